"""The entry point without the optional part."""

from __future__ import annotations

import sys

import __spark_entry__ as contract
import pytest

from keelstone import catalog


@pytest.mark.parametrize("gone", ["keelstone.llm", "keelstone.llm.queries", "corpus_pipeline"])
def test_a_missing_module_costs_only_what_needs_it(monkeypatch, gone):
    monkeypatch.setitem(sys.modules, gone, None)  # importing it fails
    for name in ("keelstone.llm.queries", "corpus_pipeline"):
        if name != gone:
            monkeypatch.delitem(sys.modules, name, raising=False)
    with pytest.warns(UserWarning, match="training data"):
        queries = contract.queries()
    assert set(catalog.all_queries()) <= set(queries)
    assert "pipeline" not in queries
    assert set(contract.oracle_sql()) <= set(queries)
