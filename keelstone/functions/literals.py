"""Python values as SQL literal text, for fixed tables inside expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_array(values: Iterable[object]) -> Column:
    return F.expr(f"array({', '.join(sql_literal(v) for v in values)})")


def literal_map(table: Mapping[str, object]) -> Column:
    pairs = (f"{sql_literal(k)}, {sql_literal(v)}" for k, v in table.items())
    return F.expr(f"map({', '.join(pairs)})")
