"""Ids of packed texts against the tokenizer's file with its own settings."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keelstone.llm import packing
from keelstone.llm.queries import vocabulary

TEXTS = [
    "before <|endoftext|> after",
    "<|endoftext|>",
    "<|endoftext|><|endoftext|> <|endoftext",
    "a" + " " * 1_000_000 + "b",
    "\n" * 1_000_000,
    "x\n \t" * 4 + " \u3000\xa0" * 400_000,
    "a" * 200_000,
    " " * 9_999 + "b",
]


@pytest.fixture(scope="module")
def reference():
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: coder.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("ranks", [True, False])
def test_ids_are_those_of_the_tokenizer(reference, ranks):
    coder = packing.Coder(*vocabulary()[: 1 + ranks])
    for text in TEXTS:
        assert coder.encode(text) == np.array(reference(text), dtype="<u4").tobytes()


def test_added_token_is_one_id(reference):
    assert len(reference("<|endoftext|>")) == 1
    assert packing.Coder(*vocabulary()).encode("<|endoftext|>") == np.array([50256], dtype="<u4").tobytes()


def test_pieces_of_such_texts(spark, reference):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    pieces: dict = {}
    for r in packing.pack(docs, *vocabulary()).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    for k, text in enumerate(TEXTS):
        ids, at = reference(text) + [packing.END], 0
        for r in sorted(pieces[k], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
