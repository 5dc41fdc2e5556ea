"""How the vocabularies of sources diverge, by sorting pointers to the starts of words.

Each task gathers texts into shards of ``SHARD_BYTES`` and works on the Arrow text
buffer itself: no word becomes an object before it is counted. A shard is cut into one
slice per (lang, source). The pointers to the word starts of a slice are sorted by a
multikey quicksort whose characters are the next seven bytes and how many of them the
word has left: pointers are sorted by the character at the present depth, and runs of
equal characters whose words go on are sorted again seven bytes deeper. A run of equal
words then gives the occurrences of a term in the slice and, as its pointers stay in
text order, the documents that hold it.

The runs of all shards meet in one shuffle by (lang, term). Terms in at least
``MIN_DOCUMENTS`` documents stay, and the sums for every pair of sources are taken in
shards of the terms: a task holds the probabilities of some terms for all sources and
adds up whole columns, so no pair of rows is ever built. All arithmetic is exact.
"""

from __future__ import annotations

import collections

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelstone.llm.common import stored

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Text gathered before its pointers are sorted. A longer text is a shard of its own.
SHARD_BYTES = 16 << 20
#: Rows of (source, term) of one language compared in one group.
ROWS_PER_GROUP = 100_000
#: Sources against which one group compares all sources of its language.
SOURCES_PER_BLOCK = 512
#: Cells of the matrix of terms and sources that a group holds at a time.
CELLS = 1 << 20

_BYTES = np.arange(256)
#: ASCII letters and all bytes of other characters belong to terms.
IN_TERM = (_BYTES >= 0x80) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of a character of the sort; the eighth says how many the word has left, with
#: one more for all that go on.
STEP = 7
#: The first n of eight bytes, read as a big-endian number; the character of a word that goes on has all seven.
FIRST = np.array([((1 << 8 * n) - 1) << 8 * (8 - n) for n in (*range(STEP + 1), STEP)], dtype=np.uint64)
#: Rows of a batch that are looked at before the size of the shard is.
ROWS_PER_LOOK = 512


def pointers(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all terms in the bytes of texts that begin at ``offsets``."""
    inside = np.zeros(len(text) + 2, dtype=bool)
    inside[1:-1] = IN_TERM[text]
    starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(text))]  # texts touch each other in the buffer
    starts[edges] |= inside[edges + 1]
    ends[edges - 1] |= inside[edges]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def sorted_runs(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by term, and where in it each run of equal terms begins.

    ``text`` needs eight more bytes than the last term. Equal terms keep their order.
    """
    words = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    order = np.arange(len(starts))
    new = np.zeros(len(starts), dtype=bool)
    # places of the order still to sort, and the run each belongs to
    at, run, depth = order.copy(), np.zeros(len(starts), dtype=np.int64), 0
    while len(at):
        own = order[at]
        left = np.minimum(lengths[own] - depth, STEP + 1)
        keys = words[starts[own] + depth].astype(np.uint64) & FIRST[left] | left.astype(np.uint64)
        by = np.argsort(keys, kind="stable") if depth == 0 else np.lexsort((keys, run))
        own, keys, left = own[by], keys[by], left[by]
        order[at] = own
        parted = np.r_[True, (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])]
        new[at] |= parted
        number = np.cumsum(parted)
        deeper = (left > STEP) & (np.bincount(number)[number] > 1)
        at, run, depth = at[deeper], number[deeper], depth + STEP
    return order, np.flatnonzero(new)


def slice_terms(text: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Terms of the texts of one slice, their occurrences, and the texts that hold them."""
    starts, ends = pointers(text, offsets)
    padded = np.concatenate([LOWER[text], np.zeros(8, np.uint8)])
    lengths = ends - starts
    order, runs = sorted_runs(padded, starts, lengths)
    counts = np.diff(np.r_[runs, len(order)])
    documents = np.searchsorted(offsets, starts[order], side="right")
    fresh = np.r_[True, documents[1:] != documents[:-1]] if len(order) else np.zeros(0, bool)
    fresh[runs] = True
    holding = np.add.reduceat(fresh.astype(np.int64), runs) if len(runs) else np.zeros(0, np.int64)
    first = order[runs]
    sizes = lengths[first]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    take = np.repeat(starts[first] - bounds[:-1], sizes) + np.arange(bounds[-1])
    terms = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(padded[take])
    )
    return terms.cast(pa.string()), counts, holding


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts without nulls, and where each text begins and ends."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return text, offsets - offsets[0]


def _slices(shard: dict):
    for (lang, source), columns in shard.items():
        parts = [_text_bytes(c) for c in columns]
        shifts = np.concatenate([[0], np.cumsum([len(t) for t, _ in parts])[:-1]])
        text = np.concatenate([t for t, _ in parts])
        offsets = np.concatenate([o[:-1] + s for (_, o), s in zip(parts, shifts, strict=True)])
        terms, counts, holding = slice_terms(text, offsets)
        n = len(terms)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int64))),
                    pa.array([source], pa.string()).take(pa.array(np.zeros(n, np.int64))),
                    terms,
                    pa.array(counts, pa.int64()),
                    pa.array(holding, pa.int64()),
                ],
                names=["lang", "source", "term", "uses", "documents"],
            )


def shard_terms(batches, shard_bytes: int, rows_per_look: int):
    """Terms of every slice of every shard of the texts of a task."""
    shard, size = collections.defaultdict(list), 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows_per_look):
            part = batch.slice(at, rows_per_look)
            rows = collections.defaultdict(list)
            for k, x in enumerate(part.select(["lang", "source"]).to_pylist()):
                rows[x["lang"], x["source"]].append(k)
            texts = part.column("text")
            for group, own in rows.items():
                shard[group].append(texts.take(pa.array(own)))
            size += texts.nbytes
            if size >= shard_bytes:
                yield from _slices(shard)
                shard, size = collections.defaultdict(list), 0
    yield from _slices(shard)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``uses`` and the ``total`` of all sources for every kept term.

    ``first`` marks one row of each (lang, term).
    """
    found = docs.select(*_groups(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shard_bytes, rows_per_look = SHARD_BYTES, ROWS_PER_LOOK

    def terms(batches):
        return shard_terms(batches, shard_bytes, rows_per_look)

    runs = found.mapInArrow(terms, "lang string, source string, term string, uses long, documents long")
    # one exchange serves the sums of each source and those of the language
    counts = runs.repartition("lang", "term").groupBy("lang", "term", "source")
    counts = counts.agg(F.sum("uses").alias("uses"), F.sum("documents").alias("documents"))
    whole = Window.partitionBy("lang", "term")
    counts = counts.select(
        "lang",
        "source",
        "term",
        "uses",
        F.sum("uses").over(whole).alias("total"),
        F.sum("documents").over(whole).alias("__documents"),
        (F.col("source") == F.min("source").over(whole)).alias("first"),
    )
    return counts.where(F.col("__documents") >= MIN_DOCUMENTS).drop("__documents")


def _groups():
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def _probability(count, total, terms):
    """p of a count, exact at any size; 1 more than the scale where there are no terms."""
    wide = (count + F.lit(1)).cast("decimal(25,0)") * F.lit(SCALE).cast("decimal(11,0)")
    return F.lit(1) + F.call_function("div", wide, F.greatest(total + terms, F.lit(1)).cast("decimal(25,0)"))


def sources(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Every (lang, source) with its words ``words``, those and the terms of the language, and its number ``k``."""
    own = counts.groupBy("lang", "source").agg(F.sum("uses").alias("words"), F.count_if("first").alias("lang_terms"))
    found = docs.select(*_groups()).distinct().join(own, ["lang", "source"], "left").fillna(0, ["words", "lang_terms"])
    lang = found.groupBy("lang").agg(
        F.sum("words").alias("lang_words"), F.sum("lang_terms").alias("lang_terms"), F.count(F.lit(1)).alias("lang_sources")
    )
    numbered = found.drop("lang_terms").withColumn(
        "k", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    )
    return numbered.join(lang, "lang")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def pair_sums(lang, block, rows: pa.Table, groups: pa.Table, per_block: int, cells: int) -> pa.Table:
    """For some terms of a language, the sums of all its sources against one block of them."""
    groups = groups.sort_by("k")
    names = groups.column("source")
    start = groups.column("absent").to_numpy()
    low, high = block * per_block, min((block + 1) * per_block, len(start))
    sums = np.zeros((high - low, len(start)), dtype=np.int64)
    if rows.num_rows:
        rows = rows.select(["term", "column", "p"]).sort_by("term")
        ids = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        k, p = rows.column("column").to_numpy(), rows.column("p").to_numpy()
        step = max(1, cells // len(start))
        for at in range(0, int(ids[-1]) + 1, step):
            a, b = np.searchsorted(ids, [at, at + step])
            table = np.tile(start, (min(step, int(ids[-1]) + 1 - at), 1))
            table[ids[a:b] - at, k[a:b]] = p[a:b]
            for other in range(low, high):
                sums[other - low] += divergence(table, table[:, other : other + 1]).sum(axis=0)
    of, against = np.meshgrid(np.arange(len(start)), np.arange(low, high))
    apart = (of != against).ravel()
    of, against = of.ravel()[apart], against.ravel()[apart]
    return pa.table(
        {
            "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(of), np.int64))),
            "source": names.take(pa.array(of)),
            "item": names.take(pa.array(against)),
            "value": pa.array(sums.ravel()[apart]),
        }
    )


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum over all kept terms for every source against every other of its language."""
    shards = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_GROUP).alias("shards"))
    groups = groups.join(shards, "lang", "left").withColumns(
        {
            "shards": F.coalesce("shards", F.lit(1).cast("long")),
            "blocks": F.ceil(F.col("lang_sources") / SOURCES_PER_BLOCK),
            "absent": _probability(F.lit(0), F.col("words"), F.col("lang_terms")),
        }
    )
    to_all = [F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).alias(c[:-1]) for c in ("shards", "blocks")]
    whole = groups.select("lang", "source", "k", "absent", "blocks", to_all[0])
    whole = whole.select("lang", "shard", to_all[1], "source", "k", "absent")
    parts = groups.select("lang", "source", F.col("k").alias("column"), "shards", "blocks")
    rows = kept.join(parts, ["lang", "source"]).withColumn("shard", F.pmod(F.xxhash64("term"), "shards"))
    rows = rows.select("lang", "shard", to_all[1], "term", "column", "p")
    key = ["lang", "shard", "block"]
    per_block, cells = SOURCES_PER_BLOCK, CELLS

    def sums(key, left, right):
        return pair_sums(key[0].as_py(), key[2].as_py(), left, right, per_block, cells)

    found = rows.groupBy(*key).cogroup(whole.groupBy(*key)).applyInArrow(
        sums, "lang string, source string, item string, value long"
    )
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audit(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of a table of documents.

    Null text, lang and source count as empty texts, so they form groups of their own.
    Repeated rows count as often as they come. A language whose terms are all too rare
    has pairs of value 0 and no terms; one with a single source has no pairs. Equal
    values are ranked by the item's UTF-8 bytes. Other columns are not read. An empty
    table gives an empty result.
    """
    counts = stored(term_counts(docs), "terms")
    groups = stored(sources(docs, counts), "sources")
    facts = groups.select("lang", "source", "words", "lang_words", "lang_terms")
    kept = counts.join(facts, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        _probability(F.col("uses"), F.col("words"), F.col("lang_terms")).alias("p"),
        _probability(F.col("total"), F.col("lang_words"), F.col("lang_terms")).alias("q"),
    )
    kept = stored(kept, "probabilities")
    above = kept.where("p > q")
    value = F.expr("(p - q) * (p - q) div q")
    terms = above.select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    top = _ranked(terms, "term").where(F.col("rank") <= TOP_TERMS)
    return _ranked(pairs(kept, groups), "pair").unionByName(top)
