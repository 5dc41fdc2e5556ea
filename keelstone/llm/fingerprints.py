"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` holds, for two prime moduli, the sums of code point times power of the
base over every prefix. Any two spans, of one text or of two, are equal exactly where
the differences of their prefix values agree after both are brought to the same power;
the longest common extension from two places follows by binary search.

A fingerprint keeps the length, the value of the whole text and prefix values on a grid
from the front and from the back. The step is the power of two that leaves at most
``CELLS`` cells, so the grids of two texts nest and cells of either can be compared.

It also keeps spans that follow the content: a text is cut wherever the difference of
two prefix values ``WINDOW`` apart meets a mask, so after an insertion or a deletion the
cuts fall between the same words again. Of longer texts the spans whose hash is divisible
by the smallest sufficient power of two are kept, so those of two texts nest as well.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODULI = (2147483647, 2147483629)
BASES = (1117649, 1453487)
CELLS = 32
#: Code points that decide a cut, one place in so many, and the most spans kept.
WINDOW = 6
SPAN_BITS = 4
SPANS = 128
MIX = np.uint64(2654435761)
#: Documents of one neighbourhood, and the most neighbourhoods. Tasks stream through
#: them in order of ids, so larger ones cost time, not memory.
BUCKET_ROWS = 4096
MOST_BUCKETS = 10_000

_tables: dict[tuple[int, int], np.ndarray] = {}


def powers(modulus: int, base: int, size: int) -> np.ndarray:
    """Powers of the base from 0 on, at least ``size`` of them; kept and doubled as needed."""
    out = _tables.get((modulus, base), np.ones(1, dtype=np.uint64))
    while len(out) < size:
        factor = np.uint64(pow(base, len(out), modulus))
        out = np.concatenate([out, out * factor % np.uint64(modulus)])
    _tables[modulus, base] = out
    return out


class PrefixHash:
    """Prefix values of one text under both moduli; spans are half-open, in code points."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        points += np.uint64(1)
        self.size = len(points)
        self.values = []
        for modulus, base in zip(MODULI, BASES, strict=True):
            terms = points * powers(modulus, base, self.size)[: self.size] % np.uint64(modulus)
            sums = np.zeros(self.size + 1, dtype=np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.values.append(sums % np.uint64(modulus))

    def prefixes(self, ends: np.ndarray, k: int = 0) -> np.ndarray:
        """Values of the prefixes of some lengths under modulus number k."""
        return self.values[k][ends]

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """Values of a span, at the power of its place."""
        return tuple((int(v[end]) - int(v[start])) % m for v, m in zip(self.values, MODULI, strict=True))

    def equal(self, start: int, other: PrefixHash, other_start: int, length: int) -> bool:
        """Whether two spans of one length are equal."""
        mine, theirs = self.span(start, start + length), other.span(other_start, other_start + length)
        return all(
            a * pow(b, other_start, m) % m == c * pow(b, start, m) % m
            for a, c, b, m in zip(mine, theirs, BASES, MODULI, strict=True)
        )

    def common_extension(self, start: int, other: PrefixHash, other_start: int) -> int:
        """Length of the longest common run from two places on, by binary search."""
        lengths = range(1, min(self.size - start, other.size - other_start) + 1)
        return bisect_right(lengths, False, key=lambda n: not self.equal(start, other, other_start, n))


class Spliced:
    """Prefix values of the first ``cut`` code points of one text followed by the first
    ``more`` of another, out of the arrays of both, without hashing the new text."""

    def __init__(self, first: PrefixHash, cut: int, second: PrefixHash, more: int):
        self.first, self.cut, self.second = first, cut, second
        self.size = cut + more

    def prefixes(self, ends: np.ndarray, k: int = 0) -> np.ndarray:
        modulus = np.uint64(MODULI[k])
        factor = np.uint64(pow(BASES[k], self.cut, MODULI[k]))
        head = self.first.prefixes(np.minimum(ends, self.cut), k)
        tail = self.second.prefixes(np.maximum(ends - self.cut, 0), k)
        return (head + tail * factor) % modulus


def step_of(size: int, cells: int = CELLS) -> int:
    """Smallest power of two that cuts a text into at most so many whole cells."""
    step = 1
    while size // step > cells:
        step *= 2
    return step


class Fingerprint:
    """Length, values of the whole text, and its front and back grids of cell values.

    The value of a cell is the span's under the first modulus brought to power zero, so
    equal cells have equal values wherever they stand.
    """

    def __init__(self, text: PrefixHash | Spliced):
        self.size = text.size
        self.step = step_of(self.size)
        whole = self.size // self.step * self.step
        end = np.array([self.size])
        self.whole = tuple(int(text.prefixes(end, k)[0]) for k in range(len(MODULI)))
        self.front = self._cells(text, np.arange(0, whole + 1, self.step))
        self.back = self._cells(text, np.arange(self.size - whole, self.size + 1, self.step))[::-1]
        self.share, self.spans, self.weights = self._spans(text)

    def _spans(self, text) -> tuple[int, np.ndarray, np.ndarray]:
        """The power of two sampled by, and values and code points of the distinct spans kept."""
        modulus = np.uint64(MODULI[0])
        inverse = powers(MODULI[0], pow(BASES[0], -1, MODULI[0]), self.size + 1)
        values = text.prefixes(np.arange(self.size + 1))
        window = (values[WINDOW:] + modulus - values[:-WINDOW]) % modulus * inverse[: max(0, self.size + 1 - WINDOW)] % modulus
        cuts = np.flatnonzero(mixed(window) >> np.uint64(32 - SPAN_BITS) == 0) + WINDOW
        places = np.unique(np.concatenate([[0], cuts, [self.size]]))
        spans = (values[places[1:]] + modulus - values[places[:-1]]) % modulus * inverse[places[:-1]] % modulus
        found, where = np.unique(spans, return_inverse=True)
        weights = np.bincount(where, weights=np.diff(places), minlength=len(found)).astype(np.int64)
        share = 1
        while (kept := sampled(found, share)).sum() > SPANS:
            share *= 2
        return share, found[kept], weights[kept]

    @staticmethod
    def _cells(text, places: np.ndarray) -> np.ndarray:
        modulus = np.uint64(MODULI[0])
        inverse = powers(MODULI[0], pow(BASES[0], -1, MODULI[0]), int(places[-1]) + 1)
        values = text.prefixes(places)
        return (values[1:] + modulus - values[:-1]) % modulus * inverse[places[:-1]] % modulus

    def __str__(self) -> str:
        grids = (np.array(x).astype(">u4").tobytes().hex() for x in (self.whole, self.front, self.back))
        spans = np.stack([self.spans.astype(np.int64), self.weights], axis=1).astype(">u4").tobytes().hex()
        return ".".join([f"{self.size:x}", *grids, f"{self.share:x}", spans])

    def grid(self, step: int, backwards: bool) -> np.ndarray:
        """Cell values at a multiple of the own step: those of joined cells."""
        cells, factor = (self.back if backwards else self.front), step // self.step
        if factor == 1:
            return cells
        whole = len(cells) // factor
        weights = powers(MODULI[0], BASES[0], step)[: step : self.step]
        if backwards:
            weights = weights[::-1]
        modulus = np.uint64(MODULI[0])
        joined = cells[: whole * factor].reshape(whole, factor) * weights % modulus
        return joined.sum(axis=1) % modulus


def mixed(values: np.ndarray) -> np.ndarray:
    """32 bits of a value in which all of it tells."""
    return values * MIX & np.uint64(0xFFFFFFFF)


def sampled(values: np.ndarray, share: int) -> np.ndarray:
    """Which values are kept when one in ``share`` is, a power of two."""
    return (mixed(values ^ np.uint64(0x5BD1E995)) >> np.uint64(8)) & np.uint64(share - 1) == 0


def span_likeness(one: Fingerprint, two: Fingerprint) -> float:
    """Share of the code points in spans that both texts have, of the spans both would keep."""
    share = max(one.share, two.share)
    mine, theirs = sampled(one.spans, share), sampled(two.spans, share)
    _, i, j = np.intersect1d(one.spans[mine], two.spans[theirs], assume_unique=True, return_indices=True)
    weights, others = one.weights[mine], two.weights[theirs]
    most = max(weights.sum(), others.sum())
    return float(np.minimum(weights[i], others[j]).sum() / most) if most else 0.0


def likeness(one: Fingerprint, two: Fingerprint) -> float:
    """Share of the longer text that both have: in cells at the same distance from the
    front or from the back, or in spans wherever they stand, whichever is more. 1 for
    equal texts, and only then. Symmetric."""
    if one.size == two.size and one.whole == two.whole:
        return 1.0
    longer, shorter = max(one.size, two.size), min(one.size, two.size)
    step = step_of(longer)
    spans = []
    for backwards in (False, True):
        mine, theirs = one.grid(step, backwards), two.grid(step, backwards)
        both = min(len(mine), len(theirs))
        for k in np.flatnonzero(mine[:both] == theirs[:both]).tolist():
            start = shorter - (k + 1) * step if backwards else k * step
            spans.append((start, start + step))
    covered, reach = 0, 0
    for start, end in sorted(spans):
        covered += max(0, end - max(start, reach))
        reach = max(reach, end)
    shared = max(covered, longer * span_likeness(one, two))
    return float(min(shared, longer - 1) / longer)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_next long"
)
TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _buckets_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Bucket of each id: 0 holds the highest ids, the last one the lowest and the nulls."""
    above = np.searchsorted(bounds, ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False))
    return len(bounds) - np.minimum(above, len(bounds))


def _heads(rows: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """Upper bounds of the buckets, and for the highest id of each bucket the one it follows.

    One number for thousands of documents, and never more than ``MOST_BUCKETS``.
    """
    ids = rows.select("doc_id").dropna()
    count, lowest = ids.agg(F.count("doc_id"), F.min("doc_id")).first()
    wanted = min(MOST_BUCKETS, -(-count // BUCKET_ROWS))
    shares = [k / wanted for k in range(1, wanted)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 100 * wanted)).first()[0] if shares else []
    bounds = np.unique(np.array([x for x in found if x >= lowest], dtype=np.int64))

    def bucketed(batches):
        for batch in batches:
            places = pa.array(_buckets_of(batch.column("doc_id"), bounds), pa.int64())
            yield pa.RecordBatch.from_arrays([places, batch.column("doc_id")], names=["bucket", "doc_id"])

    highest = (
        ids.mapInArrow(bucketed, "bucket long, doc_id long")
        .groupBy("bucket")
        .agg(F.max("doc_id").alias("doc_id"))
        .orderBy("bucket")
        .collect()
    )
    # the last bucket, which also holds the nulls, is followed by the highest id of all
    before = [len(bounds), *(x["bucket"] for x in highest[:-1])]
    return bounds, {head["doc_id"]: bucket for bucket, head in zip(before, highest, strict=False)}


def _compared(batches):
    """Rows sorted by bucket and descending id, each with the text that follows it."""
    fields = [x.split() for x in SCHEMA.split(", ")]
    columns: list[list] = [[] for _ in fields]

    def put(row, following):
        doc_id, text, own, mark = row
        after, hashed, after_mark = following
        more = len(text) // 2
        edited = text[: len(text) - more] + after[:more]
        spliced = Fingerprint(Spliced(own, len(text) - more, hashed, min(more, len(after))))
        values = (
            doc_id,
            len(text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            str(mark),
            str(spliced),
            likeness(mark, spliced),
            likeness(mark, after_mark),
            own.common_extension(0, hashed, 0) if text[:1] == after[:1] else 0,
        )
        for column, value in zip(columns, values, strict=True):
            column.append(value)

    def flushed():
        arrays = [pa.array(c, TYPES[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
        for column in columns:
            column.clear()
        return pa.RecordBatch.from_arrays(arrays, names=[f[0] for f in fields])

    bucket = first = held = None
    for batch in batches:
        rows = zip(*(batch.column(n) for n in ("bucket", "follows", "doc_id", "text")), strict=True)
        for place, follows, doc_id, text in rows:
            place, follows, text = place.as_py(), follows.as_py(), text.as_py() or ""
            if place != bucket:
                if held:  # nothing follows the bucket: the table is one bucket of null ids
                    put(held, first)
                bucket, first, held = place, None, None
            elif follows and not held:
                continue  # a further row with the id that follows
            hashed = PrefixHash(text)
            following = (text, hashed, Fingerprint(hashed))
            if held:
                put(held, following)
            first = first or following
            held = None if follows else (doc_id.as_py(), *following)
            if len(columns[0]) >= 256:
                yield flushed()
    if held:
        put(held, first)
    yield flushed()


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: fingerprints of a text and of its edited text, and their likeness.

    The edited text has its last half replaced by the beginning of the next document's,
    in descending order of ids; null ids come last, rows with the same id are ordered
    by a hash of their text, and the last row is followed by the first. Null texts
    count as empty. Two empty texts are alike (1), an empty and another text are not
    (0). Other columns are not read; an empty table gives an empty result. The text is
    shuffled once, by neighbourhoods of ids; only the rows that begin a neighbourhood
    are sent twice. ``common_next`` is the length of the common beginning with the next
    document.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    bounds, followers = _heads(rows)

    def placed(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            places = _buckets_of(ids, bounds)
            again = [(k, followers[v]) for k, v in enumerate(ids.to_pylist()) if v in followers]
            taken = batch.take(pa.array([k for k, _ in again], pa.int64()))
            for part, buckets, follows in ((batch, places, 0), (taken, [b for _, b in again], 1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(buckets, pa.int64()),
                        pa.array([follows] * part.num_rows, pa.int32()),
                        part.column("doc_id"),
                        part.column("text"),
                    ],
                    names=["bucket", "follows", "doc_id", "text"],
                )

    return (
        rows.mapInArrow(placed, "bucket long, follows int, doc_id long, text string")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "follows", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
        .mapInArrow(_compared, SCHEMA)
    )
