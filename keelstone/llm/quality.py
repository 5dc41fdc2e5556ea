"""Quality of documents by an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted documents: counts of all character n-grams of the
highest order, continuation counts below it, three discounts for each order. Counts,
contexts and probabilities are tables sharded by n-gram and joined; nothing of them is
collected or broadcast but the discounts, one row for each order.

Texts move once. They are packed into compressed blocks and dealt out into groups of
about ``GROUP`` characters; a group reports which n-grams it holds and how often in
trusted documents, the joined tables answer with the logarithm of each probability, and
the group adds them up for its documents. So what a group asks for is the distinct
n-grams of its texts, and no task ever holds the model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import row_key, stored

ORDER = 4
HALF = ORDER // 2
#: Characters of a group of documents, and of what is counted in one go.
GROUP = 16_000_000
CHUNK = 1_000_000
#: Characters of the language's median that every document is given, so that a few
#: characters alone decide nothing.
PRIOR = 50.0
#: One in so many trusted documents, by hash of the id, is kept out of the counts: a model
#: is at its best on the texts it has counted, so the medians are the others'.
HELD_OUT = 5
#: A document is rejected above this quantile of its language's trusted documents, in nats
#: a character. Where the counted ones are all below it, that is a quantile of
#: 1 - HELD_OUT * (1 - QUANTILE) of those the model has not seen: at most one in 200 is lost.
QUANTILE = 0.999
#: Trusted documents from which on a language has a quantile of its own. Others take that
#: of all trusted documents, each in units of its own language's median.
ENOUGH = 1000

PAD = 0xFFFF  # before the first character; a noncharacter, read as U+FFFD within texts
N_BITS = 40  # of a trusted count beside the group's number

COUNTED = pa.schema([pa.field("ngram", pa.string(), False), pa.field("payload", pa.int64(), False)])
SCORED = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.string()), ("lang", pa.string()), ("nats", pa.float64()), ("size", pa.int64())]
)


def _packed(batches):
    """Blocks of the documents of each group in a batch, as compressed Arrow."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        groups = batch.column("g").to_numpy(zero_copy_only=False)
        rows = batch.select(["doc_id", "key", "lang", "text"])
        order = np.argsort(groups, kind="stable")
        starts = np.flatnonzero(np.r_[True, groups[order][1:] != groups[order][:-1]]) if len(order) else []
        names, blocks = [], []
        for start, end in zip(starts, [*starts[1:], len(order)], strict=False):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                writer.write_batch(rows.take(pa.array(order[start:end])))
            names.append(groups[order[start]])
            blocks.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(blocks, pa.binary())], names=["g", "block"]
        )


def _opened(blocks: pa.Table):
    for block in blocks.column("block"):
        with pa.ipc.open_stream(block.as_buffer()) as reader:
            yield reader.read_all()


def _points(text: str | None) -> np.ndarray:
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points == PAD, 0xFFFD, points) if (points == PAD).any() else points


class Alphabet:
    """Numbers for the characters of a group, and codes for its n-grams.

    A code is a number with one digit for each character. Where the alphabet is so large
    that this could pass 63 bits, it is made of the ranks of the n-gram's halves among
    all halves in the group, which no group has enough of to pass them.
    ``texts`` gives the texts anew whenever it is called.
    """

    def __init__(self, texts):
        present = np.zeros(0x110000, dtype=bool)
        present[PAD] = True
        for points in texts():
            present[points] = True
        self.points = np.flatnonzero(present).astype("<u4")
        self.number = np.zeros(0x110000, dtype=np.int64)
        self.number[self.points] = np.arange(len(self.points))
        self.halves = None
        if len(self.points) ** ORDER >= 1 << 63:
            found = np.empty(0, dtype=np.int64)
            for chunk in _chunks((None, points) for points in texts()):
                joined = self.number[self._padded([points for _, points in chunk])]
                found = np.union1d(found, self._value([joined[:-1], joined[1:]]))
            self.halves = found

    def _padded(self, texts: list[np.ndarray]) -> np.ndarray:
        pad = np.full(ORDER - 1, PAD, dtype="<u4")
        return np.concatenate([x for text in texts for x in (pad, text)])

    def _value(self, digits) -> np.ndarray:
        value = np.zeros(len(digits[0]), dtype=np.int64)
        for digit in digits:
            value = value * len(self.points) + digit
        return value

    def _digits(self, values: np.ndarray, n: int) -> list[np.ndarray]:
        digits = []
        for _ in range(n):
            values, digit = np.divmod(values, len(self.points))
            digits.append(digit)
        return digits[::-1]

    def _code(self, digits) -> np.ndarray:
        if self.halves is None:
            return self._value(digits)
        first, second = (np.searchsorted(self.halves, self._value(x)) for x in (digits[:HALF], digits[HALF:]))
        return first * len(self.halves) + second

    def codes(self, texts: list[np.ndarray]) -> np.ndarray:
        """One code for each character of the texts: the n-gram that it ends."""
        joined = self.number[self._padded(texts)]
        size = len(joined) - ORDER + 1
        codes = self._code([joined[k : k + size] for k in range(ORDER)])
        lengths = [len(t) for t in texts]
        ends = np.repeat(np.cumsum([ORDER - 1, *(n + ORDER - 1 for n in lengths[:-1])]), lengths)
        places = ends + np.arange(sum(lengths)) - np.repeat(np.cumsum([0, *lengths[:-1]]), lengths)
        return codes[places - ORDER + 1]

    def strings(self, codes: np.ndarray) -> list[str]:
        if self.halves is None:
            digits = self._digits(codes, ORDER)
        else:
            digits = [x for half in np.divmod(codes, len(self.halves)) for x in self._digits(self.halves[half], HALF)]
        text = self.points[np.stack(digits, axis=1)].tobytes().decode("utf-32-le", "surrogatepass")
        return [text[k : k + ORDER] for k in range(0, len(text), ORDER)]

    def of_strings(self, ngrams) -> np.ndarray:
        points = np.frombuffer("".join(ngrams).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return self._code([self.number[points[k::ORDER]] for k in range(ORDER)])


def _chunks(items):
    """Lists of (anything, points) with about ``CHUNK`` characters each."""
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item[1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _documents(blocks):
    """Row (doc_id, key, lang) and points of every document of a group."""
    for table in _opened(blocks):
        rows = zip(*(table.column(c).to_pylist() for c in ("doc_id", "key", "lang")), strict=True)
        for row, text in zip(rows, table.column("text"), strict=True):
            yield row, _points(text.as_py())


def _counted(key, blocks: pa.Table, trusted: pa.Table) -> pa.Table:
    """Distinct n-grams of a group and how often they occur in its trusted documents."""
    known = set(trusted.column("doc_id").to_pylist())
    alphabet = Alphabet(lambda: (points for _, points in _documents(blocks)))
    seen, held, counts = [np.empty(0, dtype=np.int64)], [], []
    for chunk in _chunks(_documents(blocks)):
        seen.append(np.unique(alphabet.codes([points for _, points in chunk])))
        if own := [points for row, points in chunk if row[0] in known]:
            found, number = np.unique(alphabet.codes(own), return_counts=True)
            held.append(found)
            counts.append(number)
    codes = np.unique(np.concatenate(seen))
    total = np.zeros(len(codes), dtype=np.int64)
    for found, number in zip(held, counts, strict=True):
        total[np.searchsorted(codes, found)] += number
    payload = total + (key[0].as_py() << N_BITS)
    names = pa.array(alphabet.strings(codes), pa.string())
    return pa.table([names, pa.array(payload)], schema=COUNTED)


def _scored(_key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Nats and characters of every document of a group."""
    alphabet = Alphabet(lambda: (points for _, points in _documents(blocks)))
    codes = alphabet.of_strings(answers.column("ngram").to_pylist())
    order = np.argsort(codes)
    codes, nats = codes[order], -answers.column("logp").to_numpy().astype(np.float64)[order]
    rows, sums, sizes = [], [np.empty(0)], [np.empty(0, dtype=np.int64)]
    for chunk in _chunks(_documents(blocks)):
        own = alphabet.codes([points for _, points in chunk])
        total = np.r_[0.0, np.cumsum(nats[np.searchsorted(codes, own)])]
        lengths = np.array([len(points) for _, points in chunk])
        ends = np.cumsum(lengths)
        rows += [row for row, _ in chunk]
        sums.append(total[ends] - total[ends - lengths])
        sizes.append(lengths)
    columns = [pa.array([row[k] for row in rows], SCORED.field(k).type) for k in range(3)]
    columns += [pa.array(np.concatenate(sums)), pa.array(np.concatenate(sizes))]
    return pa.table(columns, schema=SCORED)


def log_probabilities(counts: DataFrame) -> DataFrame:
    """``ngram``, ``logp`` of every n-gram of ``counts`` (``ngram``, ``c``; c may be 0).

    The last character of an n-gram given those before it. Below the highest order a
    count is the number of different characters seen before the n-gram. A context that
    was never seen passes everything on to the next order, the lowest one to equal
    chances for all characters seen and one more.
    """
    levels = range(1, ORDER)
    seen = counts.where("c > 0")
    parts = [
        F.struct(F.lit(n).alias("n"), F.substring("ngram", -n, n).alias("x"), F.substring("ngram", ORDER - n, 1).alias("before"))
        for n in levels
    ]
    below = (
        seen.select(F.explode(F.array(*parts)).alias("part"))
        .groupBy("part.n", "part.x")
        .agg(F.size(F.collect_set("part.before")).cast("long").alias("a"))
    )
    adjusted = below.union(seen.select(F.lit(ORDER).alias("n"), "ngram", "c"))
    contexts = adjusted.groupBy("n", F.expr("left(x, n - 1)").alias("h")).agg(
        F.sum("a").alias("total"),
        F.count_if(F.col("a") == 1).alias("ones"),
        F.count_if(F.col("a") == 2).alias("twos"),
        F.count_if(F.col("a") >= 3).alias("more"),
    )
    times = adjusted.groupBy(F.col("n").alias("level")).agg(
        *(F.count_if(F.col("a") == k).cast("double").alias(f"t{k}") for k in range(1, 5)),
        F.count("*").alias("types"),
    )
    y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))
    discounts = times.select(
        "level",
        "types",
        *(
            # where a count of counts is missing, the discount of a half; never nothing
            F.greatest(
                F.least(F.coalesce(k - (k + 1) * y * F.try_divide(F.col(f"t{k + 1}"), F.col(f"t{k}")), F.lit(0.5)), F.lit(float(k))),
                F.lit(0.05),
            ).alias(f"d{k}")
            for k in (1, 2, 3)
        ),
    )
    # no context is one key for a quarter of all rows: it comes with the discounts instead,
    # and those rows get a key of their own, longer than any context
    nothing = [F.col(c).alias(f"all_{c}") for c in ("total", "ones", "twos", "more")]
    root = contexts.where("n = 1").select(F.col("n").alias("first"), *nothing)
    context = F.expr("left(right(ngram, m), m - 1)")
    # like every other use of the counts this needs both columns, so all share one exchange
    asked = counts.where("c >= 0").select("ngram", F.explode(F.sequence(F.lit(1), F.lit(ORDER))).alias("m")).select(
        "ngram",
        "m",
        F.expr("right(ngram, m)").alias("y"),
        F.when(F.col("m") > 1, context).otherwise(F.repeat("ngram", 2)).alias("g"),
    )
    discount = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
    total, ones, twos, more = (
        F.coalesce(F.col(c), F.col(f"all_{c}")) for c in ("total", "ones", "twos", "more")
    )
    passed = F.col("d1") * ones + F.col("d2") * twos + F.col("d3") * more
    terms = (
        asked.join(adjusted, (F.col("m") == F.col("n")) & (F.col("y") == F.col("x")), "left")
        .select("ngram", "m", "g", "a")
        .join(contexts, (F.col("m") == F.col("n")) & (F.col("g") == F.col("h")), "left")
        .join(F.broadcast(root), F.col("m") == F.col("first"), "left")
        .join(F.broadcast(discounts), F.col("m") == F.col("level"), "left")
        .select(
            "ngram",
            F.struct(
                "m",
                F.coalesce(F.greatest(F.col("a") - discount, F.lit(0.0)) / total, F.lit(0.0)).alias("own"),
                F.coalesce(passed / total, F.lit(1.0)).alias("passed"),
                F.coalesce(F.when(F.col("m") == 1, F.col("types")), F.lit(0)).alias("types"),
            ).alias("term"),
        )
    )
    return terms.groupBy("ngram").agg(F.array_sort(F.collect_list("term")).alias("terms")).select(
        "ngram",
        F.log(
            F.aggregate(
                "terms",
                1.0 / (F.col("terms")[0]["types"] + 1),
                lambda p, term: term["own"] + term["passed"] * p,
            )
        ).alias("logp"),
    )


def trusted_ids(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Ids that are labelled as good and not as toxic, once each."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return labels.where(good).select(F.col(id_column).cast("long").alias("doc_id")).dropna().distinct()


def held_out():
    return F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0


def score(
    docs: DataFrame,
    trusted: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """``doc_id``, ``key``, ``lang``, ``nats``, ``size`` of every row, stored."""
    key = row_key(id_column, text_column)
    total = docs.agg(F.sum(F.length(text_column))).first()[0] or 0
    groups = max(1, -(-total // GROUP))
    own = F.coalesce(F.xxhash64(F.col("doc_id")), F.lit(0))
    blocks = (
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            key.alias("key"),
            F.col(lang_column).cast("string").alias("lang"),
            F.col(text_column).cast("string").alias("text"),
        )
        .withColumn("g", F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("key")).otherwise(own), F.lit(groups)))
        .mapInArrow(_packed, "g long, block binary")
        .repartition("g")
    )
    known = trusted.where(~held_out()).select(F.pmod(own, F.lit(groups)).alias("g"), "doc_id")
    counted = (
        blocks.groupBy("g")
        .cogroup(known.groupBy("g"))
        .applyInArrow(_counted, "ngram string NOT NULL, payload long NOT NULL")
        .repartition("ngram")
    )
    counts = counted.groupBy("ngram").agg(
        F.sum(F.col("payload").bitwiseAND(F.lit((1 << N_BITS) - 1))).alias("c")
    )
    answers = counted.join(log_probabilities(counts), "ngram").select(
        F.shiftright("payload", N_BITS).alias("g"), "ngram", F.col("logp").cast("float").alias("logp")
    )
    scores = (
        blocks.groupBy("g")
        .cogroup(answers.groupBy("g"))
        .applyInArrow(_scored, "doc_id long, key string, lang string, nats double, size long")
    )
    return stored(scores, "scores")


def judge(scores: DataFrame, trusted: DataFrame) -> DataFrame:
    """Perplexity, threshold and decision for every row of ``score``."""

    def by_language(df, good, name, value):
        """Rows of ``df`` with a value of their language's ``good`` rows and that of all."""
        known = good.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("n_trusted"), value.alias(name))
        known = stored(known, "languages")
        everywhere = F.lit(good.agg(value).first()[0]).cast(known.schema[name].dataType)
        return df.join(known, F.col("lang").eqNullSafe(F.col("l")), "left").withColumn(f"all_{name}", everywhere)

    good = scores.join(trusted.where(held_out()), "doc_id", "left_semi").where("size > 0")
    median = F.percentile_approx(F.col("nats") / F.col("size"), 0.5, 10_000)
    middle = F.coalesce("median", "all_median")
    rate = (F.col("nats") + PRIOR * F.coalesce("middle", F.lit(0.0))) / (F.col("size") + PRIOR)
    rates = by_language(scores, good, "median", median).withColumn("middle", middle)
    rates = stored(rates.select(*scores.columns, "middle", rate.alias("rate")), "rates")

    good = rates.join(trusted, "doc_id", "left_semi").where("size > 0")
    good = good.withColumn("part", F.try_divide("rate", "middle"))
    bound = F.percentile_approx("part", QUANTILE, 10_000)
    limit = F.col("middle") * F.when(F.col("n_trusted") >= ENOUGH, F.col("bound")).otherwise(F.col("all_bound"))
    return by_language(rates, good, "bound", bound).select(
        "doc_id",
        "key",
        "lang",
        F.col("size").alias("n_scored"),
        F.exp("rate").alias("perplexity"),
        F.exp(limit).alias("threshold"),
        F.coalesce((F.col("rate") <= limit) | (F.col("size") == 0), F.lit(True)).alias("kept"),
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """One row per row: perplexity, its language's threshold, and whether it is kept.

    Null and empty texts have no characters and are kept: nothing speaks against them.
    A language with few trusted documents, null included, uses the quantile of all
    trusted documents; without any trusted document everything is kept. Repeated rows
    are scored each, rows that repeat an id are trusted together. Other columns are not
    read. Ids are expected to be mostly distinct: rows of one id meet in one group.
    """
    trusted = trusted_ids(labels, id_column)
    return judge(score(docs, trusted, id_column, text_column, lang_column), trusted)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps."""
    rejected = classify(docs, labels, id_column, text_column, lang_column).where(~F.col("kept"))
    return (
        docs.withColumn("__row", row_key(id_column, text_column))
        .join(rejected.select(F.col("key").alias("__key")), F.col("__row") == F.col("__key"), "left_anti")
        .drop("__row")
    )
