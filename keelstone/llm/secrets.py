"""Secrets in texts, with a random forest that removes false findings.

Candidates are words of at least ``SHORTEST`` characters with a digit, or ``LETTERS``
with many changes of case; words of any length that a telling name announces, before them
or in the same word; and words with a published prefix. A random forest, trained on
labelled findings, decides from a candidate's length, the kinds of characters and the
transitions between them, how much of it dictionary words cover, whether it stands in a
path, and the words around it. DataFrame and SQL functions only.

A text is cut into blocks of ``BLOCK`` words, each with the words around it and its place
in the text, so the work of a text grows with its length whatever its candidates.
"""

from __future__ import annotations

import functools

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TREES = 40
DEPTH = 8
SEED = 1
#: Candidates at least as probable are secrets.
DECISION = 0.5
SHORTEST = 8
#: Words of letters only are candidates from this length and this many changes to capitals.
LETTERS = 16
#: Words of a text that are looked at together.
BLOCK = 128
#: Words before and after a candidate that count as its neighbours.
NEAR = 3
#: Labelled findings of each kind.
EXAMPLES = 24

# Names that announce secrets, words that announce something else, common
# words of identifiers and placeholders, common pairs of letters, published prefixes.
CUES = "password|passwort|passwd|passphrase|pwd|secret|token|api.?key|access.?key|private.?key|credential|auth"
CALM = "example|sample|dummy|placeholder|checksum|md5|sha1|sha256|commit|revision|version|isbn|uuid|order|invoice|card|phone|call"
WORDS = (
    "password|secret|token|example|sample|test|dummy|change|here|your|access|admin|user|default|value|"
    "index|image|static|assets|build|release|report|version|config|server|client|public|private|local|"
    "name|page|article|content|download|upload|file|data|http|https|www|com|org|net|mail|html|json|the|and|"
    "required|must|not|see|that|this|should|have|been|will|with|from|when|what|which|incorrect|invalid|"
    "missing|expired|forgotten|reset|empty|none|null|true|false|optional|stored|sent|used|needed|wrong|"
    "correct|below|above|following|only|never|always|again|please|enter|type|old|new|reporting|nicht|wird|"
    "und|der|die|das|est|pas|les|des|une|que|los|las|una|por|para"
)
PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|ed|is|it|al|ar|st|to|nt|ng|se|ha|ou|io|le|ve|co|me|de|ch|ei|ie"
PREFIXES = r"AKIA|ASIA|AIza|ghp_|gho_|github_pat_|glpat-|sk_live_|rk_live_|xox[abprs]-|eyJ|SG\."

SPACE = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\x0c\r"
UNIT = rf"(?<=[{SPACE}])(?=[^{SPACE}])"
EDGES = r"""^[(\["'`<{]+|[)\]"'`>},;.!?]+$"""
ASSIGNED = r"""^([A-Za-z_][A-Za-z0-9_.\-]{0,40})["']?(?:=>|:=|=|:)["']?(.+)$"""
OPEN = r"""["'`(\[{<]*"""
NAMED = rf"""(?i:{CUES})[A-Za-z0-9_.\-]*["'\]`)]*"""
#: What ends the words before an announced one, and the signs it needs at least.
ANNOUNCED = rf"{NAMED}[{SPACE}]*(?:=>|:=|=|:|(?i:[{SPACE}]is))[{SPACE}]*$"
SIGNED = rf"(?:[=:>]|(?i:is))[{SPACE}]*$"
OWN = rf"{NAMED}(?:=>|:=|=|:){OPEN}[A-Za-z0-9]"
CAPITALS = "(?:[a-z0-9][A-Z].*){3}"
ANY_CANDIDATE = rf"[0-9]|(?i:{CUES})|{PREFIXES}|[a-z][A-Z]"


def _share(value: Column, pattern: str) -> Column:
    """Share of a value's characters that matches of a pattern begin at."""
    return F.coalesce(F.try_divide(F.regexp_count(value, F.lit(pattern)), F.length(value)), F.lit(0.0)).cast("double")


def features(found: DataFrame) -> DataFrame:
    """Adds ``value``, ``kind`` and the features to rows with ``before``, ``word``, ``after``."""
    bare = F.regexp_replace("word", EDGES, "")
    name, assigned = F.regexp_extract(bare, ASSIGNED, 1), F.regexp_extract(bare, ASSIGNED, 2)
    value = F.regexp_replace(F.when(assigned != "", assigned).otherwise(bare), EDGES, "")
    found = found.withColumns({"value": value, "name": name})
    value, lowered = F.col("value"), F.lower("value")
    near = F.trim(F.lower(F.concat_ws(" ", "before", "name")))
    uncovered = F.length(F.regexp_replace(lowered, WORDS, ""))

    def flag(column: Column, pattern: str) -> Column:
        return column.rlike(pattern).cast("double")

    return found.withColumns(
        {
            "f_length": F.length(value).cast("double"),
            "f_digits": _share(value, "[0-9]"),
            "f_upper": _share(value, "[A-Z]"),
            "f_lower": _share(value, "[a-z]"),
            "f_marks": _share(value, "[^A-Za-z0-9]"),
            "f_dots": _share(value, r"[.]"),
            "f_changes": _share(value, r"(?<=[a-z])(?=[0-9A-Z])|(?<=[A-Z])(?=[0-9a-z])|(?<=[0-9])(?=[A-Za-z])"),
            "f_pairs": _share(lowered, PAIRS),
            "f_different": F.coalesce(
                F.try_divide(F.size(F.array_distinct(F.split(value, ""))), F.length(value)), F.lit(0.0)
            ).cast("double"),
            "f_covered": F.coalesce(1 - F.try_divide(uncovered, F.length(value)), F.lit(0.0)).cast("double"),
            "f_path": flag(value, r"[/\\]|^[~.]|\.(html?|png|jpe?g|js|css|py|txt|json|pdf)$"),
            "f_at": flag(value, "@"),
            "f_hex": flag(value, "^[0-9a-f]+$|^[0-9A-F]+$"),
            "f_number": flag(value, r"^[+(]?[0-9][0-9().,:/\-]*$"),
            "f_cue": flag(near, rf"(?:{CUES})[a-z0-9_.\-]*[\"'\]`)]* ?(?:=>|:=|=|:|is)?$"),
            "f_calm": flag(F.lower(F.concat_ws(" ", "before", "name", "after")), CALM),
            "f_prefix": flag(value, rf"^(?:{PREFIXES})"),
        }
    ).withColumn(
        "kind",
        F.when(F.col("f_prefix") == 1, "known prefix").when(F.col("f_cue") == 1, "announced").otherwise("shape"),
    )


FEATURES = (
    "f_length f_digits f_upper f_lower f_marks f_dots f_changes f_pairs f_different f_covered f_path f_at "
    "f_hex f_number f_cue f_calm f_prefix"
).split()


def labelled_findings(spark: SparkSession) -> DataFrame:
    """Labelled findings built from a rule: ``before``, ``word``, ``after``, ``label``.

    Each kind has ``EXAMPLES`` rows whose characters come from hashes of the row number;
    the words around them rotate through a few plain ones.
    """
    numbers = spark.range(EXAMPLES)
    digest = F.sha2(F.concat(F.lit("finding"), F.col("id").cast("string"), F.lit(".")), 512)

    def hexes(n, at=1):
        return F.substring(digest, at, n)

    def mapped(n, alphabet, at=1):
        return F.translate(hexes(n, at), "0123456789abcdef", alphabet)

    upper = mapped(16, "QZ7KM2XWJ4VTYB5C")
    mixed = F.concat(mapped(12, "aZ3kQ9xWb7LtR2sY"), mapped(12, "m8HcV1fNp0GjE4uD", 30))
    digits = mapped(16, "0123456789012345")
    letters = mapped(12, "etaoinshrdlucmfw")
    plain = ["the report said that", "we went on and", "und der die", "que la casa es", "dans le monde"]
    around = F.get(F.array(*map(F.lit, plain)), (F.col("id") % len(plain)).cast("int"))
    number = F.col("id") * 7 + 11
    things = F.array(*map(F.lit, "Garden Silver Monkey Window Purple Winter Bridge Coffee Horse Candle River".split()))

    def thing(step):
        return F.get(things, ((F.col("id") * step + step) % 11).cast("int"))

    secret = [
        ("", F.concat(F.lit("AKIA"), upper)),
        ("password", F.concat(F.lit("password="), hexes(18))),
        ("token =", F.concat(F.lit('"'), hexes(40), F.lit('"'))),
        ("", F.concat(F.lit('"'), hexes(40), F.lit('"'))),
        ("", hexes(18)),
        ("", mixed),
        ("api_key:", mixed),
        ("", F.concat(F.lit("ghp_"), mixed, hexes(8))),
        ("", F.concat(F.lit("sk_live_"), mixed)),
        ("secret is", mixed),
        ("", F.concat(F.lit("DB_PASSWORD="), mapped(14, "aZ3kQ9xWb7LtR2sY"))),
        ("Authorization: token", F.concat(F.lit("eyJ"), mixed, F.lit("."), mixed)),
        ("", F.concat(F.lit('"client_secret":"'), hexes(32), F.lit('"'))),
        ("pwd:", F.concat(letters, hexes(4), F.lit("!"))),
        ("aws key", F.concat(F.lit("ASIA"), upper)),
        ("key", F.concat(F.lit("AKIA"), F.translate(upper, "0123456789", "QZXKMTWJVY"))),
        ("token:", F.concat(F.lit("ghp_"), F.translate(F.concat(mixed, hexes(10)), "0123456789", "qZxKmTwJvY"))),
        ("password:", F.concat(F.initcap(letters), F.initcap(F.reverse(letters)))),
        ("Password:", F.concat(F.initcap(mapped(7, "etaoinshrdlucmfw", 3)), F.initcap(mapped(6, "wfmculdrhsnioate", 9)))),
        ("password =", F.concat(F.initcap(mapped(6, "etaoinshrdlucmfw", 5)), F.lit("Secret"), F.lit("Pass!"))),
        ("password:", F.concat(mapped(3, "abcdefghklmnprst"), F.substring(digits, 1, 3))),
        ("password:", F.concat(thing(1), thing(3), thing(7))),
        ("passphrase =", F.concat(thing(2), thing(5), F.lit("!"))),
        ("Passwort:", F.concat(F.lower(thing(4)), thing(9), thing(2), F.col("id"))),
        ("passwd is", F.concat(mapped(5, "abcdefghklmnprst"), F.substring(digits, 1, 2), F.lit("!"))),
        ("secret =", F.concat(F.lit("'"), mapped(9, "aZ3kQ9xWb7LtR2sY"), F.lit("'"))),
    ]
    harmless = [
        ("mail to", F.concat(letters, F.lit("."), number, F.lit("@mail.example.com"))),
        ("host", F.concat_ws(".", number, number + 13, number, number % 90)),
        ("card", digits),
        ("for", digits),
        ("call +1 (555)", F.concat(F.substring(digits, 1, 3), F.lit("-"), F.substring(digits, 4, 4))),
        ("on", F.concat(F.lit("2024-0"), 1 + F.col("id") % 9, F.lit("-1"), F.col("id") % 9, F.lit("T10:00:00Z"))),
        ("version", F.concat_ws(".", number, number % 7, number % 5, F.lit("0-beta2"))),
        ("commit", hexes(40)),
        ("revision", F.concat(F.lit('"'), hexes(40), F.lit('"'))),
        ("checksum md5", hexes(32)),
        ("see", F.concat(F.lit("/static/assets/img/"), letters, number, F.lit(".png"))),
        ("see", F.concat(F.lit("https://www.example.com/article/"), number, F.lit("/"), letters)),
        ("", F.concat(F.lit("password=your_password_here"), F.col("id") % 10)),
        ("token =", F.concat(F.lit('"example-token-value'), F.col("id") % 10, F.lit('"'))),
        ("uuid", F.concat_ws("-", hexes(8), hexes(4, 9), hexes(4, 13), hexes(4, 17), hexes(12, 21))),
        ("the", F.concat(letters, letters, F.lit("-"), number)),
        ("invoice", F.concat(F.lit("INV-2024-"), digits)),
        ("isbn", F.concat(F.lit("978-3-16-"), F.substring(digits, 1, 6), F.lit("-0"))),
        ("at", F.concat(F.lit("section"), number, F.lit("paragraph"), F.col("id"))),
        ("for", F.concat(number, F.lit(",000,000.00"))),
        ("user", F.concat(F.lit("user_name_default_"), number)),
        ("the password is", F.get(F.array(*map(F.lit, "required not stored sent wrong never expired".split())), (F.col("id") % 7).cast("int"))),
        ("password:", F.get(F.array(*map(F.lit, "see must please none enter the this".split())), (F.col("id") % 7).cast("int"))),
        ("the secret is", F.get(F.array(*map(F.lit, "that in the not always to of".split())), (F.col("id") % 7).cast("int"))),
        ("token =", F.get(F.array(*map(F.lit, "null none true false empty the optional".split())), (F.col("id") % 7).cast("int"))),
        ("author:", F.initcap(mapped(6, "etaoinshrdlucmfw", 2))),
        ("see", F.concat(F.lit("get"), F.initcap(mapped(5, "etaoinshrdlucmfw")), F.lit("FromServerConfig"))),
        ("the", F.concat(F.initcap(mapped(7, "etaoinshrdlucmfw", 4)), F.lit("ReportPageIndex"))),
        ("token is", F.concat(number, F.lit("."))),
        ("", F.concat(F.lit("password:"), F.lit("change_me"))),
    ]
    rows = [
        F.struct(
            F.trim(F.concat_ws(" ", around, F.lit(before))).alias("before"),
            word.cast("string").alias("word"),
            around.alias("after"),
            F.lit(label).alias("label"),
        )
        for label, kinds in ((1.0, secret), (0.0, harmless))
        for before, word in kinds
    ]
    # a few kinds a projection: all in one exceed what Spark compiles, each by itself is slow to plan
    parts = [numbers.select(F.inline(F.array(*rows[k : k + 6]))) for k in range(0, len(rows), 6)]
    return functools.reduce(DataFrame.union, parts)


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """The forest for labelled findings: ``before``, ``word``, ``after`` strings, ``label`` 0 or 1.

    Null strings count as empty; rows without label are left out.
    """
    rows = findings.where("label IS NOT NULL").select(
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("before", "word", "after")),
        F.col("label").cast("double").alias("label"),
    )
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(rows))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", subsamplingRate=1.0
    )
    return forest.fit(table.select("label", "features").coalesce(1))


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``start``, ``before``, ``word``, ``after`` of every candidate, in code points."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).where(F.col("text").rlike(ANY_CANDIDATE))
    # units are words with the space that follows, so nothing of the text is lost
    rows = rows.select("doc_id", F.split("text", UNIT, -1).alias("units"))
    numbers = F.sequence(F.lit(0), F.floor((F.size("units") - 1) / BLOCK).cast("int"))
    rows = rows.select(
        "doc_id",
        "units",
        F.transform(
            numbers,
            lambda b: F.aggregate(
                F.slice("units", b * BLOCK + 1, BLOCK), F.lit(0).cast("long"), lambda n, u: n + F.length(u)
            ),
        ).alias("sizes"),
    )
    # a block, the words around it, and where in the text it begins
    around = F.transform(
        numbers,
        lambda b: F.struct(
            F.aggregate(F.slice("sizes", 1, b), F.lit(0).cast("long"), lambda n, x: n + x).alias("at"),
            F.least(b * BLOCK, F.lit(NEAR)).alias("lead"),
            F.slice("units", F.greatest(b * BLOCK - NEAR, F.lit(0)) + 1, BLOCK + F.least(b * BLOCK, F.lit(NEAR)) + NEAR).alias("near"),
        ),
    )
    blocks = rows.select("doc_id", F.inline(around))

    def telling(u: Column, i: Column) -> Column:
        word = F.rtrim(u, F.lit(BLANKS))
        long = F.length(word) >= SHORTEST
        shape = long & (word.rlike("[0-9]") | ((F.length(word) >= LETTERS) & word.rlike(CAPITALS)))
        last = F.coalesce(F.get("near", i - 1), F.lit(""))
        two = F.concat(F.coalesce(F.get("near", i - 2), F.lit("")), last)
        announced = last.rlike(SIGNED) & two.rlike(ANNOUNCED) & word.rlike("[A-Za-z0-9]")
        own = F.col("lead").cast("int")
        inside = (i >= own) & (i < own + BLOCK)
        return inside & (shape | word.rlike(f"^{OPEN}(?:{PREFIXES})") | word.rlike(OWN) | announced)

    places = F.filter(
        F.transform("near", lambda u, i: F.when(telling(u, i), i)), lambda i: i.isNotNull()
    )

    def joined(first: Column, n: Column | int) -> Column:
        text = F.array_join(F.slice("near", first, n), "")
        return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))

    i = F.col("i")
    before = F.slice("near", F.col("lead") + 1, i - F.col("lead"))
    return (
        blocks.withColumn("i", F.explode(places))
        .select(
            "doc_id",
            (F.col("at") + F.aggregate(before, F.lit(0).cast("long"), lambda n, u: n + F.length(u))).alias("start"),
            joined(F.greatest(i - NEAR, F.lit(0)) + 1, F.least(i, F.lit(NEAR))).alias("before"),
            F.rtrim(F.get("near", i), F.lit(BLANKS)).alias("word"),
            joined(i + 2, NEAR).alias("after"),
        )
    )


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per candidate: where it stands, its digest, and whether it is a secret.

    ``start`` and ``length`` are the whole word's, in code points; ``value_sha256`` is
    that of the value without quotes and name, so a report carries no secret. Null,
    empty and wordless texts give no rows, repeated rows give theirs again, null ids are
    kept, other columns are not read. Works row by row, without a shuffle. ``findings``
    are labelled findings to train on, by default those of ``labelled_findings``.
    """
    spark = docs.sparkSession
    model = train(labelled_findings(spark) if findings is None else findings)
    rows = features(candidates(docs, id_column, text_column))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    probability = vector_to_array("probability")[1]
    return scored.select(
        "doc_id",
        "start",
        F.length("word").cast("long").alias("length"),
        "kind",
        F.sha2("value", 256).alias("value_sha256"),
        probability.alias("probability"),
        (probability >= DECISION).alias("is_secret"),
    )
