"""Joins that keep one row per left row and do not depend on even keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone.functions.numeric import Numeric
from keelstone.operators.ratings import rating_per_customer
from keelstone.params import DEFAULTS, Settings

# The one rule by which a join spreads a key: more than SPREAD_LEAST rows and more than
# this share of all keyed rows, so fewer than 1 / SPREAD_SHARE keys at any size. It
# decides how rows are laid out, never which rows a query returns.
SPREAD_SHARE = 1e-5
SPREAD_LEAST = 100
ROWS_PER_SALT = 1_000_000


def one_per_key(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest by ``order``, then by all other columns."""
    rest = [c for c in df.columns if c != key]
    rank = [*order] + [c for c in rest if c not in order]
    best = df.groupBy(key).agg(F.max(F.struct(*rank)).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-NULL key, combined on the map side (reads one column)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))


def keys_above(df: DataFrame, key: str, threshold: int = 100) -> DataFrame:
    """All keys with more than ``threshold`` rows and their rows; as many as there are."""
    return key_counts(df, key).where(F.col("key_rows") > threshold)


def spread_keys(
    df: DataFrame,
    key: str,
    salts: int = 10,
    rows_per_salt: int = ROWS_PER_SALT,
    share: float = SPREAD_SHARE,
    least: int = SPREAD_LEAST,
) -> DataFrame:
    """Keys that a join should spread, and into how many parts to cut each.

    A key gets at least ``salts`` parts and one more per ``rows_per_salt`` rows, so
    a key with a third of all rows is cut as finely as it needs to be. ``share`` bounds
    the result to fewer than ``1 / share`` rows, so it may always be broadcast.
    """
    counts = key_counts(df, key)
    total = counts.agg(F.sum("key_rows")).scalar()
    parts = F.greatest(F.lit(salts), F.ceil(F.col("key_rows") / F.lit(rows_per_salt)))
    return counts.where(
        (F.col("key_rows") > least) & (F.col("key_rows") > total * F.lit(share))
    ).select(key, "key_rows", parts.cast("int").alias("n_salts"))


def split_by_hot(df: DataFrame, hot: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is hot, and all others. ``hot`` may be long, so it carries no hint."""
    keys = hot.select(key)
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")


def salt_rows(
    df: DataFrame, hot: DataFrame, key: str, row_id: str | Column, salt: str = "_salt"
) -> DataFrame:
    """Give every row of a hot key one of its key's salts; other keys get 0.

    The salt is a hash of the row's own id: a retried or recomputed task gives the
    same salt again. Rows without a key get the bare hash. They match nothing, but
    an outer join must carry them, and this spreads them over all partitions.
    """
    spread = F.xxhash64(F.col(row_id) if isinstance(row_id, str) else row_id)
    value = F.when(F.col(key).isNull(), spread).otherwise(
        F.pmod(spread, F.coalesce(F.col("n_salts"), F.lit(1)).cast("long"))
    )
    marked = df.join(F.broadcast(hot.select(key, "n_salts")), key, "left")
    return marked.withColumn(salt, value).drop("n_salts")


def replicate_rows(
    df: DataFrame, hot: DataFrame, key: str, salt: str = "_salt", bounded: bool = True
) -> DataFrame:
    """Copy the rows of a hot key once per salt; other rows get salt 0.

    One scan: the copies come from exploding a sequence, not from a union of a
    hot and a cold part. ``bounded`` says that ``hot`` comes from ``spread_keys``.
    """
    parts = hot.select(key, "n_salts")
    marked = df.join(F.broadcast(parts) if bounded else parts, key, "left")
    last = F.coalesce(F.col("n_salts"), F.lit(1)).cast("long") - F.lit(1)
    salts = F.explode(F.sequence(F.lit(0).cast("long"), last))
    return marked.withColumn(salt, salts).drop("n_salts")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: str | Column,
    salts: int = 10,
    how: str = "left",
    rows_per_salt: int = ROWS_PER_SALT,
    hot: DataFrame | None = None,
    least: int = SPREAD_LEAST,
) -> DataFrame:
    """``left.join(right, key, how)`` for a left side with hot or missing keys.

    Same rows as the plain join for ``inner`` and ``left``. ``row_id`` is a column
    (or expression) that differs between left rows. ``hot`` lets a caller pass the
    ``spread_keys`` of a narrower table than ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports 'inner' and 'left'")
    if hot is None:
        hot = spread_keys(left, key, salts, rows_per_salt, least=least)
    salted = salt_rows(left, hot, key, row_id)
    copies = replicate_rows(right, hot, key)
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def prefixed(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rename all columns but the key, so that loan columns keep their names."""
    return df.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != key])


def attach_counterparty(
    loans: DataFrame, counterparty: DataFrame, skew: bool = True, **skew_options
) -> DataFrame:
    side = prefixed(one_per_key(counterparty, "customer_id"), "customer_id", "cpty_")
    if skew:
        return skew_join(loans, side, "customer_id", "loan_id", **skew_options)
    return loans.join(side, "customer_id", "left")


def collateral_side(
    collateral: DataFrame, taken: Sequence[str] = ("currency",), unique: bool = False
) -> DataFrame:
    """Collateral with one row per id; names the loans already use get a prefix.

    ``unique`` says that the ids are unique already, as those of the staged table are;
    the table is then shuffled once, for the join itself.
    """
    if not unique:
        order = ["valuation_date"] if "valuation_date" in collateral.columns else []
        collateral = one_per_key(collateral, "collateral_id", order)
    clashing = {c for c in collateral.columns if c in taken} - {"collateral_id"}
    return collateral.withColumnsRenamed({c: f"collateral_{c}" for c in clashing})


def attach_collateral(
    loans: DataFrame,
    collateral: DataFrame,
    null_keys: str = "split",
    unique: bool = False,
    **skew_options,
) -> DataFrame:
    """Left join on ``collateral_id``, of which about half is NULL.

    split: loans without collateral skip the join and are added back; reads the
    loans twice, but shuffles only those that have a key.
    spread: NULL keys are dealt out over all partitions of one shuffle, for loans that
    are dear to compute twice.
    plain: an ordinary left join, leaving skew to adaptive execution.
    """
    side = collateral_side(collateral, ["currency", *loans.columns], unique)
    if null_keys == "plain":
        return loans.join(side, "collateral_id", "left")
    if null_keys == "spread":
        return skew_join(loans, side, "collateral_id", "loan_id", **skew_options)
    if null_keys == "split":
        key = F.col("collateral_id")
        keyed = skew_join(
            loans.where(key.isNotNull()), side, "collateral_id", "loan_id", **skew_options
        )
        return keyed.unionByName(loans.where(key.isNull()), allowMissingColumns=True)
    raise ValueError("null_keys must be 'spread', 'split' or 'plain'")


def attach_rating(
    loans: DataFrame,
    ratings: DataFrame,
    policy: str = DEFAULTS.rating_policy,
    hot: DataFrame | None = None,
) -> DataFrame:
    """One external rating per loan; customers rated by several agencies do not fan out.

    A customer with many loans is spread like in every other join by customer. The
    reduced ratings carry no hint: Spark compares their size with
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    side = rating_per_customer(ratings, policy).select("customer_id", "rating", "rating_numeric")
    return skew_join(loans, side, "customer_id", "loan_id", hot=hot)


def customer_side(
    ratings: DataFrame, counterparty: DataFrame, policy: str = DEFAULTS.rating_policy
) -> DataFrame:
    """Counterparty and rating in one table.

    They share the customer key, so they are joined to each other first (small
    sides) and the loans are shuffled by customer only once.
    """
    rated = rating_per_customer(ratings, policy).select("customer_id", "rating", "rating_numeric")
    known = prefixed(one_per_key(counterparty, "customer_id"), "customer_id", "cpty_")
    return known.join(rated, "customer_id", "full_outer")


def enrich(
    loans: DataFrame,
    ratings: DataFrame,
    collateral: DataFrame,
    counterparty: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    salts: int = 10,
    profile: DataFrame | None = None,
    null_keys: str = "spread",
    unique_collateral: bool = False,
) -> DataFrame:
    """Loans with counterparty, rating and collateral: exactly one row per loan.

    Both joins are against sides reduced to one row per key, and both are left
    joins, so the number of loans cannot change. The loans are shuffled once by
    customer and once by collateral. ``null_keys`` is that of ``attach_collateral``:
    spread here, where the loans come out of a join; split suits a stored table.

    The keys to spread are counted on ``profile`` (default: the loans). Any frame with
    the two key columns will do, such as the stored table the loans were made
    from: the choice affects how rows are spread, never which rows match.
    """
    profile = loans if profile is None else profile
    customers = spread_keys(profile, "customer_id", salts)
    pledged = spread_keys(profile, "collateral_id", salts)

    def rated(rows):
        if counterparty is None:
            return attach_rating(rows, ratings, settings.rating_policy, customers)
        side = customer_side(ratings, counterparty, settings.rating_policy)
        return skew_join(rows, side, "customer_id", "loan_id", hot=customers)

    options = {"unique": unique_collateral, "hot": pledged}
    if null_keys == "split":  # the collateral first: its left side is the table as stored
        return rated(attach_collateral(loans, collateral, "split", **options))
    return attach_collateral(rated(loans), collateral, null_keys, **options)


# Lookups in fixed tables (tens of rows, so always broadcast) ---------------


def attach_ccf(
    df: DataFrame, ccf: DataFrame, settings: Settings = DEFAULTS, num: Numeric = Numeric()
) -> DataFrame:
    rate = num.ratio(F.coalesce(F.col("ccf"), F.lit(settings.default_ccf)))
    joined = df.join(F.broadcast(ccf), "exposure_type", "left")
    return joined.withColumn("credit_conversion_factor", rate).drop("ccf")


def attach_risk_weight(
    df: DataFrame, weights: DataFrame, settings: Settings = DEFAULTS, num: Numeric = Numeric()
) -> DataFrame:
    """Weight of (asset class, rating bucket); pairs not in the table get the default."""
    found = weights.select("asset_class", "rating_bucket", F.col("risk_weight").alias("_weight"))
    weight = num.ratio(F.coalesce(F.col("_weight"), F.lit(settings.default_weight)))
    joined = df.join(F.broadcast(found), ["asset_class", "rating_bucket"], "left")
    return joined.withColumn("risk_weight", weight).drop("_weight")


def attach_lgd(
    df: DataFrame, lgd: DataFrame, settings: Settings = DEFAULTS, num: Numeric = Numeric()
) -> DataFrame:
    rate = num.ratio(F.coalesce(F.col("lgd"), F.lit(settings.default_lgd)))
    joined = df.join(F.broadcast(lgd), "collateral_type", "left")
    return joined.withColumn("loss_given_default", rate).drop("lgd")


def as_of_lookup(
    fact: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
    date: str = "calculation_date",
    eff: str = "effective_date",
    end: str = "end_date",
    values: Sequence[str] = ("risk_weight",),
) -> DataFrame:
    """Values of the reference row in force on the fact's date: ``eff <= date < end``.

    Validity ranges of one key must not overlap; an open ``end`` is NULL. An equi
    join on the keys with the range as an extra condition.
    """
    valid = ref.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(eff).alias("_from"), F.col(end).alias("_to"),
        *[F.col(v).alias(f"effective_{v}") for v in values],
    )
    condition = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    condition += [
        F.col(date) >= F.col("_from"),
        F.col("_to").isNull() | (F.col(date) < F.col("_to")),
    ]
    joined = fact.join(valid, condition, "left")
    return joined.drop(*[f"_k_{k}" for k in keys], "_from", "_to")


def with_dims(fact: DataFrame, dim_asset_class: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Fact with its asset-class and geography attributes (fixed-size dimensions)."""
    geo = dim_geography.withColumnRenamed("geography_code", "geography")
    return fact.join(F.broadcast(dim_asset_class), "asset_class", "left").join(
        F.broadcast(geo), "geography", "left"
    )
