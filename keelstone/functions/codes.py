"""Code lists as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from keelstone import params
from keelstone.functions.literals import literal_map


def clean_code(code: Column) -> Column:
    return F.upper(F.trim(code))


def recode(code: Column, table: Mapping[str, object], default: object = None) -> Column:
    """Look ``code`` up in a small fixed table; absent or NULL gives ``default``."""
    found = F.try_element_at(literal_map(table), code)
    return found if default is None else F.coalesce(found, F.lit(default))


def asset_class(product: Column) -> Column:
    return recode(product, params.PRODUCT_ASSET_CLASS, "OTHER")


def exposure_type(product: Column) -> Column:
    return recode(product, params.PRODUCT_EXPOSURE_TYPE, "ON_BALANCE")


def rating_numeric(rating: Column) -> Column:
    """Ordinal 1 (best) to 14 of an agency symbol; NULL when unknown."""
    return recode(rating, params.RATING_SCALE)


def common_notch(rating: Column) -> Column:
    """Translate the alternative notch spelling; other symbols pass through."""
    return F.coalesce(recode(rating, params.MOODY_TO_COMMON), rating)


def rating_bucket(rating: Column, settings: params.Settings = params.DEFAULTS) -> Column:
    return recode(rating, settings.rating_buckets, settings.default_bucket)


def geography(country: Column) -> Column:
    return F.substring(country, 1, 2)
