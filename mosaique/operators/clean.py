"""Cleaning of one period's footprints (H)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaique.schemas import KEY, VALUES


def is_valid() -> Column:
    """All four values finite and not negative, at least one above 0. NaN and null rows go: NaN would compare as largest."""
    finite = [~F.isnan(v) & (F.abs(F.col(v)) != float("inf")) & (F.col(v) >= 0) for v in VALUES]
    return F.coalesce(reduce(and_, finite) & (F.greatest(*VALUES) > 0), F.lit(False))


def drop_invalid(h: DataFrame) -> DataFrame:
    return h.where(is_valid())


def dedup_max(h: DataFrame, *more: str) -> DataFrame:
    """The element-wise maximum of the rows of one (user, tile); `more` adds key columns, such as the period."""
    return h.groupBy(*more, *KEY).agg(*(F.max(v).alias(v) for v in VALUES))


def duplicate_count(h: DataFrame, *more: str) -> DataFrame:
    """Rows beyond the first of each key, of valid rows."""
    sizes = drop_invalid(h).groupBy(*more, *KEY).agg((F.count("*") - 1).alias("extra"))
    return sizes.agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("duplicates"))


def sort_rows(h: DataFrame) -> DataFrame:
    """Order for presentation; nothing else depends on it."""
    return h.orderBy(*KEY)
