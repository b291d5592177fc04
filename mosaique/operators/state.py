"""The longitudinal state (S): one row for each user and tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaique.functions.exact import exact_sum
from mosaique.operators.clean import dedup_max, drop_invalid
from mosaique.params import Params
from mosaique.schemas import KEY, VALUES


def merge(s: DataFrame, h: DataFrame, params: Params = Params()) -> DataFrame:
    """Sum by key of the state and a cleaned, deduplicated period: one aggregation, no null handling of an outer join."""
    kept = [*KEY, *VALUES]
    return _as_stored(s.select(kept).unionByName(h.select(kept)).groupBy(*KEY).agg(*(F.sum(v).alias(v) for v in VALUES)), params)


def merge_outer_join(s: DataFrame, h: DataFrame) -> DataFrame:
    """The same as a full outer join of two inputs that are unique by key."""
    joined = s.alias("s").join(h.alias("h"), KEY, "full_outer")
    zero = F.lit(0.0)
    return joined.select(*KEY, *((F.coalesce(f"s.{v}", zero) + F.coalesce(f"h.{v}", zero)).alias(v) for v in VALUES))


def bucket_of(n: int, id: str = "id") -> Column:
    """The bucket of n that Spark writes a user's rows to."""
    return F.pmod(F.hash(id), F.lit(n))


def merge_buckets(s: DataFrame, h: DataFrame, n: int, params: Params = Params()) -> DataFrame:
    """The same sum where s is a scan of n buckets by user and h is small beside it: h alone is exchanged, to the same buckets, and
    hashed there; the state streams by, neither exchanged nor sorted. To be planned under sinks.AS_BUCKETS."""
    near = h.select(*KEY, *VALUES).repartition(n, "id").hint("shuffle_hash")
    return _as_stored(merge_outer_join(s, near), params)


def _as_stored(rows: DataFrame, params: Params) -> DataFrame:
    return rows.withColumns({v: F.col(v).cast("float").cast("double") for v in VALUES}) if params.float32_state else rows


def fold(h: DataFrame) -> DataFrame:
    """State of many periods in one plan: maximum within a period, sum across. One exchange by user serves both. Sums don't depend
    on the order of periods, so neither do thresholds and ranks that a last digit decides."""
    return dedup_max(drop_invalid(h).repartition("id"), "period").groupBy(*KEY).agg(*(exact_sum(v).alias(v) for v in VALUES))


def classes(s: DataFrame, h: DataFrame) -> DataFrame:
    """Each key with `class`: unchanged (state only), new (period only) or updated (both)."""
    both = s.select(*KEY, F.lit(1).alias("c")).unionByName(h.select(*KEY, F.lit(2).alias("c"))).groupBy(*KEY).agg(F.sum("c").alias("c"))
    return both.select(*KEY, F.element_at(F.array(F.lit("unchanged"), F.lit("new"), F.lit("updated")), F.col("c").cast("int")).alias("class"))


def record_counts(h: DataFrame, old: DataFrame, new: DataFrame, y: DataFrame) -> DataFrame:
    """Row counts of all tables, with the growth of the state and the share that is quantised."""
    counts = [t.select(F.lit(name).alias("t")) for name, t in (("h", h), ("s_old", old), ("s_new", new), ("y", y))]
    rows = counts[0].union(counts[1]).union(counts[2]).union(counts[3])
    n = rows.agg(*(F.count(F.when(F.col("t") == name, 1)).alias(name) for name in ("h", "s_old", "s_new", "y")))
    growth = F.col("s_new") - F.col("s_old")
    share = lambda a, b: F.round(F.when(b != 0, a / b), 6)
    return n.select("*", growth.alias("growth"), share(growth * 100, F.col("s_old")).alias("growth_pct"), share(F.col("y"), F.col("s_new")).alias("y_share"))
