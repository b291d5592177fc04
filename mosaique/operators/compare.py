"""Comparing tables, as acceptance tests do."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from mosaique.operators import scan
from mosaique.params import H_BYTES, S_BYTES, Y_BYTES


def sequential_ids(rows: DataFrame) -> DataFrame:
    """id: 1, 2, 3, ... for each run of equal pseudonyms in file order (line_no). Lines are dealt to ranges; where a range begins,
    the end of the one in front says whether its first line goes on a run. A null pseudonym is a run of its own."""
    at = scan.ranged(rows, "line_no")
    order = Window.partitionBy(scan.RANGE).orderBy("line_no")
    changed = F.when(F.row_number().over(order) > 1, F.coalesce((F.col("pseudonym") != F.lag("pseudonym").over(order)).cast("int"), F.lit(1)))
    at = at.withColumn("_changed", changed)
    ends = at.groupBy(scan.RANGE).agg(F.min_by("pseudonym", "line_no").alias("first"), F.max_by("pseudonym", "line_no").alias("last"), F.sum("_changed").alias("n"))
    before, last, offsets = 0, None, {}
    for r in sorted(ends.collect(), key=lambda r: r[scan.RANGE]):  # a row for each range
        before += int(last is None or r["first"] != last)
        offsets[r[scan.RANGE]] = (before,)
        before, last = before + (r["n"] or 0), r["last"]
    at = scan.with_columns_by_range(at, offsets, "_before bigint")
    return at.select(*rows.columns, (F.coalesce(F.sum("_changed").over(scan.within("line_no")), F.lit(0)) + F.col("_before")).alias("id"))


def symmetric_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, counted as often as they are too many: one aggregation of signed counts."""
    names = a.columns
    signed = a.withColumn("_n", F.lit(1)).union(b.withColumn("_n", F.lit(-1)))
    left = signed.groupBy(*names).agg(F.abs(F.sum("_n")).alias("_n")).where("_n > 0")
    return left.select(*names, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_k")).drop("_k")


def inspect(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """rows, and how many went by (get[name]) once a job has read them: a tap that costs no pass of its own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias(name)), seen


def tolerance_check(differing: int, rows: int) -> bool:
    return differing < 0.0006 * rows + 4


def record_sizes(counts: DataFrame) -> DataFrame:
    """Bytes of the input, state and quantised records, from columns h, s_new, y."""
    return counts.select((F.col("h") * H_BYTES).alias("h_bytes"), (F.col("s_new") * S_BYTES).alias("s_bytes"), (F.col("y") * Y_BYTES).alias("y_bytes"))
