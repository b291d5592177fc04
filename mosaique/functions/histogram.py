"""Histograms on a doubling scale, k-anonymous texts."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def log2_bin(x: Column, bins: int, lowest: float) -> Column:
    """Bin 0: x < lowest; bin i: lowest * 2^(i-1) <= x < lowest * 2^i; the last bin takes the rest. Edges are exact
    powers of two, compared as they are. A value that is not finite fails the job."""
    x = F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.raise_error(F.lit("a histogram value is not finite")).cast("double")).otherwise(x)
    out = F.when(x < lowest, 0)
    for i in range(1, bins - 1):
        out = out.when(x < lowest * 2.0**i, i)
    return out.otherwise(bins - 1)


def log2_histogram(values: DataFrame, column: str, bins: int, lowest: float, *by: str) -> DataFrame:
    """bin, count of the bins that occur, by group."""
    return values.groupBy(*by, log2_bin(F.col(column), bins, lowest).alias("bin")).agg(F.count("*").alias("count"))


def iterate(hist: DataFrame, groups: DataFrame | None, bins: int, *by: str) -> DataFrame:
    """Every bin of every group with count and cumulative percentage (of a total of 0 as of 1). A window holds one group's bins."""
    spark = hist.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    grid = grid if groups is None else groups.join(F.broadcast(grid))
    full = grid.join(hist, [*by, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    group = Window.partitionBy(*(by or [F.lit(1)]))
    total = F.greatest(F.sum("count").over(group), F.lit(1))
    running = F.sum("count").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    return full.select(*by, "bin", "count", F.round(running * 100 / total, 6).alias("cum_pct"))


#: How a line begins behind its prefix, for a regular bin and for the last one.
BELOW, FROM = " < ", ">= "


def edges(bins: int, lowest: float) -> list[str]:
    """Sign and upper edge of each bin; the last has the lower edge of what it takes."""
    out = [Fraction(lowest) * 2**i for i in range(bins - 1)]
    return [f"{BELOW}{x}" for x in out] + [f"{FROM}{out[-1]}"]


def k_anonymous(count: Column, k: int) -> Column:
    return F.when(count < k, F.lit("NA")).otherwise(count.cast("string"))


def k_anonymous_pct(count: Column, pct: Column, k: int) -> Column:
    """The percentage is hidden with its bin's count."""
    return F.when(count < k, F.lit("NA %")).otherwise(F.format_string("%.1f %%", pct))


def format_lines(full: DataFrame, bins: int, lowest: float, k: int, prefix: str = "") -> DataFrame:
    """bin, line: the text of each bin of an iterated histogram."""
    named = F.element_at(F.array(*map(F.lit, edges(bins, lowest))), F.col("bin") + 1)
    line = F.concat(F.lit(prefix), named, F.lit(": "), k_anonymous(F.col("count"), k), F.lit(" ("), k_anonymous_pct(F.col("count"), F.col("cum_pct"), k), F.lit(")"))
    return full.select("bin", line.alias("line"))


def anonymous(count: int, k: int) -> str:
    """k_anonymous of a count that is on the driver."""
    return "NA" if count < k else str(count)


def text_lines(counts: dict[int, int], bins: int, lowest: float, k: int, prefix: str = "") -> list[str]:
    """The lines of a histogram whose few counts are on the driver; the same texts as format_lines."""
    total, running, out = max(1, sum(counts.values())), 0, []
    for i, edge in enumerate(edges(bins, lowest)):
        n = counts.get(i, 0)
        running += n
        out.append(f"{prefix}{edge}: {anonymous(n, k)} ({'NA' if n < k else f'{100 * running / total:.1f}'} %)\n")
    return out
