"""Running sums over one order of all rows, without one task that has them all.

Rows are dealt to ranges of the order and stored; ranges are added up, the few totals (one a range) become offsets on the driver,
and a window within each range adds the rest. So the widest task has one range, and of equal order values (which should be few:
orders here are unique) all meet in one."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mosaique.functions.storage import kept

RANGE = "_range"


def ranged(rows: DataFrame, *order: str | Column) -> DataFrame:
    """rows, stored, with the number of their range, which rises with the order."""
    return kept(rows.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def within(*order: str | Column) -> Window:
    return Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def with_columns_by_range(rows: DataFrame, values: dict[int, tuple], kinds: str) -> DataFrame:
    """rows with columns (kinds: their names and types) whose values their range has."""
    names = kinds.replace(",", " ").split()[::2]
    table = rows.sparkSession.createDataFrame([(k, *v) for k, v in values.items()], f"{RANGE} int, {kinds}")
    return rows.join(F.broadcast(table), RANGE).select(*rows.columns, *names)  # a row for each range


def running_sums(rows: DataFrame, order: list[str | Column], sums: dict[str, Column]) -> tuple[DataFrame, list]:
    """rows with the running sum of each of `sums` (whole numbers or doubles; null counts as 0), and the totals."""
    names = list(sums)
    at = ranged(rows.withColumns({f"_{c}": F.coalesce(x, F.lit(0)) for c, x in sums.items()}), *order)
    totals = sorted(tuple(r) for r in at.groupBy(RANGE).agg(*(F.sum(f"_{c}") for c in names)).collect())
    ends = list(accumulate((t[1:] for t in totals), lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True)), initial=(0,) * len(names)))
    whole = [dict(at.dtypes)[f"_{c}"] not in ("double", "float") for c in names]
    kinds = ", ".join(f"_{c}_before {'bigint' if w else 'double'}" for c, w in zip(names, whole, strict=True))
    offsets = {t[0]: tuple(x if w else float(x) for x, w in zip(e, whole, strict=True)) for t, e in zip(totals, ends[:-1], strict=True)}
    out = with_columns_by_range(at, offsets, kinds)
    out = out.withColumns({c: F.sum(f"_{c}").over(within(*order)) + F.col(f"_{c}_before") for c in names})
    return out.drop(RANGE, *(f"_{c}" for c in names), *(f"_{c}_before" for c in names)), list(ends[-1])
