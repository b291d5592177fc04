"""Joins for presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaique.operators import scan
from mosaique.schemas import TILE, VALUES


def report_on_map(report: DataFrame, tiles: DataFrame, columns: list[str] = VALUES) -> DataFrame:
    """All tiles of the map with the report's values, 0 where there are none."""
    return report.join(tiles.select(*TILE), TILE, "right").na.fill(0, columns)


def heatmap_matrix(report: DataFrame, value: str, bounds: DataFrame | None = None) -> DataFrame:
    """tile_e, tile_n, value of every cell of the bounding box (of `bounds`, if given); null where there is none."""
    box = (bounds if bounds is not None else report).agg(F.min("tile_e").alias("e0"), F.max("tile_e").alias("e1"), F.min("tile_n").alias("n0"), F.max("tile_n").alias("n1"))
    cells = box.where("e0 is not null").select(F.explode(F.sequence("e0", "e1")).alias("tile_e"), "n0", "n1").select("tile_e", F.explode(F.sequence("n0", "n1")).alias("tile_n"))
    return cells.join(report.select(*TILE, F.col(value).alias("value")), TILE, "left")


def fuf_area_slice(fuf: DataFrame, area: int) -> DataFrame:
    """The matrix of one area, over the box of all areas."""
    return heatmap_matrix(fuf.where(F.col("reference_area") == area), "strength", fuf)


def quantile_classes(report: DataFrame, value: str, classes: int = 5) -> DataFrame:
    """class 1 to `classes` of each tile by quantile: classes of equal numbers of rows, the first ones of one more where they can't be."""
    ranked, (n,) = scan.running_sums(report.select(*TILE, value), [value, *TILE], {"_rank": F.lit(1)})
    size, more = divmod(n, classes)
    place, large = F.col("_rank") - 1, more * (size + 1)
    behind = F.floor((place - large) / max(size, 1)) + more
    return ranked.select(*TILE, value, (F.when(place < large, F.floor(place / (size + 1))).otherwise(behind) + 1).cast("int").alias("class"))
