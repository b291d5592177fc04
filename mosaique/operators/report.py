"""Distributions, calibration and disclosure-controlled reports from Y.

Tiles and areas come from request tables of a bounded size (params.MAX_AREA_ROWS), so their sides of joins are left to the
optimiser, which broadcasts them when they are small. User-sized tables only meet on the user's id or after aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mosaique.functions.exact import exact_sum
from mosaique.operators.quantise import highly_nomadic_users, quantise, top_anchor
from mosaique.params import MAX_AREAS, Params
from mosaique.schemas import TILE, VALUES


def area_masks(areas: DataFrame) -> DataFrame:
    """tile, mask_0, mask_1: the areas of a tile as bits; their ids are below MAX_AREAS, two longs."""
    half = F.when(F.col("id").between(0, MAX_AREAS - 1), F.floor(F.col("id") / 64)).otherwise(F.raise_error(F.lit("an area's id is out of range")).cast("bigint"))
    bit = F.expr("shiftleft(1L, id % 64)")
    return areas.groupBy(*TILE).agg(*(F.bit_or(F.when(half == k, bit).otherwise(0)).alias(f"mask_{k}") for k in (0, 1)))


def areas_of(mask_0: str, mask_1: str) -> Column:
    """The areas of a mask in order."""
    bit = lambda i: F.when(i < 64, F.getbit(mask_0, i)).otherwise(F.getbit(mask_1, i - 64))
    some = F.filter(F.sequence(F.lit(0), F.lit(MAX_AREAS - 1)), lambda i: bit(i) == 1)
    return F.when((F.col(mask_0) == 0) & (F.col(mask_1) == 0), F.array().cast("array<int>")).otherwise(some)


def with_user_areas(y: DataFrame, areas: DataFrame) -> DataFrame:
    """y with `areas` of the user, in order: a window by user ORs the masks of its tiles, so users and areas are never joined."""
    user, masks = Window.partitionBy("id"), ["mask_0", "mask_1"]
    marked = y.join(area_masks(areas), TILE, "left")
    marked = marked.withColumns({m: F.coalesce(F.bit_or(m).over(user), F.lit(0).cast("bigint")) for m in masks})
    return marked.select(*y.columns, areas_of(*masks).alias("areas"))


def user_reference_areas(y: DataFrame, areas: DataFrame) -> DataFrame:
    """id, area: areas that hold a quantised tile of the user."""
    users = y.select("id", *TILE).join(area_masks(areas), TILE).groupBy("id").agg(F.bit_or("mask_0").alias("mask_0"), F.bit_or("mask_1").alias("mask_1"))
    return users.select("id", F.explode(areas_of("mask_0", "mask_1")).alias("area"))


def user_reference_area_list(y: DataFrame, areas: DataFrame) -> DataFrame:
    """Y with the user's areas in order; an empty array where there is none. An area list has MAX_AREAS entries at most."""
    return with_user_areas(y, areas)


def tile_in_area(rows: DataFrame, areas: DataFrame, inside: bool = True) -> DataFrame:
    """Rows whose (area, tile) is, or is not, one of the areas' tiles."""
    keys = areas.select(F.col("id").alias("area"), *TILE)
    return rows.join(keys, ["area", *TILE], "left_semi" if inside else "left_anti")


def top_anchor_distribution(y: DataFrame) -> DataFrame:
    """P: users by top-anchor tile."""
    return top_anchor(y).groupBy(*TILE).agg(F.count("*").alias("value"))


def top_anchor_sdc(p: DataFrame, params: Params) -> DataFrame:
    """P': rows under xi are removed."""
    return p.where(F.col("value") >= params.xi)


def calibration_weights(p: DataFrame, residents: DataFrame, params: Params) -> DataFrame:
    """weight by top-anchor tile; a tile without census row has 0 residents."""
    joined = p.join(residents.withColumnRenamed("value", "residents"), TILE, "left").withColumn("residents", F.coalesce("residents", F.lit(0.0)))
    ratio = F.col("residents") / F.col("value")
    weight = F.when(F.greatest(F.col("residents"), F.col("value").cast("double")) < params.min_count, 1.0)
    weight = weight.when(ratio <= params.floor, params.floor).when(ratio >= params.cap, params.cap).otherwise(ratio)
    return joined.select(*TILE, "value", weight.alias("weight"))


def user_weights(y: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Y with the weight of the user's top-anchor tile; 1 without calibration."""
    if weights is None:
        return y.withColumn("weight", F.lit(1.0))
    own = top_anchor(y).select("id", *TILE).join(weights.select(*TILE, "weight"), TILE).select("id", "weight")
    return y.join(own, "id")


def observed_adjusted_users(weights: DataFrame | None, spark=None) -> DataFrame:
    """Sum of counts, and of weighted counts, over all of P; both 0 without calibration."""
    if weights is None:
        return spark.range(1).select(F.lit(0).cast("bigint").alias("observed_total_users"), F.lit(0.0).alias("adjusted_total_users"))
    observed = F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("observed_total_users")
    return weights.agg(observed, F.coalesce(exact_sum(F.col("value") * F.col("weight")), F.lit(0.0)).alias("adjusted_total_users"))


def total_footprint(y: DataFrame) -> DataFrame:
    """D: sums of the quantised values by tile."""
    return y.groupBy(*TILE).agg(*(F.sum(f"q{i}").cast("double").alias(v) for i, v in enumerate(VALUES)))


def total_footprint_calibrated(weighted: DataFrame) -> DataFrame:
    return weighted.groupBy(*TILE).agg(*(exact_sum(F.col("weight") * F.col(f"q{i}")).alias(v) for i, v in enumerate(VALUES)))


def total_footprint_sdc(d: DataFrame, params: Params) -> DataFrame:
    """D': values under xi become 0; the row stays."""
    return d.withColumns({v: F.when(F.col(v) < params.xi, 0.0).otherwise(F.col(v)) for v in VALUES})


def connection_operands(weighted: DataFrame, areas: DataFrame) -> DataFrame:
    """area, tile, num, den, where some user of the tile touches the area and the tile is outside it.

    den does not depend on the area and num only on users that touch it, so no pair of tile and area without a user is made. Sums
    don't depend on the order of users."""
    den = weighted.groupBy(*TILE).agg(exact_sum("weight").alias("den"))
    touching = with_user_areas(weighted.select("id", *TILE, "weight"), areas).select(F.explode("areas").alias("area"), *TILE, "weight")
    num = touching.groupBy("area", *TILE).agg(exact_sum("weight").alias("num"))
    return tile_in_area(num, areas, inside=False).join(den, TILE).select("area", *TILE, "num", "den")


def connection_operands_literal(weighted: DataFrame, areas: DataFrame) -> DataFrame:
    """The definition as it stands, for every area and tile outside it, to check the other form on small tables."""
    every = weighted.join(areas.select(F.col("id").alias("area")).distinct().hint("broadcast"))
    outside = tile_in_area(every, areas, inside=False)
    touches = user_reference_areas(weighted, areas).withColumn("touches", F.lit(1))
    joined = outside.join(touches, ["id", "area"], "left")
    num = F.sum(F.when(F.col("touches") == 1, F.col("weight")).otherwise(0.0))
    return joined.groupBy("area", *TILE).agg(num.alias("num"), F.sum("weight").alias("den"))


def connection_strength(operands: DataFrame, params: Params) -> DataFrame:
    """FUF: num / den where num reaches xi."""
    strength = F.col("num") / F.col("den")
    kept = operands.where((F.col("num") >= params.xi) & (strength > params.epsilon))
    return kept.select(F.col("area").alias("reference_area"), *TILE, strength.alias("strength"))


def statistics(s: DataFrame, weights: DataFrame | None, params: Params) -> DataFrame:
    return highly_nomadic_users(s, params).join(observed_adjusted_users(weights, s.sparkSession))


@dataclass
class Report:
    fingerprint: DataFrame
    top_anchor: DataFrame
    fuf: DataFrame
    statistics: DataFrame


def full_report(s: DataFrame, areas: DataFrame, residents: DataFrame, params: Params, keep: Callable[[DataFrame], DataFrame] = lambda y: y) -> Report:
    """All four reports. `keep` stores a user-sized table and reads it back: Y is quantised and ranked once, and once has its
    users' weights, and all reports are made from what is stored. Without it each report is made from the state by itself."""
    y = keep(quantise(s, params))
    p = top_anchor_distribution(y)
    weights = calibration_weights(p, residents, params) if params.with_calibration else None
    weighted = keep(user_weights(y, weights)) if params.with_calibration else user_weights(y, weights)
    d = total_footprint_calibrated(weighted) if params.with_calibration else total_footprint(y)
    fuf = connection_strength(connection_operands(weighted, areas), params)
    return Report(total_footprint_sdc(d, params), top_anchor_sdc(p, params), fuf, statistics(s, weights, params))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    def at(c: str) -> Column:
        return F.round(F.col(c), digits).alias(c) if c in names else F.col(c)

    return df.select(*(at(c) for c in df.columns))
