"""Quantisation of the state and anchor ranks (Y)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mosaique.params import Params
from mosaique.schemas import KEY, TILE


def quantise_day(s: DataFrame, params: Params) -> DataFrame:
    """Tiles whose whole-day value reaches psi."""
    return s.where(F.col("value_0") >= params.psi)


def quantise_subperiods(s: DataFrame, params: Params) -> DataFrame:
    """q0 = 1, and q1 to q3: whether the sub-period's share of the day reaches phi. Expects rows of quantise_day."""
    share = [(F.col(f"value_{i}") / F.col("value_0") >= params.phi).cast("int").alias(f"q{i}") for i in (1, 2, 3)]
    return s.select("*", F.lit(1).alias("q0"), *share)


def anchor_rank(y: DataFrame, params: Params = Params()) -> DataFrame:
    """rank from 0 within a user: by day value, the largest sub-period, then sub-period 1, all falling; ties by tile, or at
    random where params.random_ties gives a seed."""
    ties = [F.rand(params.random_ties)] if params.random_ties is not None else [F.col(c) for c in TILE]
    falling = [F.desc("value_0"), F.greatest("value_1", "value_2", "value_3").desc(), F.desc("value_1")]
    return y.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(*falling, *ties)) - 1)


def quantise(s: DataFrame, params: Params) -> DataFrame:
    """Y: id, tile, q0 to q3, rank. The filter runs before the exchange by user."""
    ranked = anchor_rank(quantise_subperiods(quantise_day(s, params), params), params)
    return ranked.select(*KEY, "q0", "q1", "q2", "q3", "rank")


def top_anchor(y: DataFrame) -> DataFrame:
    return y.where("rank = 0")


def highly_nomadic_users(s: DataFrame, params: Params) -> DataFrame:
    """How many users of the state have no tile that reaches psi."""
    best = s.groupBy("id").agg(F.max("value_0").alias("best"))
    return best.agg(F.count(F.when(F.col("best") < params.psi, 1)).alias("highly_nomadic_users"))
