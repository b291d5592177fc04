"""The analysis' tables derived from the driver's tables, and the same as SQL.

Weights are whole cents in doubles, so sums are exact in any order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaique.functions.storage import kept
from mosaique.operators import clean, quantise, report, state
from mosaique.params import Params

PARAMS = Params(psi=30000.0, phi=0.5, xi=5.0, k=5)
LOW = Params(psi=15000.0, phi=0.5, xi=5.0, k=5)
LAST_PERIOD = 19752


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = PARAMS):
        self.spark, self.sf, self.params = spark, sf_dir, params

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf}/{name}.parquet")

    def kept(self, df: DataFrame) -> DataFrame:
        """df, stored and read back."""
        return kept(df)

    @cached_property
    def obs(self) -> DataFrame:
        """A row for each event: its tile, sub-period 1 to 3 and weight v."""
        k = F.get_json_object("props", "$.k").cast("int")
        v = F.when(F.col("event_type") == "error", -1).otherwise(1) * F.round(F.col("value") * 100)
        sub = F.when(F.hour("ts") < 8, 1).when(F.hour("ts") < 16, 2).otherwise(3)
        return self.table("events").select(
            F.col("user_id").alias("id"), F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).alias("period"), (k % 5).alias("tile_e"), F.floor(k / 20.0).cast("int").alias("tile_n"), sub.alias("sub_period"), v.alias("v")
        )

    @cached_property
    def h(self) -> DataFrame:
        values = (F.when(F.col("sub_period") == i, F.col("v")).otherwise(0.0).alias(f"value_{i}") for i in (1, 2, 3))
        return self.obs.select("id", "period", "tile_e", "tile_n", F.col("v").alias("value_0"), *values)

    @cached_property
    def users(self) -> DataFrame:
        return self.table("events").select(F.col("user_id").cast("bigint").alias("id")).distinct()

    @cached_property
    def clean(self) -> DataFrame:
        return clean.drop_invalid(self.h)

    @cached_property
    def last_h(self) -> DataFrame:
        """The last period, cleaned and deduplicated."""
        return clean.dedup_max(self.clean.where(F.col("period") == LAST_PERIOD))

    @cached_property
    def old_s(self) -> DataFrame:
        return state.fold(self.h.where(F.col("period") < LAST_PERIOD))

    @cached_property
    def s(self) -> DataFrame:
        return state.fold(self.h)

    @cached_property
    def y(self) -> DataFrame:
        return quantise.quantise(self.s, self.params)

    @cached_property
    def residents(self) -> DataFrame:
        rich = F.when(F.col("c_acctbal") > 400 * F.col("c_nationkey"), 1).otherwise(0)
        tile = [(F.col("c_nationkey") % 5).cast("int").alias("tile_e"), F.floor(F.col("c_nationkey") / 5.0).cast("int").alias("tile_n")]
        return self.table("customer").select(*tile, rich.alias("x")).groupBy("tile_e", "tile_n").agg(F.sum("x").cast("double").alias("value"))

    @cached_property
    def areas(self) -> DataFrame:
        return self.table("nation").select(F.col("n_regionkey").cast("int").alias("id"), (F.col("n_nationkey") % 5).cast("int").alias("tile_e"), F.floor(F.col("n_nationkey") / 5.0).cast("int").alias("tile_n"))

    @cached_property
    def p(self) -> DataFrame:
        return report.top_anchor_distribution(self.y)

    @cached_property
    def weights(self) -> DataFrame:
        return report.calibration_weights(self.p, self.residents, self.params)

    @cached_property
    def weighted(self) -> DataFrame:
        """Y with its users' weights; Y is made once, and so is this."""
        y = kept(self.y)
        weights = report.calibration_weights(report.top_anchor_distribution(y), self.residents, self.params)
        return kept(report.user_weights(y, weights))

    @cached_property
    def tiles(self) -> DataFrame:
        """A populated grid: residents as population."""
        return self.residents.select("tile_e", "tile_n", F.col("value").alias("population"))


_V = ["value_0", "value_1", "value_2", "value_3"]
_SUMS = ", ".join(f"sum({v}) AS {v}" for v in _V)
_MAXES = ", ".join(f"max({v}) AS {v}" for v in _V)
_KEY = "id, tile_e, tile_n"


def ctes(p: Params = PARAMS) -> str:
    """The same tables as common table expressions of DuckDB SQL."""
    return f"""WITH fx_obs AS (
  SELECT user_id AS id, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INT) AS period, CAST(k % 5 AS INT) AS tile_e,
    CAST(floor(k / 20.0) AS INT) AS tile_n, CASE WHEN hour(ts) < 8 THEN 1 WHEN hour(ts) < 16 THEN 2 ELSE 3 END AS sub_period,
    CASE WHEN event_type = 'error' THEN -1 ELSE 1 END * round(value * 100) AS v
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e),
fx_h AS (
  SELECT id, period, tile_e, tile_n, v AS value_0, CASE WHEN sub_period = 1 THEN v ELSE CAST(0 AS DOUBLE) END AS value_1,
    CASE WHEN sub_period = 2 THEN v ELSE CAST(0 AS DOUBLE) END AS value_2, CASE WHEN sub_period = 3 THEN v ELSE CAST(0 AS DOUBLE) END AS value_3
  FROM fx_obs),
fx_residents AS (
  SELECT CAST(c_nationkey % 5 AS INT) AS tile_e, CAST(floor(c_nationkey / 5.0) AS INT) AS tile_n,
    CAST(sum(CASE WHEN c_acctbal > 400 * c_nationkey THEN 1 ELSE 0 END) AS DOUBLE) AS value FROM customer GROUP BY 1, 2),
fx_areas AS (SELECT CAST(n_regionkey AS INT) AS id, CAST(n_nationkey % 5 AS INT) AS tile_e, CAST(floor(n_nationkey / 5.0) AS INT) AS tile_n FROM nation),
h_clean AS (SELECT * FROM fx_h WHERE isfinite(value_0) AND isfinite(value_1) AND isfinite(value_2) AND isfinite(value_3)
  AND value_0 >= 0 AND value_1 >= 0 AND value_2 >= 0 AND value_3 >= 0 AND greatest(value_0, value_1, value_2, value_3) > 0),
h_dedup AS (SELECT period, {_KEY}, {_MAXES} FROM h_clean GROUP BY period, {_KEY}),
last_h AS (SELECT {_KEY}, {', '.join(_V)} FROM h_dedup WHERE period = {LAST_PERIOD}),
old_s AS (SELECT {_KEY}, {_SUMS} FROM h_dedup WHERE period < {LAST_PERIOD} GROUP BY {_KEY}),
s AS (SELECT {_KEY}, {_SUMS} FROM h_dedup GROUP BY {_KEY}),
y AS (SELECT {_KEY}, 1 AS q0, CAST(value_1 / value_0 >= {p.phi} AS INT) AS q1, CAST(value_2 / value_0 >= {p.phi} AS INT) AS q2, CAST(value_3 / value_0 >= {p.phi} AS INT) AS q3,
  CAST(row_number() OVER (PARTITION BY id ORDER BY value_0 DESC, greatest(value_1, value_2, value_3) DESC, value_1 DESC, tile_e, tile_n) - 1 AS INT) AS rank
  FROM s WHERE value_0 >= {p.psi}),
p AS (SELECT tile_e, tile_n, count(*) AS value FROM y WHERE rank = 0 GROUP BY 1, 2),
w AS (SELECT tile_e, tile_n, value, CASE WHEN greatest(r, value) < {p.min_count} THEN 1.0 WHEN r / value <= {p.floor} THEN {p.floor} WHEN r / value >= {p.cap} THEN {p.cap}
  ELSE r / value END AS weight FROM (SELECT p.tile_e, p.tile_n, p.value, CAST(coalesce(fx_residents.value, 0) AS DOUBLE) AS r FROM p LEFT JOIN fx_residents USING (tile_e, tile_n)) x),
uw AS (SELECT y.id, w.weight FROM y JOIN w USING (tile_e, tile_n) WHERE y.rank = 0),
yw AS (SELECT y.*, CAST(uw.weight AS DOUBLE) AS weight FROM y JOIN uw USING (id)),
ua AS (SELECT DISTINCT y.id, fx_areas.id AS area FROM y JOIN fx_areas USING (tile_e, tile_n)),
tiles AS (SELECT tile_e, tile_n, value AS population FROM fx_residents),
dense AS (SELECT e.tile_e, n.tile_n, coalesce(t.population, 0) AS population
  FROM (SELECT CAST(unnest(generate_series(min(tile_e), max(tile_e))) AS INT) AS tile_e FROM tiles) e
  CROSS JOIN (SELECT CAST(unnest(generate_series(min(tile_n), max(tile_n))) AS INT) AS tile_n FROM tiles) n LEFT JOIN tiles t USING (tile_e, tile_n))
"""
