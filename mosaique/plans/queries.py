"""The registered queries of the analysis, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaique.functions import crypto, dates, histogram
from mosaique.functions.storage import workspace
from mosaique.operators import clean, compare, control, indicators, present, quantise, report, state, synth
from mosaique.params import Params
from mosaique.plans import session
from mosaique.plans.fixture import LAST_PERIOD, LOW, PARAMS, Fixture, ctes
from mosaique.schemas import FINGERPRINT, FUF, STATISTICS, TILE, TOP_ANCHOR, VALUES
from mosaique.sources import files, sinks
from mosaique.streaming import ingest, keyed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, params: Params = PARAMS, name: str | None = None):
    """Registers a function of a Fixture under its name; sql follows the common table expressions."""

    def keep(f: Callable[[Fixture], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Fixture(spark, sf_dir, params))
        if sql:
            SQL[key] = ctes(params) + sql
        return f

    return keep


KEYS = "id, tile_e, tile_n"
V = ", ".join(VALUES)
SUMS = ", ".join(f"sum({v}) AS {v}" for v in VALUES)


# --- cleaning


@query("SELECT id, period, tile_e, tile_n, " + V + " FROM h_clean", name="h_drop_invalid")
def _(x: Fixture):
    return x.clean


@query("SELECT id, tile_e, tile_n, value_0 FROM fx_h WHERE value_0 > 5000", name="filter")
def _(x: Fixture):
    return x.h.where("value_0 > 5000").select("id", *TILE, "value_0")


@query(f"SELECT period, {KEYS}, {V} FROM h_dedup", name="h_dedup_max")
def _(x: Fixture):
    return clean.dedup_max(x.clean, "period")


DUPLICATES = f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM h_clean GROUP BY period, {KEYS}) g"


@query(DUPLICATES, name="h_duplicate_count")
def _(x: Fixture):
    return clean.duplicate_count(x.h, "period")


@query(DUPLICATES.replace("h_clean", f"(SELECT * FROM h_clean WHERE period = {LAST_PERIOD}) z"), name="ind_duplicates")
def _(x: Fixture):
    return clean.duplicate_count(x.h.where(F.col("period") == LAST_PERIOD))


@query(f"SELECT {KEYS}, {V} FROM last_h ORDER BY {KEYS}", name="h_sort")
def _(x: Fixture):
    return clean.sort_rows(x.last_h)


@query(f"SELECT {KEYS}, value_0 FROM last_h ORDER BY value_0 DESC, {KEYS}", name="sort")
def _(x: Fixture):
    return x.last_h.orderBy(F.desc("value_0"), "id", *TILE).select("id", *TILE, "value_0")


# --- state

BOTH = f"SELECT {KEYS}, {SUMS} FROM (SELECT * FROM old_s UNION ALL SELECT * FROM last_h) b GROUP BY {KEYS}"


@query(BOTH, name="state_merge")
def _(x: Fixture):
    return state.merge(x.old_s, x.last_h)


BOTH_TEXT = f"SELECT CAST(id AS VARCHAR) AS id, tile_e, tile_n, {SUMS} FROM (SELECT * FROM old_s UNION ALL SELECT * FROM last_h) b GROUP BY {KEYS}"


@query(BOTH_TEXT, name="state_merge_buckets")
def _(x: Fixture):
    """The old state in buckets by user, of which the last period's merge replaces those that it touches."""
    store = sinks.StateStore(x.spark, workspace(x.spark, "state"))
    text = lambda df: df.withColumn("id", F.col("id").cast("string"))
    before = store.write(text(x.old_s), store.empty())
    h = x.kept(text(x.last_h))
    touched = [r[0] for r in h.select(state.bucket_of(store.n)).distinct().collect()]  # as many as buckets, at most
    with sinks.Temporary(store) as keep:
        now = store.write(state.merge_buckets(keep.buckets(before, touched), h, store.n), before)
    return store.read(now)


OUTER = f"SELECT {KEYS}, " + ", ".join(f"coalesce(a.{v}, 0) + coalesce(b.{v}, 0) AS {v}" for v in VALUES) + f" FROM old_s a FULL OUTER JOIN last_h b USING ({KEYS})"


@query(OUTER, name="state_merge_outer_join")
def _(x: Fixture):
    return state.merge_outer_join(x.old_s, x.last_h)


@query(f"SELECT {KEYS}, a.value_0 AS left_value, b.value_0 AS right_value FROM old_s a FULL OUTER JOIN last_h b USING ({KEYS})", name="outer_join")
def _(x: Fixture):
    a, b = (t.select("id", *TILE, F.col("value_0").alias(n)) for t, n in ((x.old_s, "left_value"), (x.last_h, "right_value")))
    return a.join(b, ["id", *TILE], "full_outer")


@query(f"SELECT {KEYS}, {V} FROM s", name="state_fold")
def _(x: Fixture):
    return x.s


@query("SELECT id, sum(value_0) AS value_0, count(*) AS n FROM s GROUP BY id", name="squash")
def _(x: Fixture):
    return x.s.groupBy("id").agg(F.sum("value_0").alias("value_0"), F.count("*").alias("n"))


for _name, _class, _where in (("state_left_only", "unchanged", "b.id IS NULL"), ("state_new", "new", "a.id IS NULL"), ("state_updated", "updated", "a.id IS NOT NULL AND b.id IS NOT NULL")):

    @query(f"SELECT {KEYS} FROM (SELECT DISTINCT {KEYS} FROM old_s UNION SELECT DISTINCT {KEYS} FROM last_h) k LEFT JOIN old_s a USING ({KEYS}) LEFT JOIN last_h b USING ({KEYS}) WHERE {_where}", name=_name)
    def _(x: Fixture, c=_class):
        return state.classes(x.old_s, x.last_h).where(F.col("class") == c).select("id", *TILE)


COUNTS = """, n AS (SELECT (SELECT count(*) FROM last_h) AS h, (SELECT count(*) FROM old_s) AS s_old, (SELECT count(*) FROM s) AS s_new, (SELECT count(*) FROM y) AS y)
"""


@query(COUNTS + "SELECT h, s_old, s_new, y, s_new - s_old AS growth, round((s_new - s_old) * 100.0 / s_old, 6) AS growth_pct, round(y * 1.0 / s_new, 6) AS y_share FROM n", name="record_counts")
def _(x: Fixture):
    return state.record_counts(x.last_h, x.old_s, x.s, x.y)


@query(COUNTS + "SELECT h * 36 AS h_bytes, s_new * 32 AS s_bytes, y * 48 AS y_bytes FROM n", name="record_size_report")
def _(x: Fixture):
    return compare.record_sizes(state.record_counts(x.last_h, x.old_s, x.s, x.y))


@query(f"SELECT {KEYS}, {V} FROM s", name="read_state")
def _(x: Fixture):
    path = workspace(x.spark, "state")
    x.s.withColumn("id", F.col("id").cast("string")).write.parquet(path)
    return files.read_state(x.spark, path).withColumn("id", F.col("id").cast("bigint"))


# --- quantisation


@query(f"SELECT {KEYS}, {V} FROM s WHERE value_0 >= {PARAMS.psi}", name="quantise_day")
def _(x: Fixture):
    return quantise.quantise_day(x.s, x.params)


@query(f"SELECT {KEYS}, q0, q1, q2, q3 FROM y", name="quantise_subperiods")
def _(x: Fixture):
    return quantise.quantise_subperiods(quantise.quantise_day(x.s, x.params), x.params).select("id", *TILE, "q0", "q1", "q2", "q3")


@query(f"SELECT {KEYS}, rank FROM y", name="anchor_rank")
def _(x: Fixture):
    return x.y.select("id", *TILE, "rank")


@query(f"SELECT {KEYS}, q0, q1, q2, q3 FROM y WHERE rank = 0", name="top_anchor")
def _(x: Fixture):
    return quantise.top_anchor(x.y).drop("rank")


NOMADIC = f"(SELECT count(*) FROM (SELECT id FROM s GROUP BY id HAVING max(value_0) < {PARAMS.psi}) z)"


@query(f"SELECT {NOMADIC} AS highly_nomadic_users", name="highly_nomadic_users")
def _(x: Fixture):
    return quantise.highly_nomadic_users(x.s, x.params)


# --- reports


@query("SELECT id, area FROM ua", name="user_reference_areas")
def _(x: Fixture):
    return report.user_reference_areas(x.y, x.areas)


@query(f"SELECT {KEYS}, coalesce(l, '') AS areas FROM y LEFT JOIN (SELECT id, string_agg(CAST(area AS VARCHAR), ',' ORDER BY area) AS l FROM ua GROUP BY id) g USING (id)", name="user_reference_area_list")
def _(x: Fixture):
    return report.user_reference_area_list(x.y, x.areas).select("id", *TILE, F.array_join(F.col("areas").cast("array<string>"), ",").alias("areas"))


@query("SELECT y.id, ua.area, y.tile_e, y.tile_n FROM y JOIN ua USING (id) WHERE EXISTS (SELECT 1 FROM fx_areas a WHERE a.id = ua.area AND a.tile_e = y.tile_e AND a.tile_n = y.tile_n)", name="tile_in_area")
def _(x: Fixture):
    rows = x.y.select("id", *TILE).join(report.user_reference_areas(x.y, x.areas), "id")
    return report.tile_in_area(rows, x.areas).select("id", "area", *TILE)


@query("SELECT tile_e, tile_n, value FROM p", name="top_anchor_distribution")
def _(x: Fixture):
    return x.p


P_SDC = f"SELECT tile_e, tile_n, value FROM p WHERE value >= {PARAMS.xi}"


@query(P_SDC, name="top_anchor_sdc")
def _(x: Fixture):
    return report.top_anchor_sdc(x.p, x.params)


@query("SELECT tile_e, tile_n, value, round(CAST(weight AS DOUBLE), 6) AS weight FROM w", name="calibration_weights")
@query("SELECT tile_e, tile_n, value, round(CAST(weight AS DOUBLE), 6) AS weight FROM w", LOW, name="calibration_weights_low")
def _(x: Fixture):
    return report.rounded(x.weights, "weight")


@query(f"SELECT {KEYS}, rank, round(weight, 6) AS weight FROM yw", name="user_weights")
def _(x: Fixture):
    return report.rounded(x.weighted.select("id", *TILE, "rank", "weight"), "weight")


OBSERVED = "CAST(coalesce(sum(value), 0) AS BIGINT) AS observed_total_users, round(CAST(coalesce(sum(value * weight), 0) AS DOUBLE), 6) AS adjusted_total_users FROM w"


@query("SELECT " + OBSERVED, name="observed_adjusted_users")
def _(x: Fixture):
    return report.rounded(report.observed_adjusted_users(x.weights), "adjusted_total_users")


D = "SELECT tile_e, tile_n, " + ", ".join(f"CAST(sum(q{i}) AS DOUBLE) AS value_{i}" for i in range(4)) + " FROM y GROUP BY 1, 2"
DW = "SELECT tile_e, tile_n, " + ", ".join(f"sum(weight * q{i}) AS value_{i}" for i in range(4)) + " FROM yw GROUP BY 1, 2"
D_SDC = "SELECT tile_e, tile_n, " + ", ".join(f"round(CASE WHEN {v} < {PARAMS.xi} THEN 0 ELSE {v} END, 6) AS {v}" for v in VALUES) + " FROM ({}) d"


@query(D, name="total_footprint")
def _(x: Fixture):
    return report.total_footprint(x.y)


@query("SELECT tile_e, tile_n, " + ", ".join(f"round({v}, 6) AS {v}" for v in VALUES) + f" FROM ({DW}) d", name="total_footprint_calibrated")
def _(x: Fixture):
    return report.rounded(report.total_footprint_calibrated(x.weighted), *VALUES)


@query(D_SDC.format(D), name="total_footprint_sdc")
def _(x: Fixture):
    return report.rounded(report.total_footprint_sdc(report.total_footprint(x.y), x.params), *VALUES)


@query(D_SDC.format(DW), name="total_footprint_sdc_calibrated")
def _(x: Fixture):
    return report.rounded(report.total_footprint_sdc(report.total_footprint_calibrated(x.weighted), x.params), *VALUES)


def operands(weight: str, rows: str) -> str:
    return f""", op AS (SELECT a.area, t.tile_e, t.tile_n, sum(CASE WHEN ua.id IS NOT NULL THEN {weight} ELSE 0 END) AS num, CAST(sum({weight}) AS DOUBLE) AS den
  FROM {rows} t CROSS JOIN (SELECT DISTINCT id AS area FROM fx_areas) a LEFT JOIN ua ON ua.id = t.id AND ua.area = a.area
  WHERE NOT EXISTS (SELECT 1 FROM fx_areas f WHERE f.id = a.area AND f.tile_e = t.tile_e AND f.tile_n = t.tile_n) GROUP BY 1, 2, 3)
"""


STRENGTH = f"SELECT area AS reference_area, tile_e, tile_n, round(num / den, 6) AS strength FROM op WHERE num >= {PARAMS.xi} AND num / den > 1e-20"


@query(operands("t.weight", "yw") + "SELECT area, tile_e, tile_n, round(num, 6) AS num, round(den, 6) AS den FROM op WHERE num > 0", name="connection_operands")
def _(x: Fixture):
    return report.rounded(report.connection_operands(x.weighted, x.areas), "num", "den")


@query(operands("t.weight", "yw") + "SELECT area, tile_e, tile_n, round(num, 6) AS num, round(den, 6) AS den FROM op", name="connection_operands_literal")
def _(x: Fixture):
    return report.rounded(report.connection_operands_literal(x.weighted, x.areas), "num", "den")


@query(operands("1.0", "y") + STRENGTH, name="connection_strength")
def _(x: Fixture):
    return report.rounded(report.connection_strength(report.connection_operands(report.user_weights(x.y, None), x.areas), x.params), "strength")


@query(operands("t.weight", "yw") + STRENGTH, name="connection_strength_calibrated")
def _(x: Fixture):
    return report.rounded(report.connection_strength(report.connection_operands(x.weighted, x.areas), x.params), "strength")


STATS = f"SELECT {NOMADIC} AS highly_nomadic_users, {OBSERVED}"


@query(STATS, name="statistics")
def _(x: Fixture):
    return report.rounded(report.statistics(x.s, x.weights, x.params), "adjusted_total_users")


@query(f"SELECT {NOMADIC} AS highly_nomadic_users, CAST(0 AS BIGINT) AS observed_total_users, CAST(0 AS DOUBLE) AS adjusted_total_users", name="statistics_uncalibrated")
def _(x: Fixture):
    return report.statistics(x.s, None, x.params)


FULL = (
    operands("t.weight", "yw")
    + f"""SELECT 'fingerprint' AS topic, CAST(NULL AS INT) AS area, tile_e, tile_n, value_0, value_1, value_2, value_3 FROM ({D_SDC.format(DW)}) a
UNION ALL SELECT 'top_anchor', NULL, tile_e, tile_n, CAST(value AS DOUBLE), NULL, NULL, NULL FROM ({P_SDC}) b
UNION ALL SELECT 'fuf', reference_area, tile_e, tile_n, strength, NULL, NULL, NULL FROM ({STRENGTH}) c
UNION ALL SELECT 'statistics', NULL, NULL, NULL, CAST(highly_nomadic_users AS DOUBLE), CAST(observed_total_users AS DOUBLE), adjusted_total_users, NULL FROM ({STATS}) d"""
)


@query(FULL, name="full_report")
def _(x: Fixture):
    """All reports as one table, from a stored Y."""
    r = report.full_report(x.s, x.areas, x.residents, x.params, x.kept)
    none, number = F.lit(None).cast("int"), lambda c: F.col(c).cast("double")
    null = F.lit(None).cast("double")

    def topic(rows: DataFrame, name: str, area, e, n, *values) -> DataFrame:
        cols = [*values, *[null] * (4 - len(values))]
        return rows.select(F.lit(name).alias("topic"), area.alias("area"), e.alias("tile_e"), n.alias("tile_n"), *(c.alias(v) for c, v in zip(cols, VALUES, strict=True)))

    e, n = F.col("tile_e"), F.col("tile_n")
    parts = [
        topic(report.rounded(r.fingerprint, *VALUES), "fingerprint", none, e, n, *map(number, VALUES)),
        topic(r.top_anchor, "top_anchor", none, e, n, number("value")),
        topic(r.fuf, "fuf", F.col("reference_area"), e, n, F.round("strength", 6)),
        topic(r.statistics, "statistics", none, none, none, number("highly_nomadic_users"), number("observed_total_users"), F.round("adjusted_total_users", 6)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _written(x: Fixture, topic: str, schema: str) -> DataFrame:
    r = report.full_report(x.s, x.areas, x.residents, x.params, x.kept)
    rows = dict(zip(sinks.COLUMNS, (r.fingerprint, r.top_anchor, r.fuf, r.statistics), strict=True))[topic]
    path = sinks.write_topic(rows, workspace(x.spark, "report"), topic)
    return x.spark.read.schema(schema).csv(path, header=True)


@query(D_SDC.format(DW), name="write_fingerprint_report")
def _(x: Fixture):
    return report.rounded(_written(x, "fingerprint_report", FINGERPRINT), *VALUES)


@query(P_SDC, name="write_top_anchor_report")
def _(x: Fixture):
    return _written(x, "top_anchor_distribution_report", TOP_ANCHOR)


@query(operands("t.weight", "yw") + STRENGTH, name="write_fuf_report")
def _(x: Fixture):
    return report.rounded(_written(x, "functional_urban_fingerprint_report", FUF), "strength")


@query(STATS, name="write_statistics")
def _(x: Fixture):
    return report.rounded(_written(x, "statistics", STATISTICS), "adjusted_total_users")


# --- sources


@query(f"SELECT CAST(id AS VARCHAR) AS id, tile_e, tile_n, {V} FROM fx_h", name="read_footprints_csv")
def _(x: Fixture):
    path = workspace(x.spark, "csv")
    sinks.write_csv(x.h.select("id", *TILE, *VALUES).toDF(*(f"header{i}" for i in range(1, 8))), path)
    return files.read_footprints_csv(x.spark, path)


@query("SELECT printf('%032X', id) AS id, tile_e, tile_n, " + ", ".join(f"CAST(CAST({v} AS FLOAT) AS DOUBLE) AS {v}" for v in VALUES) + " FROM fx_h", name="read_footprints_binary")
def _(x: Fixture):
    """Record files that were written and are read back."""
    path = workspace(x.spark, "hdata")
    sinks.write_binary(x.h.withColumn("id", F.unhex(F.lpad(F.hex("id"), 32, "0"))), path)
    return files.read_footprints_binary(x.spark, path).select(F.hex("id").alias("id"), *TILE, *(F.col(v).cast("double").alias(v) for v in VALUES))


@query(f"SELECT CAST(id AS VARCHAR) AS id, tile_e, tile_n, {V}, period FROM fx_h", name="read_footprint_days")
def _(x: Fixture):
    folder = workspace(x.spark, "days")
    # One folder a period with the name of its file: Spark reads either.
    named = x.h.withColumn("day", F.format_string("day-%d-updates.csv", "period"))
    for (name,) in named.select("day").distinct().collect():  # 30 periods
        sinks.write_csv(named.where(F.col("day") == name).select("id", *TILE, *VALUES), f"{folder}/{name}")
    return files.read_footprint_days(x.spark, folder)


@query("SELECT id, tile_e, tile_n FROM fx_areas", name="read_reference_areas")
def _(x: Fixture):
    path = workspace(x.spark, "areas")
    sinks.write_csv(x.areas.coalesce(1).orderBy("id", *TILE), path)
    return files.read_reference_areas(x.spark, path)


@query("SELECT tile_e, tile_n, value FROM fx_residents", name="read_residents")
def _(x: Fixture):
    path = workspace(x.spark, "residents")
    sinks.write_csv(x.residents.unionByName(x.residents.withColumn("value", F.col("value") + 1)).coalesce(1).orderBy(*TILE, "value"), path)
    return files.read_residents(x.spark, path)


@query("SELECT tile_e, tile_n, population, CAST(NULL AS VARCHAR) AS geometry FROM tiles", name="read_population_geojson")
def _(x: Fixture):
    path = workspace(x.spark, "geojson")
    name = F.concat_ws(".", F.col("tile_e").cast("string"), F.col("tile_n").cast("string"), F.lit("0"))
    feature = F.struct(F.struct(name.alias("grd_floaid"), F.col("population").alias("ms_population_20160101")).alias("properties"))
    x.tiles.coalesce(1).agg(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features")).write.json(path)
    return files.read_population_geojson(x.spark, path)


@query("SELECT CAST(i AS INT) AS id, tile_e, tile_n FROM tiles CROSS JOIN (SELECT unnest([0, 1]) AS i) u", name="read_area_grid_csv")
def _(x: Fixture):
    path = workspace(x.spark, "grid")
    name = F.concat_ws(".", F.col("tile_e").cast("string"), F.col("tile_n").cast("string"), F.lit("0"))
    none = F.lit(None).cast("string")
    sinks.write_csv(x.tiles.select(F.lit(1).alias("ogc_fid"), none.alias("grd_fixid"), name.alias("grd_floaid"), none.alias("grd_newid"), F.lit(1.0).alias("shape_leng"), F.lit(1.0).alias("shape_area"), F.col("population").alias("ms_pop")), path)
    return files.read_area_grid_csv(x.spark, [path, path])


@query("SELECT DISTINCT period FROM fx_h", name="list_h_dir")
def _(x: Fixture):
    folder = workspace(x.spark, "hdata")
    for (p,) in x.h.select("period").distinct().collect():  # 30 periods
        x.spark.range(1).write.parquet(f"{folder}/day-{dates.date_of(p)}-updates.hdata")
    return files.list_h_dir(x.spark, folder).select("period")


# --- indicators


def ladder(value: str, bins: int, lowest: float) -> str:
    cases = " ".join(f"WHEN {value} < {lowest * 2.0**i!r} THEN {i}" for i in range(bins - 1))
    return f"CASE {cases} ELSE {bins - 1} END"


def all_bins(values: str, value: str, bins: int, lowest: float, by: str = "", groups: str = "") -> str:
    """SQL of a full histogram of `values` (a table expression) by the columns `by`, over the groups of a table expression."""
    sep = f"{by}, " if by else ""
    grid = f"SELECT {sep}CAST(b AS INT) AS bin FROM (SELECT unnest(range({bins})) AS b) z" + (f" CROSS JOIN ({groups}) g" if groups else "")
    part = f"PARTITION BY {by} " if by else ""
    return f""", hh AS (SELECT {sep}{ladder(value, bins, lowest)} AS bin, count(*) AS n FROM {values} v GROUP BY ALL), gg AS ({grid}),
ff AS (SELECT gg.*, coalesce(hh.n, 0) AS "count" FROM gg LEFT JOIN hh USING ({sep}bin))
SELECT {sep}bin, "count", round(sum("count") OVER ({part}ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 / greatest(sum("count") OVER ({part.strip()}), 1), 6) AS cum_pct FROM ff"""


SUBS = "SELECT CAST(unnest(range(4)) AS INT) AS sub_period"
POPULATIONS = (("h", "last_h", lambda x: x.last_h), ("old_s", "old_s", lambda x: x.old_s), ("new_s", "s", lambda x: x.s))


def unpivot(table: str, columns: list[str], name: str) -> str:
    return "(" + " UNION ALL ".join(f"SELECT {i} AS sub_period, id, {c} AS {name} FROM {table}" for i, c in enumerate(columns)) + ")"


for _suffix, _table, _rows in POPULATIONS:

    @query(all_bins(f"(SELECT CAST(count(*) AS DOUBLE) AS n FROM {_table} GROUP BY id)", "n", 10, 1.0), name=f"ind_count_{_suffix}")
    def _(x: Fixture, rows=_rows):
        return indicators.count(rows(x))

    @query(f"SELECT count(*) AS records, count(DISTINCT id) AS users FROM {_table}", name=f"ind_totals_{_suffix}")
    def _(x: Fixture, rows=_rows):
        return indicators.totals(rows(x))

    _tiles = "(SELECT id, " + ", ".join(f"CAST(count(*) FILTER ({v} > 0) AS DOUBLE) AS t{i}" for i, v in enumerate(VALUES)) + f" FROM {_table} GROUP BY id) t"

    @query(all_bins(f"(SELECT * FROM {unpivot(_tiles, ['t0', 't1', 't2', 't3'], 'n')} u WHERE n > 0)", "n", 10, 1.0, "sub_period", SUBS), name=f"ind_unique_tiles_{_suffix}")
    def _(x: Fixture, rows=_rows):
        return indicators.unique_tiles(rows(x))

    if _suffix != "new_s":

        @query(all_bins(unpivot(_table, VALUES, "x"), "x", 17, 1 / 256, "sub_period", SUBS), name=f"ind_weight_hist_{_suffix}")
        def _(x: Fixture, rows=_rows):
            return indicators.weight_hist(rows(x))


@query("SELECT CAST(p AS INT) AS pattern, count(l.id) AS \"count\" FROM (SELECT unnest(range(16)) AS p) z LEFT JOIN last_h l ON p = " + " + ".join(f"(CASE WHEN {v} <> 0 THEN {8 >> i} ELSE 0 END)" for i, v in enumerate(VALUES)) + " GROUP BY 1", name="ind_spatiotemporal")
def _(x: Fixture):
    return indicators.spatiotemporal(x.last_h)


def centroids(table: str) -> str:
    one = lambda i: f"SELECT id, {i} AS sub_period, sum(value_{i}) AS w, sum(value_{i} * tile_e) AS e, sum(value_{i} * tile_n) AS n FROM {table} GROUP BY id"
    return "(SELECT id, sub_period, e / w AS ce, n / w AS cn FROM (" + " UNION ALL ".join(map(one, range(4))) + ") q WHERE w <> 0)"


DISTANCES = f"(SELECT a.id, sub_period, sqrt((a.ce - b.ce) * (a.ce - b.ce) + (a.cn - b.cn) * (a.cn - b.cn)) AS distance FROM {centroids('last_h')} a JOIN {centroids('old_s')} b USING (id, sub_period))"


@query(f"SELECT id, sub_period, round(distance, 6) AS distance FROM {DISTANCES} d", name="ind_centroid_distances")
def _(x: Fixture):
    return report.rounded(indicators.centroid_distances(x.last_h, x.old_s), "distance")


@query(all_bins(DISTANCES, "distance", 10, 256.0, "sub_period", SUBS), name="ind_centroid_distance")
def _(x: Fixture):
    return indicators.centroid_distance(x.last_h, x.old_s)


def diagonal(table: str) -> str:
    one = lambda i: f"SELECT id, {i} AS sub_period, max(tile_e) FILTER (value_{i} <> 0) - min(tile_e) FILTER (value_{i} <> 0) AS e, max(tile_n) FILTER (value_{i} <> 0) - min(tile_n) FILTER (value_{i} <> 0) AS n FROM {table} GROUP BY id"
    return "(SELECT id, sub_period, sqrt(CAST(e * e + n * n AS DOUBLE)) AS d FROM (" + " UNION ALL ".join(map(one, range(4))) + ") q WHERE e IS NOT NULL)"


BOXES = f"(SELECT 'h' AS measure, sub_period, d FROM {diagonal('last_h')} a UNION ALL SELECT 'old_s', sub_period, d FROM {diagonal('old_s')} b UNION ALL SELECT 'change', sub_period, abs(a.d - b.d) AS d FROM {diagonal('old_s')} a JOIN {diagonal('s')} b USING (id, sub_period))"


@query(all_bins(BOXES, "d", 8, 1024.0, "measure, sub_period", f"SELECT measure, sub_period FROM ({SUBS}) s CROSS JOIN (SELECT unnest(['h', 'old_s', 'change']) AS measure) m"), name="ind_bounding_box")
def _(x: Fixture):
    return indicators.bounding_box(x.last_h, x.old_s, x.s)


@query(f"SELECT {ladder('value_0', 12, 256.0)} AS bin, count(*) AS \"count\" FROM s GROUP BY 1", name="log2_histogram")
def _(x: Fixture):
    return histogram.log2_histogram(x.s, "value_0", 12, 256.0)


@query(all_bins("s", "value_0", 12, 256.0), name="histogram_iterate")
def _(x: Fixture):
    return histogram.iterate(histogram.log2_histogram(x.s, "value_0", 12, 256.0), None, 12)


@query(f"SELECT tile_e, tile_n, CASE WHEN value < {PARAMS.k} THEN 'NA' ELSE CAST(value AS VARCHAR) END AS value FROM p", name="k_anonymize")
def _(x: Fixture):
    return x.p.select(*TILE, histogram.k_anonymous(F.col("value"), x.params.k).alias("value"))


LINE = f"""SELECT bin, CASE WHEN bin < 11 THEN ' < ' || CAST(CAST(256 * pow(2, bin) AS BIGINT) AS VARCHAR) ELSE '>= ' || CAST(256 * 1024 AS VARCHAR) END || ': '
|| CASE WHEN "count" < {PARAMS.k} THEN 'NA (NA %)' ELSE CAST("count" AS VARCHAR) || ' (' || printf('%.1f %%', cum_pct) || ')' END AS line FROM ("""


@query(all_bins("s", "value_0", 12, 256.0).replace("\nSELECT bin,", f"\n{LINE}SELECT bin,") + ") l", name="histogram_format")
def _(x: Fixture):
    full = histogram.iterate(histogram.log2_histogram(x.s, "value_0", 12, 256.0), None, 12)
    return histogram.format_lines(full, 12, 256.0, x.params.k)


# --- pseudonyms


@query("SELECT doc_id, substr(sha256(text), 1, 24) AS hash FROM documents", name="hash_id")
def _(x: Fixture):
    return x.table("documents").select("doc_id", F.lower(F.hex(crypto.hash_id(F.col("text")))).alias("hash"))


TAG_KEY = bytes(range(16))
PADS = [bytes(b ^ x for b in TAG_KEY.ljust(64, b"\0")).hex() for x in (0x36, 0x5C)]


@query(f"SELECT doc_id, substr(sha256(from_hex('{PADS[1]}') || from_hex(sha256(from_hex('{PADS[0]}') || from_hex(substr(sha256(text), 1, 24))))), 1, 8) AS tag FROM documents", name="hmac_tag")
def _(x: Fixture):
    return x.table("documents").select("doc_id", F.lower(F.hex(crypto.hmac_tag(crypto.hash_id(F.col("text")), TAG_KEY))).alias("tag"))


@query("SELECT max(period) AS period, upper(substr(sha256(CAST(max(period) AS VARCHAR)), 1, 32)) AS key FROM fx_h", name="lookup_period_key")
def _(x: Fixture):
    """The key of the last period, in a table with a key for each period."""
    keys = x.h.select("period").distinct().withColumn("key", F.unhex(F.substring(F.sha2(F.col("period").cast("string").cast("binary"), 256), 1, 32)))
    last = x.h.agg(F.max("period")).first()[0]
    return x.spark.createDataFrame([(last, crypto.lookup_key(keys, last).hex().upper())], "period int, key string")


@query("SELECT user_id AS id FROM (SELECT DISTINCT user_id FROM events) e", name="pseudonym_round_trip")
def _(x: Fixture):
    """Ids that come back from their pseudonyms: each is hashed, pseudonymised and reversed."""
    key = bytes(range(16))
    own = crypto.hash_number(F.col("id"))
    rows = x.table("events").select(F.col("user_id").alias("id")).distinct().select("id", own.alias("own"), crypto.pseudonymise(own, key).alias("pseudonym"))
    return rows.where(crypto.depseudonymise(F.col("pseudonym"), key) == F.col("own")).select("id")


# --- requests, periods, control


@query("SELECT CAST(count(*) FILTER (NOT ok) AS BIGINT) AS wrong_steps FROM (SELECT id = coalesce(lag(id) OVER (ORDER BY id, tile_e, tile_n), 0) OR id = lag(id) OVER (ORDER BY id, tile_e, tile_n) + 1 AS ok FROM fx_areas) z", name="validate_reference_areas")
def _(x: Fixture):
    rows = x.areas.coalesce(1).orderBy("id", *TILE).withColumn("line_no", F.monotonically_increasing_id())
    return files.area_steps(rows).agg(F.count("*").alias("wrong_steps"))


@query(f"SELECT period, period >= {LAST_PERIOD - 9} AND period <= {LAST_PERIOD - 2} AS accepted FROM (SELECT DISTINCT period FROM fx_h) z", name="period_guard")
def _(x: Fixture):
    return x.h.select("period").distinct().withColumn("accepted", session.period_guard(F.col("period"), LAST_PERIOD - 9, LAST_PERIOD - 2))


@query("SELECT CAST(p AS INT) AS period FROM (SELECT unnest(range(min(period), max(period))) AS p FROM fx_h) z", name="skipped_periods")
def _(x: Fixture):
    """What is skipped where a request begins with the first period and its last one comes first."""
    first, last = x.h.agg(F.min("period"), F.max("period")).first()
    return session.skipped_periods(x.spark, first, last)


@query("SELECT o_orderdate_text, CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate_text AS DATE)) AS INT) AS period FROM (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate_text FROM orders) z", name="date_to_period")
def _(x: Fixture):
    d = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("o_orderdate_text")
    return x.table("orders").select(d).distinct().withColumn("period", dates.date_to_period(F.col("o_orderdate_text")))


@query("SELECT period, strftime(DATE '1970-01-01' + period, '%Y-%m-%d') AS date FROM (SELECT DISTINCT period FROM fx_h) z", name="period_to_date")
def _(x: Fixture):
    return x.h.select("period").distinct().withColumn("date", F.date_format(dates.period_to_date(F.col("period")), "yyyy-MM-dd"))


DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
#: A date as it is, and what is none: without marks, with a letter in front, cut, with a 13th month, or with days of one digit.
TEXTS = [DAY, f"replace({DAY}, '-', '')", f"'x' || {DAY}", f"substr({DAY}, 1, 7)", f"substr({DAY}, 1, 5) || '13' || substr({DAY}, 8)", f"replace({DAY}, '-0', '-')"]
SPOILT = "CASE o_orderkey % 6 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(TEXTS)) + " END"


@query(f"SELECT o_orderkey, t AS text, coalesce(regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(t AS DATE) >= DATE '1970-01-01', false) AS valid FROM (SELECT o_orderkey, {SPOILT} AS t FROM orders) z", name="validate_date_arg")
def _(x: Fixture):
    rows = x.table("orders").withColumn("o_orderdate", F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"))
    text = F.expr(SPOILT.replace("CAST(CAST(o_orderdate AS DATE) AS VARCHAR)", "o_orderdate")).alias("text")
    return rows.select("o_orderkey", text).withColumn("valid", dates.is_date(F.col("text")))


#: What an order stands for in a history of instances, by its customer's number modulo 16: 0 and 1 polls (the second fails), 2 to 9
#: periods (failed where the order's status is F), 10 an invalid call, 11 a failed finish, 12 a finish, 13 a last period that
#: makes the report, 14 and 15 cancels (the second fails).
INVALID = ":AE01: not allowed"


def history(x: Fixture) -> DataFrame:
    m, p = F.col("o_custkey") % 16, F.floor("o_totalprice").cast("int") % 30
    ok = ~(m.isin(1, 10, 11, 15) | (m.between(2, 9) & (F.col("o_orderstatus") == "F")))
    pair = lambda name, value: F.array(F.struct(F.lit(name).alias("key"), value.cast("string").alias("value")))
    none = F.array().cast("array<struct<key: string, value: string>>")
    arguments = F.when(m <= 1, none).when(m.between(2, 10) | (m == 13), pair("period", p)).when(m <= 12, pair("finish-report", F.lit(""))).otherwise(pair("cancel", F.lit("")))
    topic = lambda name, number: F.struct(F.lit(name).alias("topic"), number.cast("int").alias("id"))
    number = F.col("o_orderkey") + 10_000_000
    outputs = F.filter(F.array(F.when(ok, topic("application_log", number)), F.when(m.isin(12, 13), topic("fingerprint_report", number))), lambda y: y.isNotNull())
    error = F.when(m == 10, INVALID).when(~ok, "cannot decrypt")
    # What a log says: a running request, a new one, none, or nothing of these.
    key = F.col("o_orderkey")
    span = F.concat(F.lit("With calibration: true\nFirst period: "), key, F.lit(", last period: "), key + 5, F.lit("\n"))
    log = F.when(key % 4 == 0, F.concat(F.lit("\nH metadata:\nday\n"), span, F.lit("Expected next period: "), key + 2, F.lit("\nSkipped period 7\n")))
    log = log.when(key % 4 == 1, F.concat(F.lit("New NSI request arrived.\n"), span)).when(key % 4 == 2, F.lit("Waited for new NSI request, nothing came, going back to sleep.\n")).otherwise(F.lit("x"))
    return x.table("orders").select(key.cast("int").alias("instance"), F.when(ok, "Finished").otherwise("Failed").alias("status"), arguments.alias("arguments"), outputs.alias("outputs"), error.alias("error"), log.alias("application_log"))


HISTORY = """, hist AS (SELECT CAST(o_orderkey AS INT) AS instance, CAST(o_custkey % 16 AS INT) AS m, CAST(CAST(floor(o_totalprice) AS INT) % 30 AS INT) AS p,
  o_custkey % 16 IN (1, 10, 11, 15) OR (o_custkey % 16 BETWEEN 2 AND 9 AND o_orderstatus = 'F') AS failed FROM orders),
norm AS (SELECT instance, CASE WHEN m BETWEEN 2 AND 9 OR m = 13 THEN p END AS period, failed,
    CASE WHEN m <= 1 THEN 'poll_request' WHEN m >= 14 THEN 'cancel' WHEN m = 12 THEN 'report' ELSE 'h' END AS type, CASE WHEN NOT failed THEN instance + 10000000 END AS application_log, 0 AS part
  FROM hist WHERE m NOT IN (10, 11)
  UNION ALL SELECT instance, NULL, failed, 'report', instance + 10000000, 1 FROM hist WHERE m = 13)
"""


@query(HISTORY + "SELECT instance, CAST(period AS INT) AS period, failed, type, CAST(application_log AS INT) AS application_log, CAST(part AS INT) AS part FROM norm", name="instances_normalise")
def _(x: Fixture):
    return control.instances_normalise(history(x))


#: Everything behind this instance is new.
LAST_SEEN = 20

BATCHES = HISTORY + f""", cut AS (SELECT *, type = 'report' OR (type = 'cancel' AND NOT failed) AS boundary, instance > {LAST_SEEN} AS fresh FROM norm),
numbered AS (SELECT *, sum(CAST(boundary AS INT)) OVER (ORDER BY instance DESC, part DESC) AS batch FROM cut),
grouped AS (SELECT batch, max(type) FILTER (boundary) AS ended, bool_or(fresh) AS any_new, coalesce(bool_or(boundary AND fresh), false) AS ended_new, bool_or(type = 'h') AS any_h,
    bool_or(type = 'poll_request' AND fresh AND NOT failed) AS polled, bool_or(type = 'poll_request' AND fresh AND failed) AS poll_failed, bool_or(type = 'cancel' AND fresh AND failed) AS cancel_failed,
    max(instance) FILTER (fresh OR boundary) AS instance, arg_max(application_log, (instance, part)) FILTER (application_log IS NOT NULL) AS application_log,
    arg_max(period, (instance, part)) FILTER (type = 'h') AS greatest_period, arg_max(period, (instance, part)) FILTER (type = 'h' AND NOT fresh) AS old_greatest_period,
    coalesce(string_agg(CAST(period AS VARCHAR), ':' ORDER BY instance DESC) FILTER (type = 'h' AND fresh AND NOT failed), '') AS periods,
    coalesce(string_agg(CAST(period AS VARCHAR), ':' ORDER BY instance DESC) FILTER (type = 'h' AND fresh AND failed), '') AS failed_periods
  FROM numbered GROUP BY batch),
kept AS (SELECT *, CASE WHEN ended = 'report' THEN 'report' WHEN ended = 'cancel' THEN 'canceled' WHEN any_h THEN 'processing' ELSE 'poll_request' END AS base
  FROM grouped WHERE any_new AND (ended IS NULL OR ended_new))
SELECT base || CASE WHEN polled AND base <> 'poll_request' THEN '_new' ELSE '' END AS type, CAST(application_log AS INT) AS application_log, CAST(instance AS INT) AS instance,
  CAST(greatest_period AS INT) AS greatest_period, CAST(old_greatest_period AS INT) AS old_greatest_period, periods, failed_periods,
  concat_ws(':', CASE WHEN cancel_failed THEN 'cancel_failed' END, CASE WHEN poll_failed THEN 'poll_request_failed' END) AS anomalies FROM kept"""


@query(BATCHES, name="group_batches")
def _(x: Fixture):
    """Lists as texts with colons, as the published interface hands them on."""
    rows = control.group_batches(control.instances_normalise(history(x)), LAST_SEEN)
    return rows.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ":") for c in ("periods", "failed_periods", "anomalies")})


@query(HISTORY + """SELECT failed AND m > 1 AND m < 14 AND m BETWEEN 2 AND 9 AND p = 5 AS report_failed, NOT failed AND m IN (12, 13, 14) AS finished_or_canceled
FROM hist WHERE m <> 10 ORDER BY instance DESC LIMIT 1""", name="last_instance_predicates")  # fmt: skip
def _(x: Fixture):
    return control.last_instance_predicates(history(x), 5)


@query(HISTORY + "SELECT max(instance) AS instance FROM hist WHERE NOT failed", name="last_finished_instance")
def _(x: Fixture):
    return control.last_finished_instance(history(x))


@query("""SELECT CAST(o_orderkey AS INT) AS log_id, CASE o_orderkey % 4 WHEN 0 THEN 'running' WHEN 1 THEN 'new_request' WHEN 2 THEN 'no_request' ELSE 'invalid' END AS kind,
CAST(CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey ELSE -1 END AS INT) AS first_period, CAST(CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey + 5 ELSE -1 END AS INT) AS last_period,
CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey + 3 ELSE -1 END AS INT) AS next_period FROM orders""", name="app_log_parse")  # fmt: skip
def _(x: Fixture):
    return control.app_log_parse(history(x).select(F.col("instance").alias("log_id"), F.col("application_log").alias("log")))


def _day(p: str) -> str:
    return f"strftime(DATE '1970-01-01' + CAST({p} AS INT), '%Y-%m-%d')"


def _days(title: str, periods: str) -> str:
    return f"CASE WHEN len({periods}) > 0 THEN '{title} ' || array_to_string(list_transform({periods}, lambda p: {_day('p')}), ', ') || chr(10) ELSE '' END"


#: The span of each request in the query: 30 periods from 0.
PROGRESS = BATCHES.replace("SELECT base || CASE", ", told AS (SELECT base || CASE", 1) + f"""),
listed AS (SELECT *, regexp_replace(type, '_new$', '') AS kind, CASE WHEN type LIKE '%\\_new' ESCAPE '\\' THEN 'new ' ELSE '' END AS fresh_word,
  CASE WHEN periods = '' THEN []::INT[] ELSE list_transform(string_split(periods, ':'), lambda p: CAST(p AS INT)) END AS good,
  CASE WHEN failed_periods = '' THEN []::INT[] ELSE list_sort(list_transform(string_split(failed_periods, ':'), lambda p: CAST(p AS INT))) END AS bad FROM told),
spans AS (SELECT *, list_filter(range(coalesce(old_greatest_period + 1, 0), CASE WHEN kind = 'processing' THEN greatest_period ELSE 29 END + 1), lambda p: NOT list_contains(good, p) AND NOT list_contains(bad, p)) AS skipped FROM listed)
SELECT instance, CASE WHEN kind = 'poll_request' THEN 'Accepted a new report 1970-01-01 to 1970-01-30' || chr(10) ELSE
  CASE WHEN kind = 'processing' THEN 'Processing a ' || fresh_word || 'report 1970-01-01 to 1970-01-30, ' || printf('%.2f', 100.0 * (greatest_period + 1) / 30) || '% done, ' || (greatest_period + 1) || ' out of 30' || chr(10)
    ELSE CASE WHEN kind = 'report' THEN 'Finished' ELSE 'Canceled' END || ' a ' || fresh_word || 'report 1970-01-01 to 1970-01-30' || chr(10) END
  || {_days('Successful dates:', 'good')} || {_days('Failed dates:', 'bad')} || {_days('Skipped dates:', 'skipped')}
  || CASE WHEN anomalies = '' THEN '' ELSE 'Anomalies: ' || replace(replace(replace(anomalies, ':', ' '), 'poll_request_failed', 'Failed to poll a new request;'), 'cancel_failed', 'Failed to cancel a report;') || chr(10) END END AS text FROM spans"""


@query(PROGRESS, name="progress_report_text")
def _(x: Fixture):
    """One text for each request of the history that has something new."""
    rows = control.group_batches(control.instances_normalise(history(x)), LAST_SEEN)
    return control.progress_texts(rows.withColumns({"first": F.lit(0), "last": F.lit(29)})).select("instance", "text")


@query("SELECT period, n AS done, printf('%.2f', 100.0 * n / 30) AS percent FROM (SELECT period, row_number() OVER (ORDER BY period) AS n FROM (SELECT DISTINCT period FROM fx_h) z) q", name="progress_percent")
def _(x: Fixture):
    from pyspark.sql import Window

    n = F.row_number().over(Window.orderBy("period")).cast("bigint")
    return x.h.select("period").distinct().select("period", n.alias("done")).withColumn("percent", control.progress_percent(F.col("done"), F.lit(30)))


SOME = "(SELECT DISTINCT period FROM fx_h WHERE period % 3 <> 0) d"


@query(f"SELECT CAST(p AS INT) AS period FROM (SELECT unnest(range({LAST_PERIOD - 40}, {LAST_PERIOD + 1})) AS p) z WHERE p NOT IN (SELECT period FROM {SOME})", name="report_skipped_set")
def _(x: Fixture):
    return control.report_skipped_set(x.h.where("period % 3 != 0").select("period").distinct(), LAST_PERIOD - 40, LAST_PERIOD)


@query(f"SELECT period FROM {SOME} WHERE period BETWEEN {LAST_PERIOD - 10} AND {LAST_PERIOD - 2} ORDER BY 1", name="schedule_periods")
def _(x: Fixture):
    return control.schedule_periods(x.h.where("period % 3 != 0").select("period"), LAST_PERIOD - 10, LAST_PERIOD - 2)


@query("SELECT coalesce(max(period), -1) AS max_period FROM fx_h", name="max_available_period")
def _(x: Fixture):
    return control.max_available_period(x.h.select("period"))


ALL_TEXT = f"SELECT CAST(id AS VARCHAR) AS id, tile_e, tile_n, {SUMS} FROM h_dedup GROUP BY {KEYS}"


@query(ALL_TEXT, name="streaming_ingest")
def _(x: Fixture):
    """All periods' files as a stream into a session, in three arrivals; what is in its state then."""
    folder = workspace(x.spark, "landing")
    days = x.h.withColumn("id", F.col("id").cast("string"))
    periods = sorted(r["period"] for r in days.select("period").distinct().collect())  # 30
    areas, residents = workspace(x.spark, "areas"), workspace(x.spark, "residents")
    x.areas.coalesce(1).orderBy("id", *TILE).withColumn("line_no", F.monotonically_increasing_id()).write.parquet(areas)
    x.residents.write.parquet(residents)
    s = session.ReportSession(x.spark, workspace(x.spark, "session"), workspace(x.spark, "out"), x.params)
    s.poll([session.Request(periods[0], periods[-1] + 1, areas, residents)])
    mark, parts = workspace(x.spark, "stream"), workspace(x.spark, "parts")
    days.select("id", *TILE, *VALUES, "period").repartition("period").write.partitionBy("period").option("header", True).csv(parts)
    for k in range(3):
        for p in periods[k * len(periods) // 3 : (k + 1) * len(periods) // 3]:
            _as_file(x.spark, f"{parts}/period={p}", f"{folder}/day-{p}-updates.csv")
        ingest.ingest_stream(ingest.footprint_stream(x.spark, folder, files=len(periods)), s, mark).awaitTermination()
    return s.state()


@query(ALL_TEXT, name="streaming_fold")
def _(x: Fixture):
    """All periods' files as a stream in three arrivals, folded by keyed state."""
    folder, out, mark, parts = (workspace(x.spark, name) for name in ("landing", "out", "stream", "parts"))
    days = x.h.withColumn("id", F.col("id").cast("string"))
    periods = sorted(r["period"] for r in days.select("period").distinct().collect())  # 30
    days.select("id", *TILE, *VALUES, "period").repartition("period").write.partitionBy("period").option("header", True).csv(parts)
    for k in range(3):
        for p in periods[k * len(periods) // 3 : (k + 1) * len(periods) // 3]:
            _as_file(x.spark, f"{parts}/period={p}", f"{folder}/day-{p}-updates.csv")
        keyed.fold_stream(ingest.footprint_stream(x.spark, folder, files=len(periods)), out, mark).awaitTermination()
    return keyed.folded_state(x.spark, out)


def _as_file(spark: SparkSession, part_folder: str, to: str) -> None:
    """The one part of a written folder under a name of its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(to).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(to).getParent())
    part = next(p for p in (f.getPath() for f in fs.listStatus(path(part_folder))) if p.getName().startswith("part-"))
    fs.rename(part, path(to))


# --- comparison


@query("SELECT user_id AS pseudonym, line_no, sum(c) OVER (ORDER BY line_no) AS id FROM (SELECT *, CAST(coalesce(CAST(user_id <> lag(user_id) OVER (ORDER BY line_no) AS INT), 1) AS BIGINT) AS c FROM (SELECT user_id, event_id AS line_no FROM events) e) z".replace("sum(c) OVER (ORDER BY line_no)", "CAST(sum(c) OVER (ORDER BY line_no) AS BIGINT)"), name="sequential_ids")
def _(x: Fixture):
    return compare.sequential_ids(x.table("events").select(F.col("user_id").alias("pseudonym"), F.col("event_id").alias("line_no")))


@query(f"SELECT {KEYS} FROM ((SELECT {KEYS} FROM old_s EXCEPT ALL SELECT {KEYS} FROM last_h) UNION ALL (SELECT {KEYS} FROM last_h EXCEPT ALL SELECT {KEYS} FROM old_s)) z", name="symmetric_diff")
def _(x: Fixture):
    return compare.symmetric_diff(x.old_s.select("id", *TILE), x.last_h.select("id", *TILE))


# --- synthetic data


@query("SELECT tile_e, tile_n, population, round(sum(population) OVER (ORDER BY tile_e, tile_n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(population) OVER (), 6) AS cdf FROM tiles", name="population_cdf")
def _(x: Fixture):
    return report.rounded(synth.population_cdf(x.tiles), "cdf")


AROUND = "(SELECT sum(d.population) FROM dense d WHERE abs(d.tile_e - t.tile_e) <= {r} AND abs(d.tile_n - t.tile_n) <= {r})"


@query("SELECT a.tile_e, a.tile_n, sum(b.population) AS sat FROM dense a JOIN dense b ON b.tile_e <= a.tile_e AND b.tile_n <= a.tile_n GROUP BY 1, 2", name="summed_area_table")
def _(x: Fixture):
    return synth.summed_area_table(x.tiles)


@query(f"SELECT tile_e, tile_n, {AROUND.format(r=1)} AS around FROM tiles t", name="population_around")
def _(x: Fixture):
    return synth.population_around(x.tiles, 1)


@query(f"SELECT tile_e, tile_n, CAST(min(CASE WHEN around >= 200 THEN r END) AS INT) AS rtile FROM (SELECT t.tile_e, t.tile_n, r, {AROUND.format(r='z.r')} AS around FROM tiles t CROSS JOIN (SELECT unnest(range(1, 9)) AS r) z) q GROUP BY 1, 2", name="find_rtile")
def _(x: Fixture):
    return synth.find_rtile(x.tiles, 200)


#: Suppliers strewn over a grid of some 200 x 180 tiles; radii go far beyond 64.
FAR = """(SELECT CAST(s_suppkey * 37 % 211 AS INT) AS tile_e, CAST((s_suppkey * 53 + s_nationkey) % 181 AS INT) AS tile_n,
  CAST(sum(abs(floor(s_acctbal))) AS DOUBLE) AS population FROM supplier GROUP BY 1, 2)"""


@query(f"""SELECT tile_e, tile_n, CAST(min(CASE WHEN around >= half THEN r END) AS INT) AS rtile FROM (
  SELECT a.tile_e, a.tile_n, greatest(abs(a.tile_e - b.tile_e), abs(a.tile_n - b.tile_n), 1) AS r, total / 2 AS half,
    sum(b.population) OVER (PARTITION BY a.tile_e, a.tile_n ORDER BY greatest(abs(a.tile_e - b.tile_e), abs(a.tile_n - b.tile_n), 1)) AS around
  FROM {FAR} a CROSS JOIN {FAR} b CROSS JOIN (SELECT sum(population) AS total FROM {FAR} c) d) z GROUP BY 1, 2""", name="find_rtile_far")
def _(x: Fixture):
    """The square with half of all people, around each of strewn tiles."""
    at = [(F.col("s_suppkey") * 37 % 211).cast("int").alias("tile_e"), ((F.col("s_suppkey") * 53 + F.col("s_nationkey")) % 181).cast("int").alias("tile_n")]
    tiles = x.table("supplier").groupBy(*at).agg(F.sum(F.abs(F.floor("s_acctbal"))).cast("double").alias("population"))
    half = tiles.agg(F.sum("population")).first()[0] / 2
    return synth.find_rtile(tiles, half)


SPOTS = "(SELECT s_suppkey AS id, CAST(s_suppkey % 7 AS INT) AS tile_e, CAST(s_nationkey % 6 AS INT) AS tile_n FROM supplier) q"


@query(f"SELECT id, tile_e, tile_n, population, population IS NOT NULL AS on_grid FROM {SPOTS} LEFT JOIN tiles USING (tile_e, tile_n)", name="grid_lookup")
def _(x: Fixture):
    spots = x.table("supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 7).cast("int").alias("tile_e"), (F.col("s_nationkey") % 6).cast("int").alias("tile_n"))
    good, bad = synth.grid_lookup(spots, x.tiles)
    out = good.withColumn("on_grid", F.lit(True)).unionByName(bad.withColumns({"population": F.lit(None).cast("double"), "on_grid": F.lit(False)}))
    return out.select("id", *TILE, "population", "on_grid")


@query(f"SELECT {KEYS}, sum(v) AS value_0, " + ", ".join(f"sum(CASE WHEN sub_period = {i} THEN v ELSE 0 END) AS value_{i}" for i in (1, 2, 3)) + f" FROM fx_obs GROUP BY {KEYS}", name="gen_day_rows")
def _(x: Fixture):
    return synth.gen_day_rows(x.obs.select("id", *TILE, "sub_period", "v"))


@query("SELECT CAST(id AS BIGINT) AS id, tile_e, tile_n, value_0 FROM last_h UNION ALL SELECT id + k * 100000, tile_e, tile_n, value_0 FROM last_h CROSS JOIN (SELECT unnest(range(2)) AS k) z", name="duplicate_users")
def _(x: Fixture):
    return synth.duplicate_users(x.last_h.select("id", *TILE, "value_0"), 100000, 2)


USERS = "(SELECT DISTINCT user_id AS id FROM events) u"


@query(f"""SELECT CAST(id AS BIGINT) AS id, CAST(day AS INT) AS period, CAST(e AS INT) AS tile_e, CAST(n AS INT) AS tile_n, CASE WHEN inside THEN 1.0 ELSE 0.00003 END::DOUBLE AS value_0,
  CASE WHEN inside THEN 1.0::DOUBLE / 3 ELSE 0.00001::DOUBLE END AS value_1, CASE WHEN inside THEN 1.0::DOUBLE / 3 ELSE 0.00001::DOUBLE END AS value_2, CASE WHEN inside THEN 1.0::DOUBLE / 3 ELSE 0.00001::DOUBLE END AS value_3
  FROM {USERS} CROSS JOIN range(2) d(day) CROSS JOIN (SELECT e, n, (e - 2.5) * (e - 2.5) + (n - 2.5) * (n - 2.5) <= 4 AS inside FROM range(6) a(e) CROSS JOIN range(6) b(n)) c""", name="gen_circle")
def _(x: Fixture):
    return synth.gen_circle(x.spark, x.users, 2, 6, 2.0)


RANDOM = {
    "gen_simple": lambda x: synth.gen_simple(x.spark, x.users, 10),
    "gen_residents": lambda x: synth.gen_residents(x.spark, x.table("customer").select(F.col("c_custkey").alias("id"))),
    "gen_reference_areas": lambda x: synth.gen_reference_areas(x.spark, areas=x.areas.select("id").distinct()),
    "cdf_sample": lambda x: synth.cdf_sample(synth.population_cdf(x.tiles), x.users.count()),
    "gen_anchors": lambda x: synth.gen_anchors(synth.population_cdf(x.tiles), x.users.count()),
    "gen_user_data": lambda x: synth.gen_user_data(synth.population_cdf(x.tiles), x.users.count(), 30),
    "tile_offsets": lambda x: synth.tile_offsets(x.last_h),
    "fill_subperiods": lambda x: synth.fill_subperiods(x.last_h),
}
for _name, _make in RANDOM.items():
    query(name=_name)(_make)


# --- presentation


@query(f"SELECT t.tile_e, t.tile_n, coalesce(p.value, 0) AS value FROM tiles t LEFT JOIN ({P_SDC}) p USING (tile_e, tile_n)", name="report_on_map")
def _(x: Fixture):
    return present.report_on_map(report.top_anchor_sdc(x.p, x.params), x.tiles, ["value"]).select(*TILE, "value")


def matrix(rows: str, box: str, value: str) -> str:
    return f"""SELECT e.tile_e, n.tile_n, r.{value} AS value FROM (SELECT CAST(unnest(generate_series(min(tile_e), max(tile_e))) AS INT) AS tile_e FROM {box}) e
CROSS JOIN (SELECT CAST(unnest(generate_series(min(tile_n), max(tile_n))) AS INT) AS tile_n FROM {box}) n LEFT JOIN {rows} r USING (tile_e, tile_n)"""


@query(f", z AS ({P_SDC}) " + matrix("z", "z", "value"), name="heatmap_matrix")
def _(x: Fixture):
    return present.heatmap_matrix(report.top_anchor_sdc(x.p, x.params), "value")


@query(operands("t.weight", "yw") + f", f AS ({STRENGTH}), z AS (SELECT * FROM f WHERE reference_area = 1) " + matrix("z", "f", "strength"), name="fuf_area_slice")
def _(x: Fixture):
    fuf = report.connection_strength(report.connection_operands(x.weighted, x.areas), x.params)
    return report.rounded(present.fuf_area_slice(fuf, 1), "value")


@query("SELECT tile_e, tile_n, value, CAST(ntile(5) OVER (ORDER BY value, tile_e, tile_n) AS INT) AS class FROM p", name="quantile_classes")
def _(x: Fixture):
    return present.quantile_classes(x.p, "value")
