"""Edges of the operators on hand-made tables."""

import math
import random

import pytest

from mosaique.operators import clean, compare, indicators, quantise, report, state, synth
from mosaique.params import Params
from mosaique.sources.files import area_steps, first_by_tile, validate_reference_areas

H = "id long, period int, tile_e int, tile_n int, value_0 double, value_1 double, value_2 double, value_3 double"
S = H.replace("period int, ", "")
P = Params(psi=10.0, phi=0.5, xi=2.0)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_drop_invalid(spark):
    bad = [(0.0, 0.0, 0.0, 0.0), (1.0, -1.0, 0.0, 0.0), (math.nan, 1.0, 0.0, 0.0), (math.inf, 0.0, 0.0, 0.0), (-0.0, 0.0, 0.0, 0.0), (1.0, 0.0, None, 0.0), (1.0, 0.0, 0.0, math.nan)]
    h = spark.createDataFrame([(i, 0, 0, 0, *v) for i, v in enumerate([*bad, (0.0, 1e-300, 0.0, 0.0)])], H)
    assert rows(clean.drop_invalid(h), "id") == [(len(bad),)]


def test_dedup_takes_the_maximum_of_each_value_and_periods_sum(spark):
    h = spark.createDataFrame([(1, 5, 0, 0, 1.0, 0.0, 3.0, 0.0), (1, 5, 0, 0, 0.0, 2.0, 1.0, 0.0), (1, 5, 0, 0, -9.0, 99.0, 0.0, 0.0), (1, 6, 0, 0, 1.0, 1.0, 1.0, 1.0)], H)
    assert rows(clean.dedup_max(clean.drop_invalid(h), "period"), "period", "value_0", "value_1", "value_2") == [(5, 1.0, 2.0, 3.0), (6, 1.0, 1.0, 1.0)]
    assert rows(state.fold(h), "value_0", "value_1", "value_2", "value_3") == [(2.0, 3.0, 4.0, 1.0)]
    assert clean.duplicate_count(h, "period").first()[0] == 1


def test_merge_forms_agree(spark):
    a = spark.createDataFrame([(1, 0, 0, 1.0, 0.0, 0.0, 0.0), (2, 0, 0, 2.0, 1.0, 0.0, 0.0)], S)
    b = spark.createDataFrame([(2, 0, 0, 3.0, 0.0, 1.0, 0.0), (3, 0, 0, 4.0, 0.0, 0.0, 0.0)], S)
    none = spark.createDataFrame([], S)
    for x, y in ((a, b), (none, b), (a, none), (none, none)):
        assert rows(state.merge(x, y), "*") == rows(state.merge_outer_join(x, y), "*")
    assert rows(state.classes(a, b), "id", "class") == [(1, "unchanged"), (2, "updated"), (3, "new")]


def test_quantise_edges(spark):
    s = spark.createDataFrame([(1, 0, 0, 9.999, 0.0, 0.0, 0.0), (1, 0, 1, 10.0, 4.999, 5.0, 5.001), (2, 0, 0, 9.0, 0.0, 0.0, 0.0)], S)
    y = quantise.quantise(s, P)
    assert rows(y, "id", "tile_n", "q0", "q1", "q2", "q3", "rank") == [(1, 1, 1, 0, 1, 1, 0)]
    assert quantise.highly_nomadic_users(s, P).first()[0] == 1
    assert quantise.highly_nomadic_users(s.limit(0), P).first()[0] == 0


def test_anchor_order(spark):
    s = spark.createDataFrame([(1, 0, 0, 20.0, 5.0, 9.0, 0.0), (1, 0, 1, 20.0, 9.0, 5.0, 0.0), (1, 0, 2, 20.0, 0.0, 0.0, 8.0), (1, 1, 0, 30.0, 0.0, 0.0, 0.0), (1, 0, 3, 20.0, 9.0, 5.0, 0.0)], S)
    y = quantise.quantise(s, P)
    assert [tuple(r) for r in y.orderBy("rank").select("tile_e", "tile_n").collect()] == [(1, 0), (0, 1), (0, 3), (0, 0), (0, 2)]


def test_weights(spark):
    p = spark.createDataFrame([(0, 0, 9), (0, 1, 10), (0, 2, 10), (0, 3, 10), (0, 4, 100), (0, 5, 9), (0, 6, 10)], "tile_e int, tile_n int, value long")
    r = spark.createDataFrame([(0, 0, 9.0), (0, 1, 2.0), (0, 2, 2.001), (0, 3, 100.0), (0, 4, 999.0)], "tile_e int, tile_n int, value double")
    got = dict(rows(report.calibration_weights(p, r, P), "tile_n", "weight"))
    assert got == {0: 1.0, 1: 0.2, 2: pytest.approx(0.2001), 3: 10.0, 4: pytest.approx(9.99), 5: 1.0, 6: 0.2}


def test_disclosure(spark):
    d = spark.createDataFrame([(0, 0, 1.999, 2.0, 0.0, 5.0), (0, 1, 0.0, 0.0, 0.0, 1.0)], "tile_e int, tile_n int, value_0 double, value_1 double, value_2 double, value_3 double")
    assert rows(report.total_footprint_sdc(d, P), "*") == [(0, 0, 0.0, 2.0, 0.0, 5.0), (0, 1, 0.0, 0.0, 0.0, 0.0)]
    p = spark.createDataFrame([(0, 0, 1), (0, 1, 2)], "tile_e int, tile_n int, value long")
    assert rows(report.top_anchor_sdc(p, P), "tile_n") == [(1,)]


def _random_state(spark, users=60, seed=1):
    r = random.Random(seed)
    data = {}
    for u in range(users):
        for _ in range(r.randint(1, 6)):
            v = [float(r.randint(0, 20)) for _ in range(3)]
            data[u, r.randint(0, 3), r.randint(0, 3)] = (sum(v), *v)
    return spark.createDataFrame([(*k, *v) for k, v in data.items() if v[0] > 0], S)


def _areas(spark):
    return spark.createDataFrame([(0, 0, 0), (0, 0, 1), (1, 2, 2), (1, 3, 3)], "id int, tile_e int, tile_n int")


def test_strength_forms_agree_and_unit_weights_change_nothing(spark):
    s, areas = _random_state(spark), _areas(spark)
    y = quantise.quantise(s, P)
    weighted = report.user_weights(y, None)
    fast, slow = (report.connection_strength(f(weighted, areas), P) for f in (report.connection_operands, report.connection_operands_literal))
    assert rows(fast, "reference_area", "tile_e", "tile_n", "strength") == rows(slow, "reference_area", "tile_e", "tile_n", "strength")
    assert rows(report.total_footprint(y), "*") == rows(report.total_footprint_calibrated(weighted), "*")
    users = y.select("id").distinct().count()
    assert report.top_anchor_distribution(y).selectExpr("sum(value)").first()[0] == users
    assert s.select("id").distinct().count() == users + quantise.highly_nomadic_users(s, P).first()[0]


def test_strength_counts_users_that_touch_the_area_elsewhere(spark):
    s = spark.createDataFrame([(u, e, n, 10.0, 0.0, 0.0, 0.0) for u, e, n in ((1, 0, 0), (1, 5, 5), (2, 0, 1), (2, 5, 5), (3, 5, 5))], S)
    weighted = report.user_weights(quantise.quantise(s, P), None)
    got = rows(report.connection_strength(report.connection_operands(weighted, _areas(spark)), P), "reference_area", "tile_e", "tile_n", "strength")
    assert got == [(0, 5, 5, pytest.approx(2 / 3))]


def test_full_report_of_nothing(spark):
    r = report.full_report(spark.createDataFrame([], S), _areas(spark), spark.createDataFrame([], "tile_e int, tile_n int, value double"), P)
    assert r.fingerprint.count() == r.top_anchor.count() == r.fuf.count() == 0
    assert tuple(r.statistics.first()) == (0, 0, 0.0)


def test_fold_does_not_depend_on_the_order_of_periods(spark):
    h = spark.createDataFrame([(1, p, 0, 0, float(p), 1.0, 0.0, 0.0) for p in (1, 2, 3)], H)
    s = h.limit(0).drop("period")
    for p in (3, 1, 2):
        s = state.merge(s, clean.dedup_max(clean.drop_invalid(h.where(f"period = {p}"))))
    assert rows(s, "*") == rows(state.fold(h), "*")


def test_one_exchange_folds_periods(spark):
    h = spark.range(100).selectExpr("id % 7 as id", "1 as period", "0 as tile_e", "0 as tile_n", "1D as value_0", "0D as value_1", "0D as value_2", "0D as value_3")
    assert state.fold(h)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize(("ids", "ok"), [([0, 0, 1, 1, 2], True), ([1, 3], False), ([0, 2], False), ([0, 1, 0], False), ([], True)])
def test_area_ids(spark, ids, ok):
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id int, line_no long")
    assert validate_reference_areas(df) is ok
    assert area_steps(df).isEmpty() is ok


def test_first_census_row_wins(spark):
    df = spark.createDataFrame([(0, 0, 7.0, 1), (0, 0, 9.0, 0), (0, 1, 1.0, 2)], "tile_e int, tile_n int, value double, line_no long")
    assert rows(first_by_tile(df), "*") == [(0, 0, 9.0), (0, 1, 1.0)]


def test_boxes_and_centroids(spark):
    s = spark.createDataFrame([(1, 0, 0, 1.0, 1.0, 0.0, 0.0), (1, 3, 4, 1.0, 0.0, 0.0, 0.0)], S)
    assert rows(indicators.diagonals(s), "sub_period", "diagonal") == [(0, 5.0), (1, 0.0)]
    assert indicators.centroid_distances(s, s.limit(0)).count() == 0
    assert not indicators.gate_open(4999, 5000, 5) and indicators.gate_open(5000, 5000, 5)


def test_compare(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(compare.symmetric_diff(a, b), "x") == [(1,), (2,), (3,)]
    assert compare.tolerance_check(3, 0) and not compare.tolerance_check(4, 0) and compare.tolerance_check(4, 1)
    d = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2), ("a", 3)], "pseudonym string, line_no int")
    assert rows(compare.sequential_ids(d), "line_no", "id") == [(0, 1), (1, 1), (2, 2), (3, 3)]


def test_synthetic_invariants(spark):
    tiles = spark.createDataFrame([(0, 0, 5.0), (1, 2, 0.0), (2, 1, 15.0)], "tile_e int, tile_n int, population double")
    sat = {(e, n): v for e, n, v in rows(synth.summed_area_table(tiles), "*")}
    assert sat[2, 2] == 20.0 and sat[1, 1] == 5.0 and len(sat) == 9
    assert dict(((e, n), v) for e, n, v in rows(synth.population_around(tiles, 1), "*")) == {(0, 0): 5.0, (1, 2): 15.0, (2, 1): 15.0}
    got = synth.cdf_sample(synth.population_cdf(tiles), 2000)
    n = dict(((r["tile_e"], r["tile_n"]), r["count"]) for r in got.groupBy("tile_e", "tile_n").count().collect())
    assert set(n) == {(0, 0), (2, 1)} and sum(n.values()) == 2000 and 400 < n[0, 0] < 600
    g = synth.gen_simple(spark, 10, 3)
    assert g.count() == 60 and g.where("abs(value_0 - value_1 - value_2 - value_3) > 1e-9").count() == 0
    # By day, a user's tiles are a run on both shuffled axes; axes differ between days.
    runs = {}
    for r in synth.gen_simple(spark, 60, 2, size=5).collect():
        runs.setdefault(r["period"], set()).add((r["tile_e"], r["tile_n"]))
    assert all(0 <= e < 5 and 0 <= n < 5 for x in runs.values() for e, n in x) and len(runs[0]) > 15
    f = synth.fill_subperiods(g)
    assert f.where("value_0 < value_1 + value_2 + value_3 - 1e-9").count() == 0


def test_anchors(spark):
    """Night anchors by population, others on the grid near them at the tile's own scale, errors in their bounds, the same again."""
    people = {(e, n): 100.0 if 2 <= e <= 12 and 2 <= n <= 12 else 1.0 for e in range(15) for n in range(15)}
    tiles = spark.createDataFrame([(e, n, p) for (e, n), p in people.items()], "tile_e int, tile_n int, population double")
    radius = {(r["tile_e"], r["tile_n"]): r["rtile"] for r in synth.find_rtile(tiles, 900).collect()}
    cdf = synth.population_cdf(tiles)
    got = synth.gen_anchors(cdf, 300, candidates=3, least=900).collect()
    assert len(got) == 300 and len({r["id"] for r in got}) == 300
    for r in got:
        for name in ("night", "day", "third"):
            at = (int(r[name]["e"]), int(r[name]["n"]))
            assert at in people and 0.5 * radius[at] <= r[name]["error"] <= 2 * radius[at]
    far = [abs(r["day"]["e"] - r["night"]["e"]) / radius[int(r["night"]["e"]), int(r["night"]["n"])] for r in got]
    assert 0.4 < sum(far) / len(far) < 1.2  # the mean of a folded normal is 0.8
    assert sum(people[int(r["day"]["e"]), int(r["day"]["n"])] == 100 for r in got) > 280
    assert {tuple(r) for r in synth.gen_anchors(cdf.repartition(7), 300, candidates=3, least=900).collect()} == {tuple(r) for r in got}
