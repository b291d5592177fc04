"""What keeps work apart: ranges instead of one task, sums in any order, searches without a cap, masks of areas."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from mosaique.functions.exact import exact_sum
from mosaique.operators import compare, control, present, report, scan, state, synth
from mosaique.schemas import H


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables in as many ranges as there are partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("n", [0, 1, 500])
def test_running_sums_over_many_ranges(spark, n):
    rng = random.Random(1)
    data = [(i, rng.randint(-3, 9) if i % 5 else None, float(i % 7)) for i in range(n)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k int, v int, d double").repartition(3)
    got, totals = scan.running_sums(df, [F.desc("k")], {"a": F.col("v"), "b": F.col("d")})
    want, a, b = [], 0, 0.0
    for k, v, d in sorted(data, reverse=True):
        a, b = a + (v or 0), b + d
        want.append((k, v, d, a, b))
    assert rows(got, "k", "v", "d", "a", "b") == sorted(want) and totals == [a, b]
    assert "SinglePartition" not in plan(got)
    if n == 500:
        assert scan.ranged(df, "k").select(scan.RANGE).distinct().count() > 1


def test_no_query_of_an_order_has_one_task(spark):
    lines = spark.createDataFrame([(i, None if i % 11 == 0 else f"p{i // 3 % 5}") for i in range(300)], "line_no int, pseudonym string").repartition(5)
    got, want, last = compare.sequential_ids(lines), [], 0
    for i in range(300):
        same = i and i % 11 and (i - 1) % 11 and i // 3 % 5 == (i - 1) // 3 % 5
        last += not same
        want.append((i, last))
    assert rows(got, "line_no", "id") == want and "SinglePartition" not in plan(got)
    tiles = spark.createDataFrame([(i, 0, float(i % 13)) for i in range(103)], "tile_e int, tile_n int, population double")
    cdf = synth.population_cdf(tiles)
    assert "SinglePartition" not in plan(cdf) and max(r["cdf"] for r in cdf.collect()) == 1.0
    classes = present.quantile_classes(tiles, "population")
    order = sorted((i % 13, i) for i in range(103))
    size = [21, 21, 21, 20, 20]
    want = {i: c for c, i in zip([c + 1 for c, n in enumerate(size) for _ in range(n)], [i for _, i in order], strict=True)}
    assert {r["tile_e"]: r["class"] for r in classes.collect()} == want and "SinglePartition" not in plan(classes)
    assert [r["class"] for r in present.quantile_classes(tiles.where("tile_e < 3"), "population").orderBy("population").collect()] == [1, 2, 3]
    history = spark.createDataFrame([(i, i, i % 4 == 0, "report" if i % 10 == 0 else "h", i, 0) for i in range(100)], "instance int, period int, failed boolean, type string, application_log int, part int")
    batches = control.group_batches(history)
    assert batches.count() == 11 and "SinglePartition" not in plan(batches)


def test_exact_sums_do_not_depend_on_the_order(spark):
    rng = random.Random(2)
    data = [(i % 3, rng.choice([rng.uniform(-1e6, 1e6), rng.uniform(0, 1), rng.uniform(0, 1e-3), 0.1 * i])) for i in range(3000)]
    one = lambda d, n: {r["k"]: r["s"] for r in spark.createDataFrame(d, "k int, x double").repartition(n).groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    first = one(data, 1)
    rng.shuffle(data)
    assert one(data, 13) == first  # bit by bit
    for k, s in first.items():
        exact = sum(math.floor(Fraction(x) * 2**62) for g, x in data if g == k)
        assert abs(Fraction(s) - Fraction(exact, 2**62)) <= Fraction(math.ulp(s))
    assert one([(0, -0.75), (0, 0.5), (1, None)], 2) == {0: -0.25, 1: None}


def test_a_fold_is_the_same_in_any_order(spark):
    rng = random.Random(3)
    data = [(str(i % 5), 0, i % 2, rng.random() * 10, rng.random(), rng.random() / 1000, rng.random() * 1e5, i % 40) for i in range(2000)]
    fold = lambda n: rows(state.fold(spark.createDataFrame(data, f"{H}, period int").repartition(n)), "*")
    first = fold(1)
    rng.shuffle(data)
    assert fold(7) == first


def test_radii_beyond_any_cap(spark):
    people = [(0, 0, 10.0), (300, 5, 10.0), (0, 200, 0.0), (301, 5, 3.0)]
    tiles = spark.createDataFrame(people, "tile_e int, tile_n int, population double")
    for least in (1, 10, 11, 20, 21, 23, 24):
        want = []
        for e, n, _ in people:
            r = next((r for r in range(1, 400) if sum(p for x, y, p in people if max(abs(x - e), abs(y - n)) <= r) >= least), None)
            want.append((e, n, r))
        got = synth.find_rtile(tiles, least)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert synth.find_rtile(tiles.limit(0)).count() == 0
    assert rows(synth.find_rtile(tiles.limit(1), 11), "rtile") == [(None,)] and rows(synth.find_rtile(tiles.where("population = 3"), 3), "rtile") == [(1,)]


def test_anchors_of_a_sparse_grid_are_not_the_night_anchor(spark, monkeypatch):
    """Tiles far apart, so that nearly all draws miss; with few draws a round every user still gets hits of its own."""
    tiles = spark.createDataFrame([(40 * i, 40 * j, 5.0) for i in range(3) for j in range(3)], "tile_e int, tile_n int, population double")
    monkeypatch.setattr(synth, "TRIES", 1)
    got = synth.gen_anchors(synth.population_cdf(tiles), 20, candidates=2, least=40).collect()
    at = lambda p: (int(p["e"] // 1), int(p["n"] // 1))
    assert len(got) == 20 and all(at(r[c]) in {(40 * i, 40 * j) for i in range(3) for j in range(3)} for r in got for c in ("night", "day", "third"))
    assert all((r["day"]["e"], r["day"]["n"]) != (r["night"]["e"], r["night"]["n"]) != (r["third"]["e"], r["third"]["n"]) for r in got)


def test_area_masks(spark):
    y = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 1, 0, 1.0), ("b", 0, 0, 2.0), ("c", 5, 5, 4.0)], "id string, tile_e int, tile_n int, weight double")
    areas = spark.createDataFrame([(0, 0, 0), (63, 1, 0), (64, 0, 0), (127, 1, 0), (2, 9, 9)], "id int, tile_e int, tile_n int")
    assert rows(report.user_reference_areas(y, areas), "id", "area") == [("a", 0), ("a", 63), ("a", 64), ("a", 127), ("b", 0), ("b", 64)]
    assert rows(report.user_reference_area_list(y, areas), "id", "areas") == [("a", [0, 63, 64, 127])] * 2 + [("b", [0, 64]), ("c", [])]
    got = report.connection_operands(y, areas)
    assert rows(got, "*") == [(0, 1, 0, 1.0, 1.0), (63, 0, 0, 1.0, 3.0), (64, 1, 0, 1.0, 1.0), (127, 0, 0, 1.0, 3.0)]
    assert rows(report.connection_operands_literal(y, areas).where("num > 0"), "*") == rows(got, "*")
    with pytest.raises(Exception, match="out of range"):
        report.user_reference_areas(y, areas.withColumn("id", F.col("id") + 1)).collect()


def test_symmetric_difference_is_one_aggregation(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, s string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (2, "x"), (4, None)], "k int, s string")
    got = compare.symmetric_diff(a, b)
    assert plan(got).count("Exchange") == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, a.exceptAll(b).union(b.exceptAll(a)).collect()))
