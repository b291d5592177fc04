"""Rows that weigh nothing or whose weight is unknown, against the SQL."""

import json
from datetime import datetime

import duckdb
from pyspark.sql import Row
from pyspark.sql import functions as F

from mosaique.operators import synth
from mosaique.plans.queries import QUERIES, SQL
from mosaique.streaming import keyed


def test_tiles_of_no_weight_have_day_rows(spark, tmp_path):
    """One user with a weight and a zero, one with a zero alone, one with a null alone, one with both."""
    seen = [(1, 5.0), (1, 0.0), (2, 0.0), (3, None), (4, None), (4, 0.004), (5, None), (5, 2.5)]
    rows = [(i, datetime(2024, 1, 1, 3 * i), u, "view", v, json.dumps({"k": 7})) for i, (u, v) in enumerate(seen)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    for t in ("customer", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    duck = duckdb.connect()
    for t in ("events", "customer", "nation"):
        duck.sql(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = QUERIES["gen_day_rows"](spark, str(tmp_path))
    want = duck.sql(SQL["gen_day_rows"])
    found = {r["id"]: tuple(r[c] for c in want.columns) for r in got.collect()}
    assert found == {r[0]: r for r in want.fetchall()} and sorted(found) == [1, 2, 3, 4, 5]


def test_day_rows_of_absent_sub_periods(spark):
    samples = spark.createDataFrame([("a", 0, 0, 2, 1.5), ("a", 0, 0, 2, 0.5), ("a", 0, 0, 3, 1.0), ("b", 1, 0, 1, 0.0)], "id string, tile_e int, tile_n int, sub_period int, v double")
    assert sorted(map(tuple, synth.gen_day_rows(samples).orderBy(F.col("id")).collect())) == [("a", 0, 0, 3.0, 0.0, 2.0, 1.0), ("b", 1, 0, 0.0, 0.0, 0.0, 0.0)]


def test_a_users_fold_reads_and_writes_its_state_once():
    """However many tiles a micro-batch has: each call to the store is a round trip."""
    calls, stored = [], []

    class Value:
        def get(self):
            calls.append("get")
            return stored[-1] if stored else None

        def update(self, value):
            calls.append("update")
            stored.append(value)

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    fold, row = keyed.UserFold(), Row("id", "tile_e", "tile_n", "value_0", "value_1", "value_2", "value_3", "period")
    fold.init(Handle())
    days = lambda *of: iter([row("a", e, 0, v, 0.0, v, 0.0, p) for p in of for e in range(40) for v in (1.0, 2.0)])
    list(fold.handleInputRows(("a",), days(2, 1), None))
    got = list(fold.handleInputRows(("a",), days(2, 3, 1), None))
    assert calls == ["get", "update"] * 2
    assert sorted(tuple(r) for r in got if not r["late"]) == [("a", e, 0, 6.0, 0.0, 6.0, 0.0, False, 3) for e in range(40)]
    assert len([r for r in got if r["late"] and r["period"] == 1]) == 80
