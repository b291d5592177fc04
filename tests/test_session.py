"""The state machine, its scheduler, progress texts, sources and sinks, and streams."""

import os
import struct
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from mosaique.functions import crypto
from mosaique.functions.storage import FileSystem, Lease, LeaseHeld, workspace
from mosaique.operators import control, indicators, quantise, state
from mosaique.params import Params
from mosaique.plans.session import InvalidRequest, ReportSession, Request, lease_of, run_available, run_exclusively
from mosaique.schemas import INSTANCES, H
from mosaique.sources import files, sinks
from mosaique.streaming import ingest, keyed


def day(spark, *rows):
    return spark.createDataFrame([(str(i), e, n, v, v, 0.0, 0.0) for i, e, n, v in rows], H)


@pytest.fixture(scope="module")
def tables(spark):
    areas, residents = workspace(spark, "a"), workspace(spark, "r")
    spark.createDataFrame([(0, 0, 0, 0), (1, 1, 1, 1)], "id int, tile_e int, tile_n int, line_no long").write.parquet(areas)
    spark.createDataFrame([(0, 0, 5.0)], "tile_e int, tile_n int, value double").write.parquet(residents)
    return areas, residents


def new(spark):
    return ReportSession(spark, workspace(spark, "s"), workspace(spark, "o"), Params(psi=1.0))


def test_transitions(spark, tables):
    s = new(spark)
    with pytest.raises(InvalidRequest):
        s.ingest(1, day(spark))
    with pytest.raises(InvalidRequest):
        s.cancel()
    requests = [Request(5, 1, *tables), Request(1, 3, *tables)]
    out = s.poll(requests)
    assert s.awaiting_h and s.at["next"] == 1 and s.at["seen"] == 2 and out.text == (
        "Failed to look at NSI report request with data id 0, skipping.\n\tError message: the first period is after the last\n"
        "New NSI request arrived.\nWith calibration: true\nFirst period: 1, last period: 3\n"
    )
    with pytest.raises(InvalidRequest):
        s.poll(requests)
    s.ingest(2, day(spark, (7, 0, 0, 2.0)))
    for p in (1, 2, 4):  # late, again, beyond
        with pytest.raises(InvalidRequest, match=":AE01:"):
            s.ingest(p, day(spark))
    again = ReportSession(spark, s.store.root, s.out, s.params)  # another driver goes on from the manifest
    assert again.at == s.at
    out = again.ingest(3, day(spark, (7, 0, 0, 1.0), (8, 1, 1, 4.0)))
    assert not again.awaiting_h and out.folder.endswith("1970-01-02-1970-01-04")
    back = spark.read.csv(out.folder + "/fingerprint_report.csv", header=True)
    assert back.columns == ["tile_e", "tile_n", "value_0", "value_1", "value_2", "value_3"] and back.count() == 2


def test_business_cycle(spark, tables, monkeypatch):
    """Keys, pseudonyms, a skipped and a bad period, indicators behind their gate, the report, and the progress texts."""
    keys = crypto.KeyTable(spark, workspace(spark, "keys"))
    made = {p: keys.generate(p) for p in (18630, 18632, 18633)}
    assert crypto.KeyTable(spark, keys._files.folder).list() == sorted(made.items())
    with pytest.raises(ValueError, match="already"):
        crypto.KeyTable(spark, keys._files.folder).generate(18630)
    s = ReportSession(spark, workspace(spark, "s"), workspace(spark, "o"), Params(psi=1.0, k=0), keys)
    s.poll([Request(18629, 18633, *tables)])

    def h(period, *rows):
        own = spark.createDataFrame([(i, e, n, v, v, 0.0, 0.0) for i, e, n, v in rows], "id long, tile_e int, tile_n int, value_0 double, value_1 double, value_2 double, value_3 double")
        return own.withColumn("id", crypto.pseudonymise(crypto.hash_number(F.col("id")), made[period]))

    first = s.ingest(18630, h(18630, (7, 0, 0, 2.0), (7, 0, 0, 3.0), (8, 1, 1, 4.0), (9, 1, 1, -1.0)), "a day's file")
    lines = first.text.split("\n")
    assert first.text.startswith(
        "\nH metadata:\na day's file\nWith calibration: true\nFirst period: 18629, last period: 18633\nExpected next period: 18629\nSkipped period 18629\n\n"
        "Number of duplicate records in the H file: 1\n\n"
        "H:\n\tNumber of unique users in file: 2\n\tNumber of records in file: 2\n\tHistogram of Number of records per user:\n\t\t < 1: 0 (0.0 %)\n\t\t < 2: 2 (100.0 %)\n"
    )
    assert "\t1100: 2" in lines and "Old S:" in lines and lines[-2].startswith("Runtime of enclave (not trustworthy): ") and first.counts == {"valid": 3, "h": 2, "s_new": 2}
    assert "Histogram of user tiles bounding box diagonal length difference between old S and new S in subperiod 3:" in lines
    with pytest.raises(KeyError):  # no key
        s.ingest(18631, h(18630, (7, 0, 0, 1.0)))
    with pytest.raises(Exception, match="does not verify"):  # another period's key
        s.ingest(18632, h(18633, (7, 0, 0, 1.0)))
    assert s.at["periods"] == [18630]
    closed = ReportSession(spark, s.store.root, s.out, Params(psi=1.0, k=20), keys)
    out = closed.ingest(18633, h(18633, (7, 2, 0, 1.0), (7, 0, 0, 1.0)))
    assert "The indicators are omitted because the user count is too small.\n" in out.text and "Skipped period 18632\n" in out.text
    assert {(r["tile_e"], r["tile_n"]): r["value_0"] for r in out.report.fingerprint.collect()} == {(0, 0): 1.0, (1, 1): 1.0, (2, 0): 1.0}
    assert [x for x in s.store._files() if x.startswith(("temporary", "state"))] == []
    logs = spark.createDataFrame([(0, first.text), (1, "Waited for new NSI request, nothing came, going back to sleep.\n"), (2, "x")], "log_id int, log string")
    got = {r["log_id"]: tuple(r)[1:] for r in control.app_log_parse(logs).collect()}
    assert got == {0: ("running", 18629, 18633, 18630), 1: ("no_request", -1, -1, -1), 2: ("invalid", -1, -1, -1)}


@pytest.mark.parametrize("scheme", ["file", "hdfs", "object store"])
def test_a_file_is_created_once(spark, scheme):
    """By a link, by a rename that doesn't overwrite, and by a create that fails where there is one."""
    files = FileSystem(spark, workspace(spark, "small"))
    files.scheme = scheme
    assert files.create("a", b"1") and not files.create("a", b"2") and files.read("a") == b"1" and files.names() == ["a"]
    files.put("a", b"3")
    assert files.read("a") == b"3"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: files.create("b", str(k).encode()), range(24)))
    assert scheme != "file" or made.count(True) == 1


def test_lease(spark):
    folder = workspace(spark, "lease")
    with Lease(spark, folder) as number:
        assert number == 1
        with pytest.raises(LeaseHeld, match="another run"), Lease(spark, folder):
            pass
    with Lease(spark, folder) as number:
        assert number == 2
    dead = Lease(spark, folder, seconds=0.5)  # its driver doesn't renew it any more
    assert dead.acquire() == 3
    with Lease(spark, folder, seconds=0.9, patience=5) as number:
        assert number == 4
        with pytest.raises(LeaseHeld):
            dead.renew()
        dead.release()  # is not its own any more
        time.sleep(1.5)
        with pytest.raises(LeaseHeld), Lease(spark, folder):  # renewed meanwhile
            pass


def test_a_session_that_has_missed_a_commit_is_refused(spark, tables):
    """Two sessions on one store: the second has read the state before the first went on."""
    a = new(spark)
    a.poll([Request(1, 9, *tables)])
    b = ReportSession(spark, a.store.root, a.out, a.params)
    a.ingest(1, day(spark, (7, 0, 0, 2.0)))
    a.ingest(2, day(spark, (8, 1, 1, 3.0)))
    with pytest.raises(sinks.StaleSession):
        b.ingest(3, day(spark, (7, 0, 0, 4.0)))
    assert b.at == a.at == a.store.manifest() and a.at["periods"] == [1, 2]
    b.ingest(3, day(spark, (7, 0, 0, 4.0)))  # it has read anew
    with pytest.raises(sinks.StaleSession):
        a.cancel()
    assert b.at["periods"] == [1, 2, 3] and {(r["id"], r["value_0"]) for r in b.state().collect()} == {("7", 6.0), ("8", 3.0)}
    named = {p.split("/")[0] for p in b.at["state"]["buckets"].values()} | {b.at["state"]["stats"]}
    assert {x for x in b.store._files() if x.startswith(("state-", "stats-", "temporary-"))} == named  # nothing else is left


def test_a_driver_that_wakes_late_is_refused(spark, tables):
    late = new(spark)
    late.poll([Request(1, 9, *tables)])
    first = lease_of(late, seconds=0.3)
    late.take(first.acquire())
    time.sleep(0.5)
    other = ReportSession(spark, late.store.root, late.out, late.params)
    with lease_of(other) as number:
        other.take(number)  # has done nothing yet
        for _ in range(2):  # nor after it has read anew
            with pytest.raises(sinks.StaleSession):
                late.ingest(1, day(spark, (7, 0, 0, 2.0)))
        with pytest.raises(sinks.StaleSession):
            run_available(late, [], [1], lambda p: day(spark, (7, 0, 0, 2.0)))
        with pytest.raises(LeaseHeld):
            run_exclusively(late, [], [1], lambda p: day(spark))
        other.ingest(1, day(spark, (8, 0, 0, 2.0)))
    assert run_exclusively(late, [], [2], lambda p: day(spark, (8, 0, 0, 1.0))) == [("ingested", 2)]
    assert [tuple(r)[:4] for r in late.state().collect()] == [("8", 0, 0, 3.0)]


def test_a_report_is_published_once_its_commit_is_made(spark, tables, monkeypatch):
    s = new(spark)
    s.poll([Request(1, 1, *tables)])
    b = ReportSession(spark, s.store.root, s.out, s.params)
    monkeypatch.setattr(s, "_publish", lambda: (_ for _ in ()).throw(KeyboardInterrupt))  # the driver dies behind its commit
    with pytest.raises(KeyboardInterrupt):
        s.ingest(1, day(spark, (7, 0, 0, 2.0)))
    names = FileSystem(spark, s.out).names
    assert names() == []
    with pytest.raises(sinks.StaleSession):  # a session behind makes no second report
        b.ingest(1, day(spark, (9, 0, 0, 2.0)))
    ReportSession(spark, s.store.root, s.out, s.params)
    assert names() == ["1970-01-02-1970-01-02"]
    again = ReportSession(spark, s.store.root, s.out, s.params)
    again.poll([Request(1, 1, *tables)] * 2)
    with pytest.raises(ValueError, match="there is a report"):
        again.ingest(1, day(spark, (7, 0, 0, 2.0)))
    assert again.awaiting_h


def test_a_period_touches_its_users_buckets_alone(spark, tables):
    """The state isn't exchanged, and buckets without a user of the period stay where they are; the log is that of the whole state."""
    s = ReportSession(spark, workspace(spark, "s"), workspace(spark, "o"), Params(psi=1.0, k=0), buckets=8)
    s.poll([Request(1, 9, *tables)])
    every = [(i, i % 3, i % 4, 1.0 + i) for i in range(40)]
    s.ingest(1, day(spark, *every))
    before = s.at["state"]
    assert len(before["buckets"]) == 8
    out = s.ingest(2, day(spark, (5, 2, 1, 7.0), (5, 9, 9, 1.0), (41, 0, 0, 1.0)))
    of = {r["id"]: str(r["b"]) for r in spark.createDataFrame([("5",), ("41",)], "id string").withColumn("b", state.bucket_of(8)).collect()}
    after = s.at["state"]
    assert {b for b in after["buckets"] if after["buckets"][b] != before["buckets"].get(b)} == {*of.values()}
    want = {(str(i), e, n): v for i, e, n, v in every} | {("5", 2, 1): 13.0, ("5", 9, 9): 1.0, ("41", 0, 0): 1.0}
    assert {tuple(r)[:3]: r["value_0"] for r in s.state().collect()} == want and out.counts["s_new"] == 42
    with sinks.Temporary(s.store) as keep, sinks.settings(spark, sinks.AS_BUCKETS):
        some = keep.buckets(after, [int(of["5"])])
        assert some.count() == spark.createDataFrame([(k[0],) for k in want], "id string").where(state.bucket_of(8) == int(of["5"])).count()
        plan = state.merge_buckets(some, day(spark, (5, 2, 1, 7.0)), 8)._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("Bucketed: true")
        assert "ShuffledHashJoin" in plan and plan.count("Exchange") == 1 and plan.index("Exchange") > scan  # that of the period
        assert "Sort " not in plan
        old, new_, h = keep(day(spark, *every)), keep(s.store.read(after)), keep(day(spark, (5, 2, 1, 7.0), (5, 9, 9, 1.0), (41, 0, 0, 1.0)))
        whole = indicators.log_text(h, old, new_, 0, 0)
    assert whole.removesuffix("\n") in out.text


def test_the_report_of_a_bucketed_state_has_one_exchange_less(spark, tables):
    s = ReportSession(spark, workspace(spark, "s"), workspace(spark, "o"), Params(psi=1.0), buckets=4)
    s.poll([Request(1, 9, *tables)])
    s.ingest(1, day(spark, (7, 0, 0, 2.0)))
    with sinks.Temporary(s.store) as keep:
        plan = quantise.quantise(keep.buckets(s.at["state"]), s.params)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


#: Arguments, status, outputs and error of a newest instance, and both predicates for a report that ends in period 5.
NEWEST = [
    ({"period": "5"}, "Failed", {}, None, True, False),
    ({"period": "4"}, "Failed", {}, None, False, False),
    ({"period": "x"}, "Failed", {}, None, False, False),
    ({"fingerprint_report": ""}, "Failed", {}, None, True, False),
    ({"cancel": "", "period": "5"}, "Failed", {}, None, False, False),
    ({}, "Failed", {}, None, False, False),
    ({"period": "5"}, "Finished", {"fingerprint_report": 3}, None, False, True),
    ({"period": "4"}, "Finished", {}, None, False, False),
    ({"cancel": ""}, "Finished", {}, None, False, True),
    ({"period": "5"}, "Failed", {}, ":AE01: not allowed", False, False),
]


@pytest.mark.parametrize("case", NEWEST)
def test_last_instance(spark, case):
    arguments, status, outputs, error, failed, ended = case
    rows = [(0, "Finished", [("period", "1")], [], None, None), (1, status, list(arguments.items()), list(outputs.items()), error, None)]
    instances = spark.createDataFrame(rows, INSTANCES)
    got = control.last_instance_predicates(instances, 5).first()
    assert (got["report_failed"], got["finished_or_canceled"]) == (failed, ended)
    assert control.last_instance_predicates(instances).first()["report_failed"] is False


def test_a_failed_period_changes_nothing(spark, tables):
    s = new(spark)
    s.poll([Request(1, 3, *tables)])
    s.ingest(1, day(spark, (7, 0, 0, 2.0)))
    before = dict(s.at)
    with pytest.raises(Exception, match="broken"):
        s.ingest(2, day(spark, (1, 0, 0, 1.0)).selectExpr("raise_error('broken') as id", "tile_e", "tile_n", "value_0", "value_1", "value_2", "value_3"))
    assert s.at == before == s.store.manifest()
    assert s.finish().report.statistics.first()["observed_total_users"] == 1


def test_finish_of_nothing_ends_in_cancel(spark, tables):
    s = new(spark)
    s.poll([Request(1, 3, *tables)])
    with pytest.raises(ValueError, match="no state"):
        s.finish()
    assert s.finish_or_cancel().text.startswith("The report generation process was canceled manually.With calibration: true\nFirst period: 1, last period: 3\n")
    assert not s.awaiting_h and s.poll([Request(1, 3, *tables)]).text == "Waited for new NSI request, nothing came, going back to sleep.\n"


def test_scheduler(spark, tables):
    """Ranges 0-5, 6-10 (closed by their last file), 12-17 (only a bad file), 20-21 (bad last file)."""
    bad = {4, 6, 17, 21}

    def read(p):
        if p in bad:
            raise ValueError("cannot decrypt")
        return day(spark, (p, 0, 0, 2.0))

    requests = [Request(a, b, *tables) for a, b in ((0, 5), (6, 10), (12, 17), (20, 21))]
    done = run_available(new(spark), requests, [1, 2, 4, 6, 8, 10, 17, 20, 21], read)
    assert done == [
        ("accepted", 0), ("ingested", 1), ("ingested", 2), ("failed", 4), ("finished", 5),
        ("accepted", 6), ("failed", 6), ("ingested", 8), ("ingested", 10), ("finished", 10),
        ("accepted", 12), ("failed", 17), ("canceled", 17),
        ("accepted", 20), ("ingested", 20), ("failed", 21), ("finished", 21),
    ]


#: A history: requests of periods 0 to 5 and 6 to 10, with a failed period, an invalid call and a failed finish.
HISTORY = [
    (0, "Finished", {}, {"application_log": 100}, None),
    (1, "Finished", {"period": "1"}, {"application_log": 101}, None),
    (2, "Finished", {"period": "2"}, {"application_log": 102}, None),
    (3, "Failed", {"period": "4"}, {}, "cannot decrypt"),
    (4, "Failed", {"period": "3"}, {}, ":AE01: invalid"),
    (5, "Failed", {"finish-report": ""}, {}, "empty"),
    (6, "Finished", {"finish-report": ""}, {"application_log": 103, "fingerprint_report": 7}, None),
    (7, "Finished", {}, {"application_log": 104}, None),
    (8, "Failed", {"period": "6"}, {}, "cannot decrypt"),
    (9, "Finished", {"period": "8"}, {"application_log": 105}, None),
    (10, "Finished", {"period": "10"}, {"application_log": 106, "fingerprint_report": 8}, None),
    (11, "Finished", {}, {"application_log": 107}, None),
    (12, "Finished", {"cancel": ""}, {"application_log": 108}, None),
]


def history(spark):
    return spark.createDataFrame([(i, s, list(a.items()), list(o.items()), e, None) for i, s, a, o, e in HISTORY], INSTANCES)


def test_batches_and_texts(spark):
    got = {r["instance"]: r for r in control.group_batches(control.instances_normalise(history(spark))).collect()}
    assert {k: r["type"] for k, r in got.items()} == {6: "report_new", 10: "report_new", 12: "canceled_new"}
    assert got[6]["periods"] == [2, 1] and got[6]["failed_periods"] == [4] and got[10]["periods"] == [10, 8] and got[10]["failed_periods"] == [6]
    assert {r["instance"] for r in control.group_batches(control.instances_normalise(history(spark)), 10).collect()} == {12}
    text = control.progress_text([
        {"type": "poll_request", "first": 6, "last": 10},
        {"type": "report_new", "first": 0, "last": 5, "greatest_period": 4, "old_greatest_period": None, "periods": [2, 1], "failed_periods": [4]},
        {"type": "processing", "first": 0, "last": 5, "greatest_period": 1, "old_greatest_period": None, "periods": [1], "failed_periods": [], "anomalies": ["cancel_failed", "poll_request_failed"]},
    ])
    assert text == (
        "Accepted a new report 1970-01-07 to 1970-01-11\n"
        "\nFinished a new report 1970-01-01 to 1970-01-06\nSuccessful dates: 1970-01-03, 1970-01-02\nFailed dates: 1970-01-05\nSkipped dates: 1970-01-01, 1970-01-04, 1970-01-06\n"
        "\nProcessing a report 1970-01-01 to 1970-01-06, 33.33% done, 2 out of 6\nSuccessful dates: 1970-01-02\nSkipped dates: 1970-01-01\n"
        "Anomalies: Failed to cancel a report; Failed to poll a new request;\n"
    )


def test_texts_as_columns_equal_those_on_the_driver(spark):
    cases = [
        {"type": "poll_request", "first": 6, "last": 10},
        {"type": "poll_request", "first": -1, "last": -1},
        {"type": "report_new", "first": 0, "last": 5, "greatest_period": 4, "old_greatest_period": None, "periods": [2, 1], "failed_periods": [4, 3]},
        {"type": "canceled", "first": 0, "last": 2, "greatest_period": None, "old_greatest_period": 2, "periods": [], "failed_periods": []},
        {"type": "processing_new", "first": 0, "last": 7, "greatest_period": 5, "old_greatest_period": 1, "periods": [5, 3], "failed_periods": [], "anomalies": ["cancel_failed", "poll_request_failed"]},
    ]
    names = ["type", "first", "last", "greatest_period", "old_greatest_period", "periods", "failed_periods", "anomalies"]
    filled = [tuple(c.get(n, [] if n in names[5:] else None) for n in names) for c in cases]
    rows = spark.createDataFrame(filled, "type string, first int, last int, greatest_period int, old_greatest_period int, periods array<int>, failed_periods array<int>, anomalies array<string>")
    got = [r["text"] for r in control.progress_texts(rows).collect()]
    assert got == [control.progress_text([dict(zip(names, c, strict=True))]) or None for c in filled]


def test_binary_files(spark, tmp_path):
    records = [(bytes([i] * 16), i, i + 1, 1.0 * i, 0.5, 0.25, 0.25) for i in range(100)]
    path = tmp_path / "day.hdata"
    path.write_bytes(b"".join(struct.pack("<16sHH4f", *r) for r in records))
    spark.dataSource.register(files.FootprintSource)
    own = spark.read.format("footprints").option("recordsPerPartition", 7).load(str(path))
    plain = files.read_footprints_binary(spark, str(path))
    for df in (own, plain):
        assert sorted(tuple([bytes(r[0]), *r[1:]]) for r in df.collect()) == records
    out = str(tmp_path / "packed")
    sinks.write_binary(own, out)
    for df in (files.read_footprints_binary(spark, out), spark.read.format("footprints").load(out)):
        assert sorted(tuple([bytes(r[0]), *r[1:]]) for r in df.collect()) == records
    with pytest.raises(Exception, match="16 bits"):
        sinks.write_binary(own.selectExpr("id", "70000 as tile_e", "tile_n", *(f"value_{i}" for i in range(4))), str(tmp_path / "beyond"))
    path.write_bytes(b"x" * 35)
    with pytest.raises(ValueError, match="whole records"):
        files.read_footprints_binary(spark, str(path))
    assert files.read_h_metadata(spark, str(path)) == ""


def test_a_bad_csv_row_fails(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b,c,d,e,f,g\n1,2,3,1,1,1,nope\n")
    with pytest.raises(Exception):
        files.read_footprints_csv(spark, str(path)).collect()


def test_limits():
    with pytest.raises(ValueError, match="areas"):
        sinks.check_request(0, 1, 129, 1, 1)
    with pytest.raises(ValueError, match="rows"):
        sinks.check_request(0, 1, 1, 1_000_001, 1)
    with pytest.raises(ValueError):
        Params(psi=0)


def test_keyed_fold_of_a_stream(spark, tmp_path, monkeypatch):
    """The fold of all files, with a restart in the middle of a batch; a batch writes its users alone; late rows lie apart."""
    folder, out, mark = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "mark")
    folder.mkdir()
    days = {1: [("a", 0, 0, 2.0), ("a", 0, 0, 3.0), ("b", 1, 1, 1.0)], 2: [("a", 0, 0, 1.0), ("a", 2, 0, 4.0)], 3: [("b", 1, 1, 0.5), ("c", 0, 0, -1.0)]}

    def arrive(name, rows, at):
        path = folder / name
        path.write_text("id,tile_e,tile_n,value_0,value_1,value_2,value_3\n" + "".join(f"{i},{e},{n},{v},{v},0,0\n" for i, e, n, v in rows))
        os.utime(path, (at, at))

    run = lambda: keyed.fold_stream(ingest.footprint_stream(spark, str(folder)), out, mark).awaitTermination()
    for p, rows_ in days.items():
        arrive(f"day-{p}-updates.csv", rows_, 1_700_000_000 + p)
    write, failed = keyed.write_part, []

    def die(batch, number, to):
        write(batch, number, to)
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("the driver died")

    monkeypatch.setattr(keyed, "write_part", die)
    with pytest.raises(Exception, match="the driver died"):
        run()
    run()
    of = lambda df: sorted(tuple(r)[:4] for r in df.collect())
    assert failed and of(keyed.folded_state(spark, out)) == [("a", 0, 0, 4.0), ("a", 2, 0, 4.0), ("b", 1, 1, 1.5)]
    assert {r["id"] for r in spark.read.parquet(f"{out}/batch=1").collect()} == {"a"}
    arrive("day-01-updates.csv", [("a", 0, 0, 9.0), ("d", 0, 0, 1.0)], 1_700_000_100)
    run()
    assert [(r["id"], r["value_0"], r["period"]) for r in keyed.late_rows(spark, out).collect()] == [("a", 9.0, 1)]
    assert of(keyed.folded_state(spark, out)) == [("a", 0, 0, 4.0), ("a", 2, 0, 4.0), ("b", 1, 1, 1.5), ("d", 0, 0, 1.0)]


def test_a_micro_batch_is_one_step(spark, tables, tmp_path):
    """All periods of a batch merge with one commit; period by period, for the logs, the state, its counts and the report are the same."""
    folder = tmp_path / "landing"
    folder.mkdir()
    days = {1: [("a", 0, 0, 2.0), ("a", 0, 0, 3.0), ("b", 1, 1, 1.0)], 2: [("a", 0, 0, 1.0), ("b", 0, 0, -1.0)], 3: [("c", 1, 1, 4.0)], 5: [("b", 1, 1, 0.5)], 9: [("x", 0, 0, 1.0)]}

    def arrive(*periods):
        for p in periods:
            (folder / f"day-{p}-updates.csv").write_text("id,tile_e,tile_n,value_0,value_1,value_2,value_3\n" + "".join(f"{i},{e},{n},{v},{v},0,0\n" for i, e, n, v in days[p]))

    def run(s, mark, **more):
        late = []
        ingest.ingest_stream(ingest.footprint_stream(spark, str(folder), files=9), s, mark, late=lambda p, why: late.append((p, why)), **more).awaitTermination()
        return late

    def counts(s):
        return sorted(map(tuple, spark.read.parquet(f"{s.store.root}/{s.at['state']['stats']}").collect()))

    one, each, logs = new(spark), new(spark), []
    for s in (one, each):
        s.poll([Request(2, 5, *tables)])
    arrive(1, 2, 3)
    before = one.at["version"]
    for s, mark, more in ((one, "one", {}), (each, "each", {"log": lambda p, out: logs.append((p, out.text))})):
        assert run(s, str(tmp_path / mark), **more) == [(1, ":AE01: period 1 is not in 2 to 5")]
    assert one.at["version"] == before + 2 and each.at["version"] == before + 3  # one for the lease
    assert (one.at["next"], one.at["periods"]) == (each.at["next"], each.at["periods"]) == (4, [2, 3])
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(one.state()) == rows(each.state()) == [("a", 0, 0, 1.0, 1.0, 0.0, 0.0), ("c", 1, 1, 4.0, 4.0, 0.0, 0.0)] and counts(one) == counts(each)
    assert [p for p, _ in logs] == [2, 3] and all(t for _, t in logs)
    with pytest.raises(InvalidRequest):
        one.ingest_periods(day(spark).withColumn("period", F.lit(3)), [3])
    arrive(5, 9)
    for s, mark, more in ((one, "one", {}), (each, "each", {"log": lambda p, out: logs.append((p, out.text))})):
        assert [p for p, _ in run(s, str(tmp_path / mark), **more)] == [9] and not s.awaiting_h
    reports = [spark.read.csv(f"{s.out}/1970-01-03-1970-01-06/fingerprint_report.csv", header=True) for s in (one, each)]
    assert rows(reports[0]) == rows(reports[1]) and reports[0].count() == 2
