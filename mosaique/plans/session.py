"""The state machine of report requests: accept, ingest periods in order, finish or cancel.

    awaiting request --poll--> awaiting H (next = first) --ingest p, next <= p < last--> same, state merged
    awaiting H --ingest last, or finish--> report, awaiting request        awaiting H --cancel--> awaiting request

Every step commits one manifest at its end. An exception leaves the last manifest, and so state and counter, as they were.
After period p the next one expected is p + 1, and the manifest lists the periods that are in the state, so that a period
can't be merged twice. A commit names the version that the session has read: where another session has committed since, it is
refused (StaleSession), what was made for it is removed, and the session reads anew. A report is written aside; the commit names
where it belongs, and it is moved there afterwards, by the next session if need be.

A period's merge reads and replaces the buckets of the state that its users are in, and no others. What the log says of the whole
state comes from counts that are kept for each bucket.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mosaique.functions.crypto import KeyTable, depseudonymise, lookup_key
from mosaique.functions.exact import exact_sum
from mosaique.functions.storage import FileSystem, Lease
from mosaique.operators import clean, control, indicators, state
from mosaique.operators.compare import inspect
from mosaique.operators.report import Report, full_report
from mosaique.params import Params
from mosaique.schemas import KEY, VALUES
from mosaique.sources.files import area_steps
from mosaique.sources.sinks import StaleSession, StateStore, Temporary, check_request, read_report, report_dir, write_report


class InvalidRequest(ValueError):
    """A call that the state does not allow; nothing changes."""

    def __init__(self, why: str):
        super().__init__(f":AE01: {why}")


@dataclass
class Request:
    """areas has id, tile and line_no; residents has tile and value. Paths are of Parquet tables, so that a manifest can name them."""

    first: int
    last: int
    areas: str
    residents: str
    with_calibration: bool = True


@dataclass
class Outcome:
    """log has the application log's lines, of which some have several; counts what the merge has seen."""

    log: list[str] = field(default_factory=list)
    report: Report | None = None
    folder: str | None = None
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def text(self) -> str:
        return "".join(f"{x}\n" for x in self.log)


def period_guard(period: int | Column, expected: int, last: int) -> bool | Column:
    """Whether a period may come now, of a number or of a column."""
    return (expected <= period) & (period <= last)


def arguments(r: Request) -> list[str]:
    return [f"{control.CALIBRATION}{'true' if r.with_calibration else 'false'}", f"{control.FIRST}{r.first}{control.LAST}{r.last}"]


def skipped_periods(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Periods from start up to but without end."""
    return spark.range(start, end).select(F.col("id").cast("int").alias("period"))


class ReportSession:
    """With keys (period, key), a period's ids are pseudonyms under its key; else they are ids as they stand. buckets: of the state
    of requests to come, as many as there are shuffle partitions unless given."""

    NEW = {"request": None, "next": None, "seen": 0, "state": None, "periods": [], "fence": 0, "publish": None, "version": -1}

    def __init__(self, spark: SparkSession, root: str, out: str, params: Params = Params(), keys: KeyTable | None = None, buckets: int | None = None):
        self.spark, self.out, self.params, self.keys = spark, out, params, keys
        self.store = StateStore(spark, root, buckets)
        self._read()
        self.fence = self.at["fence"]
        self._publish()

    @property
    def awaiting_h(self) -> bool:
        return self.at["request"] is not None

    def _read(self) -> None:
        self.at = self.NEW | (self.store.manifest() or {})

    def _commit(self, **changes) -> None:
        old, new = self.at, self.at | changes
        try:
            if new["fence"] > self.fence:
                raise StaleSession("a later lease is held")
            version = self.store.commit(new, old["version"])
        except StaleSession:
            self.store.drop_unused(new["state"], old["state"])
            self._read()
            raise
        self.at = new | {"version": version}
        self.store.drop_unused(old["state"], new["state"])

    def take(self, number: int) -> None:
        """Goes on from the newest manifest as the holder of this lease; sessions of earlier leases can't commit any more."""
        while True:
            self._read()
            self.fence = number
            try:
                self._commit(fence=max(number, self.at["fence"]))
                break
            except StaleSession:
                if self.at["fence"] > number:
                    raise
        self._publish()

    def _publish(self) -> None:
        """Moves a report that the manifest says is made to where it belongs."""
        if self.at["publish"]:
            made, to = self.at["publish"]
            files = FileSystem(self.spark, self.out)
            path = self.spark._jvm.org.apache.hadoop.fs.Path
            if files._fs.exists(path(made)):
                files._fs.rename(path(made), path(to))

    def _problem(self, r: Request) -> str | None:
        areas, residents = self.spark.read.parquet(r.areas), self.spark.read.parquet(r.residents)
        try:
            n = areas.agg(F.count("*").alias("n"), F.countDistinct("id").alias("k")).first()
            check_request(r.first, r.last, n["k"], n["n"], residents.count())
        except ValueError as e:
            return str(e)
        return None if area_steps(areas).isEmpty() else "reference area ids must begin at 0, be sorted and leave no gap"

    def poll(self, requests: list[Request]) -> Outcome:
        """Takes the first valid one of the requests that were not seen before."""
        if self.awaiting_h:
            raise InvalidRequest("a request is being worked on")
        out, seen = Outcome(), self.at["seen"]
        for r in requests[seen:]:
            seen += 1
            if problem := self._problem(r):
                out.log.append(f"{control.FAILED_REQUEST}{seen - 1}{control.FAILED_WHY}{problem}")
                continue
            out.log += [control.NEW_REQUEST, *arguments(r)]
            self._commit(request=r.__dict__, next=r.first, seen=seen, state=None, periods=[])
            return out
        if seen == self.at["seen"]:
            out.log.append(f"{control.NOTHING_NEW}.")
        else:
            out.log.append(control.NO_VALID)
        self._commit(seen=seen)
        return out

    def state(self) -> DataFrame:
        """All rows of the state that the manifest names."""
        return self.store.read(self.at["state"])

    def _finish(self, state: dict, out: Outcome) -> list[str]:
        """Makes the report of a state; where it is and where it belongs."""
        r = Request(**self.at["request"])
        params = Params(**(self.params.__dict__ | {"with_calibration": r.with_calibration}))
        areas, residents = self.spark.read.parquet(r.areas), self.spark.read.parquet(r.residents)
        to = report_dir(self.out, r.first, r.last)
        if FileSystem(self.spark, self.out)._fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(to)):
            raise ValueError(f"there is a report at {to}")
        with Temporary(self.store) as keep:
            made = full_report(keep.buckets(state), areas, residents, params, keep)
            return [write_report(made, self.out, r.first, r.last, f"{self.out.rstrip('/')}/.made-{uuid.uuid4().hex}"), to]

    def _close(self, report: list[str], out: Outcome) -> None:
        try:
            self._commit(request=None, next=None, state=None, periods=[], publish=report)
        except StaleSession:
            self.store.drop(report[0])
            raise
        self._publish()
        out.folder = report[1]
        out.report = read_report(self.spark, out.folder)

    def _ids(self, period: int, h: DataFrame) -> DataFrame:
        """h with ids as text: pseudonyms are reversed under the period's key, and one that does not verify fails the period."""
        if self.keys is None:
            return h.withColumn("id", F.col("id").cast("string"))
        key = lookup_key(self.keys.frame(self.spark), period)
        return h.withColumn("id", F.lower(F.hex(depseudonymise(F.col("id"), key))))

    def refused(self, period: int) -> str | None:
        """Why a period may not come now; None: it may."""
        if not self.awaiting_h:
            return "no request is being worked on"
        last = self.at["request"]["last"]
        allowed = period_guard(period, self.at["next"], last) and period not in self.at["periods"]
        return None if allowed else f"period {period} is not in {self.at['next']} to {last}"

    def ingest(self, period: int, h: DataFrame, metadata: str | None = None) -> Outcome:
        """Merges a period's rows; the last period also makes the report. The log has the request, what was skipped, and the
        indicators of the cleaned rows, the old and the new state."""
        if why := self.refused(period):
            raise InvalidRequest(why)
        r = Request(**self.at["request"])
        began, out = time.time(), Outcome()
        if metadata is not None:
            out.log.append(f"{control.METADATA}{metadata}")
        out.log += [*arguments(r), f"{control.EXPECTED}{self.at['next']}"]
        out.log += [f"{control.SKIPPED}{p}" for p in range(self.at["next"], period)]
        before = self.at["state"] or self.store.empty()
        with Temporary(self.store) as keep:
            valid, seen = inspect(clean.drop_invalid(self._ids(period, h)).where(F.col("id").isNotNull()), "valid")
            n, met = before["n"], Observation("h")
            ready = keep(clean.dedup_max(valid).observe(met, F.count(F.lit(1)).alias("h"), F.collect_set(state.bucket_of(n)).alias("touched")))
            touched = sorted(met.get["touched"] or [])  # n at most
            old = keep.buckets(before, touched)
            merged, after = inspect(state.merge_buckets(old, ready, n, self.params), "s_new")
            now, report = self.store.write(merged, before) if touched else before, None
            try:
                new = keep.buckets(now, touched)
                now, rest = self._counted(new, before, now, touched)
                untouched = sum(rest.get(("weight", 0), {}).values())
                out.counts = seen.get | {"s_new": (after.get["s_new"] if touched else 0) + untouched, "h": met.get["h"]}
                out.log.append(indicators.log_text(ready, old, new, out.counts["valid"] - out.counts["h"], self.params.k, rest).removesuffix("\n"))
                if period == r.last:
                    report = self._finish(now, out)
            except BaseException:
                self.store.drop_unused(now, before)
                raise
        if report:
            self.store.drop_unused(now, before)
            self._close(report, out)
        else:
            self._commit(next=period + 1, state=now, periods=[*self.at["periods"], period])
        out.log.append(f"{control.RUNTIME}{int(time.time() - began)}s")
        return out

    def ingest_periods(self, h: DataFrame, periods: list[int]) -> Outcome:
        """Merges the rows of several periods, all of which may come, as one step with one commit: the state (but for the last digit of a
        sum), its counts and the report are those of `ingest` period by period. Only the application log of each period isn't made,
        which tells of states in between. The state's rounding to floats goes period by period, so it needs `ingest`."""
        if self.params.float32_state:
            raise ValueError("a state of floats is merged period by period")
        for p in periods:
            if why := self.refused(p):
                raise InvalidRequest(why)
        last, out = self.at["request"]["last"], Outcome()
        before = self.at["state"] or self.store.empty()
        of = [self._ids(p, h.where(F.col("period") == p)) for p in periods] if self.keys else [self._ids(0, h.where(F.col("period").isin(periods)))]
        with Temporary(self.store) as keep:
            valid, seen = inspect(clean.drop_invalid(reduce(DataFrame.unionByName, of)).where(F.col("id").isNotNull()), "valid")
            n, met = before["n"], Observation("h")
            days = clean.dedup_max(valid, "period").groupBy(*KEY).agg(*(exact_sum(v).alias(v) for v in VALUES))
            ready = keep(days.observe(met, F.collect_set(state.bucket_of(n)).alias("touched")))
            touched = sorted(met.get["touched"] or [])  # n at most
            merged = state.merge_buckets(keep.buckets(before, touched), ready, n, self.params)
            now, report = self.store.write(merged, before) if touched else before, None
            try:
                now, _ = self._counted(keep.buckets(now, touched), before, now, touched)
                out.counts = dict(seen.get)
                if periods[-1] == last:
                    report = self._finish(now, out)
            except BaseException:
                self.store.drop_unused(now, before)
                raise
        if report:
            self.store.drop_unused(now, before)
            self._close(report, out)
        else:
            self._commit(next=periods[-1] + 1, state=now, periods=[*self.at["periods"], *periods])
        return out

    def _counted(self, new: DataFrame, before: dict, now: dict, touched: list[int]) -> tuple[dict, dict]:
        """The state with the counts of its buckets, and those counts of all buckets but the touched ones, added up."""
        counts, rest = indicators.bucket_counts(new, now["n"]), {}
        if {*map(int, before["buckets"])} - {*touched}:
            others = self.spark.read.parquet(f"{self.store.root}/{before['stats']}").where(~F.col("bucket").isin(touched))
            for x in others.groupBy("what", indicators.SUB, "bin").agg(F.sum("n").alias("n")).collect():  # some hundred bins
                rest.setdefault((x["what"], x[indicators.SUB]), {})[x["bin"]] = x["n"]
            counts = counts.unionByName(others)
        stats = f"stats-{uuid.uuid4().hex}"
        counts.write.parquet(f"{self.store.root}/{stats}")  # some hundred bins a bucket
        return now | {"stats": stats}, rest

    def finish(self) -> Outcome:
        if not self.awaiting_h:
            raise InvalidRequest("no request is being worked on")
        out = Outcome()
        if not (self.at["state"] and self.at["state"]["buckets"]):
            raise ValueError("there is no state to report on")
        self._close(self._finish(self.at["state"], out), out)
        return out

    def cancel(self) -> Outcome:
        if not self.awaiting_h:
            raise InvalidRequest("no request is being worked on")
        r = Request(**self.at["request"])
        self._commit(request=None, next=None, state=None, periods=[])
        first, *rest = arguments(r)
        return Outcome([control.CANCELED + first, *rest])

    def finish_or_cancel(self) -> Outcome:
        try:
            return self.finish()
        except (InvalidRequest, StaleSession):
            raise
        except Exception as e:  # whatever keeps a report from being made ends in a cancel
            out = self.cancel()
            out.log.append(f"Finish failed: {e}")
            return out


def run_exclusively(session: ReportSession, requests: list[Request], available: list[int], read: Callable[[int], DataFrame]) -> list[tuple[str, int | None]]:
    """run_available while no other driver works on the same store. A driver that loses its lease on the way is refused."""
    with lease_of(session) as number:
        session.take(number)
        return run_available(session, requests, available, read)


def lease_of(session: ReportSession, seconds: float = Lease.SECONDS, patience: float = 0) -> Lease:
    """The lease of a session's store."""
    return Lease(session.spark, f"{session.store.root}-lease", seconds, patience)


def run_available(session: ReportSession, requests: list[Request], available: list[int], read: Callable[[int], DataFrame]) -> list[tuple[str, int | None]]:
    """The scheduler: polls, ingests what is available in order, passes over periods that fail, and closes a report when
    the last period failed or newer data has come. Returns what was done."""
    done: list[tuple[str, int | None]] = []
    newest = max(available, default=-1)
    while True:
        if not session.awaiting_h:
            session.poll(requests)
            if not session.awaiting_h:
                return done
            done.append(("accepted", session.at["request"]["first"]))
        last, start = session.at["request"]["last"], session.at["next"]
        failed_last = False
        for p in sorted(x for x in set(available) if start <= x <= last):
            if not session.awaiting_h:
                break
            try:
                session.ingest(p, read(p))
                done.append(("ingested", p))
            except StaleSession:
                raise
            except Exception:  # a bad file is the period's failure, not the run's
                done.append(("failed", p))
                failed_last = p == last
        if session.awaiting_h:
            if newest <= last and not failed_last:
                return done
            had = session.at["state"] is not None
            out = session.finish_or_cancel()
            done.append(("finished" if had and out.report else "canceled", last))
        else:
            done.append(("finished", last))
