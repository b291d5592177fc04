"""Streaming ingest: a folder of footprint files as a stream, one session step for a micro-batch, or for each of its periods."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mosaique.functions.storage import Lease
from mosaique.plans.session import InvalidRequest, Outcome, ReportSession, lease_of
from mosaique.schemas import H


def footprint_stream(spark: SparkSession, folder: str, files: int = 1) -> DataFrame:
    """H of the files day-<n>-updates.csv with their period, as they arrive."""
    rows = spark.readStream.schema(H).option("header", True).option("maxFilesPerTrigger", files).option("pathGlobFilter", "day-*-updates.csv").csv(folder)
    return rows.withColumn("period", F.regexp_extract(F.input_file_name(), r"day-(\d+)-updates\.csv", 1).cast("int"))


def ingest_stream(rows: DataFrame, session: ReportSession, checkpoint: str, late: Callable[[int, str], None] | None = None, lease: Lease | None = None, log: Callable[[int, Outcome], None] | None = None) -> StreamingQuery:
    """Starts the query, under the store's lease for as long as it runs. A batch's periods are merged in one step with one commit, or
    one by one where `log` takes each period's outcome with its application log. A period that the guard rejects (late, or ingested
    before a restart) is told to `late` and passed over, so a batch that is run again changes nothing. A query whose lease is over,
    and another driver's, fails."""
    lease = lease or lease_of(session, patience=10)  # of a query that is just ending
    number = lease.__enter__()
    try:
        session.take(number)
    except BaseException:
        lease.__exit__()
        raise

    def step(batch: DataFrame, _: int) -> None:
        lease.renew()
        batch = batch.persist()
        try:
            ready = []
            for p in sorted(r["period"] for r in batch.select("period").distinct().collect()):  # at most one period a file
                if not (why := session.refused(p)):
                    ready.append(p)
                elif late:
                    late(p, f"{InvalidRequest(why)}")
            if log or session.params.float32_state:
                for p in ready:
                    made = session.ingest(p, batch.where(F.col("period") == p).drop("period"))
                    if log:
                        log(p, made)
            elif ready:
                session.ingest_periods(batch, ready)
        finally:
            batch.unpersist()

    def ended(query: StreamingQuery) -> None:
        try:
            query.awaitTermination()
        finally:
            lease.__exit__()

    query = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    threading.Thread(target=ended, args=(query,), daemon=True).start()
    return query
