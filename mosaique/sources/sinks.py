"""Writers of reports and states."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaique.functions.dates import date_of
from mosaique.functions.storage import FileSystem
from mosaique.operators.report import Report
from mosaique.operators.state import bucket_of
from mosaique.params import MAX_AREA_ROWS, MAX_AREAS, MAX_RESIDENT_ROWS
from mosaique.schemas import FINGERPRINT, FUF, KEY, STATISTICS, TILE, TOP_ANCHOR, VALUES, S
from mosaique.sources.files import FootprintSource

COLUMNS = {
    "fingerprint_report": [*TILE, *VALUES],
    "top_anchor_distribution_report": [*TILE, "value"],
    "functional_urban_fingerprint_report": ["reference_area", *TILE, "strength"],
    "statistics": ["highly_nomadic_users", "observed_total_users", "adjusted_total_users"],
}


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows under a header; an empty table still has its header."""
    rows.write.mode(mode).option("header", True).csv(path)


def write_topic(rows: DataFrame, folder: str, topic: str) -> str:
    path = f"{folder}/{topic}.csv"
    write_csv(rows.select(COLUMNS[topic]), path)
    return path


def report_dir(out: str, first: int, last: int) -> str:
    return f"{out.rstrip('/')}/{date_of(first)}-{date_of(last)}"


def write_report(report: Report, out: str, first: int, last: int, folder: str | None = None) -> str:
    """All topics in the folder of the report's dates, or in one that is given."""
    folder = folder or report_dir(out, first, last)
    for topic, rows in zip(COLUMNS, (report.fingerprint, report.top_anchor, report.fuf, report.statistics), strict=True):
        write_topic(rows, folder, topic)
    return folder


def read_report(spark: SparkSession, folder: str) -> Report:
    """The report as it was written, which no longer needs the state it came from."""
    kinds = (FINGERPRINT, TOP_ANCHOR, FUF, STATISTICS)
    return Report(*(spark.read.schema(k).csv(f"{folder}/{topic}.csv", header=True) for topic, k in zip(COLUMNS, kinds, strict=True)))


def write_binary(h: DataFrame, path: str) -> None:
    """H with binary ids of 16 bytes as 36-byte records without a header: one file for each partition in the folder path, which
    read_footprints_binary and format("footprints") read."""
    h.sparkSession.dataSource.register(FootprintSource)
    h.select("id", *(F.col(c).cast("int") for c in TILE), *(F.col(v).cast("float") for v in VALUES)).write.format("footprints").mode("append").option("path", path).save()


def check_request(first: int, last: int, areas: int, area_rows: int, resident_rows: int) -> None:
    """Limits of a request."""
    if first > last:
        raise ValueError("the first period is after the last")
    if area_rows > MAX_AREA_ROWS or resident_rows > MAX_RESIDENT_ROWS:
        raise ValueError("too many rows")
    if areas > MAX_AREAS:
        raise ValueError(f"more than {MAX_AREAS} areas")


class StaleSession(RuntimeError):
    """Another session has committed since this one read the manifest; what this one has made is dropped."""


class StateStore:
    """Manifests by version, and the state in buckets by user.

    A commit makes the manifest behind the one that was read, by a create that fails where there is one; so of sessions that
    read the same version one commits, and the others are refused. A bucket is a folder of its own, which a period's merge
    replaces if the period has a user in it. All buckets are Spark's: user and bucket are related by Spark's hash, so a bucketed
    scan needs no exchange by user. Everything goes through the Hadoop file system, so the folder can be on any store that Spark
    writes to."""

    #: Manifests that stay; a session that read an older one can't be refused by its number alone, but by the listing in front.
    KEPT = 100

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = FileSystem(spark, self.root)
        self._fs = self.files._fs

    def _files(self) -> list[str]:
        return self.files.names()

    def version(self) -> int:
        """Of the newest manifest; -1 without any."""
        return max((int(x[9:]) for x in self._files() if x.startswith("manifest-")), default=-1)

    def manifest(self) -> dict | None:
        newest = self.version()
        return json.loads(self.files.read(f"manifest-{newest:012d}")) | {"version": newest} if newest >= 0 else None

    def commit(self, manifest: dict, read: int) -> int:
        """Makes the manifest that follows the version that was read, and returns its version; StaleSession if that isn't the
        newest any more."""
        content = json.dumps({k: v for k, v in manifest.items() if k != "version"}).encode()
        if self.version() != read or not self.files.create(f"manifest-{read + 1:012d}", content):
            raise StaleSession("another session has committed")
        if read >= self.KEPT:
            self.files.delete(f"manifest-{read - self.KEPT:012d}")
        return read + 1

    def empty(self) -> dict:
        """What a manifest says of a state without rows."""
        return {"n": self.n, "buckets": {}, "stats": None}

    def write(self, rows: DataFrame, at: dict, stats: DataFrame | None = None) -> dict:
        """The state with the buckets of rows (all rows of those) replaced, each with the folder it is now in."""
        n, folder = at["n"], f"state-{uuid.uuid4().hex}"
        name = f"mosaique_{uuid.uuid4().hex}"
        # A scan in buckets that no join sits right above is still one; every task writes one bucket, so nothing need be sorted.
        with settings(self.spark, AS_BUCKETS):
            kept = rows.select(*KEY, *VALUES).withColumn("bucket", bucket_of(n))
            kept.write.partitionBy("bucket").bucketBy(n, "id").option("path", f"{self.root}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        made = self._fs.listStatus(self._path(f"{self.root}/{folder}"))
        found = {x.getPath().getName().removeprefix("bucket="): f"{folder}/{x.getPath().getName()}" for x in made if x.getPath().getName().startswith("bucket=")}
        return at | {"buckets": at["buckets"] | found}

    def read(self, at: dict | None) -> DataFrame:
        """The state's rows by the buckets' folders, without their scheme of buckets."""
        paths = [f"{self.root}/{p}" for p in at["buckets"].values()] if at else []
        return self.spark.read.schema(S).parquet(*paths) if paths else self.spark.createDataFrame([], S)

    def drop(self, path: str | None) -> None:
        if path:
            self._fs.delete(self._path(path), True)

    def drop_unused(self, old: dict | None, new: dict | None) -> None:
        """Removes what a manifest names and another doesn't: buckets, folders that have none left, statistics."""
        gone, stay = ({*x["buckets"].values()} if x else set() for x in (old, new))
        for path in sorted(gone - stay):
            self.drop(f"{self.root}/{path}")
        for folder in {p.split("/")[0] for p in gone} - {p.split("/")[0] for p in stay}:
            self.drop(f"{self.root}/{folder}")
        if old and old["stats"] and not (new and new["stats"] == old["stats"]):
            self.drop(f"{self.root}/{old['stats']}")


#: Settings under which a plan over buckets keeps them.
AS_BUCKETS = {
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings with these values for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


class Temporary:
    """Intermediate tables of one step: `with Temporary(store) as keep:`; keep(df) writes df and reads it back, keep.buckets(at) is
    a table of the state's buckets. All tables are removed at the end, of buckets only their name."""

    def __init__(self, store: StateStore):
        self.store, self.paths, self.tables = store, [], []

    def __enter__(self) -> Temporary:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        self.paths.append(f"{self.store.root}/temporary-{uuid.uuid4().hex}")
        df.write.parquet(self.paths[-1])
        return df.sparkSession.read.schema(df.schema).parquet(self.paths[-1])

    def buckets(self, at: dict, which: list[int] | None = None) -> DataFrame:
        """The state's rows, of all buckets or of some; other buckets' files are not looked at."""
        spark, root = self.store.spark, self.store.root
        self.tables.append(name := f"mosaique_{uuid.uuid4().hex}")
        spark.sql(f"CREATE TABLE {name} ({S}, bucket int) USING parquet PARTITIONED BY (bucket) CLUSTERED BY (id) INTO {at['n']} BUCKETS LOCATION '{root}/none'")
        own = {b: p for b, p in at["buckets"].items() if which is None or int(b) in which}
        if own:
            spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (bucket={b}) LOCATION '{root}/{p}'" for b, p in own.items()))
        return spark.table(name).drop("bucket")

    def __exit__(self, *_) -> None:
        for name in self.tables:
            self.store.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in self.paths:
            self.store.drop(path)


def topic_put(rows: DataFrame, folder: str, name: str) -> None:
    rows.write.parquet(f"{folder}/{name}")
