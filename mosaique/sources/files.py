"""Readers of the input files, all with explicit schemas."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from mosaique.functions.dates import date_to_period
from mosaique.params import H_BYTES
from mosaique.schemas import AREAS, BINARY, GRID_CSV, RESIDENTS, VALUES, H, S


def read_footprints_csv(spark: SparkSession, path: str) -> DataFrame:
    """H of one file: seven columns by position; names in the header are not looked at."""
    return spark.read.schema(H).csv(path, header=True, enforceSchema=True, mode="FAILFAST")


def read_footprint_days(spark: SparkSession, folder: str) -> DataFrame:
    """H of all files day-<n>-updates.csv, with period n; the files' order does not matter."""
    rows = spark.read.schema(H).csv(f"{folder}/day-*-updates.csv", header=True, enforceSchema=True, mode="FAILFAST")
    period = F.regexp_extract(F.input_file_name(), r"day-(\d+)-updates\.csv", 1).cast("int")
    return rows.withColumn("period", period)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S).parquet(path)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S)


def _numbered(spark: SparkSession, path: str, schema: str, columns: list[str]) -> DataFrame:
    """CSV rows with line_no, their place in the file (in all files of a folder by name): by file, where the row's block begins
    there, and its place in that block, each of which Spark gives with the row."""
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=True, mode="FAILFAST")
    place = F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("n"))
    # Request files have a row limit (params.MAX_AREA_ROWS), so one window over them is bounded.
    numbered = rows.withColumn("place", place).withColumn("line_no", F.row_number().over(Window.orderBy("place")) - 1)
    return numbered.select(*columns, F.col("line_no").cast("long").alias("line_no"))


def read_reference_areas(spark: SparkSession, path: str) -> DataFrame:
    """id, tile; the job fails if ids don't begin at 0, sort and leave no gap."""
    rows = _numbered(spark, path, AREAS, ["id", "tile_e", "tile_n"])
    if not validate_reference_areas(rows):
        raise ValueError("reference area ids must begin at 0, be sorted and leave no gap")
    return rows.drop("line_no")


def area_steps(rows: DataFrame) -> DataFrame:
    """Rows of a file whose area id is not in order: the first is not 0, or the step is neither 0 nor 1."""
    order = Window.orderBy("line_no")
    step = F.col("id") - F.coalesce(F.lag("id").over(order), F.lit(0))
    first = F.lag("id").over(order).isNull()
    return rows.withColumn("step", step).withColumn("first", first).where((F.col("first") & (F.col("id") != 0)) | ~F.col("step").isin(0, 1)).drop("step", "first")


def validate_reference_areas(rows: DataFrame) -> bool:
    return area_steps(rows).isEmpty()


def first_by_tile(rows: DataFrame) -> DataFrame:
    """One census row of each tile: the first in the file (line_no)."""
    return rows.groupBy("tile_e", "tile_n").agg(F.min_by("value", "line_no").alias("value"))


def read_residents(spark: SparkSession, path: str) -> DataFrame:
    return first_by_tile(_numbered(spark, path, RESIDENTS, ["tile_e", "tile_n", "value"]))


def grid_tile(name: str = "grd_floaid"):
    """tile_e, tile_n of an id with three parts E.N.C."""
    part = F.split(F.col(name), r"\.")
    return part[0].cast("int").alias("tile_e"), part[1].cast("int").alias("tile_n")


def read_population_geojson(spark: SparkSession, path: str, population: str = "ms_population_20160101") -> DataFrame:
    """tile, population and geometry (as text) of the features of a GeoJSON file."""
    shape = f"type string, features array<struct<properties: struct<grd_floaid: string, {population}: double>, geometry: string>>"
    rows = spark.read.schema(shape).json(path, multiLine=True).select(F.explode("features").alias("f"))
    rows = rows.select(F.col("f.properties.grd_floaid").alias("grd_floaid"), F.col(f"f.properties.{population}").alias("population"), F.col("f.geometry").alias("geometry"))
    return rows.select(*grid_tile(), "population", "geometry")


def read_area_grid_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Reference areas of city grids: each file is an area, numbered in the order given."""
    out = None
    for i, path in enumerate(paths):
        rows = spark.read.schema(GRID_CSV).csv(path, header=True, enforceSchema=True, mode="FAILFAST").select(F.lit(i).alias("id"), *grid_tile())
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], AREAS)


def read_h_metadata(spark: SparkSession, path: str) -> str:
    """The text of <file>.meta, empty where there is none."""
    try:
        rows = spark.read.text(path + ".meta", wholetext=True).collect()
    except Exception as e:  # an absent file is no error; anything else is
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return ""
    return "".join(r["value"] for r in rows)


def list_h_dir(spark: SparkSession, folder: str) -> DataFrame:
    """period, path of the files day-YYYY-MM-DD-updates.hdata."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [x.getPath().toString() for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    rows = spark.createDataFrame([(x,) for x in names], "path string")
    date = F.regexp_extract("path", r"day-(\d{4}-\d{2}-\d{2})-updates\.hdata$", 1)
    return rows.withColumn("date", date).where("date != ''").select(date_to_period(F.col("date")).alias("period"), "path").orderBy("period")


def peek(rows: DataFrame):
    return rows.first()


def is_exhausted(rows: DataFrame) -> bool:
    return rows.isEmpty()


#: Fixed value: the layout of a record of H_BYTES bytes.
RECORD = [("id", "V16"), ("tile_e", "<u2"), ("tile_n", "<u2"), ("value_0", "<f4"), ("value_1", "<f4"), ("value_2", "<f4"), ("value_3", "<f4")]
BLOCK_RECORDS = 1 << 14


def unpack(block: bytes) -> pa.RecordBatch:
    """The columns of a block of whole records."""
    rows = np.frombuffer(block, np.dtype(RECORD))
    ids = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(rows), [None, pa.py_buffer(rows["id"].tobytes())]).cast(pa.binary())
    tiles = [pa.array(rows[c].astype(np.int32)) for c in ("tile_e", "tile_n")]
    return pa.RecordBatch.from_arrays([ids, *tiles, *(pa.array(rows[v].copy()) for v in VALUES)], ["id", "tile_e", "tile_n", *VALUES])


def pack(batch: pa.RecordBatch) -> bytes:
    """The records of a batch; a tile beyond 16 bits or an id of another length is an error."""
    rows = np.zeros(batch.num_rows, np.dtype(RECORD))
    ids = batch.column("id").to_pylist()
    if any(x is None or len(x) != 16 for x in ids):
        raise ValueError("an id has 16 bytes")
    rows["id"] = np.frombuffer(b"".join(ids), "V16")
    for c in ("tile_e", "tile_n"):
        values = np.asarray(batch.column(c))
        if len(values) and not (0 <= values.min() and values.max() < 1 << 16):
            raise ValueError("a tile index has 16 bits")
        rows[c] = values
    for v in VALUES:
        rows[v] = np.asarray(batch.column(v))
    return rows.tobytes()


def _store(path: str) -> tuple[FileSystem, str]:
    """Arrow's file system of a path or URI that every executor can reach (a shared mount, HDFS, an object store)."""
    return FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)


class FootprintSource(DataSource):
    """Files of 36-byte records without a header: format("footprints"), option path (a file, a folder, or several with commas).

    Each partition reads a byte range of whole records through Arrow's file systems and hands on Arrow batches. Writing makes one
    file for each partition, under a name that counts only once the job commits."""

    @classmethod
    def name(cls) -> str:
        return "footprints"

    def schema(self) -> str:
        return BINARY

    def reader(self, schema) -> DataSourceReader:
        return _FootprintReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _FootprintWriter(self.options)


class _Range(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


class _FootprintReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.records = options["path"].split(","), int(options.get("recordsPerPartition", 1 << 20))

    def partitions(self) -> list[_Range]:
        out = []
        for path in self.paths:
            store, inner = _store(path)
            found = store.get_file_info(inner)
            files = [found] if found.is_file else sorted((f for f in store.get_file_info(FileSelector(inner)) if f.is_file and f.base_name[0] not in "._"), key=lambda f: f.path)
            for f in files:
                if f.size % H_BYTES:
                    raise ValueError(f"{f.path}: {f.size} bytes are not whole records of {H_BYTES}")
                scheme = path.split("://")[0] + "://" if "://" in path else ""
                step = self.records * H_BYTES
                out += [_Range(path if found.is_file else f"{scheme}{f.path}", at, min(f.size, at + step)) for at in range(0, f.size, step)]
        return out or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if partition.begin < partition.end:
            store, inner = _store(partition.path)
            with store.open_input_file(inner) as f:
                for at in range(partition.begin, partition.end, BLOCK_RECORDS * H_BYTES):
                    yield unpack(f.read_at(min(BLOCK_RECORDS * H_BYTES, partition.end - at), at))


@dataclass
class _Part(WriterCommitMessage):
    name: str


class _FootprintWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        store, inner = _store(self.folder)
        store.create_dir(inner, recursive=True)
        name = f"part-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{inner}/_{name}") as out:
            for batch in iterator:
                out.write(pack(batch))
        return _Part(name)

    def commit(self, messages: list[_Part | None]) -> None:
        store, inner = _store(self.folder)
        for m in messages:
            if m:
                store.move(f"{inner}/_{m.name}", f"{inner}/{m.name}")

    def abort(self, messages: list[_Part | None]) -> None:
        store, inner = _store(self.folder)
        for m in messages:
            if m:
                store.delete_file(f"{inner}/_{m.name}")


def read_footprints_binary(spark: SparkSession, path: str) -> DataFrame:
    """The same through Spark's fixed-length record reader, for stores that only Spark's readers reach: records are joined to
    blocks, and blocks become Arrow batches."""
    size = spark.read.format("binaryFile").load(path).select("length").where(F.col("length") % H_BYTES != 0)
    if not size.isEmpty():
        raise ValueError(f"{path}: not whole records of {H_BYTES} bytes")

    def joined(records: Iterator[bytes]) -> Iterator[tuple[bytes]]:
        while block := b"".join(islice(records, BLOCK_RECORDS)):
            yield (block,)

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.column("block").to_pylist():
                yield unpack(block)

    blocks = spark.createDataFrame(spark.sparkContext.binaryRecords(path, H_BYTES).mapPartitions(joined), "block binary")
    return blocks.mapInArrow(columns, BINARY)
