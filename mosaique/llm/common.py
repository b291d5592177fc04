"""What the operators of this folder share: tables, stored intermediates, word splitting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once; a longer document is handled alone. The arrays that an operator makes
#: of a slice take up to some forty times its bytes.
SLICE_BYTES = 3 << 20
#: Rows of an Arrow batch.
BATCH_ROWS, _ROWS = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Keys with 1 / HOT of all rows, and LEAST_HOT rows, are joined without a shuffle by them.
HOT, LEAST_HOT = 10_000, 200
#: Rows that `folded` merges at a time.
FAN = 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir). Where it is unset, a temporary one serves a session on this
    machine alone; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="mosaique-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/mosaique/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows where the session has Spark's default: an executor holds one or two batches of whole texts
    outside its heap for each task, and a Python worker one."""
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """df as a written table in the shared folder: it cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    small_batches(df.sparkSession)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def removed(table: DataFrame) -> None:
    """Removes a table that `stored` has written and that nothing will read again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hot_join(rows: DataFrame, table: DataFrame, key: str, total: int, counts: DataFrame | None = None) -> DataFrame:
    """rows (a cheap plan, of `total` rows) left-joined with table, which is unique by key; counts (key, _n), if they are known.

    A key that a HOT-th of the rows or more have is one of HOT keys at most: the table's rows of those are broadcast. Rows with
    such a key, or none, are dealt by their number instead of their key, so that no task gets them all."""
    counts = (rows.groupBy(key).agg(F.count("*").alias("_n")) if counts is None else counts).where((F.col("_n") * HOT >= total) & (F.col("_n") >= LEAST_HOT) & F.col(key).isNotNull())
    names = [c for c in table.columns if c != key]
    hot = table.join(F.broadcast(counts.select(key)), key).select(key, F.struct(*names).alias("_hot"))
    marked = rows.join(F.broadcast(hot), key, "left")
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    number = F.unhex(F.hex(F.monotonically_increasing_id())) if dict(rows.dtypes)[key] == "binary" else F.monotonically_increasing_id()
    # Rows that are dealt apart may meet a row of the table by chance, which is then not theirs.
    marked = marked.withColumn("_apart", apart).withColumn("_key", F.when(apart, number).otherwise(F.col(key)))
    joined = marked.join(table.withColumnRenamed(key, "_key"), "_key", "left")
    found = [F.when(F.col("_apart"), F.col(f"_hot.{c}")).otherwise(F.col(c)).alias(c) for c in names]
    return joined.select(*(rows.columns), *found)


def remainder(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has at most limit bytes of text, one row at least. Memory that a slice has used is given
    back before the next, so that a worker that is kept for later tasks doesn't hold the most it ever took."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, before + limit, side="right")) - at)
            yield batch.slice(at, n)
            at += n
            release()


def release() -> None:
    """Gives free memory back to the system, Arrow's and (through the system's pool) Python's and numpy's."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    words, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(words), 0)
    if len(words) and not pc.all(full).as_py():  # a split leaves empty words
        keep = np.asarray(full)
        words, offsets = words.filter(full), np.concatenate(([0], np.cumsum(keep)))[offsets]
    return offsets, words


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space (0x20, 0x09 to 0x0D): offsets by text, and all words in one array. Null has no word."""
    return _flat(pc.ascii_split_whitespace(pc.fill_null(texts, "")))


def split_at(texts: pa.Array, mark: str) -> tuple[np.ndarray, pa.Array]:
    """The same for the non-empty parts between marks."""
    return _flat(pc.split_pattern(texts, mark))


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words and the distinct words."""
    d = words.dictionary_encode()
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    return np.asarray(d.indices, dtype=np.int64), d.dictionary


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + length), one range after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values in each [offsets[i], offsets[i + 1])."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def folded(parts: DataFrame, fold: Callable[[pa.Table], pa.Table], keys: tuple[str, ...] = ()) -> DataFrame:
    """parts (a stored table with a number `part`) merged FAN at a time, in rounds, until part 0 alone is left: by keys, fold makes
    one row (with any part) of up to FAN. Every round is a stored table, so no task meets more than FAN rows of a key."""
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:
        nearer = parts.withColumn("part", F.expr(f"part div {FAN}"))

        def run(table: pa.Table) -> pa.Table:
            out, at = fold(table), table.schema.get_field_index("part")
            return out.set_column(at, "part", table.column("part").slice(0, 1)).select(table.column_names)

        before, parts = parts, stored(nearer.groupBy(*keys, "part").applyInArrow(run, nearer.schema), "folded")
        removed(before)
    return parts
