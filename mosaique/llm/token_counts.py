"""Token counts from a digest cache.

The cache is a Parquet table (version, digest, n_tokens): version is the digest of the tokenizer's file, digest that of
the normalised content. Counts are joined by both; only distinct contents that are not stored are encoded, and their
counts are appended. Where few contents are missing (FEW digests, which are broadcast), the others' texts never leave their
task; else all travel, compressed, each distinct one about once from a task.

Content is normalised as the tokenizer itself does (identity for this one), so equal digests have equal counts. Null and
empty text count 0 tokens. Repeated rows share one entry and stay rows. Very long texts are encoded whole. An empty table
gives an empty result, and appends nothing. Other columns are ignored. If two jobs append one digest, either serves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import hot_join, slices, stored, text_of

LIMIT = 4096
CACHE = "version string, digest binary, n_tokens long"
#: Contents that are opened together, digests that a task remembers, and missing ones that are broadcast (32 bytes each).
PACK_ROWS, SEEN, FEW = 1000, 200_000, 500_000


def version_of(tokenizer: str) -> str:
    with open(tokenizer, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each content of a task once, compressed."""
    import zstandard

    squeeze, seen = zstandard.ZstdCompressor(level=1), set()
    for part in slices(batches):
        out = []
        for digest, text in zip(part.column("digest").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
            if digest not in seen:
                seen = seen if len(seen) < SEEN else set()  # what comes twice is dropped behind the shuffle
                seen.add(digest)
                out.append((digest, squeeze.compress(text)))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], ["digest", "packed"])


def _encode(tokenizer: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from mosaique.llm.tokens import PieceCounts

        count, open_ = PieceCounts(tokenizer), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, PACK_ROWS):
                some = batch.slice(at, PACK_ROWS)
                texts = pa.array([open_.decompress(x) for x in some.column("packed").to_pylist()], pa.binary()).cast(pa.string())
                for part in slices(iter([pa.RecordBatch.from_arrays([some.column("digest"), texts], ["digest", "text"])])):
                    n = pa.array(count(part.column("text")))
                    yield pa.RecordBatch.from_arrays([pa.array([version] * part.num_rows, pa.string()), part.column("digest"), n], ["version", "digest", "n_tokens"])

    return run


def stored_counts(spark, cache: str, version: str) -> DataFrame:
    """digest, n_tokens of the version; an absent cache is an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    table = spark.read.schema(CACHE).parquet(cache) if there else spark.createDataFrame([], CACHE)
    return table.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; the cache is brought up to date."""
    spark, version = docs.sparkSession, version_of(tokenizer)
    digest = F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest")
    contents = docs.select(digest, text_of().alias("text"))
    cached, few = stored_counts(spark, cache, version), None
    if not cached.isEmpty():
        missing = stored(contents.select("digest").distinct().join(cached, "digest", "left_anti"), "missing")
        few = missing.count() <= FEW
    if few:
        contents = contents.join(F.broadcast(missing), "digest", "left_semi")
    packed = contents.mapInArrow(_pack, "digest binary, packed binary")
    if few is False:
        packed = packed.join(missing, "digest", "left_semi")
    once = packed.groupBy("digest").agg(F.first("packed").alias("packed"))
    once.mapInArrow(_encode(tokenizer, version), CACHE).write.mode("append").parquet(cache)
    keyed = stored(docs.select(F.col("doc_id").cast("long"), F.octet_length(text_of()).cast("long").alias("n_bytes"), digest), "digests")
    counted = hot_join(keyed, stored_counts(spark, cache, version), "digest", keyed.count())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
