"""Lines that many documents share: two Bloom filters find the suspects, an exact count confirms them.

1. Keys. A line's key is the line without white space (0x20, 0x09 to 0x0D) at its ends, A-Z in lower case. Of each row the
   distinct keys of LEAST_CHARS code points or more are stored as digests of 128 bits: a sixth of the text's size or less.
2. Filters. A task fills one filter with the digests it has seen once and a second with those that it meets again. Filters of
   tasks merge FAN at a time: what is in both of the first kind goes to the second. So the second holds every key of two rows or
   more, and a few others by chance.
3. Only digests that the second filter knows are shuffled, with their document, to be counted exactly by documents. A key of
   LEAST_DOCS documents or more keeps its lines in the largest doc_id.
4. Texts are read again and lose their lines where they are. Confirmed keys (24 bytes each) are broadcast up to HELD of them;
   beyond, the suspects are joined with them, gathered by document and joined with the texts.

A filter has BITS bits for each key, at most MOST_BITS (32 MB). More keys are dealt to several pairs of filters by ranges of their
digests, up to ROUNDS; beyond that (some 270 M keys) filters fill up, more lines than need be are shuffled, and results stay the
same.

Null or empty text: one empty line, which stays. Rows of one doc_id are one document; each row is returned. A null doc_id holds
no key: it is not counted and its lines stay. Ties don't arise: lines of the kept document all stay, repeated ones too. Very long
texts and lines are read whole. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import coded, folded, hot_join, removed, slices, stored

LEAST_CHARS, LEAST_DOCS = 20, 3
#: A digest's bytes, bits of a filter for each key, places that a key sets, most bits of a filter, bytes of its stored parts, and
#: most pairs of filters.
DIGEST, BITS, PLACES, MOST_BITS, SEGMENT, ROUNDS = 16, 16, 4, 1 << 28, 1 << 15, 16
#: Confirmed keys that are broadcast, and bytes of text at once.
HELD, SLICE = 4_000_000, 1 << 20
WHITE = " \t\n\x0b\x0c\r"


def lines_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Offsets of each text's lines, the lines, each line's code among the distinct keys of LEAST_CHARS or more (-1: shorter), and
    the digests of those keys, a row each."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    keys = pc.ascii_lower(pc.utf8_trim(lines, characters=WHITE))
    long = np.asarray(pc.greater_equal(pc.utf8_length(keys), LEAST_CHARS))
    codes = np.full(len(lines), -1, np.int64)
    codes[long], distinct = coded(keys.filter(pa.array(long)))
    found = b"".join(blake2b(x, digest_size=DIGEST).digest() for x in distinct.cast(pa.binary()).to_pylist())
    return offsets - offsets[0], lines, codes, np.frombuffer(found, np.uint64).reshape(-1, 2)


def line_keys(docs: DataFrame) -> DataFrame:
    """doc_id, digests: the distinct keys of each row, one behind the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            offsets, _, codes, digests = lines_of(part.column("text"))
            row = np.repeat(np.arange(part.num_rows), np.diff(offsets))[codes >= 0]
            pairs = np.unique(row * max(1, len(digests)) + codes[codes >= 0])
            row, own = np.divmod(pairs, max(1, len(digests)))
            ends = np.searchsorted(row, np.arange(part.num_rows + 1)) * DIGEST
            packed = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(digests[own].tobytes())])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), packed], ["doc_id", "digests"])

    some = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return some.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, digests binary").where(F.length("digests") > 0)


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All digests (two numbers each), and the row of each."""
    values = column.to_pylist()
    row = np.repeat(np.arange(len(values)), [len(x) // DIGEST for x in values])
    return np.frombuffer(b"".join(values), np.uint64).reshape(-1, 2), row


def in_range(digests: np.ndarray, part: int, parts: int) -> np.ndarray:
    return ((digests[:, 0] >> np.uint64(48)) * np.uint64(parts)) >> np.uint64(16) == part


class Bloom:
    """A filter of a power of two bits."""

    def __init__(self, bits: int):
        self.mask, self.bytes = np.uint64(bits - 1), np.zeros(bits // 8, np.uint8)

    def _places(self, digests: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(PLACES):
            at = (digests[:, 0] + np.uint64(k) * digests[:, 1]) & self.mask
            yield (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))

    def add(self, digests: np.ndarray) -> None:
        for byte, bit in self._places(digests):
            np.bitwise_or.at(self.bytes, byte, bit)

    def has(self, digests: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, ((self.bytes[byte] & bit) > 0 for byte, bit in self._places(digests)))


def met_again(digests: np.ndarray, once: Bloom) -> np.ndarray:
    """Which digests are in once, or share their first half with another of these."""
    order = np.argsort(digests[:, 0], kind="stable")
    same = np.flatnonzero(digests[order[1:], 0] == digests[order[:-1], 0])
    again = once.has(digests)
    again[order[same]] = again[order[same + 1]] = True
    return again


def twice_seen(keys: DataFrame, bits: int, part: int, parts: int) -> Bloom:
    """The filter of keys of a range that two rows or more have."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bloom(bits), Bloom(bits)
        for x in batches:
            digests, _ = unpacked(x.column("digests"))
            digests = digests[in_range(digests, part, parts)]
            twice.add(digests[met_again(digests, once)])
            once.add(digests)
        number = TaskContext.get().partitionId()
        for k in range(0, len(once.bytes), SEGMENT):
            own = [f.bytes[k : k + SEGMENT] for f in (once, twice)]
            if own[0].any():
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (number, k, *map(squeezed, own))], ["part", "segment", "once", "twice"])

    def fold(table: pa.Table) -> pa.Table:
        once = twice = np.zeros(1, np.uint8)
        for x in table.to_pylist():
            more, again = loose(x["once"], bits), loose(x["twice"], bits)
            twice, once = twice | again | (once & more), once | more
        row = {"part": table.column("part").slice(0, 1), "segment": table.column("segment").slice(0, 1), "once": [squeezed(once)], "twice": [squeezed(twice)]}
        return pa.table(row)

    out = Bloom(bits)
    parts_ = stored(keys.select("digests").mapInArrow(fill, "part long, segment long, once binary, twice binary"), "filters")
    last = folded(parts_, fold, ("segment",))
    for r in last.select("segment", "twice").toLocalIterator():  # MOST_BITS at most
        own = loose(r["twice"], bits)
        out.bytes[r["segment"] : r["segment"] + len(own)] = own
    removed(last)
    return out


def squeezed(part: np.ndarray) -> bytes:
    return pa.compress(part.tobytes(), codec="zstd", asbytes=True)


def loose(part: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(part, min(SEGMENT, bits // 8), codec="zstd", asbytes=True), np.uint8)


def suspects(keys: DataFrame, twice, part: int, parts: int) -> DataFrame:
    """digest, doc_id of the keys of a range that the broadcast filter knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            digests, row = unpacked(x.column("digests"))
            some = np.flatnonzero(in_range(digests, part, parts))
            some = some[twice.value.has(digests[some])]
            ends = np.arange(len(some) + 1, dtype=np.int32) * DIGEST
            own = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(digests[some].tobytes())])
            yield pa.RecordBatch.from_arrays([own, x.column("doc_id").take(pa.array(row[some]))], ["digest", "doc_id"])

    return keys.mapInArrow(run, f"digest binary, doc_id {dict(keys.dtypes)['doc_id']}")


def repeated(keys: DataFrame, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """Suspects (digest, doc_id), a plan, and confirmed keys (digest, keeper), a stored table."""
    total = keys.agg(F.sum(F.length("digests"))).first()[0] or 0
    wanted = max(1, total // DIGEST) * BITS
    parts = min(ROUNDS, -(-wanted // most_bits))
    bits = min(most_bits, max(1 << 13, 1 << (-(-wanted // parts) - 1).bit_length()))
    rows, found = [], []
    for part in range(parts):
        twice = keys.sparkSession.sparkContext.broadcast(twice_seen(keys, bits, part, parts))
        rows.append(suspects(keys, twice, part, parts))
        # By key and document first, so that a key of very many documents is added up before it meets in one task.
        counts = rows[-1].groupBy("digest").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
        found.append(stored(counts.where(F.col("n") >= LEAST_DOCS).select("digest", "keeper"), "repeated-lines"))
    return reduce(DataFrame.union, rows), reduce(DataFrame.union, found)


class Keepers:
    """The confirmed keys in order of their first half, with the document that keeps each."""

    def __init__(self, digests: np.ndarray, keepers: np.ndarray):
        order = np.argsort(digests[:, 0], kind="stable")
        self.first, self.second, self.keeper = digests[order, 0], digests[order, 1], keepers[order]

    def find(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its keeper, or 0."""
        hit, out, left = np.zeros(len(digests), bool), np.zeros(len(digests), np.int64), np.arange(len(digests))
        at = np.searchsorted(self.first, digests[:, 0])
        while len(left):
            inside = at < len(self.first)
            at, left = at[inside], left[inside]
            near = self.first[at] == digests[left, 0]
            at, left = at[near], left[near]
            same = self.second[at] == digests[left, 1]
            hit[left[same]], out[left[same]] = True, self.keeper[at[same]]
            at, left = at[~same] + 1, left[~same]
        return hit, out


def without_lines(part: pa.RecordBatch, gone) -> pa.RecordBatch:
    """doc_id, text, n_lines, n_dropped. gone(codes by line, digests, row by line) says which lines go."""
    offsets, lines, codes, digests = lines_of(part.column("text"))
    drop = gone(codes, digests, np.repeat(np.arange(part.num_rows), np.diff(offsets)))
    ends = np.concatenate(([0], np.cumsum(~drop)))[offsets]
    left = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines.filter(pa.array(~drop))), "\n")
    n = np.diff(offsets)
    return pa.RecordBatch.from_arrays([part.column("doc_id"), left, pa.array(n), pa.array(n - np.diff(ends))], ["doc_id", "text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, held: int = HELD, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id (a whole number), text (the lines that stay), n_lines (before), n_dropped."""
    keys = stored(line_keys(docs.withColumn("doc_id", F.col("doc_id").cast("long"))), "line-keys")
    rows, found = repeated(keys, most_bits)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    kind = "doc_id long, text string, n_lines long, n_dropped long"
    if found.count() <= held:
        table = found.toArrow()
        digests = np.frombuffer(b"".join(table.column("digest").to_pylist()), np.uint64).reshape(-1, 2)
        keepers = docs.sparkSession.sparkContext.broadcast(Keepers(digests, np.asarray(table.column("keeper"), dtype=np.int64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, limit=SLICE):
                ids = np.asarray(pc.fill_null(part.column("doc_id"), 0), dtype=np.int64)
                known = np.asarray(part.column("doc_id").is_valid())

                def gone(codes: np.ndarray, digests: np.ndarray, row: np.ndarray) -> np.ndarray:
                    hit, keeper = (np.append(x, 0) for x in keepers.value.find(digests))
                    return hit[codes].astype(bool) & (codes >= 0) & (keeper[codes] != ids[row]) & known[row]

                yield without_lines(part, gone)

        return texts.mapInArrow(run, kind)
    met = hot_join(rows, found, "digest", rows.count()).where(F.col("keeper").isNotNull() & (F.col("keeper") != F.col("doc_id")))
    own = met.groupBy("doc_id").agg(F.collect_set("digest").alias("gone"))  # of one document's lines
    joined = texts.where(F.col("doc_id").isNotNull()).join(own, "doc_id", "left")

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            sets = [{*x} for x in pc.fill_null(part.column("gone"), []).to_pylist()]

            def gone(codes: np.ndarray, digests: np.ndarray, row: np.ndarray) -> np.ndarray:
                names = [x.tobytes() for x in digests]
                return np.array([c >= 0 and names[c] in sets[r] for c, r in zip(codes.tolist(), row.tolist(), strict=True)], bool)

            yield without_lines(part, gone)

    none = F.array().cast("array<binary>").alias("gone")
    return joined.union(texts.where(F.col("doc_id").isNull()).select("*", none)).mapInArrow(apart, kind)


def summary(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
