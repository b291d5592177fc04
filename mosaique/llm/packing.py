"""Packing by minimum bin slack.

A document longer than the window is cut at multiples of the window; its last piece and all short documents are packed.
Only the histogram of piece lengths (at most `window` rows) reaches the driver. There a bitset subset-sum program picks,
around the longest length left, the multiset of lengths that comes closest to the window; the multiset is taken as often
as its counts allow, so the number of multisets depends on the window and not on the corpus. Each piece then finds its
place from its rank among the pieces of its length.

Null or empty text: the end id alone. Repeated rows, also with one doc_id, are packed each for itself; pieces of equal
length are interchangeable, so ties change no padding. A null doc_id is kept. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mosaique.llm.common import slices, stored

WINDOW = 4096
END_ID = 2
#: A length's pieces are ranked in so many parts, for a length that a third of all pieces may have.
RANK_PARTS = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's ids with the end id, cut at multiples of the window: doc_id, start, length, ids_crc32, doc_tokens
    (and the piece's ids, if wanted)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from mosaique.llm.tokens import WordIds

        encode = WordIds(tokenizer)
        for part in slices(batches):
            offsets, ids = encode(part.column("text"))
            size = np.diff(offsets) + 1
            full = np.zeros(len(ids) + len(size), "<u4")
            ends = np.cumsum(size)
            full[ends - 1] = end_id
            inner = np.ones(len(full), bool)
            inner[ends - 1] = False
            full[inner] = ids
            n = -(-size // window)
            doc = np.repeat(np.arange(len(size)), n)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(window, size[doc] - start)
            begin = (ends - size)[doc] + start
            crc = [zlib.crc32(full[a : a + k]) for a, k in zip(begin.tolist(), length.tolist(), strict=True)]
            out = [part.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(size[doc])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                # The pieces lie one behind the other, so their bounds are the running sums of their lengths.
                bounds = pa.array(np.concatenate(([0], np.cumsum(length))).astype(np.int32))
                out.append(pa.ListArray.from_arrays(bounds, pa.array(full.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def fill(counts: dict[int, int], room: int, first: int) -> dict[int, int]:
    """The multiset of lengths, `first` among them, whose sum comes closest to room; counts has how many there are of each.

    Bit s of a set is on when some multiset of the lengths seen so far sums to s; sets are kept for the way back."""
    left = room - first
    reach, seen, top = 1, [], 1 << left
    mask = (top << 1) - 1
    for length in sorted(counts, reverse=True):
        most = min(counts[length] - (length == first), left // length)
        step = 1
        while most > 0 and not reach & top:  # 1, 2, 4, ... of this length, up to its count
            k = min(step, most)
            seen.append((length, k, reach))
            reach |= (reach << (k * length)) & mask
            most -= k
            step *= 2
        if reach & top:
            break
    at = reach.bit_length() - 1
    chosen = {first: 1}
    for length, k, before in reversed(seen):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + k
            at -= k * length
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Multisets of lengths and how many sequences each makes; together they use every piece once."""
    left, out = {k: n for k, n in counts.items() if n}, []
    while left:
        chosen = fill(left, window, max(left))
        times = min(left[k] // m for k, m in chosen.items())
        out.append((chosen, times))
        for k, m in chosen.items():
            left[k] -= m * times
            if not left[k]:
                del left[k]
    return out


def places(planned: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """One row for each multiset and length: length, rank of the first piece, pieces a sequence, first sequence, offset there."""
    rows, used, sequence = [], {}, 0
    for chosen, times in planned:
        offset = 0
        for length, m in sorted(chosen.items(), reverse=True):
            rows.append((length, used.get(length, 0), m, sequence, offset))
            used[length] = used.get(length, 0) + m * times
            offset += length * m
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(df: DataFrame, parts: int = RANK_PARTS) -> DataFrame:
    """df with rank: from 0 without gaps among the rows of each length. Ranks count in parts, then parts are added up."""
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts))
    df = df.withColumn("part", part)
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start"))
    sums = df.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    joined = df.withColumn("own", own).join(sums, ["length", "part"])
    return joined.withColumn("rank", F.col("before") + F.col("own") - 1).drop("part", "own", "before")


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """cut (doc_id, start, length, ids_crc32, doc_tokens, a stored table) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most window rows
    table = places(plan(counts, window))
    keys = table[:, 0] << 48 | table[:, 1] if len(table) else np.zeros(0, np.int64)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            _, first, m, sequence, offset = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1].T
            own = rank - first
            found = [pa.array(sequence + own // m), pa.array(offset + own % m * length)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + found, [*names, "sequence_id", "offset"])

    return ranked(cut.select(*names)).select(*names, "rank").mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    return pack(stored(pieces(docs, tokenizer, window, end_id), "pieces"), window)
