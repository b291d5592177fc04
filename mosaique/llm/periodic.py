"""Periodic runs of words: maximal stretches that repeat with a period, found on a harmonic grid.

A run of period q and 2 q words or more holds two neighbours j q and (j + 1) q of the grid of its period. So for each period p
from 1 to half the text, every pair (j p, (j + 1) p) is asked how far both places agree forwards and backwards; together at least
p words make a run, which the two lengths delimit exactly. The grids of a text of n words have some n ln n pairs. A longest common
extension is a minimum over neighbours in the suffix array (of the text, and of the text read backwards for the other direction),
by a sparse table of minima. Texts of a slice share one array, whose order begins with the text, so that no extension leaves its
text. Of one stretch the smallest period counts; others that the grid finds for it are its multiples.

Null, empty or white text: no run. Repeated rows each get their row, ties of the longest run go by start, then period. Very long
texts are read whole (some 8 log2(n) bytes a word). A null id is the empty text where runs are planted. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import ascii_words, coded, slices, spread

#: Words of the shortest run; bytes of text at once; pairs of the grid at once.
LEAST, SLICE, PAIRS = 12, 1 << 20, 1 << 20


def suffix_order(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each suffix (first by its text), and by rank the words that it shares with the suffix in front.

    Prefixes double in length; a rank is the first place of its group, so only groups that are still tied are sorted again."""
    n, doc = len(codes), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = np.repeat(offsets[1:], np.diff(offsets))
    kinds = int(codes.max(initial=0)) + 1
    _, inverse, size = np.unique(doc * kinds + codes, return_inverse=True, return_counts=True)
    first = np.cumsum(size) - size
    rank = np.append(first[inverse], -1).astype(np.int64)
    levels, left, step = [rank.astype(np.int32)], np.flatnonzero(size[inverse] > 1), 1
    while len(left):
        own, ahead = rank[left], np.where(left + step < end[left], rank[np.minimum(left + step, n)], -1)
        key = own * (n + 1) + ahead + 1
        order = np.argsort(key, kind="stable")
        key, own, left = key[order], own[order], left[order]
        new, group = np.ones(len(left), bool), np.ones(len(left), bool)
        new[1:], group[1:] = key[1:] != key[:-1], own[1:] != own[:-1]
        place = np.arange(len(left))
        rank = rank.copy()
        rank[left] = own + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        levels.append(rank.astype(np.int32))
        alone = new & np.append(new[1:], True)
        left, step = left[~alone], step * 2
    rank = rank[:-1]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b, shared = order[:-1].copy(), order[1:].copy(), np.zeros(n, np.int32)
    for k in range(len(levels) - 1, -1, -1):  # each level once: of equal ones a longer prefix would be equal too
        same = levels[k][a] == levels[k][b]
        step = same.astype(np.int64) << k
        a, b = a + step, b + step
        shared[1:] += step.astype(np.int32)
    return rank, shared


class Extensions:
    """How many words two suffixes of one text share: the least of `shared` between their ranks."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray):
        self.rank, shared = suffix_order(codes, offsets)
        self.table = [shared]
        while 2 << (len(self.table) - 1) <= int(np.diff(offsets).max(initial=1)):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.append(np.minimum(last[:-half], last[half:]), last[len(last) - half :]))
        self.table = np.stack(self.table)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different places of one text."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        return np.minimum(self.table[level, low], self.table[level, high + 1 - (1 << level)]).astype(np.int64)


def _grid(offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of places j p, (j + 1) p of each text, with p, about PAIRS at a time."""
    half = np.diff(offsets) // 2
    text, period = np.repeat(np.arange(len(half)), half), spread(np.ones(len(half), np.int64), half)
    pairs = (np.diff(offsets)[text] - 1) // period
    ends, at = np.cumsum(pairs), 0
    while at < len(pairs):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        p = np.repeat(period[at:to], pairs[at:to])
        a = np.repeat(offsets[text[at:to]], pairs[at:to]) + spread(np.zeros(to - at, np.int64), pairs[at:to]) * p
        yield a, a + p, p
        at = to


def runs(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, start (in the text), length, period of all runs of `least` words or more, by text, start and period."""
    n = len(codes)
    doc, found = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), []
    if n:
        ahead, behind = Extensions(codes, offsets), Extensions(codes[::-1], n - offsets[::-1])
    for a, b, p in _grid(offsets) if n else ():
        inside = a > offsets[doc[a]]
        forth, back = codes[a] == codes[b], inside & (codes[a - 1] == codes[b - 1])
        some = np.flatnonzero(forth | back)  # others agree nowhere
        a, b, p, forth, back = a[some], b[some], p[some], forth[some], back[some]
        f, g = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        f[forth] = ahead.of(a[forth], b[forth])
        g[back] = behind.of(n - a[back], n - b[back])
        keep = np.flatnonzero((f + g >= p) & (f + g + p >= least))
        found.append(np.stack((a[keep] - g[keep], b[keep] + f[keep], p[keep]), axis=1))
    all_ = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    all_ = all_[np.lexsort(all_.T[::-1])]
    first = np.ones(len(all_), bool)
    first[1:] = (all_[1:, :2] != all_[:-1, :2]).any(axis=1)
    start, end, period = all_[first].T
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    text = doc[start]
    return text, start - offsets[text], end - start, period


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_runs, start, length and period of the longest run, runs (all of them), and collapsed: the words that are not
    behind the first period of a run, joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            offsets, words = ascii_words(part.column("text"))
            text, start, length, period = runs(coded(words)[0], offsets, least)
            count = np.bincount(text, minlength=part.num_rows)
            order, none = np.append(np.lexsort((period, start, -length, text)), len(text)), count == 0
            longest = order[np.where(none, len(text), np.cumsum(count) - count)]
            best = [pa.array(np.append(x, 0)[longest], pa.int64(), mask=none) for x in (start, length, period)]
            each = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            marks = np.zeros(len(words) + 1, np.int64)
            begin = offsets[text] + start
            np.add.at(marks, begin + period, 1)
            np.add.at(marks, begin + length, -1)
            kept = np.cumsum(marks[:-1]) == 0
            ends = np.concatenate(([0], np.cumsum(kept)))[offsets]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(pa.array(kept)))
            bounds = pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32())
            cols = [part.column("doc_id"), pa.array(count, pa.int64()), *best, pa.ListArray.from_arrays(bounds, each), pc.binary_join(lists, " ")]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_runs", "start", "length", "period", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    out = f"doc_id {kind}, n_runs long, start long, length long, period long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, out)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, in a tenth of the texts (by the id's crc32) with a run from one of its words to the end."""
    code = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(F.col("_code") / 10), F.size("_words")
    a = F.when(n > 0, g % F.greatest(n, F.lit(1)))
    p = F.lit(1) + F.floor((n - F.col("_a")) / (3 + g % 8))
    again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", F.when(i < F.col("_a"), i.cast("long")).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))
    rows = docs.select("doc_id", "text", code.alias("_code")).withColumn("_words", F.when((F.col("_code") % 10 == 0) & F.col("text").isNotNull(), words))
    rows = rows.withColumn("_a", a).withColumn("_p", p)
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digest(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run with its exponent, digests of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.col("n_runs") > 0, "\n").otherwise(""))
    exponent = F.floor(1000 * F.col("length") / F.col("period")).cast("long").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "start", "length", "period", exponent, digest(lines).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))
