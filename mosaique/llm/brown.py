"""Class-based n-gram scores (Brown model): words have classes, classes have transitions, words are emitted by classes.

Counts of every word of all training texts are one stored table. Every word that occurs LEAST times or more is a unit of its
own, and ENDINGS word endings stand for the rarer words; so the units grow with the vocabulary. Bigrams of units are counted
over all training texts and stored by buckets of units, each unit with all that comes before and behind it. The units are put
into CLASSES by exchange: first the HEAD most frequent words and the endings among themselves, one by one; then all units,
from the class of their ending on, bucket by bucket in tasks, in rounds until the class bigrams' mutual information rises by
less than CONVERGED of itself. Only class tables and moves reach the driver.

P(text) is the product of P(class | class before) * P(unit | class), and for a word behind an ending P(word | ending) with
add-0.1 counts.

Tasks get the hashes, counts, ranks and emissions (20 bytes each) of all clustered words, and of as many rarer ones as make no
more than KNOWN_HASHES in all; other words are joined with the stored table, each distinct word of a text once.

Null and empty text: the end token alone. Repeated rows are texts of their own, in counts and scores. Very long texts are
read whole. With no training text, classes and words are all equally likely. An empty table gives an empty result. Ties in
frequency go by the word's hash. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import ascii_words, coded, per_row, slices, stored

HEAD, ENDINGS, CLASSES, ROUNDS, KNOWN_HASHES = 1000, 400, 48, 6, 500_000
ENDING, ADD, PRIOR = 2, 0.1, 20.0
#: Words of fewer occurrences are behind endings. Words that are clustered at most: 20 bytes each are broadcast, and a row for each
#: that moves comes to the driver; of more, the rarest are behind endings too. Share of the mutual information that a round of
#: exchange must add.
LEAST, MOST_CLUSTERED, CONVERGED = 10, 8_000_000, 0.001
#: Bigrams that a task gathers before it hands them on, nonzero counts that are weighed at once, buckets a partition.
GATHER, WEIGHED, BUCKETS = 1_000_000, 10_000, 4


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all texts; each slice of texts adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            _, words = ascii_words(pc.ascii_lower(pc.fill_null(part.column("text"), "")))
            found = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Units:
    """Numbers of the clustered words (by rank), then of the endings, then of any other word, then of the end."""

    hashes: np.ndarray  # of words, sorted; also of words that are not clustered
    ranks: np.ndarray
    counts: np.ndarray
    clustered: int
    endings: dict[str, int]

    @property
    def other(self) -> int:
        return self.clustered + len(self.endings)

    @property
    def end(self) -> int:
        return self.other + 1

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Units of the words, and their counts, -1 for those that the hash arrays lack."""
        import xxhash

        keys = np.fromiter((xxhash.xxh64_intdigest(w, seed=42) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words)).view(np.int64)
        unit, count = np.full(len(words), -1, np.int64), np.full(len(words), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
            hit = self.hashes[at] == keys
            count[hit] = self.counts[at[hit]]
            unit[hit] = self.ranks[at[hit]]
        tail = np.flatnonzero((unit < 0) | (unit >= self.clustered))
        unit[tail] = np.fromiter((self.endings.get(w[-ENDING:], self.other) for w in words.take(pa.array(tail)).to_pylist()), np.int64, len(tail))
        return unit, count


def stream(texts: pa.Array, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Unit of each token (an end behind each text), token offsets by text, code of each token (-1: end); the distinct words,
    their units with the end's behind them, and their counts."""
    offsets, words = ascii_words(pc.ascii_lower(pc.fill_null(texts, "")))
    codes, distinct = coded(words)
    ends = offsets[1:] + np.arange(len(offsets) - 1)
    tokens = np.full(len(codes) + len(ends), -1, np.int64)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner] = codes
    unit, count = units.find(distinct)
    kinds = np.append(unit, units.end)
    return kinds[tokens], offsets + np.arange(len(offsets)), tokens, distinct, kinds, count


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of int32, the bytes of like weight together; the first is sorted."""
    import zstandard

    first = np.diff(columns[0], prepend=0)
    planes = [np.ascontiguousarray(c.astype("<i4")).view(np.uint8).reshape(-1, 4).T.tobytes() for c in (first, *columns[1:])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(3, 4, -1)
    first, second, third = (np.ascontiguousarray(x.T).view("<i4").ravel() for x in raw)
    return [np.cumsum(first, dtype=np.int64), second, third.astype(np.int64)]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


def contexts(docs: DataFrame, shared) -> DataFrame:
    """bucket, right, left: units with the units behind and before them and how often, over all texts (an end comes before the
    first word). A unit is in bucket unit % buckets, all of it in one row."""
    units: Units = shared.value
    n = units.end + 1
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = BUCKETS * parts

    def dealt(keys: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        found = {"bucket": [], "side": [], "blob": []}
        a, b = keys // n, keys % n
        for side, (unit, other) in enumerate(((a, b), (b, a))):
            bucket = unit % buckets
            order = np.lexsort((other, unit, bucket))
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(bounds)).tolist():
                at = order[bounds[k] : bounds[k + 1]]
                for column, x in zip(found.values(), (k, side, _pack(unit[at], other[at], count[at])), strict=True):
                    column.append(x)
        return pa.RecordBatch.from_arrays([pa.array(found["bucket"], pa.int32()), pa.array(found["side"], pa.int32()), pa.array(found["blob"], pa.binary())], [*found])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in slices(batches):
            now = stream(part.column("text"), shared.value)[0]
            held.append(np.unique(np.concatenate(([n - 1], now[:-1])) * n + now, return_counts=True))
            size += len(held[-1][0])
            if size >= GATHER:
                yield dealt(*_summed(*map(np.concatenate, zip(*held, strict=True))))
                held, size = [], 0
        if size:
            yield dealt(*_summed(*map(np.concatenate, zip(*held, strict=True))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for x in batches:
            for bucket, side, blob in zip(*(x.column(c).to_pylist() for c in ("bucket", "side", "blob")), strict=True):
                held.setdefault(bucket, ([], []))[side].append(blob)
        for bucket, sides in held.items():
            blobs = []
            for side in sides:
                unit, other, count = map(np.concatenate, zip(*map(_unpack, side), strict=True)) if side else [np.zeros(0, np.int64)] * 3
                keys, count = _summed(unit * n + other, count)
                blobs.append(_pack(keys // n, keys % n, count))
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([b], pa.binary()) for b in blobs)], ["bucket", "right", "left"])

    found = docs.select("text").mapInArrow(gather, "bucket int, side int, blob binary")
    return found.repartition(parts, "bucket").mapInArrow(merge, "bucket int, right binary, left binary")


def pair_counts(rows: DataFrame, kinds: np.ndarray, n: int) -> np.ndarray:
    """n x n counts of a kind behind a kind; kinds by unit."""
    shared = rows.sparkSession.sparkContext.broadcast(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, total = shared.value, np.zeros(n * n)
        for x in batches:
            for blob in x.column("right").to_pylist():
                unit, other, count = _unpack(blob)
                total += np.bincount(kind[unit].astype(np.int64) * n + kind[other], count, n * n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], ["pair", "n"])

    got = rows.select("right").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * n)
    out[np.asarray(got["pair"])] = np.asarray(got["n"])
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit: units move, most frequent first, to where the log-likelihood of the class bigrams is highest."""
    n = len(pairs)
    order = np.argsort(-pairs.sum(0), kind="stable")
    home = np.empty(n, np.int64)
    home[order] = np.minimum(np.arange(n), classes - 1) if n <= classes else np.arange(n) % classes
    member = np.eye(classes)[home]
    right, left = pairs @ member, pairs.T @ member  # of each unit, by the class behind and before
    table = member.T @ right
    for _ in range(rounds):
        moved = 0
        for w in order.tolist():
            old, own = home[w], pairs[w, w]
            r, b = right[w].copy(), left[w].copy()
            r[old] -= own
            b[old] -= own
            if not r.any() and not b.any():
                continue
            table[old] -= r
            table[:, old] -= b
            table[old, old] -= own
            rows, cols = table.sum(1), table.sum(0)
            gain = (_xlogx(table + r) - _xlogx(table)).sum(1) + (_xlogx(table.T + b) - _xlogx(table.T)).sum(1)
            d = np.diag(table)  # counted in both sums, each with a part of the change
            gain += _xlogx(d + r + b + own) - _xlogx(d + r) - _xlogx(d + b) + _xlogx(d)
            gain -= _xlogx(rows + r.sum() + own) - _xlogx(rows) + _xlogx(cols + b.sum() + own) - _xlogx(cols)
            new = int(gain.argmax()) if gain.max() > gain[old] + 1e-6 else int(old)
            table[new] += r
            table[:, new] += b
            table[new, new] += own
            if new != old:
                moved += 1
                home[w] = new
                for m, p in ((right, pairs[:, w]), (left, pairs[w])):
                    m[:, old] -= p
                    m[:, new] += p
        if not moved:
            break
    return home


def gains(table: np.ndarray, old: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log-likelihood of the class bigrams with each unit in each class, but for a part that is the same in all classes of a
    unit. right and left count what is behind and before a unit by class, own the unit behind itself (in its old class)."""
    at, sizes = np.arange(len(old)), (right.sum(1), left.sum(1))
    right, left = right.copy(), left.copy()
    right[at, old] -= own
    left[at, old] -= own
    out = np.zeros(right.shape)
    for side, other, base in ((right, left, table.T), (left, right, table)):
        who, k = np.nonzero(side)
        for a in range(0, len(who), WEIGHED):
            w, c = who[a : a + WEIGHED], k[a : a + WEIGHED]
            n = side[w, c]
            cells = base[c]  # by target class; the unit itself is taken out of its old one
            cells[np.arange(len(w)), old[w]] -= n
            same = np.flatnonzero(c == old[w])
            cells[same] -= other[w[same]]
            cells[same, old[w[same]]] -= own[w[same]]
            np.maximum(cells, 0, out=cells)
            change = _xlogx(cells + n[:, None]) - _xlogx(cells)
            starts = np.flatnonzero(np.diff(w, prepend=-1))
            out[w[starts]] += np.add.reduceat(change, starts, axis=0)
    inside = np.tile(np.diag(table), (len(old), 1))
    inside[at, old] -= right[at, old] + left[at, old] + own
    np.maximum(inside, 0, out=inside)
    out += _xlogx(inside + right + left + own[:, None]) - _xlogx(inside + right) - _xlogx(inside + left) + _xlogx(inside)
    for total, size in zip((table.sum(1), table.sum(0)), sizes, strict=True):
        sums = np.tile(total, (len(old), 1))
        sums[at, old] -= size
        np.maximum(sums, 0, out=sums)
        out -= _xlogx(sums + size[:, None]) - _xlogx(sums)
    return out


def moves(rows: DataFrame, home: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units that would rather be in another class, and that class, all else being as it is."""
    shared, classes, n_units = rows.sparkSession.sparkContext.broadcast((home, table)), len(table), len(home)
    buckets = BUCKETS * max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, table = shared.value
        for x in batches:
            for bucket, *sides in zip(*(x.column(c).to_pylist() for c in ("bucket", "right", "left")), strict=True):
                mine = np.arange(bucket, n_units, buckets)
                tables, own = [], np.zeros(len(mine))
                for k, blob in enumerate(sides):
                    unit, other, count = _unpack(blob)
                    place = unit // buckets
                    tables.append(np.bincount(place * classes + home[other], count, len(mine) * classes).reshape(-1, classes))
                    if not k:
                        own = np.bincount(place[unit == other], count[unit == other], len(mine)).astype(float)
                old = home[mine].astype(np.int64)
                gain = gains(table, old, *tables, own)
                new = gain.argmax(1)
                move = gain.max(1) > gain[np.arange(len(mine)), old] + 1e-6
                yield pa.RecordBatch.from_arrays([pa.array(mine[move].astype(np.int32)), pa.array(new[move].astype(np.int32))], ["unit", "home"])

    got = rows.mapInArrow(run, "unit int, home int").toArrow()
    return np.asarray(got["unit"], dtype=np.int64), np.asarray(got["home"], dtype=np.int64)


def information(table: np.ndarray) -> float:
    """Mutual information of neighbouring classes."""
    n = max(table.sum(), 1)
    return float((_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum() + _xlogx(n)) / n)


def clustered(rows: DataFrame, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit and the class bigrams, by rounds of exchange from home on until the mutual information stays. Units
    move at once; where that makes it worse, a half of them, a quarter or an eighth moves."""
    home = home.astype(np.uint8)
    table = pair_counts(rows, home, CLASSES)
    best = information(table)
    while True:
        unit, new = moves(rows, home, table)
        rose = 0.0
        for share in (1, 2, 4, 8):
            some = (unit * 2654435761 >> 13) % share == 0
            trial = home.copy()
            trial[unit[some]] = new[some]
            counted = pair_counts(rows, trial, CLASSES) if some.any() else table
            rose = information(counted) - best
            if rose > 0:
                home, table, best = trial, counted, best + rose
                break
        if rose <= CONVERGED * best:
            return home.astype(np.int64), table


@dataclass
class Model:
    units: Units
    home: np.ndarray  # class of each unit
    step: np.ndarray  # log10 P(class | class before)
    emit: np.ndarray  # log10 P(unit | its class)
    total: int  # training tokens
    distinct: int
    ends: int
    floor: int  # counts from here on are in the hash arrays
    behind: np.ndarray  # by unit behind the clustered words: tokens of the words that an ending stands for
    kinds: np.ndarray  # by such unit: how many such words

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + ADD) / (self.total + ADD * (self.distinct + 1)))

    def word(self, unit: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P(word | ending)."""
        at = np.maximum(unit - self.units.clustered, 0)
        return np.log10((count + ADD) / (self.behind[at] + ADD * (self.kinds[at] + 1)))


def train(docs: DataFrame, counts: DataFrame) -> Model:
    """From training texts and their stored word counts."""
    spark = docs.sparkSession
    ends = docs.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()[0]
    total, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    floor, least, held = 1, LEAST, 0
    by_size = F.floor(F.log2("n")).cast("int").alias("log2")
    for r in counts.groupBy(by_size).agg(F.count("*").alias("v")).orderBy(F.desc("log2")).collect():  # 63 rows at most
        held += r["v"]
        if floor == 1 and held > KNOWN_HASHES:
            floor = 2 << r["log2"]
        if held > MOST_CLUSTERED:
            least = max(LEAST, 2 << r["log2"])
            break
    floor = min(floor, least)  # every clustered word is in the hash arrays
    by_ending = counts.groupBy(F.expr(f"right(word, {ENDING})").alias("ending")).agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") < least, F.col("n")).otherwise(0)).alias("n"), F.sum((F.col("n") < least).cast("long")).alias("v"))
    common = by_ending.orderBy(F.desc("all"), "ending").limit(ENDINGS).collect()
    rest = by_ending.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()[0]
    number = spark.createDataFrame([(r["ending"], i) for i, r in enumerate(common)], "ending string, e int")
    named = counts.where(F.col("n") >= floor).withColumn("ending", F.expr(f"right(word, {ENDING})")).join(F.broadcast(number), "ending", "left")
    got = named.select(F.xxhash64("word").alias("h"), "n", F.coalesce("e", F.lit(len(common))).cast("short").alias("e")).toArrow()
    h, n, e = (np.asarray(got[c]).astype(t) for c, t in (("h", np.int64), ("n", np.int64), ("e", np.int64)))
    order = np.lexsort((h, -n))
    h, n, e = h[order], n[order], e[order]
    size = int((n >= least).sum())
    at = np.argsort(h)
    units = Units(h[at], at.astype(np.int32), n[at].astype(np.int32) if len(n) == 0 or n.max() < 2**31 else n[at], size, {r["ending"]: size + i for i, r in enumerate(common)})
    behind, kinds = np.zeros(units.end + 1), np.zeros(units.end + 1)
    for i, r in enumerate(common):
        behind[size + i], kinds[size + i] = r["n"], r["v"]
    behind[units.other], kinds[units.other] = (rest["n"] or 0) - behind.sum(), (rest["v"] or 0) - kinds.sum()

    rows = stored(contexts(docs, spark.sparkContext.broadcast(units)), "contexts")
    # The head and the endings among themselves, where an ending stands for all words behind the head; then all units.
    head = min(HEAD, size)
    first = np.concatenate((np.arange(head), head + e[head:size], head + np.arange(len(common) + 2)))
    n_first = head + len(common) + 2
    home, table = clustered(rows, exchange(pair_counts(rows, first, n_first), CLASSES)[first])
    share = (table.sum(0) + 1) / (table.sum() + CLASSES)
    step = (table + PRIOR * share) / (table.sum(1, keepdims=True) + PRIOR)
    seen = np.concatenate((n[:size], behind[size : units.end], [ends])) + ADD  # a smoothed emission: every unit may come
    emit = seen / np.bincount(home, seen, CLASSES)[home]
    return Model(units, home.astype(np.uint8), np.log10(step), np.log10(emit).astype(np.float32), total, distinct, ends, floor, behind[size:], kinds[size:])


_SCHEMA = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<struct<word: string, unit: int, times: int>>"


def _partial(docs: DataFrame, shared) -> DataFrame:
    """Scores without the words that the hash arrays lack; those come as rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        kind = pa.list_(pa.struct([("word", pa.string()), ("unit", pa.int32()), ("times", pa.int32())]))
        for part in slices(batches):
            units, offsets, tokens, distinct, of_word, count = stream(part.column("text"), m.units)
            before = np.concatenate(([m.units.end], units[:-1]))
            count = np.append(count, m.ends)
            tail = of_word >= m.units.clustered
            tail[-1] = False
            have = count >= 0
            base = np.where(have, m.base(np.maximum(count, 0)), 0)
            more = np.where(have & tail, m.word(of_word, np.maximum(count, 0)), 0)
            score = m.step[m.home[before], m.home[units]] + m.emit[units] + more[tokens]
            lacking = np.flatnonzero(~have[tokens])
            doc = np.searchsorted(offsets, lacking, side="right") - 1
            pairs, times = np.unique(doc * (len(distinct) + 1) + tokens[lacking], return_counts=True)
            doc, word = pairs // (len(distinct) + 1), pairs % (len(distinct) + 1)
            bounds = pa.array(np.searchsorted(doc, np.arange(len(offsets))).astype(np.int32))
            words = pa.StructArray.from_arrays([distinct.take(pa.array(word)), pa.array(of_word[word].astype(np.int32)), pa.array(times.astype(np.int32))], fields=list(kind.value_type))
            cols = [part.column(c) for c in ("key", "doc_id", "held_out")]
            cols += [pa.array(np.diff(offsets)), pa.array(per_row((count > 0)[tokens].astype(np.int64), offsets)), pa.array(per_row(base[tokens], offsets)), pa.array(per_row(score, offsets))]
            yield pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(bounds, words)], ["key", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"])

    ready = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long"), "held_out", "text")
    return ready.mapInArrow(run, _SCHEMA)


def class_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learns from the rows that are not held out."""
    spark = docs.sparkSession
    split = docs.select("doc_id", "text", held_out.alias("held_out"))
    learned = split.where(~F.col("held_out"))
    counts = stored(word_counts(learned), "word-counts")
    model = train(learned, counts)
    partial = stored(_partial(split, spark.sparkContext.broadcast(model)), "partial-scores")
    rest = partial.select("key", F.explode("rest").alias("x")).select("key", F.col("x.word").alias("word"), F.col("x.unit").alias("unit"), F.col("x.times").alias("times"))
    found = rest.join(counts.where(F.col("n") < model.floor), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # The sums under each ending; words that the hash arrays lack are all behind endings.
    under = spark.createDataFrame([(model.units.clustered + i, float(b + ADD * (k + 1))) for i, (b, k) in enumerate(zip(model.behind, model.kinds, strict=True))], "unit int, under double")
    base = F.col("times") * F.log10((F.col("n") + ADD) / F.lit(model.total + ADD * (model.distinct + 1)))
    word = F.col("times") * F.log10((F.col("n") + ADD) / F.col("under"))
    known = F.when(F.col("n") > 0, F.col("times")).otherwise(0)
    sums = found.join(F.broadcast(under), "unit").groupBy("key").agg(F.sum(base).alias("more_base"), F.sum(word).alias("more"), F.sum(known).alias("more_known"))
    out = partial.drop("rest").join(sums, "key", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", plus("n_known", "more_known").alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), plus("base_score", "more_base").alias("base_score"), plus("score", "more").alias("score"))
