"""Quality rules: base counts, and an n-gram perplexity with a lower and an upper band for each language.

The model is a modified Kneser-Ney model of the code points' n-grams, of all orders up to ORDER, and every text is scored by one
that has not seen it: documents fall into two halves by their text (so copies are in one), each half has its model, and a text is
scored by that of the other. Spark counts every n-gram of every text by half and derives the lower orders' continuation counts,
the discounts and the back-off weights of both models. Then it joins them to probabilities for every n-gram of either half, so
that one that a model lacks gets what its shorter endings have there, down to an even share of the code points. So the model grows
with the corpus, and nothing of it is cut.

Scores read it as a sorted hash array: the hashes of all n-grams of ORDER code points with both log probabilities, and an index of
the leading bits. It is broadcast where it has HELD entries (16 bytes each) at most. Of a larger model the most frequent n-grams,
HELD at most, are broadcast, and the other n-grams of each text, which are rare by what they are, are joined with the stored model
(every n-gram that is scored is there). Both ways score alike.

A document has two log perplexities: the negative log10 probability of all its code points by word, and by code point in words.
Marks and symbols around words raise both, lone ones lower the first, and what is spelled evenly lowers the second. The median
and the quartiles over all documents with a word of a language (lang; null is a language of its own) set a band for each, wider
for short texts, whose means scatter more; a document outside either band is rejected. The same rule holds for any number of
documents: the quartiles of few are drawn towards those of all languages, around the language's own median.

Null or empty text: no words, so base_failed. Repeated rows each get their row. Very long texts are read whole. Ties of
quartiles are exact (an exact percentile of values rounded to 3 digits). A band of no width never rejects what lies on
its edge. With all texts in one half, every probability is 1. An empty table gives an empty result. Other columns are ignored by
`quality` and kept by `reject`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import ascii_words, coded, hot_join, per_row, removed, slices, spread, stored, text_of

ORDER = 5
FEWEST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5
#: Texts as which the spread of all languages counts in that of one.
PRIOR = 20
#: Bytes of text at once (some sixty bytes of arrays a character), n-grams that a task gathers before it hands them on, and
#: entries of a model that is broadcast.
SLICE, GATHER, HELD = 2 << 20, 300_000, 8_000_000
#: Half-widths of a band beyond its quartiles, in interquartile ranges, and the length below which it widens. They were chosen on
#: the labels of even ids at sf0.1, so that a few in a thousand of those labelled good are lost (README has the figures of odd ids).
BELOW, ABOVE, SHORT = 3, 3, 3000
MEASURES = ["word_perplexity", "char_perplexity"]
BASE = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars long, digest binary, mean double"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points by text; all code points, ORDER - 1 line breaks in front of each text; where in them each character is."""
    plain = pc.fill_null(texts, "")
    front = "\n" * (ORDER - 1)
    joined = b"".join(front.encode() + x for x in plain.cast(pa.binary()).to_pylist())
    flat = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
    size = np.asarray(pc.utf8_length(plain), dtype=np.int64)
    return size, flat, spread(np.cumsum(size + ORDER - 1) - size, size)


def hashes(flat: np.ndarray, order: int) -> np.ndarray:
    """64-bit hash of the n-gram that begins at each place of flat and ends within it."""
    out = np.full(max(0, len(flat) - order + 1), order, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(order):
            out = out * _FACTOR + flat[k : k + len(out)]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def _spelled(flat: np.ndarray, begins: np.ndarray) -> list[str]:
    """The n-grams of ORDER code points that begin at these places."""
    text = flat[begins[:, None] + np.arange(ORDER)].tobytes().decode("utf-32-le")
    return [text[i : i + ORDER] for i in range(0, len(text), ORDER)]


def half_of() -> Column:
    """0 or 1 by the text."""
    return F.pmod(F.xxhash64(text_of()), F.lit(2)).cast("int").alias("half")


def gram_counts(docs: DataFrame) -> DataFrame:
    """gram, n_0, n_1: how often each n-gram of ORDER code points ends at a character of any text of each half; tasks add up before
    the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def given() -> pa.RecordBatch:
            counts = list(held.values())
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array([c[h] for c in counts], pa.int64()) for h in (0, 1))], ["gram", "n_0", "n_1"])

        for part in slices(batches, limit=SLICE):
            for half in (0, 1):
                _, flat, own = points(part.column("text").filter(pc.equal(part.column("half"), half)))
                _, first, n = np.unique(hashes(flat, ORDER)[own - ORDER + 1], return_index=True, return_counts=True)
                for gram, k in zip(_spelled(flat, own[first] - ORDER + 1), n.tolist(), strict=True):
                    held.setdefault(gram, [0, 0])[half] += k
            if len(held) >= GATHER:
                yield given()
                held.clear()
        yield given()

    sums = [F.sum(f"n_{h}").alias(f"n_{h}") for h in (0, 1)]
    return docs.select("text", half_of()).mapInArrow(count, "gram string, n_0 long, n_1 long").groupBy("gram").agg(*sums)


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Of counts 1, 2 and 3 or more. An order without the counts that the estimate needs takes a fixed share."""
    n = (n1, n2, n3, n4)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1 * k), 0.9 * k) if n[k - 1] else 0.5 * k for k in (1, 2, 3)]


def estimates(docs: DataFrame) -> DataFrame:
    """gram, n (in both halves), logp_0, logp_1: every n-gram of ORDER code points with its log10 probability in the modified
    Kneser-Ney models of both halves, a stored table, made by joins over n-grams."""
    levels = [stored(gram_counts(docs), "grams")]
    for length in range(ORDER - 1, 0, -1):  # lower orders count the distinct code points in front
        ahead = [F.count(F.when(F.col(f"n_{h}") > 0, 1)).alias(f"n_{h}") for h in (0, 1)]
        levels.insert(0, stored(levels[0].groupBy(F.expr(f"right(gram, {length})").alias("gram")).agg(*ahead), "grams"))
    counted = None
    for length, level in enumerate(levels, 1):
        sums = [F.sum((F.col(f"n_{h}") == k).cast("long")).alias(f"n{k}_{h}") for h in (0, 1) for k in (1, 2, 3, 4)]
        row = level.agg(*sums, *(F.count(F.when(F.col(f"n_{h}") > 0, 1)).alias(f"v_{h}") for h in (0, 1))).select(F.lit(length).alias("length"), "*")
        counted = row if counted is None else counted.union(row)
    cuts, kinds = {}, {}
    for r in counted.collect():  # ORDER rows
        for h in (0, 1):
            cuts[r["length"], h] = _discounts(*((r[f"n{k}_{h}"] or 0) for k in (1, 2, 3, 4)))
            kinds[h] = r[f"v_{h}"] if r["length"] == 1 else kinds[h]
    lower = None
    for length, level in enumerate(levels, 1):
        n = {h: F.col(f"n_{h}") for h in (0, 1)}
        off = {h: F.when(n[h] == 0, 0.0).when(n[h] == 1, cuts[length, h][0]).when(n[h] == 2, cuts[length, h][1]).otherwise(cuts[length, h][2]) for h in (0, 1)}
        ahead = F.expr(f"left(gram, {length - 1})").alias("context")
        totals = level.groupBy(ahead).agg(*(x.alias(f"{c}_{h}") for h in (0, 1) for c, x in (("total", F.sum(n[h])), ("off", F.sum(off[h])))))
        joined = level.select("gram", "n_0", "n_1", ahead, F.expr(f"right(gram, {length - 1})").alias("suffix")).join(totals, "context")
        below = {h: F.lit(1 / (kinds[h] + 1)) for h in (0, 1)}
        if lower is not None:  # every ending of an n-gram is one of the order below
            joined = joined.join(lower.select(F.col("gram").alias("suffix"), *(F.col(f"p_{h}").alias(f"below_{h}") for h in (0, 1))), "suffix")
            below = {h: F.col(f"below_{h}") for h in (0, 1)}
        p = [F.when(F.col(f"total_{h}") > 0, (n[h] - off[h] + F.col(f"off_{h}") * below[h]) / F.col(f"total_{h}")).otherwise(below[h]).alias(f"p_{h}") for h in (0, 1)]
        before, lower = lower, stored(joined.select("gram", "n_0", "n_1", *p), "probabilities")
        for table in (level, before):
            if table is not None:
                removed(table)
    logs = [F.log10(f"p_{h}").cast("float").alias(f"logp_{h}") for h in (0, 1)]
    return lower.select("gram", (F.col("n_0") + F.col("n_1")).alias("n"), *logs)


@dataclass
class HashArray:
    """Sorted hashes with a row of values each, and where the hashes of each leading bits begin."""

    keys: np.ndarray
    values: np.ndarray
    begins: np.ndarray
    bits: int
    longest: int

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> HashArray:
        order = np.argsort(keys)
        keys, bits = keys[order], max(1, int(len(keys)).bit_length())
        begins = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)
        begins = np.append(begins, np.int32(len(keys)))
        return cls(keys, values[order].astype(np.float32), begins, bits, int(np.diff(begins).max()))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its values, or zeros."""
        hit, out = np.zeros(len(keys), bool), np.zeros((len(keys), self.values.shape[1]), np.float32)
        if not len(self.keys):
            return hit, out
        at, left = self.begins[(keys >> np.uint64(64 - self.bits)).astype(np.int64)], np.arange(len(keys))
        for _ in range(self.longest):
            some = self.keys[np.minimum(at, len(self.keys) - 1)]
            same = some == keys[left]
            hit[left[same]], out[left[same]] = True, self.values[at[same]]
            more = some < keys[left]  # hashes are sorted: a larger one ends the search
            left, at = left[more], at[more] + 1
            if not len(left):
                break
        return hit, out


def held(grams: DataFrame) -> HashArray:
    """Both log probabilities of n-grams as an array on the driver; whoever calls has checked their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            flat = np.frombuffer("".join(x.column("gram").to_pylist()).encode("utf-32-le"), np.uint32)
            keys = hashes(flat, ORDER)[::ORDER] if len(flat) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), x.column("logp_0"), x.column("logp_1")], ["key", "logp_0", "logp_1"])

    got = grams.select("gram", "logp_0", "logp_1").mapInArrow(run, "key long, logp_0 float, logp_1 float").toArrow()
    values = np.stack([np.asarray(got[f"logp_{h}"], dtype=np.float32) for h in (0, 1)], axis=1).reshape(-1, 2)
    return HashArray.of(np.asarray(got["key"], dtype=np.int64).view(np.uint64), values)


def frequent(found: DataFrame) -> int:
    """From how many occurrences on the n-grams are HELD at most."""
    floor, many = 1, 0
    by_size = F.floor(F.log2("n")).cast("int").alias("log2")
    for r in found.groupBy(by_size).agg(F.count("*").alias("v")).orderBy(F.desc("log2")).collect():  # 63 rows at most
        many += r["v"]
        if many > HELD:
            return 2 << r["log2"]
    return floor


def repeated_words(offsets: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of WINDOW words found twice or more there. Windows meet by hash; equality is
    then checked word by word."""
    n, texts = len(codes), len(offsets) - 1
    doc = np.repeat(np.arange(texts), np.diff(offsets))
    inside = np.flatnonzero(np.arange(n) + WINDOW <= np.repeat(offsets[1:], np.diff(offsets)))
    if not len(inside):
        return np.zeros(texts, np.int64)
    rng = np.random.default_rng(5)
    odd = rng.integers(1 << 62, (1 << 63) - 1, WINDOW + 1, dtype=np.int64).astype(np.uint64) * 2 + 1
    mixed = doc[inside].astype(np.uint64) * odd[WINDOW]
    for k in range(WINDOW):
        word = codes[inside + k].astype(np.uint64) + np.uint64(1)
        mixed += (word ^ (word << np.uint64(29))) * odd[k]
    order = np.argsort(mixed, kind="stable")
    near = np.flatnonzero(mixed[order[1:]] == mixed[order[:-1]])
    a, b = inside[order[near]], inside[order[near + 1]]
    same = doc[a] == doc[b]
    for k in range(WINDOW):
        same &= codes[a + k] == codes[b + k]
    marks = np.zeros(n + 1, np.int64)
    at = np.unique(np.concatenate((a[same], b[same])))
    np.add.at(marks, at, 1)
    np.add.at(marks, at + WINDOW, -1)
    return per_row((np.cumsum(marks[:n]) > 0).astype(np.int64), offsets)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line."""
    lists = pc.split_pattern(texts, "\n")
    lines, doc = lists.flatten(), np.asarray(pc.list_parent_indices(lists), dtype=np.int64)
    worded = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]")
    codes, distinct = coded(lines.filter(worded))
    doc = doc[np.asarray(worded)]
    first = np.unique(doc * max(1, len(distinct)) + codes) // max(1, len(distinct))
    return np.bincount(doc, minlength=len(texts)) - np.bincount(first, minlength=len(texts))


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    texts = pc.fill_null(texts, "")
    offsets, words = ascii_words(texts)
    codes, _ = coded(words)
    return {
        "n_words": np.diff(offsets),
        "word_chars": per_row(np.asarray(pc.utf8_length(words), dtype=np.int64), offsets),
        "n_symbols": np.asarray(pc.count_substring_regex(texts, r"[#*$%&|<>]"), dtype=np.int64),
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": repeated_words(offsets, codes),
    }


def log_perplexity(texts: pa.Array, half: np.ndarray, model: HashArray) -> np.ndarray:
    """Mean negative log10 probability of each text's code points by the model of the other half; 0 for an empty one."""
    size, flat, own = points(texts)
    values = model.find(hashes(flat, ORDER)[own - ORDER + 1])[1]
    logs = np.where(np.repeat(half, size) == 0, values[:, 1], values[:, 0]).astype(np.float64)
    return -per_row(logs, np.concatenate(([0], np.cumsum(size)))) / np.maximum(size, 1)


def measures(mean: np.ndarray, size: np.ndarray, n_words: np.ndarray, word_chars: np.ndarray) -> list[np.ndarray]:
    """Both log perplexities, rounded to 3 digits; 0 for a text without a word."""
    total = np.where(n_words > 0, mean * size, 0)
    return [np.floor(total / np.maximum(n, 1) * 1000 + 0.5) / 1000 for n in (n_words, word_chars)]


def _digest():
    return F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest")


def _rest(docs: DataFrame, found: DataFrame, model, floor: int) -> DataFrame:
    """digest, more: the log10 probability of what a part of the model lacks, for each text that has such n-grams."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            size, flat, own = points(part.column("text"))
            keys = hashes(flat, ORDER)[own - ORDER + 1]
            lacking = np.flatnonzero(~model.value.find(keys)[0])
            doc, keys = np.repeat(np.arange(len(size)), size)[lacking], keys[lacking]
            order = np.lexsort((keys, doc))
            new = np.ones(len(order), bool)
            new[1:] = (keys[order[1:]] != keys[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(order)))
            of = pa.array(doc[order[first]])
            cols = [part.column("digest").take(of), part.column("half").take(of), pa.array(_spelled(flat, own[lacking[order[first]]] - ORDER + 1), pa.string()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(cols, ["digest", "half", "gram", "times"])

    # An n-gram of a text that has many copies is frequent, so few copies come here.
    grams = docs.select(_digest(), half_of(), "text").mapInArrow(spell, "digest binary, half int, gram string, times long").dropDuplicates(["digest", "gram"])
    logp = F.when(F.col("half") == 0, F.col("logp_1")).otherwise(F.col("logp_0")).cast("double")
    return grams.join(found.where(F.col("n") < floor), "gram").groupBy("digest").agg(F.sum(F.col("times") * logp).alias("more"))


def scored(docs: DataFrame, model) -> DataFrame:
    """doc_id, lang, base counts, n_chars, digest, and mean (log_perplexity by model, a broadcast one)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            text = part.column("text")
            cols = {"doc_id": part.column("doc_id"), "lang": part.column("lang")} | {k: pa.array(v, pa.int64()) for k, v in base_counts(text).items()}
            cols |= {"n_chars": pc.utf8_length(pc.fill_null(text, "")).cast(pa.int64()), "digest": part.column("digest")}
            cols["mean"] = pa.array(log_perplexity(text, np.asarray(part.column("half")), model.value))
            yield pa.RecordBatch.from_pydict(cols)

    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), _digest(), half_of(), "text").mapInArrow(score, BASE)


def measured(scores: DataFrame) -> DataFrame:
    """scores with both MEASURES for its mean."""
    total = F.when(F.col("n_words") > 0, F.col("mean") * F.col("n_chars")).otherwise(0.0)
    by = [(F.floor(total / F.greatest(F.col(n), F.lit(1)) * 1000 + 0.5) / 1000).alias(m) for m, n in zip(MEASURES, ("n_words", "word_chars"), strict=True)]
    return scores.select("*", *by)


def _scatter(size):
    """How much wider texts of a size scatter than very long ones."""
    return np.sqrt(1 + SHORT / np.maximum(size, 1))


def bands(scores: DataFrame) -> dict[str | None, np.ndarray]:
    """By language, for each of MEASURES: its median over all texts that have a word, and quartiles of the distance from it over
    the scatter of a text's size. These are averaged with those of all languages, which count as PRIOR texts."""
    some = scores.where("n_words > 0").select("lang", "n_chars", *MEASURES)
    # Values are rounded to 3 and 4 digits, so the exact percentile keeps few distinct ones for each group.
    middle = some.groupBy(F.col("lang").alias("of")).agg(*(F.percentile(m, F.lit(0.5)).alias(f"{m}_middle") for m in MEASURES))
    scatter = F.sqrt(1 + SHORT / F.greatest("n_chars", F.lit(1)))
    far = [F.round((F.col(m) - F.col(f"{m}_middle")) / scatter, 4).alias(f"{m}_far") for m in MEASURES]
    each = some.join(F.broadcast(middle), F.col("lang").eqNullSafe(F.col("of"))).select("*", *far)
    sums = [F.struct(F.first(f"{m}_middle").alias("middle"), F.percentile(f"{m}_far", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).alias(m) for m in MEASURES]
    rows = each.groupBy("lang").agg(F.count("*").alias("n"), *sums).collect()  # one a language
    if not rows:
        return {}
    n, q = np.array([r["n"] for r in rows]), np.array([[r[m]["q"] for m in MEASURES] for r in rows])
    q = (n[:, None, None] * q + PRIOR * np.average(q, axis=0, weights=n)) / (n[:, None, None] + PRIOR)
    return {r["lang"]: np.array([[r[m]["middle"], *x] for m, x in zip(MEASURES, own.tolist(), strict=True)]) for r, own in zip(rows, q, strict=True)}


def verdict(found: dict[str | None, np.ndarray], lang: list, n_words: np.ndarray, n_repeat: np.ndarray, size: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """base_failed, kept; values has MEASURES."""
    failed = (n_words < FEWEST_WORDS) | (100 * n_repeat > MOST_REPEATED * n_words)
    # A language without a band has no text with a word, which fails.
    edges = np.array([found.get(x, np.zeros((len(MEASURES), 3))) for x in lang]).reshape(-1, len(MEASURES), 3)
    kept = ~failed
    for value, (middle, low, high) in zip(values, edges.transpose(1, 2, 0), strict=True):
        wide, far = np.maximum(high - low, 0.01), (value - middle) / _scatter(size)
        kept &= (far >= low - BELOW * wide) & (far <= high + ABOVE * wide)
    return failed, kept


def _scores(docs: DataFrame) -> tuple[DataFrame, object]:
    """Stored scores of all texts, each by the model of the half it isn't in, and the broadcast model, or None where it is too large."""
    found = estimates(docs)
    if found.count() <= HELD:
        model = docs.sparkSession.sparkContext.broadcast(held(found))
        return stored(measured(scored(docs, model)), "quality"), model
    floor = frequent(found)
    model = docs.sparkSession.sparkContext.broadcast(held(found.where(F.col("n") >= floor)))
    rows = stored(scored(docs, model), "partial-scores")
    rows = hot_join(rows, _rest(docs, found, model, floor), "digest", rows.count())
    mean = F.col("mean") - F.coalesce("more", F.lit(0.0)) / F.greatest("n_chars", F.lit(1))
    return stored(measured(rows.withColumn("mean", mean).drop("more")), "quality"), None


def judged(scores: DataFrame) -> DataFrame:
    """The rows of `measured` with base_failed and kept."""
    found = bands(scores)
    names = [c for c in scores.columns if c not in ("n_chars", "mean")]
    kind = ", ".join(f"{c} {t}" for c, t in scores.dtypes if c in names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            values = [np.asarray(x.column(c)) for c in ("n_words", "n_repeat_words", "n_chars", *MEASURES)]
            failed, kept = verdict(found, x.column("lang").to_pylist(), *values[:3], values[3:])
            yield pa.RecordBatch.from_arrays([x.column(c) for c in names] + [pa.array(failed), pa.array(kept)], [*names, "base_failed", "kept"])

    return scores.mapInArrow(judge, f"{kind}, base_failed boolean, kept boolean")


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and both perplexities."""
    rows = judged(_scores(docs)[0])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *MEASURES)


def reject(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns. With a broadcast model scores are made anew, so that no text
    is written; else the rejected texts are met by language and digest."""
    scores, model = _scores(docs)
    if model is None:
        gone = judged(scores).where(~F.col("kept")).select(F.col("lang").alias("_gone_lang"), F.col("digest").alias("_gone_digest")).distinct()
        same = (_digest() == gone["_gone_digest"]) & docs["lang"].cast("string").eqNullSafe(gone["_gone_lang"])
        return docs.join(gone, same, "left_anti")
    found = bands(scores)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            own = pa.RecordBatch.from_arrays(part.columns[:-1], schema=pa.schema(list(part.schema)[:-1]))
            text = own.column("text")
            base, size = base_counts(text), np.asarray(pc.utf8_length(pc.fill_null(text, "")), dtype=np.int64)
            mean = log_perplexity(text, np.asarray(part.columns[-1]), model.value)
            values = measures(mean, size, base["n_words"], base["word_chars"])
            _, kept = verdict(found, own.column("lang").cast(pa.string()).to_pylist(), base["n_words"], base["n_repeat_words"], size, values)
            yield own.filter(pa.array(kept))

    return docs.select("*", half_of().alias("_half")).mapInArrow(keep, docs.schema)
