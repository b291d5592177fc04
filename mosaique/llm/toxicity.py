"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words fall into classes: insult, threat, target, negation, reporting, other. Insults come with weights that are learned
from labels, as whole words and as stems (the first 3 to 6 letters; the shorter, the less a stem weighs, and the more
different words of it must be found mostly in toxic texts); the other classes are fixed word lists. Five
transducers read a clause: insult and threat emit matches, target raises the weight of a match near a person, negation and
reported speech lower it. Their product (composition over the class alphabet, built once) reads each clause once, and a
clause's score is the sum of what it emits. A logistic curve over a text's sum, fitted to the labels, gives 0 to 1.

Labels are taken from a bounded sample, by the hash of the id (SAMPLE_ROWS expected rows, a parameter), and its words bound
the lexicon. The sampled texts become one stored table. Scores read whole texts and no other column.

Null and empty text: no clause, so the lowest score. Repeated rows each get their row; labels of one id that disagree count
as toxic. With no label, or one class only, the score is the smoothed share of toxic rows. Very long texts are read whole;
the clause is the unit, and only clauses with a match are walked through. An empty table gives an empty result. Other
columns are ignored by `toxicity` and kept by `reject`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import coded, slices, split_at, stored

SAMPLE_ROWS, LEAST_TEXTS, LEAST_SHARE = 40_000, 4, 0.8
#: Letters of a stem, with the different words that it needs and the share of its weight that it keeps.
STEMS = {3: (6, 0.4), 4: (5, 0.5), 5: (4, 0.6), 6: (3, 0.7)}
TOXIC_AT = 0.7
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Words of the closed classes, in English, German, French and Spanish.
WORDS = {
    THREAT: "kill hurt beat destroy burn shoot stab hang punish töten umbringen schlagen zerstören tuer frapper détruire brûler matar golpear destruir quemar".split(),
    TARGET: "you your yours he she they them him her u du dich dir ihr euch sie ihn tu toi te vous vos il elle ils tú ti te usted ustedes él ella ellos".split(),
    NEGATION: "not no never isn aren wasn don doesn nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split(),
    REPORT: "said says quoted wrote called reported claimed sagte schrieb nannte zitierte dit écrit cité dijo escribió llamó citó".split(),
}
NEAR, THREAT_WEIGHT, TARGET_GAIN, NEGATED, REPORTED = 3, 3.0, 1.5, 0.5, 0.6
CLAUSE = "\x02"

Step = Callable[[int, int], tuple[int, float, bool]]


def insult(state: int, kind: int) -> tuple[int, float, bool]:
    """Emits on every insult, with the word's own weight."""
    return 0, 1.0, kind == INSULT


def threat(state: int, kind: int) -> tuple[int, float, bool]:
    """Emits where a target follows a threat within NEAR words. State: words left to wait."""
    if kind == THREAT:
        return NEAR, 1.0, False
    return (0, THREAT_WEIGHT, True) if state and kind == TARGET else (max(0, state - 1), 1.0, False)


def target(state: int, kind: int) -> tuple[int, float, bool]:
    """Raises what comes within NEAR words behind a target."""
    return (NEAR if kind == TARGET else max(0, state - 1)), TARGET_GAIN if state else 1.0, False


def negation(state: int, kind: int) -> tuple[int, float, bool]:
    """Lowers what comes within NEAR - 1 words behind a negation."""
    return (NEAR - 1 if kind == NEGATION else max(0, state - 1)), NEGATED if state else 1.0, False


def reported(state: int, kind: int) -> tuple[int, float, bool]:
    """Lowers the rest of a clause behind a reporting verb."""
    return int(state or kind == REPORT), REPORTED if state else 1.0, False


def compose(*steps: Step) -> tuple[np.ndarray, np.ndarray]:
    """The product transducer: next state and emitted factor (0: nothing) by state and class; state 0 begins a clause."""
    known = {(0,) * len(steps): 0}
    follow, emit, todo = [], [], [(0,) * len(steps)]
    while todo:
        state = todo.pop(0)
        after, out = [], []
        for kind in range(6):
            moves = [f(s, kind) for f, s in zip(steps, state, strict=True)]
            new = tuple(m[0] for m in moves)
            if new not in known:
                known[new] = len(known)
                todo.append(new)
            after.append(known[new])
            out.append(float(np.prod([m[1] for m in moves])) if any(m[2] for m in moves) else 0.0)
        follow.append(after)
        emit.append(out)
    return np.array(follow), np.array(emit)


GRAMMAR = compose(insult, threat, target, negation, reported)
FOLLOW, EMIT = GRAMMAR
FIXED = {w: k for k, words in WORDS.items() for w in words}


def clause_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lower-case words by text, with a CLAUSE mark at each end of a clause."""
    out = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[.!?;\n]+", f" {CLAUSE} ")
    return split_at(pc.replace_substring_regex(out, f"[^\\pL\\pM{CLAUSE}]+", " "), " ")


def patterns(word: str) -> list[str]:
    """The word, and its stems as patterns."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) >= k)]


def clause_sums(texts: pa.Array, lexicon: dict[str, float], grammar: tuple[np.ndarray, np.ndarray] = GRAMMAR) -> np.ndarray:
    """Sum over the clauses of each text of what the grammar emits."""
    follow, emit = grammar
    offsets, words = clause_words(texts)
    codes, distinct = coded(words)
    kinds, weights = np.zeros(len(distinct), np.int64), np.ones(len(distinct))
    for i, w in enumerate(distinct.to_pylist()):
        hit = max((lexicon.get(p, 0.0) for p in patterns(w)), default=0.0)
        kinds[i], weights[i] = (INSULT, hit) if hit else (FIXED.get(w, OTHER), THREAT_WEIGHT)
    kind, weight = kinds[codes], weights[codes]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    marks = np.asarray(pc.equal(words, CLAUSE)) if len(words) else np.zeros(0, bool)
    clause = np.cumsum(marks) + doc
    out = np.zeros(len(offsets) - 1)
    live = np.isin(clause, np.unique(clause[(kind == INSULT) | (kind == THREAT)])) & ~marks
    state, last = 0, -1
    for i, c, k, w in zip(np.flatnonzero(live).tolist(), clause[live].tolist(), kind[live].tolist(), weight[live].tolist(), strict=True):
        state = state if c == last else 0
        if (factor := emit[state, k]) > 0:
            out[doc[i]] += factor * (w if k == INSULT else 1.0)
        state, last = follow[state, k], c
    return out


def training(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic of about `rows` labelled documents at most, one of each distinct text and label; ids are taken by their hash."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    share = min(1.0, rows / max(1, marked.count()))
    drawn = F.pmod(F.xxhash64(F.lit("label"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    picked = marked.where(drawn).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    few = docs.sparkSession.createDataFrame(picked.toArrow()) if not picked.isEmpty() else picked
    return stored(docs.where(F.col("text").isNotNull()).join(F.broadcast(few), "doc_id").select("text", "toxic").distinct(), "labelled")


def word_counts(rows: DataFrame) -> DataFrame:
    """word, toxic, clean: of how many toxic and clean texts each word or stem is part; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            offsets, words = clause_words(part.column("text"))
            codes, distinct = coded(words)
            n = max(1, len(distinct))
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            pairs = np.unique(doc * n + codes)
            toxic = np.asarray(part.column("toxic"))[pairs // n] > 0
            found: dict[str, list[int]] = {}
            text_words = distinct.to_pylist()
            seen: set[tuple[int, str]] = set()
            last = -1
            for d, c, t in zip((pairs // n).tolist(), (pairs % n).tolist(), toxic.tolist(), strict=True):
                if d != last:
                    seen, last = set(), d
                for p in patterns(text_words[c]):
                    if p not in seen:
                        seen.add(p)
                        found.setdefault(p, [0, 0])[0 if t else 1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found)), *(pa.array([v[k] for v in found.values()], pa.int64()) for k in (0, 1))], ["word", "toxic", "clean"])

    return rows.mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(rows: DataFrame, grammar: tuple[np.ndarray, np.ndarray] = GRAMMAR) -> tuple[dict[str, float], tuple[float, float]]:
    """Insults with weights, and the curve's intercept and slope over log1p of a text's sum."""
    totals = {int(r["toxic"] > 0): r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        share = (bad + 0.5) / (bad + good + 1)
        return {}, (float(np.log(share / (1 - share))), 0.0)
    # The share of toxic texts among those with the word, at even prior odds.
    odds = ((F.col("toxic") + 0.1) / bad) / ((F.col("clean") + 0.5) / good)
    share = F.col("toxic") / (F.col("toxic") + F.col("clean") + 0.5)
    counts = stored(word_counts(rows).where(~F.col("word").startswith(CLAUSE)).withColumn("share", share).withColumn("weight", F.log10(odds)), "word-counts")
    kept = counts.where((F.col("toxic") >= LEAST_TEXTS) & (F.col("share") >= LEAST_SHARE) & (F.col("weight") > 0))
    # A stem needs several different words that are found mostly in toxic texts themselves.
    telling = counts.where(~F.col("word").endswith("*") & (F.col("share") >= 0.5))
    stems = telling.select(F.explode(F.array(*(F.when(F.length("word") >= k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS))).alias("word"))
    letters = F.length("word") - 1
    by_letters = lambda i: F.element_at(F.create_map(*(F.lit(x) for k, v in STEMS.items() for x in (k, v[i]))), letters)
    supported = stems.where("word is not null").groupBy("word").agg(F.count("*").alias("words")).where(F.col("words") >= by_letters(0))
    stem = F.col("word").endswith("*")
    lexicon = {r["word"]: float(r["weight"]) for r in kept.where(~stem).select("word", "weight").collect()}  # words of a bounded sample
    few = kept.where(stem).join(supported, "word", "left_semi").select("word", (F.col("weight") * by_letters(1)).alias("weight"))
    lexicon |= {r["word"]: float(r["weight"]) for r in few.collect()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(clause_sums(part.column("text"), lexicon, grammar)), part.column("toxic")], ["x", "toxic"])

    got = rows.mapInArrow(sums, "x double, toxic int").toArrow()  # two numbers a sampled row
    return lexicon, curve(np.log1p(np.asarray(got["x"])), np.asarray(got["toxic"]) > 0)


def curve(x: np.ndarray, y: np.ndarray, penalty: float = 0.02) -> tuple[float, float]:
    """Logistic regression by Newton's method."""
    w = np.full(len(x), 1 / max(1, len(x)))
    a, b = 0.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(w * (p - y)).sum(), (w * (p - y) * x).sum() + penalty * 0.01 * b])
        h = w * p * (1 - p)
        m = np.array([[h.sum() + 1e-6, (h * x).sum()], [(h * x).sum(), (h * x * x).sum() + penalty * 0.01]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def scores(texts: pa.Array, lexicon: dict[str, float], fitted: tuple[float, float], grammar: tuple[np.ndarray, np.ndarray] = GRAMMAR) -> np.ndarray:
    z = np.clip(fitted[0] + fitted[1] * np.log1p(clause_sums(texts, lexicon, grammar)), -30, 30)
    return 1 / (1 + np.exp(-z))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from the rows that are not held out."""
    split = docs.select("doc_id", "text", held_out.alias("held_out"))
    lexicon, fitted = learn(training(split.where(~F.col("held_out")), labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            score = scores(part.column("text"), lexicon, fitted)
            cols = [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= TOXIC_AT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted"])

    ready = split.select(F.col("doc_id").cast("long"), "held_out", "text")
    return ready.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is under TOXIC_AT, with all their columns; learns from all labels."""
    lexicon, fitted = learn(training(docs.select("doc_id", "text"), labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield part.filter(pa.array(scores(part.column("text"), lexicon, fitted) < TOXIC_AT))

    return docs.mapInArrow(keep, docs.schema)
