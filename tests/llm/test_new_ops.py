"""Whitening, shared lines and periodic runs against plain forms."""

import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction
from hashlib import sha256
from math import inf, nan

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mosaique.llm import common, line_dedup, periodic, registry, whitening
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


# Whitening


def table(spark, vectors, parts=3):
    rows = [(i, v, 7, 0.5) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened double").repartition(parts)


def plain_whitening(vectors):
    """Whole numbers, components by an eigenvalue problem of the exact covariance, deviations as whole numbers."""
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1_000_000
    n, sums = len(x), [sum(c) for c in zip(*x.tolist(), strict=True)]
    d = [[n * v - s for v, s in zip(row, sums, strict=True)] for row in x.tolist()]
    c = [[float(Fraction(sum(r[i] * r[j] for r in d), n**3)) for j in range(len(sums))] for i in range(len(sums))]
    e, v = np.linalg.eigh(np.array(c))
    e, v = e[::-1], v[:, ::-1]
    return n, [sum(y * y for y in r) for r in d], (np.array(d) / n) @ v / np.sqrt(e), e / e.sum()


@pytest.mark.parametrize("fan", [2, 16])
def test_whitening_equals_an_eigenvalue_problem(spark, monkeypatch, fan):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 5)) * [30, 8, 2, 1, 0.3] @ np.linalg.qr(rng.normal(size=(5, 5)))[0] + [900, 0, -5, 1, 1]).tolist()
    monkeypatch.setattr(common, "FAN", fan)
    n, deviations, whitened, explained = plain_whitening(vectors)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whitened(table(spark, vectors, 9)).collect()}
    assert len(got) == 300 * 5 and {r["n"] for r in got.values()} == {n}
    signs = [np.sign(got[(0, k + 1)]["whitened"] * whitened[0, k]) for k in range(5)]
    for (i, k), r in got.items():
        assert r["deviation"] == deviations[i]
        assert r["whitened"] == pytest.approx(signs[k - 1] * whitened[i, k - 1], abs=1e-9)
        assert r["explained"] == pytest.approx(explained[k - 1], rel=1e-9) and r["identity_error"] < 1e-9


def test_merging_moments_loses_nothing():
    """However rows are split, all singular values, the spaces and the sums agree, next to a large common offset too."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(500, 6)) * [1000, 300, 40, 9, 3, 1]).astype(np.int64) + (1 << 40)
    whole = whitening.Moments.of(x)
    for cuts in ([250], [1, 2, 3, 499], list(range(7, 500, 7))):
        m = whitening.Moments.merged([whitening.Moments.of(p) for p in np.split(x, cuts)])
        assert (m.n, m.sums) == (whole.n, whole.sums)
        assert np.allclose(m.values, whole.values, rtol=1e-12)
        assert np.allclose(np.abs((m.vectors * whole.vectors).sum(axis=1)), 1, atol=1e-12)
    w = whitening.Whitening.of(whole)
    assert (w.unwhiten(w.whiten(x)) == x).all()  # all dimensions are retained


def test_whitening_of_odd_vectors(spark):
    good = [[1.0, 2.0], [3.0, -1.0], [0.0, 0.5], [1.0, 2.0], [1.0, 2.0]]
    odd = [None, [1.0, None], [nan, 1.0], [inf, 0.0], [1e300, 0.0], [], [1.0, 2.0, 3.0]]
    rows = whitening.whitened(table(spark, good + odd)).collect()
    assert sorted((r["vec_id"], r["component"]) for r in rows) == [(i, k) for i in range(5) for k in (1, 2)]
    n, deviations, *_ = plain_whitening(good)
    assert {r["vec_id"]: r["deviation"] for r in rows} == dict(enumerate(deviations)) and rows[0]["n"] == n
    for none in ([], odd[:4], [[]]):
        empty = whitening.whitened(table(spark, none))
        assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and not empty.collect()
    same = whitening.whitened(table(spark, [[1.0, 2.0]] * 4)).collect()
    assert len(same) == 8 and {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in same} == {(None, None, 0, 0.0)}
    flat = whitening.whitened(table(spark, [[float(i), 3.0] for i in range(5)])).collect()  # one direction without variance
    assert {r["whitened"] for r in flat if r["component"] == 2} == {None} and all(r["whitened"] is not None and r["explained"] == 1 for r in flat if r["component"] == 1)
    far = whitening.whitened(table(spark, [[1e11], [-1e11], [0.0], [0.0]])).collect()
    assert sum(r["deviation"] is None for r in far) == 2  # beyond a long


def test_whitening_query(spark):
    got = registry.op11_whitening(spark, SF)
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert got.count() == 32 * n
    x = got.agg(F.max("identity_error"), F.min("n"), F.sum(F.when(F.col("vec_id") == 0, F.col("explained")))).first()
    assert x[0] < 1e-9 and x[1] == n and 0.5 < x[2] < 1


# Shared lines


def plain_lines(docs):
    lower = {ord(a): ord(a) + 32 for a in map(chr, range(65, 91))}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or gone.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def lines_docs(seed=3, n=120):
    rng = random.Random(seed)
    pool = [f"{rng.choice(['', ' ', chr(9)])}{rng.choice(['The', 'THE', 'thé', 'Ünï'])} line number {i} of a pool{rng.choice(['', ' ', chr(13)])}" for i in range(60)] + ["short line", "", "x" * 19, "Y" * 20, "é" * 20]
    return [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 12)) + [f"a line that only document {i} has"] * rng.randint(0, 2))) for i in range(n)]


@pytest.mark.parametrize(("held", "most_bits"), [(line_dedup.HELD, line_dedup.MOST_BITS), (0, line_dedup.MOST_BITS), (line_dedup.HELD, 1 << 13), (0, 1 << 13)])
def test_lines_equal_brute_force(make, held, most_bits):
    docs = [*lines_docs(), (500, None), (501, ""), (7, "one more text of an id\nThe line number 5 of a pool"), (None, "Y" * 20), (None, "Y" * 20)]
    got = line_dedup.summary(line_dedup.dedup_lines(make([t for _, t in docs], ids=[i for i, _ in docs]), held, most_bits))
    assert sorted(map(tuple, got.collect()), key=str) == plain_lines(docs)


def test_lines_edges(make, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(map(tuple, line_dedup.summary(line_dedup.dedup_lines(odd)).collect()), key=str) == plain_lines(rows)
    empty = line_dedup.dedup_lines(odd.limit(0))
    assert empty.columns == ["doc_id", "text", "n_lines", "n_dropped"] and not empty.collect()
    texts = ["the very same line in all of them"] * 30 + [ODD[8]] * 2
    left = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(make(texts)).collect()}
    assert left == {i: (texts[i] if i >= 29 else "") for i in range(32)}


def test_filters_miss_no_repeat_and_few_others():
    rng = np.random.default_rng(4)
    digests = rng.integers(0, 1 << 63, (20_000, 2), dtype=np.int64).astype(np.uint64)
    once, twice = line_dedup.Bloom(1 << 19), line_dedup.Bloom(1 << 19)
    for part in np.split(np.concatenate((digests, digests[:500])), 10):
        twice.add(part[line_dedup.met_again(part, once)])
        once.add(part)
    assert twice.has(digests[:500]).all() and twice.has(digests[500:]).mean() < 0.01
    assert line_dedup.met_again(digests[[0, 1, 0]], line_dedup.Bloom(8)).tolist() == [True, False, True]


def test_lines_equal_their_sql(spark):
    got = sorted(map(tuple, registry.op12_line_dedup(spark, SF).collect()))
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    assert got == sorted(duck.sql(registry.LINE_DEDUP).fetchall()) and any(r[2] for r in got)


# Periodic runs


def plain_runs(words, least=12):
    """All maximal stretches with their smallest period, by trying every period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j + p - i >= least:
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_summary(i, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(b"" if i is None else str(i).encode()), len(words)
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
    found = plain_runs(words)
    gone = {k for s, length, p in found for k in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(found), *head, sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def run_texts(seed=5, n=150):
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = []
        while len(words) < rng.randint(0, 120):
            unit = rng.choices("abc" if rng.random() < 0.5 else "abcdefghijklmnop", k=rng.randint(1, 9))
            words += unit * rng.choice([1, 1, 2, 3, 7]) + unit[: rng.randint(0, len(unit))]
        out.append(rng.choice([" ", "\n", " \t "]).join(words))
    fib = ["a", "ab"]
    while len(fib[-1]) < 150:
        fib.append(fib[-1] + fib[-2])
    return [*out, " ".join(fib[-1]), " ".join("ab" * 100), " ".join("a" * 77), "", None]


def test_runs_equal_brute_force():
    texts = [(t or "").split() for t in run_texts()]
    codes = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    offsets = np.cumsum([0, *map(len, texts)])
    for least in (2, 12):
        got = defaultdict(list)
        for text, *run in zip(*(x.tolist() for x in periodic.runs(np.array([codes[w] for t in texts for w in t]), offsets, least)), strict=True):
            got[text].append(tuple(run))
        assert [got[i] for i in range(len(texts))] == [plain_runs(t, least) for t in texts]


def test_runs_do_not_depend_on_the_grid_s_cuts(monkeypatch):
    codes, offsets = np.array([k % 7 for k in range(300)] + [1] * 50), np.array([0, 0, 300, 350, 350])
    want = [x.tolist() for x in periodic.runs(codes, offsets)]
    monkeypatch.setattr(periodic, "PAIRS", 3)
    assert [x.tolist() for x in periodic.runs(codes, offsets)] == want == [[1, 2], [0, 0], [300, 50], [7, 1]]


def test_extensions_equal_comparing_words():
    rng = np.random.default_rng(6)
    codes, offsets = rng.integers(0, 2, 400), np.array([0, 100, 100, 170, 400])
    found = periodic.Extensions(codes, offsets)
    for lo, hi in ((0, 100), (100, 170), (170, 400)):
        a, b = rng.integers(lo, hi, (2, 500))
        a, b = a[a != b], b[a != b]
        want = []
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            k = 0
            while max(i, j) + k < hi and codes[i + k] == codes[j + k]:
                k += 1
            want.append(k)
        assert found.of(a, b).tolist() == want


def test_periodic_query_equals_brute_force(make, odd):
    docs = [*zip(range(1000, 1160), run_texts(), strict=False), (None, "a b a b a b a b a b a b a b")]
    made = make([t for _, t in docs], ids=[i for i, _ in docs])
    got = periodic.summary(periodic.periodic_runs(periodic.planted(made))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_summary(i, t) for i, t in docs), key=str)
    small = odd.where("text is null or length(text) < 1000")
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert sorted(map(tuple, periodic.summary(periodic.periodic_runs(small)).collect()), key=str) == sorted((plain_summary(i, t, False) for i, t in rows), key=str)
    long = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"], r["collapsed"]) for r in periodic.periodic_runs(odd).collect()}
    assert long[8] == (1, 0, 30_000, 1, "word")
    assert not periodic.periodic_runs(odd.limit(0)).collect()


def test_periodic_query_on_a_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    some = [x for x in texts if len(x[1] or "") < 4000]
    got = {r[0]: tuple(r) for r in registry.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(texts) and [got[i] for i, _ in some] == [plain_summary(i, t) for i, t in some]
