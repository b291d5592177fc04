"""Plans that stay small, since the driver holds them."""

import random
import re

from mosaique.llm import near_dups


def test_lists_of_stars_are_read_from_a_table(spark, monkeypatch):
    """Stars read their lists several times: of the second turn too they are a table, not a plan with joins."""
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"x{i}"] + [f"y{i % 3}z{k}" for k in range(30 * (i % 3))])) for i in range(30)], "doc_id long, text string")
    seen, plain = [], near_dups.star_pairs
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()

    def star_pairs(lists, salt, stars):
        out = plain(lists, salt, stars)
        seen.append((plan(lists).count("Join"), plan(out).count("Join")))
        return out

    monkeypatch.setattr(near_dups, "star_pairs", star_pairs)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert len(seen) == near_dups.TRIES and [a for a, _ in seen] == [0] * near_dups.TRIES
    assert max(b for _, b in seen) <= 4
    assert len(got) == 30 and got == {i: i % 3 for i in range(30)}


def _nodes(node):
    """Operators of an executed plan."""
    if node.nodeName() == "AdaptiveSparkPlan":
        yield from _nodes(node.executedPlan())
    elif "QueryStage" in node.nodeName():
        yield from _nodes(node.plan())
    else:
        yield node
        below = node.children()
        for i in range(below.size()):
            yield from _nodes(below.apply(i))


def test_texts_are_joined_once_to_each_member(spark, monkeypatch):
    """Blocks of an open list multiply rows after the join of the texts: four times the members make four times its rows. Each pair is
    compared in the first list that both are in, and no link is lost."""
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    made = []
    for n in (24, 96):
        rng = random.Random(n)
        base, texts = [f"w{i}" for i in range(60)], []
        for i in range(n):
            words = list(base)
            for k in rng.sample(range(60), 2):
                words[k] = f"v{i}x{k}"
            texts.append(words)
        sets = [{tuple(w[k : k + 5]) for k in range(56)} for w in texts]
        docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
        signed = near_dups.signatures(docs).collect()
        reps = spark.createDataFrame([(r["doc_id"], r["n_shingles"], r["sketch"]) for r in signed], "rep long, n long, sketch array<long>")
        lists = spark.createDataFrame([(v, i, 56, i) for v in (3, 5) for i in range(n) if v == 5 or i % 4], "value long, rep long, n long, component long")
        found = near_dups.rest_links(lists, reps, near_dups.packed_texts(docs, reps.select("rep")))
        got = {frozenset(r) for r in found.collect()}
        alike = {frozenset((a, b)) for a in range(n) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
        assert got == alike and alike
        joins = [x for x in _nodes(found._jdf.queryExecution().executedPlan()) if re.search(r"\[rep#\d+L?\], \[rep#\d+L?\], Inner", x.simpleString(1000))]
        assert joins
        made.append(sum(x.metrics().apply("numOutputRows").value() for x in joins))
    assert 0 < made[1] <= 4 * made[0]
