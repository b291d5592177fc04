"""Near-duplicates by MinHash: bottom-k sketches of one hash function.

1. A document's set is its distinct five-word shingles, each hashed once; a sketch keeps the SKETCH smallest hashes.
2. Documents of one set (equal digests) become one representative, the smallest id.
3. Inverted lists of retained values generate overlaps. Two sets at the similarity sought share half of what their sketches
   retain (the chance of less is below 1e-5), so with the values of a sketch in order of rarity, a partner is met in the
   lists of the first half: passages that many documents share stay out of them.
4. Lists of up to SMALL members give all their pairs. A longer one is first searched as stars around a few members, so that
   n near copies give a few n pairs, not n * n. The size ratio and the union sketch's estimate filter the pairs, then full
   sets confirm them (exact Jaccard).
5. Confirmed links make components, by alternating minimum stars. Where a long list still has members of several components,
   those outside its largest one are compared with every member of a like size, in blocks that go to different tasks: first
   sketch by sketch, which leaves the members that share enough with any other, then those set by set; only links come out. Of
   lists with the same members one is searched, and of the lists that a pair has in common one has its sets compared. So no link
   between different texts is lost to a cap. Sketches and texts are joined once to each member of a list, before blocks are dealt.

Nothing but numbers of rows reaches the driver. What a join reads several times is stored first, as plans that hold it again and
again, each time with its joins, are the driver's memory. Values and digests that very many members have are joined by broadcast (there
are few such), so no task gets all rows of one.

Fewer than five words: the whole sequence is one shingle. Null, empty or white text: no shingle, linked with nothing. A null
doc_id: linked with nothing, kept. Repeated rows of one doc_id are one document; each row is returned. If they differ in text,
links are confirmed on one of its texts (the least in its compressed form). Ties do not arise: a component is named by its
smallest id. Very long texts are read whole. An empty table gives an empty result. Other
columns are ignored by `near_duplicates` and kept by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from mosaique.llm.common import ascii_words, coded, hot_join, release, removed, slices, spread, stored

WORDS, SKETCH = 5, 64
#: A link: 100 * intersection >= SIMILAR * union. A pair under LEAST_ESTIMATE by its sketches is not confirmed.
SIMILAR, LEAST_ESTIMATE = 75, 0.5
STARS, TRIES, SMALL = 2, 2, 8
#: Members a side of a block of full sets, and of sketches, at most; and shingles a side of a block of full sets.
BLOCK, SKETCH_BLOCK, SHINGLES = 8192, 16_384, 1 << 20
#: Bytes of texts that are open at once, and of packed texts whose pairs are confirmed together.
OPENED, PACKED = 2 << 20, 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (63 bits) of each text."""
    import xxhash

    offsets, words = ascii_words(pc.ascii_lower(pc.fill_null(texts, "")))
    codes, distinct = coded(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct))
    word = hashes[codes]
    rolled = np.zeros(max(0, len(word) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        rolled = rolled * _FACTOR + word[k : k + len(rolled)]
    rolled = _mix(rolled) >> np.uint64(1)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for w in word[a:b]:
                h = h * _FACTOR + w
            out.append(_mix(np.array([h])) >> np.uint64(1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (null without shingles), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in slices(batches):
            with np.errstate(over="ignore"):
                sets = shingle_sets(part.column("text"))
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            sketches = pa.array([s[:SKETCH].astype(np.int64) for s in sets], pa.list_(pa.int64()))
            cols = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), sketches]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "digest", "sketch"])

    schema = "doc_id long, n_shingles long, digest binary, sketch array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def rare_lists(reps: DataFrame) -> DataFrame:
    """value, rep, n: each sketch's members of the inverted lists of its rarer half, where a list has a second member."""
    each = reps.select("rep", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    shared = stored(each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "values")
    total = reps.agg(F.coalesce(F.sum(F.size("sketch")), F.lit(0))).first()[0]
    met = hot_join(each, shared, "value", total, shared.select("value", F.col("df").alias("_n"))).where("df is not null")
    ours = met.groupBy("rep", "n", "kept").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("rare"))
    # Of `kept` values the first kept - half + 1 matter, and those in no other sketch come first.
    half = F.ceil(F.col("kept") / 2).cast("int")
    first = F.size("rare") - half + 1
    return ours.where(first > 0).select(F.explode(F.slice("rare", F.lit(1), first)).alias("x"), "rep", "n").select(F.col("x.value").alias("value"), "rep", "n")


def star_pairs(lists: DataFrame, salt: int, stars: int) -> DataFrame:
    """a < b: every member of a list with the list's hub. Lists of one colour choose the same hub of a group."""
    draw = F.xxhash64("rep", F.pmod(F.xxhash64("value"), F.lit(stars)), F.lit(salt))
    hubs = lists.groupBy("value").agg(F.min(F.struct(draw.alias("draw"), F.col("rep").alias("hub"), F.col("n").alias("hub_n"))).alias("h"))
    hubs = stored(hubs.select("value", "h.hub", "h.hub_n"), "hubs")
    joined = hot_join(lists, hubs, "value", lists.count()).where(F.col("hub") != F.col("rep"))
    near = _alike_sizes(F.col("n"), F.col("hub_n"))
    return joined.where(near).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def _alike_sizes(x, y):
    return F.least(x, y) * 100 >= F.greatest(x, y) * SIMILAR


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose union sketch (the SKETCH smallest of both sketches) is shared to LEAST_ESTIMATE."""
    left = reps.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"))
    right = reps.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return pairs.join(left, "a").join(right, "b").where(both >= LEAST_ESTIMATE * F.size(union)).select("a", "b")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3)
    for part in slices(batches):
        packed = [squeeze.compress(x) for x in part.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], ["rep", "packed"])


def _sets(packed: dict[int, bytes]) -> dict[int, np.ndarray]:
    """Shingle sets of packed texts by id; texts are opened a slice at a time."""
    import zstandard

    open_ = zstandard.ZstdDecompressor()
    ids, sets, at = list(packed), {}, 0
    while at < len(ids):
        some, size = [], 0
        while at < len(ids) and (not some or size < OPENED):
            some.append(open_.decompress(packed[ids[at]]))
            size += len(some[-1])
            at += 1
        with np.errstate(over="ignore"):
            sets.update(zip(ids[at - len(some) : at], shingle_sets(pa.array(some, pa.binary()).cast(pa.string())), strict=True))
    return sets


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        # Slices by the packed size of both texts.
        weight = pc.add(pc.binary_length(whole.column("pa")), pc.binary_length(whole.column("pb")))
        ends, at = np.cumsum(np.asarray(weight, dtype=np.int64)), 0
        while at < whole.num_rows:
            before = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, before + PACKED, side="right")) - at)
            batch, at = whole.slice(at, n), at + n
            ids = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            sets = _sets(dict(zip(ids[0] + ids[1], batch.column("pa").to_pylist() + batch.column("pb").to_pylist(), strict=True)))
            linked = []
            for a, b in zip(*ids, strict=True):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                linked.append(100 * both >= SIMILAR * (len(sets[a]) + len(sets[b]) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))
        release()


def packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """rep, packed: the texts of the ids, compressed before they travel."""
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack, "rep long, packed binary")
    return texts.join(ids, "rep", "left_semi").groupBy("rep").agg(F.min("packed").alias("packed"))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are links by their full sets."""
    left, right = texts.toDF("a", "pa"), texts.toDF("b", "pb")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "pa", "pb").mapInArrow(_confirm, "a long, b long")


def small_pairs(lists: DataFrame) -> DataFrame:
    """a < b: all pairs of the lists of up to SMALL members."""
    small = lists.where(F.col("size") <= SMALL)
    x, y = small.select("value", F.col("rep").alias("a"), "n"), small.select("value", F.col("rep").alias("b"), F.col("n").alias("m"))
    return x.join(y, "value").where((F.col("a") < F.col("b")) & _alike_sizes(F.col("n"), F.col("m"))).select("a", "b").distinct()


def _across(group: pa.Table) -> pa.Table:
    """Links of the members x of a block with its members y in other components: one for each x and component."""
    rows = group.to_pydict()
    sets = _sets(dict(zip(rows["rep"], rows["packed"], strict=True)))
    of = dict(zip(rows["rep"], rows["component"], strict=True))
    xs = [r for r, side in zip(rows["rep"], rows["side"], strict=True) if side]
    ys = sorted(r for r, side in zip(rows["rep"], rows["side"], strict=True) if not side)
    found: list[tuple[int, int]] = []
    if xs and ys:
        size = np.array([len(sets[y]) for y in ys])
        known, codes = np.unique(np.concatenate([sets[y] for y in ys]), return_inverse=True)
        starts, home, mark = np.cumsum(size) - size, np.array([of[y] for y in ys]), np.zeros(len(known), np.int32)
        for x in xs:
            at = np.searchsorted(known, sets[x])
            at = at[known[np.minimum(at, len(known) - 1)] == sets[x]]
            mark[at] = 1
            both = np.add.reduceat(mark[codes], starts)
            mark[at] = 0
            hit = np.flatnonzero((100 * both >= SIMILAR * (len(sets[x]) + size - both)) & (home != of[x]))
            _, first = np.unique(home[hit], return_index=True)
            found += [(x, ys[k]) for k in hit[first].tolist()]
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _counter(values: np.ndarray, bounds: np.ndarray, ys: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A function that counts, for each of the lists ys, its values among given ones. No list is empty."""
    size = np.diff(bounds)[ys]
    known, codes = np.unique(values[spread(bounds[ys], size)], return_inverse=True)
    starts, mark = np.cumsum(size) - size, np.zeros(len(known), np.int32)

    def count(own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, own)
        at = at[known[np.minimum(at, len(known) - 1)] == own]
        mark[at] = 1
        both = np.add.reduceat(mark[codes], starts)
        mark[at] = 0
        return both

    return count


def _arrays(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks()
    bounds = np.asarray(lists.offsets, dtype=np.int64)
    return np.asarray(lists.flatten()), bounds - bounds[0]


def _candidates(group: pa.Table) -> pa.Table:
    """Members of a block that share enough of their sketches with a member of the other side in another component, where this list
    is the first that both are in."""
    side, here = np.asarray(group["side"]), group["value"][0].as_py()
    reps, home = np.asarray(group["rep"]), np.asarray(group["component"])
    (values, bounds), (lists, ends) = _arrays(group["sketch"]), _arrays(group["lists"])
    size = np.diff(bounds)
    xs, ys = np.flatnonzero(side), np.flatnonzero(~side)
    found: set[int] = set()
    if len(xs) and len(ys):
        shared, met = _counter(values, bounds, ys), _counter(lists, ends, ys)
        for x in xs.tolist():
            hit = (shared(values[bounds[x] : bounds[x + 1]]) >= LEAST_ESTIMATE * np.maximum(size[x], size[ys])) & (home[ys] != home[x])
            if hit.any():
                of = lists[ends[x] : ends[x + 1]]
                hit &= met(of[of < here]) == 0
            if hit.any():
                found.add(int(reps[x]))
                found.update(reps[ys[hit]].tolist())
    return pa.table({"value": pa.array([here] * len(found), pa.int64()), "rep": pa.array(sorted(found), pa.int64())})


def _dealt(rows: DataFrame, block: int, shingles: int | None, payload: DataFrame) -> DataFrame:
    """rows (a stored table: value, rep, n, component, top) in blocks, with what payload has of each rep: x, those outside the list's
    largest component (top), against y, all of a like size. A size is in one of the classes that the least ratio of sizes makes; x
    meets its own and both next ones. The payload is joined before rows are dealt, once to each."""
    ratio = 100.0001 / SIMILAR
    rows = rows.withColumn("kind", F.floor(F.log(F.col("n").cast("double")) / float(np.log(ratio))).cast("int"))
    most = F.lit(block) if shingles is None else F.greatest(F.lit(1), F.least(F.lit(block), F.floor(shingles / F.pow(F.lit(ratio), F.col("k") + 1))))
    each = rows.groupBy("value", "kind").agg(F.count_if(F.col("component") != F.col("top")).alias("nx"), F.count("*").alias("ny"))
    near = each.select("value", "kind", "nx", "ny", F.explode(F.array(F.col("kind") - 1, F.col("kind"), F.col("kind") + 1)).alias("k"))
    near = near.groupBy("value", "k").agg(F.sum(F.when(F.col("k") == F.col("kind"), F.col("nx")).otherwise(0)).alias("nx"), F.sum("ny").alias("ny")).where("nx > 0")
    near = near.select("value", F.struct("k", F.ceil(F.col("nx") / most).cast("int").alias("ni"), F.ceil(F.col("ny") / most).cast("int").alias("nj")).alias("c"))
    kinds = stored(near.groupBy("value").agg(F.collect_list("c").alias("kinds")), "kinds")
    as_x = """if(component <> top, flatten(transform(filter(kinds, c -> c.k = kind), c -> transform(sequence(0, c.nj - 1),
        j -> named_struct('kind', c.k, 'i', int(pmod(xxhash64(rep, 2), c.ni)), 'j', j, 'side', true)))), array())"""
    as_y = """flatten(transform(filter(kinds, c -> abs(c.k - kind) <= 1), c -> transform(sequence(0, c.ni - 1),
        i -> named_struct('kind', c.k, 'i', i, 'j', int(pmod(xxhash64(rep, 1), c.nj)), 'side', false))))"""
    placed = hot_join(rows, kinds, "value", rows.count()).where("kinds is not null")
    placed = placed.select("value", "rep", "component", F.expr(f"concat({as_x}, {as_y})").alias("at")).join(payload, "rep")
    return placed.withColumn("at", F.explode("at")).select("*", "at.*").drop("at")


def rest_links(lists: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links across the components of the open lists (value, rep, n, component)."""
    # One of the lists that have the same members; the largest component of each.
    groups = lists.groupBy("value", "component").agg(F.count("*").alias("k"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("h"))
    whole = groups.groupBy("value").agg(F.sum("k").alias("k"), F.sum("h").alias("h"), F.max_by("component", F.struct("k", "component")).alias("top"))
    one = stored(whole.groupBy("k", "h").agg(F.min(F.struct("value", "top")).alias("one")).select("one.*"), "one-of-lists")
    rows = stored(hot_join(lists, one, "value", lists.count()).where("top is not null"), "open-lists")
    by_block = ["value", "kind", "i", "j"]
    sketches = reps.select("rep", "sketch").join(rows.groupBy("rep").agg(F.collect_list("value").alias("lists")), "rep")
    near = _dealt(rows, SKETCH_BLOCK, None, sketches).groupBy(*by_block).applyInArrow(_candidates, "value long, rep long")
    near = stored(rows.join(near.distinct(), ["value", "rep"], "left_semi"), "near")
    return _dealt(near, BLOCK, SHINGLES, texts).groupBy(*by_block).applyInArrow(_across, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component (its smallest id) of all ids in edges (a, b), by alternating stars to the smallest neighbour."""
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now, before = stored(both, "edges"), None
    while True:
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        around = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: smaller neighbours, and the id itself, go to the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.union(low.toDF("u", "v")).distinct(), "edges")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        removed(now)
        if state == before:
            break
        now, before = after, state
    roots = after.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stored(after.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots), "components")


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """value, rep, n, component of the members of long lists that hold more than one component."""
    named = lists.where(F.col("size") > SMALL).join(labels, F.col("rep") == F.col("id"), "left").select("value", "rep", "n", F.coalesce("component", "rep").alias("component"))
    several = named.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("value")
    return named.join(several, "value", "left_semi")


def links(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """id, component of all representatives that are linked with another."""
    lists = stored(rare_lists(reps), "rare-lists")
    sizes = lists.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    sized = hot_join(lists, sizes, "value", lists.count(), sizes.select("value", F.col("size").alias("_n")))
    lists = stored(sized.where("size is not null"), "lists")
    texts = stored(packed_texts(docs, lists.select("rep").distinct()), "texts")
    tried, edges, labels = None, None, docs.sparkSession.createDataFrame([], "id long, component long")
    for turn in range(TRIES):
        if turn == 0:
            pairs = small_pairs(lists).union(star_pairs(lists.where(F.col("size") > SMALL), turn, STARS)).distinct()
        else:
            pairs = star_pairs(stored(_open(lists, labels), "open"), turn, STARS).join(tried, ["a", "b"], "left_anti")
        pairs = stored(estimated(pairs, reps), "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        found = stored(confirmed(pairs, texts), "links")
        edges = found if edges is None else edges.union(found)
        labels = components(edges)
    rest = stored(_open(lists, labels), "open")
    if rest.isEmpty():
        return labels
    more = stored(rest_links(rest, reps, texts), "links")
    return labels if more.isEmpty() else components(edges.union(more))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    signed = stored(signatures(docs), "signatures")
    full = signed.where("doc_id is not null and n_shingles > 0")
    reps = full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    reps = stored(reps, "representatives")
    labels = links(docs, reps.select("rep", "n", "sketch"))
    named = reps.join(labels, F.col("rep") == F.col("id"), "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = hot_join(signed.select("doc_id", "n_shingles", "digest"), named, "digest", signed.count())
    own = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
