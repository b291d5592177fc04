"""Synthetic inputs. Random columns come from seeded generators of the engine."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mosaique.functions.storage import kept
from mosaique.operators import scan
from mosaique.schemas import KEY, TILE, VALUES

#: Probabilities and scales of the realistic generator.
FILL_AT_NIGHT_TILE, FILL_AT_DAY_TILE, FILL_MAX, NORMAL_SHARE, PARETO, LEAST_POPULATION = 0.4, 0.2, 0.1, 0.9, 1.1, 5000
#: Bounds of a position error as shares of the tile's radius, and anchor candidates of a user.
ERROR_FROM, ERROR_TO, CANDIDATES = 0.5, 2.0, 1
#: Draws for a candidate in the first round, each of which may miss the grid, and the most of a user in a round.
TRIES, MOST_TRIES = 16, 1024
TINY = 1e-15


def ids(spark: SparkSession, users: int | DataFrame) -> DataFrame:
    """id: the numbers below `users`, or those of a table."""
    return users.select("id") if isinstance(users, DataFrame) else spark.range(users)


def grid(spark: SparkSession, size: int) -> DataFrame:
    return spark.range(size * size).select((F.col("id") % size).cast("int").alias("tile_e"), F.floor(F.col("id") / size).cast("int").alias("tile_n"))


def _shuffled_axis(size: int, salt: int) -> Column:
    """The numbers below size in an order of their own for each period."""
    keyed = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.struct(F.xxhash64(i, F.col("period"), F.lit(salt)).alias("h"), i.alias("i")))
    return F.transform(F.array_sort(keyed), lambda x: x["i"])


def gen_simple(spark: SparkSession, users: int | DataFrame, days: int, size: int = 20, tiles_per_user: int = 2, seed: int = 0) -> DataFrame:
    """By day and user, tiles_per_user tiles: a run from an offset on each of two axes that are shuffled every day; values 1 to 3
    uniform, value 0 their sum."""
    axes = spark.range(days).select(F.col("id").cast("int").alias("period")).select("period", _shuffled_axis(size, seed).alias("e"), _shuffled_axis(size, seed + 1).alias("n"))
    rows = ids(spark, users).select(F.col("id"), F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("period")).join(axes, "period")  # axes: a row a day
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(tiles_per_user - 1))))
    at = lambda c, salt: F.get(c, F.pmod(F.xxhash64("id", "period", F.lit(seed + salt)) + F.col("k"), F.lit(size)).cast("int"))
    rows = rows.select("id", "period", at("e", 2).alias("tile_e"), at("n", 3).alias("tile_n"), *(F.rand(seed + i).alias(f"value_{i}") for i in (1, 2, 3)))
    return rows.withColumn("value_0", F.expr("value_1 + value_2 + value_3")).select("id", "period", *TILE, *VALUES)


def gen_circle(spark: SparkSession, users: int | DataFrame, days: int, size: int = 20, radius: float = 5.0) -> DataFrame:
    """Every user at every tile: weight 1 inside the circle in the middle, 3e-5 outside, a third in each sub-period."""
    mid = (size - 1) / 2
    inside = F.sqrt(F.pow(F.col("tile_e") - mid, 2) + F.pow(F.col("tile_n") - mid, 2)) <= radius
    cells = grid(spark, size).withColumn("value_0", F.when(inside, 1.0).otherwise(3e-5))
    cells = cells.select(*TILE, "value_0", *(F.when(inside, 1 / 3).otherwise(1e-5).alias(f"value_{i}") for i in (1, 2, 3)))
    who = ids(spark, users).select(F.col("id"), F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("period"))
    return who.join(F.broadcast(cells)).select("id", "period", *TILE, *VALUES)  # size * size cells


def gen_residents(spark: SparkSession, people: int | DataFrame, size: int = 20, seed: int = 0) -> DataFrame:
    where = ids(spark, people).select(F.floor(F.rand(seed) * size).cast("int").alias("tile_e"), F.floor(F.rand(seed + 1) * size).cast("int").alias("tile_n"))
    return grid(spark, size).join(where.groupBy(*TILE).agg(F.count("*").cast("double").alias("value")), TILE, "left").na.fill(0.0, ["value"])


def gen_reference_areas(spark: SparkSession, size: int = 20, side: int = 3, areas: int | DataFrame = 2, seed: int = 0) -> DataFrame:
    """Squares whose one random origin serves both axes."""
    at = ids(spark, areas).select(F.col("id").cast("int"), F.floor(F.rand(seed) * (size - side)).cast("int").alias("o"))
    line = F.sequence(F.col("o"), F.col("o") + side - 1)
    return at.select("id", "o", F.explode(line).alias("tile_e")).select("id", "tile_e", F.explode(line).alias("tile_n"))


def population_cdf(tiles: DataFrame) -> DataFrame:
    """Grid rows with cdf: the share of population up to and with the tile."""
    summed, (total,) = scan.running_sums(tiles.select(*TILE, F.col("population").cast("double")), TILE, {"_sum": F.col("population")})
    return summed.select(*TILE, "population", (F.col("_sum") / F.when(F.lit(total) != 0, total)).alias("cdf"))


def cdf_sample(cdf: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n grid rows by inverse CDF: a draw meets the range [cdf before, cdf). Draws are cut into buckets of the unit interval
    so that the range join is an equi-join with a filter."""
    parts, at = 1024, scan.ranged(cdf, *TILE)
    tops = sorted(tuple(r) for r in at.groupBy(scan.RANGE).agg(F.max("cdf")).collect())  # a row for each range; cdf rises
    before = {k: (top,) for (k, _), top in zip(tops, [0.0, *(c for _, c in tops)], strict=False)}
    lag = F.lag("cdf").over(Window.partitionBy(scan.RANGE).orderBy(*TILE))
    ranges = scan.with_columns_by_range(at.withColumn("lag", lag), before, "before double").withColumn("lo", F.coalesce("lag", "before")).where("cdf > lo")
    slot = lambda x: F.least(F.floor(x * parts), F.lit(parts - 1))
    ranges = ranges.withColumn("slot", F.explode(F.sequence(slot(F.col("lo")), slot(F.col("cdf")))))
    draws = cdf.sparkSession.range(n).select(F.col("id").alias("draw"), F.rand(seed).alias("u")).withColumn("slot", slot(F.col("u")))
    return draws.join(ranges, "slot").where("u >= lo and u < cdf").select("draw", *TILE)


def dense_grid(tiles: DataFrame) -> DataFrame:
    """Every cell of the bounding box; missing cells have population 0."""
    box = tiles.agg(F.min("tile_e").alias("e0"), F.max("tile_e").alias("e1"), F.min("tile_n").alias("n0"), F.max("tile_n").alias("n1"))
    cells = box.select(F.explode(F.sequence("e0", "e1")).alias("tile_e"), "n0", "n1").select("tile_e", F.explode(F.sequence("n0", "n1")).alias("tile_n"))
    return cells.join(tiles, TILE, "left").na.fill(0.0, ["population"])


def summed_area_table(tiles: DataFrame) -> DataFrame:
    """2-D prefix sums over the dense box: running sums along one axis, then the other, each in the other's partitions."""
    along = Window.partitionBy("tile_e").orderBy("tile_n").rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy("tile_n").orderBy("tile_e").rowsBetween(Window.unboundedPreceding, 0)
    one = dense_grid(tiles).withColumn("part", F.sum("population").over(along))
    return one.select(*TILE, F.sum("part").over(across).alias("sat"))


def _around(q: DataFrame, sat: DataFrame, box: tuple[int, int, int, int]) -> DataFrame:
    """q (tiles with a radius r, and more columns) with `around`: the population within the square, by four look-ups in the prefix
    sums, clipped to the box."""
    e0, e1, n0, n1 = box
    e_hi, n_hi = F.least(F.col("tile_e") + F.col("r"), F.lit(e1)), F.least(F.col("tile_n") + F.col("r"), F.lit(n1))
    e_lo, n_lo = F.col("tile_e") - F.col("r") - 1, F.col("tile_n") - F.col("r") - 1
    signs = F.array(*(F.struct(e.alias("e"), n.alias("n"), F.lit(s).alias("sign")) for e, n, s in ((e_hi, n_hi, 1), (e_lo, n_hi, -1), (e_hi, n_lo, -1), (e_lo, n_lo, 1))))
    inside = lambda c: (c["e"] >= e0) & (c["n"] >= n0)  # noqa: E731  beyond, the sum is 0
    corners = q.select("*", F.explode(F.filter(signs, inside)).alias("c")).select(*q.columns, "c.e", "c.n", "c.sign")
    found = corners.join(sat.toDF("e", "n", "sat"), ["e", "n"])
    return found.groupBy(*q.columns).agg(F.sum(F.col("sign") * F.col("sat")).alias("around"))


def _box(tiles: DataFrame) -> tuple[int, int, int, int] | None:
    found = tiles.agg(F.min("tile_e"), F.max("tile_e"), F.min("tile_n"), F.max("tile_n")).first()
    return None if found[0] is None else tuple(found)


def population_around(tiles: DataFrame, radius: int) -> DataFrame:
    """Population within a square of the radius around each tile."""
    box, q = _box(tiles), tiles.select(*TILE, F.lit(radius).alias("r"))
    if box is None:
        return q.select(*TILE, F.lit(0.0).alias("around"))
    return _around(q, summed_area_table(tiles), box).select(*TILE, "around")


def find_rtile(tiles: DataFrame, least: float = LEAST_POPULATION) -> DataFrame:
    """The smallest radius from 1 whose square has `least` people; null where the whole grid has fewer.

    The population grows with the radius: every tile doubles its radius until it has enough, then halves the interval, all tiles at
    once. So a tile takes part in some 2 log2 of its radius rounds with four look-ups each, and leaves when it is done."""
    box = _box(tiles)
    if box is None:
        return tiles.select(*TILE, F.lit(None).cast("int").alias("rtile"))
    sat, widest = kept(summed_area_table(tiles), "sat"), max(1, box[1] - box[0], box[3] - box[2])
    # lo: a radius that is too small; hi: one that is large enough, or null. At the widest radius a square has all of the grid.
    at, done = kept(tiles.select(*TILE, F.lit(0).alias("lo"), F.lit(None).cast("int").alias("hi")), "radii"), []
    while not at.isEmpty():
        probe = F.when(F.col("hi").isNull(), F.least(F.greatest(F.col("lo") * 2, F.lit(1)), F.lit(widest))).otherwise(F.floor((F.col("lo") + F.col("hi")) / 2)).cast("int")
        tried = _around(at.withColumn("r", probe), sat, box)
        enough = F.col("around") >= least
        moved = tried.select(*TILE, F.when(enough, F.col("lo")).otherwise(F.col("r")).alias("lo"), F.when(enough, F.col("r")).otherwise(F.col("hi")).alias("hi"))
        moved = kept(moved, "radii")
        over = (F.coalesce(F.col("hi") - F.col("lo") == 1, F.lit(False))) | (F.col("lo") == widest)
        done.append(moved.where(over).select(*TILE, F.col("hi").alias("rtile")))
        at = moved.where(~over)
    return reduce(DataFrame.union, done) if done else tiles.select(*TILE, F.lit(None).cast("int").alias("rtile"))


def grid_lookup(positions: DataFrame, tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positions on the grid with its columns, and positions that miss it."""
    joined = positions.join(tiles.withColumn("on_grid", F.lit(True)), TILE, "left")
    return joined.where("on_grid").drop("on_grid"), joined.where("on_grid is null").select(positions.columns)


def _on_grid(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """rows with positions e, n that lie in a populated tile, with its population and rtile."""
    return rows.withColumns({"tile_e": F.floor("e").cast("int"), "tile_n": F.floor("n").cast("int")}).join(grid, TILE).drop(*TILE)


def _uniform(salt: int, *by: str) -> Column:
    """A draw in (0, 1) that belongs to the row's id (and more columns), so that a branch that is computed again draws the same."""
    return (F.pmod(F.xxhash64("id", *by, F.lit(salt)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _normal(salt: int, *by: str) -> Column:
    return F.sqrt(-2 * F.log(_uniform(salt, *by))) * F.cos(2 * math.pi * _uniform(salt + 1000, *by))


def _error(salt: int, *by: str) -> Column:
    return F.col("rtile") * (_uniform(salt, *by) * (ERROR_TO - ERROR_FROM) + ERROR_FROM)


def _until_hit(draw: Callable[[DataFrame], DataFrame], users: DataFrame, grid: DataFrame, hits: int) -> DataFrame:
    """id, k, e, n, error, population: of each user the first `hits` draws that lie on the grid. draw makes positions e, n of rows with
    the number k of a draw.

    Rounds of TRIES draws, twice as many each time, for the users that still lack some; it ends when none is left. Every draw has a
    chance, since a position near the anchor it starts from lies in that anchor's tile."""
    first, from_, n, found, left = Window.partitionBy("id").orderBy("k"), 1, TRIES * hits, [], users.withColumn("lacking", F.lit(hits))
    while True:
        tries = left.withColumn("k", F.explode(F.sequence(F.lit(from_), F.lit(from_ + n - 1))))
        hit = _on_grid(draw(tries), grid).withColumn("_hit", F.row_number().over(first)).where(F.col("_hit") <= F.col("lacking"))
        found.append(kept(hit.select("id", "k", "e", "n", "population", "rtile"), "hits"))
        got = found[-1].groupBy("id").agg(F.count("*").alias("got"))
        left = kept(left.join(got, "id", "left").withColumn("lacking", F.col("lacking") - F.coalesce("got", F.lit(0))).where("lacking > 0").drop("got"), "users")
        if left.isEmpty():
            return reduce(DataFrame.union, found)
        from_, n = from_ + n, min(2 * n, MOST_TRIES)


def gen_anchors(cdf: DataFrame, users: int, candidates: int = CANDIDATES, seed: int = 0, least: float = LEAST_POPULATION) -> DataFrame:
    """id, night, day, third: positions (e, n) with their error radius.

    The night anchor is drawn by CDF, anywhere in its tile. The other two are offset from it normally, with the tile's rtile as
    scale: of the first `candidates` draws that hit the grid, the one in the most populated tile. Then the third moves to a point
    between both, the first that hits the grid. Errors are a uniform share of the rtile of the anchor's tile. Where the whole grid
    has too few people for an rtile, its width is one."""
    tiles = cdf.select(*TILE, "population")
    box = _box(tiles)
    widest = max(1, box[1] - box[0], box[3] - box[2]) if box else 1
    grid = kept(tiles.join(find_rtile(tiles, least), TILE).withColumn("rtile", F.coalesce("rtile", F.lit(widest))), "grid")
    night = cdf_sample(cdf, users, seed).select(F.col("draw").alias("id"), *TILE).join(grid, TILE)
    night = kept(night.select("id", (F.col("tile_e") + _uniform(seed + 1)).alias("e0"), (F.col("tile_n") + _uniform(seed + 2)).alias("n0"), F.col("rtile").alias("scale"), (_error(seed + 3)).alias("error")), "night")
    spot = F.struct("e", "n", "error")
    out = night.select("id", F.struct(F.col("e0").alias("e"), F.col("n0").alias("n"), "error").alias("night"))
    for name, salt in (("day", 10), ("third", 20)):
        offset = lambda s: _normal(seed + s, "k") * F.col("scale")
        draw = lambda rows, s=salt: rows.withColumns({"e": F.col("e0") + offset(s), "n": F.col("n0") + offset(s + 1)})
        hit = _until_hit(draw, night.drop("error"), grid, candidates).withColumn("error", _error(seed + salt + 2, "k"))
        out = out.join(hit.groupBy("id").agg(F.max_by(spot, F.struct("population", -F.col("k"))).alias(name)), "id")
    between = lambda c: _uniform(seed + 30, "k") * F.col(f"day.{c}") + (1 - _uniform(seed + 30, "k")) * F.col(f"third.{c}")
    out = kept(out, "anchors")
    moved = _until_hit(lambda rows: rows.withColumns({"e": between("e"), "n": between("n")}), out.select("id", "day", "third"), grid, 1)
    return out.drop("third").join(moved.withColumn("error", _error(seed + 31, "k")).select("id", spot.alias("third")), "id").select("id", "night", "day", "third")


def gen_user_data(cdf: DataFrame, users: int, days: int, seed: int = 0, least: float = LEAST_POPULATION) -> DataFrame:
    """Regular and vacation anchors, and the vacation's days [vacation_start, vacation_end)."""
    most = 21 if days >= 21 else math.ceil(days / 3)
    regular, vacation = gen_anchors(cdf, users, seed=seed, least=least), gen_anchors(cdf, users, seed=seed + 100, least=least)
    pick = lambda df, name: df.select("id", F.struct("night", "day", "third").alias(name))
    both = pick(regular, "regular").join(pick(vacation, "vacation"), "id")
    both = both.withColumn("length", (F.floor(F.rand(seed + 7) * most) + 1).cast("int"))
    both = both.withColumn("vacation_start", F.floor(F.rand(seed + 8) * F.greatest(F.lit(days) - F.col("length") + 1, F.lit(1))).cast("int"))
    return both.withColumn("vacation_end", F.col("vacation_start") + F.col("length")).drop("length")


def tile_offsets(rows: DataFrame, scale: float = 1.0, seed: int = 0) -> DataFrame:
    """rows with e_offset, n_offset: a mixture of a normal and a Pareto radius at a random angle."""
    pareto = (F.pow(1 - F.rand(seed + 2), -1 / PARETO) - 1) * 2
    r = F.when(F.rand(seed) < NORMAL_SHARE, F.randn(seed + 1) * scale).otherwise(pareto)
    rows = rows.withColumn("r", r).withColumn("phi", F.rand(seed + 3) * 2 * math.pi)
    return rows.withColumns({"e_offset": F.col("r") * F.cos("phi"), "n_offset": F.col("r") * F.sin("phi")}).drop("r", "phi")


def gen_day_rows(samples: DataFrame) -> DataFrame:
    """H rows of weighted samples (id, tile, sub_period 1 to 3, v): sums by sub-period as columns, and the day's sum. A tile whose
    samples weigh nothing keeps its row, and so does one whose weights are unknown (null)."""
    subs = (F.sum(F.when(F.col("sub_period") == i, F.col("v")).otherwise(0.0)).alias(f"value_{i}") for i in (1, 2, 3))
    return samples.groupBy(*KEY).agg(F.sum("v").alias("value_0"), *subs)


def fill_subperiods(h: DataFrame, seed: int = 0) -> DataFrame:
    """Empty sub-periods get a uniform weight with a probability that depends on the tile's night weight; the day grows too."""
    p = F.when(F.col("value_1") > TINY, FILL_AT_NIGHT_TILE).otherwise(FILL_AT_DAY_TILE)
    h = h.withColumn("p", p)
    for i in (1, 2, 3):
        v = f"value_{i}"
        add = F.when((F.col(v) < TINY) & (F.rand(seed + 10 * i) < F.col("p")), F.rand(seed + 10 * i + 1) * FILL_MAX).otherwise(0.0)
        h = h.withColumn("add", add).withColumns({v: F.col(v) + F.col("add"), "value_0": F.col("value_0") + F.col("add")}).drop("add")
    return h.drop("p")


def duplicate_users(h: DataFrame, users: int, times: int) -> DataFrame:
    """Rows again under further ids: copy k of user u has id u + k * users, from k = 0, which equals the original."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    again = h.withColumn("k", copies).withColumn("id", F.col("id") + F.col("k") * users).drop("k")
    return h.unionByName(again) if times else h
