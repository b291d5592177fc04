"""Quality indicators over H (cleaned), the old and the new state. All group by user first, then count in few bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaique.functions.histogram import anonymous, iterate, log2_bin, log2_histogram, text_lines
from mosaique.operators.state import bucket_of
from mosaique.schemas import TILE, VALUES

SUB = "sub_period"


def _groups(spark, n: int = 4) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias(SUB))


def count(rows: DataFrame, bins: int = 10, lowest: float = 1) -> DataFrame:
    """Histogram of records by user."""
    users = rows.groupBy("id").agg(F.count("*").cast("double").alias("n"))
    return iterate(log2_histogram(users, "n", bins, lowest), None, bins)


def totals(rows: DataFrame) -> DataFrame:
    users = rows.groupBy("id").agg(F.count("*").alias("n"))
    return users.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("records"), F.count("*").alias("users"))


def spatiotemporal(h: DataFrame) -> DataFrame:
    """How many rows have each of the 16 presence patterns (value 0 is the highest bit); patterns without rows too."""
    bits = sum((F.when(F.col(v) != 0, 8 >> i).otherwise(0) for i, v in enumerate(VALUES)), F.lit(0))
    found = h.groupBy(bits.alias("pattern")).agg(F.count("*").alias("count"))
    every = h.sparkSession.range(16).select(F.col("id").cast("int").alias("pattern"))
    return every.join(found, "pattern", "left").select("pattern", F.coalesce("count", F.lit(0)).alias("count"))


def _unpivot(rows: DataFrame, names: list[str], value: str, *by: str) -> DataFrame:
    parts = ", ".join(f"{i}, {c}" for i, c in enumerate(names))
    return rows.select(*by, F.expr(f"stack({len(names)}, {parts}) as ({SUB}, {value})"))


def unique_tiles(rows: DataFrame, bins: int = 10, lowest: float = 1) -> DataFrame:
    """By sub-period, a histogram of the tiles with a value by user; users without any are skipped."""
    users = rows.groupBy("id").agg(*(F.count(F.when(F.col(v) > 0, 1)).cast("double").alias(f"t{i}") for i, v in enumerate(VALUES)))
    flat = _unpivot(users, ["t0", "t1", "t2", "t3"], "n", "id").where("n > 0")
    return iterate(log2_histogram(flat, "n", bins, lowest, SUB), _groups(rows.sparkSession), bins, SUB)


def weight_hist(rows: DataFrame, bins: int = 17, lowest: float = 1 / 256) -> DataFrame:
    """By sub-period, a histogram of the values, zeros included."""
    flat = _unpivot(rows, VALUES, "x")
    return iterate(log2_histogram(flat, "x", bins, lowest, SUB), _groups(rows.sparkSession), bins, SUB)


def _centroids(rows: DataFrame, suffix: str) -> DataFrame:
    aggs = []
    for i, v in enumerate(VALUES):
        aggs += [F.sum(v).alias(f"w{i}"), F.sum(F.col(v) * F.col("tile_e")).alias(f"e{i}"), F.sum(F.col(v) * F.col("tile_n")).alias(f"n{i}")]
    users = rows.groupBy("id").agg(*aggs)
    flat = users.select("id", F.expr(f"stack(4, {', '.join(f'{i}, w{i}, e{i}, n{i}' for i in range(4))}) as ({SUB}, w, e, n)")).where("w != 0")
    return flat.select("id", SUB, (F.col("e") / F.col("w")).alias(f"e_{suffix}"), (F.col("n") / F.col("w")).alias(f"n_{suffix}"))


def centroid_distances(h: DataFrame, old: DataFrame) -> DataFrame:
    """Distance of a user's weighted mean positions; a side without weight is skipped."""
    both = _centroids(h, "h").join(_centroids(old, "s"), ["id", SUB])
    square = lambda a, b: (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))
    return both.select("id", SUB, F.sqrt(square("e_h", "e_s") + square("n_h", "n_s")).alias("distance"))


def centroid_distance(h: DataFrame, old: DataFrame, bins: int = 10, lowest: float = 256) -> DataFrame:
    return iterate(log2_histogram(centroid_distances(h, old), "distance", bins, lowest, SUB), _groups(h.sparkSession), bins, SUB)


def diagonals(rows: DataFrame) -> DataFrame:
    """Diagonal of the box around a user's tiles with a value, by sub-period; no row where there is none."""
    users = _sums([("rows", rows)]).select("id", *(f"d{i}" for i in range(4)))
    return _unpivot(users, [f"d{i}" for i in range(4)], "diagonal", "id").where("diagonal is not null")


def bounding_box(h: DataFrame, old: DataFrame, new: DataFrame, bins: int = 8, lowest: float = 1024) -> DataFrame:
    """Histograms of the diagonal of the box around a user's tiles with a value, by sub-period: in H, in the old state, and of its
    change from the old to the new state. All three tables are aggregated once by user; no value where a side has no tile."""
    users = by_user(h, old, new).select("id", "of", *(f"d{i}" for i in range(4)))
    wide = users.groupBy("id").agg(*(F.max(F.when(F.col("of") == name, F.col(f"d{i}"))).alias(f"{name}_{i}") for name in ("h", "old_s", "new_s") for i in range(4)))
    value = lambda measure, i, x: F.when(x.isNotNull(), F.struct(F.lit(measure).alias("measure"), F.lit(i).alias(SUB), x.alias("diagonal")))
    values = [value(name, i, F.col(f"{name}_{i}")) for name in ("h", "old_s") for i in range(4)]
    values += [value("change", i, F.abs(F.col(f"old_s_{i}") - F.col(f"new_s_{i}"))) for i in range(4)]
    every = wide.select(F.explode(F.filter(F.array(*values), lambda v: v.isNotNull())).alias("v")).select("v.*")
    spark = h.sparkSession
    groups = _groups(spark).join(spark.createDataFrame([("h",), ("old_s",), ("change",)], "measure string").hint("broadcast"))
    return iterate(log2_histogram(every, "diagonal", bins, lowest, "measure", SUB), groups, bins, "measure", SUB)


def by_user(h: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """id, of (h, old_s or new_s), and what all indicators by user are made from: one aggregation of all three tables."""
    return _sums([("h", h), ("old_s", old), ("new_s", new)])


def _sums(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    kept = ["id", *TILE, *VALUES]
    rows = None
    for name, t in tables:
        part = t.select(*kept).withColumn("of", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    aggs = [F.count("*").alias("n")]
    for i, v in enumerate(VALUES):
        there = [F.when(F.col(v) != 0, F.col(c)) for c in TILE]
        aggs += [F.count(F.when(F.col(v) > 0, 1)).alias(f"t{i}"), F.sum(v).alias(f"w{i}")]
        aggs += [F.sum(F.col(v) * F.col(c)).alias(f"{c[-1]}{i}") for c in TILE]
        aggs.append(F.sqrt(sum((F.max(x) - F.min(x)).cast("double") * (F.max(x) - F.min(x)) for x in there)).alias(f"d{i}"))
    return rows.groupBy("id", "of").agg(*aggs)


def _user_values(users: DataFrame) -> DataFrame:
    """what, sub_period, x: every value that goes into a histogram by user."""
    one = lambda what, sub, x, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(what).alias("what"), F.lit(sub).alias(SUB), x.cast("double").alias("x")))
    of = lambda name, c: F.max(F.when(F.col("of") == name, F.col(c)))
    sides = {"h": "ntwend", "old_s": "nwend", "new_s": "nd"}
    names = {c: [c] if c == "n" else [f"{c}{i}" for i in range(4)] for c in "ntwed"}
    names["n"] = ["n", *(f"n{i}" for i in range(4))]
    aggs = [of(name, c).alias(f"{name}_{c}") for name, kinds in sides.items() for kind in dict.fromkeys(kinds) for c in names[kind]]
    rows = users.groupBy("id").agg(*aggs)
    values = [one(f"count_{name}", 0, F.col(f"{name}_n"), F.col(f"{name}_n").isNotNull()) for name in sides]
    for i in range(4):
        c = lambda name, kind: F.col(f"{name}_{kind}{i}")  # noqa: E731, B023
        values.append(one("tiles", i, c("h", "t"), c("h", "t") > 0))
        apart = [F.try_divide(c("h", k), c("h", "w")) - F.try_divide(c("old_s", k), c("old_s", "w")) for k in "en"]
        values.append(one("distance", i, F.sqrt(apart[0] * apart[0] + apart[1] * apart[1]), (c("h", "w") != 0) & (c("old_s", "w") != 0)))
        values += [one(f"box_{name}", i, c(name, "d"), c(name, "d").isNotNull()) for name in ("h", "old_s")]
        change = F.abs(c("old_s", "d") - c("new_s", "d"))
        values.append(one("box_change", i, change, change.isNotNull()))
    return rows.select(F.explode(F.filter(F.array(*values), lambda v: v.isNotNull())).alias("v")).select("v.*")


#: Bins and lowest edge of each histogram.
SHAPES = {"count": (10, 1), "tiles": (10, 1), "weight": (17, 1 / 256), "distance": (10, 256), "box": (8, 1024)}
#: The text of the indicators in an application log.
OMITTED = "The indicators are omitted because the user count is too small.\n"
DUPLICATES = "Number of duplicate records in the H file: "
TITLES = {"h": "H", "old_s": "Old S", "new_s": "New S"}
COUNT_LINES = ("\n\tNumber of unique users in file: ", "\n\tNumber of records in file: ", "\n\tHistogram of Number of records per user:\n")
PATTERNS = (
    "Histogram: count of H records with given subperiod pattern (subperiod order in pattern 0,1,2,3)."
    " 0 in pattern position i means given subperiod i had weight 0 in given record, 1 means weight >0. :\n"
)
TILES = "H histogram of number of unique tiles per user (with presence > 0) for subperiod "
WEIGHTS = " histogram of weight values in subperiod "
DISTANCE = "Histogram of distance between user H and old S average position in subperiod "
BOXES = {
    "box_h": "Histogram of user tiles bounding box diagonal length in H",
    "box_old_s": "Histogram of user tiles bounding box diagonal length in old S",
    "box_change": "Histogram of user tiles bounding box diagonal length difference between old S and new S",
}
IN_SUBPERIOD = " in subperiod "


def bucket_counts(s: DataFrame, n: int) -> DataFrame:
    """bucket, what (count, box or weight), sub_period, bin, n: what the indicators of a state add up from, for each of n buckets by
    user."""
    users = _sums([("s", s)])
    one = lambda what, sub, x: F.struct(F.lit(what).alias("what"), F.lit(sub).alias(SUB), x.cast("double").alias("x"))
    each = [one("count", 0, F.col("n")), *(F.when(F.col(f"d{i}").isNotNull(), one("box", i, F.col(f"d{i}"))) for i in range(4))]
    values = users.select("id", F.explode(F.filter(F.array(*each), lambda v: v.isNotNull())).alias("v")).select("id", "v.*")
    values = values.unionByName(_unpivot(s, VALUES, "x", "id").select("id", F.lit("weight").alias("what"), SUB, "x"))
    return values.groupBy(bucket_of(n).alias("bucket"), "what", SUB, _bins().alias("bin")).agg(F.count("*").alias("n"))


def _bins():
    return F.coalesce(*(F.when(F.col("what").startswith(kind), log2_bin(F.col("x"), *shape)) for kind, shape in SHAPES.items()))


def log_text(h: DataFrame, old: DataFrame, new: DataFrame, duplicates: int, k: int, rest: dict | None = None) -> str:
    """The indicators' part of an application log: all of them, k-anonymous, or a line where the gate is closed.

    h (cleaned), old and new are stored tables; by user each is aggregated once. Only counts of bins reach the driver. rest: counts
    of bins (by what and sub_period, as bucket_counts has them) of users that old and new lack, since nothing of them has changed."""
    rest = rest or {}
    users = by_user(h, old, new).persist()
    try:
        totals = {r["of"]: (r["users"], r["n"]) for r in users.groupBy("of").agg(F.count("*").alias("users"), F.sum("n").alias("n")).collect()}
        more = [sum(rest.get(x, {}).values()) for x in (("count", 0), ("weight", 0))]  # users and records: each has one of these
        totals |= {name: tuple(a + b for a, b in zip(totals.get(name, (0, 0)), more, strict=True)) for name in ("old_s", "new_s")}
        if not gate_open(totals.get("h", (0, 0))[0], totals.get("new_s", (0, 0))[0], k):
            return "\n" + OMITTED
        values = _user_values(users)
        for name, t in (("h", h), ("old_s", old)):
            values = values.unionByName(_unpivot(t, VALUES, "x").select(F.lit(f"weight_{name}").alias("what"), SUB, "x"))
        counted = {}
        for r in values.groupBy("what", SUB, _bins().alias("bin")).agg(F.count("*").alias("n")).collect():  # some hundred bins
            counted.setdefault((r["what"], r[SUB]), {})[r["bin"]] = r["n"]
        patterns = sorted((r["pattern"], r["count"]) for r in spatiotemporal(h).collect())
    finally:
        users.unpersist()
    for (what, sub), bins in rest.items():
        own = {f"{what}_{side}": bins for side in ("old_s", "new_s")}
        for name, more in (own | ({"box_change": {0: sum(bins.values())}} if what == "box" else {})).items():
            at = counted.setdefault((name, sub), {})
            at.update({b: at.get(b, 0) + n for b, n in more.items()})
    lines = lambda what, sub, prefix: "".join(text_lines(counted.get((what, sub), {}), *SHAPES[what.split("_")[0]], k, prefix))
    out = ["\n", f"{DUPLICATES}{duplicates}\n", "\n"]
    for name, title in TITLES.items():
        n = totals.get(name, (0, 0))
        out.append(f"{title}:{COUNT_LINES[0]}{n[0]}{COUNT_LINES[1]}{n[1]}{COUNT_LINES[2]}{lines(f'count_{name}', 0, chr(9) * 2)}")
    out += ["\n", PATTERNS, *(f"\t{p:04b}: {anonymous(n, k)}\n" for p, n in patterns), "\n"]
    out += [f"{TILES}{i}:\n{lines('tiles', i, chr(9))}" for i in range(4)] + ["\n"]
    out += [f"{TITLES[name]}{WEIGHTS}{i}:\n{lines(f'weight_{name}', i, chr(9))}" for name in ("h", "old_s") for i in range(4)] + ["\n"]
    out += [f"{DISTANCE}{i}:\n{lines('distance', i, chr(9))}" for i in range(4)]
    for what, title in BOXES.items():
        out += ["\n", *(f"{title}{IN_SUBPERIOD}{i}:\n{lines(what, i, chr(9))}" for i in range(4))]
    return "".join(out)


def gate_open(h_users: int, new_users: int, k: int) -> bool:
    """All indicators are hidden unless both populations have 1000 * k users."""
    return min(h_users, new_users) >= 1000 * k
