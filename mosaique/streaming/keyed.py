"""Streaming fold by user: keyed state instead of a versioned table.

Each user has its sums by tile and its open period with the maxima by tile so far. A micro-batch reads and writes the state of its
own users only; a user's rows of a later period close the open one and add its maxima to the sums. Rows of a period that a user
has closed are late and go to a table of their own. What is in the state of a batch's users afterwards is written as the batch's
part, which replaces itself if the batch runs again; the newest part of a user is its state."""

from __future__ import annotations

from collections.abc import Iterator
from operator import add

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from mosaique.operators.clean import drop_invalid
from mosaique.schemas import KEY, TILE, VALUES
from mosaique.sources.sinks import settings

_ROWS = f"id string, tile_e int, tile_n int, {', '.join(f'{v} double' for v in VALUES)}, late boolean, period int"
_OUT = Row(*KEY, *VALUES, "late", "period")
_TILES = f"tile_e int, tile_n int, {', '.join(f'{v} double' for v in VALUES)}"
#: Spark's setting for a state store that keeps what doesn't fit in memory on disk and uploads changes alone.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class UserFold(StatefulProcessor):
    """Sums and open maxima of one user by tile, and the open period. They are one value, which a micro-batch reads once and writes
    once: each call to the store is a round trip."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        tiles = f"array<struct<{', '.join(x.replace(' ', ': ') for x in _TILES.split(', '))}>>"
        self.user = handle.getValueState("user", f"period int, sums {tiles}, open {tiles}")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.user.get()
        start, *tiles = before if before else (None, [], [])
        sums, open_ = ({(t[0], t[1]): tuple(t[2:]) for t in of} for of in tiles)
        at, late, own = start, [], []
        for r in rows:  # one user's rows of a micro-batch
            (late if start is not None and r["period"] < start else own).append(r)
        for r in sorted(own, key=lambda r: r["period"]):
            if r["period"] != at:
                sums, open_, at = _added(sums, open_), {}, r["period"]
            tile, values = (r["tile_e"], r["tile_n"]), tuple(r[v] for v in VALUES)
            open_[tile] = tuple(map(max, open_[tile], values)) if tile in open_ else values
        if own:
            self.user.update((at, _packed(sums), _packed(open_)))
        for t, v in _added(sums, open_).items():
            yield _OUT(*key, *t, *v, False, at)
        for r in late:
            yield _OUT(*key, *(r[c] for c in (*TILE, *VALUES)), True, r["period"])

    def close(self) -> None:
        pass


def _added(a: dict, b: dict) -> dict:
    """Values by tile, added up."""
    return a | {t: tuple(map(add, a[t], v)) if t in a else v for t, v in b.items()}


def _packed(tiles: dict) -> list[tuple]:
    return [(*t, *v) for t, v in tiles.items()]


def fold_stream(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Starts the fold of a stream of H rows with their period (ids as text). Parts are in out/state and out/late."""
    clean = drop_invalid(rows).where(F.col("id").isNotNull()).select(*KEY, *VALUES, "period")
    folded = clean.groupBy("id").transformWithState(UserFold(), _ROWS, "Append", "None")

    parts = folded.writeStream.foreachBatch(lambda batch, number: write_part(batch, number, out)).option("checkpointLocation", checkpoint)
    with settings(rows.sparkSession, ROCKSDB):  # a query keeps the settings that it starts with
        return parts.trigger(availableNow=True).start()


def write_part(batch: DataFrame, number: int, out: str) -> None:
    batch.write.mode("overwrite").partitionBy("late").parquet(f"{out}/batch={number}")


def _parts(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{_ROWS.replace('late boolean, ', '')}, late boolean, batch int").option("basePath", out).parquet(f"{out}/batch=*")


def folded_state(spark: SparkSession, out: str) -> DataFrame:
    """The state: of each user the rows of its newest part."""
    rows = _parts(spark, out).where("not late")
    newest = rows.groupBy("id").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["id", "batch"], "left_semi").select(*KEY, *VALUES)


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    return _parts(spark, out).where("late").select(*KEY, *VALUES, "period")
