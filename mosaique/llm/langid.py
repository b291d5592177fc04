"""Language identification by compression.

For each language, normalised pieces of labelled texts make a zstandard raw-content dictionary. A text, normalised and cut
into blocks, is compressed block by block with every dictionary; the language with the smallest sum wins. A tie of whole
bytes is broken by the sums at the levels FINER. A margin (the share by which the next best is larger) under NARROW rejects
the decision.

The sample: every labelled text is cut into pieces of PIECE characters, any of which may be drawn, by the hash of the piece;
a piece that occurs in many texts counts once. A language gets its PIECES first ones in the order of their hashes, or so many
fewer that all languages together have ALL_PIECES (each has one at least). These two numbers bound what reaches the driver;
no language and no place in a text is left out. Predictions read whole texts and no other column.

Null text, or one without a letter: `und`, score 0. If nothing was learned: `und` everywhere. One language: score 1. Ties at
all levels go to the language that comes first by name. Repeated rows each get their row; the same text gives the same result.
Very long texts are compressed whole, block by block. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mosaique.llm.common import slices, stored

PIECE, PIECES, ALL_PIECES, PARTS = 1000, 112, 1 << 16, 256
BLOCK, LEVEL, FINER, NARROW = 2048, 12, (19, 15, 9, 6, 3), 0.01
UNKNOWN = "und"


def normalised(texts: pa.Array) -> pa.Array:
    """Lower-case letters with single spaces around words; a text without a letter is one space or empty."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pM]+", " ")


def dictionaries(labelled: DataFrame, pieces: int = PIECES, total: int = ALL_PIECES) -> dict[str, bytes]:
    """Raw content by language, from labelled (doc_id, text, lang)."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    # Each task keeps a language's first pieces by their hashes; then parts of a language do, then the language.
    drawn = rows.mapInArrow(_first(pieces), "lang string, drawn long, piece string").distinct()
    order = Window.partitionBy("lang", F.pmod("drawn", F.lit(PARTS))).orderBy("drawn", "piece")
    drawn = stored(drawn.withColumn("k", F.row_number().over(order)).where(F.col("k") <= pieces), "pieces")
    each = max(1, min(pieces, total // max(1, drawn.select("lang").distinct().count())))
    order = Window.partitionBy("lang").orderBy("drawn", "piece")  # PARTS * pieces rows of a language at most
    got = drawn.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each).orderBy("lang", "k").toArrow()
    found: dict[str, list[str]] = {}
    for lang, piece in zip(got["lang"].to_pylist(), got["piece"].to_pylist(), strict=True):
        found.setdefault(lang, []).append(piece)
    return {k: "".join(normalised(pa.array(v)).to_pylist()).encode() for k, v in found.items()}


def _first(pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        kept: dict[str, dict[str, int]] = {}
        rank = lambda own: sorted(own.items(), key=lambda y: (y[1], y[0]))[:pieces]
        for part in slices(batches):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                own = kept.setdefault(lang, {})
                for at in range(0, len(text), PIECE):
                    piece = text[at : at + PIECE]
                    own[piece] = xxhash.xxh3_64_intdigest(piece.encode()) >> 1
                    if len(own) > 4 * pieces:
                        own = kept[lang] = dict(rank(own))
        out = [(lang, h, piece) for lang, own in kept.items() for piece, h in rank(own)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["lang", "drawn", "piece"])

    return run


class Sizes:
    """Compressed bytes of normalised texts with each dictionary; compressors are made when a level is first asked for."""

    def __init__(self, contents: dict[str, bytes]):
        self.contents, self.levels = list(contents.values()), {}

    def _compressors(self, level: int) -> list:
        import zstandard

        if level not in self.levels:
            self.levels[level] = []
            for content in self.contents:
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                self.levels[level].append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return self.levels[level]

    def __call__(self, raw: bytes, level: int = LEVEL) -> np.ndarray:
        squeeze, out = self._compressors(level), np.zeros(len(self.contents))
        for at in range(0, len(raw), BLOCK):
            block = raw[at : at + BLOCK]
            out += [len(x.compress(block)) for x in squeeze]
        return out

    def best(self, raw: bytes) -> tuple[int, float]:
        """The language's number, and the margin to the next best."""
        size = self(raw)
        order = np.sort(size)
        tied = np.flatnonzero(size == order[0])
        if len(tied) > 1:
            finer = sum(self(raw, level) for level in FINER)
            tied = tied[finer[tied] == finer[tied].min()]
        return int(tied[0]), 1 - order[0] / order[1] if len(order) > 1 else 1.0


def identify(docs: DataFrame, contents: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """doc_id, held_out (kept if there), lang_pred, score, rejected."""
    names = np.array([*contents, UNKNOWN], object)
    shared = docs.sparkSession.sparkContext.broadcast(contents)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for part in slices(batches):
            plain = normalised(part.column("text"))
            lettered = np.flatnonzero(np.asarray(pc.match_substring_regex(plain, r"\pL"))) if len(names) > 1 else []
            best, score = np.full(len(plain), len(names) - 1), np.zeros(len(plain))
            for i in lettered:
                best[i], score[i] = sizes.best(plain[int(i)].as_py().encode())
            cols = [part.column("doc_id"), part.column("held_out"), pa.array(names[best], pa.string()), pa.array(score), pa.array(score < narrow)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    return docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(predict, schema)


def language(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learns from the rows that are not held out, and predicts all."""
    split = docs.select("doc_id", "text", F.col("lang").cast("string"), held_out.alias("held_out"))
    return identify(split.drop("lang"), dictionaries(split.where(~F.col("held_out"))))
