"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The trie holds the pieces' UTF-8 bytes. Every distinct part of a slice of texts (a part begins at a run of space markers) is
encoded once, all parts in lockstep: numpy walks the trie from each position of all of them together. A character that no
piece of one character covers takes the unknown score and becomes byte pieces. Ties keep the path found first within a
part, so equal parts are encoded equally wherever they stand (a library that sums over a whole text breaks exact ties by
the rounding of what went before).

A model file whose scores are merge ranks gets log scores by Zipf's law, -log(rank + 1) up to a constant.

Null and empty text: no token, and it decodes to the empty text. Repeated rows each get their row. Very long texts are
encoded whole; parts longer than LOCKSTEP bytes are walked one by one. A text that has the marker character itself decodes
to one with spaces instead (round_trip is false). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import coded, per_row, slices, spread
from mosaique.llm.tokens import MARKER, marked_parts

LOCKSTEP, UNKNOWN_COST = 48, 10.0
#: States searched at a time for a place in the trie; parts walked together.
SPAN, TOGETHER = 2048, 16_384
MARK = MARKER.encode()


@dataclass
class Trie:
    """base[s] + byte is the state behind state s, if check of it is s; value is the piece that ends there, or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, pieces: dict[bytes, int]) -> Trie:
        root: dict = {}
        for piece, number in pieces.items():
            node = root
            for b in piece:
                node = node.setdefault(b, {})
            node[-1] = number
        nodes, size = [(0, root)], 1 << 18
        base, check, value, low = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32), 1
        check[0] = 0
        while nodes:
            state, node = nodes.pop()
            value[state] = node.get(-1, -1)
            keys = np.array(sorted(k for k in node if k >= 0), np.int64)
            if not len(keys):
                continue
            begin = low
            while True:  # the first place in a window where all children find free states
                if begin + SPAN + 512 > len(base):
                    base, check, value = (np.concatenate((x, np.full(len(x), e, np.int32))) for x, e in ((base, 0), (check, -1), (value, -1)))
                free = begin + np.flatnonzero(check[begin : begin + SPAN] < 0)
                if begin == low and len(free) < SPAN // 16:
                    low += SPAN  # nearly full: no longer searched
                at = free - keys[0]
                at = at[at > 0]
                for k in keys[1:]:
                    at = at[check[at + k] < 0]
                if len(at):
                    break
                begin += SPAN
            base[state] = at[0]
            check[at[0] + keys] = state
            nodes += [(int(at[0] + k), node[int(k)]) for k in keys]
        return cls(base, check, value)


@dataclass
class Pieces:
    trie: Trie
    scores: np.ndarray
    surface: list[bytes]
    byte_ids: np.ndarray  # piece of each byte
    unknown: np.float32
    longest: int

    @classmethod
    def of(cls, surface: list[bytes], scores: np.ndarray, byte_ids: np.ndarray, normal: np.ndarray) -> Pieces:
        """surface, float32 log score, the piece of each byte value, and which pieces text is made of."""
        kept = {surface[i]: i for i in np.flatnonzero(normal).tolist()}
        return cls(Trie.of(kept), scores.astype(np.float32), surface, byte_ids, np.float32(scores[normal].min() - UNKNOWN_COST), max(map(len, kept)))

    @classmethod
    def from_model(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        byte_ids, surface, normal = np.zeros(256, np.int64), [], np.zeros(n, bool)
        for i, name in enumerate(names):
            if model.is_byte(i):
                byte_ids[int(name[3:-1], 16)] = i
                surface.append(bytes([int(name[3:-1], 16)]))
            else:
                normal[i] = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
                surface.append(name.encode() if normal[i] else b"")
        rank = -np.array([model.get_score(i) for i in range(n)])
        scores = -np.log1p(np.maximum(rank, 0))
        scores -= np.log(np.exp(scores[normal]).sum())
        return cls.of(surface, scores.astype(np.float32), byte_ids, normal)


def _spell(piece: int, raw: bytes, p: Pieces) -> list[int]:
    return [piece] if piece >= 0 else p.byte_ids[np.frombuffer(raw, np.uint8)].tolist()


def encode_one(raw: bytes, p: Pieces) -> list[int]:
    """The best path of one part, position by position."""
    base, check, value = p.trie.base, p.trie.check, p.trie.value
    n = len(raw)
    best, back = [None] * (n + 1), [(0, -1)] * (n + 1)
    best[0] = np.float32(0)
    i = 0
    while i < n:
        wide = _width(raw[i])
        state, single = 0, False
        for j in range(i, min(n, i + p.longest)):
            after = int(base[state]) + raw[j]
            if not base[state] or check[after] != state:
                break
            state = after
            piece = int(value[state])
            if piece >= 0:
                score = best[i] + p.scores[piece]
                single |= j + 1 == i + wide
                if best[j + 1] is None or score > best[j + 1]:
                    best[j + 1], back[j + 1] = score, (i, piece)
        if not single:
            score = best[i] + p.unknown
            if best[i + wide] is None or score > best[i + wide]:
                best[i + wide], back[i + wide] = score, (i, -1)
        i += wide
    out, at = [], n
    while at:
        begin, piece = back[at]
        out.append(_spell(piece, raw[begin:at], p))
        at = begin
    return [x for y in reversed(out) for x in y]


def _width(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def encode_parts(parts: list[bytes], p: Pieces) -> list[list[int]]:
    """The best path of every part; parts of up to LOCKSTEP bytes go together."""
    out: list = [None] * len(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    for i in np.flatnonzero(size > LOCKSTEP).tolist():
        out[i] = encode_one(parts[i], p)
    short = np.flatnonzero(size <= LOCKSTEP)
    short = short[np.argsort(-size[short], kind="stable")]
    for at in range(0, len(short), TOGETHER):
        _lockstep(parts, short[at : at + TOGETHER], size, p, out)
    return out


def _lockstep(parts: list[bytes], short: np.ndarray, size: np.ndarray, p: Pieces, out: list) -> None:
    """Fills out for the parts numbered in short, all walked at the same time."""
    n, wide = size[short], int(size[short].max(initial=0))
    flat = np.frombuffer(b"".join(parts[i].ljust(wide, b"\0") for i in short.tolist()), np.uint8).reshape(len(short), wide).astype(np.int32)
    lead = (flat & 0xC0) != 0x80
    width = np.where(flat < 0x80, 1, np.where(flat < 0xE0, 2, np.where(flat < 0xF0, 3, 4))).astype(np.int8)
    best = np.full((len(short), wide + 1), -np.inf, np.float32)
    best[:, 0] = 0
    begin, piece_at = np.zeros((len(short), wide + 1), np.int16), np.full((len(short), wide + 1), -1, np.int32)
    base, check, value = p.trie.base, p.trie.check, p.trie.value
    for i in range(wide):
        rows = np.flatnonzero((n > i) & lead[:, i])
        start, single, every = best[rows, i], np.zeros(len(rows), bool), np.arange(len(rows))
        state, here, mine = np.zeros(len(rows), np.int32), rows, every
        for j in range(i, min(wide, i + p.longest)):
            root = base[state]
            after = root + flat[here, j]
            ok = (root > 0) & (check[after] == state) & (n[here] > j)
            here, mine, state = here[ok], mine[ok], after[ok]
            if not len(here):
                break
            number = value[state]
            hit = np.flatnonzero(number >= 0)
            if len(hit):
                r, score = here[hit], start[mine[hit]] + p.scores[number[hit]]
                single[mine[hit]] |= width[r, i] == j + 1 - i
                better = score > best[r, j + 1]
                r = r[better]
                best[r, j + 1], begin[r, j + 1], piece_at[r, j + 1] = score[better], i, number[hit][better]
        lone = every[~single]
        r = rows[lone]
        to = np.minimum(i + width[r, i], wide)
        score = start[lone] + p.unknown
        better = score > best[r, to]
        best[r[better], to[better]], begin[r[better], to[better]], piece_at[r[better], to[better]] = score[better], i, -1
    begins, ids = begin.tolist(), piece_at.tolist()
    for k, (i, at) in enumerate(zip(short.tolist(), n.tolist(), strict=True)):
        path = []
        while at:
            a, piece = begins[k][at], ids[k][at]
            if piece >= 0:
                path.append(piece)
            else:
                path += reversed(_spell(-1, parts[i][a:at], p))
            at = a
        out[i] = path[::-1]


def encode(texts: pa.Array, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by text, and the ids of all texts."""
    offsets, parts = marked_parts(texts)
    codes, distinct = coded(parts)
    each = encode_parts(distinct.cast(pa.binary()).to_pylist(), p)
    size = np.fromiter(map(len, each), np.int64, len(each))
    pool = np.fromiter((x for y in each for x in y), np.int64, int(size.sum()))
    first = np.cumsum(size) - size
    return np.concatenate(([0], np.cumsum(per_row(size[codes], offsets)))), pool[spread(first[codes], size[codes])]


def decode(offsets: np.ndarray, ids: np.ndarray, p: Pieces) -> list[bytes]:
    """UTF-8 of each text: bytes of the pieces, markers as spaces, without the one in front."""
    size = np.fromiter(map(len, p.surface), np.int64, len(p.surface))
    pool = np.frombuffer(b"".join(p.surface), np.uint8)
    first = np.cumsum(size) - size
    flat = pool[spread(first[ids], size[ids])].tobytes()
    ends = np.concatenate(([0], np.cumsum(size[ids])))[offsets].tolist()
    return [flat[a:b].replace(MARK, b" ")[1:] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encoded(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, ids_crc32 (of little-endian unsigned 32-bit ids), round_trip; and ids, if wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.from_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Pieces = shared.value
        is_byte = np.zeros(len(p.surface), bool)
        is_byte[p.byte_ids] = True
        for part in slices(batches, limit=6 << 20):
            texts = pc.fill_null(part.column("text"), "")
            offsets, ids = encode(texts, p)
            raw = ids.astype("<u4")
            spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            same = [a == b for a, b in zip(decode(offsets, ids, p), texts.cast(pa.binary()).to_pylist(), strict=True)]
            crc = [zlib.crc32(raw[a:b]) for a, b in spans]
            cols = [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(per_row(is_byte[ids].astype(np.int64), offsets)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
            names = ["doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", "round_trip"]
            if with_ids:
                cols, names = [*cols, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
