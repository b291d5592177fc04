"""Media columns: bytes stored losslessly as 8-bit sound, and audio features with time spans.

A payload becomes a mono WAV file of unsigned 8-bit samples at RATE, in a stored table. Features come from what is read back:
polyphase resampling by UP / DOWN, overlapped frames, log-mel filter banks, and segments where the energy rises over an upper
level and until it falls below a lower one (hysteresis). They are stored too, for each document as an Arrow record batch of
TENSORS: blocks of BLOCK_FRAMES frames as fixed-shape tensors with their time spans, and the segments that begin in them.
`feature` is made from those tensors, as they are read back.

Null and empty payloads: one padded unit of PAD spaces. Repeated rows each get their row, and equal payloads equal values.
Very long payloads are resampled and framed block by block. Silence (all samples equal) makes one segment over all frames,
as its energy meets both levels. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import slices, stored, text_of

PAD = 192
RATE, UP, DOWN = 12_000, 2, 3
FRAME, HOP, FFT, MELS, TAPS = 200, 80, 256, 20, 24
BLOCK_FRAMES, WORK_FRAMES = 64, 4096
UPPER, LOWER = 0.6, 0.4
DIGESTS = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]
TENSOR, SPAN = pa.fixed_shape_tensor(pa.float16(), (BLOCK_FRAMES, MELS)), pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())])
TENSORS = pa.schema([("block", pa.int64()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("n_frames", pa.int64()), ("log_mel", TENSOR), ("segments", pa.list_(SPAN))])


def padded(raw: bytes) -> bytes:
    """raw with spaces up to a positive multiple of PAD."""
    return raw.ljust(max(1, -(-len(raw) // PAD)) * PAD, b" ")


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(RATE)
        f.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as f:
        return f.readframes(f.getnframes())


def _phases() -> np.ndarray:
    """Filter of each output phase: a windowed sinc at the lower of both Nyquist rates, cut into UP phases."""
    n = np.arange(UP * TAPS) - (UP * TAPS - 1) / 2
    taps = np.sinc(n / max(UP, DOWN)) * np.hanning(UP * TAPS + 2)[1:-1]
    taps *= UP / taps.sum()
    return np.stack([taps[p::UP][::-1] for p in range(UP)])


def _mel() -> np.ndarray:
    top = 2595 * np.log10(1 + RATE * UP / DOWN / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, MELS + 2) / 2595) - 1)
    bins = np.arange(FFT // 2 + 1) * RATE * UP / DOWN / FFT
    rise = (bins - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    fall = (edges[2:, None] - bins) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(rise, fall)).T


PHASES, MEL, HANN = _phases(), _mel(), np.hanning(FRAME)


def resampled(samples: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Outputs begin to end (both multiples of UP) of the signal at RATE * UP / DOWN; there are zeros around the input."""
    half = TAPS // 2
    first, last = begin * DOWN // UP - half, -(-end * DOWN // UP) + half + TAPS
    part = samples[max(0, first) : max(0, last)]
    if part.dtype == np.uint8:  # stored samples; only the part at hand becomes floats
        part = part / 128.0 - 1.0
    part = np.pad(part, (max(0, -first), max(0, last - max(0, first) - len(part))))
    windows = np.lib.stride_tricks.sliding_window_view(part, TAPS)
    out = np.empty(end - begin)
    for k in range(UP):
        at = (np.arange(k, end - begin, UP) * DOWN) // UP
        out[k::UP] = windows[at] @ PHASES[(k * DOWN) % UP]
    return out


def log_mel(payload: bytes) -> np.ndarray:
    """Log mel energies by frame; the last frame is filled up with zeros, so that frames cover all samples."""
    samples = np.frombuffer(payload, np.uint8)
    size = len(samples) * UP // DOWN
    frames = 1 + max(0, -(-(size - FRAME) // HOP))
    out = np.empty((frames, MELS))
    for a in range(0, frames, WORK_FRAMES):
        b = min(frames, a + WORK_FRAMES)
        signal = resampled(samples, a * HOP, (b - 1) * HOP + FRAME)
        view = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP]
        power = np.abs(np.fft.rfft(view * HANN, FFT)) ** 2
        out[a:b] = np.log(power @ MEL + 1e-8)
    return out


def energies(mel: np.ndarray) -> np.ndarray:
    """Mean of each frame's bands, rounded so that equal frames are equal whatever their place in memory."""
    return np.round(mel.mean(1), 3)


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frames [from, to) where the energy is on: from the upper level until it falls below the lower one."""
    upper, lower = np.quantile(energy, UPPER), np.quantile(energy, LOWER)
    mark = np.where(energy >= upper, 1, np.where(energy < lower, 0, -1))
    known = np.maximum.accumulate(np.where(mark >= 0, np.arange(len(mark)), -1))
    on = np.concatenate(([0], np.where(known >= 0, mark[known], 0), [0]))
    edges = np.flatnonzero(np.diff(on))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def seconds(frame: int | np.ndarray) -> float | np.ndarray:
    return frame * HOP * DOWN / UP / RATE


def blocks(mel: np.ndarray) -> pa.RecordBatch:
    """The frames in blocks of one shape (zeros behind the last frame) with time spans, and the segments."""
    n = -(-len(mel) // BLOCK_FRAMES)
    full = np.pad(mel, ((0, n * BLOCK_FRAMES - len(mel)), (0, 0))).astype(np.float16).ravel()
    begin = np.arange(n) * BLOCK_FRAMES
    end = np.minimum(begin + BLOCK_FRAMES, len(mel))
    on = np.array(segments(energies(mel)), np.int64).reshape(-1, 2)
    bounds = np.searchsorted(on[:, 0], np.arange(n + 1) * BLOCK_FRAMES).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(seconds(on[:, k])) for k in (0, 1)], fields=list(SPAN))
    size = BLOCK_FRAMES * MELS
    tensor = pa.ExtensionArray.from_storage(TENSOR, pa.FixedSizeListArray.from_arrays(pa.array(full), size))
    cols = [pa.array(np.arange(n)), pa.array(seconds(begin)), pa.array(seconds(end)), pa.array(end - begin), tensor, pa.ListArray.from_arrays(pa.array(bounds), spans)]
    return pa.RecordBatch.from_arrays(cols, schema=TENSORS)


def opened(tensors: bytes) -> pa.RecordBatch:
    """A document's stored features as TENSORS."""
    return pa.ipc.read_record_batch(pa.py_buffer(tensors), TENSORS)


def stored_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: a stored table of sound files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw = part.column("text").cast(pa.binary())
            media = [to_wav(padded(x)) for x in raw.to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pc.binary_length(raw).cast(pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")
    return stored(rows, "media", compression="zstd")


def audio_features(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, tensors from doc_id, n_bytes, media."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "media", limit=1 << 20):
            rows = []
            for file in part.column("media").to_pylist():
                back = from_wav(file)
                tensors = blocks(log_mel(back)).serialize().to_pybytes()
                rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(file), hashlib.sha256(file).hexdigest(), tensors))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            cols = [part.column("doc_id"), part.column("n_bytes")] + [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cols, [*DIGESTS, "tensors"])

    kind = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, tensors binary"
    return media.mapInArrow(run, kind)


def summary(tensors: bytes) -> str:
    """Frames, segments, seconds in segments, and the mean of each mel band in thousandths."""
    found = opened(tensors)
    frames, mel = found.column("n_frames").to_numpy(), found.column("log_mel").to_numpy_ndarray()
    there = np.arange(BLOCK_FRAMES) < frames[:, None]
    means = np.round(mel.astype(np.float64)[there].mean(0) * 1000).astype(int)
    spans = found.column("segments").flatten()
    inside = pc.sum(pc.subtract(spans.field(1), spans.field(0))).as_py() or 0.0
    return f"{frames.sum()};{len(spans)};{inside:.2f};" + ",".join(map(str, means))


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature."""
    kept = stored(audio_features(stored_media(docs)), "tensors", compression="zstd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "tensors"):
            feature = [summary(x) for x in part.column("tensors").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in DIGESTS), pa.array(feature, pa.string())], [*DIGESTS, "feature"])

    kind = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return kept.mapInArrow(run, kind)
