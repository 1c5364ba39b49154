"""Media columns: WAV bytes, short-time Fourier transforms and spectral-peak pair fingerprints.

A payload is stored as the samples of an 8-bit mono WAV file written by the wave
module, so the column is the file. Features come from the bytes read back:
windowed Fourier transforms of ``FRAME`` samples every ``HOP`` (half a frame, so that a sample
at the end of one frame is in the middle of another), the strongest peaks
of each frame, and pairs of a peak with all later peaks within ``REACH`` frames, each
kept as a time code and a hash of both frequencies and their distance in time.

Defined results: null and empty texts are stored as 64 zero samples; a payload of
zeros or of one tone has few or no peaks and an empty array; equal texts give
equal values; long payloads are transformed in blocks of frames; an empty table
gives an empty result; extra columns stay out of the way.
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
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

UNIT = 64
RATE = 8000
FRAME = 256
HOP = FRAME // 2
PEAKS = 3
REACH = 8
_BLOCK = 4096
_CHUNK = 1 << 20
_TAPER = np.hanning(FRAME).astype(np.float32)
FEATURES = StructType(
    [StructField("payload_bytes", LongType()), StructField("payload_sha256", StringType()), StructField("tail_crc32", LongType()), StructField("frames", IntegerType())]
    + [StructField(name, ArrayType(IntegerType())) for name in ("codes", "hashes")]
)


def padded(raw: bytes) -> bytes:
    """With zeros up to a positive multiple of ``UNIT`` bytes."""
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b"\0")


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        if r.getsampwidth() != 1 or r.getnchannels() != 1:
            raise ValueError("8-bit mono samples are expected")
        return r.readframes(r.getnframes())


def peaks(samples: np.ndarray, hop: int = FRAME) -> tuple[np.ndarray, np.ndarray, int]:
    """Frame and frequency of the local maxima that stand out most in each frame; the number of frames."""
    n = max(1, -(-(len(samples) - FRAME) // hop) + 1)
    x = np.zeros((n - 1) * hop + FRAME, np.float32)
    x[: len(samples)] = samples.astype(np.float32) - np.float32(128)
    times, freqs = [], []
    for at in range(0, n, _BLOCK):
        m = min(_BLOCK, n - at)
        frames = np.lib.stride_tricks.sliding_window_view(x[at * hop : (at + m - 1) * hop + FRAME], FRAME)[::hop]
        power = np.abs(np.fft.rfft(frames * _TAPER, axis=1))[:, 1:]
        inner = power[:, 1:-1]
        top = np.where((inner > power[:, :-2]) & (inner >= power[:, 2:]) & (inner > 2 * power.mean(axis=1, keepdims=True)), inner, 0)
        best = np.sort(np.argpartition(-top, PEAKS, axis=1)[:, :PEAKS], axis=1)
        t, k = np.nonzero(np.take_along_axis(top, best, axis=1) > 0)
        times.append(t + at)
        freqs.append(best[t, k] + 2)
    return np.concatenate(times), np.concatenate(freqs), n


def pair_fingerprints(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Time codes and hashes of peak pairs, in order of time; the number of frames."""
    t, f, n = peaks(samples, HOP)
    codes, hashes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for step in range(1, PEAKS * (REACH + 1)):  # no more peaks lie within REACH frames
        gap = t[step:] - t[:-step]
        ok = (gap > 0) & (gap <= REACH)
        codes.append(t[:-step][ok].astype(np.int32))
        hashes.append(((f[:-step][ok] << 12) | (f[step:][ok] << 4) | gap[ok]).astype(np.int32))
    code, value = np.concatenate(codes), np.concatenate(hashes)
    order = np.lexsort((value, code))
    return code[order], value[order], n


def _describe(media: bytes) -> dict:
    payload = from_wav(media)
    codes, hashes, n = pair_fingerprints(np.frombuffer(payload, np.uint8))
    return {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-UNIT:]), "frames": n, "codes": codes, "hashes": hashes}


def _parts(batch: pa.Array) -> Iterator[pa.Array]:
    """The batch in parts of at most ``_CHUNK`` bytes, or one row where that is larger: what a part gives is several times its size."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch), 0), np.int64)
    ends, low = np.cumsum(sizes), 0
    while low < len(batch):
        begin = int(ends[low] - sizes[low])
        high = max(low + 1, int(np.searchsorted(ends, begin + _CHUNK, side="right")))
        yield batch.slice(low, high - low)
        low = high


@F.arrow_udf(BinaryType())
def _encode(raw: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in raw:
        for part in _parts(batch):
            yield pa.array([to_wav(padded(x.as_py() or b"")) for x in part], pa.binary())


_KINDS = pa.struct([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("frames", pa.int32()), ("codes", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int32()))])


@F.arrow_udf(FEATURES)
def _features(media: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in media:
        for part in _parts(batch):
            yield pa.array([_describe(x.as_py()) for x in part], _KINDS)


def wav(text: Column) -> Column:
    """The text's UTF-8 bytes, padded, as the bytes of a WAV file."""
    return _encode(F.encode(text, "UTF-8"))


def wav_features(media: Column) -> Column:
    """What the stored bytes hold: payload measures and peak pairs as time-coded arrays."""
    return _features(media)


def media_columns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as struct ``row`` with ``n_bytes, media, heard``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes")
    stored = docs.select(row, size, wav(F.col(text_col)).alias("media"))
    return stored.withColumn("heard", wav_features(F.col("media")))
