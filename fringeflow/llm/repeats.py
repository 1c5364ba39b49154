"""Removal of long repeated strings, by suffix arrays of shards.

A byte goes if a string of ``WIDTH`` bytes that covers it starts anywhere else too. All windows of ``WIDTH`` bytes
of all texts are dealt to shards so that equal windows meet, and each shard's suffix array (induced sorting) and
permuted common prefixes tell which of its windows are repeated.

How they are dealt: in each window the ``ANCHOR`` bytes with the smallest hash are its anchor, which equal windows
share. Neighbouring windows with one anchor are a stretch, named by the anchor's hash. A stretch whose anchor occurs
once holds no repeated window, so only the others are read again. Equal stretches are counted and sent once, with
their number, and only anchors that several different stretches share need a suffix array.

An anchor in the middle of a passage that many different documents share would be one large group. Where
the stretches of an anchor hold more than ``SHARD_BYTES`` they are split by where their windows begin: half as many
windows have more bytes in common, which name the halves, and so on until a single window is its own name. This decides where
windows meet, never what is equal.

Texts are told apart by the first 16 bytes of their SHA-256, and equal stretches by a 128-bit hash; inside shards bytes are compared.

Defined results: null counts as empty; texts under ``WIDTH`` bytes lose nothing; of texts that occur twice every byte
goes, if they are long enough; rows that repeat are copies like any others; long texts are cut into blocks of
``BLOCK`` windows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeflow.llm.suffixes import permuted_lcp, suffix_ranks
from fringeflow.plans.lineage import settle, shared_path

WIDTH = 400
REACH = 256
ANCHOR = WIDTH - REACH + 1
LEVELS = REACH.bit_length()
SHARD_BYTES = 1 << 20
BLOCK = 1 << 19
_POWER = 1 << (ANCHOR.bit_length() - 1)
_MIX, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # two odd numbers; any would do
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)

_STRETCH = "text_id binary, start long, windows int, back int, name long"
_PIECE = "text_id binary, start long, windows int, back int, name long, body binary, copies long"


def text_id(text: Column) -> Column:
    """What tells texts apart: 16 bytes of the SHA-256 of their UTF-8 bytes; null as empty."""
    return F.substring(F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)), 1, 16)


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * _MIX
    mixed ^= mixed >> np.uint64(29)
    return mixed + right * _ADD


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each place on, from hashes of half as many."""
    h = _paired(raw.astype(np.uint64) + _MIX, np.full(len(raw), _ADD))
    size = 1
    while size < _POWER:
        h = _paired(h[:-size], h[size:])
        size *= 2
    rest = ANCHOR - _POWER
    h = _paired(h[: len(h) - rest], h[rest:])
    h ^= h >> np.uint64(32)
    return h * _MIX


def _least(h: np.ndarray) -> np.ndarray:
    """The place of the first smallest hash among the ``REACH`` from each place on."""
    held = np.full(-(-(len(h) + REACH) // REACH) * REACH, np.iinfo(np.uint64).max, np.uint64)
    held[: len(h)] = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
    rows = held.reshape(-1, REACH)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(onward[: len(h)], upto[REACH - 1 : REACH - 1 + len(h)]) & _LOW).astype(np.int64)


def _stretches(blocks: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of the stretches of all blocks: the block, first window in it, number of windows, bytes from there to the anchor, hash of the anchor."""
    h = _hashes(np.frombuffer(b"".join(blocks), np.uint8))
    sizes = np.array([len(b) for b in blocks])
    begins, counts = np.cumsum(sizes) - sizes, sizes - WIDTH + 1
    ramp = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at, of = ramp + np.repeat(begins, counts), np.repeat(np.arange(len(blocks)), counts)
    anchor = _least(h)[at]
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])))
    return of[first], ramp[first], np.diff(first, append=len(at)), anchor[first] - at[first], h[anchor[first]].view(np.int64)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of texts ``(text_id, body)``, each of at least ``WIDTH`` bytes."""
    for batch in batches:
        blocks, held = [], 0
        for row, raw in enumerate(batch.column(1)):
            raw = raw.as_py()
            for low in range(0, len(raw) - WIDTH + 1, BLOCK):
                blocks.append((row, low, raw[low : low + BLOCK + WIDTH - 1]))
                held += len(blocks[-1][2])
                if held >= BLOCK:
                    yield _rows(batch.column(0), blocks)
                    blocks, held = [], 0
        if blocks:
            yield _rows(batch.column(0), blocks)


def _rows(ids: pa.Array, blocks: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    of, start, windows, back, name = _stretches([b[2] for b in blocks])
    row, low = np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])
    return pa.record_batch([ids.take(pa.array(row[of])), pa.array(start + low[of]), pa.array(windows.astype(np.int32)), pa.array(back.astype(np.int32)), pa.array(name)], ["text_id", "start", "windows", "back", "name"])


def _cut(level: int):
    """Names and bodies of the stretches ``cuts`` of each text, at a level of splitting."""
    reach = REACH >> level

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for i, raw, cuts in zip(ids, batch.column(1), batch.column(2)):
                raw = memoryview(raw.as_py())
                for c in cuts.as_py():
                    start, windows, back = c["start"], c["windows"], c["back"]
                    cell = back // reach
                    core = start + back - cell * reach
                    name = xxhash.xxh3_64_intdigest(raw[core : core + WIDTH - reach + 1], level * REACH + cell)
                    body = raw[start : start + windows + WIDTH - 1]
                    out.append((i, start, windows, back, name - (1 << 64 if name >> 63 else 0), xxhash.xxh3_128_digest(body), c["copies"]))
            columns = list(zip(*out)) or [()] * 7
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["text_id", "start", "windows", "back", "name", "body", "copies"])

    return cut


def repeated_windows(bodies: list[bytes], copies: list[int]) -> list[np.ndarray]:
    """For each body, which of its windows occur twice: in it, in another, or as the body itself does."""
    raw = np.frombuffer(b"".join(b + b"\0" for b in bodies), np.uint8).astype(np.int64) + 2
    ends = np.cumsum([len(b) + 1 for b in bodies]) - 1
    raw[ends] = 1
    s = np.append(raw, 0)
    used = np.zeros(258, np.int64)
    used[s] = 1
    s = (np.cumsum(used) - 1)[s]
    ranks = suffix_ranks(s)
    sa, shared = permuted_lcp(s, ranks)
    met = shared >= WIDTH  # the mark after a body is in no window, so none reaches past its body
    met[sa[:-1]] |= met[sa[1:]]
    out = []
    for body, end, n in zip(bodies, ends, copies):
        at = end - len(body)
        own = met[at : at + len(body) - WIDTH + 1]
        out.append(np.ones_like(own) if n > 1 else own)
    return out


def _spans(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


def _shard(rows: pa.Table) -> pa.Table:
    copies = rows.column("copies").to_pylist()
    found = [_spans(on) for on in repeated_windows(rows.column("bytes").to_pylist(), copies)]
    at = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
    return pa.table({"name": rows.column("name").take(at), "body": rows.column("body").take(at), "at": np.concatenate([f[0] for f in found]), "n": np.concatenate([f[1] for f in found])})


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bodies of one stretch for each row, with the text left behind."""
    for batch in batches:
        cols = {n: batch.column(n) for n in ("start", "windows", "text")}
        cut = [t.as_py()[s : s + w + WIDTH - 1] for t, s, w in zip(cols["text"], cols["start"].to_pylist(), cols["windows"].to_pylist())]
        yield pa.record_batch([batch.column("shard"), batch.column("name"), batch.column("body"), batch.column("copies"), pa.array(cut, pa.binary())], ["shard", "name", "body", "copies", "bytes"])


def _found(texts: DataFrame, pieces: DataFrame, level: int, shard_bytes: int) -> DataFrame:
    """``(text_id, start, at, n)``: the stretches of repeated windows of each piece, from its first window."""
    groups = pieces.groupBy("name", "body").agg(F.sum("copies").alias("copies"), F.min(F.struct("text_id", "start", "windows", "back")).alias("one"))
    groups = settle(groups, "repeat-body")
    held = groups.groupBy("name").agg(F.count("*").alias("bodies"), F.sum(F.col("one.windows") + WIDTH - 1).alias("bytes")).where("bodies > 1")
    held = settle(held, "repeat-group")
    mixed = settle(groups.join(held, "name").select("name", "body", "copies", "one.*", "bytes"), "repeat-mixed")
    hot = mixed.where(F.col("bytes") > shard_bytes)
    total = mixed.where(F.col("bytes") <= shard_bytes).agg(F.sum(F.col("windows") + WIDTH - 1)).head()[0] or 0
    found = groups.where("copies > 1").select("name", "body", F.lit(0).cast("long").alias("at"), F.col("one.windows").cast("long").alias("n"))
    if total:
        shards = -(-total // shard_bytes)
        cold = mixed.where(F.col("bytes") <= shard_bytes).withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
        rows = cold.join(texts.select("text_id", "text"), "text_id").mapInArrow(_bytes, "shard long, name long, body binary, copies long, bytes binary")
        found = found.unionByName(rows.groupBy("shard").applyInArrow(_shard, "name long, body binary, at long, n long"))
    if level + 1 < LEVELS and not hot.isEmpty():
        found = found.unionByName(_halved(texts, hot, level + 1, shard_bytes))
    return pieces.join(settle(found.distinct(), "repeat-found"), ["name", "body"]).select("text_id", "start", "at", "n")


def _halved(texts: DataFrame, hot: DataFrame, level: int, shard_bytes: int) -> DataFrame:
    """What ``_found`` says of the stretches of large groups, by halves of their windows."""
    reach = REACH >> level
    middle = F.floor(F.col("back") / (2 * reach)) * (2 * reach) + reach  # fewer bytes to the anchor are the second half
    first = F.greatest(F.lit(0), F.least(F.col("windows"), F.col("back") - middle + 1)).cast("int")
    halves = F.array(
        F.struct(F.col("start"), F.col("first").alias("windows"), F.col("back")),
        F.struct((F.col("start") + F.col("first")).alias("start"), (F.col("windows") - F.col("first")).alias("windows"), (F.col("back") - F.col("first")).cast("int").alias("back")),
    )
    own = hot.withColumn("first", first).select("name", "body", "text_id", F.col("start").alias("base"), "copies", F.explode(halves).alias("half")).select("name", "body", "text_id", "base", "copies", "half.*").where("windows > 0")
    own = settle(own, "repeat-half")
    cuts = own.groupBy("text_id").agg(F.collect_list(F.struct("start", "windows", "back", "copies")).alias("cuts"))
    pieces = settle(texts.select("text_id", "text").join(cuts, "text_id").mapInArrow(_cut(level), _PIECE), "repeat-piece")
    found = _found(texts, pieces, level, shard_bytes)
    back = own.select("name", "body", "text_id", "start", (F.col("start") - F.col("base")).alias("shift"))
    return back.join(found, ["text_id", "start"]).select("name", "body", (F.col("shift") + F.col("at")).alias("at"), "n")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged spans of removed bytes and what is left, for each text with its repeated windows."""
    for batch in batches:
        spans, kept = [], []
        for raw, found in zip(batch.column(1), batch.column(2)):
            raw, merged = raw.as_py(), []
            for low, high in sorted((w["low"], w["low"] + w["n"] + WIDTH - 1) for w in found.as_py()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            spans.append([{"start": low, "stop": high} for low, high in merged])
            edges = [0, *(x for m in merged for x in m), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        yield pa.record_batch([batch.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())], ["text_id", "spans", "kept"])


def repeated_spans(docs: DataFrame, text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(text_id, spans, kept)`` of each text that loses bytes: what is removed (start, stop) and the bytes left."""
    spark = docs.sparkSession
    own = docs.select(text_id(F.col(f"`{text_col}`")).alias("text_id"), F.encode(F.col(f"`{text_col}`"), "UTF-8").alias("text")).where(F.octet_length("text") >= WIDTH)
    stretches = settle(own.mapInArrow(_anchored, _STRETCH), "repeat-stretch")
    # Settled, so that the joins on names stand on plain exchanges, whose large partitions are split.
    shared = settle(stretches.groupBy("name").agg(F.count("*").alias("times")).where("times > 1").select("name"), "repeat-name")
    cuts = stretches.join(shared, "name", "left_semi").groupBy("text_id").agg(F.collect_set(F.struct("start", "windows", "back")).alias("cuts"))
    # Texts and their cuts meet in one aggregation, so copies are combined before they are sent; buckets spare later joins the texts.
    both = own.withColumn("cuts", F.lit(None).cast(cuts.schema["cuts"].dataType)).unionByName(cuts.withColumn("text", F.lit(None).cast("binary")))
    texts = both.groupBy("text_id").agg(F.first("text", ignorenulls=True).alias("text"), F.first("cuts", ignorenulls=True).alias("cuts"), F.count("text").alias("copies")).where("cuts IS NOT NULL")
    name, path = f"repeat_{uuid.uuid4().hex}", shared_path(spark, "repeat-text")
    texts.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "text_id").option("path", path).saveAsTable(name)
    texts = spark.table(name)
    cuts = F.transform("cuts", lambda c: F.struct(c["start"].alias("start"), c["windows"].alias("windows"), c["back"].alias("back"), F.col("copies").alias("copies")))
    pieces = settle(texts.select("text_id", "text", cuts.alias("cuts")).mapInArrow(_cut(0), _PIECE), "repeat-piece")
    windows = _found(texts, pieces, 0, shard_bytes).groupBy("text_id").agg(F.collect_list(F.struct((F.col("start") + F.col("at")).alias("low"), "n")).alias("found"))
    return texts.select("text_id", "text").join(windows, "text_id").mapInArrow(_kept, "text_id binary, spans array<struct<start long, stop long>>, kept binary")
