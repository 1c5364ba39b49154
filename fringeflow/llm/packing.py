"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``LENGTH`` tokens. Pieces are dealt into
partitions of about ``PART_PIECES`` rows, each packed by best-fit decreasing. Dual
feasible functions give a lower bound on the bins that a partition's pieces need;
a partition that meets it is certified. Partitions with a gap exchange the
documents of their unfilled bins: these are dealt anew and packed again, and the
new packing counts where it needs fewer bins.

Defined results: null text counts as empty, which is the end token alone; only
documents longer than a sequence are cut, and then the first piece is the short
one; repeated rows are packed as often as they come; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.plans.lineage import settle

LENGTH = 1024
END_TOKEN = 2
PART_PIECES = 2048
ROUNDS = 4
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the token that byte_bpe_50k.json adds to its ranks.
ADDED = {"<|endoftext|>": 50256}
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row_id long"
_PACKED = "row_id long, part long, bin int, offset long, length long, fill long, bins int, bound int"
_TWO_BLANKS = re.compile(r"\s\s|\s\Z")


@lru_cache(maxsize=2)
def _encoders(vocabulary: str):
    """The byte-level BPE of ``byte_bpe_50k.json`` from its rank file: the same ids, several times as fast.

    The second encoder lacks the rule for runs of white space (which needs
    look-ahead) and serves texts without such runs. Both know the vocabulary's one
    added token, which is matched before any other rule.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern = public_tokenizers.PATTERN
    plain = pattern.replace(r"\s+(?!\S)|", "")
    return tuple(tiktoken.Encoding(n, pat_str=p, mergeable_ranks=ranks, special_tokens=ADDED) for n, p in (("full", pattern), ("plain", plain)))


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of the whole text, then the end token."""
    full, plain = _encoders(vocabulary)
    if not text:
        ids = []
    elif any(a in text for a in ADDED):
        ids = full.encode(text, allowed_special="all")
    else:
        ids = (full if _TWO_BLANKS.search(text) else plain).encode_ordinary(text)
    return np.array([*ids, END_TOKEN], "<u4")


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: the first takes the remainder, the rest are full."""
    first = n % length or length
    return [(0, min(first, n)), *((s, length) for s in range(first, n, length))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a piece, with a number of its own for every row."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ident, text in zip(batch.column(0), batch.column(1)):
                ids = token_ids(text.as_py(), vocabulary)
                key = ident.as_py()
                rows += [(key, i, s, n, zlib.crc32(ids[s : s + n])) for i, (s, n) in enumerate(cut(len(ids), length))]
            cols = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = own.mapInArrow(tokenise, "doc_id long, piece int, start long, length long, ids_crc32 long")
    return settle(found.withColumn("row_id", F.monotonically_increasing_id()), "piece")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length (longest first), and how full each bin is.

    Bins are kept by free space, with a bit set of the spaces in use: the best fit is the
    lowest bit from the length upwards.
    """
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, fill = 0, []
    bins, offsets = np.empty(len(lengths), np.int32), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fits = used >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = free[space].pop()
            if not free[space]:
                used ^= 1 << space
        else:
            space, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        left = space - n
        if left:
            free[left].append(b)
            used |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


@lru_cache(maxsize=2)
def _dual_feasible(capacity: int) -> np.ndarray:
    """Rows of weights for lengths 0 to capacity under which no bin weighs over 1.

    One family drops lengths below a limit and rounds those above its complement up to a whole
    bin; the other rounds lengths down to multiples of a k-th.
    """
    x = np.arange(capacity + 1)
    rows = [x / capacity]
    for limit in range(1, capacity // 2 + 1):
        rows.append(np.where(x > capacity - limit, 1.0, np.where(x < limit, 0.0, x / capacity)))
    for k in range(1, 101):
        whole = (x * (k + 1)) % capacity == 0
        rows.append(np.where(whole, x / capacity, (x * (k + 1) // capacity) / k))
    return np.array(rows)


def lower_bound(lengths: np.ndarray, capacity: int = LENGTH) -> int:
    """No packing of these lengths needs fewer bins."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)
    return math.ceil((_dual_feasible(capacity) @ counts).max() - 1e-6)


def _pack_parts(dealt: DataFrame, capacity: int) -> DataFrame:
    """Best-fit decreasing of ``dealt(row_id, length, part)`` in each part."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row_id"], ascending=[False, True])
        sizes = rows["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(sizes, capacity)
        return pd.DataFrame({"row_id": rows["row_id"], "part": rows["part"], "bin": bins, "offset": offsets, "length": sizes, "fill": fill[bins], "bins": np.int32(len(fill)), "bound": np.int32(lower_bound(sizes, capacity))})

    return settle(dealt.groupBy("part").applyInPandas(pack, _PACKED), "packed")


def pack(found: DataFrame, capacity: int = LENGTH, rounds: int = ROUNDS, part_pieces: int = PART_PIECES) -> DataFrame:
    """``found`` with ``sequence_id`` and ``offset``."""
    n = found.count()
    deal = lambda df, size, salt: df.select("row_id", "length", F.pmod(F.xxhash64("row_id", F.lit(salt)), F.lit(max(1, -(-size // part_pieces)))).alias("part"))
    now = _pack_parts(deal(found, n, 0), capacity).withColumn("round", F.lit(0))
    final = None
    for k in range(1, rounds + 1):
        loose = F.col("bins").__gt__(F.col("bound")) & (F.col("fill") < capacity)
        pool = now.where(loose)
        size, before = pool.agg(F.count("*"), F.count_distinct("part", "bin")).head()
        if not size:
            break
        again = _pack_parts(deal(pool, size, k), capacity).withColumn("round", F.lit(k))
        after = again.select("part", "bins").distinct().agg(F.sum("bins")).head()[0]
        if after >= before:
            break
        kept = now.where(~loose)
        final = kept if final is None else final.union(kept)
        now = again
    final = now if final is None else final.union(now)
    number = F.col("round") * F.lit(1 << 54) + F.col("part") * F.lit(1 << 20) + F.col("bin")
    return found.join(final.select("row_id", number.alias("sequence_id"), "offset"), "row_id").drop("row_id")


def pack_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for every piece."""
    return pack(pieces(docs, length=length), length).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
