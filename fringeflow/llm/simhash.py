"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints are cut into ``BLOCKS`` blocks. Two fingerprints with at most
``max_bits`` differing bits agree on at least ``BLOCKS - max_bits`` of them, so
a join on every choice of that many blocks finds each close pair; the Hamming
distance is then verified. Six blocks and three bits give 20 keys of about 32
bits, which keeps chance meetings rare up to billions of fingerprints.

Defined results: null text counts as empty; empty text has fingerprint zero,
which links like any other; rows that share a doc_id are one document for the
component and keep their own fingerprints; an empty table gives an empty
result; other columns of the input are ignored. Texts of any length are
streamed through fixed-size chunks of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fringeflow.operators.components import connected_components
from fringeflow.plans.lineage import settle

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 6
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of UTF-8 bytes: A-Z lower-cased, ASCII white space parts words."""
    found = text.lower().split() if text else []
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        shingles: Iterator[bytes] = iter([b" ".join(found)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
        total = len(found) - words + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _CHUNK):
        n = min(_CHUNK, total - at)
        hashes = np.fromiter((digest(next(shingles), seed) for _ in range(n)), np.uint64, n)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


@F.arrow_udf(LongType())
def _simhash(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        values = np.array([fingerprint(x.as_py()) for x in batch], np.uint64)
        yield pa.array(values.view(np.int64))


def simhash(text: Column) -> Column:
    """The fingerprint of a text column as a signed 64-bit number."""
    return _simhash(F.encode(text, "UTF-8"))


def _masks(blocks: int = BLOCKS, agree: int = BLOCKS - MAX_BITS) -> list[int]:
    """Signed 64-bit masks, one for each choice of ``agree`` of ``blocks`` blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    full = [sum(c) for c in combinations(parts, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in full]


def close_pairs(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """``(fp_a, fp_b)`` with ``fp_a < fp_b`` for distinct ``prints(fp)`` at most ``max_bits`` apart.

    A pair that meets under several choices of blocks is reported by the first
    of them only, so no distinct step is needed.
    """
    masks = _masks(blocks, blocks - max_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])
    keyed = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.part")
    a = keyed.select(F.col("fp").alias("fp_a"), "choice", "part")
    b = keyed.select(F.col("fp").alias("fp_b"), "choice", "part")
    apart = F.col("fp_a").bitwiseXOR(F.col("fp_b"))
    earlier = F.lit(False)
    for i, m in enumerate(masks):
        earlier = earlier | ((F.col("a.choice") > i) & (apart.bitwiseAND(F.lit(m)) == 0))
    near = (F.col("fp_a") < F.col("fp_b")) & (F.bit_count(apart) <= max_bits) & ~earlier
    met = a.alias("a").join(b.alias("b"), (F.col("a.choice") == F.col("b.choice")) & (F.col("a.part") == F.col("b.part")) & near)
    return met.select("fp_a", "fp_b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    Rows of one fingerprint are one class from the start (a map-side combined
    aggregation), so copies are never paired with each other.
    """
    rows = settle(docs.select(F.col(id_col).alias("doc_id"), simhash(F.col(text_col)).alias("fp")), "simhash")
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("head")), "simhash-class")
    # Documents may share a doc_id: they are one node, whatever their fingerprints.
    pairs = close_pairs(classes.select("fp"))
    left = pairs.join(classes.select(F.col("fp").alias("fp_a"), F.col("head").alias("u")), "fp_a")
    links = left.join(classes.select(F.col("fp").alias("fp_b"), F.col("head").alias("v")), "fp_b").select("u", "v")
    repeated = rows.groupBy("doc_id").agg(F.min("fp").alias("fp_low"), F.max("fp").alias("fp_high")).where("fp_low <> fp_high").select("doc_id")
    bridges = rows.join(repeated, "doc_id", "left_semi").join(classes, "fp").select(F.col("doc_id").alias("u"), F.col("head").alias("v"))
    found = connected_components(links.union(bridges))
    named = classes.join(found.withColumnRenamed("node", "head"), "head", "left")
    named = named.select("fp", F.coalesce("component", "head").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest doc_id of its component; all columns stay.

    Rows with a null doc_id belong to no document and stay.
    """
    gone = near_duplicates(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
