"""Near-equal shards by histogram sort, in DataFrame functions only.

Rows have a total order: 60 bits of their text's digest, then doc_id, then a number
that each row is given when its keys are written. Shard ``s`` takes the rows whose
middle byte falls into the s-th equal part of all bytes. The splitters are found by
counting: each round cuts the open key ranges at ``PROBES`` evenly spaced probes, counts
the exact bytes below each probe over all partitions, and keeps the one range that
holds each boundary. A range is closed once a single row is left in it; where one key
holds several rows the next key parts them. So shards differ from the equal part by
less than one row's bytes at either end. Then every row is dealt once.

Texts are read once: what the rounds and the deal read are the keys, and the
columns that the caller wants back.

Defined results: null text has no bytes; equal texts are neighbours in the
order, and equal rows are parted like any others; a doc_id that is null or no number
orders as the least one; empty shards are possible when rows are fewer than shards;
an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.plans.lineage import settle

SHARDS = 24
ROW_BYTES = 8
PROBES = 256
SUBS = 256
KEYS = ("key1", "key2", "key3")
_TOP = (1 << 60) - 1


def _hex_bits(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def _narrow(rows: DataFrame, level: int, ranges: list[dict]) -> list[dict]:
    """The cell of ``KEYS[level]`` that each boundary of each range falls into, with the bytes below it.

    The driver reads ``PROBES`` counts for each range; ranges are disjoint and at
    most as many as boundaries. A range is a stretch of one key with the keys before it fixed.
    """
    col, fixed = KEYS[level], KEYS[:level]
    table = rows.sparkSession.createDataFrame(
        [(i, r["lo"], r["hi"], r["step"], *r["fixed"]) for i, r in enumerate(ranges)],
        "range int, lo long, hi long, step long" + "".join(f", f_{k} long" for k in fixed),
    )
    inside = F.col(col).between(F.col("lo"), F.col("hi"))
    for k in fixed:
        inside = inside & (F.col(k) == F.col(f"f_{k}"))
    # A stretch over half of all longs is cut in floating point, which keeps the order too.
    wide = F.col("hi").cast("double") - F.col("lo").cast("double") > float(1 << 62)
    cell = F.when(wide, F.floor((F.col(col).cast("double") - F.col("lo").cast("double")) / F.col("step"))).otherwise(F.expr(f"({col} - lo) div step"))
    cells = rows.join(F.broadcast(table), inside).groupBy("range", cell.alias("cell"))
    found = {}
    for r in cells.agg(F.count("*").alias("n"), F.sum("size").alias("held"), F.min(col).alias("low"), F.max(col).alias("high")).collect():
        found.setdefault(r["range"], []).append((r["cell"], r["n"], r["held"], r["low"], r["high"]))
    out = []
    for i, r in enumerate(ranges):
        below = r["base"]
        for _, n, held, low, high in sorted(found.get(i, [])):
            goals = [g for g in r["goals"] if below < g <= below + held]
            if goals:
                out.append({"goals": goals, "base": below, "lo": low, "hi": high, "n": n, "fixed": r["fixed"], "step": _step(low, high)})
            below += held
    return out


def _step(low: int, high: int) -> int:
    return -(-(high - low + 1) // PROBES)


def splitters(rows: DataFrame, shards: int) -> list[tuple[float, list[int], int]]:
    """For each inner boundary its byte, the row it falls into, and the bytes below that row.

    The row is given by as many of its keys as tell it from all others.
    """
    total, low, high = rows.agg(F.sum("size"), *[F.struct(*[f(k).alias(k) for k in KEYS]) for f in (F.min, F.max)]).head()
    if not total:
        return []
    edges, ranges = [], [{"goals": [total * s / shards for s in range(1, shards)], "base": 0, "lo": 0, "hi": _TOP, "fixed": [], "step": _step(0, _TOP)}]
    for level, key in enumerate(KEYS):
        tied = []
        while ranges:
            cut = _narrow(rows, level, ranges)
            edges += [(g, [*r["fixed"], r["lo"]], r["base"]) for r in cut if r["n"] == 1 for g in r["goals"]]
            tied += [r for r in cut if r["n"] > 1 and r["lo"] == r["hi"]]
            ranges = [r for r in cut if r["n"] > 1 and r["lo"] < r["hi"]]
        if level + 1 < len(KEYS):
            lo, hi = low[KEYS[level + 1]], high[KEYS[level + 1]]
            ranges = [r | {"fixed": [*r["fixed"], r["lo"]], "lo": lo, "hi": hi, "step": _step(lo, hi)} for r in tied]
    return sorted(edges)


def _past(edge: tuple[float, list[int], int]) -> Column:
    """Whether a row lies past the boundary: beyond the row on it, or that row with its middle byte past it."""
    goal, keys, base = edge
    past = F.lit(base) + F.col("size") / 2 >= F.lit(goal)
    for k, v in reversed(list(zip(KEYS, keys))):
        past = (F.col(k) > v) | ((F.col(k) == v) & past)
    return past


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as struct ``row`` with ``size, text_crc32, shard, slot`` for every row.

    ``keep`` names the columns of ``row``, all by default.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.toDF(*names.values())
    ident, text = (F.col(names[c]) for c in (id_col, text_col))
    body = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    kept = docs.columns if keep is None else keep
    row = F.struct(*[F.col(names[c]).alias(c) for c in kept]).alias("row")
    keys = [_hex_bits(F.md5(body), 15), F.coalesce(ident.try_cast("long"), F.lit(-1)), F.monotonically_increasing_id()]
    found = own.select(row, (F.octet_length(body).cast("long") + ROW_BYTES).alias("size"), F.crc32(body).alias("text_crc32"), *[k.alias(n) for k, n in zip(keys, KEYS)])
    rows = settle(found, "shard-key")
    past = F.lit(0)
    for edge in splitters(rows, shards):
        past = past + _past(edge).cast("int")
    placed = rows.withColumn("shard", past).withColumn("sub", F.pmod(F.xxhash64("key3"), F.lit(SUBS)).cast("int"))
    heads = placed.groupBy("shard", "sub").agg(F.count("*").alias("n"))  # SUBS rows a shard at most
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    heads = settle(heads.withColumn("head", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "shard-head")
    order = Window.partitionBy("shard", "sub").orderBy(*KEYS)
    ranked = placed.withColumn("in_sub", F.row_number().over(order) - 1).join(F.broadcast(heads), ["shard", "sub"])
    return ranked.select("row", "size", "text_crc32", "shard", (F.col("head") + F.col("in_sub")).cast("long").alias("slot"))
