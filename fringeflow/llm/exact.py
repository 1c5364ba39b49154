"""Exact duplicates by a content sort, in DataFrame functions only.

Texts are equal when they are identical after each run of ASCII white space is
replaced by one space. Rows are dealt by sampled splitters over the first characters of the
normalised content; a few bits of its hash part texts that begin alike. Spark's external sort then orders
each stretch by the whole normalised content, so equal texts are neighbours, and each row is
compared in full with the one before it. The first row of a run of equal texts is the smallest doc_id.

A text that holds more than ``1 / HOT_TEXTS`` of all bytes, and more than ``HOT_ROWS`` rows of mean size,
would fill one task. Such texts are found on a sample of about ``SAMPLE_ROWS`` rows (it decides where rows
go, never what is equal); they are at most ``HOT_TEXTS``, a list of proven size. Their rows are sorted and
compared in sub-runs, and then the first rows of the sub-runs are sorted and compared in
full with each other.

Defined results: null text counts as empty; rows that repeat a doc_id are ranked
by it and exactly one row of the group stays; a null doc_id ranks last and keeps
only if its whole group has none; an empty table gives an empty result; extra
columns are carried along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.plans.lineage import settle

HOT_ROWS = 256
HOT_TEXTS = 8192
SAMPLE_ROWS = 1 << 20
HEAD_CHARS = 32
PARTS = 1 << 16
ROW_BYTES = 64
_BLANK = r"[\x20\x09-\x0D]+"
_PLACE = ["head", "part", "sub_run"]


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BLANK, " ")


def _hot(own: DataFrame, ident: Column, norm: Column) -> DataFrame:
    """``(mark, sub_runs)`` of the texts that hold a large share of all bytes, at most ``HOT_TEXTS`` rows."""
    rows = own.count()
    every = max(1, rows // SAMPLE_ROWS)
    drawn = own if every == 1 else own.where(F.pmod(F.xxhash64(ident), F.lit(every)) == 0)
    weights = drawn.select(F.xxhash64(norm).alias("mark"), (F.octet_length(norm) + ROW_BYTES).alias("weight")).groupBy("mark").agg(F.sum("weight").alias("weight"))
    weights = settle(weights, "text-weight")
    least = (weights.agg(F.sum("weight")).head()[0] or 0) * max(1 / HOT_TEXTS, HOT_ROWS / max(rows, 1))
    return settle(weights.where(F.col("weight") > least).select("mark", F.ceil(2 * F.col("weight") / F.lit(least or 1.0)).alias("sub_runs")), "hot-text")


def _runs(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> tuple[DataFrame, bool]:
    """Rows with the place and number of their run of equal texts, their rank in it and its first doc_id; whether there are sub-runs."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no name of the input can clash
    own = docs.toDF(*names.values())
    ident, norm = F.col(names[id_col]), normalised(F.col(names[text_col]))
    hot = _hot(own, ident, norm)
    others = [F.col(c) for c in names.values() if c != names[text_col]]
    # The place of a row in the input parts rows of a hot text that are equal in all columns.
    keyed = own.withColumn("place", F.monotonically_increasing_id()).withColumn("head", F.substring(norm, 1, HEAD_CHARS)).withColumn("mark", F.xxhash64(norm)).join(F.broadcast(hot), "mark", "left")
    keyed = keyed.withColumn("sub_run", F.when(F.col("sub_runs").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(*others, "place"), F.col("sub_runs"))))
    dealt = keyed.withColumn("part", F.pmod("mark", F.lit(PARTS))).drop("mark", "sub_runs", "place").repartitionByRange(*_PLACE)
    order = Window.partitionBy(*_PLACE).orderBy("norm", ident.asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = dealt.withColumn("norm", norm).withColumn("at", F.row_number().over(order)).withColumn("before", F.lag("norm").over(order))
    # What starts a run, told to all its rows; the struct keeps a null doc_id from being passed over.
    start = F.when(~F.col("norm").eqNullSafe(F.col("before")), F.struct(F.col("at").alias("run"), ident.alias("low")))
    near = near.withColumn("start", F.last(start, ignorenulls=True).over(upto))
    rank = F.col("at") - F.col("start.run") + 1
    row = F.struct(*[F.col(names[c]).alias(c) for c in keep]).alias("row")
    return near.select(row, *_PLACE, F.col("start.run").alias("run"), F.col("start.low").alias("low"), rank.alias("rank"), "norm"), not hot.isEmpty()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as struct ``row`` with ``keep_id, group_size, kept, text_sha256`` for every row; ``keep`` names the columns of ``row``."""
    runs, hot = _runs(docs, id_col, text_col, docs.columns if keep is None else keep)
    first = F.when((F.col("rank") == 1) & (F.col("sub_run") >= 0), F.col("norm")).alias("norm")
    light = runs.select("row", *_PLACE, "run", "low", "rank", first, F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"))
    sized = light.withColumn("size", F.count("*").over(Window.partitionBy(*_PLACE, "run")))
    if not hot:
        return sized.select("row", F.col("low").alias("keep_id"), F.col("size").alias("group_size"), (F.col("rank") == 1).alias("kept"), "text_sha256")
    sized = settle(sized, "exact-run")
    met = sized.join(F.broadcast(_tied(sized)), [*_PLACE, "run"], "left")
    return met.select(
        "row",
        F.when(F.col("total").isNull(), F.col("low")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("total", "size").alias("group_size"),
        ((F.col("rank") == 1) & F.coalesce("stays", F.lit(True))).alias("kept"),
        "text_sha256",
    )


def _tied(sized: DataFrame) -> DataFrame:
    """``(place, run, keep_id, total, stays)`` of the sub-runs, one row each: those of one text are tied by comparing their first rows in full."""
    heads = sized.where("sub_run >= 0 AND rank = 1").select(*_PLACE, "run", "low", "size", "norm")
    order = Window.partitionBy("head", "part").orderBy("norm", F.col("low").asc_nulls_last(), "sub_run")
    near = heads.withColumn("new", (~F.col("norm").eqNullSafe(F.lag("norm").over(order))).cast("int")).withColumn("text_no", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    same = Window.partitionBy("head", "part", "text_no")
    return near.select(*_PLACE, "run", F.min("low").over(same).alias("keep_id"), F.sum("size").over(same).alias("total"), (F.col("new") == 1).alias("stays"))


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    runs, hot = _runs(docs, "doc_id", "text", docs.columns)
    firsts = runs.where("rank = 1")
    if hot:
        firsts = settle(firsts.select("row", *_PLACE, "run", "low", "rank", F.lit(1).alias("size"), F.when(F.col("sub_run") >= 0, F.col("norm")).alias("norm")), "exact-first")
        firsts = firsts.join(F.broadcast(_tied(firsts)), [*_PLACE, "run"], "left").where(F.coalesce("stays", F.lit(True)))
    return firsts.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
