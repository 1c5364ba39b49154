"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

A source's rate is its target over its size. The whole part of the rate is
taken as certain copies of every document. The rest is a fixed-size sample of
unequal probabilities: documents are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and the lowest ranks are taken until the words they
hold come nearest to what the target still lacks.

The rank is found without sorting a source in one task. Words are counted in
``CELLS`` equal cells of ``u`` (the rank grows with ``u`` within a source), and only
the cell in which a source reaches its target is put in order.

Defined results: null text has size 0; a null source is a source of its own and
comes last; rows that repeat a doc_id with as many words are taken together; a null doc_id counts as one more id; sources without words
have target 0 and give nothing; an empty table gives an empty result; extra
columns stay. ``u`` is a hash of the doc_id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.plans.lineage import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
CELLS = 4096
SEED = "mix"
BROADCAST_SOURCES = 10_000


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(ident: Column, seed: str = SEED) -> Column:
    """A number strictly between 0 and 1 that depends on the identifier and the seed alone."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null")))), 1, 12), 16, 10)
    return (bits.cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``sized(source, size)``.

    Targets share ``share`` of all words by weight and stop at ``most`` times the
    source's size. With sources ordered by the level at which each one stops,
    the common level is the first that the next source can still take.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    w = total.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(most)).withColumn("stop", F.col("most") / F.col("weight"))
    upto = Window.orderBy("stop", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("most").over(upto), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    w = w.withColumn("level", level).withColumn("fits", F.when(F.col("level") <= F.col("stop"), F.col("level")))
    w = w.withColumn("common", F.max("fits").over(every))
    target = F.least(F.col("most"), F.col("weight") * F.coalesce("common", F.lit(float("inf"))))
    return w.select("source", "source_size", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)).alias("target"))


def _plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``whole`` copies, inclusion ``p`` and the last rank ``edge_rank, edge_id`` that the sample takes."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("long")).withColumn("p", F.col("rate") - F.col("whole"))
    plan = plan.withColumn("lack", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = settle(plan, "mix-plan")
    cells = sized.groupBy("source", "cell").agg(F.sum("size").alias("held"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("sum_to", F.sum("held").over(upto))
    at = cells.alias("c").join(plan.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source")) & (F.col("p.p") > 0))
    at = at.where("c.sum_to >= p.lack AND c.sum_to - c.held < p.lack").select("p.source", "c.cell", "p.p", "p.lack", (F.col("c.sum_to") - F.col("c.held")).alias("base"))
    edge = sized.alias("d").join(at.alias("a"), F.col("d.source").eqNullSafe(F.col("a.source")) & (F.col("d.cell") == F.col("a.cell")))
    ranked = edge.select("a.source", "d.doc_id", "d.size", "a.lack", "a.base", rank_of(F.col("d.u"), F.col("d.size"), F.col("a.p")).alias("rank")).groupBy("source", "doc_id", "rank", "lack", "base").agg(F.sum("size").alias("size"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    run = ranked.withColumn("sum_to", F.col("base") + F.sum("size").over(order))
    over = F.when(F.col("sum_to") > F.col("lack"), F.col("sum_to") - F.col("lack")).otherwise(F.col("lack") - F.col("sum_to"))
    best = run.groupBy("source", "lack", "base").agg(F.min_by(F.struct("rank", "doc_id", over.alias("off")), F.struct(over, "sum_to", "rank", "doc_id")).alias("e"))
    # Taking none of the cell may come nearer than taking its first document.
    best = best.where(F.col("e.off") < F.col("lack") - F.col("base")).select("source", F.col("e.rank").alias("edge_rank"), F.col("e.doc_id").alias("edge_id"))
    cut = at.select(F.col("source").alias("s"), "cell")
    plan = plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    best = best.withColumnRenamed("source", "s")
    return settle(plan.join(best, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-plan")


def likelier(size: Column) -> Column:
    """What the inclusion odds of a document of so many words are multiplied by."""
    return F.sqrt(F.sqrt(size + F.lit(1.0)))


def rank_of(u: Column, size: Column, p: Column) -> Column:
    """Random odds over inclusion odds; null where nothing is to be sampled."""
    return F.try_divide(u / (F.lit(1.0) - u), likelier(size) * (p / (F.lit(1.0) - p)))


def _cell(u: Column, size: Column) -> Column:
    """Cells in the order of the rank within a source."""
    odds = u / (F.lit(1.0) - u) / likelier(size)
    return F.floor(odds / (odds + F.lit(1.0)) * CELLS).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as struct ``row`` with ``size, source_size, target, copies, taken`` for every row."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    ident, text, source = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col, source_col))
    u = uniform(ident)
    sized = own.select(ident.alias("doc_id"), source.alias("source"), words(text).alias("size"), u.alias("u"))
    sized = settle(sized.withColumn("cell", _cell(F.col("u"), F.col("size"))), "mix-size")
    plan = _plan(sized, source_targets(sized))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    whole = own.withColumn("size", words(text)).withColumn("u", u).withColumn("u_cell", _cell(F.col("u"), F.col("size")))
    met = whole.join(plan.withColumnRenamed("source", "plan_source"), source.eqNullSafe(F.col("plan_source")))
    rank = rank_of(F.col("u"), F.col("size"), F.col("p"))
    within = (F.col("u_cell") < F.col("cell")) | ((F.col("u_cell") == F.col("cell")) & F.coalesce((rank < F.col("edge_rank")) | ((rank == F.col("edge_rank")) & (ident <= F.col("edge_id"))), F.lit(False)))
    drawn = F.when((F.col("p") > 0) & within, F.lit(1)).otherwise(F.lit(0))
    row = F.struct(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)]).alias("row")
    out = met.select(row, "size", "source_size", "target", (F.col("whole") + drawn).alias("copies"))
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs).where("copies > 0")
    each = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return each.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
