"""Text sources: parameter files, acquisition manifests and pair lists.

Each reader takes files through ``spark.read.text`` and keeps the parsing in column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Marks that begin a comment, and the form of a date in a name.
COMMENTS = "#%;"
DATE = r"(?<!\d)((?:19|20)\d{6})(?!\d)"


def acquisition_date(path: Column) -> Column:
    """The last date in the file name, else the last in the whole path; null if there is none."""
    in_name = F.regexp_extract_all(F.element_at(F.split(path, "/"), -1), F.lit(DATE), F.lit(1))
    in_path = F.regexp_extract_all(path, F.lit(DATE), F.lit(1))
    found = F.when(F.size(in_name) > 0, F.element_at(in_name, -1)).when(F.size(in_path) > 0, F.element_at(in_path, -1))
    return F.to_date(found, "yyyyMMdd")


def parameters(spark: SparkSession, path: str) -> DataFrame:
    """``file, params``: a map of key to tokens for each parameter file; of repeated keys the last line counts."""
    lines = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    lines = lines.withColumn("line", F.trim("line")).where((F.col("line") != "") & ~F.col("line").rlike(f"^[{COMMENTS}]"))
    marked = F.instr("line", ":") > 0
    key = F.trim(F.when(marked, F.substring_index("line", ":", 1)).otherwise(F.element_at(F.split("line", r"\s+"), 1)))
    rest = F.trim(F.when(marked, F.regexp_replace("line", r"^[^:]*:", "")).otherwise(F.regexp_replace("line", r"^\S+\s*", "")))
    pairs = lines.select("file", "at", key.alias("key"), F.filter(F.split(rest, r"\s+"), lambda t: t != "").alias("tokens"), marked.alias("marked"))
    pairs = pairs.where(F.col("marked") | (F.size("tokens") > 0))
    last = pairs.groupBy("file", "key").agg(F.max_by("tokens", "at").alias("tokens"))
    return last.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("key", "tokens"))).alias("params"))


def first_number(params: Column, keys: list[str]) -> Column:
    """The first token of the first key that reads as a number."""
    return F.coalesce(*[F.get(F.filter(F.transform(F.try_element_at(params, F.lit(k)), lambda t: t.try_cast("double")), lambda x: x.isNotNull()), F.lit(0)) for k in keys])


def first_positive_int(params: Column, keys: list[str]) -> Column:
    value = F.rint(first_number(params, keys)).cast("int")
    return F.when(value > 0, value)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``idx, date, raster, par`` in the order of the file's lines; comments run to the end of a line.

    Dates must be there and differ.
    """
    lines = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    bare = lines.withColumn("line", F.trim(F.regexp_replace("line", f"[{COMMENTS}].*$", ""))).where("line <> ''")
    fields = F.split("line", r"\s+")
    rows = bare.select("line_no", fields.alias("f"))
    rows = rows.select("line_no", F.get("f", F.lit(0)).alias("raster"), F.get("f", F.lit(1)).alias("par")).withColumn("date", acquisition_date(F.col("raster")))
    bad = rows.agg(F.count_if(F.col("par").isNull()).alias("short"), F.count_if(F.col("date").isNull()).alias("undated"), (F.count("date") - F.count_distinct("date")).alias("twice"), F.count("*").alias("n")).head()
    if not bad["n"] or bad["short"] or bad["undated"] or bad["twice"]:
        raise ValueError(f"manifest {path}: {bad['n']} lines, {bad['short']} without a second column, {bad['undated']} without a date, {bad['twice']} repeated dates")
    return rows.withColumn("idx", F.row_number().over(Window.orderBy("line_no")) - 1).select("idx", "date", "raster", "par")  # one row an acquisition


def pair_list(spark: SparkSession, path: str, epochs: int) -> DataFrame:
    """``edge_id, i, j`` from lines ``i j k 1`` that count from one; those out of range are an error."""
    lines = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.split("value", r"\r?\n")).alias("edge_id", "line")).where("trim(line) <> ''")
    f = F.split(F.trim("line"), r"\s+")
    rows = lines.select("edge_id", (F.get(f, F.lit(0)).cast("int") - 1).alias("i"), (F.get(f, F.lit(1)).cast("int") - 1).alias("j"))
    if rows.where(~(F.col("i").between(0, epochs - 1) & F.col("j").between(0, epochs - 1) & (F.col("i") != F.col("j")))).head():
        raise ValueError(f"pair list {path} names epochs outside 1 to {epochs}")
    return rows


def write_pair_list(edges: DataFrame, path: str) -> None:
    """One text file of lines ``i j k 1`` that count from one, sorted; a line an edge of the epoch network."""
    order = Window.orderBy("i", "j")
    lines = edges.withColumn("k", F.row_number().over(order)).select(F.format_string("%d %d %d 1", F.col("i") + 1, F.col("j") + 1, "k").alias("value"), "k")
    lines.coalesce(1).sortWithinPartitions("k").select("value").write.text(path)


def baselines(spark: SparkSession, path: str) -> DataFrame:
    """``idx, bperp``: the median of each epoch's sampled baselines from lines ``idx value``."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(F.get(f, F.lit(0)).try_cast("int").alias("idx"), F.get(f, F.lit(1)).try_cast("double").alias("b"))
    return rows.where("idx IS NOT NULL AND b IS NOT NULL").groupBy("idx").agg(F.median("b").alias("bperp"))
