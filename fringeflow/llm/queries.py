"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringeflow.llm import exact, infill, langid, licenses, media, mixing, packing, periodic, repeats, sharding, simhash, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mix.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    heard = media.media_columns(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    marks = F.concat_ws(",", F.transform(F.col("heard.codes"), lambda c: c.cast("string"))), F.concat_ws(",", F.transform(F.col("heard.hashes"), lambda c: c.cast("string")))
    return heard.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        F.col("heard.payload_bytes").alias("payload_bytes"),
        F.col("heard.payload_sha256").alias("payload_sha256"),
        F.col("heard.tail_crc32").alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2(F.col("media"), 256).alias("media_sha256"),
        F.concat_ws(":", F.col("heard.frames").cast("string"), F.size("heard.codes").cast("string"), F.md5(F.concat_ws(";", *marks))).alias("feature"),
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return placed.select(F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = exact.exact_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return same.select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    told = _table(spark, sf_dir, "documents").select("doc_id", "text", F.when(h % 10 == 0, words).alias("n"), F.floor(h / 10).alias("g"))
    a = (F.col("g") % F.col("n")).cast("int")
    p = (F.floor((F.col("n") - a) / (F.col("g") % 8 + 3)) + 1).cast("int")
    planted = told.select("doc_id", F.when(F.col("n") > 0, periodic.repeated_from(F.col("text"), a, p)).otherwise(F.col("text")).alias("text"))
    found = periodic.periodic_runs(planted, keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = found.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), periodic.strongest(F.col("runs")).alias("best"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("best.length * 1000 div best.period")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    proof = infill.proof(F.col("body"), F.col("plan.pieces"), F.col("plan.form")).alias("proof")
    return cut.select("row.doc_id", "plan", proof).select("doc_id", "plan.n", "plan.form", "plan.prefix_chars", "plan.middle_chars", "proof.output_sha256", "proof.restored_sha256")


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = repeats.repeated_spans(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    lost = cut.select("text_id", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    told = docs.select("doc_id", F.octet_length(body).cast("long").alias("n_bytes"), repeats.text_id(F.col("text")).alias("text_id"), F.sha2(body, 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return told.join(lost, "text_id", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_mixing, op3_media, op4_licenses, op5_warc, op6_sharding, op7_simhash, op8_exact, op9_packing, op10_langid, op11_periodic, op12_infill, op13_repeats)}

ORACLE_SQL = {
    "op2_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  (CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight, source_size * 2.0::DOUBLE AS most FROM s),
l AS (SELECT *, most / weight AS stop,
             (sum(CAST(source_size AS DOUBLE)) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
      FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN source_size > 0 THEN least(most, weight * (SELECT max(level) FROM l WHERE level <= stop)) ELSE 0.0 END AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
q AS (SELECT *, CAST(floor(rate) AS BIGINT) AS whole, rate - floor(rate) AS p, target - floor(rate) * source_size AS lack FROM p),
r AS (SELECT d.doc_id, d.size, q.*, CASE WHEN p > 0 THEN (u / (1 - u)) / (sqrt(sqrt(size + 1.0::DOUBLE)) * (p / (1 - p))) END AS rank FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM r),
e AS (SELECT source, min(struct_pack(off := abs(upto - lack), upto := upto, rank := rank, doc_id := doc_id)) AS best FROM c WHERE p > 0 GROUP BY source)
SELECT c.doc_id, c.size, c.source_size, c.target,
       c.size * (c.whole + CASE WHEN e.best.off < c.lack AND (c.rank, c.doc_id) <= (e.best.rank, e.best.doc_id) THEN 1 ELSE 0 END) AS taken
FROM c LEFT JOIN e ON c.source IS NOT DISTINCT FROM e.source""",
    "op5_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> s) & 31) + 1 AS BIGINT), 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest FROM p),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b JOIN f USING (h)""",
    "op8_exact": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)""",
    "op12_infill": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, list_transform([1, 9, 17, 25], lambda s: CAST('0x' || substr(h, s, 8) AS BIGINT)) AS u FROM d),
f AS (SELECT *, least(u[1] % (n + 1), u[2] % (n + 1)) AS a, greatest(u[1] % (n + 1), u[2] % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR u[3] % 100 >= 90 THEN 'plain' WHEN u[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
             ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS o FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars, sha256(o) AS output_sha256, sha256(t) AS restored_sha256 FROM o""",
}
