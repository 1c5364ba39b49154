"""The pipeline against its stages done by hand, and the registered queries."""

import pytest

import __spark_entry__
import corpus_pipeline

DATA = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA).cache()
        assert out.columns == docs.columns
        seen.append(out.count())
        if name != "mixing":
            assert out.count() <= docs.count() and out.exceptAll(docs).count() == 0
        docs = out
    assert seen[0] >= seen[1] >= seen[2] > 0
    packed = corpus_pipeline.run(spark, DATA)
    assert packed.groupBy("doc_id").count().count() == docs.select("doc_id").distinct().count()


def _write(spark, folder, rows, labels):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, size long, sha string, sub_run int, row string"
    spark.createDataFrame([(i, t, None, s, None, 7, "h", 3, "r") for i, t, s in rows], kinds).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, x) for i, x in labels], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return f"{folder}"


def test_awkward_rows(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi".split()
    rows = [(i, " ".join(words[(i * k + k * k) % 16] for k in range(3, 30 + i)), ["a", "b", None][i % 3]) for i in range(40)]
    odd = [(100, None, "a"), (101, "", None), (102, " \t ", "b"), (None, "no number of its own at all", "a"), (None, None, None), (103, "x " * 20_000, "b")]
    rows += odd + rows[:5] + [(200, rows[7][1].replace(" ", "  \n"), "b")]
    d = _write(spark, f"file://{tmp_path}/odd", rows, [(i, 0) for i in range(30)] + [(None, 1)])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    norm = lambda t: " ".join((t or "").split()) if (t or "").strip() else ("" if not t else " ")
    texts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "sha", "sub_run", "row"]
        kept = docs.collect()
        texts.append([(r.doc_id, r.text) for r in kept])
        assert all((r.size, r.sha, r.sub_run, r.row) == (7, "h", 3, "r") for r in kept)
    assert len(texts[0]) == len(rows)  # no toxic document was learned, so none goes
    assert {norm(t) for _, t in texts[1]} == {norm(t) for _, t, _ in rows} and len(texts[1]) == len({norm(t) for _, t, _ in rows})
    assert 200 not in [i for i, _ in texts[1]] and set(texts[2]) <= set(texts[1]) and set(texts[3]) <= set(texts[2])
    packed = corpus_pipeline.run(spark, d).collect()
    copies = lambda found: sorted(str(x) for x in found)
    assert copies(r.doc_id for r in packed if r.piece == 0) == copies(i for i, _ in texts[3])


def test_empty_tables(spark, tmp_path):
    d = _write(spark, f"file://{tmp_path}/none", [], [])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, d).count() == 0
    assert corpus_pipeline.run(spark, d).count() == 0


@pytest.mark.parametrize("name", sorted(__import__("fringeflow.llm.queries", fromlist=["x"]).ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()[name]).df()
    got = __spark_entry__.queries()[name](spark, DATA).toPandas()[list(want.columns)]
    key = [c for c in ("doc_id", "page_id") if c in want.columns]
    a, b = (x.sort_values(key, ignore_index=True).astype(object) for x in (got, want))
    assert (a.where(a.notna(), None) == b.where(b.notna(), None)).where(~(a.isna() & b.isna()), True).all().all()
