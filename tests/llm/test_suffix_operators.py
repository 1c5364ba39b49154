"""Runs, fill-in-middle and repeated strings against brute force, on awkward rows too."""

import hashlib
import json
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fringeflow.llm import infill, periodic, queries, repeats
from fringeflow.llm.suffixes import permuted_lcp, suffix_ranks

COLUMNS = "doc_id long, text string, lang string, plan string, runs string, spans string, row string, cuts int, found int, name string, body string"


def _rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=160))
    texts = [None, "", " \t\n ", "x", "<P> inside", "é ü 漢字 🙂 " * 9, "again " * 400, "ab" * 700, "one two three " * 300, " ".join(rng.choices(vocabulary, k=25_000))]
    for i in range(40):
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(0, 250))))
        if i % 3 == 0:
            texts.append(f"{' '.join(rng.choices(vocabulary, k=i))} {passage} {' '.join(rng.choices(vocabulary, k=40))}")
    rows = [(i, t, "en", "p", "r", "s", "row", 3, 4, "n", "b") for i, t in enumerate(texts)]
    return rows + rows[8:12] + rows[20:24] + [(None, texts[15], None, None, None, None, None, None, None, None, None)] * 2


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, COLUMNS).repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], COLUMNS).write.parquet(f"{path}/documents.parquet")
    return path


def _sha(raw):
    return hashlib.sha256(raw).hexdigest()


def _answers(got):
    """Values of each row by its doc_id; rows that repeat one are kept apart."""
    return Counter((r["doc_id"], json.dumps(r.asDict(), sort_keys=True)) for r in got)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 12))
def test_induced_sorting_and_prefixes(values, times):
    raw = (values * times)[:200] + [0]
    s = np.unique(raw, return_inverse=True)[1]
    order = sorted(range(len(raw)), key=lambda i: raw[i:])
    sa, shared = permuted_lcp(s, suffix_ranks(s))
    assert sa.tolist() == order
    for a, b in zip(order, order[1:]):
        n = 0
        while raw[a + n] == raw[b + n]:
            n += 1
        assert shared[b] == n
    assert shared[order[0]] == 0


def _runs(words):
    """Every period by comparing words that far apart; a stretch counts for its smallest period only."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        at = 0
        while at + p < len(words):
            end = at
            while end + p < len(words) and words[end] == words[end + p]:
                end += 1
            if end + p - at >= max(6, 4 * p):
                found.setdefault((at, end + p), p)
            at = end + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 9)), min_size=1, max_size=4))
def test_runs_of_several_texts(parts):
    texts = [[b"%d" % v for v in (values * times)[:120]] for values, times in parts]
    assert [sorted(r) for r in periodic.runs_of(texts)] == [_runs(t) for t in texts]


def test_a_batch_may_end_where_a_chunk_does(spark):
    assert periodic.runs_of([]) == []
    docs = spark.createDataFrame([(1, "a b"), (2, "one two " * (periodic.CHUNK // 2))], "doc_id long, text string").coalesce(1)
    found = {r["row"].doc_id: ([tuple(x) for x in r["runs"]], bytes(r["collapsed"])) for r in periodic.periodic_runs(docs, keep=["doc_id"]).collect()}
    assert found == {1: ([], b"a b"), 2: ([(0, periodic.CHUNK, 2)], b"one two")}


def _planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_op11_against_brute_force(spark, folder, rows):
    want = []
    for doc_id, text, *_ in rows:
        words = _planted(doc_id, text)
        runs = _runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        told = {"doc_id": doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2], "exponent_milli": 1000 * best[1] // best[2] if runs else None}
        told |= {"runs_sha256": _sha("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()), "collapsed_sha256": _sha(b" ".join(w for i, w in enumerate(words) if i not in gone))}
        want.append((doc_id, json.dumps(told, sort_keys=True)))
    got = queries.op11_periodic(spark, folder)
    assert _answers(got.collect()) == Counter(want)
    assert sum(json.loads(w)["n_runs"] > 0 for _, w in want) > 5


def test_runs_keep_columns_and_real_outputs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = periodic.periodic_runs(docs)
    row = found.where("row.text = concat(repeat('one two three ', 299), 'one two three ')").head()
    assert row["row"].asDict().keys() == set(docs.columns)
    assert bytes(row["collapsed"]) == b"one two three" and [tuple(r) for r in row["runs"]] == [(0, 900, 3)]


def _cut(doc_id, text):
    text = text or ""
    u = [int(_sha(f"1:{'' if doc_id is None else doc_id}".encode())[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((u[0] % (n + 1), u[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or u[2] % 100 >= 90:
        return "plain", text, None, None
    if u[3] % 100 < 20:
        return "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", a, b - a
    return "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", a, b - a


def test_op12_against_brute_force(spark, folder, rows):
    want = []
    for doc_id, text, *_ in rows:
        form, out, a, b = _cut(doc_id, text)
        told = {"doc_id": doc_id, "n": len(text or ""), "form": form, "prefix_chars": a, "middle_chars": b, "output_sha256": _sha(out.encode()), "restored_sha256": _sha((text or "").encode())}
        want.append((doc_id, json.dumps(told, sort_keys=True)))
    assert _answers(queries.op12_infill(spark, folder).collect()) == Counter(want)


def test_infill_outputs_are_texts_and_come_back(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cut = infill.fill_in_middle(docs).withColumn("output", infill.spell(F.col("body"), F.col("plan.pieces")))
    back = cut.withColumn("back", infill.spell(F.col("output"), infill.restoring(F.col("output"), F.col("plan.form"))))
    got = back.select("row.doc_id", "row.text", F.decode("output", "UTF-8").alias("output"), F.decode("back", "UTF-8").alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["output"] == _cut(r["doc_id"], r["text"])[1] and r["back"] == (r["text"] or "")


@settings(max_examples=200, deadline=None)
@given(st.text("<PSM>é🙂a", max_size=40), st.tuples(st.integers(0, 99), st.integers(0, 99), st.integers(0, 89), st.integers(0, 99)))
def test_any_cut_is_restored(text, draws):
    raw = text.encode()
    told = infill.plan(raw, draws)
    output = b"".join(infill.spelled(memoryview(raw), told["pieces"]))
    assert b"".join(infill.spelled(memoryview(output), infill.undo(output, told["form"]))) == raw


def _removed(rows, width=repeats.WIDTH):
    texts = [(t or "").encode() for _, t, *_ in rows]
    times = Counter(b[k : k + width] for b in texts for k in range(len(b) - width + 1))
    out = []
    for (doc_id, *_), b in zip(rows, texts):
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if times[b[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        spans = sum(1 for k, v in enumerate(gone) if v and not (k and gone[k - 1]))
        told = {"doc_id": doc_id, "n_bytes": len(b), "n_removed": sum(gone), "n_spans": spans, "kept_sha256": _sha(bytes(v for v, g in zip(b, gone) if not g))}
        out.append((doc_id, json.dumps(told, sort_keys=True)))
    return Counter(out)


def test_op13_against_brute_force(spark, folder, rows):
    assert _answers(queries.op13_repeats(spark, folder).collect()) == _removed(rows)


def test_passages_count_by_bytes_not_by_words(spark, tmp_path):
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(70))[:n]
    passages = [words(399), words(400), "é" + words(398)]  # 399, 400 and 400 bytes, each in two documents
    assert all(len(p.split()) > 50 for p in passages)
    rows = [(i, t) for i, t in enumerate(t for p in passages for t in (f"one\t{p}\tone", f"two {p}\ntwo"))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_repeats(spark, str(tmp_path)).collect()
    assert _answers(got) == _removed(rows)
    assert [(r["n_bytes"], r["n_removed"]) for r in sorted(got)] == [(407, 0)] * 2 + [(408, 400)] * 4


def test_large_groups_are_split_with_the_same_result(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    told = lambda df: {bytes(r["text_id"]): ([tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in df.collect()}
    assert told(repeats.repeated_spans(docs, shard_bytes=1500)) == told(repeats.repeated_spans(docs))


def test_long_texts_are_cut_into_blocks(monkeypatch):
    rng = random.Random(2)
    raw = bytes(rng.choices(b"abcdefgh ", k=5000))
    import pyarrow as pa

    whole = pa.record_batch([pa.array([b"i"]), pa.array([raw])], ["text_id", "body"])
    names = lambda: [(s + k, n) for b in repeats._anchored(iter([whole])) for s, w, n in zip(*(b.column(i).to_pylist() for i in (1, 2, 4))) for k in range(w)]
    want = names()
    monkeypatch.setattr(repeats, "BLOCK", 700)
    assert sorted(names()) == sorted(want) and len(want) == len(raw) - repeats.WIDTH + 1


def test_empty_tables(spark, nothing):
    for f in (queries.op11_periodic, queries.op12_infill, queries.op13_repeats):
        assert f(spark, nothing).count() == 0
