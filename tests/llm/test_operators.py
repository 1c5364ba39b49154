"""Each operator against a brute-force version, on rows that hold the awkward cases too."""

import base64
import hashlib
import io
import math
import random
import tracemalloc
import wave
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fringeflow.llm import exact, langid, licenses, media, mixing, packing, sharding, simhash, toxicity, warc

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, rank int, sha string, fp long, cell int, keep_id long, shard string, row string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon".split()


def _rows():
    rng = random.Random(5)
    texts = [None, "", " \t\n ", "x", "Same text  here", "Same\ttext here", "same text here", "é ü 漢字 🙂", " ".join(rng.choices(WORDS, k=30_000)), "w" * 5000]
    for _ in range(60):
        texts.append(" ".join(rng.choices(WORDS, k=rng.randint(1, 300))))
    base = rng.choices(WORDS, k=400)
    for i in range(8):
        near = list(base)
        near[i * 11] = "changed"
        texts.append(" ".join(near))
    texts += ["a copy that many rows share"] * 30
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "b", "a", "", "z"][i % 5], 1, -1, 7, "s", 9, 3, 4, "h", "r") for i, t in enumerate(texts)]
    return rows + rows[4:6] + rows[10:12]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def _norm(text):
    out, blank = [], False
    for ch in text or "":
        if ch in " \t\n\x0b\x0c\r":
            if not blank:
                out.append(" ")
            blank = True
        else:
            out.append(ch)
            blank = False
    return "".join(out)


def _words(text):
    return [w for w in _norm(text).split(" ") if w]


@pytest.mark.parametrize("hot", [False, True])
def test_exact(docs, rows, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(exact, "HOT_ROWS", 3)
    got = exact.exact_duplicates(docs).select("row.doc_id", "row.size", "keep_id", "group_size", "kept", "text_sha256").collect()
    groups = {}
    for r in rows:
        groups.setdefault(_norm(r[1]), []).append(r[0])
    want = sorted((r[0], -1, min(groups[_norm(r[1])]), len(groups[_norm(r[1])]), hashlib.sha256(_norm(r[1]).encode()).hexdigest()) for r in rows)
    assert sorted((g[0], g[1], g[2], g[3], g[5]) for g in got) == want
    assert sorted(g.doc_id for g in got if g.kept) == sorted(min(g) for g in groups.values())
    assert exact.drop_exact(docs).columns == docs.columns
    assert exact.drop_exact(docs).count() == len(groups)


def test_simhash(docs, rows):
    def brute(text):
        w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in _words(text)]
        if not w:
            return 0
        s = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    prints = sorted((r[0], brute(r[1])) for r in rows)
    parent = {i: i for i, _ in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(prints, 2):
        if (a ^ b).bit_count() <= 3 and root(i) != root(j):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    assert got == [(i, f, root(i)) for i, f in prints]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {root(i) for i, _ in prints}


def test_close_pairs_find_all(spark):
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(8)}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    got = {(r.fp_a, r.fp_b) for r in simhash.close_pairs(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert got == want and len(want) > 100


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(random.Random(2).choices(WORDS, k=5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text) == whole


def test_mixing(docs, rows):
    got = mixing.mix(docs).select("row.doc_id", "row.rank", "row.source", "size", "source_size", "target", "copies", "taken").collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(_words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_, left = open_ - full, left - sum(2 * sizes[s] for s in full)
    assert len(got) == len(rows)
    taken = {}
    for g in got:
        assert g.size * g.copies == g.taken <= 2 * g.size and g["rank"] == 7
        assert g.source_size == sizes[g.source] and math.isclose(g.target, target[g.source], rel_tol=1e-9)
        taken[g.source] = taken.get(g.source, 0) + g.taken
    for s in order:
        biggest = max(len(_words(r[1])) for r in rows if r[3] == s)
        assert abs(taken[s] - target[s]) <= 2 * biggest
    again = mixing.mix(docs.repartition(3)).select("row.doc_id", "taken").collect()
    assert sorted(map(tuple, again)) == sorted((g.doc_id, g.taken) for g in got)
    assert mixing.mixed(docs).count() == sum(g.copies for g in got) and mixing.mixed(docs).columns == docs.columns


def test_mixing_odds_grow_with_words(spark):
    docs = spark.createDataFrame([(i, "w " * (1 if i % 2 else 200), "a") for i in range(4000)], "doc_id long, text string, source string")
    got = mixing.mix(docs).where("copies > 1").groupBy((F.col("size") > 1).alias("long")).count().collect()
    more = {r.long: r["count"] for r in got}
    assert more[True] > 1.3 * more[False]


def test_inclusion_is_pareto():
    """Ranks of random odds over inclusion odds draw every document about as often as its share says."""
    rng = np.random.default_rng(0)
    p = np.linspace(0.1, 0.9, 50)
    hits = np.zeros(50)
    for _ in range(4000):
        u = rng.random(50)
        hits[np.argsort(u / (1 - u) / (p / (1 - p)))[:25]] += 1
    assert np.abs(hits / 4000 - p).max() < 0.04


@pytest.mark.parametrize("shards", [1, 5, 24, 200])
def test_sharding(docs, rows, shards):
    got = sharding.shard(docs, shards).select("row.doc_id", "row.shard", "size", "text_crc32", "shard", "slot").toDF("doc_id", "own", "size", "crc", "shard", "slot").collect()
    body = lambda r: (r[1] or "").encode()
    keyed = sorted((int(hashlib.md5(body(r)).hexdigest()[:15], 16), r[0], len(body(r)) + 8, zlib.crc32(body(r))) for r in rows)
    total, below, want = sum(k[2] for k in keyed), 0, []
    for k in keyed:
        want.append((k[1], k[2], k[3], sum(below + k[2] / 2 >= total * s / shards for s in range(1, shards))))
        below += k[2]
    assert sorted((g.doc_id, g.size, g.crc, g.shard) for g in got) == sorted(want)
    for s in {g.shard for g in got}:
        assert sorted(g.slot for g in got if g.shard == s) == list(range(sum(g.shard == s for g in got)))


def test_sharding_parts_equal_rows(spark):
    ids = [None] * 60 + [7] * 60 + [-1] * 60 + [-(1 << 63)] * 60 + [(1 << 63) - 1] * 60
    docs = spark.createDataFrame([(i, "same text") for i in ids], "doc_id long, text string")
    got = sharding.shard(docs, 24, keep=["doc_id"]).collect()
    counts = np.bincount([g.shard for g in got], minlength=24)
    assert counts.min() >= 12 and counts.max() <= 13
    assert all(sorted(g.slot for g in got if g.shard == s) == list(range(counts[s])) for s in range(24))
    alike = spark.createDataFrame([(5, "x")] * 240, "doc_id long, text string")
    assert set(np.bincount([g.shard for g in sharding.shard(alike, 24).collect()])) == {10}


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    import public_tokenizers

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(docs).collect()
    bins = {}
    for g in got:
        bins.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 1024
    for ident, text in {(r[0], r[1]) for r in rows}:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted({(g.piece, g.start, g.length, g.ids_crc32) for g in got if g.doc_id == ident})
        assert [p[0] for p in own] == list(range(len(own))) and sum(p[2] for p in own) == len(ids)
        at = 0
        for _, start, n, crc in own:
            assert start == at and crc == zlib.crc32(ids[start : start + n].tobytes())
            at += n
        if len(ids) > 1024:
            assert [p[2] for p in own[1:]] == [1024] * (len(own) - 1)
    assert len(bins) <= packing.lower_bound(np.array([g.length for g in got])) + 2


def test_token_ids_with_runs_of_blanks():
    from tokenizers import Tokenizer

    import public_tokenizers

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a  b", "a\n\n b\t\tc", " x ", "x\n", "x \n", "  a", "don't we'll 12ab", "漢字 é  ü", "a 　b"):
        assert packing.token_ids(text).tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2]


def test_token_ids_of_random_text():
    from tokenizers import Tokenizer

    import public_tokenizers

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(0)
    parts = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "\u200b", "'s", "'S", "'ll", "abc", "The", "é", "ß", "漢", "🙂", "१", "²", "½", "_", "...", "12", "<|endoftext|>", "<|endoftext", "|>", "\0"]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.6 else chr(rng.choice([rng.randrange(128), rng.randrange(0x3000), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randint(0, 24))) for _ in range(10_000)]
    for text, want in zip(texts, plain.encode_batch(texts, add_special_tokens=False)):
        assert packing.token_ids(text).tolist() == [*want.ids, 2], text
    assert packing.token_ids("<|endoftext|>").tolist() == [50256, 2]


def test_dual_feasible_bounds():
    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes = np.sort(rng.integers(1, 101, rng.integers(1, 9)))[::-1]
        best = len(sizes)

        def fit(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(sizes):
                best = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + sizes[k] <= 100:
                    fit(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1 :]])
            fit(k + 1, [*bins, sizes[k]])

        fit(0, [])
        assert packing.lower_bound(sizes, 100) <= best <= len(packing.best_fit_decreasing(sizes, 100)[2])


def test_repacking_lowers_bins(spark):
    rng = np.random.default_rng(4)
    found = spark.createDataFrame([(i, 0, 0, int(n), 0, i) for i, n in enumerate(rng.integers(200, 700, 400))], "doc_id long, piece int, start long, length long, ids_crc32 long, row_id long")
    once = packing.pack(found, rounds=0, part_pieces=20).select("sequence_id").distinct().count()
    more = packing.pack(found, rounds=4, part_pieces=20)
    assert more.count() == 400 and more.select("sequence_id").distinct().count() < once


def test_media(docs, rows):
    got = {r["row"]["doc_id"]: r for r in media.media_columns(docs).collect()}
    for r in rows:
        raw = (r[1] or "").encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        g = got[r[0]]
        with wave.open(io.BytesIO(bytes(g.media))) as w:
            assert w.readframes(w.getnframes()) == payload and w.getsampwidth() == 1
        h = g.heard
        assert (g.n_bytes, h.payload_bytes, h.payload_sha256, h.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert len(h.codes) == len(h.hashes) and h.codes == sorted(h.codes)
    assert got[4].heard != got[5].heard and got[80].heard == got[90].heard


def test_media_in_parts(monkeypatch):
    """What one batch of payloads gives leaves in parts of bounded size, all rows once and in order."""
    rng = random.Random(3)
    raws = [None, b""] + [rng.randbytes(rng.choice([0, 64, 700, 5000])) for _ in range(60)] + [rng.randbytes(9000), None]
    monkeypatch.setattr(media, "_CHUNK", 8192, raising=False)
    files = list(media._encode.func(iter([pa.array(raws, pa.binary()), pa.array([], pa.binary())])))
    stored = [x for part in files for x in part.to_pylist()]
    assert stored == [media.to_wav(media.padded(x or b"")) for x in raws] and len(files) > 5
    heard = list(media._features.func(iter([pa.array(stored, pa.binary())])))
    assert [h["payload_sha256"] for part in heard for h in part.to_pylist()] == [hashlib.sha256(media.padded(x or b"")).hexdigest() for x in raws]
    assert all(len(part) == 1 or sum(h["payload_bytes"] for h in part.to_pylist()) <= 8192 for part in heard)


def test_peaks_of_a_tone_pair():
    t = np.arange(4096)
    x = np.round(128 + 50 * np.sin(2 * np.pi * 20 * t / media.FRAME) + 40 * np.sin(2 * np.pi * 70 * t / media.FRAME)).astype(np.uint8)
    frames, freqs, n = media.peaks(x)
    assert n == 16 and {20, 70} <= set(freqs.tolist()) and (freqs == 20).sum() == 16
    whole = media.pair_fingerprints(x)
    old, media._BLOCK = media._BLOCK, 3
    try:
        assert all(np.array_equal(a, b) for a, b in zip(whole, media.pair_fingerprints(x)))
    finally:
        media._BLOCK = old


def test_licenses_with_one_word_changed_or_left_out():
    index = licenses.Index()
    for name, text in licenses.TEMPLATES.items():
        own = licenses.words(text.encode())
        for i in range(len(own)):
            for put in ([], [b"zzz"]):
                changed = own[:i] + put + own[i + 1 :]
                found = index.scan(b"intro " + b" ".join(changed) + b" end")
                if licenses.telling(changed) == licenses.telling(own):
                    assert any(m[2] >= len(own) - 1 and m[3] == len(own) for m in found), (name, i)
                else:  # without its name or version it is no notice of this license
                    assert name not in [m[0] for m in found], (name, i)
    assert [m[0] for m in index.scan(b"Released under an MIT license")] == ["MIT"]


def test_pairs_reach_all_frames_and_samples():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 256, 6000).astype(np.uint8)
    t, f, _ = media.peaks(x, media.HOP)
    codes, hashes, n = media.pair_fingerprints(x)
    want = sorted((int(t[i]), int(f[i]) << 12 | int(f[j]) << 4 | int(t[j] - t[i])) for i in range(len(t)) for j in range(len(t)) if 0 < t[j] - t[i] <= media.REACH)
    assert sorted(zip(codes.tolist(), hashes.tolist())) == want
    weight = np.zeros((n - 1) * media.HOP + media.FRAME)
    for k in range(n):
        weight[k * media.HOP : k * media.HOP + media.FRAME] += media._TAPER
    assert weight[media.HOP : -media.HOP].min() > 0.9


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT-grant"]
    half = " ".join(mit.split()[: len(mit.split()) // 2])
    texts = ["", None, "nothing here", f"Intro words. {licenses.TEMPLATES['MIT']} more", f"x {licenses.TEMPLATES['CC-BY-NC-4.0']} y {licenses.TEMPLATES['GPL-3.0']}", mit.upper().replace("FREE OF CHARGE", "free of any charge"), half, (licenses.TEMPLATES["Apache-2.0"] + " filler words here ") * 2, "licensed under the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = licenses.license_matches(docs).collect()
    names = sorted((g.doc_id, g.license) for g in got)
    assert names == [(3, "MIT"), (4, "CC-BY-NC-4.0"), (4, "GPL-3.0"), (5, "MIT-grant"), (7, "Apache-2.0"), (7, "Apache-2.0")]
    for g in got:
        span = licenses.words(texts[g.doc_id].encode())[g.start_word : g.end_word]
        template = licenses.words(licenses.TEMPLATES[g.license].encode())
        assert g.coverage == g.matched / len(template) >= 0.8 and span[0] == template[0] and span[-1] == template[-1]
    assert next(g for g in got if g.doc_id == 5).matched == len(licenses.words(mit.encode()))
    assert licenses.license_matches(docs, templates={}).count() == 0


NOTICES = [
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "AGPL-3.0-header"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "LGPL-3.0-header"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.", "GPL-3.0-header"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-header"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", None),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 1.", None),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, v3.", None),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This document is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Released under the BSD License.", "BSD"), ("Released under the license.", None), ("Released under the MIT License.", "MIT"), ("Released under an MIT license", "MIT"),
    ("Released under the ISC License.", "ISC"), ("Released under the zlib License.", None), ("Released under the Apache License.", None), ("Released under the Boost License.", None),
    ("Released under the old license.", None), ("Released under the Eclipse License.", None), ("not released under the MIT License", "MIT"),
    ("Licensed under CC BY 4.0", "CC-BY-4.0"), ("Licensed under CC BY 3.0", "CC-BY-3.0"), ("Licensed under CC BY 2.5", None), ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"), ("Licensed under CC BY-ND 3.0", None),
    ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"), ("Licensed under CC BY-SA 3.0", None), ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"),
    ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC 3.0", None), ("Licensed under CC 4.0", None),
    ("Licensed under the Apache License, Version 2.0", "Apache-2.0"), ("Licensed under the Apache License, Version 1.1", None), ("Licensed under the Mozilla License, Version 2.0", None), ("Licensed under the Artistic License, Version 2.0", None),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"), ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", None), ("This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0.", None),
    (licenses.TEMPLATES["BSD-3-Clause-text"], "BSD-3-Clause-text"), (licenses.TEMPLATES["BSD-2-Clause-text"], "BSD-2-Clause-text"),
]


@pytest.mark.parametrize("around", ["{}", "Some words stand before. {} And others stand after it."])
def test_confusable_notices_are_their_own_license_or_none(around):
    index = licenses.Index()
    for text, name in NOTICES:
        assert [m[0] for m in index.scan(around.format(text).encode())] == [name] * (name is not None), text


def test_licenses_in_a_row():
    index = licenses.Index()
    for name, text in licenses.TEMPLATES.items():
        n = len(licenses.words(text.encode()))
        for times in (2, 7, 40):
            found = index.scan(" ".join([text] * times).encode())
            if name not in ("Apache-2.0", "BSD-clause"):  # these begin longer notices of the list
                assert [m[4] for m in found if m[0] == name] == [i * n for i in range(times)], (name, times)


def test_many_matches_in_linear_time():
    import time

    index, taken = licenses.Index(), []
    for n in (1000, 8000):
        text = ("Released under the MIT License. some other words stand between " * n).encode()
        began = time.perf_counter()
        assert len(index.scan(text)) == n
        taken.append(time.perf_counter() - began)
    assert taken[1] < 20 * taken[0] + 0.5


def test_two_words_changed_against_all_places():
    """Of texts with two words of a template changed, those that alignment at every place finds are found from the index."""
    rng = random.Random(3)
    index = licenses.Index()
    whole = found = 0
    for name, text in licenses.TEMPLATES.items():
        own, t = licenses.words(text.encode()), index.names.index(name)
        if len(own) < 10:
            continue  # two changes leave less than the coverage
        for _ in range(20):
            changed = list(own)
            for i in rng.sample(range(len(own)), 2):
                changed[i] = b"zzz"
            ids = np.array([index.number.get(w, 0) for w in [b"intro"] * 3 + changed + [b"end"] * 3], np.int64)
            best = max(licenses.align(index.texts[t], ids, s)[0] for s in range(-3, 8))
            if best >= licenses.COVERAGE * len(own) and licenses.telling(changed) == licenses.telling(own):
                whole += 1
                found += any(m[2] >= best for m in index.scan(b"intro intro intro " + b" ".join(changed) + b" end end end"))
    assert whole > 200 and found >= 0.97 * whole, (found, whole)


def test_license_table(spark, monkeypatch):
    table = spark.createDataFrame([("Own", "you may copy this table freely and as often as you like", 1), ("None", None, 2), (None, "x", 3), ("Empty", "!!", 4)], "license string, text string, matched int")
    docs = spark.createDataFrame([(1, "well you may copy this table freely and as often as you like so"), (None, "nothing")], "doc_id long, text string")
    got = licenses.license_matches(docs, templates=table).collect()
    assert [(g.doc_id, g.license, g.start_word, g.end_word) for g in got] == [(1, "Own", 1, 13)]
    monkeypatch.setattr(licenses, "TEMPLATE_BYTES", 10)
    with pytest.raises(ValueError):
        licenses.license_matches(docs, templates=table)


def test_alignment_is_longest_common():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(1, 5, rng.integers(1, 7)), rng.integers(0, 5, rng.integers(1, 9))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        matched, first, stop = licenses.align(a, b, 0, band=20)
        assert matched == table[-1, -1] and stop - first >= matched


def test_winnowing_meets_any_shared_run():
    rng = np.random.default_rng(1)
    for _ in range(100):
        h = rng.integers(0, 50, 30)
        kept = licenses.winnow(h, 4)
        assert all(any(i <= k < i + 4 for k in kept) for i in range(27))


PAGES = "page_id long, url string, html string, digest string, first long"


@pytest.mark.parametrize("least, packed", [(0, True), (10, False)])
def test_warc(spark, least, packed):
    html = ["<p>one</p>", "<p>one</p>", None, "", "é" * 40, "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "é" * 40, "x" * 3_000_000, "<p>one</p>"]
    pages = spark.createDataFrame([(10 - i, None if i == 2 else f"http://h/{i}\r\nX: y", h, "d", 1) for i, h in enumerate(html)], PAGES)
    got = {r.page_id: r for r in warc.archive_round_trip(pages, least, packed).collect()}
    bodies = {10 - i: (h or "").encode() for i, h in enumerate(html)}
    assert len(got) == len(bodies)
    for p, raw in bodies.items():
        first = min(q for q, other in bodies.items() if other == raw)
        revisit = len(raw) >= least and p != first
        assert tuple(got[p]) == (p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None)


@pytest.mark.parametrize("hot, packed", [(False, True), (True, True), (True, False)])
def test_warc_repeated_page_ids(spark, monkeypatch, hot, packed):
    if hot:
        monkeypatch.setattr(warc, "HOT_ROWS", 1)
    rows = [(1, "A"), (1, "BBBB"), (2, "BBBB"), (2, "A"), (3, "A"), (None, "A"), (4, "é"), (4, "é"), (5, "é")]
    got = warc.archive_round_trip(spark.createDataFrame([(i, "u", h, "", 0) for i, h in rows], PAGES), 0, packed).collect()
    want = []
    for i, h in rows:
        first = min(j for j, other in rows if other == h and j is not None)
        again = i is not None and i != first
        want.append((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if again else "response", first if again else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_warc_members(tmp_path):
    import gzip

    import pyarrow.fs

    record = lambda kind, n: f"WARC/1.1\r\nWARC-Type: {kind}\r\nContent-Length: {n}\r\n\r\n".encode() + random.Random(n).randbytes(n) + b"\r\n\r\n"
    wanted, other = [record("response", n) for n in (0, 5, 9000, 200_000)], record("request", 3_000_000)
    whole = [wanted[0], other, wanted[1], wanted[2], other, wanted[3]]
    (tmp_path / "a.gz").write_bytes(b"".join(map(warc.member, whole)))
    assert gzip.decompress((tmp_path / "a.gz").read_bytes()) == b"".join(whole)
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"".join(whole)))
    for name in ("a.gz", "b.gz"):
        with pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / name)) as raw:

            class Counting:
                taken, size, seek, tell = 0, raw.size, raw.seek, raw.tell

                def read(self, n=-1):
                    out = raw.read(n)
                    Counting.taken += len(out)
                    return out

            found = list(warc.members(Counting(), lambda h: h["warc-type"] == "response", True))
            assert [p for _, p in found] == [w.partition(b"\r\n\r\n")[2][:-4] for w in wanted]
            if name == "a.gz":
                assert Counting.taken < 300_000


def test_warc_push_down(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 3}/", f"body {i}", "", 0) for i in range(30)], PAGES)
    path = warc.shared_path(spark, "warc-test")
    warc.write_warc(pages, path)
    found = warc.read_warc(spark, path).where("target_uri LIKE 'http://h1%' AND warc_type = 'response'")
    assert {r.payload.decode() for r in found.collect()} == {f"body {i}" for i in range(1, 30, 3)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith" not in plan.split("BatchScan")[0]

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counting.taken += len(out)
            return out

    record = lambda kind, n: f"WARC/1.1\r\nWARC-Type: {kind}\r\nContent-Length: {n}\r\n\r\n".encode() + b"z" * n + b"\r\n\r\n"
    raw = Counting(record("request", 50_000_000) + record("response", 5))
    assert [h["warc-type"] for h, _ in warc.records(raw, lambda h: h["warc-type"] == "response", True)] == ["response"]
    assert Counting.taken < 5_000_000


def test_langid(docs, rows, none):
    model = langid.learn([(f"the {w} of the house and the {w}", "en", i) for i, w in enumerate(WORDS)] + [(f"der {w} und das {w} nicht", "de", i) for i, w in enumerate(WORDS)] + [(f"le {w} est dans la {w} avec", "fr", i) for i, w in enumerate(WORDS)] + [(f"el {w} que los {w} pero", "es", i) for i, w in enumerate(WORDS)])
    assert sorted(model.families) == ["germanic", "romance"]
    assert [model.predict(t)[0] for t in ("the cat and the dog of", "das ist nicht und der", "la vie est avec le", "los perros que el pero")] == ["en", "de", "fr", "es"]
    assert model.predict(None) == model.predict("123 !") == model.predict("") == ("und", 0.0)
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 for g in got)
    assert all((g.lang_pred == "und") == (not any(c.isalpha() for c in (r[1] or ""))) for r in rows for g in got if g.doc_id == r[0])
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 3 == 1) for g in got)
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_langid_has_letters_and_loses_no_language(spark, monkeypatch):
    model = langid.learn([("the house and the cat", "en", 1), ("das haus und der hund", "de", 2)])
    assert {model.predict(t)[0] for t in ("²½", "①", "٣", "!?", "\u0301")} == {"und"}
    assert model.predict("ª")[0] != "und" and model.predict("漢")[0] != "und"
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 300)
    texts = [("en", "the house and the cat " * 40), ("de", "das haus und der hund " * 40), ("fr", "la maison et le chat " * 40), ("fr", "le chat")]
    docs = spark.createDataFrame([(i * 3, t, lang) for i, (lang, t) in enumerate(texts * 8)], "doc_id long, text string, lang string")
    got = langid.identify(docs).collect()
    assert {g.lang_pred for g in got} == {"en", "de", "fr"}
    assert langid._within([(1, 5, 900), (2, 6, 20), (3, 7, 400), (4, 8, 10)], 3, 100) == [(1, 5)]
    assert langid._within([(2, 6, 20), (3, 7, 400), (4, 8, 10)], 3, 100) == [(2, 6), (4, 8)]


def test_langid_duels_against_brute_force():
    """The family and the language with most won duels, each duel by the sign of its own sum."""
    rng = random.Random(7)
    words = {lang: ["".join(rng.choices(letters, k=5)) for _ in range(40)] for lang, letters in {"en": "abcdef", "de": "abcdgh", "fr": "klmnop", "es": "klmnqr", "xx": "uvwxyz"}.items()}
    make = lambda lang: " ".join(rng.choices(words[lang], k=12))
    model = langid.learn([(make(lang), lang, i) for i in range(30) for lang in words])

    def winner(group, names, x):
        if len(names) == 1:
            return names[0]
        _, pairs, weights = model.duels[group]
        margin = {(a, b): sum(float(w) * float(v) for w, v in zip(ws, x)) for (a, b), ws in zip(pairs, weights)}
        wins = [sum((m > 0) == (i == a) for (a, b), m in margin.items() if i in (a, b)) for i in range(len(names))]
        summed = [sum(m if i == a else -m for (a, b), m in margin.items() if i in (a, b)) for i in range(len(names))]
        return names[max(range(len(names)), key=lambda i: (wins[i], summed[i]))]

    for lang in list(words) * 8:
        text = make(lang)
        x = langid.features(text)
        group = winner("", sorted(model.families), x)
        assert model.predict(text)[0] == winner(group, model.families[group], x) == lang


def test_held_out_accuracy(spark):
    """On the supplied tables: labels and languages that were not learned from."""
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    said = langid.identify(docs.select("doc_id", "text", "lang")).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'")
    assert said.where("lang_pred = lang").count() >= 0.99 * said.count()
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    share = {r.toxic: r.p for r in rows}
    assert share[1] >= 0.75 and share[0] <= 0.015


def test_equal_rows_of_a_hot_text_are_parted(spark):
    docs = spark.createDataFrame([(7, "the same row again")] * 3000 + [(i, f"text {i}") for i in range(100, 400)], "doc_id long, text string").repartition(6)
    runs, hot = exact._runs(docs, "doc_id", "text", ["doc_id"])
    sizes = [r["count"] for r in runs.where("sub_run >= 0").groupBy("sub_run").count().collect()]
    assert hot and sum(sizes) == 3000 and max(sizes) < 600
    same = exact.exact_duplicates(docs).where("row.doc_id = 7").groupBy("group_size", "keep_id", "kept").count().collect()
    assert sorted((r["group_size"], r["keep_id"], r["kept"], r["count"]) for r in same) == [(3000, 7, False, 2999), (3000, 7, True, 1)]


def test_toxicity_draw():
    assert toxicity._within([(3, 1, 5), (1, 2, toxicity.CLASS_BYTES + 1), (2, 3, 7)]) == [(1, 2, toxicity.CLASS_BYTES + 1)]
    assert [r[1] for r in toxicity._within([(1, 2, 10), (2, 3, toxicity.CLASS_BYTES), (3, 1, 5)])] == [2, 1]


def test_toxicity_distance_against_two_compressors():
    """Counts of saved bytes by two plain zstandard compressors with the two dictionaries."""
    rng = random.Random(9)
    rows = [((" ".join(rng.choices(WORDS, k=60)) + (" horrid scoundrel vermin" if i % 4 == 0 else " good day rest")).encode(), int(i % 4 == 0), rng.getrandbits(40)) for i in range(400)]
    model = toxicity.learn(rows, 0.25)
    distance = toxicity.Distance(model)
    sides = [toxicity._compressor(c) for c in (model.ordinary, model.toxic)]
    text = b"alpha horrid beta vermin gamma"
    saved = [len(sides[0](b" " + w + b" " + toxicity.CARRIER)) - len(sides[1](b" " + w + b" " + toxicity.CARRIER)) for w in text.split()]
    assert distance(text.split()) == saved and saved[1] > 2 and saved[3] > 2
    counts = distance.features(text)[1 : 1 + len(toxicity.LEVELS)]
    assert np.allclose(counts, np.log1p([sum(s >= k for s in saved) for k in toxicity.LEVELS]))
    assert toxicity.probability(model, distance, rows[0][0]) > 0.5 > toxicity.probability(model, distance, rows[1][0])


def test_toxicity(spark, docs, rows):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(WORDS, k=60)) for _ in range(400)]
    marked = []
    for i, t in enumerate(texts):
        toxic = int(i % 4 == 0)
        marked.append((i, t + (" you are a horrid scoundrel and a vermin" if toxic else " have a good day and a rest"), toxic))
    table = spark.createDataFrame([(i, t) for i, t, _ in marked] + [(1000, None), (1001, ""), (1002, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in marked] + [(None, 1), (5000, 1), (1000, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(table, labels).collect()}
    held = [i for i, _, _ in marked if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert np.mean([got[i].predicted == marked[i][2] for i in held]) > 0.95
    assert got[1000].score == got[1001].score == got[1002].score
    assert all((r.score >= 0.5) == bool(r.predicted) for r in got.values())
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    alone = toxicity.toxicity(table, labels.where("toxic = 0")).collect()
    assert {r.score for r in alone} == {0.0}


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert exact.exact_duplicates(none).count() == simhash.near_duplicates(none).count() == mixing.mix(none).count() == sharding.shard(none).count() == 0
    assert packing.pack_documents(none).count() == media.media_columns(none).count() == licenses.license_matches(none).count() == 0
    assert langid.identify(none).count() == toxicity.toxicity(none, labels).count() == 0
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_toxicity_passages():
    rng = random.Random(4)
    phrase = "people of your sort should never have been let in here"
    rows = []
    for i in range(600):
        own = rng.choices(WORDS, k=60) + phrase.split()  # every text holds the words
        rng.shuffle(own)
        at = rng.randrange(len(own))
        rows.append((" ".join(own[:at] + (phrase.split() if i % 2 else phrase.split()[::-1]) + own[at:]).encode(), i % 2, rng.getrandbits(40)))
    model = toxicity.learn(rows[:400], 0.5)
    distance = toxicity.Distance(model)
    assert np.mean([(toxicity.probability(model, distance, t) >= 0.5) == x for t, x, _ in rows[400:]]) > 0.9
    assert len(model.ordinary_passages) == len(model.toxic_passages)


def test_toxicity_lexicon_is_whole():
    rng = random.Random(5)
    bad = ["".join(rng.choices("bcdfghjklmnpqrstvwxz", k=9)) for _ in range(600)]  # 6 KB of toxic words
    rows = [(" ".join(rng.choices(WORDS, k=40) + (rng.sample(bad, 200) if i % 2 else [])).encode(), i % 2, rng.getrandbits(40)) for i in range(600)]
    model = toxicity.learn(rows, 0.5)
    assert all(w.encode() in model.toxic for w in bad)


def test_toxicity_training_holds_little_beside_its_texts(monkeypatch):
    """At many times more words than are trained on, the words of all texts are never held at once."""
    for name in ("WORDS", "PASSAGES", "_GRAMS"):
        monkeypatch.setattr(toxicity, name, 4096, raising=False)
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=400)).encode() for _ in range(400)]
    toxic, plain = [t + b" horrid scoundrel vermin" for t in texts[:100]], texts[100:]
    grams = [toxicity._gram_sets(t) for t in plain]
    assert all(np.array_equal(a, b) for a, b in zip(toxicity._counted(grams), np.unique(np.concatenate(grams), return_counts=True)))
    tracemalloc.start()
    try:
        model = toxicity._dictionaries(toxic, plain, 0.25)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert b"scoundrel" in model.toxic and peak < 3 * sum(map(len, texts)), peak / sum(map(len, texts))


def test_toxicity_windows_overlap():
    unspaced = "".join(random.Random(6).choices("abcdefghij", k=500)).encode()
    assert all(any(unspaced[i : i + 24] in w for w in toxicity.windows(unspaced)) for i in range(477))
    assert all(any(unspaced[i : i + 24] in w for w in toxicity.passages(unspaced)) for i in range(477))
