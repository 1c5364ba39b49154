"""Language identification in two steps: family first, then the language within it.

Texts become counts of hashed byte trigrams of the lower-cased text. Linear
support vector machines (squared hinge loss) are trained one versus one: between
language families, and between the languages of each family. A text goes to the
family that wins most of its duels, then to the language of that family that
wins most of its own; summed margins break ties.

Learning reads at most ``SAMPLE_ROWS`` documents and ``SAMPLE_BYTES`` bytes of text, in
equal parts for each language, drawn by a hash of doc_id over all
documents, and adds short excerpts of them so that short texts are met in training too. A text that does not
fit in what is left of its language's bytes is passed over for later ones; the first of each language is always
read, so no language is lost. Predictions read every whole text.

Defined results: ``und`` with score 0 for null texts and texts without a letter (numerals such as a
superscript two are none); a null doc_id is never learned from and is not held out;
with a single learned language every other text gets it; without any learned
language every text is ``und``; equal texts get equal results; an empty table
gives an empty result; languages outside the family table are a family of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 3200
SAMPLE_BYTES = 24 << 20
BUCKETS = 2048
UNDETERMINED = "und"
_CHUNK = 1 << 20

# Language codes by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk",
    "indo-aryan": "hi bn ur mr gu pa ne si",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "sinitic": "zh",
    "austronesian": "id ms tl jv",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"own:{lang}")


def counts(text: str) -> np.ndarray:
    """Hashed trigram counts of the lower-cased text's bytes with blanks made alike."""
    out = np.zeros(BUCKETS, np.int64)
    raw = (" " + text.lower() + " ").encode()
    for at in range(0, len(raw), _CHUNK):
        b = np.frombuffer(raw, np.uint8)[at : at + _CHUNK + 2].astype(np.uint32)
        b = np.where(b < 33, 32, b)
        if len(b) > 2:
            h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out += np.bincount(h >> np.uint32(21), minlength=BUCKETS)
    return out


def features(text: str) -> np.ndarray:
    """Square roots of the counts, at unit length, and a constant."""
    x = np.sqrt(counts(text).astype(np.float32))
    return np.append(x / max(float(np.sqrt((x * x).sum())), 1e-9), np.float32(1))


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 8.0, rounds: int = 60) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss; classes weigh alike. Accelerated gradient steps."""
    c = np.where(y > 0, cost / max((y > 0).sum(), 1), cost / max((y < 0).sum(), 1)).astype(np.float32)
    keep = np.full(x.shape[1], 0.02, np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    rate = 1.0 / (2 * 2 * 2 * cost + 0.02)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - rate * (keep * v - 2 * x.T @ (c * y * slack))
        v = new + (k / (k + 3)) * (new - w)
        w = new
    return w


@dataclass
class Model:
    """``duels``: of each group of names (families, or languages of one), pairs and the weights that tell them apart."""

    families: dict[str, list[str]] = field(default_factory=dict)
    duels: dict[str, tuple[list[str], list[tuple[int, int]], np.ndarray]] = field(default_factory=dict)

    def _winner(self, group: str, names: list[str], x: np.ndarray) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        _, pairs, weights = self.duels[group]
        margins = weights @ x
        wins, summed = np.zeros(len(names)), np.zeros(len(names))
        for (a, b), m in zip(pairs, margins):
            wins[a if m > 0 else b] += 1
            summed[a] += m
            summed[b] -= m
        best = max(range(len(names)), key=lambda i: (wins[i], summed[i]))
        least = min(m if a == best else -m for (a, b), m in zip(pairs, margins) if best in (a, b))
        return names[best], float(1 / (1 + np.exp(-4 * np.clip(least, -8, 8))))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not has_letter(text):
            return UNDETERMINED, 0.0
        x = features(text)
        group, sure = self._winner("", sorted(self.families), x)
        lang, within = self._winner(group, self.families[group], x)
        return lang, sure * within


def _excerpts(text: str, seed: int) -> Iterator[str]:
    """The text, and short runs of its words."""
    yield text
    words = text.split()
    for i, n in enumerate((1, 3, 8)):
        if len(words) > n:
            at = (seed * 31 + i * 7919) % (len(words) - n)
            yield " ".join(words[at : at + n])


def learn(rows: list[tuple[str, str, int]]) -> Model:
    """A model from ``(text, lang, hash)``."""
    model = Model()
    for lang in sorted({lang for _, lang, _ in rows}):
        model.families.setdefault(family(lang), []).append(lang)
    found = [(e, lang) for text, lang, h in rows for e in _excerpts(text, h) if has_letter(e)]
    if not found:
        return Model()
    x = np.array([features(e) for e, _ in found])
    lang = np.array([v for _, v in found])
    kin = np.array([family(v) for v in lang])

    def duels(names: list[str], label: np.ndarray) -> tuple:
        pairs = list(combinations(range(len(names)), 2))
        weights = []
        for a, b in pairs:
            mine = (label == names[a]) | (label == names[b])
            rows = x if mine.all() else x[mine]
            weights.append(_svm(rows, np.where(label[mine] == names[a], 1, -1).astype(np.float32)))
        return names, pairs, np.array(weights)

    if len(model.families) > 1:
        model.duels[""] = duels(sorted(model.families), kin)
    for group, names in model.families.items():
        if len(names) > 1:
            model.duels[group] = duels(names, lang)
    return model


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(ident.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def train(docs: DataFrame) -> Model:
    """A model from documents with a language that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("rows"))
    langs = max(1, sizes.count())
    most_rows, most_bytes = max(1, SAMPLE_ROWS // langs), SAMPLE_BYTES // langs
    # A hash threshold for each language thins its rows to about twice the bound, on the cluster.
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 32))
    thin = known.join(sizes, "lang").withColumn("draw", draw).where(F.col("draw") < F.lit(2.0 * most_rows + 8) / F.col("rows") * (1 << 32))
    by_lang: dict[str, list] = {}
    for r in thin.select("lang", "draw", "doc_id", "n").toLocalIterator():
        by_lang.setdefault(r["lang"], []).append((r["draw"], r["doc_id"], r["n"]))
    chosen = [x for rows in by_lang.values() for x in _within(rows, most_rows, most_bytes)]
    drawn = docs.sparkSession.createDataFrame(chosen, "draw long, doc_id long").dropDuplicates(["doc_id"])
    picked = docs.select("doc_id", "lang", "text").join(F.broadcast(drawn), "doc_id").where("lang IS NOT NULL AND text IS NOT NULL")  # SAMPLE_ROWS ids
    rows = sorted((r["draw"], r["text"], r["lang"]) for r in picked.toLocalIterator())
    return learn([(text, lang, h) for h, text, lang in rows])


def _within(sized: list[tuple[int, int, int]], most_rows: int, most_bytes: int) -> list[tuple[int, int]]:
    """Of ``(draw, doc_id, bytes)``, in order of the draw, at most ``most_rows`` that fit into what is left of the bytes; the first always."""
    left, kept = most_bytes, []
    for draw, ident, n in sorted(sized):
        if len(kept) < most_rows and (n <= left or not kept):
            kept.append((draw, ident))
            left -= n
    return kept


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))  # one weight vector for each pair of families, and of languages of one family

    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [model.value.predict(t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    predict.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    said = F.arrow_udf(predict, "lang string, score double")(F.col("text"))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), said.alias("said"))
    return out.select("doc_id", "held_out", F.col("said.lang").alias("lang_pred"), F.col("said.score").alias("score"))
