"""Toxicity by compression distance.

Pairs of zstandard dictionaries are trained, one of each pair on toxic and one on ordinary
text. A window of a text is compressed with both of a pair; the bytes that the toxic
side saves are its distance. The word pair is trained on single words, a window long
enough for a toxic word or stem in ordinary surroundings: the ordinary side on words of ordinary
texts; the toxic side holds the same and what is trained on the standing-out windows of toxic texts, those
words and stems that far more toxic documents hold than ordinary ones. (Trained on all
windows of toxic texts it learns the language, which both classes share.) The passage pair is trained on
``WINDOW_BYTES`` bytes of several words, every ``WINDOW_BYTES // 2`` bytes; both sides are
a hundredth of the toxic passages in size. All are loaded as content: with its own entropy
tables each side would shift all lengths alike.

A document's counts of words beyond each of ``LEVELS`` saved bytes and of passages beyond each of
``PASSAGE_LEVELS`` are weighed by a logistic model. It is fitted on documents scored with dictionaries that
the other ``FOLDS - 1`` folds trained, and on scores of all ordinary documents, by weights that leave out their fold too, the threshold is
calibrated, so that ``MOST_FALSE`` of them at most pass it; the dictionaries that stay are trained on all folds. A fold is a task. Copies and near-copies are taken once in training, or their chance words
would pass for toxic ones.

Words are cut at ``WINDOW_BYTES``, with an overlap of half, and followed by a carrier that both sides
hold, so that even a short one is compressed and not stored. Most words come
back again and again, so a worker keeps the distances of recent ones.

Learning reads at most ``CLASS_ROWS`` labelled documents and ``CLASS_BYTES`` bytes of
text of each class, drawn by a hash of doc_id over all labels; a text that does not fit in what is left of
its class's bytes is passed over for later ones, and the first of each class is always read. Scoring reads every
whole text.

Defined results: null and empty texts get the score of a text without windows;
equal texts get equal scores; a null doc_id is never learned from and is not held out; a label table
without toxic or without ordinary rows, or with too few for ``FOLDS``, gives every text the share of toxic labels; labels that repeat a doc_id count
as often as they come in that share and are learned from once; of rows that share a doc_id the shortest text is learned from; an empty table gives an empty result; extra columns are ignored by the scores
and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeflow.plans.lineage import settle

CLASS_ROWS = 3000
CLASS_BYTES = 24 << 20
DICTIONARY_BYTES = 16384
LEAST_BYTES = 8192
GRAM = 5
WINDOW_BYTES = 48
LEVELS = (3, 4, 5, 6, 8)
PASSAGE_LEVELS = (4, 8, 12, 16)
CARRIER = b"\x01carrier of one framed window of text\x02"
LEAST_Z = 6.0
LEAST_SHARE = 0.01
LEAST_RATE = 3.0
MOST_FALSE = 0.005
FOLDS = 8
SEGMENT = 24
WORDS = 400_000
PASSAGES = 100_000
_MARKS = b".,;:!?\"'()[]*&%$#"
_CACHE = 400_000
_GRAMS = 1 << 20


@dataclass
class Model:
    """Dictionaries and calibrated weights; ``base`` alone scores when a class is missing."""

    base: float
    ordinary: bytes = b""
    toxic: bytes = b""
    ordinary_passages: bytes = b""
    toxic_passages: bytes = b""
    weights: list[float] = field(default_factory=list)


def windows(text: bytes) -> list[bytes]:
    """Words of the lower-cased text, long ones in overlapping pieces."""
    found = text.lower().split()
    if max(map(len, found), default=0) > WINDOW_BYTES:
        found = [p for w in found for p in _pieces(w)]
    return found


def _pieces(text: bytes) -> list[bytes]:
    """``WINDOW_BYTES`` bytes of the text, every half of that."""
    step = WINDOW_BYTES // 2
    return [text[i : i + WINDOW_BYTES] for i in range(0, max(1, len(text) - step), step)]


def passages(text: bytes) -> list[bytes]:
    """Overlapping pieces of the lower-cased text, blanks made alike."""
    joined = b" ".join(text.lower().split())
    return _pieces(joined) if joined else []


def _compressor(content: bytes) -> "callable":
    log = max(15, len(content).bit_length())  # the tables hold every place of the content
    params = zstandard.ZstdCompressionParameters(window_log=max(17, log), hash_log=log, chain_log=log, search_log=5, min_match=3, target_length=48, strategy=zstandard.STRATEGY_GREEDY, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=held).compress


class Distance:
    """Bytes that the toxic dictionaries save on a window."""

    def __init__(self, model: Model) -> None:
        self._sides = [_compressor(x) for x in (model.ordinary, model.toxic)]
        self._passage_sides = [_compressor(x) for x in (model.ordinary_passages, model.toxic_passages)]
        self._known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> list[int]:
        known, (plain, toxic) = self._known, self._sides
        if len(known) >= _CACHE:
            known.clear()
        for w in set(words).difference(known):
            framed = b" " + w + b" " + CARRIER
            known[w] = len(plain(framed)) - len(toxic(framed))
        return [known[w] for w in words]

    def features(self, text: bytes | None) -> np.ndarray:
        """Counts of words and passages at each level of saved bytes (log), their shares, the log of all words, and the passages' mean."""
        found = windows(text) if text else []
        n = len(found)
        saved = np.array(self(found), np.int64)
        over = np.array([(saved >= k).sum() for k in LEVELS], float)
        plain, toxic = self._passage_sides
        gained = np.array([len(plain(p)) - len(toxic(p)) for p in passages(text)] if text else [], np.int64)
        m = max(len(gained), 1)
        beyond = np.array([(gained >= k).sum() for k in PASSAGE_LEVELS], float)
        return np.array([1.0, *np.log1p(over), *np.sqrt(over / max(n, 1)), np.log1p(n), *np.log1p(beyond), *np.sqrt(beyond / m), gained.sum() / m])


def _gram_sets(text: bytes) -> np.ndarray:
    """Distinct byte grams inside words, with the blank before a word and the one after it."""
    b = np.frombuffer(b" " + b" ".join(windows(text)) + b" ", np.uint8).astype(np.uint64)
    if len(b) < GRAM:
        return np.zeros(0, np.uint64)
    code = np.zeros(len(b) - GRAM + 1, np.uint64)
    inner = np.ones(len(code), bool)
    for i in range(GRAM):
        part = b[i : len(b) - GRAM + 1 + i]
        code = (code << np.uint64(8)) | part
        if 0 < i < GRAM - 1:
            inner &= part != 32
    return np.unique(code[inner])


def _over(n_toxic: np.ndarray, n_plain: np.ndarray, toxic: int, plain: int) -> np.ndarray:
    """Whether far more toxic documents hold something than their share of all documents says."""
    share = toxic / (toxic + plain)
    z = (n_toxic - (n_toxic + n_plain) * share) / np.sqrt((n_toxic + n_plain) * share * (1 - share) + 0.25)
    rate = (n_toxic / toxic) / ((n_plain + 0.5) / (plain + 1))
    return (z >= LEAST_Z) & (n_toxic >= max(3, LEAST_SHARE * toxic)) & (rate >= LEAST_RATE)


def _once(rows: list[tuple[bytes, int, int]]) -> list[tuple[bytes, int, int]]:
    """``rows`` without copies and near-copies, which share the two least hashes of their runs of five words."""
    seen, kept = set(), []
    for text, label, h in rows:
        w = text.split()
        runs = {zlib.crc32(b" ".join(w[i : i + 5])) for i in range(max(1, len(w) - 4))}
        mark = (label, *sorted(runs)[:2])
        if mark not in seen:
            seen.add(mark)
            kept.append((text, label, h))
    return kept


def _counted(sets: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The values of all sets, sorted, and how many sets hold each; at most ``_GRAMS`` and one set wait to be counted."""
    values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts, held = [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        new, times = np.unique(np.concatenate(parts), return_counts=True)
        every = np.union1d(values, new)
        total = np.zeros(len(every), np.int64)
        total[np.searchsorted(every, values)] += counts
        total[np.searchsorted(every, new)] += times
        return every, total

    for own in sets:
        parts.append(own)
        held += len(own)
        if held >= _GRAMS:
            values, counts = merged()
            parts, held = [], 0
    return merged() if parts else (values, counts)


def _salient(toxic: list[bytes], plain: list[bytes]) -> np.ndarray:
    """Grams of which that holds."""
    (a, n_a), (b, n_b) = (_counted(map(_gram_sets, texts)) for texts in (toxic, plain))
    if not len(a):
        return a
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    other = np.where(b[at] == a, n_b[at], 0) if len(b) else np.zeros(len(a), int)
    return a[_over(n_a, other, len(toxic), len(plain))]


def _salient_words(toxic: list[bytes], plain: list[bytes]) -> list[bytes]:
    """Windows without outer punctuation of which that holds, the most frequent last."""
    bare = lambda t: {w.strip(_MARKS) for w in windows(t)}
    a = Counter(w for t in toxic for w in bare(t))
    b = Counter(w for t in plain for w in bare(t) & a.keys())
    words = sorted((w for w, n in a.items() if n >= 3 and len(w) > 2), key=lambda w: (a[w], w))
    over = _over(np.array([a[w] for w in words], float), np.array([b[w] for w in words], float), len(toxic), len(plain)) if words else []
    return [w for w, ok in zip(words, over) if ok]


def _passages(text: bytes, salient: set[int]) -> Iterator[bytes]:
    """The runs of a text's words that salient grams cover, from the beginning of the word where they are near it."""
    for w in windows(text):
        b = b" " + w + b" "
        hit = [i for i in range(len(b) - GRAM + 1) if int.from_bytes(b[i : i + GRAM], "big") in salient]
        if hit:
            start = last = hit[0] if hit[0] > 2 else 0
            for i in [*hit, len(b) + GRAM]:
                if i > max(last, hit[0]) + 1:
                    yield b[start : max(last, hit[0]) + GRAM].strip()
                    start = i
                last = i


def _spread(samples: Callable[[], Iterator[bytes]], most: int) -> list[bytes]:
    """Less than twice ``most`` of the samples of learning, evenly spread; counted first, so that only these are held."""
    step = max(1, sum(1 for _ in samples()) // most)
    return list(islice(samples(), 0, None, step))


def _dictionary(samples: list[bytes], size: int, together: int = 16) -> bytes:
    """Content of a trained zstandard dictionary, or the most frequent samples where too few are given to train."""
    try:
        joined = [b" ".join(samples[i : i + together]) for i in range(0, len(samples), together)]
        return zstandard.train_dictionary(size, joined).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(w for w, _ in Counter(samples).most_common())[-size:]


def _standing_out(toxic: list[bytes], plain: list[bytes]) -> list[bytes]:
    """The windows of toxic texts that stand out: salient words, and the runs of words that salient grams cover."""
    words = set(_salient_words(toxic, plain))
    salient = set(_salient(toxic, plain).tolist())
    found = []
    for t in toxic:
        found += [b" " + w + b" " for w in map(lambda w: w.strip(_MARKS), windows(t)) if w in words]
        found += [b" " + p + b" " for p in _passages(t, salient)]
    return found


def _segments(samples: list[bytes]) -> bytes:
    """What zstandard trains on the samples in segments of ``SEGMENT`` bytes, behind the samples that its segments cut."""
    if not samples:
        return b""
    size = 2 * sum(map(len, set(samples))) + 512
    try:
        trained = zstandard.train_dictionary(max(1024, size), [b"".join(samples[i : i + 8]) for i in range(0, len(samples), 8)], k=SEGMENT, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        trained = b""
    return b"".join(sorted(w for w in set(samples) if w.strip() not in trained)) + trained


def _dictionaries(toxic: list[bytes], plain: list[bytes], share: float) -> Model:
    """The pairs of dictionaries of two classes of texts."""
    content = _dictionary(_spread(lambda: (w for t in plain for w in windows(t)), WORDS), DICTIONARY_BYTES)
    model = Model(base=share, ordinary=content + b" " + CARRIER, toxic=content + b" " + _segments(_standing_out(toxic, plain)) + b" " + CARRIER)
    size = max(LEAST_BYTES, sum(len(p) for t in toxic for p in passages(t)) // 100)
    trained = [_dictionary(_spread(lambda: (p for t in texts for p in passages(t)), PASSAGES), size, 1) for texts in (plain, toxic)]
    least = min(map(len, trained))  # neither side may save more by its size alone
    model.ordinary_passages, model.toxic_passages = (x[len(x) - least :] for x in trained)
    return model


Row = tuple[bytes, int, int]


def _fold(rows: list[Row], fold: int, share: float) -> tuple[Model | None, list[list[float]], list[int]]:
    """Dictionaries of all folds but this, and features and labels of the documents of this; ``FOLDS`` is a fold of none."""
    sides = [[t for t, x, h in rows if x == c and h % FOLDS != fold] for c in (1, 0)]
    if not all(sides):
        return None, [], []
    model = _dictionaries(*sides, share)
    distance = Distance(model)
    own = [(t, x) for t, x, h in rows if h % FOLDS == fold]
    return model, [distance.features(t) for t, _ in own], [x for _, x in own]


def _weighed(model: Model, folds: list[tuple[list[list[float]], list[int]]], share: float) -> Model:
    """The model with weights and threshold from features and labels of folds that trained none of their dictionaries.

    The threshold comes from scores by weights that were not fitted on the document's own fold either.
    """
    folds = [(np.array(held), np.array(labels, float)) for held, labels in folds if labels]
    join = lambda parts: (np.concatenate([h for h, _ in parts]), np.concatenate([y for _, y in parts]))
    clean = []
    for k, (held, labels) in enumerate(folds):
        x, y = join(folds[:k] + folds[k + 1 :]) if len(folds) > 1 else (held, labels)
        own = _logistic(x, y, share) if 0 < y.sum() < len(y) else np.zeros(x.shape[1])
        clean += (held[labels == 0] @ own).tolist()
    weights = _logistic(*join(folds), share)
    clean = sorted(clean, reverse=True)
    weights[0] -= clean[min(math.ceil(MOST_FALSE * len(clean)), len(clean) - 1)] + 1e-6
    model.weights = weights.tolist()
    return model


def learn(rows: list[Row], share: float) -> Model:
    """A model from ``rows``: text, toxic 0/1, and a hash. share: of toxic labels."""
    rows = _once(rows)
    found = [_fold(rows, fold, share) for fold in range(FOLDS + 1)]
    if any(model is None for model, _, _ in found):
        return Model(base=share)
    return _weighed(found[FOLDS][0], [(held, own) for _, held, own in found], share)


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 0.3) -> np.ndarray:
    """Newton's method; classes are weighted back to their shares among all labels."""
    held = y.mean()
    weight = np.where(y == 1, share / held, (1 - share) / (1 - held))
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (weight * (p - y)) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def probability(model: Model, distance: Distance | None, text: bytes | None) -> float:
    if distance is None:
        return model.base
    return float(1 / (1 + np.exp(-np.clip(distance.features(text) @ np.array(model.weights), -30, 30))))


def held_out(ident: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.encode(ident.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents that are not held out."""
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    draw = F.xxhash64("doc_id", F.lit(1))
    drawn = None
    for label in (0, 1):
        one = marked.where(F.col("toxic") == label).distinct().withColumn("draw", draw).orderBy("draw", "doc_id").limit(CLASS_ROWS)
        drawn = one if drawn is None else drawn.union(one)
    drawn = settle(drawn, "toxic-draw")
    # Rows that share a doc_id are one document to learn from: the shortest text, the smallest of equals.
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    ids = F.broadcast(drawn.select("doc_id").distinct())  # at most 2 x CLASS_ROWS
    sized = docs.select("doc_id", size.alias("n")).join(ids, "doc_id").groupBy("doc_id").agg(F.min("n").alias("n")).join(F.broadcast(drawn), "doc_id")
    told = sized.select("toxic", "draw", "doc_id", "n").collect()
    chosen = [(*r, label) for label in (0, 1) for r in _within([(r["draw"], r["doc_id"], r["n"]) for r in told if r["toxic"] == label])]
    chosen = F.broadcast(docs.sparkSession.createDataFrame(chosen, "draw long, doc_id long, n long, toxic int"))
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("body")
    texts = docs.select("doc_id", body).join(chosen, "doc_id").where(F.octet_length("body") == F.col("n"))
    texts = settle(texts.groupBy("doc_id", "toxic", "draw").agg(F.min("body").alias("body")), "toxic-text")
    return _learned(texts, share)


def _learned(texts: DataFrame, share: float) -> Model:
    """``learn`` with a task for each fold, to which all of the bounded sample goes; features and one model come back."""
    folds = texts.select("body", "toxic", "draw", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))).alias("fold"))

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = list(batches)
        rows = pd.concat(whole) if whole else pd.DataFrame({"fold": []})
        for fold, own in rows.groupby("fold"):
            ordered = sorted(((bytes(b), int(x), int(d) >> 1) for b, x, d in zip(own["body"], own["toxic"], own["draw"])), key=lambda r: (r[2], r[0]))
            model, held, labels = _fold(_once(ordered), int(fold), share)
            yield pd.DataFrame({"fold": [fold], "model": [None if model is None or fold < FOLDS else pickle.dumps(model)], "held": [pickle.dumps((held, labels))], "some": [model is not None]})

    # A fold for each partition: ranges of its number. Sorted here, as a sort in Spark would train twice.
    found = folds.repartitionByRange(FOLDS + 1, "fold").mapInPandas(parts, "fold int, model binary, held binary, some boolean").collect()
    found.sort(key=lambda r: r["fold"])
    if len(found) <= FOLDS or not all(r["some"] for r in found):
        return Model(base=share)
    return _weighed(pickle.loads(found[-1]["model"]), [pickle.loads(r["held"]) for r in found], share)


def _within(sized: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of ``(draw, doc_id, bytes)``, in order of the draw, those that fit into what is left of ``CLASS_BYTES``; the first always."""
    left, kept = CLASS_BYTES, []
    for r in sorted(sized):
        if r[2] <= left or not kept:
            kept.append(r)
            left -= r[2]
    return kept


def score(model: Model) -> "callable":
    """An Arrow function of UTF-8 bytes that gives the score of each text."""

    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        distance = Distance(model) if model.weights else None
        for batch in texts:
            yield pa.array([probability(model, distance, t.as_py()) for t in batch], pa.float64())

    scores.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scores, "double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model)(F.encode("text", "UTF-8")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns unchanged."""
    model = train(docs, labels)
    return docs.where(score(model)(F.encode("text", "UTF-8")) < 0.5)
