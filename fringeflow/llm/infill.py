"""Fill-in-middle by piece tables.

A document is never copied while it is cut and rearranged. Its table starts as one descriptor
``(buffer, start, length)`` over the immutable text; cutting splits descriptors, the sentinels are
descriptors over a buffer of their own, an arrangement permutes the table, and the inverse permutation
of the table that is cut from an output at its sentinels restores the text. Digests stream the
descriptors; a text is put together only where a caller asks for it.

The cuts are two positions drawn from the digest of a seed and the doc_id, in code points; descriptors
hold UTF-8 bytes. A text that holds a sentinel could not be restored and stays plain, as do an
empty one and the share that is left as it is.

Defined results: null text counts as empty and is plain with no code points; a null doc_id draws like an
empty one; rows that repeat a doc_id are cut at the same places of their own texts; texts of any
length take one pass and no copy but the output; an empty table gives an empty result; extra columns are
carried in ``row``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

SEED = 1
KEEP_FROM = 90  # of 100 documents, those from here on stay plain
SUFFIX_FIRST = 20  # of 100 others, so many begin with the suffix
TEXT, MARKS = 0, 1
SENTINELS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Places of the table that is cut: prefix, middle, suffix, then the sentinels in their order.
ORDERS = {PLAIN: (0, 1, 2), PSM: (3, 0, 4, 2, 5, 1), SPM: (4, 2, 3, 0, 5, 1)}
_MARKS = b"".join(SENTINELS)
Piece = tuple[int, int, int]

PIECES = ArrayType(StructType([StructField("buffer", IntegerType()), StructField("start", LongType()), StructField("length", LongType())]))
PLAN = StructType([StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()), StructField("pieces", PIECES)])
PROOF = StructType([StructField("output_sha256", StringType()), StructField("restored_sha256", StringType())])
_PROOF = pa.struct([("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
_PLAN = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("pieces", _PIECES)])


def split(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The table before and from byte ``at`` of what it spells; the descriptor that holds it is split."""
    left, right = [], []
    for buffer, start, length in pieces:
        head = min(max(at, 0), length)
        left += [(buffer, start, head)] * (head > 0)
        right += [(buffer, start + head, length - head)] * (head < length)
        at -= length
    return left, right


def arrange(groups: list[list[Piece]], order: tuple[int, ...]) -> list[Piece]:
    """The groups of descriptors, one after another in this order."""
    return [p for k in order for p in groups[k]]


def spelled(text: memoryview, pieces: list[Piece]) -> Iterator[memoryview]:
    """Views of the bytes that the table spells."""
    buffers = (text, memoryview(_MARKS))
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def digest(text: memoryview, pieces: list[Piece]) -> str:
    found = hashlib.sha256()
    for part in spelled(text, pieces):
        found.update(part)
    return found.hexdigest()


def _starts(raw: bytes) -> np.ndarray | range:
    """The byte at which each code point begins, and the end."""
    if raw.isascii():
        return range(len(raw) + 1)
    return np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))


def plan(raw: bytes, draws: tuple[int, int, int, int]) -> dict:
    """The form of a text and the table of its output, by four draws: two cuts, plain or not, which order."""
    at = _starts(raw)
    n = len(at) - 1
    if not n or draws[2] % 100 >= KEEP_FROM or any(s in raw for s in SENTINELS):
        return {"n": n, "form": PLAIN, "pieces": [(TEXT, 0, len(raw))]}
    first, second = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    rest, suffix = split([(TEXT, 0, len(raw))], int(at[second]))
    prefix, middle = split(rest, int(at[first]))
    groups, marks = [prefix, middle, suffix], [(MARKS, 0, len(_MARKS))]
    for s in SENTINELS:
        mark, marks = split(marks, len(s))
        groups.append(mark)
    form = SPM if draws[3] % 100 < SUFFIX_FIRST else PSM
    return {"n": n, "form": form, "prefix_chars": first, "middle_chars": second - first, "pieces": arrange(groups, ORDERS[form])}


def undo(output: bytes, form: str) -> list[Piece]:
    """The table over an output that spells the text it was made of.

    A sentinel neither begins nor ends inside another, and the text holds none, so the first of each is its own.
    """
    if form == PLAIN:
        return [(TEXT, 0, len(output))]
    order, rest, at, groups = ORDERS[form], [(TEXT, 0, len(output))], 0, {}
    for k, place in enumerate(order):
        if place > 2:
            end = at + len(SENTINELS[place - 3])
        else:
            end = output.index(SENTINELS[order[k + 1] - 3], at) if k + 1 < len(order) else len(output)
        groups[place], rest = split(rest, end - at)
        at = end
    return arrange(groups, ORDERS[PLAIN])


def _table(column: pa.ListArray) -> Iterator[list[Piece]]:
    flat = column.flatten()
    rows = list(zip(*(flat.field(k).to_pylist() for k in range(3))))
    at = 0
    for n in column.value_lengths().to_pylist():
        yield rows[at : at + n]
        at += n


@F.arrow_udf(PLAN)
def _plan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for keys, texts in batches:
        draws = ([int(k[8 * i : 8 * i + 8], 16) for i in range(4)] for k in keys.to_pylist())
        yield pa.array([plan(raw.as_py(), d) for raw, d in zip(texts, draws)], _PLAN)


@F.arrow_udf(PIECES)
def _undo(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for outputs, forms in batches:
        yield pa.array([undo(x.as_py(), f) for x, f in zip(outputs, forms.to_pylist())], _PIECES)


@F.arrow_udf(BinaryType())
def _spell(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, pieces in batches:
        yield pa.array([b"".join(spelled(memoryview(raw.as_py()), p)) for raw, p in zip(texts, _table(pieces))], pa.binary())


@F.arrow_udf(PROOF)
def _proof(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, pieces, forms in batches:
        yield pa.array([_both(raw.as_py(), p, f) for raw, p, f in zip(texts, _table(pieces), forms.to_pylist())], _PROOF)


def _both(raw: bytes, pieces: list[Piece], form: str) -> dict:
    output = b"".join(spelled(memoryview(raw), pieces))
    return {"output_sha256": digest(memoryview(raw), pieces), "restored_sha256": digest(memoryview(output), undo(output, form))}


def spell(text: Column, pieces: Column) -> Column:
    """The UTF-8 bytes that a table over ``text`` (UTF-8 bytes) spells."""
    return _spell(text, pieces)


def restoring(output: Column, form: Column) -> Column:
    """The table over ``output`` that spells the original."""
    return _undo(output, form)


def proof(text: Column, pieces: Column, form: Column) -> Column:
    """SHA-256 of the output, streamed from its table, and of what the output and its form restore (see ``PROOF``)."""
    return _proof(text, pieces, form)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``docs`` as struct ``row`` with ``body`` (the text's UTF-8 bytes) and ``plan``: ``n, form, prefix_chars, middle_chars, pieces``.

    ``spell("body", "plan.pieces")`` is the output. ``keep`` names the columns of ``row``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
    body = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8").alias("body")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256).alias("key")
    return docs.select(row, body, key).select("row", "body", _plan("key", "body").alias("plan"))
