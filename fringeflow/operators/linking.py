"""Phase linking of coherence matrices in Arrow batches of centres.

The eigenvector of the inverse-weighted matrix whose eigenvalue lies nearest to ``mu`` is used; centres
whose magnitude matrix is not safely positive definite fall back to the largest eigenvector of the
magnitude-weighted matrix. Phases are referenced to one epoch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.operators.coherence import epoch_pairs

EVD, EMI, INVALID = 0, 1, 255
BATCH = 2048


def hermitian(pairs: np.ndarray, epochs: int) -> np.ndarray:
    """Matrices with unit diagonal from upper triangles, one a row."""
    out = np.zeros((len(pairs), epochs, epochs), complex)
    i, j = np.triu_indices(epochs, 1)
    out[:, i, j] = pairs
    out[:, j, i] = pairs.conj()
    out[:, range(epochs), range(epochs)] = 1
    return out


def link(matrices: np.ndarray, beta: float = 0.0, mu: float = 0.99, jitter: float = 1e-6, least: float = 1e-7, reference: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases, estimator codes and eigenvalues of a batch; phases of invalid matrices are NaN."""
    n = matrices.shape[1]
    phases = np.full((len(matrices), n), np.nan)
    codes = np.full(len(matrices), INVALID, np.int16)
    values = np.full(len(matrices), np.nan)
    whole = np.isfinite(matrices).all(axis=(1, 2))
    magnitude = np.abs(np.where(whole[:, None, None], matrices, np.eye(n)))
    eye = np.eye(n)
    weights = (1 - beta) * magnitude + beta * eye if beta > 0 else magnitude
    weights = (weights + weights.transpose(0, 2, 1)) / 2 + jitter * eye
    good = whole & (np.linalg.eigvalsh(weights)[:, 0] > least)

    def put(rows: np.ndarray, vectors: np.ndarray, found: np.ndarray, code: int) -> None:
        turned = np.angle(vectors) - np.angle(vectors[:, reference])[:, None]
        phases[rows], codes[rows], values[rows] = np.angle(np.exp(1j * turned)), code, found

    for rows, code in ((np.flatnonzero(good), EMI), (np.flatnonzero(whole & ~good), EVD)):
        if len(rows):
            side = np.linalg.inv(weights[rows]) if code == EMI else magnitude[rows]
            a = side * matrices[rows]
            lam, vec = np.linalg.eigh((a + a.conj().transpose(0, 2, 1)) / 2)
            pick = np.abs(lam - mu).argmin(axis=1) if code == EMI else lam.argmax(axis=1)
            put(rows, vec[np.arange(len(rows)), :, pick], lam[np.arange(len(rows)), pick], code)
    return phases, codes, values


def link_phases(rows: DataFrame, epochs: int, beta: float = 0.0, mu: float = 0.99) -> DataFrame:
    """``center_id, phase (array), estimator, eigenvalue`` from wide coherence rows."""
    pairs = epoch_pairs(epochs)
    flat = rows.select("center_id", F.array(*[f"cre_{i}_{j}" for i, j in pairs]).alias("re"), F.array(*[f"cim_{i}_{j}" for i, j in pairs]).alias("im"))
    return link_arrays(flat, epochs, beta, mu)


def link_arrays(flat: DataFrame, epochs: int, beta: float = 0.0, mu: float = 0.99) -> DataFrame:
    """``link_phases`` of ``center_id, re, im`` with arrays in the order of ``epoch_pairs``."""
    pairs = epoch_pairs(epochs)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), BATCH):
                part = whole.slice(at, BATCH)
                re, im = (np.array(part.column(k).to_pylist(), float).reshape(len(part), len(pairs)) for k in (1, 2))
                phases, codes, values = link(hermitian(re + 1j * im, epochs), beta, mu)
                yield pa.record_batch([part.column(0), pa.array(list(phases), pa.list_(pa.float64())), pa.array(codes, pa.int16()), pa.array(values)], ["center_id", "phase", "estimator", "eigenvalue"])

    return flat.mapInArrow(solve, "center_id long, phase array<double>, estimator short, eigenvalue double")


def combined_estimator(codes: DataFrame, key: str) -> DataFrame:
    """``key, estimator``: invalid if any stage is, else the fallback if any stage used it."""
    worst = F.when(F.max("estimator") == INVALID, INVALID).when(F.min("estimator") == EVD, EVD).otherwise(EMI)
    return codes.groupBy(key).agg(worst.cast("short").alias("estimator"))


def ds_selection(points: DataFrame, tc_min: float, pair_min: float, accept_fallback: bool = False) -> DataFrame:
    """Points that are no scatterer candidates already, were linked, and reach both quality limits."""
    linked = F.col("estimator").isin([EMI, EVD] if accept_fallback else [EMI])
    good = (F.col("tc") >= tc_min) & (F.col("median_coh") >= pair_min) & ~F.isnan("tc") & ~F.isnan("median_coh")
    return points.where(~F.col("ps") & linked & good)
