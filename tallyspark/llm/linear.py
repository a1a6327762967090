"""A softmax regression over sparse rows, fitted by Spark jobs that add up gradients."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def pack(column: pa.ListArray | pa.ChunkedArray):
    """Row lengths and flat values of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.diff(column.offsets.to_numpy()), flat


def scores(sizes, idx, val, weights: np.ndarray) -> np.ndarray:
    """Row x class sums of ``val * weights[idx]``."""
    ends = np.cumsum(sizes)
    parts = weights[idx] * val[:, None]
    total = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(parts, axis=0)])
    return total[ends] - total[ends - sizes]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _gradient_batches(weights: np.ndarray):
    def run(batches):
        grad, loss, n = np.zeros_like(weights), 0.0, 0.0
        for b in batches:
            sizes, idx = pack(b.column("idx"))
            _, val = pack(b.column("val"))
            _, want = pack(b.column("want"))
            want = want.reshape(-1, weights.shape[1])
            if not len(want):
                continue
            p = softmax(scores(sizes, idx, val, weights))
            total = want.sum(axis=1)
            loss -= float((want * np.log(np.maximum(p, 1e-12))).sum())
            diff = np.repeat(p * total[:, None] - want, sizes, axis=0) * val[:, None]
            for c in range(weights.shape[1]):
                grad[:, c] += np.bincount(idx, diff[:, c], len(weights))
            n += float(total.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([grad.tobytes()], pa.binary()), pa.array([loss]), pa.array([n])],
            ["grad", "loss", "n"])
    return run


def fit(rows: DataFrame, dim: int, classes: int, iterations: int = 25, step: float = 4.0,
        ridge: float = 1e-5, parts: int = 8) -> np.ndarray:
    """Weights (``dim`` x ``classes``) fitted to ``rows(idx array<int>, val array<double>,
    want array<double>)``: sparse features and the wanted mass of each class (soft labels,
    or row weights times one-hot ones). Rows should have norm 1.

    Accelerated gradient descent; each step is one job whose tasks send back one dense
    gradient each (``parts`` of them, ``dim x classes`` numbers: bounded). ``rows`` should be
    a bounded sample that has been stored. Without rows all weights are zero.
    """
    w = np.zeros((dim, classes))
    ahead, momentum = w, 1.0
    held = rows.coalesce(parts)
    for _ in range(iterations):
        sent = held.mapInArrow(_gradient_batches(ahead), "grad binary, loss double, n double")
        got = sent.collect()
        n = sum(r["n"] for r in got)
        if n <= 0:
            return w
        grad = sum(np.frombuffer(r["grad"]).reshape(dim, classes) for r in got) / n
        new = ahead - step * (grad + ridge * ahead)
        later = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = new + (momentum - 1) / later * (new - w)
        w, momentum = new, later
    return w
