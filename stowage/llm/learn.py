"""Small models fitted on the driver over tables of bounded size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def logistic(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1e-3, rounds: int = 50
) -> np.ndarray:
    """Logistic regression by Newton's method; ``y`` may hold probabilities, the first column is not shrunk."""
    w = np.zeros(x.shape[1])
    mass = np.ones(len(y)) if weights is None else weights
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (mass * (y - p)) - shrink * w
        bend = (x * (mass * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> np.ndarray:
    """Logistic regression with an L1 penalty on all but the first column, by accelerated proximal steps."""
    n = max(1, len(y))
    step = 4.0 / max(1e-9, np.linalg.norm(x, 2) ** 2 / n)
    w = ahead = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        moved = ahead + step * (x.T @ (y - p)) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new[0] = moved[0]
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / later * (new - w)
        if np.abs(new - w).max() < 1e-7:
            return new
        w, t = new, later
    return w


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the identifier as text, modulo ``parts``; rows without an identifier count as remainder 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts, F.lit(0))


def bounded_sample(df: DataFrame, rows: int, total: int, *keys: str) -> DataFrame:
    """About ``rows`` of the ``total`` rows at most, chosen by a hash of ``keys``.

    Where equal keys have so many rows that twice as many would be chosen, any of them are.
    """
    if total <= rows:
        return df
    chosen = df.where(F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1 << 30)) < int(rows / total * (1 << 30)))
    return chosen.limit(2 * rows)
