"""Isotonic calibration shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def isotonic_fit(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (x, value) of the non-decreasing fit."""
    if not len(x):
        return np.array([]), np.array([])
    x, back = np.unique(x, return_inverse=True)          # equal scores are one point
    y = np.bincount(back, y * w) / np.bincount(back, w)
    w = np.bincount(back, w)
    means: list[float] = []
    weights: list[float] = []
    spans: list[tuple[float, float]] = []
    for xi, yi, wi in zip(x, y, w):
        means.append(float(yi))
        weights.append(float(wi))
        spans.append((float(xi), float(xi)))
        while len(means) > 1 and means[-2] >= means[-1]:
            total = weights[-2] + weights[-1]
            means[-2:] = [(means[-2] * weights[-2] + means[-1] * weights[-1]) / total]
            weights[-2:] = [total]
            spans[-2:] = [(spans[-2][0], spans[-1][1])]
    xs = [v for s in spans for v in s]
    ys = [m for m in means for _ in range(2)]
    return np.array(xs), np.array(ys)


def isotonic_apply(knots: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    if not len(knots[0]):
        return np.full(len(x), 0.5)
    return np.clip(np.interp(x, knots[0], knots[1]), 0.0, 1.0)


def isotonic_from_frame(scored: DataFrame, bins: int = 1000, low: float = -1.0, high: float = 2.0):
    """Fit on (raw double, label int) rows of any number: equal-width bins are
    counted by Spark, at most ``bins`` rows reach the driver."""
    b = F.floor((F.greatest(F.least("raw", F.lit(high)), F.lit(low)) - low) / ((high - low) / bins))
    rows = (scored.groupBy(b.alias("bin")).agg(F.avg("raw").alias("x"), F.avg("label").alias("y"),
                                               F.count("*").alias("w")).collect())
    if not rows:
        return np.array([]), np.array([])
    x, y, w = (np.array([float(r[c]) for r in rows]) for c in ("x", "y", "w"))
    return isotonic_fit(x, y, w)
