"""Which way up a page is, and how far it is turned."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.geometry import DEAD_BAND


def pick_rotation(scores: DataFrame, keys: list[str], rotation: str, score: str) -> DataFrame:
    """The rotation of the best score, the smaller on a tie; 0 by method ``none`` unless the score is above 0."""
    best = F.max(F.struct(F.col(score).alias("score"), (-F.col(rotation)).alias("first"))).alias("b")
    picked = scores.groupBy(*keys).agg(best)
    sure = F.coalesce(F.col("b.score") > 0, F.lit(False))
    return picked.select(*keys, F.when(sure, -F.col("b.first")).otherwise(0).alias("rotation"), F.when(sure, "confidence").otherwise("none").alias("method"), F.col("b.score").alias("score"))


def skew(angles: Column) -> Column:
    """Exact median of near-horizontal segment angles, 0 within the dead band or without segments."""
    middle = F.coalesce(F.median(angles), F.lit(0.0))
    return F.when(F.abs(middle) >= DEAD_BAND, middle).otherwise(0.0)


def turn(image: np.ndarray, degrees: int) -> np.ndarray:
    """A quarter rotation; 90 is clockwise."""
    return np.rot90(image, {0: 0, 90: 3, 180: 2, 270: 1}[degrees % 360])


def estimate_skew(ink: np.ndarray, most: float = 5.0, step: float = 0.05) -> float:
    """The angle whose sheared row projection varies most: a deterministic search in place of sampled line voting."""
    ys, xs = np.nonzero(ink)
    if not len(ys):
        return 0.0
    def sharpness(angle: float) -> float:
        rows = np.rint(ys - (xs - xs.mean()) * np.tan(np.radians(angle))).astype(int)
        return float((np.bincount(rows - rows.min()).astype(float) ** 2).sum())

    coarse = np.arange(-most, most + 1e-9, 10 * step)
    near = max(coarse, key=sharpness)
    fine = np.arange(near - 10 * step, near + 10 * step + 1e-9, step)
    return float(round(max(fine, key=sharpness), 4))


def straighten(image: np.ndarray, angle: float) -> np.ndarray:
    """The page turned back about its centre, bilinear, edges repeated; unchanged within the dead band."""
    if abs(angle) < DEAD_BAND:
        return image
    h, w = image.shape[:2]
    a = np.radians(angle)
    y, x = np.mgrid[0:h, 0:w].astype(float)
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.clip((x - cx) * np.cos(a) - (y - cy) * np.sin(a) + cx, 0, w - 1)
    sy = np.clip((x - cx) * np.sin(a) + (y - cy) * np.cos(a) + cy, 0, h - 1)
    x0, y0 = np.minimum(sx.astype(int), w - 2), np.minimum(sy.astype(int), h - 2)
    fx, fy = sx - x0, sy - y0
    if image.ndim == 3:
        fx, fy = fx[..., None], fy[..., None]
    v = image.astype(float)
    out = v[y0, x0] * (1 - fx) * (1 - fy) + v[y0, x0 + 1] * fx * (1 - fy) + v[y0 + 1, x0] * (1 - fx) * fy + v[y0 + 1, x0 + 1] * fx * fy
    return np.rint(out).astype(image.dtype)


def best_rotation(scores: dict[int, float]) -> tuple[int, str]:
    """The twin of ``pick_rotation`` for the scores of one page."""
    best = max(sorted(scores), key=lambda r: scores[r], default=0)
    return (best, "confidence") if scores.get(best, 0) > 0 else (0, "none")


def normalize(image: np.ndarray, ink: Callable[[np.ndarray], np.ndarray], score: Callable[[np.ndarray], float] | None = None, osd: Callable[[np.ndarray], int | None] | None = None, contest: tuple[int, ...] = (0, 90, 180, 270)) -> tuple[np.ndarray, int, str, float]:
    """(page upright and level, rotation, method, skew): rotated, then its skew estimated and taken back.

    The rotation is what ``osd`` says, else that of the ``contest`` in which the page reads with most confidence
    (``score``), else 0.  The skew is 0 within the dead band.
    """
    rotation, method = osd(image) if osd else None, "osd"
    if rotation not in (0, 90, 180, 270):
        rotation, method = best_rotation({r: score(turn(image, r)) for r in contest} if score else {})
    upright = np.ascontiguousarray(turn(image, rotation))
    angle = estimate_skew(ink(upright))
    angle = angle if abs(angle) >= DEAD_BAND else 0.0
    return straighten(upright, angle), rotation, method, round(angle, 3)
