"""What a cell holds: nothing, a dash, or content; decided from its features by one expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CellRule:
    """The limits of the decision; the defaults are for cells scanned at 300 dpi."""

    empty_ink: float = 0.004
    least_area: float = 12
    least_cover: float = 0.002
    dash_ink: float = 0.12
    dash_aspect: float = 2.2
    dash_height: float = 0.35


def cell_kind(h: Column, w: Column, ink_ratio: Column, blobs: Column, rule: CellRule | None = None) -> Column:
    """``struct(kind, components)`` from a cell's size, share of ink and blobs (``area`` and box each).

    A cell of size 0, too little ink, no blob large enough or too little covered is ``empty`` (in the last case the
    blobs are still counted); one low, wide blob is a ``dash``; everything else is ``content``.
    """
    r = rule or CellRule()
    kept = F.filter(blobs, lambda b: b["area"] >= r.least_area)
    n = F.size(kept)
    cover = F.aggregate(kept, F.lit(0.0), lambda a, b: a + b["area"]) / (h * w)
    first = F.try_element_at(kept, F.lit(1))
    bw, bh = first["x1"] - first["x0"], first["y1"] - first["y0"]
    dash = (n == 1) & (ink_ratio < r.dash_ink) & (bh > 0) & (bw / F.nullif(bh, F.lit(0)) >= r.dash_aspect) & (bh / F.nullif(h, F.lit(0)) <= r.dash_height)
    out = lambda kind, count: F.struct(F.lit(kind).alias("kind"), count.cast("int").alias("components"))
    return (
        F.when((h * w == 0) | (ink_ratio < r.empty_ink) | (n == 0), out("empty", F.lit(0)))
        .when(cover < r.least_cover, out("empty", n))
        .when(dash, out("dash", F.lit(1)))
        .otherwise(out("content", n))
    )
