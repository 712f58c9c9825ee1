"""From projections to the lattice of a page, and from the lattice to cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.sequence import consecutive, gap_merge, thin

#: Share of the strongest projection that makes a line; thickness of one line; least height and width of a cell.
PEAK, MERGE, MIN_H, MIN_W = 0.30, 12, 12, 18


def projection(pixels: DataFrame, keys: list[str], axis: str, ink: Column) -> DataFrame:
    """Ink pixels per position along ``axis`` (a column): keys, position, ``n``."""
    return pixels.groupBy(*keys, axis).agg(F.count_if(ink).alias("n"))


def peaks(profile: DataFrame, keys: list[str], share: float = PEAK) -> DataFrame:
    """Positions whose ink exceeds ``share`` of the page's strongest; none on a page without ink."""
    top = F.max("n").over(Window.partitionBy(*keys))
    return profile.withColumn("_top", top).where((F.col("_top") > 0) & (F.col("n") > share * F.col("_top"))).drop("_top")


def boundaries(peak_positions: DataFrame, keys: list[str], axis: str, least: int, merge: int = MERGE) -> DataFrame:
    """One sorted array of line centres per page: runs merged, then those too near the one kept before left out."""
    runs = gap_merge(peak_positions, keys, axis, merge)
    return runs.groupBy(*keys).agg(thin(F.array_sort(F.collect_list(F.col("centre").cast("int"))), least).alias("coords"))


def explode_cells(lattice: DataFrame, keys: list[str], xs: str = "xs", ys: str = "ys") -> DataFrame:
    """One row per cell of each page: keys, ``row``, ``col`` and its box.  Fewer than two lines give no cells."""
    rows = lattice.select(*keys, xs, F.posexplode(consecutive(F.col(ys))).alias("row", "y"))
    cells = rows.select(*keys, "row", "y", F.posexplode(consecutive(F.col(xs))).alias("col", "x"))
    return cells.select(*keys, "row", "col", F.col("x.start").alias("x0"), F.col("y.start").alias("y0"), F.col("x.end").alias("x1"), F.col("y.end").alias("y1"))


def overlay(lattice: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """What a debug picture draws: a line per boundary (``at``), a rectangle 2 px inside each cell."""
    blank = [F.lit(None).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")]
    lines = [lattice.select(*keys, F.lit(kind).alias("shape"), F.explode(F.col(c).cast("array<int>")).alias("at"), *blank) for c, kind in (("ys", "horizontal"), ("xs", "vertical"))]
    boxes = cells.select(*keys, F.lit("cell").alias("shape"), F.lit(None).cast("int").alias("at"), *[(F.col(c) + d).cast("int").alias(c) for c, d in (("x0", 2), ("y0", 2), ("x1", -2), ("y1", -2))])
    return lines[0].unionByName(lines[1]).unionByName(boxes)
