"""Geometry of cells, words and segments as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INSET, SCALE, PAD = 3, 3, 12
NEAR_HORIZONTAL, DEAD_BAND = 5.0, 0.15


def inset(x0: Column, y0: Column, x1: Column, y1: Column, by: int = INSET) -> dict[str, Column]:
    """The box inside a cell's printed lines, at least one pixel in each direction."""
    left, top = F.least(x0 + by, x1 - 1), F.least(y0 + by, y1 - 1)
    return {"cx0": left, "cy0": top, "cx1": F.greatest(x1 - by, left + 1), "cy1": F.greatest(y1 - by, top + 1)}


def inset_box(x0: int, y0: int, x1: int, y1: int, by: int = INSET) -> tuple[int, int, int, int]:
    """The twin of ``inset`` for plain numbers."""
    left, top = min(x0 + by, x1 - 1), min(y0 + by, y1 - 1)
    return left, top, max(x1 - by, left + 1), max(y1 - by, top + 1)


def recognizer_size(width: Column, height: Column) -> dict[str, Column]:
    """Size of a crop once it is scaled up and given a white margin."""
    return {"ocr_w": width * SCALE + 2 * PAD, "ocr_h": height * SCALE + 2 * PAD}


def box(left: Column, top: Column, width: Column, height: Column) -> Column:
    return F.struct(left.alias("x0"), top.alias("y0"), (left + width).alias("x1"), (top + height).alias("y1"))


def segment_angle(dx: Column, dy: Column) -> Column:
    return F.degrees(F.atan2(dy, dx))


def near_horizontal(angle: Column) -> Column:
    return F.abs(angle) <= NEAR_HORIZONTAL


def dead_band(angle: Column) -> Column:
    """No skew unless it is large enough to matter."""
    return F.when(F.abs(angle) >= DEAD_BAND, angle).otherwise(0.0)


def quarter_turn(degrees: Column) -> Column:
    """Degrees as one of 0, 90, 180, 270, else null."""
    turn = F.pmod(degrees, F.lit(360))
    return F.when(turn.isin(0, 90, 180, 270), turn)


def kernel_length(size: Column, scale: int = 40) -> Column:
    return F.greatest(F.lit(10), F.floor(size / scale).cast("int"))


def round_binary(value: Column, digits: int) -> Column:
    """The double rounded as its binary value says, exact halves to even: 0.0005 goes up or down by what it really holds.

    ``value * 10**digits`` is rounded itself; where it comes out as a half, what was rounded off decides.  It is had
    without error from the two halves of the value's digits.
    """
    scale = float(10**digits)
    p, split = value * scale, value * 134217729.0
    high = split - (split - value)
    off = (high * scale - p) + (value - high) * scale
    whole = F.floor(p)
    half = p - whole
    up = (half > 0.5) | ((half == 0.5) & ((off > 0) | ((off == 0) & (F.pmod(whole, F.lit(2)) == 1))))
    return F.when(F.isnan(value) | (F.abs(value) > 1e15 / scale), value).otherwise((whole + up.cast("int")) / scale)
