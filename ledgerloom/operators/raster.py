"""Rasters: as pixel relations for small ones, as arrays in Arrow batches for scanned pages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Block and offset of the threshold, part of a side that makes a line, gap it may bridge; enlargement and margin
# of a crop, and the constant of its cubic convolution.
BLOCK, OFFSET, SCALE, BRIDGE = 25, 15, 40, 15
ENLARGE, PAD, CUBIC = 3, 12, -0.75


# Pixel relations -----------------------------------------------------------------------------------------------------
def to_pixels(df: DataFrame, key: str, values: str, width: int) -> DataFrame:
    """A flat array of values as ``(key, y, x, v)``."""
    return df.select(key, F.posexplode(values).alias("i", "v")).select(key, F.floor(F.col("i") / width).cast("int").alias("y"), (F.col("i") % width).alias("x"), "v")


def along(pixels: DataFrame, keys: list[str], axis: str, value: str, before: int, after: int, erode: bool) -> Column:
    """The least (erosion) or largest (dilation) value of the neighbours along one axis."""
    other = "y" if axis == "x" else "x"
    w = Window.partitionBy(*keys, other).orderBy(axis).rowsBetween(-before, after)
    return (F.min if erode else F.max)(value).over(w)


def open_along(pixels: DataFrame, keys: list[str], axis: str, value: str, out: str, half: int = 1) -> DataFrame:
    """Erosion followed by dilation along one axis: strokes shorter than ``2 * half + 1`` vanish."""
    eroded = pixels.withColumn("_e", along(pixels, keys, axis, value, half, half, True))
    return eroded.withColumn(out, along(eroded, keys, axis, "_e", half, half, False)).drop("_e")


def box_threshold(pixels: DataFrame, keys: list[str], value: str, offset: int) -> DataFrame:
    """``ink``: 1 where a whole-number value exceeds the mean of its 3 by 3 neighbourhood by ``offset``, in whole numbers."""
    cells = [F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    spread = pixels.select(*keys, "y", "x", value, F.explode(F.array(*cells)).alias("d"))
    sums = spread.groupBy(*keys, (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x")).agg(F.sum(value).alias("_sum"), F.count("*").alias("_n"))
    return pixels.join(sums, [*keys, "y", "x"]).select(*pixels.columns, (F.col(value) * F.col("_n") > F.col("_sum") + offset * F.col("_n")).cast("int").alias("ink"))


def quarter_turn(y: Column, x: Column, height: int, width: int, degrees: int) -> tuple[Column, Column]:
    """Where a pixel goes under a quarter rotation (90 is clockwise)."""
    return {0: (y, x), 90: (x, height - 1 - y), 180: (height - 1 - y, width - 1 - x), 270: (width - 1 - x, y)}[degrees]


# Arrays --------------------------------------------------------------------------------------------------------------
def gray(image: np.ndarray) -> np.ndarray:
    """Blue-green-red to grey by the usual weights; grey stays."""
    if image.ndim == 2:
        return image
    return np.clip(np.rint(image[..., :3].astype(float) @ np.array([0.114, 0.587, 0.299])), 0, 255).astype(np.uint8)


def _slide(a: np.ndarray, before: int, after: int, axis: int, lowest: bool, edge: int) -> np.ndarray:
    pad = [(0, 0)] * a.ndim
    pad[axis] = (before, after)
    view = np.lib.stride_tricks.sliding_window_view(np.pad(a, pad, constant_values=edge), before + after + 1, axis=axis)
    return view.min(axis=-1) if lowest else view.max(axis=-1)


def dilate(a: np.ndarray, height: int, width: int) -> np.ndarray:
    out = a
    for n, axis in ((height, 0), (width, 1)):
        if n > 1:
            out = _slide(out, n // 2, n - 1 - n // 2, axis, False, 0)
    return out


def erode(a: np.ndarray, height: int, width: int) -> np.ndarray:
    out = a
    for n, axis in ((height, 0), (width, 1)):
        if n > 1:
            out = _slide(out, n // 2, n - 1 - n // 2, axis, True, 255)
    return out


def binarize(image: np.ndarray, block: int = BLOCK, offset: int = OFFSET) -> np.ndarray:
    """Ink as 255: pixels darker than the Gaussian mean of their block by more than ``offset``; edges are repeated."""
    g = gray(image).astype(float)
    sigma = 0.3 * ((block - 1) * 0.5 - 1) + 0.8
    at = np.arange(block) - block // 2
    kernel = np.exp(-(at**2) / (2 * sigma * sigma))
    kernel /= kernel.sum()
    half = block // 2
    blurred = g
    for axis in (0, 1):
        pad = [(half, half) if i == axis else (0, 0) for i in (0, 1)]
        blurred = np.lib.stride_tricks.sliding_window_view(np.pad(blurred, pad, mode="edge"), block, axis=axis) @ kernel
    return np.where(g <= np.rint(blurred) - offset, 255, 0).astype(np.uint8)


def line_masks(ink: np.ndarray, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Long horizontal and vertical strokes, each bridged along its own direction."""
    h, w = ink.shape
    across, down = max(10, w // scale), max(10, h // scale)
    horizontal = dilate(erode(ink, 1, across), 1, across)
    vertical = dilate(erode(ink, down, 1), down, 1)
    return dilate(horizontal, 1, BRIDGE), dilate(vertical, BRIDGE, 1)


def lattice_mask(horizontal: np.ndarray, vertical: np.ndarray) -> np.ndarray:
    """The printed lines, thick enough to cover their soft edges."""
    return dilate(dilate(horizontal | vertical, 3, 3), 3, 3)


def without_lines(image: np.ndarray, lattice: np.ndarray) -> np.ndarray:
    """The page with its lines painted white, and the strokes they cut closed again."""
    out = np.where(lattice > 0, 255, gray(image)).astype(np.uint8)
    return erode(dilate(out, 3, 3), 3, 3)


def line_coordinates(mask: np.ndarray, axis: int, least: int, share: float = 0.30, merge: int = 12) -> list[int]:
    """Centres of the lines in a mask: strong projections, merged into runs, thinned (the array twin of ``boundaries``)."""
    profile = (mask > 0).sum(axis=axis)
    if not profile.size or profile.max() <= 0:
        return []
    hits = np.flatnonzero(profile > share * profile.max())
    runs = np.split(hits, np.flatnonzero(np.diff(hits) > merge) + 1)
    kept: list[int] = []
    for centre in (int(round(float(np.mean(r)))) for r in runs):
        if not kept or centre - kept[-1] >= least:
            kept.append(centre)
    return kept


def label_runs(mask: np.ndarray, diagonal: bool) -> tuple[np.ndarray, int]:
    """A number (from 1) for each connected part of a mask, 8-connected or 4-connected: runs of a row are joined, not pixels."""
    height, width = mask.shape
    label = np.zeros((height, width), np.int64)
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edges == 1)
    stop = np.nonzero(edges == -1)[1]
    parent = list(range(len(row)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(row, np.arange(height + 1))
    reach = 1 if diagonal else 0
    for y in range(1, height):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if start[i] < stop[j] + reach and start[j] < stop[i] + reach:
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
            if stop[i] < stop[j]:
                i += 1
            else:
                j += 1
    roots = np.array([root(i) for i in range(len(row))], dtype=np.int64)
    found, number = np.unique(roots, return_inverse=True)
    flat = np.repeat(row * width + start, stop - start) + _ramp(stop - start)
    label.reshape(-1)[flat] = np.repeat(number + 1, stop - start)
    return label, len(found)


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. for each length in turn."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def components(mask: np.ndarray) -> list[tuple[float, int, int, int, int]]:
    """Each 8-connected blob: area enclosed by its outer border, and its box (y0, x0, height, width).

    The area is that of the polygon through the centres of the border pixels, holes filled: by bit quads (Gray
    1971) one for each 2 by 2 block that is full, one half for each with three pixels.
    """
    label, n = label_runs(mask > 0, True)
    if not n:
        return []
    ys, xs = np.nonzero(label)
    at = label[ys, xs] - 1
    top, left = np.full(n, mask.shape[0]), np.full(n, mask.shape[1])
    bottom, right = np.zeros(n, int), np.zeros(n, int)
    np.minimum.at(top, at, ys)
    np.minimum.at(left, at, xs)
    np.maximum.at(bottom, at, ys)
    np.maximum.at(right, at, xs)
    out = []
    for k in range(n):
        own = np.pad(label[top[k] : bottom[k] + 1, left[k] : right[k] + 1] == k + 1, 1)
        ground, _ = label_runs(~own, False)
        filled = (ground != ground[0, 0]).astype(int)
        quads = filled[:-1, :-1] + filled[1:, :-1] + filled[:-1, 1:] + filled[1:, 1:]
        out.append((float((quads == 4).sum() + 0.5 * (quads == 3).sum()), int(top[k]), int(left[k]), int(bottom[k] - top[k] + 1), int(right[k] - left[k] + 1)))
    return out


def enlarge(image: np.ndarray, scale: int) -> np.ndarray:
    """A grey image ``scale`` times as large by cubic convolution (a = -0.75), edges repeated."""
    out = image.astype(float)
    for axis in (0, 1):
        n = out.shape[axis]
        at = (np.arange(n * scale) + 0.5) / scale - 0.5
        base = np.floor(at).astype(int)
        t = at - base
        total = 0.0
        for k in range(-1, 3):
            d = np.abs(t - k)
            weight = np.where(d <= 1, (CUBIC + 2) * d**3 - (CUBIC + 3) * d**2 + 1, CUBIC * d**3 - 5 * CUBIC * d**2 + 8 * CUBIC * d - 4 * CUBIC)
            shape = (-1, 1) if axis == 0 else (1, -1)
            total = total + out.take(np.clip(base + k, 0, n - 1), axis=axis) * weight.reshape(shape)
        out = total
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def prepare(crop: np.ndarray, scale: int = ENLARGE, pad: int = PAD) -> np.ndarray:
    """A cell's crop as a recognizer wants it: enlarged, with a white margin; an empty one stays empty."""
    return np.pad(enlarge(gray(crop), scale), pad, constant_values=255) if crop.size else crop


def draw_overlay(image: np.ndarray, ys: list[int], xs: list[int]) -> np.ndarray:
    """The page in colour with its lattice: red rows, blue columns, a green box 2 pixels inside each cell."""
    out = np.repeat(gray(image)[..., None], 3, axis=2)
    for y in ys:
        out[max(0, y - 1) : y + 1] = (255, 0, 0)
    for x in xs:
        out[:, max(0, x - 1) : x + 1] = (0, 0, 255)
    for y0, y1 in zip(ys, ys[1:]):
        for x0, x1 in zip(xs, xs[1:]):
            top, bottom, left, right = y0 + 2, y1 - 2, x0 + 2, x1 - 2
            if top <= bottom and left <= right:
                for box in ((top, slice(left, right + 1)), (bottom, slice(left, right + 1)), (slice(top, bottom + 1), left), (slice(top, bottom + 1), right)):
                    out[box] = (0, 200, 0)
    return out


def png(image: np.ndarray) -> bytes:
    """A grey or colour image as a PNG file."""
    import struct
    import zlib

    height, width = image.shape[:2]
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    lines = np.pad(image.reshape(height, -1), ((0, 0), (1, 0))).astype(np.uint8).tobytes()
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


FEATURES = "key long, h int, w int, ink_ratio double, blobs array<struct<area:double,x0:int,y0:int,x1:int,y1:int>>"


def cell_features(df: DataFrame, key: str, ink: str, width: int) -> DataFrame:
    """Features of small rasters given as flat arrays of 0 and 1 (schema ``FEATURES``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, flat in zip(pdf["k"], pdf["v"]):
                mask = np.asarray(flat, dtype=int).reshape(-1, width) if flat is not None and len(flat) else np.zeros((0, width), int)
                blobs = [{"area": a, "x0": x, "y0": y, "x1": x + w, "y1": y + h} for a, y, x, h, w in components(mask)]
                rows.append((k, mask.shape[0], width, float((mask > 0).mean()) if mask.size else 0.0, blobs))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ("key long", "h int", "w int", "ink_ratio double", "blobs x")])

    return df.select(F.col(key).cast("long").alias("k"), F.col(ink).alias("v")).mapInPandas(run, FEATURES)


def page_lattice(image: np.ndarray) -> dict:
    """Everything a page's raster gives in one pass: lines, ink without lines, page without lines."""
    ink = binarize(image)
    horizontal, vertical = line_masks(ink)
    lattice = lattice_mask(horizontal, vertical)
    return {
        "ys": line_coordinates(horizontal, 1, 12),
        "xs": line_coordinates(vertical, 0, 18),
        "content": np.where(lattice > 0, 0, ink).astype(np.uint8),
        "delined": without_lines(image, lattice),
    }
