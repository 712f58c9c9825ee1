"""Recognizers: the one point where the engine is extended.

A provider turns cells into readings; it is given content cells only, since a UDF inside a CASE would be run
for every row.  Whatever it returns is written once (``recognize``), because several results are read from it.
"""

from __future__ import annotations

import shutil
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip
from ledgerloom.session import cut

CELL = ["file", "page", "row", "col"]
READING = "file string, page int, row int, col int, text string, confidence double, engine string, seconds double"
_PLACES = ("/usr/bin/tesseract", "/usr/local/bin/tesseract", "/opt/homebrew/bin/tesseract")


class Provider(Protocol):
    """Readings for cells: one row per cell, empty text and confidence 0 where nothing could be read."""

    name: str

    def recognize(self, cells: DataFrame) -> DataFrame: ...


class ReplayProvider:
    """Readings taken from a table, for tests and for pages read before."""

    name = "replay"

    def __init__(self, readings: DataFrame):
        self.readings = readings

    def recognize(self, cells: DataFrame) -> DataFrame:
        stored = self.readings.select(*CELL, F.col("text").alias("_t"), F.col("confidence").alias("_c"), F.col("engine").alias("_e"))
        joined = cells.select(*CELL).join(stored, CELL, "left")
        return joined.select(*CELL, F.coalesce("_t", F.lit("")).alias("text"), F.coalesce("_c", F.lit(0.0)).alias("confidence"), F.coalesce("_e", F.lit(self.name)).alias("engine"))


#: A text block of a page: (text, confidence 0..1, x0, y0, x1, y1).
Block = tuple[str, float, int, int, int, int]


def blocks_text(blocks: list[Block]) -> tuple[str, float]:
    """The texts of a page's blocks in reading order, joined by spaces, and their mean confidence (0 for none)."""
    kept = [b for b in blocks or [] if b[0].strip() and b[1] >= 0]
    return " ".join(b[0].strip() for b in kept), sum(b[1] for b in kept) / len(kept) if kept else 0.0


class FunctionProvider:
    """Any Python function of (crop, numeric) to (text, confidence 0..1), run in Arrow batches.

    A crop is a grey array, enlarged and with a white margin unless ``prepared`` is False.  ``read_page``, of a grey
    array to its text blocks, reads header bands and decides which way up a page is; ``osd``, of a grey array to a
    rotation or None, is asked first.  A cell without crop, or one on which the function raises, reads as empty with
    confidence 0.  ``cells`` must have the columns ``crop`` (grey bytes), ``h``, ``w`` and ``numeric``.
    """

    def __init__(self, name: str, read, read_page=None, osd=None, prepared: bool = True):
        self.name, self.read, self.read_page, self.osd, self.prepared = name, read, read_page, osd, prepared

    def recognize(self, cells: DataFrame) -> DataFrame:
        name, read, prepared = self.name, self.read, self.prepared

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import numpy as np

            from ledgerloom.operators.raster import prepare

            for pdf in batches:
                out = []
                for crop, h, w, numeric in zip(pdf["crop"], pdf["h"], pdf["w"], pdf["numeric"]):
                    began = time.perf_counter()
                    try:
                        image = np.frombuffer(crop, np.uint8).reshape(int(h), int(w)) if crop else None
                        text, confidence = ("", 0.0) if image is None or not image.size else read(prepare(image) if prepared else image, bool(numeric))
                    except Exception:  # a reader's failure is an empty reading, never a failed job
                        text, confidence = "", 0.0
                    out.append((text or "", float(confidence), time.perf_counter() - began))
                yield pdf[CELL].assign(text=[t for t, _, _ in out], confidence=[c for _, c, _ in out], engine=name, seconds=[s for _, _, s in out])

        return cells.select(*CELL, "crop", "h", "w", "numeric").mapInPandas(run, READING)


class TesseractProvider(FunctionProvider):
    """The external recognizer of that name, one process a crop, fed and read through pipes.

    Language, line mode and binary are options; the binary is looked for on the machine that reads, when it first does.
    """

    def __init__(self, lang: str = "eng", psm: int = 7, binary: str | None = None, timeout: float = 120.0):
        super().__init__("tesseract", self.read_cell, self.read_blocks, self.read_rotation)
        self.lang, self.psm, self.binary, self.timeout = lang, psm, binary, timeout

    def call(self, image, *flags: str) -> str:
        import subprocess

        self.binary = self.binary or find_binary()
        data = b"P5 %d %d 255\n" % (image.shape[1], image.shape[0]) + image.tobytes()
        done = subprocess.run([self.binary, "stdin", "stdout", "-l", self.lang, *flags], input=data, capture_output=True, timeout=self.timeout, check=True)
        return done.stdout.decode("utf-8", "replace")

    def words(self, image, psm: int, numeric: bool) -> list[Block]:
        flags = ["--psm", str(psm), "--oem", "3", *(["-c", "tessedit_char_whitelist=0123456789"] if numeric else []), "tsv"]
        lines = self.call(image, *flags).splitlines()
        names = lines[0].split("\t") if lines else []
        out = []
        for line in lines[1:]:
            row = dict(zip(names, line.split("\t", len(names) - 1)))
            text, confidence = row.get("text", "").strip(), float(row.get("conf") or -1)
            if text and confidence >= 0:
                x, y, w, h = (int(row[c]) for c in ("left", "top", "width", "height"))
                out.append((text, confidence / 100, x, y, x + w, y + h))
        return out

    def read_cell(self, image, numeric: bool) -> tuple[str, float]:
        return blocks_text(self.words(image, self.psm, numeric))

    def read_blocks(self, image) -> list[Block]:
        return self.words(image, 6, False)

    def read_rotation(self, image) -> int | None:
        import re

        found = re.search(r"^Rotate: *(\d+)", self.call(image, "--psm", "0"), re.MULTILINE)
        return int(found.group(1)) % 360 if found else None


def find_binary(name: str = "tesseract", places: tuple[str, ...] = _PLACES) -> str:
    """An external recognizer's binary: on the path, else in the usual places, else an error."""
    from pathlib import Path

    found = shutil.which(name) or next((p for p in places if Path(p).is_file()), None)
    if not found:
        raise FileNotFoundError(f"{name} is neither on the path nor in {places}")
    return found


#: Recognizers by name, for the command line; a new one is added here.
ENGINES: dict[str, Callable[..., Provider]] = {"tesseract": TesseractProvider}


def engine(name: str, **options: object) -> Provider:
    """The recognizer of that name, built with its options; an unknown name is an error that says which there are."""
    if name not in ENGINES:
        raise ValueError(f"no engine {name!r}; there are {sorted(ENGINES)}")
    return ENGINES[name](**options)


def recognize(facts: DataFrame, provider: Provider, kind: str = "kind") -> DataFrame:
    """Readings of the content cells only, written once before they are used by rows, review and page counts."""
    return cut(provider.recognize(facts.where(F.col(kind) == "content")))


def readable(text: Column, conf: Column) -> Column:
    """Whether a word a recognizer gives counts: it is not blank and its confidence not negative."""
    return (F.length(strip(text)) > 0) & (conf >= 0)


def words_to_reading(words: str) -> tuple:
    """(text, confidence) of an array of ``struct(text, conf)``: words that are blank or have negative confidence
    are left out, the rest joined by spaces, their mean confidence scaled from 100 to 1 (0 if none)."""
    kept = F.filter(words, lambda w: readable(w["text"], w["conf"]))
    n = F.size(kept)
    mean = F.aggregate(kept, F.lit(0.0), lambda a, w: a + w["conf"]) / n / 100
    return F.array_join(F.transform(kept, lambda w: strip(w["text"])), " "), F.when(n > 0, mean).otherwise(0.0)
