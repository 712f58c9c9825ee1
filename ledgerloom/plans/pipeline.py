"""Pages to rows, end to end, and the command line around it."""

from __future__ import annotations

import argparse
import importlib
import re
import sys
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.geometry import inset_box
from ledgerloom.functions.text import HEADER_BAND
from ledgerloom.operators.assemble import apply_checks, cell_values, nested_pages, page_counts, review_queue, rows_out, summary_lines
from ledgerloom.operators.classify import CellRule, cell_kind
from ledgerloom.operators.providers import ENGINES, Provider, blocks_text, engine, recognize
from ledgerloom.operators.templates import TEMPLATES, Template, bind_columns, form_of, keywords_of, load_templates, template_tables
from ledgerloom.session import cut
from ledgerloom.sources.files import list_files, pick_largest, read_pages, route, write_bytes, write_documents

CELL = (
    "row int, col int, x0 int, y0 int, x1 int, y1 int, h int, w int, ink_ratio double, "
    "blobs array<struct<area:double,x0:int,y0:int,x1:int,y1:int>>, crop binary"
)
#: What one pass over a page's raster gives.
SCANNED = (
    "file string, page int, orientation_applied int, orientation_method string, skew_deg double, grid_rows int, grid_cols int, "
    f"text string, engine string, seconds double, cells array<struct<{CELL}>>"
)
FACTS = ["orientation_applied", "orientation_method", "skew_deg", "grid_rows", "grid_cols", "engine", "seconds"]


def scan_pages(pages: DataFrame, provider: Provider | None = None, debug: str | None = None) -> DataFrame:
    """Each scanned page turned upright and straightened, with its header text and its cells (schema ``SCANNED``).

    ``pages`` has file, page and ``image`` (height, width, data: grey bytes, or blue-green-red).  The provider's ``osd``
    and ``read_page`` decide which way up a page is, ``read_page`` reads its header band; without them a page is taken as
    upright, and its ``text`` is null.  A page without lattice or image has no cells and comes out all the same.
    With ``debug``, a folder all executors share, the lattice of each page is drawn there.
    """
    name, reader, osd = (getattr(provider, k, None) for k in ("name", "read_page", "osd"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        from ledgerloom.operators.orient import normalize
        from ledgerloom.operators.raster import binarize, components, draw_overlay, gray, page_lattice, png

        columns = ["file", "page", "orientation_applied", "orientation_method", "skew_deg", "grid_rows", "grid_cols", "text", "engine", "seconds", "cells"]

        def read(image: np.ndarray) -> tuple[str, float]:
            try:
                return blocks_text(reader(image))
            except Exception:  # as for cells: a reader's failure is an empty reading
                return "", 0.0

        def seen(image: np.ndarray) -> int | None:
            try:
                return osd(image)
            except Exception:
                return None

        for pdf in batches:
            for file, page, image in zip(pdf["file"], pdf["page"], pdf["image"]):
                began = time.perf_counter()
                if image is None or image["data"] is None:
                    yield pd.DataFrame([(file, page, 0, "none", 0.0, 0, 0, None, name, 0.0, [])], columns=columns)
                    continue
                h, w = int(image["height"]), int(image["width"])
                raw = np.frombuffer(image["data"], np.uint8)
                raw = raw.reshape(h, w) if raw.size == h * w else gray(raw.reshape(h, w, -1))
                raster, rotation, method, angle = normalize(raw, binarize, (lambda a: read(a)[1]) if reader else None, seen if osd else None)
                found = page_lattice(raster)
                xs, ys, cells = found["xs"], found["ys"], []
                for r in range(len(ys) - 1):
                    for c in range(len(xs) - 1):
                        left, top, right, bottom = inset_box(xs[c], ys[r], xs[c + 1], ys[r + 1])
                        ink = found["content"][top:bottom, left:right]
                        blobs = [{"area": a, "x0": x, "y0": y, "x1": x + dx, "y1": y + dy} for a, y, x, dy, dx in components(ink)]
                        crop = found["delined"][top:bottom, left:right].tobytes()
                        cells.append({"row": r, "col": c, "x0": xs[c], "y0": ys[r], "x1": xs[c + 1], "y1": ys[r + 1], "h": ink.shape[0], "w": ink.shape[1], "ink_ratio": float((ink > 0).mean()) if ink.size else 0.0, "blobs": blobs, "crop": crop})
                band = found["delined"][: max(1, int(len(raster) * HEADER_BAND))]
                text = read(band)[0] if reader else None
                if debug is not None:
                    stem = re.sub(r"\.[^./]*$", "", file)
                    write_bytes(debug, f"{stem}_p{page}_grid.png".replace(" ", "_"), png(draw_overlay(raster, ys, xs)))
                row = (file, page, rotation, method, angle, max(0, len(ys) - 1), max(0, len(xs) - 1), text, name, time.perf_counter() - began, cells)
                yield pd.DataFrame([row], columns=columns)

    return pages.select("file", "page", "image").mapInPandas(run, SCANNED)


def page_cells(scanned: DataFrame) -> DataFrame:
    """Every cell of scanned pages with its features and its crop, and the form of its page where that is known."""
    form = ["form_id"] if "form_id" in scanned.columns else []
    return scanned.select("file", "page", *form, F.col("grid_rows").alias("n_rows"), F.col("grid_cols").alias("n_cols"), F.inline("cells"))


def scan_cells(pages: DataFrame, provider: Provider | None = None) -> DataFrame:
    """Every cell of every scanned page (``scan_pages``); a page without lattice has no cells."""
    return page_cells(scan_pages(pages, provider))


def process_pages(pages: DataFrame, provider: Provider, templates: list[Template] | tuple[Template, ...] = TEMPLATES, rule: CellRule | None = None, texts: DataFrame | None = None, debug: str | None = None) -> dict[str, DataFrame]:
    """Pages to rows, end to end: upright, straight, cells, header, form, readings, rows and documents.

    The scanned pages are written once, since cells and page facts are both read from them; the form is found in
    place, so no crop is shuffled to learn it.  ``texts`` (file, page, text) are pages read from their text layer,
    which stand in the documents beside the scanned ones.
    """
    scanned = cut(scan_pages(pages, provider, debug).withColumn("form_id", form_of(F.col("text"), keywords_of(templates))["form_id"]))
    return process(page_cells(scanned), scanned.drop("cells", "form_id"), provider, templates, rule, texts)


def process(cells: DataFrame, headers: DataFrame, provider: Provider, templates: list[Template] | tuple[Template, ...] = TEMPLATES, rule: CellRule | None = None, texts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Rows, review queue, page statistics and file documents from cells with features and header texts.

    ``cells`` is as ``page_cells`` gives it; ``headers`` has file, page and ``text``.  Only content cells
    reach the recognizer.  A page without header, or with a null one, is ``generic``; a page without cells keeps its
    place in meta and documents.  ``headers`` may have the page facts of ``scan_pages``, which are null where it has none.
    ``seconds`` adds those of the readings, where the provider states them, to those of the page.
    """
    spark = cells.sparkSession
    dims = template_tables(spark, templates)
    forms = headers.select("file", "page", form_of(F.col("text"), keywords_of(templates))["form_id"].alias("form_id"))
    kinds = cells.withColumn("kind", cell_kind(F.col("h"), F.col("w"), F.col("ink_ratio"), F.col("blobs"), rule)["kind"])
    if "form_id" not in cells.columns:
        kinds = kinds.join(forms, ["file", "page"], "left").withColumn("form_id", F.coalesce("form_id", F.lit("generic")))
    bound = bind_columns(kinds, dims["forms"], dims["columns"]).withColumn("numeric", F.col("type") == "integer")
    readings = recognize(bound, provider)
    values = cell_values(bound.drop("crop", "blobs", "numeric"), readings, dims["forms"])
    rows = apply_checks(rows_out(values), [(t.form_id, target, list(parts)) for t in templates for target, parts in t.checks])
    totals = cells.groupBy("file", "page").agg(F.max("n_rows").alias("_rows"), F.max("n_cols").alias("_cols"), F.count("*").alias("cells_total"))
    checks = rows.groupBy("file", "page").agg(F.sum("passed").alias("checks_passed"), F.sum("failed").alias("checks_failed"))
    spent = (readings if "seconds" in readings.columns else readings.withColumn("seconds", F.lit(None).cast("double"))).groupBy("file", "page").agg(F.sum("seconds").alias("_spent"))
    kinds_of = dict(c.split(" ")[:2] for c in SCANNED.split(", cells")[0].split(", "))
    given = [F.col(c) if c in headers.columns else F.lit(None).cast(kinds_of[c]).alias(c) for c in FACTS]
    facts = headers.select("file", "page", F.substring("text", 1, 200).alias("matched_header_text"), *given).join(forms, ["file", "page"]).join(totals, ["file", "page"], "full")
    for part in (page_counts(values).drop("form_id"), checks, spent):
        facts = facts.join(part, ["file", "page"], "left")
    counted = ["cells_total", "cells_empty", "cells_dash", "cells_ocr", "cells_low_confidence", "mean_ocr_confidence", "checks_passed", "checks_failed"]
    grid = [F.coalesce(a, b, F.lit(0)).alias(a) for a, b in (("grid_rows", "_rows"), ("grid_cols", "_cols"))]
    seconds = F.round(F.when(F.col("seconds").isNotNull() | F.col("_spent").isNotNull(), F.coalesce("seconds", F.lit(0.0)) + F.coalesce("_spent", F.lit(0.0))), 1)
    meta = facts.fillna(0, counted).select(
        "file", "page", F.coalesce("form_id", F.lit("generic")).alias("form_id"), "orientation_applied", "orientation_method", "skew_deg", *grid, *counted[:6],
        "matched_header_text", *counted[6:], F.coalesce("engine", F.lit(provider.name)).alias("engine"), seconds.alias("seconds"),
    )
    review = review_queue(values)
    integers = {t.form_id: [k for k, kind, _ in t.columns if kind == "integer"] for t in templates}
    return {"values": values, "rows": rows, "review": review, "meta": meta, "documents": nested_pages(rows, review, meta, texts, integers)}


def load_function(name: str) -> Callable:
    """``module:function``; its module is sent to the executors, so it need not be installed there."""
    module, _, function = name.partition(":")
    loaded = importlib.import_module(module)
    if not module.startswith("ledgerloom."):
        cloudpickle.register_pickle_by_value(loaded)
    return getattr(loaded, function)


def run_files(spark: SparkSession, path: str, out: str, provider: Provider, parse: Callable, templates: list[Template] | tuple[Template, ...] = TEMPLATES, debug: bool = False) -> Iterator[str]:
    """Every PDF at ``path`` to ``<stem>.json`` below ``out``; yields one line of text a page, file and failure.

    Files are isolated: one that cannot be parsed is stated and the others go on.  Pages with a text layer are kept as
    text, the others scanned.  Raises ``FileNotFoundError`` where there is no such path or no PDF under it.
    """
    files = list_files(spark, path)
    if files.isEmpty():
        raise FileNotFoundError(f"no PDFs under {path}")
    pages = cut(read_pages(files, parse))
    texts, scans = route(pages.where("error is null"))
    image = pick_largest(scans).select("file", "page", F.when(F.col("image").isNotNull(), F.struct("image.height", "image.width", "image.data")).alias("image"))
    done = process_pages(image, provider, templates, texts=texts.select("file", "page", "text"), debug=f"{out}/debug" if debug else None)
    written = cut(write_documents(done["documents"], out))
    counts = done["meta"].join(done["rows"].groupBy("file", "page").agg(F.count("*").alias("n_rows_out")), ["file", "page"], "left").join(done["review"].groupBy("file", "page").agg(F.count("*").alias("n_review")), ["file", "page"], "left")
    lines = summary_lines(counts).unionByName(texts.select("file", "page", F.format_string("p%d: text layer, %d chars", "page", F.length("text")).alias("line")))
    lines = lines.unionByName(pages.where("error is not null").select("file", "page", F.concat(F.lit("FAILED: "), "error").alias("line")))
    lines = lines.unionByName(written.select("file", F.lit(2**31 - 1).alias("page"), F.concat(F.lit("-> "), "target").alias("line")))
    for r in lines.orderBy("file", "page").toLocalIterator():
        yield f"{r['file']}: {r['line']}"


def main(args: list[str] | None = None) -> int:
    """``run PATH --out FOLDER --engine NAME --debug``: PDFs to result documents.  ``flatten PATH --out FOLDER``: result
    documents of Parquet files to child tables.

    Returns 1 where the path is missing, holds no PDF, or the engine or parser is not there; else 0, even if single files fail.
    """
    from ledgerloom.operators.flatten import emit, write_children
    from ledgerloom.session import local_session

    parser = argparse.ArgumentParser(prog="ledgerloom")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="read the PDFs of a folder, or one, into result documents")
    run.add_argument("--engine", default="tesseract", choices=sorted(ENGINES))
    run.add_argument("--parser", default="ledgerloom.sources.pdf:parse_pdf", help="module:function of file bytes to (text, images) of each page")
    run.add_argument("--templates", help="a folder of YAML templates")
    run.add_argument("--debug", action="store_true", help="also draw the lattice of each page")
    flat = commands.add_parser("flatten", help="flatten the result documents of a folder of Parquet files")
    for command in (run, flat):
        command.add_argument("path")
        command.add_argument("--out", default="out")
    given = parser.parse_args(args)
    try:
        if "://" not in given.path and not Path(given.path).exists():
            raise FileNotFoundError(f"{given.path} does not exist")
        spark = local_session("*")
        if given.command == "run":
            templates = load_templates(given.templates) if given.templates else TEMPLATES
            provider = engine(given.engine)
            print(f"engine: {provider.name}   templates: {len(templates)}")
            for line in run_files(spark, given.path, given.out, provider, load_function(given.parser), templates, given.debug):
                print(line, file=sys.stderr if ": FAILED: " in line else sys.stdout)
            return 0
        write_children(emit(spark.read.parquet(given.path)), given.out)
        for r in spark.read.parquet(given.out).groupBy("tag").count().orderBy("tag").collect():
            print(f"{r['tag']}: {r['count']}")
        return 0
    except (AnalysisException, FileNotFoundError, ImportError, AttributeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
