"""Inputs and outputs: folders of files, page texts and images, result documents."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import TEXT_LAYER_CHARS, page_source, strip

PAGES = "file string, page int, text string, images array<struct<width:int,height:int,data:binary>>, error string"


def list_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """``(file, path, content)`` of a file as it is, or of all matching files below a folder.

    ``file`` is the path below the folder, so files of one name in different folders stay apart.  Each partition is in
    order of path; contents are not shuffled for it.  Raises ``FileNotFoundError`` where a local path doesn't exist.
    """
    if "://" not in path and not Path(path).exists():
        raise FileNotFoundError(path)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if "://" in path or Path(path).is_dir():
        reader = reader.option("pathGlobFilter", pattern)
    root = path.rstrip("/") if "://" in path else f"file:{Path(path).resolve()}"
    below = F.when(F.startswith("path", F.lit(root + "/")), F.substr("path", F.lit(len(root) + 2)))
    return reader.load(path).select(F.coalesce(below, F.element_at(F.split("path", "/"), -1)).alias("file"), "path", "content").sortWithinPartitions("path")


def read_pages(files: DataFrame, parse: Callable[[bytes], list[tuple[str, list[dict]]]]) -> DataFrame:
    """One row per page (schema ``PAGES``) by a parser of file bytes to (text, images) per page.

    Files are isolated: one on which the parser raises becomes one row with page -1 and the error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, content in zip(pdf["file"], pdf["content"]):
                try:
                    rows = [(file, i, text, images, None) for i, (text, images) in enumerate(parse(bytes(content)))]
                except Exception as e:  # the batch goes on, the failure is stated
                    rows = [(file, -1, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["file", "page", "text", "images", "error"])

    return files.select("file", "content").mapInPandas(run, PAGES)


def route(pages: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pages with a text layer, which need no recognition, and pages to be read as scans."""
    sourced = pages.withColumn("source", page_source(F.coalesce(F.col(text), F.lit(""))))
    return sourced.where("source = 'text'").withColumn(text, strip(F.col(text))), sourced.where("source = 'scan'")


def has_text_layer(pages: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    return pages.groupBy(file).agg(F.coalesce(F.bool_or(F.length(strip(F.col(text))) >= TEXT_LAYER_CHARS), F.lit(False)).alias("has_text"))


def largest_image(images: str):
    """The image of the largest area of an array, the first of equal ones; null for none."""
    ranked = F.transform(images, lambda x, i: F.struct((x["width"].cast("long") * x["height"]).alias("area"), (-i).alias("first"), x.alias("image")))
    return F.array_max(F.transform(ranked, lambda r: F.struct(r["area"], r["first"])))


def pick_largest(pages: DataFrame, images: str = "images", out: str = "image") -> DataFrame:
    """Pages with their largest embedded image, the first of equal ones; null where there is none."""
    at = -largest_image(images)["first"]
    return pages.withColumn(out, F.when(F.size(images) > 0, F.try_element_at(images, (at + 1).cast("int"))))


def write_results(files: DataFrame, folder: str, payload: str = "payload") -> None:
    """One JSON document per file, partitioned by file (equal names of different folders stay apart if ``file`` does)."""
    files.select("file", F.col(payload).alias("value")).write.mode("overwrite").partitionBy("file").text(folder)


def write_bytes(folder: str, name: str, data: bytes) -> str:
    """A file written whole or not at all, so that a task run twice leaves what one would; returns its path."""
    import uuid

    import pyarrow.fs as pafs

    fs, base = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), str(Path(folder).resolve()))
    target = f"{base}/{name}"
    fs.create_dir(target.rpartition("/")[0], recursive=True)
    part = f"{target}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, target)
    return target


def write_documents(documents: DataFrame, folder: str, payload: str = "payload") -> DataFrame:
    """One file ``<stem>.json`` per document, written by the tasks that hold them: ``(file, target)``, when it is run.

    ``folder`` must be shared by all executors.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for file, text in zip(pdf["file"], pdf["payload"]):
                stem = re.sub(r"\.[^./]*$", "", file)
                done.append((file, write_bytes(folder, f"{stem}.json", json.dumps(json.loads(text), indent=2, ensure_ascii=False).encode())))
            yield pd.DataFrame(done, columns=["file", "target"])

    return documents.select("file", F.col(payload).alias("payload")).mapInPandas(run, "file string, target string")
