"""Ordered sequences: merging near neighbours, thinning, pairs, and the fold of ditto marks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gap_merge(df: DataFrame, keys: list[str], index: str, gap: int, order: list[str] | None = None) -> DataFrame:
    """Runs of indices no further than ``gap`` from the one before, with each run's rounded centre.

    Returns keys, ``run`` (from 0), ``first``, ``last``, ``n`` and ``centre`` (half to even).
    Null indices are left out.
    """
    w = Window.partitionBy(*keys).orderBy(*(order or [index]))
    step = F.col(index) - F.lag(index).over(w)
    marked = df.where(F.col(index).isNotNull()).withColumn("_new", F.when(step > gap, 1).otherwise(0))
    runs = marked.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "run").agg(
        F.min(index).alias("first"), F.max(index).alias("last"), F.count("*").alias("n"), F.bround(F.avg(index), 0).cast("long").alias("centre")
    )


def thin(coords: Column, least: int) -> Column:
    """Of a sorted array, the elements at least ``least`` after the one kept before (the first is kept)."""
    empty = F.slice(coords, 1, 0)
    return F.aggregate(coords, empty, lambda kept, c: F.when((F.size(kept) == 0) | (c - F.element_at(kept, -1) >= least), F.concat(kept, F.array(c))).otherwise(kept))


def thin_rows(df: DataFrame, keys: list[str], index: str, least: int) -> DataFrame:
    """``(keys, index)`` of the rows that ``thin`` keeps of each key, for sequences of any length.

    Rows are sorted by key and index and passed through once; only the last index kept is remembered, so neither a key
    nor a run of it is ever held.  Null indices are left out.
    """
    rows = df.where(F.col(index).isNotNull()).select(*keys, index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, last = None, None
        for pdf in batches:
            kept = []
            for at, (*key, value) in enumerate(pdf.itertuples(index=False, name=None)):
                key = [None if k != k else k for k in key]
                if key != before or value - last >= least:
                    kept.append(at)
                    last = value
                before = key
            yield pdf.iloc[kept]

    ordered = rows.repartition(*keys) if keys else rows.repartition(1)
    return ordered.sortWithinPartitions(*keys, index).mapInPandas(run, rows.schema)


def consecutive(coords: Column) -> Column:
    """Neighbouring pairs of an array as ``struct(start, end)``; none for fewer than two elements."""
    n = F.size(coords)
    return F.when(n < 2, F.expr("cast(array() as array<struct<start:int,end:int>>)")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(F.element_at(coords, i).cast("int").alias("start"), F.element_at(coords, i + 1).cast("int").alias("end")))
    )


def fold_ditto(cells: DataFrame, page: list[str], row: str, key: str, outcome: str, value: str, written: str) -> DataFrame:
    """Cells with ditto marks replaced by what the last emitted row holds; rows that hold nothing are left out.

    ``cells`` has one row per cell: ``outcome`` is ``ditto`` where the value is inherited, ``written`` says
    whether a value counts as written by hand (a ditto always does).  A row is emitted if any written
    value, inherited ones included, is not null; only then do its non-null values replace the state.
    Returns page, row and ``record`` (map key to value, nulls kept).  A page is bounded by its form,
    so its cells are folded in one array; cells are sorted, so order of arrival doesn't matter.
    """
    cell = F.struct(F.col(key).alias("k"), (F.col(outcome) == "ditto").alias("ditto"), F.col(value).cast("string").alias("v"), F.coalesce(F.col(written), F.lit(False)).alias("w"))
    rows = cells.groupBy(*page, row).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    pages = rows.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct(F.col(row).alias("row"), "cells"))).alias("rows"))
    start = F.struct(F.expr("cast(map() as map<string,string>)").alias("prev"), F.expr("cast(array() as array<struct<row:bigint,record:map<string,string>>>)").alias("out"))

    def step(state: Column, r: Column) -> Column:
        filled = F.transform(r["cells"], lambda c: F.struct(c["k"].alias("key"), F.when(c["ditto"], F.try_element_at(state["prev"], c["k"])).otherwise(c["v"]).alias("value"), (c["w"] | c["ditto"]).alias("w")))
        emitted = F.exists(filled, lambda c: c["w"] & c["value"].isNotNull())
        record = F.map_from_entries(F.transform(filled, lambda c: F.struct(c["key"], c["value"])))
        kept = F.map_filter(record, lambda _, v: v.isNotNull())
        after = F.struct(kept.alias("prev"), F.concat(state["out"], F.array(F.struct(r["row"].cast("long").alias("row"), record.alias("record")))).alias("out"))
        return F.when(emitted, after).otherwise(F.struct(state["prev"].alias("prev"), state["out"].alias("out")))

    folded = pages.select(*page, F.explode(F.aggregate("rows", start, step, lambda s: s["out"])).alias("r"))
    return folded.select(*page, F.col("r.row").alias(row), F.col("r.record").alias("record"))
