"""Filling missing cells from like records: hierarchical group statistics with back-off."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import beside, cut

#: Statistics of a level with up to so many groups are sent to every executor; more are joined by a shuffle.
SENT_GROUPS = 100_000
#: Partitions over which rows are spread that have no group.
SALTS = 1024


@dataclass(frozen=True)
class FillField:
    """A field to fill: its name, how (``mode`` or ``median``) and which values are usable."""

    name: str
    how: str
    usable: Callable[[str], Column]


def _records(df: DataFrame, key: str, fields: list[FillField], groups: list[str]) -> DataFrame:
    """``_key``, groups and the usable value of each field (``_u<field>``): one row per key."""
    usable = [F.when(f.usable(f.name), F.col(f.name)).alias(f"_u{j}") for j, f in enumerate(fields)]
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), *groups, *usable).dropDuplicates(["_key"])


def _histogram(records: DataFrame, fields: list[FillField], groups: list[str]) -> DataFrame:
    """How often each usable value of each field stands in each finest group: groups, ``_f`` (field), ``_v`` (of a mode) or
    ``_x`` (of a median), ``_n``."""
    only = lambda j, f, how, kind: (F.col(f"_u{j}") if f.how == how else F.lit(None)).cast(kind)
    cells = F.array(*[F.struct(F.lit(j).cast("byte").alias("_f"), only(j, f, "mode", "string").alias("_v"), only(j, f, "median", "double").alias("_x")) for j, f in enumerate(fields)])
    return records.select(*groups, F.inline(cells)).where("_v is not null or _x is not null").groupBy(*groups, "_f", "_v", "_x").agg(F.count("*").alias("_n"))


def _level_stats(hist: DataFrame, level: list[str], groups: list[str], fields: list[FillField], i: int) -> DataFrame:
    """Per group of a level, of each field what to fill in (``_fill<level>_<field>``) and how many values it rests on (``_support``)."""
    pool = hist.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in level], F.lit(True)))
    if set(level) != set(groups):
        pool = pool.groupBy(*level, "_f", "_v", "_x").agg(F.sum("_n").alias("_n"))
    out = []
    for j, f in enumerate(fields):
        mine = f"filter (where _f = {j})"
        fill = f"min_by(_v, struct(-_n, _v)) {mine}" if f.how == "mode" else f"cast(floor(percentile(_x, 0.5, _n) {mine}) as string)"
        out += [F.expr(fill).alias(f"_fill{i}_{j}"), F.coalesce(F.expr(f"sum(_n) {mine}"), F.lit(0)).alias(f"_support{i}_{j}")]
    return pool.groupBy(*[F.col(c).alias(f"_level_{c}") for c in level]).agg(*out)


def _with_levels(rows: DataFrame, stats: list[DataFrame], levels: list[list[str]], spread: Column) -> DataFrame:
    """``rows`` with the statistics of all their groups beside them; every row comes out once.

    Of several levels, one of up to ``SENT_GROUPS`` groups is broadcast, a larger one joined by a shuffle; a single one
    is not counted first, so that it is worked out in the same job as the rows.  A row without group
    goes to a partition of its own choosing (``spread``), so these don't meet in one.
    """
    for level, stat in zip(levels, stats):
        if not level:
            rows = beside(rows, stat)
        elif len(levels) > 1 and stat.count() <= SENT_GROUPS:
            rows = rows.join(F.broadcast(stat), reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_level_{c}") for c in level]), "left").drop(*[f"_level_{c}" for c in level])
        else:
            whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in level])
            salted = rows.withColumn("_salt", F.when(whole, F.lit(-1)).otherwise(F.pmod(spread, F.lit(SALTS)).cast("int")))
            salted = salted.withColumns({f"_at_{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in level})
            keyed = stat.withColumn("_level_salt", F.lit(-1)).withColumns({f"_level_{c}": F.col(f"_level_{c}").cast("string") for c in level})
            match = reduce(lambda a, b: a & b, [F.col(f"_at_{c}") == F.col(f"_level_{c}") for c in level], F.col("_salt") == F.col("_level_salt"))
            rows = salted.join(keyed, match, "left").drop("_salt", "_level_salt", *[f"_at_{c}" for c in level], *[f"_level_{c}" for c in level])
    return rows


def _all_stats(records: DataFrame, fields: list[FillField], levels: list[list[str]], groups: list[str]) -> list[DataFrame]:
    hist = _histogram(records, fields, groups)
    if len(levels) == 1:
        return [_level_stats(hist, levels[0], groups, fields, 0)]
    hist = cut(hist)
    return [cut(_level_stats(hist, level, groups, fields, i)) for i, level in enumerate(levels)]


def _first(levels: list[list[str]], j: int, min_support: int, value: Callable[[int], Column]) -> Column:
    """``value`` of the finest level that has support in field ``j``."""
    return F.coalesce(*[F.when(F.coalesce(F.col(f"_support{i}_{j}"), F.lit(0)) >= min_support, value(i)) for i in range(len(levels))])


def fill_cells(df: DataFrame, key: str, fields: list[FillField], levels: list[list[str]], min_support: int = 1) -> DataFrame:
    """The cells of ``df`` to be filled, one row per cell, with what to fill in.

    Returns ``(key, field_name, fill_value string, level int, level_name string, support long)``.
    Level 0 is the finest group of ``levels`` that has at least ``min_support`` usable values in
    the field, later levels are coarser, an empty column list is the whole table.  A record whose
    group columns hold a null has no group at that level.  A cell that no level can fill is kept
    with null ``fill_value`` and ``level``.  ``mode`` takes the most frequent value, ties go to
    the smaller one; ``median`` is rounded down to a whole number.  Repeated rows of one key count
    once, rows without key not at all.  An empty table gives an empty result; other columns
    of the table are ignored, whatever their names.

    The table is shuffled once for the keys; the statistics of all fields and levels come from one histogram
    (group, field, value, count) that is combined before it is shuffled, so a group with a third of all
    rows is one entry per value.  Only records with a missing cell take part in the joins.
    """
    min_support = max(1, min_support)
    groups = list(dict.fromkeys(c for level in levels for c in level))
    records = _records(df, key, fields, groups)
    stats = _all_stats(records, fields, levels, groups)
    missing = [F.col(f"_u{j}").isNull() for j in range(len(fields))]
    rows = records.where(reduce(lambda a, b: a | b, missing)).select("_key", *groups, *[m.alias(f"_missing{j}") for j, m in enumerate(missing)])
    rows = _with_levels(rows, stats, levels, F.xxhash64("_key"))
    cell = lambda j, f: F.struct(
        F.lit(f.name).alias("field_name"),
        _first(levels, j, min_support, lambda i: F.col(f"_fill{i}_{j}")).alias("fill_value"),
        _first(levels, j, min_support, lambda i: F.lit(i)).alias("level"),
        _first(levels, j, min_support, lambda i: F.lit("+".join(levels[i]) or "all")).alias("level_name"),
        _first(levels, j, min_support, lambda i: F.col(f"_support{i}_{j}")).alias("support"),
    )
    cells = F.array_compact(F.array(*[F.when(F.col(f"_missing{j}"), cell(j, f)) for j, f in enumerate(fields)]))
    return rows.select(F.col("_key").alias(key), F.inline(cells))


def fill_missing(df: DataFrame, key: str, fields: list[FillField], levels: list[list[str]], min_support: int = 1) -> DataFrame:
    """``df`` with its missing cells filled and each filled cell marked.

    Adds per field ``<f>_filled`` (the usable value, else the fill, else null),
    ``<f>_was_filled`` and ``<f>_fill_level``; the original columns stay as they are.  Every row
    of ``df`` comes out once, repeated deliveries and rows without key included (the latter
    cannot be filled).  Columns of these names in ``df`` are replaced.  Each row is joined to the statistics of its groups and
    filled in place (see ``fill_cells``).
    """
    min_support = max(1, min_support)
    groups = list(dict.fromkeys(c for level in levels for c in level))
    rows = _with_levels(df, _all_stats(_records(df, key, fields, groups), fields, levels, groups), levels, F.xxhash64(key))
    added = {}
    for j, f in enumerate(fields):
        own = F.when(f.usable(f.name), F.col(f.name))
        known = own.isNull() & F.col(key).isNotNull()
        fill = F.when(known, _first(levels, j, min_support, lambda i: F.col(f"_fill{i}_{j}")))
        added[f"{f.name}_filled"] = F.coalesce(own, fill.cast(df.schema[f.name].dataType))
        added[f"{f.name}_was_filled"] = fill.isNotNull()
        added[f"{f.name}_fill_level"] = F.when(known, _first(levels, j, min_support, lambda i: F.lit(i)))
    kept = [c for c in df.columns if c not in added]
    return rows.select(*kept, *[v.alias(c) for c, v in added.items()])
