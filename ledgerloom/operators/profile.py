"""Column profiles of large tables and of their loads, footers first, and loads that depart."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.footers import chunk_statistics, scan_groups, scan_values
from ledgerloom.session import cut

#: Bins per doubling of a value, and the smallest step that is told apart (in units of the value).
BINS_PER_OCTAVE, STEP = 32, 0.001
#: Loads holding more rows than this share are spread over SALTS partitions.
HOT_LOAD, SALTS = 1 / 64, 64


def _flat(df: DataFrame, fields: list[str] | None) -> list[str]:
    return df.columns if fields is None else fields


def table_values(df: DataFrame, fields: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The chunks of a Parquet table (schema ``CHUNKS``, written once) and its different values ``(field, value)``.

    Values come from the dictionaries of chunks that have one for all their pages, and from scans of the others.
    """
    chunks = cut(chunk_statistics(df.sparkSession, sorted(df.inputFiles()), _flat(df, fields), dictionaries=True))
    scanned = scan_values(chunks.where(~(F.col("exact") & F.col("distinct_complete")))).where("value is not null").select("field", "value")
    listed = chunks.where(F.col("exact") & F.col("distinct_complete")).select("field", F.explode("distinct_values").alias("value"))
    return chunks, listed.unionByName(scanned).distinct()


def profile_table(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Rows, nulls, share of nulls, extrema and distinct values of each field of a Parquet table (of all without ``fields``).

    Nulls and extrema come from the footers of the chunks where these are exact, distinct values from the chunks'
    dictionaries; only chunks where either is insufficient are scanned, each by itself.  ``scanned_chunks``
    of ``chunks`` says how many.  ``df`` must be read from Parquet files as they are (no filter).  ``low`` and ``high`` are of
    numbers, ``low_text`` and ``high_text`` of all other values, as ``canonical`` writes them; NaN is a value that no
    extremum shows.  An empty table gives one row per field with 0 rows.
    """
    spark, fields = df.sparkSession, _flat(df, fields)
    chunks, values = table_values(df, fields)
    ok = F.col("exact") & F.col("distinct_complete")
    number = [f.name for f in df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double")]
    ends = lambda low, high: [F.min(low).alias("low"), F.max(high).alias("high")]
    text = lambda c: F.when(~F.col("field").isin(*number), F.col(c)) if number else F.col(c)
    exact = chunks.where(ok).groupBy("field").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), *ends("low", "high"), F.min(text("low_text")).alias("low_text"), F.max(text("high_text")).alias("high_text"))
    num = F.when(~F.isnan("num"), F.col("num"))
    scanned = scan_values(chunks.where(~ok)).groupBy("field").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), *ends(num, num), F.min(text("value")).alias("low_text"), F.max(text("value")).alias("high_text")
    )
    both = exact.unionByName(scanned).groupBy("field").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), *ends("low", "high"), F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"))
    distinct = values.groupBy("field").agg(F.count("*").alias("distinct_values"))
    counts = chunks.groupBy("field").agg(F.count("*").alias("chunks"), F.count_if(~ok).alias("scanned_chunks"))
    out = spark.createDataFrame([(f,) for f in fields], "field string")
    for part in (both, distinct, counts):
        out = out.join(part, "field", "left")
    return out.fillna(0, ["rows", "nulls", "distinct_values", "chunks", "scanned_chunks"]).select(
        "field", "rows", "nulls", F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")).alias("null_share"), "distinct_values", "low", "high", "low_text", "high_text", "chunks", "scanned_chunks"
    )


def pattern_of(value: Column) -> Column:
    """The pattern of a text: a run of letters as ``a``, of digits as ``9``, all else as it is."""
    return F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]+", "9")


def profile_patterns(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """``(field, pattern, distinct_values)``: the patterns of the text fields of a Parquet table, over all their different values.

    Values come as in ``profile_table``: from dictionaries, and from scans only of chunks without.
    """
    texts = [f.name for f in df.schema if f.dataType.typeName() == "string" and (fields is None or f.name in fields)]
    if not texts:
        return df.sparkSession.createDataFrame([], "field string, pattern string, distinct_values long")
    return table_values(df, texts)[1].groupBy("field", pattern_of(F.col("value")).alias("pattern")).agg(F.count("*").alias("distinct_values"))


@dataclass(frozen=True)
class LoadField:
    """A field to profile by load: which of its values count, and the scale on which they scatter."""

    name: str
    counts: Callable[[Column], Column] | None = None
    log_scale: bool = False


LOADS = (
    "load long, station long, field_name string, n long, nulls long, n_values long, n_distinct long, low double, high double, "
    "bins array<struct<bin:int,n:long,low:double,high:double>>, forms array<long>"
)


def _counts_of(f: LoadField, v: Column) -> Column:
    return f.counts(v) if f.counts is not None else F.lit(True)


def _bin(v: Column) -> Column:
    return (F.signum(v) * F.floor(F.log2(1 + F.abs(v) / STEP) * BINS_PER_OCTAVE)).cast("int")


def _decimals(v: Column) -> Column:
    """Written decimals of a value: 0, 1, 2, 3, or 4 for more."""
    close = lambda k: F.abs(v * 10**k - F.round(v * 10**k)) < 1e-6 * F.greatest(F.abs(v), F.lit(1.0))
    return F.when(close(0), 0).when(close(1), 1).when(close(2), 2).when(close(3), 3).otherwise(4)


COUNTED = "load long, station long, field_name string, v double, n long"


def sufficient_groups(df: DataFrame, key: str, load: str, station: str, fields: list[LoadField], only: dict[str, str]) -> tuple[DataFrame | None, DataFrame | None]:
    """What footers alone can say about loads, and the row groups that must be scanned.

    A row group is sufficient if its footers are exact, load and station are one value each, every column of ``only`` is
    the wanted text, every field is null throughout or one value beside its nulls, the keys, by the
    dictionary, are all different, and their range meets that of no other row group (so that no delivery is repeated).
    Returns value counts (schema ``COUNTED``) and the other row groups ``(path, row_group)``; None, None where no row
    group is sufficient.  The driver is told no more than whether there is one.
    """
    spark = df.sparkSession
    chunks = cut(chunk_statistics(spark, sorted(df.inputFiles()), [key, load, station, *(f.name for f in fields), *only]))
    one = F.col("exact") & (F.col("low") == F.col("high")) & (F.col("nulls") == 0)
    text = F.coalesce(*[F.when(F.col("field") == c, F.lit(v)) for c, v in only.items()], F.lit(None).cast("string"))
    ok = (
        F.when(F.col("field").isin(load, station), one)
        .when(F.col("field") == key, F.col("exact") & (F.col("nulls") == 0))
        .when(text.isNotNull(), F.col("exact") & (F.col("nulls") == 0) & (F.col("low_text") == text) & (F.col("high_text") == text))
        # A fraction's bounds leave NaN out, so one value is certain only for whole numbers or by the dictionary (``exact``).
        .otherwise(F.col("exact") & ((F.col("nulls") == F.col("rows")) | (F.col("low") == F.col("high"))))
    )
    of_key = lambda c: F.when(F.col("field") == key, F.col(c))
    groups = chunks.groupBy("path", "row_group").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("ok"), F.min(of_key("low")).alias("first"), F.max(of_key("high")).alias("last"), F.max(of_key("rows")).alias("n"))
    if groups.where("ok").isEmpty() or not groups.where("first is null").isEmpty():
        return None, None
    in_order = Window.orderBy("first", "last", "path", "row_group")  # one row a row group
    before, after = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lead("first").over(in_order)
    alone = groups.withColumn("_before", before).withColumn("_after", after).where("ok and coalesce(_before < first, true) and coalesce(_after > last, true)")
    keys = chunk_statistics(spark, alone.select("path", "row_group"), [key], dictionaries=True)
    good = cut(keys.where(F.col("distinct_complete") & (F.size("distinct_values") == F.col("rows"))).select("path", "row_group"))
    if good.isEmpty():
        return None, None
    at = ["path", "row_group"]
    own = chunks.join(good, at)
    of = lambda c, name: own.where(F.col("field") == c).select(*at, F.col("low").cast("long").alias(name))
    values = own.where(F.col("field").isin(*(f.name for f in fields))).join(of(load, "load"), at).join(of(station, "station"), at)
    both = F.array(F.struct(F.col("low").alias("v"), (F.col("rows") - F.col("nulls")).alias("n")), F.struct(F.lit(None).cast("double").alias("v"), F.col("nulls").alias("n")))
    counted = values.select("load", "station", F.col("field").alias("field_name"), F.explode(both).alias("x")).select("load", "station", "field_name", "x.v", "x.n").where("n > 0")
    return counted, groups.join(good, at, "left_anti").select(*at)


def load_profiles(df: DataFrame, key: str, load: str, station: str, fields: list[LoadField], only: dict[str, str] | None = None, footers: bool = False) -> DataFrame:
    """A profile of each field in each load (schema ``LOADS``): counts, nulls, distinct, range, histogram, written forms.

    Repeated deliveries (rows of one ``key``) count once.  Values for which ``counts`` is false are no
    values: neither null nor counted.  Rows without load are left out.  The histogram has
    logarithmic bins, so it is bounded whatever the load; the written form is the number of decimals.

    ``only`` keeps the rows with these texts.  With ``footers``, ``df`` must be Parquet files as they are: row groups
    whose footers and dictionaries say all of this are not scanned (see ``sufficient_groups``).

    Rows are shuffled once, by load, and a load's histogram is made where its rows are; loads above ``HOT_LOAD`` of all
    rows are spread over ``SALTS`` partitions, and the counts of their values added up in a second, small step.
    """
    known, columns = None, list(dict.fromkeys([key, load, station, *(f.name for f in fields), *(only or {})]))
    if footers:
        known, to_scan = sufficient_groups(df, key, load, station, fields, only or {})
        if known is not None:
            kinds = {f.name: f.dataType.simpleString() for f in df.schema}
            df = scan_groups(to_scan, columns, ", ".join(f"`{c}` {kinds[c]}" for c in columns))
    for c, text in (only or {}).items():
        df = df.where(F.col(c) == text)
    rows = df.where(F.col(load).isNotNull()).select(
        F.col(key).alias("k"), F.col(load).cast("long").alias("load"), F.col(station).cast("long").alias("station"),
        *[F.col(f.name).cast("double").alias(f"v{i}") for i, f in enumerate(fields)],
        *[F.coalesce(_counts_of(f, F.col(f.name)), F.lit(False)).alias(f"c{i}") for i, f in enumerate(fields) if f.counts is not None],
    )
    by_load = rows.groupBy("load").agg(F.count("*").alias("n"))
    total = df.count()
    hot = [r["load"] for r in by_load.where(F.col("n") > max(50_000, total * HOT_LOAD)).select("load").collect()]  # at most 1/HOT_LOAD of them
    spread = ["load", "salt"] if hot else ["load"]
    if hot:
        rows = rows.withColumn("salt", F.when(F.col("load").isin(*hot), F.pmod(F.xxhash64("k"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    once = rows.repartition(*spread).dropDuplicates([*spread, "k"])
    value = lambda i, f: F.when(F.col(f"c{i}") | F.col(f"v{i}").isNull(), F.col(f"v{i}")) if f.counts is not None else F.col(f"v{i}")
    no_value = lambda i, f: (F.col(f"v{i}").isNotNull() & ~F.col(f"c{i}")) if f.counts is not None else F.lit(False)
    long = once.select(*spread, "station", F.explode(F.array(*[F.struct(F.lit(f.name).alias("field_name"), value(i, f).alias("v"), no_value(i, f).alias("odd")) for i, f in enumerate(fields)])).alias("x")).select(*spread, "station", "x.*")
    counted = long.groupBy(*spread, "field_name", "v", "odd").agg(F.count("*").alias("n"), F.min("station").alias("station"))
    if hot:
        over = counted.where(F.col("load").isin(*hot)).groupBy("load", "field_name", "v", "odd").agg(F.sum("n").alias("n"), F.min("station").alias("station"))
        counted = counted.where(~F.col("load").isin(*hot)).select(*over.columns).unionByName(over)
    if known is not None:
        odd = F.coalesce(*[F.when((F.col("field_name") == f.name) & F.col("v").isNotNull(), ~F.coalesce(_counts_of(f, F.col("v")), F.lit(False))) for f in fields if f.counts is not None], F.lit(False))
        known = known.withColumn("odd", odd).select("load", "field_name", F.when(~F.col("odd"), F.col("v")).alias("v"), "odd", "n", "station")
        columns = ["load", "field_name", "v", "odd", "n", "station"]
        counted = counted.select(*columns).unionByName(known.select(*columns)).groupBy("load", "field_name", "v", "odd").agg(F.sum("n").alias("n"), F.min("station").alias("station"))
    is_value = F.col("v").isNotNull()
    forms = _decimals(F.col("v"))
    binned = counted.groupBy("load", "field_name", F.when(is_value, _bin(F.col("v"))).alias("bin")).agg(
        F.min("station").alias("station"),
        F.sum("n").alias("n"),
        F.sum(F.when(~is_value & ~F.col("odd"), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(is_value, F.col("n")).otherwise(0)).alias("n_values"),
        F.count("v").alias("n_distinct"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        *[F.sum(F.when(is_value & (forms == d), F.col("n")).otherwise(0)).alias(f"f{d}") for d in range(5)],
    )
    return binned.groupBy("load", "field_name").agg(
        F.min("station").alias("station"), F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("n_values").alias("n_values"), F.sum("n_distinct").alias("n_distinct"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.array_sort(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", F.col("n_values").alias("n"), "low", "high")))).alias("bins"),
        F.array(*[F.sum(f"f{d}") for d in range(5)]).alias("forms"),
    ).select("load", "station", "field_name", "n", "nulls", "n_values", "n_distinct", "low", "high", "bins", "forms")


@dataclass(frozen=True)
class Departure:
    """When a load plainly departs from the other loads of its station.

    ``nulls``: share of nulls differs by more; ``distinct``: fewer than this part of the others' distinct
    values; ``form``: total variation distance of written forms; ``outside``: at least so many values
    (or this share) beyond the others' 10 % and 90 % points by ``fence`` times their distance;
    ``shift``: median off by more than this part of that distance; ``spread``: that distance larger or smaller by more
    than this factor.  What counts as plain widens with the sampling error of a load's n values, at every size
    alike: by 1/n for ``distinct``, 2/n for ``form``, ``shift_error`` / sqrt(n) for ``shift``, exp(``spread_error`` / sqrt(n))
    for ``spread``.
    """

    nulls: float = 0.25
    distinct: float = 0.3
    form: float = 0.4
    outside: int = 2
    outside_share: float = 0.01
    fence: float = 1.5
    shift: float = 0.35
    shift_error: float = 1.22
    spread: float = 1.75
    spread_error: float = 2.3


DEPARTURES = "load long, station long, field_name string, reasons array<string>"


def _points(mid: np.ndarray, n: np.ndarray, total: int, log: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(mid, kind="stable")
    mid, n = mid[order], n[order]
    scaled = np.sign(mid) * np.log1p(np.abs(mid)) if log else mid
    at = np.interp(np.array([0.1, 0.5, 0.9]) * total, np.cumsum(n) - n / 2, scaled) if len(n) > 1 else np.repeat(scaled, 3)
    return at, scaled, n


def compare_loads(loads: list[dict], log: bool, rule: Departure) -> list[tuple[int, list[str]]]:
    """For the loads of one station and field, the reasons for which each departs from the others.

    A load has the fields of ``LOADS``, its histogram as the arrays ``mid`` (middles of the bins) and ``freq``.
    """
    m = len(loads)
    if m < 3:
        return []
    null = np.array([x["nulls"] / max(1, x["n"]) for x in loads])
    distinct = np.array([x["n_distinct"] for x in loads], dtype=float)
    count = np.array([x["n_values"] for x in loads], dtype=float)
    forms = np.array([np.array(x["forms"], dtype=float) / max(1, x["n_values"]) for x in loads])
    points = [_points(x["mid"], x["freq"], x["n_values"], log) if x["n_values"] else None for x in loads]
    q = np.array([p[0] if p else [np.nan] * 3 for p in points])
    width = q[:, 2] - q[:, 0]
    out = []
    for i in range(m):
        rest = [j for j in range(m) if j != i]
        reasons = []
        if abs(null[i] - np.median(null[rest])) > rule.nulls:
            reasons.append("nulls")
        others = [j for j in rest if count[j] > 0 and width[j] > 0]
        if count[i] > 0 and len(others) >= 2:
            few, n = rule.distinct - 1 / count[i], count[i]
            if distinct[i] / n < few * np.median(distinct[others] / count[others]) or distinct[i] < few * np.median(distinct[others]) and n > 0.5 * np.median(count[others]):
                reasons.append("distinct")
            if 0.5 * np.abs(forms[i] - np.median(forms[others], axis=0)).sum() > rule.form + 2 / n:
                reasons.append("form")
            lo, mid, hi = (np.median(q[others, k]) for k in range(3))
            w = max(hi - lo, 1e-9)
            _, v, of = points[i]
            beyond = of[(v > hi + rule.fence * w) | (v < lo - rule.fence * w)].sum()
            if beyond >= max(rule.outside, rule.outside_share * n):
                reasons.append("range")
            if abs(q[i, 1] - mid) > (rule.shift + rule.shift_error / np.sqrt(n)) * w:
                reasons.append("distribution")
            elif abs(np.log(max(width[i] / w, 1e-9))) > np.log(rule.spread) + rule.spread_error / np.sqrt(n):
                reasons.append("spread")
        if reasons:
            out.append((i, reasons))
    return out


def _departures(batches: Iterator, logs: dict[str, bool], rule: Departure) -> Iterator:
    """The departures (schema ``DEPARTURES``) of Arrow batches with a row per station and field.

    A row is taken from its batch by itself and histograms stay arrays, so a worker holds the batch and the loads of one
    station, however many stations a batch has.
    """
    import pyarrow as pa

    kind = pa.schema([("load", pa.int64()), ("station", pa.int64()), ("field_name", pa.string()), ("reasons", pa.list_(pa.string()))])
    plain = ("load", "n", "nulls", "n_values", "n_distinct", "forms")
    for batch in batches:
        out, grouped = [], batch.column(batch.schema.get_field_index("loads"))
        for at, (station, field) in enumerate(zip(batch.column(batch.schema.get_field_index("station")).to_pylist(), batch.column(batch.schema.get_field_index("field_name")).to_pylist())):
            of = grouped[at].values
            columns = {c: of.field(c).to_pylist() for c in plain}
            loads = [{c: columns[c][i] for c in plain} | {c: of.field(c)[i].values.to_numpy(zero_copy_only=False).astype(float) for c in ("mid", "freq")} for i in range(len(of))]
            loads.sort(key=lambda x: x["load"])
            out += [{"load": loads[i]["load"], "station": station, "field_name": field, "reasons": reasons} for i, reasons in compare_loads(loads, logs[field], rule)]
        yield pa.RecordBatch.from_pylist(out, kind)


def departing_loads(profiles: DataFrame, fields: list[LoadField], rule: Departure | None = None) -> DataFrame:
    """Loads whose profile plainly departs from the other loads of their station, with the reasons.

    Each load is held against the medians of the other loads, so a few odd loads do not hide one another, and
    slow drift or differences between stations are no reason.  A station with fewer than
    three loads has no cases.  A group here is the profiles of one station: loads, never rows; of a histogram it has
    the bins' middles and numbers only.
    """
    rule, logs = rule or Departure(), {f.name: f.log_scale for f in fields}
    bins = [F.transform("bins", lambda b: (b["low"] + b["high"]) / 2).alias("mid"), F.transform("bins", lambda b: b["n"]).alias("freq")]
    compact = profiles.where(F.col("station").isNotNull()).select("station", "field_name", F.struct("load", "n", "nulls", "n_values", "n_distinct", *bins, "forms").alias("load"))
    grouped = compact.groupBy("station", "field_name").agg(F.collect_list("load").alias("loads"))
    return grouped.mapInArrow(lambda batches: _departures(batches, logs, rule), DEPARTURES)
