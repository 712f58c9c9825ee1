"""From classified and read cells to rows, review queue, checks and page statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import DITTO_CONFIDENCE, GEOMETRIC_CONFIDENCE, REVIEW_BELOW, coerce_number, coerce_text, penalized
from ledgerloom.functions.geometry import round_binary
from ledgerloom.operators.sequence import fold_ditto

PAGE = ["file", "page"]


def cell_values(bound: DataFrame, readings: DataFrame, forms: DataFrame) -> DataFrame:
    """Each bound cell's outcome: ``empty``, ``dash``, ``ditto`` or ``ocr``, with value and confidences.

    ``bound`` has file, page, row, col, form_id, key, type, printed, ditto, kind and a box; ``readings`` text and
    confidence of content cells.  Empty and dash cells are never ditto; a dash is what the form says it means.
    An unreadable cell is ``ocr`` with null value and confidence 0.  ``conf`` is null except for ``ocr``;
    ``row_conf`` is what enters the row's mean; ``written`` marks values that show the row was filled in.
    """
    meaning = F.broadcast(forms.select("form_id", "dash_means", "ditto_markers"))
    rest = bound.where(F.col("kind") != "content").select("*", F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("confidence"))
    read = bound.where(F.col("kind") == "content").join(readings.select(*PAGE, "row", "col", "text", "confidence"), [*PAGE, "row", "col"], "left")
    cells = read.select(*rest.columns).unionByName(rest).join(meaning, "form_id", "left")
    text = F.coalesce("text", F.lit(""))
    squashed = F.regexp_replace(text, r"(?U)\s+", "")
    ditto = (F.col("kind") == "content") & F.col("ditto") & F.coalesce(F.array_contains("ditto_markers", squashed), F.lit(False))
    outcome = F.when(F.col("kind") == "empty", "empty").when(F.col("kind") == "dash", "dash").when(ditto, "ditto").otherwise("ocr")
    number = F.col("type") == "integer"
    value = F.when(number, coerce_number(text)["value"].cast("string")).otherwise(coerce_text(text)["value"])
    clean = F.when(number, coerce_number(text)["clean"]).otherwise(coerce_text(text)["clean"])
    conf = penalized(F.coalesce("confidence", F.lit(0.0)), clean)
    done = cells.withColumn("outcome", outcome).withColumn("value", F.when(F.col("outcome") == "dash", F.col("dash_means").cast("string")).when(F.col("outcome") == "ocr", value))
    done = done.withColumn("clean", F.when(F.col("outcome") == "ocr", clean)).withColumn("conf", F.when(F.col("outcome") == "ocr", conf))
    row_conf = F.when(F.col("outcome").isin("empty", "dash"), GEOMETRIC_CONFIDENCE).when(F.col("outcome") == "ditto", DITTO_CONFIDENCE).otherwise(round_binary(F.col("conf"), 3))
    written = (F.col("outcome") == "ditto") | (~F.col("printed") & F.col("value").isNotNull())
    return done.withColumn("row_conf", row_conf).withColumn("written", written).drop("dash_means", "ditto_markers")


def rows_out(values: DataFrame) -> DataFrame:
    """Emitted rows: file, page, form_id, row, ``record`` (key to value) and the row's mean confidence."""
    folded = fold_ditto(values, [*PAGE, "form_id"], "row", "key", "outcome", "value", "written")
    confidence = values.groupBy(*PAGE, "row").agg(round_binary(F.avg("row_conf"), 3).alias("confidence"))
    return folded.join(confidence, [*PAGE, "row"])


def review_queue(values: DataFrame, below: float = REVIEW_BELOW) -> DataFrame:
    """Read values of low confidence, those of rows that are not emitted included; the test is on the unrounded value."""
    low = values.where((F.col("outcome") == "ocr") & F.col("value").isNotNull() & (F.col("conf") < below))
    return low.select(*PAGE, "row", F.col("key").alias("column"), "value", F.col("text").alias("raw_text"), round_binary(F.col("conf"), 3).alias("confidence"), F.array("x0", "y0", "x1", "y1").alias("bbox"), "type")


def apply_checks(rows: DataFrame, checks: list[tuple[str, str, list[str]]]) -> DataFrame:
    """``rows`` with ``passed``, ``failed`` and ``check_failures`` from identities (form_id, target, parts).

    A check is skipped where the target or a part is null or absent; an empty list of parts adds up to 0.
    Failures are stated, they don't change confidence or review.
    """
    record = lambda k: F.try_element_at("record", F.lit(k)).try_cast("decimal(38,0)")
    if not checks:
        return rows.select("*", F.lit(0).alias("passed"), F.lit(0).alias("failed"), F.expr("cast(array() as array<string>)").alias("check_failures"))
    terms = []
    for form, target, parts in checks:
        total = sum((record(p) for p in parts), F.lit(0).cast("decimal(38,0)"))
        own = F.col("form_id") == form
        terms.append(F.struct(F.when(own, record(target)).alias("target"), F.when(own, total).alias("total"), F.lit(f"{target}=").alias("left"), F.lit(f" but sum({'+'.join(parts)})=").alias("right")))
    # Each identity's terms are read once; a null one makes both tests null.
    out = rows.withColumn("_terms", F.filter(F.array(*terms), lambda t: t["target"].isNotNull() & t["total"].isNotNull()))
    wrong = F.filter("_terms", lambda t: t["target"] != t["total"])
    failures = F.transform(wrong, lambda t: F.concat(t["left"], t["target"].cast("string"), t["right"], t["total"].cast("string")))
    return out.select(*rows.columns, F.size(F.filter("_terms", lambda t: t["target"] == t["total"])).alias("passed"), F.size(wrong).alias("failed"), failures.alias("check_failures"))


def solve_unknown(rows: DataFrame, form: str, target: str, parts: list[str], out: str = "solved") -> DataFrame:
    """Extension: where exactly one of an identity's terms is null, ``out`` maps its key to the value that solves it."""
    record = lambda k: F.try_element_at("record", F.lit(k)).try_cast("decimal(38,0)")
    terms = [target, *parts]
    missing = sum((record(k).isNull().cast("int") for k in terms), F.lit(0))
    known = sum((F.coalesce(record(p), F.lit(0).cast("decimal(38,0)")) for p in parts), F.lit(0).cast("decimal(38,0)"))
    value = lambda k: known if k == target else F.coalesce(record(target), F.lit(0).cast("decimal(38,0)")) - known
    solved = F.coalesce(*[F.when(record(k).isNull(), F.create_map(F.lit(k), value(k).cast("string"))) for k in terms])
    return rows.withColumn(out, F.when((F.col("form_id") == form) & (missing == 1), solved))


def page_counts(values: DataFrame, below: float = REVIEW_BELOW) -> DataFrame:
    """Per page: empty, dash, read and low-confidence cells, and the mean confidence of read cells (ditto left out)."""
    low = (F.col("outcome") == "ocr") & F.col("value").isNotNull() & (F.col("conf") < below)
    return values.groupBy(*PAGE, "form_id").agg(
        F.count_if(F.col("outcome") == "empty").alias("cells_empty"),
        F.count_if(F.col("outcome") == "dash").alias("cells_dash"),
        F.count_if(F.col("outcome").isin("ocr", "ditto")).alias("cells_ocr"),
        F.count_if(low).alias("cells_low_confidence"),
        round_binary(F.coalesce(F.avg("conf"), F.lit(0.0)), 3).alias("mean_ocr_confidence"),
    )


KEPT = {"ignoreNullFields": "false"}


def _json(value: Column | str) -> Column:
    """A text, number or truth value as JSON text, null as ``null``: what stands in a list of it alone (none of these ends in a bracket)."""
    return F.rtrim(F.substring(F.to_json(F.array(value)), 2, 2**31 - 1), F.lit("]"))


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def nested_pages(rows: DataFrame, review: DataFrame, meta: DataFrame, texts: DataFrame | None = None, integers: dict[str, list[str]] | None = None) -> DataFrame:
    """One JSON document per file: its pages in order, each with rows, review queue and statistics; nulls are kept.

    ``meta`` has a row for every scanned page, also for those without cells; ``texts`` (file, page, text) are the pages read
    from their text layer.  A row on which a check failed has ``_check_failures``.  Values of the columns that
    ``integers`` names for their form, and review values of type ``integer``, are written as numbers.
    """
    whole = F.map_from_entries(F.array(*[F.struct(F.lit(f), F.array(*[F.lit(k) for k in keys]).cast("array<string>")) for f, keys in (integers or {}).items()])) if integers else F.create_map().cast("map<string,array<string>>")
    is_number = lambda key: F.coalesce(F.array_contains(F.try_element_at(whole, F.col("form_id")), key), F.lit(False))
    written = lambda v, number: F.when(v.isNull(), F.lit("null")).when(number, v).otherwise(_json(v))
    cells = F.transform(F.map_entries("record"), lambda e: F.concat(_json(e["key"]), F.lit(":"), written(e["value"], is_number(e["key"]))))
    body = [_joined('"_row":', F.col("row").cast("string")), F.when(F.size("record") > 0, F.array_join(cells, ",")), _joined('"_confidence":', _json("confidence"))]
    if "check_failures" in rows.columns:
        body.append(F.when(F.size("check_failures") > 0, _joined('"_check_failures":', F.to_json("check_failures"))))
    record = _joined("{", F.concat_ws(",", *body), "}")
    in_order = lambda by, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*by, value.alias("_v")))), lambda x: x["_v"]), ",")
    r = rows.groupBy(*PAGE).agg(in_order(["row"], record).alias("_rows"))
    number = F.col("type") == "integer" if "type" in review.columns else F.lit(False)
    item = _joined(
        '{"row":', F.col("row").cast("string"), ',"column":', _json("column"), ',"value":', written(F.col("value"), number), ',"raw_text":', _json("raw_text"),
        ',"confidence":', _json("confidence"), ',"bbox":', F.coalesce(F.to_json("bbox"), F.lit("null")), "}",
    )
    q = review.groupBy(*PAGE).agg(in_order(["row", "column"], item).alias("_review"))
    facts = F.struct(*[c for c in meta.columns if c not in (*PAGE, "form_id")])
    m = meta.select(*PAGE, "form_id", F.to_json(facts, KEPT).alias("_meta"))
    scans = m.join(r, PAGE, "left").join(q, PAGE, "left").select(*PAGE, _joined(
        '{"form_id":', _json("form_id"), ',"rows":[', F.coalesce("_rows", F.lit("")), '],"review_queue":[', F.coalesce("_review", F.lit("")), '],"_meta":', F.col("_meta"),
        ',"page":', F.col("page").cast("string"), ',"source":"scan"}',
    ).alias("_page"))
    if texts is not None:
        scans = scans.unionByName(texts.select(*PAGE, _joined('{"page":', F.col("page").cast("string"), ',"source":"text","text":', _json("text"), "}").alias("_page")))
    files = scans.groupBy("file").agg(in_order(["page"], F.col("_page")).alias("_pages"))
    return files.select("file", _joined('{"file":', _json(F.element_at(F.split("file", "/"), -1)), ',"pages":[', F.col("_pages"), "]}").alias("payload"))


def summary_lines(counts: DataFrame) -> DataFrame:
    """One line of text per page, for a console; ``counts`` may have the facts of a page's meta, its rows and its review items."""
    has = lambda c: F.coalesce(F.col(c), F.lit(0)) if c in counts.columns else None
    parts = [F.format_string("p%d %s: %d empty, %d dash, %d read, %d low", "page", "form_id", "cells_empty", "cells_dash", "cells_ocr", "cells_low_confidence")]
    for label, c, kind in (("rows", "n_rows_out", "%d"), ("grid rows", "grid_rows", "%d"), ("rot", "orientation_applied", "%d"), ("conf", "mean_ocr_confidence", "%.3f"), ("review", "n_review", "%d"), ("s", "seconds", "%.1f")):
        if has(c) is not None:
            parts.append(F.format_string(f"{label} {kind}", has(c)))
    return counts.select(*PAGE, F.concat_ws(", ", *parts).alias("line"))
