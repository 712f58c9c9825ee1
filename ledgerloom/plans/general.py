"""Queries of the general data problems (1 to 4), and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.usable import STAND_IN_QUANTITIES, STAND_IN_WORDS, usable_quantity, usable_text
from ledgerloom.operators.drift import compile_projections, field_profiles, schema_changes, unify
from ledgerloom.operators.flatten import emit, flatten_tables
from ledgerloom.operators.impute import FillField, fill_cells, fill_missing
from ledgerloom.operators.profile import LoadField, departing_loads, load_profiles, profile_patterns, profile_table
from ledgerloom.session import cut, table

FILL_FIELDS = [
    FillField("vendor_name", "mode", usable_text),
    FillField("rejection_qty", "median", usable_quantity),
]
FILL_LEVELS = [["station_id", "item_code"], ["item_code"], ["station_id"], []]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    cells = fill_cells(table(spark, sf, "scrap_note_rows"), "rec_id", FILL_FIELDS, FILL_LEVELS[:1])
    return cells.where(F.col("level") == 0).select("rec_id", "field_name")


def p3_filled(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "scrap_note_rows").groupBy("rec_id").agg(*[F.min_by(c, "loaded_at").alias(c) for c in ("station_id", "item_code", "vendor_name", "rejection_qty")])
    return fill_missing(rows, "rec_id", FILL_FIELDS, FILL_LEVELS)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    emitted = emit(table(spark, sf, "page_results")).where(F.col("tag").isin("row", "review", "meta", "broken"))
    return emitted.select("result_id", "page_no", F.col("tag").alias("child_kind"), "row_no", "column_key")


def _children(spark: SparkSession, sf: str, tag: str) -> DataFrame:
    return flatten_tables(table(spark, sf, "page_results"))[tag].drop("payload")


def p4_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _children(spark, sf, "row")


def p4_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _children(spark, sf, "review")


def p4_meta(spark: SparkSession, sf: str) -> DataFrame:
    return _children(spark, sf, "meta")


def p4_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _children(spark, sf, "page")


def p4_checks(spark: SparkSession, sf: str) -> DataFrame:
    """One row per failed check that stands in a row, with that row's key."""
    return _children(spark, sf, "check")


def p4_broken(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold no pages, and why."""
    return _children(spark, sf, "broken")


def p4_tables(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows each child table has, and how many of them have a parent in the table above: all."""
    tables = flatten_tables(table(spark, sf, "page_results"))
    keys = tables["page"].select(F.col("node_key").alias("parent_key")).unionByName(tables["row"].select(F.col("node_key").alias("parent_key")))
    roots = table(spark, sf, "page_results").select(F.col("result_id").cast("string").alias("parent_key"))
    keys = keys.unionByName(roots).withColumn("known", F.lit(True))
    nodes = reduce(DataFrame.unionByName, [t.select(F.lit(tag).alias("tag"), "parent_key") for tag, t in tables.items()])
    return nodes.join(keys, "parent_key", "left").groupBy("tag").agg(F.count("*").alias("n"), F.count("known").alias("with_parent"))


QUERIES = {"p3_found": p3_found, "p3_filled": p3_filled, "p4_found": p4_found, "p4_rows": p4_rows, "p4_reviews": p4_reviews, "p4_meta": p4_meta, "p4_pages": p4_pages, "p4_checks": p4_checks, "p4_broken": p4_broken, "p4_tables": p4_tables}

_WORDS = ", ".join(f"'{w}'" for w in STAND_IN_WORDS)
_NUMBERS = ", ".join(map(str, STAND_IN_QUANTITIES))
_RECORDS = f"""
WITH core AS (
  SELECT DISTINCT ON (rec_id) rec_id, station_id, item_code, vendor_name, rejection_qty,
    lower(regexp_replace(regexp_replace(vendor_name, '^[^\\pL\\pN]+', ''), '[^\\pL\\pN]+$', '')) AS v
  FROM scrap_note_rows ORDER BY rec_id, loaded_at),
records AS (
  SELECT *, coalesce(length(v) > 0 AND v NOT IN ({_WORDS}), false) AS vendor_ok,
    coalesce(rejection_qty >= 1 AND rejection_qty NOT IN ({_NUMBERS}), false) AS qty_ok
  FROM core)"""

SQL = {
    "p3_found": _RECORDS + """
SELECT rec_id, 'vendor_name' AS field_name FROM records r WHERE NOT vendor_ok AND EXISTS
  (SELECT 1 FROM records o WHERE o.station_id = r.station_id AND o.item_code = r.item_code AND o.vendor_ok)
UNION ALL
SELECT rec_id, 'rejection_qty' FROM records r WHERE NOT qty_ok AND EXISTS
  (SELECT 1 FROM records o WHERE o.station_id = r.station_id AND o.item_code = r.item_code AND o.qty_ok)""",
    "p3_filled": _RECORDS + """,
vv AS (SELECT station_id, item_code, vendor_name AS x, count(*) AS n FROM records WHERE vendor_ok GROUP BY ALL),
v0 AS (SELECT station_id, item_code, arg_min(x, (-n, x)) AS f FROM vv WHERE station_id IS NOT NULL AND item_code IS NOT NULL GROUP BY ALL),
v1 AS (SELECT item_code, arg_min(x, (-n, x)) AS f FROM (SELECT item_code, x, sum(n) AS n FROM vv GROUP BY ALL) WHERE item_code IS NOT NULL GROUP BY ALL),
v2 AS (SELECT station_id, arg_min(x, (-n, x)) AS f FROM (SELECT station_id, x, sum(n) AS n FROM vv GROUP BY ALL) WHERE station_id IS NOT NULL GROUP BY ALL),
v3 AS (SELECT arg_min(x, (-n, x)) AS f FROM (SELECT x, sum(n) AS n FROM vv GROUP BY ALL)),
q AS (SELECT station_id, item_code, rejection_qty AS x FROM records WHERE qty_ok),
q0 AS (SELECT station_id, item_code, floor(quantile_cont(x, 0.5))::BIGINT AS f FROM q WHERE station_id IS NOT NULL AND item_code IS NOT NULL GROUP BY ALL),
q1 AS (SELECT item_code, floor(quantile_cont(x, 0.5))::BIGINT AS f FROM q WHERE item_code IS NOT NULL GROUP BY ALL),
q2 AS (SELECT station_id, floor(quantile_cont(x, 0.5))::BIGINT AS f FROM q WHERE station_id IS NOT NULL GROUP BY ALL),
q3 AS (SELECT floor(quantile_cont(x, 0.5))::BIGINT AS f FROM q)
SELECT r.rec_id, r.station_id, r.item_code, r.vendor_name, r.rejection_qty,
  CASE WHEN vendor_ok THEN vendor_name ELSE coalesce(v0.f, v1.f, v2.f, v3.f) END AS vendor_name_filled,
  NOT vendor_ok AND coalesce(v0.f, v1.f, v2.f, v3.f) IS NOT NULL AS vendor_name_was_filled,
  CASE WHEN vendor_ok THEN NULL WHEN v0.f IS NOT NULL THEN 0 WHEN v1.f IS NOT NULL THEN 1 WHEN v2.f IS NOT NULL THEN 2 WHEN v3.f IS NOT NULL THEN 3 END AS vendor_name_fill_level,
  CASE WHEN qty_ok THEN rejection_qty ELSE coalesce(q0.f, q1.f, q2.f, q3.f) END AS rejection_qty_filled,
  NOT qty_ok AND coalesce(q0.f, q1.f, q2.f, q3.f) IS NOT NULL AS rejection_qty_was_filled,
  CASE WHEN qty_ok THEN NULL WHEN q0.f IS NOT NULL THEN 0 WHEN q1.f IS NOT NULL THEN 1 WHEN q2.f IS NOT NULL THEN 2 WHEN q3.f IS NOT NULL THEN 3 END AS rejection_qty_fill_level
FROM records r
LEFT JOIN v0 USING (station_id, item_code) LEFT JOIN v1 USING (item_code) LEFT JOIN v2 USING (station_id) CROSS JOIN v3
LEFT JOIN q0 USING (station_id, item_code) LEFT JOIN q1 USING (item_code) LEFT JOIN q2 USING (station_id) CROSS JOIN q3""",
}



def _unpacked(x: str) -> str:
    return f"(CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x}->>'$') THEN ({x}->>'$')::JSON ELSE {x} END)"


# The layouts as a union: wrapped, bare list, single page, JSON in strings; rows listed, keyed or single; review items of a page or of its rows.
_NESTED = f"""
WITH raw AS (SELECT result_id, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM page_results),
un AS (SELECT result_id, {_unpacked('j')} AS j FROM raw),
doc AS (SELECT result_id, CASE WHEN json_type(j) = 'OBJECT' AND (j->'result') IS NOT NULL THEN {_unpacked("(j->'result')")} ELSE j END AS j FROM un),
pg AS (SELECT result_id, CASE WHEN json_type(j) = 'ARRAY' THEN j WHEN json_type(j) = 'OBJECT' AND (j->'pages') IS NOT NULL THEN {_unpacked("(j->'pages')")}
    WHEN json_type(j) = 'OBJECT' AND coalesce(j->'page', j->'rows', j->'review_queue', j->'_meta') IS NOT NULL THEN json_array(j) END AS j FROM doc),
page AS (SELECT result_id, i - 1 AS p, json_extract(j, '$[' || (i - 1) || ']') AS j FROM pg, unnest(range(1, coalesce(json_array_length(j), 0)::BIGINT + 1)) AS u(i)),
pages AS (SELECT result_id, p, coalesce(try_cast(j->>'page' AS INT), p::INT) AS page_no, j, {_unpacked("(j->'rows')")} AS rws, {_unpacked("(j->'review_queue')")} AS rev, {_unpacked("(j->'_meta')")} AS meta FROM page),
rw AS (
  SELECT result_id, p, page_no, i - 1 AS r, json_extract(rws, '$[' || (i - 1) || ']') AS x, NULL AS k FROM pages, unnest(range(1, json_array_length(rws)::BIGINT + 1)) AS u(i) WHERE json_type(rws) = 'ARRAY'
  UNION ALL SELECT result_id, p, page_no, 0, rws, NULL FROM pages WHERE json_type(rws) = 'OBJECT' AND (rws->'_row') IS NOT NULL
  UNION ALL SELECT result_id, p, page_no, i - 1, json_extract(rws, '$."' || json_keys(rws)[i] || '"'), json_keys(rws)[i] FROM pages, unnest(range(1, len(json_keys(rws))::BIGINT + 1)) AS u(i) WHERE json_type(rws) = 'OBJECT' AND (rws->'_row') IS NULL),
rows_ AS (SELECT result_id, p, page_no, r, x, try_cast(coalesce(k, x->>'_row') AS INT) AS row_no FROM rw),
rv AS (
  SELECT result_id, page_no, NULL::INT AS row_no, rev FROM pages UNION ALL SELECT result_id, page_no, row_no, {_unpacked("(x->'review_queue')")} FROM rows_),
reviews AS (
  SELECT result_id, page_no, row_no, json_extract(rev, '$[' || (i - 1) || ']') AS x FROM rv, unnest(range(1, json_array_length(rev)::BIGINT + 1)) AS u(i) WHERE json_type(rev) = 'ARRAY'
  UNION ALL SELECT result_id, page_no, row_no, rev FROM rv WHERE json_type(rev) = 'OBJECT')
"""
SQL["p4_found"] = _NESTED + """
SELECT result_id, page_no, 'row' AS child_kind, row_no, '' AS column_key FROM rows_
UNION ALL SELECT result_id, page_no, 'review', coalesce(try_cast(x->>'row' AS INT), row_no), coalesce(x->>'column', '') FROM reviews
UNION ALL SELECT result_id, page_no, 'meta', -1, '' FROM pages WHERE json_type(meta) <> 'NULL'
UNION ALL SELECT result_id, -1, 'broken', -1, '' FROM pg WHERE j IS NULL"""
_COLUMNS = {"s_no": "INT", "item_code": "VARCHAR", "item_name": "VARCHAR", "unit": "VARCHAR", "rejection_qty": "BIGINT", "vendor_name": "VARCHAR", "reason_remarks": "VARCHAR", "_confidence": "DOUBLE"}
_LISTED = ", ".join(f'"{c}": null' for c in (*_COLUMNS, "_row", "review_queue", "_check_failures", "extra"))
SQL["p4_rows"] = _NESTED + f"""
SELECT result_id, page_no, row_no, '' AS column_key, result_id || '/' || p || '/row/' || r AS node_key, result_id || '/' || p AS parent_key,
  {", ".join(f"try_cast(x->>'{c}' AS {kind}) AS {c}" for c, kind in _COLUMNS.items())}, x->'extra'->'operator'->>'code' AS extra_operator_code, x->'extra'->'operator'->>'shift' AS extra_operator_shift,
  nullif(json_merge_patch(x, '{{{_LISTED}}}')::VARCHAR, '{{}}') AS rest FROM rows_"""
def _listed(*names: str) -> str:
    return "{" + ", ".join(f'"{c}": null' for c in names) + "}"


SQL["p4_checks"] = _NESTED + """
SELECT result_id, page_no, row_no, '' AS column_key, result_id || '/' || p || '/row/' || r || '/check/' || (i - 1) AS node_key, result_id || '/' || p || '/row/' || r AS parent_key,
  x->'_check_failures'->>(i - 1)::INT AS failure, NULL::VARCHAR AS rest FROM rows_, unnest(range(1, coalesce(json_array_length(x->'_check_failures'), 0)::BIGINT + 1)) AS u(i)"""
SQL["p4_pages"] = _NESTED + f"""
SELECT result_id, page_no, -1 AS row_no, '' AS column_key, result_id || '/' || p AS node_key, result_id::VARCHAR AS parent_key, j->>'form_id' AS form_id, j->>'source' AS source, j->>'text' AS text,
  nullif(json_merge_patch(j, '{_listed('page', 'form_id', 'source', 'text', 'rows', 'review_queue', '_meta')}')::VARCHAR, '{{}}') AS rest FROM pages"""
_REVIEWS = """,
ri AS (SELECT result_id, p, page_no, NULL::INT AS row_no, result_id || '/' || p AS parent_key, -1 AS r, rev FROM pages
  UNION ALL SELECT result_id, p, page_no, row_no, result_id || '/' || p || '/row/' || r, r, """ + _unpacked("(x->'review_queue')") + """ FROM rows_),
items AS (SELECT result_id, p, page_no, row_no, parent_key, r, i, json_extract(rev, '$[' || (i - 1) || ']') AS x FROM ri, unnest(range(1, json_array_length(rev)::BIGINT + 1)) AS u(i) WHERE json_type(rev) = 'ARRAY'
  UNION ALL SELECT result_id, p, page_no, row_no, parent_key, r, 1, rev FROM ri WHERE json_type(rev) = 'OBJECT')"""
SQL["p4_reviews"] = _NESTED + _REVIEWS + f"""
SELECT result_id, page_no, coalesce(try_cast(x->>'row' AS INT), row_no) AS row_no, coalesce(x->>'column', '') AS column_key,
  result_id || '/' || p || '/review/' || (row_number() OVER (PARTITION BY result_id, p ORDER BY r, i) - 1) AS node_key, parent_key,
  x->>'value' AS value, x->>'raw_text' AS raw_text, try_cast(x->>'confidence' AS DOUBLE) AS confidence, x->>'bbox' AS bbox,
  nullif(json_merge_patch(x, '{_listed('row', '_row', 'column', 'value', 'raw_text', 'confidence', 'bbox')}')::VARCHAR, '{{}}') AS rest FROM items"""
_META = {"orientation_applied": "INT", "orientation_method": "VARCHAR", "skew_deg": "DOUBLE", "grid_rows": "INT", "grid_cols": "INT", "cells_total": "INT", "cells_empty": "INT", "cells_dash": "INT", "cells_ocr": "INT", "cells_low_confidence": "INT", "mean_ocr_confidence": "DOUBLE", "engine": "VARCHAR", "seconds": "DOUBLE"}
SQL["p4_meta"] = _NESTED + f"""
SELECT result_id, page_no, -1 AS row_no, '' AS column_key, result_id || '/' || p || '/meta' AS node_key, result_id || '/' || p AS parent_key,
  {", ".join(f"try_cast(coalesce(meta->>'{c}', meta->'cells'->>'{c.removeprefix('cells_')}') AS {kind}) AS {c}" if c.startswith("cells_") else f"try_cast(meta->>'{c}' AS {kind}) AS {c}" for c, kind in _META.items())},
  nullif(json_merge_patch(meta, '{_listed(*_META, 'cells')}')::VARCHAR, '{{}}') AS rest FROM pages WHERE json_type(meta) <> 'NULL'"""
SQL["p4_tables"] = _NESTED + """
SELECT tag, n, n AS with_parent FROM (
  SELECT 'page' AS tag, count(*) AS n FROM pages UNION ALL SELECT 'row', count(*) FROM rows_ UNION ALL SELECT 'review', count(*) FROM reviews UNION ALL SELECT 'broken', count(*) FROM pg WHERE j IS NULL
  UNION ALL SELECT 'meta', count(*) FROM pages WHERE json_type(meta) <> 'NULL' UNION ALL SELECT 'check', coalesce(sum(json_array_length(x->'_check_failures')), 0)::BIGINT FROM rows_) WHERE n > 0"""
SQL["p4_broken"] = _NESTED + """
SELECT result_id, -1 AS page_no, -1 AS row_no, '' AS column_key, result_id || '/broken' AS node_key, result_id::VARCHAR AS parent_key,
  CASE WHEN trim(coalesce(payload, '')) = '' THEN 'empty' WHEN NOT json_valid(payload) THEN 'not JSON' ELSE 'no pages' END AS reason, NULL::VARCHAR AS rest FROM pg JOIN page_results USING (result_id) WHERE pg.j IS NULL"""


def _export_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return field_profiles(table(spark, sf, "form_exports"), "series_id", "file_no", "file_id", "record_json")


def p2_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The plain fields of each file on the first level, by JSON type: how many values, how many different ones, and their range."""
    profiles = _export_profiles(spark, sf).where("kind not in ('array', 'object')").where(~F.rlike("path", F.lit(r"(?<!\\)\.")))
    return profiles.select("series", "file_id", "path", "kind", "n", F.col("distinct").alias("distinct_values"), "low", "high")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of fields; a field that moved to another parent is removed there and added here."""
    changes = schema_changes(cut(_export_profiles(spark, sf))).where(~F.col("change_kind").isin("wrapped", "unwrapped"))
    pair = lambda kind, old, new: F.struct(F.lit(kind).alias("change_kind"), old.alias("old_name"), new.alias("new_name"))
    own = F.array(F.struct("change_kind", "old_name", "new_name"))
    both = F.array(pair("removed", F.col("old_name"), F.lit("")), pair("added", F.lit(""), F.col("new_name")))
    return changes.select("file_id", F.explode(F.when(F.col("change_kind") == "moved", both).otherwise(own)).alias("c")).select("file_id", "c.*")


def p2_unified(spark: SparkSession, sf: str) -> DataFrame:
    exports = table(spark, sf, "form_exports")
    return unify(exports, compile_projections(cut(_export_profiles(spark, sf))), "file_id", "record_json")


def p2_table(spark: SparkSession, sf: str) -> DataFrame:
    """The consistent table: the two named fields of the two forms as columns, and all fields under their names and types."""
    rows = p2_unified(spark, sf)
    return rows.select(
        "export_rec_id", "series_id", "file_no", "line_no", "form_title",
        *[F.get_json_object("fields", f"$.{c}").alias(c) for c in ("form_id", "col_0")],
        F.col("fields").alias("record"),
    )


def p2_kept(spark: SparkSession, sf: str) -> DataFrame:
    """How many values each record has in the consistent table: as many as in the raw record."""
    return p2_unified(spark, sf).select("export_rec_id", F.coalesce(F.array_size(F.json_object_keys("fields")), F.lit(0)).cast("long").alias("n_values"))


def p2_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the consistent table of each series: name, type, and the files that have it."""
    paths = compile_projections(cut(_export_profiles(spark, sf)))
    return paths.groupBy("series", F.col("to_name").alias("name"), F.col("to_type").alias("type")).agg(F.countDistinct("file_id").alias("files"))


QUERIES |= {"p2_found": p2_found, "p2_table": p2_table, "p2_columns": p2_columns, "p2_kept": p2_kept, "p2_fields": p2_fields}
SQL["p2_fields"] = r"""
WITH f AS (SELECT series_id AS series, file_id, replace(j.key, '.', '\.') AS path, j.type AS type, j.value AS value
  FROM form_exports, json_each(CASE WHEN json_valid(record_json) AND json_type(record_json) = 'OBJECT' THEN record_json END) j WHERE j.type NOT IN ('ARRAY', 'OBJECT')),
k AS (SELECT series, file_id, path, CASE type WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'truth' WHEN 'NULL' THEN 'null' WHEN 'DOUBLE' THEN 'fraction' ELSE 'whole' END AS kind, value FROM f)
SELECT series, file_id, path, kind, count(*) AS n, CASE WHEN kind = 'null' THEN 0 ELSE count(DISTINCT value::VARCHAR) END AS distinct_values,
  min(CASE WHEN kind IN ('whole', 'fraction') THEN value::DOUBLE END) AS low, max(CASE WHEN kind IN ('whole', 'fraction') THEN value::DOUBLE END) AS high FROM k GROUP BY series, file_id, path, kind"""
SQL["p2_kept"] = """
SELECT export_rec_id, coalesce(n, 0) AS n_values FROM form_exports LEFT JOIN (
  SELECT export_rec_id, count(*) AS n FROM form_exports, json_tree(CASE WHEN json_valid(record_json) THEN record_json END) j
  WHERE j.type <> 'OBJECT' AND j.fullkey <> '$' AND j.fullkey NOT LIKE '%]' GROUP BY export_rec_id) USING (export_rec_id)"""


PROFILED = ("scrap_note_rows", "scan_pages")


def _each(spark: SparkSession, sf: str, profile: Callable[[DataFrame], DataFrame]) -> DataFrame:
    parts = [profile(table(spark, sf, t)).select(F.lit(t).alias("table_name"), "*") for t in PROFILED]
    return parts[0].unionByName(parts[1])


def p1_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of both tables."""
    return _each(spark, sf, profile_table).drop("null_share", "chunks", "scanned_chunks")


def p1_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """The patterns of every text column of both tables."""
    return _each(spark, sf, profile_patterns)


def p1_load_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of each load: one row per load and field, deliveries counted once."""
    profiles = _load_profiles(spark, sf)
    both = profiles[0].unionByName(profiles[1])
    return both.select(F.col("load").alias("load_id"), F.col("station").alias("station_id"), "field_name", "n", "nulls", "n_values", "n_distinct", "low", "high", F.col("forms")[0].alias("whole_values"))


def note_fields() -> list[LoadField]:
    return [LoadField("rejection_qty", lambda v: ~v.isin(*STAND_IN_QUANTITIES), log_scale=True), LoadField("_confidence")]


def page_fields() -> list[LoadField]:
    return [LoadField("cells_empty")]


def _load_profiles(spark: SparkSession, sf: str) -> list[DataFrame]:
    notes = load_profiles(table(spark, sf, "scrap_note_rows"), "rec_id", "load_id", "station_id", note_fields(), footers=True)
    press = {"form_title": "PRESS SHOP REJECTION REPORT"}
    pages = load_profiles(table(spark, sf, "scan_pages"), "page_id", "load_id", "station_id", page_fields(), press, footers=True)
    return [notes, pages]


def p1_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Loads that depart from their station's other loads, with the reasons."""
    notes, pages = _load_profiles(spark, sf)
    return departing_loads(notes, note_fields()).unionByName(departing_loads(pages, page_fields()))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_loads(spark, sf).select(F.col("load").alias("load_id"), "field_name")


QUERIES |= {"p1_found": p1_found, "p1_loads": p1_loads, "p1_profile": p1_profile, "p1_patterns": p1_patterns, "p1_load_profiles": p1_load_profiles}

# The columns of both tables by kind.
_NUMBERS_OF = {
    "scrap_note_rows": "rec_id page_id load_id station_id _row s_no rejection_qty _confidence",
    "scan_pages": "page_id page_no station_id load_id orientation_applied skew_deg grid_rows grid_cols cells_total cells_empty cells_dash cells_ocr cells_low_confidence mean_ocr_confidence checks_passed checks_failed seconds_taken",
}
_TEXTS_OF = {"scrap_note_rows": "item_code item_name unit vendor_name reason_remarks", "scan_pages": "file_name form_id form_title page_source orientation_method matched_header_text engine"}
_TIMES_OF = {t: "scanned_at loaded_at" for t in PROFILED}
_SHOWN = {"n": ("{f}::DOUBLE", "NULL::VARCHAR"), "t": ("NULL::DOUBLE", "{f}"), "s": ("NULL::DOUBLE", "strftime({f}, '%Y-%m-%d %H:%M:%S.%f')")}
SQL["p1_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{f}' AS field, count(*) AS rows, count(*) - count({f}) AS nulls, count(DISTINCT {f}) AS distinct_values, "
    f"min({_SHOWN[kind][0]}) AS low, max({_SHOWN[kind][0]}) AS high, min({_SHOWN[kind][1]}) AS low_text, max({_SHOWN[kind][1]}) AS high_text FROM {t}".replace("{f}", f)
    for t in PROFILED
    for kind, columns in (("n", _NUMBERS_OF), ("t", _TEXTS_OF), ("s", _TIMES_OF))
    for f in columns[t].split()
)
SQL["p1_patterns"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{f}' AS field, regexp_replace(regexp_replace({f}, '\\pL+', 'a', 'g'), '[0-9]+', '9', 'g') AS pattern, count(DISTINCT {f}) AS distinct_values FROM {t} WHERE {f} IS NOT NULL GROUP BY 3"
    for t in PROFILED
    for f in _TEXTS_OF[t].split()
)
SQL["p1_load_profiles"] = f"""
WITH notes AS (SELECT DISTINCT ON (rec_id, load_id) * FROM scrap_note_rows WHERE load_id IS NOT NULL),
v AS (SELECT load_id, station_id, 'rejection_qty' AS field_name, rejection_qty::DOUBLE AS raw, CASE WHEN rejection_qty NOT IN ({_NUMBERS}) THEN rejection_qty::DOUBLE END AS v FROM notes
  UNION ALL SELECT load_id, station_id, '_confidence', _confidence, _confidence FROM notes
  UNION ALL SELECT load_id, station_id, 'cells_empty', cells_empty::DOUBLE, cells_empty::DOUBLE FROM scan_pages WHERE form_title = 'PRESS SHOP REJECTION REPORT' AND load_id IS NOT NULL)
SELECT load_id, min(station_id) AS station_id, field_name, count(*) AS n, count(*) - count(raw) AS nulls, count(v) AS n_values, count(DISTINCT v) AS n_distinct, min(v) AS low, max(v) AS high,
  count(*) FILTER (abs(v - round(v)) < 1e-6 * greatest(abs(v), 1.0)) AS whole_values FROM v GROUP BY load_id, field_name"""
