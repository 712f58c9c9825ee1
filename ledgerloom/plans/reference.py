"""Queries of the form operators, bound to the tables of a data folder, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import geometry as G
from ledgerloom.functions import text as T
from ledgerloom.operators import assemble, classify, lattice, orient, raster, sequence
from ledgerloom.operators.flatten import emit
from ledgerloom.operators.providers import readable, words_to_reading
from ledgerloom.operators.templates import SCRAP_NOTE, bind_columns, keywords_of, match_template, template_tables
from ledgerloom.session import table
from ledgerloom.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"
_TEXT = STRIP.format("text")
_MARKERS = ", ".join("'" + m.replace("'", "''") + "'" for m in SCRAP_NOTE.ditto_markers)


# Pages and texts -----------------------------------------------------------------------------------------------------
@query("q_page_route", f"SELECT doc_id, CASE WHEN length({_TEXT}) >= 40 THEN 'text' ELSE 'scan' END AS page_source FROM documents")
def q_page_route(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.page_source(F.col("text")).alias("page_source"))


@query("q_text_pages", f"SELECT doc_id, length({_TEXT}) AS text_length, left({_TEXT}, 200) AS shown FROM documents WHERE length({_TEXT}) >= 40")
def q_text_pages(spark, sf):
    pages = table(spark, sf, "documents").where(T.page_source(F.col("text")) == "text")
    return pages.select("doc_id", F.length(T.strip(F.col("text"))).alias("text_length"), F.substring(T.strip(F.col("text")), 1, 200).alias("shown"))


@query("q_any_text_layer", f"SELECT source, coalesce(bool_or(length({_TEXT}) >= 40), false) AS has_text FROM documents GROUP BY source")
def q_any_text_layer(spark, sf):
    return files.has_text_layer(table(spark, sf, "documents"), "source")


@query("q_page_union", f"""
SELECT doc_id, 'text' AS page_source, length({_TEXT}) AS text_length FROM documents WHERE length({_TEXT}) >= 40
UNION ALL SELECT doc_id, 'scan', NULL FROM documents WHERE coalesce(length({_TEXT}), 0) < 40""")
def q_page_union(spark, sf):
    texts, scans = files.route(table(spark, sf, "documents").select("doc_id", "text"))
    columns = ["doc_id", F.col("source").alias("page_source")]
    return texts.select(*columns, F.length("text").alias("text_length")).unionByName(scans.select(*columns), allowMissingColumns=True)


@query("q_largest_image", """
SELECT p_brand, p_size, arg_max(p_partkey, (p_size * (p_partkey % 97 + 1), -p_partkey)) AS p_partkey, max(p_size * (p_partkey % 97 + 1)) AS area FROM part GROUP BY p_brand, p_size""")
def q_largest_image(spark, sf):
    """Parts as pictures: a brand and size is a page, the picture of a part has an area of its own."""
    image = F.struct("p_partkey", F.col("p_size").alias("width"), (F.col("p_partkey") % 97 + 1).cast("int").alias("height"))
    pages = table(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.array_sort(F.collect_list(image)).alias("images"))
    best = F.col("image")
    return files.pick_largest(pages).select("p_brand", "p_size", best["p_partkey"].alias("p_partkey"), (best["width"].cast("long") * best["height"]).alias("area"))


@query("q_coerce_numeric", """
WITH t AS (SELECT c_custkey, c_name AS x FROM customer UNION ALL SELECT c_custkey, ' ' || c_custkey::VARCHAR || ' ' FROM customer UNION ALL SELECT c_custkey, c_mktsegment FROM customer)
SELECT c_custkey, try_cast(nullif(regexp_replace(x, '[^0-9]', '', 'g'), '') AS BIGINT) AS value,
  regexp_replace(x, '[^0-9]', '', 'g') <> '' AND regexp_replace(x, '[^0-9]', '', 'g') = trim(x) AS clean FROM t""")
def q_coerce_numeric(spark, sf):
    c = table(spark, sf, "customer")
    texts = [F.col("c_name"), F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")), F.col("c_mktsegment")]
    rows = c.select("c_custkey", F.explode(F.array(*texts)).alias("x")).withColumn("r", T.coerce_number(F.col("x")))
    return rows.select("c_custkey", F.col("r.value").cast("long").alias("value"), F.col("r.clean").alias("clean"))


@query("q_coerce_text", f"SELECT doc_id, nullif({STRIP.format('lang')}, '') AS value, coalesce({STRIP.format('lang')} <> '', false) AS clean FROM documents")
def q_coerce_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.coerce_text(F.col("lang")).alias("r")).select("doc_id", "r.value", "r.clean")


@query("q_ditto_match", f"SELECT rec_id, loaded_at, coalesce(regexp_replace(reason_remarks, '\\s+', '', 'g') IN ({_MARKERS}), false) AS ditto FROM scrap_note_rows")
def q_ditto_match(spark, sf):
    return table(spark, sf, "scrap_note_rows").select("rec_id", "loaded_at", T.is_ditto(F.col("reason_remarks"), list(SCRAP_NOTE.ditto_markers)).alias("ditto"))


@query("q_normalize_text", r"SELECT rec_id, loaded_at, lower(trim(regexp_replace(item_name, '\s+', ' ', 'g'))) AS normal FROM scrap_note_rows")
def q_normalize_text(spark, sf):
    return table(spark, sf, "scrap_note_rows").select("rec_id", "loaded_at", T.normalize(F.col("item_name")).alias("normal"))


@query("q_header_band", "SELECT doc_id, length(b) AS chars, md5(b) AS digest FROM (SELECT doc_id, substr(text, 1, greatest(1, floor(length(text) * 0.18)::INT)) AS b FROM documents)")
def q_header_band(spark, sf):
    band = T.header_band(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.length(band).alias("chars"), F.md5(band.cast("binary")).alias("digest"))


@query("q_page_stem", "SELECT page_id, replace(regexp_replace(file_name, '\\.[^.]*$', '') || '_p' || page_no::VARCHAR, ' ', '_') AS stem FROM scan_pages")
def q_page_stem(spark, sf):
    return table(spark, sf, "scan_pages").select("page_id", T.page_stem(F.col("file_name"), F.col("page_no")).alias("stem"))


_KEYWORDS = [*keywords_of(), ("press", 2, "PRESS SHOP"), ("press", 2, "F/12"), ("weld", 3, "WELD  SHOP"), ("weld", 3, "F/13"), ("any_report", 4, "rejection report")]
_MATCH = """
WITH k(form_id, ord, w) AS (VALUES ('mis_plating', 0, 'daily mis report'), ('mis_plating', 0, 'mppl/f/qad/35'), ('scrap_note', 1, 'scrap note'), ('scrap_note', 1, 'mppl/f/str/07'),
  ('press', 2, 'press shop'), ('press', 2, 'f/12'), ('weld', 3, 'weld shop'), ('weld', 3, 'f/13'), ('any_report', 4, 'rejection report')),
h AS (SELECT page_id, form_title, lower(trim(regexp_replace(coalesce(matched_header_text, ''), '\\s+', ' ', 'g'))) AS t FROM scan_pages),
s AS (SELECT page_id, form_id, ord, sum(contains(t, w)::INT) AS hits FROM h CROSS JOIN k GROUP BY ALL),
b AS (SELECT page_id, arg_max(form_id, (hits, -ord)) AS form_id, max(hits)::INT AS hits FROM s GROUP BY page_id)
"""


@query("q_template_match", _MATCH + "SELECT page_id, form_id, hits FROM b WHERE hits > 0")
def q_template_match(spark, sf):
    return match_template(table(spark, sf, "scan_pages"), "page_id", "matched_header_text", _KEYWORDS).where("hits > 0")


@query("q_template_fallback", _MATCH + "SELECT page_id, CASE WHEN hits > 0 THEN b.form_id ELSE 'generic' END AS form_id, CASE WHEN hits = 0 THEN list_transform(range(grid_cols), lambda i: 'col_' || i::VARCHAR) END AS columns FROM b JOIN scan_pages USING (page_id)")
def q_template_fallback(spark, sf):
    pages = table(spark, sf, "scan_pages")
    matched = match_template(pages.withColumn("k", F.struct("page_id", "grid_cols")), "k", "matched_header_text", _KEYWORDS)
    names = F.transform(F.sequence(F.lit(0), F.col("k.grid_cols") - 1), lambda i: F.concat(F.lit("col_"), i.cast("string")))
    return matched.select("k.page_id", "form_id", F.when(F.col("hits") == 0, names).alias("columns"))


@query("q_template_columns", """
SELECT w.rec_id, w.loaded_at, c.key, c.v AS value, c.kind FROM weld_shop_rows w, LATERAL (VALUES ('s_no', w.col_0, 'integer'), ('item_code', w.col_1, 'text'), ('item_name', w.col_2, 'text'),
 ('unit', w.col_3, 'text'), ('rejection_qty', w.col_4, 'integer'), ('vendor_name', w.col_5, 'text'), ('reason_remarks', w.col_6, 'text')) c(key, v, kind) WHERE w._row >= 4 AND w._row < 37 - 1""")
def q_template_columns(spark, sf):
    dims = template_tables(spark)
    rows = table(spark, sf, "weld_shop_rows").withColumnRenamed("_row", "row")
    cells = rows.select("rec_id", "loaded_at", "row", F.lit("scrap_note").alias("form_id"), F.lit(37).alias("n_rows"), F.posexplode(F.array(*[f"col_{i}" for i in range(7)])).alias("col", "value"))
    return bind_columns(cells, dims["forms"], dims["columns"]).select("rec_id", "loaded_at", "key", "value", F.col("type").alias("kind"))


@query("q_engine_flags", "SELECT p_partkey, '--psm 7 --oem 3' || CASE WHEN p_size % 2 = 0 THEN ' -c tessedit_char_whitelist=0123456789' ELSE '' END AS flags FROM part")
def q_engine_flags(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.engine_flags(F.col("p_size") % 2 == 0).alias("flags"))


@query("q_error_isolation", "SELECT result_id, coalesce(json_valid(payload), false) AS readable FROM page_results")
def q_error_isolation(spark, sf):
    """Result documents as files, read by a parser that raises on some: these become one page -1 with the error."""
    import json

    raw = table(spark, sf, "page_results").select(F.col("result_id").cast("string").alias("file"), F.col("payload").cast("binary").alias("content"))
    pages = files.read_pages(raw, lambda content: [(type(json.loads(content)).__name__, None)])
    return pages.select(F.col("file").cast("long").alias("result_id"), F.col("error").isNull().alias("readable"))


# Rasters and lattices ------------------------------------------------------------------------------------------------
_PIXELS = "p AS (SELECT vec_id, ((i - 1) // 8)::INT AS y, ((i - 1) % 8)::INT AS x, v FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"
_PROFILE = {a: f"n AS (SELECT vec_id, {a}, count(*) FILTER (v > 0) AS n FROM p GROUP BY ALL)" for a in "yx"}


def _pixels(spark, sf):
    return raster.to_pixels(table(spark, sf, "embeddings"), "vec_id", "embedding", 8)


@query("q_projection_rows", f"WITH {_PIXELS}, {_PROFILE['y']} SELECT vec_id, y, n FROM n")
def q_projection_rows(spark, sf):
    return lattice.projection(_pixels(spark, sf), ["vec_id"], "y", F.col("v") > 0)


@query("q_projection_cols", f"WITH {_PIXELS}, {_PROFILE['x']} SELECT vec_id, x, n FROM n")
def q_projection_cols(spark, sf):
    return lattice.projection(_pixels(spark, sf), ["vec_id"], "x", F.col("v") > 0)


@query("q_peaks", f"WITH {_PIXELS}, {_PROFILE['y']} SELECT vec_id, y, n FROM n QUALIFY max(n) OVER (PARTITION BY vec_id) > 0 AND n > 0.6 * max(n) OVER (PARTITION BY vec_id)")
def q_peaks(spark, sf):
    return lattice.peaks(q_projection_rows(spark, sf), ["vec_id"], 0.6)


def _lattices(spark, sf):
    pixels = _pixels(spark, sf)
    sides = []
    for axis, name in (("y", "ys"), ("x", "xs")):
        profile = lattice.projection(pixels, ["vec_id"], axis, F.col("v") > 0).withColumn(axis, F.col(axis) * 20)
        sides.append(lattice.boundaries(lattice.peaks(profile, ["vec_id"], 0.6), ["vec_id"], axis, 40).withColumnRenamed("coords", name))
    return sides[0].join(sides[1], "vec_id")


def _boundary_sql(a: str) -> str:
    return f"""
n{a} AS (SELECT vec_id, {a} * 20 AS c, count(*) FILTER (v > 0) AS n FROM p GROUP BY vec_id, {a}),
k{a} AS (SELECT vec_id, c, row_number() OVER (PARTITION BY vec_id ORDER BY c) AS rn FROM (SELECT vec_id, c FROM n{a} QUALIFY max(n) OVER (PARTITION BY vec_id) > 0 AND n > 0.6 * max(n) OVER (PARTITION BY vec_id))),
t{a} AS (SELECT vec_id, rn, c AS last, [c::INT] AS kept FROM k{a} WHERE rn = 1
  UNION ALL SELECT k.vec_id, k.rn, CASE WHEN k.c - t.last >= 40 THEN k.c ELSE t.last END, CASE WHEN k.c - t.last >= 40 THEN list_append(t.kept, k.c::INT) ELSE t.kept END FROM t{a} t JOIN k{a} k ON k.vec_id = t.vec_id AND k.rn = t.rn + 1),
{a}s AS (SELECT vec_id, arg_max(kept, rn) AS {a}s FROM t{a} GROUP BY vec_id)"""


_CELLS = f"""
WITH RECURSIVE {_PIXELS},{_boundary_sql('y')},{_boundary_sql('x')},
cells AS (SELECT vec_id, (r - 1)::INT AS row, (c - 1)::INT AS col, xs[c] AS x0, ys[r] AS y0, xs[c + 1] AS x1, ys[r + 1] AS y1
  FROM ys JOIN xs USING (vec_id), LATERAL (SELECT unnest(range(1, len(ys))) AS r), LATERAL (SELECT unnest(range(1, len(xs))) AS c))
"""


@query("q_lattice_cells", _CELLS + "SELECT * FROM cells")
def q_lattice_cells(spark, sf):
    return lattice.explode_cells(_lattices(spark, sf), ["vec_id"])


@query("q_grid_size", _CELLS + "SELECT vec_id, greatest(0, len(ys) - 1)::INT AS n_rows, greatest(0, len(xs) - 1)::INT AS n_cols FROM ys JOIN xs USING (vec_id)")
def q_grid_size(spark, sf):
    return _lattices(spark, sf).select("vec_id", F.greatest(F.lit(0), F.size("ys") - 1).alias("n_rows"), F.greatest(F.lit(0), F.size("xs") - 1).alias("n_cols"))


@query("q_overlay", _CELLS + """
SELECT vec_id, 'horizontal' AS shape, unnest(ys) AS at, NULL::INT AS x0, NULL::INT AS y0, NULL::INT AS x1, NULL::INT AS y1 FROM ys JOIN xs USING (vec_id)
UNION ALL SELECT vec_id, 'vertical', unnest(xs), NULL, NULL, NULL, NULL FROM ys JOIN xs USING (vec_id)
UNION ALL SELECT vec_id, 'cell', NULL, x0 + 2, y0 + 2, x1 - 2, y1 - 2 FROM cells""")
def q_overlay(spark, sf):
    lines = _lattices(spark, sf)
    return lattice.overlay(lines, lattice.explode_cells(lines, ["vec_id"]), ["vec_id"])


@query("q_cell_lookup", _CELLS + "SELECT a.vec_id, a.row, a.col, b.x1 - a.x0 AS span FROM cells a JOIN cells b ON b.vec_id = a.vec_id AND b.row = a.row AND b.col = a.col + 1")
def q_cell_lookup(spark, sf):
    cells = q_lattice_cells(spark, sf)
    right = cells.select("vec_id", "row", (F.col("col") - 1).alias("col"), F.col("x1").alias("right_x1"))
    return cells.join(right, ["vec_id", "row", "col"]).select("vec_id", "row", "col", (F.col("right_x1") - F.col("x0")).alias("span"))


@query("q_crop_geometry", _CELLS + """
, c AS (SELECT *, least(x0 + 3, x1 - 1) AS cx0, least(y0 + 3, y1 - 1) AS cy0 FROM cells), d AS (SELECT *, greatest(x1 - 3, cx0 + 1) AS cx1, greatest(y1 - 3, cy0 + 1) AS cy1 FROM c)
SELECT vec_id, row, col, cx0, cy0, cx1, cy1, (cx1 - cx0) * 3 + 24 AS ocr_w, (cy1 - cy0) * 3 + 24 AS ocr_h FROM d""")
def q_crop_geometry(spark, sf):
    boxes = q_lattice_cells(spark, sf).withColumns(G.inset(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))
    sized = boxes.withColumns(G.recognizer_size(F.col("cx1") - F.col("cx0"), F.col("cy1") - F.col("cy0")))
    return sized.select("vec_id", "row", "col", "cx0", "cy0", "cx1", "cy1", "ocr_w", "ocr_h")


@query("q_binarize_boxmean", f"""
WITH {_PIXELS}, i AS (SELECT vec_id, y, x, floor(v::DOUBLE * 1000)::INT AS v FROM p)
SELECT a.vec_id, a.y, a.x, any_value(a.v) AS v, (any_value(a.v) * count(*) > sum(b.v) + 15 * count(*))::INT AS ink
FROM i a JOIN i b ON b.vec_id = a.vec_id AND abs(b.y - a.y) <= 1 AND abs(b.x - a.x) <= 1 GROUP BY a.vec_id, a.y, a.x""")
def q_binarize_boxmean(spark, sf):
    pixels = _pixels(spark, sf).withColumn("v", F.floor(F.col("v").cast("double") * 1000).cast("int"))
    return raster.box_threshold(pixels, ["vec_id"], "v", 15).select("vec_id", "y", "x", "v", "ink")


_NEAR = "OVER (PARTITION BY vec_id, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"
_INK = f"{_PIXELS}, b AS (SELECT vec_id, y, x, (v > 0)::INT AS ink FROM p)"


def _ink(spark, sf):
    return _pixels(spark, sf).select("vec_id", "y", "x", (F.col("v") > 0).cast("int").alias("ink"))


@query("q_dilate_1d", f"WITH {_INK} SELECT vec_id, y, x, max(ink) {_NEAR} AS grown FROM b")
def q_dilate_1d(spark, sf):
    pixels = _ink(spark, sf)
    return pixels.select("vec_id", "y", "x", raster.along(pixels, ["vec_id"], "x", "ink", 1, 1, False).alias("grown"))


@query("q_erode_1d", f"WITH {_INK} SELECT vec_id, y, x, min(ink) {_NEAR} AS shrunk FROM b")
def q_erode_1d(spark, sf):
    pixels = _ink(spark, sf)
    return pixels.select("vec_id", "y", "x", raster.along(pixels, ["vec_id"], "x", "ink", 1, 1, True).alias("shrunk"))


_OPEN = f"""{_INK}, e AS (SELECT *, min(ink) {_NEAR} AS er, min(ink) OVER (PARTITION BY vec_id, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS ec FROM b),
o AS (SELECT vec_id, y, x, ink, max(er) {_NEAR} AS h, max(ec) OVER (PARTITION BY vec_id, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM e),
l AS (SELECT *, greatest(h, v) AS line FROM o)"""


def _lines(spark, sf):
    opened = raster.open_along(raster.open_along(_ink(spark, sf), ["vec_id"], "x", "ink", "h"), ["vec_id"], "y", "ink", "v")
    return opened.withColumn("line", F.greatest("h", "v"))


@query("q_open_1d", f"WITH {_OPEN} SELECT vec_id, y, x, h, v FROM o")
def q_open_1d(spark, sf):
    return _lines(spark, sf).select("vec_id", "y", "x", "h", "v")


@query("q_line_mask", f"WITH {_OPEN}, r AS (SELECT vec_id, y, x, max(line) {_NEAR} AS m FROM l) SELECT vec_id, y, x, max(m) OVER (PARTITION BY vec_id, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS mask FROM r")
def q_line_mask(spark, sf):
    lines = _lines(spark, sf)
    wide = lines.withColumn("m", raster.along(lines, ["vec_id"], "x", "line", 1, 1, False))
    return wide.select("vec_id", "y", "x", raster.along(wide, ["vec_id"], "y", "m", 1, 1, False).alias("mask"))


@query("q_content_mask", f"WITH {_OPEN} SELECT vec_id, y, x FROM l WHERE ink = 1 AND line = 0")
def q_content_mask(spark, sf):
    return _lines(spark, sf).where("ink = 1 and line = 0").select("vec_id", "y", "x")


@query("q_rotate_quarter", f"WITH {_INK} SELECT vec_id, x AS y90, 7 - y AS x90, 7 - y AS y180, 7 - x AS x180, 7 - x AS y270, y AS x270, ink FROM b")
def q_rotate_quarter(spark, sf):
    turned = {f"{c}{d}": v for d in (90, 180, 270) for c, v in zip("yx", raster.quarter_turn(F.col("y"), F.col("x"), 8, 8, d))}
    return _ink(spark, sf).select("vec_id", *[v.alias(c) for c, v in turned.items()], "ink")


@query("q_ink_ratio", f"WITH {_INK} SELECT vec_id, avg(ink) AS ink_ratio FROM b GROUP BY vec_id")
def q_ink_ratio(spark, sf):
    return _features(spark, sf, 0.0).select("vec_id", "ink_ratio")


def _features(spark, sf, cut: float):
    masks = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: (v > cut).cast("int")).alias("mask"))
    return raster.cell_features(masks, "vec_id", "mask", 8).withColumnRenamed("key", "vec_id")


@query("q_components", f"""
WITH RECURSIVE {_PIXELS}, b AS (SELECT vec_id, y, x FROM p WHERE v > 0.15),
r AS (SELECT vec_id, y, x, y AS y2, x AS x2 FROM b UNION SELECT r.vec_id, r.y, r.x, b.y, b.x FROM r JOIN b ON b.vec_id = r.vec_id AND abs(b.y - r.y2) <= 1 AND abs(b.x - r.x2) <= 1),
c AS (SELECT vec_id, y, x, min(y2 * 8 + x2) AS label FROM r GROUP BY ALL)
SELECT vec_id, min(x)::INT AS x0, min(y)::INT AS y0, max(x)::INT + 1 AS x1, max(y)::INT + 1 AS y1 FROM c GROUP BY vec_id, label""")
def q_components(spark, sf):
    return _features(spark, sf, 0.15).select("vec_id", F.explode("blobs").alias("b")).select("vec_id", *[f"b.{c}" for c in ("x0", "y0", "x1", "y1")])


@query("q_classify")
def q_classify(spark, sf):
    """Rows only: areas come from bit quads of labelled blobs, which the tests check against border tracing."""
    rule = classify.CellRule(empty_ink=0.05, least_area=0.5, least_cover=0.012, dash_ink=0.30, dash_aspect=1.5, dash_height=0.35)
    kind = classify.cell_kind(F.col("h"), F.col("w"), F.col("ink_ratio"), F.col("blobs"), rule)
    return _features(spark, sf, 0.15).select("vec_id", "ink_ratio", kind.alias("k")).select("vec_id", "ink_ratio", "k.kind", "k.components")


# Sequences -----------------------------------------------------------------------------------------------------------
_SECONDS = "s AS (SELECT user_id, event_id, epoch(date_trunc('second', ts))::BIGINT - 1704067200 AS sec FROM events)"


def _seconds(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_id", (F.unix_timestamp(F.date_trunc("second", F.col("ts")).cast("timestamp")) - 1704067200).alias("sec"))


@query("q_gap_merge", f"""
WITH {_SECONDS}, d AS (SELECT *, coalesce((sec - lag(sec) OVER w > 7200)::INT, 0) AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS UNBOUNDED PRECEDING) AS run FROM d)
SELECT user_id, run::BIGINT AS run, min(sec) AS first, max(sec) AS last, count(*) AS n, round_even(avg(sec), 0)::BIGINT AS centre FROM r GROUP BY user_id, run""")
def q_gap_merge(spark, sf):
    return sequence.gap_merge(_seconds(spark, sf), ["user_id"], "sec", 7200, ["sec", "event_id"])


@query("q_min_gap_thin", f"""
WITH RECURSIVE {_SECONDS}, k AS (SELECT user_id, sec, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS rn FROM s),
t AS (SELECT user_id, rn, sec, sec AS last, true AS kept FROM k WHERE rn = 1
  UNION ALL SELECT k.user_id, k.rn, k.sec, CASE WHEN k.sec - t.last >= 7200 THEN k.sec ELSE t.last END, k.sec - t.last >= 7200 FROM t JOIN k ON k.user_id = t.user_id AND k.rn = t.rn + 1)
SELECT user_id, sec FROM t WHERE kept""")
def q_min_gap_thin(spark, sf):
    return sequence.thin_rows(_seconds(spark, sf), ["user_id"], "sec", 7200)


@query("q_pairs", f"""
WITH {_SECONDS}, n AS (SELECT user_id, sec // 86400 AS day, sec, lead(sec) OVER (PARTITION BY user_id, sec // 86400 ORDER BY sec) AS stop FROM s)
SELECT user_id, day, sec::INT AS start, stop::INT AS stop FROM n WHERE stop IS NOT NULL""")
def q_pairs(spark, sf):
    days = _seconds(spark, sf).groupBy("user_id", F.floor(F.col("sec") / 86400).alias("day")).agg(F.array_sort(F.collect_list("sec")).alias("at"))  # a user's day
    return days.select("user_id", "day", F.explode(sequence.consecutive(F.col("at"))).alias("p")).select("user_id", "day", F.col("p.start").alias("start"), F.col("p.end").alias("stop"))


# Cells, rows, review, checks -----------------------------------------------------------------------------------------
# Every event is a row of two cells: a, a text that may be blank, dashed or a ditto, and b, a number that may be dirty.
_FACTS = """
e AS (SELECT user_id AS page, event_id AS row, event_type, json_extract(props, '$.k')::INT AS k, value AS v FROM events),
c AS (SELECT page, row, 'a' AS key, 0 AS col, CASE WHEN v < 10 THEN 'empty' WHEN v < 25 THEN 'dash' WHEN event_type = 'error' THEN 'ditto' ELSE 'ocr' END AS outcome,
    CASE WHEN k % 10 <> 0 THEN event_type END AS read, CASE WHEN k % 10 <> 0 THEN event_type ELSE ' ' END AS raw, k % 10 <> 0 AS ok, k FROM e
  UNION ALL SELECT page, row, 'b', 1, 'ocr', CASE WHEN k % 3 <> 0 THEN k::VARCHAR END, CASE WHEN k % 3 = 0 THEN '' WHEN k % 4 = 0 THEN 'x' || k::VARCHAR ELSE k::VARCHAR END, k % 3 <> 0 AND k % 4 <> 0, k FROM e),
f AS (SELECT page, row, key, col, outcome, raw, CASE outcome WHEN 'dash' THEN '0' WHEN 'ocr' THEN read END AS value, CASE WHEN outcome = 'ocr' THEN ok END AS clean,
    CASE WHEN outcome = 'ocr' THEN k % 50 * CASE WHEN ok THEN 20 ELSE 10 END END AS conf_m,
    CASE outcome WHEN 'ocr' THEN k % 50 * CASE WHEN ok THEN 20 ELSE 10 END WHEN 'ditto' THEN 750 ELSE 970 END AS row_m FROM c)"""
_FOLD = _FACTS + """,
g AS (SELECT a.page, a.row, a.outcome, a.value AS a, b.value AS b, (a.row_m + b.row_m) // 2 AS m, row_number() OVER (PARTITION BY a.page ORDER BY a.row) AS rn FROM f a JOIN f b ON a.key = 'a' AND b.key = 'b' AND a.page = b.page AND a.row = b.row),
t AS (SELECT page, 0::BIGINT AS rn, 0::BIGINT AS row, NULL::VARCHAR AS a, NULL::VARCHAR AS b, NULL::VARCHAR AS prev, false AS emitted, 0::BIGINT AS m FROM (SELECT DISTINCT page FROM g)
  UNION ALL SELECT g.page, g.rn, g.row, CASE WHEN g.outcome = 'ditto' THEN t.prev ELSE g.a END, g.b,
    CASE WHEN g.b IS NOT NULL OR CASE WHEN g.outcome = 'ditto' THEN t.prev ELSE g.a END IS NOT NULL THEN CASE WHEN g.outcome = 'ditto' THEN t.prev ELSE g.a END ELSE t.prev END,
    g.b IS NOT NULL OR CASE WHEN g.outcome = 'ditto' THEN t.prev ELSE g.a END IS NOT NULL, g.m
  FROM t JOIN g ON g.page = t.page AND g.rn = t.rn + 1),
o AS (SELECT page, row, a, b, m FROM t WHERE emitted)"""


def _values(spark, sf):
    """Events as bound cells with readings, through ``cell_values``."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf, "events").select(F.lit("events").alias("file"), F.col("user_id").alias("page"), F.col("event_id").alias("row"), "event_type", k.alias("k"), "value")
    kind = F.when(F.col("value") < 10, "empty").when(F.col("value") < 25, "dash").otherwise("content")
    cell = lambda col, key, kind_of, type_of, ditto, text: F.struct(F.lit(col).alias("col"), F.lit(key).alias("key"), kind_of.alias("kind"), F.lit(type_of).alias("type"), F.lit(ditto).alias("ditto"), text.alias("text"))
    a = F.when(F.col("event_type") == "error", ' " ').when(F.col("k") % 10 == 0, " ").otherwise(F.col("event_type"))
    b = F.when(F.col("k") % 3 == 0, "").when(F.col("k") % 4 == 0, F.concat(F.lit("x"), "k")).otherwise(F.col("k").cast("string"))
    cells = e.select("file", "page", "row", "k", F.inline(F.array(cell(0, "a", kind, "text", True, a), cell(1, "b", F.lit("content"), "integer", False, b))))
    box = [(F.col("col") * 90 + d).cast("int").alias(c) for c, d in (("x0", 0), ("x1", 90))] + [F.lit(v).alias(c) for c, v in (("y0", 0), ("y1", 40))]
    bound = cells.select("file", "page", "row", "col", F.lit("facts").alias("form_id"), "key", "type", "ditto", "kind", F.lit(False).alias("printed"), *box)
    readings = cells.where("kind = 'content'").select("file", "page", "row", "col", "text", (F.col("k") % 50 / 50).alias("confidence"))
    forms = spark.createDataFrame([("facts", 0, ['"'])], "form_id string, dash_means long, ditto_markers array<string>")
    return assemble.cell_values(bound, readings, forms)


def _thousandths(c: str):
    return F.round(F.col(c) * 1000).cast("long")


@query("q_cell_outcomes", f"WITH {_FACTS} SELECT page, row, key, outcome, clean, conf_m, row_m, value FROM f")
def q_cell_outcomes(spark, sf):
    return _values(spark, sf).select("page", "row", "key", "outcome", "clean", _thousandths("conf").alias("conf_m"), _thousandths("row_conf").alias("row_m"), "value")


@query("q_ditto_fold", f"WITH RECURSIVE {_FOLD} SELECT page, row, a, b FROM o")
def q_ditto_fold(spark, sf):
    folded = sequence.fold_ditto(_values(spark, sf), ["page"], "row", "key", "outcome", "value", "written")
    return folded.select("page", "row", F.col("record")["a"].alias("a"), F.col("record")["b"].alias("b"))


@query("q_blank_rows", f"WITH RECURSIVE {_FOLD} SELECT g.page, count(*) AS lines, count(o.row) AS written FROM g LEFT JOIN o ON o.page = g.page AND o.row = g.row GROUP BY g.page")
def q_blank_rows(spark, sf):
    values = _values(spark, sf)
    written = assemble.rows_out(values).groupBy("page").agg(F.count("*").alias("written"))
    lines = values.groupBy("page").agg(F.count_if(F.col("key") == "a").alias("lines"))
    return lines.join(written, "page", "left").select("page", "lines", F.coalesce("written", F.lit(0)).alias("written"))


@query("q_row_confidence", f"WITH RECURSIVE {_FOLD} SELECT page, row, m AS mean_m FROM o")
def q_row_confidence(spark, sf):
    return assemble.rows_out(_values(spark, sf)).select("page", "row", _thousandths("confidence").alias("mean_m"))


_LOW = "outcome = 'ocr' AND value IS NOT NULL AND conf_m < 600"


@query("q_review_queue", f'WITH {_FACTS} SELECT page, row, key AS "column", value, raw AS raw_text, conf_m, col * 90 AS x0, col * 90 + 90 AS x1 FROM f WHERE {_LOW}')
def q_review_queue(spark, sf):
    review = assemble.review_queue(_values(spark, sf))
    return review.select("page", "row", "column", "value", "raw_text", _thousandths("confidence").alias("conf_m"), F.col("bbox")[0].alias("x0"), F.col("bbox")[2].alias("x1"))


_COUNTS = f"""n AS (SELECT page, count(*) FILTER (outcome = 'empty') AS cells_empty, count(*) FILTER (outcome = 'dash') AS cells_dash, count(*) FILTER (outcome IN ('ocr', 'ditto')) AS cells_ocr,
  count(*) FILTER ({_LOW}) AS cells_low_confidence, coalesce(avg(conf_m), 0.0) AS mean_m FROM f GROUP BY page)"""


@query("q_page_meta", f"WITH {_FACTS}, {_COUNTS} SELECT page, cells_empty, cells_dash, cells_ocr, cells_low_confidence, true AS mean_near FROM n")
def q_page_meta(spark, sf):
    """Page counts; the mean, which is rounded, is held against the values it comes from."""
    values = _values(spark, sf)
    means = values.groupBy("page").agg(F.coalesce(F.avg("conf"), F.lit(0.0)).alias("mean"))
    counts = assemble.page_counts(values).join(means, "page")
    near = F.abs(F.col("mean_ocr_confidence") - F.col("mean")) <= 0.0005 + 1e-9
    return counts.select("page", "cells_empty", "cells_dash", "cells_ocr", "cells_low_confidence", near.alias("mean_near"))


@query("q_batch_summary", f"WITH {_FACTS}, {_COUNTS} SELECT page, format('p{{}} facts: {{}} empty, {{}} dash, {{}} read, {{}} low', page, cells_empty, cells_dash, cells_ocr, cells_low_confidence) AS line FROM n")
def q_batch_summary(spark, sf):
    return assemble.summary_lines(assemble.page_counts(_values(spark, sf)).drop("mean_ocr_confidence")).select("page", "line")


@query("q_json_rows", f"""
WITH RECURSIVE {_FOLD} SELECT page::INT AS page, 'row' AS tag, row::INT AS row, a, b::BIGINT AS b, NULL AS low_column, m AS conf_m FROM o
UNION ALL SELECT page::INT, 'review', row::INT, NULL, NULL, key, conf_m FROM f WHERE {_LOW}""")
def q_json_rows(spark, sf):
    """Rows and review queue nested into documents, and read back from these by the flattening pass."""
    values = _values(spark, sf).withColumn("file", F.concat((F.col("page") % 50).cast("string"), F.lit(".pdf")))
    meta = assemble.page_counts(values)
    documents = assemble.nested_pages(assemble.rows_out(values), assemble.review_queue(values), meta, None, {"facts": ["b"]})
    emitted = emit(documents.select(F.regexp_extract("file", r"^\d+", 0).cast("long").alias("result_id"), "payload")).where("tag in ('row', 'review')")
    item = lambda c, kind: F.get_json_object("payload", f"$.{c}").cast(kind)
    confidence = F.coalesce(item("_confidence", "double"), item("confidence", "double"))
    return emitted.select(
        F.col("page_no").alias("page"), "tag", F.col("row_no").alias("row"), item("a", "string").alias("a"), item("b", "long").alias("b"),
        F.when(F.col("tag") == "review", F.col("column_key")).alias("low_column"), F.round(confidence * 1000).cast("long").alias("conf_m"),
    )


_CHECK = """
k AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, nullif((round(l_extendedprice * 100)::BIGINT % 10), 9) AS target, l_linenumber % 5 AS a, l_quantity::BIGINT % 5 AS b FROM lineitem)"""


def _identities(spark, sf):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.nullif(cents % 10, F.lit(9)).alias("target"), (F.col("l_linenumber") % 5).alias("a"), (F.col("l_quantity").cast("long") % 5).alias("b"))


def _checked(spark, sf):
    rows = _identities(spark, sf)
    record = F.create_map(*[x for c in ("target", "a", "b") for x in (F.lit(c), F.col(c).cast("string"))])
    return assemble.apply_checks(rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "target", F.lit("line").alias("form_id"), record.alias("record")), [("line", "target", ["a", "b"])])


@query("q_checks", f"WITH {_CHECK} SELECT l_suppkey, count(*) FILTER (target = a + b) AS passed, count(*) FILTER (target <> a + b) AS failed, count(*) FILTER (target IS NULL) AS skipped FROM k GROUP BY l_suppkey")
def q_checks(spark, sf):
    return _checked(spark, sf).groupBy("l_suppkey").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"), F.count_if(F.col("passed") + F.col("failed") == 0).alias("skipped"))


@query("q_check_messages", f"WITH {_CHECK} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'target=' || target::VARCHAR || ' but sum(a+b)=' || (a + b)::VARCHAR AS message FROM k WHERE target <> a + b")
def q_check_messages(spark, sf):
    return _checked(spark, sf).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.explode("check_failures").alias("message"))


@query("q_cell_accounting", """
SELECT page_id, cells_total = grid_rows * grid_cols AS whole, cells_empty + cells_dash + cells_ocr AS counted,
  CASE form_id WHEN 'scrap_note' THEN greatest(grid_rows - 5, 0) * least(grid_cols, 7) WHEN 'generic' THEN greatest(grid_rows - 1, 0) * grid_cols ELSE 0 END AS bound FROM scan_pages""")
def q_cell_accounting(spark, sf):
    """Every cell of every page's lattice, bound to its form: how many are bound, against what the page's counts say."""
    dims = template_tables(spark)
    pages = table(spark, sf, "scan_pages").select("page_id", "form_id", "grid_rows", "grid_cols", "cells_total", "cells_empty", "cells_dash", "cells_ocr")
    at = lambda n: F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
    cells = pages.where("grid_rows > 0 and grid_cols > 0").select("page_id", "form_id", F.col("grid_rows").alias("n_rows"), "grid_cols", F.explode(at(F.col("grid_rows"))).alias("row"))
    cells = cells.select("page_id", "form_id", "n_rows", "row", F.explode(at(F.col("grid_cols"))).alias("col"))
    bound = bind_columns(cells, dims["forms"], dims["columns"]).groupBy("page_id").agg(F.count("*").cast("int").alias("bound"))
    counted = F.col("cells_empty") + F.col("cells_dash") + F.col("cells_ocr")
    return pages.join(bound, "page_id", "left").select("page_id", (F.col("cells_total") == F.col("grid_rows") * F.col("grid_cols")).alias("whole"), counted.alias("counted"), F.coalesce("bound", F.lit(0)).alias("bound"))


# Words and orientation -----------------------------------------------------------------------------------------------
_WORDS = "w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS t, unnest(range(1, len(string_split(text, ' ')) + 1)) AS i FROM documents), k AS (SELECT *, length(t) * 7 % 101 - 3 AS conf FROM w)"


def _words(spark, sf):
    parts = F.transform(F.split("text", " ", -1), lambda t: F.struct(t.alias("text"), (F.length(t) * 7 % 101 - 3).alias("conf")))
    return table(spark, sf, "documents").where("text is not null").select("doc_id", parts.alias("words"))


@query("q_word_join", f"WITH {_WORDS} SELECT doc_id, md5(coalesce(string_agg(trim(t), ' ' ORDER BY i) FILTER (length(trim(t)) > 0 AND conf >= 0), '')) AS digest, coalesce(avg(conf) FILTER (length(trim(t)) > 0 AND conf >= 0) / 100, 0.0) AS confidence FROM k GROUP BY doc_id")
def q_word_join(spark, sf):
    text, confidence = words_to_reading("words")
    return _words(spark, sf).select("doc_id", F.md5(text.cast("binary")).alias("digest"), confidence.alias("confidence"))


@query("q_page_blocks", f"WITH {_WORDS} SELECT doc_id, i - 1 AS block, (i - 1) % 12 * 90 AS x0, (i - 1) // 12 * 40 AS y0, (i - 1) % 12 * 90 + length(t) * 8 AS x1, (i - 1) // 12 * 40 + 30 AS y1 FROM k WHERE length(trim(t)) > 0 AND conf >= 0")
def q_page_blocks(spark, sf):
    at = F.col("block")
    words = _words(spark, sf).select("doc_id", F.posexplode("words").alias("block", "w")).where(readable(F.col("w.text"), F.col("w.conf")))
    box = G.box(at % 12 * 90, F.floor(at / 12).cast("int") * 40, F.length("w.text") * 8, F.lit(30))
    return words.select("doc_id", "block", box.alias("b")).select("doc_id", "block", "b.*")


@query("q_orientation_pick", """
WITH s AS (SELECT vec_id, list_sum(list_transform(embedding[1:32], lambda v: floor(v::DOUBLE * 10)))::BIGINT AS a, list_sum(list_transform(embedding[33:64], lambda v: floor(v::DOUBLE * 10)))::BIGINT AS b FROM embeddings)
SELECT vec_id, CASE WHEN greatest(a, b) <= 0 THEN 0 WHEN b > a THEN 180 ELSE 0 END AS rotation, CASE WHEN greatest(a, b) > 0 THEN 'confidence' ELSE 'none' END AS method, greatest(a, b) AS score FROM s""")
def q_orientation_pick(spark, sf):
    score = lambda lo: F.aggregate(F.slice("embedding", lo, 32), F.lit(0).cast("long"), lambda a, v: a + F.floor(v.cast("double") * 10))
    both = F.array(F.struct(F.lit(0).alias("rotation"), score(1).alias("score")), F.struct(F.lit(180).alias("rotation"), score(33).alias("score")))
    scores = table(spark, sf, "embeddings").select("vec_id", F.explode(both).alias("s")).select("vec_id", "s.*")
    return orient.pick_rotation(scores, ["vec_id"], "rotation", "score")


@query("q_skew_median", """
WITH a AS (SELECT l_suppkey, degrees(atan2((l_linenumber - 4)::DOUBLE, l_quantity)) AS angle FROM lineitem), m AS (SELECT l_suppkey, median(angle) AS m FROM a WHERE abs(angle) <= 5 GROUP BY l_suppkey)
SELECT l_suppkey, round(CASE WHEN abs(m) >= 0.15 THEN m ELSE 0.0 END, 6) AS skew FROM m""")
def q_skew_median(spark, sf):
    angles = table(spark, sf, "lineitem").select("l_suppkey", G.segment_angle(F.col("l_quantity"), (F.col("l_linenumber") - 4).cast("double")).alias("angle"))
    return angles.where(G.near_horizontal(F.col("angle"))).groupBy("l_suppkey").agg(F.round(orient.skew(F.col("angle")), 6).alias("skew"))


@query("q_quarter_turns", "SELECT p_partkey, CASE WHEN ((p_partkey * 45 - 900) % 360 + 360) % 360 IN (0, 90, 180, 270) THEN ((p_partkey * 45 - 900) % 360 + 360) % 360 END AS rotation, greatest(10, (p_size * 37) // 40) AS kernel FROM part")
def q_quarter_turns(spark, sf):
    return table(spark, sf, "part").select("p_partkey", G.quarter_turn(F.col("p_partkey") * 45 - 900).alias("rotation"), G.kernel_length(F.col("p_size") * 37).alias("kernel"))
