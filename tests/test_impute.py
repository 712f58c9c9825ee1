from collections import Counter
from statistics import median

from pyspark.sql import functions as F

from ledgerloom.functions.usable import usable_quantity, usable_text
from ledgerloom.operators.impute import FillField, fill_cells, fill_missing

FIELDS = [FillField("vendor", "mode", usable_text), FillField("qty", "median", usable_quantity)]
LEVELS = [["st", "item"], ["item"], []]
SCHEMA = "id long, st long, item string, vendor string, qty long, level string, support int"
ROWS = [
    (1, 1, "a", "Xa", 4, "keep", 1), (2, 1, "a", "Xa", 5, None, 2), (3, 1, "a", "Ya", None, "z", 3), (4, 1, "a", None, 9999, None, None),
    (5, 1, "b", "//", 7, None, 0), (6, 2, "b", "W", -1, None, 0), (7, 2, None, " ", 0, None, 0), (8, None, "a", "n/a", 8, None, 0),
    (2, 1, "a", "Xa", 5, None, 2), (None, 1, "a", "Q", 1, None, 0), (9, 3, "c", "as above", None, None, 0),
]


def test_usable_values(spark):
    texts = [("Xa", True), ("N/A", False), (" .. ", False), ("''", False), ("(same)", False), ("", False), (None, False), ("do model", True), ("11", True)]
    got = spark.createDataFrame(texts, "t string, ok boolean").select("ok", usable_text("t").alias("u")).collect()
    assert all(r["ok"] == r["u"] for r in got)


def test_cells_levels_and_values(spark):
    cells = {(r["id"], r["field_name"]): r for r in fill_cells(spark.createDataFrame(ROWS, SCHEMA), "id", FIELDS, LEVELS).collect()}
    assert cells[4, "vendor"]["fill_value"] == "Xa" and cells[4, "vendor"]["level"] == 0
    assert cells[3, "qty"]["fill_value"] == "4" and cells[3, "qty"]["support"] == 2
    assert cells[5, "vendor"]["fill_value"] == "W" and cells[5, "vendor"]["level"] == 1
    assert cells[6, "qty"]["fill_value"] == "7" and cells[6, "qty"]["level_name"] == "item"
    assert cells[7, "vendor"]["level"] == 2  # no item code: the whole table
    assert cells[9, "qty"]["level"] == 2
    assert (1, "vendor") not in cells and None not in {k for k, _ in cells}


def test_tie_goes_to_the_smaller_value(spark):
    rows = [(1, 1, "a", "Ya", 1, "", 0), (2, 1, "a", "Xa", 1, "", 0), (3, 1, "a", None, 1, "", 0)]
    cell = fill_cells(spark.createDataFrame(rows, SCHEMA), "id", FIELDS[:1], LEVELS).first()
    assert cell["fill_value"] == "Xa"


def test_filled_table_keeps_every_row_and_clashing_columns(spark):
    out = fill_missing(spark.createDataFrame(ROWS, SCHEMA), "id", FIELDS, LEVELS)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    four = next(r for r in rows if r["id"] == 4)
    assert four["vendor"] is None and four["vendor_filled"] == "Xa" and four["vendor_was_filled"] and four["qty_filled"] == 4
    assert next(r for r in rows if r["id"] == 1)["level"] == "keep"
    assert not next(r for r in rows if r["id"] == 1)["vendor_was_filled"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fill_cells(empty, "id", FIELDS, LEVELS).count() == 0
    assert fill_missing(empty, "id", FIELDS, LEVELS).count() == 0


def test_against_plain_python(spark, small):
    df = spark.read.parquet(f"{small}/scrap_note_rows.parquet")
    fields = [FillField("vendor_name", "mode", usable_text), FillField("rejection_qty", "median", usable_quantity)]
    ok = df.select("rec_id", "station_id", "item_code", "vendor_name", "rejection_qty", usable_text("vendor_name").alias("v"), usable_quantity("rejection_qty").alias("q")).dropDuplicates(["rec_id"]).collect()
    groups, quantities = {}, {}
    for r in ok:
        if r["v"]:
            groups.setdefault((r["station_id"], r["item_code"]), Counter())[r["vendor_name"]] += 1
        if r["q"]:
            quantities.setdefault((r["station_id"], r["item_code"]), []).append(r["rejection_qty"])
    want = {}
    for r in ok:
        g = (r["station_id"], r["item_code"])
        if None in g:
            continue
        if not r["v"] and g in groups:
            want[r["rec_id"], "vendor_name"] = min(groups[g].items(), key=lambda x: (-x[1], x[0]))[0]
        if not r["q"] and g in quantities:
            want[r["rec_id"], "rejection_qty"] = str(int(median(quantities[g]) // 1))
    got = {(r["rec_id"], r["field_name"]): r["fill_value"] for r in fill_cells(df, "rec_id", fields, [["station_id", "item_code"]]).where(F.col("level") == 0).collect()}
    assert got == want


def test_large_levels_are_joined_by_a_shuffle_with_the_same_result(spark, monkeypatch):
    from ledgerloom.operators import impute

    df = spark.createDataFrame(ROWS, SCHEMA)
    plain = lambda d: sorted(map(str, d.collect()))
    one = plain(fill_missing(df, "id", FIELDS, LEVELS)), plain(fill_cells(df, "id", FIELDS, LEVELS))
    monkeypatch.setattr(impute, "SENT_GROUPS", 0)
    assert (plain(fill_missing(df, "id", FIELDS, LEVELS)), plain(fill_cells(df, "id", FIELDS, LEVELS))) == one
