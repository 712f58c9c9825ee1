import json

from ledgerloom.operators.flatten import child_table, emit, visit

PAGE = {"form_id": "scrap_note", "page": 3, "source": "scan", "rows": [{"_row": 4, "item_code": "A", "rejection_qty": 2}], "review_queue": [{"row": 9, "column": "unit", "value": "N", "confidence": 0.2, "bbox": [1, 2, 3, 4]}], "_meta": {"cells": {"total": 9}, "engine": "t"}}


def kinds(payload):
    return [(r[2], r[1], r[3], r[4]) for r in visit(1, payload) if r[2] != "page"]


WANT = [("row", 3, 4, ""), ("review", 3, 9, "unit"), ("meta", 3, -1, "")]


def test_layouts_give_the_same_children():
    doc = {"file": "f", "pages": [PAGE]}
    inner = dict(PAGE, rows=json.dumps(PAGE["rows"]), review_queue=json.dumps(PAGE["review_queue"]), _meta=json.dumps(PAGE["_meta"]))
    single = dict(PAGE, rows=PAGE["rows"][0], review_queue=PAGE["review_queue"][0])
    keyed = dict(PAGE, rows={"4": {"item_code": "A"}})
    for layout in (doc, [PAGE], dict(PAGE, file="f"), {"version": 2, "result": doc}, json.dumps(doc), {"pages": [inner]}, {"pages": [single]}, {"pages": [keyed]}, {"pages": {"3": PAGE}}):
        assert kinds(json.dumps(layout)) == WANT, layout


def test_review_inside_a_row_takes_its_number():
    page = {"page": 0, "rows": [{"_row": "7", "review_queue": [{"column": "unit"}]}]}
    assert kinds(json.dumps([page])) == [("row", 0, 7, ""), ("review", 0, 7, "unit")]


def test_optional_parts():
    page = {"page": 0, "rows": None, "review_queue": [], "_meta": None}
    assert kinds(json.dumps([page])) == []
    assert kinds("[]") == []
    assert kinds(json.dumps([{"page": 0, "source": "text", "text": "x" * 100_000}])) == []


def test_broken_documents():
    for payload in (None, "", "  ", "{", "null", "12", '"x"', "{}", "[" * 100_000):
        assert kinds(payload) == [("broken", -1, -1, "")], payload


def test_emit_and_child_tables(spark):
    rows = [(1, json.dumps([PAGE, PAGE]), "x"), (2, None, None), (None, json.dumps([PAGE]), "tag")]
    emitted = emit(spark.createDataFrame(rows, "result_id long, payload string, tag string")).cache()
    assert emitted.where("tag = 'broken'").count() == 1
    got = child_table(emitted, "row").where("result_id = 1").collect()
    assert len(got) == 2 and got[0]["rejection_qty"] == 2 and got[0]["item_code"] == "A"
    parents = {r["node_key"] for r in emitted.where("tag = 'page' and result_id = 1").collect()}
    assert {r["parent_key"] for r in got} <= parents
    assert child_table(emitted, "meta").where("result_id = 1").first()["cells_total"] == 9
    assert emitted.where("result_id is null").count() == 4
    assert emit(spark.createDataFrame([], "result_id long, payload string")).count() == 0


def test_nothing_of_an_object_is_lost(spark):
    row = {"_row": 4, "item_code": "A", "rejection_qty": "two", "extra": {"operator": {"code": "OP-1", "shift": "B", "line": 7}}, "_check_failures": ["total=7 but sum(a+b)=6", "x"], "mark": None}
    page = {"page": 3, "form_id": "scrap_note", "source": "scan", "text": "t", "stamp": 5, "rows": [row, "scrawl"], "review_queue": [{"row": "?", "column": "unit", "by": "K"}], "_meta": {"engine": "t", "cells": {"odd": 1}}}
    emitted = emit(spark.createDataFrame([(1, json.dumps([page]))], "result_id long, payload string")).cache()
    table = {tag: child_table(emitted, tag).collect() for tag in ("page", "row", "check", "review", "meta")}
    (got,) = table["row"]
    assert (got["item_code"], got["extra_operator_code"], got["extra_operator_shift"]) == ("A", "OP-1", "B")
    assert json.loads(got["rest"]) == {"rejection_qty": "two", "extra": {"operator": {"line": 7}}, "mark": None}
    assert [(r["failure"], r["parent_key"], r["row_no"]) for r in table["check"]] == [("total=7 but sum(a+b)=6", got["node_key"], 4), ("x", got["node_key"], 4)]
    (top,) = table["page"]
    assert (top["form_id"], top["source"], top["text"], top["node_key"]) == ("scrap_note", "scan", "t", got["parent_key"])
    assert json.loads(top["rest"]) == {"stamp": 5, "rows": ["scrawl"]}
    assert json.loads(table["review"][0]["rest"]) == {"by": "K", "row": "?"} and json.loads(table["meta"][0]["rest"]) == {"cells_odd": 1}
    assert child_table(emit(spark.createDataFrame([(1, json.dumps([PAGE]))], "result_id long, payload string")), "row").first()["rest"] is None


def test_any_depth_and_pages_that_are_no_objects(spark):
    deep, text = [{"page": 3, "rows": [{"_row": 1}]}, 7, None, "x"], None
    for _ in range(12):
        deep = {"result": json.dumps(deep)}
    rows = list(visit(1, json.dumps(deep)))
    assert [(r[1], r[2], r[3]) for r in rows] == [(3, "page", -1), (3, "row", 1), (1, "page", -1), (2, "page", -1)] and json.loads(rows[2][9]) == {"value": 7}
    assert [r[2] for r in visit(2, "[" * 100_000)] == ["broken"] and [r[2] for r in visit(3, '{"pages": null}')] == []


def test_tables_from_one_written_pass(spark, tmp_path):
    from ledgerloom.operators.flatten import flatten_tables

    docs = [(1, json.dumps([{"page": 0, "note": "n", "rows": [{"_row": 4, "odd": [1]}], "_meta": {"grid_rows": 3}}])), (2, "{")]
    tables = flatten_tables(spark.createDataFrame(docs, "result_id long, payload string"), str(tmp_path / "flat"))
    assert {tag: t.count() for tag, t in tables.items()} == {"page": 1, "row": 1, "check": 0, "review": 0, "meta": 1, "broken": 1}
    assert tables["row"].first()["rest"] == '{"odd":[1]}' and tables["row"].first()["parent_key"] == tables["page"].first()["node_key"]
    empty = flatten_tables(spark.createDataFrame([], "result_id long, payload string"), str(tmp_path / "none"))
    assert all(t.count() == 0 for t in empty.values())
