import json
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import geometry as G
from ledgerloom.functions import text as T
from ledgerloom.operators import assemble, classify, lattice, orient, raster, sequence, templates
from ledgerloom.operators.graph import connected_components
from ledgerloom.operators.providers import FunctionProvider, ReplayProvider, engine, find_binary, recognize, words_to_reading
from ledgerloom.plans.pipeline import process, process_pages, scan_cells, scan_pages
from ledgerloom.sources import files


def test_number_coercion(spark):
    big = "123456789012345678901"
    cases = [("", None, False), ("  ", None, False), ("0012", 12, True), ("4.5", 45, False), ("-5", 5, False), ("1 2", 12, False), ("abc", None, False), (big, int(big), True), (" 7\t", 7, True), ("٣", None, False), (None, None, False)]
    got = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string").select("i", T.coerce_number(F.col("t")).alias("r")).collect()
    for r in got:
        _, value, clean = cases[r["i"]]
        assert (None if r["r"]["value"] is None else int(r["r"]["value"])) == value and r["r"]["clean"] == clean, cases[r["i"]]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" '\t' ",), ("11",), ("x" * 40,), (" " + "x" * 39 + " ",), ("A   B",)], "t string")
    got = df.select(T.is_ditto(F.col("t"), list(templates.SCRAP_NOTE.ditto_markers)).alias("d"), T.page_source(F.col("t")).alias("s"), T.normalize(F.col("t")).alias("n")).collect()
    assert [r["d"] for r in got] == [True, True, False, False, False]
    assert [r["s"] for r in got] == ["scan", "scan", "text", "scan", "scan"] and got[4]["n"] == "a b"
    rounded = spark.createDataFrame([(0.1235,), (0.0005,), (0.0625,), (None,)], "x double").select(G.round_binary(F.col("x"), 3).alias("r")).collect()
    assert [r["r"] for r in rounded] == [0.123, 0.001, 0.062, None]


def test_gap_merge_and_thinning(spark):
    df = spark.createDataFrame([(1, i) for i in (0, 12, 25, 26, 28, 40)] + [(2, None)], "p int, i int")
    got = [(r["first"], r["last"], r["centre"]) for r in sequence.gap_merge(df, ["p"], "i", 12).orderBy("run").collect()]
    assert got == [(0, 12, 6), (25, 40, 30)]
    thin = spark.createDataFrame([([10, 15, 22, 40, 45, 53],), ([],), ([7],)], "c array<int>").select(sequence.thin(F.col("c"), 12).alias("t"), sequence.consecutive(F.col("c")).alias("p")).collect()
    assert [r["t"] for r in thin] == [[10, 22, 40, 53], [], [7]]
    assert len(thin[0]["p"]) == 5 and thin[1]["p"] == [] and thin[2]["p"] == []


def test_thinning_of_long_sequences(spark):
    rng, rows, want = random.Random(8), [], set()
    for key in range(20):
        seq, last = sorted(rng.randint(0, 400) for _ in range(rng.randint(0, 80))), None
        rows += [(key, i) for i in seq]
        for i in seq:
            if last is None or i - last >= 9:
                want.add((key, i))
                last = i
    rng.shuffle(rows)
    got = [tuple(r) for r in sequence.thin_rows(spark.createDataFrame([*rows, (1, None)], "k int, i int"), ["k"], "i", 9).collect()]
    assert len(got) == len(want) and set(got) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 200), unique=True, max_size=30), st.integers(1, 20))
def test_line_coordinates_keep_their_distance(hits, least):
    mask = np.zeros((201, 3), np.uint8)
    mask[hits] = 255
    kept = raster.line_coordinates(mask, 1, least, merge=2)
    assert all(b - a >= least for a, b in zip(kept, kept[1:]))


def naive_fold(rows):
    previous, out = {}, []
    for number, cells in rows:
        record, written = {}, []
        for key, ditto, value, by_hand in cells:
            record[key] = previous.get(key) if ditto else value
            if ditto or by_hand:
                written.append(record[key])
        if any(v is not None for v in written):
            out.append((number, record))
            previous = {k: v for k, v in record.items() if v is not None}
    return out


def test_ditto_fold_equals_a_plain_loop(spark):
    rng, pages, flat = random.Random(5), {}, []
    for page in range(60):
        rows = []
        for row in range(rng.randint(1, 12)):
            cells = [(k, rng.random() < 0.35, rng.choice([None, "u", "v"]), rng.random() < 0.8) for k in "abc"]
            rows.append((row, cells))
            flat += [(page, row, k, "ditto" if d else "ocr", None if d else v, w) for k, d, v, w in cells]
        pages[page] = naive_fold(rows)
    rng.shuffle(flat)
    df = spark.createDataFrame(flat, "page int, row int, key string, outcome string, value string, written boolean")
    got = {}
    for r in sequence.fold_ditto(df, ["page"], "row", "key", "outcome", "value", "written").collect():
        got.setdefault(r["page"], []).append((r["row"], r["record"]))
    assert {p: sorted(v, key=lambda x: x[0]) for p, v in got.items()} == {p: v for p, v in pages.items() if v}


def traced_area(mask):
    """Area of the polygon through the border pixels' centres, holes filled: a brute-force count by Pick's formula per blob."""
    on = {(y, x) for y, x in np.argwhere(mask)}
    out = []
    while on:
        stack, blob = [on.pop()], set()
        while stack:
            y, x = stack.pop()
            blob.add((y, x))
            for p in ((y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
                if p in on:
                    on.remove(p)
                    stack.append(p)
        top, left = min(y for y, _ in blob) - 1, min(x for _, x in blob) - 1
        low, right = max(y for y, _ in blob) + 1, max(x for _, x in blob) + 1
        outside, stack = {(top, left)}, [(top, left)]
        while stack:
            y, x = stack.pop()
            for p in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                if top <= p[0] <= low and left <= p[1] <= right and p not in blob and p not in outside:
                    outside.add(p)
                    stack.append(p)
        full = {(y, x) for y in range(top, low + 1) for x in range(left, right + 1)} - outside
        area = 0.0
        for y in range(top, low + 1):
            for x in range(left, right + 1):
                n = sum(p in full for p in ((y, x), (y + 1, x), (y, x + 1), (y + 1, x + 1)))
                area += {4: 1.0, 3: 0.5}.get(n, 0.0)
        out.append(area)
    return sorted(out)


def test_components():
    stroke, box, ring = np.zeros((9, 9), int), np.zeros((9, 9), int), np.zeros((9, 9), int)
    stroke[4, 1:8], box[2:6, 1:7] = 1, 1
    ring[1:8, 1:8] = 1
    ring[3:6, 3:6] = 0
    assert [c[0] for c in raster.components(stroke)] == [0.0]
    assert raster.components(box) == [(15.0, 2, 1, 4, 6)] and raster.components(ring)[0][0] == 36.0
    rng = np.random.default_rng(2)
    for _ in range(80):
        mask = rng.random((9, 11)) < 0.4
        assert sorted(c[0] for c in raster.components(mask)) == traced_area(mask)


def test_cell_kinds(spark):
    b = lambda a, x0, y0, x1, y1: (float(a), x0, y0, x1, y1)
    rows = [
        ("none", 0, 10, 0.0, [], "empty", 0), ("clean", 40, 100, 0.0039, [b(50, 0, 0, 9, 9)], "empty", 0), ("specks", 40, 100, 0.01, [b(11, 0, 0, 4, 4)] * 3, "empty", 0),
        ("thin cover", 100, 100, 0.01, [b(13, 0, 0, 9, 9)], "empty", 1), ("dash", 40, 100, 0.05, [b(80, 10, 20, 50, 24)], "dash", 1),
        ("full dash", 40, 100, 0.12, [b(80, 10, 20, 50, 24)], "content", 1), ("tall", 40, 100, 0.05, [b(80, 10, 2, 50, 17)], "content", 1), ("two", 40, 100, 0.05, [b(80, 10, 20, 50, 24)] * 2, "content", 2),
    ]
    df = spark.createDataFrame([r[:5] for r in rows], "n string, h int, w int, ink double, blobs array<struct<area:double,x0:int,y0:int,x1:int,y1:int>>")
    got = {r["n"]: r["k"] for r in df.select("n", classify.cell_kind(F.col("h"), F.col("w"), F.col("ink"), F.col("blobs")).alias("k")).collect()}
    for name, *_, kind, n in rows:
        assert (got[name]["kind"], got[name]["components"]) == (kind, n), name


def test_templates(spark, tmp_path):
    (tmp_path / "b.yaml").write_text("form_id: b\nmatch: Gate Pass\ncolumns: [{key: n, type: integer}]\nditto_columns: null\n")
    (tmp_path / "a.yaml").write_text("form_id: a\nmatch: [gate pass, out]\ncolumns: null\n")
    (tmp_path / "c.yaml").write_text("")
    loaded = templates.load_templates(str(tmp_path))
    assert [t.form_id for t in loaded] == ["a", "b"] and loaded[1].match == ("Gate Pass",)
    assert templates.load_templates(str(tmp_path / "none")) == []
    with pytest.raises(ValueError):
        templates.parse_template({"form_id": "x", "columns": [{"key": "k", "colour": 1}]})
    words = [(t.form_id, i, k) for i, t in enumerate(loaded) for k in t.match]
    pages = spark.createDataFrame([(1, "GATE  pass"), (2, "gate pass out"), (3, ""), (4, None)], "p int, t string")
    got = {r["p"]: r["form_id"] for r in templates.match_template(pages, "p", "t", words).collect()}
    assert got == {1: "a", 2: "a", 3: "generic", 4: "generic"}
    dims = templates.template_tables(spark)
    assert dims["columns"].count() == 24 and dims["checks"].count() == 1


def test_checks_and_solving(spark):
    rows = [("f", {"t": "5", "a": "2", "b": "3"}), ("f", {"t": "6", "a": "2", "b": "3"}), ("f", {"t": None, "a": "2", "b": "3"}), ("f", {"t": "6", "a": "2"}), ("g", {"t": "6", "a": "2", "b": "3"})]
    df = spark.createDataFrame(rows, "form_id string, record map<string,string>")
    got = assemble.apply_checks(df, [("f", "t", ["a", "b"])]).collect()
    assert [(r["passed"], r["failed"]) for r in got] == [(1, 0), (0, 1), (0, 0), (0, 0), (0, 0)]
    assert got[1]["check_failures"] == ["t=6 but sum(a+b)=5"]
    solved = [r["solved"] for r in assemble.solve_unknown(df, "f", "t", ["a", "b"]).collect()]
    assert solved == [None, None, {"t": "5"}, {"b": "4"}, None]


def drawn_page(rows=7, cols=7, height=40, width=120):
    page = np.full((rows * height + 40, cols * width + 40), 230, np.uint8)
    for r in range(rows + 1):
        page[20 + r * height : 22 + r * height, 20 : 21 + cols * width] = 20
    for c in range(cols + 1):
        page[20 : 21 + rows * height, 20 + c * width : 22 + c * width] = 20
    for c in range(cols):
        page[20 + 4 * height + 14 : 20 + 4 * height + 22, 50 + c * width : 59 + c * width] = 10
    page[20 + 5 * height + 20 : 20 + 5 * height + 23, 50:68] = 10
    return page


def test_page_end_to_end(spark):
    page = drawn_page()
    image = (page.shape[0], page.shape[1], page.tobytes())
    pages = spark.createDataFrame([("f", 0, image), ("f", 1, None)], "file string, page int, image struct<height:int,width:int,data:binary>")
    cells = scan_cells(pages).cache()
    assert cells.count() == 49
    headers = spark.createDataFrame([("f", 0, "SCRAP  note 7")], "file string, page int, text string")
    out = process(cells, headers, FunctionProvider("fixed", lambda crop, numeric: ("12" if numeric else " ,, ", 0.9)))
    rows = out["rows"].collect()
    assert [(r["row"], r["record"]["rejection_qty"], r["record"]["unit"], r["record"]["item_code"]) for r in rows] == [(4, "12", None, ",,")]
    meta = out["meta"].first()
    assert (meta["form_id"], meta["cells_total"], meta["cells_dash"], meta["cells_ocr"], meta["cells_empty"]) == ("scrap_note", 49, 1, 7, 6)
    assert json.loads(out["documents"].first()["payload"])["pages"][0]["_meta"]["grid_rows"] == 7
    assert out["review"].count() == 0


def test_recognizer_reads_content_only_and_survives_errors(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(crop, numeric):
        seen.add(1)
        raise ValueError

    cells = spark.createDataFrame([("f", 0, i, 0, bytearray(b"x"), 1, 1, False, "content" if i < 3 else "empty") for i in range(10)], "file string, page int, row int, col int, crop binary, h int, w int, numeric boolean, kind string")
    readings = recognize(cells, FunctionProvider("bad", read))
    assert [(r["text"], r["confidence"]) for r in readings.collect()] == [("", 0.0)] * 3 and readings.count() == 3
    assert seen.value == 3
    replay = ReplayProvider(spark.createDataFrame([("f", 0, 0, 0, "a", 0.5, "e")], "file string, page int, row int, col int, text string, confidence double, engine string"))
    assert sorted(r["text"] for r in replay.recognize(cells).collect()) == [""] * 9 + ["a"]
    with pytest.raises(FileNotFoundError):
        find_binary("no-such-engine", ())


def test_words(spark):
    df = spark.createDataFrame([([(" a ", 90), ("", 50), ("b", -1), ("c", 70)],), ([],)], "w array<struct<text:string,conf:int>>")
    text, confidence = words_to_reading("w")
    assert [(r["t"], r["c"]) for r in df.select(text.alias("t"), confidence.alias("c")).collect()] == [("a c", 0.8), ("", 0.0)]


def test_orientation(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 180, 5), (2, 0, 1), (2, 180, 3), (3, 0, 0)], "p int, r int, s int")
    got = {r["p"]: (r["rotation"], r["method"]) for r in orient.pick_rotation(df, ["p"], "r", "s").collect()}
    assert got == {1: (0, "confidence"), 2: (180, "confidence"), 3: (0, "none")}
    page = drawn_page()
    assert np.array_equal(orient.turn(orient.turn(page, 90), 270), page) and orient.turn(page, 90).shape == page.shape[::-1]
    for angle in (-2.0, 1.0, 3.5):
        turned = orient.straighten(page, -angle)
        assert math.isclose(abs(orient.estimate_skew(turned < 128)), abs(angle), abs_tol=0.15)
    assert orient.straighten(page, 0.1) is page


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("b.pdf", "a.pdf", "c.txt"):
        (tmp_path / "in" / name).write_bytes(name.encode())
    listed = files.list_files(spark, str(tmp_path / "in"))
    assert sorted(r["file"] for r in listed.collect()) == ["a.pdf", "b.pdf"]
    assert files.list_files(spark, str(tmp_path / "in" / "c.txt")).count() == 1
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tmp_path / "none"))

    def parse(content):
        if content.startswith(b"b"):
            raise ValueError("broken")
        return [("x" * 50, []), ("", [{"width": 2, "height": 3, "data": b"1"}, {"width": 3, "height": 2, "data": b"2"}])]

    pages = files.pick_largest(files.read_pages(listed, parse)).collect()
    assert sorted((r["file"], r["page"]) for r in pages) == [("a.pdf", 0), ("a.pdf", 1), ("b.pdf", -1)]
    assert next(r for r in pages if r["page"] == 1)["image"]["data"] == b"1"
    assert "broken" in next(r for r in pages if r["page"] == -1)["error"]
    text, scans = files.route(files.read_pages(listed, parse).where("error is null"))
    assert (text.count(), scans.count()) == (1, 1) and files.has_text_layer(text).first()["has_text"]


def test_command_line_and_sinks(spark, tmp_path, capsys):
    from ledgerloom.plans.pipeline import main

    assert main(["run", str(tmp_path / "none")]) == 1 and main(["flatten", str(tmp_path / "none")]) == 1
    docs = [(1, json.dumps([{"page": 0, "rows": [{"_row": 4}]}])), (2, "{")]
    spark.createDataFrame(docs, "result_id long, payload string").write.parquet(str(tmp_path / "in"))
    assert main(["flatten", str(tmp_path / "in"), "--out", str(tmp_path / "out")]) == 0
    assert capsys.readouterr().out.split("\n")[:3] == ["broken: 1", "page: 1", "row: 1"]
    files.write_results(spark.createDataFrame([("a", "{}"), ("b", "[]")], "file string, payload string"), str(tmp_path / "json"))
    assert spark.read.text(str(tmp_path / "json")).count() == 2
    counts = spark.createDataFrame([("f", 0, "generic", 1, 2, 3, 4)], "file string, page int, form_id string, cells_empty int, cells_dash int, cells_ocr int, cells_low_confidence int")
    assert assemble.summary_lines(counts).first()["line"] == "p0 generic: 1 empty, 2 dash, 3 read, 4 low"
    (tmp_path / "empty").mkdir()
    assert main(["run", str(tmp_path / "empty"), "--out", str(tmp_path / "o")]) == 1
    with pytest.raises(ValueError, match="tesseract"):
        engine("none")


def page_parser(content):
    """Files of the test: b"bad" raises, b"text" has a text layer, anything else a drawn page and a text page."""
    if content == b"bad":
        raise ValueError("broken")
    text = ("words " * 20, [])
    if content == b"text":
        return [text]
    page = drawn_page()
    return [("", [{"width": page.shape[1], "height": page.shape[0], "data": page.tobytes()}]), text]


def test_files_to_documents_from_the_command_line(spark, tmp_path, capsys, monkeypatch):
    from ledgerloom.operators.providers import ENGINES
    from ledgerloom.plans import pipeline

    for name, content in (("a b.pdf", b"scan"), ("bad.pdf", b"bad"), ("sub/a b.pdf", b"text"), ("c.txt", b"text")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)

    def read(crop, numeric):  # the crop comes in its own shape, three times as large, with a white margin
        ok = crop.ndim == 2 and min(crop.shape) > 24 and (crop[:12] == 255).all() and (crop[:, -12:] == 255).all() and crop.min() < 128
        return ("12" if numeric else "a", 0.9) if ok else ("", 0.0)

    monkeypatch.setitem(ENGINES, "fixed", lambda: FunctionProvider("fixed", read, lambda image: [("Scrap Note", 0.9, 0, 0, 1, 1)]))
    args = ["run", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--engine", "fixed", "--parser", f"{__name__}:page_parser", "--debug"]
    assert pipeline.main(args) == 0
    said = capsys.readouterr()
    assert "broken" in said.err and "a b.pdf: p0 scrap_note: " in said.out and "a b.pdf: p1: text layer, 119 chars" in said.out and "sub/a b.json" in said.out
    doc = json.loads((tmp_path / "out" / "a b.json").read_text())
    assert doc["file"] == "a b.pdf" and [p["source"] for p in doc["pages"]] == ["scan", "text"]
    scan = doc["pages"][0]
    assert [(r["_row"], r["rejection_qty"]) for r in scan["rows"]] == [(4, 12)] and isinstance(scan["_meta"]["seconds"], float) and len(scan["_meta"]) == 16
    assert json.loads((tmp_path / "out" / "sub" / "a b.json").read_text())["pages"][0]["source"] == "text"
    drawn = (tmp_path / "out" / "debug" / "a_b_p0_grid.png").read_bytes()
    assert drawn.startswith(b"\x89PNG") and not (tmp_path / "out" / "bad.json").exists()
    assert pipeline.main(args) == 0 and len(list((tmp_path / "out").rglob("*.json"))) == 2


def test_external_recognizer(tmp_path):
    binary = tmp_path / "tesseract"
    binary.write_text("""#!/bin/sh
cat > /dev/null
case "$*" in *"--psm 0"*) echo "Rotate: 270"; exit 0;; *"-l xx"*) exit 1;; esac
printf 'level\\tleft\\ttop\\twidth\\theight\\tconf\\ttext\\n5\\t1\\t2\\t3\\t4\\t90\\t12\\n4\\t0\\t0\\t9\\t9\\t-1\\t\\n5\\t5\\t2\\t3\\t4\\t70\\t'
case "$*" in *whitelist*) echo 34;; *) echo ab;; esac
""")
    binary.chmod(0o755)
    reader, image = engine("tesseract", binary=str(binary)), np.full((5, 6), 200, np.uint8)
    assert reader.read_cell(image, True) == ("12 34", 0.8) and reader.read_cell(image, False)[0] == "12 ab"
    assert reader.read_page(image) == [("12", 0.9, 1, 2, 4, 6), ("ab", 0.7, 5, 2, 8, 6)] and reader.osd(image) == 270
    with pytest.raises(Exception):
        engine("tesseract", binary=str(binary), lang="xx").read_page(image)


def test_pdf_parser_takes_text_or_the_largest_picture(monkeypatch):
    import sys
    import types

    class Pixmap:
        def __init__(self, *args):
            if args and args[-1] == 9:
                raise ValueError
            self.width, self.height, self.samples, self.alpha, self.colorspace = 2, 3, bytes([args[-1] if args else 7] * 6), 0, types.SimpleNamespace(n=1)

    def page(text, images):
        return types.SimpleNamespace(get_text=lambda: text, get_images=lambda full: images, get_pixmap=lambda dpi: Pixmap())

    class Doc(list):
        __enter__ = lambda self: self
        __exit__ = lambda self, *a: None

    pages = Doc([page(" " + "x" * 50, []), page("", [(4, 0, 2, 2), (5, 0, 3, 3), (9, 0, 9, 9)]), page("", [])])
    monkeypatch.setitem(sys.modules, "pymupdf", types.SimpleNamespace(open=lambda stream, filetype: pages, Pixmap=Pixmap, csGRAY=None))
    from ledgerloom.sources.pdf import parse_pdf

    got = parse_pdf(b"")
    assert got[0] == ("x" * 50, []) and got[1][1][0]["data"][0] == 5 and got[2][1][0]["height"] == 3


def test_rounding_of_the_binary_value(spark):
    rng = random.Random(2)
    values = [0.0005, 0.0015, 0.0025, 2.5, 0.4875, 0.5425, 1e-9, -0.0005, -0.4875, 0.1235, float("nan"), 1e20] + [rng.randrange(20000) / 10000 for _ in range(3000)] + [sum(rng.choice([0.97, 0.75, 0.455]) for _ in range(7)) / 7 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", G.round_binary(F.col("v"), 3).alias("r")).collect():
        assert r["r"] == round(r["v"], 3) or r["v"] != r["v"], r
    assert spark.createDataFrame([(None,)], "v double").select(G.round_binary(F.col("v"), 3)).first()[0] is None


def test_crops_are_prepared():
    assert raster.prepare(np.zeros((0, 4), np.uint8)).size == 0
    flat = raster.prepare(np.full((5, 4), 77, np.uint8))
    assert flat.shape == (39, 36) and (flat[12:-12, 12:-12] == 77).all() and (flat[:12] == 255).all()
    step = raster.enlarge(np.array([[0, 0, 255, 255]], np.uint8), 3)[1]
    assert list(step[:4]) == [0, 0, 0, 0] and (np.diff(step[4:8].astype(int)) > 0).all()


def test_stream_flattens_once(spark, tmp_path):
    from ledgerloom.streaming.ingest import first_deliveries, flatten_stream, watch

    docs = [(1, "f", None, json.dumps([{"page": 0, "rows": [{"_row": 4}]}])), (2, "g", None, None)]
    df = spark.createDataFrame(docs, "result_id long, file_name string, made_at timestamp, payload string").withColumn("made_at", F.expr("timestamp'2025-01-01'"))
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        flatten_stream(first_deliveries(watch(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out") + "/batch=*")
    assert sorted(r["tag"] for r in got.select("tag").collect()) == ["broken", "page", "row"]


def test_components_of_a_graph(spark):
    rng, edges = random.Random(4), [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    rng.shuffle(edges)
    nodes = spark.createDataFrame([(i,) for i in [*range(42), 100, 101, 102, 200]], "id long")
    got = {r["id"]: r["component"] for r in connected_components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[41] == 41 and {got[i] for i in (100, 101, 102)} == {100} and got[200] == 200
    assert connected_components(nodes.limit(0), spark.createDataFrame([], "a long, b long")).count() == 0


def test_lattice_and_overlay(spark):
    df = spark.createDataFrame([(1, [0, 50, 90], [0, 30]), (2, [5], [1, 2])], "p int, xs array<int>, ys array<int>")
    cells = lattice.explode_cells(df, ["p"])
    assert sorted((r["p"], r["row"], r["col"], r["x0"], r["x1"]) for r in cells.collect()) == [(1, 0, 0, 0, 50), (1, 0, 1, 50, 90)]
    assert lattice.overlay(df, cells, ["p"]).count() == 5 + 3 + 2


def test_turned_and_skewed_pages_end_to_end(spark):
    page = drawn_page()
    for x in (200, 222, 244):  # the header's mark, shorter than a printed line: upright, it stands in the top band
        page[30:38, x : x + 15] = 10

    def read_page(image):
        up = bool((image[:46, 196:264] < 60).sum() > 200) and image.shape[1] > image.shape[0]
        return [("SCRAP", 0.9, 0, 0, 9, 9), (" ", 0.1, 0, 0, 1, 1), ("NOTE", 0.7, 9, 0, 18, 9)] if up else [("?", 0.2, 0, 0, 9, 9)]

    def struct(a):
        return (a.shape[0], a.shape[1], np.ascontiguousarray(a).tobytes())

    wide = np.full((page.shape[0] + 160, page.shape[1] + 160), 230, np.uint8)
    wide[80:-80, 80:-80] = page
    skewed = orient.straighten(wide, -2.0)
    pages = [("f", 0, struct(page)), ("f", 1, struct(orient.turn(page, 180))), ("f", 2, struct(orient.turn(page, 90))), ("f", 3, None), ("f", 4, struct(np.full((60, 80), 230, np.uint8)))]
    df = spark.createDataFrame(pages, "file string, page int, image struct<height:int,width:int,data:binary>")
    out = process_pages(df, FunctionProvider("fixed", lambda crop, numeric: ("12" if numeric else "a", 0.9), read_page))
    meta = {r["page"]: r for r in out["meta"].collect()}
    assert [meta[p]["orientation_applied"] for p in range(3)] == [0, 180, 270]
    assert all((meta[p]["form_id"], meta[p]["cells_total"], meta[p]["orientation_method"], meta[p]["engine"]) == ("scrap_note", 49, "confidence", "fixed") for p in range(3))
    assert meta[0]["matched_header_text"] == "SCRAP NOTE" and all(m["seconds"] is not None for m in meta.values())
    assert [(meta[p]["cells_total"], meta[p]["grid_rows"]) for p in (3, 4)] == [(0, 0), (0, 0)]
    rows = {r["page"]: (r["row"], r["record"]) for r in out["rows"].collect()}
    assert set(rows) == {0, 1, 2} and rows[0] == rows[1] == rows[2]
    doc = json.loads(out["documents"].first()["payload"])
    assert [p["page"] for p in doc["pages"]] == [0, 1, 2, 3, 4] and doc["pages"][3]["rows"] == []
    assert doc["pages"][1]["_meta"]["orientation_applied"] == 180 and doc["pages"][0]["source"] == "scan"
    tilted = spark.createDataFrame([("g", 0, struct(skewed)), ("g", 1, struct(orient.straighten(wide, 3.0)))], df.schema)
    headers = spark.createDataFrame([("g", 0, "SCRAP NOTE"), ("g", 1, "SCRAP NOTE")], "file string, page int, text string")
    straight = scan_pages(tilted).collect()
    assert [(r["grid_rows"], r["grid_cols"], len(r["cells"])) for r in straight] == [(7, 7, 49)] * 2
    assert math.isclose(straight[0]["skew_deg"], 2.0, abs_tol=0.15) and math.isclose(straight[1]["skew_deg"], -3.0, abs_tol=0.15)
    tilted_rows = process(scan_cells(tilted), headers, FunctionProvider("fixed", lambda crop, numeric: ("12" if numeric else "a", 0.9)))["rows"].collect()
    assert sorted((r["page"], r["row"]) for r in tilted_rows) == [(0, 4), (1, 4)]


def test_failed_checks_stand_in_the_document(spark):
    rows = spark.createDataFrame([("f", 0, "s", 1, {"t": "6"}, 0.9, ["t=6 but sum(a+b)=5"]), ("f", 0, "s", 2, {"t": None}, 0.9, [])], "file string, page int, form_id string, row int, record map<string,string>, confidence double, check_failures array<string>")
    review = spark.createDataFrame([], "file string, page int, row int, column string, value string, raw_text string, confidence double, bbox array<int>")
    meta = spark.createDataFrame([("f", 0, "s", 7)], "file string, page int, form_id string, grid_rows int")
    got = json.loads(assemble.nested_pages(rows, review, meta).first()["payload"])["pages"][0]
    assert got["rows"] == [{"_row": 1, "t": "6", "_confidence": 0.9, "_check_failures": ["t=6 but sum(a+b)=5"]}, {"_row": 2, "t": None, "_confidence": 0.9}]
    texts = spark.createDataFrame([("f", 1, 'say "x"\n'), ("g", 0, "t")], "file string, page int, text string")
    payloads = {r["file"]: json.loads(r["payload"]) for r in assemble.nested_pages(rows, review, meta, texts, {"s": ["t"]}).collect()}
    assert payloads["f"]["pages"][0]["rows"][0]["t"] == 6 and payloads["f"]["pages"][1] == {"page": 1, "source": "text", "text": 'say "x"\n'}
    assert payloads["g"] == {"file": "g", "pages": [{"page": 0, "source": "text", "text": "t"}]}
