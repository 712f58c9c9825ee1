import json

from ledgerloom.operators.drift import Field, assign, build_tree, compile_projections, field_profiles, schema_changes, shared_values, tree_edit, unify

SCHEMA = "rec long, series_id long, file_no int, file_id long, record_json string, fields string"


def frame(spark, files):
    rows, n = [], 0
    for no, records in enumerate(files, 1):
        for r in records:
            n += 1
            rows.append((n, 1, no, 100 + no, r if r is None or isinstance(r, str) else json.dumps(r), "clash"))
    return spark.createDataFrame(rows, SCHEMA)


def changes(spark, *files):
    df = frame(spark, files)
    got = schema_changes(field_profiles(df, "series_id", "file_no", "file_id", "record_json")).collect()
    return sorted((r["file_id"], r["change_kind"], r["old_name"], r["new_name"]) for r in got)


def records(n=12, **make):
    return [{k: f(i) for k, f in make.items()} for i in range(n)]


def test_added_removed_renamed_retyped(spark):
    a = records(form_id=lambda i: ["x", "y", "z"][i % 3], secs=lambda i: 5 + i / 3, page=lambda i: i)
    b = records(FORM_ID=lambda i: ["x", "y", "z"][(i + 1) % 3], secs=lambda i: str(i), page=lambda i: i)
    c = records(FORM_ID=lambda i: ["x", "y"][i % 2], page=lambda i: i, tags=lambda i: ["a", "b"])
    assert changes(spark, a, b, c) == [(102, "renamed", "form_id", "FORM_ID"), (102, "retyped", "secs", "secs"), (103, "added", "", "tags"), (103, "removed", "secs", "")]


def test_no_change_from_order_nulls_and_repeats(spark):
    a = records(x=lambda i: i, y=lambda i: "t")
    b = [{"y": "t", "x": None if i % 2 else i} for i in range(12)]
    assert changes(spark, a, b + b, [None, "not json", "[1]"] + a) == []


def test_removed_and_added_of_other_content_is_no_rename(spark):
    a, b = records(col_9=lambda i: str(i * 7 % 90), x=lambda i: 1), records(oven=lambda i: 160 + i, x=lambda i: 1)
    assert [c[1] for c in changes(spark, a, b)] == ["added", "removed"]
    a, b = records(col_9=lambda i: str(i), x=lambda i: 1), records(col_7=lambda i: str(i), x=lambda i: 1)
    assert [c[1] for c in changes(spark, a, b)] == ["added", "removed"]


def test_nested_fields(spark):
    a, b = records(box=lambda i: {"a": i, "b": "x"}), records(box=lambda i: {"a": i, "c": True})
    assert changes(spark, a, b) == [(102, "added", "", "box.c"), (102, "removed", "box.b", "")]


def unified(spark, *files):
    df = frame(spark, files)
    out = unify(df, compile_projections(field_profiles(df, "series_id", "file_no", "file_id", "record_json")), "file_id", "record_json", "out").orderBy("rec").collect()
    assert all(r["fields"] == "clash" for r in out)
    return [None if r["out"] is None else json.loads(r["out"]) for r in out]


def test_unified_table_follows_renames(spark):
    a, b, c = records(form_id=lambda i: "x", p=lambda i: i), records(form=lambda i: "x", p=lambda i: None), records(frm=lambda i: "x", p=lambda i: i)
    out = unified(spark, a, b, c + [None])
    assert len(out) == 37 and all(set(r) == {"form_id", "p"} for r in out if r is not None) and out[-1] is None


def test_a_name_taken_anew_is_another_field(spark):
    a = records(a=lambda i: f"x{i % 4}", k=lambda i: i)
    b = records(b=lambda i: f"x{i % 4}", k=lambda i: i)
    c = records(b=lambda i: f"x{i % 4}", a=lambda i: True, k=lambda i: i)
    out = unified(spark, a, b, c)
    assert out[0] == {"a": "x0", "k": 0} and out[12] == {"a": "x0", "k": 0} and out[24] == {"a": "x0", "a#2": True, "k": 0}


def test_a_removed_field_comes_back_only_if_alike(spark):
    a, gone = records(a=lambda i: f"v{i % 3}", k=lambda i: i), records(k=lambda i: i)
    assert unified(spark, a, gone, a)[24] == {"a": "v0", "k": 0}
    other = records(a=lambda i: 3.5 * i, k=lambda i: i)
    assert unified(spark, a, gone, other)[24] == {"a#2": 0.0, "k": 0}


def test_nested_renames_moves_and_wrapped_values_are_followed(spark):
    words = ["red", "blue", "green"]
    a = records(o=lambda i: {"q": words[i % 3], "z": i}, k=lambda i: i)
    b = records(o=lambda i: {"qq": words[i % 3], "z": i}, k=lambda i: i)
    assert unified(spark, a, b)[12] == {"o.q": "red", "o.z": 0, "k": 0}
    moved = records(v=lambda i: {"q": words[i % 3]}, o=lambda i: {"z": i}, k=lambda i: i)
    assert unified(spark, a, moved)[12] == {"o.q": "red", "o.z": 0, "k": 0}
    df = frame(spark, [a, moved])
    got = {(r["change_kind"], r["old_name"], r["new_name"]) for r in schema_changes(field_profiles(df, "series_id", "file_no", "file_id", "record_json")).collect()}
    assert ("moved", "o.q", "v.q") in got
    plain, wrapped = records(q=lambda i: str(i), k=lambda i: i), records(q=lambda i: {"text": str(i), "src": True}, k=lambda i: i)
    assert unified(spark, plain, wrapped, plain)[13] == {"q": "1", "q.src": True, "k": 1}
    assert [c[1:] for c in changes(spark, plain, wrapped) if c[1] == "retyped"] == [("retyped", "q", "q")]


def test_a_renamed_object_is_compared_inside(spark):
    a, b = records(box=lambda i: {"a": i, "b": "x", "e": 1, "c": True}), records(crate=lambda i: {"a": i, "b": "x", "e": 1, "d": [1]})
    assert changes(spark, a, b) == [(102, "added", "", "crate.d"), (102, "removed", "box.c", ""), (102, "renamed", "box", "crate")]
    assert unified(spark, a, b)[12] == {"box.a": 0, "box.b": "x", "box.e": 1, "crate.d": [1]}


def test_types_are_united_over_the_series(spark):
    a, b = records(q=lambda i: i, m=lambda i: i, t=lambda i: "5"), records(q=lambda i: i + 0.5, m=lambda i: i, t=lambda i: i)
    out = unified(spark, a, b)
    assert isinstance(out[0]["q"], float) and isinstance(out[0]["m"], int) and out[12]["t"] == "0"


def test_no_value_is_lost_in_random_series(spark):
    import random

    rng = random.Random(5)

    def value(depth=0):
        kind = rng.randrange(7 if depth < 2 else 5)
        if kind == 5:
            return {rng.choice("abc"): value(depth + 1) for _ in range(2)}
        return [None, rng.randrange(9), rng.random(), rng.choice("xyz"), True, None, [1, "a"]][kind]

    def leaves(x):
        return sum(leaves(v) if isinstance(v, dict) and v else 1 for v in x.values())

    files = [[{rng.choice(["a", "b", "c", "d.e", "a#2"]): value() for _ in range(3)} for _ in range(6)] for _ in range(8)]
    out = unified(spark, *files)
    assert [len(o) for o in out] == [leaves(r) for f in files for r in f]


def test_keys_repeated_in_a_record_and_odd_texts(spark):
    out = unified(spark, ['{"a": 1, "a": 2, "b": "x"}', "", "[1]", '{"a": "' + "y" * 50_000 + '"}', "{}"])
    assert out[0] == {"a": "2", "b": "x"} and out[1] is None and out[2] is None and len(out[3]["a"]) == 50_000 and out[4] == {}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    profiles = field_profiles(df, "series_id", "file_no", "file_id", "record_json")
    assert schema_changes(profiles).count() == 0 and compile_projections(profiles).count() == 0


def test_assignment_is_optimal():
    from itertools import permutations
    import random

    rng = random.Random(3)
    for _ in range(60):
        n, m = rng.randint(1, 4), rng.randint(1, 4)
        cost = [[rng.random() * 2.5 for _ in range(m)] for _ in range(n)]
        got = assign(cost, 1.0)
        total = sum(cost[i][j] for i, j in got.items()) + (n - len(got)) + (m - len(got))
        best = min(
            sum(cost[i][p] if p < m else 1.0 for i, p in enumerate(perm)) + sum(1.0 for j in range(m) if j not in perm)
            for perm in permutations(range(m + n), n)
        )
        assert abs(total - best) < 1e-9


def test_edit_of_a_tree_to_itself_is_empty():
    tree = build_tree([("a", "whole", 3, 1.0, 3.0, [1, 2, 3], []), ("b.c", "text", 2, None, None, [5], ["a"])])
    assert tree_edit(tree, tree) == (0.0, []) or tree_edit(tree, tree)[1] == []
    assert tree_edit(Field(""), tree)[0] == 3.0


def profile(spark, files):
    return field_profiles(frame(spark, files), "series_id", "file_no", "file_id", "record_json")


def test_profiles_count_all_lines_exactly(spark):
    few = records(3000, code=lambda i: i % 64, text=lambda i: "x" * 45 + "-" + "-".join("ab1"[j % 3] for j in range(i % 100)))
    got = {r["path"]: r for r in profile(spark, [few]).collect()}
    assert (got["code"]["n"], got["code"]["distinct"], len(got["code"]["values"])) == (3000, 64, 64)
    assert got["text"]["distinct"] == 100 and len(got["text"]["shapes"]) == 100
    a = build_tree([tuple(got["code"][c] for c in ("path", "kind", "n", "low", "high", "values", "shapes", "distinct", "items"))])
    assert a.children["code"].distinct / a.children["code"].items == 64 / 3000


def test_repeated_numbers_in_one_range_are_no_rename(spark):
    a = records(2000, col_9=lambda i: 2 * (i % 64), x=lambda i: 1)
    b = records(2000, oven=lambda i: 2 * (i % 64) + 1, x=lambda i: 1)
    assert [c[1] for c in changes(spark, a, b)] == ["added", "removed"]


def test_shared_values_of_large_fields(spark):
    sizes = {"p": range(6000), "q": range(3000, 9000), "r": range(2000)}
    rows = {r["path"]: r for r in profile(spark, [[{k: v} for k, vs in sizes.items() for v in vs]]).collect()}
    field = {k: build_tree([tuple(rows[k][c] for c in ("path", "kind", "n", "low", "high", "values", "shapes", "distinct", "items"))]).children[k] for k in sizes}
    assert all(field[k].distinct == len(v) for k, v in sizes.items())
    assert abs(shared_values(field["p"], field["q"]) - 3000) < 500 and abs(shared_values(field["p"], field["r"]) - 2000) < 400


def test_fields_in_several_sets_give_the_same_profiles(spark, monkeypatch):
    from ledgerloom.operators import drift

    files = [records(400, a=lambda i: i % 90, b=lambda i: f"v{i}", c=lambda i: [i % 7, "x"]), records(30, a=lambda i: i)]
    one = sorted(map(str, profile(spark, files).collect()))
    monkeypatch.setattr(drift, "SET_SIZE", 20)
    assert sorted(map(str, profile(spark, files).collect())) == one
