import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerloom.operators import profile
from ledgerloom.operators.footers import chunk_statistics
from ledgerloom.operators.profile import LoadField, departing_loads, load_profiles, profile_table

SCHEMA = "rec long, load_id long, station_id long, q long, c double, n int, bins string"
FIELDS = [("q", True), ("c", False)]


def fields():
    return [LoadField("q", lambda v: ~v.isin(-1, 9999), True), LoadField("c")]


def station(odd=None, loads=8, rows=120, seed=1):
    rng, out, rec = random.Random(seed), [], 0
    for load in range(loads):
        for _ in range(rows):
            rec += 1
            q, c = max(1, int(rng.lognormvariate(1.6, 0.7))), round(min(0.99, max(0.05, rng.gauss(0.5, 0.12))), 3)
            if rng.random() < 0.01:
                q = 9999
            if odd and load == 3:
                q, c = odd(rng, q, c)
            out.append((rec, load, 1, q, c, 0, "clash"))
    return out


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = departing_loads(load_profiles(df, "rec", "load_id", "station_id", fields()), fields()).collect()
    return {(r["load"], r["field_name"]): set(r["reasons"]) for r in got}


def test_even_loads_have_no_cases(spark):
    assert found(spark, station()) == {}


def test_each_kind_of_departure(spark):
    cases = {
        "nulls": (lambda r, q, c: (None if r.random() < 0.6 else q, c), "q"),
        "distinct": (lambda r, q, c: (5, c), "q"),
        "form": (lambda r, q, c: (q, round(c, 1)), "c"),
        "range": (lambda r, q, c: (q, c * 100 if r.random() < 0.06 else c), "c"),
        "distribution": (lambda r, q, c: (q * 6, c), "q"),
    }
    for reason, (odd, field) in cases.items():
        got = found(spark, station(odd))
        assert set(got) == {(3, field)} and reason in got[3, field], (reason, got)


def test_repeats_stand_ins_and_missing_keys(spark):
    rows = station()
    assert found(spark, rows + rows[:300] + [(None, None, None, None, None, None, None)]) == {}
    profile = load_profiles(spark.createDataFrame(rows + rows, SCHEMA), "rec", "load_id", "station_id", fields()).where("load = 0 and field_name = 'q'").first()
    own = [r for r in rows if r[1] == 0]
    assert profile["n"] == 120 and profile["high"] == max(r[3] for r in own if r[3] != 9999)
    assert profile["n_distinct"] == len({r[3] for r in own if r[3] != 9999}) and sum(profile["forms"]) == profile["n_values"]


def test_hot_load_is_counted_whole(spark):
    rows = [(i, 7, 1, i % 50 + 1, 0.5, 0, "") for i in range(60_000)]
    p = load_profiles(spark.createDataFrame(rows, SCHEMA), "rec", "load_id", "station_id", fields()).where("field_name = 'q'").collect()
    assert len(p) == 1 and p[0]["n"] == 60_000 and p[0]["n_distinct"] == 50 and sum(b["n"] for b in p[0]["bins"]) == 60_000


def test_empty_and_two_loads(spark):
    assert found(spark, []) == {}
    assert found(spark, station(lambda r, q, c: (5, c), loads=2)) == {}


def test_footers_and_dictionaries(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    table = pa.table({"a": pa.array([3, 1, None, 3] * 500), "s": ["x", "yy", None, "x"] * 500, "f": [0.5, 1.5, None, 2.5] * 500, "z": pa.array([None] * 2000, pa.int64())})
    pq.write_table(table, path, row_group_size=700)
    got = chunk_statistics(spark, [path], ["a", "s", "f", "z", "gone"], True).collect()
    assert len(got) == 15
    for r in got:
        want = {"a": {"1", "3"}, "s": {"x", "yy"}, "f": {"0.5", "1.5", "2.5"}, "z": set(), "gone": set()}[r["field"]]
        assert set(r["distinct_values"]) == want and r["distinct_complete"] and r["exact"]
    plain = str(tmp_path / "plain.parquet")
    pq.write_table(table, plain, use_dictionary=False, write_statistics=False)
    assert not any(r["exact"] or r["distinct_complete"] for r in chunk_statistics(spark, [plain], ["a"], True).collect())


def test_table_profile_scans_only_what_it_must(spark, tmp_path):
    table = pa.table({"a": pa.array([3, 1, None, 3] * 500), "s": ["x" * 50_000, "y", None, ""] * 500})
    folder = tmp_path / "t"
    folder.mkdir()
    pq.write_table(table, folder / "a.parquet")
    pq.write_table(table, folder / "b.parquet", use_dictionary=False, write_statistics=False)
    got = {r["field"]: r for r in profile_table(spark.read.parquet(str(folder)), ["a", "s"]).collect()}
    assert (got["a"]["rows"], got["a"]["nulls"], got["a"]["distinct_values"], got["a"]["low"], got["a"]["high"], got["a"]["scanned_chunks"]) == (4000, 1000, 2, 1.0, 3.0, 1)
    assert (got["s"]["rows"], got["s"]["nulls"], got["s"]["distinct_values"]) == (4000, 1000, 3)
    spark.createDataFrame([], "a long, s string").write.parquet(str(tmp_path / "empty"))
    empty = profile_table(spark.read.parquet(str(tmp_path / "empty")), ["a"]).first()
    assert empty["rows"] == 0 and empty["null_share"] is None


def test_loads_known_from_footers_alone(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()

    def write(name, load, first, q, c, title="A", rows=50):
        n = range(first, first + rows)
        pq.write_table(pa.table({"rec_id": pa.array(n, pa.int64()), "load_id": pa.array([load] * rows, pa.int64()), "station_id": pa.array([1] * rows, pa.int64()), "q": pa.array([q(i) for i in n], pa.int64()), "c": pa.array([c(i) for i in n], pa.float64()), "title": [title] * rows}), folder / name)

    write("a.parquet", 1, 0, lambda i: 5, lambda i: None)
    write("b.parquet", 2, 100, lambda i: None if i % 2 else 7, lambda i: 0.5)
    write("c.parquet", 3, 200, lambda i: i % 9 + 1, lambda i: i / 1000)
    write("d.parquet", 2, 300, lambda i: 7, lambda i: 0.25)
    write("e.parquet", 4, 400, lambda i: 9999, lambda i: 0.5, "B")
    write("f.parquet", 5, 500, lambda i: 9999, lambda i: 0.5)
    write("g.parquet", 6, 600, lambda i: 1, lambda i: 0.5)
    write("h.parquet", 6, 620, lambda i: 1, lambda i: 0.5)
    df = spark.read.parquet(str(folder))
    known, scan = profile.sufficient_groups(df, "rec_id", "load_id", "station_id", fields(), {"title": "A"})
    assert {r["path"].rsplit("/", 1)[1] for r in scan.collect()} == {"c.parquet", "e.parquet", "g.parquet", "h.parquet"} and known.count() == 9
    columns = ["load", "field_name", "station", "n", "nulls", "n_values", "n_distinct", "low", "high", "bins", "forms"]
    both = [sorted(map(str, load_profiles(df, "rec_id", "load_id", "station_id", fields(), {"title": "A"}, footers=f).select(*columns).collect())) for f in (True, False)]
    assert both[0] == both[1] and len(both[0]) == 10


def test_row_groups_of_one_file_are_judged_apart(spark, tmp_path):
    path, schema = str(tmp_path / "t.parquet"), pa.schema([("rec", pa.int64()), ("load_id", pa.int64()), ("station_id", pa.int64()), ("q", pa.int64()), ("c", pa.float64())])
    with pq.ParquetWriter(path, schema) as out:
        for g in range(4):
            n = range(g * 100, g * 100 + 60)
            out.write_table(pa.table({"rec": n, "load_id": [g] * 60, "station_id": [1] * 60, "q": [7 if g != 2 else i % 5 + 1 for i in n], "c": [0.5 if i % 2 else None for i in n]}, schema=schema))
    df = spark.read.parquet(path)
    known, scan = profile.sufficient_groups(df, "rec", "load_id", "station_id", fields(), {})
    assert [(r["row_group"]) for r in scan.collect()] == [2] and known.count() == 9
    columns = ["load", "field_name", "n", "nulls", "n_values", "n_distinct", "low", "high", "bins", "forms"]
    both = [sorted(map(str, load_profiles(df, "rec", "load_id", "station_id", fields(), footers=f).select(*columns).collect())) for f in (True, False)]
    assert both[0] == both[1] and len(both[0]) == 8


def test_values_are_the_same_from_dictionaries_and_scans(spark, tmp_path):
    from datetime import datetime

    folder = tmp_path / "t"
    folder.mkdir()
    table = pa.table({"f": [1e-5, 2.5] * 50, "t": pa.array([datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 6)] * 50, pa.timestamp("us")), "d": pa.array([1, 20000] * 50, pa.date32()), "b": [True, False] * 50, "n": [[1], None] * 50, "z": [0.0, -0.0] * 50})
    pq.write_table(table, folder / "a.parquet")
    pq.write_table(table, folder / "b.parquet", use_dictionary=False)
    got = {r["field"]: r for r in profile_table(spark.read.parquet(str(folder))).collect()}
    assert {f: got[f]["distinct_values"] for f in got} == {"f": 2, "t": 2, "d": 2, "b": 2, "n": 1, "z": 1} and all(r["rows"] == 200 for r in got.values())
    assert got["t"]["low_text"].startswith("2024-01-01 00:00:00") and got["f"]["low"] == 1e-5 and got["n"]["nulls"] == 100
    nan = tmp_path / "nan.parquet"
    pq.write_table(pa.table({"f": [1.0, float("nan"), None, 3.0]}), nan)
    r = profile_table(spark.read.parquet(str(nan))).first()
    assert (r["low"], r["high"], r["nulls"], r["distinct_values"], r["scanned_chunks"]) == (1.0, 3.0, 1, 3, 1)


def test_patterns(spark, tmp_path):
    spark.createDataFrame([("AB-12", 1), ("C-7", 2), ("C-7", 3), ("x", 4), (None, 5), ("", 6)], "s string, n int").write.parquet(str(tmp_path / "t"))
    got = {r["pattern"]: r["distinct_values"] for r in profile.profile_patterns(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert got == {"a-9": 2, "a": 1, "": 1}


def test_a_worker_holds_one_station_at_a_time():
    import tracemalloc

    stations, loads, bins = 300, 10, 120
    load = lambda k: {"load": k, "n": bins, "nulls": 0, "n_values": bins, "n_distinct": bins, "mid": [float(i) for i in range(bins)] if k % loads != 3 else [1000.0 + i for i in range(bins)], "freq": [1] * bins, "forms": [bins, 0, 0, 0, 0]}
    kind = pa.struct([("load", pa.int64()), ("n", pa.int64()), ("nulls", pa.int64()), ("n_values", pa.int64()), ("n_distinct", pa.int64()), ("mid", pa.list_(pa.float64())), ("freq", pa.list_(pa.int64())), ("forms", pa.list_(pa.int64()))])
    rows = pa.array([[load(s * loads + k) for k in range(loads)] for s in range(stations)], pa.list_(kind))
    batch = pa.RecordBatch.from_arrays([pa.array(range(stations), pa.int64()), pa.array(["q"] * stations), rows], ["station", "field_name", "loads"])
    tracemalloc.start()
    got = [r for b in profile._departures(iter([batch]), {"q": False}, profile.Departure()) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["load"], r["station"]) for r in got] == [(s * loads + 3, s) for s in range(stations)] and all("range" in r["reasons"] for r in got)
    assert peak < 5_000_000, peak  # 360,000 bins as Python objects take far more
