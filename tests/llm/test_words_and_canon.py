import random

import pytest

from ledgerloom.llm import canonical
from ledgerloom.llm.canonical import Canon, canon, map_records, map_values
from ledgerloom.llm.lexicon import REASON_PHRASES
from ledgerloom.llm.words import KnownWords, abbreviates, edits, fold, words


def slow_edits(a, b):
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_edits_against_the_full_table():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in "ab")
        assert edits(a, b, 2) == min(3, slow_edits(a, b))


def test_words():
    assert words(fold("M/s 0wn  Sh0p, son's (P) Ltd.")) == ["ms", "own", "shop", "sons", "p", "ltd"]
    assert fold("Émaille 125") == "emaille 125"
    assert abbreviates("brkt", "bracket") and not abbreviates("bracket", "brkt") and not abbreviates("kt", "bracket")
    known = KnownWords(["lamp", "clamp", "front", "frame", "lh", "rh"])
    assert known.nearest("lamp") == ("same", ["lamp"]) and known.nearest("lapm") == ("typo", ["lamp"])
    assert known.nearest("fr") == ("short", ["frame", "front"]) and known.nearest("lr") == ("none", []) and known.nearest("x" * 500) == ("none", [])


ENTRIES = ((1, "Burr on cut edge"), (2, "Hole oversize"), (3, "Hole undersize"), (4, "Weld crack"), (5, "Nut"))
PHRASES = (("bore too big", "Hole oversize"), ("lost", "no such entry"))
MEANT = [(i, list(dict.fromkeys(words(fold(t))))) for i, t in (*ENTRIES, (2, PHRASES[0][0]))]


@pytest.fixture(scope="module")
def listed(spark):
    return Canon(spark.createDataFrame(ENTRIES, "id long, text string"), PHRASES, (r"\bagain\b",))


VALUES = {
    "burr on cut edge.": 1, "edge cut on Burr": 1, "Hole ovesrize": 2, "hole o/s": 2, "H0le under5ize again": 3, "BORE TOO BIG": 2, "wld crack": 4, "Weld-crack": 4, "nutt": 5,
    "hole": 0, "crack in hole weld and more": 0, "{/zb": 0, "": 0, "  ": 0, "x" * 20_000: 0, "weld " * 5000 + "crack": 4, "nt": 0,
}


def test_values_to_entries(spark, listed):
    got = {r["text"]: r["ref_id"] for r in map_values(spark.createDataFrame([(v,) for v in VALUES], "text string"), listed).collect()}
    assert got == VALUES


def brute(value):
    best = []
    known = KnownWords([w for _, p in MEANT for w in p])
    tokens = list(dict.fromkeys(words(fold(value))))
    near = [known.nearest(w) for w in tokens]
    for i, phrase in MEANT:
        hit = min(len(tokens), sum(any(w in n for _, n in near) for w in phrase))
        sure = sum(any(w in n and how != "short" for how, n in near) for w in phrase)
        j = hit / max(1, len(tokens) + len(phrase) - hit)
        if j >= canonical.THRESHOLD and (sure >= hit or (len(phrase) > 1 and j == 1)):
            best.append((j, i))
    top = {i for j, i in best if j == max(b[0] for b in best)}
    return top.pop() if len(top) == 1 else 0


def test_prefix_join_loses_nothing(spark, listed):
    rng, pool = random.Random(9), sorted({w for _, p in MEANT for w in p}) + ["zz", "ovr", "crak", "hol"]
    values = sorted({" ".join(rng.choice(pool) for _ in range(rng.randint(1, 5))) for _ in range(400)})
    plain = Canon(listed.entries, listed.phrases)
    got = {r["text"]: (r["ref_id"], r["similarity"]) for r in map_values(spark.createDataFrame([(v,) for v in values], "text string"), plain).collect()}
    assert len(got) == len(values)
    for v in values:
        want = brute(v)
        if want or got[v][0]:
            assert got[v][0] == want or want == 0, (v, got[v], want)


def test_records(spark, listed):
    rows = [(1, "hole oversize", "clash"), (1, "hole oversize", "clash"), (2, "Hole oversize", ""), (3, None, ""), (4, "nothing like it", ""), (5, "hole oversize", ""), (None, "weld crack", "")]
    df = spark.createDataFrame(rows, "rec long, value string, ref_id string")
    got = sorted((r["rec"] or 0, r["ref_id"]) for r in map_records(df, "rec", "value", listed).collect())
    assert got == [(0, 4), (1, 2), (4, 0), (5, 2)]
    assert map_records(df.limit(0), "rec", "value", listed).count() == 0
    empty = canon(spark.createDataFrame([(None, "x"), (1, None)], "i int, t string"), "i", "t")
    assert {r["ref_id"] for r in map_records(df, "rec", "value", empty).collect()} == {0}


def test_hot_value_is_mapped_whole(spark, listed):
    df = spark.range(60_000).selectExpr("id as rec", "case when id % 3 = 0 then concat('v', id) else 'hole oversiz' end as value")
    got = map_records(df, "rec", "value", listed)
    assert got.count() == 60_000 and got.where("ref_id = 2").count() == 40_000


def test_phrases_name_entries(spark, small):
    entries = {r["reason_text"] for r in spark.read.parquet(f"{small}/reason_list.parquet").collect()}
    assert {t for _, t in REASON_PHRASES} <= entries


def test_a_remark_is_left_out_only_where_that_helps(spark):
    listed = Canon(spark.createDataFrame([(1, "Mixed lot"), (2, "Rust seen")], "id long, text string"), (), (r"\blot \d+\b", r"\b\d+ pcs?\b", r"\bseen\b"))
    values = {"mixed lot 4 pcs": 1, "rust seen 3 pcs": 2, "mixed lot seen": 1, "seen": 0, "4 pcs": 0}
    assert {r["text"]: r["ref_id"] for r in map_values(spark.createDataFrame([(v,) for v in values], "text string"), listed).collect()} == values


def test_lists_above_what_is_sent_give_the_same(spark, listed, monkeypatch):
    from ledgerloom.llm import words as lookup

    monkeypatch.setattr(canonical, "SENT_ENTRIES", 2)
    monkeypatch.setattr(canonical, "SENT_WORDS", 2)
    monkeypatch.setattr(lookup, "VOCABULARY", 3)
    assert {r["text"]: r["ref_id"] for r in map_values(spark.createDataFrame([(v,) for v in VALUES], "text string"), listed).collect()} == VALUES
