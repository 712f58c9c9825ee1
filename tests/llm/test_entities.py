import math
import random

from pyspark.sql import functions as F

from ledgerloom.llm import entities, words
from ledgerloom.llm.entities import LINK, entity_pairs, link_names, parse_firm, parse_firms, similar_pairs, size_up, soft_similarity, weigh
from ledgerloom.llm.lexicon import FIRMS as LEXICON
from ledgerloom.llm.lexicon import FirmLexicon

FIRMS = [
    ["Tavasata Sugar Engineering and Sons", "Tavasata S. Engineering & Son's", "Sugar Tavasata Engineering and Sons", "Engineering, Tavasata Sugar and Sons", "Tavasta Sugar Engg & Sons", "M/s Tavasata Sugar Engineering", "Tavasata Sugar & Son's", "TAVASATA SUGAR ENGINEERING AND SONS"],
    ["Tavasata Sugar Springs Pvt Ltd", "Tavasatasugar Sprgs (P) Ltd.", "Tavasata Sguar Spring Private Limited", "Tavasata Sugar P Ltd"],
    ["Rodevara Sotal Metal Works", "Rodevara Sotal M. Works", "Rodevara Soatl Metalworks", "Messrs Rodevara Sotal Metal Wks"],
    ["Korbhela Forge Works", "KFW (Korbhela)", "Forge Works Korbhela", "Korbela Forge Works"],
    ["Wyndle Press Tools Pvt Ltd", "Wyndle P.T.", "Wyndel Press Tools"],
    ["Own Shop", "OWN SHOP (internal)", "0wn Shop", "own sohp", "Ownshop", "Self Make"],
    ["Nolokagi Lanos Polymers"],
]
ITEMS = [
    ["Horn Bracket Front LH", "horn brkt fr LH", "Front LH, Horn Bracket", "HRON BRACKET FRONT LH"],
    ["Horn Bracket Front RH", "Horn Bracket fr RH"], ["Horn Bracket Front", "Horn brkt fr"], ["Horn Bracket Rear", "Horn Bracket rr"], ["Horn Bracket Inner"], ["Horn Bracket Outer", "Outer Horn Bracket"],
    ["Horn Bracket Rear LH"], ["Horn Bracket Rear RH"], ["Horn Bracket Long"], ["Horn Bracket Assembly", "Horn Bracket assy"],
]
ITEMS += [[f"{part} {place}"] for part in ("Lamp Bracket", "Seat Support", "Tank Strap", "Side Stand", "Fender Stay", "Hinge Link") for place in ("Front", "Front LH", "Front RH", "Rear", "Rear LH", "Rear RH", "Assembly")]


def test_firms_and_items(spark):
    rows, want = [], set()
    for kind, groups in (("firm", FIRMS), ("item", ITEMS)):
        for g in groups:
            ids = list(range(len(rows) + 1, len(rows) + 1 + len(g)))
            rows += [(i, n, kind, "clash") for i, n in zip(ids, g)]
            want |= {(a, b) for a in ids for b in ids if a < b}
    rows += [(900, None, "firm", ""), (901, "  ", "item", ""), (902, "//", "item", ""), (903, "x" * 5000, "firm", "")]
    names = spark.createDataFrame(rows, "id long, name string, kind string, entity string")
    linked = link_names(names)
    assert linked.count() == len(rows)
    got = {(r["a"], r["b"]) for r in entity_pairs(linked).collect()}
    name = {r[0]: r[1] for r in rows}
    assert got == want, ([(name[a], name[b]) for a, b in want - got], [(name[a], name[b]) for a, b in got - want])


def test_copies_are_linked_without_pairs(spark):
    letters = spark.range(9_000).selectExpr("id", "translate(md5(cast(id as string)), '0123456789abcdef', 'bdgklmnrstvaeiou') as t")
    names = letters.selectExpr("id", "case when id % 3 = 0 then 'Rodevara Sotal Springs' when id = 1 then 'Rodevara S. Springs' else concat(substr(t, 1, 8), ' ', substr(t, 9, 5), ' Polymers') end as name", "'firm' as kind")
    linked = link_names(names)
    assert linked.count() == 9_000 and linked.where("entity = 0").count() == 3_001


def test_empty(spark):
    assert link_names(spark.createDataFrame([], "id long, name string, kind string")).count() == 0


def test_parts():
    assert parse_firm("M/S. Suderoto Bonal Polymers L.L.P.") == (["suderoto", "bonal"], "polymers", "llp")
    assert parse_firm("Auto Parts, Kotalono Viber and Company") == (["kotalono", "viber"], "autoparts", "co")
    even = lambda name: [(w, 1000) for w in parse_firm(name)[0]]
    same = lambda x, y: soft_similarity(even(x), even(y), x, y) >= LINK
    assert same("Detisudi Dobel Polymers", "Detisudi Dibel Springs") and not same("Detisudi Dobel Polymers", "Detisudi Ramas Polymers")
    assert not same("Kobo Ltd", "Kabo Sales")


def test_rare_words_count_more():
    score = lambda rare, common: soft_similarity([("kotalono", rare), ("viber", common)], [("kotalono", rare), ("ramas", common)], "", "")
    assert score(9000, 1000) > 0.8 > score(5000, 5000) > score(1000, 9000)
    assert soft_similarity([], [("a", 1)], "", "x") == 0.0 and parse_firm("Rodevara Sotal Springs Ltd", FirmLexicon()) == (["rodevara", "springs", "sotal", "ltd"], "", "")


def test_join_finds_what_comparing_all_pairs_finds(spark, small):
    register = spark.read.parquet(f"{small}/name_register.parquet").where("field_name = 'vendor_name'")
    names = register.select(F.col("name_id").alias("id"), F.col("name_text").alias("name"))
    own = {r["id"]: r["own"] for r in parse_firms(names, LEXICON).collect()}
    full = {r["id"]: r["name"] for r in names.collect()}
    df = {w: sum(w in o for o in own.values()) for o in own.values() for w in o}
    weighted = {i: [(w, round(1000 * math.log(1 + len(own) / df[w]))) for w in o] for i, o in own.items()}
    ids = sorted(own)
    want = {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if soft_similarity(weighted[a], weighted[b], full[a], full[b]) >= LINK}
    sets = parse_firms(names, LEXICON).select("id", F.lit("firm").alias("kind"), "own")
    pairs = similar_pairs(size_up(weigh(sets.withColumn("grams", entities._grams(F.col("own"))), "grams")))
    made = [(r["id_a"], r["id_b"]) for r in pairs.select("id_a", "id_b").collect()]
    assert len(want) > 150 and len(made) == len(set(made))
    assert len(want & set(made)) >= 0.9 * len(want)


def test_join_is_exact_and_splits_frequent_tokens(spark, monkeypatch):

    rng = random.Random(8)
    rows = [(i, "firm", sorted({f"t{rng.randrange(12)}" for _ in range(4)} | {f"r{rng.randrange(60)}"})) for i in range(150)]
    df = {t: sum(t in s for _, _, s in rows) for _, _, s in rows for t in s}
    w = {t: round(1000 * math.log(1 + len(rows) / n)) for t, n in df.items()}
    weight = lambda s: sum(w[t] for t in s)
    alike = lambda least: {(i, j) for i, _, a in rows for j, _, b in rows if i < j and weight(set(a) & set(b)) > least * weight(set(a) | set(b))}
    table = spark.createDataFrame(rows, "id long, kind string, ts array<string>")
    for block in (1000, 7):
        monkeypatch.setattr(entities, "BLOCK", block)
        got = [(r["id_a"], r["id_b"]) for r in similar_pairs(size_up(weigh(table, "ts"))).collect()]
        assert alike(entities.JOIN + 0.002) <= set(got) <= alike(entities.JOIN - 0.002) and len(got) == len(set(got))


def test_known_words_in_any_number_of_blocks(spark, monkeypatch):
    known = spark.createDataFrame([(w,) for w in ("bracket", "brake", "mounting", "plate", "plated", "rear", "rr", "nut")], "w string")
    asked = spark.createDataFrame([(w,) for w in ("brkt", "brcket", "mtg", "plte", "rear", "rr", "nutt", "x", "", "q" * 3000)], "w string")
    one = {r["w"]: (r["how"], r["near"]) for r in words.resolve(asked, known, longer=True).collect()}
    monkeypatch.setattr(words, "VOCABULARY", 2)
    assert {r["w"]: (r["how"], r["near"]) for r in words.resolve(asked, known, longer=True).collect()} == one
    assert one["brcket"] == ("typo", ["bracket"]) and one["rr"][1] == ["rear", "rr"] and one["x"] == ("none", [])


def test_firms_of_equal_words_are_compared_once(spark):
    rows = [(1, "Tavasata Sugar Springs Ltd"), (2, "Sugar Tavasata Polymers"), (3, "TAVASATA SUGAR SPRINGS"), (4, "KFW (Korbhela)"), (5, "Korbhela Forge Works"), (6, "Korbhela Forge Works Ltd"), (7, "//"), (8, "..")]
    got = {r["id"]: (r["rep"], r["initials"]) for r in entities.group_firms(parse_firms(spark.createDataFrame(rows, "id long, name string"), LEXICON)).collect()}
    assert {i: got[i][0] for i in (1, 2, 3, 4, 7, 8)} == {1: 1, 2: 1, 3: 1, 4: 4, 7: 7, 8: 8} and got[5][1] == "kfw" and got[1][1] == ""


def test_no_pair_that_is_linked_is_passed_over(spark):
    rng = random.Random(4)
    letters = "bdklnrsaeiou"

    def typed(w):
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
            i = rng.randrange(len(w) - 1)
            w = rng.choice((w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + w[i + 1 :]))
        return w

    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(5, 12)))
    rows = []
    for i in range(600):
        a = [(word(), rng.randrange(1000, 9000)) for _ in range(rng.choice((1, 2, 2, 3)))]
        b = [(typed(w) if rng.random() < 0.8 else word(), n) for w, n in a]
        rng.shuffle(b)
        rows.append((i, a, b, soft_similarity(a, b, "", "") >= LINK))
    kind = "struct<ws:array<struct<t:string,weight:long>>,whole:boolean,initials:string>"
    side = lambda ws: (ws, all(len(w) > 4 for w, _ in ws), "")
    df = spark.createDataFrame([(i, side(a), side(b), linked) for i, a, b, linked in rows], f"id int, a {kind}, b {kind}, linked boolean")
    may = {r["id"]: r["may"] for r in df.select("id", entities.may_link(F.col("a"), F.col("b")).alias("may")).collect()}
    linked = {i for i, *_, x in rows if x}
    assert len(linked) > 100 and all(may[i] for i in linked) and sum(not x for x in may.values()) > 100
