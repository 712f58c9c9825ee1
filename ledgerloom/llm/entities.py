"""Variant spellings of names linked to one entity: prefix-filtered q-gram join, soft weighted verification."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.lexicon import FIRMS, FirmLexicon
from ledgerloom.llm.words import allowed_edits, edits, fold, resolve, words
from ledgerloom.operators.graph import connected_components
from ledgerloom.session import cut

#: Letters of a q-gram; a word is marked at both ends.
Q = 4
#: Least weighted Jaccard similarity of two names' q-grams for them to be compared, and least soft weighted similarity of
#: their words for them to be linked.
JOIN, LINK = 0.18, 0.77
#: A word of so many item names is a known word, which others may misspell or abbreviate.
KNOWN_IN = 6
#: Weights of q-grams are whole thousandths below this; holders of a q-gram are compared in blocks of about so many.
WEIGHTS, BLOCK = 1 << 20, 1000

PARSED = "id long, own array<string>, trade string, legal string, initials string"
SIZED = "id long, kind string, total long, codes array<long>, prefix array<struct<t:long,left:long>>"


def parse_firm(name: str, lexicon: FirmLexicon = FIRMS) -> tuple[list[str], str, str]:
    """The owner's words (longest first), the trade and the legal form of a firm's name ('' if none)."""
    text = re.sub(lexicon.address, " ", fold(name)) if lexicon.address else fold(name)
    plain = " ".join(words(text))
    for other, meant in lexicon.aliases:
        if plain == other:
            text = meant
    legal = ""
    for pattern, form in lexicon.legal_forms:
        if re.search(pattern, text):
            legal, text = legal or form, re.sub(pattern, " ", text)
    outside = re.sub(r"\([^)]*\)", " ", text)
    if len(words(outside)) >= 2:
        text = outside
    exact = {v: t for t, forms in lexicon.trades.items() for v in forms}
    trade = ""
    rest: list[str] = []
    for w in (w for w in words(text) if w != "and"):
        hit = exact.get(w)
        if not hit and len(w) >= 6:
            near = [(d, t) for t, forms in lexicon.trades.items() for v in forms if len(v) >= 6 and (d := edits(w, v, 2)) <= 2]
            hit = min(near)[1] if near else None
        if hit and (not trade or trade == hit):
            trade = hit
        else:
            rest.append(w)
    if trade in lexicon.halves:
        halves = lexicon.halves[trade]
        drop = [w for w in rest if len(w) == 1 and w == halves[0][0] and re.search(rf"\b{w}\b[. ]+{halves[1]}\b", text)]
        drop += [w for w in rest if len(w) > 2 and any(edits(w, h, 1) <= 1 for h in halves)]
        if len(rest) - len(drop) >= 1:
            rest = [w for w in rest if w not in drop]
    return sorted(rest, key=lambda w: (-len(w), w)), trade, legal


def initials_of(full: str) -> str:
    """The first letters of all words of a name."""
    return "".join(w[0] for w in words(fold(full)))


def soft_similarity(a: list[tuple[str, int]], b: list[tuple[str, int]], full_a: str, full_b: str) -> float:
    """Soft similarity of two owners' weighted words, 0 to 1: the share of their weight that agrees, rare words counting more.

    Words are paired one to one, the likest first, as far as a typing error may take them apart (less a share for each
    edit); a single letter agrees with a word it begins.  Words run together are compared as one, in either order.
    A word of the other name's initials stands for all words but one that agrees.
    """
    for own, other, full in ((a, b, full_b), (b, a, full_a)):
        initials = initials_of(full)
        rest = [w for w, _ in own if w != initials]
        if len(initials) >= 3 and len(rest) == len(own) - 1 == 1:
            return 0.85 if any(edits(rest[0], w, 1) <= 1 for w, _ in other if len(w) >= 6) else 0.0
    if not a or not b:
        return 0.0
    total = sum(w for _, w in a) + sum(w for _, w in b)

    def like(x: str, y: str) -> float:
        if x == y:
            return 1.0
        if min(len(x), len(y)) == 1:
            return INITIAL if x[0] == y[0] and len(x) != len(y) else 0.0
        most = allowed_edits(min(len(x), len(y)))
        d = edits(x, y, most)
        return 1 - d / max(len(x), len(y)) if d <= most else 0.0

    ranked = sorted(((-like(x, y), i, j) for i, (x, _) in enumerate(a) for j, (y, _) in enumerate(b)))
    left, right, agreed, whole = set(), set(), 0.0, False
    for negative, i, j in ranked:
        if negative < 0 and i not in left and j not in right:
            left.add(i)
            right.add(j)
            agreed -= negative * (a[i][1] + b[j][1])
            whole |= min(len(a[i][0]), len(b[j][0])) > 1
    score = agreed / total if whole else 0.0
    if len(a) != len(b) and all(len(w) > 1 for w, _ in (*a, *b)):
        x, y = [w for w, _ in a], [w for w, _ in b]
        joined = min(edits(p, q, 2) for p in {"".join(x), "".join(reversed(x))} for q in {"".join(y), "".join(reversed(y))})
        n = max(sum(map(len, x)), sum(map(len, y)))
        if joined <= (1 if n < 8 else 2):
            score = max(score, 1 - joined / n)
    return score


#: How far a single letter agrees with a word it begins.
INITIAL = 0.85


def parse_firms(names: DataFrame, lexicon: FirmLexicon) -> DataFrame:
    """Names of firms (``id``, ``name``) read into owner's words, trade, legal form and initials (schema ``PARSED``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, *parse_firm(name, lexicon), initials_of(name)) for i, name in zip(pdf["id"].tolist(), pdf["name"].tolist())]
            yield pd.DataFrame(rows, columns=["id", "own", "trade", "legal", "initials"])

    return names.select("id", "name").mapInPandas(run, PARSED)


def parse_items(names: DataFrame) -> DataFrame:
    """``(id, slots)``: of each item name its words in order, each as the known words it may stand for, or as itself.

    A known word that may itself be short for longer known words stands for these too.
    """

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(dict.fromkeys(words(fold(t)))))

    word = names.select("id", F.posexplode(split("name")).alias("at", "w"))
    plain = names.select("id", F.explode(F.array_distinct(F.split(F.lower(F.regexp_replace("name", r"[/']", "")), r"[^\p{L}\p{N}]+"))).alias("w")).where("length(w) > 1")
    known = plain.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= KNOWN_IN).select("w")
    near = resolve(word.select("w").distinct(), known, longer=True)
    slots = word.join(near, "w").select("id", "at", F.when(F.size("near") > 0, F.col("near")).otherwise(F.array("w")).alias("slot"))
    return slots.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "slot"))).alias("s")).select("id", F.transform("s", lambda x: x["slot"]).alias("slots"))


def _grams(ws: Column) -> Column:
    """The q-grams of words; single letters have none beside longer words, since they agree with any word they begin."""
    long = F.filter(ws, lambda w: F.length(w) > 1)
    marked = F.transform(F.when(F.size(long) > 0, long).otherwise(ws), lambda w: F.concat(F.lit("^"), w, F.lit("$")))
    of = lambda m: F.transform(F.sequence(F.lit(1), F.greatest(F.length(m) - Q + 1, F.lit(1))), lambda i: F.substr(m, i, F.lit(Q)))
    return F.array_distinct(F.flatten(F.transform(marked, of)))


def weigh(sets: DataFrame, tokens: str) -> DataFrame:
    """``(id, kind, ts)``: the tokens of each set with their weights, the rarest first.

    A token's weight is the logarithm of how rare it is among the sets of its kind, in thousandths.  A set counts as often
    as its column ``times`` says, once without.
    """
    sets = sets if "times" in sets.columns else sets.withColumn("times", F.lit(1))
    token = sets.select("id", "kind", "times", F.explode(tokens).alias("t"))
    df = token.groupBy("kind", "t").agg(F.sum("times").alias("df"))
    sizes = sets.groupBy("kind").agg(F.sum("times").alias("size"))  # one row a kind
    weight = F.least(F.round(1000 * F.log(1 + F.col("size") / F.col("df"))), F.lit(WEIGHTS - 1)).cast("long")
    weights = df.join(F.broadcast(sizes), "kind").select("kind", "t", weight.alias("weight"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("rare"), "t")))
    return token.join(weights, ["kind", "t"]).groupBy("id", "kind").agg(listed.alias("ts")).select("id", "kind", F.transform("ts", lambda x: F.struct(x["t"].alias("t"), (-x["rare"]).alias("weight"))).alias("ts"))


def size_up(weighed: DataFrame) -> DataFrame:
    """Weighed sets as codes (a token's hash with its weight in the low bits) with their prefix (schema ``SIZED``).

    A prefix ends where the weight still to come falls below ``JOIN`` of the set's: sets that share none of theirs cannot
    be similar enough.  ``left`` is the weight from that token on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, kind, codes in zip(pdf["id"].tolist(), pdf["kind"].tolist(), pdf["codes"]):
                codes = np.asarray(codes, dtype=np.int64)
                weights = codes & (WEIGHTS - 1)
                left = weights[::-1].cumsum()[::-1]
                n = int((left >= JOIN * left[0] - 1e-6).sum()) if len(left) else 0
                rows.append((i, kind, int(left[0]) if len(left) else 0, codes, [{"t": int(t), "left": int(x)} for t, x in zip(codes[:n], left[:n])]))
            yield pd.DataFrame(rows, columns=["id", "kind", "total", "codes", "prefix"])

    code = F.transform("ts", lambda x: F.shiftleft(F.shiftright(F.xxhash64(x["t"]), 20), 20).bitwiseOR(x["weight"]))
    return weighed.select("id", "kind", code.alias("codes")).mapInPandas(run, SIZED)


def may_link(a: Column, b: Column) -> Column:
    """False only where ``soft_similarity`` is below ``LINK`` for sure: an upper bound of it, from plain edit distances.

    ``a`` and ``b`` have ``ws`` (words with weights), ``whole`` (no short word) and ``initials``.  A swap is one edit there and
    two here, so a distance counts half; every word is taken to agree with its likest, one to one or not.  Names with
    short words, different numbers of words or the other's initials may always be linked.
    """
    loose = ~a["whole"] | ~b["whole"] | (F.size(a["ws"]) != F.size(b["ws"])) | F.exists(a["ws"], lambda w: w["t"] == b["initials"]) | F.exists(b["ws"], lambda w: w["t"] == a["initials"])

    def like(x: Column, y: Column) -> Column:
        d = F.levenshtein(x, y, 4)
        return F.when(d >= 0, 1 - F.ceil(d / 2) / F.greatest(F.length(x), F.length(y))).otherwise(0.0)

    def agreed(ws: Column, others: Column) -> Column:
        return F.aggregate(ws, F.lit(0.0), lambda s, w: s + w["weight"] * F.array_max(F.transform(others, lambda o: like(w["t"], o["t"]))))

    total = F.aggregate(F.concat(a["ws"], b["ws"]), F.lit(0.0), lambda s, w: s + w["weight"])
    return loose | (agreed(a["ws"], b["ws"]) + agreed(b["ws"], a["ws"]) >= (LINK - 1e-6) * total)


def similar_pairs(sized: DataFrame, carried: str | None = None, keep: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(id_a, id_b, kind)`` of all sets of one kind whose weighted Jaccard similarity is ``JOIN`` or more.

    With ``keep``, a condition on the column ``carried`` of both, only pairs that meet it leave the join.

    A pair is made on its rarest common token only, is passed over where the totals or the weight still to come are too
    small (length and positional filters), and is verified exactly.  Holders of a frequent token are split into
    blocks of about ``BLOCK``, each of which meets all of them in a task of its own.
    """
    also = [carried] if carried else []
    token = sized.select("kind", F.explode("prefix").alias("p"), "id", "total", "codes", *also).select("kind", "p.t", "p.left", "id", "total", "codes", *also)
    often = token.groupBy("kind", "t").agg(F.count("*").alias("n")).where("n > 1").select("kind", "t", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    held = token.join(often, ["kind", "t"])
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("id", "left", "total", "codes", *also)]
    a = held.select("kind", "t", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), *side("a"))
    b = held.select("kind", "t", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *side("b"))
    # Common tokens are taken once: their first must be the one joined on, their weights are added up.
    common = F.transform(F.array(F.array_intersect("codes_a", "codes_b")), lambda x: F.when(x[0] == F.col("t"), F.aggregate(x, F.lit(0).cast("long"), lambda s, c: s + c.bitwiseAND(F.lit(WEIGHTS - 1)))))[0]
    both = F.col("total_a") + F.col("total_b")
    need = JOIN / (1 + JOIN) * both - 1
    fit = (F.col("id_a") < F.col("id_b")) & (F.least("left_a", "left_b") >= need) & (F.least("total_a", "total_b") >= JOIN * F.greatest("total_a", "total_b") - 1) & (common >= need)
    fit = fit & keep(F.col(f"{carried}_a"), F.col(f"{carried}_b")) if keep else fit
    return a.join(b, ["kind", "t", "block"]).where(fit).select("id_a", "id_b", "kind")


def group_firms(firms: DataFrame) -> DataFrame:
    """Parsed firms with ``rep``, the least id of those that compare alike, and ``initials`` kept only where they may matter.

    Firms of the same owner's words compare alike with every other, and are linked with one another, unless initials
    come in: those that are no word of an owner of two words never do.  Firms without words stay alone.
    """
    known = firms.where(F.size("own") == 2).select(F.explode("own").alias("initials")).where(F.length("initials") >= 3).distinct().withColumn("matter", F.lit(True))
    firms = firms.join(known, "initials", "left").withColumn("initials", F.when(F.col("matter"), F.col("initials")).otherwise(""))
    alone = F.when((F.size("own") == 0) | F.array_contains("own", F.col("initials")), F.col("id"))
    return firms.select("id", "own", "trade", "legal", "initials", F.min("id").over(Window.partitionBy("own", "initials", alone)).alias("rep"))


def item_similarity(a: list[tuple[list[str], int]], b: list[tuple[list[str], int]]) -> float:
    """Share of the weight of two items' words that agrees one to one, where a word agrees if both may stand for one known
    word, or, unknown, are a typing error apart."""
    if not a or not b:
        return 0.0
    free, agreed = list(b), 0
    for s, w in sorted(a, key=lambda x: len(x[0])):
        fit = next((t for t in sorted(free, key=lambda x: len(x[0])) if set(s) & set(t[0])), None)
        if fit is None and len(s) == 1:
            fit = next((t for t in free if len(t[0]) == 1 and 0 < edits(s[0], t[0][0], 2) <= allowed_edits(min(len(s[0]), len(t[0][0]))) - 1), None)
        if fit is not None:
            agreed += w + fit[1]
            free.remove(fit)
    return agreed / (sum(w for _, w in a) + sum(w for _, w in b))


def link_names(names: DataFrame, lexicon: FirmLexicon = FIRMS) -> DataFrame:
    """``(id, entity)`` of each name: equal entities name one firm or one item.

    ``names`` has ``id`` (long, unique), ``name`` and ``kind`` (``firm`` or ``item``).  Null and blank names are entities of
    their own, as is every name with no variant.  Q-grams of the words (of firms the owner's, of items the known words they
    may stand for) are weighted by rarity over all names and joined on their rare prefixes (``similar_pairs``).  Pairs are
    linked by the soft weighted similarity of their words, in which rare ones count more; of items, moreover, all
    words must agree, since left and right are different items.  Of firms, trade and legal form don't count, except that
    different trades are different firms: a firm's name without trade goes to its owner's only trade, or to the
    only one of the same legal form; where several fit it stays alone.  Equal spellings are linked once, by the least
    id among them, so copies make no pairs; nor do firms whose owner's words are equal (``group_firms``).
    """
    every = names.where((F.length(F.trim("name")) > 0) & F.col("kind").isNotNull()).select(F.col("id").cast("long").alias("id"), "name", "kind")
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows can be much work, so they aren't left in one task
    usable = cut(every.groupBy("kind", "name").agg(F.min("id").alias("id")).select("id", "name", "kind"))
    firms = cut(group_firms(cut(parse_firms(usable.where("kind = 'firm'").repartition(tasks), lexicon))))
    of_items = usable.where("kind != 'firm'")
    items = of_items.select("id").join(parse_items(of_items), "id", "left").select("id", F.coalesce("slots", F.array().cast("array<array<string>>")).alias("slots"))
    alone = lambda w: F.transform(w, lambda x: F.array(x))
    groups = firms.groupBy("rep").agg(F.min_by("own", "id").alias("own"), F.min("initials").alias("initials"), F.count("*").alias("times"))
    parsed = groups.select(F.col("rep").alias("id"), F.lit("firm").alias("kind"), alone("own").alias("slots"), "initials", "times")
    parsed = cut(parsed.unionByName(items.select("id", F.lit("item").alias("kind"), "slots", F.lit("").alias("initials"), F.lit(1).cast("long").alias("times"))))
    weights = weigh(parsed.withColumn("ws", F.array_distinct(F.transform("slots", lambda s: s[0]))), "ws").select("id", F.map_from_entries("ts").alias("w"))
    shown = parsed.join(weights, "id").join(usable.select("id", "name"), "id").select("id", "kind", "name", "slots", "initials", F.transform("slots", lambda s: F.try_element_at(F.col("w"), s[0])).alias("weights"))
    shown = cut(shown)
    # Items take part in the join as names that may always be linked.
    ws = F.arrays_zip(F.transform("slots", lambda s: s[0]).alias("t"), F.col("weights").alias("weight"))
    whole = (F.col("kind") == "firm") & ~F.exists(F.flatten("slots"), lambda w: F.length(w) <= 4)
    owner = shown.select("id", F.struct(F.when(F.col("kind") == "firm", ws).alias("ws"), whole.alias("whole"), "initials").alias("owner"))
    sized = cut(size_up(weigh(parsed.withColumn("grams", _grams(F.flatten("slots"))), "grams")).join(owner, "id"))
    pairs = cut(similar_pairs(sized, "owner", may_link))
    words_of = lambda x: shown.select(*[F.col(c).alias(f"{c}_{x}") for c in ("id", "name", "slots", "weights")])
    pairs = pairs.join(words_of("a"), "id_a").join(words_of("b"), "id_b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for kind, na, nb, sa, sb, wa, wb in zip(*(pdf[c] for c in ("kind", "name_a", "name_b", "slots_a", "slots_b", "weights_a", "weights_b"))):
                a, b = ([([str(x) for x in s], int(n)) for s, n in zip(slots, ws)] for slots, ws in ((sa, wa), (sb, wb)))
                if kind == "firm":
                    keep.append(soft_similarity([(s[0], n) for s, n in a], [(s[0], n) for s, n in b], na, nb) >= LINK)
                else:
                    keep.append(item_similarity(a, b) >= 1.0)
            yield pdf.loc[keep, ["id_a", "id_b"]].rename(columns={"id_a": "a", "id_b": "b"})

    links = pairs.mapInPandas(verify, "a long, b long")
    members = firms.select("id", "rep", "trade", "legal").unionByName(items.select("id", F.col("id").alias("rep"), F.lit("").alias("trade"), F.lit("").alias("legal")))
    owners = connected_components(parsed.select("id"), links)
    firms = members.join(owners.withColumnRenamed("id", "rep"), "rep").select("id", "component", "trade", "legal")
    seen = firms.where("trade != ''").groupBy("component").agg(F.collect_set("trade").alias("trades"), F.collect_set(F.struct("trade", "legal")).alias("forms"))  # at most trades x legal forms
    known = firms.join(seen, "component", "left")
    same_form = F.array_distinct(F.transform(F.filter("forms", lambda f: f["legal"] == F.col("legal")), lambda f: f["trade"]))
    trade = (
        F.when((F.col("trade") != "") | F.col("trades").isNull(), F.col("trade"))
        .when(F.size("trades") == 1, F.element_at("trades", 1))
        .when(F.size(same_form) == 1, F.element_at(same_form, 1))
        .otherwise(F.concat(F.lit("?"), F.col("id").cast("string")))
    )
    keyed = known.select("id", "component", trade.alias("trade"))
    entity = keyed.groupBy("component", "trade").agg(F.min("id").alias("entity"))
    done = keyed.join(entity, ["component", "trade"]).select("id", "entity")
    spelt = usable.join(done, "id").select("name", "kind", "entity")
    done = every.join(spelt, ["name", "kind"]).select("id", "entity")
    rest = names.where(~((F.length(F.trim("name")) > 0) & F.col("kind").isNotNull()) | F.col("name").isNull() | F.col("kind").isNull()).select(F.col("id").cast("long").alias("id"))
    return done.unionByName(rest.select("id", F.col("id").alias("entity")))


def entity_pairs(linked: DataFrame) -> DataFrame:
    """Every pair of names of one entity, the smaller id first."""
    b = linked.select(F.col("id").alias("b"), "entity")
    return linked.select(F.col("id").alias("a"), "entity").join(b, "entity").where("a < b").select("a", "b")
