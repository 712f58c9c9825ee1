"""Free-entered values mapped to a canonical list: a prefix-filtered set-similarity join."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.words import fold, resolve, words
from ledgerloom.session import cut

#: Least Jaccard similarity of a value's words and an entry's words.
THRESHOLD = 0.6
#: A canonical list of up to so many entries, and up to so many different words of values that stand for known ones, are
#: sent to every executor; larger ones are joined by a shuffle.
SENT_ENTRIES, SENT_WORDS = 20_000, 200_000


@dataclass(frozen=True)
class Canon:
    """A canonical list: its entries ``(id long, text)``, other phrases that mean an entry, and remarks that may be left out.

    ``phrases`` pairs a phrase with an entry's text; ``remarks`` are patterns on folded text.
    """

    entries: DataFrame
    phrases: tuple[tuple[str, str], ...] = ()
    remarks: tuple[str, ...] = ()


def canon(df: DataFrame, key: str, text: str, phrases: tuple = (), remarks: tuple = ()) -> Canon:
    """The canonical list of a table; nulls are left out, of one text the least id is kept."""
    entries = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    return Canon(entries.groupBy("text").agg(F.min("id").alias("id")).select("id", "text"), phrases, remarks)


def _readings(text: Column | str, remarks: tuple[str, ...] = ()) -> Column:
    """The different words of a text in order: of the text as it stands, without any one of its remarks, and without all."""
    patterns = [re.compile(r) for r in remarks]

    @F.pandas_udf("array<array<string>>")
    def read(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            plain = " ".join(fold(t).split())
            held, bare = [r for r in patterns if r.search(plain)], plain
            for r in held:
                bare = r.sub(" ", bare)
            every = dict.fromkeys(tuple(dict.fromkeys(words(x))) for x in (plain, *(r.sub(" ", plain) for r in held), bare))
            out.append([list(ws) for i, ws in enumerate(every) if ws or not i])
        return pd.Series(out, dtype=object)

    return read(text)


def _allowed(n: Column) -> Column:
    """How many words of a set of ``n`` are probed: the rarest ``n - ceil(t n) + 1``."""
    return (n - F.ceil(F.lit(THRESHOLD) * n - 1e-9) + 1).cast("int")


def _phrases(canon: Canon) -> DataFrame:
    """``(entry, ref_id, ws)``: every entry and every further phrase of one, as its set of words."""
    spark = canon.entries.sparkSession
    own = canon.entries.select("id", _readings("text")[0].alias("ws"))
    if canon.phrases:
        more = spark.createDataFrame(list(canon.phrases), "phrase string, meant string").select(_readings("phrase")[0].alias("ws"), F.array_join(_readings("meant")[0], " ").alias("plain"))
        named = own.groupBy(F.array_join("ws", " ").alias("plain")).agg(F.min("id").alias("id"))
        own = own.unionByName(more.join(named, "plain").select("id", "ws"))
    return own.where(F.size("ws") > 0).select(F.xxhash64("id", "ws").alias("entry"), F.col("id").alias("ref_id"), "ws")


def _slots(read: DataFrame, slot: DataFrame) -> DataFrame:
    """``read`` with, of each word of ``ws``, the ranks of the known words it may stand for (``slots``), and whether it is
    one or a misspelt one (``sure``).

    ``slot`` (w, sure, ranks) has the words that stand for any.  Up to ``SENT_WORDS`` of them are sent to the executors;
    more are joined.
    """
    if slot.count() > SENT_WORDS:
        word = read.select("text", "v", F.posexplode("ws").alias("at", "w")).join(slot, "w", "left")
        seen = F.struct("at", F.coalesce("sure", F.lit(False)).alias("sure"), F.coalesce("ranks", F.array().cast("array<int>")).alias("ranks"))
        listed = word.groupBy("text", "v").agg(F.array_sort(F.collect_list(seen)).alias("x"))
        return read.join(listed, ["text", "v"]).select(*read.columns, F.transform("x", lambda x: x["ranks"]).alias("slots"), F.transform("x", lambda x: x["sure"]).alias("sure"))
    sent = read.sparkSession.sparkContext.broadcast({r["w"]: (r["sure"], sorted(r["ranks"])) for r in slot.collect()})  # at most SENT_WORDS
    none = (False, [])

    @F.pandas_udf("struct<slots:array<array<int>>,sure:array<boolean>>")
    def look(ws: pd.Series) -> pd.DataFrame:
        known = sent.value
        found = [[known.get(w, none) for w in words_] for words_ in ws]
        return pd.DataFrame({"slots": [[x for _, x in f] for f in found], "sure": [[x for x, _ in f] for f in found]})

    return read.withColumn("_found", look("ws")).select(*read.columns, "_found.slots", "_found.sure")


def map_values(values: DataFrame, canon: Canon) -> DataFrame:
    """Each distinct value (column ``text``, no nulls) with its entry: ``(text, ref_id long, similarity double)``.

    A value is read as it stands and without its remarks.  Each word is set to the known words of the list it may stand for
    (spelling, abbreviation), once for all values.  Known words are ordered by rarity over all values; only the rarest
    ``|x| - ceil(t|x|) + 1`` words of a reading and of an entry are joined, pairs are cut down by length and position,
    Jaccard is verified exactly on all words, and the best entry is kept.  Where an entry has one word
    only, or not all words agree, words that can only be taken as abbreviations don't count.  ``ref_id`` is 0 where no
    entry reaches ``THRESHOLD``, or where several different entries are equally near.  Equal Jaccard is decided by
    the edit distance of the whole text.  An empty list maps everything to 0.
    """
    phrases = cut(_phrases(canon))
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows can be much work, so they aren't left in one task
    read = cut(values.select("text").repartition(tasks).select("text", F.posexplode(_readings("text", canon.remarks)).alias("v", "ws")))
    asked = read.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    vocabulary = phrases.select(F.explode("ws").alias("w")).distinct()
    known = cut(resolve(asked.select("w"), vocabulary).join(asked, "w").where(F.size("near") > 0))
    count = known.select(F.explode("near").alias("w"), "n").groupBy("w").agg(F.sum("n").alias("n"))
    # The words of the list by how often they are meant, then by themselves; the window holds the list's words only.
    rank = F.row_number().over(Window.orderBy(F.coalesce("n", F.lit(0)), "w")).alias("rank")
    ranks = cut(vocabulary.join(count, "w", "left").select("w", rank))
    slot = known.select(F.col("w").alias("asked"), F.col("how").isin("same", "typo").alias("sure"), F.explode("near").alias("w")).join(ranks, "w")
    slot = cut(slot.groupBy(F.col("asked").alias("w"), "sure").agg(F.collect_list("rank").alias("ranks")))
    readings = _slots(read, slot).select("text", F.size("ws").alias("n"), F.array_join(F.array_sort("ws"), " ").alias("plain"), "slots", "sure").where("n > 0")
    # A word that may stand for several known words has no fixed place in the order: it is probed as each
    # of them that can come within the prefix, whatever the other words stand for.
    last = F.transform("slots", lambda s: F.coalesce(F.array_max(s), F.lit(0)))
    probes = readings.withColumn("last", last).select("*", F.explode(F.array_distinct(F.flatten("slots"))).alias("rank"))
    probes = probes.withColumn("at", F.size(F.filter("last", lambda r: r < F.col("rank")))).where(F.col("at") < _allowed(F.col("n"))).drop("last")
    entries = phrases.select("entry", "ref_id", F.array_join(F.array_sort("ws"), " ").alias("entry_text"), F.explode("ws").alias("w")).join(ranks, "w")
    entries = entries.groupBy("entry", "ref_id", "entry_text").agg(F.array_sort(F.collect_list("rank")).alias("entry_words")).withColumn("m", F.size("entry_words"))
    entries = entries.select("ref_id", "entry_text", "entry_words", "m", F.posexplode(F.slice("entry_words", F.lit(1), _allowed(F.col("m")))).alias("entry_at", "rank"))
    small = canon.entries.count() + len(canon.phrases) <= SENT_ENTRIES
    t = F.lit(THRESHOLD)
    pairs = probes.join(F.broadcast(entries) if small else entries, "rank").where(
        (F.col("m") >= t * F.col("n"))
        & (F.col("n") >= t * F.col("m"))
        # position filter: the words still to come must be able to reach the needed overlap
        & (1 + F.least(F.col("n") - F.col("at") - 1, F.col("m") - F.col("entry_at") - 1) + F.col("entry_at") >= t / (1 + t) * (F.col("n") + F.col("m")) - 1e-9)
    )
    found = lambda ok: F.size(F.filter("entry_words", lambda w: F.exists(F.arrays_zip("slots", "sure"), lambda z: ok(z) & F.array_contains(z["slots"], w))))
    overlap = F.least(found(lambda z: F.lit(True)), "n")
    jaccard = overlap / (F.col("n") + F.col("m") - overlap)
    fair = F.when((F.col("m") == 1) | (F.col("j") < 1), found(lambda z: z["sure"]) >= F.col("overlap")).otherwise(True)
    scored = pairs.withColumn("overlap", overlap).withColumn("j", jaccard).where(F.col("j") >= t).where(fair).select("text", "ref_id", "j", (-F.levenshtein("plain", "entry_text")).alias("near"))
    scored = scored.groupBy("text").agg(F.max(F.struct("j", "near")).alias("top"), F.collect_set(F.struct("j", "near", "ref_id")).alias("all"))
    ties = F.array_distinct(F.transform(F.filter("all", lambda a: (a["j"] == F.col("top.j")) & (a["near"] == F.col("top.near"))), lambda a: a["ref_id"]))
    mapped = scored.select("text", F.when(F.size(ties) == 1, ties[0]).otherwise(F.lit(0)).alias("ref_id"), F.col("top.j").alias("similarity"))
    return values.select("text").join(mapped, "text", "left").select("text", F.coalesce("ref_id", F.lit(0)).cast("long").alias("ref_id"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def map_records(rows: DataFrame, key: str, text: str, canon: Canon) -> DataFrame:
    """``(key, text, ref_id, similarity)`` of each record whose value is not exactly an entry's text.

    Null values are left out, repeated deliveries of a key and value count once.  Each distinct value is
    mapped once; values holding more than 1/64 of all rows (at most 64) are looked up by broadcast,
    the others by one shuffle on the value, which also removes the repetitions.
    """
    exact = canon.entries.select("text")
    exact = F.broadcast(exact) if exact.count() <= SENT_ENTRIES else exact
    open_rows = rows.select(F.col(key).alias("k"), F.col(text).alias("text")).where("text is not null").join(exact, "text", "left_anti")
    counts = cut(open_rows.groupBy("text").agg(F.count("*").alias("n")))
    mapping = cut(map_values(counts, canon))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > max(20_000, total / 64)).select("text")
    hot_list = [r["text"] for r in hot.collect()]
    cold = open_rows.where(~F.col("text").isin(*hot_list)) if hot_list else open_rows
    out = cold.join(mapping, "text").dropDuplicates(["text", "k"])
    if hot_list:
        few = F.broadcast(mapping.where(F.col("text").isin(*hot_list)))
        out = out.unionByName(open_rows.where(F.col("text").isin(*hot_list)).dropDuplicates(["k", "text"]).join(few, "text").select(*out.columns))
    return out.select(F.col("k").alias(key), F.col("text").alias(text), "ref_id", "similarity")
