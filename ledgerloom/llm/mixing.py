"""Sources mixed to target shares of the total size, with capped repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import beside

#: Seeds tried for each source; the one whose tokens come nearest to its part of the mix is taken.
SEEDS = 64
RATES = "source_name string, target_share double, max_repeats int, tokens long, rate double"


def repetition_rates(totals: DataFrame, targets: DataFrame, budget: float | None = None) -> DataFrame:
    """``(source_name, target_share, max_repeats, tokens, rate)`` of each target source (schema ``RATES``).

    Without ``budget`` the mix is as large as the caps allow with every share met: the least over the
    sources of ``max_repeats * tokens / share``.  With one, a source that cannot reach its part is used up to
    its cap.  Shares are scaled to add up to 1 over the sources that have tokens; a source without tokens has rate 0
    and doesn't bound the mix.  Targets of null name are left out, null shares and caps are 0.
    """
    tokens = totals.select("source_name", F.col("tokens").cast("long").alias("tokens"))
    rows = targets.where("source_name is not null").join(tokens, "source_name", "left").select(
        "source_name", F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)).alias("target_share"), F.coalesce(F.col("max_repeats").cast("int"), F.lit(0)).alias("max_repeats"), F.coalesce("tokens", F.lit(0)).alias("tokens")
    )
    share = F.when(F.col("tokens") > 0, F.col("target_share"))
    bound = F.min(F.when((F.col("tokens") > 0) & (F.col("target_share") > 0), F.col("max_repeats") * F.col("tokens") / F.col("target_share")))
    whole = rows.agg(F.sum(share).alias("_share"), bound.alias("_bound"))  # one row
    size = F.col("_bound") * F.col("_share") if budget is None else F.lit(float(budget))
    wanted = F.coalesce(size * F.col("target_share") / F.nullif("_share", F.lit(0.0)) / F.nullif("tokens", F.lit(0)), F.lit(0.0))
    rate = F.when((F.col("tokens") > 0) & (F.col("target_share") > 0), F.least(F.col("max_repeats").cast("double"), wanted)).otherwise(0.0)
    return beside(rows, whole).select("source_name", "target_share", "max_repeats", "tokens", rate.alias("rate"))


def _uniform(key: Column, seed: Column) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    return F.pmod(F.xxhash64(key, seed), F.lit(1 << 52)) / float(1 << 52)


def mix(sizes: DataFrame, rates: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """Each copy of each document in the mix: ``(doc_id, source_name, copy_no, n_tokens)``.

    ``sizes`` has ``doc_id``, ``source_name`` and ``n_tokens``.  A document comes out ``floor(rate)`` times, and once
    more with the probability of the rate's fraction, drawn from the hash of its id: the same on every run.  Of
    ``seeds`` draws, whose tokens are added up for each source in one pass, a source takes the one that comes nearest to
    its part (the first of equals).  Documents of sources without target, or of none, are left out.  Rows are not shuffled,
    only sums of sources.
    """
    rated = sizes.select("doc_id", "source_name", "n_tokens").join(rates.select("source_name", "rate", "tokens"), "source_name")
    part = F.col("rate") - F.floor("rate")
    drawn = [F.sum(F.when(_uniform(F.col("doc_id"), F.lit(s)) < F.col("part"), F.col("n_tokens")).otherwise(0)).alias(f"s{s}") for s in range(seeds)]
    sums = rated.withColumn("part", part).groupBy("source_name", "part", (part * F.col("tokens")).alias("want")).agg(*drawn)
    off = F.array(*[F.struct(F.abs(F.col(f"s{s}") - F.col("want")).alias("off"), F.lit(s).alias("seed")) for s in range(seeds)])
    seed = sums.select("source_name", F.array_min(off)["seed"].alias("seed"))
    seeded = rated.join(seed, "source_name")
    copies = F.floor("rate").cast("int") + (_uniform(F.col("doc_id"), F.col("seed")) < part).cast("int")
    return seeded.withColumn("n", copies).where("n > 0").select("doc_id", "source_name", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy_no"), "n_tokens")


def share_report(mixed: DataFrame, rates: DataFrame, totals: DataFrame) -> DataFrame:
    """Per source: its target share, its actual share of the mix's tokens and how far that is off, copies, documents, most uses.

    Sources without target, and documents without source, are listed with the tokens they would have had and share 0.
    """
    per_doc = mixed.groupBy("source_name", "doc_id").agg(F.count("*").alias("uses"), F.sum("n_tokens").alias("used"))
    per = per_doc.groupBy("source_name").agg(F.sum("used").alias("tokens"), F.sum("uses").alias("copies"), F.count("*").alias("documents"), F.max("uses").alias("most_uses"))
    rest = totals.join(rates.select("source_name"), "source_name", "left_anti").select("source_name", F.lit(0.0).alias("target_share"), F.lit(0).alias("max_repeats"), "tokens", F.lit(0.0).alias("rate"))
    plan = rates.select("source_name", "target_share", "max_repeats", "tokens", "rate").unionByName(rest).withColumnRenamed("tokens", "available_tokens")
    joined = plan.join(per, "source_name", "left").fillna(0, ["tokens", "copies", "documents", "most_uses"])
    whole = per.agg(F.sum("tokens").alias("all_tokens"))  # one row
    actual = F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens"))
    return beside(joined, whole).withColumn("actual_share", actual).withColumn("off", F.col("actual_share") - F.col("target_share")).drop("all_tokens")
