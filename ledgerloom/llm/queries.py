"""Queries of the text problems (5 to 9), and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.usable import usable_text
from ledgerloom.llm.canonical import canon, map_records
from ledgerloom.llm.entities import entity_pairs, link_names
from ledgerloom.llm.langid import MAX_NAMES, classify_units, fit_units, label_code, name_pattern, read_units
from ledgerloom.llm.lexicon import REASON_PHRASES, REMARKS
from ledgerloom.llm.mixing import mix, repetition_rates, share_report
from ledgerloom.llm.packing import fill_report, pack_documents
from ledgerloom.llm.tokens import measure
from ledgerloom.session import cut, table


def _mapped(spark: SparkSession, sf: str, phrases: tuple, remarks: tuple) -> DataFrame:
    notes = table(spark, sf, "scrap_note_rows").where(usable_text("reason_remarks"))
    welds = table(spark, sf, "weld_shop_rows").where(F.col("_row").between(5, 35) & usable_text("col_2"))
    reasons = canon(table(spark, sf, "reason_list"), "reason_id", "reason_text", phrases, remarks)
    items = canon(table(spark, sf, "item_list"), "item_id", "item_text", (), remarks)
    parts = [(notes, "reason_remarks", reasons), (welds, "col_2", items)]
    done = [map_records(rows, "rec_id", c, listed).select(F.lit(c).alias("field_name"), "rec_id", F.col(c).alias("value"), "ref_id", "similarity") for rows, c, listed in parts]
    return done[0].unionByName(done[1])


def p5_mapped(spark: SparkSession, sf: str) -> DataFrame:
    """Each usable value that is not an entry's text, with its entry and how similar it is."""
    return _mapped(spark, sf, REASON_PHRASES, REMARKS)


def p5_spelled(spark: SparkSession, sf: str) -> DataFrame:
    """The same by spelling alone, without further phrases and remarks: what the method finds in the two lists themselves."""
    return _mapped(spark, sf, (), ())


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p5_mapped(spark, sf).select("field_name", "rec_id", F.col("ref_id").cast("int").alias("ref_id"))


def p6_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Each registered spelling with the entity it names (the least name_id of its group)."""
    register = table(spark, sf, "name_register")
    kind = F.when(F.col("field_name") == "item_name", "item").otherwise("firm")
    linked = link_names(register.select(F.col("name_id").alias("id"), F.col("name_text").alias("name"), kind.alias("kind")))
    return linked.select(F.col("id").alias("name_id"), F.col("entity").alias("entity_id"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    linked = p6_entities(spark, sf).select(F.col("name_id").alias("id"), F.col("entity_id").alias("entity"))
    return entity_pairs(linked).select(F.col("a").alias("name_id_a"), F.col("b").alias("name_id_b"))


QUERIES = {"p6_found": p6_found, "p6_entities": p6_entities, "p5_found": p5_found, "p5_mapped": p5_mapped, "p5_spelled": p5_spelled}
SQL: dict[str, str] = {}


def _item_names(spark: SparkSession, sf: str) -> list[str]:
    """The distinct item names; one above the bound is read, so that ``name_pattern`` raises."""
    name = F.lower(F.trim("item_text"))
    names = table(spark, sf, "item_list").where(F.length(name) > 0).select(name.alias("n")).distinct()
    return [r["n"] for r in names.limit(MAX_NAMES + 1).collect()]


def p9_stretches(spark: SparkSession, sf: str) -> DataFrame:
    """The language of each stretch of each document, with its confidence and the label as delivered."""
    read = read_units(table(spark, sf, "documents"), "text", "doc_id", "lang", name_pattern(_item_names(spark, sf)))
    return classify_units(read, fit_units(read))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = p9_stretches(spark, sf).where(F.col("seg_no") >= 0)
    right = (F.col("n_langs") == 1) & F.coalesce(label_code("label") == F.col("lang"), F.lit(False))
    return rows.where(~right).select(F.col("key").alias("doc_id"), "seg_no", "lang")


QUERIES |= {"p9_found": p9_found, "p9_stretches": p9_stretches}


#: Container specifications packed in one query.
MAX_SPECS = 1_000


def _specs(spark: SparkSession, sf: str) -> list[tuple[str, int]]:
    rows = table(spark, sf, "container_specs").limit(MAX_SPECS + 1).collect()
    if len(rows) > MAX_SPECS:
        raise ValueError(f"container_specs has more than {MAX_SPECS} entries")
    return sorted((r["spec_name"], r["capacity_tokens"]) for r in rows)


def p7_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Every document, or piece of one above the capacity, with its container of each spec."""
    return pack_documents(table(spark, sf, "documents"), "doc_id", "text", _specs(spark, sf))


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    return fill_report(p7_packed(spark, sf), _specs(spark, sf))


def _mix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = table(spark, sf, "documents")
    sizes = measure(docs, "doc_id", "text", vectors=False, keep=("source",))
    sizes = cut(sizes.select(F.col("key").alias("doc_id"), F.col("source").alias("source_name"), "n_tokens"))
    totals = sizes.groupBy("source_name").agg(F.sum("n_tokens").alias("tokens"))
    rates = cut(repetition_rates(totals, table(spark, sf, "mix_targets")))
    return mix(sizes, rates), rates, totals


def p8_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Every copy of every document in the mix."""
    return _mix(spark, sf)[0]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return share_report(*_mix(spark, sf))


QUERIES |= {"p7_packed": p7_packed, "p7_fill": p7_fill, "p8_mixed": p8_mixed, "p8_shares": p8_shares}
