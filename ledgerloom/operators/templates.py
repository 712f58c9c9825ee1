"""Form templates: declared in YAML or here, matched by keywords, bound to cells by position."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import normalize

FORM = "form_id string, ord int, first_data_row int, trailing_rows_to_drop int, dash_means long, ditto_markers array<string>"
COLUMN = "form_id string, col int, key string, type string, printed boolean, ditto boolean"
KEYWORD = "form_id string, ord int, keyword string"
CHECK = "form_id string, check_idx int, target string, sum_of array<string>"


@dataclass(frozen=True)
class Template:
    """One form: where its data rows are, its columns in order, and its rules."""

    form_id: str
    match: tuple[str, ...] = ()
    columns: tuple[tuple[str, str, bool], ...] = ()
    first_data_row: int = 1
    trailing_rows_to_drop: int = 0
    dash_means: int | None = None
    ditto_columns: tuple[str, ...] = ()
    ditto_markers: tuple[str, ...] = ()
    checks: tuple[tuple[str, tuple[str, ...]], ...] = field(default=())
    header_row: int = 0
    description: str = ""


# The two declared forms.
MIS_PLATING = Template(
    "mis_plating",
    match=("DAILY MIS REPORT", "MPPL/F/QAD/35"),
    columns=(
        ("sr_no", "integer", True), ("defect", "text", True), ("reason", "text", True), ("cr_aael", "integer", False), ("cr_aad", "integer", False),
        ("engine_guard", "integer", False), ("pedal_brake", "integer", False), ("pgc", "integer", False), ("handle", "integer", False), ("total", "integer", False),
        ("renickel", "integer", False), ("rechrome", "integer", False), ("bufff", "integer", False), ("ok", "integer", False), ("b_grade", "integer", False),
        ("scrap", "integer", False), ("total_final", "integer", False),
    ),
    first_data_row=4,
    dash_means=0,
    checks=(("total", ("cr_aael", "cr_aad", "engine_guard", "pedal_brake", "pgc", "handle")),),
    header_row=3,
)
SCRAP_NOTE = Template(
    "scrap_note",
    match=("Scrap Note", "MPPL/F/STR/07"),
    columns=(
        ("s_no", "integer", True), ("item_code", "text", False), ("item_name", "text", False), ("unit", "text", False),
        ("rejection_qty", "integer", False), ("vendor_name", "text", False), ("reason_remarks", "text", False),
    ),
    header_row=3,
    first_data_row=4,
    trailing_rows_to_drop=1,
    ditto_columns=("unit", "vendor_name", "reason_remarks"),
    ditto_markers=("''", '"', "11", "l1", "1l", "//", ",,", "))", ")1", "1)"),
)
TEMPLATES = (MIS_PLATING, SCRAP_NOTE)


def parse_template(raw: dict) -> Template:
    """A template from a YAML document: one keyword may stand alone, lists may be null, unknown column keys raise."""
    columns = []
    for c in raw.get("columns") or []:
        if extra := set(c) - {"key", "type", "printed"}:
            raise ValueError(f"unknown column settings {sorted(extra)} in {raw.get('form_id')}")
        columns.append((c["key"], c.get("type", "text"), bool(c.get("printed", False))))
    if len({k for k, _, _ in columns}) < len(columns):
        raise ValueError(f"column keys repeat in {raw.get('form_id')}")
    match = raw.get("match") or []
    return Template(
        raw["form_id"],
        match=(match,) if isinstance(match, str) else tuple(match),
        columns=tuple(columns),
        first_data_row=int(raw.get("first_data_row", 1)),
        trailing_rows_to_drop=int(raw.get("trailing_rows_to_drop", 0)),
        dash_means=raw.get("dash_means"),
        ditto_columns=tuple(raw.get("ditto_columns") or ()),
        ditto_markers=tuple(str(m) for m in raw.get("ditto_markers") or ()),
        checks=tuple((c["target"], tuple(c.get("sum_of") or ())) for c in raw.get("checks") or ()),
        header_row=int(raw.get("header_row", 0)),
        description=raw.get("description") or "",
    )


def load_templates(folder: str) -> list[Template]:
    """All ``*.yaml`` of a folder in order of name, which decides ties; no folder or empty files give none."""
    import yaml

    path = Path(folder)
    docs = [yaml.safe_load(p.read_text(encoding="utf-8")) for p in sorted(path.glob("*.yaml"))] if path.is_dir() else []
    return [parse_template(d) for d in docs if d]


def template_tables(spark: SparkSession, templates: list[Template] | tuple[Template, ...] = TEMPLATES) -> dict[str, DataFrame]:
    """The templates as small dimension tables: forms, columns, keywords, checks."""
    forms = [(t.form_id, i, t.first_data_row, t.trailing_rows_to_drop, t.dash_means, list(t.ditto_markers)) for i, t in enumerate(templates)]
    columns = [(t.form_id, c, k, kind, printed, k in t.ditto_columns) for t in templates for c, (k, kind, printed) in enumerate(t.columns)]
    keywords = keywords_of(templates)
    checks = [(t.form_id, i, target, list(parts)) for t in templates for i, (target, parts) in enumerate(t.checks)]
    return {n: spark.createDataFrame(rows, schema) for n, rows, schema in (("forms", forms, FORM), ("columns", columns, COLUMN), ("keywords", keywords, KEYWORD), ("checks", checks, CHECK))}


def form_of(text: Column, keywords: list[tuple[str, int, str]]) -> Column:
    """``struct(form_id, hits)``: the form with most keywords in a page's text; ties go to the first, none to ``generic``."""
    hay = normalize(F.coalesce(text, F.lit("")))
    by_form: dict[tuple[int, str], list[str]] = {}
    for form, at, word in keywords:
        by_form.setdefault((at, form), []).append(" ".join(word.split()).lower())
    scored = lambda t: [F.struct(sum((F.contains(t, F.lit(w)).cast("int") for w in words), F.lit(0)).alias("hits"), F.lit(-at).alias("first"), F.lit(form).alias("form_id")) for (at, form), words in sorted(by_form.items())]
    if not by_form:
        return F.struct(F.lit("generic").alias("form_id"), F.lit(0).alias("hits"))
    # The text is normalized once, whatever the number of keywords.
    best = F.transform(F.array(hay), lambda t: F.array_max(F.array(*scored(t))))[0]
    return F.struct(F.when(best["hits"] > 0, best["form_id"]).otherwise("generic").alias("form_id"), best["hits"].alias("hits"))


def keywords_of(templates: list[Template] | tuple[Template, ...] = TEMPLATES) -> list[tuple[str, int, str]]:
    return [(t.form_id, i, k) for i, t in enumerate(templates) for k in t.match]


def match_template(pages: DataFrame, key: str, text: str, keywords: list[tuple[str, int, str]]) -> DataFrame:
    """``(key, form_id, hits)`` of each page (``form_of``), in place, without a join: the keywords are few and given."""
    return pages.select(key, form_of(F.col(text), keywords).alias("_form")).select(key, "_form.form_id", "_form.hits")


def bind_columns(cells: DataFrame, forms: DataFrame, columns: DataFrame, form: str = "form_id") -> DataFrame:
    """Cells of data rows with their column's key and type, bound by position; cells beyond the template are dropped.

    ``cells`` has ``form_id``, ``row``, ``col`` and ``n_rows``.  Generic pages get ``col_<n>`` from row 1 on.
    """
    generic = cells.where(F.col(form) == "generic").where((F.col("row") >= 1) & (F.col("row") < F.col("n_rows")))
    generic = generic.select("*", F.concat(F.lit("col_"), "col").alias("key"), F.lit("text").alias("type"), F.lit(False).alias("printed"), F.lit(False).alias("ditto"))
    typed = cells.where(F.col(form) != "generic").join(F.broadcast(forms.select(form, "first_data_row", "trailing_rows_to_drop")), form)
    typed = typed.where((F.col("row") >= F.col("first_data_row")) & (F.col("row") < F.col("n_rows") - F.col("trailing_rows_to_drop"))).drop("first_data_row", "trailing_rows_to_drop")
    return typed.join(F.broadcast(columns), [form, "col"]).select(*generic.columns).unionByName(generic)
