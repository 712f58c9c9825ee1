"""Nested result documents into flat child tables, by one tagged depth-first pass."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir

#: What the visitor emits for each object: the table tag, the document's key, the object's
#: own key and its parent's, the rest as JSON, and what of it no column of its child table shows
#: (null if nothing).
EMITTED = "result_id long, page_no int, tag string, row_no int, column_key string, ordinal int, node_key string, parent_key string, payload string, rest string"

#: Scalar columns of each child table, by tag (read from the emitted payload); ``a.b`` is a field
#: inside an object, as column ``a_b``.
CHILD_SCHEMAS = {
    "page": "form_id string, source string, text string",
    "row": "s_no int, item_code string, item_name string, unit string, rejection_qty long, vendor_name string, reason_remarks string, _confidence double, extra.operator.code string, extra.operator.shift string",
    "check": "failure string",
    "review": "value string, raw_text string, confidence double, bbox string",
    "meta": "orientation_applied int, orientation_method string, skew_deg double, grid_rows int, grid_cols int, cells_total int, cells_empty int, cells_dash int, cells_ocr int, cells_low_confidence int, mean_ocr_confidence double, engine string, seconds double",
    "broken": "reason string",
}
_COLUMNS = {tag: dict(c.split() for c in columns.split(", ")) for tag, columns in CHILD_SCHEMAS.items()}
_BITS = {"int": 31, "long": 63}


def _unpack(value: object) -> object:
    """A value whose JSON was written into a string, once or several times over."""
    while isinstance(value, str) and value.strip()[:1] in ("{", "[", '"'):
        try:
            value = json.loads(value)
        except (ValueError, RecursionError):
            return value
    return value


def _int(value: object) -> int | None:
    try:
        return None if isinstance(value, bool) else int(str(value).strip())
    except (TypeError, ValueError):
        return None


def _items(value: object, key_name: str) -> list[dict]:
    """A list of objects, given as a list, a single object, or a map from key to object."""
    value = _unpack(value)
    if isinstance(value, dict):
        inner = [(k, _unpack(v)) for k, v in value.items()]
        if inner and key_name not in value and all(isinstance(v, dict) and _int(k) is not None for k, v in inner):
            return [{key_name: k, **v} for k, v in inner]
        return [value] if value else []
    return [x for x in map(_unpack, value) if isinstance(x, dict)] if isinstance(value, list) else []


def _pages(doc: object) -> list[dict] | None:
    """The page objects of a document in any of its layouts; None if it holds no pages.  What stands in a list of pages
    and is no object becomes a page that has it as its value."""
    doc = _unpack(doc)
    while isinstance(doc, dict) and "pages" not in doc and not any(k in doc for k in ("page", "rows", "review_queue", "_meta")):
        wrapper = next((k for k in ("result", "data", "payload", "document") if k in doc), None)
        if wrapper is None:
            return None
        doc = _unpack(doc[wrapper])
    if isinstance(doc, dict) and "pages" in doc:
        doc = _unpack(doc["pages"])
        if isinstance(doc, dict) and "page" not in doc:
            doc = list(doc.values())
        elif not isinstance(doc, (dict, list)):
            doc = []
    elif isinstance(doc, dict):
        return [doc]
    if isinstance(doc, dict):
        return [doc]
    if not isinstance(doc, list):
        return None
    return [x if isinstance(x, dict) else {"value": x} for x in map(_unpack, doc) if x is not None]


def _shown(value: object, kind: str) -> bool:
    """Whether a column of this type shows the value unchanged."""
    if value is None or kind == "string":
        return True
    if type(value) is int and -(2**31) <= value < 2**31:
        return True
    if isinstance(value, bool) or not isinstance(value, (int, float, str)):
        return False
    if kind == "double":
        return abs(value) <= 2**53 if not isinstance(value, str) else bool(re.fullmatch(r"-?\d{1,15}(\.\d{1,15})?", value))
    whole = not isinstance(value, float) and re.fullmatch(r"-?[0-9]{1,19}", str(value))
    return bool(whole) and -(2 ** _BITS[kind]) <= int(value) < 2 ** _BITS[kind]


def _rest(x: dict, tag: str, prefix: str = "") -> dict:
    """What of an object no column of its child table shows: unlisted keys, and values that do not fit the column's type."""
    out, columns = {}, _COLUMNS[tag]
    for k, v in x.items():
        path = prefix + k
        kind = columns.get(path)
        if kind is not None:
            if kind != "string" and not _shown(v, kind):
                out[k] = v
        elif isinstance(v, dict) and any(c.startswith(path + ".") for c in columns):
            if inner := _rest(v, tag, path + "."):
                out[k] = inner
        else:
            out[k] = v
    return out


def _stray(value: object) -> object:
    """What of a list of objects is no object."""
    value = _unpack(value)
    if isinstance(value, list):
        return [x for x in value if x is not None and not isinstance(_unpack(x), dict)]
    return None if isinstance(value, dict) else value


def _failures(value: object) -> list[str]:
    value = _unpack(value)
    found = value if isinstance(value, list) else [value]
    return [x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in found if x is not None and x != ""]


def visit(result_id: int, payload: str | None) -> Iterator[tuple]:
    """Depth-first over one document, each object emitted once with its parent's key."""

    def node(number: int, tag: str, row_no: int | None, column: str, ordinal: int, key: str, parent: str, x: dict, *parts: str, **kept: object) -> tuple:
        payload = {k: v for k, v in x.items() if k not in parts}
        rest = _rest(payload, tag)
        rest.pop(elsewhere.get(tag), None)
        rest |= {k: v for k, v in kept.items() if v not in (None, "", [])}
        text = json.dumps(rest, ensure_ascii=False, separators=(",", ":")) if rest else None
        return (result_id, number, tag, row_no, column, ordinal, key, parent, json.dumps(payload, ensure_ascii=False), text)

    elsewhere = {"page": "page", "row": "_check_failures"}

    def unread(x: dict, *names: str) -> dict:
        return {k: x[k] for k in names if x.get(k) is not None and _int(x[k]) is None}

    def broken(reason: str) -> tuple:
        return (result_id, -1, "broken", -1, "", 0, f"{result_id}/broken", str(result_id), json.dumps({"reason": reason}), None)

    if payload is None or not payload.strip():
        yield broken("empty")
        return
    try:
        doc = json.loads(payload)
    except (ValueError, RecursionError):
        yield broken("not JSON")
        return
    pages = _pages(doc)
    if pages is None:
        yield broken("no pages")
        return
    for p, page in enumerate(pages):
        number = _int(page.get("page"))
        number = p if number is None else number
        page_key = f"{result_id}/{p}"
        stray = unread(page, "page") | {k: _stray(page.get(k)) for k in ("rows", "review_queue")}
        yield node(number, "page", -1, "", p, page_key, str(result_id), page, "rows", "review_queue", "_meta", **stray)
        reviews = [(None, page_key, x) for x in _items(page.get("review_queue"), "row")]
        for r, row in enumerate(_items(page.get("rows"), "_row")):
            row_no, row_key = _int(row.get("_row")), f"{page_key}/row/{r}"
            stray = unread(row, "_row") | {"review_queue": _stray(row.get("review_queue"))}
            yield node(number, "row", row_no, "", r, row_key, page_key, row, "_row", "review_queue", **stray)
            for i, text in enumerate(_failures(row.get("_check_failures"))):
                yield node(number, "check", row_no, "", i, f"{row_key}/check/{i}", row_key, {"failure": text})
            reviews += [(row_no, row_key, x) for x in _items(row.get("review_queue"), "row")]
        for r, (row_no, parent, item) in enumerate(reviews):
            own = _int(item.get("row", item.get("_row")))
            column = str(item.get("column") or "")
            yield node(number, "review", row_no if own is None else own, column, r, f"{page_key}/review/{r}", parent, item, "row", "_row", "column", **unread(item, "row", "_row"))
        if page.get("_meta") is not None:
            meta = _unpack(page["_meta"])
            meta = dict(meta) if isinstance(meta, dict) else {"value": meta}
            for k, v in (meta.pop("cells", None) or {}).items() if isinstance(meta.get("cells"), dict) else ():
                meta[f"cells_{k}"] = v
            yield node(number, "meta", -1, "", 0, f"{page_key}/meta", page_key, meta)


def emit(documents: DataFrame, key: str = "result_id", payload: str = "payload") -> DataFrame:
    """All objects of the documents as tagged rows (schema ``EMITTED``), in one pass.

    ``page_no`` is the page number inside the document (its position where it has none);
    ``row_no`` is -1 where a tag has none.  A document that is null, blank, not JSON or holds no
    pages becomes one row tagged ``broken``.  Review items inside a row take that row's number;
    those of the page keep theirs even where no such row exists.  Repeated objects come out
    as often as they stand in the document; each failed check of a row is a child of that row; an empty table gives no rows, other columns
    are ignored.  Documents without key are emitted with a null key.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in EMITTED.split(", ")]
        for pdf in batches:
            out: list[tuple] = []
            for k, text in zip(pdf["k"].tolist(), pdf["p"].tolist()):
                out += visit(None if k != k else k, text)
                if len(out) > 20_000:
                    yield _frame(out, names)
                    out = []
            yield _frame(out, names)

    return documents.select(F.col(key).cast("long").alias("k"), F.col(payload).cast("string").alias("p")).mapInPandas(run, EMITTED)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=names)
    for c in ("result_id", "page_no", "row_no", "ordinal"):
        pdf[c] = pdf[c].astype("Int64")
    return pdf


def child_table(emitted: DataFrame, tag: str) -> DataFrame:
    """One flat child table: keys plus the columns of ``CHILD_SCHEMAS[tag]``, the rest that no column shows, and the raw payload."""
    fields = [c.split() for c in CHILD_SCHEMAS[tag].split(", ")]
    return emitted.where(F.col("tag") == tag).select(
        "result_id", "page_no", "row_no", "column_key", "node_key", "parent_key",
        *[F.expr(f"try_cast(get_json_object(payload, '$.{name}') as {kind})").alias(name.replace(".", "_")) for name, kind in fields],
        "rest", "payload",
    )


def write_children(emitted: DataFrame, folder: str) -> None:
    """The emitted rows written once, partitioned by tag, for the child tables to be read from."""
    emitted.write.mode("overwrite").partitionBy("tag").parquet(folder)


def flatten_tables(documents: DataFrame, folder: str | None = None, key: str = "result_id", payload: str = "payload") -> dict[str, DataFrame]:
    """Every child table of the documents by tag, from one pass over them.

    The pass is written once, partitioned by tag, to ``folder`` or below the session's checkpoint folder; each table reads
    only its own tag's files.
    """
    folder = folder or f"{ensure_checkpoint_dir(documents.sparkSession)}/flat-{uuid.uuid4().hex}"
    write_children(emit(documents, key, payload), folder)
    written = documents.sparkSession.read.schema(f"{EMITTED}").parquet(folder)
    return {tag: child_table(written, tag) for tag in CHILD_SCHEMAS}
