"""Schemas that drift between files: tree edits between nested schemas, compiled to projections."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values (and shapes) kept of each field of a file (the smallest hashes) to estimate how many two fields share; up to so many it is exact.
SKETCH = 1024
#: Of these, how many are kept to recognise a field that comes back after it was removed.
DIGEST = 64
#: Distinct values of a field of one file are counted in sets of about so many.
SET_SIZE = 100_000
ADD_OR_DELETE = 1.0
#: Two fields are the same under another name if their rename costs less than this; a move costs this beside what differs.
RENAME_BELOW, MOVE = 0.6, 0.5

PROFILE = "series long, file_no int, file_id long, path string, kind string, n long, low double, high double, values array<long>, shapes array<long>, distinct long, items long"
CHANGES = "series long, file_no int, file_id long, change_kind string, old_name string, new_name string, old_kind string, new_kind string, cost double"
PATHS = "series long, file_no int, file_id long, from_path string, to_name string, to_type string"
_KEYS = ["series", "file_no", "file_id"]
_CELLS = "series long, file_no int, file_id long, path string, kind string, n int, text string, num double, item boolean"
_FIELD = ["path", "kind", "n", "low", "high", "values", "shapes", "distinct", "items"]


def json_kind(value: object) -> str:
    """The JSON type of a value: null, truth, whole, fraction, text, array or object."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "truth"
    if isinstance(value, int):
        return "whole"
    if isinstance(value, float):
        return "fraction"
    return {str: "text", list: "array", dict: "object"}[type(value)]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _walk(path: str, value: object) -> Iterator[tuple]:
    """A field and, depth first, what is inside it: (path, kind, n, text, num, item); a dot in a key is written as ``\\.``."""
    kind = json_kind(value)
    if kind == "object":
        yield path, kind, 1, None, None, False
        for k, v in value.items():
            yield from _walk(path + "." + k.replace(".", "\\."), v)
    elif kind == "array":
        yield path, kind, 1, None, None, False
        for x in value:
            yield path, kind, 0, x if isinstance(x, str) else json.dumps(x, sort_keys=True), None, True
    else:
        number = kind in ("whole", "fraction")
        yield path, kind, 1, None if kind == "null" else value if kind == "text" else json.dumps(value), float(value) if number else None, kind != "null"


def _shape(text: Column) -> Column:
    digits = F.regexp_replace(text, r"(?U)\d", "9")
    return F.regexp_replace(F.regexp_replace(digits, r"\p{L}", "a"), r"(?s)(.)\1+", "$1")


def _cells(df: DataFrame, series: str, file_no: str, file_id: str, record: str) -> DataFrame:
    """Every value of every record (schema ``_CELLS``).  Flat values are read in the JVM; only arrays, objects and records
    the JVM refuses (a key twice, say) are walked in Python."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for s, no, fid, text, refused in zip(*(pdf[c].tolist() for c in (*_KEYS, "text", "refused"))):
                try:
                    value = json.loads(text)
                except (TypeError, ValueError, RecursionError):
                    continue
                if isinstance(value, dict):
                    # The JVM has the flat values of a record it can read.
                    rows += [(s, no, fid, *x) for k, v in value.items() if refused or isinstance(v, (dict, list)) for x in _walk(_part(k), v)]
            yield pd.DataFrame(rows, columns=_names(_CELLS))

    parts = df.select(F.col(series).cast("long").alias("series"), F.col(file_no).cast("int").alias("file_no"), F.col(file_id).cast("long").alias("file_id"), F.col(record).cast("string").alias("r"))
    parts = parts.where(F.col("series").isNotNull() & F.col("file_no").isNotNull() & F.col("file_id").isNotNull() & F.col("r").isNotNull())
    # Only these can hold arrays, objects or what the JVM refuses; the others are parsed once.
    inner = F.substring("r", F.lit(2), F.length("r"))
    refused = F.try_parse_json("r").isNull()
    odd = F.contains(inner, F.lit("{")) | F.contains(inner, F.lit("[")) | refused
    single = parts.select(*_KEYS, F.explode(F.try_parse_json("r").try_cast("map<string,variant>")).alias("path", "v")).withColumn("path", F.replace("path", F.lit("."), F.lit("\\.")))
    single = single.withColumn("type", F.when(F.col("v").isNull() | F.is_variant_null("v"), F.lit("VOID")).otherwise(F.schema_of_variant("v")))
    t = F.col("type")
    kind = F.when(t == "STRING", "text").when(t == "BIGINT", "whole").when(t == "BOOLEAN", "truth").when(t == "VOID", "null").when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "fraction")
    single = single.withColumn("kind", kind).withColumn("text", F.col("v").try_cast("string"))
    number = F.when(F.col("kind").isin("whole", "fraction"), F.col("v").try_cast("double"))
    flat = single.where("kind is not null").select(*_KEYS, "path", "kind", F.lit(1).alias("n"), "text", number.alias("num"), (F.col("kind") != "null").alias("item"))
    return flat.unionByName(parts.where(odd).select(*_KEYS, F.col("r").alias("text"), refused.alias("refused")).mapInPandas(walk, _CELLS))


def field_profiles(df: DataFrame, series: str, file_no: str, file_id: str, record: str) -> DataFrame:
    """Per file and field: JSON types, number of values, range, exact number of distinct values, and sketches of values and shapes.

    Records that are null or no JSON object are passed over; of a key repeated inside one record the last counts.  Each
    partition sends one set of hashes per file and field.  Sets are split by hash so that each holds about
    ``SET_SIZE`` of them: files above 1/64 of all rows by their own size, the rest by the largest of them.
    """
    counts = df.groupBy(F.col(file_id).cast("long").alias("file_id")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = {r["file_id"]: r["n"] for r in counts.where(F.col("n") > F.lit(max(SET_SIZE, total / 64))).collect()}  # at most 64
    largest = counts.where(F.col("n") <= F.lit(max(SET_SIZE, total / 64))).agg(F.max("n")).first()[0] or 0
    sets = F.coalesce(*[F.when(F.col("file_id") == k, F.lit(n // SET_SIZE + 1)) for k, n in hot.items()], F.lit(largest // SET_SIZE + 1))
    # A fraction is the same however it is written.
    value = F.when(F.col("item"), F.when(F.col("kind") == "fraction", F.xxhash64("num")).otherwise(F.xxhash64("text")))
    cells = _cells(df, series, file_no, file_id, record).select(*_KEYS, "path", "kind", "n", "num", value.alias("h"), F.when(F.col("item") & F.col("kind").isin("text", "array"), F.xxhash64(_shape(F.col("text")))).alias("shape"))
    least = lambda c: F.slice(F.sort_array(c), 1, SKETCH)
    sums = [F.sum("n").alias("n"), F.min("num").alias("low"), F.max("num").alias("high"), F.collect_set("h").alias("values"), F.collect_set("shape").alias("shapes"), F.count("h").alias("items")]
    if not hot and largest < SET_SIZE:  # every field of every file is one set
        whole = cells.groupBy(*_KEYS, "path", "kind").agg(*sums)
        return whole.select(*_KEYS, "path", "kind", "n", "low", "high", least("values").alias("values"), least("shapes").alias("shapes"), F.size("values").cast("long").alias("distinct"), "items")
    by_set = cells.groupBy(*_KEYS, "path", "kind", F.coalesce(F.pmod(F.col("h"), sets), F.lit(0)).alias("set")).agg(*sums)
    together = lambda c: least(F.array_distinct(F.flatten(F.collect_list(least(c))))).alias(c)
    merged = by_set.groupBy(*_KEYS, "path", "kind").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), together("values"), together("shapes"), F.sum(F.size("values")).alias("distinct"), F.sum("items").alias("items")
    )
    return merged.select(*_names(PROFILE))


class Field:
    """A node of a schema tree: its kinds of non-null values, sketches and child fields."""

    __slots__ = ("children", "counted", "high", "items", "kinds", "low", "n", "name", "shapes", "upto", "values")

    def __init__(self, name: str):
        self.name, self.kinds, self.n, self.low, self.high = name, {}, 0, None, None
        self.values, self.shapes, self.children = set(), set(), {}
        self.counted, self.items, self.upto = 0, 0, None

    @property
    def kind(self) -> str:
        return max(self.kinds, key=lambda k: (self.kinds[k], k)) if self.kinds else "null"

    @property
    def distinct(self) -> int:
        """The number of distinct values: of the sketch where that holds them all."""
        return len(self.values) if self.upto is None else self.counted


def build_tree(rows: list) -> Field:
    """The schema tree of one file from its profile rows; the sketch is all values where no number of distinct ones is given."""
    root = Field("")
    for path, kind, n, low, high, values, shapes, *counts in rows:
        node = root
        for part in re.split(r"(?<!\\)\.", path):
            node = node.children.setdefault(part.replace("\\.", "."), Field(part.replace("\\.", ".")))
        if kind == "null":
            continue
        node.kinds[kind] = node.kinds.get(kind, 0) + n
        node.n += n
        if low is not None and low == low:
            node.low = low if node.low is None else min(node.low, low)
            node.high = high if node.high is None else max(node.high, high)
        node.values |= set(values)
        node.shapes |= set(shapes)
        distinct, items = counts or (len(values), n)
        node.counted, node.items = node.counted + distinct, node.items + items
        if distinct > len(values):
            node.upto = max(values) if node.upto is None else min(node.upto, max(values))
    return root


def size(node: Field) -> int:
    return 1 + sum(size(c) for c in node.children.values())


def _name_distance(a: str, b: str) -> float:
    x, y = (re.sub(r"[^a-z0-9]", "", s.lower()) for s in (a, b))
    if x == y:
        return 0.0
    grams = lambda s: {s[i : i + 2] for i in range(len(s) - 1)} or {s}
    p, q = grams(x), grams(y)
    d = 1 - 2 * len(p & q) / (len(p) + len(q))
    digits = ["".join(re.findall(r"\d", s)) for s in (a, b)]
    return d + (2.0 if all(digits) and digits[0] != digits[1] else 0.0)


def shared_values(a: Field, b: Field) -> float:
    """How many distinct values two fields have in common: exact where both sketches are whole, else the bottom-k estimate.

    Below the smaller of the two largest hashes kept, both sketches are whole: what they share there is to their
    union there as the shared values are to all.
    """
    ends = [x.upto for x in (a, b) if x.upto is not None]
    if not ends:
        return len(a.values & b.values)
    p, q = ({h for h in x.values if h <= min(ends)} for x in (a, b))
    share = len(p & q) / max(1, len(p | q))
    return min(share / (1 + share) * (a.distinct + b.distinct), a.distinct, b.distinct)


def _content_distance(a: Field, b: Field) -> float:
    if a.kind != b.kind or a.kind == "null":
        return 1.0
    if a.kind == "object":
        p, q = set(a.children), set(b.children)
        return 1 - len(p & q) / max(1, len(p | q))
    same = shared_values(a, b)
    alike = (same / max(1, min(a.distinct, b.distinct)) + same / max(1, a.distinct + b.distinct - same)) / 2
    spread = [x.distinct / max(1, x.items) for x in (a, b)]
    if a.low is not None and b.low is not None and min(spread) > 0.5:
        union = max(a.high, b.high) - min(a.low, b.low)
        overlap = min(a.high, b.high) - max(a.low, b.low)
        alike = max(alike, (overlap / union if overlap > 0 else 0.0) if union else 1.0)
    if a.kind == "text" and (a.shapes or b.shapes):
        # Where one has more shapes than a sketch holds, those below the larger sketch's end are compared.
        end = min((max(s) for s in (a.shapes, b.shapes) if len(s) >= SKETCH), default=None)
        p, q = (s if end is None else {h for h in s if h <= end} for s in (a.shapes, b.shapes))
        common = len(p & q)
        alike = max(alike, 0.9 * (common / max(1, min(len(p), len(q))) + common / max(1, len(p | q))) / 2)
    return 0.7 * (1 - alike) + 0.3 * abs(spread[0] - spread[1])


def rename_cost(a: Field, b: Field) -> float:
    """What it costs to call field ``a`` by the name of ``b``: mostly how far their contents differ."""
    return 0.7 * _content_distance(a, b) + 0.3 * _name_distance(a.name, b.name)


def assign(cost: list[list[float]], skip: float) -> dict[int, int]:
    """Cheapest one-to-one matching of rows to columns, each row or column left out at ``skip``.

    Shortest augmenting paths over a square matrix padded with skips: exact at any size.
    """
    n, m = len(cost), len(cost[0]) if cost else 0
    if not n or not m:
        return {}
    size_ = n + m
    at = lambda i, j: cost[i][j] if i < n and j < m else (skip if (i < n) != (j < m) else 0.0)
    inf = float("inf")
    u, v, match = [0.0] * (size_ + 1), [0.0] * (size_ + 1), [size_] * (size_ + 1)
    for i in range(size_):
        match[size_], j0 = i, size_
        low, prev, used = [inf] * (size_ + 1), [size_] * (size_ + 1), [False] * (size_ + 1)
        while True:
            used[j0] = True
            i0, step, j1 = match[j0], inf, -1
            for j in range(size_):
                if not used[j]:
                    c = at(i0, j) - u[i0] - v[j]
                    if c < low[j]:
                        low[j], prev[j] = c, j0
                    if low[j] < step:
                        step, j1 = low[j], j
            for j in range(size_ + 1):
                if used[j]:
                    u[match[j]] += step
                    v[j] -= step
                else:
                    low[j] -= step
            j0 = j1
            if match[j0] == size_:
                break
        while j0 != size_:
            match[j0] = match[prev[j0]]
            j0 = prev[j0]
    return {match[j]: j for j in range(m) if match[j] < n}


def _edit(a: Field, b: Field, old: str, new: str) -> tuple[float, list[tuple], list[tuple[str, Field]], list[tuple[str, Field]]]:
    """Edits of one level and below: (cost, script, subtrees removed, subtrees added)."""
    script, total, removed, added = [], 0.0, [], []

    def inside(x: Field, y: Field, p: str, q: str) -> None:
        nonlocal total
        cost, inner, r, c = _edit(x, y, p + ".", q + ".")
        total += cost
        script.extend(inner)
        removed.extend(r)
        added.extend(c)

    for k, x in a.children.items():
        if k not in b.children:
            continue
        y, p, q = b.children[k], old + _part(k), new + _part(k)
        if x.kind != y.kind and "null" not in (x.kind, y.kind):
            script.append(("retyped", p, q, x.kind, y.kind, 0.5))
            total += 0.5
            # A value wrapped in an object, or taken out of one, goes on inside it.
            for kind, whole, outer, parts in (("wrapped", x, p, y), ("unwrapped", y, q, x)):
                if parts.kind == "object" and whole.kind != "object":
                    near = [(c, n) for n, z in parts.children.items() if (c := _content_distance(whole, z)) < RENAME_BELOW]
                    if near:
                        inner = f"{outer}.{_part(min(near)[1])}"
                        script.append((kind, p, inner, x.kind, y.kind, 0.0) if kind == "wrapped" else (kind, inner, q, x.kind, y.kind, 0.0))
        elif x.kind == "object":
            inside(x, y, p, q)
    gone = [c for k, c in a.children.items() if k not in b.children]
    came = [c for k, c in b.children.items() if k not in a.children]
    costs = [[c if (c := rename_cost(x, y)) < RENAME_BELOW else 3 * ADD_OR_DELETE for y in came] for x in gone]
    pairs = {i: j for i, j in assign(costs, ADD_OR_DELETE).items() if costs[i][j] < RENAME_BELOW} if costs and came else {}
    for i, x in enumerate(gone):
        p = old + _part(x.name)
        if i in pairs:
            y = came[pairs[i]]
            q = new + _part(y.name)
            script.append(("renamed", p, q, x.kind, y.kind, costs[i][pairs[i]]))
            total += costs[i][pairs[i]]
            if x.kind == y.kind == "object":
                inside(x, y, p, q)
        else:
            removed.append((p, x))
    added += [(new + _part(y.name), y) for j, y in enumerate(came) if j not in pairs.values()]
    return total, script, removed, added


def _part(name: str) -> str:
    return name.replace(".", "\\.")


def _split(path: str) -> list[str]:
    return re.split(r"(?<!\\)\.", path)


def _nodes(path: str, node: Field) -> Iterator[tuple[str, Field]]:
    yield path, node
    for k, c in node.children.items():
        yield from _nodes(f"{path}.{_part(k)}", c)


def tree_edit(a: Field, b: Field) -> tuple[float, list[tuple]]:
    """Edit script from schema tree ``a`` to ``b``: (cost, [(kind, old path, new path, old kind, new kind, cost)]).

    A restricted tree edit distance.  Children are unordered (key order is no change).  Level by level, fields of one
    name match at the cost of their types and subtrees; the rest of a level is an exact assignment in which a rename
    (with the edits inside it) competes with deleting and adding, which cost 1 per node.  What is then still removed and
    added, at any depth, is held against each other by a second exact assignment: a pair of one name and type under
    different parents, or of like content, is a move.  Of a ``wrapped`` or ``unwrapped`` field (part of a
    retype, no edit of its own) the value goes on inside an object, or outside it.
    """
    total, script, removed, added = _edit(a, b, "", "")
    gone = [x for p, n in removed for x in _nodes(p, n)]
    came = [x for p, n in added for x in _nodes(p, n)]
    costs = [[_move_cost(p, x, q, y) for q, y in came] for p, x in gone]
    pairs = {gone[i][0]: came[j][0] for i, j in assign(costs, ADD_OR_DELETE).items() if costs[i][j] < 2 * ADD_OR_DELETE} if costs and came else {}
    for (p, x), row in zip(gone, costs):
        if p in pairs:
            j = [q for q, _ in came].index(pairs[p])
            script.append(("moved", p, pairs[p], x.kind, came[j][1].kind, row[j]))
            total += row[j]
    for p, x in removed:
        if p not in pairs:
            cost = float(sum(q not in pairs for q, _ in _nodes(p, x)))
            script.append(("removed", p, "", x.kind, "", cost))
            total += cost
    for p, x in added:
        if p not in pairs.values():
            cost = float(sum(q not in pairs.values() for q, _ in _nodes(p, x)))
            script.append(("added", "", p, "", x.kind, cost))
            total += cost
    return total, script


def _move_cost(p: str, x: Field, q: str, y: Field) -> float:
    """What a move costs; too much for fields of one parent (a rename was not cheap enough), or of no like name or content."""
    if _split(p)[:-1] == _split(q)[:-1] or x.kind != y.kind or "null" in (x.kind, y.kind):
        return 3 * ADD_OR_DELETE
    cost = rename_cost(x, y)
    return MOVE + cost if cost < RENAME_BELOW or x.name == y.name else 3 * ADD_OR_DELETE


def _tree(fields: list) -> Field:
    rows = [[f[c] for c in _FIELD] for f in fields]
    return build_tree(sorted(rows, key=lambda r: (r[0], r[1])))


def schema_changes(profiles: DataFrame) -> DataFrame:
    """Every change of each file against the preceding file of its series (schema ``CHANGES``).

    ``change_kind`` is added, removed, renamed, retyped, moved, or, beside a retype, wrapped or unwrapped.  The first
    file of a series has no changes.  Pairs of files are compared apart from one another: a task holds the profiles
    of two files, whatever the length of the series.
    """
    files = profiles.groupBy(*_KEYS).agg(F.collect_list(F.struct(*_FIELD)).alias("fields"))  # one entry a field and type
    order = F.lag("file_id").over(Window.partitionBy("series").orderBy("file_no", "file_id"))
    before = F.lag("file_no").over(Window.partitionBy("series").orderBy("file_no", "file_id"))
    pairs = profiles.select(*_KEYS).distinct().select(*_KEYS, order.alias("_id"), before.alias("_no")).where("_id is not null")
    earlier = files.select(F.col("series").alias("_series"), F.col("file_no").alias("_no"), F.col("file_id").alias("_id"), F.col("fields").alias("old"))
    both = pairs.join(files, _KEYS).join(earlier.withColumnRenamed("_series", "series"), ["series", "_no", "_id"]).select(*_KEYS, "old", "fields")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for s, no, fid, old, new in zip(pdf["series"].tolist(), pdf["file_no"].tolist(), pdf["file_id"].tolist(), pdf["old"].tolist(), pdf["fields"].tolist()):
                rows += [(s, no, fid, *change) for change in tree_edit(_tree(old), _tree(new))[1]]
            yield pd.DataFrame(rows, columns=_names(CHANGES))

    return both.mapInPandas(run, CHANGES)


def _united(kinds: set[str]) -> str:
    """The type that holds values of all these JSON types: bigint, double, boolean, string, or json where they stay as they are."""
    kinds = kinds - {"null"}
    if kinds == {"whole"}:
        return "bigint"
    if kinds and kinds <= {"whole", "fraction"}:
        return "double"
    if kinds == {"truth"}:
        return "boolean"
    return "string" if "text" in kinds or kinds and not kinds & {"array", "object"} else "json"


class _Series:
    """The identities of the fields of one series, as its files come in order."""

    def __init__(self) -> None:
        self.names: dict[str, str] = {}
        self.given: set[str] = set()
        self.retired: dict[str, list[tuple[str, Field]]] = {}
        self.last: dict[str, Field] = {}

    def _new(self, path: str, node: Field) -> str:
        """A field's name: that of a retired field of this path and like content, else a name no field has had."""
        for i, (name, was) in enumerate(self.retired.get(path, [])):
            if was.kind == node.kind and _content_distance(was, node) < RENAME_BELOW or "null" in (was.kind, node.kind):
                del self.retired[path][i]
                return name
        name, n = path, 1
        while name in self.given:
            n += 1
            name = f"{path}#{n}"
        self.given.add(name)
        return name

    def read(self, tree: Field, script: list[tuple]) -> dict[str, str]:
        """The name of each field of the next file, whose changes are given."""
        here = dict(n for k, c in tree.children.items() for n in _nodes(_part(k), c))
        source = {new: old for kind, old, new, *_ in script if kind in ("renamed", "moved", "wrapped", "unwrapped")}
        added = {new for kind, _, new, *_ in script if kind == "added"}

        def origin(path: str) -> str | None:
            if path in source or path in added:
                return source.get(path)
            parts = _split(path)
            if len(parts) == 1:
                return path
            up = origin(".".join(parts[:-1]))
            return None if up is None else f"{up}.{parts[-1]}"

        names, claimed = {}, {}
        for path in sorted(here, key=lambda p: (p not in source, p)):
            name = self.names.get(origin(path) or "")
            # An object and the value it wraps may share a name, since a record has either.
            if name is not None and all(path.startswith(q + ".") or q.startswith(path + ".") for q in claimed.get(name, ())):
                names[path] = name
                claimed.setdefault(name, []).append(path)
        kept = set(names.values())
        for path, name in self.names.items():
            if name not in kept and path in self.last:
                self.retired.setdefault(path, []).append((name, self.last[path]))
        for path in sorted(here):
            if path not in names:
                names[path] = self._new(path, here[path])
        self.names, self.last = names, here
        return names


def compile_projections(profiles: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """Per file, the projection of its fields to the names and types of the consistent table (schema ``PATHS``).

    Each field of a series has one name for good, its path when it was first seen; renames and moves, nested
    ones included, are followed from file to file.  A removed field's name is not given to another: a later field
    of that path gets it back only if its content is alike, else it is called ``path#2`` and so on.
    ``to_type`` is the type that holds all values the field ever has in the series.  A task holds the field
    lists of one series with ``DIGEST`` hashes a field, and its changes.
    """
    changes = schema_changes(profiles) if changes is None else changes
    few = lambda c: F.slice(F.sort_array(c), 1, DIGEST).alias(c)
    fields = profiles.select(*[few(c) if c in ("values", "shapes") else F.col(c) for c in _names(PROFILE)])

    def run(fields: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        series, rows, kinds = _Series(), [], {}
        scripts = {k: g[["change_kind", "old_name", "new_name"]].itertuples(index=False, name=None) for k, g in changes.groupby(["file_no", "file_id"])}
        for (no, fid), g in fields.groupby(["file_no", "file_id"], sort=True):
            tree = build_tree(sorted(zip(*(g[c] for c in _FIELD)), key=lambda r: (r[0], r[1])))
            names = series.read(tree, list(scripts.get((no, fid), ())))
            for path, kind in zip(g["path"], g["kind"]):
                kinds.setdefault(names[path], set()).update(() if kind == "object" and any(q.startswith(path + ".") for q in names) else (kind,))
            rows += [(int(g["series"].iloc[0]), int(no), int(fid), path, name) for path, name in names.items()]
        return pd.DataFrame([(*r, _united(kinds[r[4]])) for r in rows], columns=_names(PATHS))

    return fields.groupBy("series").cogroup(changes.groupBy("series")).applyInPandas(run, PATHS)


def _cast(value: object, kind: str) -> object:
    if value is None or kind == "json":
        return value
    if kind == "string":
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if kind == "double" and type(value) is int and abs(value) <= 2**53:
        return float(value)
    return value


def project_record(record: dict, plan: dict[str, tuple[str, str]], path: str = "", out: dict | None = None) -> dict:
    """A record under the names and types of its plan (path to name and type).  No value is lost: objects come apart
    into their fields, and a name already taken in the record gets a number."""
    out = {} if out is None else out
    for k, v in record.items():
        at = path + _part(k)
        if isinstance(v, dict) and v:
            project_record(v, plan, at + ".", out)
            continue
        name, kind = plan.get(at, (at, "json"))
        key, n = name, 1
        while key in out:
            n += 1
            key = f"{name}#{n}"
        out[key] = _cast(v, kind)
    return out


def unify(df: DataFrame, projections: DataFrame, file_id: str, record: str, out: str = "fields") -> DataFrame:
    """``df`` with ``record`` read through its file's projection: a flat JSON object of consistent names and types.

    Nulls stay as null values, absent fields have no entry; a record that is no JSON object gives null.  Every row
    comes out once, and every value of its record (see ``project_record``).  Other columns stay; one called like ``out``
    is replaced.
    """
    plan = F.to_json(F.array_sort(F.collect_list(F.struct("from_path", "to_name", "to_type"))))
    plans = projections.groupBy(F.col("file_id").alias("_ledgerloom_file")).agg(plan.alias("_ledgerloom_plan"))  # one entry a field
    joined = df.join(plans, F.col(file_id).cast("long") == F.col("_ledgerloom_file"), "left")

    @F.pandas_udf("string")
    def projected(records: pd.Series, plans: pd.Series) -> pd.Series:
        read: dict[str, dict] = {}
        done = []
        for text, plan in zip(records, plans):
            try:
                value = json.loads(text)
            except (TypeError, ValueError, RecursionError):
                value = None
            if not isinstance(value, dict):
                done.append(None)
                continue
            if plan is not None and plan not in read:
                read[plan] = {p["from_path"]: (p["to_name"], p["to_type"]) for p in json.loads(plan)}
            done.append(json.dumps(project_record(value, read.get(plan, {})), ensure_ascii=False, separators=(",", ":")))
        return pd.Series(done, dtype=object)

    return joined.withColumn("_ledgerloom_out", projected(F.col(record).cast("string"), "_ledgerloom_plan")).drop(record, out, "_ledgerloom_plan", "_ledgerloom_file").withColumnRenamed("_ledgerloom_out", out)
