"""Column statistics from Parquet footers and dictionary pages, read on the executors."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNKS = (
    "path string, row_group int, field string, rows long, nulls long, low double, high double, low_text string, high_text string, "
    "exact boolean, distinct_values array<string>, distinct_complete boolean"
)
VALUES = "field string, value string, num double, n long"
#: A dictionary larger than this many entries isn't listed; its chunk is scanned instead.
MAX_DICTIONARY = 200_000


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        b = buf[at]
        at, value, shift = at + 1, value | (b & 0x7F) << shift, shift + 7
        if not b & 0x80:
            return value, at


def _zigzag(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def _struct(buf: bytes, at: int) -> tuple[dict, int]:
    """A Thrift compact-protocol struct as {field id: value}; the fields of nested structs likewise."""
    out, last = {}, 0
    while True:
        head = buf[at]
        at += 1
        if head == 0:
            return out, at
        kind, delta = head & 0x0F, head >> 4
        if delta:
            last += delta
        else:
            raw, at = _varint(buf, at)
            last = _zigzag(raw)
        out[last], at = _value(buf, at, kind)


def _value(buf: bytes, at: int, kind: int) -> tuple[object, int]:
    if kind in (1, 2):
        return kind == 1, at
    if kind == 3:
        return buf[at], at + 1
    if kind in (4, 5, 6):
        raw, at = _varint(buf, at)
        return _zigzag(raw), at
    if kind == 7:
        return struct.unpack_from("<d", buf, at)[0], at + 8
    if kind == 8:
        n, at = _varint(buf, at)
        return buf[at : at + n], at + n
    if kind in (9, 10):
        head = buf[at]
        n, at = head >> 4, at + 1
        if n == 15:
            n, at = _varint(buf, at)
        items = []
        for _ in range(n):
            x, at = _value(buf, at, head & 0x0F)
            items.append(x)
        return items, at
    if kind == 12:
        return _struct(buf, at)
    raise ValueError(f"Thrift kind {kind}")


def _page(file: object, offset: int) -> tuple[dict, int]:
    """The header of the page at ``offset`` and where its data starts."""
    for n in (256, 65_536, 4_194_304):
        file.seek(offset)
        buf = file.read(n)
        try:
            header, at = _struct(buf, 0)
            return header, offset + at
        except (IndexError, struct.error):
            continue
    raise ValueError("page header")


def canonical(values: object) -> list[str | None]:
    """The values of an Arrow array as texts, the same wherever they were read: equal values give equal texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = values.type
    if pa.types.is_floating(kind):
        values = pc.add(values, pa.scalar(0, kind))  # -0.0 is 0.0
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return values.to_pylist()
    if pa.types.is_nested(kind) or pa.types.is_dictionary(kind) or pa.types.is_binary(kind):
        return [None if v is None else repr(v) for v in values.to_pylist()]
    return values.cast(pa.string()).to_pylist()


def dictionary(file: object, chunk: object, kind: object) -> tuple[object, bool] | None:
    """The values of a chunk's dictionary as an Arrow array of type ``kind``, and whether every page of the chunk uses it.

    None where there is no dictionary, or its encoding or type isn't understood.  Page headers: 1 type (0 data,
    2 dictionary, 3 data v2), 2 and 3 sizes, 5/7/8 the header of the type, whose field 1 is the
    number of values; field 2 (v2: 4) is the encoding (2 and 8 are dictionary encodings).
    """
    import pyarrow as pa

    if not chunk.has_dictionary_page or chunk.dictionary_page_offset is None:
        return None
    try:
        header, start = _page(file, chunk.dictionary_page_offset)
        if header[1] != 2 or header[7][1] > MAX_DICTIONARY:
            return None
        file.seek(start)
        data = file.read(header[3])
        if chunk.compression != "UNCOMPRESSED":
            data = pa.Codec(chunk.compression.lower()).decompress(data, header[2], asbytes=True)
        n = header[7][1]
        plain = {"INT32": pa.int32(), "INT64": pa.int64(), "FLOAT": pa.float32(), "DOUBLE": pa.float64()}.get(chunk.physical_type)
        if chunk.physical_type == "BYTE_ARRAY" and pa.types.is_string(kind):
            texts, at = [], 0
            for _ in range(n):
                (k,) = struct.unpack_from("<i", data, at)
                texts.append(data[at + 4 : at + 4 + k].decode("utf-8"))
                at += 4 + k
            values = pa.array(texts, kind)
        elif plain is not None and (pa.types.is_signed_integer(kind) or pa.types.is_floating(kind) or pa.types.is_temporal(kind)):
            values = pa.Array.from_buffers(plain, n, [None, pa.py_buffer(data)]).cast(kind)
        else:
            return None
        complete, seen, offset = True, 0, start + header[3]
        while seen < chunk.num_values:
            header, at = _page(file, offset)
            inner = header.get(5) or header.get(8)
            if inner is None:
                return values, False
            complete &= inner[2 if 5 in header else 4] in (2, 8)
            seen, offset = seen + inner[1], at + header[3]
        return values, complete
    except (ValueError, KeyError, IndexError, OSError, struct.error, pa.ArrowException):
        return None


def _open(path: str) -> object:
    import pyarrow.fs as pafs

    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs.open_input_file(inner)


def read_chunks(path: str, fields: list[str], dictionaries: bool, groups: list[int] | None = None) -> Iterator[tuple]:
    """One row per row group and field of a file (schema ``CHUNKS``)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    with _open(path) as file:
        whole = pq.ParquetFile(file)
        meta, types = whole.metadata, {f.name: f.type for f in whole.schema_arrow}
        for g in range(meta.num_row_groups) if groups is None else groups:
            group = meta.row_group(g)
            chunks = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
            for f in fields:
                chunk, kind = chunks.get(f), types.get(f)
                if kind is None:
                    yield (path, g, f, group.num_rows, group.num_rows, None, None, None, None, True, [], True)
                    continue
                if chunk is None:  # a nested column has no chunk of its own
                    yield (path, g, f, group.num_rows, None, None, None, None, None, False, [], False)
                    continue
                s = chunk.statistics if chunk.is_stats_set else None
                nulls = s.null_count if s is not None and s.has_null_count else None
                all_null = nulls is not None and nulls == chunk.num_values
                try:
                    ends = pa.array([s.min, s.max], kind) if s is not None and s.has_min_max else None
                except (pa.ArrowException, TypeError, ValueError):
                    ends = None
                found = dictionary(file, chunk, kind) if dictionaries or pa.types.is_floating(kind) else None
                low, high = canonical(ends) if ends is not None else (None, None)
                number = pa.types.is_integer(kind) or pa.types.is_floating(kind)
                # A text bound may have been cut short; a fraction's leaves NaN out, which only a whole dictionary can exclude.
                sound = ends is not None and (not pa.types.is_string(kind) or len(low) < 32 and len(high) < 32)
                if pa.types.is_floating(kind):
                    sound &= found is not None and found[1] and not pc.any(pc.is_nan(found[0])).as_py()
                value = lambda i: float(ends[i].as_py()) if ends is not None and number else None
                listed = found if dictionaries else None
                yield (
                    path, g, f, chunk.num_values, nulls, value(0), value(1), low, high, nulls is not None and (all_null or sound),
                    [] if listed is None else canonical(listed[0]), all_null or (listed is not None and listed[1]),
                )


def read_values(path: str, group: int, fields: list[str]) -> Iterator[tuple]:
    """Every different value of some fields of one row group, with its number (schema ``VALUES``); a null has a null value."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    with _open(path) as file:
        columns = pq.ParquetFile(file).read_row_group(group, columns=fields)
    for f in columns.column_names:
        column = columns[f].combine_chunks()
        if pa.types.is_nested(column.type):
            counts: dict = {}
            for text in canonical(column):
                counts[text] = counts.get(text, 0) + 1
            yield from ((f, text, None, n) for text, n in counts.items())
            continue
        pairs = column.value_counts()
        values, counts_of = pairs.field("values"), pairs.field("counts").to_pylist()
        number = pa.types.is_integer(column.type) or pa.types.is_floating(column.type)
        nums = values.cast(pa.float64()).to_pylist() if number else [None] * len(values)
        yield from zip([f] * len(values), canonical(values), nums, counts_of)


def chunk_statistics(spark: SparkSession, files: list[str] | DataFrame, fields: list[str], dictionaries: bool = False) -> DataFrame:
    """The footer statistics of every column chunk of the files, one row per row group and field (schema ``CHUNKS``).

    ``files`` are paths, or a table of ``path`` and ``row_group`` that names the row groups to read.  ``exact`` says that
    nulls and extrema are valid as they stand; ``distinct_values`` lists the chunk's dictionary where
    ``dictionaries`` is set, ``distinct_complete`` that it holds all its values.  Files are spread over the cluster; only
    footers and dictionary pages are read.
    """
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, groups in zip(pdf["path"], pdf["groups"]):
                rows = list(read_chunks(path, fields, dictionaries, None if groups is None else sorted(int(g) for g in groups)))
                if rows:
                    out = pd.DataFrame(rows, columns=names)
                    out["nulls"] = out["nulls"].astype("Int64")
                    yield out

    if isinstance(files, DataFrame):
        return files.groupBy("path").agg(F.collect_set("row_group").alias("groups")).mapInPandas(run, CHUNKS)
    if not files:
        return spark.createDataFrame([], CHUNKS)
    slices = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame(pd.DataFrame({"path": files})).repartition(slices, "path")
    return listed.withColumn("groups", F.lit(None).cast("array<int>")).mapInPandas(run, CHUNKS)


def scan_values(chunks: DataFrame) -> DataFrame:
    """The counted values (schema ``VALUES``) of the column chunks named by ``path``, ``row_group`` and ``field``; only these are read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, group, fields in zip(pdf["path"], pdf["row_group"], pdf["fields"]):
                yield pd.DataFrame(list(read_values(path, int(group), list(fields))), columns=["field", "value", "num", "n"])

    return chunks.groupBy("path", "row_group").agg(F.collect_set("field").alias("fields")).mapInPandas(run, VALUES)


def scan_groups(groups: DataFrame, columns: list[str], schema: str) -> DataFrame:
    """The rows of the row groups named by ``path`` and ``row_group``, some columns only."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            for path, group in zip(batch.column("path").to_pylist(), batch.column("row_group").to_pylist()):
                with _open(path) as file:
                    read = pq.ParquetFile(file).read_row_group(group, columns=columns)
                missing = [c for c in columns if c not in read.column_names]
                for c in missing:
                    read = read.append_column(c, pa.nulls(len(read)))
                yield from read.select(columns).to_batches()

    return groups.select("path", "row_group").mapInArrow(run, schema)
