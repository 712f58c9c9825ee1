"""Items packed into containers of fixed capacity along a space-filling curve."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import DIMENSIONS, TOKENIZER, measure
from ledgerloom.session import cut

#: Bits per dimension of the curve; neighbours packed at a time; containers kept open meanwhile.
BITS, WINDOW, OPEN = 8, 512, 1024

PACKED = "spec_name string, container_id string, doc_id long, piece_no int, position int, token_start int, token_end int, tokens int"


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions along the Hilbert curve of integer points (rows), after Skilling (2004)."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[:, i] & q) != 0
            swap = (x[:, 0] ^ x[:, i]) & p
            x[:, 0] = np.where(high, x[:, 0] ^ p, x[:, 0] ^ swap)
            x[:, i] = np.where(high, x[:, i], x[:, i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[:, n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


class Packer:
    """Best fit of neighbouring items into open containers of one capacity."""

    def __init__(self, spec: str, capacity: int):
        self.spec, self.capacity = spec, capacity
        self.free: list[tuple[int, str]] = []  # sorted (room left, container)
        self.filled: dict[str, int] = {}

    def place(self, doc: int, piece: int, start: int, size: int) -> tuple:
        at = bisect_left(self.free, (size, ""))
        if at < len(self.free):
            room, container = self.free.pop(at)
        else:
            room, container = self.capacity, f"{self.spec}/{doc}.{piece}"
            self.filled[container] = 0
        position = self.filled[container]
        if room > size:
            self.filled[container] = position + 1
            insort(self.free, (room - size, container))
            if len(self.free) > OPEN:
                del self.filled[self.free.pop(0)[1]]  # the fullest
        else:
            del self.filled[container]
        return (self.spec, container, doc, piece, position, start, start + size, size)


def pack(sizes: DataFrame, specs: list[tuple[str, int]]) -> DataFrame:
    """Every item assigned to containers of every spec (schema ``PACKED``).

    ``sizes`` has ``doc_id``, ``n_tokens`` and ``curve`` (the place along the curve).  An item above a capacity is
    split into full containers and a rest that is packed like an item; no other item is split.  An item of
    size 0 goes where there is room.  Items are range-partitioned and sorted along the curve (ties by id, so
    equal items may fall into several partitions); each partition packs windows of neighbours, the
    largest first, into the open container with the least room that suffices.  Each partition leaves its
    last containers part full.  Repeated ids are separate items of one name; give unique ids.
    """
    for name, capacity in specs:
        if capacity is None or capacity < 1:
            raise ValueError(f"capacity of {name}: {capacity}")
    capacity_of = dict(specs)
    spec = F.explode(F.array(*[F.struct(F.lit(s).alias("spec_name"), F.lit(int(c)).alias("capacity")) for s, c in specs])).alias("spec")
    items = sizes.select("doc_id", "n_tokens", "curve", spec).select("doc_id", "n_tokens", "curve", "spec.*")
    rest = F.when(F.col("n_tokens") > F.col("capacity"), F.col("n_tokens") % F.col("capacity")).otherwise(F.col("n_tokens"))
    whole = F.when(F.col("n_tokens") > F.col("capacity"), (F.col("n_tokens") / F.col("capacity")).cast("int")).otherwise(F.lit(0))
    items = items.withColumn("full", whole).withColumn("rest", rest)
    full = items.where("full > 0").select("spec_name", "capacity", "doc_id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece_no"))
    full = full.select(
        "spec_name", F.concat_ws("", "spec_name", F.lit("/"), "doc_id", F.lit("."), "piece_no").alias("container_id"), "doc_id", "piece_no", F.lit(0).alias("position"),
        (F.col("piece_no") * F.col("capacity")).alias("token_start"), ((F.col("piece_no") + 1) * F.col("capacity")).alias("token_end"), F.col("capacity").alias("tokens"),
    )
    loose = items.where("full = 0 or rest > 0").select("spec_name", "curve", "doc_id", F.col("full").alias("piece_no"), (F.col("full") * F.col("capacity")).alias("start"), F.col("rest").alias("size"))
    placed = loose.repartitionByRange("spec_name", "curve", "doc_id", "piece_no").sortWithinPartitions("spec_name", "curve", "doc_id", "piece_no")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packers: dict[str, Packer] = {}
        names = [c.split()[0] for c in PACKED.split(", ")]
        for pdf in batches:
            for spec_name, group in pdf.groupby("spec_name", sort=False):
                packer = packers.setdefault(spec_name, Packer(spec_name, capacity_of[spec_name]))
                for start in range(0, len(group), WINDOW):
                    window = group.iloc[start : start + WINDOW].sort_values(["size", "doc_id"], ascending=[False, True], kind="stable")
                    rows = [packer.place(*r) for r in window[["doc_id", "piece_no", "start", "size"]].itertuples(index=False, name=None)]
                    yield pd.DataFrame(rows, columns=names)

    return placed.mapInPandas(run, PACKED).unionByName(full)


def curve_places(measured: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, curve)``: projections scaled by their spread over all documents, as places along the curve."""
    dims = range(DIMENSIONS)
    row = measured.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in dims], *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in dims]).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in dims])
    spread = np.array([row[f"s{i}"] or 1.0 for i in dims])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            z = (pdf[[f"x{i}" for i in dims]].to_numpy(dtype=float) - mean) / spread
            cells = np.clip((z + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield pd.DataFrame({"doc_id": pdf["key"], "n_tokens": pdf["n_tokens"], "curve": hilbert_keys(cells)})

    return measured.mapInPandas(run, "doc_id long, n_tokens int, curve long")


def pack_documents(docs: DataFrame, key: str, text: str, specs: list[tuple[str, int]], tokenizer: str = TOKENIZER) -> DataFrame:
    """Documents packed into containers of each spec, sized in tokens, neighbours by vocabulary together."""
    return pack(curve_places(cut(measure(docs, key, text, tokenizer))), specs)


def fill_report(packed: DataFrame, specs: list[tuple[str, int]]) -> DataFrame:
    """Per spec: containers, tokens, share of the room that is used, and documents that were split."""
    room = F.coalesce(*[F.when(F.col("spec_name") == s, F.lit(int(c))) for s, c in specs])
    per = packed.groupBy("spec_name", "container_id").agg(F.sum("tokens").alias("tokens"))
    split = packed.where("piece_no > 0").select("spec_name", "doc_id").distinct().groupBy("spec_name").agg(F.count("*").alias("split_documents"))
    out = per.groupBy("spec_name").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    return out.join(F.broadcast(split), "spec_name", "left").select("spec_name", "containers", "tokens", "fullest", (F.col("tokens") / (F.col("containers") * room)).alias("used_share"), F.coalesce("split_documents", F.lit(0)).alias("split_documents"))
