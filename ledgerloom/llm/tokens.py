"""Sizes of texts in tokens of a public tokenizer, with a small projection of their vocabulary."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary file: its place is a parameter, it is no part of this package.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Dimensions to which documents are projected.
DIMENSIONS = 4

MEASURED = "key long, n_tokens int, " + ", ".join(f"x{i} float" for i in range(DIMENSIONS))
_WORDS = re.compile(r"[^\W\d_]{2,}")


def public_pattern() -> str:
    """The splitting pattern of the public vocabularies, from the package that brings them."""
    from public_tokenizers import PATTERN

    return PATTERN


def encoder(path: str, pattern: str | None = None) -> object:
    """The encoder of a rank file and a splitting pattern (``public_pattern`` without), loaded once a Python worker."""
    import sys
    import types

    import tiktoken

    # Functions come to a worker by value, so what is to outlive one task is kept in a module of its own.
    loaded = sys.modules.setdefault("_ledgerloom_encoders", types.ModuleType("_ledgerloom_encoders")).__dict__
    pattern = pattern or public_pattern()
    if (path, pattern) not in loaded:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        loaded[path, pattern] = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return loaded[path, pattern]


def project(words: list[str]) -> np.ndarray:
    """A document's hashed word vector (log counts, length 1) projected to ``DIMENSIONS`` random directions.

    Each direction is +1 or -1 for each word, by its hash, so no matrix is stored.
    """
    import xxhash

    if not words:
        return np.zeros(DIMENSIONS, np.float32)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    h = np.array([xxhash.xxh32_intdigest(w) for w in counts], dtype=np.uint32)
    weight = 1 + np.log(np.fromiter(counts.values(), dtype=np.float32))
    sign = ((h[:, None] >> np.arange(DIMENSIONS, dtype=np.uint32)) & 1).astype(np.float32) * 2 - 1
    return (weight @ sign) / np.sqrt((weight * weight).sum())


def measure(docs: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER, vectors: bool = True, keep: tuple[str, ...] = (), pattern: str | None = None) -> DataFrame:
    """``(key, n_tokens, x0..)`` of each document: whole texts are read; a null or empty text has 0 tokens.

    Columns of ``keep`` come along as text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, pattern)
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["t"]]
            out = {"key": pdf["k"], **{f"keep_{c}": pdf[f"keep_{c}"] for c in keep}, "n_tokens": [len(enc.encode_ordinary(t)) for t in texts]}
            x = np.stack([project(_WORDS.findall(t.lower())) for t in texts]) if vectors and texts else np.zeros((len(texts), DIMENSIONS), np.float32)
            yield pd.DataFrame(out | {f"x{i}": x[:, i] for i in range(DIMENSIONS)})

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), *[F.col(c).cast("string").alias(f"keep_{c}") for c in keep])
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() * 2 <= cores:
        rows = rows.repartition(cores)
    schema = MEASURED.replace("key long, ", "key long, " + "".join(f"`keep_{c}` string, " for c in keep))
    return rows.mapInPandas(run, schema).withColumnsRenamed({f"keep_{c}": c for c in keep})
