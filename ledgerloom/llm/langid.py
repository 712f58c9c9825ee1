"""Languages of documents and of their stretches: nearest clustered centroids of hashed n-gram vectors."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import written

#: Buckets of the n-gram hash, lengths of n-grams, centroids per language.
BUCKETS, LENGTHS, CLUSTERS = 1 << 15, (2, 3), 8
#: How far a cluster's centroid is drawn towards the mean of its language.
TO_MEAN = 0.5
#: Labelled documents the centroids are fitted on, for each language, about (at most twice as many).
FIT_DOCUMENTS = 300
#: A stretch nearer to no centroid than this cosine has no language; units of fewer letters count only in a text without longer ones.
REJECT, FEW_LETTERS = 0.06, 12
#: A unit counts as another language than the one before it only by at least this much more cosine.
MARGIN = 0.02
#: Units whose cosines a worker remembers.
MEMORY = 100_000

# Notations of the languages.
NOTATIONS = {
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "en": ("en", "eng", "english"),
    "es": ("es", "spa", "spanish", "espanol", "castellano"),
    "fr": ("fr", "fra", "fre", "french", "francais"),
    "hi": ("hi", "hin", "hindi"),
    "it": ("it", "ita", "italian", "italiano"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands"),
    "pt": ("pt", "por", "portuguese", "portugues"),
}
LANGUAGES = tuple(NOTATIONS)
_BY_NOTATION = {n: code for code, names in NOTATIONS.items() for n in names}
_UNIT = re.compile(r"[\r\n]+|(?<=[.!?।])\s+|(?<=[a-zà-ÿ])\s+(?=[ऀ-ॿ])|(?<=[ऀ-ॿ])\s+(?=[a-zà-ÿ])")
_DIGIT = re.compile(r"\d")
_ACCENT = re.compile("[\u0300-\u036f]")
_OTHER = re.compile(r"[^a-zऀ-ॿ]+")


def label_language(label: str | None) -> str | None:
    """The language a label names, in any notation (en, EN, en-GB, eng, English); None if it names none."""
    if label is None:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", label.strip().lower()) if not unicodedata.combining(c))
    return _BY_NOTATION.get(re.split(r"[-_ ]", plain)[0])


def label_code(label: str) -> Column:
    """The column form of ``label_language`` (null where the label names no language)."""
    base = F.element_at(F.split(F.translate(F.lower(F.trim(label)), "áàâãçéèêëíîñóôõúü", "aaaaceeeeiinooouu"), "[-_ ]"), 1)
    return F.coalesce(*[F.when(base.isin(*names), F.lit(code)) for code, names in NOTATIONS.items()])


def clean(unit: str, names: re.Pattern | None = None) -> str:
    """The letters of a unit of text: item names, numbers and lot codes left out, lower case, accents dropped."""
    text = unit.lower()
    if names is not None:
        text = names.sub(" ", text)
    if _DIGIT.search(text):
        text = " ".join([w for w in text.split() if not _DIGIT.search(w)])
    if not text.isascii():
        text = _ACCENT.sub("", unicodedata.normalize("NFKD", text))
    return _OTHER.sub(" ", text).strip()


def units(text: str, names: re.Pattern | None = None) -> list[str]:
    """The cleaned sentences and lines of a text in order, those without letters left out."""
    return [c for u in _UNIT.split(text) if u and len(c := clean(u, names)) >= 2]


#: Item names taken into one pattern.
MAX_NAMES = 20_000


def name_pattern(names: list[str]) -> re.Pattern | None:
    """A pattern for the names of a bounded list in lower case, the longest first; shared beginnings are tried once.

    More than ``MAX_NAMES`` names are an error: those left out would count as text of a language.
    """
    tree: dict = {}
    listed = sorted({n.strip().lower() for n in names if n and n.strip()})
    if len(listed) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} item names")
    for n in listed:
        node = tree
        for c in n:
            node = node.setdefault(c, {})
        node[""] = {}

    def write(node: dict) -> str:
        ways = [re.escape(c) + write(x) for c, x in sorted(node.items()) if c]
        if not ways:
            return ""
        body = ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"
        return f"(?:{body})?" if "" in node else body

    return re.compile(rf"\b{write(tree)}\b") if tree else None


def features(cleaned: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse n-gram counts of the units: (unit, bucket, count), ordered by unit."""
    if not cleaned:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    text = "\x00".join(f" {u} " for u in cleaned)
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    at = np.cumsum(code == 0)
    keys = []
    for n in LENGTHS:
        m = len(code) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, dtype=np.uint64)
        for k in range(n):
            h = (h * np.uint64(0x100000001B3) + code[k : k + m]) & np.uint64(0xFFFFFFFFFFFF)
        h = ((h ^ (h >> np.uint64(21))) * np.uint64(0x9E3779B1) >> np.uint64(12)) & np.uint64(BUCKETS - 1)
        whole = at[:m] == at[n - 1 :]
        whole &= code[:m] != 0
        keys.append(at[:m][whole] * BUCKETS + h[whole].astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // BUCKETS, key % BUCKETS, count.astype(np.float32)


@dataclass
class Model:
    """IDF of the buckets, unit centroids as columns, and the language of each centroid."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    memory: dict[str, np.ndarray] = field(default_factory=dict)

    def weighted(self, cleaned: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, bucket, weight) with vectors of length 1."""
        u, b, n = features(cleaned)
        w = (1 + np.log(n)) * self.idf[b]
        norm = np.sqrt(np.bincount(u, w * w, len(cleaned)))
        norm[norm == 0] = 1
        return u, b, (w / norm[u]).astype(np.float32)

    def cosines(self, cleaned: list[str]) -> np.ndarray:
        """Cosine of each unit with the nearest centroid of each language (columns as ``LANGUAGES``).

        Units recur, so those seen first are remembered, ``MEMORY`` of them; the others are worked out again.
        """
        new = [u for u in dict.fromkeys(cleaned) if u not in self.memory]
        rows = np.zeros((len(new), len(LANGUAGES)), np.float32)
        for start in range(0, len(new), 128):
            part = new[start : start + 128]
            u, b, w = self.weighted(part)
            near = product(u, b, w, len(part), self.centroids)
            for j, lang in enumerate(LANGUAGES):
                own = [k for k, x in enumerate(self.languages) if x == lang]
                if own:
                    rows[start : start + 128, j] = near[:, own].max(axis=1)
        fresh = dict(zip(new, rows))
        out = np.zeros((len(cleaned), len(LANGUAGES)), np.float32)
        for i, u in enumerate(cleaned):
            out[i] = fresh[u] if u in fresh else self.memory[u]
        for u in new[: max(0, MEMORY - len(self.memory))]:
            self.memory[u] = fresh[u].copy()
        return out


def product(u: np.ndarray, b: np.ndarray, w: np.ndarray, n: int, dense: np.ndarray) -> np.ndarray:
    """Rows of the sparse (u, b, w) times a dense matrix; ``u`` is sorted."""
    out = np.zeros((n, dense.shape[1]), np.float32)
    if len(u):
        starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
        out[u[starts]] = np.add.reduceat(dense.take(b, axis=0) * w[:, None], starts, axis=0)
    return out


def _means(u: np.ndarray, b: np.ndarray, w: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """Normalised mean vector of each group of units (-1: none), as columns."""
    g = group[u]
    ok = g >= 0
    flat = np.bincount(b[ok] * k + g[ok], w[ok], BUCKETS * k)
    m = flat.reshape(BUCKETS, k).astype(np.float32)
    norm = np.sqrt((m * m).sum(axis=0))
    return m / np.where(norm == 0, 1, norm)


def fit(idf: np.ndarray, texts: list[list[str]], labels: list[str]) -> Model:
    """Centroids from the units of labelled texts, some of whose labels are wrong and some of which are mixed.

    Each distinct unit starts with the label most of its documents have.  Units nearer to another
    language's mean are left out, unless many documents agree on them, and the means taken again.  What
    remains of a language is split by spherical k-means into ``CLUSTERS`` clusters; a centroid is the cluster's
    mean drawn towards the language's, so that tight clusters don't outbid wide ones.  Units are
    then checked once more, against these centroids, and the clusters made again; what they still
    miss of a language becomes further centroids of it, at most five.
    """
    seen: dict[str, list[int]] = {}
    for cleaned, lab in zip(texts, labels):
        for u in cleaned:
            if len(u) >= FEW_LETTERS:
                seen.setdefault(u, []).append(LANGUAGES.index(lab))
    cleaned = list(seen)
    model = Model(idf, np.zeros((BUCKETS, 1), np.float32), [])
    if not cleaned:
        return model
    votes = [(max(sorted(set(v)), key=v.count), len(v), max(map(v.count, set(v)))) for v in seen.values()]
    label = np.array([v[0] for v in votes], dtype=np.int64)
    agreed = np.array([n >= 6 and most >= 0.5 * n for _, n, most in votes])
    u, b, w = model.weighted(cleaned)
    often = w * np.array([v[2] for v in votes], dtype=np.float32)[u]  # a unit counts as often as it occurs

    def against(dense: np.ndarray) -> np.ndarray:
        parts = []
        for start in range(0, len(cleaned), 2048):
            lo, hi = np.searchsorted(u, (start, start + 2048))
            parts.append(product(u[lo:hi] - start, b[lo:hi], w[lo:hi], min(2048, len(cleaned) - start), dense))
        return np.concatenate(parts)

    def nearest(columns: list[np.ndarray], languages: list[int]) -> np.ndarray:
        return np.array(languages)[against(np.stack(columns, axis=1).astype(np.float32)).argmax(axis=1)]

    group = label.copy()
    for _ in range(4):
        near = against(_means(u, b, often, group, len(LANGUAGES)))
        group = np.where((near.argmax(axis=1) == label) | agreed, label, -1)
    rng = np.random.default_rng(7)
    for _ in range(2):
        means, columns, languages = _means(u, b, often, group, len(LANGUAGES)), [], []
        for j in range(len(LANGUAGES)):
            own = np.flatnonzero(group == j)
            if not len(own):
                continue
            place = np.full(len(cleaned), -1, dtype=np.int64)
            place[own] = rng.integers(0, CLUSTERS, len(own))
            for _ in range(8):
                place[own] = against(_means(u, b, often, place, CLUSTERS))[own].argmax(axis=1)
            parts = _means(u, b, often, place, CLUSTERS)
            sizes = np.bincount(place[own], minlength=CLUSTERS)
            for k in range(CLUSTERS):
                if sizes[k] >= min(5, sizes.max()):
                    c = (1 - TO_MEAN) * parts[:, k] + TO_MEAN * means[:, j]
                    columns.append(c / np.sqrt((c * c).sum()))
                    languages.append(j)
        best = nearest(columns, languages)
        group = np.where((best == label) | agreed, label, -1)
    for _ in range(5):
        # What a language's centroids still miss becomes one more centroid of it.
        missed = np.where((group >= 0) & (best != group), group, -1)
        if (missed < 0).all():
            break
        extra = _means(u, b, often, missed, len(LANGUAGES))
        for j in sorted(set(missed[missed >= 0].tolist())):
            columns.append(extra[:, j])
            languages.append(j)
        best = nearest(columns, languages)
    dense = np.stack(columns, axis=1).astype(np.float32)
    model.centroids, model.languages = dense, [LANGUAGES[j] for j in languages]
    return model


def stretches(cleaned: list[str], cosine: np.ndarray) -> list[tuple[str, float, int]]:
    """Longest runs of one language over a text's units: (language, confidence, letters).

    Units below ``REJECT``, and those of few letters beside longer ones, have no language and
    join the run around them; a unit differs from the run before it only by ``MARGIN``, more for short ones.  The confidence is the mean
    margin of the language's cosine over the next best, by letters, scaled to 0..1.
    """
    if not len(cleaned):
        return []
    first = cosine.argmax(axis=1)
    two = np.partition(cosine, -2, axis=1)[:, -2:]
    tops, seconds, table, firsts = two[:, 1].tolist(), two[:, 0].tolist(), cosine.tolist(), first.tolist()
    runs: list[list] = []
    last = -1
    least = FEW_LETTERS if any(len(t) >= FEW_LETTERS for t in cleaned) else 0
    for i, text in enumerate(cleaned):
        best, n, other = firsts[i], len(text), seconds[i]
        if tops[i] < REJECT or n < least:
            continue
        if last >= 0 and best != last and tops[i] - table[i][last] < MARGIN * (1 + 30 / n):
            best, other = last, tops[i]
        own = table[i][best]
        sure = min(1.0, max(0.0, (own - other) / max(1e-6, own)))
        if runs and runs[-1][0] == best:
            runs[-1][1] += sure * n
            runs[-1][2] += n
        else:
            runs.append([best, sure * n, n])
        last = best
    return [(LANGUAGES[b], s / n, n) for b, s, n in runs]


READ = "key long, label string, units string, bucket int, n long"


def read_units(docs: DataFrame, text: str, key: str, label: str, names: re.Pattern | None) -> DataFrame:
    """The cleaned units of every document, one to a line, and how many units have each n-gram (schema ``READ``), written once.

    Rows without ``bucket`` are documents (``units`` is null where the text is), the others add up to the counts; bucket -1
    counts all units.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "label", "units", "bucket", "n"]
        total, n = np.zeros(BUCKETS, np.int64), 0
        for pdf in batches:
            for start in range(0, len(pdf), 1024):
                part = pdf.iloc[start : start + 1024]
                read = [units(t, names) if isinstance(t, str) else None for t in part["t"]]
                yield pd.DataFrame({"key": part["k"].astype("Int64"), "label": part["lab"], "units": [None if r is None else "\n".join(r) for r in read], "bucket": None, "n": None}, columns=columns)
                # Units recur: each is taken apart once.
                counts = Counter(u for r in read if r for u in r)
                once, often = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                for at in range(0, len(once), 2048):
                    u, b, _ = features(once[at : at + 2048])
                    total += np.bincount(b, often[at + u], BUCKETS).astype(np.int64)
                n += int(often.sum())
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"key": pd.array([None] * (len(hit) + 1), "Int64"), "label": None, "units": None, "bucket": np.r_[hit, -1], "n": np.r_[total[hit], n]}, columns=columns)

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(label).cast("string").alias("lab"), F.col(text).cast("string").alias("t"))
    return written(spread(rows).mapInPandas(run, READ))


def fit_units(read: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Model:
    """IDF over the units of all documents (``read_units``), centroids from a bounded sample of labelled ones.

    The sample has about ``fit_documents`` documents a language, those of the smallest hashed keys.
    """
    sums = {r["bucket"]: r["n"] for r in read.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # at most BUCKETS + 1 rows
    df = np.zeros(BUCKETS)
    for b, n in sums.items():
        if b >= 0:
            df[b] = n
    idf = np.log((1 + sums.get(-1, 0)) / (1 + df)).astype(np.float32) + 0.01
    code = F.lower(F.trim("label"))
    known = read.where("bucket is null and units is not null").where(code.isin(*LANGUAGES)).select("units", code.alias("lang"), F.xxhash64("key").alias("h"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model(idf, np.zeros((BUCKETS, 1), np.float32), [])
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, fit_documents / n))) for lang, n in counts.items()])
    picked = known.where((F.col("h") / 2.0**64 + 0.5) < share).orderBy("lang", "h").limit(2 * fit_documents * len(counts)).collect()
    return fit(idf, [r["units"].split("\n") if r["units"] else [] for r in picked], [r["lang"] for r in picked])


def fit_model(docs: DataFrame, text: str, label: str, key: str, names: re.Pattern | None, fit_documents: int = FIT_DOCUMENTS) -> Model:
    """``fit_units`` of documents that have not been read yet."""
    return fit_units(read_units(docs, text, key, label, names), fit_documents)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where it came in fewer partitions (a single small file)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


STRETCHES = "key long, label string, seg_no int, lang string, confidence double, letters int, n_langs int"


def classify_units(read: DataFrame, model: Model) -> DataFrame:
    """Every stretch of every document in reading order (schema ``STRETCHES``).

    A document with no text, or with nothing in a language (figures, codes, item names), has one row with
    ``seg_no`` -1 and null ``lang``.  Repeated keys give repeated rows; whole texts are read.
    """
    sent = read.sparkSession.sparkContext.broadcast((model.idf, model.centroids, model.languages))  # BUCKETS x CLUSTERS x languages numbers, whatever the data

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*sent.value)
        for pdf in batches:
            out = []
            for start in range(0, len(pdf), 256):
                part = pdf.iloc[start : start + 256]
                per_doc = [t.split("\n") if t else [] for t in part["units"]]
                cosine, at = m.cosines([u for d in per_doc for u in d]), 0
                for k, lab, d in zip(part["key"].tolist(), part["label"].tolist(), per_doc):
                    found = stretches(d, cosine[at : at + len(d)])
                    at += len(d)
                    langs = len({x[0] for x in found})
                    out += [(k, lab, i, lang, sure, n, langs) for i, (lang, sure, n) in enumerate(found)] or [(k, lab, -1, None, 0.0, 0, 0)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in STRETCHES.split(", ")])

    return read.where("bucket is null").select("key", "label", "units").mapInPandas(run, STRETCHES)


def classify(docs: DataFrame, text: str, key: str, label: str, model: Model, names: re.Pattern | None) -> DataFrame:
    """``classify_units`` of documents that have not been read yet."""
    return classify_units(read_units(docs, text, key, label, names), model)
