"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models on hashed word features.  Each later model also
reads the log-odds of the earlier categories.  While training, these come from models that did not see the row
(out-of-fold), so that later models learn how far earlier predictions can be trusted.

Training reads a bounded sample of labelled rows.  How many of its documents of each class hold a feature is a Spark
aggregate; each model keeps at most SELECTED features, and one task then fits the chain on rows reduced to bits of the
kept features: at most `rows` x SELECTED / 8 bytes for each model, whatever the length of the texts.  The driver gets
counts, the kept features and the weights.  Scoring runs over all rows in Arrow batches.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, StructField, StructType

from tidemark.llm.common import cut, hashed_share, map_rows

# At most so many labelled rows are used for training, half of them with the last category set.
TRAINING_ROWS = 12_000
DIMENSIONS = 1 << 18
# Features a model may use, chosen by the significance of their difference between the classes.
SELECTED = 4096
LEAST_Z = 2.5
FOLDS = 4
THRESHOLD = 0.4
# Entries of the training matrix that are expanded at once.
BLOCK = 1 << 20
# Characters of a text whose words are listed at once.
CHUNK = 1 << 20

_WORD = re.compile(r"\w+")
_PREFIXES = (4, 5)


class _Buckets(dict):
    """Word -> hashed features: the word and its beginnings, which inflected forms share."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        parts = [word, *(word[:n] + "*" for n in _PREFIXES if len(word) >= n)]
        found = tuple(xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass")) % DIMENSIONS for p in parts)
        self[word] = found
        return found


def _distinct_words(text: str) -> set[str]:
    """Distinct words of the whole text, a chunk at a time; a word over a chunk's end is cut by neither chunk."""
    found: set[str] = set()
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        while end < len(text) and _WORD.match(text, end - 1, end + 1):
            end += 1
        found.update(_WORD.findall(text, at, end))
        at = end
    return found


def features(text: str | None, buckets: _Buckets) -> np.ndarray:
    """Sorted hashed features of the whole text, each once; none for a null or empty text."""
    found: set[int] = set()
    for word in _distinct_words((text or "").lower()):
        found.update(buckets[word])
    return np.array(sorted(found), dtype=np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class Linear:
    """weights over all dimensions, weights of the earlier categories' log-odds, bias."""

    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def logit(self, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        own = np.array([self.weights[r].sum(dtype=np.float64) for r in rows])
        return own + earlier @ self.earlier + self.bias


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    links: tuple[Linear, ...]

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        """(rows, categories)"""
        logits = np.zeros((len(rows), 0))
        for link in self.links:
            logits = np.column_stack((logits, link.logit(rows, logits)))
        return _sigmoid(logits)


class Matrix:
    """Rows of set features, kept as bits and used a block of rows at a time."""

    def __init__(self, bits: np.ndarray, columns: np.ndarray) -> None:
        """`bits` is (rows, bytes); `columns` are the bit positions this matrix shows."""
        self.shape = len(bits), len(columns)
        found, lengths = [np.zeros(0, np.uint16)], []
        for at in range(0, len(bits), 256):
            shown = np.unpackbits(bits[at:at + 256], axis=1)[:, columns]
            lengths.append(shown.sum(1, dtype=np.int64))
            found.append(np.nonzero(shown)[1].astype(np.uint16))
        self.column = np.concatenate(found)
        self.end = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))) if lengths else np.zeros(1, np.int64)
        self.cuts = [0]
        while self.cuts[-1] < len(bits):
            most = np.searchsorted(self.end, self.end[self.cuts[-1]] + BLOCK, side="right") - 1
            self.cuts.append(int(max(self.cuts[-1] + 1, most)))

    def times(self, theta: np.ndarray) -> np.ndarray:
        total = np.zeros(self.shape[0])
        for first, last in zip(self.cuts, self.cuts[1:]):
            filled = first + np.flatnonzero(np.diff(self.end[first:last + 1]))
            if len(filled):
                known = theta[self.column[self.end[first]:self.end[last]]]
                total[filled] = np.add.reduceat(known, self.end[filled] - self.end[first])
        return total

    def transposed_times(self, error: np.ndarray) -> np.ndarray:
        total = np.zeros(self.shape[1])
        for first, last in zip(self.cuts, self.cuts[1:]):
            told = np.repeat(error[first:last], np.diff(self.end[first:last + 1]))
            total += np.bincount(self.column[self.end[first]:self.end[last]], told, self.shape[1])
        return total


def fit_linear(x: Matrix, earlier: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 250) -> np.ndarray:
    """Weighted logistic regression with L2: weights of the columns, of the earlier log-odds, and the bias."""
    width, share = x.shape[1], weight / weight.sum()
    rate = np.clip((share * target).sum(), 1e-4, 1 - 1e-4)
    theta = np.zeros(width + earlier.shape[1] + 1)
    theta[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):  # Adam on the whole sample
        error = share * (_sigmoid(x.times(theta[:width]) + earlier @ theta[width:-1] + theta[-1]) - target)
        slope = np.concatenate((x.transposed_times(error), earlier.T @ error, [error.sum()]))
        slope[:-1] += 1e-5 * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        theta -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return theta


def fit_chain(bits: np.ndarray, targets: np.ndarray, weight: np.ndarray, fold: np.ndarray,
              columns: dict[tuple[int, int], np.ndarray], folds: int = FOLDS) -> list[np.ndarray]:
    """The weights of each category's model, in the order of the chain.

    `bits` holds the sample's features, `columns` the positions that the model of (category, left-out fold) reads; fold
    -1 leaves none out.  `targets` is (rows, categories), 0 or 1.
    """
    none = np.zeros(0, dtype=np.int64)
    earlier, models = np.zeros((len(bits), 0)), []
    for k in range(targets.shape[1]):
        models.append(fit_linear(Matrix(bits, columns.get((k, -1), none)), earlier, targets[:, k], weight))
        if k + 1 == targets.shape[1]:
            break
        unseen = np.zeros(len(bits))
        for f in range(folds):
            inside, outside, used = fold != f, fold == f, columns.get((k, f), none)
            if inside.any() and outside.any():
                theta = fit_linear(Matrix(bits[inside], used), earlier[inside], targets[inside, k], weight[inside])
                unseen[outside] = Matrix(bits[outside], used).times(theta[:len(used)]) + (
                    earlier[outside] @ theta[len(used):-1] + theta[-1])
        earlier = np.column_stack((earlier, unseen))
    return models


def _selected(marked: DataFrame, categories: list[str], folds: int) -> dict[tuple[int, int], list[int]]:
    """(category, left-out fold) -> the features that differ most significantly between the classes, SELECTED at most.

    A fold's model is chosen for without the fold's own rows.
    """
    count, last = len(categories), len(categories) - 1
    cells = count * folds * 2

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(b, dtype=np.int32) for b in batch.column(0).to_pylist()]
        flat = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int64)
        row = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
        fold = np.asarray(batch.column(1))[row].astype(np.int64)
        codes = [flat * cells + (k * folds + fold) * 2 + np.asarray(batch.column(2 + k))[row] for k in range(count)]
        code, n = np.unique(np.concatenate(codes), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code // cells), pa.array((code % cells).astype(np.int32)), pa.array(n)],
                                          names=["feature", "cell", "n"])

    counts = map_rows(marked.select("ids", "fold", *categories), counted, "feature long, cell int, n long").groupBy("feature").agg(
        *[F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(cells)])
    rows = {(r["fold"], *[r[c] for c in categories]): r["count"] for r in marked.groupBy("fold", *categories).count().collect()}
    models = [(k, f) for k in range(count) for f in ([-1] if k == last else [-1, *range(folds)])]

    def z(k: int, left_out: int):
        def documents(v):
            return max(1, sum(n for key, n in rows.items() if key[0] != left_out and key[1 + k] == v))

        def having(v):
            return sum((F.col(f"c{(k * folds + f) * 2 + v}") for f in range(folds) if f != left_out), F.lit(0))

        n1, n0, w1, w0 = documents(1), documents(0), having(1), having(0)
        pooled = (w1 + w0 + 1) / (n1 + n0 + 2)
        return F.abs((w1 + pooled) / (n1 + 1) - (w0 + pooled) / (n0 + 1)) / F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))

    scored = counts.select("feature", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(f).alias("f"), z(k, f).alias("z")) for k, f in models])).alias("m"))
    best = Window.partitionBy("m.k", "m.f").orderBy(F.desc("m.z"), "feature")  # at most DIMENSIONS rows each
    kept = scored.where(F.col("m.z") >= LEAST_Z).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= SELECTED)
    found: dict[tuple[int, int], list[int]] = {}
    for r in kept.select("m.k", "m.f", "feature").orderBy("feature").collect():
        found.setdefault((r["k"], r["f"]), []).append(r["feature"])
    return found


def train(docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id", rows: int = TRAINING_ROWS,
          folds: int = FOLDS) -> Chain | None:
    """Fit on at most `rows` labelled documents, taken by a hash of the key.

    `labels` has the key and a 0/1 column for each category; a null there counts as 0, of repeated labels the largest
    counts, of documents with one key one is used.  None without labels.
    """
    names = [f"y{i}" for i in range(len(categories))]
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        *[F.coalesce(F.max(F.when(F.col(c) > 0, 1).otherwise(0)), F.lit(0)).alias(n) for c, n in zip(categories, names)]
    )
    # one row of two numbers
    total = {r[names[-1]]: r["count"] for r in known.groupBy(names[-1]).count().collect()}
    order = F.xxhash64("key"), F.col("key")
    half = max(1, rows // 2)
    with_1, with_0 = (
        known.where((F.col(names[-1]) == v) & hashed_share(half, total.get(v, 0), "key")).orderBy(*order).limit(half) for v in (1, 0)
    )
    sample = cut(with_1.union(with_0))

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        buckets = _Buckets()
        found = [features(t, buckets).tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["key", "ids"])

    # at most `rows` narrow rows, so the broadcast is bounded
    texts = docs.select(F.col(key).alias("key"), "text").join(F.broadcast(sample.select("key")), "key")
    schema = StructType([texts.schema["key"], StructField("ids", BinaryType())])
    marked = cut(map_rows(texts, hashed, schema).groupBy("key").agg(F.min("ids").alias("ids")).join(
        F.broadcast(sample), "key"
    ).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(folds)).cast("int")))
    chosen = _selected(marked, names, folds)
    union = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.array(v, np.int64) for v in chosen.values()]]))
    columns = {m: np.searchsorted(union, v) for m, v in chosen.items()}

    def reduced(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = np.zeros((batch.num_rows, len(union) or 1), dtype=np.uint8)
        for i, ids in enumerate(batch.column(0).to_pylist()):
            bits[i, np.flatnonzero(np.isin(union, np.frombuffer(ids, dtype=np.int32), assume_unique=True))] = 1
        packed = np.packbits(bits, axis=1)
        return pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in packed], pa.binary()), *batch.columns[1:]],
                                          names=["bits", *batch.schema.names[1:]])

    def fitted(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).sort_by("place")
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), dtype=np.uint8).reshape(table.num_rows, -1)
        targets = np.column_stack([table[n].to_numpy() for n in names]).astype(np.float64)
        used = {v: max(1, int((targets[:, -1] == v).sum())) for v in (0, 1)}
        weight = np.maximum([total.get(int(v), 0) / used[int(v)] for v in targets[:, -1]], 1e-9)
        models = fit_chain(bits, targets, weight, table["fold"].to_numpy(), columns, folds)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(models)), pa.int32()), pa.array([list(m) for m in models], pa.list_(pa.float64()))],
                                         names=["category", "theta"])

    bounded = map_rows(marked.select("ids", "fold", *names, F.xxhash64("key").alias("place")), reduced,
                       StructType.fromDDL(f"bits binary, fold int, {', '.join(f'{n} int' for n in names)}, place long"))
    found = {r["category"]: np.array(r["theta"]) for r in bounded.repartition(1).mapInArrow(
        fitted, "category int, theta array<double>").collect()}
    if not found:
        return None
    links = []
    for k in range(len(categories)):
        used = union[columns.get((k, -1), np.zeros(0, np.int64))]
        dense = np.zeros(DIMENSIONS, dtype=np.float32)
        dense[used] = found[k][:len(used)]
        links.append(Linear(dense, found[k][len(used):-1], float(found[k][-1])))
    return Chain(tuple(categories), tuple(links))


def score(docs: DataFrame, chain: Chain | None, categories: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with p_<category> for each category and `toxic`, whether the last one reaches the threshold.

    Columns of these names are replaced, all others kept.  Null and empty texts get what the models give to no words;
    without a trained chain all probabilities are 0.
    """
    names = [f"p_{c}" for c in categories]
    kept = docs.drop(*names, "toxic")
    at = kept.columns.index("text")
    count = len(categories)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        buckets = _Buckets()
        rows = [features(t, buckets) for t in batch.column(at).to_pylist()]
        found = chain.probabilities(rows) if chain else np.zeros((len(rows), count))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array(found[:, i]) for i in range(count)], pa.array(found[:, -1] >= threshold)],
            names=[*batch.schema.names, *names, "toxic"],
        )

    fields = [StructField(n, DoubleType()) for n in names]
    return map_rows(kept, add, StructType([*kept.schema.fields, *fields, StructField("toxic", BooleanType())]))


def without_toxic(docs: DataFrame, chain: Chain | None, threshold: float = THRESHOLD) -> DataFrame:
    """`docs`, whatever its columns, without the rows whose last category reaches the threshold."""
    at = docs.columns.index("text")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        if chain is None:
            return batch
        buckets = _Buckets()
        found = chain.probabilities([features(t, buckets) for t in batch.column(at).to_pylist()])
        return batch.filter(pa.array(found[:, -1] < threshold))

    return map_rows(docs, keep, docs.schema)


# The chain over the labels table: low quality first, its log-odds then help to predict toxicity.
CATEGORIES = ["low_quality", "toxic"]


def label_categories(labels: DataFrame) -> DataFrame:
    """The labels table (doc_id, quality, toxic) as categories; unknown values count as not set."""
    return labels.select("doc_id", F.coalesce(1 - F.col("quality"), F.lit(0)).alias("low_quality"),
                         F.coalesce("toxic", F.lit(0)).alias("toxic"))
