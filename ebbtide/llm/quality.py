"""Operator 2: document quality by a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after another; each visit fits a shallow tree to the gradients of that feature's
bins and adds it to the feature's lookup table. Then the pairs whose joint bins explain most of what is left get
tables of their own in the same way. A score is a sum of looked-up values: bins are found and added for a whole batch
at once.

The model is fitted on at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of doc_id; all other steps see every
row.
Held-out rows (crc32 of doc_id as text, mod 5 = 0) are never learned from, and only the text is an input of a score.

Null text counts as empty; empty texts have a score. A null doc_id counts as held out. Several labels of a document
are averaged, labels without a document or a value are ignored. Without labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bound of the training sample, in labelled documents; a hash of the doc_id decides which.
TRAIN_ROWS = 40_000
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, STEP, LEAVES, LEAST_IN_LEAF, RIDGE = 120, 60, 0.15, 4, 20, 1.0

FEATURES = (
    "log_words", "word_bytes", "distinct_share", "repeat_share", "upper_share", "symbol_share", "shout_rate",
    "pipe_rate", "digit_share", "line_rate", "stop_rate", "foreign_share", "short_share",
)
_UPPER, _LOWER, _DIGIT, _SYMBOL, _SHOUT, _PIPE, _LINE, _STOP, _FOREIGN, _OTHER = range(10)


def _byte_classes() -> np.ndarray:
    classes = np.full(256, _OTHER, np.uint8)
    for chars, kind in (
        (b"*&#$%@^~<>{}[]\\=+_/", _SYMBOL), (b"!", _SHOUT), (b"|", _PIPE), (b"\n", _LINE), (b".,;:?", _STOP),
    ):
        classes[list(chars)] = kind
    classes[65:91], classes[97:123], classes[48:58], classes[128:] = _UPPER, _LOWER, _DIGIT, _FOREIGN
    return classes


_CLASSES = _byte_classes()


def text_features(text: str | None) -> tuple[float, ...]:
    data = (text or "").encode()
    words = data.split()
    n = max(len(words), 1)
    counts = np.bincount(_CLASSES[np.frombuffer(data, np.uint8)], minlength=10)
    size = max(len(data), 1)
    return (
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        counts[_UPPER] / max(counts[_UPPER] + counts[_LOWER], 1),
        counts[_SYMBOL] / size,
        counts[_SHOUT] / n,
        counts[_PIPE] / n,
        counts[_DIGIT] / size,
        counts[_LINE] / n,
        counts[_STOP] / n,
        counts[_FOREIGN] / size,
        sum(len(word) <= 3 for word in words) / n,
    )


def feature_rows(texts: list) -> np.ndarray:
    return np.array([text_features(text) for text in texts], np.float64).reshape(len(texts), len(FEATURES))


class QualityModel(NamedTuple):
    """Bin edges and lookup tables; the score of a text is sigmoid(base + tables + pair tables)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, rows: np.ndarray) -> np.ndarray:
        bins = to_bins(rows, self.edges)
        total = np.full(len(rows), self.base)
        for feature, values in enumerate(self.tables):
            total += values[bins[:, feature]]
        wide = coarse(bins, self.edges)
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[wide[:, a], wide[:, b]]
        return 1 / (1 + np.exp(-total))


def to_bins(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    columns = [np.searchsorted(edge, rows[:, i], side="right") for i, edge in enumerate(edges)]
    return np.stack(columns, axis=1) if columns else np.zeros((len(rows), 0), int)


def coarse(bins: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bins of pair tables: neighbouring bins as one, by how many a feature has; few bins stay as they are."""
    return bins * PAIR_BINS // np.array([max(len(edge) + 1, PAIR_BINS) for edge in edges], int)


def shallow_tree(gradient: np.ndarray, curvature: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Value of each bin: the best leaf is split at its best cut until there are ``LEAVES``."""
    g, h, n = (np.concatenate([[0.0], np.cumsum(x)]) for x in (gradient, curvature, rows))

    def gain(left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray:
        return (g[right] - g[left]) ** 2 / (h[right] - h[left] + RIDGE)

    leaves = [(0, len(gradient))]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for leaf in leaves:
            cuts = np.arange(leaf[0] + 1, leaf[1])
            cuts = cuts[(n[cuts] - n[leaf[0]] >= LEAST_IN_LEAF) & (n[leaf[1]] - n[cuts] >= LEAST_IN_LEAF)]
            if len(cuts):
                gains = gain(leaf[0], cuts) + gain(cuts, leaf[1]) - gain(*leaf)
                if gains.max() > best[0]:
                    best = (gains.max(), leaf, int(cuts[gains.argmax()]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gradient))
    for left, right in leaves:
        out[left:right] = (g[right] - g[left]) / (h[right] - h[left] + RIDGE)
    return out


def quadrant_tree(gradient: np.ndarray, curvature: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree with one cut per axis."""
    g, h = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (gradient, curvature))
    size = gradient.shape[0]
    cuts = np.arange(1, size)

    def four(x: np.ndarray) -> list[np.ndarray]:
        corner, top, left = x[np.ix_(cuts, cuts)], x[cuts, -1][:, None], x[-1, cuts][None, :]
        return [corner, top - corner, left - corner, x[-1, -1] - top - left + corner]

    gains = sum(a**2 / (b + RIDGE) for a, b in zip(four(g), four(h)))
    row, column = np.unravel_index(gains.argmax(), gains.shape)
    values = [a[row, column] / (b[row, column] + RIDGE) for a, b in zip(four(g), four(h))]
    cells = np.empty_like(gradient)
    row, column = row + 1, column + 1
    cells[:row, :column], cells[:row, column:], cells[row:, :column], cells[row:, column:] = values
    return float(gains.max()), cells


def fit(rows: np.ndarray, target: np.ndarray) -> QualityModel:
    """Boost the lookup tables on rows of features and targets between 0 and 1."""
    if not len(rows):
        return QualityModel(0.0, [np.array([])] * len(FEATURES), [np.zeros(BINS)] * len(FEATURES), [], [])
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    bins = to_bins(rows, edges)
    rate = np.clip(target.mean(), 0.001, 0.999)
    base = float(np.log(rate / (1 - rate)))
    total = np.full(len(rows), base)
    tables = [np.zeros(BINS) for _ in edges]
    sizes = [np.bincount(column, minlength=BINS).astype(float) for column in bins.T]
    for _ in range(ROUNDS):
        for i, values in enumerate(tables):
            p = 1 / (1 + np.exp(-total))
            step = STEP * shallow_tree(
                np.bincount(bins[:, i], target - p, BINS), np.bincount(bins[:, i], p * (1 - p), BINS), sizes[i]
            )
            values += step
            total += step[bins[:, i]]
    wide = coarse(bins, edges)

    def grids(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        cell = wide[:, a] * PAIR_BINS + wide[:, b]
        return tuple(np.bincount(cell, x, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for x in (target - p, p * (1 - p)))

    every = [(a, b) for a in range(len(edges)) for b in range(a)]
    pairs = sorted(every, key=lambda pair: -quadrant_tree(*grids(*pair))[0])[:PAIRS]
    pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), values in zip(pairs, pair_tables):
            step = STEP * quadrant_tree(*grids(a, b))[1]
            values += step
            total += step[wide[:, a], wide[:, b]]
    return QualityModel(base, edges, tables, pairs, pair_tables)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents that are not held out; rows with one doc_id are averaged."""
    labels = labels.select(F.col("doc_id").cast("long"), "quality")
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = min(1.0, 1.2 * rows / max(usable.count(), 1))
    place = F.xxhash64("doc_id")
    picked = usable.where(F.pmod(place, F.lit(1_000_000)) < share * 1_000_000)
    picked = picked.groupBy("doc_id").agg(F.avg("quality").alias("target")).orderBy(place, "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most ``rows`` rows of two numbers, whatever the size of the tables
    chosen = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "target")
    width = len(FEATURES)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = feature_rows(batch.column(1).to_pylist())
            columns = [batch.column(0), batch.column(2), *(pa.array(values[:, i], pa.float64()) for i in range(width))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "target", *FEATURES])

    ddl = "doc_id long, target double, " + ", ".join(f"{name} double" for name in FEATURES)
    found = chosen.mapInArrow(extract, ddl).groupBy("doc_id").agg(*[F.avg(c).alias(c) for c in ("target", *FEATURES)])
    data = np.array(found.collect(), np.float64).reshape(-1, width + 2)
    data = data[np.lexsort(data.T[::-1])]  # the same order, so the same sums, whatever the partitions
    return fit(data[:, 2:], data[:, 1])


SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(feature_rows(batch.column(1).to_pylist()))
            predicted = pa.array((score >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), predicted], schema=SCHEMA)

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows, with all their columns, that the model does not reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(model.score(feature_rows(texts)) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
