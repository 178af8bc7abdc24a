"""Operator 10: document fingerprints of improbable features in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy; how rare its entropy is among all windows of the corpus ranks it. A
window that is the rarest of ``SELECT`` neighbours often enough is a feature. Features go into Bloom filters of 2,048
bits, ``CAPACITY`` to a filter, one filter after another. Two fingerprints are compared by the bits that their filters
share, less what chance would make them share.

The edited text of a document needs the beginning of the next one. Rows are dealt by ranges of doc_id; the first row of
each range also goes to the range before it, so each task sees its rows in order with the neighbour of the last one.

Null text counts as empty and has an empty fingerprint; two empty fingerprints are alike (1), an empty and another are
not (0). A text without a feature of its own (shorter than a window, or all of low entropy) has one feature, the whole.
Rows of one doc_id follow each other in the order of a hash of their text; a null doc_id comes first. A single document
is its own next one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import per_batch

WINDOW, SELECT, OFTEN = 32, 64, 16
FILTER_BITS, HASHES, CAPACITY = 2048, 5, 160
LEVELS = 256  # entropies are told apart in this many levels
LEAST_BITS = 1.5  # windows of less entropy are no features
CHANCE = 0.3  # share of the room above chance that counts as no likeness
RANGE_BYTES = 8 << 20
MOST_RANGES = 20_000

_SCALE = 1 << 20
_PARTS = np.array([round(_SCALE * c * np.log2(c)) if c else 0 for c in range(WINDOW + 2)], np.int64)
_GAIN = _PARTS[1:] - _PARTS[:-1]  # by the count before a byte is added
_WEIGHTS = np.random.default_rng(10).integers(0, 1 << 63, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)
_NEVER = 1 << 20


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Level of every window, from the counts of a sliding window.

    What a byte adds depends on how often it stands in the bytes before it, what a leaving byte takes on how often it
    stands in the bytes after it. Sums are integers, so equal windows have equal levels wherever they stand.
    """
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, WINDOW):
        same = (data[k:] == data[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    change = _GAIN[before]
    change[WINDOW:] -= _GAIN[after[:-WINDOW]]
    total = np.cumsum(change)[WINDOW - 1 :]
    entropy = np.log2(WINDOW) - total / (_SCALE * WINDOW)
    return np.clip(entropy * (LEVELS / np.log2(WINDOW)), 0, LEVELS - 1).astype(np.int64)


def level_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each level."""
    schema = pa.schema([("level", pa.int32()), ("n", pa.int64())])

    def rows(texts: Iterable) -> Iterator[tuple]:
        counts = np.zeros(LEVELS, np.int64)
        for text in texts:
            counts += np.bincount(entropy_levels(as_bytes(text)), minlength=LEVELS)
        yield from enumerate(counts.tolist())

    counted = per_batch(docs.select("text"), schema, "level int, n long", rows)
    out = np.zeros(LEVELS, np.int64)
    for level, n in counted.groupBy("level").agg(F.sum("n")).collect():
        out[level] = n
    return out


def rarity_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, rarest first; levels of too little entropy are never features."""
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.lexsort((np.arange(LEVELS), counts))] = np.arange(LEVELS)
    ranks[np.arange(LEVELS) < LEAST_BITS * LEVELS / np.log2(WINDOW)] = _NEVER
    return ranks


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def feature_places(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    rank = ranks[entropy_levels(data)]
    n = len(rank)
    if not n:
        return np.empty(0, np.int64)
    least = rank << 40 | np.arange(n)
    shift, reach = 1, min(SELECT, n)
    span = 1
    while span < reach:  # minimum over ``reach`` neighbours by doubling
        shift = min(span, reach - span)
        least = np.minimum(least[:-shift], least[shift:])
        span += shift
    places = least & ((1 << 40) - 1)
    often = np.bincount(places, minlength=n)
    return np.flatnonzero((often >= min(OFTEN, len(places))) & (rank < _NEVER))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprint:
    """Chained Bloom filters as packed bits, with the number of features in all of them."""

    def __init__(self, text: str | None, ranks: np.ndarray) -> None:
        data = as_bytes(text)
        places = feature_places(data, ranks)
        if len(places):
            windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places]
            sums = [(windows[at : at + 4096] * _WEIGHTS).sum(1, dtype=np.uint64) for at in range(0, len(places), 4096)]
            hashes = _mix(np.concatenate(sums))
        else:
            whole = hashlib.blake2b(data.tobytes(), digest_size=8).digest() if len(data) else b""
            hashes = np.frombuffer(whole, np.uint64)
        self.features = len(hashes)
        number = np.arange(self.features) // CAPACITY
        bits = np.zeros((-(-self.features // CAPACITY), FILTER_BITS), bool)
        for i in range(HASHES):
            bits[number, (hashes >> np.uint64(11 * i)) & np.uint64(FILTER_BITS - 1)] = True
        self.filters = np.packbits(bits, axis=1)

    def __str__(self) -> str:
        return f"{self.features}:{base64.b64encode(self.filters.tobytes()).decode()}"


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1: for each filter of the smaller fingerprint its best match in the other, weighted by features."""
    if not a.features or not b.features:
        return float(a.features == b.features)
    if (a.features, a.filters.tobytes()) > (b.features, b.filters.tobytes()):
        a, b = b, a
    of_a, of_b = (np.bitwise_count(x.filters).sum(1, dtype=np.int64) for x in (a, b))
    shared = np.stack([np.bitwise_count(b.filters & one).sum(1, dtype=np.int64) for one in a.filters])
    chance = of_a[:, None] * of_b[None, :] / FILTER_BITS
    most = np.minimum(of_a[:, None], of_b[None, :])
    floor = chance + CHANCE * (most - chance)
    score = np.clip((shared - floor) / np.maximum(most - floor, 1e-9), 0, 1).max(1)
    weight = np.full(len(score), CAPACITY, float)
    weight[-1] = a.features - CAPACITY * (len(score) - 1)
    return float((score * weight).sum() / weight.sum())


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (place, tail, doc_id, text), dealt by ranges of doc_id and sorted; tail rows begin the next range."""
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    ranges = int(min(MOST_RANGES, 1 + size // RANGE_BYTES))
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10_000)).head()[0] if shares else None
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def place_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), side="right").astype(np.int32))

    dealt = docs.select("doc_id", "text", order.alias("ord")).withColumn("place", place_of("ord"))
    firsts = dict(map(tuple, dealt.groupBy("place").agg(F.min("ord")).collect()))  # one row per range
    places = sorted(firsts)
    previous = dict(zip(places, [*places[-1:], *places[:-1]]))
    first_ids = np.array([firsts[p] for p in places], np.int64)
    back = np.array([previous[p] for p in places], np.int32)

    @F.pandas_udf("int")
    def tail_of(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(first_ids, values), len(first_ids) - 1)
        return pd.Series(np.where(first_ids[at] == values, back[at], -1).astype(np.int32))

    both = F.array(
        F.struct("place", F.lit(False).alias("tail")), F.struct(tail_of("ord").alias("place"), F.lit(True).alias("tail"))
    )
    rows = dealt.select("doc_id", "text", "ord", F.inline(both)).where("place >= 0")
    # a range is about RANGE_BYTES whatever the size of the table, and there are as many partitions as ranges
    return rows.repartition(len(places) or 1, "place").sortWithinPartitions("place", "tail", "ord", F.xxhash64("text")).select(
        "place", "tail", "doc_id", "text"
    )


def fingerprint_documents(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they and the next document are."""
    ranks = rarity_ranks(level_counts(docs)) if ranks is None else ranks

    def judge(current: tuple, following: tuple) -> tuple:
        doc_id, text, own = current
        changed = edited(text, following[1])
        other = Fingerprint(changed, ranks)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        return doc_id, len(text), digest, str(own), str(other), likeness(own, other), likeness(own, following[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_place, held = None, None
        for batch in batches:
            out = []
            for place, tail, doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
                if tail and place != held_place:
                    continue  # the row that needed it has it
                text = text or ""
                row = (doc_id, text, Fingerprint(text, ranks))
                if held is not None and place == held_place:
                    out.append(judge(held, row))
                held_place, held = (None, None) if tail else (place, row)
            columns = zip(*out) if out else [[] for _ in OUT]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, OUT)], schema=OUT)

    return with_next(docs).mapInArrow(run, OUT_DDL)
