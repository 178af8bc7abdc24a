"""Operator 9: benchmark decontamination by n-gram seeds and Smith-Waterman alignment.

Seeds of a passage are its pairs of words at distance 1 and 2, all of them, however common: commonness is never counted,
so no number of copies can take seeds away. Where a document holds enough of a passage's seeds close together, the words
there are aligned with the passage. The score is the alignment's, over the score of a perfect copy: 1 for a copy, about
1 - 1.5 f where a share f of the words was replaced.

Items of more than ``PASSAGE_WORDS`` words are cut into even parts; every two neighbouring parts are a passage, and its
score is over that of a perfect copy of one part, 1 at most. So any run of words as long as a part, wherever it begins,
lies whole in one passage, and where an excerpt stands in its item makes no difference to whether it is found.

Enough is what every alignment of the least score has. Between two neighbouring equal words, no edit leaves a pair of
the passage at its own distance, one edit (a word replaced, left out or put in) a pair at distance 1 or 2 on both sides.
An alignment of m equal words and e edits of 0.5 scores m - e / 2; each of its m - 1 steps adds 1 and takes half a point
per edit, so 1 + (steps without edit) + (steps with one edit) / 2 is at least its score. Nothing that would reach the
least score is left out before it is aligned.

Passages are taken in blocks of bounded size, one scan of the documents for each; documents are never shuffled and never
paired with items that they share no seed with.

Words are runs of letters and digits after lower-casing. Null and empty documents and items match nothing. Repeated
documents are each reported. Passages of less than ``SHORT_WORDS`` words count only when they occur whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import per_batch, staged

PASSAGE_WORDS = 200
BLOCK_PASSAGES, BLOCK_WORDS = 5_000, 1_000_000  # at most so many, on average, are held by a task: some 60 MB
SHORT_WORDS = 8
MISMATCH, GAP = 0.5, 0.5  # the count of seeds relies on these
THRESHOLD = 0.4
CACHED_WORDS = 25_000  # a worker keeps them; more save no time

_WORD_BYTES = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hashes = _WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").lower().encode().translate(_WORD_BYTES).split()
    return np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))


def pair_hashes(words: np.ndarray, distance: int) -> np.ndarray:
    """One hash per word and the word so many places after it; the distance is no part of it."""
    if len(words) <= distance:
        return np.empty(0, np.uint64)
    joint = words[: len(words) - distance] * np.uint64(0x9E3779B97F4A7C15) + words[distance:]
    return joint ^ (joint >> np.uint64(29))


class Passage(NamedTuple):
    item_id: int | None
    words: np.ndarray
    unit: int  # words of which a perfect copy scores 1: all, or those of one part of a long item

    @property
    def least_score(self) -> float:
        return THRESHOLD if self.unit >= SHORT_WORDS else 1.0

    @property
    def least_points(self) -> float:
        """What an alignment has to score, less what rounding of the score may forgive."""
        return self.least_score * self.unit - 0.001

    @property
    def reach(self) -> int:
        """The most words of a text that an alignment of the least score takes: m equal ones and 2 (m - points) edits."""
        return int(3 * len(self.words) - 2 * self.least_points)


def cut(words: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(words, unit) of the passages of an item: the whole, or every two neighbouring parts of a long one."""
    parts = -(-len(words) // PASSAGE_WORDS)
    if parts == 1:
        yield words, len(words)
    elif parts:
        pieces = np.array_split(words, parts)
        for left, right in zip(pieces, pieces[1:]):
            yield np.concatenate([left, right]), len(words) // parts


def passages(benchmark: DataFrame) -> DataFrame:
    """(item_id, part, unit, words) with the words as hashes; long items are several passages."""
    schema = pa.schema([("item_id", pa.int64()), ("part", pa.int32()), ("unit", pa.int32()), ("words", pa.binary())])

    def rows(ids: Iterable, texts: Iterable) -> Iterator[tuple]:
        for item_id, text in zip(ids, texts):
            for part, (words, unit) in enumerate(cut(word_hashes(text))):
                yield item_id, part, unit, words.tobytes()

    ddl = "item_id long, part int, unit int, words binary"
    return staged(per_batch(benchmark.select("item_id", "text"), schema, ddl, rows), "passages")


class Block:
    """Passages of one block with their seeds."""

    def __init__(self, held: list[Passage]) -> None:
        self.held = held
        self.needed = np.array([passage.least_points - 1 for passage in held])
        keys, owners, steps = [np.empty(0, np.uint64)], [np.empty(0, np.int32)], [np.empty(0, np.int8)]
        for number, passage in enumerate(held):
            for step in (1, 2) if len(passage.words) > 1 else (0,):  # a single word is its own seed
                keys.append(pair_hashes(passage.words, step))
                owners.append(np.full(len(keys[-1]), number, np.int32))
                steps.append(np.full(len(keys[-1]), step, np.int8))
        key, owner, step = map(np.concatenate, (keys, owners, steps))
        order = np.lexsort((step, owner, key))
        key, owner, step = key[order], owner[order], step[order]
        first = np.ones(len(key), bool)  # a passage has a seed once, at its least distance
        first[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        self.owner, self.step = owner[first], step[first]
        self.keys, self.begin = np.unique(key[first], return_index=True)
        self.count = np.diff(np.append(self.begin, len(self.owner)))
        self.texts_steps = (0, 1, 2) if (self.step == 0).any() else (1, 2)
        self.shift = np.uint64(64 - min(24, max(20, (16 * len(self.keys)).bit_length())))
        self.marks = np.zeros(1 << int(np.uint64(64) - self.shift), bool)
        self.marks[self.keys >> self.shift] = True

    def seeds(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, place in the text, points) of every seed in a text."""
        out = []
        for step in self.texts_steps if len(self.keys) else ():
            pairs = pair_hashes(words, step)
            at = np.flatnonzero(self.marks[pairs >> self.shift])
            found = np.minimum(np.searchsorted(self.keys, pairs[at]), len(self.keys) - 1)
            same = self.keys[found] == pairs[at]
            at, found = at[same], found[same]
            many = self.count[found]
            entry = np.repeat(self.begin[found] - np.cumsum(many) + many, many) + np.arange(many.sum())
            points = np.where((self.step[entry] <= 1) & (step <= 1), 1.0, 0.5)
            out.append((self.owner[entry], np.repeat(at, many), points))
        return tuple(map(np.concatenate, zip(*out))) if out else (np.empty(0, np.int32), np.empty(0, int), np.empty(0))

    def matches(self, words: np.ndarray) -> dict[int | None, tuple[float, int, int]]:
        """item_id -> (score, first word, last word) of the best alignment that is good enough."""
        owner, at, points = self.seeds(words)
        total = np.bincount(owner, points, len(self.held))
        enough = (total > 0) & (total >= self.needed)
        found: dict[int | None, tuple[float, int, int]] = {}
        if not enough.any():
            return found
        mine = enough[owner]
        owner, at, points = owner[mine], at[mine], points[mine]
        order = np.lexsort((-points, at, owner))
        owner, at, points = owner[order], at[order], points[order]
        best = np.ones(len(owner), bool)  # a place counts once for a passage
        best[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1])
        owner, at, points = owner[best], at[best], points[best]
        numbers, begins = np.unique(owner, return_index=True)
        for number, begin, end in zip(numbers.tolist(), begins, [*begins[1:], len(owner)]):
            passage = self.held[number]
            for left, right in windows(at[begin:end], points[begin:end], self.needed[number], passage.reach, len(words)):
                if seeds_held(passage.words, words[left:right]) < self.needed[number]:
                    continue
                score, first, last = align(passage.words, words[left:right], passage.unit, passage.least_score)
                if score >= passage.least_score and score > found.get(passage.item_id, (0.0,))[0]:
                    found[passage.item_id] = (score, left + first, left + last)
        return {item_id: (min(score, 1.0), first, last) for item_id, (score, first, last) in found.items()}


def windows(at: np.ndarray, points: np.ndarray, needed: float, reach: int, total: int) -> list[tuple[int, int]]:
    """Ranges of ``reach`` words from a seed that hold seeds of enough points; overlapping ranges are one."""
    sums = np.append(0.0, np.cumsum(points))
    starts = at[sums[np.searchsorted(at, at + reach)] - sums[:-1] >= needed]
    out: list[list[int]] = []
    for start in starts.tolist():
        right = min(total, start + reach)
        if out and start <= out[-1][1]:
            out[-1][1] = right
        else:
            out.append([start, right])
    return [(left, right) for left, right in out]


def seeds_held(item: np.ndarray, text: np.ndarray) -> float:
    """Points of the seeds of ``item`` that ``text`` holds; a seed that is repeated in the text counts once."""
    points = np.zeros(len(item))
    near, far = pair_hashes(text, 1), pair_hashes(text, 2)
    for step in (1, 2):
        mine = pair_hashes(item, step)
        held = np.maximum(np.isin(mine, near) * (1.0 if step == 1 else 0.5), np.isin(mine, far) * 0.5)
        points[: len(mine)] = np.maximum(points[: len(mine)], held)
    return float(points.sum())


def best_local(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """Smith-Waterman: best score (1 per equal word) and the place in ``text`` after its last word."""
    ramp = GAP * np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1)
    best, end = 0.0, 0
    for word in item:
        step = np.maximum(row - GAP, 0.0)
        step[1:] = np.maximum(step[1:], row[:-1] + np.where(text == word, 1.0, -MISMATCH))
        row = np.maximum.accumulate(step + ramp) - ramp  # gaps along the text
        at = int(row.argmax())
        if row[at] > best + 1e-9:
            best, end = float(row[at]), at
    return best, end


def align(item: np.ndarray, text: np.ndarray, unit: int, least: float) -> tuple[float, int, int]:
    """Score per word of ``unit``, first and last word of the best alignment; (0, 0, 0) below ``least``."""
    best, end = best_local(item, text)
    score = round(best / unit, 6)
    if score < least:
        return 0.0, 0, 0
    _, length = best_local(item[::-1], text[:end][::-1])
    return score, end - length, end - 1


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The passages of one item are in one block, so that a document and an item meet once."""
    held = passages(benchmark)
    total, size = held.agg(F.count("*"), F.coalesce(F.sum(F.length("words")), F.lit(0)) / 8).first()
    count = max(1, -(-total // BLOCK_PASSAGES), -(-int(size) // BLOCK_WORDS))
    for number in range(count):
        rows = held.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == number).collect()
        mine = sorted(
            (Passage(row.item_id, np.frombuffer(row.words, np.uint64), row.unit) for row in rows),
            key=lambda p: (p.item_id is not None, p.item_id or 0, p.words.tobytes()),
        )
        yield Block(mine)


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
)
DDL = "doc_id long, item_id long, score double, first_word long, last_word long"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and test item that it holds a copy of; clean documents have none."""
    out = None
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def rows(ids: Iterable, texts: Iterable, shared=shared) -> Iterator[tuple]:
            for doc_id, text in zip(ids, texts):
                for item_id, found in shared.value.matches(word_hashes(text)).items():
                    yield doc_id, item_id, *found

        part = per_batch(docs.select("doc_id", "text"), SCHEMA, DDL, rows)
        out = part if out is None else out.union(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that hold no copy of a test item."""
    clean = docs
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                keep = [not shared.value.matches(word_hashes(text)) for text in texts]
                yield batch.filter(pa.array(keep, pa.bool_()))

        clean = clean.mapInArrow(run, docs.schema)
    return clean
