"""Operator 4: byte-level BPE. Higher-order functions fold the ranked merges over the byte arrays of distinct words.

Python tasks split texts into words and hand Spark the distinct words that are not known yet; a native expression merges
them with a map from pairs of ids to ranks; a second Python step of the same task puts the ids in the places of
the words and, to decode, joins the binary pieces of the ids. A word is merged once per task however often it occurs, no
text is shuffled, and rows between the steps are blocks of whole documents of about ``BLOCK_CHARS`` characters.

Known are the tokens, the words of a sample of about ``SAMPLE_BYTES`` of text, at most ``KNOWN_WORDS``, which the same
expression has merged before, and the words that the task has met. They only save work: what they lack is merged where
it occurs, with equal results. A task forgets what it has met beyond ``TASK_WORDS`` words.

Words of more than ``LONG_WORD`` bytes, on which a fold of array copies takes quadratic time, are merged with a heap
instead; the result is the same. Null and empty texts have no ids. Repeated rows are encoded each time.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.common import staged

BLOCK_CHARS = 2_000_000
SAMPLE_BYTES = 64_000_000
KNOWN_WORDS = 400_000  # 40 bytes each in a task
TASK_WORDS = 500_000  # some 150 bytes each in a task
LONG_WORD = 256
#: A piece of a word in one long: rank of the pair that it begins, its first byte, its id.
_ID_BITS, _RANK_SHIFT = 20, 40
_ID_MASK, _START_AND_ID = (1 << _ID_BITS) - 1, (1 << _RANK_SHIFT) - 1
_START_MASK = _START_AND_ID - _ID_MASK
_NO_RANK = _GUARD_ID = _ID_MASK
_TRIED = 4096  # shifts of a table row that are tried at once

#: Texts of these characters only are split by the standard library, whose classes agree with the pattern's on them.
_PLAIN = re.compile(r"[\x00-\x1b\x20-\x7e\xc0-ʯ]*")
_PLAIN_WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@cache
def _word_pattern(pattern: str) -> regex.Pattern:
    """The pattern with white space by its Unicode property, which is what the merges were made for."""
    spelled = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(spelled)


def split_words(text: str, pattern: str) -> list[str]:
    if pattern == WORD_PATTERN and _PLAIN.fullmatch(text):
        return _PLAIN_WORD.findall(text)
    return _word_pattern(pattern).findall(text)


# Fixed value: the public pattern that goes with the ranks.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary(NamedTuple):
    """Token bytes by id; ids are the ranks of the merges."""

    tokens: list[bytes]
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str = WORD_PATTERN) -> Vocabulary:
        with open(path, "rb") as file:
            ranks = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, file)]
        tokens = [b""] * (max(rank for rank, _ in ranks) + 1)
        for rank, token in ranks:
            tokens[rank] = token
        return cls(tokens, pattern)

    def pairs(self) -> dict[tuple[int, int], int]:
        """Every pair of tokens whose bytes together are a token, with that token's rank."""
        rank = {token: i for i, token in enumerate(self.tokens) if token}
        return {
            (rank[token[:cut]], rank[token[cut:]]): i
            for token, i in rank.items()
            for cut in range(1, len(token))
            if token[:cut] in rank and token[cut:] in rank
        }


def _literal(numbers: list[int], kind: str) -> Column:
    """An array literal: the optimizer folds the split of one string."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


class Ranks(NamedTuple):
    """The two arrays of a rank map inside an expression."""

    shifts: Column
    table: Column

    def of(self, left: Column, right: Column) -> Column:
        """The rank of a pair, or ``_NO_RANK``."""
        entry = F.get(self.table, (F.get(self.shifts, left) + right).cast("int"))
        # the rank if the entry names this left id; with any other one, or none, a number of more bits
        beyond = (entry - left * F.lit(1 << _ID_BITS)).bitwiseAND(F.lit((1 << 63) - 1))
        return F.least(beyond, F.lit(_NO_RANK))


class RankMap:
    """Map from a pair of ids to its rank, as one table that all left ids share.

    The row of a left id is shifted to where its entries fall on free places; an entry names its left id, so a lookup is
    one addition, one access and one comparison. The table is a scalar of the plan: a literal of that length would be in
    every copy of the plan and in its texts, which the driver keeps.
    """

    def __init__(self, spark: SparkSession, pairs: dict[tuple[int, int], int]) -> None:
        rows: dict[int, list[tuple[int, int]]] = {}
        for (left, right), rank in pairs.items():
            rows.setdefault(left, []).append((right, rank))
        table = np.full(1 << 21, -1, np.int64)
        free = np.ones(len(table), bool)
        shifts = np.zeros(max(rows, default=0) + 1, np.int64)
        first_free = 0
        for left, entries in sorted(rows.items(), key=lambda row: -len(row[1])):
            rights = np.array([right for right, _ in entries])
            first_free += int(free[first_free:].argmax())
            shift, fits = first_free - int(rights.min()) - _TRIED, np.zeros(1, bool)
            while not fits.any():  # where every entry finds a free place, for many shifts at once
                shift += _TRIED
                fits = np.ones(_TRIED, bool)
                for right in rights.tolist():
                    fits &= free[shift + right : shift + right + _TRIED]
            shift += int(fits.argmax())
            shifts[left] = shift
            table[rights + shift] = [left << _ID_BITS | rank for _, rank in entries]
            free[rights + shift] = False
        used = int(np.flatnonzero(table >= 0).max(initial=-1)) + 1
        arrays = pa.array([shifts], pa.list_(pa.int32())), pa.array([table[:used]], pa.list_(pa.int64()))
        row = spark.createDataFrame(pa.table(arrays, ["shifts", "table"]))
        self.maps = row.select(F.struct("shifts", "table")).scalar()

    def lookup(self, rows: DataFrame, name: str, body: Callable[[Ranks], Column]) -> DataFrame:
        """The rows with a column of what ``body`` makes of the map's arrays, which are fetched once a row.

        A scalar may not be written inside a higher-order function, so it is a column first, which the planner puts
        where it is used: no row holds it.
        """
        value = _let(
            F.col("rank_maps"),
            lambda maps: _let(
                maps["shifts"], lambda shifts: _let(maps["table"], lambda table: body(Ranks(shifts, table)))
            ),
        )
        return rows.withColumn("rank_maps", self.maps).select(*rows.columns, value.alias(name))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def merge_expression(word: Column, byte_ids: Column, ranks: Ranks) -> Column:
    """Ids of a word given as an array of byte values: a fold with one step per possible merge.

    A piece is one long: the rank of its pair with the next piece, the byte at which it starts, its id. The least of
    them is the next merge, leftmost first. Guards that pair with nothing stand at both ends.
    """
    everything = F.lit(1 << 20)
    rank_unit, start_unit = F.lit(1 << _RANK_SHIFT), F.lit(1 << _ID_BITS)
    guard = F.lit(_NO_RANK << _RANK_SHIFT | _GUARD_ID)

    def id_of(piece: Column) -> Column:
        return piece.bitwiseAND(F.lit(_ID_MASK))

    def step(pieces: Column, _: Column) -> Column:
        def merged(place: Column) -> Column:
            best, before, after = (F.element_at(pieces, place + shift) for shift in (0, -1, 2))
            joint = F.shiftright(best, _RANK_SHIFT)
            changed = F.array(
                ranks.of(id_of(before), joint) * rank_unit + before.bitwiseAND(F.lit(_START_AND_ID)),
                ranks.of(joint, id_of(after)) * rank_unit + best.bitwiseAND(F.lit(_START_MASK)) + joint,
            )
            return F.when(
                joint < _NO_RANK,
                F.concat(F.slice(pieces, F.lit(1), place - 2), changed, F.slice(pieces, place + 2, everything)),
            ).otherwise(pieces)

        # where only guards and pieces without a pair are left, the least is the first guard: its place is replaced by 2
        return _let(F.greatest(F.array_position(pieces, F.array_min(pieces)).cast("int"), F.lit(2)), merged)

    def fold(ids: Column) -> Column:
        first = F.transform(
            ids,
            lambda id_, i: ranks.of(id_, F.coalesce(F.get(ids, i + 1), F.lit(_GUARD_ID))) * rank_unit
            + (i + 1) * start_unit
            + id_,
        )
        start = F.concat(F.array(guard), first, F.array(guard, guard))
        return F.aggregate(
            F.slice(ids, 2, everything),
            start,
            step,
            lambda pieces: F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 3), lambda p: id_of(p).cast("int")),
        )

    return _let(F.transform(word, lambda byte: F.get(byte_ids, byte).cast("long")), fold)


def heap_merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of a long word: repeatedly the lowest rank, leftmost first, with a heap over linked pieces."""
    end = [i + 1 for i in range(len(word))]
    before = [i - 1 for i in range(len(word))]
    pending = [(rank[word[i : i + 2]], i, i + 2) for i in range(len(word) - 1) if word[i : i + 2] in rank]
    heapq.heapify(pending)
    while pending:
        _, start, stop = heapq.heappop(pending)
        middle = end[start]
        if middle == 0 or middle >= stop or end[middle] != stop:
            continue  # one of the two pieces has changed since
        end[start], end[middle] = stop, 0
        if stop < len(word):
            before[stop] = start
            if (joint := rank.get(word[start : end[stop]])) is not None:
                heapq.heappush(pending, (joint, start, end[stop]))
        if before[start] >= 0 and (joint := rank.get(word[before[start] : stop])) is not None:
            heapq.heappush(pending, (joint, before[start], stop))
    out, at = [], 0
    while at < len(word):
        out.append(rank[word[at : end[at]]])
        at = end[at]
    return out


class Ragged(NamedTuple):
    """Variable-length rows as one array and offsets."""

    values: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of_bytes(cls, rows: list[bytes]) -> Ragged:
        offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows], dtype=np.int64)])
        return cls(np.frombuffer(b"".join(rows), np.uint8), offsets)

    @classmethod
    def of_lists(cls, lists: pa.ListArray) -> Ragged:
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False).astype(np.uint32)
        return cls(values[offsets[0] : offsets[-1]], offsets - offsets[0])

    def take(self, numbers: np.ndarray) -> Ragged:
        sizes = self.offsets[numbers + 1] - self.offsets[numbers]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(offsets[-1]) + np.repeat(self.offsets[numbers] - offsets[:-1], sizes)
        return Ragged(self.values[places], offsets)


BLOCKS = pa.schema(
    [("rest", pa.binary()), ("sizes", pa.list_(pa.int64())), ("codes", pa.binary()), ("restart", pa.bool_()),
     ("words", pa.list_(pa.list_(pa.int32()))), ("long_words", pa.list_(pa.list_(pa.int32())))]
)
BLOCKS_DDL = (
    "rest binary, sizes array<long>, codes binary, restart boolean, words array<array<int>>, long_words array<array<int>>"
)


class _Codes(dict):
    """Numbers words: tokens by id, others in the order in which they come, after the tokens."""

    def __init__(self, tokens: dict[str, int], first: int) -> None:
        super().__init__(tokens)
        self.next = first
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = self.next
        self.next += 1
        self.new.append(word)
        return code


class KnownWords(NamedTuple):
    """Ids of words by the 128-bit hash of their bytes, in the order of its first half."""

    high: np.ndarray
    low: np.ndarray
    ids: Ragged

    @staticmethod
    def hashes(words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2).astype(np.uint64)

    @classmethod
    def of(cls, merged: pa.Table) -> KnownWords:
        """From rows (word, ids)."""
        found = cls.hashes(merged.column(0).to_pylist())
        order = np.lexsort((found[:, 1], found[:, 0]))
        ids = Ragged.of_lists(merged.column(1).combine_chunks()).take(order)
        return cls(found[order, 0], found[order, 1], ids)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, or -1."""
        if not len(self.high) or not words:
            return np.full(len(words), -1, np.int64)
        wanted = self.hashes(words)
        at = np.minimum(np.searchsorted(self.high, wanted[:, 0]), len(self.high) - 1)
        return np.where((self.high[at] == wanted[:, 0]) & (self.low[at] == wanted[:, 1]), at, -1)


def whole_tokens(vocabulary: Vocabulary) -> dict[str, int]:
    """Tokens that are text: a word that is one needs no merge."""
    whole = {}
    for i, token in enumerate(vocabulary.tokens):
        try:
            whole[token.decode()] = i
        except UnicodeDecodeError:
            continue
    whole.pop("", None)
    return whole


def known_words(docs: DataFrame, shared: Broadcast, byte_ids: Column, rank_map: RankMap) -> KnownWords:
    """Merge the words of a sample of documents, chosen by a hash of their text."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    share = min(1.0, SAMPLE_BYTES / max(size, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = whole_tokens(shared.value)
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                counts.update(split_words(text, shared.value.pattern))
            found = {word.encode(): n for word, n in counts.items() if word not in whole}
            found = {word: n for word, n in found.items() if len(word) <= LONG_WORD}
            columns = [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.array([list(word) for word in batch.column(0).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["word", "bytes"])

    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000).select("text").dropna()
    counts = sample.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = staged(counts, "word-counts")
    few = counts.count() <= KNOWN_WORDS
    words = counts if few else counts.orderBy(F.desc("n"), "word").limit(KNOWN_WORDS)
    words = words.select("word").repartition(2 * docs.sparkSession.sparkContext.defaultParallelism)
    spelled = words.mapInArrow(as_bytes, "word binary, bytes array<int>")
    merged = rank_map.lookup(spelled, "ids", lambda ranks: merge_expression(F.col("bytes"), byte_ids, ranks))
    return KnownWords.of(merged.select("word", "ids").toArrow())  # at most KNOWN_WORDS words


class _Splitter:
    """Words of a task's documents as numbers: tokens, known words, then the others in the order in which they come."""

    def __init__(self, vocabulary: Vocabulary, known: KnownWords, most_words: int) -> None:
        self.vocabulary, self.known, self.most_words = vocabulary, known, most_words
        self.whole = whole_tokens(vocabulary)
        self.rank: dict[bytes, int] = {}
        self.codes: _Codes | None = None

    def block(self, rest: pa.Table, texts: list[str]) -> pa.RecordBatch:
        n_tokens = len(self.vocabulary.tokens)
        restart = self.codes is None or self.codes.next > n_tokens + self.most_words
        if restart:
            self.codes = _Codes(self.whole, n_tokens)
            self.final = np.arange(n_tokens, dtype=np.int32)  # number of each code
            self.fresh = 0
        coded = [
            np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words))
            for words in (split_words(text, self.vocabulary.pattern) for text in texts)
        ]
        found = [word.encode() for word in self.codes.new]
        self.codes.new.clear()
        places = self.known.find(found)
        fresh = np.flatnonzero(places < 0)
        places[fresh] = len(self.known.high) + self.fresh + np.arange(len(fresh))
        self.fresh += len(fresh)
        self.final = np.concatenate([self.final, (n_tokens + places).astype(np.int32)])
        found = [found[i] for i in fresh.tolist()]
        if not self.rank and any(len(word) > LONG_WORD for word in found):
            self.rank.update((token, i) for i, token in enumerate(self.vocabulary.tokens) if token)
        words = [list(word) if len(word) <= LONG_WORD else [] for word in found]
        long_words = [[] if len(word) <= LONG_WORD else heap_merge(word, self.rank) for word in found]
        numbers = self.final[np.concatenate(coded)].tobytes()
        row = [_as_bytes(rest), [len(one) for one in coded], numbers, restart, words, long_words]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCKS)], schema=BLOCKS)


class _Places:
    """Ids of all words of a task, by their numbers."""

    def __init__(self, vocabulary: Vocabulary, known: KnownWords) -> None:
        n_tokens = len(vocabulary.tokens)
        self.values = np.concatenate([np.arange(n_tokens, dtype=np.uint32), known.ids.values])
        self.offsets = np.concatenate([np.arange(n_tokens), n_tokens + known.ids.offsets])
        self.words = Ragged(self.values, self.offsets)

    def add(self, fresh: Ragged, restart: bool) -> Ragged:
        before = Ragged(self.values, self.offsets) if restart else self.words
        self.words = Ragged(
            np.concatenate([before.values, fresh.values]),
            np.concatenate([before.offsets, before.offsets[-1] + fresh.offsets[1:]]),
        )
        return self.words


def _as_bytes(rest: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rest.schema) as writer:
        writer.write_table(rest)
    return sink.getvalue().to_pybytes()


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    with_decoded: bool = False,
    keep: Sequence[str] = ("doc_id",),
    task_words: int = TASK_WORDS,
) -> DataFrame:
    """The columns ``keep`` of every row, n_tokens, and ids as little-endian unsigned 32-bit integers in a binary.

    On demand also ``decoded``, the bytes that the ids stand for. ``task_words`` bounds what a task remembers; it changes
    its memory and how often a word is merged again, never the ids.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(vocabulary)
    byte_ids = _literal([vocabulary.tokens.index(bytes([b])) for b in range(256)], "int")
    rank_map = RankMap(docs.sparkSession, vocabulary.pairs())
    known = context.broadcast(known_words(docs, shared, byte_ids, rank_map))
    names = [f"k{i}" for i in range(len(keep))]  # kept columns may have any names
    source = docs.select(F.col("text").alias("text"), *[F.col(f"`{c}`").alias(name) for c, name in zip(keep, names)])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(shared.value, known.value, task_words)
        for batch in batches:
            first, chars, texts = 0, 0, []
            for row, text in enumerate(batch.column(0), 1):
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= BLOCK_CHARS or row == batch.num_rows:
                    rest = batch.slice(first, row - first).select(names)
                    yield splitter.block(pa.Table.from_batches([rest]), texts)
                    first, chars, texts = row, 0, []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(shared.value, known.value)
        pieces = shared.value.tokens
        for batch in batches:
            for row in range(batch.num_rows):
                rest = pa.ipc.open_stream(batch.column(0)[row].as_buffer()).read_all().combine_chunks()
                codes = np.frombuffer(batch.column(2)[row].as_py(), np.int32).astype(np.int64)
                words = places.add(Ragged.of_lists(batch.column(4)[row].values), batch.column(3)[row].as_py())
                bounds = np.concatenate([[0], np.cumsum(batch.column(1)[row].as_py())]).astype(np.int64)
                for first in range(0, rest.num_rows, 256):  # some documents at a time keep the arrays small
                    part = bounds[first : first + 257]
                    placed = words.take(codes[part[0] : part[-1]])
                    ends = placed.offsets[part - part[0]]
                    ids = [placed.values[a:b] for a, b in zip(ends, ends[1:])]
                    columns = [*rest.slice(first, 256).columns, pa.array(np.diff(ends), pa.int64())]
                    columns.append(pa.array([one.tobytes() for one in ids], pa.binary()))
                    if with_decoded:
                        decoded = [b"".join(map(pieces.__getitem__, one.tolist())) for one in ids]
                        columns.append(pa.array(decoded, pa.binary()))
                    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
                    yield pa.RecordBatch.from_arrays(columns, [*names, "n_tokens", "ids", "decoded"][: len(columns)])

    def merged(ranks: Ranks) -> Column:
        return F.transform(
            F.col("words"),
            lambda word, i: F.when(F.size(word) > 0, merge_expression(word, byte_ids, ranks)).otherwise(
                F.get(F.col("long_words"), i)
            ),
        )

    blocks = rank_map.lookup(source.mapInArrow(split, BLOCKS_DDL), "merged", merged)
    blocks = blocks.select("rest", "sizes", "codes", "restart", "merged")
    kept = T.StructType([T.StructField(name, source.schema[name].dataType) for name in names])
    kept = kept.add("n_tokens", T.LongType()).add("ids", T.BinaryType())
    encoded = blocks.mapInArrow(place, kept.add("decoded", T.BinaryType()) if with_decoded else kept)
    return encoded.toDF(*keep, *encoded.columns[len(names) :])


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the tokens' bytes, one after the other. Unknown ids are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value.tokens
        for batch in batches:
            decoded = [
                b"".join(map(pieces.__getitem__, np.frombuffer(ids, np.uint32).tolist()))
                for ids in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"])

    schema = "doc_id long, n_tokens long, ids binary, decoded binary"
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    encoded = with_digests(encode(docs, vocabulary, with_decoded=True))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def with_digests(encoded: DataFrame) -> DataFrame:
    """``ids`` and ``decoded`` joined by their SHA-256; ``decoded`` itself is dropped."""
    digests = {f"{name}_sha256": F.sha2(name, 256) for name in ("ids", "decoded")}
    return encoded.withColumns(digests).drop("decoded")
