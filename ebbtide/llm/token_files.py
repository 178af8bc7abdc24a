"""Operator 7: token ids in files of shuffled planes.

A chunk holds the ids of whole documents. They are cut into blocks of ``BLOCK_IDS``, each block is transposed into byte
or bit planes, every plane is compressed with zstandard, and an index of the plane sizes stands in front, so that one
block can be read alone. Files are sequences of chunks (Parquet rows, which any shared storage takes) in ascending
order of doc_id: the rows are range-partitioned, and a file holds one range.

Null and empty texts have the end id only. Repeated rows are written each time, rows of one doc_id in the order of a
hash of the text, rows with a null doc_id first.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm.bpe import WORD_PATTERN, split_words
from ebbtide.llm.common import scratch

END_ID = 2
BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20  # a chunk is closed when it holds this many ids; a longer document is a chunk of its own
CACHED_WORDS = 900_000
MAGIC = b"PLN1"
_HEAD = struct.Struct("<4sBIII")  # magic, planes per block, ids, ids per block, blocks

CHUNKS = pa.schema(
    [("shard", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("body", pa.binary())]
)
CHUNKS_DDL = "shard int, seq int, start long, n_ids long, doc_ids array<long>, sizes array<long>, body binary"


def to_planes(ids: np.ndarray, bits: bool) -> np.ndarray:
    """One row per plane, most alike bytes together: 4 byte planes or 32 bit planes of unsigned 32-bit ids."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if bits:
        each = np.unpackbits(planes, axis=1).reshape(4, -1, 8).transpose(0, 2, 1).reshape(32, -1)
        planes = np.packbits(each, axis=1)
    return planes


def from_planes(planes: np.ndarray, count: int) -> np.ndarray:
    if len(planes) == 32:
        each = np.unpackbits(planes, axis=1)[:, :count].reshape(4, 8, count).transpose(0, 2, 1).reshape(4, -1)
        planes = np.packbits(each, axis=1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack(ids: np.ndarray, bits: bool = False, level: int = 3) -> bytes:
    """A chunk body: head, sizes of the compressed planes, planes."""
    compress = zstandard.ZstdCompressor(level=level).compress
    blocks = [ids[at : at + BLOCK_IDS] for at in range(0, len(ids), BLOCK_IDS)]
    planes = [compress(plane.tobytes()) for block in blocks for plane in to_planes(block, bits)]
    head = _HEAD.pack(MAGIC, 32 if bits else 4, len(ids), BLOCK_IDS, len(blocks))
    return head + np.array([len(plane) for plane in planes], "<u4").tobytes() + b"".join(planes)


def unpack(body: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of blocks ``first`` to ``last`` (exclusive, all by default); only their planes are decompressed."""
    magic, width, total, block_ids, blocks = _HEAD.unpack_from(body)
    if magic != MAGIC:
        raise ValueError("not a chunk of token planes")
    sizes = np.frombuffer(body, "<u4", blocks * width, _HEAD.size).reshape(blocks, width)
    at = _HEAD.size + sizes.nbytes + int(sizes[:first].sum())
    decompress = zstandard.ZstdDecompressor().decompress
    out = []
    for number in range(first, blocks if last is None else last):
        count = min(block_ids, total - number * block_ids)
        planes = []
        for size in sizes[number].tolist():
            planes.append(np.frombuffer(decompress(body[at : at + size]), np.uint8))
            at += size
        out.append(from_planes(np.stack(planes), count))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct word once while it is remembered.

    A text that holds the string of an added token, such as <|endoftext|>, goes to the library whole: it gives that
    string its own id.
    """

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.added and self.added.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = split_words(text, WORD_PATTERN)
        missing = list(set(words).difference(self.known))
        if missing:
            if len(self.known) + len(missing) > CACHED_WORDS:
                self.known.clear()
                missing = list(set(words))
            for word, found in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)):
                self.known[word] = np.array(found.ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, words))


@lru_cache(maxsize=1)
def word_encoder(tokenizer_json: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker process runs: words stay known from task to task."""
    return WordEncoder(tokenizer_json)


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, bits: bool = False, end_id: int = END_ID) -> None:
    """Encode every document, append ``end_id``, and write the chunks below ``path`` in ascending order of doc_id."""
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(shared.value)
        shard = TaskContext.get().partitionId()
        seq, start = 0, 0
        doc_ids: list = []
        parts: list[bytes] = []
        held = 0

        def chunk() -> pa.RecordBatch:
            body = pack(np.frombuffer(b"".join(parts), "<u4"), bits)
            row = [shard, seq, start, held, list(doc_ids), [len(part) // 4 for part in parts], body]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, CHUNKS)], schema=CHUNKS)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = encoder.encode(text or "") + end
                doc_ids.append(doc_id)
                parts.append(part)
                held += len(part) // 4
                if held >= CHUNK_IDS:
                    yield chunk()
                    seq, start, held = seq + 1, start + held, 0
                    doc_ids.clear()
                    parts.clear()
        if parts:
            yield chunk()

    tie = F.xxhash64("text")
    in_order = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    in_order.mapInArrow(write, CHUNKS_DDL).write.parquet(path)


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    What the driver adds up is one total per file.
    """
    chunks = spark.read.schema(CHUNKS_DDL).parquet(path)
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    offsets, before = {}, 0
    for row in sorted(totals):
        offsets[row.shard] = before
        before += row.n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, doc_ids, sizes, body in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ids = unpack(body).tobytes()
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
                columns = [doc_ids, bounds[:-1] + start + offsets[shard], sizes, crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=READ)

    return chunks.select("shard", "start", "doc_ids", "sizes", "body").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_files_round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    path = scratch(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_path, path)
    return read_token_files(docs.sparkSession, path)
