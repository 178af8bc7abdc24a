"""Operator 8: near duplicates by MinHash bands, sequential Bayesian verification and exact confirmation.

Texts with equal shingle sets are one node, so copies cost one node however many there are. Nodes that share a band
bucket are candidates. They are not paired with each other: first every node of a bucket is compared with two hubs; only
where the confirmed links leave a bucket in several components are nodes of different components compared, inside groups
of bounded size that write confirmed links only. A comparison reads signatures in batches and stops once the posterior
chance of reaching the threshold is below ``MISS``; what survives is confirmed on the full shingle sets.

Words are split at ASCII white space after lower-casing A-Z. A text with fewer words than a shingle is one shingle; a
text without words has an empty set, is linked with nothing and is its own component. Rows with one doc_id are one
document. Rows with a null doc_id take part; a component of such rows only has a null id, and they are kept. Shingles
and sets are known by 64-bit hashes: among ten billion different sets about three pairs are taken for equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import per_batch, staged
from ebbtide.llm.components import connected_components

BANDS, ROWS = 40, 5  # a pair at 0.8 shares no band with a chance of (1 - 0.8 ** 5) ** 40 = 1.3e-7
SIGNATURE = BANDS * ROWS
BATCH = 25  # hashes compared before each look at the posterior
MISS = 1e-6  # a pair is pruned when its posterior chance of reaching the threshold is below this
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000  # nodes and shingles of one bucket that are compared in one group
BROADCAST_ROWS = 500_000  # addresses of candidate texts are broadcast up to this many (24 bytes each), joined beyond
CACHED_WORDS = 25_000  # a worker keeps them; more save no time

_MASK = (1 << 64) - 1
_random = np.random.default_rng(8)
_MULTIPLY = _random.integers(0, 1 << 32, SIGNATURE, np.uint32) | np.uint32(1)
_ADD = _random.integers(0, 1 << 32, SIGNATURE, np.uint32)
_BAND_MULTIPLY = _random.integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ADD = _random.integers(0, 1 << 63, BANDS, np.uint64)


class Shingling(NamedTuple):
    """Words per shingle, and the smallest similarity in hundredths."""

    words: int
    percent: int


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hashes = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    joint = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        joint = _mix(joint * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - size + 1 + i])
    return np.unique(joint)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of ``SIGNATURE`` multiply-add permutations of 32-bit shingle hashes."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        np.minimum(least, (low[at : at + 4096, None] * _MULTIPLY + _ADD).min(0), out=least)
    return least


def bucket_keys(least: np.ndarray) -> np.ndarray:
    banded = least.reshape(BANDS, ROWS).astype(np.uint64)
    return _mix(_mix((banded * _BAND_MULTIPLY).sum(1, dtype=np.uint64)) + _BAND_ADD).view(np.int64)


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "big", signed=True)


def least_matches(percent: int) -> list[tuple[int, int]]:
    """(hashes compared, matches needed): below, P(similarity >= threshold | matches) < MISS under a uniform prior."""
    s = (np.arange(20_000) + 0.5) / 20_000
    needed = []
    for n in range(BATCH, SIGNATURE + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log(1 - s)
            density = np.exp(log - log.max())
            if density[s >= percent / 100].sum() / density.sum() >= MISS:
                needed.append((n, m))
                break
    return needed


def may_reach(a: np.ndarray, b: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Which of the paired signatures (rows of a and b) survive every look at the posterior."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), int)
    done = 0
    for n, least in needed:
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
        if not len(alive):
            break
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def reach(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: 100 * intersection >= percent * union of two sorted sets."""
    both = len(a) + len(b) - len(np.union1d(a, b)) if len(a) and len(b) else 0
    return 100 * both >= percent * (len(a) + len(b) - both)


SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
     ("buckets", pa.list_(pa.int64()))]
)


def text_hash() -> Column:
    """With the doc_id, what tells rows apart: rows equal in both are one document."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sketch(docs: DataFrame, shingling: Shingling) -> DataFrame:
    def rows(ids: Iterable, texts: Iterable, hashes: Iterable) -> Iterator[tuple]:
        for doc_id, text, hashed in zip(ids, texts, hashes):
            shingles = shingle_set(text, shingling.words)
            if len(shingles):
                yield doc_id, hashed, len(shingles), node_of(shingles), bucket_keys(signature(shingles))
            else:
                yield doc_id, hashed, 0, None, None

    ddl = "doc_id long, text_hash long, n_shingles long, node long, buckets array<long>"
    source = docs.select(F.col("doc_id").cast("long"), "text", text_hash().alias("text_hash"))
    return staged(per_batch(source, SKETCH, ddl, rows), "sketch")


SETS = pa.schema([("node", pa.int64()), ("least", pa.binary()), ("shingles", pa.binary())])


def candidate_sets(docs: DataFrame, first_ids: DataFrame, nodes: DataFrame, shingling: Shingling) -> DataFrame:
    """Signature and full set of each of ``nodes``, computed again from one text that holds it."""

    def rows(texts: Iterable) -> Iterator[tuple]:
        done = set()
        for text in texts:
            shingles = shingle_set(text, shingling.words)
            node = node_of(shingles)
            if node not in done:
                done.add(node)
                yield node, signature(shingles).tobytes(), shingles.tobytes()

    holders = staged(first_ids.join(nodes, "node", "left_semi").select(F.col("first_id").alias("holder")), "holders")
    hint = "broadcast" if holders.count() <= BROADCAST_ROWS else "shuffle_hash"
    texts = docs.select("doc_id", "text").join(
        holders.distinct().hint(hint), F.col("doc_id").eqNullSafe(F.col("holder")), "left_semi"
    )
    sets = per_batch(texts.select("text"), SETS, "node long, least binary, shingles binary", rows)
    return staged(sets.dropDuplicates(["node"]), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, shingling: Shingling) -> DataFrame:
    """The pairs (u, v) that reach the threshold: signatures first, then full sets of the survivors."""
    needed = least_matches(shingling.percent)
    percent = shingling.percent

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, SIGNATURE) for i in (2, 3)
            )
            yield batch.select([0, 1]).filter(pa.array(may_reach(a, b, needed)))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                reach(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64), percent)
                for a, b in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def beside(rows: DataFrame, column: str) -> DataFrame:
        for end in ("v", "u"):
            side = sets.select(F.col("node").alias(f"{end}_node"), F.col(column).alias(f"{end}_{column}"))
            rows = rows.join(side, F.col(end) == F.col(f"{end}_node")).drop(f"{end}_node")
        return rows.select("u", "v", f"u_{column}", f"v_{column}")

    alive = beside(pairs, "least").mapInArrow(survivors, "u long, v long")
    alive = staged(alive, "survivors")
    return staged(beside(alive, "shingles").mapInArrow(exact, "u long, v long"), "confirmed")


def compare_block(group: pd.DataFrame, needed: list[tuple[int, int]], percent: int) -> pd.DataFrame:
    """Confirmed links between components of one group, as few as connect what is connected."""
    least = np.frombuffer(b"".join(group["least"]), np.uint32).reshape(-1, SIGNATURE)
    sets = [np.frombuffer(shingles, np.uint64) for shingles in group["shingles"]]
    sizes = np.array([len(one) for one in sets])
    chunk, nodes = group["chunk"].to_numpy(), group["node"].to_numpy()
    first, second = int(group["first"].iloc[0]), int(group["second"].iloc[0])
    component = group["root"].to_numpy().copy()
    out = []
    for i in np.flatnonzero(chunk == first):
        other = (chunk == second) if first != second else (np.arange(len(nodes)) > i)
        fits = 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
        others = np.flatnonzero(other & fits & (component != component[i]))
        others = others[may_reach(np.broadcast_to(least[i], (len(others), SIGNATURE)), least[others], needed)]
        for j in others:
            if component[j] != component[i] and reach(sets[i], sets[j], percent):
                component[component == component[j]] = component[i]
                out.append(sorted((nodes[i], nodes[j])))
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def cross_component_links(members: DataFrame, sets: DataFrame, shingling: Shingling) -> DataFrame:
    """Confirmed links between components within buckets. ``members``: bucket, node, root.

    A bucket is cut into chunks of bounded nodes and shingles; each pair of chunks is one group, so a group stays
    bounded, a large bucket becomes many groups, and a group writes fewer links than it has nodes.
    """
    needed = least_matches(shingling.percent)
    percent = shingling.percent

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return compare_block(group, needed, percent)

    sizes = sets.select(F.col("node").alias("sized"), (F.length("shingles") / 8).alias("size"))
    total = members.join(sizes, F.col("node") == F.col("sized")).groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("chunks")
    )
    dealt = members.join(total.withColumnRenamed("bucket", "of"), F.col("bucket") == F.col("of")).drop("of")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select(
        "bucket", "node", "root", "chunk", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second")
    )
    side = sets.withColumnRenamed("node", "set_node")
    dealt = dealt.join(side, F.col("node") == F.col("set_node")).drop("set_node")
    links = dealt.groupBy("bucket", "first", "second").applyInPandas(compare, "u long, v long")
    return staged(links.distinct(), "cross-links")


def components_of(docs: DataFrame, shingling: Shingling) -> DataFrame:
    """(doc_id, text_hash, n_shingles, root, component_id) of every row; root is null for a text without words."""
    sketches = sketch(docs, shingling)
    held = sketches.where(F.col("node").isNotNull())
    first_ids = staged(held.groupBy("node").agg(F.min("doc_id").alias("first_id")), "first-ids")

    in_buckets = held.select("node", F.explode("buckets").alias("bucket"))
    shared = in_buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = staged(shared.where("low <> high").select(F.col("bucket").alias("of"), "low", "high"), "shared")
    # copies hold the same buckets: one row per bucket and node
    members = staged(
        in_buckets.join(shared, F.col("bucket") == F.col("of")).select("bucket", "node", "low", "high").distinct(),
        "members",
    )
    hubs = [members.select(F.col(hub).alias("u"), F.col("node").alias("v")) for hub in ("low", "high")]
    stars = hubs[0].union(hubs[1]).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    stars = staged(stars.distinct(), "stars")
    sets = candidate_sets(docs, first_ids, members.select("node").distinct(), shingling)
    links = confirmed(stars, sets, shingling)

    roots = connected_components(links).select(F.col("node").alias("linked"), "root")
    rooted = members.join(roots, F.col("node") == F.col("linked"), "left")
    rooted = staged(rooted.select("bucket", "node", F.coalesce("root", "node").alias("root")), "rooted")
    mixed = rooted.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    # in a bucket of two or three every pair holds one of the two hubs
    mixed = staged(mixed.where("low <> high AND members > 3").select(F.col("bucket").alias("of")), "mixed")
    left_open = staged(rooted.join(mixed, F.col("bucket") == F.col("of")).select("bucket", "node", "root"), "left-open")
    more = cross_component_links(left_open, sets, shingling)

    final = staged(connected_components(links.union(more)), "roots")
    rooted_ids = first_ids.join(final.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
    rooted_ids = rooted_ids.select("node", "first_id", F.coalesce("root", "node").alias("root"))
    ids = rooted_ids.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_node = rooted_ids.join(ids.withColumnRenamed("root", "id_root"), F.col("root") == F.col("id_root"))
    by_node = staged(by_node.select(F.col("node").alias("of_node"), "root", "component_id"), "by-node")

    columns = ("doc_id", "text_hash", "n_shingles", "root", "component_id")
    full = held.join(by_node, F.col("node") == F.col("of_node")).select(*columns)
    empty = sketches.where(F.col("node").isNull())
    return full.union(empty.withColumns({"root": F.col("node"), "component_id": F.col("doc_id")}).select(*columns))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    found = components_of(docs, Shingling(words, percent)).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one document per group of near duplicates stays.

    Rows equal in doc_id and text are one document and stay once, the one whose columns have the least hash. Rows of one
    doc_id with different texts are documents of their own. Of a group the document with the smallest doc_id stays, of
    several with that id the one whose text has the least hash; a group without any doc_id keeps one document, too.
    Documents without words are alike to nothing and stay. A table without rows stays empty.
    """
    judged = components_of(docs, Shingling(words, percent))
    judged = staged(judged.groupBy("doc_id", "text_hash", "root", "component_id").agg(F.count("*").alias("copies")), "judged")
    first = judged.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    of_groups = first.where(F.col("root").isNotNull()).groupBy("root").agg(
        F.min(F.struct("text_hash", "doc_id", "copies")).alias("one")
    )
    winners = of_groups.select("one.doc_id", "one.text_hash", "one.copies").union(
        first.where(F.col("root").isNull()).select("doc_id", "text_hash", "copies")
    )
    winners = staged(winners.toDF("kept_id", "kept_hash", "copies"), "kept")
    clear = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)], text_hash().alias("hashed"))
    doc_id = f"in_{docs.columns.index('doc_id')}"
    same = F.col(doc_id).eqNullSafe(F.col("kept_id")) & (F.col("hashed") == F.col("kept_hash"))
    kept = clear.join(winners, same).drop("kept_id", "kept_hash")
    columns = [c for c in clear.columns if c != "hashed"]
    once = kept.where("copies = 1").select(*columns)
    order = Window.partitionBy(doc_id, "hashed").orderBy(F.xxhash64(*columns))
    repeated = kept.where("copies > 1").withColumn("place", F.row_number().over(order))
    return once.union(repeated.where("place = 1").select(*columns)).toDF(*docs.columns)
