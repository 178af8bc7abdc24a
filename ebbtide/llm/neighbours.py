"""Operator 12: nearest neighbours by inner product, with collision counting over sorted single projections.

The index deals vectors into blocks of like norm and bounded size. A block holds its vectors, their projections on random
orthonormal directions, each projection on its own sorted array, and nothing else: no bucket is ever fixed. A query opens
a window around its own projection in every array and widens all windows step by step (virtual rehashing). A vector
inside a window collides with the query in that array. Vectors that collide in at least as many arrays as a vector within
the current radius does, but for a chance of ``MISS``, are verified: their inner product is computed. The search of a
block ends when the radius covers everything that could still be among the ``k`` nearest.

Inner products become distances by one more coordinate, sqrt(M^2 - norm^2) with the block's greatest norm M (0 for
queries): then distance^2 = M^2 + |q|^2 - 2 q.x, and every vector of inner product t or more lies within the radius of t.
Blocks are searched in rounds of growing number, greatest norms first. Each round starts from the k-th best product that
the query has found so far, so later windows are narrow, and a block whose norms cannot reach it is passed over.

A true neighbour is missed with a chance of at most ``MISS`` whatever the data, since the directions are a random
rotation. Hot spots do no harm: copies of a vector are spread over blocks by hash, and a block returns k rows a query.

Null, empty and zero vectors, vectors with a null, NaN or infinite component, and rows with a null id take no part.
Vectors are compared with vectors of the same length. Rows equal in id and vector count once; other rows with one id are
candidates of their own and, as queries, rank their neighbours separately, but never find rows of their own id. Columns
other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import staged

PROJECTIONS = 128  # at most; as many as a vector has dimensions are a whole rotation
WINDOW = 1.8  # half a window, in standard deviations of the projection of a vector at the radius
MISS = 0.02
RADII = (0.9, 1.0)  # of the radius that is known to hold the k nearest
FIRST_LOOK = 2_048  # vectors of a block that are verified first where a query has no k products yet
BLOCK_ROWS, BLOCK_NUMBERS = 16_384, 1 << 20  # vectors and components of a block, at most on average
GROUP_QUERIES, GROUP_NUMBERS = 1_024, 1 << 18  # the same for the queries that meet a block in one task
GROWTH = 8  # each round searches so many times the blocks of all rounds before
NORM_STEPS = 8  # classes of norms per doubling


@cache
def directions(dim: int) -> np.ndarray:
    """Random orthonormal directions as columns, for vectors with one more coordinate."""
    random = np.random.default_rng(dim)
    count = min(dim + 1, PROJECTIONS)
    return np.linalg.qr(random.standard_normal((dim + 1, count)))[0]


@cache
def collisions_needed(dim: int) -> int:
    """Windows of half width ``WINDOW`` that hold a vector at the radius, but for a chance of ``MISS``."""
    random = np.random.default_rng(dim)
    count, held = min(dim + 1, PROJECTIONS), []
    for _ in range(20):  # directions of a random rotation, seen from a fixed vector
        inside = random.standard_normal((1_000, count)) ** 2
        rest = random.chisquare(dim + 1 - count, 1_000) if count <= dim else 0.0
        held.append((inside * (dim + 1) <= WINDOW**2 * (inside.sum(1) + rest)[:, None]).sum(1))
    return int(np.quantile(np.concatenate(held), MISS, method="lower"))


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added up in the order of the components, so that equal vectors have equal ones."""
    return np.cumsum(vectors * query, axis=1)[:, -1] if len(vectors) else np.empty(0)


class Block:
    """Vectors with sorted projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors, self.dim = ids, vectors, vectors.shape[1]
        norms = np.sqrt((vectors**2).sum(1))
        self.norm = float(norms.max())
        last = np.sqrt(np.maximum(self.norm**2 - norms**2, 0.0))
        places = np.hstack([vectors, last[:, None]]) @ directions(self.dim)
        order = np.argsort(places, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T)
        self.places = np.ascontiguousarray(np.take_along_axis(places, order, axis=0).T)

    def radius(self, size: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Distance within which every vector lies whose product with a query of squared norm ``size`` reaches ``bound``."""
        return np.sqrt(np.maximum(self.norm**2 + size - 2 * bound, 0.0))

    def windows(self, centres: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of each query's window in every sorted array; a row per query."""
        pairs = [
            (places.searchsorted(centre - half), places.searchsorted(centre + half, "right"))
            for places, centre in zip(self.places, centres.T)
        ]
        return tuple(np.ascontiguousarray(np.stack(side, axis=1)) for side in zip(*pairs))

    def search(self, queries: np.ndarray, names: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[tuple]:
        """(number of the query, rows, products) of what may be among the k nearest; bounds are products to reach."""
        size = (queries**2).sum(1)
        slack = 1e-9 * np.sqrt(size) * self.norm  # products are rounded
        reachable = np.flatnonzero(bounds - slack <= np.sqrt(size) * self.norm)
        bounds = bounds - slack
        looked: dict[int, np.ndarray] = {}
        for number in np.flatnonzero(bounds == -np.inf).tolist():  # the k-th best of a few vectors is a bound too
            looked[number] = np.where(self.ids[:FIRST_LOOK] == names[number], -np.inf, self.vectors[:FIRST_LOOK] @ queries[number])
            if len(looked[number]) >= k:
                bounds[number] = np.partition(looked[number], -k)[-k] - slack[number]
        centres = queries @ directions(self.dim)[:-1]
        widest = self.radius(size, bounds)
        half = WINDOW * widest / np.sqrt(self.dim + 1) + 1e-9 * np.sqrt(self.norm**2 + size)
        steps = [self.windows(centres, share * half) for share in RADII]
        for number in reachable.tolist():
            open_ = self.ids != names[number]
            if bounds[number] == -np.inf:  # fewer than k vectors: all of them
                found = np.flatnonzero(open_)
            else:
                found = np.empty(0, np.int64)
                if number in looked:
                    open_[:FIRST_LOOK] = False
                    found = np.flatnonzero(looked[number] >= bounds[number])
                seen = [(low[number].tolist(), high[number].tolist()) for low, high in steps]
                found = self._expand(queries[number], size[number], bounds[number], found, open_, seen, k)
            products = exact_products(self.vectors[found], queries[number])
            best = np.lexsort((self.ids[found], -products))[:k]
            yield number, found[best], products[best]

    def _expand(
        self, query: np.ndarray, size: float, bound: float, found: np.ndarray, open_: np.ndarray, seen: list, k: int
    ) -> np.ndarray:
        """Rows that reach the bound: those found before, and more from windows (low, high) that widen.

        ``bound`` rises with what is verified; ``open_`` marks what is not verified yet.
        """
        missed = np.zeros(len(self.ids), np.int64)
        most_missed = len(self.order) - collisions_needed(self.dim)
        widest = self.radius(size, bound)
        slack = 1e-9 * np.sqrt(size) * self.norm
        products = self.vectors[found] @ query
        before = None
        for share, (low, high) in zip(RADII, seen):
            if before is None:  # windows hold most of an array: what is outside of them is counted
                outside = [o[:a] for o, a in zip(self.order, low)] + [o[b:] for o, b in zip(self.order, high)]
                missed = np.bincount(np.concatenate(outside), minlength=len(missed))
            else:
                reached = [o[a:b] for o, a, b in zip(self.order, low, before[0])]
                reached += [o[a:b] for o, a, b in zip(self.order, before[1], high)]
                missed -= np.bincount(np.concatenate(reached), minlength=len(missed))
            before = low, high
            collide = np.flatnonzero((missed <= most_missed) & open_)
            if len(collide):
                open_[collide] = False
                product = self.vectors[collide] @ query
                found, products = np.append(found, collide), np.append(products, product)
                if len(products) >= k:
                    bound = max(bound, np.partition(products, -k)[-k] - slack)
                held = products >= bound
                found, products = found[held], products[held]
            if share * widest >= self.radius(size, bound):
                break
        return found


def usable_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector, dim, norm) of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    rows = df.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).where("id IS NOT NULL")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = rows.where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    return rows.select("id", "vector", F.size("vector").alias("dim"), norm.alias("norm"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


BLOCKS = pa.schema([("dim", pa.int32()), ("number", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])


def build_index(vectors: DataFrame) -> DataFrame:
    """Blocks (dim, number, ids, vectors) of ``usable_vectors``, written to the shared folder.

    Numbers count the blocks of one dimension, greatest norms first. The sorted arrays of a block follow from its vectors
    and are set up where it is searched, which takes less time than reading them.
    """
    classed = vectors.withColumn("class", F.round(F.log2("norm") * NORM_STEPS).cast("int"))
    held = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_NUMBERS) / F.col("dim"))))
    sizes = classed.groupBy("dim", "class").agg(F.count("*").alias("n"))
    sizes = sizes.select("dim", "class", F.ceil(F.col("n") / held).cast("int").alias("blocks"))
    in_order = Window.partitionBy("dim").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("blocks").over(in_order), F.lit(0)).cast("int"))
    sizes = staged(sizes.withColumnsRenamed({"dim": "of_dim", "class": "of_class"}), "block-sizes")
    placed = classed.join(sizes, (F.col("dim") == F.col("of_dim")) & (F.col("class") == F.col("of_class")))
    number = F.col("before") + F.pmod(F.xxhash64("id", "vector"), F.col("blocks")).cast("int")

    def block(rows: pa.Table) -> pa.Table:
        ids = rows["id"].to_numpy()
        matrix = _matrix(rows["vector"], rows["dim"][0].as_py())
        first = np.unique(np.column_stack([ids, matrix.view(np.int64)]), axis=0, return_index=True)[1]
        values = [rows["dim"][0].as_py(), rows["number"][0].as_py(), ids[first].tobytes(), matrix[first].tobytes()]
        return pa.table([pa.array([v], f.type) for v, f in zip(values, BLOCKS)], schema=BLOCKS)

    dealt = placed.select("id", "vector", "dim", number.alias("number"))
    blocks = dealt.groupBy("dim", "number").applyInArrow(block, "dim int, number int, ids binary, vectors binary")
    return staged(blocks, "vector-blocks")


FOUND = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
FOUND_DDL = "query_id long, query_key long, vec_id long, score double"


def search_round(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Every query (dim, part, parts, id, key, vector, bound) against every one of ``blocks`` of its dimension."""

    def search(block_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        if not block_rows.num_rows or not query_rows.num_rows:
            return FOUND.empty_table()
        dim = block_rows["dim"][0].as_py()
        ids = np.frombuffer(block_rows["ids"][0].as_py(), np.int64)
        block = Block(ids, np.frombuffer(block_rows["vectors"][0].as_py(), np.float64).reshape(-1, dim))
        names, keys = query_rows["id"].to_numpy(), query_rows["key"].to_numpy()
        out: list[list] = [[], [], [], []]
        matrix, bounds = _matrix(query_rows["vector"], dim), query_rows["bound"].to_numpy()
        for number, rows, products in block.search(matrix, names, bounds, k):
            for column, values in zip(
                out, (np.full(len(rows), names[number]), np.full(len(rows), keys[number]), ids[rows], products)
            ):
                column.append(values)
        columns = [np.concatenate(c) if c else [] for c in out]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    parts = queries.groupBy(F.col("dim").alias("of_dim")).agg(F.max("parts").alias("parts"))
    dealt = blocks.join(parts, F.col("dim") == F.col("of_dim"))
    dealt = dealt.select("dim", "number", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    numbers = blocks.groupBy(F.col("dim").alias("of_dim")).agg(F.collect_list("number").alias("numbers"))
    asked = queries.join(numbers, F.col("dim") == F.col("of_dim"))
    asked = asked.select("dim", "part", "id", "key", "vector", "bound", F.explode("numbers").alias("number"))
    keys = ("dim", "number", "part")
    return dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND_DDL)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k rows of greatest score of each query, with their ranks."""
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k rows of ``vectors`` of greatest inner product."""
    blocks = build_index(usable_vectors(vectors, id_column, vector_column))
    asked = usable_vectors(queries, id_column, vector_column).withColumn("key", F.xxhash64("vector"))
    per_part = F.least(F.lit(GROUP_QUERIES), F.greatest(F.lit(1), F.floor(F.lit(GROUP_NUMBERS) / F.col("dim"))))
    asked = staged(asked.dropDuplicates(["id", "key"]).select("id", "key", "vector", "dim"), "queries")
    sizes = asked.groupBy(F.col("dim").alias("of_dim")).agg(F.count("*").alias("n"))
    asked = asked.join(sizes, F.col("dim") == F.col("of_dim")).drop("of_dim")
    asked = asked.withColumn("parts", F.ceil(F.col("n") / per_part).cast("int")).drop("n")
    asked = staged(asked.withColumn("part", F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int")), "query-parts")

    found = best_of(queries.sparkSession.createDataFrame([], FOUND_DDL), k)
    last = blocks.agg(F.max("number")).head()[0]
    first, end = 0, 1
    while last is not None and first <= last:
        bounds = found.where(F.col("rank") == k).select("query_id", "query_key", F.col("score").alias("reached"))
        known = asked.join(bounds, (F.col("id") == F.col("query_id")) & (F.col("key") == F.col("query_key")), "left")
        known = known.withColumn("bound", F.coalesce("reached", F.lit(float("-inf"))))
        more = search_round(blocks.where((F.col("number") >= first) & (F.col("number") < end)), known, k)
        found = staged(best_of(found.drop("rank").unionByName(more), k), "found")
        first, end = end, end * GROWTH
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
