"""Approximate nearest neighbours by stable projections in kd-trees.

Vectors are projected to ``PROJECTED`` dimensions by Gaussian (2-stable) directions: the squared projected distance of
two vectors, over their squared distance, follows a chi-square distribution. Largest inner products become least
distances by one more coordinate that gives all vectors the same length.

The top of a kd-tree over the projections, fitted on a sample of about ``SAMPLE`` rows, deals every vector to a cell; cells
with more than ``CELL_ROWS`` rows are split by a hash of the id. Each cell goes on as a kd-tree of its own with small
leaves. A query first searches its own cell; the neighbours found bound the distance. Then it visits every other cell
that the stopping test does not rule out. Within a cell its leaves are taken in the order of projected distance and their
vectors verified, until the next leaf is so far that a vector nearer than the present last neighbour would project that
far with a chance below 1 - ``CERTAIN``. All vectors are indexed and no cell or candidate is dropped.

Vectors that are null, zero, hold null or non-finite components, or differ in length from most take no part; nor do rows
without vec_id. Rows that repeat a vec_id are one candidate for each row; a query is never its own candidate. Ties go to
the smaller vec_id. Fewer than ``k`` candidates give them all. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from webmart.llm.common import arrow_schema, in_batches, saved

PROJECTED = 8
SAMPLE = 20_000
CELL_ROWS = 4096
#: Cells of the fitted tree at most; larger tables split cells by a hash.
MOST_CELLS = 1 << 14
LEAF_ROWS = 64
CERTAIN = 0.95
K = 20
#: Queries that a task verifies together.
TOGETHER = 128
FOUND = "query_id long, vec_id long, score double"


def chi_square(value: float, degrees: int = PROJECTED) -> float:
    """Distribution function of the chi-square distribution with an even number of degrees."""
    half = value / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


def quantile(chance: float, degrees: int = PROJECTED) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < chance else (low, middle)
    return high


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, components in double precision."""
    vector = F.col("embedding").cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select("vec_id", vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & usable & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("vector") == (sizes["size"] if sizes else 0))


class Space:
    """Projection of vectors and queries, in which nearer means a larger inner product."""

    def __init__(self, size: int, longest: float, seed: int = 5):
        self.longest = longest
        self.directions = np.random.default_rng(seed).normal(size=(size + 1, PROJECTED))

    def of_vectors(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (rows**2).sum(axis=1), 0))
        return rows @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def of_queries(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.directions[:-1] * (self.longest / np.linalg.norm(rows, axis=1))[:, None]

    def distance(self, score: np.ndarray, query_length: np.ndarray) -> np.ndarray:
        """Squared distance of a query, stretched to the longest vector, from a vector, by their inner product."""
        return np.maximum(2 * self.longest**2 - 2 * self.longest * score / query_length, 0)


class Tree:
    """A kd-tree over points, split at medians of the widest dimension into cells of at most ``rows`` points."""

    def __init__(self, points: np.ndarray, rows: int, most: int = 1 << 30):
        self.split: list[tuple[int, float, int, int]] = []  # dimension, value, left, right; cells are negative
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.members: list[np.ndarray] = []
        depth = max(0, math.ceil(math.log2(max(1, len(points) / rows))))
        self.most_depth = min(depth, int(math.log2(most)))
        width = points.shape[1]
        self.root = self._grow(points, np.arange(len(points)), np.full(width, -np.inf), np.full(width, np.inf), 0)

    def _grow(self, points, own, low, high, depth) -> int:
        spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(points.shape[1])
        at = int(spread.argmax())
        if depth == self.most_depth or spread[at] == 0:
            self.low.append(low)
            self.high.append(high)
            self.members.append(own)
            return -len(self.members)
        value = float(np.median(points[own, at]))
        left = points[own, at] < value
        if not left.any() or left.all():
            value = float(points[own, at].mean())
            left = points[own, at] < value
        node = len(self.split)
        self.split.append((at, value, 0, 0))
        below, above = high.copy(), low.copy()
        below[at] = above[at] = value
        sides = (
            self._grow(points, own[left], low, below, depth + 1),
            self._grow(points, own[~left], above, high, depth + 1),
        )
        self.split[node] = (at, value, *sides)
        return node

    def cell(self, points: np.ndarray) -> np.ndarray:
        """The number of each point's cell."""
        at = np.full(len(points), self.root)
        if self.split:
            table = np.array(self.split)
            while (inner := np.flatnonzero(at >= 0)).size:
                dimension, value, left, right = table[at[inner]].T
                lower = points[inner, dimension.astype(int)] < value
                at[inner] = np.where(lower, left, right).astype(int)
        return -1 - at

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distances of points from the boxes of all cells."""
        low, high = np.array(self.low), np.array(self.high)
        out = np.zeros((len(points), len(low)))
        for k in range(points.shape[1]):
            gap = np.maximum(np.maximum(low[None, :, k] - points[:, k, None], points[:, k, None] - high[None, :, k]), 0)
            out += gap**2
        return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, best first; places without a candidate hold -inf."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


class Cell:
    """The vectors of a cell, in leaves."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, space: Space):
        self.space = space
        points = space.of_vectors(rows)
        self.tree = Tree(points, LEAF_ROWS)
        size = max(len(own) for own in self.tree.members)
        leaves = len(self.tree.members)
        self.rows = np.zeros((leaves, size, rows.shape[1]))
        self.ids = np.full((leaves, size), -1, dtype=np.int64)
        self.real = np.zeros((leaves, size), dtype=bool)
        for leaf, own in enumerate(self.tree.members):
            self.rows[leaf, : len(own)], self.ids[leaf, : len(own)] = rows[own], ids[own]
            self.real[leaf, : len(own)] = True
            if len(own):  # boxes that fit the vectors rule out more than those of the splits
                self.tree.low[leaf], self.tree.high[leaf] = points[own].min(axis=0), points[own].max(axis=0)

    def search(self, query_ids, queries, worst, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query place, vec_id, score) of up to k candidates each that reach the score ``worst`` has for it."""
        lengths = np.linalg.norm(queries, axis=1)
        apart = self.tree.distances(self.space.of_queries(queries))
        order = np.argsort(apart, axis=1, kind="stable")
        scores = np.full((len(queries), k), -np.inf)
        ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        stop = quantile(CERTAIN)
        live = np.arange(len(queries))
        for step in range(order.shape[1]):
            leaf = order[live, step]
            least = np.maximum(scores[live, -1], worst[live])
            bound = np.where(np.isinf(least), np.inf, self.space.distance(least, lengths[live]) * stop)
            on = apart[live, leaf] <= bound
            live, leaf = live[on], leaf[on]
            if not len(live):
                break
            found = np.einsum("qnd,qd->qn", self.rows[leaf], queries[live])
            usable = self.real[leaf] & (self.ids[leaf] != query_ids[live, None])
            found = np.where(usable, found, -np.inf)
            scores[live], ids[live] = _best(
                np.concatenate([scores[live], found], axis=1), np.concatenate([ids[live], self.ids[leaf]], axis=1), k
            )
        place, rank = np.nonzero((scores > -np.inf) & (scores >= worst[:, None]))
        return place, ids[place, rank], scores[place, rank]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _search_cells(placed: DataFrame, asked: DataFrame, parts: int, space: Space, k: int) -> DataFrame:
    """Candidates of queries (query_id, vector, worst, cell, split) among vectors (vec_id, vector, cell, split)."""
    both = placed.select("cell", "split", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "vector", F.lit(0.0).alias("worst"))
    both = both.union(asked.select("cell", "split", F.lit(1), "query_id", "vector", "worst"))
    dealt = both.repartition(parts, "cell", "split").sortWithinPartitions("cell", "split", "kind")

    arrow = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, cell = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(name).to_numpy() for name in ("cell", "split", "kind")], axis=1)
            id_column = batch.column("id").to_numpy()
            vector_column = _matrix(batch.column("vector"))
            worst_column = batch.column("worst").to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if key != tuple(keys[begin, :2]):
                    key, ids, rows, cell = tuple(keys[begin, :2]), [], [], None
                if keys[begin, 2] == 0:
                    ids.append(id_column[begin:end])
                    rows.append(vector_column[begin:end])
                    continue
                if not ids:
                    continue
                if cell is None:
                    cell = Cell(np.concatenate(ids), np.concatenate(rows), space)
                for at in range(begin, end, TOGETHER):
                    part = slice(at, min(at + TOGETHER, end))
                    place, found, scores = cell.search(id_column[part], vector_column[part], worst_column[part], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(id_column[part][place]), pa.array(found), pa.array(scores)], schema=arrow
                    )

    return dealt.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(table: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query row with all other rows."""
    spark = table.sparkSession
    rows = saved(vectors(table))
    facts = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("vector")).alias("size"),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))).alias("longest"),
    ).first()
    if not facts.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space = Space(facts.size, facts.longest)
    one_in = max(1, facts.n // SAMPLE)
    sampled = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(one_in)) == 0).select("vector").toArrow()
    points = space.of_vectors(_matrix(sampled.column("vector").combine_chunks())) if len(sampled) else np.zeros((0, PROJECTED))
    tree = Tree(points, max(1, math.ceil(CELL_ROWS * len(points) / facts.n)), MOST_CELLS)

    def place_start():
        def apply(columns):
            cells = tree.cell(space.of_vectors(np.array(columns["vector"], dtype=np.float64)))
            return columns | {"cell": cells.tolist()}

        return apply

    placed = in_batches(rows, "vec_id long, vector array<double>, cell int", place_start, 2048)
    placed = saved(placed)
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("splits"))
    sizes = F.broadcast(saved(sizes))  # one row for each cell of the fitted tree
    split = F.pmod(F.xxhash64("vec_id"), F.col("splits")).cast("int")
    placed = placed.join(sizes, "cell").withColumn("split", split)
    queries = placed.where(is_query)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), facts.n // CELL_ROWS // 4)
    home = queries.select(F.col("vec_id").alias("query_id"), "vector", F.lit(float("-inf")).alias("worst"), "cell", "split")
    first = saved(_ranked(_search_cells(placed, home.distinct(), parts, space, k), k))
    least = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounds = least.select("query_id", F.when(F.col("n") == k, F.col("least")).alias("worst"))
    asked = home.drop("worst").distinct().join(bounds, "query_id", "left").na.fill(float("-inf"), ["worst"])

    def visit_start():
        def apply(columns):
            vectors_ = np.array(columns["vector"], dtype=np.float64).reshape(len(columns["cell"]), -1)
            apart = tree.distances(space.of_queries(vectors_))
            worst = np.array(columns["worst"], dtype=np.float64)
            reach = space.distance(worst, np.linalg.norm(vectors_, axis=1)) * quantile(CERTAIN)
            row, cell = np.nonzero(apart <= np.where(np.isinf(worst), np.inf, reach)[:, None])
            out = {name: [columns[name][i] for i in row] for name in ("query_id", "vector", "worst")}
            out["own"] = [columns["cell"][i] if columns["cell"][i] == c else None for i, c in zip(row, cell)]
            out["own_split"] = [columns["split"][i] for i in row]
            return out | {"cell": cell.tolist()}

        return apply

    schema = "query_id long, vector array<double>, worst double, own int, own_split int, cell int"
    visits = in_batches(asked, schema, visit_start, 256).join(sizes, "cell")
    visits = visits.withColumn("split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    visits = visits.where("own IS NULL OR own_split <> split")
    more = _search_cells(placed, visits, parts, space, k)
    found = _ranked(first.select("query_id", "vec_id", "score").union(more), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
