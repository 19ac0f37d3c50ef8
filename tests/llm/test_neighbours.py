import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from webmart.llm import neighbours as N
from webmart.llm.queries import op8_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k):
    """All inner products, best first."""
    usable = [
        (i, np.array(v, dtype=np.float64)) for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for i, query in usable:
        if i % 20 == 0:
            ranked = sorted(((-float(np.dot(query, v)), j) for j, v in usable if j != i))
            out[i] = [(j, -s) for s, j in ranked[:k]]
    return out


def of(frame):
    out = {}
    for row in sorted(frame.collect(), key=lambda row: (row.query_id, row.rank)):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
    return out


def recall(found, right):
    kept = sum(len({j for j, _ in found.get(i, [])} & {j for j, _ in best}) for i, best in right.items())
    return kept / sum(len(best) for best in right.values())


def test_recall_and_scores(spark, sf_dir):
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found, right = of(op8_neighbours(spark, sf_dir)), plain(rows, 20)
    assert found.keys() == right.keys() and recall(found, right) >= 0.9
    vectors = {i: np.array(v, dtype=np.float64) for i, v, *_ in rows}
    for i, best in found.items():
        assert [s for _, s in best] == sorted((s for _, s in best), reverse=True)
        assert all(abs(np.dot(vectors[i], vectors[j]) - s) < 1e-9 for j, s in best)


def test_many_cells_and_splits(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 100)
    monkeypatch.setattr(N, "LEAF_ROWS", 8)
    monkeypatch.setattr(N, "SAMPLE", 300)
    draw = np.random.default_rng(4)
    points = draw.normal(size=(1500, 12)) * draw.uniform(0.2, 3, size=(1500, 1))
    points[600:1100] = points[600]  # a hot vector
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(points)]
    found = of(N.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 10))
    right = plain(rows, 10)
    hits = total = 0
    for i, best in right.items():
        assert len(found[i]) == 10
        least = best[-1][1] - 1e-9
        hits += sum(s >= least for _, s in found[i])
        total += 10
    assert hits / total >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (20, [2.0, 1.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, None, 1), (4, [], 1),
            (5, [0.0, 0.0], 1), (6, [None, 1.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 2.0, 3.0], 1),
            (None, [5.0, 5.0], None), (40, None, 1), (60, [0.0, 0.0], 1)]
    found = of(N.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0))
    assert {i: [j for j, _ in best] for i, best in found.items()} == {0: [1, 2, 20], 20: [0, 1, 2]}


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert N.nearest(empty, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1)], SCHEMA)
    assert N.nearest(one, F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square():
    assert abs(N.chi_square(N.quantile(0.95)) - 0.95) < 1e-9
    assert abs(N.quantile(0.95, 8) - 15.507) < 1e-3


@pytest.mark.parametrize("rows", [1, 7, 500])
def test_tree_deals_every_point_to_the_cell_of_its_box(rows):
    points = np.array([[random.Random(i * 8 + k).random() for k in range(8)] for i in range(rows)])
    tree = N.Tree(points, 16)
    cells = tree.cell(points)
    assert all((cells[own] == k).all() for k, own in enumerate(tree.members))
    assert (tree.distances(points)[np.arange(rows), cells] == 0).all()
