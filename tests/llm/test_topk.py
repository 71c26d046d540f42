import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from wattlake.llm import queries, topk

VECTORS = "vec_id long, embedding array<float>"


def naive(rows, k, scale=64):
    fine = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = set()
    for q in sorted({i for i, _ in fine if i % 20 == 0}):
        best = {}
        for _, a in [x for x in fine if x[0] == q]:
            for c, b in fine:
                if c != q and len(a) == len(b):
                    best[c] = max(best.get(c, -(1 << 70)), sum(x * y for x, y in zip(a, b, strict=True)))
        for rank, (c, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            found.add((q, rank, c, s))
    return found


def run(spark, rows, k, schema=VECTORS, **sizes):
    df = spark.createDataFrame(rows, schema)
    return {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k, **sizes).collect()}


@pytest.mark.parametrize("spread", [0.0, 0.5, 2.0])
def test_results_equal_brute_force(spark, spread):
    rng = np.random.default_rng(int(spread * 10))
    centres = rng.normal(size=(5, 6))
    rows = []
    for i in range(300):
        v = centres[i % 5] + 0.3 * rng.normal(size=6)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v) * np.exp(spread * rng.normal())]))
    assert run(spark, rows, 7, bucket=40, block=4) == naive(rows, 7)


def test_pruning_keeps_all_that_reach_the_bound():
    rng = np.random.default_rng(8)
    vectors = rng.integers(-50, 50, (500, 8))
    vectors[:250] = vectors[0] + rng.integers(-4, 5, (250, 8))
    own = topk.Bucket(np.arange(500), vectors)
    for q in vectors[:60]:
        scores = own.vectors @ q
        length = float(np.sqrt((q * q).sum()))
        for bound in np.quantile(scores, [0.5, 0.9, 0.99, 1.0]):
            need = set(np.flatnonzero(scores >= bound).tolist())
            assert need <= set(own.left_by_length(bound, length).tolist())
            cosine = bound / (own.lengths[0] * length)
            if 0 < cosine <= 1:
                left = own.left_by_coordinate(cosine, q / length)
                assert need <= set(left.tolist())
    assert len(own.left_by_coordinate(0.9, vectors[0] / np.linalg.norm(vectors[0]))) < 500


def test_ties_and_repeated_rows(spark):
    same = [(i, [0.5, 0.5]) for i in range(1, 60)] + [(0, [0.5, 0.5]), (0, [1.0, 0.0]), (20, [0.25, 0.5]), (7, [9.0, 9.0]), (7, [9.0, 9.0])]
    assert run(spark, same, 5, bucket=8) == naive(same, 5)
    zero = [(i, [0.0, 0.0]) for i in range(30)]
    assert run(spark, zero, 3, bucket=4) == naive(zero, 3)


def test_odd_rows_have_defined_results(spark):
    rows = [
        (0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (1, [-1.0, -0.001]), (2, [1.0]), (100, [2.0]), (3, []), (120, []), (140, [1e6, -1e6]), (4, [3e6, 1e6]),
    ]
    odd = [(i, v, 1, 2) for i, v in rows]
    assert run(spark, odd, 4, VECTORS + ", id int, length int") == naive(rows, 4)
    assert run(spark, [], 4) == set()
    assert run(spark, [(1, [1.0])], 4) == set() and run(spark, [(20, [1.0])], 4) == set()


def test_large_products_are_exact():
    a, b = np.array([[1 << 30, 3]]), np.array([[1 << 30, 5]])
    assert topk.products(a, b)[0, 0] == (1 << 60) + 15


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    ok, note = compare(spark, connect(folder), folder, "op8_top_products", queries.QUERIES, queries.EQUIVALENT_SQL)
    assert ok, note
