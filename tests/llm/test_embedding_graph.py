import numpy as np
import pytest
from compare import compare, connect

from wattlake.llm import embedding_graph, queries

VECTORS = "vec_id long, embedding array<float>, label int"


def naive(rows, threshold):
    able = []
    for place, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            able.append((place, i, np.float32(v).astype(float), label))
    links = {p: set() for p in range(len(rows))}
    for p, _, a, la in able:
        for q, _, b, lb in able:
            if p != q and la == lb and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                links[p].add(q)
    found = []
    for p, (i, _, _) in enumerate(rows):
        seen, front = {p}, [p]
        while front:
            for q in links[front.pop()] - seen:
                seen.add(q)
                front.append(q)
        ids = [rows[q][0] for q in seen if rows[q][0] is not None]
        least = min(ids) if ids else None
        found.append((i, len(links[p]), least, i == least))
    return sorted(found, key=repr)


def run(spark, rows, schema=VECTORS, **sizes):
    df = spark.createDataFrame(rows, schema)
    return sorted((tuple(r) for r in embedding_graph.near_duplicate_vectors(df, 0.93, **sizes).collect()), key=repr)


def clusters(n, size, seed, spread=0.12):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        centre = rng.normal(size=16)
        centre /= np.linalg.norm(centre)
        rows += [(centre + spread / 4 * rng.normal(size=16), c % 2) for _ in range(size if c else 4 * size)]
    rng.shuffle(rows)
    return [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("sizes", [{}, {"shard": 40, "chunk": 60}])
def test_links_equal_brute_force(spark, sizes):
    rows = clusters(12, 12, 1)
    assert run(spark, rows, **sizes) == naive(rows, 0.93)


def test_neighbourhoods_larger_than_the_widest_beam(spark, monkeypatch):
    monkeypatch.setattr(embedding_graph, "FIRST_BEAM", 4)
    monkeypatch.setattr(embedding_graph, "WIDEST_BEAM", 8)
    rows = clusters(6, 20, 2)
    assert run(spark, rows) == naive(rows, 0.93)


def test_recall_of_the_graph_and_reach():
    rng = np.random.default_rng(3)
    own = embedding_graph.unit(rng.normal(size=(3000, 24)))
    graph = embedding_graph.Graph(own)
    ids, _ = graph.search(own, 48)
    best = np.argsort(-(own @ own.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), best.tolist(), strict=True)]) > 0.9
    seen, front = {graph.entry}, [graph.entry]
    while front:
        for node in graph.near[0][front.pop()].tolist():
            if node >= 0 and node not in seen:
                seen.add(node)
                front.append(node)
    assert len(seen) == 3000


def test_odd_rows_have_defined_results(spark):
    a, b = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [
        (1, a, 1), (2, b, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 0.0], 1),
        (8, [float("nan"), 1.0, 0.0], 1), (9, [float("inf"), 1.0, 0.0], 1), (10, [], 1), (11, [2.0, 0.0], 1), (12, [1.0, 0.0], 1),
        (13, a, 1), (13, a, 1), (None, b, 1), (None, [0.0, 0.0, 1.0], 1), (14, [4.0, 0.0, 0.0], 1),
    ]
    got = run(spark, [(*r, "x", 1) for r in rows], VECTORS + ", component_id string, size int")
    expected = [(i, n, c, True if i is None and c is None else k) for i, n, c, k in naive(rows, 0.93)]
    assert got == sorted(expected, key=repr)
    assert run(spark, []) == []


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    ok, note = compare(spark, connect(folder), folder, "op6_near_vectors", queries.QUERIES, queries.EQUIVALENT_SQL)
    assert ok, note
