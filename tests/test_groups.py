import random
import statistics
from datetime import date, timedelta

import pytest
from conftest import rows

from wattlake.operators import dense_rank_within, orphans, rolling_mean_by_days, score_against_group, top_n_cutoff


def values(spark, seed=5, n=400):
    rng = random.Random(seed)
    data = [(rng.choice(["hot"] * 5 + ["a", None]), rng.choice([None, *map(float, range(40))]), i) for i in range(n)]
    return data, spark.createDataFrame(data, "g string, v double, id int")


@pytest.mark.parametrize("limit", [10**6, 30, 4])
def test_dense_rank(spark, limit):
    data, df = values(spark)
    expected = []
    for g, v, i in data:
        peers = sorted({(x is not None, x or 0) for h, x, _ in data if h == g}, reverse=True)
        expected.append((g, v, i, peers.index((v is not None, v or 0)) + 1))
    assert rows(dense_rank_within(df, ["g"], "v", "r", max_group_rows=limit)) == sorted(expected, key=repr)


def test_cutoff_counts_ties_and_leaves_out_nulls(spark):
    df = spark.createDataFrame(
        [("a", v) for v in (9.0, 8.0, 8.0, 7.0, None)] + [("b", 1.0), ("b", None)], "g string, v double"
    )
    assert rows(top_n_cutoff(df, ["g"], "v", 3)) == [("a", 8.0, 3), ("b", 1.0, 1)]


def test_scores_and_leaders_equal_brute_force(spark):
    data, df = values(spark, seed=9)
    out = score_against_group(df, ["g"], "v", top_n=5).collect()
    assert len(out) == len(data)
    for r in out:
        peers = [x for h, x, _ in data if h == r.g and x is not None]
        rank = 1 + (len(peers) if r.v is None else sum(x > r.v for x in peers))
        assert r.is_leader == (rank <= 5)
        if r.v is not None:
            z = (r.v - statistics.mean(peers)) / statistics.stdev(peers)
            assert abs(r.z_score - z) < 0.001
            assert r.anomaly_band == ("severe" if abs(z) >= 3 else "watch" if abs(z) >= 2 else "normal")


def test_one_row_or_equal_rows_have_no_score(spark):
    df = spark.createDataFrame([("one", 5.0), ("same", 2.0), ("same", 2.0)], "g string, v double")
    for r in score_against_group(df, ["g"], "v", top_n=1).collect():
        assert r.z_score is None and r.anomaly_band == "normal" and r.is_leader


def test_rolling_mean(spark):
    rng = random.Random(2)
    start = date(2024, 1, 1)
    data = [
        (rng.choice(["a", None]), start + timedelta(days=rng.choice([0, 1, 2, 9, 10, 15, 30])), rng.choice([None, 1.0, 4.0]))
        for _ in range(80)
    ]
    df = spark.createDataFrame(data, "g string, day date, v double")
    expected = []
    for g, day, v in data:
        frame = [x for h, d, x in data if h == g and timedelta(0) <= day - d <= timedelta(days=6) and x is not None]
        expected.append((g, day, v, sum(frame) / len(frame) if frame else None))
    assert rows(rolling_mean_by_days(df, ["g"], "day", "v", "m")) == sorted(expected, key=repr)


def test_null_is_an_orphan(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert rows(orphans(child, parent, "k", "p")) == [("b",), (None,)]
