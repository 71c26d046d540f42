import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import Row

from wattlake.operators import asof_join
from wattlake.operators.asof import _bucket_plan, _measured, _present, _wide_plan
from wattlake.plans import load_queries

T0 = datetime(2024, 1, 1)


def brute_force(left, right, how, exact):
    out = []
    for key, time, tag in left:
        hits = [
            (t, v) for k, t, v in right
            if None not in (key, time, k, t) and k == key and (t <= time if exact else t < time)
        ]
        best = max(hits, key=lambda h: (h[0], h[1] is not None, h[1] or 0), default=None)
        if best is not None:
            out.append((key, time, tag, *best))
        elif how == "left":
            out.append((key, time, tag, None, None))
    return sorted(out, key=repr)


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, "k string, ts timestamp_ntz, tag int"),
        spark.createDataFrame(right, "k string, since timestamp_ntz, v int"),
    )


def sample(seed):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]  # one key holds two thirds
    moment = lambda: T0 + timedelta(minutes=15 * rng.randrange(400))
    left = [(rng.choice(keys), moment(), i) for i in range(300)]
    left += [("a", None, 900), (None, None, 901), ("absent", T0, 902), ("hot", T0 - timedelta(days=900), 903)]
    right = [(rng.choice(keys), moment(), rng.choice([None, 1, 2, 3])) for _ in range(120)]
    right += [("a", None, 5), ("hot", T0 - timedelta(days=800), 7), ("hot", T0 + timedelta(days=300), 8)]
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("strategy, limit", [("broadcast", 10**6), ("bucketed", 10**6), ("sorted", 10**6), ("sorted", 25)])
def test_equals_brute_force(spark, how, exact, strategy, limit):
    left, right = sample(7)
    l, r = frames(spark, left, right)
    got = rows(asof_join(
        l, r, ["k"], "ts", "since", how, allow_exact=exact, strategy=strategy, max_group_rows=limit
    ))
    assert got == brute_force(left, right, how, exact)


@pytest.mark.parametrize("focus", [(0, 3), (-900, -899), (2, 900), (400, 500)])
@pytest.mark.parametrize("exact", [True, False])
def test_focus_does_not_change_the_result(spark, focus, exact):
    left, right = sample(11)
    l, r = frames(spark, left, right)
    days = tuple(T0.date() + timedelta(days=d) for d in focus)
    got = rows(asof_join(l, r, ["k"], "ts", "since", "left", allow_exact=exact, strategy="broadcast", focus=days))
    assert got == brute_force(left, right, "left", exact)


def test_match_with_null_payload_is_a_match(spark):
    l, r = frames(spark, [("a", T0, 1)], [("a", T0 - timedelta(hours=2), 4), ("a", T0 - timedelta(hours=1), None)])
    for strategy in ("broadcast", "bucketed", "sorted"):
        (row,) = asof_join(l, r, ["k"], "ts", "since", "inner", strategy=strategy).collect()
        assert row.v is None and row.since == T0 - timedelta(hours=1)


def test_duplicate_right_rows_do_not_multiply(spark):
    l, r = frames(spark, [("a", T0, 1)], [("a", T0, v) for v in (1, 3, 2)])
    for strategy in ("broadcast", "bucketed", "sorted"):
        (row,) = asof_join(l, r, ["k"], "ts", "since", strategy=strategy).collect()
        assert row.v == 3


def test_empty_right_side(spark):
    l, r = frames(spark, [("a", T0, 1)], [])
    assert asof_join(l, r, ["k"], "ts", "since", "inner").count() == 0
    assert asof_join(l, r, ["k"], "ts", "since", "left").first().v is None


def test_only_a_right_side_of_proven_size_is_broadcast(spark):
    left, right = sample(1)
    l, r = frames(spark, left, right)
    small = asof_join(l, r, ["k"], "ts", "since")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="too large"):
        asof_join(l, r, ["k"], "ts", "since", strategy="broadcast", broadcast_bytes=100)
    large = asof_join(l, r, ["k"], "ts", "since", broadcast_bytes=100)
    text = large._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert rows(large) == rows(small)


def test_many_rows_at_one_key_and_time_meet_the_sorted_pass_as_one(spark):
    left = [("a", T0, i) for i in range(3000)] + [("a", T0 + timedelta(hours=1), -1), ("b", T0, -2), (None, T0, -3)]
    right = [("a", T0 - timedelta(hours=2), 1), ("a", T0, 5), ("a", T0, 3), ("c", T0, 9)]
    for limit in (10**6, 2):
        for how in ("inner", "left"):
            l, r = frames(spark, left, right)
            joined = asof_join(l, r, ["k"], "ts", "since", how, strategy="sorted", max_group_rows=limit)
            assert rows(joined) == brute_force(left, right, how, True)
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in text.split("Window")[-1]  # rows of one key and time are one before they are dealt


def test_crowded_buckets_are_not_broadcast(spark):
    crowd = [("a", T0 + timedelta(milliseconds=i), i) for i in range(1500)]
    _, r = frames(spark, [], crowd)
    seen = _measured(_present(r, ["k"], "since"), ["k"], "since")
    assert (seen.rows, seen.keys, seen.largest, seen.fullest) == (1500, 1, 1500, 1500)
    assert _bucket_plan(seen, 2**26) is None and _wide_plan(seen) is None
    l, r = frames(spark, [("a", T0 + timedelta(seconds=1), 1)], crowd)
    assert asof_join(l, r, ["k"], "ts", "since").first().v == 1000
    with pytest.raises(ValueError, match="crowd"):
        asof_join(l, r, ["k"], "ts", "since", strategy="bucketed")


def test_a_large_right_side_costs_one_shuffle_of_the_left(spark, tmp_path):
    """One key has nearly all left rows; each side is dealt by key and bucket, the left one once and whole."""
    rng = random.Random(3)
    moment = lambda: T0 + timedelta(minutes=rng.randrange(60 * 24 * 90))
    left = [("hot" if i % 50 else "a", moment(), i) for i in range(4000)]
    right = [(k, moment(), i) for i, k in enumerate(["hot", "a", "b", "c"] * 60)]
    for name, frame in zip(("left", "right"), frames(spark, left, right), strict=True):
        frame.write.parquet(str(tmp_path / name))
    l, r = (spark.read.parquet(str(tmp_path / name)) for name in ("left", "right"))
    joined = asof_join(l, r, ["k"], "ts", "since", "left", strategy="bucketed")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 3 and sum("_k_k" in line or "REPARTITION" in line for line in shuffles) == 2
    assert plan.count("Window") == 1 and plan.count("FileScan") == 2 and "Broadcast" not in plan
    assert rows(joined) == brute_force(left, right, "left", True)


def test_many_keys_with_few_rows_over_years_fit_wide_buckets(spark):
    """A bucket has no more rows than its key, so a year's width is no crowd where keys have few rows."""
    right = [(f"k{k}", T0 + timedelta(days=(k * 7 + i * 900) % 2400), i) for k in range(4000) for i in range(3)]
    left = [(f"k{k}", T0 + timedelta(days=k % 2400), k) for k in range(0, 4000, 40)]
    l, r = frames(spark, left, right)
    seen = _measured(_present(r, ["k"], "since"), ["k"], "since")
    assert (seen.largest, seen.fullest) == (3, 1) and _wide_plan(seen) is not None
    many = Row(**seen.asDict() | {"rows": 150_000, "keys": 15_000})
    assert _wide_plan(many)[0] == 24 * 365
    joined = asof_join(l, r, ["k"], "ts", "since", "left", broadcast_bytes=0)
    assert "_b" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == brute_force(left, right, "left", True)


def test_the_large_query_does_not_fail_where_no_width_of_buckets_does(spark, tmp_path):
    """One customer with more orders in an hour than a bucket takes: sorted, not refused."""
    orders = [(i, 1, T0 + timedelta(seconds=i), 1.5) for i in range(1500)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(i, 1, T0 + timedelta(seconds=i), 9) for i in (0, 700, 1499)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = load_queries()[0]["asof_large_right"](spark, str(tmp_path)).collect()
    assert sorted((r.l_orderkey, r.last_order == r.l_shipdate, r.spent_cents) for r in got) == [(i, True, 150) for i in (0, 700, 1499)]


def test_bad_arguments(spark):
    l, r = frames(spark, [("a", T0, 1)], [("a", T0, 1)])
    with pytest.raises(ValueError):
        asof_join(l, r, ["k"], "ts", "since", "outer")
    with pytest.raises(ValueError):
        asof_join(l, r, ["k"], "ts", "since", strategy="magic")
    with pytest.raises(ValueError):
        asof_join(l, r.withColumnRenamed("v", "tag"), ["k"], "ts", "since")
