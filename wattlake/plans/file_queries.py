"""Registered queries on written files: footers, layout, sketches and catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattlake.operators.sketches import estimates, sketch
from wattlake.plans.registry import query, table
from wattlake.quality import Expectation
from wattlake.session import scratch_path, small_table
from wattlake.sources.footers import column_ranges, footers
from wattlake.sources.layout import write_clustered
from wattlake.sources.tables import ensure_table, replace_date
from wattlake.written_checks import evaluate_files

_RANGED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": "timestamp_ntz"}


@query(
    "footer_ranges",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(*) AS rows, count(*) - count({c}) AS nulls, "
        + (f"epoch(min({c}))::BIGINT AS least, epoch(max({c}))::BIGINT AS most" if t != "bigint" else f"min({c})::BIGINT AS least, max({c})::BIGINT AS most")
        + " FROM orders" for c, t in _RANGED.items()
    ),
)
def _footer_ranges(spark, folder):
    """Nulls and ranges of columns of orders by the footers alone; times in seconds."""
    told = column_ranges(footers(spark, f"{folder}/orders.parquet"), _RANGED)
    number = lambda c, end: (
        F.unix_seconds(F.col(f"{c}.{end}").cast("timestamp")) if _RANGED[c] != "bigint" else F.col(f"{c}.{end}")
    ).alias(end)
    cells = F.array(*(
        F.struct(F.lit(c).alias("name"), F.col("_rows").alias("rows"), F.col(f"{c}.nulls").alias("nulls"), number(c, "least"), number(c, "most"))
        for c in _RANGED
    ))
    return told.select(F.explode(cells).alias("c")).select("c.*")


_LINES = "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string"


@query(
    "footer_checks",
    """SELECT 'row_count_min:lineitem' AS name, count(*) >= 1 AS passed, count(*)::VARCHAR AS observed FROM lineitem
    UNION ALL SELECT 'not_null:lineitem.l_orderkey', count(l_orderkey) = count(*), count_if(l_orderkey IS NULL) || ' nulls' FROM lineitem
    UNION ALL SELECT 'between:lineitem.l_linenumber', count_if(l_linenumber < 1 OR l_linenumber > 7) = 0,
                     count_if(l_linenumber < 1 OR l_linenumber > 7) || ' out of range' FROM lineitem
    UNION ALL SELECT 'between:lineitem.l_quantity', count_if(l_quantity < 2 OR l_quantity > 40) = 0,
                     count_if(l_quantity < 2 OR l_quantity > 40) || ' out of range' FROM lineitem
    UNION ALL SELECT 'accepted_values:lineitem.l_returnflag', count_if(l_returnflag NOT IN ('A', 'N', 'R')) = 0,
                     count_if(l_returnflag NOT IN ('A', 'N', 'R')) || ' outside set' FROM lineitem""",
)
def _footer_checks(spark, folder):
    """Three checks that footers answer and two that need rows, in one report."""
    path = f"{folder}/lineitem.parquet"
    kinds = dict(table(spark, folder, "lineitem").dtypes)
    checks = evaluate_files(
        spark,
        [
            Expectation("row_count_min", "lineitem", params={"min": 1}), Expectation("not_null", "lineitem", "l_orderkey"),
            Expectation("between", "lineitem", "l_linenumber", {"min": 1, "max": 7}),
            Expectation("between", "lineitem", "l_quantity", {"min": 2, "max": 40}),
            Expectation("accepted_values", "lineitem", "l_returnflag", {"values": ["A", "N", "R"]}),
        ],
        {"lineitem": path}, {"lineitem": ", ".join(f"{c} {kinds[c]}" for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))},
    )
    return small_table(spark, [vars(c) for c in checks], "name string, passed boolean, observed string")


@query(
    "sketch_profile",
    """SELECT date_trunc('month', ts)::DATE AS month, event_type, count(*) AS rows, true AS distinct_near, true AS quartiles_near
       FROM events GROUP BY ALL""",
)
def _sketch_profile(spark, folder):
    """Users and quartiles of values by month and type, merged from sketches a day, beside the exact figures.

    ``distinct_near``: within 4 %. ``quartiles_near``: the exact ranks of the three estimates are within 2 %.
    """
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    path = scratch_path(spark, "sketches")
    sketch(events, ["day", "event_type"], distinct=["user_id"], quantiles=["value"]).write.parquet(path)
    month = F.trunc("day", "month").alias("month")
    by = ["month", "event_type"]
    found = estimates(spark.read.parquet(path).withColumn("month", month), by, (0.25, 0.5, 0.75))
    told = found.groupBy(*by).agg(F.max("distinct").alias("d"), F.max("quantiles").alias("q"))
    # Told figures are a row a group; AQE broadcasts them only if they are small.
    exact = events.withColumn("month", month).join(told, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"), F.count("value").alias("n"), F.first("d").alias("d"),
        *(F.count_if(F.col("value") < F.col("q")[k]).alias(f"below{k}") for k in range(3)),
        *(F.count_if(F.col("value") <= F.col("q")[k]).alias(f"upto{k}") for k in range(3)),
    )
    near = F.lit(True)
    for k, rank in enumerate((0.25, 0.5, 0.75)):
        near &= (F.col(f"below{k}") <= (rank + 0.02) * F.col("n") + 1) & (F.col(f"upto{k}") >= (rank - 0.02) * F.col("n") - 1)
    return exact.select(
        *by, "rows", (F.abs(F.col("d") - F.col("users")) <= 0.04 * F.col("users")).alias("distinct_near"), near.alias("quartiles_near")
    )


@query(
    "clustered_lookup",
    """SELECT ts::DATE AS dt, user_id, count(*) AS n, CAST(sum(floor(value)) AS BIGINT) AS total
       FROM events WHERE user_id = (SELECT max(user_id) FROM events) GROUP BY ALL""",
)
def _clustered_lookup(spark, folder):
    """The days of one user, read from files clustered by user with Bloom filters."""
    events = table(spark, folder, "events").select(F.to_date("ts").alias("dt"), "user_id", "value")
    path = scratch_path(spark, "clustered")
    write_clustered(events, path, "dt", "user_id", bloom=["user_id"])
    last = events.agg(F.max("user_id")).first()[0]
    kept = spark.read.schema(events.schema).parquet(path).filter(F.col("user_id") == F.lit(last))
    return kept.groupBy("dt", "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("value")).cast("long").alias("total"))


@query(
    "catalog_replaced_dates",
    """WITH days AS (SELECT date_trunc('month', o_orderdate)::DATE AS dt, min(dt) OVER () AS first, max(dt) OVER () AS last, * FROM orders)
       SELECT dt, o_orderpriority, count(*) AS orders, CAST(sum(o_orderkey) + CASE WHEN dt = last THEN count(*) ELSE 0 END AS BIGINT) AS keys
       FROM days WHERE dt <> first GROUP BY dt, o_orderpriority, last""",
)
def _catalog_replaced_dates(spark, folder):
    """Orders by month in a catalog table; the last date is then replaced, with keys one higher and columns turned round, the first cleared."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", F.trunc("o_orderdate", "month").alias("dt"))
    name = f"orders_{uuid.uuid4().hex}"
    ensure_table(spark, name, "o_orderkey bigint, o_orderpriority string, dt date", "dt", scratch_path(spark, "catalog_table"))
    orders.hint("rebalance", "dt").write.mode("append").insertInto(name)
    first, last = orders.agg(F.min("dt"), F.max("dt")).first()
    replace_date(orders.filter(F.col("dt") == last).select("dt", "o_orderpriority", (F.col("o_orderkey") + 1).alias("o_orderkey")), name, "dt", last)
    replace_date(orders.limit(0), name, "dt", first)
    return spark.table(name).groupBy("dt", "o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys"))
