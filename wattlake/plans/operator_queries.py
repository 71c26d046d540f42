"""Each operator on its own, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions import cents, path_segment, round_to, run_id_of, safe_divide, to_hour
from wattlake.operators import (
    asof_join,
    dense_rank_within,
    difference_by_key,
    dimension_join,
    latest_per_key,
    orphans,
    score_against_group,
    split_rows,
)
from wattlake.operators.keyed import with_day_boundary
from wattlake.plans.medallion import reject_reason
from wattlake.plans.registry import query, table
from wattlake.quality import duplicate_keys, monotonic_violations

# --- projections and filters ----------------------------------------------


@query(
    "cast_and_normalise",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, lower(c_mktsegment) AS segment,
              upper(n_name) AS nation, CAST(c_acctbal AS DOUBLE) AS balance,
              DATE '2026-08-01' AS business_date, '->' AS dir,
              lower(n_name) || '.' || c_nationkey AS nation_label
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _cast_and_normalise(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.lower("c_mktsegment").alias("segment"),
        F.upper("n_name").alias("nation"),
        F.col("c_acctbal").cast("double").alias("balance"),
        F.lit("2026-08-01").cast("date").alias("business_date"),
        F.lit("->").alias("dir"),
        F.concat(F.lower("n_name"), F.lit("."), F.col("c_nationkey").cast("string")).alias("nation_label"),
    )


@query(
    "scalar_functions",
    """SELECT l_orderkey, l_linenumber, l_shipdate,
              round(l_extendedprice * (1 - l_discount), 1) AS r1,
              round(l_extendedprice * l_discount, 2) AS r2,
              round(l_extendedprice / l_quantity, 3) AS r3,
              round(l_tax / nullif(l_discount, 0), 4) AS r4,
              round(l_extendedprice * l_tax / 7, 5) AS r5,
              abs(l_discount - l_tax) AS spread,
              l_quantity BETWEEN 10 AND 20 AS mid_size, l_quantity NOT BETWEEN 10 AND 20 AS other_size,
              nullif(l_returnflag, 'N') AS flag, "left"(l_linestatus || l_returnflag || 'xyz', 3) AS preview,
              l_returnflag IN ('A', 'R') AS returned,
              date_diff('second', l_shipdate, l_shipdate + INTERVAL 90 SECOND) AS secs
       FROM lineitem""",
)
def _scalar_functions(spark, folder):
    price, qty, disc, tax = map(F.col, ("l_extendedprice", "l_quantity", "l_discount", "l_tax"))
    later = F.col("l_shipdate") + F.expr("INTERVAL 90 SECOND")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        round_to(price * (1 - disc), 1).alias("r1"),
        round_to(price * disc, 2).alias("r2"),
        round_to(price / qty, 3).alias("r3"),
        round_to(safe_divide(tax, disc), 4).alias("r4"),
        round_to(price * tax / 7, 5).alias("r5"),
        F.abs(disc - tax).alias("spread"),
        qty.between(10, 20).alias("mid_size"),
        (~qty.between(10, 20)).alias("other_size"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.left(F.concat("l_linestatus", "l_returnflag", F.lit("xyz")), F.lit(3)).alias("preview"),
        F.col("l_returnflag").isin("A", "R").alias("returned"),
        F.timestamp_diff("SECOND", F.col("l_shipdate"), later).alias("secs"),
    )


@query(
    "hour_and_peak",
    """SELECT * EXCLUDE (props), date_trunc('hour', ts) AS hour_start, hour(ts) AS hour_of_day,
              hour(ts) BETWEEN 17 AND 20 AS is_peak
       FROM events""",
)
def _hour_and_peak(spark, folder):
    return table(spark, folder, "events").drop("props").select(
        "*",
        to_hour(F.col("ts")).alias("hour_start"),
        F.hour("ts").cast("long").alias("hour_of_day"),
        F.hour("ts").between(17, 20).alias("is_peak"),
    )


@query(
    "path_parse",
    """SELECT page_id, split_part(replace(url, 'http://', ''), '/', 1) AS host,
              split_part(replace(url, 'http://', ''), '/', 2) AS section,
              nullif(regexp_extract(url, 'page=([^&/]+)', 1), '') AS page
       FROM pages""",
)
def _path_parse(spark, folder):
    below = F.replace(F.col("url"), F.lit("http://"), F.lit(""))
    return table(spark, folder, "pages").select(
        "page_id",
        F.split_part(below, F.lit("/"), F.lit(1)).alias("host"),
        F.split_part(below, F.lit("/"), F.lit(2)).alias("section"),
        F.nullif(F.regexp_extract("url", "page=([^&/]+)", 1), F.lit("")).alias("page"),
    )


@query(
    "path_inventory",
    """WITH files AS (
           SELECT '/lake/silver/dataset=' || event_type || '/dt=' || CAST(ts AS DATE)
                  || '/run=u' || user_id || '/part-' || event_id AS file
           FROM events
       )
       SELECT split_part(replace(file, '/lake/', ''), '/', 1) AS layer,
              split_part(split_part(replace(file, '/lake/', ''), '/', 2), '=', 2) AS dataset,
              count(*) AS files, count(DISTINCT nullif(regexp_extract(file, 'run=([^/]+)', 1), '')) AS runs
       FROM files GROUP BY ALL""",
)
def _path_inventory(spark, folder):
    file = F.concat(
        F.lit("/lake/silver/dataset="), "event_type", F.lit("/dt="), F.to_date("ts").cast("string"),
        F.lit("/run=u"), F.col("user_id").cast("string"), F.lit("/part-"), F.col("event_id").cast("string"),
    )
    files = table(spark, folder, "events").select(file.alias("file"))
    return files.groupBy(
        path_segment(F.col("file"), "/lake", 1).alias("layer"),
        path_segment(F.col("file"), "/lake", 2).alias("dataset"),
    ).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_distinct(run_id_of(F.col("file"))).alias("runs"),
    )


# --- keyed and ordered ----------------------------------------------------

_LATEST_SQL = """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC
    ) = 1"""


@query("latest_per_key", _LATEST_SQL)
def _latest_per_key(spark, folder):
    return latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "lag_difference",
    """SELECT event_id, user_id, ts, value, lag(value) OVER w AS prev_value, lag(ts) OVER w AS prev_time,
              value - lag(value) OVER w AS difference
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""",
)
def _lag_difference(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return difference_by_key(events, ["user_id"], "ts", "value")


@query(
    "day_boundary_lag",
    """WITH daily AS (
           SELECT *, CAST(ts AS DATE) AS day,
                  lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS prev,
                  lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts) AS prev_day
           FROM events
       )
       SELECT event_id, user_id, ts, day, value,
              CASE WHEN date_diff('day', prev_day, day) <= 1 THEN prev END AS prev_value
       FROM daily""",
)
def _day_boundary_lag(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "ts", F.to_date("ts").alias("day"), "value"
    )
    return with_day_boundary(events, ["user_id"], "day", "ts", "value", "prev_value")


_CLASSIFIED_SQL = """
placed AS (
    SELECT event_id, user_id, ts, nullif(170 + value, if(event_type = 'view', 170 + value, NULL)) AS voltage,
           nullif(value, if(event_type = 'error', value, NULL)) AS cumulative_kwh,
           count(*) OVER (PARTITION BY user_id ORDER BY ts) AS place
    FROM events
),
classified AS (
    SELECT n.* EXCLUDE (place), p.cumulative_kwh AS prev_kwh, p.ts AS prev_ts,
           n.cumulative_kwh - p.cumulative_kwh AS interval_kwh, coalesce(
               if(n.cumulative_kwh IS NULL, 'null_reading', NULL), if(p.cumulative_kwh IS NULL, 'no_prior_reading', NULL),
               if(n.cumulative_kwh < p.cumulative_kwh, 'meter_rollback', NULL),
               if(n.cumulative_kwh - p.cumulative_kwh > 40, 'implausible_spike', NULL),
               if(n.voltage < 180 OR n.voltage > 260, 'voltage_out_of_range', NULL)) AS reject_reason
    FROM placed n LEFT JOIN placed p ON p.user_id = n.user_id AND p.place + 1 = n.place
)"""


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    readings = table(spark, folder, "events").select(
        "event_id", "user_id", "ts",
        F.when(kind != "view", 170 + F.col("value")).alias("voltage"),
        F.when(kind != "error", F.col("value")).alias("cumulative_kwh"),
    )
    stepped = difference_by_key(
        readings, ["user_id"], "ts", "cumulative_kwh",
        previous_value="prev_kwh", previous_time="prev_ts", difference="interval_kwh",
    )
    return stepped.withColumn("reject_reason", reject_reason())


@query("classify_reject_reason", f"WITH {_CLASSIFIED_SQL} SELECT * FROM classified")
def _classify(spark, folder):
    return _classified(spark, folder)


@query("split_accepted", f"WITH {_CLASSIFIED_SQL} SELECT * FROM classified WHERE reject_reason IS NULL")
def _split_accepted(spark, folder):
    return split_rows(_classified(spark, folder), "reject_reason")[0]


@query("split_quarantine", f"WITH {_CLASSIFIED_SQL} SELECT * FROM classified WHERE reject_reason IS NOT NULL")
def _split_quarantine(spark, folder):
    return split_rows(_classified(spark, folder), "reject_reason")[1]


@query(
    "monotonic_violations",
    """SELECT user_id, count(*) FILTER (WHERE value < prev) AS violations
       FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)
       GROUP BY user_id HAVING count(*) FILTER (WHERE value < prev) > 0""",
)
def _monotonic_violations(spark, folder):
    return monotonic_violations(table(spark, folder, "events"), ["user_id"], "ts", "value")


# --- joins ----------------------------------------------------------------


@query(
    "dim_join",
    """SELECT user_id, event_id, ts, value, c_mktsegment, n_name, r_name
       FROM events JOIN (SELECT c_custkey AS user_id, c_mktsegment, n_name, r_name FROM customer
                         JOIN nation ON c_nationkey = n_nationkey
                         JOIN region ON n_regionkey = r_regionkey) USING (user_id)""",
)
def _dim_join(spark, folder):
    customers = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnRenamed("c_custkey", "user_id")
    )
    return dimension_join(
        table(spark, folder, "events").select("user_id", "event_id", "ts", "value"),
        customers, "user_id", ["c_mktsegment", "n_name", "r_name"],
    )


def _clicks_and_purchases(spark, folder):
    events = table(spark, folder, "events")
    clicks = events.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    purchases = events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("purchase_ts"), F.col("value").alias("purchase_value")
    )
    return clicks, purchases


_ASOF_SQL = """
    SELECT c.event_id, c.user_id, c.ts, p.ts AS purchase_ts, p.value AS purchase_value
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF {how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON c.user_id = p.user_id AND c.ts {op} p.ts"""


@query("asof_inner", _ASOF_SQL.format(how="", op=">="))
def _asof_inner(spark, folder):
    clicks, purchases = _clicks_and_purchases(spark, folder)
    return asof_join(clicks, purchases, ["user_id"], "ts", "purchase_ts", "inner")


@query("asof_left", _ASOF_SQL.format(how="LEFT", op=">="))
def _asof_left(spark, folder):
    clicks, purchases = _clicks_and_purchases(spark, folder)
    return asof_join(clicks, purchases, ["user_id"], "ts", "purchase_ts", "left")


@query("asof_strict", _ASOF_SQL.format(how="LEFT", op=">"))
def _asof_strict(spark, folder):
    clicks, purchases = _clicks_and_purchases(spark, folder)
    return asof_join(clicks, purchases, ["user_id"], "ts", "purchase_ts", "left", allow_exact=False)


@query(
    "asof_large_right",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_partkey, o.last_order, o.spent_cents
       FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, o_custkey
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey) l
       ASOF LEFT JOIN (
           SELECT o_custkey, o_orderdate AS last_order,
                  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS spent_cents
           FROM orders GROUP BY ALL
       ) o ON l.o_custkey = o.o_custkey AND l.l_shipdate >= o.last_order""",
)
def _asof_large_right(spark, folder):
    orders = table(spark, folder, "orders")
    lines = (
        table(spark, folder, "lineitem")
        .join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
        .select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "o_custkey")
    )
    spent = orders.groupBy("o_custkey", F.col("o_orderdate").alias("last_order")).agg(
        F.sum(cents(F.col("o_totalprice"))).alias("spent_cents")
    )
    # Never broadcast, however small the tables; shuffled by buckets or sorted, as the right rows allow.
    return asof_join(
        lines, spent, ["o_custkey"], "l_shipdate", "last_order", "left", broadcast_bytes=0
    ).drop("o_custkey")


@query(
    "anti_join_orphans",
    "SELECT c_custkey, c_name FROM customer ANTI JOIN orders ON c_custkey = o_custkey",
)
def _anti_join_orphans(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return orphans(customers, table(spark, folder, "orders"), "c_custkey", "o_custkey")


@query(
    "anti_join_inactive",
    "SELECT c_custkey, c_name FROM customer ANTI JOIN events ON c_custkey = user_id",
)
def _anti_join_inactive(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return orphans(customers, table(spark, folder, "events"), "c_custkey", "user_id")


@query(
    "semi_join_active",
    "SELECT c_custkey, c_name FROM customer SEMI JOIN events ON c_custkey = user_id",
)
def _semi_join_active(spark, folder):
    active = table(spark, folder, "events").select(F.col("user_id").alias("c_custkey"))
    return table(spark, folder, "customer").select("c_custkey", "c_name").join(active, "c_custkey", "left_semi")


# --- aggregates -----------------------------------------------------------


@query(
    "daily_group_filter",
    """WITH e AS (SELECT *, CAST(ts AS DATE) AS day, CAST(round(value * 100) AS BIGINT) AS c FROM events)
       SELECT day, event_type, count(*) AS n, count(DISTINCT user_id) AS users,
              CAST(sum(c) AS BIGINT) AS total_cents, round(avg(c), 2) AS avg_cents, max(value) AS max_value,
              CAST(sum(c) FILTER (WHERE hour(ts) BETWEEN 17 AND 20) AS BIGINT) AS peak_cents,
              round(100.0::DOUBLE * sum(c) FILTER (WHERE hour(ts) BETWEEN 17 AND 20)
                    / nullif(sum(c), 0), 2) AS peak_share_pct
       FROM e GROUP BY ALL""",
)
def _daily_group_filter(spark, folder):
    amount = cents(F.col("value"))
    peak = F.hour("ts").between(17, 20)
    return (
        table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("user_id").alias("users"),
            F.sum(amount).alias("total_cents"),
            round_to(F.avg(amount), 2).alias("avg_cents"),
            F.max("value").alias("max_value"),
            F.sum(F.when(peak, amount)).alias("peak_cents"),
        )
        .withColumn(
            "peak_share_pct", round_to(safe_divide(100.0 * F.col("peak_cents"), F.col("total_cents")), 2)
        )
    )


@query(
    "lineitem_group",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_partkey) AS parts,
              sum(l_quantity) AS quantity, round(avg(l_quantity), 4) AS avg_quantity,
              max(l_extendedprice) AS max_price,
              CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents,
              sum(l_quantity) FILTER (WHERE l_discount > 0.05) AS discounted
       FROM lineitem GROUP BY ALL""",
)
def _lineitem_group(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("l_partkey").alias("parts"),
        F.sum("l_quantity").alias("quantity"),
        round_to(F.avg("l_quantity"), 4).alias("avg_quantity"),
        F.max("l_extendedprice").alias("max_price"),
        F.sum(cents(F.col("l_extendedprice"))).alias("price_cents"),
        F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity"))).alias("discounted"),
    )


@query(
    "any_value_fd",
    """SELECT o_custkey, any_value(c_mktsegment) AS segment, count(*) AS orders, max(o_orderdate) AS newest
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey""",
)
def _any_value_fd(spark, folder):
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return dimension_join(table(spark, folder, "orders"), customers, "o_custkey", ["c_mktsegment"]).groupBy(
        "o_custkey"
    ).agg(
        F.any_value("c_mktsegment", ignoreNulls=True).alias("segment"),
        F.count(F.lit(1)).alias("orders"),
        F.max("o_orderdate").alias("newest"),
    )


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _duplicate_keys(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "global_aggregate",
    """SELECT count(*) AS n, coalesce(sum(l_quantity), 0) AS quantity,
              coalesce(sum(l_quantity) FILTER (WHERE l_quantity < 0), 0) AS negative,
              stddev_samp(l_quantity) IS NOT NULL AS has_sd
       FROM lineitem""",
)
def _global_aggregate(spark, folder):
    return table(spark, folder, "lineitem").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("quantity"),
        F.coalesce(F.sum(F.when(F.col("l_quantity") < 0, F.col("l_quantity"))), F.lit(0.0)).alias("negative"),
        F.stddev_samp("l_quantity").isNotNull().alias("has_sd"),
    )


# --- windows --------------------------------------------------------------


@query(
    "dense_rank_in_day",
    """SELECT day, event_type, amount, dense_rank() OVER (PARTITION BY day ORDER BY amount DESC) AS rank_in_day
       FROM (SELECT CAST(ts AS DATE) AS day, event_type,
                    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount
             FROM events GROUP BY ALL)""",
)
def _dense_rank_in_day(spark, folder):
    daily = table(spark, folder, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.sum(cents(F.col("value"))).alias("amount")
    )
    return dense_rank_within(daily, ["day"], "amount", "rank_in_day")


@query(
    "dense_rank_quantity",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_returnflag, l_quantity,
              dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS quantity_rank
       FROM lineitem""",
)
def _dense_rank_quantity(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag", "l_quantity"
    )
    return dense_rank_within(lines, ["l_returnflag"], "l_quantity", "quantity_rank")


_SCORED_SQL = """
spent AS (
    SELECT user_id, c_mktsegment, sum(floor(value)) AS kwh
    FROM events, customer WHERE user_id = c_custkey GROUP BY 1, 2
),
peers AS (SELECT c_mktsegment, avg(kwh) AS region_avg, stddev_samp(kwh) AS region_sd FROM spent GROUP BY 1),
scored AS (
    SELECT s.*, p.region_avg, p.region_sd, round((s.kwh - p.region_avg) / nullif(p.region_sd, 0), 3) AS z_score,
           list_extract(['normal', 'watch', 'severe'],
                        1 + coalesce(abs(s.kwh - p.region_avg) / nullif(p.region_sd, 0) >= 2, false)::INTEGER
                          + coalesce(abs(s.kwh - p.region_avg) / nullif(p.region_sd, 0) >= 3, false)::INTEGER) AS anomaly_band,
           (SELECT count(*) FROM spent o WHERE o.c_mktsegment = s.c_mktsegment AND o.kwh > s.kwh) AS ahead
    FROM spent s JOIN peers p USING (c_mktsegment)
)"""


def _scored(spark, folder):
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "user_id")
    per_user = (
        dimension_join(table(spark, folder, "events"), customers, "user_id", ["c_mktsegment"])
        .groupBy("user_id", "c_mktsegment")
        .agg(F.sum(F.floor("value").cast("double")).alias("kwh"))
    )
    return score_against_group(
        per_user, ["c_mktsegment"], "kwh", top_n=5, mean="region_avg", deviation="region_sd"
    )


@query(
    "partition_stats_zscore",
    f"""WITH {_SCORED_SQL}
    SELECT user_id, c_mktsegment, kwh, round(region_avg, 4) AS region_avg, round(region_sd, 4) AS region_sd,
           z_score, anomaly_band FROM scored""",
)
def _partition_stats_zscore(spark, folder):
    return _scored(spark, folder).select(
        "user_id", "c_mktsegment", "kwh", round_to(F.col("region_avg"), 4).alias("region_avg"),
        round_to(F.col("region_sd"), 4).alias("region_sd"), "z_score", "anomaly_band",
    )


@query(
    "top_n_or_flag",
    f"""WITH {_SCORED_SQL}
    SELECT user_id, c_mktsegment, kwh, z_score, anomaly_band FROM scored
    WHERE ahead < 5 OR anomaly_band IN ('watch', 'severe')""",
)
def _top_n_or_flag(spark, folder):
    scored = _scored(spark, folder)
    return scored.filter((F.col("anomaly_band") != "normal") | F.col("is_leader")).select(
        "user_id", "c_mktsegment", "kwh", "z_score", "anomaly_band"
    )


# --- sorts, limits, distinct, latest --------------------------------------


@query(
    "topk_abs",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 20",
)
def _topk_abs(spark, folder):
    return (
        table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
        .orderBy(F.abs("c_acctbal").desc(), "c_custkey").limit(20)
    )


@query(
    "order_by_ordinal",
    "SELECT n_regionkey, n_name FROM nation ORDER BY 1, 2",
)
def _order_by_ordinal(spark, folder):
    return table(spark, folder, "nation").select("n_regionkey", "n_name").orderBy(1, 2)


@query("select_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority, '->' AS dir FROM orders")
def _select_distinct(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderstatus", "o_orderpriority", F.lit("->").alias("dir")
    ).distinct()


@query(
    "latest_run_rows",
    """SELECT event_id, user_id, ts, event_type FROM events
       WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)""",
)
def _latest_run_rows(spark, folder):
    events = table(spark, folder, "events")
    # One row, so its size is certain.
    newest = events.agg(F.max_by("user_id", F.struct("ts", "event_id")).alias("user_id"))
    return events.join(F.broadcast(newest), "user_id", "left_semi").select(
        "event_id", "user_id", "ts", "event_type"
    )


@query(
    "latest_row",
    "SELECT event_id, user_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1",
)
def _latest_row(spark, folder):
    row = F.struct("event_id", "user_id", "ts", "value")
    return table(spark, folder, "events").agg(
        F.max_by(row, F.struct("ts", "event_id")).alias("row")
    ).select("row.*")


@query(
    "rows_not_in_list",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE o_orderstatus NOT IN ('F', 'O') AND o_orderpriority <> '5-LOW' AND o_totalprice > 1000""",
)
def _rows_not_in_list(spark, folder):
    return table(spark, folder, "orders").filter(
        ~F.col("o_orderstatus").isin("F", "O")
        & (F.col("o_orderpriority") != "5-LOW") & (F.col("o_totalprice") > 1000)
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")
