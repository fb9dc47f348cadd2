"""One query per operator, straight on the given tables, each next to its reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aprisco.functions import date_dimension, not_excluded_id, not_test_name, repair_mojibake
from aprisco.functions.columns import MOJIBAKE, is_valid_row
from aprisco.operators import (
    as_dimension,
    asof_version_join,
    check_snapshot,
    current_versions,
    daily_rollup,
    full_outer_merge,
    join_calendar,
    replay_snapshots,
    star_join,
)
from aprisco.quality import (
    accepted_values,
    column_metrics,
    count_reconciliation,
    daily_loads,
    freshness,
    freshness_metrics,
    ledger_reconciliation,
    not_null,
    not_null_within,
    relationships,
    score_anomalies,
    unique,
    volume_metrics,
)
from testbed.model_queries import calendar_sql, scored_sql, volume_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CALENDAR = (date(1995, 1, 1), date(2002, 1, 1))
NOW = datetime(2024, 2, 10)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name, with its reference SQL."""
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def day(column: str):
    return F.col(column).cast("date")


def money(column: str, digits: int = 2):
    return F.col(column).cast(f"decimal(18,{digits})")


# --- projection and filter -----------------------------------------------------------------

@query("""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_day, o_totalprice
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority NOT LIKE '5-%'
""")
def valid_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").where(
        is_valid_row("o_orderstatus", "F") & not_test_name("o_orderpriority", "5-")
    )
    return rows.select("o_orderkey", "o_custkey", day("o_orderdate").alias("order_day"),
                       "o_totalprice")


@query("""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
""")
def exclude_ids(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    return rows.where(not_excluded_id("c_mktsegment", ("BUILDING", "MACHINERY"))).select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query("""
WITH d AS (SELECT doc_id, replace(replace(replace(replace(replace(text,
  'ñ', 'Ã±'), 'í', concat('Ã', chr(173))),
  'ó', 'Ã³'), 'é', 'Ã©'),
  'á', 'Ã¡') AS damaged FROM documents)
SELECT doc_id, damaged, replace(replace(replace(replace(replace(damaged,
  'Ã±', 'ñ'), concat('Ã', chr(173)), 'í'),
  'Ã³', 'ó'), 'Ã©', 'é'),
  'Ã¡', 'á') AS repaired FROM d
""")
def mojibake_repair(spark, sf_dir):
    """The texts are sound, so they are damaged first."""
    damaged = F.col("text")
    for wrong, right in MOJIBAKE:
        damaged = F.replace(damaged, F.lit(right), F.lit(wrong))
    return (
        read(spark, sf_dir, "documents")
        .select("doc_id", damaged.alias("damaged"))
        .withColumn("repaired", repair_mojibake("damaged"))
    )


# --- calendar and star joins ---------------------------------------------------------------

@query(f"""
WITH cal AS ({calendar_sql('1995-01-01', '2002-01-01')}),
n AS (SELECT CAST(l_shipdate AS DATE) AS fecha, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT cal.*, n.n_lines FROM cal LEFT JOIN n USING (fecha)
""", name="date_dimension")
def date_dimension_activity(spark, sf_dir):
    """Every calendar day with all its labels and the lines shipped on it, if any."""
    lines = read(spark, sf_dir, "lineitem").groupBy(day("l_shipdate").alias("fecha")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    return date_dimension(spark, *CALENDAR).join(lines, "fecha", "left")


@query(f"""
WITH cal AS ({calendar_sql('1995-01-01', '2001-01-01')})
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, dia_semana_nombre, estacion, c_name,
       c_mktsegment, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN cal ON CAST(o_orderdate AS DATE) = fecha
""")
def star_recent(spark, sf_dir):
    """Orders with customer and calendar labels; the calendar ends before the last orders."""
    orders = read(spark, sf_dir, "orders").withColumn("order_day", day("o_orderdate"))
    rows = star_join(
        orders, read(spark, sf_dir, "customer"), "o_custkey", "c_custkey",
        ["c_name", "c_mktsegment"],
    )
    calendar = date_dimension(spark, CALENDAR[0], date(2001, 1, 1))
    rows = join_calendar(rows, calendar, "order_day", ["dia_semana_nombre", "estacion"])
    return rows.select("o_orderkey", "order_day", "dia_semana_nombre", "estacion", "c_name",
                       "c_mktsegment", "o_totalprice")


@query("""
SELECT c_custkey, c_name, n_name, n_regionkey
FROM customer JOIN nation ON n_name = concat('NATION_', c_nationkey)
""")
def star_by_name(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").withColumn(
        "nation_name", F.concat(F.lit("NATION_"), F.col("c_nationkey"))
    )
    rows = star_join(customers, read(spark, sf_dir, "nation"), "nation_name", "n_name",
                     {"n_name": "n_name", "n_regionkey": "n_regionkey"})
    return rows.select("c_custkey", "c_name", "n_name", "n_regionkey")


# --- merge and rollup ----------------------------------------------------------------------

@query("""
WITH v AS (SELECT user_id, CAST(ts AS DATE) AS event_day, count(*) AS n_views,
             sum(CAST(value AS DECIMAL(18,4))) AS view_value
           FROM events WHERE event_type = 'view' GROUP BY 1, 2),
c AS (SELECT user_id, CAST(ts AS DATE) AS event_day, count(*) AS n_clicks,
             sum(CAST(value AS DECIMAL(18,4))) AS click_value
      FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT coalesce(v.user_id, c.user_id) AS user_id, coalesce(v.event_day, c.event_day) AS event_day,
       n_views, view_value, n_clicks, click_value, c_name
FROM v FULL JOIN c ON v.user_id = c.user_id AND v.event_day = c.event_day
JOIN customer ON c_custkey = coalesce(v.user_id, c.user_id)
""")
def quality_merge(spark, sf_dir):
    """Views and clicks of a user and day side by side, whichever of them there were."""
    events = read(spark, sf_dir, "events").withColumn("event_day", day("ts"))

    def daily(kind: str) -> DataFrame:
        return events.where(F.col("event_type") == kind).groupBy("user_id", "event_day").agg(
            F.count(F.lit(1)).alias(f"n_{kind}s"), F.sum(money("value", 4)).alias(f"{kind}_value")
        )

    rows = full_outer_merge(
        daily("view"), daily("click"), ["user_id", "event_day"], one_row_per_key=True
    )
    return star_join(rows, read(spark, sf_dir, "customer"), "user_id", "c_custkey", ["c_name"])


@query("""
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_day, b.event_day) AS event_day,
       a.event_id AS purchase_id, b.event_id AS error_id
FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS event_day FROM events
      WHERE event_type = 'purchase') a
FULL JOIN (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS user_id,
           CAST(ts AS DATE) AS event_day FROM events WHERE event_type = 'error') b
  ON a.user_id = b.user_id AND a.event_day = b.event_day
""")
def merge_with_fan_out(spark, sf_dir):
    """Rows as they are: several matches multiply, and rows with a NULL key stay alone."""
    events = read(spark, sf_dir, "events").withColumn("event_day", day("ts"))
    keys = ["user_id", "event_day"]
    purchases = events.where("event_type = 'purchase'").select(
        *keys, F.col("event_id").alias("purchase_id")
    )
    errors = events.where("event_type = 'error'").select(
        F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id"), "event_day",
        F.col("event_id").alias("error_id"),
    )
    return full_outer_merge(purchases, errors, keys)


@query("""
SELECT n_name, CAST(l_shipdate AS DATE) AS ship_day, l_returnflag,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_price,
       count(*) AS n_lines
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY 1, 2, 3
""", name="daily_rollup")
def daily_rollup_by_nation(spark, sf_dir):
    suppliers = star_join(
        read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation"),
        "s_nationkey", "n_nationkey", ["n_name"],
    )
    lines = read(spark, sf_dir, "lineitem").withColumn("ship_day", day("l_shipdate"))
    return daily_rollup(
        lines, suppliers, fact_key="l_suppkey", dim_key="s_suppkey", dim_name="n_name",
        group_by=["ship_day", "l_returnflag"], amount=money("l_extendedprice"),
        total="total_price", count="n_lines",
    )


# --- history -------------------------------------------------------------------------------

# The last event of a user and day stands for the state of the user in that day's copy.
def daily_state(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    events = read(spark, sf_dir, "events")
    if kind:
        events = events.where(F.col("event_type") == kind)
    latest = F.struct("ts", "event_id")
    return events.groupBy("user_id", day("ts").alias("event_day")).agg(
        F.max_by("event_type", latest).alias("event_type"),
        F.max_by("value", latest).alias("value"),
        F.max("ts").alias("last_ts"),
    )


DAILY_STATE = """
daily AS (SELECT user_id, CAST(ts AS DATE) AS event_day, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                             ORDER BY ts DESC, event_id DESC) = 1)"""

REPLAY = f"""
{DAILY_STATE},
marked AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS nth FROM daily
  WINDOW w AS (PARTITION BY user_id ORDER BY event_day)),
starts AS (SELECT user_id, event_type, value, CAST(event_day AS TIMESTAMP) AS dbt_valid_from
  FROM marked WHERE nth = 1 OR event_type IS DISTINCT FROM before),
history AS (SELECT *, lead(dbt_valid_from) OVER (PARTITION BY user_id ORDER BY dbt_valid_from)
    AS dbt_valid_to,
  md5(concat(user_id, '|', strftime(dbt_valid_from, '%Y-%m-%d %H:%M:%S.%f'))) AS dbt_scd_id
  FROM starts)"""


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = daily_state(spark, sf_dir).select(
        "user_id", "event_type", "value", F.col("event_day").cast("timestamp_ntz").alias("batch_ts")
    )
    return replay_snapshots(batches, "user_id", ["event_type"], "batch_ts")


@query(f"WITH {REPLAY} SELECT * FROM history")
def snapshot_replay(spark, sf_dir):
    return user_history(spark, sf_dir)


@query(f"""
WITH {REPLAY}
SELECT dbt_scd_id AS sk_user, user_id, event_type, value, dbt_valid_from AS vigente_desde,
       dbt_valid_to AS vigente_hasta, dbt_valid_to IS NULL AS vigente
FROM history
""")
def scd2_dimension(spark, sf_dir):
    return as_dimension(user_history(spark, sf_dir), "sk_user", ["user_id", "event_type", "value"])


@query(f"""
WITH {REPLAY}
SELECT dbt_scd_id AS sk_user, user_id, event_type AS estado, dbt_valid_from AS vigente_desde,
       dbt_valid_to AS vigente_hasta, dbt_valid_to IS NULL AS vigente
FROM history WHERE dbt_valid_to IS NULL AND event_type = 'purchase'
""")
def scd2_current(spark, sf_dir):
    dimension = as_dimension(
        user_history(spark, sf_dir), "sk_user", {"user_id": "user_id", "event_type": "estado"}
    )
    return current_versions(dimension, "purchase")


SNAPSHOT_RUNS = (datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 13), datetime(2024, 1, 1, 20))


@query(f"""
WITH b AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, TIMESTAMP '{SNAPSHOT_RUNS[0]}' AS run
    FROM customer WHERE c_nationkey <> 7
  UNION ALL SELECT c_custkey, c_name,
    CASE WHEN c_nationkey < 9 THEN c_mktsegment || '-2' ELSE c_mktsegment END,
    c_acctbal + 1, TIMESTAMP '{SNAPSHOT_RUNS[1]}' FROM customer WHERE c_nationkey <> 11
  UNION ALL SELECT c_custkey, c_name,
    CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
         WHEN c_nationkey < 9 THEN c_mktsegment || '-2' ELSE c_mktsegment END,
    c_acctbal + 1 + 1, TIMESTAMP '{SNAPSHOT_RUNS[2]}' FROM customer
    WHERE c_nationkey <> 11 AND c_acctbal + 1 > 1),
m AS (SELECT *, lag(c_mktsegment) OVER w AS before, row_number() OVER w AS nth FROM b
  WINDOW w AS (PARTITION BY c_custkey ORDER BY run))
SELECT c_custkey, c_name, c_mktsegment, c_acctbal, run AS dbt_valid_from,
  lead(run) OVER (PARTITION BY c_custkey ORDER BY run) AS dbt_valid_to,
  md5(concat(c_custkey, '|', strftime(run, '%Y-%m-%d %H:%M:%S.%f'))) AS dbt_scd_id
FROM m WHERE nth = 1 OR c_mktsegment IS DISTINCT FROM before
""")
def snapshot_merge(spark, sf_dir):
    """Three snapshot runs over customers.

    The first does not see one nation yet. By the second another nation is gone, nations below
    9 moved to other segments, and every balance changed, which is not tracked. In the third
    the builders lost their segment, and who owes money is gone.
    """
    customers = read(spark, sf_dir, "customer")
    nation, segment, balance = (F.col(c) for c in ("c_nationkey", "c_mktsegment", "c_acctbal"))
    builders = segment.startswith("BUILDING")
    second = customers.where(nation != 11).withColumns({
        "c_mktsegment": F.when(nation < 9, F.concat(segment, F.lit("-2"))).otherwise(segment),
        "c_acctbal": balance + 1,
    })
    third = second.where(balance > 1).withColumns({
        "c_mktsegment": F.when(~builders, segment),
        "c_acctbal": balance + 1,
    })
    history = None
    for copy, run_ts in zip((customers.where(nation != 7), second, third), SNAPSHOT_RUNS,
                            strict=True):
        history = check_snapshot(
            history, copy.drop("c_nationkey"), "c_custkey", ["c_mktsegment"], run_ts
        )
    return history


@query(f"""
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS d, ts, event_id, value FROM events
  WHERE event_type = 'signup' AND user_id NOT IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
  QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1),
m AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM s),
v AS (SELECT user_id, value, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts)
  AS valid_to FROM m WHERE value IS DISTINCT FROM before),
p AS (SELECT event_id, user_id, CAST(ts AS DATE) AS event_day FROM events
  WHERE event_type = 'purchase'),
c AS (SELECT p.*, v.value AS signup_value, row_number() OVER (PARTITION BY event_id ORDER BY
  CASE WHEN event_day >= valid_from AND (event_day < valid_to OR valid_to IS NULL) THEN 1 ELSE 2
  END, valid_from NULLS FIRST) AS rn FROM p LEFT JOIN v ON p.user_id = v.user_id)
SELECT event_id, user_id, event_day, signup_value FROM c WHERE rn = 1
""")
def asof_version(spark, sf_dir):
    """Purchases with the user's signup state at the time; builders have no history."""
    builders = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    batches = daily_state(spark, sf_dir, "signup").join(
        builders, F.col("user_id") == F.col("c_custkey"), "left_anti"
    )
    versions = replay_snapshots(
        batches.select("user_id", "value", "last_ts"), "user_id", ["value"], "last_ts"
    )
    purchases = read(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        "event_id", "user_id", day("ts").alias("event_day")
    )
    return asof_version_join(
        purchases, versions, key="user_id", fact_date="event_day", fact_id="event_id",
        attrs={"value": "signup_value"}, version_id="dbt_scd_id",
    )


@query("""
WITH v AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate AS valid_from,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
       ELSE o_orderdate + INTERVAL 1 HOUR * (7 + o_orderkey % 9000) END AS valid_to FROM orders),
f AS (SELECT c_custkey, CAST(CAST('1996-01-01' AS DATE) + CAST(c_custkey * 37 % 2000 AS INT) AS DATE)
  AS visit_day FROM customer),
c AS (SELECT f.*, v.o_orderpriority AS priority, v.o_orderkey AS version,
  row_number() OVER (PARTITION BY c_custkey ORDER BY
    CASE WHEN visit_day >= valid_from AND (visit_day < valid_to OR valid_to IS NULL) THEN 1 ELSE 2
    END, valid_from NULLS FIRST, o_orderkey NULLS FIRST) AS rn
  FROM f LEFT JOIN v ON c_custkey = o_custkey)
SELECT c_custkey, visit_day, priority, version FROM c WHERE rn = 1
""")
def asof_overlapping(spark, sf_dir):
    """Orders as versions that overlap: the oldest valid one wins, ties go to the lower key."""
    start = F.col("o_orderdate")
    versions = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", start.alias("valid_from"),
        F.when(
            F.col("o_orderkey") % 5 != 0,
            start + F.make_dt_interval(hours=(7 + F.col("o_orderkey") % 9000).cast("int")),
        ).alias("valid_to"),
    )
    visits = read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.date_add(F.lit(date(1996, 1, 1)), (F.col("c_custkey") * 37 % 2000).cast("int")).alias(
            "visit_day"
        ),
    )
    return asof_version_join(
        visits, versions, key="c_custkey", version_key="o_custkey", fact_date="visit_day",
        fact_id="c_custkey", attrs={"o_orderpriority": "priority", "o_orderkey": "version"},
        valid_from="valid_from", valid_to="valid_to", version_id="o_orderkey", unique_facts=True,
    )


@query("""
WITH v AS (SELECT o_custkey, o_orderkey,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS valid_from,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL 400 DAY END AS valid_to
  FROM orders),
f AS (SELECT c_custkey, CAST(CASE c_custkey % 5 WHEN 0 THEN DATE '9999-12-31' WHEN 1 THEN NULL
  ELSE CAST('1996-01-01' AS DATE) + CAST(c_custkey * 37 % 2000 AS INT) END AS DATE) AS visit_day
  FROM customer),
c AS (SELECT f.*, v.o_orderpriority AS priority, v.o_orderkey AS version,
  row_number() OVER (PARTITION BY c_custkey ORDER BY
    CASE WHEN visit_day >= valid_from AND (visit_day < valid_to OR valid_to IS NULL) THEN 1 ELSE 2
    END, valid_from NULLS FIRST, o_orderkey NULLS FIRST) AS rn
  FROM f LEFT JOIN v ON c_custkey = o_custkey)
SELECT c_custkey, visit_day, priority, version FROM c WHERE rn = 1
""")
def asof_odd_versions(spark, sf_dir):
    """Versions without a start and without attributes, facts on the last date there is."""
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    versions = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey",
        F.when(key % 9 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(key % 4 != 0, start).alias("valid_from"),
        F.when(key % 3 != 0, start + F.make_dt_interval(days=F.lit(400))).alias("valid_to"),
    )
    visitor = F.col("c_custkey")
    day_ = F.date_add(F.lit(date(1996, 1, 1)), (visitor * 37 % 2000).cast("int"))
    visits = read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(visitor % 5 == 0, F.lit(date(9999, 12, 31))).when(visitor % 5 != 1, day_).alias("visit_day"),
    )
    return asof_version_join(
        visits, versions, key="c_custkey", version_key="o_custkey", fact_date="visit_day",
        fact_id="c_custkey", attrs={"o_orderpriority": "priority", "o_orderkey": "version"},
        valid_from="valid_from", valid_to="valid_to", version_id="o_orderkey",
    )


# --- checks --------------------------------------------------------------------------------

@query("""
SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1
""")
def check_unique(spark, sf_dir):
    return unique(read(spark, sf_dir, "lineitem"), "l_orderkey")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
""")
def check_unique_composite(spark, sf_dir):
    return unique(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) AS discount FROM lineitem
WHERE nullif(l_discount, 0) IS NULL
""")
def check_not_null(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
    )
    return not_null(lines, "discount")


@query("""
SELECT count(*) AS n_rows, count_if(nullif(l_discount, 0) IS NULL) AS n_null,
       round(count_if(nullif(l_discount, 0) IS NULL) / count(*), 6) AS null_fraction
FROM lineitem WHERE l_returnflag = 'R'
HAVING count_if(nullif(l_discount, 0) IS NULL) > 0.01 * count(*)
""")
def check_not_null_if(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumn(
        "discount", F.nullif(F.col("l_discount"), F.lit(0.0))
    )
    return not_null_within(lines, "discount", 0.01, F.col("l_returnflag") == "R")


@query("""
SELECT event_type, count(*) AS n_records FROM events
WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view') GROUP BY 1
""")
def check_accepted_values(spark, sf_dir):
    return accepted_values(
        read(spark, sf_dir, "events"), "event_type", ("click", "purchase", "signup", "view")
    )


@query("""
SELECT o_custkey, count(*) AS n_records FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1
""")
def check_relationships(spark, sf_dir):
    parents = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return relationships(read(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey")


RECONCILED = {
    "customer": "c_custkey >= 0",
    "events": "event_type <> 'error'",
    "lineitem": "l_quantity < 50",
    "orders": "o_orderstatus <> 'P'",
    "part": "p_size > 0",
}


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS tabla, a AS conteo_raw, b AS conteo_operacional, a - b AS diferencia FROM "
    f"(SELECT count(*) FILTER ({live}) AS a, count(*) AS b FROM {t}) WHERE a <> b"
    for t, live in RECONCILED.items()
))
def reconcile_counts(spark, sf_dir):
    """Replicas that lost rows against the whole tables; two of them lost none."""
    return count_reconciliation({
        t: (read(spark, sf_dir, t).where(kept), read(spark, sf_dir, t))
        for t, kept in RECONCILED.items()
    })


LINE_AMOUNT = "CAST(l_extendedprice AS DECIMAL(18,2))"


@query(f"""
WITH t AS (SELECT l_orderkey, sum({LINE_AMOUNT}) AS suma FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(suma + CASE WHEN o_orderkey % 7 = 0 THEN 0.01 ELSE 0.00001 END
       AS DECIMAL(38,9)) AS balance, CAST(suma AS DECIMAL(38,2)) AS suma_ledger,
       CAST(0.01 AS DECIMAL(38,4)) AS diferencia
FROM orders JOIN t ON o_orderkey = l_orderkey WHERE o_orderkey % 7 = 0
""")
def ledger_vs_balance(spark, sf_dir):
    """Cached balances off by a cent where the key divides by 7, and elsewhere by less than counts."""
    lines = read(spark, sf_dir, "lineitem").withColumn("amount", money("l_extendedprice"))
    cached = lines.groupBy("l_orderkey").agg(F.sum("amount").alias("suma"))
    off = F.when(F.col("o_orderkey") % 7 == 0, F.lit("0.01")).otherwise(F.lit("0.00001"))
    orders = (
        read(spark, sf_dir, "orders")
        .join(cached, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("o_orderkey", (F.col("suma") + off.cast("decimal(18,9)")).cast("decimal(38,9)")
                .alias("balance"))
    )
    return ledger_reconciliation(
        orders, lines, key="o_orderkey", ledger_key="l_orderkey", balance="balance",
        amount="amount",
    )


@query(f"""
WITH t AS (SELECT l_orderkey, sum({LINE_AMOUNT}) AS suma FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
       CAST(suma AS DECIMAL(38,2)) AS suma_ledger,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) - suma AS DECIMAL(38,4)) AS diferencia
FROM orders JOIN t ON o_orderkey = l_orderkey WHERE CAST(o_totalprice AS DECIMAL(18,2)) <> suma
""")
def ledger_vs_orders(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumn("amount", money("l_extendedprice"))
    orders = read(spark, sf_dir, "orders").withColumn("total", money("o_totalprice"))
    return ledger_reconciliation(
        orders, lines, key="o_orderkey", ledger_key="l_orderkey", balance="total",
        amount="amount", keep=["o_orderstatus"],
    )


LOADS = {
    "events": ("ts", "true", (5, 14)),
    "events_until_21": ("ts", "ts < '2024-01-21'", (14, 45)),
    "lineitem": ("l_shipdate", "true", (5, 14)),
    "none": ("ts", "event_type = 'nothing'", (5, 14)),
    "orders": ("o_orderdate", "true", (14, 45)),
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS tabla, max({stamp}) AS max_loaded_at, "
    f"CASE WHEN max({stamp}) IS NULL THEN 'not_computable' "
    f"WHEN TIMESTAMP '{NOW}' - max({stamp}) > INTERVAL {error} DAY THEN 'error' "
    f"WHEN TIMESTAMP '{NOW}' - max({stamp}) > INTERVAL {warn} DAY THEN 'warn' ELSE 'pass' END "
    f"AS status FROM {name.split('_')[0].replace('none', 'events')} WHERE {kept}"
    for name, (stamp, kept, (warn, error)) in LOADS.items()
), name="freshness")
def source_freshness(spark, sf_dir):
    sources = {}
    for name, (stamp, kept, limits) in LOADS.items():
        table = name.split("_")[0].replace("none", "events")
        sources[name] = (read(spark, sf_dir, table).where(kept), stamp, limits)
    return freshness(sources, NOW)


# --- anomalies -----------------------------------------------------------------------------

VOLUMES = (("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate"))


@query(scored_sql(f"series AS ({' UNION ALL '.join(volume_sql(t, ts) for t, ts in VOLUMES)})"))
def volume_anomaly(spark, sf_dir):
    loads = [daily_loads(read(spark, sf_dir, t), t, ts) for t, ts in VOLUMES]
    return score_anomalies(volume_metrics(reduce(DataFrame.union, loads)))


@query(scored_sql("""l AS (SELECT CAST(ts AS DATE) AS bucket, max(ts) AS t FROM events GROUP BY 1),
g AS (SELECT bucket, epoch_us(t) - lag(epoch_us(t)) OVER (ORDER BY bucket) AS us FROM l),
series AS (SELECT 'events' AS tabla, 'seconds_since_previous_load' AS metrica,
  CAST(NULL AS VARCHAR) AS columna, bucket, CAST(us // 1000000 AS DOUBLE) AS valor FROM g WHERE us IS NOT NULL)
"""))
def freshness_anomaly(spark, sf_dir):
    return score_anomalies(freshness_metrics(daily_loads(read(spark, sf_dir, "events"), "events", "ts")))


PROFILED = {
    "event_id": ("event_id", ""),
    "user_id": ("user_id", ""),
    "event_type": ("length(event_type)", "_length"),
    "value": ("value", ""),
    "props": ("length(props)", "_length"),
}


@query(scored_sql("series AS (" + " UNION ALL ".join(
    f"""SELECT 'events' AS tabla, '{name}' AS metrica, '{column}' AS columna,
  CAST(ts AS DATE) AS bucket, CAST({value} AS DOUBLE) AS valor FROM events GROUP BY 4"""
    for column, (measured, suffix) in PROFILED.items()
    for name, value in (
        ("null_count", f"count_if({column} IS NULL)"),
        ("distinct_count", f"count(DISTINCT {column})"),
        (f"min{suffix}", f"min({measured})"),
        (f"max{suffix}", f"max({measured})"),
    )
) + ")"))
def column_anomaly(spark, sf_dir):
    """Every column of the events, by day, with exact distinct counts."""
    return score_anomalies(
        column_metrics(read(spark, sf_dir, "events"), "events", stamp="ts", exact=True)
    )


# Columns of the order lines and what their range is measured on
LINE_COLUMNS = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey", "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount", "l_tax": "l_tax", "l_returnflag": "length(l_returnflag)",
    "l_linestatus": "length(l_linestatus)",
}


@query(scored_sql("series AS (" + " UNION ALL ".join(
    f"""SELECT 'lineitem' AS tabla, '{name}' AS metrica, '{column}' AS columna,
  CAST(l_shipdate AS DATE) AS bucket, CAST({value} AS DOUBLE) AS valor FROM lineitem GROUP BY 4"""
    for column, measured in LINE_COLUMNS.items()
    for name, value in (
        ("null_count", f"count_if({column} IS NULL)"),
        ("distinct_count", "1"),
        (f"min{'_length' * (measured != column)}", f"min({measured})"),
        (f"max{'_length' * (measured != column)}", f"max({measured})"),
    )
) + ")"))
def column_anomaly_sketched(spark, sf_dir):
    """The same over the order lines with estimated distinct counts, the form for large tables.
    An estimate, of 5 % standard error, is given as 1 if it is within six of these, or two, of the
    exact count, else as 0."""
    lines = read(spark, sf_dir, "lineitem").select(*LINE_COLUMNS, "l_shipdate")
    sketched = column_metrics(lines, "lineitem", stamp="l_shipdate")
    exact = column_metrics(lines, "lineitem", stamp="l_shipdate", exact=True)
    exact = exact.where("metrica = 'distinct_count'").withColumnRenamed("valor", "truth")
    both = sketched.join(exact, ["tabla", "metrica", "columna", "bucket"], "left")
    close = F.abs(F.col("valor") - F.col("truth")) <= F.greatest(F.col("truth") * 0.3, F.lit(2.0))
    value = F.when(F.col("truth").isNull(), F.col("valor")).otherwise(close.cast("double"))
    return score_anomalies(both.withColumn("valor", value).drop("truth"))
