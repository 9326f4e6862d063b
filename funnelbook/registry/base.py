"""Test tables, the views that stand for the engine's inputs, and the registration of queries.

A view is plain SQL that Spark and DuckDB read alike; ``{name}`` refers to a table or view.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.windows import resolve_window

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

# Windows that cover every row of the tables at each scale.
ADS_START, ADS_END = resolve_window(date(2002, 1, 1), 2600)
VISITS_START, VISITS_END = resolve_window(date(2024, 2, 1), 60)

VIEWS = {
    # source side of the ads comparison: one report row per line item
    "ads_src": """
        SELECT 'c' || CAST(l_suppkey AS STRING) AS client, CAST(l_shipdate AS DATE) AS dt,
               CAST(l_quantity AS BIGINT) AS impressions, CAST(l_linenumber AS BIGINT) AS clicks,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS cost, CAST(l_linenumber AS BIGINT) AS goal_id,
               CAST(l_quantity AS BIGINT) % 3 AS conv, l_returnflag AS network, l_linestatus AS slot,
               l_orderkey AS campaign_id, l_partkey AS group_id, l_discount AS mark_a, l_tax AS mark_b
        FROM {lineitem}""",
    # warehouse side: rows that vanished, click and cost drift, goal 7 unknown, client c9 never loaded
    "ads_wh": """
        SELECT client, dt, impressions,
               clicks + CASE WHEN mark_a = 0.09 AND mark_b = 0.07 THEN 1 ELSE 0 END AS clicks,
               CAST(cost + CASE WHEN mark_a = 0.05 AND mark_b = 0.02 THEN 600 ELSE 0 END AS DECIMAL(18,2)) AS cost,
               NULLIF(goal_id, 7) AS goal_id,
               conv + CASE WHEN mark_a = 0.02 AND mark_b = 0.03 THEN 1 ELSE 0 END AS conv,
               network, slot, campaign_id, group_id, mark_a, mark_b
        FROM {ads_src} WHERE NOT (mark_a = 0.04 AND mark_b = 0.06) AND client <> 'c9'""",
    # one event = one visit; goal 4 of client m_2 cannot be read at the source
    "vis_src": """
        SELECT client, visit_id, ts, CAST(ts AS DATE) AS dt,
               CASE WHEN client = 'm_2' THEN NULLIF(goal_all, 4) ELSE goal_all END AS goal_id, goal_all,
               user_id, event_type, value, props
        FROM (SELECT 'm_' || CAST(user_id % 10 AS STRING) AS client, event_id AS visit_id, ts,
                     CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 4
                          WHEN 'error' THEN 5 END AS goal_all, user_id, event_type, value, props
              FROM {events}) e""",
    # warehouse side: large visits not there yet, some goals lost, goal 5 unknown to clients m_5 .. m_9
    "vis_wh": """
        SELECT client, visit_id, ts, dt,
               CASE WHEN value > 170 AND value < 172 THEN NULL
                    WHEN user_id % 10 >= 5 THEN NULLIF(goal_all, 5) ELSE goal_all END AS goal_id,
               user_id, event_type, value, props
        FROM {vis_src} WHERE value < 250""",
    # ads of a dozen clients as their landed reports say them, and what the warehouse has of them
    "rep_src": """
        SELECT 'r' || CAST(l_suppkey % 12 AS STRING) AS client, CAST(l_shipdate AS DATE) AS dt, l_returnflag AS network,
               CAST(l_quantity AS BIGINT) AS impressions, CAST(l_linenumber AS BIGINT) AS clicks,
               CAST(FLOOR(l_extendedprice) AS BIGINT) AS cost, CAST(l_linenumber AS BIGINT) AS goal_id, CAST(l_quantity AS BIGINT) % 3 AS conv,
               l_suppkey % 12 AS number, l_discount AS mark_a, l_tax AS mark_b
        FROM {lineitem}""",
    # days before 1994 are outside of the comparison; goal 6 rests since then, and goal 7 was never loaded
    "rep_wh": """
        SELECT client, dt, CASE WHEN goal_id = 7 OR (goal_id = 6 AND dt >= DATE '1994-01-01') THEN NULL ELSE goal_id END AS goal_id, impressions,
               clicks + CASE WHEN mark_a = 0.09 AND mark_b = 0.07 AND network = 'A' THEN 1 ELSE 0 END AS clicks, CAST(cost AS DOUBLE) AS cost, conv
        FROM {rep_src} WHERE NOT (mark_a = 0.04 AND mark_b = 0.06 AND network = 'R') AND client <> 'r9'""",
    # visit report: the events of a user and day are the report rows of one visit
    "report": """
        SELECT client, CAST(user_id AS STRING) || '-' || CAST(dt AS STRING) AS visit_id, visit_id AS pos,
               event_type AS interest,
               CASE WHEN value < 20 THEN NULL WHEN value < 60 THEN 'male' ELSE 'female' END AS gender,
               CASE WHEN event_type = 'view' THEN NULL ELSE event_type || '-area' END AS area,
               CASE WHEN value < 30 THEN NULL ELSE CAST(FLOOR(value) AS BIGINT) END AS user_visits
        FROM {vis_src}""",
    # visit log: one row per visit with list literals; users with an error-only day are not in the log
    "vis_log": """
        SELECT client, visit_id, first_ts, duration, page_views, device,
               '[' || substring(coalesce(repeat(',1', n1), '') || coalesce(repeat(',2', n2), '') || coalesce(repeat(',4', n4), '')
                   || coalesce(repeat(',5', n5), '') || coalesce(repeat(',1', n1), ''), 2) || ']' AS goals_id,
               '[' || substring(coalesce(repeat(',' || chr(39) || t1 || chr(39), n1), '')
                   || coalesce(repeat(',' || chr(39) || t2 || chr(39), n2), '')
                   || coalesce(repeat(',' || chr(39) || t4 || chr(39), n4), '')
                   || coalesce(repeat(',' || chr(39) || 'bad' || chr(39), n5), ''), 2) || ']' AS goals_time
        FROM (SELECT client, CAST(user_id AS STRING) || '-' || CAST(dt AS STRING) AS visit_id,
                     CAST(date_trunc('second', MIN(ts)) AS STRING) AS first_ts,
                     CAST(SUM(CAST(FLOOR(value) AS BIGINT)) AS BIGINT) AS duration, CAST(COUNT(*) AS BIGINT) AS page_views,
                     MAX(CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 1 ELSE 0 END) AS device,
                     CAST(SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS INT) AS n1,
                     CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS n2,
                     CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS INT) AS n4,
                     CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS INT) AS n5,
                     CAST(date_trunc('second', MIN(CASE WHEN event_type = 'signup' THEN ts END)) AS STRING) AS t1,
                     CAST(date_trunc('second', MIN(CASE WHEN event_type = 'purchase' THEN ts END)) AS STRING) AS t2,
                     CAST(date_trunc('second', MIN(CASE WHEN event_type = 'click' THEN ts END)) AS STRING) AS t4
              FROM {vis_src} GROUP BY client, user_id, dt) s
        WHERE n1 + n2 + n4 + device > 0""",
    # goals of each client as listed at the source
    "goal_names": """
        SELECT DISTINCT client, CAST(goal_all AS STRING) AS id,
               CASE WHEN goal_all IN (1, 2) THEN 'mADD lead' ELSE 'Other' END AS name
        FROM {vis_src} WHERE goal_all IS NOT NULL AND NOT (client = 'm_4' AND goal_all = 4)""",
    # credentials: repeated logins in several spellings, agencies, numeric counters, rows without token
    "access": """
        SELECT CASE WHEN c_acctbal < -900 THEN NULL
                    WHEN c_mktsegment = 'BUILDING' THEN CAST(c_custkey AS STRING)
                    WHEN c_mktsegment = 'MACHINERY' THEN 'shop_' || n_name || '.' || CAST(c_custkey % 500 AS STRING)
                    ELSE 'shop-' || n_name || '-' || CAST(c_custkey % 500 AS STRING) END AS login,
               CASE WHEN c_acctbal > 9800 THEN NULL ELSE 'tok-' || CAST(c_custkey AS STRING) END AS token,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE n_name END AS container,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'visits' WHEN 'MACHINERY' THEN 'ads:agency_parsed'
                    WHEN 'HOUSEHOLD' THEN 'ads:not_agency_token' WHEN 'AUTOMOBILE' THEN 'visits:agency' END AS type,
               c_custkey AS seq
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    # run log
    "runs": """
        SELECT event_id AS id, event_type AS state, ts AS end_time,
               CASE WHEN user_id % 5 = 0 THEN 'admin_bot' ELSE 'auto' END AS tag, user_id
        FROM {events}""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{sf}/{name}.parquet"
    if (sf, name) not in _SCHEMAS:
        _SCHEMAS[sf, name] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[sf, name]).parquet(path)


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    text = VIEWS[name]
    refs = {r: table(spark, sf, r) if r in TABLES else view(spark, sf, r) for r in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **refs)


def _with_views(body: str) -> str:
    """The statement with the views it needs as leading common table expressions, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for r in re.findall(r"\{(\w+)\}", text):
            if r in VIEWS and r not in order:
                need(VIEWS[r])
                order.append(r)

    need(body)
    plain = {r: re.sub(r"\{(\w+)\}", r"\1", VIEWS[r]) for r in order}
    body = re.sub(r"\{(\w+)\}", r"\1", body).strip()
    ctes = ", ".join(f"{r} AS ({t})" for r, t in plain.items())
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.startswith("WITH ") else f"WITH {ctes} {body}"


def days_as_text(df: DataFrame) -> DataFrame:
    """Days and times as text, the form in which both engines print them alike."""
    return df.select(*[F.col(c).cast("string").alias(c) if t.startswith(("date", "timestamp")) else F.col(c) for c, t in df.dtypes])


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the same question in SQL."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf: days_as_text(fn(spark, sf))
        if oracle is not None:
            ORACLES[name] = _with_views(oracle)
        return fn

    return register
