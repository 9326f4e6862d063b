"""Warehouse upkeep on tables written to the shared folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..plans.reload import collapse_ranges
from ..plans.warehouse import Warehouse
from .ads import CHANGED_DAYS_ADS, RANGES, _changes
from .base import query, table, view

LAYOUT = {"buckets": 2, "period": "year"}
ROW = 'client, CAST(dt AS STRING) AS "Date", impressions, clicks, CAST(cost AS DOUBLE) AS cost, COALESCE(goal_id, 0) AS goal_id, conv, network'
COLUMNS = ("client", "Date", "impressions", "clicks", "cost", "goal_id", "conv", "network")


def _rows(spark, sf, name):
    return view(spark, sf, name).withColumnRenamed("dt", "Date").select(*COLUMNS)


def _stored(spark, sf):
    house = Warehouse(spark, **LAYOUT)
    house.write("ads", _rows(spark, sf, "ads_wh"))
    return house


def _out(df):
    return df.withColumn("cost", F.col("cost").cast("double")).fillna(0, ["goal_id"]).select(*COLUMNS)


@query(
    "range_replace",
    CHANGED_DAYS_ADS
    + f""", res AS (SELECT * FROM {{ads_src}} s WHERE EXISTS (SELECT 1 FROM days d WHERE d.client = s.client AND d.dt = s.dt)
          UNION ALL SELECT * FROM {{ads_wh}} w WHERE NOT EXISTS (SELECT 1 FROM days d WHERE d.client = w.client AND d.dt = w.dt))
          SELECT {ROW} FROM res""",
)
def q_range_replace(spark, sf):
    house = _stored(spark, sf)
    house.range_replace("ads", _rows(spark, sf, "ads_src"), collapse_ranges(_changes(spark, sf)))
    return _out(house.read("ads"))


CLIENTS = "SELECT 'c' || CAST(s_suppkey AS STRING) AS client FROM {supplier} WHERE s_acctbal > 0"


def _clients(spark, sf):
    return spark.sql(CLIENTS, supplier=table(spark, sf, "supplier"))


@query(
    "erase_range",
    f"""SELECT {ROW} FROM {{ads_wh}} WHERE NOT (dt BETWEEN DATE '1996-01-15' AND DATE '1999-06-15' AND client IN ({CLIENTS}))""",
)
def q_erase_range(spark, sf):
    house = _stored(spark, sf)
    house.erase_range("ads", _clients(spark, sf), date(1996, 1, 15), date(1999, 6, 15))
    return _out(house.read("ads"))


@query(
    "full_reload",
    f"""SELECT {ROW} FROM {{ads_wh}} WHERE NOT dt BETWEEN DATE '1997-02-10' AND DATE '1998-03-20'
        UNION ALL SELECT {ROW} FROM {{ads_src}} WHERE dt BETWEEN DATE '1997-02-10' AND DATE '1998-03-20'""",
)
def q_full_reload(spark, sf):
    house = _stored(spark, sf)
    house.full_reload("ads", _rows(spark, sf, "ads_src"), date(1997, 2, 10), date(1998, 3, 20))
    return _out(house.read("ads"))


@query("cleanup_clients", f"SELECT {ROW} FROM {{ads_wh}} WHERE client NOT IN ({CLIENTS})")
def q_cleanup_clients(spark, sf):
    house = _stored(spark, sf)
    house.cleanup_clients(_clients(spark, sf), ["ads"])
    return _out(house.read("ads"))


@query("append_roundtrip", f"SELECT {ROW}, CASE WHEN network = 'A' THEN '-' ELSE slot END AS slot FROM {{ads_wh}}")
def q_append_roundtrip(spark, sf):
    rows = view(spark, sf, "ads_wh").withColumnRenamed("dt", "Date").select(*COLUMNS, "slot")
    house = Warehouse(spark, **LAYOUT)
    house.write("ads", rows.where("network = 'A'").drop("slot"))
    house.write("ads", rows.where("network <> 'A'"))
    return house.read("ads").withColumn("cost", F.col("cost").cast("double")).fillna(0, ["goal_id"]).fillna("-", ["slot"])


@query(
    "type_upgrade",
    """SELECT client, CAST(dt AS STRING) AS "Date", campaign_id, goal_id, CASE WHEN slot = 'O' THEN clicks ELSE -1 END AS clicks
       FROM (SELECT client, dt, campaign_id, clicks, slot, COALESCE(goal_id, 0) AS goal_id FROM {ads_wh}) x""",
)
def q_type_upgrade(spark, sf):
    rows = view(spark, sf, "ads_wh").withColumnRenamed("dt", "Date").fillna(0, ["goal_id"])
    text = F.when(F.col("slot") == "O", F.col("clicks").cast("string")).otherwise("n/a")
    house = Warehouse(spark, **LAYOUT)
    house.write("ads", rows.select("client", "Date", "campaign_id", "goal_id", text.alias("clicks")))
    house.upgrade_types("ads", {"clicks": "bigint", "campaign_id": "string"})
    return house.read("ads").fillna(-1, ["clicks"])


@query(
    "empty_goals",
    """SELECT client, CAST(dt AS STRING) AS "Date", CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(0 AS BIGINT) AS conversions_99
       FROM {ads_wh} GROUP BY client, dt""",
)
def q_empty_goals(spark, sf):
    house = Warehouse(spark, **LAYOUT)
    daily = _rows(spark, sf, "ads_wh").groupBy("client", "Date").agg(F.sum("clicks").alias("clicks"))
    house.write("daily", daily)
    house.add_goal_columns("daily", ["conversions_99", "clicks"])
    return house.read("daily")


@query(
    "range_audit",
    CHANGED_DAYS_ADS + RANGES + """
          SELECT r.client, CAST(start_day AS STRING) AS "start", CAST(end_day AS STRING) AS "end",
                 (SELECT COUNT(*) FROM {ads_wh} w WHERE w.client = r.client AND w.dt BETWEEN start_day AND end_day) AS removed,
                 (SELECT COUNT(*) FROM {ads_src} s WHERE s.client = r.client AND s.dt BETWEEN start_day AND end_day) AS added FROM ranges r""",
)
def q_range_audit(spark, sf):
    return _stored(spark, sf).audit("ads", _rows(spark, sf, "ads_src"), collapse_ranges(_changes(spark, sf)))
