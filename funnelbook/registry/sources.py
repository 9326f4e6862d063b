"""Landed files: written to the shared folder from the test tables, then read by the engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.frames import strip_prefix
from ..session import shared_dir
from ..sources.pages import explode_pages, read_pages, zip_dims_metrics
from ..sources.reports import read_report_tsv, read_visit_parts
from .base import query, table


@query(
    "scan_report_tsv",
    """SELECT l_orderkey AS "AdId", CAST(CAST(l_shipdate AS DATE) AS STRING) AS "Date", CAST(l_linenumber AS BIGINT) AS "Clicks",
              CASE WHEN l_returnflag = 'A' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS "Impressions", l_extendedprice AS "Cost",
              l_returnflag AS "Slot" FROM {lineitem}""",
)
def q_scan_report_tsv(spark, sf):
    path = shared_dir(spark)
    table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("AdId"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date"), F.col("l_linenumber").alias("Clicks"),
        F.when(F.col("l_returnflag") == "A", "--").otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("Impressions"),
        F.round(F.col("l_extendedprice") * 1_000_000).cast("bigint").alias("Cost"), F.col("l_returnflag").alias("Slot"),
    ).write.csv(path, sep="\t", header=True)
    types = {"AdId": "bigint", "Date": "date", "Clicks": "bigint", "Impressions": "bigint", "Cost": "double", "Slot": "string"}
    return read_report_tsv(spark, path, types, micros=True)


@query(
    "scan_visit_parts",
    """SELECT CAST(event_id AS STRING) AS "visitID", CAST(user_id AS STRING) AS "clientID", CAST(FLOOR(value) AS BIGINT) AS "pageViews", event_type AS browser
       FROM {events}""",
)
def q_scan_visit_parts(spark, sf):
    path = shared_dir(spark)
    table(spark, sf, "events").select(
        F.col("event_id").alias("ym:s:visitID"), F.col("user_id").alias("ym:s:clientID"), F.floor("value").alias("ym:s:pageViews"),
        F.col("event_type").alias("ym:s:browser"),
    ).repartition(4, "ym:s:clientID").write.csv(path, sep="\t", header=True)
    types = {"ym:s:visitID": "string", "ym:s:clientID": "string", "ym:s:pageViews": "bigint", "ym:s:browser": "string"}
    return strip_prefix(read_visit_parts(spark, path, types), "ym:s:")


@query(
    "scan_json_pages",
    """SELECT event_id, user_id, event_type AS kind FROM {events} UNION ALL SELECT event_id, user_id + 1, 'next' FROM {events}""",
)
def q_scan_json_pages(spark, sf):
    path = shared_dir(spark)
    first = F.struct("user_id", F.col("event_type").alias("kind"))
    second = F.struct((F.col("user_id") + 1).alias("user_id"), F.lit("next").alias("kind"))
    table(spark, sf, "events").select("event_id", F.array(first, second).alias("records")).write.json(path)
    pages = read_pages(spark, path, "event_id bigint, records array<struct<user_id:bigint,kind:string>>")
    return explode_pages(pages, "records", keep=["event_id"])


@query(
    "zip_dims_metrics",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day, CASE WHEN event_type = 'view' THEN 'v' ELSE event_type END AS kind,
              value AS visits, CASE WHEN event_type = 'click' THEN 0 ELSE CAST(user_id AS DOUBLE) END AS goals, CAST(0 AS DOUBLE) AS rest
       FROM {events} WHERE event_type <> 'error'""",
)
def q_zip_dims_metrics(spark, sf):
    def dim(name, ident):
        return F.struct(name.cast("string").alias("name"), ident.cast("string").alias("id"))

    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.array(dim(F.to_date("ts"), F.lit("d")), dim(kind, F.lit("v")))).otherwise(F.array()).alias("dimensions"),
        F.array(F.col("value"), F.when(F.col("event_type") != "click", F.col("user_id").cast("double"))).alias("metrics"),
    )
    return zip_dims_metrics(rows, ["day", "kind"], ["visits", "goals", "rest"], keep=["event_id"])
