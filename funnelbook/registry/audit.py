"""Stale clients and failed runs, in batch and as a stream."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..operators.audit import cleanup_entries, failed, fan_out, newest_runs, recent_alerts, stale_clients
from ..session import shared_dir
from ..streaming.monitor import failed_run_stream, read_alerts, write_alerts
from .base import query, table, view

SINCE = datetime(2024, 1, 20)
FAILED = "state = 'error' AND end_time > TIMESTAMP '2024-01-20 00:00:00' AND tag <> 'admin_bot'"


@query(
    "stale_clients",
    """WITH m AS (SELECT client, MAX(dt) AS d, 'ads' AS source FROM {ads_src} GROUP BY client
                  UNION ALL SELECT client, MAX(dt), 'visits' FROM {vis_src} GROUP BY client)
       SELECT client, CAST(d AS STRING) AS max_date, source, CAST(DATE '2001-11-25' - d AS BIGINT) AS days_since_update
       FROM m WHERE d < DATE '2001-11-25' - 30""",
)
def q_stale_clients(spark, sf):
    sources = {"ads": (view(spark, sf, "ads_src"), "dt"), "visits": (view(spark, sf, "vis_src"), "dt")}
    return stale_clients(sources, date(2001, 11, 25)).withColumn("days_since_update", F.col("days_since_update").cast("bigint"))


def _runs(spark, sf):
    return view(spark, sf, "runs").withColumn("tags", F.array("tag", F.lit("nightly")))


@query(
    "failed_runs",
    f"""SELECT id, state, CAST(date_trunc('second', end_time) AS STRING) AS end_time, tag FROM {{runs}} WHERE {FAILED}
        ORDER BY runs.end_time DESC, id DESC LIMIT 50""",
)
def q_failed_runs(spark, sf):
    newest = newest_runs(failed(_runs(spark, sf), SINCE, states=("ERROR",)))
    return newest.select("id", "state", F.date_trunc("second", "end_time").cast("timestamp_ntz").alias("end_time"), "tag")


@query(
    "cleanup_entries",
    """SELECT id, COALESCE(CASE WHEN ok THEN src END, '-') AS source, COALESCE(CASE WHEN ok THEN cl END, '-') AS client, ok FROM (
           SELECT event_id AS id, event_type AS src, 'c' || CAST(user_id AS STRING) AS cl, event_type IN ('click', 'view') AS ok FROM {events}) x""",
)
def q_cleanup_entries(spark, sf):
    kind = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.concat(F.lit(" "), F.upper("event_type"), F.lit(":")))
    entry = F.concat(kind, F.lit(" c"), F.col("user_id").cast("string"))
    parsed = cleanup_entries(table(spark, sf, "events").select(F.col("event_id").alias("id"), entry.alias("entry")), ["click", "view"])
    text = [F.coalesce(c, F.lit("-")).alias(c) for c in ("source", "client")]
    return parsed.select("id", *text, F.col("error").isNull().alias("ok"))


@query("alert_fanout", f"SELECT id, CAST(r_regionkey AS BIGINT) AS admin_id FROM {{runs}}, {{region}} WHERE {FAILED}")
def q_alert_fanout(spark, sf):
    admins = table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("admin_id"))
    return fan_out(failed(_runs(spark, sf), SINCE, states=("ERROR",)).select("id"), admins)


@query(
    "recent_alerts",
    f"SELECT id, state, tag FROM {{runs}} WHERE {FAILED} ORDER BY runs.end_time DESC, id DESC LIMIT 20",
)
def q_recent_alerts(spark, sf):
    return recent_alerts(failed(_runs(spark, sf), SINCE, states=("ERROR",))).select("id", "state", "tag")


@query("failed_runs_stream", f"SELECT id, user_id FROM {{runs}} WHERE {FAILED}")
def q_failed_runs_stream(spark, sf):
    events = table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    tag = F.when(F.col("user_id") % 5 == 0, "admin_bot").otherwise("auto")
    runs = stream.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("state"), F.col("ts").alias("end_time"), F.array(tag).alias("tags"), "user_id"
    )
    folder = shared_dir(spark)
    alerts = failed_run_stream(runs, SINCE, states=("ERROR",)).select("id", "user_id", "end_time")
    write_alerts(alerts, f"{folder}/alerts", f"{folder}/progress").awaitTermination()
    return read_alerts(spark, f"{folder}/alerts", "id bigint, user_id bigint")
