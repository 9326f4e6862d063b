"""Calls and leads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nested import first_comment, tag_category, tag_names, tag_type
from ..operators.calls import calls_leads
from .base import query, table

KEYWORD = "CASE user_id % 4 WHEN 0 THEN '(not set)' WHEN 1 THEN '' WHEN 2 THEN 'None' ELSE 'kw-' || event_type END"
URL = "CASE WHEN event_type = 'view' THEN 'site.example' ELSE 'https://www.site' || CAST(user_id % 7 AS STRING) || '.example/' || event_type END"


def _tags(kind):
    """Two tags: one with a type and two names (one empty), one with a category only."""
    names = F.array(F.concat(F.lit("n-"), F.col("event_type")), F.lit(""), F.lit("z"))
    full = F.struct(kind.alias("category"), F.lit("AUTO").alias("type"), names.alias("names"))
    short = F.struct(F.lit("extra").alias("category"), F.lit(None).cast("string").alias("type"), F.lit(None).cast("array<string>").alias("names"))
    return F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.array(full, short))


def _raw(spark, sf):
    events = table(spark, sf, "events")
    text = F.when(F.col("event_type") != "click", F.concat(F.lit("c"), F.col("event_id").cast("string")))
    return events.select(
        "*",
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("when"),
        F.expr(KEYWORD).alias("kw"),
        F.expr(URL).alias("link"),
        _tags(F.concat(F.lit("k"), (F.col("user_id") % 3).cast("string"))).alias("tags"),
        F.when(text.isNotNull(), F.array(F.struct(text.alias("comment")), F.struct(F.lit("second").alias("comment")))).alias("notes"),
    )


@query(
    "calls_leads",
    f"""WITH x AS (SELECT *, event_type IN ('purchase', 'click', 'view') AS is_call, {KEYWORD} AS kw, {URL} AS link FROM {{events}})
        SELECT CASE WHEN is_call THEN 'call' ELSE 'lead' END || CAST(event_id AS STRING) AS id,
               CAST(CAST(ts AS DATE) AS STRING) AS "Date", CAST(date_trunc('second', ts) AS STRING) AS event_ts,
               CASE WHEN event_type = 'error' THEN '-' ELSE 'k' || CAST(user_id % 3 AS STRING) || ', extra' END AS tag_category,
               CASE WHEN event_type = 'error' THEN '-' ELSE 'AUTO' END AS tag_type,
               CASE WHEN event_type = 'error' THEN '-' ELSE 'n-' || event_type || ', z' END AS tag_names,
               CASE WHEN event_type = 'click' THEN '-' ELSE 'c' || CAST(event_id AS STRING) END AS comment_text,
               is_call AND value > 50 AS "CallSuccessful", NOT is_call AND value > 100 AS "targetRequest",
               CASE WHEN is_call THEN CAST(FLOOR(value) AS BIGINT) ELSE -1 END AS "CallDuration",
               CASE WHEN user_id % 4 = 3 THEN kw ELSE '-' END AS keywords, link AS url,
               CASE WHEN event_type = 'view' THEN '-' ELSE 'site' || CAST(user_id % 7 AS STRING) || '.example' END AS domain,
               CASE WHEN is_call THEN '-' ELSE 'Firefox' END AS browser
        FROM x""",
)
def q_calls_leads(spark, sf):
    raw = _raw(spark, sf)
    calls = raw.where(F.col("event_type").isin("purchase", "click", "view")).select(
        F.col("when").alias("date"), F.col("event_id").alias("callId"), F.col("tags").alias("callTags"),
        F.col("notes").alias("comments"), F.col("value").alias("duration"),
        F.when(F.col("value") > 10, F.col("value") > 50).alias("successful"), F.col("kw").alias("keyword"), F.col("link").alias("url"),
        F.lit("x").alias("hostname"), F.lit(1).alias("siteId"),
    )
    leads = raw.where(F.col("event_type").isin("signup", "error")).select(
        F.col("when").alias("dateStr"), F.col("ts").alias("date"), F.col("event_id").alias("requestId"), F.col("tags").alias("RequestTags"),
        F.col("notes").alias("comments"), (F.col("value") > 100).alias("targetRequest"),
        F.struct(
            F.col("kw").alias("keywords"), F.col("link").alias("url"), F.lit("Firefox").alias("browserName"),
            F.lit("FF 1.0").alias("browser"), F.lit("10.0.0.1").alias("ip"),
        ).alias("session"),
        F.struct(F.lit("A").alias("fio"), F.lit("1").alias("phones")).alias("client"),
    )
    out = calls_leads(calls, leads)
    dash = F.lit("-")
    text = {c: F.coalesce(F.col(c), dash).alias(c) for c in ("tag_category", "tag_type", "tag_names", "comment_text", "keywords", "url", "domain", "browser")}
    return out.select(
        F.coalesce(F.concat(F.lit("call"), "callId"), F.concat(F.lit("lead"), "requestId")).alias("id"),
        "Date", "event_ts", "CallSuccessful", "targetRequest", F.coalesce("CallDuration", F.lit(-1)).alias("CallDuration"), *text.values(),
    )


@query(
    "tag_extract",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE 'k' || CAST(user_id % 3 AS STRING) || ', extra' END AS category,
              CASE WHEN event_type = 'error' THEN '' ELSE 'AUTO' END AS type,
              CASE WHEN event_type = 'error' THEN '' ELSE 'n-' || event_type || ', z' END AS names,
              CASE WHEN event_type = 'click' THEN '' ELSE 'c' || CAST(event_id AS STRING) END AS comment FROM {events}""",
)
def q_tag_extract(spark, sf):
    return _raw(spark, sf).select(
        "event_id", tag_category(F.col("tags")).alias("category"), tag_type(F.col("tags")).alias("type"),
        tag_names(F.col("tags")).alias("names"), first_comment(F.col("notes")).alias("comment"),
    )
