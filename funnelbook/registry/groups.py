"""Ad groups: plan tree, nested metrics, activity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nested import coalesce_aliases, flatten_json, flatten_structs
from ..operators.goals import campaign_goals
from ..operators.groups import active_clients, attach_group, normalize_groups, run_summary
from .base import ADS_END, ADS_START, query, table, view


def _plans(spark, sf):
    """Plans = brands, groups = parts; the groups of a brand are dealt to tree rows by size."""
    parts = table(spark, sf, "part")
    named = F.when(F.col("p_size") > 5, F.col("p_name"))
    return parts.select(
        F.col("p_brand").alias("plan_id"),
        F.concat(F.lit("plan "), "p_brand").alias("plan_name"),
        F.array(F.struct(F.col("p_partkey").alias("group_id"), named.alias("name"))).alias("groups"),
    )


@query(
    "group_lookup",
    """SELECT a.client, CAST(a.dt AS STRING) AS dt, a.group_id, 'plan ' || p.p_brand AS campaign_name, p.p_brand AS campaign_id,
              p.p_name AS group_name, a.impressions AS shows
       FROM {ads_src} a JOIN {part} p ON p.p_partkey = a.group_id WHERE p.p_size > 5""",
)
def q_group_lookup(spark, sf):
    stats = view(spark, sf, "ads_src").select("client", "dt", "group_id", F.col("impressions").alias("shows"))
    return attach_group(stats, _plans(spark, sf))


@query(
    "active_clients",
    """SELECT 'c' || CAST(s_suppkey AS STRING) AS client, CAST(SUM(impressions) AS BIGINT) AS shows
       FROM {supplier} JOIN {ads_src} ON client = 'c' || CAST(s_suppkey AS STRING)
       WHERE s_acctbal > 0 GROUP BY s_suppkey HAVING SUM(impressions) > 0""",
)
def q_active_clients(spark, sf):
    clients = table(spark, sf, "supplier").select(
        F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("client"),
        F.when(F.col("s_acctbal") > 0, "active").otherwise("blocked").alias("status"),
    )
    daily = view(spark, sf, "ads_src").select("client", "dt", F.col("impressions").alias("shows"))
    return active_clients(clients, daily, ADS_START, ADS_END)


@query(
    "run_summary",
    """SELECT COUNT(DISTINCT o_orderpriority) AS agencies_processed, COUNT(*) AS clients_processed,
              COUNT(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS clients_successful,
              CAST(SUM(CASE WHEN o_orderstatus <> 'F' THEN CAST(FLOOR(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS total_rows FROM {orders}""",
)
def q_run_summary(spark, sf):
    return run_summary(
        table(spark, sf, "orders").select(
            F.col("o_orderpriority").alias("agency"), F.col("o_custkey").alias("client"),
            (F.col("o_orderstatus") != "F").alias("success"), F.floor("o_totalprice").cast("bigint").alias("rows"),
        )
    )


@query(
    "campaign_goals",
    """SELECT DISTINCT client, goal_id FROM (
           SELECT client, CAST(campaign_id % 20 AS BIGINT) AS goal_id FROM {ads_src} WHERE network = 'A'
           UNION ALL SELECT client, goal_id FROM {ads_src}
           UNION ALL SELECT client, impressions AS goal_id FROM {ads_src} WHERE network = 'R') x WHERE goal_id <> 12""",
)
def q_campaign_goals(spark, sf):
    def kind(ids):
        items = F.transform(ids, lambda g: F.struct(g.alias("GoalId")))
        return F.struct(F.struct(items.alias("Items")).alias("PriorityGoals"))

    rows = view(spark, sf, "ads_src")
    campaigns = rows.select(
        "client",
        F.when(F.col("network") == "A", kind(F.array((F.col("campaign_id") % 20).cast("bigint")))).alias("TextCampaign"),
        kind(F.array("goal_id", F.lit(None).cast("bigint"))).alias("DynamicTextCampaign"),
        F.when(F.col("network") == "R", kind(F.array("impressions"))).alias("SmartCampaign"),
    )
    return campaign_goals(campaigns)


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


@query(
    "json_flatten",
    f"""SELECT event_id, CAST({K} AS STRING) AS props_k, CAST(user_id AS STRING) AS wrap_inner_user_id, chr(123) || chr(125) AS wrap_empty,
               event_type AS session_kind, CAST(CASE WHEN event_type = 'view' THEN {K} ELSE user_id END AS STRING) AS picked FROM {{events}}""",
)
def q_json_flatten(spark, sf):
    rows = table(spark, sf, "events")
    inner = F.to_json(F.struct("user_id"))
    # the inner object is once nested, once string-encoded
    nested = F.concat(F.lit('{"inner":'), inner, F.lit(',"empty":{}}'))
    encoded = F.to_json(F.struct(inner.alias("inner"), F.lit("{}").alias("empty")))
    shaped = flatten_structs(
        rows.select(
            "event_id", "props", F.when(F.col("event_type") == "view", encoded).otherwise(nested).alias("wrap"),
            F.struct(F.col("event_type").alias("kind")).alias("session"), "event_type",
        ),
        sep="_",
    )
    flat = flatten_json(shaped, ["props", "wrap"], ["props_k", "wrap_inner_user_id", "wrap_empty"])
    flat = flat.withColumn("first", F.when(F.col("event_type") == "view", F.col("props_k")))
    return coalesce_aliases(flat, "picked", ["absent", "first", "wrap_inner_user_id"]).drop("first", "event_type")


@query(
    "vk_normalize",
    f"""SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS date, event_type AS campaign_name, user_id % 7 AS base_clicks,
               CAST(FLOOR(value) AS BIGINT) AS base_shows, value AS base_spent,
               CASE WHEN event_type = 'view' THEN {K} WHEN event_type = 'click' THEN user_id ELSE 0 END AS base_vk_goals,
               {K} AS events_likes, 0 AS events_shares, user_id AS uniques_video_started, CAST(user_id AS DOUBLE) / 4 AS video_depth_of_view,
               {K} AS social_network_vk_join FROM {{events}}""",
)
def q_vk_normalize(spark, sf):
    rows = table(spark, sf, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1)
    base = F.struct(
        F.floor("value").cast("string").alias("shows"), (F.col("user_id") % 7).alias("clicks"), F.col("value").alias("spent"),
        F.when(F.col("event_type") == "view", k).alias("goals"), F.when(F.col("event_type") == "click", F.col("user_id")).alias("conversions"),
    )
    stats = rows.select(
        "event_id",
        F.col("ts").alias("date"),
        F.col("event_type").alias("campaign_name"),
        F.to_json(base).alias("base"),
        F.to_json(F.struct(k.cast("bigint").alias("likes"), F.lit("--").alias("shares"))).alias("events"),
        F.to_json(F.struct(F.struct(F.col("user_id").alias("started")).alias("video"))).alias("uniques"),
        F.to_json(F.struct((F.col("user_id") / 4).alias("depth_of_view"))).alias("video"),
        F.to_json(F.struct(F.struct(k.alias("join")).alias("vk"))).alias("social_network"),
    )
    out = normalize_groups(stats, keep=("event_id",))
    return out.select(
        "event_id", "date", "campaign_name", "base_clicks", "base_shows", "base_spent", "base_vk_goals", "events_likes", "events_shares",
        "uniques_video_started", "video_depth_of_view", "social_network_vk_join",
    )
