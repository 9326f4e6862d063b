"""Ad-group statistics: lookup of the plan tree, normalisation, active clients, run summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import in_window
from ..functions.nested import GOAL_ALIASES, coalesce_aliases, flatten_json
from ..functions.numbers import lenient_double, lenient_long

# The groups of nested metrics and the columns of the stored table with their types.
METRIC_ROOTS = ("base", "events", "social_network", "uniques", "uniques_video", "video")
GROUP_COLUMNS = {
    "date": "date",
    "campaign_name": "string", "campaign_id": "string", "group_name": "string", "group_id": "string",
    "base_shows": "bigint", "base_clicks": "bigint", "base_spent": "double", "base_vk_goals": "bigint",
    "events_clicks_on_external_url": "bigint", "events_comments": "bigint", "events_joinings": "bigint",
    "events_launching_video": "bigint", "events_likes": "bigint", "events_moving_into_group": "bigint",
    "events_opening_app": "bigint", "events_opening_post": "bigint", "events_sending_form": "bigint",
    "events_shares": "bigint", "events_votings": "bigint",
    "social_network_ok_message": "bigint", "social_network_result_join": "bigint",
    "social_network_result_message": "bigint", "social_network_vk_join": "bigint",
    "social_network_vk_message": "bigint", "social_network_vk_subscribe": "bigint",
    "uniques_frequency": "double", "uniques_increment": "bigint", "uniques_total": "bigint",
    "uniques_video_depth_of_view": "double", "uniques_video_started": "bigint",
    "uniques_video_viewed_25_percent": "bigint", "uniques_video_viewed_10_seconds": "bigint",
    "uniques_video_viewed_50_percent": "bigint", "uniques_video_viewed_75_percent": "bigint",
    "uniques_video_viewed_100_percent": "bigint", "video_depth_of_view": "double",
    "video_first_second": "bigint", "video_paused": "bigint", "video_resumed_after_pause": "bigint",
    "video_sound_turned_off": "bigint", "video_sound_turned_on": "bigint", "video_started": "bigint",
    "video_started_cost": "double", "video_viewed_10_seconds": "bigint", "video_viewed_100_percent": "bigint",
    "video_viewed_75_percent": "bigint", "video_viewed_50_percent": "bigint", "video_viewed_25_percent": "bigint",
}


def flatten_groups(plans: DataFrame) -> DataFrame:
    """Plan tree (plan_id, plan_name, groups[]) to one row per named group."""
    each = plans.select("plan_id", "plan_name", F.explode("groups").alias("g"))
    return each.select(
        F.col("plan_name").alias("campaign_name"),
        F.col("plan_id").alias("campaign_id"),
        F.col("g.name").alias("group_name"),
        F.col("g.group_id").alias("group_id"),
    ).where(F.col("group_name").isNotNull() & (F.col("group_name") != "") & F.col("group_id").isNotNull())


def attach_group(stats: DataFrame, plans: DataFrame) -> DataFrame:
    """Statistics with their campaign and group; rows of unnamed or unknown groups are dropped.

    No broadcast is forced: the size of the group list decides at run time.
    """
    return stats.join(flatten_groups(plans), "group_id")


def normalize_groups(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested metric groups (JSON text) to the fixed columns; absent metrics are 0, absent texts null."""
    roots = [r for r in METRIC_ROOTS if r in df.columns]
    wanted = [c for c in GROUP_COLUMNS if c not in df.columns]
    aliases = [a for a in GOAL_ALIASES if a not in wanted and a not in df.columns]
    flat = coalesce_aliases(flatten_json(df, roots, [*wanted, *aliases]), "base_vk_goals", GOAL_ALIASES)
    lenient = {"bigint": lenient_long, "double": lenient_double}

    def column(c: str, kind: str) -> Column:
        return (lenient[kind](F.col(c)) if kind in lenient else F.col(c).try_cast(kind)).alias(c)

    return flat.select(*keep, *[column(c, t) for c, t in GROUP_COLUMNS.items()])


def active_clients(clients: DataFrame, daily: DataFrame, start: date, end: date) -> DataFrame:
    """Clients with status ``active`` whose shows in the window exceed 0."""
    shown = (
        daily.where(in_window(F.col("dt"), start, end))
        .groupBy("client")
        .agg(F.sum("shows").cast("bigint").alias("shows"))
        .where(F.col("shows") > 0)
    )
    return clients.where(F.col("status") == "active").select("client").distinct().join(shown, "client")


def run_summary(results: DataFrame) -> DataFrame:
    """Totals over load results (agency, client, success, rows)."""
    ok = F.col("success")
    return results.agg(
        F.count_distinct("agency").alias("agencies_processed"),
        F.count("*").alias("clients_processed"),
        F.count_if(ok).alias("clients_successful"),
        F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).cast("bigint").alias("total_rows"),
    )
