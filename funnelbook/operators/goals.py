"""Goals and conversions, kept long: one row per (client, day or visit, goal)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_visit_ts
from ..functions.frames import in_window
from ..functions.text import goal_class
from ..plans.skew import skew_join

# Fixed value: this goal id never counts as a goal of a campaign.
EXCLUDED_GOAL = 12

# Campaign kinds that carry priority goals.
CAMPAIGN_KINDS = ("TextCampaign", "DynamicTextCampaign", "SmartCampaign")


def goal_hits(visits: DataFrame, keys: Sequence[str], goals: str, times: str) -> DataFrame:
    """One row per visit and distinct goal: how often it was reached and when first.

    A visit carries its whole goal list in its row, so the counting happens inside the row and no shuffle is needed: the goals
    with their places are sorted, and where the goal changes a count ends, so a list of n goals costs n log n steps however many of
    them differ. Null goals do not count. A missing or malformed time gives null.
    """
    places = F.filter(F.transform(F.col(goals), lambda g, i: F.struct(g.alias("g"), i.alias("i"))), lambda p: p["g"].isNotNull())
    # each list is a column of its own, made once for all that refers to it
    ordered = visits.select(*keys, times, F.array_sort(places).alias("__s")).where(F.size("__s") > 0)

    def goal(i: Column) -> Column:
        return F.get("__s", i)["g"]

    begins = F.filter(F.sequence(F.lit(0), F.size("__s") - 1), lambda i: (i == 0) | (goal(i) != goal(i - 1)))
    cut = ordered.withColumn("__b", F.concat(begins, F.array(F.size("__s"))))
    counted = F.transform(
        F.slice("__b", 1, F.size("__b") - 1),
        lambda b, k: F.struct(goal(b).alias("goal_id"), (F.get("__b", k + 1) - b).cast("bigint").alias("hits"), F.get(times, F.get("__s", b)["i"]).alias("t")),
    )
    each = cut.select(*keys, F.explode(counted).alias("__h"))
    return each.select(*keys, "__h.goal_id", "__h.hits", parse_visit_ts(F.col("__h.t")).alias("first_time"))


def goal_dimension(goals: DataFrame) -> DataFrame:
    """(client, goal_id, class) from raw (client, id, name); rows without a numeric id are dropped."""
    gid = F.col("id").try_cast("bigint")
    return (
        goals.select("client", gid.alias("goal_id"), goal_class(F.col("name")).alias("class"))
        .where(F.col("goal_id").isNotNull())
        .groupBy("client", "goal_id")
        .agg(F.min("class").alias("class"))
    )


def goal_flags(hits: DataFrame, goals: DataFrame) -> DataFrame:
    """Flags of the goals that the client has: ``u`` for each, ``g`` only for marked ones."""
    hit = F.when(F.col("hits") > 0, 1).otherwise(0)
    return skew_join(goals, hits, ["client", "goal_id"]).select(
        *[c for c in hits.columns if c not in ("hits", "first_time")],
        hit.alias("u_flag"),
        F.when(F.col("class") == "g", hit).otherwise(0).alias("g_flag"),
    )


def list_sums(lists: DataFrame, goals: DataFrame, ids: str) -> DataFrame:
    """(client, ``ids``, g_sum_goal, u_sum_goal) of every distinct goal list of a client that reaches one of its goals.

    ``lists`` is (client, ``ids``), best straight from the stored log. Lists are made distinct before they are spread to narrow
    rows (client, goal), and counted by list with a sum in each task, so neither the goals of a client nor visits meet in one place.
    """
    known = goals.where(F.col("goal_id").isNotNull()).select("client", "goal_id", "class").distinct()
    known = known.groupBy("client", "goal_id").agg(F.max(F.coalesce((F.col("class") == "g").cast("int"), F.lit(0))).alias("marked"))
    some = lists.where(F.size(ids) > 0).select("client", ids).distinct()
    each = some.select("client", ids, F.explode(F.array_distinct(ids)).alias("goal_id"))
    return each.join(known, ["client", "goal_id"]).groupBy("client", ids).agg(
        F.sum("marked").cast("bigint").alias("g_sum_goal"), F.count("*").cast("bigint").alias("u_sum_goal")
    )


def goal_sums(visits: DataFrame, goals: DataFrame, ids: str, lists: DataFrame | None = None) -> DataFrame:
    """Adds ``g_sum_goal`` and ``u_sum_goal``, the number of the client's goals that a visit reached, to each visit.

    ``lists`` names the stored goal lists, (client, ``ids``), where ``visits`` is costly to compute a second time. Visits are joined to
    the sums of their list; frequent lists, and the empty one above all, are spread.
    """
    counted = (visits if lists is None else lists).select("client", ids)
    sums = list_sums(counted, goals, ids)
    listed = visits.withColumn(ids, F.coalesce(F.col(ids), F.array().cast("array<bigint>")))
    empty = counted.select("client", F.coalesce(F.col(ids), F.array().cast("array<bigint>")).alias(ids))
    joined = skew_join(sums, listed, ["client", ids], "left", counted=empty)
    out = joined.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("g_sum_goal", "u_sum_goal")})
    return out.select(*listed.columns, "g_sum_goal", "u_sum_goal")


def goal_list_daily(visits: DataFrame, start: date, end: date, ids: str, *, date_col: str = "dateTime") -> DataFrame:
    """(client, dt, goal_id, conversions) out of stored visits: how many visits of a day have the goal in their list.

    The window reaches the scan and two columns of it are read; counts are made in each task before the only shuffle, so a
    client with very many visits brings its days and goals.
    """
    rows = visits.where(in_window(F.col(date_col), start, end)).select("client", F.to_date(date_col).alias("dt"), F.explode(F.array_distinct(ids)).alias("goal_id"))
    return rows.where(F.col("goal_id").isNotNull()).groupBy("client", "dt", "goal_id").agg(F.count("*").alias("conversions"))


def pivot_goals(df: DataFrame, keys: Sequence[str], value: str, goal_ids: Sequence[int], prefix: str) -> DataFrame:
    """Wide form for an explicit goal list; a goal without rows is 0."""
    return df.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("goal_id") == g, F.col(value))), F.lit(0)).cast("bigint").alias(f"{prefix}{g}")
            for g in goal_ids
        ]
    )


def merge_goal_batches(frames: Sequence[DataFrame], keys: Sequence[str], base: Sequence[str]) -> DataFrame:
    """Put reports of several goal batches together by key.

    Each batch repeats the base metrics, so these are taken once; every other column is a
    conversion column and counts 0 where its batch has no such key.
    """
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    conversions = [c for c in both.columns if c not in keys and c not in base]
    return both.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in base],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in conversions],
    )


def campaign_goals(campaigns: DataFrame, client: str = "client") -> DataFrame:
    """Distinct goals of each client from ``<kind>.PriorityGoals.Items[].GoalId``."""
    ids = [
        F.transform(F.col(f"{kind}.PriorityGoals.Items"), lambda i: i.getField("GoalId"))
        for kind in CAMPAIGN_KINDS
        if kind in campaigns.columns
    ]
    empty = F.array().cast("array<bigint>")
    every = F.concat(*[F.coalesce(i.cast("array<bigint>"), empty) for i in ids])
    return (
        campaigns.select(client, F.explode(every).alias("goal_id"))
        .where(F.col("goal_id").isNotNull() & (F.col("goal_id") != EXCLUDED_GOAL))
        .distinct()
    )


def goal_sets(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Each (client, goal_id) of either side with the side(s) it is on: source, warehouse or both."""
    tagged = source.select("client", "goal_id", F.lit(1).alias("s"), F.lit(0).alias("w")).unionByName(
        warehouse.select("client", "goal_id", F.lit(0).alias("s"), F.lit(1).alias("w"))
    )
    return (
        tagged.where(F.col("goal_id").isNotNull())
        .groupBy("client", "goal_id")
        .agg(F.max("s").alias("s"), F.max("w").alias("w"))
        .select(
            "client",
            "goal_id",
            F.when(F.col("s") + F.col("w") == 2, "both").when(F.col("s") == 1, "source").otherwise("warehouse").alias("side"),
        )
    )


def stale_goals(stored: DataFrame, goals: DataFrame) -> DataFrame:
    """Stored ``g`` goals whose marker is gone at the source (no such goal, or another class now)."""
    marked = goals.where(F.col("class") == "g").select("client", "goal_id")
    return stored.where(F.col("class") == "g").join(marked, ["client", "goal_id"], "left_anti")


def drop_goals(stored: DataFrame, gone: DataFrame) -> DataFrame:
    """Stored goal rows (dimension or daily) without those of the goals in ``gone``."""
    return stored.join(gone.select("client", "goal_id").distinct(), ["client", "goal_id"], "left_anti")


def wide_flags(visits: DataFrame, ids: str, goal_ids: Sequence[int], prefix: str = "u_goal_") -> DataFrame:
    """Wide 0/1 columns for an explicit goal list, read from the goal list of each visit."""
    reached = F.coalesce(F.col(ids), F.array().cast("array<bigint>"))
    return visits.withColumns({f"{prefix}{g}": F.array_contains(reached, F.lit(g).cast("bigint")).cast("int") for g in goal_ids})


def drop_legacy(df: DataFrame, marked: Sequence[int] = ()) -> DataFrame:
    """Wide input without ``goal_*``, ``sum_goal`` and those ``g_goal_*`` columns whose goal is not in ``marked``."""
    keep = {f"g_goal_{g}" for g in marked}

    def legacy(c: str) -> bool:
        return c == "sum_goal" or c.startswith("goal_") or (c.startswith("g_goal_") and c not in keep)

    return df.drop(*[c for c in df.columns if legacy(c)])
