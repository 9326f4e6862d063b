"""Which days of which clients differ between a source and the warehouse.

Both sides are stacked with a side mark and aggregated once, so that an absent side is 0
without an outer join, and a client with very many rows is reduced to its days and goals on
the map side, before anything is shuffled. After that one shuffle by client serves all later
steps: a client then has at most days x goals rows, whatever its traffic.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import in_window
from ..functions.text import login_canonical

# Cost tolerance of the two ads profiles.
COST_TOLERANCE = {"analytics": 500, "light": 2}
DEFAULT_TOLERANCE = 5


def _sides(source: DataFrame, warehouse: DataFrame, values: Sequence[str]) -> DataFrame:
    """Both frames stacked: each value once per side (``s_``/``w_``), 0 on the other, and row marks."""

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        keys = [c for c in ("client", "dt", "goal_id") if c in df.columns]
        types = dict(df.dtypes)
        return df.select(
            *keys,
            *[F.col(v).alias(f"{own}_{v}") for v in values],
            *[F.lit(0).cast(types[v]).alias(f"{other}_{v}") for v in values],
            F.lit(1).alias(f"{own}_rows"),
            F.lit(0).alias(f"{other}_rows"),
        )

    return side(source, "s", "w").unionByName(side(warehouse, "w", "s"))


def _sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).alias(c)


def compare_ads(source: DataFrame, warehouse: DataFrame, start: date, end: date, known_goals: DataFrame | None = None) -> DataFrame:
    """Ads rows of both sides (one goal at most per row) to sums per client, day and goal.

    ``known`` says whether the warehouse has that goal: whether it is one of ``known_goals`` (client, goal_id), or else has a row
    in ``warehouse``, on whatever day. So a goal that was loaded before the window and rested in it is not new.
    """
    values = ["impressions", "clicks", "cost", "conv"]
    columns = ["client", "dt", "goal_id", *values]
    sides = [df.select(*columns).where(in_window(F.col("dt"), start, end)) for df in (source, warehouse)]
    listed = warehouse.where(~F.coalesce(in_window(F.col("dt"), start, end), F.lit(False))) if known_goals is None else known_goals
    listed = listed.where(F.col("goal_id").isNotNull()).select("client", "goal_id", F.lit(1).alias("listed"))
    stacked = _sides(*sides, values).unionByName(listed, allowMissingColumns=True)
    merged = stacked.groupBy("client", "dt", "goal_id").agg(
        *[_sum(f"{p}_{v}") for p in "sw" for v in values], *[F.coalesce(F.max(m), F.lit(0)).alias(m) for m in ("s_rows", "w_rows", "listed")]
    )
    goal = Window.partitionBy("client", "goal_id")
    mark = F.col("listed") if known_goals is not None else F.greatest("listed", "w_rows")
    return merged.repartition("client").withColumn("known", F.max(mark).over(goal) == 1).where(F.col("dt").isNotNull()).drop("listed")


def changed_days_ads(
    source: DataFrame,
    warehouse: DataFrame,
    start: date,
    end: date,
    *,
    tolerance: float | None = None,
    profile: str | None = None,
    skip_cost: Sequence[str] = (),
    compare_conversions: bool = True,
    known_goals: DataFrame | None = None,
) -> DataFrame:
    """(client, dt, reason) of the days to reload. Inputs are ads rows of both sides; ``known_goals`` as in ``compare_ads``.

    * ``presence``: one side has any metric above 0, the other has none;
    * ``metrics``: both have, and impressions, clicks, cost (by more than the tolerance, not
      for clients on ``skip_cost``) or the conversions of a known goal differ;
    * ``new_goal``: a goal unknown to the warehouse has conversions on that day;
    * ``forced``: the last day, for a client with source rows but no warehouse row in the window.

    A client without source rows is never reported. Names on ``skip_cost`` match in any spelling.
    """
    per_goal = compare_ads(source, warehouse, start, end, known_goals)
    real = F.col("goal_id").isNotNull()
    per_day = per_goal.groupBy("client", "dt").agg(
        *[_sum(f"{p}_{v}") for p in "sw" for v in ("impressions", "clicks", "cost")],
        *[F.coalesce(F.sum(F.when(real, F.col(f"{p}_conv"))), F.lit(0)).alias(f"{p}_conv") for p in "sw"],
        F.max(F.coalesce(real & F.col("known") & (F.col("s_conv") != F.col("w_conv")), F.lit(False))).alias("known_differs"),
        F.max(F.coalesce(real & ~F.col("known") & (F.col("s_conv") > 0), F.lit(False))).alias("new_goal"),
        F.max("s_rows").alias("s_rows"),
        F.max("w_rows").alias("w_rows"),
    )

    def present(p: str) -> Column:
        return F.col(f"{p}_impressions") + F.col(f"{p}_clicks") + F.col(f"{p}_cost") + F.col(f"{p}_conv") > 0

    cost_differs = F.abs(F.col("s_cost") - F.col("w_cost")) > F.lit(COST_TOLERANCE.get(profile, DEFAULT_TOLERANCE) if tolerance is None else tolerance)
    if skip_cost:
        names = [n.strip().replace("_", "-").replace(".", "-") for n in skip_cost]
        cost_differs = cost_differs & ~login_canonical(F.col("client")).isin(*names)
    differs = (F.col("s_impressions") != F.col("w_impressions")) | (F.col("s_clicks") != F.col("w_clicks")) | cost_differs
    if compare_conversions:
        differs = differs | F.col("known_differs")
    reason = (
        F.when(present("s") != present("w"), "presence").when(present("s") & differs, "metrics").when(F.col("new_goal"), "new_goal")
    )

    # a client's days with a reason are a list of at most the window's days, so one aggregation by client serves all of it
    day = F.struct("dt", "reason")
    clients = (
        per_day.select("client", "dt", reason.alias("reason"), "s_rows", "w_rows")
        .groupBy("client")
        .agg(
            F.max("s_rows").alias("s_rows"),
            F.max("w_rows").alias("w_rows"),
            F.collect_list(F.when(F.col("reason").isNotNull(), day)).alias("found"),
            F.max(F.when((F.col("dt") == F.lit(end)) & F.col("reason").isNotNull(), 1)).alias("last_found"),
        )
    )
    forced = (F.col("w_rows") == 0) & F.col("last_found").isNull()
    extra = F.array(F.struct(F.lit(end).alias("dt"), F.lit("forced").alias("reason")))
    return (
        clients.where("s_rows = 1")
        .select("client", F.explode(F.when(forced, F.concat("found", extra)).otherwise(F.col("found"))).alias("day"))
        .select("client", "day.dt", "day.reason")
    )


def new_goal_days(source_daily: DataFrame, known_goals: DataFrame) -> DataFrame:
    """Goals of the source that the warehouse lacks, with the days they have conversions on.

    ``source_daily`` is (client, dt, goal_id, conversions). A goal without conversions gives one
    row with a null day: it only needs an entry in the goal dimension, no reload.
    """
    known = known_goals.select("client", "goal_id").where(F.col("goal_id").isNotNull()).distinct()
    stacked = source_daily.select("client", "goal_id", "dt", "conversions", F.lit(0).alias("known")).unionByName(
        known.select("client", "goal_id", F.lit(None).cast("date").alias("dt"), F.lit(0).cast("bigint").alias("conversions"), F.lit(1).alias("known"))
    )
    goal = Window.partitionBy("client", "goal_id")
    marked = stacked.withColumns(
        {
            "any_known": F.max("known").over(goal),
            "most": F.max("conversions").over(goal),
            "rn": F.row_number().over(goal.orderBy("dt")),
        }
    ).where("any_known = 0")
    hit, empty = F.col("conversions") > 0, (F.coalesce("most", F.lit(0)) <= 0) & (F.col("rn") == 1)
    return marked.where(hit | empty).select("client", "goal_id", F.when(hit, F.col("dt")).alias("dt"))


def changed_days_visits(
    source: DataFrame,
    source_goals: DataFrame,
    warehouse: DataFrame,
    warehouse_goals: DataFrame,
    *,
    goal_list: DataFrame | None = None,
    known_goals: DataFrame | None = None,
    ignored: DataFrame | None = None,
    compare_conversions: bool = True,
) -> DataFrame:
    """(client, dt, reason) of the days to reload, from daily visits and daily goals of both sides.

    ``source`` and ``warehouse`` are (client, dt, visits, conversions); the goal frames are
    (client, dt, goal_id, conversions). ``goal_list`` and ``known_goals`` name the goals of
    each side and default to those with rows. Conversions are compared as the sum over known
    goals, as totals when the warehouse knows no goal, and not at all for a client with a
    known goal that the source does not report. ``ignored`` goals count as unknown.
    """
    values = ["visits", "conversions"]
    totals = _sides(source, warehouse, values).drop("s_rows", "w_rows").withColumn("goal_id", F.lit(None).cast("bigint"))
    goals = _sides(source_goals, warehouse_goals, ["conversions"]).withColumnsRenamed(
        {"s_conversions": "s_goal", "w_conversions": "w_goal"}
    )
    goals = goals.withColumns(
        {
            "listed": F.lit(0) if goal_list is not None else F.col("s_rows"),
            "known": F.lit(0) if known_goals is not None else F.col("w_rows"),
        }
    ).drop("s_rows", "w_rows")
    stacked = totals.unionByName(goals, allowMissingColumns=True)
    for frame, mark in ((goal_list, "listed"), (known_goals, "known"), (ignored, "ignored")):
        if frame is not None:
            stacked = stacked.unionByName(frame.select("client", "goal_id", F.lit(1).alias(mark)), allowMissingColumns=True)
    if ignored is None:
        stacked = stacked.withColumn("ignored", F.lit(0))

    marks, sums = ("listed", "known", "ignored"), ("s_visits", "w_visits", "s_conversions", "w_conversions", "s_goal", "w_goal")
    per_goal = stacked.groupBy("client", "dt", "goal_id").agg(
        *[_sum(c) for c in sums], *[F.coalesce(F.max(m), F.lit(0)).alias(m) for m in marks]
    )
    goal, client = Window.partitionBy("client", "goal_id"), Window.partitionBy("client")
    real = F.col("goal_id").isNotNull()
    per_goal = (
        per_goal.repartition("client")
        .withColumns({m: F.max(m).over(goal) for m in marks})
        .withColumn("known", real & (F.col("known") == 1) & (F.col("ignored") == 0))
        .withColumns(
            {"has_known": F.max("known").over(client), "has_missing": F.max(F.col("known") & (F.col("listed") == 0)).over(client)}
        )
    )
    days = per_goal.where(F.col("dt").isNotNull()).groupBy("client", "dt").agg(
        *[_sum(c) for c in sums[:4]],
        *[F.coalesce(F.sum(F.when(F.col("known"), F.col(f"{p}_goal"))), F.lit(0)).alias(f"{p}_known") for p in "sw"],
        F.max(real & ~F.col("known") & (F.col("ignored") == 0) & (F.col("s_goal") > 0)).alias("new_goal"),
        F.max("has_known").alias("has_known"),
        F.max("has_missing").alias("has_missing"),
    )

    present = {p: F.col(f"{p}_visits") + F.col(f"{p}_conversions") > 0 for p in "sw"}
    conversions_differ = (
        F.when(F.col("has_missing"), False)
        .when(F.col("has_known"), F.col("s_known") != F.col("w_known"))
        .otherwise(F.col("s_conversions") != F.col("w_conversions"))
    )
    if not compare_conversions:
        conversions_differ = F.lit(False)
    any_present = present["s"] | present["w"]
    reason = (
        F.when(present["s"] != present["w"], "presence")
        .when(any_present & (F.col("s_visits") != F.col("w_visits")), "visits")
        .when(any_present & conversions_differ, "conversions")
        .when(F.col("new_goal"), "new_goal")
    )
    return days.select("client", "dt", reason.alias("reason")).where(F.col("reason").isNotNull())


def goal_deltas(source_goals: DataFrame, warehouse_goals: DataFrame, limit: int = 15) -> DataFrame:
    """The first ``limit`` differing goals of each client and day by id, with the number of further ones."""
    per_goal = _sides(source_goals, warehouse_goals, ["conversions"]).groupBy("client", "dt", "goal_id").agg(
        _sum("s_conversions"), _sum("w_conversions")
    )
    differing = per_goal.where(F.col("s_conversions") != F.col("w_conversions"))
    day = Window.partitionBy("client", "dt")
    ranked = differing.withColumns(
        {"goal_rank": F.row_number().over(day.orderBy("goal_id")), "n": F.count("*").over(day)}
    )
    return ranked.where(F.col("goal_rank") <= limit).select(
        "client", "dt", "goal_id", "s_conversions", "w_conversions",
        (F.col("s_conversions") - F.col("w_conversions")).alias("delta"),
        F.greatest(F.col("n") - F.lit(limit), F.lit(0)).alias("more"),
    )


def diagnostics(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Per client: visits, conversions and days with data of both sides, and whether a side is empty."""
    both = _sides(source, warehouse, ["visits", "conversions"])
    return both.groupBy("client").agg(
        *[_sum(f"{p}_{v}") for p in "sw" for v in ("visits", "conversions")],
        *[F.count_if((F.col(f"{p}_visits") > 0) | (F.col(f"{p}_conversions") > 0)).alias(f"{p}_days") for p in "sw"],
        (F.max("s_rows") == 0).alias("s_empty"),
        (F.max("w_rows") == 0).alias("w_empty"),
    )
