"""Daily aggregates per client. Every one is a single partial-then-final aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import in_window
from ..functions.numbers import int64_or_zero


def _total(df: DataFrame, c: str) -> Column:
    kind = dict(df.dtypes)[c]
    value = int64_or_zero(F.col(c)) if kind == "string" else F.col(c)
    total = F.coalesce(F.sum(value), F.lit(0))
    if kind.startswith("decimal"):
        scale = kind.partition(",")[2].rstrip(")")
        return total.cast(f"decimal(38,{scale})")
    return total if kind in ("double", "float") else total.cast("bigint")


def daily_summary(
    df: DataFrame, metrics: Sequence[str], start: date, end: date, *, date_col: str = "dt", keys: Sequence[str] = ("client",)
) -> DataFrame:
    """Sum of each metric per client and day. Text columns count as whole numbers, bad text as 0."""
    day = F.to_date(date_col).alias("dt")
    return (
        df.where(in_window(F.col(date_col), start, end))
        .groupBy(*keys, day)
        .agg(*[_total(df, m).alias(m) for m in metrics])
    )


def goal_daily(df: DataFrame, start: date, end: date, *, value: str = "conv", date_col: str = "dt") -> DataFrame:
    """Sum of each goal per client and day; rows without a goal do not count."""
    rows = df.where(F.col("goal_id").isNotNull())
    return daily_summary(rows, [value], start, end, date_col=date_col, keys=("client", "goal_id")).withColumnRenamed(
        value, "conversions"
    )


def daily_visits(visits: DataFrame, start: date, end: date, *, date_col: str = "ts") -> DataFrame:
    """Visits and conversions per client and day.

    Conversions come from ``u_sum_goal`` where stored, else from the wide ``u_goal_*`` columns, else 0.
    """
    if "u_sum_goal" in visits.columns:
        conversions = _total(visits, "u_sum_goal")
    else:
        wide = [c for c in visits.columns if c.startswith("u_goal_")]
        conversions = reduce(lambda a, b: a + b, [_total(visits, c) for c in wide], F.lit(0))
    count = _total(visits, "visits") if "visits" in visits.columns else F.lit(0)
    return (
        visits.where(in_window(F.col(date_col), start, end))
        .groupBy("client", F.to_date(date_col).alias("dt"))
        .agg(count.cast("bigint").alias("visits"), conversions.cast("bigint").alias("conversions"))
    )


def merge_slices(frames: Sequence[DataFrame], keys: Sequence[str] = ("client", "dt")) -> DataFrame:
    """Metric slices of the same days side by side, 0 where a slice lacks the day: one union, one aggregation."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return both.groupBy(*keys).agg(*[_total(both, c).alias(c) for c in both.columns if c not in keys])


def day_snapshot(df: DataFrame, *, date_col: str = "ts") -> DataFrame:
    """Rows, first and last time of each client and day."""
    return df.groupBy("client", F.to_date(date_col).alias("dt")).agg(
        F.count("*").alias("rows"), F.min(date_col).alias("min_ts"), F.max(date_col).alias("max_ts")
    )


def day_goal_detail(goals: DataFrame, visits: DataFrame, max_goals: int = 20) -> DataFrame:
    """Rows and visits of each day with its first ``max_goals`` goals by id (a diagnostic report)."""
    w = Window.partitionBy("client", "dt").orderBy("goal_id")
    top = goals.withColumn("goal_rank", F.row_number().over(w)).where(F.col("goal_rank") <= max_goals)
    return visits.join(top.drop("goal_rank"), ["client", "dt"], "left")


def last_dates(df: DataFrame, date_col: str = "dt") -> DataFrame:
    """Newest day of each client."""
    return df.groupBy("client").agg(F.max(F.to_date(date_col)).alias("max_date")).where(F.col("max_date").isNotNull())
