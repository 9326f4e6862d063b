"""Date windows, day series and blocks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADS_LOOKBACK = 60
VISITS_LOOKBACK = 60
CALLS_LOOKBACK = 10
GROUPS_LOOKBACK = 10
BLOCK_DAYS = 5


def resolve_window(
    as_of: date, lookback: int, start: date | None = None, end: date | None = None, *, extra_day: bool = False
) -> tuple[date, date]:
    """Inclusive window. Given dates win; else it ends yesterday and spans ``lookback`` days.

    Calls and groups look back one day more than ads and visits (``extra_day``).
    """
    last = end or as_of - timedelta(days=1)
    days = max(1, int(lookback))
    return start or last - timedelta(days=days if extra_day else days - 1), last


def day_series(windows: DataFrame) -> DataFrame:
    """One row per day of each (.., start, end) row; none where start is after end."""
    days = F.sequence("start", "end", F.expr("interval 1 day"))
    ordered = windows.where(F.col("start") <= F.col("end"))
    return ordered.withColumn("dt", F.explode(days)).drop("start", "end")


def window_chunks(windows: DataFrame, days: int = BLOCK_DAYS) -> DataFrame:
    """Inclusive blocks of at most ``days`` days that cover each (.., start, end) row exactly."""
    ordered = windows.where(F.col("start") <= F.col("end"))
    starts = F.sequence("start", "end", F.expr(f"interval {int(days)} days"))
    blocks = ordered.withColumn("chunk_start", F.explode(starts))
    return blocks.withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), F.col("end"))).drop("start", "end")
