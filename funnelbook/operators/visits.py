"""Visit report and visit log to one clean row per visit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import strip_prefix
from ..functions.labels import device_label, robot_flag
from ..functions.nested import list_of_longs, list_of_strings
from ..functions.numbers import finite_or_null, lenient_long
from ..functions.text import VISIT_NULL_WORDS, VISIT_UNDEFINED_WORDS, null_words
from ..plans.skew import skew_join
from .goals import goal_sums

VISIT_PREFIX = "ym:s:"

# Report columns of which a visit keeps its first known value.
FIRST_COLUMNS = (
    "gender", "isRobot", "regionArea", "userVisits", "userVisitsPeriod", "ageInterval", "visits",
    "lastsignSearchPhrase", "lastsignSourceEngine",
)
# Columns in which the "undefined" words mean null, 0/1 columns, whole-number columns.
UNDEFINED_COLUMNS = ("ageInterval", "gender", "regionArea", "screenFormat")
FLAG_COLUMNS = ("bounce", "isNewUser")
LONG_COLUMNS = (
    "userVisits", "visits", "visitDuration", "pageViews", "browserMajorVersion", "clientTimeZone",
    "lastsignDirectBannerGroup", "lastsignDirectClickBanner",
)
TIME_COLUMNS = ("dateTime", "dateTimeUTC")


def collapse_visits(report: DataFrame, keys: Sequence[str], first: Sequence[str], joined: str, pos: str) -> DataFrame:
    """One row per visit: first non-null value by ``pos``, and distinct ``joined`` values in arrival order.

    Two levels: repeats of a value are folded on the map side before the values of a visit
    meet, so what is collected is bounded by the distinct values, which the result holds anyway.
    """


    folded = report.groupBy(*keys, joined).agg(
        F.min(pos).alias("__pos"),
        *[
            F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).alias("v")))).alias(c)
            for c in first
        ],
    )
    merged = folded.groupBy(*keys).agg(
        *[F.min(c).getField("v").alias(c) for c in first],
        F.array_sort(
            F.collect_list(F.when(F.col(joined).isNotNull(), F.struct(F.col("__pos"), F.col(joined).alias("v"))))
        ).alias(joined),
    )
    return merged.withColumn(joined, F.array_join(F.transform(joined, lambda s: s.getField("v")), ", "))


def enrich_visits(report: DataFrame, logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report rows with their log columns; rows without duration or page views are dropped.

    That filter also drops report rows without a log row, so an inner join says the same;
    ``unmatched_visits`` counts them. Rows of a hot key (repeated or placeholder ids in the log) are split by adaptive
    execution; each side is read once.
    """
    joined = skew_join(report, logs, keys)
    return joined.where(F.col("visitDuration").isNotNull() & F.col("pageViews").isNotNull())


def unmatched_visits(report: DataFrame, logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report rows for which the log has nothing, counted per client."""
    return report.join(logs.select(*keys).distinct(), list(keys), "left_anti").groupBy("client").agg(F.count("*").alias("unmatched"))


def clean_visits(df: DataFrame) -> DataFrame:
    """Names without prefix, null words, labels, flags, whole numbers and times; columns that are absent stay absent."""
    df = strip_prefix(df, VISIT_PREFIX)
    out = {}
    for name, kind in df.dtypes:
        c = F.col(name)
        if name == "interest":
            c = null_words(c, VISIT_NULL_WORDS, blank=True)
        elif name == "deviceCategory":
            c = device_label(c)
        elif name == "isRobot":
            c = robot_flag(c)
        elif name in FLAG_COLUMNS:
            c = lenient_long(c).cast("int")
        elif name in LONG_COLUMNS:
            c = lenient_long(c)
        elif name == "userVisitsPeriod":
            c = c.cast("string").try_cast("bigint")
        elif name in TIME_COLUMNS:
            c = c.try_cast("timestamp_ntz")
        elif kind in ("double", "float"):
            c = finite_or_null(c)
        elif kind == "string":
            words = VISIT_NULL_WORDS + (VISIT_UNDEFINED_WORDS if name in UNDEFINED_COLUMNS else ())
            c = null_words(c, words)
        out[name] = c
    return df.withColumns(out)


def shape_visits(report: DataFrame, logs: DataFrame, goals: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """Report and log to finished visits: collapse, join, clean, parse goal lists, sum goals.

    ``goals`` is the dimension (client, goal_id, class). A client without goals keeps its
    visits, with sums of 0. The goal lists stay in the row as arrays for ``goal_hits``.
    """
    report, logs = strip_prefix(report, VISIT_PREFIX), strip_prefix(logs, VISIT_PREFIX)
    first = [c for c in FIRST_COLUMNS if c in report.columns]
    one = collapse_visits(report, keys, first, "interest", pos)
    visits = clean_visits(enrich_visits(one, logs, keys))
    visits = visits.withColumns(
        {"goalsID": list_of_longs(F.col("goalsID")), "goalsDateTime": list_of_strings(F.col("goalsDateTime"))}
    )
    return goal_sums(visits, goals, "goalsID", logs.select("client", list_of_longs(F.col("goalsID")).alias("goalsID")))


def dedup_visits(visits: DataFrame, keys: Sequence[str], order: str, *ties: str) -> DataFrame:
    """Newest row per visit; equal order values are decided by ``ties``, the largest first. Catalyst limits each group before the shuffle, so a hot key is harmless."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (order, *ties)])
    return visits.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
