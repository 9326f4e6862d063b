"""Ad reports as landed: one file per goal batch, each with the base metrics and the conversion columns of its own goals.

``Conversions_<goal>_<model>`` columns become rows (client, day, goal, model, conversions); the base metrics, which every
batch repeats, are taken once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_day
from ..functions.numbers import lenient_double, lenient_long, micros_to_units
from .landed import FAULT, add_faults, read_lines, scan_headed
from .reports import PROFILES

# How conversion columns are named, with goal and attribution model or as one total, and the word for "no value".
CONVERSIONS = "conversions"
GOAL_COLUMN = r"(?i)^conversions_([0-9]+)(?:_(.+))?$"
NO_VALUE = "--"


def _profile_types() -> dict[str, str]:
    return {c: t for types in PROFILES.values() for c, t in types.items()}


def scan_reports(spark: SparkSession, path: str | list[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Lines of reports by name, with folder columns, ``file``, ``fields``, ``fault`` and ``dt``.

    ``types`` are the columns that may occur (by default those of all profiles); conversion columns always may. Beside the faults of a
    headed scan: ``no day`` (a ``Date`` that is none) and ``no number`` (text in a number column other than ``--`` or nothing).
    """
    types = dict(types or _profile_types())
    scanned = scan_headed(read_lines(spark, path), list(types), [CONVERSIONS])
    numeric = {c for c, t in types.items() if t in ("bigint", "double")}
    counted = F.map_filter("fields", lambda k, v: k.isin(*numeric) | F.lower(k).startswith(CONVERSIONS))
    bad = F.exists(F.map_values(counted), lambda v: ~v.isin("", NO_VALUE) & v.try_cast("double").isNull())
    day = parse_day(F.element_at("fields", F.lit("Date")))
    return add_faults(scanned.withColumn("dt", day), {"no day": F.col("dt").isNull(), "no number": bad})


def _value(name: str, kind: str) -> Column:
    text = F.try_element_at("fields", F.lit(name))
    text = F.when(text == NO_VALUE, "0").otherwise(text)
    if kind == "bigint":
        return lenient_long(text)
    return lenient_double(text) if kind == "double" else text.try_cast(kind)


def base_rows(
    scanned: DataFrame, keys: Sequence[str], metrics: Sequence[str], dims: Mapping[str, str] | None = None, *, types: Mapping[str, str] | None = None, micros: bool = False
) -> DataFrame:
    """``keys``, ``dt``, the report's dimensions ``dims`` (column to output name) and ``metrics``, once however many batches repeat them.

    Metrics are summed within a file, and the largest of the files' sums counts: batches of one report agree, and a day that
    only one batch has is kept. With ``micros`` the cost is in millionths.
    """
    types, dims = dict(types or _profile_types()), dict(dims or {})
    at = [*keys, "dt", *dims.values()]
    rows = scanned.select("file", *keys, "dt", *[_value(c, "string").alias(n) for c, n in dims.items()], *[_value(m, types[m]).alias(m) for m in metrics])
    if micros and "Cost" in metrics:
        rows = rows.withColumn("Cost", micros_to_units(F.col("Cost")))
    each = rows.groupBy("file", *at).agg(*[F.sum(m).alias(m) for m in metrics])
    return each.groupBy(*at).agg(*[F.max(m).alias(m) for m in metrics])


def goal_rows(scanned: DataFrame, keys: Sequence[str], dims: Mapping[str, str] | None = None) -> DataFrame:
    """``keys``, ``dt``, ``dims``, ``goal_id``, ``model`` and ``conv`` of every goal with conversions.

    Only values above 0 leave their row, so a report with hundreds of goal columns does not grow; ``goal_columns`` names the goals
    without any. A goal that two batches report counts once.
    """
    dims = dict(dims or {})
    at = [*keys, "dt", *dims.values(), "goal_id", "model"]
    numbers = F.map_filter("fields", lambda k, v: F.lower(k).startswith(CONVERSIONS) & ~v.isin("0", "", NO_VALUE))
    rows = scanned.select("file", *keys, "dt", *[_value(c, "string").alias(n) for c, n in dims.items()], F.explode(numbers).alias("k", "v"))
    rows = rows.withColumns(
        {"goal_id": F.nullif(F.regexp_extract("k", GOAL_COLUMN, 1), F.lit("")).try_cast("bigint"), "model": F.regexp_extract("k", GOAL_COLUMN, 2), "conv": lenient_long(F.col("v"))}
    ).where(F.col("goal_id").isNotNull() & (F.col("conv") != 0))
    each = rows.groupBy("file", *at).agg(F.sum("conv").alias("conv"))
    return each.groupBy(*at).agg(F.max("conv").alias("conv"))


def goal_columns(scanned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ``keys``, ``goal_id`` and ``model`` of the conversion columns, whether or not any row has conversions."""
    names = F.filter(F.map_keys("fields"), lambda k: k.rlike(GOAL_COLUMN))
    rows = scanned.where(F.col("fields").isNotNull()).select(*keys, names.alias("names")).distinct()
    goals = rows.select(*keys, F.explode("names").alias("k"))
    return goals.select(*keys, F.regexp_extract("k", GOAL_COLUMN, 1).try_cast("bigint").alias("goal_id"), F.regexp_extract("k", GOAL_COLUMN, 2).alias("model")).distinct()


def ads_rows(scanned: DataFrame, keys: Sequence[str] = ("client",), *, types: Mapping[str, str] | None = None, micros: bool = False) -> DataFrame:
    """(client, dt, goal_id, impressions, clicks, cost, conv): base metrics in rows without a goal, conversions in rows of their goal."""
    base = base_rows(scanned, keys, ["Impressions", "Clicks", "Cost"], types=types, micros=micros)
    base = base.select(*keys, "dt", F.lit(None).cast("bigint").alias("goal_id"), F.col("Impressions").alias("impressions"), F.col("Clicks").alias("clicks"), F.col("Cost").alias("cost"), F.lit(0).cast("bigint").alias("conv"))
    goals = goal_rows(scanned, keys).groupBy(*keys, "dt", "goal_id").agg(F.sum("conv").alias("conv"))
    zero = {c: F.lit(0).cast(dict(base.dtypes)[c]) for c in ("impressions", "clicks", "cost")}
    return base.unionByName(goals.withColumns(zero))


__all__ = ["FAULT", "ads_rows", "base_rows", "goal_columns", "goal_rows", "scan_reports"]
