"""Column-set helpers: pure projections, no action and no shuffle."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import lenient_double, lenient_long


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[re.sub(f"^{re.escape(prefix)}", "", c) for c in df.columns])


def align(df: DataFrame, types: Mapping[str, str], fill: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the listed columns in their order; absent ones are filled, extra ones are dropped."""
    fill = fill or {}
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit(fill.get(c))).try_cast(t).alias(c) for c, t in types.items()]
    )


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Absent columns are added as null."""
    have = set(df.columns)
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in have])


def drop_known(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop by name, where names may contain dots."""
    gone = set(names)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])


def select_prefix(df: DataFrame, prefix: str, ignore_case: bool = False) -> list[str]:
    if ignore_case:
        return sorted(c for c in df.columns if c.lower().startswith(prefix.lower()))
    return [c for c in df.columns if c.startswith(prefix)]


def metric_columns(df: DataFrame, allow: Sequence[str], prefixes: Sequence[str] = ()) -> list[str]:
    """Columns on the allow-list or with one of the prefixes, both without regard to case."""
    allow = {a.lower() for a in allow}
    starts = tuple(p.lower() for p in prefixes)
    return [c for c in df.columns if c.lower() in allow or (starts and c.lower().startswith(starts))]


def cast_present(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast those listed columns that are there; numbers leniently, the rest with ``try_cast``."""

    def cast(c: str) -> Column:
        t = types.get(c)
        if t is None:
            return F.col(f"`{c}`")
        if t == "bigint":
            return lenient_long(F.col(c)).alias(c)
        if t == "double":
            return lenient_double(F.col(c)).alias(c)
        return F.col(c).try_cast(t).alias(c)

    return df.select(*[cast(c) for c in df.columns])


def in_window(c: Column, start: date, end: date) -> Column:
    """Inclusive day filter. On a timestamp column it reaches the scan as a range."""
    return F.to_date(c).between(F.lit(start), F.lit(end))


def sum_columns(df: DataFrame, columns: Sequence[str]) -> Column:
    """Row total of the listed columns, null counted as 0."""
    total = F.lit(0).cast("bigint")
    for c in columns:
        total = total + F.coalesce(F.col(c).cast("bigint"), F.lit(0))
    return total
