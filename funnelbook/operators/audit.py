"""Stale clients and failed runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_days
from ..functions.text import blank_to_null, strip
from .summaries import last_dates

# States that count as failed, the tag that is left out, and the defaults of the reports.
ERROR_STATES = ("FAILED", "CRASHED", "CANCELLED")
IGNORED_TAG = "admin_bot"
NEWEST_RUNS = 50
RECENT_ALERTS = 20
STALE_DAYS = 30
ADMIN_LIST = 1_000


def stale_clients(sources: Mapping[str, tuple[DataFrame, str]], as_of: date, days: int = STALE_DAYS) -> DataFrame:
    """Clients whose newest day is more than ``days`` old, oldest first; one pass over each source."""
    newest = [last_dates(df, col).withColumn("source", F.lit(name)) for name, (df, col) in sources.items()]
    return (
        reduce(DataFrame.unionByName, newest)
        .where(F.col("max_date") < F.lit(as_of - timedelta(days=days)))
        .withColumn("days_since_update", age_days(F.lit(as_of), F.col("max_date")))
        .orderBy(F.col("days_since_update").desc(), "source", "client")
    )


def failed(runs: DataFrame, since: datetime, states=ERROR_STATES, ignored_tag: str = IGNORED_TAG) -> DataFrame:
    """Failed runs that ended after ``since`` and do not carry the ignored tag. Works on streams as well."""
    after = F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")
    tagged = F.coalesce(F.array_contains("tags", ignored_tag), F.lit(False))
    return runs.where(F.upper("state").isin(*states) & (F.col("end_time") > after) & ~tagged)


def newest_runs(runs: DataFrame, limit: int = NEWEST_RUNS) -> DataFrame:
    return runs.orderBy(F.col("end_time").desc(), F.col("id").desc()).limit(limit)


def recent_alerts(alerts: DataFrame, limit: int = RECENT_ALERTS) -> DataFrame:
    """The last alerts, newest first."""
    return newest_runs(alerts, limit)


def cleanup_entries(entries: DataFrame, sources: Sequence[str], selected: str | None = None) -> DataFrame:
    """Typed clean-up entries ``client`` or ``source:client`` with their source, client and error code.

    Without a selected source each entry must name one; with one, an entry may name no other.
    """
    entry = strip(F.col("entry"))
    named = entry.contains(":")
    parts = F.split(entry, ":", 2)
    source = F.when(named, F.lower(strip(F.get(parts, F.lit(0))))).otherwise(F.lit(selected))
    client = blank_to_null(F.when(named, F.get(parts, F.lit(1))).otherwise(entry))
    known = F.coalesce(source.isin(*sources), F.lit(False))
    if selected is not None:
        known = known & (source == selected)
    error = F.when(client.isNull(), "no_client").when(~known, "bad_source")
    ok = error.isNull()
    return entries.withColumns({"source": F.when(ok, source), "client": F.when(ok, client), "error": error})


def fan_out(runs: DataFrame, admins: DataFrame) -> DataFrame:
    """One alert per run and admin, for any number of admins.

    Admins are dealt to lists of about ``ADMIN_LIST`` ids. Each run gets the numbers of all lists and meets them by equality.
    """
    ids = admins.select("admin_id").where("admin_id IS NOT NULL").distinct()
    n = F.greatest(F.ceil(F.count("*") / ADMIN_LIST), F.lit(1)).cast("int")
    lists = ids.select(n.alias("n")).scalar()
    dealt = ids.groupBy(F.pmod(F.xxhash64("admin_id"), lists).cast("int").alias("__list")).agg(F.collect_list("admin_id").alias("__ids"))
    numbered = runs.withColumn("__list", F.explode(F.sequence(F.lit(0), lists - 1)))
    return numbered.join(dealt, "__list").withColumn("admin_id", F.explode("__ids")).drop("__list", "__ids")
