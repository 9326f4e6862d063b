"""Changed days to date ranges and reload jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_day


def collapse_ranges(days: DataFrame, key: str = "client") -> DataFrame:
    """Distinct days of each client to maximal runs of consecutive days.

    ``dt`` may be text; what is no date is skipped. The window sees one row per client and day.
    """
    day = F.col("dt") if dict(days.dtypes)["dt"] == "date" else parse_day(F.col("dt"))
    distinct = days.select(key, day.alias("dt")).where(F.col("dt").isNotNull()).distinct()
    w = Window.partitionBy(key).orderBy("dt")
    island = F.date_sub("dt", F.row_number().over(w))
    return (
        distinct.withColumn("__island", island)
        .groupBy(key, "__island")
        .agg(F.min("dt").alias("start"), F.max("dt").alias("end"))
        .drop("__island")
    )


def plan_jobs(changes: DataFrame, clients: DataFrame, profile: str) -> DataFrame:
    """Reload jobs for all clients.

    ``clients`` is (client, token). A client with changes gets one ``job`` row per range, one
    without gets an ``unchanged`` row, and a range without credential is reported as ``no_access``.
    """
    ranges = collapse_ranges(changes)
    joined = ranges.join(clients.select("client", "token"), "client", "full_outer")
    status = F.when(F.col("start").isNull(), "unchanged").when(F.col("token").isNull(), "no_access").otherwise("job")
    return joined.select("client", "token", "start", "end", F.lit(profile).alias("profile"), status.alias("status"))


def interval_plan(ranges: DataFrame, key: str = "client") -> DataFrame:
    """One row per client with ``ranges``, its (start, end) in order; ranges that share a day are joined.

    A client has at most as many ranges as its window has days, so the list fits its row. Null clients are a client of their
    own; ranges without both days, or that end before they start, are skipped. ``__steps`` are the powers of two up to the number of
    ranges, largest first: the strides in which ``range_of`` searches them.
    """
    w = Window.partitionBy(key).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    marked = ranges.where(F.col("start") <= F.col("end")).select(key, "start", "end").distinct().withColumn("__new", fresh)
    joined = marked.withColumn("__run", F.sum("__new").over(w)).groupBy(key, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    lists = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("ranges"))
    highest = F.length(F.bin(F.size("ranges"))) - 1
    return lists.withColumn("__steps", F.transform(F.sequence(highest, F.lit(0), F.lit(-1)), lambda k: F.power(F.lit(2), k).cast("int")))


def range_of(day: Column) -> Column:
    """The range of the plan row that holds the day, null outside of all.

    The ranges are in order and share no day, so the last one that starts by the day is found by halving: a row costs the logarithm
    of its client's number of ranges.
    """
    begun = F.aggregate("__steps", F.lit(0), lambda n, step: F.when(F.get("ranges", n + step - 1)["start"] <= day, n + step).otherwise(n))
    last = F.get("ranges", begun - 1)
    return F.when(day <= last["end"], last)


def range_audit(plan: DataFrame, stored: DataFrame, new: DataFrame, key: str = "client", day: str = "Date") -> DataFrame:
    """(client, start, end, removed, added): rows that a replace takes out of and puts into each planned range.

    Ranges without any row on either side are there with zeros. Rows are reduced to one per range and task before the only shuffle.
    """

    def counted(df: DataFrame, removed: int, added: int) -> DataFrame:
        hit = df.select(F.col(key).alias("__k"), F.to_date(day).alias("__d")).join(plan, F.col("__k").eqNullSafe(F.col(key)))
        hit = hit.select(key, F.explode(F.array(range_of(F.col("__d")))).alias("r")).where(F.col("r").isNotNull())  # searched once a row
        return hit.select(key, "r.start", "r.end", F.lit(removed).cast("bigint").alias("removed"), F.lit(added).cast("bigint").alias("added"))

    zero = plan.select(key, F.explode("ranges").alias("r")).select(key, "r.start", "r.end", F.lit(0).cast("bigint").alias("removed"), F.lit(0).cast("bigint").alias("added"))
    return zero.unionByName(counted(stored, 1, 0)).unionByName(counted(new, 0, 1)).groupBy(key, "start", "end").agg(F.sum("removed").alias("removed"), F.sum("added").alias("added"))
