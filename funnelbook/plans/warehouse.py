"""Partitioned Parquet tables that can replace date ranges of single clients.

One table per source holds all clients. It is partitioned by ``part`` = period (day, month or year) and client bucket, for example
``20240131-007``; the number of partitions depends on the layout, not on the number of clients. Replacing ranges rewrites
the partitions that the table has in them and no others (copy on write): the planned ranges of a client are one row, and a stored row
is tested against them where it is read, so what is kept is shuffled once, for the write. The
new content is computed in full and moved in at the end of the write, so a failed job leaves the table as it was. A partition that
loses its last row is dropped after that.

Whole tables are replaced by a swap: the new version is written once, to a folder of its own, and two renames put it in place of the
old one, which is there until then. A swap that was cut off is finished at the next look at the table. This is the only
module that runs actions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, shared_dir
from .reload import interval_plan, range_audit, range_of

PART = "part"

# Spark and Python patterns of the partition periods.
PERIODS = {"day": ("yyyyMMdd", "%Y%m%d"), "month": ("yyyyMM", "%Y%m"), "year": ("yyyy", "%Y")}

#: Planned ranges up to which a plan is sent to every task (some 50 MB); a longer one is joined by client.
SMALL_PLAN = 1_000_000


class Warehouse:
    def __init__(self, spark: SparkSession, schema: str | None = None, location: str | None = None, *, buckets: int = 64, period: str = "month"):
        """A schema at ``location`` (by default a fresh folder in the shared directory).

        ``buckets`` is the number of client buckets per ``period``; both must stay the same for
        the life of the tables.
        """
        self.spark = spark
        self.period = period
        self.buckets = buckets
        self.schema = schema or f"fb_{uuid.uuid4().hex}"
        self.location = location or shared_dir(spark)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema} LOCATION '{self.location}'")

    # -- layout ------------------------------------------------------------------------------

    def _name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def _there(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._name(name))

    def exists(self, table: str) -> bool:
        """Whether the table is there; a swap that was cut off is finished first."""
        if not self._there(table) and self._there(f"{table}__new"):
            self._rename(f"{table}__new", table)
        if self._there(table) and self._there(f"{table}__old"):
            self._remove(f"{table}__old")
        return self._there(table)

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._name(old)} RENAME TO {self._name(new)}")

    def _remove(self, name: str) -> None:
        """Drop a version and its files: a table with a folder of its own keeps them when dropped, so it is emptied first."""
        with self._overwrite_mode("static"):
            self.spark.createDataFrame([], self.spark.table(self._name(name)).schema).write.insertInto(self._name(name), overwrite=True)
        self.spark.sql(f"DROP TABLE {self._name(name)}")

    @contextmanager
    def _staged(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` written once, as a table of the schema that is dropped with its files at the end."""
        name = self._name(f"staged_{uuid.uuid4().hex}")
        df.write.format("parquet").saveAsTable(name)
        try:
            yield self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _part(self, day: str | Column, client: str | Column = "client") -> Column:
        return F.concat_ws("-", F.coalesce(F.date_format(day, PERIODS[self.period][0]), F.lit("0")), self._bucket(client))

    def _bucket(self, client: str | Column = "client") -> Column:
        return F.lpad(F.pmod(F.xxhash64(client), F.lit(self.buckets)).cast("string"), 3, "0")

    def _parts(self, table: str) -> DataFrame:
        """``part`` of each partition that the table has, from its metadata."""
        named = self.spark.sql(f"SHOW PARTITIONS {self._name(table)}")
        return named.select(F.regexp_extract("partition", f"{PART}=(.*)$", 1).alias(PART))

    def read(self, table: str, start: date | None = None, end: date | None = None) -> DataFrame:
        """The table without its layout column; a window prunes periods at planning time."""
        df = self.spark.table(self._name(table))
        fmt = PERIODS[self.period][1]
        if start is not None:
            df = df.where((F.col(PART) >= start.strftime(fmt)) & (F.col("Date") >= F.lit(start)))
        if end is not None:
            df = df.where((F.col(PART) < end.strftime(fmt) + "~") & (F.col("Date") <= F.lit(end)))
        return df.drop(PART)

    def _laid_out(self, df: DataFrame, order: Iterable[str]) -> DataFrame:
        """Rows gathered by partition for few files; AQE splits partitions that are too large for one task.

        A table without ``Date`` or ``client`` (credentials, goals) has one period or one bucket.
        Columns of the sort order that are absent are left out, down to the first column.
        """
        day = F.col("Date") if "Date" in df.columns else F.lit(None).cast("date")
        client = F.col("client") if "client" in df.columns else F.lit(None).cast("string")
        keys = [c for c in order if c in df.columns] or df.columns[:1]
        return df.withColumn(PART, self._part(day, client)).hint("rebalance", PART).sortWithinPartitions(PART, *keys)

    # -- append and schema -------------------------------------------------------------------

    def write(self, table: str, df: DataFrame, order: Iterable[str] = ("client", "Date")) -> None:
        """Append; the table is created or its schema extended first. Columns are nullable always."""
        if self.exists(table):
            self.add_missing_columns(table, df)
            rows = self._conform(table, self._laid_out(df, order))
            rows.write.mode("append").insertInto(self._name(table))
        else:
            self._create(table, df, order)

    def _create(self, name: str, df: DataFrame, order: Iterable[str]) -> None:
        """A table in a folder of its own, known to the catalog when all its files are there."""
        folder = f"{self.location}/{name}-{uuid.uuid4().hex}"
        self._laid_out(df, order).write.partitionBy(PART).format("parquet").option("path", folder).saveAsTable(self._name(name))

    def replace_table(self, table: str, df: DataFrame, order: Iterable[str] = ("client", "Date")) -> None:
        """Full replace by a swap. ``df`` may be derived from the table; columns that only the table has stay, with their defaults."""
        if not self.exists(table):
            self.write(table, df, order)
            return
        self.add_missing_columns(table, df)
        self._swap(table, self._conform(table, df.withColumn(PART, F.lit(None).cast("string"))).drop(PART), order)

    def _swap(self, table: str, df: DataFrame, order: Iterable[str] = ("client", "Date")) -> None:
        """Write the next version of an existing table once and put it in the place of the old one."""
        fresh = f"{table}__new"
        defaults = {f.name: f.metadata["CURRENT_DEFAULT"] for f in self.spark.table(self._name(table)).schema.fields if "CURRENT_DEFAULT" in (f.metadata or {})}
        if self._there(fresh):  # left by a job that ended before its swap
            self._remove(fresh)
        self._create(fresh, df, order)
        for column, default in defaults.items():
            self.spark.sql(f"ALTER TABLE {self._name(fresh)} ALTER COLUMN `{column}` SET DEFAULT {default}")
        self._rename(table, f"{table}__old")
        self._rename(fresh, table)
        self._remove(f"{table}__old")
        self.spark.catalog.refreshTable(self._name(table))

    def _conform(self, table: str, df: DataFrame) -> DataFrame:
        """Stored columns, order and types; absent columns take their default, 0 for goal columns, else null.

        A value that does not fit the stored type fails the write under ANSI mode, Spark's default.
        """
        stored = self.spark.table(self._name(table)).schema
        have = set(df.columns)

        def column(f: T.StructField) -> Column:
            if f.name in have:
                return F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
            default = f.metadata.get("CURRENT_DEFAULT") if f.metadata else None
            return (F.expr(default) if default else F.lit(None)).cast(f.dataType).alias(f.name)

        return df.select(*[column(f) for f in stored.fields])

    def add_missing_columns(self, table: str, df: DataFrame) -> T.StructType:
        stored = set(self.spark.table(self._name(table)).columns)
        fresh = [f for f in df.schema.fields if f.name not in stored]
        if fresh:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
            self.spark.sql(f"ALTER TABLE {self._name(table)} ADD COLUMNS ({cols})")
        return self.spark.table(self._name(table)).drop(PART).schema

    def add_goal_columns(self, table: str, names: Iterable[str]) -> int:
        """Wide form of a goal without data: a column that reads 0 in stored rows. Absent table: nothing."""
        if not self.exists(table):
            return 0
        stored = set(self.spark.table(self._name(table)).columns)
        fresh = [n for n in names if n not in stored]
        if fresh:
            cols = ", ".join(f"`{n}` BIGINT DEFAULT 0" for n in fresh)
            self.spark.sql(f"ALTER TABLE {self._name(table)} ADD COLUMNS ({cols})")
        return len(fresh)

    def upgrade_types(self, table: str, wanted: Mapping[str, str]) -> dict[str, int]:
        """Stored text columns become the wanted type; anything else stays. Returns bad values per column.

        The converted rows are written once, as the next version of the table.
        """
        if not self.exists(table):
            return {}
        old = self.spark.table(self._name(table))
        current = dict(old.dtypes)
        todo = {c: t for c, t in wanted.items() if current.get(c) == "string" and t != "string" and c != PART}
        if not todo:
            return {}
        seen = Observation()
        bad = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in todo.items()]
        new = old.drop(PART).observe(seen, *bad).withColumns({c: F.col(c).try_cast(t) for c, t in todo.items()})
        self._swap(table, new)
        return dict(seen.get)

    # -- replace -----------------------------------------------------------------------------

    def range_replace(self, table: str, new: DataFrame, ranges: DataFrame, *, empty: str = "delete") -> None:
        """Delete the days of ``ranges`` (client, start, end; inclusive), then add ``new`` rows of those days.

        Rows of ``new`` outside the ranges are ignored. Days that vanished at the source lose their rows. An absent table is
        created. ``empty`` says what a planned range without any new row means: ``delete`` its stored rows, ``keep`` them, or ``fail``
        before anything is changed. Null clients are a client like any other.
        """
        if empty not in ("delete", "keep", "fail"):
            raise ValueError(f"unknown meaning of empty ranges: {empty}")
        with self._staged(interval_plan(ranges)) as plan:
            if empty == "delete":
                self._replace_planned(table, new, plan)
                return
            with self._staged(self._in_plan(new, self._sent(plan))) as wanted:
                blank = self._sent(plan)
                counts = range_audit(blank, wanted.limit(0), wanted)
                if empty == "fail":
                    missing = counts.where("added = 0").orderBy("client", "start").limit(20).collect()  # enough to name some
                    if missing:
                        raise ValueError("planned ranges without rows: " + ", ".join(f"{r['client']} {r['start']}..{r['end']}" for r in missing))
                    self._replace_planned(table, wanted, plan)
                else:
                    with self._staged(interval_plan(counts.where("added > 0"))) as full:
                        self._replace_planned(table, wanted, full)

    def audit(self, table: str, new: DataFrame, ranges: DataFrame) -> DataFrame:
        """What ``range_replace`` would do: (client, start, end, removed, added) for each planned range. Reads the touched partitions only.

        The plan is worked out once and kept in the shared folder, where the result reads it.
        """
        plan = materialise(interval_plan(ranges), f"{shared_dir(self.spark)}/plan")
        sent = self._sent(plan)
        if not self.exists(table):
            return range_audit(sent, new.limit(0), new)
        stored = self.spark.table(self._name(table)).where(F.col(PART).isin(*self._touched(table, plan)))
        return range_audit(sent, stored, new)

    def _sent(self, plan: DataFrame) -> DataFrame:
        """A plan for joining rows to it: sent to every task if it is small, which is counted, else joined by client with its skew split."""
        size = plan.agg(F.sum(F.size("ranges") + 1)).first()[0] or 0
        return F.broadcast(plan) if size <= SMALL_PLAN else plan

    def _in_plan(self, rows: DataFrame, plan: DataFrame, inside: bool = True) -> DataFrame:
        """Rows on planned days, or those on no planned day.

        The day is tested in the join itself, so no row carries its client's list of ranges.
        """
        there = plan.withColumnRenamed("client", "__client")
        planned = F.col("client").eqNullSafe(F.col("__client")) & range_of(F.to_date("Date")).isNotNull()
        return rows.join(there, planned, "left_semi" if inside else "left_anti")

    def _touched(self, table: str, plan: DataFrame) -> list[str]:
        """Partitions of the table that hold planned days: a subset of its layout.

        Equal ranges of a bucket's clients are one row before they are spread over periods, so a window for all clients
        costs one row a bucket.
        """
        spans = plan.select(self._bucket().alias("b"), F.explode("ranges").alias("r")).select("b", "r.start", "r.end").distinct()
        days = F.sequence("start", "end", F.expr("interval 1 day"))
        code = PERIODS[self.period][0]
        periods = spans.select("b", F.explode(F.array_distinct(F.transform(days, lambda d: F.date_format(d, code)))).alias("p")).distinct()
        return [r[0] for r in self._parts(table).join(periods.select(F.concat_ws("-", "p", "b").alias(PART)), PART, "left_semi").collect()]

    def _replace_planned(self, table: str, new: DataFrame, plan: DataFrame) -> None:
        sent = self._sent(plan)
        wanted = self._in_plan(new, sent)
        if not self.exists(table):
            self.write(table, wanted)
            return
        self.add_missing_columns(table, new)
        self._rewrite(table, self._touched(table, plan), lambda rows: self._in_plan(rows, sent, inside=False), wanted)

    def erase_range(self, table: str, clients: DataFrame, start: date, end: date) -> None:
        """Delete a window for the listed clients."""
        if self.exists(table):
            ranges = clients.select("client").distinct().select("client", F.lit(start).alias("start"), F.lit(end).alias("end"))
            self.range_replace(table, self.read(table).limit(0), ranges)

    def full_reload(self, table: str, new: DataFrame, start: date, end: date, clients: DataFrame | None = None) -> None:
        """Replace a whole window without detection, for the given clients or for all of either side.

        For all clients the days alone decide, so rows without a client are replaced as well.
        """
        if clients is not None:
            self.range_replace(table, new, clients.select("client").distinct().select("client", F.lit(start).alias("start"), F.lit(end).alias("end")))
            return
        inside = F.coalesce(F.to_date("Date").between(F.lit(start), F.lit(end)), F.lit(False))
        if not self.exists(table):
            self.write(table, new.where(inside))
            return
        self.add_missing_columns(table, new)
        first, last = (d.strftime(PERIODS[self.period][1]) for d in (start, end))
        touched = self._parts(table).where(F.substring_index(PART, "-", 1).between(first, last)).collect()
        self._rewrite(table, [r[0] for r in touched], lambda rows: rows.where(~inside), new.where(inside))

    def cleanup_clients(self, clients: DataFrame, tables: Iterable[str]) -> int:
        """Remove all rows of the listed clients from the tables; counts the (table, client) pairs removed.

        A ``source`` column in ``clients`` limits a row to the table of that name. Only the buckets of the listed clients are read.
        """
        names = [c for c in ("source", "client") if c in clients.columns]
        removed = 0
        with self._staged(clients.select(*names).where("client IS NOT NULL").distinct()) as every:
            for table in tables:
                if not self.exists(table):
                    continue
                gone = every.where(F.col("source") == table).drop("source") if "source" in names else every
                buckets = gone.select(self._bucket().alias("b")).distinct()
                near = self._parts(table).join(buckets, F.substring_index(PART, "-", -1) == F.col("b"), "left_semi").collect()
                if not near:
                    continue
                stored = self.spark.table(self._name(table)).where(F.col(PART).isin(*[r[0] for r in near]))
                hit = stored.join(gone, "client", "left_semi")
                parts, count = hit.agg(F.collect_set(PART), F.count_distinct("client")).first()
                self._rewrite(table, parts, lambda rows, gone=gone: rows.join(gone, "client", "left_anti"), None)
                removed += count
        return removed

    @contextmanager
    def _overwrite_mode(self, mode: str) -> Iterator[None]:
        """``dynamic``: only partitions that get rows are replaced, and a table may be read while it is written.

        A writer's own option does not reach inserts into a table, so the session's setting is changed for this one write.
        """
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, mode)
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def _rewrite(self, table: str, parts: list[str], keep, new: DataFrame | None) -> None:
        """Write the given partitions anew: what ``keep`` leaves of their rows, plus ``new``.

        ``parts`` comes from the table layout, so it has at most periods x buckets entries. ``new`` may add further partitions.
        """
        if not parts and new is None:
            return
        name = self._name(table)
        rows = keep(self.spark.table(name).where(F.col(PART).isin(*parts) if parts else F.lit(False))).drop(PART)
        if new is not None:
            rows = rows.unionByName(self._conform(table, new).drop(PART))
        written = Observation()
        out = self._conform(table, self._laid_out(rows, ("client", "Date")))
        out = out.observe(written, F.collect_set(PART).alias("parts"))
        with self._overwrite_mode("dynamic"):
            out.write.insertInto(name, overwrite=True)
        for part in sorted(set(parts) - set(written.get["parts"] or [])):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PART} = '{part}')")
        self.spark.catalog.refreshTable(name)
