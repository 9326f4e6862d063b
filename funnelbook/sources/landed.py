"""Landed text files in which nothing is lost without a word.

Files are read as lines. Each tab-separated file brings its own header, so files with different columns share one scan: fields
are put into a map by the names of their file's header. Every line gets a ``fault`` where it cannot be what its source wrote;
the ledger counts faults by file, ``good`` keeps the rest, ``strict`` fails the job that reads a faulty line. So a cut file either
stops a load or is reported before anything is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column of the scan with the name of what is wrong, null for good lines.
FAULT = "fault"


def _fields(line: Column) -> Column:
    """Fields between tabs; a field in double quotes is what stands between them. A tab inside quotes still cuts, which the count then shows."""

    def bare(x: Column) -> Column:
        inner = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        return F.when((F.length(x) > 1) & x.startswith('"') & x.endswith('"'), inner).otherwise(x)

    cut = F.split(line, "\t", -1)
    return F.when(line.contains('"'), F.transform(cut, bare)).otherwise(cut)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line`` and ``file`` of every non-empty line, with the columns that folder names give (``client=..``)."""
    lines = spark.read.text(path)
    folders = [c for c in lines.columns if c != "value"]
    line = F.regexp_replace("value", "^﻿|\r$", "")
    return lines.select(*folders, F.col("_metadata.file_path").alias("file"), line.alias("line")).where(F.col("line") != "")


def file_headers(lines: DataFrame, known: Sequence[str], prefixes: Sequence[str] = ()) -> DataFrame:
    """``file``, ``names`` (its header's fields) and ``several`` (headers that differ), one row per file.

    A line is a header if all of its fields are column names: on the list, or with one of the prefixes in any case. A line of
    data holds a day or a number, so it never is, wherever it stands. Lines that do not start with a name are not cut up.
    """
    starts = [p.lower() for p in prefixes]

    def named(x: Column) -> Column:
        found = x.isin(*known)
        for p in starts:
            found = found | F.lower(x).startswith(p)
        return found

    first = F.substring_index("line", "\t", 1)
    heads = lines.where(named(F.replace(first, F.lit('"'))) & F.forall(_fields(F.col("line")), named))
    return heads.groupBy("file").agg(F.min("line").alias("h"), (F.min("line") != F.max("line")).alias("several")).select(
        "file", F.col("h").alias("header"), _fields(F.col("h")).alias("names"), "several"
    )


def scan_headed(lines: DataFrame, known: Sequence[str], prefixes: Sequence[str] = ()) -> DataFrame:
    """The lines of data with ``fields``, a map from column name to text, and ``fault``.

    Faults: ``no header``, ``several headers`` (that differ), ``repeated column``, ``short row``, ``long row``. Header lines are left out. A file without any line gives
    none. Headers are one row per file and are joined by file; where they do not fit a broadcast, a file with very many lines is split
    by the skew join of adaptive execution.
    """
    heads = file_headers(lines, known, prefixes).withColumnRenamed("file", "__file")
    both = lines.join(heads, F.col("file") == F.col("__file"), "left")
    data = both.where(F.col("header").isNull() | (F.col("line") != F.col("header")))
    row = _fields(F.col("line"))
    fault = (
        F.when(F.col("names").isNull(), "no header").when(F.col("several"), "several headers")
        .when(F.size(F.array_distinct("names")) < F.size("names"), "repeated column")
        .when(F.size("__row") < F.size("names"), "short row").when(F.size("__row") > F.size("names"), "long row")
    )
    kept = [c for c in lines.columns if c != "line"]
    found = data.withColumn("__row", row).withColumn(FAULT, fault)
    fields = F.when(F.col(FAULT).isNull(), F.map_from_arrays("names", "__row"))
    return found.select(*kept, "line", fields.alias("fields"), FAULT)


def scan_json(lines: DataFrame, schema: str, required: Sequence[str] = ()) -> DataFrame:
    """One JSON document per line: the columns of ``schema`` and ``fault``.

    Faults: ``no JSON`` (cut or otherwise malformed, also values that do not fit the schema), ``missing <name>`` for a required
    field that is absent or null, such as the records of a page.
    """
    kept = [c for c in lines.columns if c != "line"]
    parsed = lines.withColumn("__p", F.from_json("line", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    fault = F.when(F.col("__p").isNull() | F.col("__p.__bad").isNotNull(), "no JSON")
    for name in required:
        fault = fault.when(F.col(f"__p.{name}").isNull(), f"missing {name}")
    names = [f.name for f in lines.sparkSession.createDataFrame([], schema).schema.fields]
    return parsed.select(*kept, "line", *[F.col(f"__p.`{n}`").alias(n) for n in names], fault.alias(FAULT))


def add_faults(scanned: DataFrame, faults: dict[str, Column]) -> DataFrame:
    """Further named conditions for lines that are good so far; the first that holds counts."""
    every = F.col(FAULT)
    for name, wrong in faults.items():
        every = F.coalesce(every, F.when(wrong, F.lit(name)))
    return scanned.withColumn(FAULT, every)


def ledger(scanned: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """``keys``, ``fault``, ``rows`` and ``example`` (the first such line in order) for each fault of a file. One aggregation."""
    return scanned.where(F.col(FAULT).isNotNull()).groupBy(*keys, FAULT).agg(F.count("*").alias("rows"), F.min("line").alias("example"))


def scan_counts(scanned: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """``keys``, ``good`` and ``faulty`` lines."""
    return scanned.groupBy(*keys).agg(F.count_if(F.col(FAULT).isNull()).alias("good"), F.count_if(F.col(FAULT).isNotNull()).alias("faulty"))


def good(scanned: DataFrame) -> DataFrame:
    """The lines without a fault."""
    return scanned.where(F.col(FAULT).isNull()).drop(FAULT)


def strict(scanned: DataFrame) -> DataFrame:
    """All lines; the job that reads a faulty one fails and names file, fault and line."""
    message = F.concat_ws(" ", F.col(FAULT), F.lit("in"), F.col("file") if "file" in scanned.columns else F.lit("input"), F.lit(":"), F.substring("line", 1, 200))
    return scanned.where(F.when(F.col(FAULT).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop(FAULT)
