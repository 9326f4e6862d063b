"""Paged JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import lenient_double

_BAD = "__bad"


def read_pages(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Landed pages, one JSON document per line, with a given schema. A cut page fails the job; ``landed.scan_json`` reports it instead."""
    pages = spark.read.json(path, schema=f"{schema}, {_BAD} string", columnNameOfCorruptRecord=_BAD)
    message = F.concat(F.lit("broken page in "), F.col("_metadata.file_path"), F.lit(": "), F.substring(_BAD, 1, 200))
    return pages.where(F.when(F.col(_BAD).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop(_BAD)


def explode_pages(pages: DataFrame, field: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of the array ``field``; struct records become columns."""
    rows = pages.select(*keep, F.explode(field).alias("__r"))
    return rows.select(*keep, "__r.*")


def zip_dims_metrics(rows: DataFrame, dims: Sequence[str], metrics: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Positional ``dimensions[]`` and ``metrics[]`` to named columns.

    A dimension is its name, else its id; a missing or null metric is 0. Rows without any
    dimension are dropped.
    """

    def dimension(i: int):
        d = F.get("dimensions", F.lit(i))
        return F.coalesce(F.nullif(d.getField("name"), F.lit("")), d.getField("id"))

    return rows.where(F.size("dimensions") > 0).select(
        *keep,
        *[dimension(i).alias(d) for i, d in enumerate(dims)],
        *[lenient_double(F.get("metrics", F.lit(i))).alias(m) for i, m in enumerate(metrics)],
    )
