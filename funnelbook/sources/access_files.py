"""Credential files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.access import COLUMNS, with_service


def read_access_file(spark: SparkSession, path: str) -> DataFrame:
    """CSV or TSV (by suffix) with a header, everything as text."""
    return spark.read.csv(path, header=True, sep="\t" if path.lower().endswith(".tsv") else ",", inferSchema=False)


def access_export(access: DataFrame) -> DataFrame:
    """The credential table with its type split, ordered by login and container."""
    return with_service(access.select(*COLUMNS)).orderBy("login", "container", "type", "token")


def export_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    (df.orderBy(*order) if order else df).write.mode("errorifexists").csv(path, header=True)
