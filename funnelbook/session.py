"""Session helpers: the shared folder and materialised intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"funnelbook-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one named in ``spark.checkpoint.dir``.

    Only a local master (tests, a laptop) may leave it unset: a temporary folder is then made, once per
    application. On a cluster a machine-local folder would lose rows, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _own_dir(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of executors."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
