"""What several operators share: reading tables, written intermediate tables, shingles of bytes."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import materialise, shared_dir

#: A-Z to a-z; every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A-Z to a-z, digits, letters and bytes of non-ASCII characters kept, every other byte a space.
WORDS = bytes(c if 48 <= (c := LOWER[b]) <= 57 or 97 <= c <= 122 or b >= 128 else 32 for b in range(256))


#: Where the library lies; a cluster gets it as any Python package (--py-files, an image), local workers from here.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if ROOT not in (path := spark.sparkContext.environment.get("PYTHONPATH", "")).split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (path, ROOT)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write to the folder that all executors share and read back: cuts lineage, survives lost executors."""
    return materialise(df, shared_dir(df.sparkSession))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Smaller views of the batches, so that what Python holds of texts at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]
