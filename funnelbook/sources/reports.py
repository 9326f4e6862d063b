"""Tab-separated reports and visit logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_day
from ..functions.frames import cast_present
from ..functions.numbers import lenient_double, micros_to_units

# The two report profiles with their column types.
ANALYTICS_TYPES = {
    "Date": "date", "Criterion": "string", "AdFormat": "string", "AdId": "bigint", "CampaignType": "string",
    "CampaignName": "string", "AdGroupName": "string", "Clicks": "bigint", "Ctr": "double", "Cost": "double",
    "Impressions": "bigint", "Conversions": "bigint", "AvgImpressionPosition": "double", "AvgPageviews": "double",
    "AvgClickPosition": "double", "Bounces": "bigint", "Age": "string", "Gender": "string", "Device": "string",
    "LocationOfPresenceName": "string", "Sessions": "bigint", "Slot": "string", "Placement": "string",
    "AdNetworkType": "string", "AvgTrafficVolume": "double",
}
LIGHT_TYPES = {
    "Date": "date", "CampaignType": "string", "CampaignName": "string", "AdGroupName": "string", "Clicks": "bigint",
    "Conversions": "bigint", "Cost": "double", "Impressions": "bigint", "Bounces": "bigint", "Sessions": "bigint",
    "Placement": "string", "AdNetworkType": "string",
}
PROFILES = {"analytics": ANALYTICS_TYPES, "light": LIGHT_TYPES}
DEFAULT_PROFILE = "analytics"
_BAD = "__bad"


def resolve_profiles(option: str) -> list[str]:
    return list(PROFILES) if option == "both" else [option]


def profile_project(df: DataFrame, profile: str = DEFAULT_PROFILE, keep: Sequence[str] = ("client",)) -> DataFrame:
    """The columns of a profile that are present, after the ``keep`` columns; conversion columns stay."""
    wanted = PROFILES[profile]
    extra = [c for c in df.columns if c not in wanted and c.lower().startswith(("conversions_", "sumconversion"))]
    return df.select(*[c for c in keep if c in df.columns], *[c for c in wanted if c in df.columns], *extra)


def _read_tsv(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """All columns as text, so that no inference pass over the files is needed; a row with more or fewer fields fails the job.

    Files whose headers differ, and loads that go on without their faulty rows, are for ``landed.scan_headed``.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, _BAD)])
    # a reader that parses only some columns does not count the fields of a row
    whole = spark.read.option("columnPruning", False)
    rows = whole.csv(path, sep="\t", header=True, schema=schema, enforceSchema=False, columnNameOfCorruptRecord=_BAD)
    message = F.concat(F.lit("broken row in "), F.col("_metadata.file_path"), F.lit(": "), F.substring(_BAD, 1, 200))
    return rows.where(F.when(F.col(_BAD).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop(_BAD)


def read_report_tsv(spark: SparkSession, path: str | list[str], types: Mapping[str, str], *, micros: bool = False, drop_bad_days: bool = False) -> DataFrame:
    """Tab-separated report: ``--`` is 0, ``Date`` is a day, numbers are read leniently. Rows with an empty ``Date`` are dropped.

    A ``Date`` that is no day fails the job, as a row of the wrong size does: both are what a cut file leaves. With
    ``drop_bad_days`` such rows are dropped instead. With ``micros`` the cost is in millionths (daily check reports).
    """
    raw = _read_tsv(spark, path, list(types))
    cleaned = raw.select(*[F.when(F.col(c) == "--", "0").otherwise(F.col(c)).alias(c) for c in raw.columns])
    if "Date" in types:
        cleaned = cleaned.where(F.coalesce("Date", F.lit("")) != "")
        day = parse_day(F.col("Date"))
        no_day = F.raise_error(F.concat(F.lit("no day: "), F.col("Date"))).cast("date")
        cleaned = cleaned.where(day.isNotNull()).withColumn("Date", day) if drop_bad_days else cleaned.withColumn("Date", F.coalesce(day, no_day))
    out = cast_present(cleaned, {c: t for c, t in types.items() if t in ("bigint", "double") or t.startswith("decimal")})
    if micros and "Cost" in types:
        out = out.withColumn("Cost", micros_to_units(lenient_double(F.col("Cost"))))
    return out


def read_visit_parts(spark: SparkSession, path: str | list[str], types: Mapping[str, str]) -> DataFrame:
    """Many part files of a visit log in one scan; ids stay text, other types by ``types``."""
    return cast_present(_read_tsv(spark, path, list(types)), {c: t for c, t in types.items() if t != "string"})
