"""User table as an append log: a role change is a new row, the newest row of an id counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, positive_key
from .access import latest


def current_users(log: DataFrame) -> DataFrame:
    """(id, name, role) of each user from rows (id, name, role, version); of equal versions the largest role, then name, counts."""
    return latest(log, "id", "version", "role", "name").select("id", "name", "role")


def users_by_role(log: DataFrame, role: str) -> DataFrame:
    """Users whose current role is the given one."""
    return current_users(log).where(F.col("role") == role.strip())


def add_users(log: DataFrame, fresh: DataFrame, version: int) -> DataFrame:
    """Rows to append for users that are not there yet; known ids and bad ids are left out.

    ``fresh`` is (id, name, role) with the id as text. Of repeated ids the first by name is taken.
    """
    rows = fresh.select(
        positive_key(F.col("id").cast("string")).alias("id"),
        F.coalesce(blank_to_null(F.col("name")), F.lit("")).alias("name"),
        F.coalesce(blank_to_null(F.col("role")), F.lit("")).alias("role"),
    ).where(F.col("id").isNotNull())
    one = rows.groupBy("id").agg(F.min(F.struct("name", "role")).alias("u")).select("id", "u.name", "u.role")
    known = log.select("id").distinct()
    return one.join(known, "id", "left_anti").withColumn("version", F.lit(version).cast("bigint"))


def delete_users(log: DataFrame, identifiers: DataFrame) -> DataFrame:
    """The log without all rows of the listed users; an identifier is a whole number (id) or a name."""
    ids = identifiers.select(positive_key(F.col("identifier")).alias("id")).where(F.col("id").isNotNull()).distinct()
    names = (
        identifiers.where(positive_key(F.col("identifier")).isNull())
        .select(blank_to_null(F.col("identifier")).alias("name"))
        .where(F.col("name").isNotNull())
        .distinct()
    )
    return log.join(ids, "id", "left_anti").join(names, "name", "left_anti").select(*log.columns)
