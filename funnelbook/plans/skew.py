"""A join that spreads hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that hold more than one in so many rows, or in as many as there are shuffle partitions if these are fewer, are hot.
SHARE = 1024


def skew_join(
    one: DataFrame,
    many: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    counted: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Equi-join of a side with unique keys to a side that may have very frequent ones; null keys have no partner.

    ``inner``, or ``left`` to keep the rows of ``many`` that have no partner.

    Without ``counted`` this is a plain join, whose hot partitions adaptive execution splits by their measured size, and each side is
    read once. Adaptive execution does not split where a later step relies on the join's partitioning, and a row that was
    shuffled to one place is read from there by all parts. With ``counted``, a stored frame with about the same keys (best the
    key columns alone), hot keys are found before the shuffle, with a frequency sketch of fixed size. Rows of a
    hot key are dealt to as many groups as its share of all partitions, three times over so that groups which fall together even out: a
    key with a third of the rows goes to all partitions, one with a hundredth to three in a hundred. The single partner row is
    copied to each group; all other rows join once as usual. There are at most ``SHARE`` hot keys, so the map that every task
    gets has a fixed bound. A wrong estimate changes the spread of the work, never the result.

    The group of a row depends on its content and its partition only, so a task that runs again after the loss of an
    executor deals its rows the same way.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if counted is None:
        return one.join(many, list(keys)) if how == "inner" else many.join(one, list(keys), "left")
    parts = partitions or int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(2, min(SHARE, parts))
    hashed = F.xxhash64(*keys)
    top = counted.select(F.call_function("approx_top_k", hashed, F.lit(share), F.lit(4 * share)).alias("top"), F.count("*").alias("n"))
    frequent = F.filter("top", lambda t: t.getField("count") * share > F.col("n"))
    groups = F.transform(frequent, lambda t: F.least(F.lit(parts), F.ceil(3 * parts * t.getField("count") / F.col("n"))).cast("int"))
    hot = top.select(F.map_from_arrays(F.transform(frequent, lambda t: t.getField("item")), groups)).scalar()
    salts = F.coalesce(F.try_element_at(F.coalesce(hot, F.create_map().cast("map<bigint,int>")), hashed), F.lit(1))

    content = [c for c, t in many.dtypes if "map<" not in t and "variant" not in t]
    spread = many.withColumn("__salt", F.pmod(F.xxhash64(*content, F.spark_partition_id()), salts).cast("int"))
    copied = one.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    on = [*keys, "__salt"]
    return (copied.join(spread, on) if how == "inner" else spread.join(copied, on, "left")).drop("__salt")
