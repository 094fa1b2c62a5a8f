"""Join helpers that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_to_unique(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``many`` rows per key to ``one`` row per key (``inner`` or ``left``).

    One plan at every size: Spark broadcasts a side whose known size is below its limit, and
    otherwise AQE splits the partitions of ``many`` in which a key is hot
    (``forceOptimizeSkewedJoin`` keeps that on below aggregates).  Each input is read once.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    return many.join(one, key, how)


def _with_stand_in(df: DataFrame, column: str, side: str) -> DataFrame:
    """Add ``_match``: the text key, or for a missing one a text found on this side only.

    Rows without a key match nothing, yet outer and anti joins keep them, and hashing
    NULL would put them all into one task.  Stand-ins made of the row's hash spread them over
    all tasks, however many there are; of the same rows those of different partitions part as well.
    """
    stand_in = F.concat(F.lit(f"\u0000{side}"), F.xxhash64(*df.columns, F.spark_partition_id()).cast("string"))
    return df.withColumn("_match", F.coalesce(F.col(column), stand_in))


def outer_join(left: DataFrame, right: DataFrame, key: str, how: str = "full_outer") -> DataFrame:
    """Left or full outer join on a text key, rows without a key spread over the tasks."""
    if how not in ("left", "full_outer"):
        raise ValueError(f"unsupported join type: {how}")
    named = right.withColumnRenamed(key, "_right_key")
    rights = named.where(F.col("_right_key").isNotNull()) if how == "left" else named
    joined = _with_stand_in(left, key, "l").join(_with_stand_in(rights, "_right_key", "r"), "_match", how)
    return joined.withColumn(key, F.coalesce(key, "_right_key")).drop("_match", "_right_key")


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose text key the right side lacks, rows without a key among them."""
    there = right.where(F.col(key).isNotNull()).select(F.col(key).alias("_match"))
    return _with_stand_in(left, key, "l").join(there, "_match", "left_anti").select(*left.columns)
