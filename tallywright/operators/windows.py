"""One row per key, top rows and previous values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _pick(df: DataFrame, keys: list[str], order: Column, choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(choose(F.struct(*rest), order).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def keep_last(df: DataFrame, keys: str | list[str], order: Column | str) -> DataFrame:
    """The row with the greatest ``order`` per key, whole, inner NULLs included.

    A NULL order comes before all others.  Rows that lack a key column belong to no key and are
    left out; :func:`tallywright.operators.ingest.split_rejects` reports them.  ``max_by`` combines
    before the shuffle, so a hot key sends one row per task (text columns make it a sort aggregate).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = F.col(order) if isinstance(order, str) else order
    return _pick(df, keys, F.struct(by.isNotNull(), by), F.max_by)


def keep_first(df: DataFrame, keys: str | list[str], order: Column | str) -> DataFrame:
    """The row with the smallest ``order`` per key; a NULL order comes after all others."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = F.col(order) if isinstance(order, str) else order
    return _pick(df, keys, F.struct(by.isNull(), by), F.min_by)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows by ``order``: each task keeps n rows, no full sort."""
    return df.orderBy(*order).limit(n)


def previous_value(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    out: str,
    bucket: Column,
) -> DataFrame:
    """``lag(value)`` per key without sorting a whole key in one task.

    ``bucket`` must grow with ``order`` (a day, a month).  Inside a bucket a plain
    window gives the previous row; the first row of a bucket takes the last value
    of the nearest earlier bucket, found on one summary row per key and bucket.
    """
    bucketed = df.withColumn("_bucket", bucket)
    lasts = bucketed.groupBy(*keys, "_bucket").agg(
        F.max_by(F.struct(F.col(value).alias("v")), order).alias("_last")
    )
    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    carried = lasts.select(*keys, "_bucket", F.lag("_last").over(by_bucket).alias("_carried"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    ranked = bucketed.withColumn("_n", F.row_number().over(inside)).withColumn(
        "_prev", F.lag(value).over(inside)
    )
    return (
        ranked.join(carried, [*keys, "_bucket"], "left")
        .withColumn(out, F.when(F.col("_n") == 1, F.col("_carried.v")).otherwise(F.col("_prev")))
        .drop("_bucket", "_n", "_prev", "_carried")
    )


def earlier_moments(df: DataFrame, keys: list[str], order: str, value: str, bucket: Column) -> DataFrame:
    """Number (``n``), sum, sum of squares and last of the whole numbers ``value`` in all earlier rows of a key.

    As in :func:`previous_value`, ``bucket`` must grow with ``order``: a window runs inside a bucket, and what
    earlier buckets hold is merged from one summary row each.  Moments are exact decimals, so neither the
    split nor the order of adding matters.  ``n`` is 0 and the others NULL in the first row.
    """
    number = F.col(value).cast("decimal(12,0)")
    moments = {"n": F.count(value), "sum": F.sum(number), "squares": F.sum(number * number)}
    bucketed = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = bucketed.groupBy(*keys, "_bucket").agg(*[m.alias(name) for name, m in moments.items()], F.max_by(value, order).alias("last"))
    carried = whole.select(*keys, "_bucket", *[F.sum(name).over(before).alias(f"_{name}") for name in moments], F.last("last").over(before).alias("_last"))
    ranked = bucketed.withColumns({name: m.over(inside) for name, m in moments.items()} | {"last": F.last(value).over(inside)})
    joined = ranked.join(carried, [*keys, "_bucket"], "left")
    plus = lambda name: F.when(F.col(name).isNull(), F.col(f"_{name}")).otherwise(F.col(name) + F.coalesce(F.col(f"_{name}"), F.lit(0)))
    merged = {name: plus(name) for name in moments} | {"last": F.coalesce("last", "_last")}
    return joined.withColumns(merged).drop("_bucket", "_last", *[f"_{name}" for name in moments])
