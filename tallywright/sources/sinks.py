"""Writers: replace, append once, upsert, files and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywright.operators import windows
from tallywright.session import settings, work_dir


def replace_table(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)


def append_new(df: DataFrame, name: str, key: str) -> None:
    """Append the rows whose key the table does not hold yet."""
    spark = df.sparkSession
    fresh = df.dropDuplicates([key])
    if not spark.catalog.tableExists(name):
        fresh.write.format("parquet").saveAsTable(name)
        return
    known = spark.table(name).select(key)
    columns = spark.table(name).columns
    fresh.join(known, key, "left_anti").select(*columns).write.mode("append").insertInto(name)


#: What an upserted table keeps beside its own columns: the change a row comes from, and whether
#: that change deleted the key (the mark stays, so that an older change cannot bring the key back).
SEQUENCE, DELETED = "_seq", "_deleted"


def upsert(
    df: DataFrame,
    name: str,
    key: str,
    seq: str | Column,
    partition_by: str | None = None,
    deleted: Column | None = None,
) -> None:
    """Insert, replace or delete by key; the change with the greatest ``seq`` wins, whether it comes
    in this call or came before.  Read the table with :func:`live`.

    Rows without a key are left out.  What changes is checkpointed to the shared folder before the
    table is overwritten, so losing executors in between loses nothing.  A partitioned table only
    rewrites the partitions that lose or gain a row; without ``partition_by`` the whole table is
    rewritten, for large tables see :func:`tallywright.streaming.sync.append_changes`.
    """
    spark = df.sparkSession
    work_dir(spark)
    order = F.col(seq) if isinstance(seq, str) else seq
    marked = df.withColumns({SEQUENCE: order, DELETED: F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)})
    fresh = windows.keep_last(marked.drop(seq) if isinstance(seq, str) else marked, key, SEQUENCE)
    if not spark.catalog.tableExists(name):
        replace_table(fresh, name, partition_by)
        return
    current = spark.table(name)
    columns = current.columns
    had = [F.col(key), F.col(SEQUENCE).alias("_had"), F.lit(True).alias("_known")]
    known = current.select(*had, *([F.col(partition_by).alias("_was")] if partition_by else []))
    newer = F.col("_known").isNull() | F.coalesce(F.col(SEQUENCE) > F.col("_had"), F.col("_had").isNull() & F.col(SEQUENCE).isNotNull())
    changes = fresh.join(known, key, "left").where(newer).checkpoint()
    rows = changes.select(*columns)
    if partition_by is None:
        merged = current.join(rows.select(key), key, "left_anti").select(*columns).unionByName(rows)
        merged.checkpoint().write.mode("overwrite").insertInto(name)
        return
    lost = changes.where("_known").select(F.col("_was").alias(partition_by)).distinct()
    touched = lost.unionByName(rows.select(partition_by)).distinct()
    in_touched = current.join(touched, current[partition_by].eqNullSafe(touched[partition_by]), "left_semi")
    merged = in_touched.join(rows.select(key), key, "left_anti").select(*columns).unionByName(rows).checkpoint()
    # A touched partition whose rows all moved elsewhere must end up empty; dynamic overwrite
    # leaves partitions alone that receive no row, so drop those.
    filled = merged.select(F.col(partition_by).alias("_filled")).distinct()
    left_over = lost.join(filled, lost[partition_by].eqNullSafe(filled["_filled"]), "left_anti").collect()  # one value per emptied partition
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        merged.write.mode("overwrite").insertInto(name)
    for row in left_over:
        value = "null" if row[0] is None else "'" + str(row[0]).replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition_by} = {value})")


def live(spark: SparkSession, name: str) -> DataFrame:
    """The rows of an upserted table that are not deleted, in the table's own columns."""
    return spark.table(name).where(~F.col(DELETED)).drop(SEQUENCE, DELETED)


def write_processed(df: DataFrame, folder: str, name: str) -> tuple[str, str]:
    """The frame as CSV and as Parquet; returns both paths."""
    csv_path, parquet_path = f"{folder}/processed_{name}.csv", f"{folder}/processed_{name}.parquet"
    df.write.mode("overwrite").option("header", True).csv(csv_path)
    df.write.mode("overwrite").parquet(parquet_path)
    return csv_path, parquet_path


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """A report of one row as one JSON file, NULL fields included."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
