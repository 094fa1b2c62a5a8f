"""Counts by hour and user that late rows still correct.

Every micro-batch is aggregated to panes (one row per hour and user) and stored with a mark that tells
whether the hour was closed when its rows came, that is, behind the watermark.  Panes add up: closed hours
are folded from all their panes, so a late row corrects them, and longer windows are sums of panes, so no
event is ever copied into the windows that hold it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywright.operators.governance import ACCESS_LIMIT
from tallywright.sources.manifest import Manifest
from tallywright.streaming.monitors import LATENESS

HOUR = 3600
PANE = "hour timestamp, user string, n long, kinds array<string>, late boolean"


class PaneStore:
    """Panes of one stream below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, lateness: str = LATENESS):
        self.spark, self.folder, self.lateness = spark, folder.rstrip("/"), lateness
        self.manifest = Manifest(spark, folder)

    def add(self, batch: DataFrame, ts: str, user: str, kind: Column | str, number: int) -> None:
        """Add a micro-batch; repeating one changes nothing.

        The watermark is the latest time of all earlier batches less the lateness; it is kept with the
        panes, in the same commit."""
        version, content = self.manifest.read()
        if content and content["batch"] >= number:
            return
        content = content or {"latest": None, "batch": -1, "parts": []}
        closed = F.lit(False)
        if content["latest"] is not None:
            mark = F.timestamp_micros(F.lit(content["latest"])) - F.expr(f"INTERVAL {self.lateness}")
            closed = F.col("hour") + F.expr("INTERVAL 1 HOUR") <= mark
        kinds = F.col(kind) if isinstance(kind, str) else kind
        rows = batch.where(F.col(ts).isNotNull()).select(F.date_trunc("hour", ts).alias("hour"), F.col(user).cast("string").alias("user"), kinds.alias("kind"), F.unix_micros(F.col(ts)).alias("at"))
        panes = rows.groupBy("hour", "user").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("kind")).alias("kinds"), F.max("at").alias("at"))
        name = f"panes-{uuid.uuid4().hex}"
        panes.withColumn("late", closed).write.parquet(f"{self.folder}/{name}")
        latest = self.spark.read.schema("at long").parquet(f"{self.folder}/{name}").agg(F.max("at")).first()[0]
        content["latest"] = max((x for x in (content["latest"], latest) if x is not None), default=None)
        content["batch"] = number
        content["parts"].append(name)
        self.manifest.commit(version, content)

    def stored(self) -> DataFrame:
        """Panes as they were added."""
        parts = self.manifest.read()[1].get("parts", [])
        return self.spark.read.schema(PANE).parquet(*[f"{self.folder}/{p}" for p in parts]) if parts else self.spark.createDataFrame([], PANE)

    def compact(self) -> None:
        """Put the panes of all batches into one file set."""
        version, content = self.manifest.read()
        if len(content.get("parts", [])) > 1:
            name = f"panes-{uuid.uuid4().hex}"
            folded(self.stored(), "late").write.parquet(f"{self.folder}/{name}")
            self.manifest.commit(version, content | {"parts": [name]})


def run(store: PaneStore, events: DataFrame, ts: str, user: str, kind: Column | str, checkpoint: str) -> StreamingQuery:
    """Feed a stream into a store, micro-batch by micro-batch, up to what is there."""
    query = events.writeStream.foreachBatch(lambda batch, number: store.add(batch, ts, user, kind, number))
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def folded(panes: DataFrame, *keep: str) -> DataFrame:
    """One pane per hour and user (and further columns): counts added, kinds united."""
    return panes.groupBy("hour", "user", *keep).agg(F.sum("n").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("kinds")))).alias("kinds"))


def late_counts(panes: DataFrame) -> DataFrame:
    """Hours that late rows have corrected: all rows, and those that came late."""
    late = F.sum(F.when(F.col("late"), F.col("n")).otherwise(0))
    return panes.groupBy("hour").agg(F.sum("n").alias("n"), late.alias("n_late")).where("n_late > 0")


def busy_days(panes: DataFrame, limit: int = ACCESS_LIMIT) -> DataFrame:
    """Users above ``limit`` accesses in a day-long window, for every hour at which one may begin.

    Only panes whose neighbourhood (the hours that share a window with it) is above the limit are looked
    at further; the others are in no such window.
    """
    one = folded(panes)
    at = F.unix_seconds("hour")
    by_user = Window.partitionBy("user").orderBy("at")
    near = F.sum("n").over(by_user.rangeBetween(-23 * HOUR, 23 * HOUR))
    wanted = one.withColumn("at", at).withColumn("near", near).where(F.col("near") > limit)
    starts = wanted.select("user", "n", "kinds", F.explode(F.sequence(F.col("at") - 23 * HOUR, F.col("at"), F.lit(HOUR))).alias("start"))
    sums = starts.groupBy("user", "start").agg(F.sum("n").alias("access_count"), F.size(F.array_distinct(F.flatten(F.collect_list("kinds")))).alias("entity_types"))
    return sums.where(F.col("access_count") > limit).select(F.timestamp_seconds("start").alias("window_start"), F.col("user").alias("auditor_id"), "access_count", "entity_types")
