"""A log sealed with a Merkle tree, so that two states are compared without reading both.

Rows are dealt to buckets by the first hex digits of the SHA-256 of their id.  A bucket's digest covers its row
digests in the order of the hashed ids, an inner node's those of its (at most 16) children, and the root
all of them.  A comparison starts at the roots and goes down only where digests differ; of the rows it
reads the buckets found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywright.functions.hashing import row_digest

#: Levels below the root: 16 ** DIGITS buckets, of which one task digests each.
DIGITS = 2
#: Digits of the place by which rows are dealt to tasks at least: a tree of few buckets is written by many tasks too.
DEAL_DIGITS = 2


def _digest(place: str, digest: str) -> Column:
    ordered = F.sort_array(F.collect_list(F.struct(F.col(place).alias("place"), F.col(digest).alias("digest"))))
    return F.sha2(F.array_join(F.transform(ordered, lambda x: x["digest"]), ""), 256)


def leaves(rows: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(prefix, n, digest) of each bucket, from rows with ``_place`` and ``row_hash``.

    Rows are put in order in runs, a sixteenth of a bucket each; for a bucket's digest only the 32 bytes
    of every row digest come together, run behind run.
    """
    pair = F.struct(F.unhex("_place").alias("place"), F.unhex("row_hash").alias("digest"))
    ordered = F.transform(F.sort_array(F.collect_list(pair)), lambda x: F.hex(x["digest"]))
    runs = rows.groupBy(F.left("_place", F.lit(digits + 1)).alias("run")).agg(F.count("*").alias("n"), F.unhex(F.array_join(ordered, "")).alias("digests"))
    joined = F.transform(F.sort_array(F.collect_list(F.struct("run", "digests"))), lambda x: F.lower(F.hex(x["digests"])))
    return runs.groupBy(F.left("run", F.lit(digits)).alias("prefix")).agg(F.sum("n").alias("n"), F.sha2(F.array_join(joined, ""), 256).alias("digest"))


def above(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of ``level``, from those of the next one."""
    return nodes.groupBy(F.left("prefix", F.lit(level)).alias("parent")).agg(F.sum("n").alias("n"), _digest("prefix", "digest").alias("digest")).withColumnRenamed("parent", "prefix")


class SealedLog:
    """One state of a log in ``folder``.  Ids should be unique; rows without an id count as those with an empty one."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "log_id"):
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key

    def seal(self, log: DataFrame, digits: int = DIGITS) -> SealedLog:
        """Store the rows by bucket, all their columns digested, and the tree over them.  Choose ``digits`` so that a
        bucket's digests (70 bytes a row) fit a task with ease: 4 for some billions of rows."""
        marked = log.withColumns({"row_hash": row_digest(log.columns), "_place": F.sha2(F.coalesce(F.col(self.key).cast("string"), F.lit("")), 256)})
        dealt = marked.withColumn("_bucket", F.left("_place", F.lit(digits)))
        dealt.repartition(F.left("_place", F.lit(max(digits, DEAL_DIGITS)))).write.partitionBy("_bucket").parquet(f"{self.folder}/rows")
        stored = self.spark.read.schema(marked.schema).parquet(f"{self.folder}/rows")
        leaves(stored.select("_place", "row_hash"), digits).write.parquet(f"{self.folder}/tree/{digits}")
        for level in range(digits - 1, -1, -1):  # at most 16 ** (level + 1) small rows each
            above(self.nodes(level + 1), level).coalesce(1).write.parquet(f"{self.folder}/tree/{level}")
        return self

    def nodes(self, level: int) -> DataFrame:
        return self.spark.read.schema("prefix string, n long, digest string").parquet(f"{self.folder}/tree/{level}")

    def root(self) -> str | None:
        """The digest of the whole log, None without rows."""
        found = self.nodes(0).select("digest").first()
        return found.digest if found else None

    def rows(self, buckets: list[str] | None = None) -> DataFrame:
        """The stored rows with ``row_hash``, of some buckets only on request."""
        kinds = self.spark.read.parquet(f"{self.folder}/rows").drop("_bucket").schema
        stored = self.spark.read.schema(kinds.add("_bucket", "string")).parquet(f"{self.folder}/rows")
        return (stored if buckets is None else stored.where(F.col("_bucket").isin(buckets))).drop("_place", "_bucket")

    def levels(self) -> int:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/tree")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return len(files.listStatus(path)) - 1


def changed_buckets(before: SealedLog, after: SealedLog) -> list[str]:
    """The buckets that differ, found from the roots down; at most as many as there are buckets."""
    depth = before.levels()
    if depth != after.levels():
        raise ValueError("logs sealed with different numbers of digits")
    open_ = [""]
    for level in range(depth + 1):
        below = lambda log: log.nodes(level).where(F.left("prefix", F.lit(max(level - 1, 0))).isin(open_))  # noqa: E731, B023
        old, new = below(before).select("prefix", F.col("digest").alias("old")), below(after).select("prefix", F.col("digest").alias("new"))
        differ = old.join(new, "prefix", "full").where(~F.col("old").eqNullSafe(F.col("new")))
        open_ = sorted(r.prefix for r in differ.select("prefix").collect())
        if not open_:
            break
    return open_


def differences(before: SealedLog, after: SealedLog) -> DataFrame:
    """``key`` and ``violation`` (DELETED, INSERTED or CHANGED) of the lines in which two states differ.  Only the
    buckets that :func:`changed_buckets` finds are read."""
    buckets, key = changed_buckets(before, after), before.key
    told = lambda log, name: log.rows(buckets).select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias(key), F.col("row_hash").alias(name))
    both = told(before, "old").join(told(after, "new"), key, "full")
    kind = F.when(F.col("new").isNull(), "DELETED").when(F.col("old").isNull(), "INSERTED").when(F.col("old") != F.col("new"), "CHANGED")
    return both.select(key, kind.alias("violation")).where("violation IS NOT NULL")
