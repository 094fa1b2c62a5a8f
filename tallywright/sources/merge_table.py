"""A keyed table that takes changes without rewriting itself: merge on read.

Each batch of changes becomes a set of delta files, deletes included as marked rows, and a new version of the
manifest.  Readers put the newest change of a key over its base row.  Rows are dealt to buckets by key;
a bucket is compacted when its deltas have grown to a share of its base, others stay as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallywright.operators import windows
from tallywright.sources.manifest import Conflict, Manifest
from tallywright.sources.sinks import DELETED, SEQUENCE

BUCKET = "_bucket"
BUCKETS = 64
#: Rows of deltas to rows of the base above which a bucket is compacted.
COMPACT_SHARE = 0.25
#: Shares into which rows are dealt for writing: a table of few buckets is written by many tasks too.
DEALT = 256


class MergeTable:
    """``key`` names the key columns.  ``buckets`` is fixed when the table is made; its files should have
    some 100 MB each, so that one task can rewrite a bucket."""

    def __init__(self, spark: SparkSession, folder: str, key: str | list[str], buckets: int = BUCKETS):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.manifest = Manifest(spark, folder)
        self._buckets = buckets

    # -- reading ---------------------------------------------------------------

    def _rows(self, content: dict, kind: str, wanted: set[str] | None = None) -> DataFrame:
        """Base rows or changes of all buckets, or of the wanted ones."""
        by_path: dict[str, list[int]] = {}
        for bucket, state in content["buckets"].items():
            if wanted is None or bucket in wanted:
                for name in state[kind]:
                    by_path.setdefault(name, []).append(int(bucket))
        schema = StructType.fromJson(content["schema"])
        parts = [self.spark.read.schema(schema).parquet(f"{self.folder}/{name}").where(F.col(BUCKET).isin(buckets)) for name, buckets in sorted(by_path.items())]
        whole = parts[0] if parts else self.spark.createDataFrame([], schema)
        for more in parts[1:]:
            whole = whole.unionByName(more)
        return whole

    def _merged(self, content: dict, wanted: set[str] | None = None) -> DataFrame:
        """The newest change of each key, deleted keys included."""
        base = self._rows(content, "base", wanted)
        if not any(state["deltas"] for bucket, state in content["buckets"].items() if wanted is None or bucket in wanted):
            return base
        fresh = windows.keep_last(self._rows(content, "deltas", wanted), [*self.key], SEQUENCE)
        rest = [c for c in base.columns if c not in self.key]
        new = fresh.select(*self.key, *[F.col(c).alias(f"_new_{c}") for c in rest], F.lit(True).alias("_there"))
        both = base.withColumn("_here", F.lit(True)).join(new, self.key, "full_outer")
        was, now = F.col(SEQUENCE), F.col(f"_new_{SEQUENCE}")
        newer = F.col("_here").isNull() | F.coalesce(now > was, was.isNull() & now.isNotNull())
        taken = F.col("_there").isNotNull() & newer
        return both.select(*[F.col(c) if c in self.key else F.when(taken, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in base.columns])

    def exists(self) -> bool:
        return bool(self.manifest.read()[1])

    def read(self, version: int | None = None) -> DataFrame:
        """The live rows, of an earlier version on request."""
        _, content = self.manifest.read(version)
        if not content:
            raise ValueError(f"no table in {self.folder}")
        return self._merged(content).where(~F.col(DELETED)).drop(SEQUENCE, DELETED, BUCKET)

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The live rows of the given keys (rows of the key columns); buckets without one are not read."""
        _, content = self.manifest.read()
        if not content:
            raise ValueError(f"no table in {self.folder}")
        wanted = {str(r[0]) for r in keys.select(self._bucket(content["n_buckets"])).distinct().collect()}  # one number a bucket
        live = self._merged(content, wanted).where(~F.col(DELETED)).drop(SEQUENCE, DELETED, BUCKET)
        return live.join(keys.select(*self.key), self.key, "left_semi")

    def notes(self) -> dict:
        """What the last writer that left notes has noted."""
        return self.manifest.read()[1].get("notes", {})

    def applied(self, stream: str) -> int:
        """Number of the last batch of a stream that is in the table, -1 for none."""
        return self.manifest.read()[1].get("applied", {}).get(stream, -1)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")

    # -- writing ---------------------------------------------------------------

    def _written(self, rows: DataFrame, kind: str) -> tuple[str, dict[str, int]]:
        """Write rows by bucket; the folder's name and the rows of each bucket."""
        name = f"{kind}-{uuid.uuid4().hex}"
        share = F.pmod(F.shiftright(F.xxhash64(*self.key), 32), F.lit(-(-DEALT // self._buckets)))
        rows.repartition(BUCKET, share).write.partitionBy(BUCKET).parquet(f"{self.folder}/{name}")
        counted = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}").groupBy(BUCKET).count().collect()  # one row a bucket
        return name, {str(r[0]): r[1] for r in counted}

    def upsert(
        self,
        changes: DataFrame,
        seq: str | Column,
        deleted: Column | None = None,
        batch: tuple[str, int] | None = None,
        notes: dict | None = None,
        after: int | None = None,
    ) -> bool:
        """Add changes; the one with the greatest ``seq`` wins, whether it comes now or came before, and of
        equal ones the earlier call's.  Rows without a key are left out.

        ``batch`` (a stream and the number of its batch) makes a repeated call do nothing; False then.
        Only the batch is written, whatever the size of the table.  ``notes`` become part of the same version as the changes.
        ``after`` names the version that the changes were made from; it fails if there is a newer one.
        """
        version, content = self.manifest.read()
        if after is not None and version != after:
            raise Conflict(f"version {version} follows version {after}")
        if batch and content and content["applied"].get(batch[0], -1) >= batch[1]:
            return False
        buckets = content["n_buckets"] if content else self._buckets
        marked = changes.withColumns({SEQUENCE: F.col(seq) if isinstance(seq, str) else seq, DELETED: F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)})
        fresh = windows.keep_last(marked.drop(seq) if isinstance(seq, str) else marked, self.key, SEQUENCE)
        placed = fresh.withColumn(BUCKET, self._bucket(buckets))
        content = content or {"n_buckets": buckets, "schema": placed.schema.jsonValue(), "buckets": {}, "applied": {}}
        if batch:
            content["applied"][batch[0]] = batch[1]
        if notes is not None:
            content["notes"] = notes
        ordered = placed.select([f["name"] for f in content["schema"]["fields"]])
        name, rows = self._written(ordered, "delta")
        for bucket, n in rows.items():
            state = content["buckets"].get(bucket)
            if state is None:  # the first rows of a bucket, one for each key, are its base
                content["buckets"][bucket] = {"base": [name], "base_rows": n, "deltas": [], "delta_rows": 0}
            else:
                state["deltas"].append(name)
                state["delta_rows"] += n
        self.manifest.commit(version, content)
        return True

    def compact(self, share: float = COMPACT_SHARE) -> list[str]:
        """Rewrite the buckets whose changes are more than ``share`` of their base; their numbers.

        Marks of deleted keys stay, so that an older change cannot bring a key back."""
        version, content = self.manifest.read()
        due = sorted(b for b, s in content.get("buckets", {}).items() if s["delta_rows"] > share * s["base_rows"])
        if due:
            name, rows = self._written(self._merged(content, set(due)), "base")
            for bucket in due:
                content["buckets"][bucket] = {"base": [name], "base_rows": rows.get(bucket, 0), "deltas": [], "delta_rows": 0}
            self.manifest.commit(version, content)
        return due

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the files that none of the last ``keep`` versions names.  No writer may be at work."""
        named: set[str] = set()
        for number in self.manifest.numbers()[-keep:]:
            for state in self.manifest.read(number)[1].get("buckets", {}).values():
                named.update(state["base"], state["deltas"])
        gone = [name for name in self.manifest.names() if name not in named]
        for name in gone:
            self.manifest.drop(name)
        return gone
