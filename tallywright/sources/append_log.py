"""A log that takes each id once without reading what it holds.

Rows lie in slots, a day and a prefix of the id's hash.  Beside each written slot lies a Bloom filter of its
ids.  A batch asks the filters first: ids that none of them knows are new, and only slots that may hold
an id of the batch are read to tell.  So an append costs what the batch costs, plus the slots that a
replay really touches; a filter errs for one id in a million.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallywright.sources.manifest import Manifest

# Tasks get the functions themselves, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOT = "_slot"
#: Bits a filter keeps for each id, and how many of them an id sets: wrong once in a million.
BITS, PROBES = 32, 12
#: Prefixes of the hash.  A prefix should have some ten million rows at most, so its filters fit a task.
PREFIXES = 64


def _bits(n: int) -> int:
    return max(BITS * n, 1024)


def _probes(one: np.ndarray, two: np.ndarray, bits: int) -> np.ndarray:
    """The bits of ids, by two of their hashes (ids x PROBES), each spread anew: plain steps of an
    arithmetic sequence would repeat in small filters."""
    x = one.view(np.uint64)[:, None] + np.arange(PROBES, dtype=np.uint64)[None, :] * two.view(np.uint64)[:, None]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(bits)).astype(np.int64)


def _known(filter_bits: bytes, n: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    packed = np.frombuffer(filter_bits, np.uint8)
    at = _probes(one, two, _bits(n))
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)


class AppendLog:
    """``key`` is the id, ``day`` an expression that gives a row's day as text."""

    def __init__(self, spark: SparkSession, folder: str, key: str, day: Column, prefixes: int = PREFIXES):
        self.spark, self.folder, self.key, self.day = spark, folder.rstrip("/"), key, day
        self.manifest, self._prefixes = Manifest(spark, folder), prefixes

    def _hashes(self) -> list[Column]:
        return [F.xxhash64(F.lit(salt), F.col(self.key)).alias(name) for salt, name in ((1, "one"), (2, "two"))]

    def _prefix(self, prefixes: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(prefixes)).cast("int")

    def _data(self, content: dict, slots: list[str] | None = None) -> DataFrame:
        """Stored rows, of some slots on request: others are not listed, let alone read."""
        schema = StructType.fromJson(content["schema"])
        whole = self.spark.createDataFrame([], schema)
        for part in content["parts"]:
            held = sorted(set(part["slots"]) & set(slots)) if slots is not None else None
            if held or slots is None:
                rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{part['data']}")
                whole = whole.unionByName(rows if held is None else rows.where(F.col(SLOT).isin(held)))
        return whole

    def read(self) -> DataFrame:
        _, content = self.manifest.read()
        if not content:
            raise ValueError(f"no log in {self.folder}")
        return self._data(content).drop(SLOT)

    def slots_asked(self, batch: DataFrame, content: dict | None = None) -> list[str]:
        """The slots that may hold an id of the batch, by their filters alone."""
        content = self.manifest.read()[1] if content is None else content
        if not content or not content["parts"]:
            return []
        stored = [f"{self.folder}/{part['filters']}" for part in content["parts"]]
        filters = self.spark.read.schema("prefix int, slot string, n long, bits binary").parquet(*stored)

        def ask(ids: pa.Table, known: pa.Table) -> pa.Table:
            one, two = (ids[name].to_numpy() for name in ("one", "two"))
            held = zip(*(known[c].to_pylist() for c in ("slot", "n", "bits")))
            return pa.table({"slot": pa.array([slot for slot, n, bits in held if len(one) and _known(bits, n, one, two).any()], pa.string())})

        ids = batch.where(F.col(self.key).isNotNull()).select(self._prefix(content["prefixes"]).alias("prefix"), *self._hashes())
        hit = ids.groupBy("prefix").cogroup(filters.groupBy("prefix")).applyInArrow(ask, "slot string")
        return sorted(r.slot for r in hit.distinct().collect())  # names of slots, at most as many as there are

    def append(self, batch: DataFrame, stream: tuple[str, int] | None = None) -> int:
        """Add the rows whose id the log does not hold, one row of equal ids; how many.

        Rows without an id are left out.  ``stream`` (a stream and the number of its batch) lets a
        repeated batch return at once; without it a replay is found by its ids."""
        version, content = self.manifest.read()
        if stream and content and content["applied"].get(stream[0], -1) >= stream[1]:
            return 0
        prefixes = content["prefixes"] if content else self._prefixes
        one_each = batch.where(F.col(self.key).isNotNull()).dropDuplicates([self.key]).persist()
        try:
            return self._append(one_each, version, content, prefixes, stream)
        finally:
            one_each.unpersist()

    def _append(self, fresh: DataFrame, version: int, content: dict, prefixes: int, stream: tuple[str, int] | None) -> int:
        columns = fresh.columns
        slots = self.slots_asked(fresh, content)
        if slots:
            fresh = fresh.join(self._data(content, slots).select(self.key), self.key, "left_anti").select(columns)
        prefix = self._prefix(prefixes)
        placed = fresh.withColumn(SLOT, F.concat_ws("_", F.coalesce(self.day, F.lit("none")), F.lpad(prefix.cast("string"), 5, "0")))
        content = content or {"prefixes": prefixes, "schema": placed.schema.jsonValue(), "parts": [], "applied": {}}
        if stream:
            content["applied"][stream[0]] = stream[1]
        part = self._written(placed.select([f["name"] for f in content["schema"]["fields"]]), prefixes)
        if part["slots"]:
            content["parts"].append(part)
        self.manifest.commit(version, content)
        return sum(part["slots"].values())

    def _written(self, rows: DataFrame, prefixes: int) -> dict:
        """Write rows by slot, and then their filters."""
        name = uuid.uuid4().hex
        rows.repartition(SLOT).write.partitionBy(SLOT).parquet(f"{self.folder}/data-{name}")
        stored = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/data-{name}")
        sizes = {r[0]: r[1] for r in stored.groupBy(SLOT).count().collect()}  # one row a slot

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Slots come one after the other; a filter's bits are all that is kept.
            slot, prefix, bits = None, None, None

            def done() -> pa.RecordBatch:
                columns = [pa.array([prefix], pa.int32()), pa.array([slot]), pa.array([sizes[slot]], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())]
                return pa.record_batch(columns, names=["prefix", "slot", "n", "bits"])

            for batch in batches:
                names, of_prefix = batch.column("slot").to_pylist(), batch.column("prefix").to_pylist()
                one, two = (batch.column(c).to_numpy() for c in ("one", "two"))
                at = 0
                while at < len(names):
                    end = at + 1
                    while end < len(names) and names[end] == names[at]:
                        end += 1
                    if names[at] != slot:
                        if slot is not None:
                            yield done()
                        slot, prefix, bits = names[at], of_prefix[at], np.zeros(_bits(sizes[names[at]]), bool)
                    bits[_probes(one[at:end], two[at:end], len(bits)).ravel()] = True
                    at = end
            if slot is not None:
                yield done()

        ids = stored.select(self._prefix(prefixes).alias("prefix"), F.col(SLOT).alias("slot"), *self._hashes())
        filters = ids.repartition("slot").sortWithinPartitions("slot").mapInArrow(build, "prefix int, slot string, n long, bits binary")
        filters.write.parquet(f"{self.folder}/filters-{name}")
        return {"data": f"data-{name}", "filters": f"filters-{name}", "slots": sizes}

    def compact(self) -> None:
        """Put all parts into one; ids and rows stay as they are."""
        version, content = self.manifest.read()
        if len(content.get("parts", [])) > 1:
            content["parts"] = [self._written(self._data(content), content["prefixes"])]
            self.manifest.commit(version, content)
