"""Helpers shared by the operators: the working folder, words as 64-bit codes, packed columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywright.session import work_dir

#: Entries a task keeps in a memo before it starts afresh (bounds a worker's memory).
MEMO_ENTRIES = 300_000

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_written: dict[str, list[str]] = {}


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` into the shared working folder and read it back: cuts the lineage and
    survives the loss of executors.  :func:`release` removes what a session wrote."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove the tables :func:`saved` wrote in this session; frames that read them end here."""
    context = spark.sparkContext
    for path in _written.pop(context.applicationId, []):
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def parts(spark: SparkSession, total: float, per_part: float) -> int:
    """Groups of about ``per_part`` each, at least as many as shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total / per_part) + 1)


def chars(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, one pass with partial sums."""
    return docs.select(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0


class Memo(dict):
    """A mapping that computes what it lacks and starts afresh when full."""

    def __init__(self, compute: Callable, most: int = MEMO_ENTRIES):
        super().__init__()
        self._compute, self._most = compute, most

    def __missing__(self, key):
        if len(self) >= self._most:
            self.clear()
        value = self[key] = self._compute(key)
        return value


def word_codes() -> Callable[[bytes], np.ndarray]:
    """Codes of a text's words ``[^\\x20\\x09-\\x0D]+`` (what ``bytes.split`` cuts at)."""
    memo = Memo(xxhash.xxh3_64_intdigest)

    def codes(text: bytes | None) -> np.ndarray:
        words = text.split() if text else ()
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))

    return codes


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(codes: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """A hash of each run of ``length`` codes; ``family`` picks one of two hash functions."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    by = np.uint64(_MULTIPLIERS[family])
    value = codes[:n].copy()
    for k in range(1, length):
        value = value * by + codes[k : k + n]
    return mixed(value + np.uint64(length))


def binary(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: all first bytes, then all second ones.  Bytes that hardly differ, as the
    high ones of ids and of sorted hashes, then compress to nothing on their way."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes() if len(numbers) else b""


def unpacked(blobs, kind) -> np.ndarray:
    """The numbers of packed values, one after the other."""
    kind = np.dtype(kind)
    parts = [np.frombuffer(b, np.uint8).reshape(kind.itemsize, -1).T for b in blobs.to_pylist() if b]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).ravel() if parts else np.zeros(0, kind)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted columns (first row included)."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = keys[0][1:] != keys[0][:-1]
        for key in keys[1:]:
            new[1:] |= key[1:] != key[:-1]
    return new


def cuts(groups: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, rows) of each run of a sorted column."""
    starts = np.flatnonzero(runs(groups)) if len(groups) else np.zeros(0, int)
    for k, start in enumerate(starts):
        yield int(groups[start]), slice(start, starts[k + 1] if k + 1 < len(starts) else len(groups))
