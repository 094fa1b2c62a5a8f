"""Starting streams: file sources, exactly-once table sinks, bounded runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallywright.session import settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_settings(partitions: int | None = None) -> dict[str, str]:
    """What a stream takes over at its start: state on disk, number of state partitions."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # A commit then ships the changes of the batch, not a snapshot of the state.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # The number of rows is known from the tables; to count them would look up each key once more.
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    }
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    return wanted


def read_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files: int | None = None, **options
) -> DataFrame:
    """A stream over landed files; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None, timeout: int | None = None
) -> DataFrame:
    """Process what is there, append it to Parquet files, stop, return the table.

    The file sink's log makes a restarted or replayed batch count once.
    """
    spark = stream.sparkSession
    with settings(spark, stream_settings(partitions)):
        query = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(path)
        )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream to {path} did not end in {timeout} s")
    return spark.read.schema(stream.schema).parquet(path)
