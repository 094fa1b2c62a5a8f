"""Audit log written as findings come up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallywright.sources import sinks
from tallywright.sources.append_log import AppendLog


def log_stream(findings: DataFrame, log: AppendLog | str, checkpoint: str) -> StreamingQuery:
    """Append findings per micro-batch; a finding already logged is left out, also on replay.

    An :class:`AppendLog` costs what the batch costs; a catalog table (its name) is read for its ids.
    """

    def append(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        if isinstance(log, AppendLog):
            log.append(batch, (checkpoint, number))
        else:
            sinks.append_new(batch, log, "log_id")

    return (
        findings.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
