"""Per-minute concurrent users from a stream of server heartbeats.

The batch job (R29) sums every server's latest status once a minute. Here
each heartbeat ``(hashkey, dtmUpdated, numCCU)`` lands in its minute window;
per (minute, server) the latest heartbeat counts, and a minute's total is the
sum over the servers that reported in it. The watermark bounds state: a
minute is final once heartbeats ``lateness`` newer have arrived, and its
per-server rows are then emitted together, so each micro-batch holds whole
minutes. They are summed and upserted into ``crm_ccu`` by minute (K3), which
makes replays of a micro-batch idempotent.

Servers that did not report within the minute are not counted (the batch
job's ``staleness="strict"`` reading, with a one-minute tolerance).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ccu import STATUS_PREFIX
from tallyspark.sinks.store import TableStore


def ccu_per_minute(heartbeats: DataFrame, lateness: str = "2 minutes") -> DataFrame:
    """Streaming (or batch) DataFrame of finished (minute, server, ccu) rows."""
    return (heartbeats
            .where(F.col("hashkey").startswith(STATUS_PREFIX))
            .withWatermark("dtmUpdated", lateness)
            .groupBy(F.window("dtmUpdated", "1 minute").alias("w"), "hashkey")
            # latest heartbeat; equal stamps resolve to the larger count
            .agg(F.max(F.struct("dtmUpdated", "numCCU")).alias("last"))
            .select(F.col("w.start").alias("time"), "hashkey", F.col("last.numCCU").alias("numCCU")))


def minute_totals(per_server: DataFrame) -> DataFrame:
    """(time, ccu) per minute from finished (minute, server, ccu) rows."""
    return (per_server.groupBy("time")
            .agg(F.coalesce(F.sum("numCCU"), F.lit(0)).cast("int").alias("ccu")))


def _write_minutes(store: TableStore):
    def write(batch: DataFrame, _batch_id: int) -> None:
        store.upsert("crm_ccu", minute_totals(batch), "time", "day", F.to_date("time"))
    return write


def start_ccu_stream(heartbeats: DataFrame, store: TableStore, checkpoint: str,
                     lateness: str = "2 minutes", trigger: dict | None = None):
    """Start the query; ``checkpoint`` must be a shared, durable folder (the
    stream's progress and window state survive executor or driver loss)."""
    writer = (ccu_per_minute(heartbeats, lateness).writeStream
              .outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(_write_minutes(store)))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
