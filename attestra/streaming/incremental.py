"""Streams over the same operators: the incremental load as micro-batches, and a running fold of a decision log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from attestra.operators.reconcile import reconcile_evidence


def load_stream(arrivals: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame, DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Reconcile every micro-batch with the stored evidence, source by source; replaying a batch changes nothing.

    A batch is the whole load of the sources it names (a file holds all of a source): only their evidence can become
    obsolete, that of all others stays as it is. read gives the current evidence, write stores (evidence, actions).
    """

    def one(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        current, named = read(), batch.select(F.col("fuente").alias("__fuente")).distinct()
        same = F.col("fuente").eqNullSafe(F.col("__fuente"))
        after, actions = reconcile_evidence(current.join(named, same, "left_semi"), batch)
        write(after.unionByName(current.join(named, same, "left_anti"), allowMissingColumns=True), actions)

    return arrivals.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state_stream(log: DataFrame, key: str, time: str) -> DataFrame:
    """The last state of each key so far. The state is one row a key, for good: a decision holds until the next one."""
    return log.groupBy(key).agg(F.max_by(F.struct("estado_nuevo", "validador"), time).alias("last")).select(key, "last.*")


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Events of each kind in windows of time, closed once the watermark has passed."""
    return events.withWatermark(time, delay).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")
