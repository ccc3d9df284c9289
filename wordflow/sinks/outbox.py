"""Delivery of micro-batches once, to targets that may keep a part of what was sent.

A batch is put into an outbox first, every record with an id of its own, and sent
from there. Behind the last record a commit is logged. A batch that runs again is
skipped if its commit is there; if not, the outbox is read back, what the target
holds already is left out, and the rest is sent.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordflow.sinks.commits import CommitLog, Versions

# Names of a record's id, in the outbox and at the target, and of the time, in
# milliseconds, when it was put into the outbox.
DELIVERY, STAGED_AT = "delivery_id", "staged_at"

Send = Callable[[DataFrame], None]
# The ids, as column ``DELIVERY``, that the target holds; its argument is the outbox's table.
Arrived = Callable[[DataFrame], DataFrame]


class Outbox:
    """A sink for ``foreachBatch`` that gives ``send`` every record once.

    ``name`` tells the query from others with the same target. ``key`` names the
    columns that identify a record within its batch (for windows: their bounds and
    the word). Without ``arrived`` the target is taken to keep all of a send or
    nothing: only a batch that was sent whole and not committed comes twice.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        folder: str,
        key: Sequence[str],
        send: Send,
        arrived: Arrived | None = None,
    ) -> None:
        self.name, self.key, self.send, self.arrived = name, list(key), send, arrived
        self.staged = Versions(spark, f"{folder}/outbox")
        self.log = CommitLog(spark, f"{folder}/commits")

    def _with_ids(self, batch: DataFrame, batch_id: int) -> DataFrame:
        parts = F.to_json(F.struct(F.lit(self.name), F.lit(batch_id), *self.key))
        staged_at = F.lit(int(time.time() * 1000)).cast("bigint")
        return batch.withColumns({DELIVERY: F.sha2(parts, 256), STAGED_AT: staged_at})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        done, again = self.log.done(batch_id), self.staged.has(batch_id)
        if done or again:
            # The stream's own state moves on only if the batch is computed.
            batch.write.format("noop").mode("overwrite").save()
        else:
            self.staged.write(batch_id, self._with_ids(batch, batch_id))
        if done:
            return
        records = self.staged.read(batch_id)
        if again and self.arrived is not None:
            there = self.arrived(records).select(DELIVERY).distinct()
            records = records.join(there, DELIVERY, "left_anti").select(*records.columns)
        self.send(records)
        self.log.commit(batch_id)


def append_to_table(path: str) -> Send:
    """Records appended to a parquet folder: a target that keeps whatever was sent before a failure."""

    def send(records: DataFrame) -> None:
        records.write.mode("append").parquet(path)

    return send


def arrived_in_table(path: str) -> Arrived:
    """The ids in a parquet folder that ``append_to_table`` fills; none while it is not there."""

    def arrived(records: DataFrame) -> DataFrame:
        records.limit(0).write.mode("append").parquet(path)
        return records.sparkSession.read.schema(records.schema).parquet(path)

    return arrived
