"""Stamped lines of a stream, cleaned and rejected in one read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from wordflow.operators.stamps import DATE_FORMATS, cleaned, judge_stamps
from wordflow.sinks.commits import CommitLog


def stamp_stream(
    lines: DataFrame, folder: str, checkpoint: str, formats: Sequence[str] = DATE_FORMATS, line: str = "line"
) -> DataStreamWriter:
    """A writer, ready to start, for cleaned lines and rejects, a folder per micro-batch and outcome.

    Both outputs of a batch come from one read of its lines and count together, once
    the batch's commit is there: see ``committed_lines``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, f"{folder}/commits")
        if log.done(batch_id):
            return
        judged = cleaned(judge_stamps(batch, formats, line), line)
        judged.write.mode("overwrite").partitionBy("outcome").parquet(f"{folder}/lines/batch_id={batch_id}")
        log.commit(batch_id)

    return lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def committed_lines(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """``batch_id``, ``outcome`` and the lines, in the shape ``schema``, of all batches that were committed."""
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("outcome", T.StringType())])
    done = CommitLog(spark, f"{folder}/commits").committed()
    if not done:
        return spark.createDataFrame([], whole)
    found = spark.read.schema(whole).parquet(f"{folder}/lines")
    return found.filter(F.col("batch_id").isin(done))
