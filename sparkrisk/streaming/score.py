"""Cleaning and scoring of arriving rows.

Everything learned is in the model, so each row is handled by itself and no state
or watermark is needed.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sparkrisk.operators.clean import clean
from sparkrisk.spec import MIXED, TARGET


def clean_stream(rows: DataFrame, target: str = TARGET, mixed: str | None = MIXED) -> DataFrame:
    """The batch cleaning on a streaming table."""
    return clean(rows, target, mixed)


def score_stream(
    rows: DataFrame, model: PipelineModel, output: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Appends scored rows to a Parquet folder, each exactly once."""
    writer = model.transform(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)


def score_stream_in_batches(
    rows: DataFrame, model: PipelineModel, output: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Scores every micro-batch as a batch table and stores it under its number.

    A batch that is run again after a failure replaces its own folder.
    """

    def handle(batch: DataFrame, number: int) -> None:
        model.transform(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
