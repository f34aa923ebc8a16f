"""The detection job as a stream: partial bins per micro-batch.

Each micro-batch writes its own partial bins under its batch id, so a repeated
batch replaces what it wrote before, and late rows add partials to old bins. The
trailing window then sums over the stored partials.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import interval_literal
from tidemark.operators.rollup import last_record, recent_bins, trailing_window

OnWindow = Callable[[DataFrame, int], None]


def write_partial_bins(bins: DataFrame, path: str, batch_id: int) -> None:
    """Store one batch's bins, by day and batch."""
    (
        bins.withColumns({"binDate": F.to_date("timeBin"), "batchId": F.lit(batch_id)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("binDate", "batchId")
        .parquet(path)
    )


def window_of_batch(
    spark, path: str, batch_id: int, schema, interval: timedelta, window: timedelta
) -> DataFrame:
    """Trailing window up to the last record of a batch.

    Of earlier batches, only days that can reach into the window are read.
    """
    stored = spark.read.schema(schema).parquet(path).where(F.col("batchId") <= batch_id)
    fresh = F.col("batchId") == batch_id
    last = last_record(stored.where(fresh))
    oldest = last - interval_literal(interval)
    near = stored.where(fresh | (F.col("binDate") >= F.to_date(oldest - interval_literal(window))))
    return trailing_window(recent_bins(near, oldest, window, fresh), interval, window, last)


def run_partial_bins(
    stream: DataFrame,
    to_bins: Callable[[DataFrame], DataFrame],
    bins_path: str,
    checkpoint: str,
    *,
    interval: timedelta,
    window: timedelta,
    on_window: OnWindow | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream. ``to_bins`` turns a micro-batch into partial bins;
    ``on_window`` gets the trailing window of each batch, to score and store it."""

    def process(batch: DataFrame, batch_id: int) -> None:
        bins = to_bins(batch)
        write_partial_bins(bins, bins_path, batch_id)
        if on_window is not None:
            schema = f"{_ddl(bins)}, binDate date, batchId int"
            on_window(
                window_of_batch(batch.sparkSession, bins_path, batch_id, schema, interval, window),
                batch_id,
            )

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store a result under its batch id; a repeated batch replaces it."""
    (
        df.withColumn("batchId", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batchId")
        .parquet(path)
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
