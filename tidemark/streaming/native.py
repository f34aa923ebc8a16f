"""Deduplication, bins and windows kept in Spark's own streaming state.

Spark's watermark advances between micro-batches, so a bin is emitted one batch
after its last row, and rows later than the delay are dropped. The partial-bin job
in ``tidemark.streaming.detection`` keeps late rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stream_files(spark, path: str, schema, *, fmt: str = "parquet", glob: str | None = None,
                 max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream; the checkpoint remembers which were read."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def deduplicated(stream: DataFrame, keys: Sequence[str], ts: str, delay: timedelta) -> DataFrame:
    """Drop repeats of the keys that arrive within the delay."""
    return stream.withWatermark(ts, _text(delay)).dropDuplicatesWithinWatermark(list(keys))


def windowed_bins(
    stream: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    *,
    ts: str = "timestamp",
    interval: timedelta,
    delay: timedelta | None = None,
    slide: timedelta | None = None,
) -> DataFrame:
    """Tumbling (or sliding) windows, each emitted once it is complete.

    Pass ``delay`` unless the stream already has a watermark.
    """
    if delay is not None:
        stream = stream.withWatermark(ts, _text(delay))
    window = F.window(ts, _text(interval), _text(slide) if slide else None)
    bins = stream.groupBy(window.alias("bin"), *keys).agg(*measures)
    return bins.select(
        F.col("bin.start").alias("timeBin"), F.col("bin.end").alias("timeBinEnd"),
        *[c for c in bins.columns if c != "bin"],
    )


def _text(interval: timedelta) -> str:
    return f"{interval // timedelta(milliseconds=1)} milliseconds"
