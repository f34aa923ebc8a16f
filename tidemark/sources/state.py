"""State tables: Parquet, partitioned by customer and reference time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.metrics import latest_per_key

# Fixed value: reference times sort as text.
REF_TIME = "yyyy-MM-dd'T'HH-mm-ss.SSS"

_NOTE = "empty boolean"
WATERMARK_SCHEMA = "timestamp timestamp"


def write_state(
    df: DataFrame, root: str, entity: str, customer: str, ref_ts: datetime | Column, mode: str = "overwrite"
) -> None:
    """Write one snapshot; the same customer and time overwrite each other only.

    Whether it is empty is noted beside the table, as an empty snapshot has no files and
    would leave an older one of the same time, or an earlier time, in its place.
    """
    # Asked first: a repeated run may read what it overwrites.
    empty = not isinstance(ref_ts, Column) and df.isEmpty()
    _write_partitions(df, root, entity, customer, ref_ts, mode)
    if not isinstance(ref_ts, Column):
        note = df.sparkSession.createDataFrame([(empty,)], _NOTE)
        _write_partitions(note, root, _notes(entity), customer, ref_ts, "overwrite")


def _write_partitions(df: DataFrame, root: str, entity: str, customer: str, ref_ts: datetime | Column, mode: str) -> None:
    (
        df.withColumns({"customer": F.lit(customer), "refTs": ref_time(ref_ts)})
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("customer", "refTs")
        .parquet(_path(root, entity))
    )


def _notes(entity: str) -> str:
    return f"{entity}_snapshots"


def read_state(
    spark: SparkSession,
    root: str,
    entity: str,
    customer: str,
    schema: T.StructType | str,
    *,
    latest_only: bool = False,
    at: datetime | None = None,
) -> DataFrame:
    """All snapshots of an entity, the newest one, or that of a time; empty if there is none.

    A snapshot that was written empty is empty, also if it is the newest.
    """
    rows = _read_partitions(spark, root, entity, customer, schema)
    notes = _read_partitions(spark, root, _notes(entity), customer, _NOTE)
    if at is not None:
        rows, notes = (t.where(F.col("refTs") == ref_time(at)) for t in (rows, notes))
    elif latest_only:
        times = rows.select("refTs").unionByName(notes.select("refTs"))
        rows = rows.where(F.col("refTs") == times.agg(F.max("refTs")).scalar())
    return rows.join(notes.where("empty").select("refTs"), "refTs", "left_anti").select(*rows.columns)


def _read_partitions(spark: SparkSession, root: str, entity: str, customer: str, schema: T.StructType | str) -> DataFrame:
    full = T.StructType(
        [
            *(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields,
            T.StructField("customer", T.StringType()),
            T.StructField("refTs", T.StringType()),
        ]
    )
    try:
        rows = spark.read.schema(full).parquet(_path(root, entity))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], full)
    return rows.where(F.col("customer") == customer)


def ref_time(ts: datetime | Column) -> Column:
    """A reference time as it is written in the partition column."""
    return F.date_format(ts if isinstance(ts, Column) else F.lit(ts), REF_TIME)


def latest_partition(df: DataFrame, col: str) -> DataFrame:
    """Rows with the greatest value of a (partition) column."""
    return df.where(F.col(col) == df.agg(F.max(col)).scalar())


def write_watermark(spark: SparkSession, root: str, customer: str, ts: datetime) -> None:
    """Store the time up to which files were taken."""
    row = spark.createDataFrame([(ts,)], WATERMARK_SCHEMA)
    write_state(row, root, "watermarkTs", customer, ts)


def read_watermark(
    spark: SparkSession, root: str, customer: str, end: datetime, interval: timedelta
) -> datetime:
    """The greatest stored watermark, or one interval before ``end``."""
    stored = read_state(spark, root, "watermarkTs", customer, WATERMARK_SCHEMA)
    default = F.lit(end - interval)
    return stored.agg(F.coalesce(F.max("timestamp"), default).alias("ts")).first()["ts"]


def archive(
    df: DataFrame, limit: datetime, history_root: str, entity: str
) -> DataFrame:
    """Copy snapshots older than ``limit`` to the history table and return the live rest.

    Files are left in place for the storage owner to expire.
    """
    cut = ref_time(limit)
    (
        df.where(F.col("refTs") < cut)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("customer", "refTs")
        .parquet(_path(history_root, entity))
    )
    return df.where(F.col("refTs") >= cut)


def archive_all(
    tables: dict[str, DataFrame],
    watermark: datetime,
    history_root: str,
    keep: timedelta,
    keep_endpoints: timedelta,
) -> dict[str, DataFrame]:
    """Retention of all state tables; endpoint snapshots have a limit of their own."""
    return {
        entity: archive(
            df, watermark - (keep_endpoints if entity == "endpoint" else keep), history_root, entity
        )
        for entity, df in tables.items()
    }


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append rows to a relational table."""
    df.write.mode("append").jdbc(url, table, properties=properties or {})


def append_metrics(df: DataFrame, path: str, fmt: str = "json") -> Exception | None:
    """Append metrics; a failure is returned rather than raised."""
    try:
        df.write.mode("append").format(fmt).save(path)
    except Exception as e:  # metrics must not fail the run
        return e
    return None


def merge_endpoints(new: DataFrame, stored: DataFrame, key: str = "macAddress", ts: str = "timestamp") -> DataFrame:
    """Newest record per device over stored and new endpoints."""
    both = stored.select(*new.columns).unionByName(new)
    rest = [c for c in new.columns if c not in (key, ts)]
    return latest_per_key(both, key, ts, [ts, *rest]).select(*new.columns)


def _path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}"
