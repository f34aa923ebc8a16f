"""Incremental reads of raw files laid out as ``<customer>/data/<time>/<entity>/…``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedupe import earliest_per_key
from tidemark.operators.enrich import byte_threshold_filter, flatten_records, flatten_struct
from tidemark.sources.listing import list_objects, literal_glob

# Folder names and time formats of the raw layout.
DATA_FOLDER = "data"
MINUTE_PREFIX = "%Y-%m-%dT%H-%M"
PATH_TIME = "yyyy-MM-dd'T'HH-mm-ss.SSS'Z'"
FLOW_ENTITY = "netflowpacket"
ENDPOINT_ENTITY = "endpointclassification"


def minute_prefixes(customer: str, start: datetime, end: datetime) -> list[str]:
    """One listing prefix per minute in ``[start, end)``."""
    minutes = int((end - start) / timedelta(minutes=1))
    return [
        f"{customer}/{DATA_FOLDER}/{start + timedelta(minutes=n):{MINUTE_PREFIX}}"
        for n in range(minutes)
    ]


def path_time(path: Column) -> Column:
    """Time folder of a raw file, null if the path has another form."""
    token = F.regexp_extract(path, rf"/{DATA_FOLDER}/([^/]+)/", 1)
    return F.try_to_timestamp(token, F.lit(PATH_TIME))


def path_entity(path: Column) -> Column:
    """Entity folder of a raw file."""
    return F.regexp_extract(path, rf"/{DATA_FOLDER}/[^/]+/([^/]+)/", 1)


def discover(
    spark: SparkSession,
    root: str,
    customer: str,
    start: datetime,
    end: datetime,
    watermark: datetime,
    suffix: str = "avro",
) -> DataFrame:
    """``(path, entity, ts)`` of new raw files of both entities."""
    listed = list_objects(spark, root, minute_prefixes(customer, start, end), glob=f"*.{suffix}")
    path = F.col("path")
    files = listed.select("path", path_entity(path).alias("entity"), path_time(path).alias("ts"))
    return files.where(
        F.col("entity").isin(FLOW_ENTITY, ENDPOINT_ENTITY) & (F.col("ts") > F.lit(watermark))
    )


def new_watermark(files: DataFrame, start: datetime) -> DataFrame:
    """One row: the latest file time, no earlier than ``start``."""
    return files.agg(F.greatest(F.coalesce(F.max("ts"), F.lit(start)), F.lit(start)).alias("timestamp"))


def read_raw(
    spark: SparkSession,
    root: str,
    customer: str,
    entity: str,
    schema: T.StructType | str,
    start: datetime,
    end: datetime,
    watermark: datetime,
    upto: datetime | None = None,
    *,
    fmt: str = "avro",
    suffix: str | None = None,
    ignore_corrupt: bool = False,
) -> DataFrame:
    """Rows of one entity's files after ``watermark`` and, if given, up to ``upto``.

    Minute folders limit the listing, and the filter on the file path prunes files
    before they are opened. ``upto`` keeps out files that land between two listings.
    """
    stems = sorted(p.split("/")[-1] for p in minute_prefixes(customer, start, end))
    base = literal_glob(f"{root.rstrip('/')}/{customer}/{DATA_FOLDER}")
    reader = (
        spark.read.format(fmt)
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix or fmt}")
        .option("ignoreCorruptFiles", str(ignore_corrupt).lower())
    )
    try:
        rows = reader.load(f"{base}/{{{','.join(stems)}}}*/{entity}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    arrived = path_time(F.col("_metadata.file_path"))
    rows = rows.where(arrived > F.lit(watermark))
    return rows if upto is None else rows.where(arrived <= F.lit(upto))


def flow_rows(
    raw: DataFrame, thresholds: DataFrame, default_client: int, default_server: int
) -> DataFrame:
    """Flattened flows that pass the byte thresholds."""
    return byte_threshold_filter(flatten_records(raw), thresholds, default_client, default_server)


def endpoint_rows(raw: DataFrame, keys: list[str]) -> DataFrame:
    """Flattened endpoints, the earliest record per key."""
    return earliest_per_key(flatten_struct(raw), keys)
