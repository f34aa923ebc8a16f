"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as named by ``spark.checkpoint.dir``.

    Where it is unset a local master gets a scratch folder; a cluster must name
    one, since executors cannot read each other's local disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="tidemark-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run in here drop their shuffle files when they end.

    Otherwise these stay on disk until the driver happens to collect garbage. It is for queries whose
    result is written, as nothing reads their shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there."""
    shared_dir(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        # The setting counts for a query from when it is made.
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it from there.

    This cuts lineage, so that a lost executor costs no recomputation beyond its own
    tasks, and tells the optimizer the size. The folder belongs to its owner to clear.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def splittable(df: DataFrame) -> DataFrame:
    """Move an aggregate away from its keys before a join on them.

    Adaptive execution splits a hot join key only if both sides are shuffled for
    the join, and an aggregate on the join keys would not be.
    """
    return df.repartition(F.xxhash64(*df.columns))


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A small table of given rows whose size the optimizer knows, so that it is
    broadcast rather than shuffled against."""
    names = [part.split()[0] for part in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(names)
    return spark.createDataFrame(pa.table({n: list(c) for n, c in zip(names, columns)}), schema)
