"""Object listings as DataFrames.

Listing is left to Spark's file index, which spreads many prefixes over the
cluster; file contents are never read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/*"

LISTING_SCHEMA = "path string, modificationTime timestamp, length long"


def list_objects(
    spark: SparkSession,
    root: str,
    prefixes: str | Sequence[str] = "",
    *,
    glob: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """``(path, modificationTime, length)`` of all files whose key starts with a prefix.

    ``root`` is the bucket or base folder. ``glob`` filters file names, ``where``
    any other property. No match gives an empty table.
    """
    wanted = [prefixes] if isinstance(prefixes, str) else list(prefixes)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        found = reader.load(_pattern(root, wanted))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    listed = found.select("path", "modificationTime", "length")
    return listed if where is None else listed.where(where)


def list_keys(
    spark: SparkSession,
    root: str,
    prefixes: str | Sequence[str] = "",
    *,
    full_urls: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """``(key)`` relative to ``root``, or full URLs."""
    listed = list_objects(spark, root, prefixes, glob=glob)
    return listed.select((F.col("path") if full_urls else key_of("path", root)).alias("key"))


def exists(spark: SparkSession, root: str, prefix: str = "") -> bool:
    """Whether any object lies under the prefix."""
    return not list_objects(spark, root, prefix).limit(1).isEmpty()


def key_of(path: str, root: str) -> Column:
    """Part of ``path`` after ``root``, which it must begin with (schemes aside), else null."""
    stem = _bare(root.rstrip("/")) + "/"
    bare = F.regexp_replace(F.col(path), _SCHEME, "")
    return F.when(bare.startswith(stem), bare.substr(len(stem) + 1, 1 << 20))


def literal_glob(text: str) -> str:
    """``text`` as a path pattern that matches only itself."""
    return re.sub(r"([*?\[\]{},^\\])", r"\\\1", text)


def _bare(path: str) -> str:
    return re.sub(_SCHEME, "", path)


def _pattern(root: str, prefixes: Sequence[str]) -> str:
    base = literal_glob(root.rstrip("/")) + "/"
    stems = sorted({literal_glob(p.lstrip("/")) for p in prefixes})
    if len(stems) == 1:
        return f"{base}{stems[0]}*"
    return f"{base}{{{','.join(stems)}}}*"
