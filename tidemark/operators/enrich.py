"""Flattening, filtering and lookups of flow and endpoint records.

Lookup tables are joined without a hint: Spark broadcasts one only where its
size stays under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles
both sides, where adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import UNKNOWN, UNKNOWN_NAMES, resolved_app_name
from tidemark.session import splittable

# Fields of an endpoint record that carry no device attribute.
ENDPOINT_DROPPED = ("matchedRules", "logicalProfile", "classificationTimestamp", "macRandomData")


def flatten_records(df: DataFrame, col: str = "records") -> DataFrame:
    """Merge the fields of the first element of an array of structs into the row."""
    inner = df.schema[col].dataType.elementType.fieldNames()
    kept = [c for c in df.columns if c != col and c not in inner]
    return df.select(*kept, *[F.get(F.col(col), F.lit(0))[f].alias(f) for f in inner])


def flatten_struct(
    df: DataFrame, col: str = "classificationData", drop: Sequence[str] = ENDPOINT_DROPPED
) -> DataFrame:
    """Merge a struct's fields into the row; null arrays become empty ones."""
    fields = [f for f in df.schema[col].dataType.fields if f.name not in drop]
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c != col and c not in names]
    return df.select(*kept, *[_filled(F.col(col)[f.name], f).alias(f.name) for f in fields])


def fill_from(df: DataFrame, fallbacks: Mapping[str, str]) -> DataFrame:
    """Fill nulls of each target from its fallback column, which is dropped."""
    filled = {t: F.coalesce(F.col(t), F.col(f)) for t, f in fallbacks.items()}
    return df.withColumns(filled).drop(*fallbacks.values())


def unpivot_sides(
    df: DataFrame,
    common: Sequence[str],
    sides: Mapping[str, str],
    target: str = "mac",
    side: str = "side",
) -> DataFrame:
    """One row per record and side with a known identifier, in a single scan."""
    ends = F.explode(
        F.array(*[F.struct(F.col(c).alias(target), F.lit(s).alias(side)) for s, c in sides.items()])
    )
    known = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in sides.values()])
    rows = df.where(known).select(*common, ends.alias("__end")).select(*common, "__end.*")
    return rows.where(F.col(target).isNotNull())


def byte_threshold_filter(
    df: DataFrame,
    thresholds: DataFrame,
    default_client: int,
    default_server: int,
    *,
    app: str = "appName",
    client: str = "clientBytesSent",
    server: str = "serverBytesSent",
) -> DataFrame:
    """Keep flows that carried enough bytes.

    An app listed in ``thresholds`` (app, minFlowClientBytes, minFlowServerBytes)
    must reach both of its minima; any other app must reach the defaults in one
    direction or the other.
    """
    limits = thresholds.groupBy(F.col("app").alias("__app")).agg(
        F.max("minFlowClientBytes").alias("__client"), F.max("minFlowServerBytes").alias("__server")
    )
    looked_up = F.when(F.col(app) == "Unknown", "unknown").otherwise(F.col(app))
    c, s = F.col(client), F.col(server)
    listed = (c >= F.col("__client")) & (s >= F.col("__server"))
    other = ((c >= default_client) & (s >= default_server)) | (
        (c >= default_server) & (s >= default_client)
    )
    joined = df.join(splittable(limits), looked_up == F.col("__app"), "left")
    keep = F.when(F.col("__app").isNotNull(), listed).otherwise(other)
    return joined.where(keep).select(*df.columns)


def lookup_flag(
    df: DataFrame, table: DataFrame, key: str, flag: str, default: bool = False
) -> DataFrame:
    """Left lookup of a flag; rows without an entry get ``default``."""
    entries = table.groupBy(F.col(key).alias("__key")).agg(F.max(flag).alias(flag))
    joined = df.join(splittable(entries), F.col(key) == F.col("__key"), "left")
    return joined.select(*df.columns, F.coalesce(F.col(flag), F.lit(default)).alias(flag))


def lookup_overwrite(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    col: str,
    value: str,
    when: Column,
    *,
    drop_null: bool = True,
) -> DataFrame:
    """Overwrite ``col`` with the table's ``value`` on rows where ``when`` holds.

    The least value decides between entries with equal keys. Rows left without a
    value are dropped.
    """
    entries = table.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
        F.min(value).alias("__value")
    )
    on = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    new = F.when(when, F.col("__value")).otherwise(F.col(col))
    out = df.join(splittable(entries), on, "left").select(
        *[new.alias(c) if c == col else F.col(c) for c in df.columns]
    )
    return out.where(F.col(col).isNotNull()) if drop_null else out


def resolve_app_names(
    df: DataFrame, taxonomy: DataFrame, *, flag: str = "isInTaxonomy", unknown: str = UNKNOWN
) -> DataFrame:
    """Replace ``appName`` by its standard name."""
    flagged = lookup_flag(df, taxonomy, "appName", flag)
    name = resolved_app_name(
        F.col("appName"), F.col("ipProto"), F.col("serverPort"), F.col(flag), unknown
    )
    return flagged.withColumn("appName", name).select(*df.columns)


def single_ports(registry: DataFrame, port: str = "port") -> DataFrame:
    """Registry entries of one port each; ranges such as ``8000-8010`` are dropped."""
    return registry.where(~F.col(port).contains("-")).withColumn(port, F.col(port).try_cast("long"))


def port_based_apps(
    df: DataFrame, registry: DataFrame, unknown_names: Sequence[str] = UNKNOWN_NAMES
) -> DataFrame:
    """Name unknown applications after their registered port; drop the rest."""
    ports = single_ports(registry).select(
        "ipProto", F.col("port").alias("serverPort"), F.col("appName").alias("portName")
    )
    return lookup_overwrite(
        df, ports, ["ipProto", "serverPort"], "appName", "portName",
        F.col("appName").isin(*unknown_names),
    )


def assign_class(
    df: DataFrame, rules: Sequence[tuple[str, Column]], col: str = "logicalClass"
) -> DataFrame:
    """Label rows by the first predicate that holds; unlabelled rows are dropped."""
    (label, cond), *others = rules
    chain = F.when(cond, label)
    for label, cond in others:
        chain = chain.when(cond, label)
    return df.withColumn(col, chain).where(F.col(col).isNotNull())


def attach_endpoints(
    flows: DataFrame,
    endpoints: DataFrame,
    active: Sequence[str] | None = None,
    *,
    mac: str = "macAddress",
    label: str = "logicalClass",
) -> DataFrame:
    """Inner join of flow sides with known endpoints of the active classes."""
    known = endpoints.select(F.col(mac).alias("mac"), label, "uuid")
    if active is not None:
        known = known.where(F.col(label).isin(*active))
    return flows.join(known, "mac")


def _filled(value: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(value, F.array().cast(field.dataType))
    return value
