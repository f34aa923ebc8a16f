"""Label lookup, cluster quality and run metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.features import OUT_OF_VOCAB


def latest_per_key(
    df: DataFrame, key: str, ts: str, cols: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Columns of the newest row per key.

    Only one row per key and map task is shuffled (a window group limit). Equal
    timestamps are decided by the greatest ``tie_break``, then ``cols``.
    """
    order = [F.desc(c) for c in dict.fromkeys([ts, *tie_break, *cols])]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").select(key, *cols)


def latest_known_labels(
    snapshots: DataFrame,
    label: str,
    *,
    key: str = "endpoint",
    ts: str = "snapshotTimestamp",
    unknown: str = "unknown",
) -> DataFrame:
    """``(key, label)``: the newest label that is known."""
    return latest_per_key(snapshots.where(F.col(label) != unknown), key, ts, [label])


def cluster_quality(
    assignments: DataFrame,
    labels: DataFrame,
    *,
    key: str = "endpoint",
    label: str = "label",
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(*by, name, value)`` metrics and ``(*by, clusterId, name, value)`` per cluster.

    Purity, homogeneity and completeness compare clusters with the known labels of
    their members; noise (null cluster) is only counted.
    """
    by = list(by)
    found = labels.select(key, F.col(label).alias("label"))
    table = (
        assignments.join(found, key, "left")
        .groupBy(*by, "clusterId", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_cluster = (
        table.where(F.col("clusterId").isNotNull())
        .groupBy(*by, "clusterId")
        .agg(
            F.sum("n").alias("size"),
            F.coalesce(F.sum(_known("n")), F.lit(0)).alias("labelled"),
            F.coalesce(F.max(_known("n")), F.lit(0)).alias("top"),
            F.coalesce(F.sum(_known("n * log(n)")), F.lit(0.0)).alias("cells"),
        )
        .withColumn("rows", _n_log_n("labelled"))
    )
    labelled = table.where("clusterId is not null and label is not null")
    columns = labelled.groupBy(*by, "label").agg(F.sum("n").alias("n"))
    columns = columns.groupBy(*by).agg(F.sum(_n_log_n("n")).alias("columns"))
    totals = per_cluster.groupBy(*by).agg(
        F.count(F.lit(1)).cast("double").alias("clusters"),
        F.sum("size").cast("double").alias("clustered"),
        F.sum("labelled").alias("labelled"),
        F.sum("top").alias("top"),
        F.sum("cells").alias("cells"),
        F.sum("rows").alias("rows"),
    )
    noise = table.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("clusterId").isNull(), F.col("n"))), F.lit(0))
        .cast("double")
        .alias("noise")
    )
    if by:
        wide = noise.join(totals, by, "left").join(columns, by, "left")
    else:
        wide = noise.select("*", _only_row(totals).alias("totals"), _only_row(columns).alias("columns")).select(
            "noise", "totals.*", "columns.*"
        )
    n = F.col("labelled")
    label_entropy = F.log(n) - F.col("columns") / n
    cluster_entropy = F.log(n) - F.col("rows") / n
    values = {
        "clusters": F.coalesce("clusters", F.lit(0.0)),
        "clustered": F.coalesce("clustered", F.lit(0.0)),
        "noise": F.col("noise"),
        "purity": _if_any(n, F.col("top") / n),
        "homogeneity": _share(n, F.col("rows"), label_entropy),
        "completeness": _share(n, F.col("columns"), cluster_entropy),
    }
    metrics = _long(wide, by, values)
    per = _long(
        per_cluster,
        [*by, "clusterId"],
        {
            "size": F.col("size").cast("double"),
            "labelled": F.col("labelled").cast("double"),
            "purity": _if_any(F.col("labelled"), F.col("top") / F.col("labelled")),
        },
    )
    return metrics, per


def pivot_metrics(metrics: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """One row per key, one column per metric name."""
    return metrics.groupBy(key).pivot("name", list(names)).agg(F.first("value"))


def out_of_vocab_metrics(words: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label, and how many of them use apps outside the vocabulary."""
    uses = [F.array_contains("words", w) for w in OUT_OF_VOCAB.values()]
    return words.groupBy(label).agg(
        F.count(F.lit(1)).alias("numDevices"), F.count_if(uses[0] | uses[1]).alias("numOutOfVocab")
    )


def detection_metrics(detections: DataFrame, label: str = "label") -> DataFrame:
    """Detections per label."""
    return detections.groupBy(label).agg(F.count(F.lit(1)).alias("numDetections"))


def merge_metrics(left: DataFrame, right: DataFrame, key: str = "label") -> DataFrame:
    """Full outer join of two metric tables."""
    return left.join(right, key, "full")


def _known(expr: str):
    return F.when(F.col("label").isNotNull(), F.expr(expr))


def _only_row(df: DataFrame):
    """The single row of ``df`` as a struct, by scalar subquery."""
    return df.select(F.struct(*df.columns)).scalar()


def _n_log_n(c: str):
    return F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c).cast("double"))).otherwise(0.0)


def _if_any(n, value):
    return F.when(n > 0, value)


def _share(n, whole, entropy):
    """1 - H(a|b) / H(a), and 1 where H(a) is zero."""
    conditional = (whole - F.col("cells")) / n
    return _if_any(n, F.when(entropy <= 1e-12, 1.0).otherwise(1 - conditional / entropy))


def _long(df: DataFrame, keys: list[str], values: dict) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in values.items()]
    long = df.select(*keys, F.explode(F.array(*pairs)).alias("m")).select(*keys, "m.*")
    return long.where(F.col("value").isNotNull())
