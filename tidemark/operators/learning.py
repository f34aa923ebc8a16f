"""Group folds, weighted boosting and per-class scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, literal_table, splittable

# Boosting parameters and their names in Spark ML.
BOOSTING_PARAMS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "min_data_in_leaf": "minInstancesPerNode",
    "min_gain_to_split": "minInfoGain",
}


def stratified_group_folds(
    df: DataFrame, group: str, label: str, k: int, *, fold: str = "fold"
) -> DataFrame:
    """Add a fold 0..k-1 such that a group never spans folds and label shares stay close.

    Groups are dealt out in turn: by their main label, largest first, then by the md5 of
    the group. No task ranks all of them: groups are counted by label, size and the first
    digits of the md5, and only those of one count are numbered together.
    """
    counts = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    key = F.md5(F.coalesce(F.col(group).cast("string"), F.lit("")))
    groups = (
        counts.groupBy(group)
        .agg(F.max(F.struct("n", label))[label].alias("stratum"), F.sum("n").alias("size"))
        .select(F.col(group).alias("__group"), "stratum", "size", key.alias("key"))
        .withColumn("digits", F.substring("key", 1, 3))
    )
    parts = ["stratum", "size", "digits"]
    tally = groups.groupBy(*parts).agg(F.count(F.lit(1)).alias("m"))
    strata = tally.groupBy("stratum").agg(F.sum("m").alias("all"))
    earlier = Window.orderBy("stratum").rowsBetween(Window.unboundedPreceding, -1)
    strata = strata.select("stratum", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("first"))
    ahead = Window.partitionBy("stratum").orderBy(F.desc("size"), "digits").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select(*parts, F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("before"))
    offsets = offsets.join(strata, offsets["stratum"].eqNullSafe(strata["stratum"])).select(
        *[offsets[c].alias(f"__{c}") for c in parts], (F.col("first") + F.col("before")).alias("offset")
    )
    together = Window.partitionBy(*parts).orderBy("key", "__group")
    numbered = groups.withColumn("number", F.row_number().over(together))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in parts]
    dealt = numbered.join(splittable(offsets), same).select(
        "__group", F.pmod(F.col("offset") + F.col("number") - 1, F.lit(k)).cast("int").alias(fold)
    )
    return df.join(dealt, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")


def balanced_group_folds(
    df: DataFrame, group: str, label: str, k: int, *, fold: str = "fold", most: int = 100_000
) -> DataFrame:
    """Add a fold 0..k-1 such that a group never spans folds and every label is spread evenly.

    A group is its counts of all labels, and groups of equal counts are alike: they are dealt
    evenly, in the order of their md5, and only what does not go up evenly is assigned,
    each to the fold that leaves the shares of all labels closest. Counts come in the order
    of their own spread, widest first. The driver gets a row per different counts; beyond
    the first ``most`` of them the rest of equal groups starts at a fold by hash. Null labels
    are a label, and null groups one group.
    """
    labels = [r[0] for r in df.select(label).distinct().orderBy(F.asc_nulls_first(label)).collect()]
    one = [F.count(F.when(F.col(label).eqNullSafe(F.lit(name)), 1)) for name in labels] or [F.lit(0).cast("long")]
    groups = df.groupBy(F.col(group).alias("__group")).agg(F.array(*one).alias("counts"))
    key = F.md5(F.coalesce(F.col("__group").cast("string"), F.lit("")))
    groups = groups.withColumn("key", key).withColumn("digits", F.substring("key", 1, 3))
    tally = groups.groupBy("counts", "digits").agg(F.count(F.lit(1)).alias("m"))
    alike = cut_lineage(tally.groupBy("counts").agg(F.sum("m").alias("all")))
    square = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c * c) * len(labels)
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    first = alike.orderBy((square - total * total).desc(), F.col("counts").desc()).limit(most).collect()
    rests = deal_rests([(list(r["counts"]), r["all"] % k) for r in first], k)
    known = literal_table(
        df.sparkSession, [(list(r["counts"]), rest) for r, rest in zip(first, rests)], "counts array<bigint>, rest array<int>"
    )
    ahead = Window.partitionBy("counts").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.withColumn("before", F.coalesce(F.sum("m").over(ahead), F.lit(0))).drop("m")
    offsets = offsets.join(alike, "counts").join(known, "counts", "left")
    together = Window.partitionBy("counts", "digits").orderBy("key", "__group")
    place = F.col("before") + F.row_number().over(together) - 1
    even = F.floor(F.col("all") / k) * k
    other = F.pmod(F.xxhash64("counts") + place, F.lit(k))
    rest = F.coalesce(F.get("rest", (place - even).cast("int")).cast("long"), other)
    dealt = groups.join(splittable(offsets), ["counts", "digits"]).select(
        "__group", F.when(place < even, F.pmod(place, F.lit(k))).otherwise(rest).cast("int").alias(fold)
    )
    return df.join(dealt, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")


def deal_rests(groups: Sequence[tuple[Sequence[int], int]], k: int) -> list[list[int]]:
    """For counts of labels and how many groups have them, fewer than ``k``, a fold for each, all different.

    Each goes to the fold that makes the mean spread of the labels' shares least; of equal
    folds to that of fewest rows, then to the first.
    """
    if not groups:
        return []
    counts = np.array([c for c, _ in groups], float)
    totals = np.maximum((counts * np.array([[n] for _, n in groups]).reshape(-1, 1)).sum(axis=0), 1)
    held, out = np.zeros((k, counts.shape[1])), []
    for row, (_, n) in zip(counts, groups):
        free, chosen = list(range(k)), []
        for _ in range(n):
            after = np.repeat(held[None], len(free), axis=0)
            after[np.arange(len(free)), free] += row
            spread = np.round((after / totals).std(axis=1).mean(axis=1), 12)
            best = min(range(len(free)), key=lambda f: (spread[f], held[free[f]].sum(), free[f]))
            held[free[best]] += row
            chosen.append(free.pop(best))
        out.append(chosen)
    return out


def boosting(
    *,
    features: str = "features",
    label: str = "label",
    weight: str | None = "weight",
    seed: int = 0,
    **params: float,
) -> GBTClassifier:
    """A weighted gradient-boosted classifier; see ``BOOSTING_PARAMS`` for the names."""
    unknown = set(params) - set(BOOSTING_PARAMS)
    if unknown:
        raise ValueError(f"no Spark counterpart for {sorted(unknown)}")
    clf = GBTClassifier(featuresCol=features, labelCol=label, seed=seed)
    if weight:
        clf = clf.setWeightCol(weight)
    return clf.setParams(**{BOOSTING_PARAMS[name]: value for name, value in params.items()})


def weighted_f1(label: str = "label", weight: str | None = "weight") -> MulticlassClassificationEvaluator:
    """Weighted F1 of the positive class."""
    evaluator = MulticlassClassificationEvaluator(
        labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0
    )
    return evaluator.setWeightCol(weight) if weight else evaluator


def search_boosting(
    train: DataFrame,
    grid: Mapping[str, Sequence[float]],
    *,
    group: str = "group",
    label: str = "label",
    weight: str | None = "weight",
    features: str = "features",
    k: int = 3,
    parallelism: int = 2,
) -> tuple[dict[str, float], CrossValidatorModel]:
    """Best parameters by mean weighted F1 over stratified group folds."""
    clf = boosting(features=features, label=label, weight=weight)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(clf.getParam(BOOSTING_PARAMS[name]), list(values))
    maps = builder.build()
    search = CrossValidator(
        estimator=clf,
        estimatorParamMaps=maps,
        evaluator=weighted_f1(label, weight),
        numFolds=k,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(cut_lineage(stratified_group_folds(train, group, label, k)))
    best = maps[max(range(len(maps)), key=lambda n: search.avgMetrics[n])]
    names = {spark: name for name, spark in BOOSTING_PARAMS.items()}
    return {names[p.name]: v for p, v in best.items()}, search


def fit_boosting(
    train: DataFrame,
    *,
    model_params: Mapping[str, float] | None = None,
    grid: Mapping[str, Sequence[float]] | None = None,
    group: str = "group",
    label: str = "label",
    weight: str | None = "weight",
    features: str = "features",
    k: int = 3,
) -> GBTClassificationModel:
    """Fit with the given parameters, or with the best of ``grid``."""
    if model_params is None:
        model_params, _ = search_boosting(
            train, grid or {}, group=group, label=label, weight=weight, features=features, k=k
        )
    return boosting(features=features, label=label, weight=weight, **model_params).fit(train)


def score_classes(
    rows: DataFrame, models: Mapping[str, Model | PipelineModel], label: str = "label"
) -> DataFrame:
    """Rows of each class with the prediction of that class's model.

    If all models give their prediction as an expression (``predicted``), the rows are read
    once and each takes that of its class; other models each read the rows of their class.
    """
    if models and all(hasattr(model, "predicted") for model in models.values()):
        own = [F.when(F.col(label) == name, model.predicted(rows)) for name, model in models.items()]
        return rows.where(F.col(label).isin(*models)).withColumn("prediction", F.coalesce(*own))
    scored = [
        model.transform(rows.where(F.col(label) == name)).select(*rows.columns, "prediction")
        for name, model in models.items()
    ]
    if not scored:
        raise ValueError("no active classes")
    out = scored[0]
    for part in scored[1:]:
        out = out.unionByName(part)
    return out


def positives(scored: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows predicted positive."""
    return scored.where(F.col("prediction") == 1).select(*cols)
