"""Gradient boosting on histograms: regularised leaves, a leaf budget and early stopping.

Features are cut into bins at their quantiles once. For every tree the gradients of the log
loss are summed by leaf, feature and bin, with partial sums before the shuffle; the best split of
each leaf is found from running sums over its bins, and only that reaches the driver. Trees
grow best leaf first. The rows carry their score from tree to tree.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.vectors import as_array
from tidemark.operators.learning import balanced_group_folds, weighted_f1
from tidemark.session import cut_lineage

#: Relative error of the quantiles is one in this many.
ACCURACY = 10_000
# Gains that differ by less count as equal, and the first feature and bin is taken.
_DIGITS = 9


@dataclass(frozen=True)
class TreeParams:
    """Settings of the trees. A leaf's value is that of its summed gradients, less ``lambda_l1``, over
    its hessians and ``lambda_l2``; a split has to gain more than ``min_gain_to_split``."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int = -1
    min_data_in_leaf: int = 20
    lambda_l1: float = 0.0
    lambda_l2: float = 0.0
    min_gain_to_split: float = 0.0
    max_bins: int = 255
    early_stopping_rounds: int | None = None


@dataclass(frozen=True)
class Split:
    """Rows of a leaf whose feature is at most ``threshold`` go left."""

    gain: float
    dim: int
    bin: int
    threshold: float


@dataclass
class Tree:
    """Splits by node and values by leaf; node n has the children 2n and 2n + 1, the root is 1."""

    splits: dict[int, Split] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def node(self, goes_left, at: int = 1) -> Column:
        """The leaf of a row, ``goes_left`` giving the condition of a split."""
        if at not in self.splits:
            return F.lit(at).cast("long")
        return F.when(goes_left(self.splits[at]), self.node(goes_left, 2 * at)).otherwise(self.node(goes_left, 2 * at + 1))

    def value(self, goes_left, at: int = 1) -> Column:
        """The value of a row's leaf."""
        if at not in self.splits:
            return F.lit(self.values[at])
        return F.when(goes_left(self.splits[at]), self.value(goes_left, 2 * at)).otherwise(self.value(goes_left, 2 * at + 1))


@dataclass
class BoostedTrees:
    """A fitted model; ``losses`` has the validation metric after every tree that was tried."""

    first: float
    rate: float
    trees: list[Tree]
    losses: list[float]

    def raw(self, feature: Callable[[int], Column]) -> Column:
        """The score in log odds, from the column of each feature."""
        left = lambda split: feature(split.dim) <= split.threshold
        return reduce(lambda total, tree: total + self.rate * tree.value(left), self.trees, F.lit(self.first))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Rows with ``raw``, ``probability`` and ``prediction``."""
        values = as_array(df, features)
        scored = df.withColumn("raw", self.raw(lambda dim: values[dim]))
        return scored.withColumns({
            "probability": 1 / (1 + F.exp(-F.col("raw"))), "prediction": (F.col("raw") > 0).cast("double")
        })

    def predicted(self, df: DataFrame, features: str = "features") -> Column:
        """The prediction as one expression on the rows of ``df``."""
        values = as_array(df, features)
        return (self.raw(lambda dim: values[dim]) > 0).cast("double")

    def predicted_by_words(self, vocabulary: Sequence[str], words: str = "words") -> Column:
        """The prediction of rows whose features are the words of a vocabulary that they have."""
        return (self.raw(lambda dim: F.array_contains(words, vocabulary[dim]).cast("double")) > 0).cast("double")


def bin_edges(df: DataFrame, features: str, max_bins: int) -> list[np.ndarray]:
    """Upper ends of each feature's bins, from a quantile sketch; values rarer than a bin's share may have none of their own."""
    shares = F.array(*[F.lit((k + 1) / max_bins) for k in range(max_bins)])
    values = df.select(F.posexplode(features).alias("dim", "x"))
    ends = values.groupBy("dim").agg(F.percentile_approx("x", shares, ACCURACY).alias("ends")).collect()
    edges = [np.zeros(0)] * (max((r["dim"] for r in ends), default=-1) + 1)
    for r in ends:
        edges[r["dim"]] = np.unique(np.array(r["ends"], float))
    return edges


def fit_trees(
    train: DataFrame,
    params: TreeParams = TreeParams(),
    *,
    validation: DataFrame | None = None,
    features: str = "features",
    label: str = "label",
    weight: str | None = "weight",
    metric: str = "logloss",
) -> BoostedTrees:
    """Boosted trees for labels 0 and 1.

    With ``validation`` rows, as many trees are kept as give them the best ``metric``
    (``logloss`` or ``auc``), and fitting ends when ``early_stopping_rounds`` trees brought
    nothing better. Vectors have one length; null labels are left out. The driver gets bin
    ends, a split per leaf and a metric per tree.
    """
    if metric not in ("logloss", "auc"):
        raise ValueError("metric must be 'logloss' or 'auc'")
    parts = [(train, True)] + ([(validation, False)] if validation is not None else [])
    rows = reduce(DataFrame.unionByName, [
        df.where(F.col(label).isNotNull()).select(
            as_array(df, features).alias("x"),
            F.col(label).cast("double").alias("y"),
            (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
            F.lit(used).alias("train"),
        )
        for df, used in parts
    ])
    rows = cut_lineage(rows)
    edges = bin_edges(rows.where("train"), "x", params.max_bins)
    sent = rows.sparkSession.sparkContext.broadcast(edges)

    @F.pandas_udf("array<int>")
    def binned(x: pd.Series) -> pd.Series:
        matrix = np.stack(list(x)) if len(x) else np.zeros((0, len(sent.value)))
        out = np.stack([np.searchsorted(ends, matrix[:, k]) for k, ends in enumerate(sent.value)], axis=1)
        return pd.Series(list(out.astype(np.int32)), dtype=object)

    share = rows.where("train").agg(F.sum(F.col("w") * F.col("y")) / F.sum("w")).first()[0]
    if share is None or not 0 < share < 1:
        # One class alone: nothing to split.
        return BoostedTrees(math.inf if share == 1 else -math.inf, params.learning_rate, [], [])
    first = math.log(share / (1 - share))
    rows = cut_lineage(rows.select("y", "w", "train", binned("x").alias("bins"), F.lit(first).alias("score")))
    trees: list[Tree] = []
    losses: list[float] = []
    for _ in range(params.n_estimators):
        tree = _grow(_with_gradients(rows.where("train")), params, edges)
        if not tree.splits:
            break
        trees.append(tree)
        left = lambda split: F.col("bins")[split.dim] <= split.bin
        rows = cut_lineage(rows.withColumn("score", F.col("score") + params.learning_rate * tree.value(left)))
        if validation is not None:
            losses.append(_loss(rows.where("NOT train"), metric))
            best = losses.index(min(losses))
            if params.early_stopping_rounds and len(losses) - 1 - best >= params.early_stopping_rounds:
                break
    kept = losses.index(min(losses)) + 1 if losses else len(trees)
    return BoostedTrees(first, params.learning_rate, trees[:kept], losses)


def _with_gradients(rows: DataFrame) -> DataFrame:
    p = 1 / (1 + F.exp(-F.col("score")))
    return rows.select("bins", (F.col("w") * (p - F.col("y"))).alias("g"), (F.col("w") * p * (1 - p)).alias("h"))


def _loss(rows: DataFrame, metric: str) -> float:
    """The weighted log loss, or what is missing to an AUC of one."""
    if metric == "auc":
        column = rows.select("score", F.col("y"), F.col("w"))
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", weightCol="w", numBins=0)
        return 1 - evaluator.evaluate(column)
    signed = F.when(F.col("y") == 1, -F.col("score")).otherwise(F.col("score"))
    loss = F.greatest(signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))
    return rows.agg(F.sum(F.col("w") * loss) / F.sum("w")).first()[0] or 0.0


def _grow(rows: DataFrame, params: TreeParams, edges: Sequence[np.ndarray]) -> Tree:
    """A tree, best leaf first. Each pass over the rows looks at all leaves whose best split is not known yet."""
    known: dict[int, Split | None] = {}
    left = lambda split: F.col("bins")[split.dim] <= split.bin
    while True:
        tree, unknown = _best_first(known, params)
        if not unknown:
            break
        leaf = tree.node(left)
        found = best_splits(rows.withColumn("leaf", leaf).where(F.col("leaf").isin(unknown)), params)
        known |= dict.fromkeys(unknown)
        for r in found.collect():
            known[r["leaf"]] = Split(r["gain"], r["dim"], r["bin"], float(edges[r["dim"]][r["bin"]]))
    sums = rows.groupBy(tree.node(left).alias("leaf")).agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    tree.values = {r["leaf"]: r["value"] for r in sums.select("leaf", _value(params).alias("value")).collect()}
    return tree


def _best_first(known: Mapping[int, Split | None], params: TreeParams) -> tuple[Tree, list[int]]:
    """The tree of the known splits within the leaf budget, and its leaves without a known one.

    A leaf that is not known yet may still be better than those split here, so the tree is
    final only if there is none.
    """
    tree, leaves = Tree(), [1]
    while len(leaves) < params.num_leaves:
        able = [leaf for leaf in leaves if known.get(leaf)]
        if not able:
            break
        best = min(able, key=lambda leaf: (-known[leaf].gain, leaf))
        tree.splits[best] = known[best]
        leaves = [leaf for leaf in leaves if leaf != best] + [2 * best, 2 * best + 1]
    deepest = params.max_depth if params.max_depth > 0 else 62
    unknown = [leaf for leaf in leaves if leaf not in known and leaf.bit_length() - 1 < deepest]
    return tree, unknown if params.num_leaves > 1 else []


def _shrunk(g: Column, params: TreeParams) -> Column:
    return F.greatest(F.abs(g) - params.lambda_l1, F.lit(0.0))


def _value(params: TreeParams) -> Column:
    over = F.col("h") + params.lambda_l2
    return F.coalesce(F.when(over > 0, -F.signum("g") * _shrunk(F.col("g"), params) / over), F.lit(0.0))


def histograms(rows: DataFrame) -> DataFrame:
    """``(leaf, dim, bin, g, h, n)``: sums of gradients and hessians and the number of rows."""
    entries = rows.select("leaf", "g", "h", F.posexplode("bins").alias("dim", "bin"))
    return entries.groupBy("leaf", "dim", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n"))


def best_splits(rows: DataFrame, params: TreeParams) -> DataFrame:
    """``(leaf, gain, dim, bin)``: the best split of each leaf that has one; ``bin`` is the last one on the left."""
    upto = Window.partitionBy("leaf", "dim").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy("leaf", "dim")
    sums = histograms(rows).select(
        "leaf", "dim", "bin",
        *[F.sum(c).over(upto).alias(f"{c}_left") for c in "ghn"],
        *[F.sum(c).over(every).alias(c) for c in "ghn"],
    )

    def score(g: Column, h: Column) -> Column:
        return F.coalesce(F.when(h + params.lambda_l2 > 0, _shrunk(g, params) ** 2 / (h + params.lambda_l2)), F.lit(0.0))

    right = {c: F.col(c) - F.col(f"{c}_left") for c in "ghn"}
    gain = score(F.col("g_left"), F.col("h_left")) + score(right["g"], right["h"]) - score(F.col("g"), F.col("h"))
    usable = (F.least(F.col("n_left"), right["n"]) >= max(1, params.min_data_in_leaf)) & (F.col("gain") > params.min_gain_to_split)
    rated = sums.withColumn("gain", F.round(gain, _DIGITS)).where(usable)
    best = F.max(F.struct("gain", (-F.col("dim")).alias("dim"), (-F.col("bin")).alias("bin"))).alias("best")
    return rated.groupBy("leaf").agg(best).select(
        "leaf", "best.gain", (-F.col("best.dim")).alias("dim"), (-F.col("best.bin")).alias("bin")
    )


def search_trees(
    train: DataFrame,
    grid: Mapping[str, Sequence[float]],
    *,
    base: TreeParams = TreeParams(),
    group: str = "group",
    label: str = "label",
    weight: str | None = "weight",
    features: str = "features",
    k: int = 3,
) -> tuple[TreeParams, list[tuple[TreeParams, float]]]:
    """The grid point with the best mean weighted F1 over group folds, and the mean of each.

    Each fold's rows decide how many trees are kept. Of equal means the first grid point wins.
    """
    folds = cut_lineage(balanced_group_folds(train, group, label, k))
    scores = []
    for values in product(*grid.values()):
        params, found = replace(base, **dict(zip(grid, values))), []
        for n in range(k):
            test = folds.where(F.col("fold") == n)
            model = fit_trees(
                folds.where(F.col("fold") != n), params, validation=test, features=features, label=label, weight=weight, metric="auc"
            )
            found.append(weighted_f1(label, weight).evaluate(model.transform(test, features).drop("probability")))
        scores.append((params, float(np.mean(found))))
    return max(scores, key=lambda s: s[1])[0], scores
