"""Histogram boosting against a plain implementation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.histograms import TreeParams, best_splits, bin_edges, fit_trees, search_trees
from tidemark.operators.learning import score_classes


def sample(n, seed, noise=0.2):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.choice([0.0, 1.0]), rnd.choice([-2.5, 0.0, 1.0, 7.0]), float(rnd.randrange(9)), 3.0]
        y = int((x[1] > 0 and x[2] > 4) != (rnd.random() < noise))
        rows.append((i, x, y, 1.0 + i % 3, f"g{i // 4}"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "n int, features array<double>, label int, weight double, group string")


def sigmoid(s):
    return 1 / (1 + math.exp(-s))


def plain_trees(rows, p, count):
    """Scores after so many trees, grown best leaf first by trying every split."""
    wy, w = sum(r[2] * r[3] for r in rows), sum(r[3] for r in rows)
    score = {r[0]: math.log(wy / w / (1 - wy / w)) for r in rows}
    shrunk = lambda g: max(abs(g) - p.lambda_l1, 0)
    quality = lambda g, h: shrunk(g) ** 2 / (h + p.lambda_l2)
    for _ in range(count):
        grad = {r[0]: r[3] * (sigmoid(score[r[0]]) - r[2]) for r in rows}
        hess = {r[0]: r[3] * sigmoid(score[r[0]]) * (1 - sigmoid(score[r[0]])) for r in rows}
        sums = lambda some: (sum(grad[r[0]] for r in some), sum(hess[r[0]] for r in some))

        def best(some):
            found = []
            for dim in range(len(rows[0][1])):
                for threshold in sorted({r[1][dim] for r in rows}):
                    left = [r for r in some if r[1][dim] <= threshold]
                    right = [r for r in some if r[1][dim] > threshold]
                    if min(len(left), len(right)) >= p.min_data_in_leaf:
                        gain = round(quality(*sums(left)) + quality(*sums(right)) - quality(*sums(some)), 9)
                        if gain > p.min_gain_to_split:
                            found.append((gain, -dim, -threshold, left, right))
            return max(found, key=lambda f: f[:3], default=None)

        leaves = [(1, rows)]
        while len(leaves) < p.num_leaves:
            splits = [(best(some), node, some) for node, some in leaves if p.max_depth < 0 or node.bit_length() - 1 < p.max_depth]
            splits = [s for s in splits if s[0]]
            if not splits:
                break
            (_, _, _, left, right), node, _ = max(splits, key=lambda s: (s[0][0], -s[1]))
            leaves = [leaf for leaf in leaves if leaf[0] != node] + [(2 * node, left), (2 * node + 1, right)]
        for _, some in leaves:
            g, h = sums(some)
            for r in some:
                score[r[0]] += p.learning_rate * -math.copysign(shrunk(g), g) / (h + p.lambda_l2)
    return score


@pytest.mark.parametrize(
    "params",
    [
        TreeParams(n_estimators=3, learning_rate=0.5, num_leaves=5, min_data_in_leaf=3, lambda_l1=0.5, lambda_l2=2.0),
        TreeParams(n_estimators=2, num_leaves=9, max_depth=2, min_data_in_leaf=8, min_gain_to_split=0.7),
        TreeParams(n_estimators=2, num_leaves=2, min_data_in_leaf=1, lambda_l2=0.1),
    ],
)
def test_trees_equal_plain_ones(spark, params):
    rows = sample(120, 5)
    df = frame(spark, rows)
    model = fit_trees(df, params)
    assert len(model.trees) == params.n_estimators and all(len(t.values) <= params.num_leaves for t in model.trees)
    got = {r["n"]: r for r in model.transform(df).collect()}
    want = plain_trees(rows, params, params.n_estimators)
    assert {n: r["raw"] for n, r in got.items()} == pytest.approx(want)
    assert all(r["probability"] == pytest.approx(sigmoid(r["raw"])) and r["prediction"] == (r["raw"] > 0) for r in got.values())


@pytest.mark.parametrize("metric", ["logloss", "auc"])
def test_validation_decides_the_number_of_trees(spark, metric):
    """Labels that are half noise: more trees soon make the validation rows worse."""
    train, test = frame(spark, sample(80, 1, 0.45)), frame(spark, sample(80, 2, 0.45))
    params = TreeParams(n_estimators=12, learning_rate=0.9, min_data_in_leaf=1, early_stopping_rounds=2)
    model = fit_trees(train, params, validation=test, metric=metric)
    best = model.losses.index(min(model.losses))
    assert len(model.trees) == best + 1 and len(model.losses) == min(best + 3, 12) < 12
    scored = {r["n"]: r for r in model.transform(test).collect()}
    if metric == "logloss":
        loss = sum(r["weight"] * -math.log(r["probability"] if r["label"] else 1 - r["probability"]) for r in scored.values())
        assert model.losses[best] == pytest.approx(loss / sum(r["weight"] for r in scored.values()))


def test_few_bins_and_odd_rows(spark):
    rows = sample(100, 3)
    df = frame(spark, rows)
    edges = bin_edges(df, "features", 255)
    assert [list(e) for e in edges] == [[0, 1], [-2.5, 0, 1, 7], list(range(9)), [3]]
    few = bin_edges(df, "features", 4)
    assert all(len(e) <= 4 and e[-1] == full[-1] and set(e) <= set(full) for e, full in zip(few, edges))
    params = TreeParams(n_estimators=1, num_leaves=4, min_data_in_leaf=1)
    same = df.withColumn("label", F.lit(1))
    assert fit_trees(same, params).transform(df).where("prediction = 1").count() == 100
    assert fit_trees(df.limit(0), params).transform(df).where("prediction = 0").count() == 100
    extra = df.unionByName(df.withColumn("label", F.lit(None).cast("int")))
    one, two = (fit_trees(d, params, weight=None).transform(df).select("n", "raw").collect() for d in (df, extra))
    assert sorted(one) == sorted(two)
    with pytest.raises(ValueError, match="metric"):
        fit_trees(df, params, metric="f1")


def test_sums_are_combined_before_the_shuffle(spark, plan):
    rows = spark.range(100).select(F.lit(1).alias("leaf"), F.array(F.col("id") % 3).alias("bins"), F.lit(0.5).alias("g"), F.lit(0.2).alias("h"))
    text = plan(best_splits(rows, TreeParams()))
    assert "partial_sum" in text and "CartesianProduct" not in text


def test_search_keeps_the_first_best(spark):
    grid = {"num_leaves": [2, 6], "lambda_l1": [0.0, 1e9]}
    base = TreeParams(n_estimators=2, min_data_in_leaf=2, learning_rate=0.5, early_stopping_rounds=1)
    best, scores = search_trees(frame(spark, sample(120, 6, 0.1)), grid, base=base, k=2)
    assert [(p.num_leaves, p.lambda_l1) for p, _ in scores] == [(2, 0.0), (2, 1e9), (6, 0.0), (6, 1e9)]
    assert best.lambda_l1 == 0 and dict((p, s) for p, s in scores)[best] == max(s for _, s in scores)


class WithoutExpression:
    """A model that only transforms, as those of Spark ML."""

    def __init__(self, model):
        self.model = model

    def transform(self, df):
        return self.model.transform(df)


def test_all_classes_in_one_pass(spark, rows, plan, tmp_path):
    data = frame(spark, sample(150, 8)).withColumn("class", F.concat(F.lit("c"), F.col("n") % 4))
    params = TreeParams(n_estimators=2, num_leaves=4, min_data_in_leaf=2)
    models = {f"c{k}": fit_trees(data.where(F.col("n") % 4 == k), params) for k in range(3)}
    data.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    one = score_classes(stored, models, "class")
    many = score_classes(stored, {name: WithoutExpression(model) for name, model in models.items()}, "class")
    assert rows(one) == rows(many.select(one.columns)) and one.count() < 150
    assert plan(one).count("FileScan") == 1 and plan(many).count("FileScan") == 3


def test_words_are_features(spark, rows):
    """Trees on words flag the devices that they flag on the words' vector."""
    vocabulary = ("client_web", "client_mail", "server_web")
    data = [(n, [float(n & 1), float(n >> 1 & 1), float(n >> 2 & 1)], int(n % 8 in (1, 5, 7)), 1.0, "g") for n in range(64)]
    model = fit_trees(frame(spark, data), TreeParams(n_estimators=2, num_leaves=5, min_data_in_leaf=1, learning_rate=1.0))
    words = spark.createDataFrame([(n, [w for k, w in enumerate(vocabulary) if n >> k & 1]) for n in range(8)], "n int, words array<string>")
    flagged = words.where(model.predicted_by_words(vocabulary) == 1)
    assert rows(flagged.select("n")) == [(1,), (5,), (7,)]
