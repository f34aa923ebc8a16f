import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators.learning import (
    balanced_group_folds,
    boosting,
    deal_rests,
    fit_boosting,
    positives,
    score_classes,
    search_boosting,
    stratified_group_folds,
    weighted_f1,
)


def training(spark, n=240):
    rnd = random.Random(0)
    rows = []
    for i in range(n):
        label = int(rnd.random() < 0.3)
        rows.append((Vectors.dense(label + rnd.gauss(0, 0.2), rnd.random()), label, f"g{i // 4}", 1.0 + i % 2))
    return spark.createDataFrame(rows, ["features", "label", "group", "weight"])


def test_groups_never_span_folds_and_shares_stay_close(spark):
    rnd = random.Random(1)
    rows = [(f"g{g}", int(g % 4 == 0)) for g in range(600) for _ in range(rnd.randint(1, 6))]
    rows += [("huge", 0)] * 50 + [(None, 1)] * 3
    df = spark.createDataFrame(rows, "group string, label int")
    folds = stratified_group_folds(df, "group", "label", 3)
    assert folds.count() == len(rows)
    assert folds.groupBy("group").agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0] == 1
    per = folds.groupBy("fold").agg(F.count("*").alias("n"), F.avg("label").alias("share")).collect()
    assert {r["fold"] for r in per} == {0, 1, 2}
    share = sum(label for _, label in rows) / len(rows)
    assert all(abs(r["share"] - share) < 0.06 for r in per)
    assert max(r["n"] for r in per) < 1.25 * min(r["n"] for r in per)
    again = stratified_group_folds(df.repartition(7), "group", "label", 3)
    key = lambda d: {(r["group"], r["fold"]) for r in d.collect()}
    assert key(again) == key(folds)


def test_boosting_with_given_parameters(spark):
    df = training(spark)
    model = fit_boosting(df, model_params={"n_estimators": 3, "max_depth": 2, "learning_rate": 0.5})
    assert model.getNumTrees == 3
    scored = model.transform(df)
    assert weighted_f1().evaluate(scored) > 0.8
    with pytest.raises(ValueError, match="num_leaves"):
        boosting(num_leaves=3)


def test_weighted_f1_of_the_positive_class(spark):
    rows = [(1.0, 1.0, 2.0), (1.0, 0.0, 1.0), (0.0, 1.0, 3.0), (0.0, 0.0, 5.0)]
    df = spark.createDataFrame(rows, "label double, prediction double, weight double")
    precision, recall = 2 / 5, 2 / 3
    assert weighted_f1().evaluate(df) == pytest.approx(2 * precision * recall / (precision + recall))


def test_search_picks_the_best_grid_point(spark):
    best, search = search_boosting(
        training(spark), {"n_estimators": [1, 3], "learning_rate": [0.001, 0.5]}, k=2
    )
    assert len(search.avgMetrics) == 4
    assert set(best) == {"n_estimators", "learning_rate"}
    assert max(search.avgMetrics) > 0.8


def test_scoring_uses_the_model_of_each_class(spark, rows):
    df = training(spark)
    up = boosting(n_estimators=1).fit(df)
    down = boosting(n_estimators=1).fit(df.withColumn("label", 1 - F.col("label")))
    data = spark.createDataFrame(
        [(1, "a", Vectors.dense(1.0, 0.5)), (2, "a", Vectors.dense(0.0, 0.5)), (3, "b", Vectors.dense(1.0, 0.5)),
         (4, "b", Vectors.dense(0.0, 0.5)), (5, "c", Vectors.dense(1.0, 0.5))],
        ["n", "label", "features"],
    )
    scored = score_classes(data, {"a": up, "b": down})
    assert rows(positives(scored, ["n", "label"])) == [(1, "a"), (4, "b")]
    with pytest.raises(ValueError, match="classes"):
        score_classes(data, {})


def test_few_equal_groups_fill_every_fold(spark):
    rows = [(f"g{g}", int(g < 4)) for g in range(12) for _ in range(5)]
    folds = stratified_group_folds(spark.createDataFrame(rows, "group string, label int"), "group", "label", 3)
    per = {r["fold"]: (r["n"], r["ones"]) for r in folds.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    assert {n for n, _ in per.values()} == {20} and set(per) == {0, 1, 2}
    assert sorted(ones for _, ones in per.values()) == [5, 5, 10]


def test_no_task_numbers_all_groups(spark, plan):
    rows = [(f"g{g}", 0) for g in range(4000)]
    folds = stratified_group_folds(spark.createDataFrame(rows, "group string, label int"), "group", "label", 4)
    windows = [line for line in plan(folds).splitlines() if "row_number" in line and "Window" in line]
    assert windows and all("digits" in line for line in windows)
    assert {r["n"] for r in folds.groupBy("fold").agg(F.count("*").alias("n")).collect()} == {1000}


def mixed_groups(seed):
    """Groups of several labels, many of them alike."""
    rnd = random.Random(seed)
    kinds = [[rnd.choice("aabc") for _ in range(rnd.randint(1, 7))] for _ in range(25)]
    rows = [(f"g{n}", label) for n in range(300) for label in (rnd.choice(kinds) if n % 3 else rnd.choices("abc", k=rnd.randint(1, 9)))]
    return rows + [("huge", "a")] * 40 + [(None, "b"), (None, None)]


def spread(rows, fold_of, k):
    totals, held = Counter(label for _, label in rows), defaultdict(Counter)
    for g, label in rows:
        held[label][fold_of[g]] += 1
    return np.mean([np.std([held[name][f] / n for f in range(k)]) for name, n in totals.items()])


@pytest.mark.parametrize("seed", range(3))
def test_balanced_folds_equal_a_greedy_loop(spark, seed):
    rows, k = mixed_groups(seed), 3
    df = spark.createDataFrame(rows, "group string, label string")
    got = {r["group"]: r["fold"] for r in balanced_group_folds(df, "group", "label", k).select("group", "fold").distinct().collect()}
    labels = sorted({name for _, name in rows}, key=lambda x: (x is not None, x))
    counts = defaultdict(lambda: [0] * len(labels))
    for g, label in rows:
        counts[g][labels.index(label)] += 1
    alike = defaultdict(list)
    for g, c in counts.items():
        alike[tuple(c)].append(g)
    order = sorted(alike, key=lambda c: (len(c) * sum(x * x for x in c) - sum(c) ** 2, c), reverse=True)
    held, totals, want = np.zeros((k, len(labels))), np.zeros(len(labels)), {}
    for c in order:
        totals += np.array(c) * (len(alike[c]) % k)
    totals = np.maximum(totals, 1)
    for c in order:
        names = sorted(alike[c], key=lambda g: (hashlib.md5((g or "").encode()).hexdigest(), g or ""))
        even, used = len(names) // k * k, set()
        want |= {g: n % k for n, g in enumerate(names[:even])}
        for g in names[even:]:
            rated = []
            for f in set(range(k)) - used:
                after = held.copy()
                after[f] += c
                rated.append((round(float((after / totals).std(axis=0).mean()), 12), held[f].sum(), f))
            want[g] = min(rated)[2]
            used.add(want[g])
            held[want[g]] += c
    assert got == want
    dealt = {r["group"]: r["fold"] for r in stratified_group_folds(df, "group", "label", k).select("group", "fold").distinct().collect()}
    assert spread(rows, got, k) <= spread(rows, dealt, k)


def test_balanced_folds_deal_equal_groups_evenly(spark, plan):
    df = spark.createDataFrame([(f"g{g}", n % 2) for g in range(1000) for n in range(3)], "group string, label int")
    folds = balanced_group_folds(df, "group", "label", 4)
    assert {r["n"] for r in folds.groupBy("fold").agg(F.countDistinct("group").alias("n")).collect()} == {250}
    assert all("digits" in line for line in plan(folds).splitlines() if "row_number" in line and "Window" in line)
    few = balanced_group_folds(df, "group", "label", 3, most=0).groupBy("fold").agg(F.countDistinct("group").alias("n")).collect()
    assert sorted(r["n"] for r in few) == [333, 333, 334]
    assert balanced_group_folds(df.limit(0), "group", "label", 3).count() == 0


def test_rests_go_to_different_folds():
    assert deal_rests([([5, 0], 2), ([0, 5], 1), ([1, 1], 0)], 3) == [[0, 1], [2], []]
