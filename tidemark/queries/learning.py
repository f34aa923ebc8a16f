"""Group folds, boosting and per-class scoring."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators.features import device_words, words_to_vector
from tidemark.operators.histograms import TreeParams, fit_trees
from tidemark.operators.learning import (
    balanced_group_folds,
    boosting,
    fit_boosting,
    search_boosting,
    stratified_group_folds,
    weighted_f1,
)
from tidemark.plans.detection import ClassModel, score_usage
from tidemark.queries import inputs
from tidemark.queries.inputs import table
from tidemark.queries.usage import _WITH_WORDS, _WORDS, _windowed
from tidemark.session import cut_lineage, literal_table


def _training(spark, sf_dir):
    """Signs of embeddings of two halves of the labels, weighted, in groups of neighbouring ids."""
    signs = F.transform("embedding", lambda x: (x > 0).cast("double"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        array_to_vector(signs).alias("features"),
        (F.col("label") >= 5).cast("int").alias("label"),
        F.concat(F.lit("g"), F.floor(F.col("vec_id") / 5).cast("string")).alias("group"),
        (1.0 + F.col("label") / 10).alias("weight"),
    )


def group_folds(spark, sf_dir):
    """Rows and fold of each group."""
    folds = stratified_group_folds(_training(spark, sf_dir), "group", "label", 3)
    return folds.groupBy("group", "fold").agg(F.count(F.lit(1)).alias("rows"))


def balanced_folds(spark, sf_dir):
    """Fold of each group by all its labels."""
    rows = _training(spark, sf_dir).withColumn("label", F.when(F.col("label") == 1, F.floor(F.col("weight") * 10)).otherwise(F.col("label")))
    folds = balanced_group_folds(rows, "group", "label", 3)
    return folds.groupBy("group", "fold").agg(F.count(F.lit(1)).alias("rows"))


def fold_shares(spark, sf_dir):
    folds = stratified_group_folds(_training(spark, sf_dir), "group", "label", 3)
    return folds.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").cast("long").alias("positive")
    )


# One tree of depth one on 0/1 features: the split that SQL finds too.
_STUMP = {"n_estimators": 1, "max_depth": 1}
_GAINS = (0.0, 0.01, 0.9)


def boosted(spark, sf_dir):
    rows = cut_lineage(_training(spark, sf_dir))
    model = fit_boosting(rows, model_params=_STUMP)
    return model.transform(rows).select("vec_id", "label", "weight", "prediction")


def boosting_f1(spark, sf_dir):
    """Weighted F1 of the fitted model, by Spark's evaluator."""
    f1 = weighted_f1().evaluate(boosted(spark, sf_dir))
    return literal_table(spark, [(round(f1, 9),)], "f1 double")


def boosting_search(spark, sf_dir):
    """Mean F1 over group folds of each least gain of a split, and the best of them."""
    grid = {**{name: [value] for name, value in _STUMP.items()}, "min_gain_to_split": list(_GAINS)}
    best, search = search_boosting(_training(spark, sf_dir), grid, k=2)
    scores = [(gain, round(float(m), 9)) for gain, m in zip(_GAINS, search.avgMetrics)]
    return literal_table(spark, scores, "min_gain double, f1 double").withColumn(
        "best", F.col("min_gain") == F.lit(best["min_gain_to_split"])
    )


_TREES = TreeParams(
    n_estimators=5, learning_rate=0.5, num_leaves=4, max_depth=2, min_data_in_leaf=5, lambda_l1=0.1, lambda_l2=1.0,
    early_stopping_rounds=2,
)


def _boosted_trees(spark, sf_dir):
    """Trees of four leaves; a fold of the groups decides how many of them are kept."""
    rows = cut_lineage(stratified_group_folds(_training(spark, sf_dir), "group", "label", 3))
    return rows, fit_trees(rows.where("fold > 0"), _TREES, validation=rows.where("fold = 0"))


def boosting_trees(spark, sf_dir):
    """Scores of all rows by the trees that are kept."""
    rows, model = _boosted_trees(spark, sf_dir)
    return model.transform(rows).select("vec_id", "fold", F.round("raw", 6).alias("score"), "prediction")


def boosting_rounds(spark, sf_dir):
    """The log loss of the validation rows after each tree that was tried, and whether the tree is kept."""
    _, model = _boosted_trees(spark, sf_dir)
    rounds = [(n, round(loss, 6), n <= len(model.trees)) for n, loss in enumerate(model.losses, 1)]
    return literal_table(spark, rounds, "tree int, loss double, kept boolean")


_SPLIT = TreeParams(n_estimators=1, learning_rate=1.0, num_leaves=2, min_data_in_leaf=1, lambda_l2=1.0)


def _class_models(spark, sf_dir, trees=None):
    """A model of one split per class: does a device send more than it receives?"""
    windowed = _windowed(spark, sf_dir)
    vocabulary = literal_table(
        spark, [(label, w) for label in inputs.ACTIVE_CLASSES for w in _WORDS], "label string, word string"
    )
    words = device_words(windowed, vocabulary)
    heavy = F.aggregate(
        "apps", F.lit(0).cast("long"), lambda acc, a: acc + a["totalClientBytes"] - a["totalServerBytes"]
    )
    words = cut_lineage(words)
    rows = words_to_vector(words, _WORDS).select("label", "features", (heavy > 0).cast("int").alias("target"))
    # A class without devices has nothing to learn from, and nothing to score.
    present = sorted(r["label"] for r in words.select("label").distinct().collect())
    clf = boosting(label="target", weight=None, **_STUMP)
    fit = (lambda df: fit_trees(df, trees, label="target", weight=None)) if trees else clf.fit
    models = {label: ClassModel(_WORDS, fit(rows.where(F.col("label") == label))) for label in present}
    return windowed, models


def scoring(spark, sf_dir):
    """Devices that the model of their class flags."""
    detections, _ = score_usage(*_class_models(spark, sf_dir))
    return detections.select("mac", "label", "uuid", F.size("apps").cast("long").alias("num_apps"))


def scoring_trees(spark, sf_dir):
    """Devices that the trees of their class flag: all classes in one pass, without features."""
    detections, _ = score_usage(*_class_models(spark, sf_dir, _SPLIT))
    return detections.select("mac", "label", "uuid", F.size("apps").cast("long").alias("num_apps"))


def scoring_metrics(spark, sf_dir):
    _, metrics = score_usage(*_class_models(spark, sf_dir))
    return _plain_metrics(metrics)


def _plain_metrics(metrics):
    return metrics.select(
        "label", F.col("numDevices").alias("devices"), F.col("numOutOfVocab").alias("out_of_vocab"),
        F.col("numDetections").alias("detections"),
    )


def _rule_models():
    """Models of every class that flag devices with at least three known words."""
    rule = SQLTransformer(
        statement="SELECT *, CAST(size(words) >= 3 AS DOUBLE) AS prediction FROM __THIS__"
    )
    return {label: ClassModel(_WORDS, rule) for label in inputs.ACTIVE_CLASSES}


def scoring_rule(spark, sf_dir):
    """Detections of a rule in place of a trained model."""
    detections, _ = score_usage(_windowed(spark, sf_dir), _rule_models())
    return detections.select(
        "mac", "label", "uuid", F.unix_millis("windowStart").alias("start_ms"),
        F.unix_millis("windowEnd").alias("end_ms"), F.size("apps").cast("long").alias("num_apps"),
    )


def scoring_rule_metrics(spark, sf_dir):
    _, metrics = score_usage(_windowed(spark, sf_dir), _rule_models())
    return _plain_metrics(metrics)


QUERIES = {
    "group_folds": group_folds,
    "fold_shares": fold_shares,
    "balanced_folds": balanced_folds,
    "boosting": boosted,
    "boosting_f1": boosting_f1,
    "boosting_search": boosting_search,
    "boosting_trees": boosting_trees,
    "boosting_rounds": boosting_rounds,
    "scoring": scoring,
    "scoring_trees": scoring_trees,
    "scoring_metrics": scoring_metrics,
    "scoring_rule": scoring_rule,
    "scoring_rule_metrics": scoring_rule_metrics,
}

_DEVICES_SQL = f"""{_WITH_WORDS},
devices AS (
  SELECT w.mac, w.label, w.uuid, w.windowStart, w.windowEnd, count(DISTINCT w.appName) AS num_apps,
    any_value(d.num_words) AS num_words, any_value(d.oov) AS oov
  FROM windowed w JOIN (
    SELECT mac, label, uuid, count(*) AS num_words, bool_or(contains(word, 'out-of-vocab')) AS oov
    FROM words GROUP BY ALL) d ON w.mac = d.mac AND w.label = d.label AND w.uuid = d.uuid
  GROUP BY ALL
)"""

_FOLDS_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x > 0 AS INTEGER)) AS features,
    CAST(label >= 5 AS INTEGER) AS label, 'g' || (vec_id // 5) AS "group", 1.0::DOUBLE + label / 10.0::DOUBLE AS weight FROM embeddings
), groups AS (
  SELECT "group", max({{'n': n, 'label': label}}).label AS stratum, sum(n) AS size
  FROM (SELECT "group", label, count(*) AS n FROM rows GROUP BY ALL) GROUP BY ALL
), folds AS (
  SELECT "group", CAST((row_number() OVER (ORDER BY stratum, size DESC, md5("group"), "group") - 1) % {k} AS INTEGER) AS fold FROM groups
), folded AS (SELECT r.*, f.fold FROM rows r JOIN folds f USING ("group"))"""

# Per case c: the split with the greatest drop in variance of the labels as 1 and -1, if it
# drops by the least gain and at all; a side, or all rows without a split, gets the sign of its mean.
_STUMP_SQL = """entries AS (
  SELECT c, least, unnest(range(0, len(features))) AS dim, unnest(features) AS x, 2 * label - 1 AS y, weight AS w FROM cases WHERE train
), sums AS (
  SELECT c, dim, any_value(least) AS least, sum(w) AS w, sum(w * y) AS s, sum(w) FILTER (WHERE x = 0) AS w0,
    sum(w * y) FILTER (WHERE x = 0) AS s0, sum(w) FILTER (WHERE x = 1) AS w1, sum(w * y) FILTER (WHERE x = 1) AS s1
  FROM entries GROUP BY c, dim
), gains AS (
  SELECT *, CASE WHEN w0 IS NULL OR w1 IS NULL THEN 0
    ELSE (1 - (s / w) ** 2) - w0 / w * (1 - (s0 / w0) ** 2) - w1 / w * (1 - (s1 / w1) ** 2) END AS gain FROM sums
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY gain DESC, dim) AS rn FROM gains) WHERE rn = 1
), predicted AS (
  SELECT k.*, CAST(CASE WHEN b.gain <= 1e-12 OR b.gain < b.least THEN b.s > 0
    WHEN k.features[b.dim + 1] = 0 THEN b.s0 > 0 ELSE b.s1 > 0 END AS DOUBLE) AS prediction
  FROM cases k JOIN best b USING (c)
)"""

_F1_SQL = """CASE WHEN coalesce(sum(weight) FILTER (WHERE prediction = 1 AND label = 1), 0) = 0 THEN 0
  ELSE 2 * sum(weight) FILTER (WHERE prediction = 1 AND label = 1)
    / (sum(weight) FILTER (WHERE prediction = 1) + sum(weight) FILTER (WHERE label = 1)) END"""

def _tree_sql(n: int) -> str:
    """One more tree of depth two on 0/1 features: histograms, gains and leaf values of its training rows."""
    def level(k: int, before: str, after: str) -> str:
        return f"""{after}_h AS MATERIALIZED (
  SELECT node, dim, x, sum(g) AS g, sum(h) AS h, count(*) AS n
  FROM (SELECT node, g, h, unnest(range(0, len(features))) AS dim, unnest(features) AS x FROM {before} WHERE fold > 0) GROUP BY ALL
), {after}_s AS (
  SELECT node, dim, sum(g) AS g, sum(h) AS h, sum(n) AS n, coalesce(sum(g) FILTER (WHERE x = 0), 0) AS g0,
    coalesce(sum(h) FILTER (WHERE x = 0), 0) AS h0, coalesce(sum(n) FILTER (WHERE x = 0), 0) AS n0 FROM {after}_h GROUP BY ALL
), {after}_b AS (
  SELECT node, arg_min(dim, (-gain, dim)) AS dim FROM (
    SELECT *, round(greatest(abs(g0) - {_TREES.lambda_l1}, 0) ** 2 / (h0 + {_TREES.lambda_l2})
      + greatest(abs(g - g0) - {_TREES.lambda_l1}, 0) ** 2 / (h - h0 + {_TREES.lambda_l2})
      - greatest(abs(g) - {_TREES.lambda_l1}, 0) ** 2 / (h + {_TREES.lambda_l2}), 9) AS gain FROM {after}_s)
  WHERE gain > 0 AND least(n0, n - n0) >= {_TREES.min_data_in_leaf} GROUP BY node
), {after} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node), CASE WHEN b.dim IS NULL THEN r.node ELSE 2 * r.node + r.features[b.dim + 1] END AS node
  FROM {before} r LEFT JOIN {after}_b b ON b.node = r.node
)"""

    return f"""g{n} AS MATERIALIZED (
  SELECT vec_id, features, label, weight, fold, score, 1 AS node, weight * (1 / (1 + exp(-score)) - label) AS g,
    weight * (1 / (1 + exp(-score))) * (1 - 1 / (1 + exp(-score))) AS h FROM r{n - 1}
), {level(0, f"g{n}", f"a{n}")}, {level(1, f"a{n}", f"b{n}")}, v{n} AS (
  SELECT node, -sign(sum(g)) * greatest(abs(sum(g)) - {_TREES.lambda_l1}, 0) / (sum(h) + {_TREES.lambda_l2}) AS value
  FROM b{n} WHERE fold > 0 GROUP BY node
), r{n} AS MATERIALIZED (
  SELECT b.vec_id, b.features, b.label, b.weight, b.fold, b.score + {_TREES.learning_rate} * v.value AS score
  FROM b{n} b JOIN v{n} v ON v.node = b.node
)"""


_LOSS = "greatest(CASE WHEN label = 1 THEN -score ELSE score END, 0) + ln(1 + exp(-abs(score)))"
_TRIED = range(1, _TREES.n_estimators + 1)
_TREES_SQL = f"""{_FOLDS_SQL.format(k=3)}, r0 AS MATERIALIZED (
  SELECT *, (SELECT ln(p / (1 - p)) FROM (SELECT sum(weight * label) / sum(weight) AS p FROM folded WHERE fold > 0)) AS score FROM folded
), {", ".join(map(_tree_sql, _TRIED))}, losses AS MATERIALIZED (
  {" UNION ALL ".join(f"SELECT {n} AS tree, sum(weight * ({_LOSS})) / sum(weight) AS loss FROM r{n} WHERE fold = 0" for n in _TRIED)}
), so_far AS (
  SELECT tree, loss, arg_min(tree, (loss, tree)) OVER (ORDER BY tree) AS best FROM losses
), tried AS (
  SELECT * FROM so_far WHERE tree <= coalesce((SELECT min(tree) FROM so_far WHERE tree - best >= {_TREES.early_stopping_rounds}), {_TREES.n_estimators})
), kept AS (SELECT arg_min(tree, (loss, tree)) AS tree FROM tried)"""

_FLAGS = ", ".join(f"max(CAST(w.word = '{word}' AS INTEGER))" for word in _WORDS)
_CASES_SQL = f"""{_WITH_WORDS},
traffic AS (
  SELECT mac, label, uuid, CAST(sum(clientBytes) > sum(serverBytes) AS INTEGER) AS heavy, count(*) AS num_apps FROM windowed GROUP BY ALL
), cases AS (
  SELECT t.mac, t.uuid, t.num_apps, t.label AS c, 0.0 AS least, t.heavy AS label, 1.0::DOUBLE AS weight, true AS train,
    [{_FLAGS}] AS features, bool_or(contains(w.word, 'out-of-vocab')) AS oov
  FROM traffic t JOIN words w USING (mac, label, uuid) GROUP BY t.mac, t.uuid, t.num_apps, t.label, t.heavy
) """
_SCORED_SQL = f"""{_CASES_SQL}, {_STUMP_SQL}, scored AS (SELECT mac, c AS label, uuid, num_apps, oov, prediction FROM predicted)"""

SQL = {
    "scoring_rule": f"""{_DEVICES_SQL}
SELECT mac, label, uuid, (epoch_us(windowStart) // 1000) AS start_ms, (epoch_us(windowEnd) // 1000) AS end_ms,
  num_apps FROM devices WHERE num_words >= 3""",
    "scoring_rule_metrics": f"""{_DEVICES_SQL}
SELECT label, count(*) AS devices, count(*) FILTER (WHERE oov) AS out_of_vocab,
  CASE WHEN count(*) FILTER (WHERE num_words >= 3) > 0 THEN count(*) FILTER (WHERE num_words >= 3) END AS detections
FROM devices GROUP BY label""",
    "group_folds": f"""{_FOLDS_SQL.format(k=3)}
SELECT "group", fold, count(*) AS "rows" FROM folded GROUP BY ALL""",
    "fold_shares": f"""{_FOLDS_SQL.format(k=3)}
SELECT fold, count(*) AS "rows", CAST(sum(label) AS BIGINT) AS positive FROM folded GROUP BY ALL""",
    "boosting": f"""{_FOLDS_SQL.format(k=2)}, cases AS (SELECT 0 AS c, 0.0 AS least, *, true AS train FROM folded), {_STUMP_SQL}
SELECT vec_id, label, weight, prediction FROM predicted""",
    "boosting_f1": f"""{_FOLDS_SQL.format(k=2)}, cases AS (SELECT 0 AS c, 0.0 AS least, *, true AS train FROM folded), {_STUMP_SQL}
SELECT round({_F1_SQL}, 9) AS f1 FROM predicted""",
    "boosting_search": f"""{_FOLDS_SQL.format(k=2)}, cases AS (
  SELECT 2 * g.n + f.fold AS c, g.least, r.*, r.fold <> f.fold AS train
  FROM folded r, (VALUES {", ".join(f"({n}, {gain})" for n, gain in enumerate(_GAINS))}) g(n, least), (VALUES (0), (1)) f(fold)
), {_STUMP_SQL}, scores AS (
  SELECT c // 2 AS n, any_value(least) AS least, {_F1_SQL} AS f1 FROM predicted WHERE NOT train GROUP BY c, c // 2
), means AS (SELECT n, CAST(any_value(least) AS DOUBLE) AS min_gain, avg(f1) AS f1 FROM scores GROUP BY n)
SELECT min_gain, round(f1, 9) AS f1, n = (SELECT arg_max(-n, f1) FROM means) * -1 AS best FROM means""",
    "boosting_trees": f"""{_TREES_SQL}
SELECT vec_id, fold, round(score, 6) AS score, CAST(score > 0 AS DOUBLE) AS prediction
FROM ({" UNION ALL ".join(f"SELECT *, {n} AS tree FROM r{n}" for n in _TRIED)}) JOIN kept USING (tree)""",
    "boosting_rounds": f"""{_TREES_SQL}
SELECT CAST(tree AS INTEGER) AS tree, round(loss, 6) AS loss, tree <= (SELECT tree FROM kept) AS kept FROM tried""",
    "scoring": f"""{_SCORED_SQL}
SELECT mac, label, uuid, num_apps FROM scored WHERE prediction = 1""",
    "scoring_trees": f"""{_CASES_SQL}, started AS (SELECT *, avg(label) OVER (PARTITION BY c) AS p FROM cases), sums AS (
  SELECT c, dim, any_value(p) AS p, sum(p - label) AS g, sum(p * (1 - p)) AS h, count(*) AS n, coalesce(sum(p - label) FILTER (WHERE x = 0), 0) AS g0,
    coalesce(sum(p * (1 - p)) FILTER (WHERE x = 0), 0) AS h0, count(*) FILTER (WHERE x = 0) AS n0
  FROM (SELECT c, p, label, unnest(range(0, len(features))) AS dim, unnest(features) AS x FROM started) GROUP BY c, dim
), best AS (
  SELECT c, arg_min(struct_pack(dim := dim, g := g, h := h, g0 := g0, h0 := h0), (-gain, dim)) AS b FROM (
    SELECT *, round(g0 ** 2 / (h0 + 1) + (g - g0) ** 2 / (h - h0 + 1) - g ** 2 / (h + 1), 9) AS gain FROM sums WHERE p > 0 AND p < 1)
  WHERE gain > 0 AND least(n0, n - n0) >= 1 GROUP BY c
)
SELECT mac, c AS label, uuid, num_apps FROM started LEFT JOIN best USING (c)
WHERE CASE WHEN p = 0 THEN false WHEN p = 1 THEN true ELSE ln(p / (1 - p)) - coalesce(
  CASE WHEN features[b.dim + 1] = 0 THEN b.g0 / (b.h0 + 1) ELSE (b.g - b.g0) / (b.h - b.h0 + 1) END, 0) > 0 END""",
    "scoring_metrics": f"""{_SCORED_SQL}
SELECT label, count(*) AS devices, count(*) FILTER (WHERE oov) AS out_of_vocab,
  CASE WHEN count(*) FILTER (WHERE prediction = 1) > 0 THEN count(*) FILTER (WHERE prediction = 1) END AS detections
FROM scored GROUP BY label""",
}
