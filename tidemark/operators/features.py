"""Vector sums and multi-hot features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import vector_entries
from tidemark.operators.rollup import DEVICE_KEYS, nested_app
from tidemark.session import literal_table, splittable

# Vocabulary words that stand for unknown apps of either side.
OUT_OF_VOCAB = {"client": "client-out-of-vocab", "server": "server-out-of-vocab"}


def vector_sum(df: DataFrame, key: str, vector_col: str, out: str = "entries") -> DataFrame:
    """``(key, out)``: the non-zero ``(dim, val)`` entries of the sum of each key's vectors.

    Sums are taken per key and dimension, so sparse vectors are never made dense. A key
    with zero vectors only has no entries.
    """
    entries = df.select(key, F.explode_outer(vector_entries(df, vector_col)).alias("__entry"))
    sums = entries.groupBy(key, F.col("__entry.dim").alias("__dim")).agg(F.sum("__entry.val").alias("__val"))
    entry = F.struct(F.col("__dim").alias("dim"), F.col("__val").alias("val"))
    return sums.groupBy(key).agg(F.sort_array(F.collect_list(F.when(F.col("__val") != 0, entry))).alias(out))


def vocabulary_words(
    usage: DataFrame, vocabulary: DataFrame, keys: Sequence[str] = DEVICE_KEYS, apps: str = "apps"
) -> DataFrame:
    """``(*keys, words)``: the vocabulary words in use on each row, sorted.

    ``usage`` nests structs with ``appName`` and ``numFlows``; an app counts if it
    has flows. Unknown apps show as the flag word of their side; those that name
    no side are ignored. Rows without apps get no words. ``vocabulary`` holds one
    ``word`` per row, per ``label`` if it has that column.
    """
    used = usage.select(*keys, F.explode_outer(apps).alias("app")).select(
        *keys, F.when(F.col("app.numFlows") > 0, F.col("app.appName")).alias("__used")
    )
    words = _with_word(used, vocabulary)
    return words.groupBy(*keys).agg(F.sort_array(F.collect_set("__word")).alias("words"))


def device_words(
    windowed: DataFrame, vocabulary: DataFrame, keys: Sequence[str] = DEVICE_KEYS
) -> DataFrame:
    """Nested usage together with its vocabulary words, from the trailing window.

    The vocabulary is looked up before nesting, so both lists come out of one
    shuffle.
    """
    used = F.when(F.col("numFlowsWindow") > 0, F.col("appName")).alias("__used")
    words = _with_word(windowed.select("*", used), vocabulary)
    return words.groupBy(*keys).agg(
        F.sort_array(F.collect_list(nested_app())).alias("apps"),
        F.sort_array(F.collect_set("__word")).alias("words"),
    )


def multi_hot(
    usage: DataFrame,
    vocabulary: Sequence[str],
    keys: Sequence[str] = DEVICE_KEYS,
    *,
    feature_type: str = "binary",
    apps: str = "apps",
) -> DataFrame:
    """``(*keys, words, features)`` with one 0/1 dimension per vocabulary word."""
    if feature_type != "binary":
        raise ValueError("only binary features are supported")
    missing = set(OUT_OF_VOCAB.values()) - set(vocabulary)
    if missing:
        raise ValueError(f"vocabulary lacks {sorted(missing)}")
    table = literal_table(usage.sparkSession, [(w,) for w in vocabulary], "word string")
    return words_to_vector(vocabulary_words(usage, table, keys, apps), vocabulary)


def words_to_vector(df: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Add ``features``, a sparse 0/1 vector over the vocabulary, from ``words``."""
    model = CountVectorizerModel.from_vocabulary(
        list(vocabulary), inputCol="words", outputCol="features", minTF=1.0
    )
    return model.setBinary(True).transform(df)


def _with_word(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    by_label = [c for c in ("label",) if c in vocabulary.columns]
    known = vocabulary.select(*by_label, F.col("word").alias("__used")).distinct()
    known = known.withColumn("__known", F.lit(True))
    name = F.col("__used")
    word = F.when(F.col("__known"), name)
    for side, flag in OUT_OF_VOCAB.items():
        word = word.when(name.startswith(side), flag)
    joined = df.join(splittable(known), [*by_label, "__used"], "left")
    return joined.withColumn("__word", word)
