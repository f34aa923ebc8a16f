"""Quality rules as a ledger: every rule once per document, kept as bits and measurements.

Only built-in functions, and no shuffle: measurements are expressions over one row. A
policy is a bit mask, so policies can change, and be compared, without reading texts.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window whose repetition counts.
WINDOW = 5
_SPACE = r"\x20\x09-\x0D"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"



def _rules() -> dict[str, Column]:
    words = F.col("n_words")
    return {
        "few_words": words < 10,
        "repeated_words": 100 * F.col("n_repeat_words") > 20 * words,
        "symbols": 100 * F.col("n_symbols") > 20 * F.col("word_chars"),
        "repeated_lines": 100 * F.col("n_dup_lines") > 60 * F.col("n_lines"),
        "short_words": F.col("word_chars") < 2 * words,
        "long_words": F.col("word_chars") > 30 * words,
    }


RULE_NAMES = ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words")


def mask_of(*rules: str) -> int:
    """The bits of some rules."""
    return sum(1 << RULE_NAMES.index(rule) for rule in rules)


#: The base rules, and versions of the policy; a document is kept if it fails none of its bits.
BASE = mask_of("few_words", "repeated_words")
POLICIES = {"v1": BASE, "v2": BASE | mask_of("symbols", "repeated_lines", "long_words")}


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger: ``(id_col, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, failed)``.

    Words are runs of characters other than spaces and ASCII controls 9 to 13. ``failed``
    has bit k set if rule k of ``RULE_NAMES`` fails. Null and empty texts measure zero
    everywhere and fail ``few_words``. One row per row, repeated ones included.
    """
    long = lambda c: c.cast("long")
    empty = F.array().cast("array<string>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.regexp_replace("text", f"^[{_SPACE}]+|[{_SPACE}]+$", "")
    base = (
        docs.select(F.col(id_col), text.alias("text"))
        .withColumn("words", F.when(F.col("text").rlike(f"[^{_SPACE}]"), F.split(trimmed, f"[{_SPACE}]+")).otherwise(empty))
        .withColumn("lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{_SPACE}]")))
        .withColumn("word_chars", F.length(F.translate("text", _SPACES, "")))
        .withColumn("n_symbols", F.length("text") - F.length(F.translate("text", _SYMBOLS, "")))
        .withColumn("n_words", F.size("words"))
    )
    window = lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])
    last = F.col("n_words") - WINDOW
    hashes = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)).otherwise(F.array().cast("array<bigint>"))
    # Windows with different hashes differ; the few documents with equal ones are compared in full.
    spelled = lambda i: F.struct(F.concat_ws(" ", F.slice("words", i + 1, WINDOW)).alias("w"), i.alias("i"))
    none = F.array().cast("array<struct<w:string,i:int>>")
    found = (
        base.withColumn("hashes", hashes)
        .withColumn("again", F.size(F.array_distinct("hashes")) < F.size("hashes"))
        .withColumn("sorted", F.when(F.col("again"), F.sort_array(F.transform(F.sequence(F.lit(0), last), spelled))).otherwise(none))
        .withColumn("places", F.sort_array(F.transform(F.filter("sorted", _has_twin), lambda x: x["i"])))
        .withColumn("gaps", F.transform("places", lambda p, k: F.least(F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))))
    )
    measured = found.select(
        F.col(id_col),
        long(F.col("n_words")).alias("n_words"),
        long(F.col("word_chars")).alias("word_chars"),
        long(F.col("n_symbols")).alias("n_symbols"),
        long(F.size("lines")).alias("n_lines"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.aggregate("gaps", F.lit(0).cast("long"), lambda a, g: a + g).alias("n_repeat_words"),
    )
    bits = [F.when(fails, F.lit(1 << RULE_NAMES.index(name))).otherwise(0) for name, fails in _rules().items()]
    return measured.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def _has_twin(x: Column, k: Column) -> Column:
    same = lambda other: F.coalesce(other["w"] == x["w"], F.lit(False))
    return same(F.get("sorted", k - 1)) | same(F.get("sorted", k + 1))


def apply_policy(ledger: DataFrame, policy: int) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``: no bit of the base rules or the policy is set."""
    failed = F.col("failed")
    return ledger.withColumn("base_failed", failed.bitwiseAND(F.lit(BASE)) != 0).withColumn(
        "kept", failed.bitwiseAND(F.lit(BASE | policy)) == 0
    )


def ablations(ledger: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """``(policy, without, kept, only_here)`` per policy and rule of it.

    ``kept`` documents pass the policy without that rule (all rules where ``without`` is
    null) and ``only_here`` fail that rule alone. Texts are not read: documents are counted
    per mask first, and there are at most 2 to the number of rules masks.
    """
    masks = ledger.groupBy("failed").agg(F.count("*").alias("n"))
    cases = [
        (name, rule, bits, 0 if rule is None else mask_of(rule))
        for name, bits in policies.items()
        for rule in (None, *(r for r in RULE_NAMES if bits & mask_of(r)))
    ]
    spread = masks.select("failed", "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("policy"), F.lit(rule).cast("string").alias("without"), F.lit(bits).alias("bits"), F.lit(bit).alias("bit"))
        for name, rule, bits, bit in cases
    ])).alias("c"))
    rest = F.col("failed").bitwiseAND(F.col("c.bits"))
    left = rest.bitwiseAND(F.bitwise_not(F.col("c.bit")))
    return spread.groupBy(F.col("c.policy").alias("policy"), F.col("c.without").alias("without")).agg(
        F.sum(F.when(left == 0, F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when((left == 0) & (rest != 0), F.col("n")).otherwise(0)).alias("only_here"),
    )
