"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one
long with a bit per failed rule; a policy is a versioned set of rules, applied as a mask
of that long, so policies can change without reading a text again. ``ablation`` counts
the distinct ledgers first and then tells, for each rule of a policy, how many documents
fail it and how many fail it alone (those that dropping the rule would bring back).

Everything is built from Spark's own functions over the words of one row: no shuffle, no
explode. A text's three-word windows are hashed, sorted with their places, and equal
neighbours mark the repeated ones; the places they cover are summed in text order.

Defined results: null and empty texts have no words (all measurements 0; they fail
``few_words``); repeated rows are judged each; no rows give no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import WORD

SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")

# Bit i of the ledger is the i-th rule.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "capitals": "100 * n_upper > 60 * n_letters",
}

# Versioned policies; a version, once used, is never changed.
POLICIES: dict[str, Sequence[str]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}


def mask(rules: Sequence[str]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _length(values: Column) -> Column:
    return F.size(values).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every row of ``docs`` (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    parts = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        "text",
        F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.regexp_like(line, F.lit(WORD))).alias("lines"),
    )
    n = F.size("words")
    # Hash and place of each window; the two words after place i are fetched by index.
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(
            F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")
        ),
    )
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    parts = parts.select(
        "doc_id",
        _length(F.col("words")).alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _length(F.col("lines")).alias("n_lines"),
        (_length(F.col("lines")) - _length(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.sort_array(F.when(n >= 3, windows).otherwise(none)).alias("windows"),
    )
    w = F.col("windows")

    def again(x: Column, i: Column) -> Column:
        before, after = F.get(w, i - 1), F.get(w, i + 1)
        return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter(w, again), lambda x: x["i"]))
    parts = parts.withColumn("places", places)
    p = F.col("places")
    # A window covers its place and the two after it, as far as the next window leaves them.
    covered = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1), x + 3) - x, F.lit(3)))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return parts.withColumn("n_repeat_words", total).select("doc_id", *MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed``, the bits of the rules a document fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(RULES.values())]
    return measured(docs).withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def fails(policy: Sequence[str]) -> Column:
    """Whether a ledger row fails any rule of a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablation(rows: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """version, rule, n_docs, n_failed, n_failed_alone from ledger rows.

    ``n_failed_alone``: documents of which this is the only rule of the policy they fail.
    """
    # At most one row per combination of rules.
    counts = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = F.array(
        *[
            F.struct(
                F.lit(version).alias("version"),
                F.lit(rule).alias("rule"),
                F.lit(mask([rule])).cast("long").alias("bit"),
                F.lit(mask(rules)).cast("long").alias("mask"),
            )
            for version, rules in policies.items()
            for rule in rules
        ]
    )
    each = counts.select("n", "failed", F.explode(cases).alias("c"))
    hit = F.col("failed").bitwiseAND(F.col("c.mask"))
    return each.groupBy("c.version", "c.rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(hit.bitwiseAND(F.col("c.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("c.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
    )
