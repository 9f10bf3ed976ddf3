"""Bounded samples of labelled documents to train on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def labelled(labels: DataFrame, label: str, training: Column) -> DataFrame:
    """doc_id and one label per document that may be learned from.

    Rows without id or label are left out, as are documents with contradicting labels.
    """
    rows = labels.filter(training & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    one = rows.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
    return one.filter(F.col("label") == F.col("other")).select("doc_id", "label")


# Label values up to which each is sampled by a plan of its own, a combined top-k.
FEW_VALUES = 100
SLICES = 64


def bounded_sample(rows: DataFrame, values: list, per_class: int, seed: int) -> DataFrame:
    """At most ``per_class`` documents of each label value of ``rows``, those of smallest seeded hash.

    ``values`` are all the values of ``label``.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    rows = rows.select("doc_id", "label")
    if len(values) <= FEW_VALUES:
        parts = [rows.filter(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in values]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
    else:
        # One plan for all values; the first ones of each slice of a value, then of these.
        part = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(SLICES))
        first = Window.partitionBy("label", part).orderBy(order, "doc_id")
        out = rows
        for w in (first, Window.partitionBy("label").orderBy(order, "doc_id")):
            out = out.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= per_class).drop("nth")
    found = [tuple(r) for r in out.collect()]
    return rows.sparkSession.createDataFrame(found, rows.schema)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, label and text of the sampled documents; one row per id (of repeated ids, one of them)."""
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
