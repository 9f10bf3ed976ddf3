"""Mix sources to target weights by capped water-filling.

Every source has a weight and a cap: ``max_epochs`` times its own size. The level
starts at total / sum of weights; sources whose share is above their cap are clamped
there, what they leave is shared among the others by weight, and so on until none is
above its cap. Each round is one aggregate over the (written) table of sources.

A source then repeats all its documents ``floor(target / size)`` times, and for the
fractional rest takes documents once more in the order of a seeded hash until the target
is met; the last of them is taken in part. The order is never sorted as a whole: words are
summed per source and hash bucket, prefix sums over the buckets find the one in which
the target falls, and only that bucket's rows are put in order.

Defined results: null text has size 0; null is a source of its own, ordered last; a
source of size 0 has target 0 and takes nothing; repeated rows are separate documents,
but rows equal in id and text are taken together; no rows give no rows. Only the
columns named in the arguments are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import small, word_count
from tidemart.operators.ordering import SortKey, global_row_number
from tidemart.session import write_shared

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3.0
SEED = 20260
BUCKET_BITS = 12


def _order(seed: int) -> Column:
    """The seeded place of a document within its source."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def _bucket(order: Column) -> Column:
    return F.shiftright(order, 64 - BUCKET_BITS)


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One narrow row per document: doc_id, source, size in words, seeded order."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _order(seed).alias("order"))


def water_level(sources: DataFrame, total: float) -> float:
    """The level at which the clamped shares of ``sources`` (weight, cap) sum to ``total``.

    Rounds end when no further source is clamped; the level only rises, so there are at
    most as many rounds as sources, in practice a handful.
    """
    level = 0.0
    while True:
        over = F.col("cap") < F.col("weight") * F.lit(level)
        kept, weight = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not weight:
            return level
        risen = (total - kept) / weight
        if risen <= level:
            return level
        level = risen


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """Target words per source from (source, source_size); weights repeat in code point order."""
    placed = global_row_number(sizes, [SortKey("source", nulls_first=False)], "place", start=0)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = write_shared(
        placed.select(
            "source",
            "source_size",
            F.get(cycle, F.pmod("place", F.lit(len(weights))).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"),
        ),
        "mix-sources",
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = water_level(sources, float(total))
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def mix_plan(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """What each source takes, from ``measured`` rows that give the same on each reading.

    Returns of (the source), source_size, target, whole (repetitions of every document), need
    (words beyond those), cut_order (documents ordered before it are taken once more; null:
    all are) and cut_part (the part taken of the document there).
    """
    buckets = write_shared(
        rows.groupBy("source", _bucket(F.col("order")).alias("bucket")).agg(F.sum("size").alias("words")),
        "mix-buckets",
    )
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    plan = (
        source_targets(sizes, weights, max_epochs)
        .withColumn("whole", whole.cast("long"))
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    plan = write_shared(plan.withColumnRenamed("source", "of"), "mix-plan")
    # At most 2^BUCKET_BITS rows per source.
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = buckets.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    cuts = (
        before.join(small(plan.select("of", "need")), F.col("source").eqNullSafe(F.col("of")))
        .filter(F.col("before") <= F.col("need"))
        .groupBy(F.col("source").alias("of"))
        .agg(F.max("bucket").alias("cut_bucket"), F.max_by(F.col("need") - F.col("before"), "bucket").alias("left"))
    )
    cuts = write_shared(cuts, "mix-cuts")
    # Documents with equal hashes form one step of the order.
    steps = (
        rows.join(
            small(cuts),
            F.col("source").eqNullSafe(F.col("of")) & (_bucket(F.col("order")) == F.col("cut_bucket")),
        )
        .groupBy("of", "order", "left")
        .agg(F.sum("size").alias("words"))
    )
    along = Window.partitionBy("of").orderBy("order")
    last = (
        steps.withColumn("past", F.sum("words").over(along) - F.col("left"))
        .filter((F.col("past") > 0) & (F.col("past") <= F.col("words")))
        .select(
            F.col("of").alias("of_"),
            F.col("order").alias("cut_order"),
            (1 - F.col("past") / F.col("words")).alias("cut_part"),
        )
    )
    out = plan.join(last, F.col("of").eqNullSafe(F.col("of_")), "left").drop("of_")
    return write_shared(out, "mix-cut-plan")


def repetitions(order: Column, plan: str = "") -> tuple[Column, Column]:
    """Full repetitions of a document and the part of it that is taken besides, beside its
    source's row of the plan (``plan``: prefix of the plan's columns)."""
    cut = F.col(f"{plan}cut_order")
    fits = (F.col(f"{plan}need") > 0) & F.coalesce(order < cut, F.lit(True))
    full = F.col(f"{plan}whole") + fits.cast("long")
    return full, F.when(order == cut, F.col(f"{plan}cut_part")).otherwise(0.0)


def mix_counts(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """doc_id, source, size, source_size, target, full (repetitions), part and taken of every document.

    ``part`` is above 0 for one document per source (and those equal to it), of which
    only the first words are taken once more, so that the source meets its target.
    """
    rows = write_shared(measured(docs, seed), "mix-rows")
    plan = small(mix_plan(rows, weights, max_epochs))
    full, part = repetitions(F.col("order"))
    taken = full * F.col("size") + F.round(part * F.col("size")).cast("long")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target",
        full.alias("full"), part.alias("part"), taken.alias("taken"),
    )


def mix_documents(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """The mixed rows themselves, all columns kept: every document as often as it is taken.

    Only whole documents are given out: the one that is cut by its source's target comes
    once more if at least half of it is within.
    """
    rows = write_shared(measured(docs, seed), "mix-rows")
    plan = mix_plan(rows, weights, max_epochs)
    plan = small(plan.select(F.struct(*plan.columns).alias("_mix_plan_")))
    chosen = docs.join(plan, F.col("source").eqNullSafe(F.col("_mix_plan_.of")))
    full, part = repetitions(_order(seed), "_mix_plan_.")
    return (
        chosen.withColumn("_mix_times_", (full + (part >= 0.5).cast("long")).cast("int"))
        .filter("_mix_times_ > 0")
        .withColumn("_mix_copy_", F.explode(F.sequence(F.lit(1), F.col("_mix_times_"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
