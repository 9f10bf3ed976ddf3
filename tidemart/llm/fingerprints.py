"""Document fingerprints by consistent weighted sampling.

A text's terms are its lower-cased five-word shingles (a text of fewer words has its whole
sequence as one), each weighted by how often it occurs. A term x of weight w draws, from
its hash alone, r and c ~ Gamma(2, 1) and b ~ Uniform(0, 1); with

    t = floor(ln w / r + b),    ln a = ln c - r (t + 1 - b)

a is exponential with rate w and the same for all weights that share t, so the term with
the least a is a sample that two bags agree on with the probability of their generalised
Jaccard similarity, the sum of smaller weights over the sum of larger ones.

A fingerprint holds up to ``BINS`` samples. A term draws once and competes in the bin that
its hash names, instead of drawing anew for every sample: the bins split the terms
at random, a sample of a bin stands for its share, and a text costs one draw a term however
long the fingerprint is. Bins empty in both texts say nothing and are left out of

    likeness = bins with equal samples / bins with a sample in either

which estimates the generalised Jaccard similarity, with a standard error of at most
0.5 / sqrt(bins with a sample).

Samples are kept as whole numbers, bin * 2^16 + 1 + a hash of ln a below 2^16 - 1: unequal
samples look equal once in 65,535. As text, a sample is six hexadecimal digits.

Everything is Spark's own functions over one row's arrays; nothing is exploded, and a
fingerprint needs no shuffle. A row's arrays hold about 100 bytes a word.

Defined results: null and empty texts and texts without words have no samples (an empty
fingerprint); two such texts have likeness 1, one such and another 0. Equal texts have equal
fingerprints. A null doc_id is carried and sorts after all others; rows equal in id and text
give one row each; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import WORD
from tidemart.operators.ordering import SortKey, global_row_number
from tidemart.session import write_shared

SHINGLE = 5
BINS = 64
# Bits of the term's hash that name its bin.
_BIN_BITS = 6
# ln a lies within (-500, 500): a bin and a value make one sortable number.
_APART = 1000.0


def _uniform(term: Column, salt: int) -> Column:
    """A number between 0 and 1, both excluded, from the hash of a term."""
    return (F.shiftrightunsigned(F.xxhash64(term, F.lit(salt)), 11) + F.lit(0.5)) * F.lit(2.0**-53)


def _gamma(term: Column, salt: int) -> Column:
    """A Gamma(2, 1) number from the hash of a term."""
    return -F.log(_uniform(term, salt) * _uniform(term, salt + 1))


def _drawn(term: Column, log_weight: Column | None = None) -> Column:
    """bin * 1000 + ln a of a term; without a weight it is 1."""
    r, b = _gamma(term, 1), _uniform(term, 5)
    # At weight 1, t is 0.
    t = F.lit(0.0) if log_weight is None else F.floor(log_weight / r + b).cast("double")
    value = F.log(_gamma(term, 3)) - r * ((t + 1) - b)
    return F.shiftrightunsigned(term, 64 - _BIN_BITS).cast("double") * _APART + value


def _bin(drawn: Column) -> Column:
    return F.floor((drawn + _APART / 2) / _APART)


def fingerprinted(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the samples of column ``text`` as whole numbers in order of their bins."""
    w, h, d, s, e, p = (f"_{out}_{name}_" for name in ("words", "hashes", "distinct", "sorted", "ends", "drawn"))
    longs, ints = F.array().cast("array<bigint>"), F.array().cast("array<int>")
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))
    rows = rows.withColumn(w, F.transform(words, lambda x: F.xxhash64(x)))
    n = F.size(w)
    shingles = F.transform(
        F.sequence(F.lit(0), n - SHINGLE),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]),
    )
    rows = rows.withColumn(h, F.when(n >= SHINGLE, shingles).when(n > 0, F.array(F.xxhash64(w))).otherwise(longs))
    rows = rows.withColumn(d, F.array_distinct(h))
    # Only texts that repeat a shingle are sorted to count them.
    rows = rows.withColumn(s, F.when(F.size(d) < F.size(h), F.sort_array(h)))
    last = F.filter(
        F.sequence(F.lit(0), F.size(s) - 1), lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i + 1))
    )
    rows = rows.withColumn(e, F.when(F.col(s).isNotNull(), last).otherwise(ints))
    weighted = F.transform(
        e, lambda x, i: _drawn(F.get(s, x), F.log((x - F.coalesce(F.get(e, i - 1), F.lit(-1))).cast("double")))
    )
    drawn = F.when(F.col(s).isNotNull(), weighted).otherwise(F.transform(d, lambda x: _drawn(x)))
    rows = rows.withColumn(p, F.sort_array(drawn))
    least = F.filter(p, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(p, i - 1))))
    samples = F.transform(
        least, lambda x: (_bin(x) * 65536 + 1 + F.pmod(F.xxhash64(x), F.lit(65535))).cast("int")
    )
    return rows.withColumn(out, samples).drop(w, h, d, s, e, p)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples among the bins with a sample in either fingerprint."""
    shared = F.size(F.array_intersect(a, b))
    bins = F.size(F.array_union(_bins(a), _bins(b)))
    return F.when(bins == 0, F.lit(1.0)).otherwise(shared / bins)


def _bins(samples: Column) -> Column:
    return F.transform(samples, lambda x: F.shiftright(x, 16))


def as_text(samples: Column) -> Column:
    """A fingerprint as hexadecimal text, six digits a sample."""
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct documents, and who follows whom in descending order of doc_id.

    The first frame has a, b (128 bits that name a document by id and text) and text. The
    second, written, has a, b, doc_id, n_chars, copies (rows equal in both) and the a, b of the
    next one, ordered by id and then by hash; the first comes after the last.
    """
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text")).select(
        F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").alias("a"),
        F.xxhash64("text", F.col("doc_id").isNull(), "doc_id").alias("b"),
        "doc_id",
        "text",
    )
    groups = named.groupBy("a", "b", "doc_id", F.length("text").cast("long").alias("n_chars")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    order = [SortKey("doc_id", descending=True, nulls_first=False), SortKey("a"), SortKey("b")]
    numbered = write_shared(global_row_number(groups, order, "nth"), "documents-in-order")
    total = numbered.count()
    after = numbered.select(
        F.when(F.col("nth") == 1, F.lit(total)).otherwise(F.col("nth") - 1).cast("long").alias("nth"),
        F.col("a").alias("next_a"),
        F.col("b").alias("next_b"),
    )
    links = write_shared(numbered.join(after, "nth").drop("nth"), "document-links")
    return named.select("a", "b", "text").dropDuplicates(["a", "b"]), links


def _half_replaced(text: Column, n_chars: Column, head: Column) -> Column:
    """``text`` with its last n_chars / 2 code points, rounded down, replaced by ``head``."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n_chars.cast("int") - half), head)


def _head(text: Column, n_chars: Column) -> Column:
    """The first n_chars / 2 code points of ``text``, rounded down, or all."""
    return F.substring(text, F.lit(1), F.floor(n_chars / 2).cast("int"))


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of
    every row of ``docs`` (doc_id, text).

    The edited text has its last half replaced by the beginning of the next document. A
    document's copies follow it, so all but the last of them are followed by an equal text.
    Texts are shuffled once, and of each its beginning once more to the document it goes into.
    """
    texts, links = with_next(docs)
    into = links.select(
        F.col("a").alias("into_a"), F.col("b").alias("into_b"), "n_chars", F.col("next_a").alias("a"), F.col("next_b").alias("b")
    )
    heads = texts.join(into, ["a", "b"]).select(
        F.col("into_a").alias("a"), F.col("into_b").alias("b"), _head(F.col("text"), F.col("n_chars")).alias("head")
    )
    held = texts.join(links, ["a", "b"]).join(heads, ["a", "b"])
    own = _head(F.col("text"), F.col("n_chars"))
    # An edit by the next document, and one by a copy where there are copies.
    kinds = F.array(
        F.struct(F.lit(1).cast("long").alias("rows"), F.lit(False).alias("copy"), F.col("head").alias("head")),
        F.struct((F.col("copies") - 1).alias("rows"), F.lit(True).alias("copy"), own.alias("head")),
    )
    held = fingerprinted(held, "text", "samples").withColumn(
        "kind", F.explode(F.filter(kinds, lambda k: k["rows"] > 0))
    )
    held = held.select(
        "a", "b", "next_a", "next_b", "doc_id", "n_chars", "samples",
        F.col("kind.rows").alias("rows"),
        F.col("kind.copy").alias("copy"),
        _half_replaced(F.col("text"), F.col("n_chars"), F.col("kind.head")).alias("edited"),
    )
    found = fingerprinted(held, "edited", "edited_samples").withColumn("edited_sha256", F.sha2("edited", 256))
    found = write_shared(found.drop("edited"), "fingerprints")
    after = found.filter(~F.col("copy")).select(
        F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("samples").alias("next_samples")
    )
    met = found.join(after, ["next_a", "next_b"])
    near_next = F.when(F.col("copy"), F.lit(1.0)).otherwise(likeness(F.col("samples"), F.col("next_samples")))
    return met.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("samples")).alias("fingerprint"),
        as_text(F.col("edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        near_next.alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_row"),
    ).drop("_row")
