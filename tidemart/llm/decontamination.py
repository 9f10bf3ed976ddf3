"""Benchmark decontamination by fingerprints of item-sized windows.

Words are runs of letters and digits, lower-cased. A benchmark item of n words is held
against windows of n words of a document, as sets of five-word shingles (a shorter item
is one shingle of all its words) weighted by how often they occur in either.

1. **Windows.** Two bags of a and b shingles are similar by 80 percent only if they share
   80 / 180 of a + b or more. One pass over the texts hashes every shingle and looks it up
   among the items' shingles; for each item, every window that holds so many of its
   shingles is laid, wherever it starts, and no other can match it.
2. **Fingerprints.** Each window and each item gets a 128-bit SimHash of its weighted
   shingles.
3. **Hamming blocks.** The bits are cut into ``RADIUS + 1`` blocks. Two fingerprints at
   most RADIUS apart agree in one block at least, so an equi-join on (item, block,
   value) finds all of them; the exact distance is taken next.
4. **Similarity.** Pairs within the radius are verified by the exact weighted Jaccard
   similarity of their shingles, 80 percent or more.

Fingerprints differ by chance: of two sets at similarity 0.8 a bit differs with probability
0.16 or less, and more than RADIUS = 48 of 128 with probability below 1e-8. That holds for
``PLAIN`` or more shingles that do not repeat. Fewer, or repeated ones, weigh single bits more; where
either side is such a bag, the pair goes to the exact check whatever its distance.

Equal texts are searched once. Everything is Spark's own functions; shingles and their
counts are kept as whole numbers. Broadcast sides are measured in rows and bytes first;
larger benchmarks are joined by shuffle. Only windows are shuffled, and the texts that hold one.

Defined results: null or empty texts and items without words match nothing; a null
doc_id or item_id is carried as null; documents equal in id and text give one result,
repeated items one each; no rows on either side give no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.skew import broadcast_if_small
from tidemart.session import write_shared

SHINGLE = 5
PERCENT = 80
RADIUS = 48
BITS = 128
# Shingles of a set whose fingerprint can be trusted.
PLAIN = 16

# Rows that a side of a few whole numbers may have to be broadcast (32 MB at most, as is checked).
ANCHOR_ROWS = 1_000_000

TEXT = ["text_hash", "text_check"]
_RUN = r"([\p{L}\p{M}\p{N}]+)"


def _words(text: Column) -> Column:
    """The lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_RUN), F.lit(1))


def _named(docs: DataFrame, *others: str) -> DataFrame:
    """Columns ``others`` and text, and 128 bits that name the text."""
    return docs.select(
        *others, "text", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(1), "text").alias("text_check")
    )


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all k-word shingles, in order; ``words`` is a column used more than once."""
    empty = F.array().cast("array<bigint>")
    each = F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]),
    )
    return F.when(F.size(words) >= k, each).otherwise(empty)


def _placed_shingles(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """text_hash, text_check, n_words, at, k and shingle of each shingle of ``sizes`` words of each text.

    Shifted copies of the words are zipped and exploded, so that all of it is generated code.
    """
    words, most = F.col("words"), max(sizes)
    rows = texts.select(*TEXT, _words(F.col("text")).alias("words"))
    shifted = [F.slice(words, j + 1, F.size(words)).alias(f"w{j}") for j in range(most)]
    rows = rows.select(*TEXT, F.size(words).alias("n_words"), F.posexplode(F.arrays_zip(*shifted)).alias("at", "w"))
    each = [
        F.when(
            F.col("at") + k <= F.col("n_words"),
            F.struct(F.lit(k).alias("k"), F.xxhash64(*[F.col(f"w.w{j}") for j in range(k)]).alias("shingle")),
        )
        for k in sizes
    ]
    if len(each) == 1:
        rows = rows.withColumn("s", each[0]).drop("w")
    else:
        rows = rows.select(*TEXT, "n_words", "at", F.explode(F.array(*each)).alias("s"))
    return rows.filter("s IS NOT NULL").select(*TEXT, "n_words", "at", "s.k", "s.shingle")


def _simhash(shingles: Column) -> Column:
    """Two longs: bit b is set if the shingles' hashes have it more often than not.

    A shingle that occurs twice counts twice: that is its weight.
    """

    def word(salt: int) -> Column:
        hashes = F.transform(shingles, lambda s: F.xxhash64(s, F.lit(salt)))
        bound = F.transform(F.array(hashes), lambda h: F.aggregate(
            F.sequence(F.lit(0), F.lit(63)),
            F.lit(0).cast("long"),
            lambda acc, b: acc.bitwiseOR(
                F.when(
                    2 * F.aggregate(h, F.lit(0), lambda n, x: n + F.call_function("getbit", x, b).cast("int")) > F.size(h),
                    F.call_function("shiftleft", F.lit(1).cast("long"), b),
                ).otherwise(F.lit(0).cast("long"))
            ),
        ))
        return F.element_at(bound, 1)

    return F.array(*[word(salt) for salt in range(BITS // 64)])


def _cuts(radius: int) -> list[tuple[int, int, int]]:
    """(word, lowest bit, bits) of the radius + 1 blocks; none reaches over two words."""
    words = BITS // 64
    cuts = []
    for w in range(words):
        n = (radius + 1 + w) // words
        edges = [i * 64 // n for i in range(n + 1)] if n else []
        cuts += [(w, low, high - low) for low, high in zip(edges, edges[1:])]
    return cuts


def _block(word: Column, low: int, size: int) -> Column:
    return F.shiftrightunsigned(word, low).bitwiseAND(F.lit((1 << size) - 1).cast("long"))


def _blocks(bits: Column, radius: int) -> Column:
    """(block, value) of the radius + 1 blocks into which the fingerprint is cut."""
    values = F.array(*[_block(F.get(bits, F.lit(w)), low, size) for w, low, size in _cuts(radius)])
    return F.transform(values, lambda v, i: F.struct(i.alias("block"), v.alias("value")))


def _first_block(a: Column, b: Column, radius: int) -> Column:
    """Number of the first block in which two fingerprints agree; null if there is none."""
    apart = [F.get(a, F.lit(w)).bitwiseXOR(F.get(b, F.lit(w))) for w in range(BITS // 64)]
    values = F.array(*[_block(apart[w], low, size) for w, low, size in _cuts(radius)])
    return F.nullif(F.array_position(values, F.lit(0).cast("long")), F.lit(0)) - 1


def _distance(a: Column, b: Column) -> Column:
    each = [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITS // 64)]
    return reduce(Column.__add__, each)


def _plain(shingles: Column) -> Column:
    """Whether a bag is a set, large enough for its fingerprint to be trusted."""
    return (F.size(shingles) >= PLAIN) & (F.size(F.array_distinct(shingles)) == F.size(shingles))


def _with_numbered(rows: DataFrame, shingles: str, out: str) -> DataFrame:
    """``rows`` with ``out``: distinct longs, of which two bags share as many as they share shingles.

    A shingle's first occurrence is itself, a further one a hash of it and its number.
    """
    s, e = f"_{out}_sorted_", f"_{out}_ends_"
    repeated = F.size(F.array_distinct(shingles)) < F.size(shingles)
    rows = rows.withColumn(s, F.when(repeated, F.sort_array(shingles)))
    last = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i + 1)))
    rows = rows.withColumn(e, F.when(F.col(s).isNotNull(), last).otherwise(F.array().cast("array<int>")))

    def group(x: Column, i: Column) -> Column:
        count = x - F.coalesce(F.get(e, i - 1), F.lit(-1))
        value = F.get(s, x)
        return F.transform(
            F.sequence(F.lit(0), count - 1), lambda t: F.when(t == 0, value).otherwise(F.xxhash64(value, t))
        )

    numbered = F.when(F.col(s).isNotNull(), F.flatten(F.transform(e, group))).otherwise(F.col(shingles))
    return rows.withColumn(out, numbered).drop(s, e)


def _similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two numbered bags: shared / total."""
    shared = F.size(F.array_intersect(a, b))
    return shared / F.greatest(F.size(a) + F.size(b) - shared, F.lit(1))


def _starts(at: Column, least: Column, span: Column, last: Column) -> Column:
    """Each start from 0 to ``last`` once whose next ``span`` places hold ``least`` or more of the
    sorted places ``at``, which are at least as many."""

    def from_first(i: Column) -> Column:
        # Starts that have at[i] as their first place, or lie on it.
        low = F.greatest(F.get(at, i + least - 1) - span + 1, F.get(at, i - 1) + 1, F.lit(0))
        high = F.least(F.get(at, i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(at) - least), from_first))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id, n (words), k (words of a shingle), words and shingles of every item with words."""
    words = benchmark.select("item_id", _words(F.col("text")).alias("words"))
    rows = words.select("item_id", F.size("words").alias("n"), "words").filter("n > 0")
    w = F.col("words")
    long = _shingles(w, SHINGLE)
    short = [F.when(F.col("n") == k, _shingles(w, k)) for k in range(1, SHINGLE)]
    return rows.select(
        "item_id", "n", F.least("n", F.lit(SHINGLE)).alias("k"), F.coalesce(*short, long).alias("shingles")
    )


def _laid(texts: DataFrame, items: DataFrame, sizes: list[int], percent: int) -> DataFrame:
    """text_hash, text_check, item, n, k and start of every window that may be similar to an item."""
    anchors = items.select("item", "n", "k", F.explode(F.array_distinct("shingles")).alias("shingle"))
    anchors = broadcast_if_small(write_shared(anchors, "benchmark-shingles"), ANCHOR_ROWS)
    hits = _placed_shingles(texts, sizes).join(anchors, ["k", "shingle"])
    held = hits.groupBy(*TEXT, "n_words", "item", "n", "k").agg(F.array_sort(F.collect_set("at")).alias("at"))
    n = F.col("n")
    # A text shorter than the item is one window, of fewer shingles.
    full, span = n - F.col("k") + 1, F.least("n", "n_words") - F.col("k") + 1
    # The least number shared by bags of these sizes, rounded up.
    least = F.greatest(F.ceil(percent * (full + span) / F.lit(100 + percent)).cast("int"), F.lit(1))
    rows = held.withColumns({"span": span, "least": least}).filter(F.size("at") >= F.col("least"))
    last = F.greatest(F.col("n_words") - n, F.lit(0))
    starts = _starts(F.col("at"), F.col("least"), F.col("span"), last)
    return rows.select(*TEXT, "item", "n", "k", F.explode(starts).alias("start"))


def _windows(texts: DataFrame, places: DataFrame, sizes: list[int]) -> DataFrame:
    """text_hash, text_check, n, start, shingles, numbered, plain and bits of the windows at ``places``."""
    per_text = places.groupBy(*TEXT).agg(F.collect_set(F.struct("n", "k", "start")).alias("places"))
    wanted = write_shared(per_text, "texts-with-windows")
    keys = broadcast_if_small(wanted.select(*TEXT), ANCHOR_ROWS)
    # Copies are combined before the shuffle.
    held = texts.join(keys, TEXT, "left_semi").dropDuplicates(TEXT).join(wanted, TEXT)
    held = held.select(*TEXT, "places", _words(F.col("text")).alias("words"))
    for k in sizes:
        held = held.withColumn(f"of_{k}", _shingles(F.col("words"), k))
    cut = held.select(*TEXT, *[f"of_{k}" for k in sizes], F.explode("places").alias("p"))
    length = F.col("p.n") - F.col("p.k") + 1
    shingles = F.coalesce(*[F.when(F.col("p.k") == k, F.slice(f"of_{k}", F.col("p.start") + 1, length)) for k in sizes])
    cut = write_shared(cut.select(*TEXT, "p.n", "p.start", shingles.alias("shingles")), "windows")
    cut = _with_numbered(cut.withColumn("plain", _plain(F.col("shingles"))), "shingles", "numbered")
    return write_shared(cut.withColumn("bits", _simhash(F.col("shingles"))), "window-fingerprints")


def contaminated_texts(
    texts: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS
) -> DataFrame:
    """text_hash, text_check, item_id, start (word), similarity and distance of each text's best
    window for each item it holds, written; ``texts`` has text and its names."""
    items = benchmark_items(benchmark)
    items = _with_numbered(items, "shingles", "numbered").withColumns(
        {"item": F.monotonically_increasing_id(), "bits": _simhash(F.col("shingles")), "plain": _plain(F.col("shingles"))}
    )
    items = write_shared(items, "benchmark-items")
    # At most SHINGLE values.
    sizes = sorted(r[0] for r in items.select("k").distinct().collect()) or [SHINGLE]
    places = write_shared(_laid(texts, items, sizes, percent), "window-places")
    windows = _windows(texts, places, sizes)
    sought = write_shared(places.drop("k").join(windows, [*TEXT, "n", "start"]), "windows-and-items")
    ours = items.select(
        "item", "item_id", F.col("bits").alias("item_bits"), F.col("numbered").alias("item_numbered"), F.col("plain").alias("item_plain")
    )
    ours = broadcast_if_small(ours)
    # Block -1 is common to all pairs: those that fingerprints can't judge meet there.
    every = F.array(F.struct(F.lit(-1).alias("block"), F.lit(0).cast("long").alias("value")))

    def met(side: DataFrame, plain: str, bits: str, out: str) -> DataFrame:
        common = F.when(F.col(plain), F.slice(every, 1, 0)).otherwise(every)
        return side.withColumn(out, F.explode(F.concat(common, _blocks(F.col(bits), radius))))

    left = sought.join(ours.select("item", "item_plain"), "item")
    left = met(left.withColumn("both", F.col("plain") & F.col("item_plain")), "both", "bits", "b").select(
        *TEXT, "item", "n", "start", "bits", "numbered", "both", "b.block", "b.value"
    )
    right = items.select("item", "plain", "bits").withColumn("never", F.lit(False))
    right = met(right, "never", "bits", "c").select("item", F.col("c.block").alias("block"), F.col("c.value").alias("value"))
    pairs = left.join(broadcast_if_small(write_shared(right, "item-blocks"), ANCHOR_ROWS), ["item", "block", "value"])
    pairs = pairs.join(ours, "item").withColumn("distance", _distance(F.col("bits"), F.col("item_bits")))
    # Each pair is verified once, however many blocks agree.
    once = F.when(
        F.col("both"), (F.col("distance") <= radius) & (F.col("block") == _first_block(F.col("bits"), F.col("item_bits"), radius))
    ).otherwise(F.col("block") == -1)
    near = (
        pairs.filter(once)
        .withColumn("similarity", _similarity(F.col("numbered"), F.col("item_numbered")))
        .filter(F.col("similarity") * 100 >= percent)
    )
    best = F.struct("similarity", -F.col("start"), -F.col("distance"))
    found = near.groupBy(*TEXT, "item").agg(
        F.max_by(F.struct("item_id", "start", "similarity", "distance"), best).alias("m")
    )
    return write_shared(found.select(*TEXT, "m.*"), "contaminated-texts")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS
) -> DataFrame:
    """doc_id, text_hash, item_id, start (word), similarity and distance of each document's best
    window for each item it holds, from ``docs`` (doc_id, text) and ``benchmark`` (item_id, text)."""
    found = contaminated_texts(_named(docs), benchmark, percent, radius)
    keys = broadcast_if_small(found.select(*TEXT).distinct(), ANCHOR_ROWS)
    held = _named(docs, "doc_id").drop("text").join(keys, TEXT, "left_semi").distinct()
    return held.join(found, TEXT).select("doc_id", "text_hash", "item_id", "start", "similarity", "distance")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns are kept."""
    found = contaminated_texts(_named(docs), benchmark)
    held = found.select(*[F.col(c).alias(f"_{c}_") for c in TEXT]).distinct()
    held = broadcast_if_small(write_shared(held, "contaminated"), ANCHOR_ROWS)
    here = (F.xxhash64("text") == F.col("_text_hash_")) & (F.xxhash64(F.lit(1), "text") == F.col("_text_check_"))
    return docs.join(held, here, "left_anti")
