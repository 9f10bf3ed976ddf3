"""Exact n-gram Jaccard self-join by a token-group matrix.

Texts with equal shingle sets are one class. Classes are partitioned into small groups
of similar ones, and the matrix stores the union of each group's tokens as (token,
group) rows. A group can hold a partner of a query only if enough of the query's tokens
are in its union; only pairs of groups that pass are opened, and inside an opened pair
the bound is taken again for each query against the full union before its members are
compared.

* **Leading tokens.** The matrix holds each class's leading tokens in one global order:
  of two sets of similarity t, both leading parts of n - ceil(t n) + L tokens share at
  least L (L <= ceil(t n)). So group pairs that share fewer than L tokens of the matrix
  are not opened, and nothing is missed, whatever the order.
* **Order.** Tokens are ordered by hash, but those found in many documents come last, so
  that a passage shared by many texts doesn't bring them all together. Counts are exact
  over all documents, for tokens in the first ``COUNTED`` of the hash range. The list of
  frequent tokens is broadcast; the count that makes a token frequent is the lowest
  power of two, from ``FREQUENT`` up, for which the list has at most ``LIST_ROWS`` rows
  (8 MB). It only sets the order, never the result.
* **Groups.** A class goes to the group of its most common shared leading token and its
  size range, cut by hash into groups of about ``GROUP_ROWS``: no group grows with the data.
* **Two rounds.** Many near copies of one text make many groups that all meet. So each group is
  first opened with itself and with one hub group per token, a number of pairs that grows as the
  matrix does. Then each group is cut in two, its largest component that reaches into other groups
  and the rest, and parts of one component are not opened with each other. All other pairs
  that pass are, so no link between components is missed.
* **Opening.** Set comparisons run in numpy inside tasks, one pair of groups at a time,
  and give a spanning forest of the links found there instead of all of them. Texts of
  opened groups are read again rather than stored.

Defined results: texts without words (null, empty) have size 0 and are linked with
nothing; null ids are possible, a component's id is the smallest non-null one; repeated
rows are equal texts; no rows give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import textbytes
from tidemart.llm.common import small
from tidemart.llm.components import components
from tidemart.session import write_shared

COUNTED = 0.4
FREQUENT = 16
LIST_ROWS = 1 << 20
GROUP_ROWS = 128
LEADING_MATCHES = 3
FLUSH_TOKENS = 1 << 18
KEY = ["key_a", "key_b", "n"]


def _limit() -> np.uint64:
    return np.uint64(int(COUNTED * 2**64))


def _sets(texts: textbytes.Texts, k: int) -> list[np.ndarray]:
    return list(textbytes.shingle_sets(textbytes.words_of(texts), k))


def frequent_tokens(docs: DataFrame, k: int) -> np.ndarray:
    """Sorted hashes of the tokens that come last in the order."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = int(_limit()) // parts + 1

    def packed(tokens: list[np.ndarray]) -> pa.RecordBatch:
        token, count = np.unique(np.concatenate(tokens), return_counts=True)
        part = (token // np.uint64(width)).astype(np.int32)
        at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
        ends = np.r_[at[1:], len(part)] if len(part) else at
        return pa.RecordBatch.from_arrays(
            [
                pa.array(part[at], pa.int32()),
                pa.array([token[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()),
                pa.array([count[a:b].astype(np.uint32).tobytes() for a, b in zip(at, ends)], pa.binary()),
            ],
            ["part", "tokens", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, _limit()
        for batch in batches:
            for texts in textbytes.texts_of(batch.column(0)):
                for s in _sets(texts, k):
                    held.append(s[: np.searchsorted(s, limit)])
                    size += len(held[-1])
                if size > FLUSH_TOKENS:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    def merge(pdf):
        import pandas as pd

        token = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["tokens"]])
        n = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["counts"]])
        order = np.argsort(token, kind="stable")
        token, n = token[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        total = np.add.reduceat(n, first)
        keep = total > FREQUENT
        return pd.DataFrame({"token": token[first][keep].view(np.int64), "n": total[keep]})

    counts = docs.select("text").mapInArrow(count, "part int, tokens binary, counts binary")
    counts = write_shared(counts.groupBy("part").applyInPandas(merge, "token long, n long"), "token-counts")
    # One row per power of two.
    sizes = counts.groupBy(F.ceil(F.log2("n")).cast("int").alias("p")).count().collect()
    power, left = int(math.log2(FREQUENT)), sum(r["count"] for r in sizes)
    while left > LIST_ROWS:
        power += 1
        left -= sum(r["count"] for r in sizes if r["p"] == power)
    # At most LIST_ROWS longs.
    rows = counts.filter(F.col("n") > 2**power).select("token").toArrow().column(0).to_numpy()
    return np.sort(rows.view(np.uint64))


def _leading(s: np.ndarray, frequent: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` tokens of a sorted set, frequent ones last."""
    if not len(frequent):
        return s[:size]
    counted = s[: np.searchsorted(s, _limit())]
    at = np.minimum(np.searchsorted(frequent, counted), len(frequent) - 1)
    late = frequent[at] == counted
    if not late.any():
        return s[:size]
    return np.concatenate([counted[~late], s[len(counted) :], counted[late]])[:size]


def smallest_size(percent: int) -> int:
    """The smallest set that can be similar to a different one."""
    return -(-percent // max(1, 100 - percent))


def leading_tokens(docs: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, text_hash, n and fingerprint of every document's set, and its leading tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    least = smallest_size(percent)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        for batch in batches:
            for texts in textbytes.texts_of(batch.column(2)):
                sets = _sets(texts, k)
                n = np.array([len(s) for s in sets], np.int64)
                keys = _fingerprints(sets)
                cut = n - -(-percent * n // 100) + LEADING_MATCHES
                rows = [_leading(s, late, m) if len(s) >= least else s[:0] for s, m in zip(sets, cut.tolist())]
                ends = np.cumsum([0, *map(len, rows)])
                part = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(n),
                        pa.array(keys[0]),
                        pa.array(keys[1]),
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(np.concatenate(rows).view(np.int64))
                        ),
                    ],
                    ["doc_id", "text_hash", "n", "key_a", "key_b", "lead"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        lead, f"doc_id {kind}, text_hash long, n long, key_a long, key_b long, lead array<long>"
    )


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set."""
    out = np.zeros((2, len(sets)), np.uint64)
    if sets:
        flat = np.concatenate(sets)
        sums = np.zeros(len(flat) + 1, np.uint64)
        ends = np.cumsum([0, *map(len, sets)])
        for i, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            np.cumsum(textbytes.mixed(flat + np.uint64(salt)), out=sums[1:])
            out[i] = sums[ends[1:]] - sums[ends[:-1]]
    return out[0].view(np.int64), out[1].view(np.int64)


def _near(a: str, b: str, percent: int) -> Column:
    """Whether sizes of ``low`` to ``high`` on two sides leave room for similar sets."""
    return (F.col(f"high_{a}") * 100 >= F.col(f"low_{b}") * percent) & (
        F.col(f"high_{b}") * 100 >= F.col(f"low_{a}") * percent
    )


def _sides(matrix: DataFrame, columns: list[str], side: str) -> DataFrame:
    return matrix.select("token", *[F.col(c).alias(f"{c}_{side}") for c in columns])


def token_groups(nodes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The shared leading tokens (rid, n, token) and the groups (rid, n, gid)."""
    tokens = nodes.select("rid", "n", F.explode("lead").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    rows = write_shared(tokens.join(shared, "token"), "shared-tokens")
    width = math.log(100 / percent) if percent < 100 else 1.0
    homes = rows.groupBy("rid", "n").agg(F.max(F.struct("df", "token")).alias("home"))
    homes = write_shared(
        homes.select("rid", "n", F.col("home.token").alias("home"), F.floor(F.log("n") / width).alias("range")),
        "token-homes",
    )
    # Only homes of more than one group are joined, so that a large one is not brought together.
    sizes = homes.groupBy("home", "range").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("parts")).filter("parts > 1")
    part = F.pmod(F.xxhash64("rid"), F.coalesce("parts", F.lit(1)))
    groups = homes.join(small(write_shared(sizes, "large-homes")), ["home", "range"], "left").select(
        "rid", "n", F.xxhash64("home", "range", part).alias("gid")
    )
    return rows, write_shared(groups, "token-groups")


def _matrix(rows: DataFrame, groups: DataFrame, *group: str) -> DataFrame:
    """The tokens of each group with the sizes of the sets that hold them."""
    return (
        rows.select("rid", "token")
        .join(groups, "rid")
        .groupBy("token", *group)
        .agg(F.min("n").alias("low"), F.max("n").alias("high"))
    )


def first_pairs(rows: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups (ga, gb) to open first, ga <= gb: each group with itself, and with the
    smallest group id of its tokens where they share enough such tokens. They are as many as
    the matrix has rows at most."""
    matrix = write_shared(_matrix(rows, groups, "gid"), "token-group-matrix")
    least = F.min(F.struct("gid", "low", "high")).alias("least")
    hubs = matrix.groupBy("token").agg(least, F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    hubs = write_shared(
        hubs.select("token", *[F.col(f"least.{c}").alias(f"{c}_a") for c in ("gid", "low", "high")]), "token-hubs"
    )
    met = (
        hubs.join(_sides(matrix, ["gid", "low", "high"], "b"), "token")
        .filter((F.col("gid_a") < F.col("gid_b")) & _near("a", "b", percent))
        .groupBy(F.col("gid_a").alias("ga"), F.col("gid_b").alias("gb"))
        .agg(F.count(F.lit(1)).alias("met"))
        .filter(F.col("met") >= LEADING_MATCHES)
        .select("ga", "gb")
    )
    within = groups.groupBy("gid").count().filter("count > 1").select(F.col("gid").alias("ga"), F.col("gid").alias("gb"))
    return write_shared(met.unionByName(within), "first-pairs")


def further_pairs(
    rows: DataFrame, groups: DataFrame, linked: DataFrame, opened: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Parts of groups (rid, n, gid), and all pairs of those that may hold a link still missing.

    ``linked`` (rid, comp) are the classes linked so far, ``opened`` the pairs already opened.
    Of each token, the parts of the component with most of them need not meet each other.
    """
    known = write_shared(groups.join(linked, "rid", "left"), "linked-groups")
    # Only the largest component of a group is cut off, and only if it lies in several groups.
    held = known.filter("comp IS NOT NULL").groupBy("gid", "comp").agg(F.count(F.lit(1)).alias("held"))
    wide = held.groupBy("comp").agg(F.count(F.lit(1)).alias("over")).filter("over > 1").select("comp")
    largest = held.join(small(write_shared(wide, "wide-components")), "comp", "left_semi")
    largest = largest.groupBy("gid").agg(F.max(F.struct("held", "comp")).alias("largest"))
    largest = small(write_shared(largest.select("gid", F.col("largest.comp").alias("cut")), "cut-components"))
    cut = F.when(F.col("comp") == F.col("cut"), F.col("comp"))
    parts = known.join(largest, "gid", "left").select("rid", "n", "gid", cut.alias("comp"))
    parts = write_shared(parts.withColumn("part", F.xxhash64("gid", "comp")), "group-parts")
    matrix = write_shared(_matrix(rows, parts, "part", "gid", "comp"), "part-matrix")
    sizes = matrix.filter("comp IS NOT NULL").groupBy("token", "comp").agg(F.count(F.lit(1)).alias("parts"))
    tops = sizes.groupBy("token").agg(F.max(F.struct("parts", "comp")).alias("top")).filter("top.parts > 1")
    tops = small(write_shared(tops.select("token", F.col("top.comp").alias("top")), "token-tops"))
    judged = matrix.join(tops, "token", "left").withColumn(
        "odd", ~F.coalesce(F.col("comp") == F.col("top"), F.lit(False))
    )
    columns = ["part", "gid", "comp", "low", "high", "odd"]
    a, b = _sides(judged.filter("odd"), columns, "a"), _sides(judged, columns, "b")
    apart = (F.col("gid_a") != F.col("gid_b")) & ~F.coalesce(F.col("comp_a") == F.col("comp_b"), F.lit(False))
    # Two odd ones meet twice.
    once = ~F.col("odd_b") | (F.col("gid_a") < F.col("gid_b"))
    lower = F.col("gid_a") < F.col("gid_b")

    def sided(column: str, first: Column) -> Column:
        return F.when(first, F.col(f"{column}_a")).otherwise(F.col(f"{column}_b"))

    met = (
        a.join(b, "token")
        .filter(apart & once & _near("a", "b", percent))
        .groupBy(
            sided("gid", lower).alias("ga"),
            sided("gid", ~lower).alias("gb"),
            sided("part", lower).alias("pa"),
            sided("part", ~lower).alias("pb"),
        )
        .agg(F.count(F.lit(1)).alias("met"))
        .filter(F.col("met") >= LEADING_MATCHES)
        .join(opened, ["ga", "gb"], "left_anti")
    )
    pairs = met.select(F.col("pa").alias("ga"), F.col("pb").alias("gb"))
    return parts.select("rid", "n", F.col("part").alias("gid")), write_shared(pairs, "further-pairs")


def _open_pair(
    a: list[tuple[int, np.ndarray]], b: list[tuple[int, np.ndarray]], same: bool, percent: int
) -> list[tuple[int, int]]:
    """A spanning forest of the links between (or, for one group, within) two groups."""
    roots: dict[int, int] = {}

    def root(x: int) -> int:
        while roots.setdefault(x, x) != x:
            roots[x] = x = roots[roots[x]]
        return x

    sizes = np.array([len(t) for _, t in b], np.int64)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    union, places = np.unique(np.concatenate([t for _, t in b]), return_inverse=True)
    found = []
    for i, (rid, query) in enumerate(a):
        at = np.minimum(np.searchsorted(union, query), len(union) - 1)
        at = at[union[at] == query]
        # No member can share more with the query than the group's union does.
        if 100 * len(at) < percent * len(query):
            continue
        mark = np.zeros(len(union), np.int64)
        mark[at] = 1
        both = np.add.reduceat(mark[places], starts)
        linked = 100 * both >= percent * (len(query) + sizes - both)
        if same:
            linked[: i + 1] = False
        for j in np.flatnonzero(linked):
            x, y = root(rid), root(b[j][0])
            if x != y:
                roots[x] = y
                found.append((rid, b[j][0]))
    return found


def open_pairs(docs: DataFrame, nodes: DataFrame, groups: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, v) between classes of the opened pairs of groups."""
    opened = pairs.select(F.col("ga").alias("gid")).union(pairs.select("gb")).distinct()
    needed = write_shared(
        groups.join(opened, "gid", "left_semi").select("rid", "gid").join(nodes.drop("lead"), "rid"), "opened-classes"
    )
    ids = small(needed.select(F.col("doc_id").alias("_needed_id_")).distinct())
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_needed_id_")), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbytes.texts_of(batch.column(0)):
                found = _sets(part, k)
                keys = _fingerprints(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[0]),
                        pa.array(keys[1]),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([s.tobytes() for s in found], pa.binary()),
                    ],
                    [*KEY, "tokens"],
                )

    read = texts.select("text").mapInArrow(sets, "key_a long, key_b long, n long, tokens binary")
    members = (
        read.join(small(needed.select(*KEY, "rid", "gid")), KEY).select("gid", "rid", "tokens").dropDuplicates(["rid"])
    )
    sides = pairs.select("ga", "gb", F.col("ga").alias("gid"), F.lit(0).alias("side")).unionByName(
        pairs.filter("ga != gb").select("ga", "gb", F.col("gb").alias("gid"), F.lit(1).alias("side"))
    )
    rows = write_shared(members, "opened-sets").join(small(sides), "gid").select("ga", "gb", "side", "rid", "tokens")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [])

        def done() -> pa.RecordBatch:
            same = now[0] == now[1]
            a, b = held
            links = _open_pair(a, a if same else b, same, percent) if a and (same or b) else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["u", "v"]
            )

        for batch in batches:
            ga, gb, side, rid = (batch.column(i).to_pylist() for i in range(4))
            for i, tokens in enumerate(batch.column(4)):
                if (ga[i], gb[i]) != now:
                    if now:
                        yield done()
                    now, held = (ga[i], gb[i]), ([], [])
                held[side[i]].append((rid[i], np.frombuffer(tokens.as_py(), np.uint64)))
        if now:
            yield done()

    return rows.repartition("ga", "gb").sortWithinPartitions("ga", "gb").mapInArrow(compare, "u long, v long")


def _members(stars: DataFrame) -> DataFrame:
    """rid and comp of every linked class, from the stars of ``components``."""
    linked = stars.select(F.col("u").alias("rid"), F.col("v").alias("comp"))
    return linked.unionByName(linked.select(F.col("comp").alias("rid"), "comp").distinct())


def similar_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every document with its set's fingerprint, and every set with its component.

    Returns (doc_id, text_hash, n, key_a, key_b) and (key_a, key_b, n, comp, component_id).
    """
    docs = docs.select("doc_id", "text")
    rows = write_shared(leading_tokens(docs, k, percent, frequent_tokens(docs, k)), "leading-tokens")
    nodes = rows.filter("n > 0").groupBy(*KEY).agg(F.min("doc_id").alias("doc_id"), F.first("lead").alias("lead"))
    nodes = write_shared(nodes.withColumn("rid", F.monotonically_increasing_id()), "set-classes")
    tokens, groups = token_groups(nodes, percent)
    first = first_pairs(tokens, groups, percent)
    stars = components(open_pairs(docs, nodes, groups, first, k, percent))
    parts, further = further_pairs(tokens, groups, _members(stars), first, percent)
    if not further.isEmpty():
        stars = components(stars.unionByName(open_pairs(docs, nodes, parts, further, k, percent)))
    ids, linked = nodes.select("rid", *KEY, "doc_id"), _members(stars)
    known = ids.join(linked, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    least = known.join(linked.select("rid"), "rid", "left_semi").groupBy("comp").agg(F.min("doc_id").alias("least"))
    classes = known.join(least, "comp", "left").select(
        *KEY, "comp", F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )
    return rows.drop("lead"), write_shared(classes, "set-components")


def jaccard_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Sets link at ``percent`` or more of their union; a component is named by its smallest id.
    """
    rows, classes = similar_sets(docs, k, percent)
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return (
        rows.filter("n > 0")
        .join(classes, KEY)
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionByName(empty)
    )


def _same_row(doc_id: Column, text_hash: Column, side: str) -> Column:
    return doc_id.eqNullSafe(F.col(f"_{side}_id_")) & text_hash.eqNullSafe(F.col(f"_{side}_hash_"))


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the smallest id's (null last), of its texts
    the one of smallest hash, of rows equal in both any one. Texts without words stay."""
    rows, classes = similar_sets(docs, k, percent)
    placed = rows.filter("n > 0").join(classes, KEY)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = placed.groupBy("comp").agg(F.min(rank).alias("best"))
    judged = write_shared(
        placed.groupBy("comp", "doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(best, "comp")
        .withColumn("kept", rank.eqNullSafe(F.col("best"))),
        "kept-of-each",
    )
    keys = [F.col("doc_id").alias("_of_id_"), F.col("text_hash").alias("_of_hash_")]
    here = _same_row(F.col("doc_id"), F.xxhash64("text"), "of")
    out = docs.join(small(judged.filter("not kept").select(*keys).distinct()), here, "left_anti")
    again = judged.filter("kept and rows > 1").select(*keys)
    if again.isEmpty():
        return out
    again = small(again)
    once = out.join(again, here, "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(again, here, "left_anti").unionByName(once)
