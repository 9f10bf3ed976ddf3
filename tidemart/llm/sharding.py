"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``virtual_nodes`` points of a 64-bit ring; a document hashes to a place
on it and goes to the owner of the next point clockwise. Loads are bounded: a full shard
takes no more, and the keys that overflow continue clockwise to the next point whose
shard has room. Here the bounds are floor and ceiling of rows / shards, so row counts
differ by at most one, while documents move between two rings only as far as the new
arcs and the overflow ask.

The ring has shards x virtual_nodes arcs. Rows are counted per arc; the walk of the
overflow runs over these counts (an arc's rows leave it in one order, so a walk is a
list of cut positions per arc) and its size depends on the two parameters alone. A row
then finds its shard from its place in its arc, whose order is by a second hash of the
place, then by text. Places come from counts per cell, a range of that hash, and row numbers
within a cell. A cell beyond ``hot_rows`` rows is cut into as many narrower ranges as its rows
ask for; rows equal in id and text, where more than ``hot_rows``, form a cell of their own,
split by salts. Neither changes the order, so shards and slots depend on the rows alone, not
on ``hot_rows`` or the files they lie in.

Defined results: a null id is placed by its text; null text has no bytes; repeated rows
are separate rows (which of several equal rows goes where is open); no rows give no
rows; the other columns are carried along unread.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import small
from tidemart.session import write_shared

VIRTUAL_NODES = 64
SLICE_BITS = 6
STEP_BITS = 10
HOT_ROWS = 1_000_000
CELL = ("arc", "piece", "part", "segment", "salt")


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 8 for the id."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(point, shard) clockwise; the points of a shard don't depend on how many others there are."""

    def point(shard: int, node: int) -> int:
        digest = hashlib.blake2b(f"shard {shard} node {node}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "big", signed=True)

    return sorted((point(s, v), s) for s in range(shards) for v in range(virtual_nodes))


def bounded_walk(loads: list[int], owners: list[int], room: list[int]) -> list[list[tuple[int, int, int]]]:
    """Cuts of each arc as (first place, shard, first slot), by walking overflow clockwise.

    Round r offers what is left of every arc to the owner of the r-th point after its own,
    arcs in ring order. An owner takes while it has room.
    """
    left, done, used = list(loads), [0] * len(loads), [0] * len(room)
    cuts: list[list[tuple[int, int, int]]] = [[] for _ in loads]
    waiting = [a for a, n in enumerate(loads) if n]
    for step in range(len(owners)):
        for arc in waiting:
            shard = owners[(arc + step) % len(owners)]
            take = min(left[arc], room[shard] - used[shard])
            if take:
                cuts[arc].append((done[arc], shard, used[shard]))
                left[arc] -= take
                done[arc] += take
                used[shard] += take
        waiting = [a for a in waiting if left[a]]
        if not waiting:
            break
    return cuts


def even_room(rows: int, shards: int) -> list[int]:
    """Row bounds that sum to ``rows`` and differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _with_arc(df: DataFrame, points: list[int]) -> DataFrame:
    """Add ``arc``: index of the first point at or after ``place`` (the first point again, past the last).

    The ring is cut into 2^STEP_BITS even steps, a table of that many rows with the number
    of points before each step and the points inside it.
    """
    edges = [(i << (64 - STEP_BITS)) - (1 << 63) for i in range(1 << STEP_BITS)]
    inside: list[list[int]] = [[] for _ in edges]
    for p in points:
        inside[(p + (1 << 63)) >> (64 - STEP_BITS)].append(p)
    table = [(i, bisect.bisect_left(points, e), inside[i]) for i, e in enumerate(edges)]
    steps = df.sparkSession.createDataFrame(table, "step int, first int, inside array<bigint>")
    step = (F.shiftright("place", 64 - STEP_BITS) + F.lit(1 << (STEP_BITS - 1))).cast("int")
    arc = F.col("first") + F.size(F.filter("inside", lambda p: p < F.col("place")))
    return (
        df.withColumn("step", step)
        .join(F.broadcast(steps), "step")
        .withColumn("arc", F.pmod(arc, F.lit(len(points))))
        .drop("step", "first", "inside")
    )


def _cells(placed: DataFrame, counted: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows with the columns of ``CELL``, and the row count of each cell.

    Ordered by ``CELL``, the cells of an arc follow the order of its rows. ``segment`` is
    2 x (keys of great numbers before the row), plus 1 for the rows of such a key.
    """
    plain = {"part": F.col("piece").cast("long"), "segment": F.lit(0), "salts": F.lit(1)}
    hot = write_shared(counted.filter(F.col("n") > hot_rows), "ring-hot-cells")
    if not hot.limit(1).count():
        cells = counted.withColumns(plain).withColumn("salt", F.lit(0).cast("long"))
        return placed.withColumns(plain).withColumn("salt", F.lit(0).cast("long")), cells
    hot = small(hot)
    equal = (
        placed.join(hot.select("arc", "piece"), ["arc", "piece"], "left_semi")
        .groupBy("arc", "piece", "at", "place", "tie")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > hot_rows)
    )
    # A cell has fewer such keys than its rows / hot_rows.
    key = F.struct("at", "place", "tie")
    great = equal.groupBy("arc", "piece").agg(
        F.array_sort(F.collect_list(F.struct(key.alias("key"), F.ceil(F.col("rows") / hot_rows).alias("salts")))).alias("great")
    )
    most = 64 - SLICE_BITS
    bits = F.least(F.ceil(F.log2(F.col("n") / hot_rows)) + 1, F.lit(most)).cast("int")
    cut = write_shared(
        hot.join(great, ["arc", "piece"], "left").select("arc", "piece", bits.alias("bits"), "great"), "ring-cuts"
    )
    none = F.array().cast("array<struct<key: struct<at: bigint, place: bigint, tie: bigint>, salts: bigint>>")
    rows = placed.join(small(cut), ["arc", "piece"], "left").withColumn("great", F.coalesce("great", none))
    own = F.filter("great", lambda g: g["key"] == key)
    before = F.size(F.filter("great", lambda g: g["key"] < key))
    rows = rows.withColumns({
        "part": F.expr(f"shiftright(at, {most} - coalesce(bits, 0))"),
        "segment": 2 * before + F.size(own),
        "salts": F.coalesce(F.get(own, F.lit(0))["salts"], F.lit(1)),
    })
    rows = rows.withColumn("salt", F.pmod("salt", "salts")).drop("bits", "great")
    return rows, rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))


def shard_documents(
    docs: DataFrame,
    shards: int,
    virtual_nodes: int = VIRTUAL_NODES,
    hot_rows: int = HOT_ROWS,
    shard: str = "shard",
    slot: str = "slot",
) -> DataFrame:
    """``docs`` (doc_id, text or doc_id, text_hash) with the shard of each row and its slot there.

    Slots are gapless from 0 in each shard. Input columns named like ``shard`` or ``slot``
    are replaced.
    """
    points = ring_points(shards, virtual_nodes)
    text = F.col("text_hash") if "text_hash" in docs.columns else F.xxhash64("text")
    keep = [c for c in docs.columns if c not in (shard, slot)]
    place = F.when(F.col("doc_id").isNull(), text).otherwise(F.xxhash64("doc_id"))
    placed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), place.alias("place"), text.alias("tie")
    )
    # An arc may span a large part of the ring or a small one; its cells are by hash.
    by_hash = F.xxhash64("place")
    placed = placed.withColumns({
        "at": by_hash,
        "piece": F.shiftright(by_hash, 64 - SLICE_BITS).cast("int"),
        "salt": F.xxhash64(F.monotonically_increasing_id()),
    })
    placed = write_shared(_with_arc(placed, [p for p, _ in points]), "ring-rows")
    # At most arcs x 2^SLICE_BITS rows.
    counted = write_shared(placed.groupBy("arc", "piece").agg(F.count(F.lit(1)).alias("n")), "ring-counts")
    # shards x virtual_nodes rows.
    loads = [0] * len(points)
    for r in counted.groupBy("arc").agg(F.sum("n").alias("n")).collect():
        loads[r["arc"]] = r["n"]
    in_cells, cells = _cells(placed, counted, hot_rows)
    upto = Window.partitionBy("arc").orderBy(*CELL[1:]).rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*CELL, F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    cuts = bounded_walk(loads, [s for _, s in points], even_room(sum(loads), shards))
    walk = docs.sparkSession.createDataFrame(
        [(arc, cut) for arc, cut in enumerate(cuts) if cut],
        "arc int, cuts array<struct<first: bigint, shard: int, slot: bigint>>",
    )
    inside = Window.partitionBy(*CELL).orderBy("at", "place", "tie")
    numbered = (
        in_cells.withColumn("nth", F.row_number().over(inside) - 1)
        .join(starts, list(CELL))
        .join(F.broadcast(walk), "arc")
        .withColumn("nth", F.col("nth") + F.col("start"))
        .withColumn("cut", F.element_at(F.filter("cuts", lambda c: c["first"] <= F.col("nth")), -1))
    )
    return numbered.select(
        *[F.col(f"row.`{c}`").alias(c) for c in keep],
        F.col("cut.shard").alias(shard),
        (F.col("cut.slot") + F.col("nth") - F.col("cut.first")).alias(slot),
    )
