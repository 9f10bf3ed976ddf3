"""Token counts that follow edits without encoding texts again.

A text is first cut into pre-tokens, and a token never spans two of them, so counts add
up. Runs of ``LEAF`` pre-tokens are the leaves of a segment tree per document whose nodes
hold the characters and tokens below them. An edit looks up the leaf at its place, and
pre-tokens are cut anew from that leaf's start (at least ``CONTEXT`` characters before the
edit, since a cut may depend on what follows it) until a cut meets the start of a leaf
behind the edit: cutting runs from left to right and looks at nothing behind it, so from
there on all is as before. Those leaves get their new sums, and the sums above them are
updated. The total is the root.

``count_tokens`` builds the trees, stored as their leaves; ``recount`` takes them, the
texts and a table of edits, and reads only edited documents; ``count_and_redact`` does both
in one pass for edits that a pattern finds.

The vocabulary file is a parameter, read on the driver and broadcast (50,256 entries); counts
of pre-tokens are kept in each worker, at most ``KEPT`` of them.

Defined results: null and empty texts have no tokens; edits are given in characters of the
text before any of them, those beyond the text are cut to it, and one that begins before
the end of an earlier one (by start, then end) is left out; edits of unknown documents
are ignored; of documents with equal ids each takes its edits; no rows give no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how texts are cut for that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 64
CONTEXT = 4
KEPT = 200_000
BATCH_CHARS = 1 << 20

# Personal data and secrets: mail addresses, IPv4 addresses, card numbers, key ids, long hex strings.
PRIVATE = (
    r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+"
    r"|\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b|\b[0-9]{13,16}\b|\bAKIA[0-9A-Z]{16}\b|\b[0-9a-f]{32,64}\b"
)
REDACTED = "[redacted]"


class Encoder:
    """Counts the tokens of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self._coding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(pattern)
        self._known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self._known
        if len(known) > KEPT:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = len(self._coding.encode_ordinary(piece))
        return [known[p] for p in pieces]


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}


class Tree:
    """A segment tree over leaves of (characters, tokens)."""

    def __init__(self, chars, tokens) -> None:
        self.leaves = max(1, len(chars))
        self.width = 1 << (self.leaves - 1).bit_length()
        self.nodes = np.zeros((2 * self.width, 2), np.int64)
        self.nodes[self.width : self.width + len(chars), 0] = chars
        self.nodes[self.width : self.width + len(chars), 1] = tokens
        level = self.width
        while level > 1:
            self.nodes[level // 2 : level] = self.nodes[level : 2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2

    @property
    def chars(self) -> int:
        return int(self.nodes[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.nodes[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last non-empty one, past the end), and its start."""
        at = max(0, min(at, self.chars - 1))
        node, start = 1, 0
        while node < self.width:
            node *= 2
            left = int(self.nodes[node, 0])
            if at - start >= left and int(self.nodes[node + 1, 0]):
                start += left
                node += 1
        return node - self.width, start

    def leaf_chars(self, leaf: int) -> int:
        return int(self.nodes[self.width + leaf, 0])

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Replace a leaf and add the change to all nodes above it."""
        node = self.width + leaf
        change = np.array([chars, tokens]) - self.nodes[node]
        while node:
            self.nodes[node] += change
            node //= 2

    def arrays(self) -> tuple[list[int], list[int]]:
        rows = self.nodes[self.width : self.width + self.leaves]
        rows = rows[rows[:, 0] > 0]
        return rows[:, 0].tolist(), rows[:, 1].tolist()


def plant(text: str, encoder: Encoder) -> Tree:
    """The tree of a whole text."""
    pieces = encoder.cut.findall(text)
    if not pieces:
        return Tree([], [])
    first = np.arange(0, len(pieces), LEAF)
    chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tokens = np.array(encoder.counts(pieces), np.int64)
    return Tree(np.add.reduceat(chars, first), np.add.reduceat(tokens, first))


def in_order(edits, length: int) -> list[tuple[int, int, str]]:
    """Edits cut to the text, by place, without those that overlap an earlier one."""
    out, end = [], 0
    for start, stop, new in sorted(edits, key=lambda e: e[:2]):
        start, stop = min(max(start, 0), length), min(max(stop, start, 0), length)
        if start >= end or not out:
            out.append((start, stop, new))
            end = stop
    return out


def edit(text: str, tree: Tree, edits, encoder: Encoder) -> tuple[str, int, int]:
    """Apply edits to a text and its tree; returns the new text, edits applied, characters cut anew."""
    edits, read = in_order(edits, len(text)), 0
    # From right to left, so that the places of those still to come stay as they are.
    for start, stop, new in reversed(edits):
        leaf, begin = tree.find(start - CONTEXT)
        moved, length = len(new) - (stop - start), len(text)
        text = text[:start] + new + text[stop:]
        # The next leaf start behind the edit, in the new text.
        after, border = leaf + 1, begin + tree.leaf_chars(leaf)
        while after < tree.leaves and border < stop:
            border += tree.leaf_chars(after)
            after += 1
        pieces, at = [], begin
        for piece in encoder.cut.finditer(text, begin):
            while after < tree.leaves and border + moved < at:
                border += tree.leaf_chars(after)
                after += 1
            if border + moved == at and at > begin and border < length:
                break
            pieces.append(piece.group())
            at = piece.end()
        else:
            after = tree.leaves
        for gone in range(leaf + 1, after):
            tree.put(gone, 0, 0)
        tree.put(leaf, at - begin, sum(encoder.counts(pieces)))
        read += at - begin
    return text, len(edits), read


def _sent(spark: SparkSession, vocabulary: str):
    """A function that gives each worker its encoder."""
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    def encoder() -> Encoder:
        return Encoder(ranks.value)

    return encoder


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about BATCH_CHARS characters of text."""
    lengths = batch.column(column).to_pylist()
    at, size = 0, 0
    for i, text in enumerate(lengths):
        size += len(text or "")
        if size > BATCH_CHARS:
            yield batch.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text_hash, n_tokens and the tree's leaves (leaf_chars, leaf_tokens) of every row of
    ``docs`` (doc_id, text); the hash tells a tree's text among documents with one id."""
    make = _sent(docs.sparkSession, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in batches:
            for part in _parts(batch, "text"):
                trees = [plant(t or "", encoder) for t in part.column("text").to_pylist()]
                leaves = [t.arrays() for t in trees]
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array([t.tokens for t in trees], pa.int64()),
                        pa.array([x[0] for x in leaves], kind),
                        pa.array([x[1] for x in leaves], kind),
                    ],
                    ["doc_id", "text_hash", "n_tokens", "leaf_chars", "leaf_tokens"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", _text_hash(), "text").mapInArrow(
        count, f"doc_id {kind}, text_hash long, n_tokens long, leaf_chars array<long>, leaf_tokens array<long>"
    )


def recount(docs: DataFrame, trees: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text, text_hash and tree of the edited documents, with n_edits and n_reread (characters cut anew).

    ``trees`` is what ``count_tokens`` or ``recount`` gave; ``edits`` has doc_id, start, stop
    and new: the characters from start up to stop are replaced. Documents without edits are
    not read; one document's edits are handled together. Of documents with equal ids each takes
    the edits, with the tree of its own text.
    """
    make = _sent(docs.sparkSession, vocabulary)
    change = F.struct(*[F.col(c).cast("long" if c != "new" else "string").alias(c) for c in ("start", "stop", "new")])
    valid = F.col("start").isNotNull() & F.col("stop").isNotNull()
    lists = edits.filter(valid).groupBy("doc_id").agg(F.collect_list(change).alias("edits"))
    # Equal texts have equal trees; one of them serves all.
    own = trees.select("doc_id", "text_hash", "leaf_chars", "leaf_tokens").join(lists, "doc_id")
    own = own.dropDuplicates(["doc_id", "text_hash"])
    rows = docs.select("doc_id", _text_hash(), "text").join(own, ["doc_id", "text_hash"])

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in batches:
            for part in _parts(batch, "text"):
                out = []
                for row in part.to_pylist():
                    tree = Tree(row["leaf_chars"], row["leaf_tokens"])
                    listed = [(e["start"], e["stop"], e["new"] or "") for e in row["edits"]]
                    text, applied, read = edit(row["text"] or "", tree, listed, encoder)
                    chars, tokens = tree.arrays()
                    out.append([text, tree.tokens, chars, tokens, applied, read])
                kind = pa.list_(pa.int64())
                kinds = [pa.string(), pa.int64(), kind, kind, pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))],
                    ["doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", "n_edits", "n_reread"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return rows.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits").mapInArrow(
        update,
        f"doc_id {kind}, text string, n_tokens long, leaf_chars array<long>, leaf_tokens array<long>, "
        "n_edits long, n_reread long",
    ).withColumn("text_hash", _text_hash())


def count_and_redact(
    docs: DataFrame, pattern: str = PRIVATE, new: str = REDACTED, vocabulary: str = VOCABULARY
) -> DataFrame:
    """Token counts of every row of ``docs`` (doc_id, text) before and after what ``pattern`` finds
    is replaced by ``new``: doc_id, n_chars, n_tokens, n_edits, n_tokens_edited, n_reread."""
    make = _sent(docs.sparkSession, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, wanted = make(), regex.compile(pattern)
        names = ["n_chars", "n_tokens", "n_edits", "n_tokens_edited", "n_reread"]
        for batch in batches:
            for part in _parts(batch, "text"):
                out = []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    tree = plant(text, encoder)
                    before = tree.tokens
                    edits = [(*m.span(), new) for m in wanted.finditer(text)]
                    _, applied, read = edit(text, tree, edits, encoder)
                    out.append((len(text), before, applied, tree.tokens, read))
                columns = [pa.array(c, pa.int64()) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_chars long, n_tokens long, n_edits long, n_tokens_edited long, n_reread long"
    )
