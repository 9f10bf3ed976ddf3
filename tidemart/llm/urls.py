"""URL rules as a bit-parallel wildcard automaton.

Each rule becomes two globs over the canonical URL (lower-case host, ``#``, path): the
host itself and ``*.`` host, both followed by ``#``, the path and ``*``. Neither host nor
path can hold a ``#``, so no ``*`` of a host reaches into the path. All globs lie side by
side in one row of state bits, packed into 64-bit words: bit j says that the glob's
first j tokens match what was read. One step reads one byte of every URL of a batch at
once: states whose next token accepts the byte move on, states before a ``*`` stay
(Shift-And with self-loops), states behind a ``*`` are entered without reading. Bytes
are read as UTF-8, so any text can be matched. When all is read, the accept bits give
each URL's matching globs; the longest rule wins (of equal ones the first), and a URL
that matches none gets the default verdict.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased;
path: from there up to ``?``, ``#`` or the end. A null URL, or one without ``://``, has an empty
host and path and matches no rule. Repeated rows are judged each. No rows, no result rows.

Memory: a step holds the state of one sub-batch; URLs are sorted into sub-batches by
length, so one very long URL is read alone. The number of words grows with the rules.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
SUB_BATCH_BYTES = 1 << 20
# Between host and path, where it cannot occur.
EDGE = "#"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host followed by a path prefix (from the first ``/``); both may hold ``*``."""

    verdict: str
    pattern: str

    def globs(self) -> list[str]:
        host, slash, path = self.pattern.partition("/")
        return [f"{host}{EDGE}{slash}{path}*", f"*.{host}{EDGE}{slash}{path}*"]


RULES = (
    Rule(ALLOW, "com/"),
    Rule(BLOCK, "example.com/en/"),
    Rule(ALLOW, "www.example.com/en/"),
    Rule(BLOCK, "net/es/"),
    Rule(BLOCK, "net/fr/"),
)


@dataclass(frozen=True)
class Automaton:
    """Masks over ``words`` 64-bit words; accept[g] = (word, bit) of glob g's last state."""

    moves: np.ndarray  # [256, words]: states that may be entered by a byte
    loops: np.ndarray  # [words]: states that stay on any byte
    start: np.ndarray  # [words]
    accept: list[tuple[int, int]]

    @property
    def words(self) -> int:
        return len(self.start)


def compile_globs(globs: Sequence[str]) -> Automaton:
    """Lay the globs out one after another: a state for its start and for each literal byte.

    A ``*`` makes the state it follows loop. Runs of ``*`` are one.
    """
    literals: list[list[tuple[int, bool]]] = []
    for glob in globs:
        states = [(-1, False)]
        for byte in glob.encode():
            if byte == ord("*"):
                states[-1] = (states[-1][0], True)
            else:
                states.append((byte, False))
        literals.append(states)
    total = sum(map(len, literals))
    words = max(1, -(-total // 64))
    moves = np.zeros((256, words), np.uint64)
    loops, start = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    accept, at = [], 0
    for states in literals:
        for byte, loop in states:
            word, bit = divmod(at, 64)
            mask = np.uint64(1) << np.uint64(bit)
            if byte < 0:
                start[word] |= mask
            else:
                moves[byte, word] |= mask
            if loop:
                loops[word] |= mask
            at += 1
        accept.append(divmod(at - 1, 64))
    return Automaton(moves, loops, start, accept)


def _run(automaton: Automaton, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Final states of the strings data[starts : starts + lengths], lengths descending."""
    state = np.repeat(automaton.start[None, :], len(starts), axis=0)
    one, top = np.uint64(1), np.uint64(63)
    alive = len(starts)
    for i in range(int(lengths[0]) if len(lengths) else 0):
        while alive and lengths[alive - 1] <= i:
            alive -= 1
        now = state[:alive]
        moved = now << one
        moved[:, 1:] |= now[:, :-1] >> top
        state[:alive] = (moved & automaton.moves[data[starts[:alive] + i]]) | (now & automaton.loops)
    return state


def matching(automaton: Automaton, texts: list[bytes]) -> np.ndarray:
    """A row of booleans per text: which globs match all of it."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(-lengths, kind="stable")
    found = np.zeros((len(texts), len(automaton.accept)), bool)
    at = 0
    while at < len(order):
        size, end = 0, at
        while end < len(order) and (end == at or size + lengths[order[end]] + 8 * automaton.words <= SUB_BATCH_BYTES):
            size += lengths[order[end]] + 8 * automaton.words
            end += 1
        part = order[at:end]
        data = np.frombuffer(b"".join(texts[i] for i in part), np.uint8)
        starts = np.concatenate([[0], np.cumsum(lengths[part])[:-1]]).astype(np.int64)
        state = _run(automaton, data, starts, lengths[part])
        for g, (word, bit) in enumerate(automaton.accept):
            found[part, g] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1
        at = end
    return found


def judge_pages(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url)."""
    automaton = compile_globs([g for r in rules for g in r.globs()])
    rank = np.array([len(r.pattern) for r in rules], np.int64)
    patterns, verdicts = [r.pattern for r in rules], [r.verdict for r in rules]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            urls = [(h + EDGE + p).encode() for h, p in zip(hosts, paths)]
            hit = matching(automaton, urls).reshape(len(urls), len(patterns), 2).any(axis=2)
            score = np.where(hit, rank, -1)
            best = score.argmax(axis=1) if len(patterns) else np.zeros(len(urls), int)
            none = ~hit.any(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("host"),
                    batch.column("path"),
                    pa.array([None if n else patterns[b] for n, b in zip(none, best)], pa.string()),
                    pa.array([default if n else verdicts[b] for n, b in zip(none, best)], pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    after = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract("url", after, 1), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = pages.select(
        "page_id",
        F.translate(host, upper, lower).alias("host"),
        F.coalesce(F.regexp_extract("url", after, 2), F.lit("")).alias("path"),
    )
    kind = dict(pages.dtypes)["page_id"]
    return parts.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
