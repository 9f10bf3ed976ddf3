import random
import re

import pytest

from tidemart.llm import jaccard
from tidemart.llm.components import components


def _sets(rows, k):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def _brute(rows, k, percent):
    """Rows' component roots, by comparing every two."""
    sets, roots = _sets(rows, k), list(range(len(rows)))

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                roots[max(root(i), root(j))] = min(root(i), root(j))
    return sets, [root(i) for i in range(len(rows))]


def _edited(text, rnd, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture
def rows(prose):
    rnd, passage, rows = random.Random(5), prose(30, 99), []
    for base in range(12):
        text = prose(20 + 25 * base, base)
        rows += [_edited(text, rnd, e) for e in (0, 0, 1, 1, 2, 3, 4)]
    # One large group of near copies, and many texts that share a passage.
    hot = prose(120, 77)
    rows += [_edited(hot, rnd, rnd.randrange(5)) for _ in range(150)]
    rows += [f"{prose(rnd.randrange(3, 60), 1000 + i)} {passage}" for i in range(120)]
    rows += ["one", "ONE", "one  two", "One\ttwo ", "one two three four", "", "  ", None, None, "é É", "é é"]
    rows += [prose(9000, 500), _edited(prose(9000, 500), rnd, 200)]
    return list(enumerate(rows))


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
@pytest.mark.parametrize("frequent,group", [(16, 128), (2, 4)])
def test_components_equal_brute_force(frame, rows, monkeypatch, k, percent, frequent, group):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "GROUP_ROWS", group)
    sets, roots = _brute(rows, k, percent)
    got = {r["doc_id"]: r for r in jaccard.jaccard_components(frame(rows).repartition(5), k, percent).collect()}
    assert len(got) == len(rows)
    for i, (s, root) in enumerate(zip(sets, roots)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (len(s), root), rows[i]


@pytest.mark.parametrize("group", [3, 16])
def test_further_round_finds_what_the_first_leaves(frame, rows, monkeypatch, group):
    first = jaccard.first_pairs
    monkeypatch.setattr(jaccard, "GROUP_ROWS", group)
    monkeypatch.setattr(jaccard, "first_pairs", lambda *args: first(*args).filter("ga = gb"))
    _, roots = _brute(rows, 4, 85)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(frame(rows), 4, 85).collect()}
    assert got == dict(enumerate(roots))


def test_near_copies_open_few_pairs(frame, prose, monkeypatch):
    """Groups of near copies that are linked do not all meet."""
    monkeypatch.setattr(jaccard, "GROUP_ROWS", 8)
    opened, further = [], jaccard.further_pairs

    def counted(tokens, groups, linked, first, percent):
        parts, pairs = further(tokens, groups, linked, first, percent)
        n = groups.select("gid").distinct().count()
        opened.append((n, first.count(), pairs.count()))
        return parts, pairs

    monkeypatch.setattr(jaccard, "further_pairs", counted)
    rnd, hot = random.Random(3), prose(200, 41)
    rows = [(i, _edited(hot, rnd, rnd.randrange(1, 3))) for i in range(800)]
    rows += [(1000 + i, prose(60, 2000 + i)) for i in range(40)]
    _, roots = _brute(rows, 4, 85)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(frame(rows), 4, 85).collect()}
    assert got == {i: rows[root][0] for (i, _), root in zip(rows, roots)}
    (groups, first, more), = opened
    # All pairs would be about 5,000.
    assert groups > 80 and first + more < 8 * groups


def test_null_and_repeated_ids(frame, prose):
    text = prose(50, 3)
    rows = [(None, text), (9, text), (9, text), (4, text + " end"), (9, "other"), (None, "alone"), (None, None)]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame(rows), 4, 85).collect()}
    assert {(None, 47, 4), (9, 47, 4), (4, 48, 4), (9, 1, 9), (None, 1, None), (None, 0, None)} == got


def test_one_of_each_stays(frame, rows):
    docs = frame(rows + [(0, rows[0][1]), (0, rows[0][1]), (None, "gone astray"), (None, None)])
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    sets, roots = _brute(rows, 5, 80)
    want = [i for i, (s, root) in enumerate(zip(sets, roots)) if not s or root == i]
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted(want)
    assert got.count(None) == 2


def test_empty(frame):
    assert jaccard.jaccard_components(frame([]), 4, 85).collect() == []
    assert jaccard.keep_one_of_each(frame([])).collect() == []


def test_components_of_long_chain(spark):
    rnd, links = random.Random(2), [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    rnd.shuffle(links)
    links = [(a, b) if rnd.random() < 0.5 else (b, a) for a, b in links] + links[:5]
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}
