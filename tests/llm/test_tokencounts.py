import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.llm import tokencounts as tc


@pytest.fixture(scope="module")
def encoder():
    return tc.Encoder(tc.read_ranks())


def _whole(encoder, text):
    return len(encoder._coding.encode_ordinary(text))


def _applied(text, edits):
    for start, stop, new in reversed(tc.in_order(edits, len(text))):
        text = text[:start] + new + text[stop:]
    return text


_pieces = st.lists(st.sampled_from(["a", "'l", "l", " ", "  ", "\n", "9", "é", "word ", "!?", "'ve"]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(_pieces, st.lists(st.tuples(st.integers(-3, 90), st.integers(-3, 90), _pieces), max_size=5))
def test_edited_counts_equal_whole_counts(text, edits):
    encoder = _shared()
    old, tc.LEAF = tc.LEAF, 3
    try:
        tree = tc.plant(text, encoder)
        assert tree.tokens == _whole(encoder, text)
        out, _, _ = tc.edit(text, tree, edits, encoder)
    finally:
        tc.LEAF = old
    assert out == _applied(text, edits)
    assert (tree.chars, tree.tokens) == (len(out), _whole(encoder, out))


_held = []


def _shared():
    if not _held:
        _held.append(tc.Encoder(tc.read_ranks()))
    return _held[0]


def test_only_a_region_is_read_again(encoder, prose):
    text = prose(20_000, 3)
    tree = tc.plant(text, encoder)
    out, n, read = tc.edit(text, tree, [(50_000, 50_010, "changed"), (10, 12, "")], encoder)
    assert n == 2 and tree.tokens == _whole(encoder, out) and read < 3000


def test_trees_survive_tables_and_more_edits(spark, frame, encoder, prose):
    rnd = random.Random(6)
    texts = [prose(300, i) for i in range(6)] + [None, "", "  ", prose(5000, 9)]
    docs = frame(list(enumerate(texts)))
    trees = tc.count_tokens(docs)
    assert {r["doc_id"]: r["n_tokens"] for r in trees.collect()} == {i: _whole(encoder, t or "") for i, t in enumerate(texts)}
    edits = [(i, s, s + rnd.randrange(9), rnd.choice(["", "x", " new words"])) for i in (0, 3, 6, 9) for s in rnd.sample(range(900), 6)]
    more = edits + [(77, 0, 1, "unknown"), (2, None, 4, "x"), (4, 5, 9, None)]
    once = tc.recount(docs, trees, spark.createDataFrame(more, "doc_id long, start int, stop int, new string"))
    got = {r["doc_id"]: r for r in once.collect()}
    assert set(got) == {0, 3, 4, 6, 9}
    for i in (0, 3, 6, 9):
        want = _applied(texts[i] or "", [e[1:] for e in edits if e[0] == i])
        assert got[i]["text"] == want and got[i]["n_tokens"] == _whole(encoder, want)
    again = tc.recount(once, once, spark.createDataFrame([(3, 4, 6, "'ll")], "doc_id long, start int, stop int, new string"))
    row = again.first()
    assert row["n_tokens"] == _whole(encoder, row["text"])


def test_redaction(frame, encoder):
    texts = ["mail a.b@example.com now", "at 10.0.0.1, or 4111111111111111", None, "", "nothing"]
    docs = frame(list(enumerate(texts)) + [(0, texts[0]), (None, "x")])
    rows = tc.count_and_redact(docs).collect()
    assert len(rows) == 7
    got = {r["doc_id"]: r for r in rows}
    new = ["mail [redacted] now", "at [redacted], or [redacted]", "", "", "nothing"]
    for i, text in enumerate(new):
        assert got[i]["n_tokens"] == _whole(encoder, texts[i] or "")
        assert got[i]["n_tokens_edited"] == _whole(encoder, text)
    assert [got[i]["n_edits"] for i in range(5)] == [1, 2, 0, 0, 0]
    assert tc.count_and_redact(frame([])).collect() == [] and tc.count_tokens(frame([])).collect() == []


def test_documents_with_one_id_keep_their_own_trees(spark, frame):
    rows = [(1, "one two three"), (1, "a much longer text, of ten words and more."), (1, "one two three"), (2, "other")]
    trees = tc.count_tokens(frame(rows))
    edits = spark.createDataFrame([(1, 0, 3, "none at all")], "doc_id long, start int, stop int, new string")
    got = tc.recount(frame(rows), trees, edits).collect()
    want = sorted("none at all" + t[3:] for i, t in rows if i == 1)
    assert sorted(r["text"] for r in got) == want
    exact = {r["text_hash"]: r["n_tokens"] for r in tc.count_tokens(frame([(1, t) for t in want])).collect()}
    assert all(r["n_tokens"] == exact[r["text_hash"]] and sum(r["leaf_chars"]) == len(r["text"]) for r in got)
