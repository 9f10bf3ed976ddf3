from collections import Counter

import pytest

from tidemart.llm.sharding import bounded_walk, even_room, ring_points, shard_documents


def _check(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_balanced_gapless_with_nulls_ties_and_repeats(frame, hot_rows):
    rows = [(i, f"text {i % 7}") for i in range(200)] + [(None, None)] * 90 + [(3, "x")] * 60 + [(5, ""), (None, "y" * 9000)]
    docs = frame(rows)
    out = shard_documents(docs, 7, virtual_nodes=8, hot_rows=hot_rows)
    assert set(out.columns) == {*docs.columns, "slot"}
    got = out.collect()
    _check(got, 7)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert {r["note"] for r in got} == {"kept"}


def test_shards_and_slots_depend_on_the_rows_alone(frame):
    rows = [(i, f"text {i % 7}") for i in range(300)] + [(3, "x")] * 60 + [(3, "y")] * 40 + [(None, None)] * 30
    docs = frame(rows)
    dealt_anew = docs.repartition(5, "text")

    def placed(df, hot_rows):
        out = shard_documents(df, 7, virtual_nodes=4, hot_rows=hot_rows)
        return Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in out.collect())

    want = placed(docs, 1_000_000)
    assert placed(dealt_anew, 1_000_000) == want
    assert all(placed(df, hot) == want for df in (docs, dealt_anew) for hot in (4, 25))


def _naive(rows, shards, virtual_nodes):
    """Single rows walk: each goes to the first point clockwise whose shard has room."""
    points = ring_points(shards, virtual_nodes)
    room, arcs = even_room(len(rows), shards), {}
    for doc_id, place, at in rows:
        arc = next((i for i, (p, _) in enumerate(points) if p >= place), 0)
        arcs.setdefault(arc, []).append((at, place, doc_id))
    left, found, used = {a: sorted(r) for a, r in arcs.items()}, {}, [0] * shards
    for step in range(len(points)):
        for arc in sorted(left):
            shard = points[(arc + step) % len(points)][1]
            while left[arc] and used[shard] < room[shard]:
                found[left[arc].pop(0)[2]] = (shard, used[shard])
                used[shard] += 1
    return found


@pytest.mark.parametrize("shards", [1, 6, 24])
def test_equals_a_walk_of_single_rows(frame, shards):
    docs = frame([(i, f"text {i % 9}") for i in range(700)])
    hashed = docs.selectExpr("doc_id", "xxhash64(doc_id) place", "xxhash64(xxhash64(doc_id)) at").collect()
    want = _naive([tuple(r) for r in hashed], shards, 8)
    got = shard_documents(docs, shards, virtual_nodes=8).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want


def test_empty_table(frame):
    assert shard_documents(frame([]), 4).collect() == []


def test_reruns_agree_and_growth_moves_few(frame):
    docs = frame([(i, str(i)) for i in range(3000)])
    placed = [{r["doc_id"]: r["shard"] for r in shard_documents(docs, n).collect()} for n in (12, 12, 13)]
    assert placed[0] == placed[1]
    moved = sum(placed[0][i] != placed[2][i] for i in placed[0]) / 3000
    # One of 13 shards is new; the overflow moves some more, a plain modulus would move 12 of 13.
    assert moved < 0.35


def test_walk_fills_every_shard_and_loses_nothing():
    points = ring_points(5, 16)
    owners = [s for _, s in points]
    loads = [(i * 37) % 11 for i in range(len(points))]
    loads[3] = 500
    room = even_room(sum(loads), 5)
    cuts = bounded_walk(loads, owners, room)
    taken = Counter()
    for load, cut in zip(loads, cuts):
        ends = [c[0] for c in cut[1:]] + [load] if cut else []
        for (first, shard, _), end in zip(cut, ends):
            taken[shard] += end - first
    assert [taken[s] for s in range(5)] == room
