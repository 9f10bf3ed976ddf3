import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemart.llm import periods


def _brute(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            smaller = any(all(w[x] == w[x - p] for x in range(start + p, j)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def _repetitive(rnd):
    w, letters = [], rnd.choice([1, 2, 3, 5, 9])
    while len(w) < rnd.randint(0, 80):
        w += [rnd.randrange(letters) for _ in range(rnd.randint(1, 9))] * rnd.randint(1, 8)
        w += [rnd.randrange(letters) for _ in range(rnd.choice([0, 0, 2]))]
    return w


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    found = 0
    for _ in range(1500):
        w = _repetitive(rnd)
        got = list(zip(*(x.tolist() for x in periods.find_runs(np.array(w, np.int64)))))
        assert got == _brute(w)
        found += len(got)
    assert found > 1000


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(9, np.int64), least_periods=3)


def test_texts(spark, frame, monkeypatch):
    monkeypatch.setattr(periods, "CHUNK", 200)
    rnd = random.Random(4)
    texts = [" ".join(map(str, _repetitive(rnd))) for _ in range(60)]
    texts += ["", " \n\t", "a b a b", "\n".join(["x\ty  z"] * 9) + "\r\fé é é é é é", "A a A a A a A a"]
    rows = [*enumerate(texts), (900, None), (None, texts[3]), (3, texts[3]), (3, texts[3])]
    got = periods.periodic_runs(frame(rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, text in rows:
        w = (text or "").encode().split()
        runs = _brute(w)
        want.append((i, len(w), runs, _collapsed([x.decode() for x in w], runs)))
    assert sorted([(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got], key=repr) == sorted(want, key=repr)


def test_very_long_texts_and_no_rows(frame):
    assert periods.periodic_runs(frame([])).collect() == []
    # One word only: all earlier occurrences would be 2 * 10^10 matches.
    got = periods.periodic_runs(frame([(1, "x " * 200_000), (2, "a b c " * 50_000 + "d")])).collect()
    assert {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in got} == {1: [(0, 200_000, 1)], 2: [(0, 150_000, 3)]}
    assert {r["doc_id"]: r["collapsed"] for r in got} == {1: "x", 2: "a b c d"}


def test_planted_and_longest(spark, frame, prose):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:8]
    rows = [(i, prose(40 + i, i)) for i in ids] + [(ids[0], None), (ids[1], " "), (None, prose(9, 1))]
    texts = {(r[0], r[1]) for r in periods.planted(frame(rows)).collect()}
    for i, text in rows[: len(ids)]:
        w, g = text.split(), zlib.crc32(str(i).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        assert (i, " ".join(w[:a] + [w[a + (j - a) % p] for j in range(a, len(w))])) in texts
    assert {(ids[0], None), (ids[1], " "), (None, rows[-1][1])} <= texts
    runs = spark.createDataFrame([([(5, 8, 2), (20, 12, 3), (40, 12, 1)],), ([],)], f"runs {periods.RUNS}")
    best = [r[0] for r in runs.select(periods.longest(runs["runs"])).collect()]
    assert (best[0]["start"], -best[0]["length"], best[0]["period"]) == (20, 12, 3) and best[1] is None


def test_query_digests(spark, tmp_path, frame):
    from tidemart.llm import queries

    frame([(1, "a b c a b c a b c a b c q"), (2, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.registered()["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (got[1]["n_runs"], got[1]["start"], got[1]["length"], got[1]["period"], got[1]["exponent_milli"]) == (1, 0, 12, 3, 4000)
    assert (got[1]["runs_sha256"], got[1]["collapsed_sha256"]) == (sha("0,12,3\n"), sha("a b c q"))
    assert got[2]["n_runs"] == 0 and got[2]["start"] is None and got[2]["runs_sha256"] == got[2]["collapsed_sha256"] == sha("")
