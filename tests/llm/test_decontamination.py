import re
from collections import Counter

from tidemart.llm import decontamination as de

RUN = re.compile(r"[^\W_]+")


def _bag(words, k):
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def _brute(docs, items):
    """(doc, item) -> the largest similarity of any window of the item's size."""
    out = {}
    for d, text in docs:
        words = RUN.findall((text or "").lower())
        for i, item in items:
            want = RUN.findall((item or "").lower())
            if not want or not words:
                continue
            n, k = len(want), min(5, len(want))
            bag = _bag(want, k)
            for s in range(max(1, len(words) - n + 1)):
                b = _bag(words[s : s + n], k)
                total = sum((b | bag).values())
                if total and sum((b & bag).values()) / total >= 0.8:
                    best = sum((b & bag).values()) / total
                    out[(d, i)] = max(out.get((d, i), 0), best)
    return out


def _benchmark(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")


def test_equals_brute_force(spark, frame, prose):
    items = [(i, prose(14 + 5 * i, i)) for i in range(7)]
    items += [(20, "Two words"), (21, "a b c d e a b c d e a b c d e"), (22, None), (23, ""), (24, "!"), (25, prose(14, 0))]
    texts = [
        prose(200, 100), f"{prose(30, 101)} {items[0][1]} {prose(20, 102)}", items[3][1].upper() + ".", None, "", "?!",
        f"{prose(10, 103)} {items[4][1].rsplit(' ', 1)[0]} changed", f"{items[5][1].split(' ', 2)[2]} tail",
        "it holds two words here", "a b c d e a b c d e a b c d e f", " ".join(items[6][1].split()[:12]),
        f"{items[2][1]}\n{prose(3000, 104)}\n{items[2][1]} {items[1][1]}", items[1][1].replace(" ", ", "),
        " ".join(items[4][1].split()[:20] + ["odd"] + items[4][1].split()[20:]),
    ]
    docs = list(enumerate(texts))
    got = de.contaminated(frame(docs + [(1, texts[1]), (None, texts[1])]), _benchmark(spark, items)).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got if r["doc_id"] is not None}
    want = _brute(docs, items)
    assert set(found) == set(want) and len(want) > 8
    assert all(abs(found[k] - want[k]) < 1e-12 for k in want)
    assert {r["item_id"] for r in got if r["doc_id"] is None} == {i for d, i in want if d == 1}
    clean = de.clean_documents(frame(docs + [(None, texts[1]), (0, texts[0])]), _benchmark(spark, items))
    assert clean.columns == frame([]).columns
    bad = {d for d, _ in want}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted([i for i, _ in docs if i not in bad] + [0])


def test_windows_between_alignments(spark, frame, prose):
    """The best window of an item cut at both ends and widened in the middle starts between its alignments."""
    sizes = [58, 59, 62, 66]
    items = [(i, prose(n, 300 + n)) for i, n in enumerate(sizes)]
    docs = []
    for i, item in items:
        w = item.split()
        half = len(w) // 2
        for j, ends in enumerate([("", ""), ("first", "last")]):
            inner = " ".join([ends[0], *w[1:half], "two", "odd", *w[half:-1], ends[1]])
            docs.append((10 * i + j, f"{prose(40, 400 + i)} {inner} {prose(40, 500 + i)}"))
        docs.append((10 * i + 2, f"{item} {item}"))
        docs.append((10 * i + 3, " ".join(w[2:])))
    got = de.contaminated(frame(docs), _benchmark(spark, items)).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got}
    want = _brute(docs, items)
    assert set(found) == set(want) and len(want) == len(docs)
    assert all(abs(found[k] - want[k]) < 1e-12 for k in want)


def test_repetitive_and_small_items(spark, frame, prose):
    """Bags in which one shingle weighs much: fingerprints may differ far, similarity decides."""
    items, docs = [], []
    for i in range(40):
        w = prose(2, 700 + i).split()
        # Two alternating shingles of five words nine times over, one changed; and five shingles against four.
        items.append((2 * i, " ".join((w * 7)[:13])))
        docs.append((2 * i, " ".join(w * 6 + ["odd"])))
        items.append((2 * i + 1, prose(9, 800 + i)))
        docs.append((2 * i + 1, " ".join(items[-1][1].split()[:8])))
    items.append((100, "x y " * 12))
    docs += [(100, "x y " * 11 + "odd end"), (101, "q " * 60 + "x y " * 30)]
    got = de.contaminated(frame(docs), _benchmark(spark, items)).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got}
    want = _brute(docs, items)
    assert set(found) == set(want) and len(want) >= 81
    assert all(abs(found[k] - want[k]) < 1e-12 for k in want)


def test_very_long_text(spark, frame, prose):
    item = prose(50, 1)
    docs = [(1, f"{prose(40_000, 2)} {item} {prose(40_000, 3)}"), (2, prose(60_000, 4))]
    got = de.contaminated(frame(docs), _benchmark(spark, [(7, item)])).collect()
    assert [(r["doc_id"], r["item_id"], r["start"], r["similarity"]) for r in got] == [(1, 7, 40_000, 1.0)]


def test_empty_sides(spark, frame, prose):
    some = frame([(1, prose(30, 1))])
    assert de.contaminated(frame([]), _benchmark(spark, [(1, prose(30, 1))])).collect() == []
    assert de.contaminated(some, _benchmark(spark, [])).collect() == []
    assert de.contaminated(some, _benchmark(spark, [(1, None)])).collect() == []


def test_blocks_guarantee_the_radius(spark):
    """Any two fingerprints within the radius agree in a block."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(3)
    rows = []
    for _ in range(60):
        bits = [rnd.getrandbits(64) for _ in range(2)]
        other = list(bits)
        for b in rnd.sample(range(128), de.RADIUS):
            other[b // 64] ^= 1 << (b % 64)
        signed = [[x - (1 << 64) if x >> 63 else x for x in v] for v in (bits, other)]
        rows.append(tuple(signed))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    out = df.select(
        de._distance(F.col("a"), F.col("b")).alias("d"),
        F.size(F.array_intersect(de._blocks(F.col("a"), de.RADIUS), de._blocks(F.col("b"), de.RADIUS))).alias("n"),
    ).collect()
    assert all(r["d"] == de.RADIUS and r["n"] > 0 for r in out)


def test_native(spark, frame, prose, plan_of):
    plan = plan_of(de.contaminated(frame([(1, prose(30, 1))]), _benchmark(spark, [(1, prose(30, 1))])))
    assert "EvalPython" not in plan and "MapIn" not in plan and "CartesianProduct" not in plan
