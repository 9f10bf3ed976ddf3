import hashlib
import math
import random
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tidemart.llm import fingerprints as fp


def _bag(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def _hash(value, seed=42):
    data = value.encode() if isinstance(value, str) else (value & (2**64 - 1)).to_bytes(8, "little")
    return xxhash.xxh64_intdigest(data, seed)


def _samples(text):
    """The winning (term, t) of each bin, drawn one by one."""
    best = {}
    w = (text or "").lower().split()
    for term, weight in _bag(text).items():
        seed = 42
        for word in term if len(w) >= 5 else w:
            seed = _hash(_hash(word), seed)
        x = seed

        def uniform(salt):
            return ((xxhash.xxh64_intdigest(salt.to_bytes(4, "little"), _hash(x)) >> 11) + 0.5) * 2.0**-53

        r, b = -math.log(uniform(1) * uniform(2)), uniform(5)
        t = math.floor(math.log(weight) / r + b)
        value = math.log(-math.log(uniform(3) * uniform(4))) - r * (t + 1 - b)
        best[x >> 58] = min(best.get(x >> 58, (math.inf, 0, 0)), (value, x, t))
    return {k: v[1:] for k, v in best.items()}


def _likeness(a, b):
    bins = a.keys() | b.keys()
    return sum(a.get(k) == b.get(k) for k in bins) / len(bins) if bins else 1.0


def _texts(prose):
    rnd = random.Random(5)
    texts = [prose(n, n) for n in (1, 3, 4, 5, 6, 40, 200, 900)]
    texts += [" ".join([prose(7, 70 + i)] * rnd.randint(2, 9) + [prose(60, i)]) for i in range(6)]
    return texts + ["", " \n", "Same Words here", "same words HERE"]


def test_samples_equal_brute_force(spark, frame, prose):
    texts = _texts(prose)
    rows = fp.fingerprinted(frame(list(enumerate(texts)) + [(99, None)]), "text", "samples")
    got = {r["doc_id"]: r["samples"] for r in rows.select("doc_id", "samples").collect()}
    assert got[99] == []
    for i, text in enumerate(texts):
        want = _samples(text)
        assert [x >> 16 for x in got[i]] == sorted(want)
        assert all(0 < (x & 0xFFFF) <= 0xFFFF for x in got[i])
    # Samples are equal where the drawn term and t are.
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = ({s >> 16: s for s in got[k]} for k in (i, j))
            p, q = _samples(a), _samples(b)
            assert all((x[k] == y[k]) == (p[k] == q[k]) for k in p.keys() & q.keys())
    assert got[len(texts) - 1] == got[len(texts) - 2]


def test_collisions_estimate_generalised_jaccard(spark, frame):
    """Over many pairs of bags with repeated terms the mean error is near none."""
    rnd = random.Random(8)
    pairs = []
    for i in range(150):
        lines = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(5)) for _ in range(90)]
        keep = rnd.random()
        side = [[line for line in lines for _ in range(rnd.choice([1, 1, 2, 4])) if rnd.random() < keep] for _ in range(2)]
        pairs.append((i, "\n".join(side[0]), "\n".join(side[1])))
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    df = fp.fingerprinted(fp.fingerprinted(df, "a", "x"), "b", "y").select("i", fp.likeness(F.col("x"), F.col("y")).alias("s"))
    errors = []
    for i, s in df.collect():
        a, b = _bag(pairs[i][1]), _bag(pairs[i][2])
        errors.append(s - sum((a & b).values()) / max(sum((a | b).values()), 1))
    assert abs(sum(errors) / len(errors)) < 0.015
    assert math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.07


def test_compared_equals_brute_force(spark, frame, prose):
    texts = _texts(prose)
    texts += [texts[6], texts[7] + " more", "é" * 9, "\U0001f600 b \U0001f600 d"]
    rows = [(10 * i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[5]), (33, None), (44, texts[6]), (44, texts[6]), (44, texts[6]), (44, texts[7])]
    got = fp.compared(frame(rows)).collect()
    assert len(got) == len(rows)
    # Descending ids, nulls last; the order of different texts with one id is that of their hashes.
    for seven_first in (True, False):
        tied = sorted([t or "" for i, t in rows if i == 44], key=lambda t: (t != texts[7]) == seven_first)
        order = [(i, t or "") for i, t in rows if i is not None and i != 44] + [(44, t) for t in tied]
        order = sorted(order, key=lambda r: -r[0]) + [(None, texts[5])]
        want = []
        for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
            half = len(t) // 2
            edited = t[: len(t) - half] + following[:half]
            a, b = _samples(t), _samples(edited)
            near = _likeness(a, b), _likeness(a, _samples(following))
            want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *(round(v, 12) for v in near)))
        have = [
            (r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in got
        ]
        if sorted(have, key=repr) == sorted(want, key=repr):
            break
    else:
        raise AssertionError("no order of equal ids gives these rows")
    prints = {}
    for r in got:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[44] == prints[60] | prints[70] and prints[0] != prints[10]


def test_single_and_no_documents(spark, frame):
    assert fp.compared(frame([])).collect() == []
    for text in ("only one text", None):
        (row,) = fp.compared(frame([(1, text)])).collect()
        assert row["near_next"] == 1.0 and row["n_chars"] == len(text or "")


def test_very_long_texts(spark, frame, prose):
    long = prose(120_000, 3)
    (one, two) = fp.compared(frame([(1, long), (2, long + " " + prose(90, 4))])).orderBy("doc_id").collect()
    assert one["near_next"] > 0.9 and two["near_next"] > 0.9 and len(one["fingerprint"]) == 6 * fp.BINS


def test_native(spark, frame, prose, plan_of):
    plan = plan_of(fp.compared(frame([(1, prose(30, 1)), (2, prose(30, 2))])))
    assert "EvalPython" not in plan and "MapIn" not in plan and "CartesianProduct" not in plan
