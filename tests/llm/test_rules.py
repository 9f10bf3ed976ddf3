import re
from collections import Counter

from tidemart.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {p for i, w in enumerate(windows) if counts[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measurements_equal_brute_force(frame, prose):
    texts = [
        None, "", " \n\t ", "a", "a b c a b c", "x x x x x", "a b c d a b c", "é # ñ ö\n\né # ñ ö\nz",
        "line one\nline one\nline two\n\n\nline one", prose(60, 1), prose(40, 2) + "\n" + prose(40, 2), "A B <p> | & %% $" * 30,
        prose(20000, 3, "ab"), "😀 😀 😀 😀", "a\x0bb\x0cc a\x0bb\x0cc",
    ]
    docs = frame([(i, t) for i, t in enumerate(texts)] + [(0, None), (None, "a b c a b c")])
    got = rules.ledger(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = _brute("a b c a b c" if r["doc_id"] is None else texts[r["doc_id"]])
        assert tuple(r[m] for m in rules.MEASURES[:6]) == want


def test_policies_and_ablation(frame, prose):
    texts = [prose(80, 1), "short text", "A! " * 90, prose(60, 2).upper(), prose(60, 3), None, "# % " * 60]
    rows = rules.ledger(frame(list(enumerate(texts)))).cache()
    bits = {r["doc_id"]: r["failed"] for r in rows.collect()}
    assert bits[0] == bits[4] == 0
    assert bits[1] & rules.mask(["few_words"]) and bits[3] == rules.mask(["capitals"])
    failing = {r["doc_id"] for r in rows.filter(rules.fails(rules.POLICIES["v1"])).collect()}
    assert failing == {i for i, b in bits.items() if b}
    table = {(r["version"], r["rule"]): r for r in rules.ablation(rows).collect()}
    assert set(table) == {(v, r) for v, names in rules.POLICIES.items() for r in names}
    for (version, rule), r in table.items():
        whole, bit = rules.mask(rules.POLICIES[version]), rules.mask([rule])
        assert r["n_docs"] == len(texts)
        assert r["n_failed"] == sum(bool(b & bit) for b in bits.values())
        assert r["n_failed_alone"] == sum(b & whole == bit for b in bits.values())


def test_native_and_empty(frame, plan_of):
    assert rules.ledger(frame([])).collect() == []
    assert rules.ablation(rules.ledger(frame([]))).collect() == []
    plan = plan_of(rules.ledger(frame([(1, "a b c")])))
    assert "EvalPython" not in plan and "MapIn" not in plan and "Exchange" not in plan
