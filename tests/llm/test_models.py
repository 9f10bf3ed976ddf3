"""Held-out accuracy and edge cases of the three trained operators."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import labels as labels_of
from tidemart.llm import langid, quality, textbytes, toxicity
from tidemart.llm.common import held_out, id_remainder

ROOT = "/root/testdata/sf0.01"
EDGES = [(9001, None), (9002, ""), (9003, " \n "), (9004, "12 34 !?"), (9005, "a"), (None, "some text here."), (9006, "é" * 90_000)]


def _read(spark, table):
    return spark.read.parquet(f"{ROOT}/{table}.parquet")


def _with_edges(docs, frame):
    return docs.select("doc_id", "text", "lang").unionByName(frame(EDGES + [EDGES[4]] * 2).select("doc_id", "text", "lang"))


def test_quality(spark, frame):
    labels = _read(spark, "labels")
    noise = spark.createDataFrame([(None, 1), (3, None), (7, 0), (7, 1)], "doc_id long, quality long")
    labels = labels.select("doc_id", F.col("quality").cast("long").alias("quality")).unionByName(noise)
    docs = _with_edges(_read(spark, "documents"), frame)
    apart = held_out(F.col("doc_id"), 3, 1)
    got = quality.quality_scores(docs, labels, ~apart).cache()
    assert got.count() == docs.count()
    assert got.filter("score < 0 or score > 1 or isnan(score) or predicted != int(score >= 0.5)").count() == 0
    rows = got.filter(apart).join(_read(spark, "labels"), "doc_id").filter("doc_id < 9000").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97
    assert {r["score"] for r in got.filter("doc_id in (9001, 9002, 9003)").collect()} == {0.0}
    assert got.filter("doc_id = 9005").select("score").distinct().count() == 1


def test_quality_without_labels_or_rows(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = {r["score"] for r in quality.quality_scores(frame([(1, "a b"), (2, "c")]), none, F.lit(True)).collect()}
    assert some == {0.5}
    assert quality.quality_scores(frame([]), none, F.lit(True)).collect() == []
    model = quality.fit(np.zeros((0, quality.N_FEATURES), np.float32), np.zeros(0), 0.0)
    out = quality.score(frame([(1, "x y")]), model)
    assert sorted(out.columns) == sorted(frame([]).columns)


def test_pairs_rank_and_quantile_cuts():
    rng = np.random.default_rng(1)
    y = (rng.random(800) < 0.7).astype(int)
    x = rng.normal(0, 1, (800, quality.N_FEATURES)).astype(np.float32)
    x[:, 5] += 4 * y
    model = quality.fit(x, y, 1 - y.mean())
    p = model.scores(x, np.ones(800))
    assert np.mean((p >= 0.5) == y) > 0.93
    assert abs(np.mean(p < 0.5) - (1 - y.mean())) < 0.01


def test_toxicity(spark, frame):
    docs = _with_edges(_read(spark, "documents"), frame)
    apart = held_out(F.col("doc_id"), 5, 0)
    got = toxicity.toxicity(docs, _read(spark, "labels"), ~apart).cache()
    assert got.count() == docs.count()
    assert got.filter("score < 0 or score > 1 or isnan(score)").count() == 0
    assert got.filter("doc_id in (9001, 9002, 9003) and (score > 0 or n_sentences > 0)").count() == 0
    rows = got.join(_read(spark, "labels"), "doc_id").filter(apart).collect()
    clean = [r["score"] for r in rows if not r["toxic"]]
    assert np.mean([s < 0.5 for s in clean]) > 0.93


def test_toxic_documents_are_found_and_long_clean_ones_left(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    apart = held_out(F.col("doc_id"), 5, 0)
    got = toxicity.toxicity(docs, labels, ~apart).join(labels, "doc_id").withColumn("apart", apart).collect()
    toxic = [r["score"] >= 0.5 for r in got if r["apart"] and r["toxic"]]
    clean = [r["score"] >= 0.5 for r in got if r["apart"] and not r["toxic"]]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.02
    long = [r["score"] >= 0.5 for r in got if r["n_sentences"] > 200 and not r["toxic"]]
    assert len(long) > 10 and np.mean(long) < 0.1


def test_toxicity_equals_a_plain_pass(spark, frame):
    """Scores, sentence by sentence, from the learned weights, without numpy's batching."""
    docs, labels = _read(spark, "documents").limit(150), _read(spark, "labels")
    apart = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(_read(spark, "documents"), labels, ~apart)
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(_read(spark, "documents"), labels, ~apart).collect()}
    for r in docs.collect():
        clean = 1.0
        bag = [toxicity.sentences_of(t) for t in textbytes.texts_of(pa.array([r["text"] or ""]))][0]
        for i, start in enumerate(bag.first):
            end = bag.first[i + 1] if i + 1 < len(bag.first) else len(bag.slots)
            z = model.bias + sum(float(model.weights[s]) for s in bag.slots[start:end])
            clean *= 1 - 1 / (1 + np.exp(-z))
        assert abs(got[r["doc_id"]] - (1 - clean)) < 1e-6


def test_noisy_or_learns_words_and_finds_sentences():
    rng = np.random.default_rng(4)
    texts, y = [], []
    for i in range(400):
        words = [f"w{rng.integers(0, 60)}" for _ in range(60)]
        if i % 4 == 0:
            words[rng.integers(0, 60)] = f"bad{rng.integers(0, 3)}"
        texts.append("".join(w + (". " if j % 7 == 6 else " ") for j, w in enumerate(words)))
        y.append(int(i % 4 == 0))
    bags = [toxicity.sentences_of(t) for x in texts for t in textbytes.texts_of(pa.array([x]))]
    y = np.array(y)
    model = toxicity.fit(bags[:300], y[:300], (0.75, 0.25))
    for text, bag, label in list(zip(texts, bags, y))[300:]:
        p = model.sentence_scores(bag)
        assert (toxicity.noisy_or(p, bag.bounds)[0] >= 0.5) == label
        for i in np.flatnonzero(p >= 0.5):
            assert "bad" in text.encode()[bag.start[i] : bag.end[i]].decode()
    none = toxicity.fit(bags[:3], np.zeros(3), (1.0, 0.0))
    assert toxicity.noisy_or(none.sentence_scores(bags[0]), bags[0].bounds)[0] < 1e-9


def test_language(spark, frame):
    docs = _with_edges(_read(spark, "documents"), frame)
    apart = held_out(F.col("doc_id"), 5, 0)
    got = langid.languages(docs, docs, ~apart, per_class=300).cache()
    assert got.count() == docs.count()
    assert {r["lang_pred"] for r in got.filter("doc_id in (9001, 9002, 9003, 9004)").collect()} == {"und"}
    rows = got.filter(apart).join(_read(spark, "documents"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
    assert got.filter("score < 0 or score > 1 or isnan(score)").count() == 0


def test_language_with_little_to_learn_from(spark, frame):
    docs = frame([(1, "some text", None), (2, "mehr text", None), (3, None, None)])
    none = langid.languages(docs, docs, F.lit(True)).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    one = frame([(1, "some text", "en"), (2, "more", "en"), (3, "123", "en")])
    assert {r["doc_id"]: r["lang_pred"] for r in langid.languages(one, one, F.lit(True)).collect()} == {1: "en", 2: "en", 3: "und"}
    assert langid.languages(frame([]), frame([]), F.lit(True)).collect() == []


def test_language_scores_equal_a_plain_pass(spark, frame):
    docs = _with_edges(_read(spark, "documents").limit(60), frame)
    learned = _read(spark, "documents")
    net = langid.train(docs, learned, F.lit(True), per_class=20)
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in langid.languages(docs, learned, F.lit(True), per_class=20).collect()}
    empty = langid.train(docs.limit(0), docs.limit(0), F.lit(True))
    assert not empty.languages

    def plain(text):
        raw = text.encode()
        total = np.zeros(len(net.languages))
        for at in range(0, len(raw), langid.WINDOW):
            held = raw[at : at + langid.WINDOW]
            window = np.frombuffer(held.ljust(langid.WINDOW + 3, b" "), np.uint8)
            hidden = []
            for table in net.tables:
                sums = [sum(table[j][window[i + j]] for j in range(len(table))) for i in range(langid.WINDOW)]
                hidden.extend(np.max(sums, axis=0))
            z = np.maximum(np.array(hidden) + net.bias, 0) @ net.dense + net.offset
            total += len(held) * np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        return total / max(1, len(raw))

    for r in docs.filter("doc_id < 9000 or doc_id = 9005").dropDuplicates(["doc_id"]).limit(25).collect():
        p = plain(r["text"])
        assert abs(got[r["doc_id"], net.languages[p.argmax()]] - p.max()) < 1e-3


def test_language_of_hundreds(spark, frame):
    rows = [(i, f"word{i % 700} " * 3, f"l{i % 700:03d}") for i in range(1500)]
    got = langid.languages(frame(rows), frame(rows), F.lit(True), per_class=2).collect()
    assert len(got) == 1500 and {r["lang_pred"] for r in got} <= {r[2] for r in rows}
    assert all(0 <= r["score"] <= 1 for r in got)


def test_sample_of_many_values_is_that_of_few(spark, monkeypatch):
    rows = spark.range(600).selectExpr("id doc_id", "concat('v', id % 5) label")
    values = [f"v{i}" for i in range(5)]
    few = labels_of.bounded_sample(rows, values, 7, 3).collect()
    monkeypatch.setattr(labels_of, "FEW_VALUES", 1)
    assert sorted(labels_of.bounded_sample(rows, values, 7, 3).collect()) == sorted(few)
    assert len(few) == 35


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_runs_of_texts_split_alike(chunk):
    texts = ["one two", "", None, " three  four\tfive ", "é x", "six"]
    got = [w for t in textbytes.texts_of(pa.array(texts), chunk) for w in np.diff(textbytes.words_of(t).bounds).tolist()]
    assert got == [2, 0, 0, 3, 1, 1]


def test_held_out_rows(spark):
    import zlib

    df = spark.range(50).select(F.col("id").alias("doc_id"), id_remainder(F.col("id"), 3).alias("m"))
    assert all(r["m"] == zlib.crc32(str(r["doc_id"]).encode()) % 3 for r in df.collect())
