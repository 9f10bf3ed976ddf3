"""The registered queries, and the pipeline, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

from tidemart.llm import oracle, queries

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in queries.registered() if n not in oracle.statements()])
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    got = queries.registered()[name](spark, ROOT)
    if name.startswith("op12_"):
        vectors = spark.read.parquet(f"{ROOT}/embeddings.parquet").count()
        assert got.groupBy("vec_id").count().filter("count = 32").count() == vectors
        return
    ids = [r["doc_id"] for r in got.collect()]
    if name.startswith("op6_"):
        assert set(ids) <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    else:
        assert sorted(ids) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


@pytest.mark.parametrize("name", list(oracle.statements()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{ROOT}/{table}.parquet')")
    result = con.execute(oracle.statements()[name])
    columns = sorted(d[0] for d in result.description)
    at = [[d[0] for d in result.description].index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
    got = queries.registered()[name](spark, ROOT)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == want


def test_registered_names():
    assert [n.split("_")[0] for n in queries.registered()] == [f"op{n}" for n in range(1, 14)]


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, ROOT)
        last = i == len(corpus_pipeline.STAGES) - 1
        assert out.columns == (columns + ["shard", "slot"] if last else columns)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > 0 and counts[2] >= counts[3] and counts[4] == counts[5]
    rows = docs.groupBy("shard").count().collect()
    assert max(r["count"] for r in rows) - min(r["count"] for r in rows) <= 1
    whole = corpus_pipeline.run(spark, ROOT)
    assert sorted(map(repr, whole.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))


def test_pipeline_without_rows(spark, frame):
    docs = frame([]).drop("shard", "note", "score")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, ROOT)
        assert docs.collect() == []


def test_pipeline_keeps_odd_rows(spark, frame, prose):
    """Nulls, empty and long texts, repeated rows and clashing columns pass every stage."""
    rows = [(1, None), (None, None), (2, ""), (3, prose(20_000, 4)), (4, "a b"), (4, "a b"), (None, prose(90, 5)), (5, prose(80, 6), "en", "s")]
    docs = frame(rows)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, ROOT)
        assert set(docs.columns) <= set(out.columns)
        # The classifier may reject what it likes; the others meet all rows.
        if i:
            docs = out
    kept = {(r["doc_id"], r["n_chars"]) for r in docs.collect()}
    assert len([r for r in docs.collect() if r["doc_id"] == 4]) <= 3
    assert kept <= {(r[0], None if r[1] is None else len(r[1])) for r in rows}
