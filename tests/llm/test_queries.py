"""The registered queries on a driver folder: against DuckDB where SQL can
express them, and the pipeline stage by stage against brute force."""

import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from relayline.llm import bpe, mixing
from relayline.llm.oracle import ORACLE_SQL
from relayline.llm.queries import QUERIES
from test_joins_search import brute
from test_text_scans import secrets_of

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "conversations", "labels", "benchmark", "pages")


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if re.match(r"op\d+_", n)}
    assert "pipeline" in names and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE_SQL[name]).to_arrow_table()
    got = QUERIES[name](spark, SF).toArrow().select(want.column_names)
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    rows = [sorted(tuple(r.values()) for r in t.to_pylist()) for t in (got, want)]
    assert rows[0] == rows[1] and rows[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"pipeline"}))
def test_query_covers_every_document(spark, name):
    got = QUERIES[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(
        r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    from tokenizers import Tokenizer
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs, seen = documents, []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test-stage")
        seen.append(docs)
    for out in seen[:-1]:
        assert out.schema.simpleString() == documents.schema.simpleString()
    every, good, single, clean, mixed = ([(r.doc_id, r.text, r.source) for r in x.collect()]
                                         for x in (documents, *seen[:-1]))
    kept = {i for i, _, _ in good}
    assert {x for x in every if x[0] in kept} == set(good)
    assert all(i in kept for i, q in labels.items() if q == 1)
    components = brute(good, 5, 80)
    assert sorted(i for i, _, _ in single) == sorted(i for i, (n, c) in components.items() if n == 0 or i == c)
    text = {i: t for i, t, _ in single}
    for i, t, _ in clean:
        found = secrets_of(text[i])
        assert (t == text[i]) or found
        assert not found or t != text[i]
    plan = {r.doc_id: r.copies for r in mixing.mix(seen[2]).collect()}
    taken = {}
    for i, _, _ in mixed:
        taken[i] = taken.get(i, 0) + 1
    assert taken == {i: c for i, c in plan.items() if c}
    library, text = Tokenizer.from_file(bpe.default_path()), {i: t for i, t, _ in mixed}
    rows = seen[-1].collect()
    assert len(rows) == len(mixed)
    for r in rows:
        want = library.encode(text[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        back = library.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
