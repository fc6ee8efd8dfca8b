"""The pipeline's stages against brute force, and its oracles."""

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from check_oracle import digest
from offerlens.llm import queries
from offerlens.llm.common import tokenizer_path


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = queries.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})")
    assert digest([tuple(r) for r in got.select(cols).collect()])[0] == digest(want.fetchall())[0]


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        if k == 1:
            assert after.select("doc_id").distinct().count() == after.count() < before
        docs, before = after, after.count()
        assert before > 0
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    last = spark.read.parquet(str(tmp_path / "3"))
    assert sorted(tuple(sp.encode(r.text or "")) for r in last.collect()) == sorted(tuple(r.ids) for r in docs.collect())
    assert all(r.round_trip for r in docs.collect())
