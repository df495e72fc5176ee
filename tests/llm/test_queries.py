"""The registered queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import toxicity
from quarry.llm.queries import ORACLES, QUERIES
from quarry.llm.scratch import table, written
from tests.conftest import SF_SMALL
from tests.oracle_check import TABLES, compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLES[name], con)
    assert res["status"] == "OK", res


def test_names():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
    assert [s[0] for s in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "ngram_join", "source_mix", "piece_bpe"]


def test_pipeline_stages(spark):
    raw = table(spark, SF_SMALL, "documents")
    docs, seen = raw, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        seen[name] = docs
    for name in list(seen)[:-1]:
        assert seen[name].columns == raw.columns
    first = seen["quality_rules"]
    assert 0 < first.count() < raw.count() and first.join(raw, ["doc_id", "text"], "left_anti").count() == 0
    from quarry.llm.ngram_join import join_components
    left = seen["ngram_join"]
    assert join_components(left).where("component_id != doc_id").count() == 0
    want = join_components(seen["toxicity"]).where("component_id = doc_id").select("doc_id")
    assert sorted(want.collect()) == sorted(left.select("doc_id").collect())
    mixed = seen["source_mix"]
    assert mixed.join(left, "doc_id", "left_anti").count() == 0
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and docs.count() == mixed.count()
    empty = raw.where("false")
    for name, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, SF_SMALL), f"test-empty-{name}")
    assert empty.count() == 0
