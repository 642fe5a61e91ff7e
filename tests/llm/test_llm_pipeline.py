"""The pipeline's stages against plain Python, and the queries."""

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import connect, differences
from ratepanel.llm.queries import QUERIES, SQL
from test_llm_operators import base_counts, near_groups

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(SQL) <= set(oracle_sql())


def test_queries_equal_their_sql(spark):
    database = connect(SF)
    for name in SQL:
        assert differences(spark, database, name, SF) is None


def test_pipeline_keeps_what_each_stage_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "byte_bpe"]
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in rows.select("doc_id", "text").collect()}
        out = stage(spark, rows, SF).cache()
        if name == "byte_bpe":
            assert {r.doc_id for r in out.collect()} == set(before)
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_rules":
            assert not any(base_counts(t)[5] for t in after.values())
        elif name == "minhash_near_dedup":
            assert set(after) == {i for i, v in near_groups(before.items()).items() if v[2]}
        elif name == "secret_scan":
            assert set(after) == set(before)
        assert set(after) <= set(before)
        rows = out
    done = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in done.select("doc_id").collect()} == set(before)


def test_native_operators_run_no_python(spark):
    for name in ("op3_feistel_sharding", "op6_secret_scan", "op7_chat_format"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(p in plan for p in ("Python", "Pandas", "Arrow"))
