"""The corpus pipeline: each stage on what the one before kept."""

import odd
from test_decontaminate import best
from test_simhash import expected

import corpus_pipeline
from ledger.llm import mixing, sharding

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs, tmp_path):
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, kept[-1], SF).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return kept


def judge(spark, docs, kept):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(((r.doc_id, r.text) for r in kept[1].collect()), key=str) == sorted(lettered, key=str)
    firsts = {w[2] for w in expected(lettered)}
    assert sorted((r.doc_id for r in kept[2].collect()), key=str) == sorted(firsts, key=str)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [(r.doc_id, r.text) for r in kept[2].collect() if not any(best(r.text, i) >= 0.8 for i in items)]
    assert sorted(((r.doc_id, r.text) for r in kept[3].collect()), key=str) == sorted(clean, key=str)
    plan = {r.doc_id: (r.taken, r["size"]) for r in mixing.plan_mix(kept[3]).collect()}
    copies = {}
    for r in kept[4].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert all(copies.get(d, 0) * size == taken for d, (taken, size) in plan.items())
    assert kept[5].count() == kept[4].count()
    want = {r.doc_id: r.shard for r in sharding.plan_shards(kept[4]).collect()}
    assert all(r[-1] == want[r.doc_id] for r in kept[5].collect())
    assert all(k.columns == docs.columns for k in kept[:5])


def test_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = run_stages(spark, docs, tmp_path)
    judge(spark, docs, kept)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, kept[-1].collect()))


def test_odd_rows(spark, tmp_path):
    docs = odd.documents(spark)
    judge(spark, docs, run_stages(spark, docs, tmp_path))


def test_empty(spark, tmp_path):
    docs = odd.documents(spark).limit(0)
    assert [k.count() for k in run_stages(spark, docs, tmp_path)] == [0] * 6
