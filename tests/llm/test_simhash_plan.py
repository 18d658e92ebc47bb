"""Joins by bucket in SimHash: never broadcast, however small Spark takes their rows to be."""

import random

import corpus_pipeline
from smishlens.llm import simhash


def by_bucket(plans):
    return [line for plan in plans for line in plan.splitlines() if "Join [segment" in line]


def test_bucket_joins_are_not_broadcast(spark, monkeypatch):
    """Index and probe rows are some forty a fingerprint, which Spark's size of an explode does not tell."""
    rng = random.Random(5)
    prints = [rng.getrandbits(63) for _ in range(40)]
    prints += [p ^ (1 << k) for k, p in enumerate(prints[:20])]
    df = simhash.shared_table(spark.createDataFrame([(p, 1) for p in prints], "fp long, n long"), "prints")
    plans, write = [], simhash.shared_table

    def kept(df, name):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return write(df, name)

    monkeypatch.setattr(simhash, "shared_table", kept)
    out = simhash.links(df)
    plans.append(out._jdf.queryExecution().sparkPlan().toString())
    assert len(by_bucket(plans)) == 4  # pivots, tops, and the pairs with and without a minor member
    assert all("SortMergeJoin" in line for line in by_bucket(plans))
    found = {(r["a"], r["b"]) for r in out.collect()}
    assert found == {tuple(sorted((p, p ^ (1 << k)))) for k, p in enumerate(prints[:20])}


def test_the_stage_of_the_pipeline_does_not_broadcast_buckets(spark, monkeypatch):
    docs = spark.createDataFrame([(k, " ".join(f"w{j * (k % 4 + 1) % 97}" for j in range(60))) for k in range(12)], "doc_id long, text string")
    plans, write = [], simhash.shared_table
    monkeypatch.setattr(simhash, "shared_table", lambda df, name: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or write(df, name))
    out = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2, 3]
    assert by_bucket(plans) and all("SortMergeJoin" in line for line in by_bucket(plans))
