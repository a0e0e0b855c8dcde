"""Each stage against brute force on the smallest tables."""

import re

import corpus_pipeline as p

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _name, stage in p.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        sizes.append(docs.count())
        if stage is p.exact_stage:
            keep = {}
            for r in before.collect():
                t = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
                keep[t] = min(keep.get(t, r.doc_id), r.doc_id)
            assert sorted(keep.values()) == sorted(r.doc_id for r in docs.collect())
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] > 0
    assert p.STAGES[-1][1](spark, docs, SF).count() == sizes[-1]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _name, stage in p.STAGES:
        assert stage(spark, docs, SF).count() == 0
