"""The whole pipeline on odd, long, clashing and no rows, against its stages and a plain encoding."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tellake.llm import packing

D = "/root/testdata/sf0.001"
CLASHING = ("__row", "a.b", "score", "lang_pred", "rejected", "row", "doc_ids", "ids", "component_id", "n_hit", "__bin", "tick`s")


@pytest.fixture
def folder(spark, tmp_path):
    base = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang", "source")
    sample = base.filter("lang is not null and length(text) > 300").orderBy("doc_id").limit(3).collect()
    odd = [(None, sample[0].text, None, None), (None, None, None, None), (800001, "", "en", ""), (800002, None, "en", "s"), (800003, " \n ", None, "s"), (800004, "12 34", "en", "s")]
    odd += [(800005, sample[1].text, sample[1].lang, "x"), (800005, sample[2].text + " and more words", sample[2].lang, "x"), (800006, (sample[1].text + " ") * (1 + 1_200_000 // len(sample[1].text)), None, "x")]
    docs = base.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string"))
    for k, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(k) if k % 2 else F.lit(f"v{k}"))
    at = f"file://{tmp_path}/sf"
    docs.write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{D}/benchmark.parquet").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_run_packs_what_the_stages_keep(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns
        assert kept.select("__row", "`a.b`", "`tick``s`").distinct().collect() == [("v0", 1, 11)]
    encode = packing.encoder(packing.vocabulary(spark, corpus_pipeline.VOCABULARY)).encode_ordinary
    want = Counter()
    for r in kept.select("doc_id", "text").collect():
        if r.text is not None:
            want[r.doc_id] += len(encode(r.text)) + 1
    got, seen = Counter(), 0
    for r in corpus_pipeline.run(spark, folder).collect():
        seen += 1
        for doc, a, b in zip(r.doc_ids, r.cu_seqlens, r.cu_seqlens[1:]):
            got[doc] += b - a
    assert got == want and seen > 0 and len(want) > 50
    ids = {r.doc_id for r in kept.collect()}
    assert {800001, 800002, 800003, 800004}.isdisjoint(ids)  # no letters: no language


def test_run_on_no_rows(spark, folder, tmp_path):
    at = f"file://{tmp_path}/none"
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{at}/{name}.parquet")
    assert corpus_pipeline.run(spark, at).count() == 0
