"""Language identification: unknown languages go, clean short texts stay."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tellake.llm import language_id

UNKNOWN = {
    "pl": "Wczoraj wieczorem poszliśmy na długi spacer wzdłuż rzeki, ponieważ pogoda była wyjątkowo piękna i wszyscy chcieli odpocząć po ciężkim tygodniu pracy. Dzieci zbierały kamienie, a starsi rozmawiali o tym, co wydarzyło się w mieście przez ostatnie miesiące.",
    "fi": "Eilen illalla kävelimme pitkään joen rantaa pitkin, koska sää oli poikkeuksellisen kaunis ja kaikki halusivat levätä raskaan työviikon jälkeen. Lapset keräsivät kiviä, ja vanhemmat keskustelivat siitä, mitä kaupungissa oli tapahtunut viime kuukausina.",
    "hu": "Tegnap este hosszú sétát tettünk a folyó mentén, mert az idő különösen szép volt, és mindenki pihenni szeretett volna a nehéz munkahét után. A gyerekek köveket gyűjtöttek, az idősebbek pedig arról beszélgettek, mi történt a városban az elmúlt hónapokban.",
}
D = "/root/testdata/sf0.01"


def test_unknown_languages_go_and_short_texts_stay(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    model = language_id.fit(docs)
    short = []
    for r in docs.filter("lang is not null and length(text) > 400").orderBy("doc_id").limit(200).collect():
        words = r.text.split()
        short.append((r.doc_id, " ".join(words[10:18])))
    names = list(UNKNOWN)
    rows = [(-1 - k, UNKNOWN[n]) for k, n in enumerate(names)] + short
    out = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    stay = [not out[i].rejected for i, _ in short]
    assert all(out[-1 - k].rejected for k in range(len(names))), [(n, out[-1 - k].score) for k, n in enumerate(names)]
    assert np.mean(stay) >= 0.97, np.mean(stay)


def test_centroids_are_of_many_texts():
    rng = np.random.default_rng(1)
    base = language_id.unit(rng.random((2, 50)))
    x = language_id.unit(np.concatenate([base[rng.integers(0, 2, 200)] + 0.05 * rng.random((200, 50)), np.eye(50)[:3]]))
    c = language_id.k_means(x.astype(np.float32), 4)
    assert np.bincount((x @ c.T).argmax(axis=1), minlength=len(c)).min() >= 10


@pytest.mark.parametrize("ids", ["null", "one", "two", "equal rows"])
def test_every_language_is_learned_whatever_the_ids(spark, ids):
    """More rows a language than the sample, whose ids tell them badly apart; the sample stays within its bound."""
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang")
    odd = {"null": F.lit(None).cast("long"), "one": F.lit(3).cast("long"), "two": F.col("doc_id") % 2, "equal rows": F.lit(1).cast("long")}[ids]
    df = docs.withColumn("doc_id", odd)
    if ids == "equal rows":
        df = df.withColumn("text", F.first("text").over(Window.partitionBy("lang").orderBy(F.length("text").desc())))
    langs = {r.lang for r in docs.filter("lang is not null").select("lang").distinct().collect()}
    model = language_id.fit(df, sample_per_lang=50)
    assert set(model.langs) == langs
    rows = df.filter("text is not null and lang is not null").withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    cut = language_id.sample_cuts(rows, 50, 20_000)
    picked = rows.select("lang", "h").distinct().collect()
    assert all(1 <= sum(r.h <= cut[lang] for r in picked if r.lang == lang) <= 50 for lang in langs)
    few = language_id.sample_cuts(rows, 50, 2 * len(langs))
    assert all(1 <= sum(r.h <= few[lang] for r in picked if r.lang == lang) <= 2 for lang in langs)
    out = language_id.predict(docs.filter("lang is not null and length(text) > 400"), model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert ids == "equal rows" or out > 0.9  # one text a language teaches little


def test_sampling_stops_early_in_every_task(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("lang"), F.col("id").alias("h"))
    first = rows.select("lang", "h", F.row_number().over(Window.partitionBy("lang").orderBy("h")).alias("k")).filter("k <= 400")
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert language_id.fit(spark.createDataFrame([(1, "12 34", "en"), (2, None, "en"), (3, "abc", None)], "doc_id long, text string, lang string")).langs == []
