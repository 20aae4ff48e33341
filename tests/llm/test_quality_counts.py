from tellake.llm import quality


def test_word_histograms_without_a_call_a_word(spark):
    rows = [(1, "the cat the dog x", "en"), (2, "the  the\ttheir", "en"), (3, "the", None), (4, None, "en"), (5, "the", "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    common = spark.createDataFrame([("en", ["dog", "the"], [0.2, 0.6, 0.2])], "common_lang string, common array<string>, ref_words array<double>")
    out = quality.features(df, "doc_id", "text", "lang", common)
    assert {r.doc_id: r.word_hist for r in out.collect()} == {1: [1.0, 2.0, 2.0], 2: [0.0, 2.0, 1.0], 3: None, 4: [0.0, 0.0, 0.0], 5: None}
    assert "array_contains" not in out._jdf.queryExecution().optimizedPlan().toString()
