"""License scans with whole texts, tables of templates, repeated licenses and odd rows."""

import random

import pytest

from tellake.llm import license_scan, license_texts

SCHEMA = "doc_id long, text string"


def found(df):
    return {r.doc_id: r.licenses for r in df.collect()}


def test_whole_texts_are_told_apart(spark):
    """Each long text, with a fortieth of its words changed and other text around, gives its own name."""
    rng = random.Random(2)
    whole = {n: t for n, t in license_texts.default_templates().items() if n.endswith("(text)")}
    assert len(whole) >= 10 and {"Apache-2.0 (text)", "GPL-3 (text)", "MPL-2.0 (text)"} <= set(whole)
    rows = []
    for k, (name, text) in enumerate(whole.items()):
        words = text.split()
        for _ in range(len(words) // 40):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        rows.append((k, "code " * rng.randrange(200) + " ".join(words) + " more" * rng.randrange(200)))
    got = found(license_scan.scan_licenses(spark.createDataFrame(rows, SCHEMA)))
    for k, name in enumerate(whole):
        assert name in got[k]
    # a half of a text is not the text
    half = [(k, " ".join(t.split()[: len(t.split()) // 2])) for k, t in enumerate(whole.values())]
    got = found(license_scan.scan_licenses(spark.createDataFrame(half, SCHEMA)))
    assert all(name not in got[k] for k, name in enumerate(whole))


def test_a_table_of_templates(spark):
    table = spark.createDataFrame([("a", "these words are the first license of all"), ("b", "another one with words of its own entirely"), ("a", "the other wording of the first license here"), (None, "no name at all but some words"), ("c", None)], "name string, text string")
    rows = [(1, "see: THESE words are the first license of all, ok"), (2, "the other wording of the first license here"), (3, "another one with words of its own entirely. the other wording of the first license here"), (4, "no name at all but some words")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS name", "'x' AS licenses", "2 AS `a.b`")
    assert found(license_scan.scan_licenses(df, templates=table.selectExpr("*", "1 AS doc_id"))) == {1: ["a"], 2: ["a"], 3: ["a", "b"], 4: []}
    assert found(license_scan.scan_licenses(df, templates=table.limit(0))) == {k: [] for k in (1, 2, 3, 4)}
    big = spark.createDataFrame([("x", "word " * (1 << 20))], "name string, text string")
    with pytest.raises(ValueError):
        license_scan.scan_licenses(df, templates=big)


def test_every_place_is_reported(spark):
    mit = license_texts.TEMPLATES["MIT"]
    n = len(mit.split())
    rows = [(1, (mit + " ") + "gap " * 2000 + mit), (2, "Released under the MIT License. " + "gap " * 50 + "Released under the MIT License."), (3, "x " * 1_000_000 + mit)]
    spans = {r.doc_id: [(s["from"], s["to"]) for s in r.spans if s["name"] in ("MIT", "MIT (line)")] for r in license_scan.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(spans[1]) >= 2 and spans[1][0][0] == 0 and spans[1][-1][1] > 2000 + n and all(a < b for a, b in spans[1])
    assert len(spans[2]) == 2 and len(spans[3]) == 1 and spans[3][0][1] > 1_000_000
