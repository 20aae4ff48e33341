"""The ten operators against brute force on small fixtures, with odd rows mixed in."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tellake.llm import decontaminate, jaccard_join, language_id, language_model, license_scan, line_dedup, mixing, packing, quality, substring_dedup

D = "/root/testdata/sf0.001"
SPACED = r"[^\x20\x09-\x0D]+"
ODD = [(900001, None, None, None), (900002, "", "en", ""), (900003, " \n\t ", "en", "s"), (900004, "one two", "en", "s"), (900005, "one two", "fr", None), (900006, "é" * 3, None, "s"), (900007, "same word " * 3000, "en", "s"), (900007, "other text of a repeated id", "en", "s"), (None, "a text without an id " * 8, "en", "s"), (900008, "12 34 !?", "en", "s")]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    return base.unionByName(odd).withColumns({"block": F.lit(1), "answer": F.lit("clash"), "score": F.lit(0), "bucket": F.lit("x")}).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "", r.source) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def lower(s):
    return s.translate({i: i + 32 for i in range(65, 91)})


def test_mixing(docs, empty):
    out = mixing.mix_plan(docs).collect()
    again = mixing.mix_plan(docs.repartition(5)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    assert len(out) == docs.count() and all(r.taken <= 3 * r["size"] for r in out)
    by = {}
    for r in out:
        s = by.setdefault((r.source_size, r.target), [0, 0])
        s[0] += r.taken
    assert all(abs(v[0] - t) <= 2 for (_, t), v in by.items())
    assert math.isclose(sum(t for _, t in by), sum(r["size"] for r in out))
    assert mixing.mix_plan(empty).count() == 0 and mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs.withColumns({"__key": F.lit(1), "__times": F.lit("x"), "a.b": F.lit(2)})).columns == [*docs.columns, "__key", "__times", "a.b"]


@pytest.mark.parametrize("quality", [None, 0.1, 1e-6])
def test_mixing_takes_keys_in_order(docs, quality):
    """Every row's take against a plain sort by key; bins do not degenerate at low quality."""
    weight = None if quality is None else F.lit(quality)
    out = mixing.mix_plan(docs, quality=weight).collect()
    groups = {}
    for r in out:
        groups.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), rows in groups.items():
        epochs = int(target // size) if size else 0
        left = target - epochs * size
        by_key = {}
        for r in rows:
            by_key.setdefault(r.quality_key, []).append(r)
        for key in sorted(by_key):
            total = sum(r["size"] for r in by_key[key])
            part = min(1.0, max(0.0, left / total)) if total else 0.0
            left -= total
            for r in by_key[key]:
                assert abs(r.taken - (epochs * r["size"] + part * r["size"])) <= 0.5 + 1e-6
    bins = mixing.keyed(docs, "doc_id", "text", "source", weight, 17).groupBy("__bin").count().agg(F.max("count")).first()[0]
    assert bins <= 6


def distance(p, q):
    half = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
    return math.sqrt(max(0.0, sum((half(a, b) + half(b, a)) / 2 for a, b in zip(p, q))))


def shares(hist):
    return [x / sum(hist) if sum(hist) else 0.0 for x in hist]


def check_divergence(docs, out):
    """Both distances and the verdicts in plain Python."""
    base = {(r.doc_id, r.n_words, r.word_chars): r for r in out}
    words = [re.findall(SPACED, r.text or "") for r in docs]
    counts = {}
    for r, w in zip(docs, words):
        if r.lang and len(w) >= 50:
            counts.setdefault(r.lang, Counter()).update(w)
    total = {k: sum(c.values()) for k, c in counts.items()}
    common = {k: sorted(w for w, n in c.items() if n >= 0.01 * total[k]) for k, c in counts.items()}
    word_ref = {k: [*(counts[k][w] / total[k] for w in c), 1 - sum(counts[k][w] for w in c) / total[k]] for k, c in common.items()}
    classes = lambda w: [sum(sum(bool(re.match(p, c)) for c in x) for x in w) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[#*$%&|<>]", r"(?![a-zA-Z0-9#*$%&|<>])[\x00-\x7f]", r"[^\x00-\x7f]")]
    chars, char_ref, far = [classes(w) for w in words], {}, {}
    for r, w, c in zip(docs, words, chars):
        if r.lang and not base[r.doc_id, len(w), sum(map(len, w))].base_failed:
            char_ref[r.lang] = [a + b for a, b in zip(char_ref.get(r.lang, [0] * 6), c)]
    want = []
    for r, w, c in zip(docs, words, chars):
        row = base[r.doc_id, len(w), sum(map(len, w))]
        cd = distance(shares(c), shares(char_ref[r.lang])) if r.lang in char_ref else None
        often = Counter(w)
        wd = distance(shares([*(often[x] for x in common[r.lang]), len(w) - sum(often[x] for x in common[r.lang])]), word_ref[r.lang]) if r.lang in common else None
        assert (row.char_distance is None) == (cd is None) and (row.word_distance is None) == (wd is None)
        assert cd is None or abs(row.char_distance - cd) < 1e-6
        assert wd is None or abs(row.word_distance - wd) < 1e-6
        want.append((r.lang, row, cd, wd))
        if r.lang and not row.base_failed:
            far.setdefault(r.lang, ([], []))
            far[r.lang][0].extend([cd] if row.word_chars >= 200 else [])
            far[r.lang][1].extend([wd] if row.n_words >= 100 else [])

    def limit(x):
        x = sorted(x)
        a, b = (x[math.ceil(len(x) * q) - 1] for q in (0.5, 0.75))
        return a + 8 * max(0.01, b - a)

    for lang, row, cd, wd in want:
        odd = False
        if lang in far:
            odd = row.word_chars >= 200 and cd > limit(far[lang][0]) or row.n_words >= 100 and wd > limit(far[lang][1])
        assert row.kept == (not row.base_failed and not odd)


def test_quality(docs, rows, empty):
    out = quality.quality_verdicts(docs).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    want = Counter()
    for i, s, _ in rows:
        w = re.findall(SPACED, s)
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        often = Counter(tri)
        cover = {k + d for k, x in enumerate(tri) if often[x] > 1 for d in range(3)}
        lines = [x for x in s.split("\n") if re.search(SPACED, x)]
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in s), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w))] += 1
    assert got == want
    check_divergence(docs.collect(), out)
    assert not any(r.kept and r.base_failed for r in out) and quality.quality_verdicts(empty).count() == 0


def test_packing_round_trip(spark, docs, empty):
    out = packing.pack_documents(docs, "/opt/tokenizers/byte_bpe_50k.tiktoken", capacity=256).collect()
    encode = packing.encoder(packing.vocabulary(spark, "/opt/tokenizers/byte_bpe_50k.tiktoken"))
    parts = []
    for r in out:
        ids = packing.matrix_of([r.ids], 256)[0]
        assert r.cu_seqlens[-1] == r.n_tokens <= 256 and not ids[r.n_tokens :].any() and r.resets == r.cu_seqlens[:-1]
        parts += [(d, at, ids[a:b].tolist()) for d, at, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:])]
    want = Counter()
    for r in docs.filter("text is not null").collect():
        ids = [*encode.encode_ordinary(r.text), 50256]
        want.update((r.doc_id, at, tuple(ids[at : at + 256])) for at in range(0, len(ids), 256))
    assert Counter((d, at, tuple(x)) for d, at, x in parts) == want
    assert packing.pack_documents(empty, "/opt/tokenizers/byte_bpe_50k.tiktoken").count() == 0


def test_best_fit():
    import random

    rng = random.Random(1)
    lengths = [rng.randint(1, 64) for _ in range(500)]
    got = packing.best_fit_decreasing(lengths, 64)
    assert sorted(i for r in got for i in r) == list(range(500)) and all(sum(lengths[i] for i in r) <= 64 for r in got)
    open_rows = []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, room in enumerate(open_rows) if room >= n]
        if fit:
            open_rows[min(fit, key=lambda k: open_rows[k])] -= n
        else:
            open_rows.append(64 - n)
    assert len(got) == len(open_rows)


def test_language(docs, empty):
    out = language_id.language_of(docs).join(docs.select("doc_id", "lang", "text").withColumnRenamed("text", "t"), "doc_id").collect()
    for r in out:
        if not any(c.isalpha() for c in r.t or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0, True)
    held = [r for r in out if r.held_out and r.lang and r.doc_id < 900000]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in out)
    assert language_id.language_of(empty).count() == 0 and language_id.in_known_language(docs).columns == docs.columns


def shingles(s, n):
    w = re.findall(SPACED, lower(s))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


@pytest.mark.parametrize(("n", "num"), [(4, 85), (2, 50)])
def test_jaccard(docs, rows, empty, n, num):
    sets = [shingles(s, n) for _, s, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= num * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    want = Counter((i, len(s), low.get(find(k), i) if s else i) for k, ((i, _, _), s) in enumerate(zip(rows, sets)))
    assert Counter(map(tuple, jaccard_join.jaccard_components(docs, n=n, num=num).collect())) == want
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_contamination(spark, docs, rows, empty):
    items = [(1, "of the and to in is be an at it on"), (2, rows[3][1][:400]), (3, None), (4, "one two"), (None, "x"), (5, ""), (5, rows[3][1][:400])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda s: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(s or ""))
    windows = {}
    for i, s in items:
        w = words(s)
        for k in range(max(1, len(w) - 9) if w and i is not None else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    want = Counter()
    for i, s, _ in rows:
        w, hit, found = words(s), set(), set()
        for x, ids in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found |= ids
        want[(i, len(w), len(hit), tuple(sorted(found)))] += 1
    out = decontaminate.contamination(docs, bench)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in out.collect()) == want
    assert decontaminate.contamination(empty, bench).count() == 0 and decontaminate.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha beta " + "z " * 20 + "gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    index = decontaminate.build_index(docs)
    assert sorted(r.doc_id for r in decontaminate.search(index, items, slop=2).collect()) == [1, 2]
    assert decontaminate.search(index, items).count() == 0


def test_language_model(docs, rows, empty):
    out = language_model.language_model_scores(docs).collect()
    tokens = [(i, [*re.findall(SPACED, lower(s)), None]) for i, s, _ in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    count = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(count.values()), len(count)
    want = Counter((i, held(i), len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for i, t in tokens)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    fresh = [r for r in out if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh) and all(r.score < 0 for r in out)
    assert language_model.language_model_scores(empty).count() == 0


def test_lines(spark, empty):
    line = "the quick brown fox jumps over the lazy dog near the old river bank today and every other day of the long year"
    rows = [(1, line + "\nshort\n" + line), (2, line.upper() + "!"), (3, None), (4, ""), (None, line), (5, line.replace("river", "rivers")), (6, "wholly different words that share nothing at all with any other line here")]
    out = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in line_dedup.fuzzy_line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_words=5).collect()}
    assert out[1] == (3, 1, [2]) and out[2] == (1, 1, [0]) and out[3] == out[4] == (0, 0, []) and out[None] == (1, 1, [0]) and out[6] == (1, 0, [])
    assert line_dedup.fuzzy_line_dedup(empty).count() == 0


def test_licenses(spark, docs, empty):
    known = license_scan.TEMPLATES
    text = "word " * 70 + known["MIT"] + " tail" * 50
    rows = [(1, text), (2, "Released under the MIT License."), (3, None), (4, "x " * 500), (5, known["BSD (grant)"].replace("binary", "any")), (5, known["BSD (grant)"].replace("binary", "any")), (None, "\n".join(known.values()))]
    out = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), containment=0.7).collect()
    assert sorted(((r.doc_id or 0), tuple(r.licenses)) for r in out) == [(0, tuple(sorted(known))), (1, ("MIT", "MIT (grant)")), (2, ("MIT (line)",)), (3, ()), (4, ()), (5, ("BSD (grant)",)), (5, ("BSD (grant)",))]
    want = {r.doc_id for r in docs.collect() if "Licensed under CC BY-NC 4.0." in (r.text or "")}
    assert {r.doc_id for r in license_scan.scan_licenses(docs).collect() if "CC-BY-NC-4.0 (line)" in r.licenses} == want
    assert license_scan.scan_licenses(empty).count() == 0


def test_short_templates_and_borders(spark):
    """Templates below a shingle are found, and no window crosses into the next text."""
    rows = [(1, "MIT License"), (2, "the mit license, here"), (3, "MIT"), (4, "License MIT"), (5, "one two three"), (6, "four five six seven eight")]
    names = {"x": "MIT License", "y": "two three four five six seven", "z": "!"}
    out = {r.doc_id: r.licenses for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), templates=names).collect()}
    assert out == {1: ["x"], 2: ["x"], 3: [], 4: [], 5: [], 6: []}


def test_licenses_against_every_window(spark):
    """Edited templates in running text: found where some stretch as long as the template, with its margins, contains 0.8 of its shingles."""
    import random

    rng = random.Random(4)
    names = {k: v for k, v in license_scan.TEMPLATES.items() if len(v.split()) >= 20}
    words = [f"w{k}" for k in range(300)]
    rows, planted = [], []
    for k in range(150):
        name = rng.choice(sorted(names))
        body = names[name].split()
        for _ in range(rng.randint(0, len(body) // 8)):
            body[rng.randrange(len(body))] = rng.choice(words)
        rows.append((k, " ".join(rng.choices(words, k=rng.randint(0, 90)) + body + rng.choices(words, k=rng.randint(0, 90)))))
        planted.append(name)
    terms = lambda s: re.findall("[0-9a-z\x80-\U0010ffff]+", lower(s))
    five = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    want = {(k, n) for k, s in rows for n, t in names.items() if len(five(terms(t)) & five(terms(s))) >= 0.8 * len(five(terms(t)))}
    got = {(r.doc_id, n) for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates=names).collect() for n in r.licenses}
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 60, (len(got), len(want))


@pytest.mark.parametrize(("length", "start"), [(20, 10), (6, 2)])
def test_substrings(docs, rows, empty, length, start):
    texts = [(math.inf if i is None else i, k, re.findall(SPACED, s)) for k, (i, s, _) in enumerate(rows)]
    spots = {}
    for i, k, w in texts:
        for p in range(len(w) - length + 1):
            spots.setdefault(tuple(w[p : p + length]), []).append((i, k, p))
    low = {x: min(i for i, _, _ in v) for x, v in spots.items()}
    want = Counter()
    for i, k, w in texts:
        gone, seen = set(), set()
        for p in range(len(w) - length + 1):
            x = tuple(w[p : p + length])
            if low[x] < i or x in seen:
                gone.update(range(p, p + length))
            seen.add(x)
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        want[(None if i == math.inf else i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert Counter(map(tuple, substring_dedup.substring_digest(docs, length=length, start=start).collect())) == want
    assert substring_dedup.substring_digest(empty).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{D}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, D)
        assert kept.columns == docs.columns
    assert corpus_pipeline.run(spark, D).count() > 0
