"""Quality rules: base counts and divergence from language references, in DataFrame functions only.

Each text has two histograms: its characters by class and its words by common word.  The common
words of a language are those that make up COMMON_SHARE of the words of its texts of MIN_WORDS
words or more, so there are at most 1 / COMMON_SHARE of them; their shares are the word reference.
The character reference sums the histograms of its texts that pass the base rules.  A text whose
Jensen-Shannon distance from its language is too large in either is dropped, if it is long enough
for its histogram to mean something.  Too large: SPREADS times as far above the median distance
of the language's base-passing texts as the third quartile is, LEAST_SPREAD at least.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import broadcast_if_small, drop, materialize

WORD, SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
COMMON_SHARE = 0.01
#: characters and words of the shortest texts that the two distances judge
CHAR_MIN, WORD_MIN = 200, 100
SPREADS, LEAST_SPREAD = 8.0, 0.01
#: bins of a distance, and fine bins of a bin
BINS = 1 << 16


def common_words(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Rows (common_lang, common, ref_words), materialised: the common words of each language in order, and their shares and that of all others."""
    words = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(WORD), 0)
    long = df.select(F.col(lang_col).cast("string").alias("lang"), words.alias("words")).filter(F.col("lang").isNotNull() & (F.size("words") >= MIN_WORDS))
    counts = materialize(long.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    totals = broadcast_if_small(materialize(counts.groupBy("lang").agg(F.sum("n").alias("total")), "word-totals"))
    often = counts.join(totals, "lang").filter(F.col("n") >= COMMON_SHARE * F.col("total"))
    listed = often.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", (F.col("n") / F.col("total")).alias("share")))).alias("w"))
    rest = F.greatest(F.lit(0.0), 1.0 - F.aggregate("w.share", F.lit(0.0), lambda a, b: a + b))
    out = materialize(listed.select(F.col("lang").alias("common_lang"), F.col("w.word").alias("common"), F.concat("w.share", F.array(rest)).alias("ref_words")), "common-words")
    drop(counts)
    return out


def coded_windows(words: Column, n: Column) -> tuple[Column, Column]:
    """The 3-word windows of `words` (n of them), and the bits that hold a position.

    Each window becomes one long, hash above position; sorted, equal windows are neighbours.
    The hash keeps 64 bits less those of the position.
    """
    bits = F.ceil(F.log2(n + 1.0)).cast("int")
    coded = F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(0))), lambda w, i: F.call_function("shiftleft", F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), bits).bitwiseOR(i.cast("long")))
    return F.sort_array(coded), bits


def covered_by_repeats(coded: Column, bits: Column) -> Column:
    """Words covered by windows of `coded` that have an equal neighbour."""

    def window(x: Column) -> Column:
        return F.call_function("shiftright", x, bits)

    again = F.filter(coded, lambda x, i: F.coalesce(window(F.get(coded, i + 1)) == window(x), F.lit(False)) | F.coalesce(window(F.get(coded, i - 1)) == window(x), F.lit(False)))
    return F.sort_array(F.transform(again, lambda x: x - F.call_function("shiftleft", window(x), bits)))


def features(df: DataFrame, id_col: str, text_col: str, lang_col: str, common: DataFrame) -> DataFrame:
    """Rows (doc_id, lang, base columns, char_hist, word_hist), one per input row; null text counts as empty.

    word_hist counts the common words of the row's language and all others; null without a language.
    """
    out = df.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = out.join(common, out.lang == common.common_lang, "left")
    out = out.select("doc_id", "lang", "common", "text", F.regexp_extract_all("text", F.lit(WORD), 0).alias("words"), F.regexp_replace("text", SPACE, "").alias("chars"))
    out = out.withColumns({"n": F.size("words"), "no_lower": F.regexp_replace("chars", "[a-z]+", "")})
    coded, bits = coded_windows(F.col("words"), F.col("n"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    # one pass of the words a common word, without a lambda's call a word
    counts = F.transform("common", lambda c: (F.col("n") - F.size(F.array_remove("words", c))).cast("double"))
    out = out.withColumns({"coded": coded, "bits": bits, "lines": lines, "counts": counts, "no_upper": F.regexp_replace("no_lower", "[A-Z]+", "")})
    out = out.withColumns({"places": covered_by_repeats(F.col("coded"), F.col("bits")), "no_digit": F.regexp_replace("no_upper", "[0-9]+", "")})
    out = out.withColumns({"no_symbol": F.translate("no_digit", SYMBOLS, "")})
    out = out.withColumns({"no_ascii": F.regexp_replace("no_symbol", r"[\x00-\x7F]+", "")})
    repeat = F.aggregate(F.transform("places", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("places", i + 1) - p, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda a, b: a + b)

    def gone(before: str, after: str) -> Column:
        return (F.length(before) - F.length(after)).cast("double")

    chars = [gone("chars", "no_lower"), gone("no_lower", "no_upper"), gone("no_upper", "no_digit"), gone("no_digit", "no_symbol"), gone("no_symbol", "no_ascii"), F.length("no_ascii").cast("double")]
    others = F.col("n") - F.aggregate("counts", F.lit(0.0), lambda a, b: a + b)
    return out.select(
        "doc_id", "lang", F.col("n").cast("long").alias("n_words"), F.length("chars").cast("long").alias("word_chars"), gone("no_digit", "no_symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), repeat.alias("n_repeat_words"),
        F.array(*chars).alias("char_hist"), F.concat("counts", F.array(others)).alias("word_hist"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def share(hist: Column | str) -> Column:
    """A histogram divided by its sum; all zero stays zero."""
    total = F.aggregate(hist, F.lit(0.0), lambda a, b: a + b)
    return F.transform(hist, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions, base 2: between 0 and 1; null where either is null."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(p, q, lambda a, b: (half(a, b) + half(b, a)) / 2), F.lit(0.0), lambda s, x: s + x))))


def references(rows: DataFrame) -> DataFrame:
    """Rows (ref_lang, ref_chars): character histograms summed over each language's texts that pass the base rules."""
    good = rows.filter("not base_failed and lang is not null")
    sums = good.groupBy(F.col("lang").alias("ref_lang")).agg(*[F.sum(F.get("char_hist", F.lit(i))).alias(f"c{i}") for i in range(6)])
    return sums.select("ref_lang", share(F.array(*[f"c{i}" for i in range(6)])).alias("ref_chars"))


def limits(scored: DataFrame) -> DataFrame:
    """Rows (limit_lang, char_limit, word_limit), materialised, from the distances of each language's base-passing texts that are long enough for them.

    Quartiles come from counts by bin, then by fine bin of those bins in which they lie, so they do not depend on how the
    rows lie and no task orders a language: the largest distance of the fine bin stands for the quartile in it.
    """
    char = F.when(F.col("word_chars") >= CHAR_MIN, F.col("char_distance"))
    word = F.when(F.col("n_words") >= WORD_MIN, F.col("word_distance"))
    good = scored.filter("not base_failed and lang is not null")
    both = [good.select("lang", F.lit(k).alias("kind"), d.alias("d")).filter("d is not null") for k, d in ((0, char), (1, word))]
    fine = F.least(F.lit(BINS * BINS - 1), F.floor(F.col("d") * (BINS * BINS)))
    rows = both[0].unionByName(both[1]).withColumn("fine", fine).withColumn("bin", F.floor(F.col("fine") / BINS))

    def crossed(counts: DataFrame, keys: list[str], bin_name: str) -> DataFrame:
        """The first bin of each group at which the rows so far reach the place, with the rows before it."""
        upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(bin_name))
        reached = counts.withColumn("upto", upto).filter(F.col("upto") >= F.col("place"))
        return reached.groupBy(*keys).agg(F.min(F.struct(bin_name, (F.col("place") - F.col("upto") + F.col("n")).alias("left"), "top")).alias("at"))

    coarse = materialize(rows.groupBy("lang", "kind", "bin").agg(F.count("*").alias("n"), F.max("d").alias("top")), "distances")
    total = coarse.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    wanted = total.select("lang", "kind", F.explode(F.array(F.lit(2), F.lit(3))).alias("quarter"), "total").withColumn("place", F.ceil(F.col("total") * F.col("quarter") / 4))
    first = crossed(coarse.join(wanted, ["lang", "kind"]), ["lang", "kind", "quarter"], "bin")
    first = materialize(first.select("lang", "kind", "quarter", "at.bin", F.col("at.left").alias("place")), "quarters")
    inside = rows.join(broadcast_if_small(first), ["lang", "kind", "bin"]).groupBy("lang", "kind", "quarter", "fine").agg(F.count("*").alias("n"), F.max("d").alias("top"), F.first("place").alias("place"))
    at = crossed(inside, ["lang", "kind", "quarter"], "fine").select("lang", "kind", "quarter", F.col("at.top").alias("value"))

    def limit(kind: int) -> Column:
        half, most = (F.max(F.when((F.col("kind") == kind) & (F.col("quarter") == q), F.col("value"))) for q in (2, 3))
        return half + SPREADS * F.greatest(F.lit(LEAST_SPREAD), most - half)

    out = materialize(at.groupBy(F.col("lang").alias("limit_lang")).agg(limit(0).alias("char_limit"), limit(1).alias("word_limit")), "limits")
    drop(coarse, first)
    return out


def quality_verdicts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept).

    One per input row.  Null or wordless text: zero counts, base_failed.  A distance is null
    where the language is null or has no reference; a null distance, or a text below the length
    guard, drops nothing.  Other columns are not read.
    """
    common = broadcast_if_small(common_words(df, text_col, lang_col))
    rows = materialize(features(df, id_col, text_col, lang_col, common), "quality")
    refs = broadcast_if_small(materialize(references(rows), "references"))
    out = rows.join(refs, rows.lang == refs.ref_lang, "left").join(common.drop("common"), rows.lang == common.common_lang, "left")
    scored = out.select(
        *(c for c in rows.columns if not c.endswith("_hist")),
        jensen_shannon(share("char_hist"), F.col("ref_chars")).alias("char_distance"), jensen_shannon(share("word_hist"), F.col("ref_words")).alias("word_distance"))
    scored = materialize(scored, "scored")
    drop(rows)
    bounds = broadcast_if_small(limits(scored))
    odd = ((F.col("word_chars") >= CHAR_MIN) & (F.col("char_distance") > F.col("char_limit"))) | ((F.col("n_words") >= WORD_MIN) & (F.col("word_distance") > F.col("word_limit")))
    kept = ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False))
    out = scored.join(bounds, scored.lang == bounds.limit_lang, "left")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", kept.alias("kept"))
