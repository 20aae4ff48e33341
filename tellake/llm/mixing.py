"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key, scaled by its quality weight (Efraimidis and
Spirakis): key = -ln(u) / quality.  A source's target is spent in complete epochs first;
what remains is filled with its documents in key order until their sizes reach it.

Finding where a source's prefix sum reaches its budget needs no sort of the source: sizes
are summed by coarse key bin (pre-aggregated before the shuffle), the bin that crosses the
budget is split into finer bins, and only the documents of that one fine bin are ordered.
Bins are equal steps of the key's logarithm, whose density is the same for every quality (it
only moves), so one fine bin holds about one row in 47,000 of a source at most.
Shares of sources are windows over one row a source.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import all_columns, broadcast_if_small, drop, materialize

BINS = 1024
#: natural logarithms of keys: those of u = 1 - 2**-54 at quality 1 and of u = 2**-54 at quality 1e-6 lie within
LOW_LOG, HIGH_LOG = -38.0, 18.0
MAX_EPOCHS = 3


def word_count(text: str) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def default_quality(size: Column) -> Column:
    """Texts of 50 words or more weigh 1, shorter ones less, at least 0.1."""
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), size / F.lit(50.0)))


def keyed(df: DataFrame, id_col: str, text_col: str, source_col: str, quality: Column | None, seed: int) -> DataFrame:
    """df with __size, __source (null-safe key), __key and __bin, functions of the row alone."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    sized = df.withColumns({"__size": word_count(text_col), "__source": F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("null"))})
    weight = default_quality(F.col("__size")) if quality is None else quality
    drawn = sized.withColumn("__key", -F.log(u) / F.greatest(weight, F.lit(1e-6)))
    return drawn.withColumn("__bin", F.greatest(F.lit(0), F.least(F.lit(BINS * BINS - 1), F.floor((F.log("__key") - LOW_LOG) * (BINS * BINS / (HIGH_LOG - LOW_LOG))))).cast("int"))


def targets(rows: DataFrame, source: Column, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Rows (__source, source_size, target): shares of the total by weight, none above MAX_EPOCHS sizes.

    Sources in code point order, null last, weigh weights[0], weights[1], ... repeating.
    The excess of capped sources goes to the others by weight until none is above; that is
    one level x with target = min(cap, x * weight), found by a prefix sum over cap / weight.
    """
    sizes = rows.groupBy("__source", source.alias("__name")).agg(F.sum("__size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("__name").asc_nulls_last())) - 1
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int")))
    by_level = Window.orderBy("level", "__name").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    capped = weighed.withColumn("cap", F.col("source_size") * float(MAX_EPOCHS)).withColumn("level", F.col("cap") / F.col("w"))
    left = capped.withColumns({
        "budget": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(by_level), F.lit(0.0)),
        "share": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(by_level), F.lit(0.0)),
    }).withColumn("x", F.col("budget") / F.col("share"))
    # sources below the level are capped; the first whose own level is not below decides x
    x = F.min(F.when(F.col("x") <= F.col("level"), F.struct("level", "__name", "x"))).over(whole)["x"]
    return left.select("__source", "source_size", F.coalesce(F.least("cap", x * F.col("w")), F.col("cap")).alias("target"))


def thresholds(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Rows (__source, source_size, target, epochs, cut_bin, cut_key, cut_part) from keyed rows.

    Documents below cut_bin, or in it with a key below cut_key, are taken once more than
    epochs; of the document with cut_key the share cut_part still fits.  shares is materialised, and removed here.
    The plan has one row a source: it is broadcast if it is small, so that a source with a third of all rows is not
    one task of the joins with it.
    """
    plan = shares.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    plan = plan.withColumn("rest", F.when(F.col("source_size") > 0, F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(0.0))
    upto = Window.partitionBy("__source").orderBy("b")

    def crossing(bins: DataFrame, rest: str) -> DataFrame:
        """The first bin of each source at which the running size reaches the rest, and the size before it."""
        run = bins.withColumn("upto", F.sum("size").over(upto)).filter(F.col("upto") >= F.col(rest))
        return run.groupBy("__source").agg(F.min(F.struct("b", (F.col("upto") - F.col("size")).alias("before"))).alias("at"))

    coarse = rows.groupBy("__source", F.floor(F.col("__bin") / BINS).alias("b")).agg(F.sum("__size").alias("size"))
    first = crossing(coarse.join(plan.select("__source", "rest"), "__source").filter("rest > 0"), "rest").select("__source", F.col("at.b").alias("b1"), F.col("at.before").alias("before1"))
    first = materialize(plan.join(first, "__source", "left"), "mix-coarse")
    inside = rows.join(first.select("__source", "b1", (F.col("rest") - F.col("before1")).alias("rest1")), (F.floor(F.col("__bin") / BINS) == F.col("b1")) & (rows["__source"] == first["__source"])).drop(first["__source"])
    fine = inside.groupBy("__source", F.col("__bin").alias("b")).agg(F.sum("__size").alias("size"), F.first("rest1").alias("rest1"))
    second = crossing(fine, "rest1").select("__source", F.col("at.b").alias("cut_bin"), F.col("at.before").alias("before2"))
    second = materialize(first.join(second, "__source", "left"), "mix-fine")
    last = rows.join(second.select("__source", "cut_bin", (F.col("rest") - F.col("before1") - F.col("before2")).alias("rest2")), (F.col("__bin") == F.col("cut_bin")) & (rows["__source"] == second["__source"])).drop(second["__source"])
    tied = last.groupBy("__source", "__key").agg(F.sum("__size").alias("size"), F.first("rest2").alias("rest2"))
    run = F.sum("size").over(Window.partitionBy("__source").orderBy("__key"))
    at = tied.withColumn("upto", run).filter(F.col("upto") >= F.col("rest2")).groupBy("__source").agg(
        F.min(F.struct("__key", (F.col("rest2") - F.col("upto") + F.col("size")).alias("fits"), "size")).alias("at"))
    cut = at.select("__source", F.col("at.__key").alias("cut_key"), (F.col("at.fits") / F.col("at.size")).alias("cut_part"))
    whole = materialize(second.join(cut, "__source", "left").select("__source", "source_size", "target", "epochs", "cut_bin", "cut_key", "cut_part"), "mix-plan")
    drop(first, second, shares)
    return broadcast_if_small(whole)


def extra_part() -> Column:
    """Share of a keyed row, joined with its source's thresholds, that the unfinished epoch takes."""
    edge = F.col("__bin") == F.col("cut_bin")
    before = (F.col("__bin") < F.col("cut_bin")) | (edge & (F.col("__key") < F.col("cut_key")))
    return F.when(before, F.lit(1.0)).when(edge & (F.col("__key") == F.col("cut_key")), F.col("cut_part")).otherwise(F.lit(0.0))


def mix_plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1.0, 2.0, 3.0), quality: Column | None = None, seed: int = 17) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, quality_key), one per input row.

    size: words of the text (null: 0).  Sources are compared as strings, null is a source.
    taken: size times the complete epochs, and once more for rows that come before the rest
    of the target in key order; of the row that crosses it only the words that still fit.
    The same rows give the same mix.  Rows equal in id and text are taken alike.  Where all texts are
    empty every target is 0.
    """
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"), *([] if quality is None else [quality.alias("__weight")]))
    rows = materialize(keyed(slim, "doc_id", "text", "source", None if quality is None else F.col("__weight"), seed).select("doc_id", "source", "__size", "__source", "__key", "__bin"), "mix")
    plan = thresholds(rows, materialize(targets(rows, F.col("source"), weights), "mix-targets"))
    out = rows.join(plan, "__source")
    return out.select("doc_id", F.col("__size").alias("size"), "source_size", "target", (F.col("epochs") * F.col("__size") + F.round(extra_part() * F.col("__size"))).cast("long").alias("taken"), F.col("__key").alias("quality_key"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1.0, 2.0, 3.0), quality: Column | None = None, seed: int = 17) -> DataFrame:
    """The mix itself: rows of df, each as often as the mix takes it (none to three times).

    Rows stay whole: the one that crosses a source's target is kept if half of it fits.  A null
    text has no words and is never taken beyond complete epochs of its source; a null source is a
    source.  Columns of df may have any names.
    """
    whole = df.select(F.struct(*all_columns(df)).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"), *([] if quality is None else [quality.alias("__weight")]))
    rows = keyed(whole, "doc_id", "text", "source", None if quality is None else F.col("__weight"), seed)
    slim = materialize(rows.select("source", "__size", "__source", "__key", "__bin"), "mix")
    plan = thresholds(slim, materialize(targets(slim, F.col("source"), weights), "mix-targets"))
    out = rows.join(plan.select("__source", "epochs", "cut_bin", "cut_key", "cut_part"), "__source").withColumn("__times", F.col("epochs") + (extra_part() >= 0.5).cast("int")).filter("__times > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select("row.*")
