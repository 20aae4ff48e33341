"""Registered queries of the telemetry operators with their SQL oracles.

The driver tables stand in for telemetry: events are frames (user_id is the series, frame
the rank by ts and event_id, an `error` event a reset frame); orders and lineitem are the
raw and parsed ledgers; pages, documents and the nations give paths, sizes and a tree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import metadata, paths
from .operators import features, ledger, sampling, segments
from .plans import registry
from .plans.steps import Chain, Normalize, Select
from .sources.frames import scan_directory as scan
from .streaming.incremental import process_pending as run_pending

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import store_queries  # noqa: F401  registers its own

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from . import store_queries  # noqa: F401

    return dict(_sql)


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def frames(spark: SparkSession, d: str) -> DataFrame:
    return segments.frame_index(t(spark, d, "events"), "user_id", "ts", "event_id")



FRAMES = "f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame FROM events)"
SEGS = FRAMES + """, r AS (SELECT user_id, frame, frame - row_number() OVER (PARTITION BY user_id ORDER BY frame) AS g FROM f WHERE event_type <> 'error'),
 s AS (SELECT user_id, min(frame) AS seg_start, max(frame) + 1 AS seg_end FROM r GROUP BY user_id, g HAVING count(*) >= 3)"""
WINS = SEGS + ", w AS (SELECT s.*, seg_start + 2 * k AS w_start, seg_start + 2 * k + 4 AS w_end FROM s, unnest(range(0, ((seg_end - seg_start - 4) // 2 + 1)::BIGINT)) u(k) WHERE seg_end - seg_start >= 4)"
SIZE, STRIDE, LEAST = 4, 2, 3


def segs(spark: SparkSession, d: str) -> DataFrame:
    return segments.segment_boundaries(frames(spark, d), "user_id", F.col("event_type") == "error", LEAST)


# --- sequence


@query(f"WITH {FRAMES} SELECT event_id, user_id, frame FROM f")
def frame_index(spark, d):
    return frames(spark, d).select("event_id", "user_id", "frame")


@query("SELECT vec_id, coalesce(embedding[1] = 0 AND embedding[2] = 0 AND embedding[3] = 0 AND embedding[4] = 0, false) AS is_reset FROM embeddings")
def reset_frames(spark, d):
    df = t(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].alias(c) for i, c in enumerate(("x", "y", "vx", "vy"))])
    return df.select("vec_id", segments.is_reset("x", "y", "vx", "vy").alias("is_reset"))


@query(f"WITH {FRAMES}, r AS (SELECT user_id, frame, frame - row_number() OVER (PARTITION BY user_id ORDER BY frame) AS g FROM f WHERE event_type = 'error') SELECT user_id, min(frame) AS run_start, max(frame) AS run_end FROM r GROUP BY user_id, g")
def contiguous_runs(spark, d):
    return segments.contiguous_runs(frames(spark, d).filter("event_type = 'error'"), "user_id")


@query(f"WITH {SEGS} SELECT * FROM s")
def segment_boundaries(spark, d):
    return segs(spark, d)


@query(f"WITH {SEGS} SELECT user_id, '[' || string_agg('[' || seg_start || ',' || seg_end || ']', ',' ORDER BY seg_start) || ']' AS boundaries FROM s GROUP BY user_id")
def boundaries_json(spark, d):
    return segments.boundaries_json(segs(spark, d), "user_id")


@query(f"WITH {SEGS} SELECT * FROM s")
def boundaries_roundtrip(spark, d):
    return segments.parse_boundaries(segments.boundaries_json(segs(spark, d), "user_id"))


@query(f"WITH {SEGS} SELECT *, seg_start AS w_start, seg_end AS w_end FROM s")
def segment_samples(spark, d):
    return segments.window_index(segs(spark, d), None)


@query(f"WITH {WINS} SELECT * FROM w")
def window_index(spark, d):
    return segments.window_index(segs(spark, d), SIZE, STRIDE)


@query(f"WITH {SEGS} SELECT count(*) AS skipped FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id NOT IN (SELECT user_id FROM s WHERE seg_end - seg_start >= 12)")
def windows_skipped(spark, d):
    wanted = t(spark, d, "events").select("user_id").distinct()
    return segments.missing_boundaries(wanted, segs(spark, d).filter("seg_end - seg_start >= 12"), "user_id").agg(F.count("*").alias("skipped"))


@query(f"WITH {WINS} SELECT w.user_id, w_start, f.frame, f.frame - w_start AS pos, event_id FROM w JOIN f ON f.user_id = w.user_id AND f.frame >= w_start AND f.frame < w_end")
def window_frames(spark, d):
    return segments.window_frames(frames(spark, d), segs(spark, d), "user_id", SIZE, STRIDE).select("user_id", "w_start", "frame", "pos", "event_id")


@query(f"WITH {WINS} SELECT w.user_id, w_start, count(*) AS rows, round(sum(value::FLOAT::DOUBLE), 3) AS total, list(event_id ORDER BY frame)::VARCHAR AS ids FROM w JOIN f ON f.user_id = w.user_id AND f.frame >= w_start AND f.frame < w_end GROUP BY 1, 2")
def window_matrix(spark, d):
    inside = segments.window_frames(frames(spark, d), segs(spark, d), "user_id", SIZE, STRIDE)
    m = segments.window_matrix(inside, "user_id", ["value", "event_id"])
    total = F.aggregate("matrix", F.lit(0.0), lambda a, r: a + r[0].cast("double"))
    ids = F.array_join(F.transform("matrix", lambda r: r[1].cast("long").cast("string")), ", ")
    return m.select("user_id", "w_start", F.size("matrix").cast("long").alias("rows"), F.round(total, 3).alias("total"), F.concat(F.lit("["), ids, F.lit("]")).alias("ids"))


@query(f"WITH {SEGS} SELECT * FROM s WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def boundary_backfill(spark, d):
    known = t(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return segments.segment_boundaries(segments.missing_boundaries(frames(spark, d), known, "user_id"), "user_id", F.col("event_type") == "error", LEAST)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_boundaries(spark, d):
    return segments.missing_boundaries(t(spark, d, "documents").select("doc_id"), t(spark, d, "labels"), "doc_id")


# --- features

LINE = {"l_quantity": 50.0, "l_extendedprice": 105000.0, "l_discount": 0.1, "l_tax": 0.08}
LINE_COLUMNS = ("l_orderkey", "l_linenumber", *LINE)
SCALED = "l_quantity / 50.0::DOUBLE AS l_quantity, l_extendedprice / 105000.0::DOUBLE AS l_extendedprice, l_discount / 0.1::DOUBLE AS l_discount, l_tax / 0.08::DOUBLE AS l_tax"


@query("SELECT l_tax, l_quantity, l_orderkey FROM lineitem")
def select_explicit(spark, d):
    return Select(("l_tax", "l_quantity", "l_orderkey"))(t(spark, d, "lineitem"))


def wide(spark: SparkSession, d: str, num_players: int = 2) -> DataFrame:
    """Frames with the columns of the full preset, filled from embeddings."""
    names = registry.select_columns("full", num_players)
    return t(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i % 64].cast("double").alias(n) for i, n in enumerate(names)])


def _wide_sql(names: list[str], over: dict[str, float] | None = None) -> str:
    full = registry.select_columns("full", 2)
    cols = []
    for n in names:
        e = f"embedding[{full.index(n) % 64 + 1}]::DOUBLE"
        cols.append(f'{e} / {over[n]}::DOUBLE AS "{n}"' if over and n in over else f'{e} AS "{n}"')
    return f"SELECT {', '.join(cols)} FROM embeddings"


PHYSICS = registry.select_columns("physics", 2)


@query(_wide_sql(PHYSICS))
def select_preset(spark, d):
    return Select.preset("physics", 2)(wide(spark, d))


@query("SELECT url, CASE WHEN b LIKE '%quaternion%' THEN 'quaternion' WHEN b LIKE '%velocity%' THEN 'velocity' WHEN regexp_matches(b, '^position [xyz]$') THEN 'position' WHEN regexp_matches(b, '^rotation [xyz]$') THEN 'euler' ELSE 'other' END AS class FROM (SELECT url, regexp_replace(n, '^(Ball - |i )', '') AS b FROM (SELECT url, CASE page_id % 5 WHEN 0 THEN 'Ball - position x' WHEN 1 THEN 'rotation w' WHEN 2 THEN 'i rotation y' WHEN 3 THEN 'linear velocity z' ELSE url END AS n FROM pages))")
def classify_columns(spark, d):
    r = F.col("page_id") % 5
    name = F.when(r == 0, "Ball - position x").when(r == 1, "rotation w").when(r == 2, "i rotation y").when(r == 3, "linear velocity z").otherwise(F.col("url"))
    return t(spark, d, "pages").select("url", features.classify(name).alias("class"))


KEPT = registry.kept_positions(registry.preset_columns("minimal", 2))


@query("SELECT vec_id, " + ", ".join(f'embedding[{at + 1}] AS "{n}"' for at, n in KEPT) + " FROM embeddings")
def dedupe_features(spark, d):
    return features.deduplicate(t(spark, d, "embeddings"), registry.preset_columns("minimal", 2), "embedding", ["vec_id"])


@query("SELECT vec_id, " + ", ".join(f"embedding[{at + 1}]::DOUBLE AS \"{n}\"" for at, n in KEPT if n.startswith("Ball")) + ", NULL::DOUBLE AS \"p7_boost level\" FROM embeddings")
def padded_frames(spark, d):
    ball = [n for _, n in KEPT if n.startswith("Ball")]
    df = features.deduplicate(t(spark, d, "embeddings"), registry.preset_columns("minimal", 2), "embedding", ["vec_id"])
    df = features.padded(df.select("vec_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in ball]))
    return df.select("vec_id", *[F.col(f"`{c}`") for c in ball], F.col("`p7_boost level`"))


DIVISORS = {n: registry.divisor(n) for n in PHYSICS}


@query("SELECT " + ", ".join(f"count(*) * {v}::DOUBLE AS \"{n}\"" for n, v in DIVISORS.items() if v) + " FROM embeddings")
def divisor_map(spark, d):
    found = Normalize().divisors(select_preset(spark, d).columns)
    return t(spark, d, "embeddings").agg(*[(F.count("*") * F.lit(v)).alias(n) for n, v in found.items()])


@query(f"SELECT l_orderkey, l_linenumber, {SCALED} FROM lineitem")
def normalize(spark, d):
    return Normalize(LINE)(t(spark, d, "lineitem").select(*LINE_COLUMNS))


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({c}, 6) AS {c}" for c in LINE) + " FROM lineitem")
def denormalize(spark, d):
    n = Normalize(LINE)
    df = n.inverse(n(t(spark, d, "lineitem").select(*LINE_COLUMNS)))
    return df.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in LINE])


@query(_wide_sql(PHYSICS, {n: v for n, v in DIVISORS.items() if v}))
def pipeline_chain(spark, d):
    return Chain([Select.preset("physics", 2), Normalize()])(wide(spark, d))


@query("SELECT " + ", ".join(f'round(embedding[{registry.select_columns("full", 2).index(n) % 64 + 1}]::DOUBLE, 6) AS "{n}"' for n in PHYSICS) + " FROM embeddings")
def pipeline_inverse(spark, d):
    chain = Chain([Select.preset("physics", 2), Normalize()])
    df = chain.inverse(chain(wide(spark, d)))
    return df.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) for c in df.columns])


@query("SELECT l_orderkey, l_linenumber, 'l_quantity' AS feature, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem")
def feature_series(spark, d):
    return features.feature_series(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax", "absent"])


@query(f"WITH {FRAMES} SELECT user_id, frame, value FROM f WHERE frame >= 10 AND frame < 20")
def frame_slice(spark, d):
    return features.frame_slice(frames(spark, d), 10, 20).select("user_id", "frame", "value")


@query("SELECT vec_id, list_transform(embedding[1:8], lambda x: x::DOUBLE * 0.5)[3]::FLOAT AS third FROM embeddings")
def float_cast(spark, d):
    return features.float32(t(spark, d, "embeddings").select("vec_id", (F.col("embedding")[2].cast("double") * 0.5).alias("third")), ["third"])


# --- quality

NOISE_SQL = "(SELECT vec_id, label, CASE vec_id % 10 WHEN 0 THEN list_append(embedding::DOUBLE[], 'nan'::DOUBLE) WHEN 1 THEN list_append(embedding::DOUBLE[], 'inf'::DOUBLE) ELSE embedding::DOUBLE[] END AS v FROM embeddings)"


def noisy(spark: SparkSession, d: str) -> DataFrame:
    e, r = F.col("embedding").cast("array<double>"), F.col("vec_id") % 10
    return t(spark, d, "embeddings").select("vec_id", "label", F.when(r == 0, F.array_append(e, F.lit(float("nan")))).when(r == 1, F.array_append(e, F.lit(float("inf")))).otherwise(e).alias("v"))


@query(f"SELECT label, sum(len(list_filter(v, lambda x: isnan(x))))::BIGINT AS nans, sum(len(list_filter(v, lambda x: isinf(x))))::BIGINT AS infs FROM {NOISE_SQL} GROUP BY label")
def nan_inf_counts(spark, d):
    return noisy(spark, d).groupBy("label").agg(F.sum(features.nan_count(F.col("v"))).alias("nans"), F.sum(features.inf_count(F.col("v"))).alias("infs"))


@query("SELECT user_id, count(*) AS n, CASE WHEN count(*) < 60 THEN 'too few frames' WHEN count(*) > 75 THEN 'too many frames' WHEN user_id % 10 < 2 THEN 'too few players' WHEN user_id % 10 > 8 THEN 'too many players' ELSE 'ok' END AS verdict FROM events GROUP BY user_id")
def quality_verdict(spark, d):
    n = t(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return n.select("user_id", "n", features.verdict(F.col("n"), F.col("user_id") % 10, 60, 75).alias("verdict"))


@query(f"SELECT vec_id, concat_ws(',', CASE WHEN len(list_filter(v, lambda x: isnan(x))) > 0 THEN 'NaN values' END, CASE WHEN len(list_filter(v, lambda x: isinf(x))) > 0 THEN 'Inf values' END, CASE WHEN len(v) <> 64 THEN 'column count' END) AS warnings FROM {NOISE_SQL}")
def quality_warnings(spark, d):
    v = F.col("v")
    return noisy(spark, d).select("vec_id", F.array_join(features.warnings(features.nan_count(v), features.inf_count(v), F.size(v), F.lit(64)), ",").alias("warnings"))


@query("SELECT o_orderkey, o_orderstatus <> 'P' AND o_totalprice >= 1000 AS success, CASE WHEN o_orderstatus = 'P' THEN 'Parse failed' WHEN o_totalprice < 1000 THEN 'Validation failed: too few frames' END AS error, CASE WHEN o_orderstatus = 'P' THEN -1 WHEN o_totalprice < 1000 THEN 0 ELSE o_custkey END::BIGINT AS rows FROM orders")
def format_outcome(spark, d):
    check = F.when(F.col("o_totalprice") < 1000, "too few frames").otherwise("ok")
    o = features.format_outcome(F.col("o_orderstatus") != "P", check, F.col("o_custkey"), F.lit(64))
    return t(spark, d, "orders").select("o_orderkey", o.alias("o")).select("o_orderkey", "o.success", "o.error", "o.rows")


@query("SELECT user_id, CASE WHEN count(*) > 0 AND user_id % 4 > 0 THEN count(*) / (user_id % 4)::DOUBLE ELSE 0.0 END AS seconds FROM events GROUP BY user_id")
def duration(spark, d):
    n = t(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return n.select("user_id", features.duration(F.col("n"), (F.col("user_id") % 4).cast("double")).alias("seconds"))


@query("SELECT conv_id, coalesce(CASE WHEN conv_id % 3 = 0 THEN 4::BIGINT END, nullif(count(*) FILTER (role = 'user'), 0), 6)::BIGINT AS players FROM conversations GROUP BY conv_id")
def player_count(spark, d):
    n = t(spark, d, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("n"))
    told = F.when(F.col("conv_id") % 3 == 0, F.lit(4).cast("long"))
    return n.select("conv_id", features.player_count_fallback(told, F.col("n"), F.lit(None).cast("int")).cast("long").alias("players"))


# --- ledger


def parsed_keys(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("parsed_key")).agg(F.count("*").alias("frame_count"), F.sum("l_quantity").alias("bytes"))


P = "p AS (SELECT l_orderkey AS parsed_key, count(*) AS frame_count, sum(l_quantity) AS bytes FROM lineitem GROUP BY 1)"


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> ''")
def catalogue_scan(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "parsed").otherwise("failed")
    return ledger.catalogue(t(spark, d, "orders").withColumn("status", status), "status", "o_orderpriority").select("o_orderkey", "o_custkey")


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1")
def status_filter(spark, d):
    return ledger.with_status(t(spark, d, "orders"), ["o_orderstatus"], "o_orderstatus", "F", "P").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def pending_anti(spark, d):
    return ledger.pending(t(spark, d, "orders").select("o_orderkey"), t(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@query(f"WITH {P} SELECT parsed_key, o_custkey FROM p LEFT JOIN orders ON o_orderkey = parsed_key AND o_orderstatus = 'F' WHERE frame_count < 3")
def failed_left_join(spark, d):
    raw = t(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return ledger.failed_with_source(parsed_keys(spark, d).filter("frame_count < 3"), raw, "parsed_key", "o_orderkey", ["o_custkey"])


@query(f"WITH {P} SELECT parsed_key, o_orderpriority, coalesce(o_orderstatus = 'F', false) AS is_rlcs FROM p LEFT JOIN orders ON o_orderkey = parsed_key")
def inherit_attrs(spark, d):
    return ledger.inherit(parsed_keys(spark, d).select("parsed_key"), t(spark, d, "orders"), "parsed_key", "o_orderkey", ["o_orderpriority"], F.col("o_orderstatus") == "F")


@query("SELECT doc_id, 'old' AS origin FROM (SELECT DISTINCT doc_id FROM labels) UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def insert_if_absent(spark, d):
    old = t(spark, d, "labels").select("doc_id").distinct().withColumn("origin", F.lit("old"))
    return ledger.insert_if_absent(old, t(spark, d, "documents").select("doc_id", F.lit("new").alias("origin")), "doc_id")


@query(f"WITH {P} SELECT coalesce(o_orderkey, parsed_key) AS key, CASE WHEN parsed_key IS NOT NULL THEN nullif(frame_count, 4) ELSE o_custkey END AS n, o_orderpriority AS kept FROM orders FULL JOIN p ON o_orderkey = parsed_key")
def upsert_latest(spark, d):
    table = t(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("n"), F.col("o_orderpriority").alias("kept"))
    new = parsed_keys(spark, d).select(F.col("parsed_key").alias("key"), F.nullif(F.col("frame_count"), F.lit(4)).alias("n"))
    return ledger.upsert(table, new, "key", ["n"])


@query("SELECT user_id, arg_max(event_type, event_id) AS status, CASE WHEN arg_max(event_type, event_id) <> 'parsed' THEN arg_max(props, event_id) END AS error, arg_max(value, event_id) FILTER (event_type = 'parsed') AS value FROM (SELECT * REPLACE (CASE WHEN event_type IN ('error', 'click') THEN event_type ELSE 'parsed' END AS event_type) FROM events) GROUP BY user_id")
def event_fold(spark, d):
    kind = F.when(F.col("event_type").isin("error", "click"), F.col("event_type")).otherwise("parsed")
    return ledger.fold_events(t(spark, d, "events").select("user_id", "event_id", kind.alias("kind"), F.col("props").alias("error"), "value"), "user_id", "event_id", "kind", ["value"])


@query(f"WITH {P} SELECT o_orderkey, CASE WHEN parsed_key IS NOT NULL THEN bytes ELSE o_totalprice END AS o_totalprice FROM orders LEFT JOIN p ON parsed_key = o_orderkey AND frame_count > 3")
def backfill_update(spark, d):
    updates = parsed_keys(spark, d).filter("frame_count > 3").select(F.col("parsed_key").alias("o_orderkey"), F.col("bytes").alias("o_totalprice"))
    return ledger.replace_matched(t(spark, d, "orders").select("o_orderkey", "o_totalprice"), updates, "o_orderkey", ["o_totalprice"])


@query("SELECT c_custkey, coalesce(c.nation, b.seg, c_name) AS title FROM customer LEFT JOIN (SELECT c_custkey AS k, c_mktsegment AS seg FROM customer WHERE c_custkey % 2 = 0) b ON k = c_custkey LEFT JOIN (SELECT c_custkey AS kk, 'n' || c_nationkey AS nation FROM customer WHERE c_custkey % 3 = 0) c ON kk = c_custkey")
def metadata_merge(spark, d):
    c = t(spark, d, "customer")
    base, stored, side = c.select("c_custkey", F.col("c_name").alias("title")), c.filter("c_custkey % 2 = 0").select("c_custkey", F.col("c_mktsegment").alias("title")), c.filter("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("n"), "c_nationkey").alias("title"))
    return ledger.metadata_merge(base, stored, side, "c_custkey", ["title"])


@query(f"WITH {P} SELECT count(frame_count) AS n, round(avg(frame_count), 9) AS mean, round(stddev_pop(frame_count), 9) AS std, min(frame_count) AS low, max(frame_count) AS high, median(frame_count) AS median, sum(frame_count)::BIGINT AS total FROM p")
def frame_count_summary(spark, d):
    return ledger.frame_summary(parsed_keys(spark, d), "frame_count").withColumns({c: F.round(c, 9) for c in ("mean", "std")})


RAW_STATS = "SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS downloaded, count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) - count(*) FILTER (o_orderstatus = 'F') - count(*) FILTER (o_orderstatus = 'P') AS pending, coalesce(sum(o_custkey), 0)::BIGINT AS bytes FROM orders"
PARSE_STATS = f"WITH {P} SELECT count(*) AS entries, count(*) FILTER (frame_count >= 3) AS parsed, count(*) FILTER (frame_count < 3) AS failed_parses, sum(CASE WHEN frame_count >= 3 THEN frame_count END)::BIGINT AS total_frames FROM p"


@query(RAW_STATS)
def raw_stats(spark, d):
    return ledger.download_statistics(t(spark, d, "orders"), F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P", "o_custkey").drop("mb", "gb")


@query(PARSE_STATS)
def parse_stats(spark, d):
    stats = ledger.parse_statistics(parsed_keys(spark, d), F.col("frame_count") >= 3, "frame_count", "bytes")
    return stats.select("entries", "parsed", "failed_parses", "total_frames")


@query(f"SELECT * FROM ({RAW_STATS}) a, ({PARSE_STATS}) b")
def full_stats(spark, d):
    return ledger.full_statistics(raw_stats(spark, d), parse_stats(spark, d))


STATE = "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) FILTER (o_orderstatus = 'O') AS skipped FROM orders GROUP BY 1"


def states(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_custkey").agg(*[F.count_if(F.col("o_orderstatus") == s).alias(n) for s, n in (("F", "done"), ("P", "failed"), ("O", "skipped"))])


@query(f"SELECT o_custkey, done, failed, CASE WHEN failed = 0 THEN 'complete' WHEN done > 0 THEN 'partial' ELSE 'failed' END AS status FROM ({STATE})")
def group_status(spark, d):
    return states(spark, d).select("o_custkey", "done", "failed", ledger.group_state(F.col("done"), F.col("failed")).alias("status"))


@query(f"SELECT o_custkey, CASE WHEN failed = 0 THEN 'complete' WHEN done > 0 OR skipped > 0 THEN 'partial' ELSE 'failed' END AS status FROM ({STATE})")
def finalize_status(spark, d):
    return states(spark, d).select("o_custkey", ledger.group_state(F.col("done"), F.col("failed"), F.col("skipped")).alias("status"))


@query(f"WITH {P} SELECT count(*) AS total, count(*) FILTER (frame_count >= 3) AS successful, count(*) FILTER (frame_count < 3) AS failed, sum(frame_count)::BIGINT AS frames, round(sum(bytes), 2) AS bytes FROM p")
def batch_result(spark, d):
    ok = F.col("frame_count") >= 3
    return parsed_keys(spark, d).agg(F.count("*").alias("total"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), F.sum("frame_count").alias("frames"), F.round(F.sum("bytes"), 2).alias("bytes"))


OUTCOME = "CASE o_orderstatus WHEN 'F' THEN 'parsed' WHEN 'O' THEN 'skipped' ELSE 'failed' END"


@query(f"SELECT o_orderdate, count(*) AS total, count(*) FILTER (o = 'parsed') AS successful, count(*) FILTER (o = 'skipped') AS skipped, count(*) FILTER (o = 'failed') AS failed, coalesce(sum(CASE WHEN o = 'parsed' THEN o_custkey END), 0)::BIGINT AS frames, coalesce(sum(CASE WHEN o = 'parsed' THEN o_custkey END), 0)::BIGINT AS bytes, coalesce(string_agg(CASE WHEN o = 'parsed' THEN 'out/' || o_orderkey END, ',' ORDER BY 'out/' || o_orderkey), '') AS output_paths, coalesce(string_agg(CASE WHEN o = 'failed' THEN o_orderkey || ':' || o_orderpriority END, ',' ORDER BY o_orderkey), '') AS errors FROM (SELECT *, {OUTCOME} AS o FROM orders) GROUP BY 1")
def batch_report(spark, d):
    kind = F.when(F.col("o_orderstatus") == "F", "parsed").when(F.col("o_orderstatus") == "O", "skipped").otherwise("failed")
    rows = t(spark, d, "orders").select("o_orderdate", "o_orderkey", kind.alias("outcome"), F.when(kind == "parsed", F.col("o_custkey")).alias("frames"), F.col("o_custkey").alias("bytes"), F.concat(F.lit("out/"), "o_orderkey").alias("output_path"), F.col("o_orderpriority").alias("error"))
    lists = F.array_join(F.array_sort(F.collect_list(F.col("v"))), ",")
    paths_of = ledger.batch_outputs(rows, ["o_orderdate"]).withColumnRenamed("output_path", "v").groupBy("o_orderdate").agg(lists.alias("output_paths"))
    errors = ledger.batch_errors(rows, "o_orderkey", ["o_orderdate"]).groupBy("o_orderdate").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "error"))), lambda e: F.concat(e["o_orderkey"].cast("string"), F.lit(":"), e["error"])), ",").alias("errors"))
    out = ledger.batch_result(rows, ["o_orderdate"]).join(paths_of, "o_orderdate", "left").join(errors, "o_orderdate", "left")
    return out.fillna("", ["output_paths", "errors"])


@query("SELECT count(*) AS total, coalesce(sum(o_custkey), 0)::BIGINT AS bytes, round(sum(o_custkey) / 1048576.0::DOUBLE, 2) AS mb, round(sum(o_custkey) / 1073741824.0::DOUBLE, 2) AS gb FROM orders")
def download_sizes(spark, d):
    return ledger.download_statistics(t(spark, d, "orders"), F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P", "o_custkey").select("total", "bytes", "mb", "gb")


@query("SELECT count(*) AS files, sum(octet_length(encode(html)))::BIGINT AS bytes, round(sum(octet_length(encode(html))) / 1048576.0::DOUBLE, 2) AS mb, round(sum(octet_length(encode(html))) / 1073741824.0::DOUBLE, 2) AS gb FROM pages WHERE url LIKE 'http%'")
def prefix_stats(spark, d):
    return paths.storage_statistics(t(spark, d, "pages").select(F.col("url").alias("path"), F.octet_length("html").cast("long").alias("length")), "http")


@query("SELECT doc_id, 'key ' || doc_id AS ballchasing_id, source AS map, lang AS match_type, n_chars::VARCHAR AS team_size, NULL::VARCHAR AS date, CASE WHEN n_chars > 1000 THEN '[1]' ELSE '[]' END AS goals, '[]' AS highlights FROM documents")
def header_fields(spark, d):
    pairs = [("Id", F.concat(F.lit("key "), "doc_id")), ("MapName", F.lit("first")), ("MatchType", F.col("lang")), ("TeamSize", F.col("n_chars").cast("string")), ("MapName", F.col("source"))]
    listed = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])
    goals = F.when(F.col("n_chars") > 1000, F.array(F.struct(F.lit("Goals").alias("key"), F.lit("[1]").alias("value")))).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    out = metadata.header_fields(t(spark, d, "documents").withColumn("pairs", F.concat(listed, goals)), ["doc_id"], "pairs")
    return out.select("doc_id", "ballchasing_id", "map", "match_type", "team_size", "date", "goals", "highlights")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_snapshot(spark, d):
    return ledger.latest_snapshot(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("SELECT doc_id, n_chars AS size, 'parsed' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def process_pending(spark, d):
    return run_pending(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id", "doc_id", lambda df: df.select("doc_id", F.col("n_chars").alias("size"), F.lit("parsed").alias("status")))


@query("SELECT doc_id, CASE WHEN l.k IS NOT NULL THEN 'skip' WHEN n_chars > 1000 THEN 'mark' ELSE 'fetch' END AS action, CASE WHEN l.k IS NULL AND n_chars > 1000 THEN n_chars END AS size FROM documents LEFT JOIN (SELECT DISTINCT doc_id AS k FROM labels) l ON k = doc_id")
def skip_decision(spark, d):
    known = t(spark, d, "labels").select(F.col("doc_id").alias("k")).distinct()
    df = t(spark, d, "documents").select("doc_id", "n_chars").join(known, F.col("doc_id") == F.col("k"), "left")
    return df.select("doc_id", ledger.skip_decision(F.col("k").isNotNull(), F.col("n_chars") > 1000, F.col("n_chars")).alias("s")).select("doc_id", "s.action", "s.size")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'P') = 0)")
def group_early_exit(spark, d):
    return ledger.to_visit(t(spark, d, "orders"), group_status(spark, d), "o_custkey").select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, o_custkey, NULL::BIGINT AS duration FROM orders")
def add_columns(spark, d):
    return ledger.with_columns(t(spark, d, "orders").select("o_orderkey", "o_custkey"), {"duration": "bigint", "o_custkey": "string"})


# --- sampling

KEY = "md5('42|' || c_custkey)"


@query(f"SELECT c_custkey FROM customer ORDER BY {KEY}, c_custkey LIMIT 50")
def sample_ids(spark, d):
    return sampling.sample_ids(t(spark, d, "customer").select("c_custkey"), "c_custkey", 50)


@query(f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT c_custkey FROM customer ORDER BY {KEY}, c_custkey LIMIT 50)")
def sample_rows(spark, d):
    return ledger.keep_ids(t(spark, d, "customer"), sample_ids(spark, d), "c_custkey").select("c_custkey", "c_name")


@query(f"SELECT c_custkey, CASE WHEN r < floor(n * 0.7::DOUBLE) THEN 'train' WHEN r < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM (SELECT c_custkey, row_number() OVER (ORDER BY {KEY} || '|' || c_custkey) - 1 AS r, count(*) OVER () AS n FROM customer)")
def split_ids(spark, d):
    return sampling.split_ids(t(spark, d, "customer").select("c_custkey"), "c_custkey")


@query("SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) // 100)::BIGINT AS batch_id FROM customer")
def batch_assign(spark, d):
    return ledger.batch_ids(t(spark, d, "customer").select("c_custkey"), "c_custkey", 100)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def id_subset_semi(spark, d):
    ids = t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return ledger.keep_ids(t(spark, d, "orders"), ids, "o_custkey").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 20")
def first_rows(spark, d):
    return ledger.limited(t(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"), "o_orderkey", 20)


# --- paths

SAN = "trim(translate({}, '<>:\"/\\|?*', '_________'), '. ')"


@query(f"SELECT page_id, {SAN.format('url')} AS clean FROM pages")
def sanitize_path(spark, d):
    return t(spark, d, "pages").select("page_id", paths.sanitize(F.col("url")).alias("clean"))


@query(f"SELECT page_id, CASE WHEN c[1] = {SAN.format('r')} THEN array_to_string(c[2:], '/') ELSE array_to_string(c, '/') END AS path FROM (SELECT page_id, r, list_transform(p, lambda x: {SAN.format('x')}) AS c FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'http:' ELSE 'other' END AS r, string_split(replace(url, 'https:', 'http:'), '/') AS p FROM pages))")
def build_path(spark, d):
    root = F.when(F.col("page_id") % 2 == 0, "http:").otherwise("other")
    parts = F.split(F.replace("url", F.lit("https:"), F.lit("http:")), "/")
    out = paths.build_path(parts, root)
    return t(spark, d, "pages").select("page_id", F.array_join(out, "/").alias("path"))


@query("SELECT c_custkey AS leaf_id, r_name || '/' || n_name AS path FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def tree_paths(spark, d):
    r = t(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name"))
    n = t(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("name"))
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("leaf_id"), F.concat(F.lit("n"), "c_nationkey").alias("group_id"))
    return paths.tree_paths(r.unionByName(n), c).select("leaf_id", F.array_join("path", "/").alias("path"))


@query("SELECT doc_id, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.2f KB', n / 1024.0::DOUBLE) WHEN n < 1073741824 THEN printf('%.2f MB', n / 1048576.0::DOUBLE) ELSE printf('%.2f GB', n / 1073741824.0::DOUBLE) END AS size FROM (SELECT doc_id, n_chars * 997 * (1 + doc_id % 500) + 1 AS n FROM documents)")
def format_bytes(spark, d):
    n = F.col("n_chars") * 997 * (1 + F.col("doc_id") % 500) + 1
    return t(spark, d, "documents").select("doc_id", paths.format_bytes(n).alias("size"))


@query("SELECT page_id, 'replays/parsed/' || CASE WHEN raw IS NULL THEN page_id::VARCHAR ELSE replace(CASE WHEN starts_with(raw, 'replays/raw/') THEN substr(raw, 13) ELSE raw END, '.replay', '') END || '.parquet' AS key FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'replays/raw/' || url || '.replay' WHEN 1 THEN url END AS raw FROM pages)")
def mirror_key(spark, d):
    raw = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("replays/raw/"), "url", F.lit(".replay"))).when(F.col("page_id") % 3 == 1, F.col("url"))
    return t(spark, d, "pages").select("page_id", paths.mirror_key(raw, F.col("page_id").cast("string")).alias("key"))


@query("SELECT page_id, array_to_string(string_split(url, '/'), '/') || '/' || page_id || '.replay' AS key FROM pages")
def storage_key(spark, d):
    return t(spark, d, "pages").select("page_id", paths.storage_key(F.split("url", "/"), F.col("page_id").cast("string")).alias("key"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'a/' || doc_id ELSE 'b/' || doc_id END AS path FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0")
def resolve_paths(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    listing = docs.filter("doc_id % 2 = 0").select(F.concat(F.lit("a/"), "doc_id").alias("path")).unionByName(docs.filter("doc_id % 3 = 0").select(F.concat(F.lit("b/"), "doc_id").alias("path")))
    return paths.resolve(docs, listing, "doc_id", [F.concat(F.lit("a/"), "doc_id"), F.concat(F.lit("b/"), "doc_id")])


@query("SELECT source, count(*) AS files, sum(n_chars)::BIGINT AS bytes, round(sum(n_chars) / 1048576.0::DOUBLE, 2) AS mb FROM documents GROUP BY 1")
def storage_stats(spark, d):
    return t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("files"), F.sum("n_chars").alias("bytes"), ledger.megabytes(F.sum("n_chars")).alias("mb"))


@query("SELECT 'events' AS replay_id, event_id, user_id FROM events")
def scan_directory(spark, d):
    return scan(spark, f"{d}/events.parquet").select("replay_id", "event_id", "user_id")


# --- metadata


@query("SELECT event_id, 'Unknown' AS title, 'Unknown' AS blue_team, json_extract(props, '$.k')::BIGINT AS duration, 0 AS overtime FROM events")
def json_flatten(spark, d):
    record = F.concat(F.lit('{"id":"'), "event_id", F.lit('","duration":'), F.get_json_object("props", "$.k"), F.lit(',"blue":{"goals":3}}'))
    flat = metadata.flatten_record(t(spark, d, "events").select(record.alias("record")))
    return flat.select(F.col("replay_id").cast("long").alias("event_id"), "title", "blue_team", "duration", "overtime")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, 'Unknown') AS title, 'Unknown' AS date FROM customer")
def short_metadata(spark, d):
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    s = metadata.short_metadata(k.cast("string"), F.when(k % 2 == 0, F.col("c_name")), F.when(k % 3 == 0, F.col("c_mktsegment")), F.col("c_name"), F.col("c_name"), none)
    return t(spark, d, "customer").select("c_custkey", s.alias("s")).select("c_custkey", "s.title", "s.date")


@query("SELECT vec_id, 'c' AS map, 'd' AS title FROM embeddings")
def header_extraction(spark, d):
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("map", "a"), ("title", "d"), ("map", "c"))])
    m = t(spark, d, "embeddings").select("vec_id", metadata.header_map(pairs).alias("m"))
    return m.select("vec_id", F.try_element_at("m", F.lit("map")).alias("map"), F.try_element_at("m", F.lit("title")).alias("title"))


def sides(spark: SparkSession, d: str) -> DataFrame:
    def side(role: str):
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.col("turn")))), lambda x: x)

    return t(spark, d, "conversations").groupBy("conv_id").agg(side("user").alias("zero"), side("assistant").alias("one"))


ROSTER = "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY team, turn, role) - 1 AS slot, team, turn AS player FROM (SELECT *, CASE role WHEN 'user' THEN 0 ELSE 1 END AS team FROM conversations WHERE role IN ('user', 'assistant') AND conv_id IS NOT NULL AND turn IS NOT NULL)"


@query(f"SELECT conv_id, slot::INTEGER AS slot, team, player FROM ({ROSTER})")
def roster(spark, d):
    return metadata.roster(sides(spark, d).filter("conv_id is not null"), ["conv_id"], "zero", "one")


@query(f"SELECT conv_id, slot::INTEGER AS slot, team, (row_number() OVER (PARTITION BY conv_id, team ORDER BY slot) - 1)::BIGINT AS team_order FROM ({ROSTER})")
def roster_order(spark, d):
    return metadata.order_in_team(roster(spark, d), ["conv_id"], "team", "slot").select("conv_id", "slot", "team", "team_order")


@query("SELECT n_nationkey, k::INTEGER AS slot, CASE WHEN k = 1 AND n_nationkey % 2 = 0 THEN n_name ELSE 'Player ' || k END AS name, CASE WHEN k = 1 AND n_nationkey % 2 = 0 THEN 0 WHEN k < 2 THEN 0 ELSE 1 END AS team FROM nation, unnest(range(0, 5)) u(k)")
def roster_defaults(spark, d):
    n = t(spark, d, "nation").withColumn("n", F.lit(5))
    mapping = n.filter("n_nationkey % 2 = 0").select("n_nationkey", F.lit(1).alias("slot"), F.col("n_name").alias("name"), F.lit(None).cast("int").alias("team"))
    return metadata.roster_defaults(n, "n_nationkey", "n", mapping)


# --- spatial


@query("SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN round(embedding[1]::DOUBLE + embedding[2]::DOUBLE + embedding[3]::DOUBLE, 6) END AS total FROM embeddings")
def entity_positions(spark, d):
    x, y, z = (F.col("embedding")[i].cast("double") for i in range(3))
    p = features.entity_position(F.when(F.col("vec_id") % 7 != 0, x).otherwise(F.lit(float("nan"))), y, z)
    return t(spark, d, "embeddings").select("vec_id", p.alias("p")).select("vec_id", F.round(F.col("p.x") + F.col("p.y") + F.col("p.z"), 6).alias("total"))


@query("SELECT vec_id, round(2 * (x * y - z * w) / n, 6) AS x, round(1 - 2 * (x * x + z * z) / n, 6) AS y, round(2 * (y * z + x * w) / n, 6) AS z FROM (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS w, x * x + y * y + z * z + w * w AS n FROM embeddings)")
def orientation_forward(spark, d):
    v = features.forward(*(F.col("embedding")[i].cast("double") for i in range(4)))
    return t(spark, d, "embeddings").select("vec_id", v.alias("v")).select("vec_id", *[F.round(F.col(f"v.{a}"), 6).alias(a) for a in "xyz"])
