"""Registered queries of loading, path rules, stores, shards, trees and ledger updates, with their SQL oracles.

The driver tables stand in for telemetry as in queries.py.  What a query writes goes to a new folder of the shared one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import metadata, paths
from .operators import features, ledger, segments
from .operators.storage import shared_folder
from .plans import registry
from .plans.steps import Chain, Normalize
from .queries import SEGS, SIZE, STRIDE, WINS, frames, query, segs, t
from .sources import trees, writing
from .sources import frames as sources
from .sources.loading import load_sample, load_series
from .streaming.incremental import Store, drain_to_store, retry_failed, run_pending

# --- loading and paths


def written_types(spark, d):
    """Events as series of their type, written one file each: (root, catalogue with the nations' names as series without files)."""
    root = shared_folder(spark, "series")
    df = t(spark, d, "events").select(F.col("event_type").alias("replay_id"), F.col("event_id").alias("frame"), "value")
    writing.write_series(df, root, per_series=True)
    held = writing.inventory(spark, root).select("replay_id", "output_path")
    nations = t(spark, d, "nation").select(F.col("n_name").alias("replay_id"), F.concat(F.lit("gone/"), "n_name", F.lit(".parquet")).alias("output_path"))
    return root, held.unionByName(nations)


@query("SELECT event_type AS id, count(*) AS rows, round(sum(value), 2) AS total, NULL AS error FROM events GROUP BY 1 UNION ALL SELECT n_name, NULL, NULL, 'file not found' FROM nation")
def load_report(spark, d):
    root, catalogue = written_types(spark, d)
    got = load_series(spark, catalogue, root, "replay_id string, frame long, value double")
    read = got.frames.groupBy("replay_id").agg(F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total"))
    return got.report.select("replay_id", "error").join(read, "replay_id", "left").select(F.col("replay_id").alias("id"), "rows", "total", "error")


@query("SELECT o_custkey AS id, count(*) AS rows, true AS whole FROM orders GROUP BY 1")
def written_inventory(spark, d):
    """Orders written as series of their customers, several a file: rows of each, and whether the shares of bytes add up to the files."""
    root = shared_folder(spark, "series")
    writing.write_series(t(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("frame"), "o_totalprice"), root, "id")
    held = writing.inventory(spark, root, "id", "long")
    size = sources.list_files(spark, root, "*.parquet").agg(F.sum("length")).first()[0]
    return held.select("id", "rows", F.lit(held.agg(F.sum("bytes")).first()[0] == size).alias("whole"))


@query("SELECT event_type AS id, count(*) AS rows FROM events WHERE event_type IN (SELECT id FROM (SELECT DISTINCT event_type AS id FROM events UNION ALL SELECT n_name FROM nation) ORDER BY md5('42|' || id), id LIMIT 12) GROUP BY 1")
def load_sampled(spark, d):
    root, catalogue = written_types(spark, d)
    got = load_sample(spark, catalogue, root, "replay_id string, frame long, value double", n=12)
    return got.frames.groupBy(F.col("replay_id").alias("id")).agg(F.count("*").alias("rows"))


#: path part of a page's address, and its last part
OUT, LAST = "regexp_replace(url, '^https?://', '')", "split_part(regexp_replace(url, '^https?://', ''), '/', -1)"
N = "length(html)"


def pages(spark, d):
    """Pages with a path on record (out), its last part, and the length of the page, which decides where its file is."""
    out = F.regexp_replace("url", "^https?://", "")
    return t(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), out.alias("out"), paths.file_name(out).alias("last"), F.length("html").alias("n"))


def listed(df, *choices):
    """A listing of the paths that choices (condition, path) give."""
    return df.select(F.explode(F.array_compact(F.array(*[F.when(c, p) for c, p in choices]))).alias("path"))


@query(f"""WITH p AS (SELECT page_id::VARCHAR AS id, CASE WHEN {N} % 5 = 0 THEN '/abs/' || {OUT} ELSE {OUT} END AS o, {LAST} AS last, {N} AS n, {OUT} AS out FROM pages),
 l AS (SELECT '/cache/' || id || '.parquet' AS path FROM p WHERE n % 7 = 0 UNION SELECT '/abs/' || out FROM p WHERE n % 2 = 0 UNION SELECT '/data/' || out FROM p WHERE n % 3 = 0 UNION SELECT '/data/' || last FROM p WHERE n % 3 = 1)
 SELECT id, coalesce(a.path, b.path, c.path, e.path, 's3://store/' || o) AS path, CASE WHEN a.path IS NOT NULL THEN '0' WHEN b.path IS NOT NULL THEN '1' WHEN c.path IS NOT NULL THEN '2' WHEN e.path IS NOT NULL THEN '3' ELSE 'otherwise' END AS rule
 FROM p LEFT JOIN l a ON a.path = '/cache/' || id || '.parquet' LEFT JOIN l b ON b.path = o LEFT JOIN l c ON c.path = '/data/' || o AND n % 5 <> 0 LEFT JOIN l e ON e.path = '/data/' || last AND n % 5 <> 0""")
def locate_parsed(spark, d):
    p, n = pages(spark, d), F.col("n")
    data = F.lit("/data/")
    have = listed(p, (n % 7 == 0, F.concat(F.lit("/cache/"), "id", F.lit(".parquet"))), (n % 2 == 0, F.concat(F.lit("/abs/"), "out")), (n % 3 == 0, F.concat(data, "out")), (n % 3 == 1, F.concat(data, "last")))
    wanted = p.withColumn("o", F.when(n % 5 == 0, F.concat(F.lit("/abs/"), "out")).otherwise(F.col("out")))
    return paths.locate_parsed(wanted, have, "id", "o", "/data", "/cache", "store")


@query(f"""WITH p AS (SELECT page_id::VARCHAR AS id, {OUT} || '.replay' AS o, {N} AS n FROM pages),
 l AS (SELECT '/raw/' || o AS path FROM p WHERE n % 4 = 0 UNION SELECT '/raw/' || id || '.replay' FROM p WHERE n % 4 = 1 UNION SELECT '/raw/' || o || '/' || id || '.replay' FROM p WHERE n % 4 = 2 UNION SELECT '/raw/b/' || id || '.replay' FROM p WHERE n % 8 = 2),
 m AS (SELECT split_part(path, '/', -1) AS name, min(path) AS path FROM l GROUP BY 1)
 SELECT id, coalesce(a.path, b.path, m.path) AS path, CASE WHEN a.path IS NOT NULL THEN '0' WHEN b.path IS NOT NULL THEN '1' WHEN m.path IS NOT NULL THEN 'anywhere' END AS rule
 FROM p LEFT JOIN l a ON a.path = '/raw/' || o LEFT JOIN l b ON b.path = '/raw/' || id || '.replay' LEFT JOIN m ON m.name = id || '.replay'""")
def locate_raw(spark, d):
    p, n = pages(spark, d).withColumn("o", F.concat("out", F.lit(".replay"))), F.col("n")
    own, raw = F.concat("id", F.lit(".replay")), F.lit("/raw/")
    have = listed(p, (n % 4 == 0, F.concat(raw, "o")), (n % 4 == 1, F.concat(raw, own)), (n % 4 == 2, F.concat(raw, "o", F.lit("/"), own)), (n % 8 == 2, F.concat(F.lit("/raw/b/"), own)))
    return paths.locate_raw(p, have, "id", "o", "/raw")


@query(f"""WITH p AS (SELECT page_id::VARCHAR AS id, CASE WHEN {N} % 5 = 0 THEN '/abs/' || {OUT} ELSE {OUT} END AS o, {LAST} AS last, {N} AS n, {OUT} AS out FROM pages),
 l AS (SELECT '/abs/' || out AS path FROM p WHERE n % 2 = 0 UNION SELECT '/data/' || out FROM p WHERE n % 3 = 0 UNION SELECT '/data/' || last FROM p WHERE n % 7 = 1 UNION SELECT '/data/' || id || '.parquet' FROM p WHERE n % 11 < 4)
 SELECT id, coalesce(b.path, c.path, e.path, g.path) AS path, CASE WHEN b.path IS NOT NULL THEN '0' WHEN c.path IS NOT NULL THEN '1' WHEN e.path IS NOT NULL THEN '2' WHEN g.path IS NOT NULL THEN '3' END AS rule
 FROM p LEFT JOIN l b ON b.path = o AND n % 5 = 0 LEFT JOIN l c ON c.path = '/data/' || o LEFT JOIN l e ON e.path = '/data/' || last LEFT JOIN l g ON g.path = '/data/' || id || '.parquet'""")
def locate_for_backfill(spark, d):
    p, n = pages(spark, d), F.col("n")
    data = F.lit("/data/")
    have = listed(p, (n % 2 == 0, F.concat(F.lit("/abs/"), "out")), (n % 3 == 0, F.concat(data, "out")), (n % 7 == 1, F.concat(data, "last")), (n % 11 < 4, F.concat(data, "id", F.lit(".parquet"))))
    wanted = p.withColumn("o", F.when(n % 5 == 0, F.concat(F.lit("/abs/"), "out")).otherwise(F.col("out")))
    return paths.locate_for_backfill(wanted, have, "id", "o", "/data")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = (SELECT max(l_orderkey) FROM lineitem)")
def catalogue_lookup(spark, d):
    key = t(spark, d, "lineitem").agg(F.max("l_orderkey")).first()[0]
    return ledger.lookup(t(spark, d, "orders"), "o_orderkey", key).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT d.doc_id, coalesce(n, 0)::BIGINT AS size FROM documents d LEFT JOIN (SELECT doc_id, sum(quality) + 5 AS n FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id")
def stored_sizes(spark, d):
    listing = t(spark, d, "labels").groupBy(F.col("doc_id").alias("stem")).agg((F.sum("quality") + 5).alias("length"))
    return sources.file_sizes(t(spark, d, "documents").select("doc_id"), listing, "doc_id")


@query("""WITH d AS (SELECT doc_id, text, len(string_split(text, chr(10))) AS n FROM documents)
 SELECT doc_id::VARCHAR AS path, text <> '' AND n > 1 AS ok, CASE WHEN text IS NULL THEN 'File not found: ' || doc_id WHEN text = '' THEN 'Parsing failed: empty' WHEN n = 1 THEN 'Expected 2D array, got 1D' END AS error,
 CASE WHEN text <> '' THEN n END AS lines, CASE WHEN text IS NULL OR text = '' THEN -1 WHEN n = 1 THEN 2 ELSE n END::BIGINT AS num_frames, CASE WHEN n > 1 THEN n END AS frames,
 CASE WHEN n > 1 THEN list_sum(list_transform(string_split(text, chr(10)), lambda x: length(x)))::BIGINT END AS chars FROM d""")
def decode_outcomes(spark, d):
    """Documents as raw files through a decoder: outcomes with metadata, and the frames that the same pass gives."""

    def lines_of(content):
        """A decoder for documents: their lines are frames of (characters, words); an empty one is broken, one line alone is flat."""
        text = content.decode()
        if not text:
            raise ValueError("empty")
        rows = [[float(len(line)), float(line.count(" ") + 1)] for line in text.split("\n")]
        return {"lines": len(rows)}, rows if len(rows) > 1 else rows[0]

    files = t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))
    both = sources.stored(sources.decode(files, lines_of))
    frames_of = both.filter("frame is not null").groupBy("path").agg(F.count("*").alias("frames"), F.sum(F.col("values")[0]).cast("long").alias("chars"))
    out = both.filter("frame is null").join(frames_of, "path", "left")
    return out.select("path", "ok", "error", F.get_json_object("metadata", "$.lines").cast("long").alias("lines"), "num_frames", "frames", "chars")


@query("SELECT event_type AS replay_id, count(*) AS n, count(DISTINCT user_id) AS users, max(event_id) AS last FROM events GROUP BY 1")
def sidecar_roundtrip(spark, d):
    side = t(spark, d, "events").groupBy(F.col("event_type").alias("replay_id")).agg(F.count("*").alias("n"), F.struct(F.countDistinct("user_id").alias("users"), F.max("event_id").alias("last")).alias("more"))
    root = shared_folder(spark, "sidecars")
    sources.write_sidecar(side, root)
    return sources.read_sidecar(spark, root, "replay_id string, n long, more struct<users:long,last:long>").select("replay_id", "n", "more.users", "more.last")


# --- long layout, casts

V = "list_slice(list_concat(embedding, embedding, embedding), 1, 22 + 24 * n)"


@query(f"""WITH e AS (SELECT vec_id, 2 + 2 * (label % 3) AS n, embedding FROM embeddings), v AS (SELECT vec_id, n, {V} AS v, unnest(range(-1, n)) AS s FROM e),
 b AS (SELECT vec_id, s, CASE WHEN s < 0 THEN 4 ELSE 23 + 24 * s END AS p, 23 + 24 * s + 15 AS q, v FROM v),
 w AS (SELECT vec_id, s, v[p]::DOUBLE AS px, v[p + 1]::DOUBLE AS py, v[p + 2]::DOUBLE AS pz, v[q]::DOUBLE AS x, v[q + 1]::DOUBLE AS y, v[q + 2]::DOUBLE AS z, v[q + 3]::DOUBLE AS w FROM b)
 SELECT vec_id, CASE WHEN s < 0 THEN 'ball' ELSE 'p' || s END AS entity, round(px, 5) AS px, round(py, 5) AS py, round(pz, 5) AS pz,
 CASE WHEN s >= 0 THEN round(2 * (x * y - z * w) / (x * x + y * y + z * z + w * w), 5) END AS fx, CASE WHEN s >= 0 THEN round(1 - 2 * (x * x + z * z) / (x * x + y * y + z * z + w * w), 5) END AS fy FROM w""")
def entity_layout(spark, d):
    n = 2 + 2 * (F.col("label") % 3)
    e = F.col("embedding").cast("array<double>")
    raw = t(spark, d, "embeddings").select("vec_id", n.alias("n"), F.slice(F.concat(e, e, e), F.lit(1), 22 + 24 * n).alias("values"))
    poses = features.entity_poses(features.entity_frames(raw, ["vec_id"], "n"), ["vec_id"])
    return poses.select("vec_id", "entity", *[F.round(f"position.{a}", 5).alias(f"p{a}") for a in "xyz"], *[F.round(f"forward.{a}", 5).alias(f"f{a}") for a in "xy"])


@query("SELECT l_orderkey::FLOAT AS l_orderkey, l_quantity::FLOAT AS l_quantity, l_returnflag FROM lineitem")
def float_export(spark, d):
    return features.float32(t(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"))


@query("SELECT vec_id, len(embedding) - (13 + 15 * (label % 4)) AS off FROM embeddings")
def expected_columns(spark, d):
    n = F.create_map(*[F.lit(x) for k in range(4) for x in (k, registry.expected_count(*registry.PARSE_PRESETS["minimal"], k))])
    return t(spark, d, "embeddings").select("vec_id", (F.size("embedding") - n[F.col("label") % 4]).cast("long").alias("off"))


# --- windows


@query(f"""WITH {WINS}, o AS (SELECT user_id, w_start, row_number() OVER (ORDER BY md5('42|' || user_id || '|' || w_start), '42|' || user_id || '|' || w_start) - 1 AS place, count(*) OVER () AS total FROM w),
 v AS (SELECT w.user_id, w_start, sum((value / 10.0::DOUBLE)::FLOAT::DOUBLE) AS s FROM w JOIN f ON f.user_id = w.user_id AND f.frame >= w_start AND f.frame < w_end GROUP BY 1, 2)
 SELECT place, place * ceil(total / 64.0::DOUBLE)::BIGINT // total AS shard, o.user_id, o.w_start, round(s, 3) AS total FROM o JOIN v ON v.user_id = o.user_id AND v.w_start = o.w_start""")
def training_shards(spark, d):
    chain = Chain([lambda df: df.select("user_id", "frame", "value"), Normalize({"value": 10.0})])
    windows = writing.shuffled_windows(frames(spark, d), segs(spark, d), "user_id", chain, ["value"], SIZE, STRIDE, rows_per_file=64)
    root = shared_folder(spark, "shards")
    writing.save_shards(windows, root)
    rows = writing.read_shards(spark, root, windows.schema)
    read = rows.join(writing.manifest_of(rows).select("shard"), "shard", "left_semi")
    return read.select("place", "shard", "user_id", "w_start", F.round(F.aggregate("matrix", F.lit(0.0), lambda a, r: a + r[0].cast("double")), 3).alias("total"))


#: the customers' names stand for missing boundaries, a quarter of the users for empty text and a quarter for `[]`
KNOWN = f"{SEGS}, k AS (SELECT u.user_id, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_nationkey % 4 = 0 THEN '' WHEN c_nationkey % 4 = 1 THEN '[]' ELSE 'x' END AS b FROM (SELECT DISTINCT user_id FROM events) u JOIN customer ON c_custkey = u.user_id)"


def catalogue_of_users(spark, d):
    """Users who are customers, with segment_boundaries: NULL, empty, `[]` or their own."""
    own = segments.boundaries_json(segs(spark, d), "user_id")
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal", "c_nationkey")
    users = t(spark, d, "events").select("user_id").distinct().join(c, "user_id").join(own, "user_id", "left")
    told = F.when(F.col("c_acctbal") < 0, None).when(F.col("c_nationkey") % 4 == 0, "").when(F.col("c_nationkey") % 4 == 1, "[]").otherwise(F.coalesce("boundaries", F.lit("[]")))
    return users.select("user_id", told.alias("segment_boundaries"))


@query(f"WITH {KNOWN}, q AS (SELECT s.* FROM s JOIN k ON k.user_id = s.user_id AND b = 'x' WHERE seg_end - seg_start >= 4) SELECT user_id, seg_start, seg_end, seg_start + 2 * i AS w_start, seg_start + 2 * i + 4 AS w_end FROM q, unnest(range(0, ((seg_end - seg_start - 4) // 2 + 1)::BIGINT)) u(i)")
def stored_windows(spark, d):
    return segments.stored_windows(catalogue_of_users(spark, d), t(spark, d, "events").select("user_id"), "user_id", SIZE, STRIDE)[0]


@query(f"WITH {KNOWN} SELECT count(*) FILTER (b IS NULL OR b = '') AS skipped FROM k")
def stored_windows_skipped(spark, d):
    return segments.stored_windows(catalogue_of_users(spark, d), t(spark, d, "events").select("user_id"), "user_id", SIZE, STRIDE)[1]


@query(f"WITH {SEGS}, c AS (SELECT c_custkey AS user_id FROM customer WHERE c_acctbal < 0), j AS (SELECT user_id, '[' || string_agg('[' || seg_start || ',' || seg_end || ']', ',' ORDER BY seg_start) || ']' AS b FROM s GROUP BY 1) SELECT c.user_id, coalesce(b, '[]') AS boundaries FROM c LEFT JOIN j ON j.user_id = c.user_id WHERE c.user_id IN (SELECT user_id FROM events)")
def backfilled_boundaries(spark, d):
    return segments.backfill_boundaries(customers_without(spark, d), frames(spark, d), "user_id", F.col("event_type") == "error", 3)[0]


@query("WITH c AS (SELECT c_custkey AS user_id FROM customer WHERE c_acctbal < 0) SELECT count(*) AS total, count(*) FILTER (user_id IN (SELECT user_id FROM events)) AS successful, count(*) FILTER (user_id NOT IN (SELECT user_id FROM events)) AS failed FROM c")
def backfill_summary(spark, d):
    return segments.backfill_boundaries(customers_without(spark, d), frames(spark, d), "user_id", F.col("event_type") == "error", 3)[2]


def customers_without(spark, d):
    """Customers as catalogue rows; those with a negative balance have no stored boundaries."""
    return t(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.when(F.col("c_acctbal") >= 0, "[]").alias("segment_boundaries"))


# --- ledger


@query("""WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'boundary' ELSE 'parsed' END AS kind, event_id::VARCHAR AS raw, props AS err, CASE WHEN value > 20 THEN 'p' || event_id END AS path, event_id % 50 AS n, props || event_id AS cut FROM events)
 SELECT user_id, arg_min(raw, event_id) FILTER (kind <> 'boundary') AS raw_replay_id, split_part(max(CASE WHEN kind = 'parsed' THEN lpad(event_id::VARCHAR, 12, '0') || '|' || coalesce(path, '') END), '|', 2) AS output_path,
 arg_max(n, event_id) FILTER (kind = 'parsed') AS frame_count, arg_max(kind, event_id) FILTER (kind <> 'boundary') AS parse_status,
 CASE WHEN arg_max(kind, event_id) FILTER (kind <> 'boundary') = 'failed' THEN arg_max(err, event_id) FILTER (kind <> 'boundary') END AS error_message,
 CASE WHEN max(event_id) FILTER (kind = 'boundary') > min(event_id) FILTER (kind <> 'boundary') THEN arg_max(cut, event_id) FILTER (kind = 'boundary') END AS segment_boundaries
 FROM e GROUP BY user_id HAVING count(*) FILTER (kind <> 'boundary') > 0""")
def ledger_fold(spark, d):
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "boundary").otherwise("parsed")
    log = t(spark, d, "events").select(
        "user_id", "event_id", kind.alias("kind"), F.col("event_id").cast("string").alias("raw_replay_id"), F.col("props").alias("error_message"),
        F.when(F.col("value") > 20, F.concat(F.lit("p"), "event_id")).alias("output_path"), (F.col("event_id") % 50).alias("frame_count"), F.concat("props", "event_id").alias("segment_boundaries"))
    return ledger.fold_ledger(log, "user_id", "event_id", "kind", ["output_path", "frame_count"]).withColumn("output_path", F.when(F.col("frame_count").isNotNull(), F.coalesce("output_path", F.lit(""))))


RAW = "SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'downloaded' WHEN 'P' THEN 'failed' ELSE 'pending' END AS download_status, o_orderstatus = 'F' AS is_downloaded, CASE WHEN o_orderstatus = 'P' THEN 'old' END AS error_message, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS size FROM orders"
BIG = "SELECT l_orderkey AS id, count(*) AS size FROM lineitem GROUP BY 1 HAVING count(*) > 4"


def raw_table(spark, d):
    """Orders as raw ledger rows."""
    s = F.col("o_orderstatus")
    return t(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(s == "F", "downloaded").when(s == "P", "failed").otherwise("pending").alias("download_status"), (s == "F").alias("is_downloaded"),
        F.when(s == "P", "old").alias("error_message"), F.when(s == "F", F.col("o_custkey")).alias("size"))


def big_orders(spark, d):
    return t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("size")).filter("size > 4")


@query(f"SELECT r.id, CASE WHEN b.id IS NOT NULL THEN 'downloaded' ELSE download_status END AS download_status, b.id IS NOT NULL OR is_downloaded AS is_downloaded, error_message, CASE WHEN b.id IS NOT NULL THEN b.size ELSE r.size END AS size FROM ({RAW}) r LEFT JOIN ({BIG}) b ON b.id = r.id")
def mark_downloaded(spark, d):
    return ledger.mark_downloaded(raw_table(spark, d), big_orders(spark, d), "id", ["size"])


@query(f"SELECT r.id, CASE WHEN b.id IS NOT NULL THEN 'failed' ELSE download_status END AS download_status, is_downloaded, CASE WHEN b.id IS NOT NULL THEN 'lost ' || b.size ELSE error_message END AS error_message, r.size FROM ({RAW}) r LEFT JOIN ({BIG}) b ON b.id = r.id")
def mark_failed(spark, d):
    bad = big_orders(spark, d).select("id", F.concat(F.lit("lost "), "size").alias("error_message"))
    return ledger.mark_failed(raw_table(spark, d), bad, "id")


@query(f"SELECT coalesce(r.id, b.id) AS id, CASE WHEN b.id IS NOT NULL THEN 'failed' ELSE download_status END AS status, CASE WHEN b.id IS NOT NULL THEN 'lost ' || b.size ELSE error_message END AS error, r.size FROM ({RAW}) r FULL JOIN ({BIG}) b ON b.id = r.id")
def record_failures(spark, d):
    table = raw_table(spark, d).select("id", F.col("download_status").alias("status"), F.col("error_message").alias("error"), "size")
    return ledger.record_failures(table, big_orders(spark, d).select("id", F.concat(F.lit("lost "), "size").alias("error")), "id")


@query("""WITH g AS (SELECT c_nationkey AS g, count(*) AS done, count(*) FILTER (c_acctbal < 0) AS failed, max(c_name) AS completed_at FROM customer GROUP BY 1), s AS (SELECT n_nationkey AS k FROM nation WHERE n_regionkey < 3)
 SELECT coalesce(g, k) AS g, CASE WHEN k IS NOT NULL THEN 'pending' ELSE 'complete' END AS status, CASE WHEN k IS NOT NULL THEN 0 ELSE done END AS done, CASE WHEN k IS NOT NULL THEN 0 ELSE failed END AS failed, CASE WHEN k IS NULL THEN completed_at END AS completed_at FROM g FULL JOIN s ON g = k""")
def start_groups(spark, d):
    groups = t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("g")).agg(F.lit("complete").alias("status"), F.count("*").alias("done"), F.count_if(F.col("c_acctbal") < 0).alias("failed"), F.max("c_name").alias("completed_at"))
    return ledger.start_groups(groups, t(spark, d, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("g")), "g", ["done", "failed"])


@query("SELECT l_orderkey AS id, l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS is_new FROM lineitem GROUP BY 1")
def first_seen(spark, d):
    known = t(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    return ledger.first_seen(known, t(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders) THEN (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS duration FROM customer")
def backfill_missing(spark, d):
    c = t(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") > 0).alias("is_downloaded"), F.col("c_name").alias("downloaded_at"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey").cast("long")).alias("duration"))
    fetched = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("duration"))
    return ledger.backfill(c, fetched, "c_custkey", ("duration",)).select("c_custkey", "duration")


@query("SELECT o_orderkey, o_orderpriority AS error FROM orders WHERE o_orderstatus = 'P'")
def batch_errors(spark, d):
    kind = F.when(F.col("o_orderstatus") == "F", "parsed").when(F.col("o_orderstatus") == "O", "skipped").otherwise("failed")
    return ledger.batch_errors(t(spark, d, "orders").select("o_orderkey", kind.alias("outcome"), F.col("o_orderpriority").alias("error")), "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = (SELECT max(o_orderstatus) FROM orders)")
def snapshot_restore(spark, d):
    root, orders = shared_folder(spark, "snapshots"), t(spark, d, "orders")
    for r in orders.select("o_orderstatus").distinct().collect():  # three states
        sources.write_snapshot(orders.filter(F.col("o_orderstatus") == r[0]).select("o_orderkey", "o_custkey"), root, r[0])
    return sources.read_latest_snapshot(spark, root)


@query("""WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey AS id, o_orderstatus = 'F' AS early, n, l.k IS NULL AS bad FROM orders LEFT JOIN l ON k = o_orderkey)
 SELECT id, CASE WHEN bad THEN 'failed' ELSE 'parsed' END AS status, CASE WHEN bad THEN 'no frames' END AS error, n AS frames, (CASE WHEN bad THEN (CASE WHEN early THEN 3 ELSE 2 END) ELSE 1 END)::BIGINT AS tries FROM o""")
def incremental_ledger(spark, d):
    """Orders as raw files, their lines as frames: a first run over finished orders, a second over all, then one retry of what failed."""
    orders = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("long").alias("frame"), F.col("l_quantity").alias("v"))

    def work(raw):
        mine = lines.join(raw.select("id"), "id", "left_semi")
        there = mine.select("id").distinct().withColumn("ok", F.lit(True))
        return mine, raw.select("id").join(there, "id", "left").select("id", F.when(F.col("ok").isNull(), "no frames").alias("error"))

    store = Store(spark, shared_folder(spark, "store"), "id", "long", "id long, frame long, v double")
    run_pending(store, orders.filter("o_orderstatus = 'F'"), work)
    run_pending(store, orders, work)
    retry_failed(store, orders, work, attempts=1)
    tries = store.events().groupBy("id").agg(F.count("*").alias("tries"))
    read = store.frames().groupBy("id").agg(F.count("*").alias("frames"))
    return store.state().join(tries, "id").join(read, "id", "left").select("id", F.col("parse_status").alias("status"), F.col("error_message").alias("error"), "frames", "tries")


@query("""WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
 SELECT o_orderkey AS id, CASE WHEN k IS NULL THEN 'failed' ELSE 'parsed' END AS status, n AS frames, (CASE WHEN k IS NULL AND o_orderstatus <> 'P' THEN 2 ELSE 1 END)::BIGINT AS tries FROM orders LEFT JOIN l ON k = o_orderkey""")
def incremental_stream(spark, d):
    """Orders arrive as files, finished and open ones twice; the stream drains after each arrival, and a call without news does nothing."""
    root = shared_folder(spark, "stream")
    orders = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("long").alias("frame"), F.col("l_quantity").alias("v"))

    def work(raw):
        mine = lines.join(raw.select("id"), "id", "left_semi")
        there = mine.select("id").distinct().withColumn("ok", F.lit(True))
        return mine, raw.select("id").join(there, "id", "left").select("id", F.when(F.col("ok").isNull(), "no frames").alias("error"))

    store = Store(spark, f"{root}/store", "id", "long", "id long, frame long, v double")
    for arrival in (orders.filter("o_orderstatus <> 'P'"), orders):
        arrival.write.mode("append").parquet(f"{root}/source")
        drain_to_store(store, f"{root}/source", "id long, o_orderstatus string", work, f"{root}/checkpoint")
    drain_to_store(store, f"{root}/source", "id long, o_orderstatus string", work, f"{root}/checkpoint")
    tries = store.events().groupBy("id").agg(F.count("*").alias("tries"))
    read = store.frames().groupBy("id").agg(F.count("*").alias("frames"))
    return store.state().join(tries, "id").join(read, "id", "left").select("id", F.col("parse_status").alias("status"), "frames", "tries")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) ORDER BY c_custkey LIMIT 30")
def missing_boundaries_first(spark, d):
    cut = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return segments.missing_boundaries(t(spark, d, "customer").select("c_custkey"), cut, "c_custkey", limit=30)


# --- trees and metadata


@query("""SELECT o_custkey::VARCHAR AS tree_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS place, l_partkey::VARCHAR AS leaf, 'c' || o_custkey || '/' || o_orderpriority AS path, o_orderkey::VARCHAR AS group_id
 FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def group_tree_walk(spark, d):
    """Each customer's tree as JSON: orders are its groups, their lines the leaves."""
    line = F.struct("l_linenumber", F.col("l_partkey"), "l_suppkey", F.col("l_partkey").cast("string").alias("id"))
    lines = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("replays"))
    group = F.struct("o_orderkey", F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("name"), "replays")
    orders = t(spark, d, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    tree = F.struct(F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("c"), "o_custkey").alias("name"), F.sort_array(F.collect_list(group)).alias("children"))
    nested = orders.groupBy("o_custkey").agg(F.to_json(tree).alias("tree")).select(F.col("o_custkey").cast("string").alias("tree_id"), "tree")
    _, leaves = trees.walk(nested)
    return leaves.select("tree_id", "place", F.get_json_object("replay", "$.id").alias("leaf"), F.array_join("path", "/").alias("path"), "group_id")


FLAT = ("replay_id", "title", *metadata.PLAIN, "overtime", "blue_team", "blue_goals", "orange_team", "orange_goals", "min_rank", "min_rank_tier", "min_rank_division", "max_rank", "max_rank_tier", "max_rank_division", "uploader_name", "uploader_steam_id")


@query("""SELECT o_orderkey::VARCHAR AS replay_id, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority ELSE 'Unknown' END AS title, o_custkey AS duration, o_custkey + 1 AS overtime_seconds, 'm' || o_custkey AS map_code, o_orderpriority AS map_name, o_orderstatus AS match_type,
 o_custkey % 4 AS team_size, o_custkey % 9 AS season, o_orderstatus || 's' AS season_type, 'q' || o_custkey AS playlist_id, o_orderpriority || 'd' AS date, (o_custkey % 3 = 0)::INTEGER AS overtime,
 CASE WHEN o_custkey % 5 = 0 THEN 'Unknown' ELSE 'b' || o_custkey END AS blue_team, o_custkey % 7 AS blue_goals, 'o' || o_custkey AS orange_team, CASE WHEN o_custkey % 6 > 0 THEN o_custkey % 6 END AS orange_goals,
 'r' || o_custkey AS min_rank, o_custkey % 8 AS min_rank_tier, o_custkey % 10 AS min_rank_division, CASE WHEN o_custkey % 4 > 0 THEN 'x' || o_custkey END AS max_rank, CASE WHEN o_custkey % 4 > 0 THEN o_custkey % 11 END AS max_rank_tier, CASE WHEN o_custkey % 4 > 0 THEN o_custkey % 12 END AS max_rank_division,
 'u' || o_custkey AS uploader_name, '7' || o_custkey AS uploader_steam_id FROM orders""")
def json_flatten_all(spark, d):
    """All 27 columns of the flat record, every one from the data; missing fields, teams' names and ranks among them."""
    k, s = F.col("o_custkey"), lambda prefix: F.concat(F.lit(prefix), F.col("o_custkey"))
    rank = lambda name, a, b: F.struct(name.alias("name"), (k % a).alias("tier"), (k % b).alias("division"))
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.when(k % 2 == 0, F.col("o_orderpriority")).alias("title"), k.alias("duration"), (k + 1).alias("overtime_seconds"), s("m").alias("map_code"), F.col("o_orderpriority").alias("map_name"),
        F.col("o_orderstatus").alias("match_type"), (k % 4).alias("team_size"), (k % 9).alias("season"), F.concat("o_orderstatus", F.lit("s")).alias("season_type"), s("q").alias("playlist_id"), F.concat("o_orderpriority", F.lit("d")).alias("date"),
        F.when(k % 3 == 0, True).alias("overtime"), F.struct(F.when(k % 5 != 0, s("b")).alias("name"), (k % 7).alias("goals")).alias("blue"), F.struct(s("o").alias("name"), F.when(k % 6 > 0, k % 6).alias("goals")).alias("orange"),
        rank(s("r"), 8, 10).alias("min_rank"), F.when(k % 4 > 0, rank(s("x"), 11, 12)).alias("max_rank"), F.struct(s("u").alias("name"), s("7").alias("steam_id")).alias("uploader"))
    return metadata.flatten_record(t(spark, d, "orders").select(F.to_json(record).alias("record"))).select(*FLAT)


HEADERS = {"Id": "c_name", "ReplayName": "c_mktsegment", "Date": "'d' || c_custkey", "MapName": "'m' || c_nationkey", "MatchType": "c_mktsegment || c_nationkey", "TeamSize": "c_nationkey::VARCHAR", "NumFrames": "(c_custkey * 2)::VARCHAR", "Team0Score": "(c_custkey % 5)::VARCHAR", "Team1Score": "(c_custkey % 6)::VARCHAR", "BuildVersion": "'v' || c_custkey"}


@query("SELECT c_custkey, " + ", ".join(f"{HEADERS[key]} AS {name}" for name, key in metadata.HEADER.items() if key in HEADERS) + ", CASE WHEN c_acctbal < 0 THEN '[]' ELSE '[1]' END AS goals, CASE WHEN c_acctbal < 0 THEN '[]' ELSE '[2]' END AS highlights FROM customer")
def header_fields_all(spark, d):
    """All 12 header fields from pairs in which each key stands twice: the last counts."""
    values = [F.expr(e.replace("::VARCHAR", "::STRING")) for e in HEADERS.values()]
    pairs = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in zip(HEADERS, values)]
    lists = F.when(F.col("c_acctbal") >= 0, F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("Goals", "[1]"), ("HighLights", "[2]"))]))
    old = [F.struct(F.lit(k).alias("key"), F.lit("old").alias("value")) for k in HEADERS]
    df = t(spark, d, "customer").withColumn("pairs", F.concat(F.array(*old), F.array(*pairs), F.coalesce(lists, F.array().cast("array<struct<key:string,value:string>>"))))
    return metadata.header_fields(df, ["c_custkey"], "pairs")


PLAYERS = "FROM conversations WHERE conv_id IS NOT NULL AND role IN ('user', 'assistant')"


def teams(spark, d):
    """Conversations as matches: turns of users and assistants are the players of the teams; odd turns lack names and ids, every third lacks stats."""
    name = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("n"), "turn"))
    remote = F.when(F.col("turn") % 2 == 0, F.create_map(F.lit("Steam"), F.concat(F.lit("s"), "turn"))).otherwise(F.create_map(F.lit("Epic"), F.lit("e")))
    stats = F.when(F.col("turn") % 3 > 0, F.create_map(F.lit("n"), F.length("text").cast("long")))
    rows = t(spark, d, "conversations").filter("conv_id is not null").withColumn("p", F.struct(name.alias("name"), F.map_entries(remote).alias("remote"), F.map_entries(stats).alias("stats")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "p"))), lambda x: F.struct(x["role"].alias("role"), x["p"].alias("p")))
    both = rows.groupBy("conv_id").agg(listed.alias("all"))

    def team(role):
        return F.transform(F.filter("all", lambda x: x["role"] == role), lambda x: F.struct(x["p"]["name"].alias("name"), F.map_from_entries(x["p"]["remote"]).alias("remote_id"), F.map_from_entries(x["p"]["stats"]).alias("stats")))

    return both.select("conv_id", team("user").alias("zero"), team("assistant").alias("one"))


@query(f"SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY role DESC, turn) - 1)::INTEGER AS slot, (role <> 'user')::INTEGER AS team, CASE WHEN turn % 2 = 0 THEN 'n' || turn END AS name, CASE WHEN turn % 2 = 0 THEN 's' || turn END AS steam_id, CASE WHEN turn % 3 > 0 THEN length(text) END AS n, (turn % 3 > 0)::INTEGER AS stats {PLAYERS}")
def player_mapping(spark, d):
    m = metadata.player_mapping(teams(spark, d), ["conv_id"], "zero", "one")
    return m.select("conv_id", "slot", "team", "name", "steam_id", F.try_element_at("stats", F.lit("n")).alias("n"), F.size("stats").alias("stats"))


@query(f"SELECT conv_id, count(*)::INTEGER AS players {PLAYERS} GROUP BY 1")
def team_sizes(spark, d):
    return teams(spark, d).select("conv_id", features.player_count("zero", "one").alias("players")).filter("players > 0")
