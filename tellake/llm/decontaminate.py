"""Benchmark decontamination by a distributed positional inverted index.

The index is sharded by documents: one row holds the postings of a block of documents,
sorted by term, each the positions at which the term occurs.  Positions of different
documents never touch, so a phrase cannot cross a border.  It is written once; term
frequencies over all shards come from it, and every phrase is looked up in each shard from
its rarest term on: the rarest term's positions, shifted by its offset in the phrase, are
the candidate starts; the other terms, rarest first, are looked up at their places after each
start that is left, by the inverse of the postings.  A phrase with a term that a shard lacks costs one lookup.

Phrases are a stated query set.  They reach the tasks in packed parts of bounded size
(query_bytes), so a large benchmark costs more passes over the index, never more memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import id_array, pack, unpack
from .store import all_columns, broadcast_if_small, materialize, with_row_keys
from .words import ALNUM, LOWER, U, slices, split_words, text_buffers

GAP = 64


class Shard:
    """terms: sorted distinct term hashes; cut: range of each in places; places: their positions."""

    def __init__(self, body: bytes):
        self.ids, self.no_id, self.base, self.n_words, self.terms, self.cut, self.places = unpack(body)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term, -1 where the shard lacks it."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def by_place(self) -> np.ndarray:
        """Term index at each position, -1 in gaps: the postings turned round once for many lookups."""
        size = int(self.base[-1] + self.n_words[-1]) + GAP if len(self.base) else 0
        out = np.full(size, -1, np.int32)
        out[self.places] = np.repeat(np.arange(len(self.terms), dtype=np.int32), np.diff(self.cut))
        return out


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards (shard long, body binary) of all texts; terms are [0-9a-z and non-ASCII]+ after A-Z became a-z."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, no_id = id_array(batch.column(0))
            buf, offsets, _ = text_buffers(batch.column(1))
            for i, j in slices(offsets):
                w = split_words(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM, LOWER)
                n_words = np.diff(w.first)
                base = np.r_[0, np.cumsum(n_words[:-1] + GAP)]
                place = (np.arange(len(w)) + GAP * w.doc).astype(np.uint32)
                order = np.argsort(w.hash, kind="stable")
                terms = w.hash[order]
                cut = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
                body = pack(ids[i:j], no_id[i:j], base, n_words, terms[cut], np.r_[cut, len(terms)].astype(np.uint32), place[order])
                yield pa.record_batch([pa.array([(part << 32) | seq]), pa.array([body], pa.binary())], names=["shard", "body"])
                seq += 1

    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialize(slim.mapInArrow(build, "shard long, body binary"), "index")


def phrases_of(texts: list[str | None], items: list, size: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Distinct windows of `size` terms of the texts (a shorter text is one window): terms padded with 0, lengths, item lists."""
    buf, offsets, _ = text_buffers(pa.array(texts, pa.string()))
    w = split_words(buf, offsets, ALNUM, LOWER)
    owners: dict[bytes, set] = {}
    for item, a, b in zip(items, w.first[:-1].tolist(), w.first[1:].tolist()):
        for k in range(a, max(a + 1, b - size + 1)) if b > a else ():
            owners.setdefault(w.hash[k : min(k + size, b)].tobytes(), set()).add(item)
    terms = np.zeros((len(owners), size), U)
    length = np.zeros(len(owners), np.int64)
    for r, key in enumerate(owners):
        h = np.frombuffer(key, U)
        terms[r, : len(h)], length[r] = h, len(h)
    return terms, length, list(owners.values())


def _parts(benchmark: DataFrame, item_col: str, text_col: str, query_bytes: int) -> Iterator[tuple[list, list]]:
    """Items and texts of the benchmark in parts whose texts have about query_bytes together."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).filter("text is not null and item is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // query_bytes) + 1
    for k in range(n):
        got = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        yield [r["item"] for r in got], [r["text"] for r in got]


def term_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Occurrences of each of the sorted terms over all shards."""
    told = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(told.value), np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                s = Shard(body)
                at = s.find(told.value)
                total += np.where(at >= 0, np.diff(s.cut.astype(np.int64))[at], 0) if len(s.terms) else 0
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["term", "n"])

    out = np.zeros(len(terms), np.int64)
    for r in index.select("body").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def exact_matches(s: Shard, terms: np.ndarray, length: np.ndarray, rarest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start position) of every exact occurrence; rarest: offsets of each phrase's terms, rarest first."""
    at = s.find(terms.ravel()).reshape(terms.shape)
    within = np.arange(terms.shape[1]) < length[:, None]
    live = np.flatnonzero(((at >= 0) | ~within).all(axis=1))
    if not len(live):
        return live, live
    lead = at[live, rarest[live, 0]]
    n = np.diff(s.cut.astype(np.int64))[lead]
    phrase = np.repeat(live, n)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = s.places[np.repeat(s.cut.astype(np.int64)[lead], n) + inner].astype(np.int64) - np.repeat(rarest[live, 0], n)
    term_at = s.by_place()
    for k in range(1, terms.shape[1]):
        used = k < length[phrase]
        offset = rarest[phrase, k]
        place = start + offset
        ok = ~used | ((start >= 0) & (place < len(term_at)) & (term_at[np.clip(place, 0, len(term_at) - 1)] == at[phrase, offset]))
        phrase, start = phrase[ok], start[ok]
    ok = start >= 0
    return phrase[ok], start[ok]


def near_matches(s: Shard, terms: np.ndarray, length: np.ndarray, rarest: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, start, end) where all terms of a phrase, in any order, lie within length + slop positions."""
    at = s.find(terms.ravel()).reshape(terms.shape)
    out: list[tuple[int, int, int]] = []
    for p in np.flatnonzero(((at >= 0) | (np.arange(terms.shape[1]) >= length[:, None])).all(axis=1)).tolist():
        span = int(length[p]) + slop
        need = np.unique(at[p, : length[p]], return_counts=True)
        lists = {int(t): s.places[s.cut[t] : s.cut[t + 1]].astype(np.int64) for t in need[0]}
        lead = lists[int(at[p, rarest[p, 0]])]
        for t, c in zip(*need):
            x = lists[int(t)]
            near = np.searchsorted(x, lead + span) - np.searchsorted(x, lead - span, "right")
            lead = lead[near >= c]
        for q in lead.tolist():
            close = sorted((int(v), int(t)) for t, x in lists.items() for v in x[np.searchsorted(x, q - span, "right") : np.searchsorted(x, q + span)])
            have: dict[int, int] = {}
            left = 0
            for v, t in close:
                have[t] = have.get(t, 0) + 1
                while v - close[left][0] >= span:
                    have[close[left][1]] -= 1
                    left += 1
                if all(have.get(int(t), 0) >= c for t, c in zip(*need)):
                    out.append((p, close[left][0], v + 1))
                    break
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def search(index: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = 10, slop: int | None = None, query_bytes: int = 8 << 20) -> DataFrame:
    """Rows (shard, place, doc_id, item_id, from, to): word ranges of documents that match a window of an item.

    slop None: exact phrases.  Else proximity: all terms of the window within size + slop
    words, in any order; from and to bound the match.  item_id is a string.
    """
    spark = index.sparkSession
    out: DataFrame | None = None
    for items, texts in _parts(benchmark, item_col, text_col, query_bytes):
        terms, length, owners = phrases_of(texts, [str(i) for i in items], size)
        known = np.unique(terms[np.arange(size) < length[:, None]])
        often = term_counts(index, known)
        weight = np.where(np.arange(size) < length[:, None], often[np.searchsorted(known, terms).clip(0, max(0, len(known) - 1))] if len(known) else 0, np.iinfo(np.int64).max)
        rarest = np.argsort(weight, axis=1, kind="stable")
        told = spark.sparkContext.broadcast((terms, length, owners, rarest))

        def look(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            terms, length, owners, rarest = told.value
            for batch in batches:
                for row in batch.to_pylist():
                    s = Shard(row["body"])
                    if slop is None:
                        phrase, start = exact_matches(s, terms, length, rarest)
                        end = start + length[phrase]
                    else:
                        phrase, start, end = near_matches(s, terms, length, rarest, slop)
                    doc = np.searchsorted(s.base, start, "right") - 1
                    inside = end <= s.base[doc] + s.n_words[doc]
                    hits = [(d, i, a, b) for d, p, a, b in zip(doc[inside].tolist(), phrase[inside].tolist(), (start - s.base[doc])[inside].tolist(), (end - s.base[doc])[inside].tolist()) for i in owners[p]]
                    if hits:
                        docs, names, starts, ends = zip(*hits)
                        ids = [None if s.no_id[d] else int(s.ids[d]) for d in docs]
                        yield pa.record_batch([pa.array([row["shard"]] * len(hits)), pa.array(docs, pa.int64()), pa.array(ids, pa.int64()), pa.array(names), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["shard", "place", "doc_id", "item_id", "from", "to"])

        hits = index.mapInArrow(look, "shard long, place long, doc_id long, item_id string, from int, to int")
        out = hits if out is None else out.unionByName(hits)
    return out


def documents_of(index: DataFrame) -> DataFrame:
    """Rows (shard, place, doc_id, n_words) of all indexed documents."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Shard(row["body"])
                yield pa.record_batch([pa.array([row["shard"]] * len(s.ids)), pa.array(np.arange(len(s.ids))), pa.array([None if n else int(i) for i, n in zip(s.ids, s.no_id)], pa.int64()), pa.array(s.n_words)], names=["shard", "place", "doc_id", "n_words"])

    return index.mapInArrow(read, "shard long, place long, doc_id long, n_words long")


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, items), one per document row.

    n_hit counts words inside any occurrence of a window of an item, items are the sorted
    distinct ids (as strings) of items with occurring windows.  Null or wordless text: no
    words, no hits.  Null ids are kept; ids are integers, or strings of them, and others fail.  Items that are null, have a null id or no words
    match nothing; repeated items count once.
    """
    index = build_index(df, id_col, text_col)
    hits = search(index, benchmark, item_col, item_text_col, size)
    spans = F.array_sort(F.collect_set(F.struct("from", "to")))
    found = hits.groupBy("shard", "place").agg(spans.alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    # covered words: each range adds what lies beyond the furthest end before it
    grown = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["to"] - F.greatest(acc["end"], s["from"]))).alias("n"), F.greatest(acc["end"], s["to"]).alias("end")))
    found = found.select("shard", "place", grown["n"].cast("long").alias("n_hit"), "items")
    return documents_of(index).join(found, ["shard", "place"], "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination_digest(df: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """contamination() with the items as count and SHA-256 of their comma-joined ids."""
    out = contamination(df, benchmark, size=size)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def without_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 10) -> DataFrame:
    """df without contaminated rows, whatever their ids and the names of other columns."""
    rows, key = with_row_keys(df)
    bad = contamination(rows, benchmark, key, text_col, size=size).filter("n_hit > 0").select(F.col("doc_id").alias(key))
    bad = broadcast_if_small(materialize(bad, "contaminated"))
    return rows.join(bad, key, "left_anti").select(*all_columns(df))
