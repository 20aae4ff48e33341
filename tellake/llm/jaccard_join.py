"""N-gram Jaccard join: overlap counts of the document by n-gram incidence matrix, in blocks.

The matrix is never held whole.  A document can only link if nearly all of its n-grams
occur elsewhere (overlap >= t * size), which bounds what has to be multiplied:

1. On a hash-chosen quarter of all n-grams, ask which occur in another set of the same block
   or in another block.  A document whose missing quarter alone exceeds (1 - t) * size is
   done: it links nothing new.  The choice is by n-gram, alike in every document, so the
   bound is exact.
2. The rest are kept once per distinct set (exact copies are one class) and pruned on all
   n-grams until nothing more goes.
3. Rows are multiplied with hub columns: for each n-gram its best-covered set is the hub.
   Counts with hubs are lower bounds of overlaps, so links found are true; a family of
   thousands of near copies joins its hub with one count a member, not a pair a pair.
4. Linked classes become one component, and pruning is repeated for n-grams that occur in
   another component.  When hubs find few new links, what is left is joined on its rarest
   n-grams and every meeting pair of different components counted in full: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, Emit, answers, bucket_count, exchange, make_blocks, pack, unpack
from .components import connected_components
from .store import all_columns, broadcast_if_small, drop, materialize, quoted, with_row_keys
from .words import LOWER, SPACED, U, mix, split_words, windows

SAMPLE_BITS = 2
CHUNK_HASHES = 1 << 16


def shingle_sets(block: Block, n: int) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each text; fewer words: the whole sequence; none: empty."""
    words = split_words(block.buf, block.offsets, SPACED, LOWER)
    every = windows(words.hash, n)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            h = np.sort(every[a : b - n + 1])
            out.append(h[np.r_[True, h[1:] != h[:-1]]])
        else:
            out.append(windows(words.hash[a:b], b - a) if b > a else np.zeros(0, U))
    return out


def set_key(h: np.ndarray) -> int:
    """64-bit key of a set: equal sets, equal keys; n different sets collide with chance n*n / 2**65."""
    return int(mix(np.add.reduce(mix(h ^ U(0x5851F42D4C957F2D)), keepdims=True) + U(len(h)))[0]) if len(h) else 0


def least_overlap(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Smallest overlap a set of size n can link with: ceil(n * num / den)."""
    return -((-np.asarray(n, np.int64) * num) // den)


def _bounds(keys: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the smallest and largest value of each."""
    order = np.argsort(keys, kind="stable")
    keys, value = keys[order], value[order]
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    both = np.empty(len(cut), _RANGE)
    if len(cut):
        both["lo"], both["hi"] = np.minimum.reduceat(value, cut), np.maximum.reduceat(value, cut)
    return keys[cut], both


_RANGE = np.dtype([("lo", "<u8"), ("hi", "<u8")])


def _several(keys: np.ndarray, values: np.ndarray, group: np.ndarray):
    """Fold: whether a key has more than one value over all rows."""
    cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return (np.minimum.reduceat(values["lo"], cut) < np.maximum.reduceat(values["hi"], cut)).astype(np.uint8), None


def _sampled(sets: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sampled n-grams of each class's first document here, and its index."""
    seen: set[int] = set()
    parts, owner = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for i, (h, k) in enumerate(zip(sets, keys.tolist())):
        if len(h) and k not in seen:
            seen.add(k)
            s = h[(h & U((1 << SAMPLE_BITS) - 1)) == 0]
            parts.append(s)
            owner.append(np.full(len(s), i))
    return np.concatenate(parts), np.concatenate(owner)


def document_sets(df: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int) -> DataFrame:
    """Rows (doc_id, n_shingles, cls, hashes): hashes only where a link is still possible, once a class and block."""
    blocks = make_blocks(df, id_col, text_col)

    def emit(body: bytes):
        sets = shingle_sets(Block(body), n)
        keys = np.array([set_key(h) for h in sets], U)
        grams, both = _bounds(*_sampled(sets, keys))
        return grams, 1 + (both["lo"] < both["hi"]).astype(np.uint8)

    def fold(keys: np.ndarray, values: np.ndarray, group: np.ndarray):
        return (np.bincount(group, values) > 1).astype(np.uint8), None

    found, _ = exchange(blocks, Emit(emit, "u1"), fold, bucket_count(blocks), ["body"], "grams")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["body"])
                sets = shingle_sets(block, n)
                size = np.array([len(h) for h in sets], np.int64)
                keys = np.array([set_key(h) for h in sets], U)
                grams, owner = _sampled(sets, keys)
                kept, _ = _bounds(grams, owner)
                again = answers(row["answer"], np.uint8).astype(bool)
                missing = np.zeros(len(sets), np.int64)
                if len(grams):
                    np.add.at(missing, owner, ~again[np.searchsorted(kept, grams)])
                first = np.zeros(len(sets), bool)
                first[np.unique(keys, return_index=True)[1]] = True
                alive = (size > 0) & first & (missing <= size - least_overlap(size, num, den))
                yield pa.record_batch(
                    [pa.array(block.id_list(), pa.int64()), pa.array(size), pa.array(keys.view(np.int64)), pa.array([h.tobytes() if a else None for h, a in zip(sets, alive)], pa.binary())],
                    names=["doc_id", "n_shingles", "cls", "hashes"])

    out = materialize(blocks.join(found, "block", "left").select("body", "answer").mapInArrow(judge, "doc_id long, n_shingles long, cls long, hashes binary"), "sets")
    drop(blocks, found)
    return out


class Chunk:
    """Some sets: class, component, size, share of n-grams seen elsewhere, and the n-grams one after another."""

    def __init__(self, body: bytes):
        self.cls, self.comp, self.size, self.share, self.offsets, self.grams = unpack(body)
        self.owner = np.repeat(np.arange(len(self.cls)), np.diff(self.offsets))


def _chunk_row(block: int, cls, comp, size, share, hashes: list[np.ndarray]) -> pa.RecordBatch:
    lengths = np.array([len(h) for h in hashes], np.int64)
    body = pack(np.asarray(cls, U), np.asarray(comp, U), np.asarray(size, np.int64), np.asarray(share, np.uint16), np.r_[0, np.cumsum(lengths)].astype(np.int64), np.concatenate([np.zeros(0, U), *hashes]))
    return pa.record_batch([pa.array([block]), pa.array([len(lengths)]), pa.array([int(lengths.sum()) * 8]), pa.array([body], pa.binary())], names=["block", "n_sets", "n_bytes", "body"])


_CHUNK = "block long, n_sets long, n_bytes long, body binary"


def pack_sets(sets: DataFrame, total: int) -> DataFrame:
    """Rows (cls, comp, n, hashes), of about total hashes, as chunks."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append((row["cls"], row["comp"], row["n"], np.frombuffer(row["hashes"], U)))
                size += len(held[-1][3])
                if size >= CHUNK_HASHES:
                    yield make(part, seq, held)
                    seq, held, size = seq + 1, [], 0
        if held:
            yield make(part, seq, held)

    def make(part, seq, held):
        return _chunk_row((part << 32) | seq, np.array([h[0] for h in held], np.int64).view(U), np.array([h[1] for h in held], np.int64).view(U), [h[2] for h in held], np.zeros(len(held)), [h[3] for h in held])

    return materialize(sets.select("cls", "comp", "n", "hashes").coalesce(total // CHUNK_HASHES + 1).mapInArrow(build, _CHUNK), "chunks")


def _count(chunks: DataFrame, column: str = "n_sets") -> int:
    return chunks.agg(F.sum(column)).first()[0] or 0


def prune(chunks: DataFrame, num: int, den: int) -> DataFrame:
    """Drop sets of which too few n-grams occur in another component; others get that share."""

    def emit(body: bytes):
        c = Chunk(body)
        return _bounds(c.grams, c.comp[c.owner])

    found, _ = exchange(chunks, Emit(emit, _RANGE), _several, bucket_count(chunks), ["body"], "shared")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["body"])
                keys, _ = _bounds(c.grams, c.comp[c.owner])
                shared = np.zeros(len(c.cls), np.int64)
                if len(keys):
                    np.add.at(shared, c.owner, answers(row["answer"], np.uint8)[np.searchsorted(keys, c.grams)])
                stay = np.flatnonzero(shared >= least_overlap(c.size, num, den))
                if len(stay):
                    yield _chunk_row(row["block"], c.cls[stay], c.comp[stay], c.size[stay], (shared[stay] * 65535) // c.size[stay], [c.grams[c.offsets[i] : c.offsets[i + 1]] for i in stay.tolist()])

    out = materialize(chunks.join(found, "block").select("block", "body", "answer").mapInArrow(judge, _CHUNK), "pruned")
    drop(chunks, found)
    return out


_HUB = np.dtype([("share", "<u2"), ("cls", "<u8"), ("comp", "<u8"), ("size", "<u4")])


def _best(keys: np.ndarray, hubs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct key its first hub by share, size and class, largest first."""
    order = np.lexsort((hubs["cls"], hubs["size"], hubs["share"], keys))
    last = np.flatnonzero(np.r_[keys[order][1:] != keys[order][:-1], True]) if len(keys) else np.zeros(0, np.int64)
    return keys[order][last], hubs[order][last]


def hub_links(chunks: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b, comp_a, comp_b) whose counted overlap with a hub reaches the threshold."""

    def emit(body: bytes):
        c = Chunk(body)
        hubs = np.empty(len(c.grams), _HUB)
        hubs["share"], hubs["cls"], hubs["comp"], hubs["size"] = (x[c.owner] for x in (c.share, c.cls, c.comp, c.size))
        return _best(c.grams, hubs)

    def fold(keys: np.ndarray, values: np.ndarray, group: np.ndarray):
        return _best(keys[group], values)[1], None

    found, _ = exchange(chunks, Emit(emit, _HUB), fold, bucket_count(chunks), ["body"], "hubs")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["body"])
                hubs = answers(row["answer"], _HUB)[np.searchsorted(_bounds(c.grams, c.cls[c.owner])[0], c.grams)]
                other = hubs["comp"] != c.comp[c.owner]
                owner, hubs = c.owner[other], hubs[other]
                order = np.lexsort((hubs["cls"], owner))
                owner, hubs = owner[order], hubs[order]
                cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (hubs["cls"][1:] != hubs["cls"][:-1])]) if len(owner) else np.zeros(0, np.int64)
                overlap = np.diff(np.r_[cut, len(owner)])
                owner, hubs = owner[cut], hubs[cut]
                link = den * overlap >= num * (c.size[owner] + hubs["size"].astype(np.int64) - overlap)
                owner, hubs = owner[link], hubs[link]
                yield pa.record_batch([pa.array(x.view(np.int64)) for x in (c.comp[owner], np.ascontiguousarray(hubs["comp"]))], names=["a", "b"])

    return materialize(chunks.join(found, "block").select("body", "answer").mapInArrow(count, "a long, b long").distinct(), "links")


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks back to rows (cls, comp, n, hashes)."""
    for batch in batches:
        for row in batch.to_pylist():
            c = Chunk(row["body"])
            hashes = [c.grams[a:b].tobytes() for a, b in zip(c.offsets[:-1].tolist(), c.offsets[1:].tolist())]
            yield pa.record_batch([pa.array(c.cls.view(np.int64)), pa.array(c.comp.view(np.int64)), pa.array(c.size), pa.array(hashes, pa.binary())], names=["cls", "comp", "n", "hashes"])


_ROWS = "cls long, comp long, n long, hashes binary"


def remaining_links(chunks: DataFrame, num: int, den: int) -> DataFrame:
    """All links (a, b) between components of what hubs could not decide.

    Two linked sets share one of the n - ceil(n * t) + 1 rarest n-grams of each, in one
    global order by frequency; sets that meet there are counted in full.  Frequent n-grams
    come last in that order, so common passages make no pairs.
    """

    def emit(body: bytes):
        c = Chunk(body)
        grams = np.sort(c.grams)
        cut = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
        return grams[cut], np.diff(np.r_[cut, len(grams)]).astype(np.uint32)

    def fold(keys: np.ndarray, values: np.ndarray, group: np.ndarray):
        return np.bincount(group, values).astype(np.uint32), None

    found, _ = exchange(chunks, Emit(emit, "<u4"), fold, bucket_count(chunks), ["body"], "frequency")

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["body"])
                often = answers(row["answer"], np.uint32)[np.searchsorted(emit(row["body"])[0], c.grams)]
                order = np.lexsort((c.grams, often, c.owner))
                place = np.arange(len(order)) - c.offsets[c.owner]
                some = (place <= (c.size - least_overlap(c.size, num, den))[c.owner]) & (often[order] > 1)
                lead, place = order[some], place[some]
                owner = c.owner[lead]
                yield pa.record_batch([pa.array(x.view(np.int64)) for x in (c.grams[lead], c.cls[owner], c.comp[owner])] + [pa.array(c.size[owner] - place), pa.array(c.size[owner])], names=["gram", "cls", "comp", "left", "n"])

    left = materialize(chunks.join(found, "block").select("body", "answer").mapInArrow(rarest, "gram long, cls long, comp long, left long, n long"), "rarest")
    right = left.select("gram", F.col("cls").alias("cls2"), F.col("comp").alias("comp2"), F.col("left").alias("left2"), F.col("n").alias("n2"))
    # at the first n-gram two linked sets share, what is left of either holds their whole overlap
    near = F.least("left", "left2") * (num + den) >= (F.col("n") + F.col("n2")) * num
    pairs = left.join(right, (left.gram == right.gram) & (F.col("cls") < F.col("cls2")) & (F.col("comp") != F.col("comp2")) & near).select("cls", "cls2").distinct()
    sets = materialize(chunks.select("body").mapInArrow(_rows_of, _ROWS), "rows")
    other = sets.select(F.col("cls").alias("cls2"), F.col("comp").alias("comp2"), F.col("hashes").alias("hashes2"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (x, y) in enumerate(zip(batch["hashes"].to_pylist(), batch["hashes2"].to_pylist())):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = np.sort(np.concatenate([x, y]))
                overlap = int((both[1:] == both[:-1]).sum())
                if den * overlap >= num * (len(both) - overlap):
                    keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    full = pairs.join(sets, "cls").join(other, "cls2").select(F.col("comp").alias("a"), F.col("comp2").alias("b"), "hashes", "hashes2")
    return materialize(full.mapInArrow(verify, "a long, b long").distinct(), "links")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per input row.

    Words are [^\\x20\\x09-\\x0D]+ after A-Z became a-z.  Two documents link when
    den * |intersection| >= num * |union| of their distinct n-word shingles; a text with
    fewer than n words has its whole sequence as its one shingle.  component_id is the
    smallest non-null doc_id reachable by links, itself included.  Null or wordless text:
    n_shingles 0, linked with nothing, component_id its own doc_id.  Null doc_id: the row
    is kept and linked; it is null only if its whole component has none.  Rows that repeat
    a doc_id are documents of their own.  Ids are integers, or strings of them; others fail.
    Other input columns are not read.
    """
    docs = document_sets(df, id_col, text_col, n, num, den)
    reps = docs.filter("hashes is not null").dropDuplicates(["cls"]).select("cls", F.col("n_shingles").alias("n"), "hashes")
    chunks = pack_sets(reps.withColumn("comp", F.col("cls")), _count(docs.filter("hashes is not null"), "n_shingles"))
    roots: DataFrame | None = None
    alive = _count(chunks)
    while alive:
        while True:
            before, chunks = alive, prune(chunks, num, den)
            alive = _count(chunks)
            if alive > 0.97 * before or not alive:
                break
        if not alive:
            break
        links = hub_links(chunks, num, den)
        last = links.count() * 50 < alive
        if last:
            links = links.unionByName(remaining_links(chunks, num, den))
            if links.isEmpty():
                break
        step = connected_components(links)
        if roots is None:
            roots = step
        else:
            moved = roots.join(step.select(F.col("node").alias("root"), F.col("root").alias("over")), "root", "left").select("node", F.coalesce("over", "root").alias("root"))
            roots = materialize(moved.unionByName(step.join(roots, "node", "left_anti")), "roots")
        if last:
            break
        chunks = _renamed(chunks, roots)
    slim = docs.select("doc_id", "n_shingles", "cls")
    if roots is None:
        rooted = slim.withColumn("comp", F.col("cls"))
    else:
        rooted = slim.join(roots, slim.cls == roots.node, "left").select("doc_id", "n_shingles", "cls", F.coalesce("root", "cls").alias("comp"))
    linked = rooted.filter("n_shingles > 0")
    low = linked.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")).filter("rows > 1").select("comp", "component_id")
    out = rooted.withColumn("comp", F.when(F.col("n_shingles") > 0, F.col("comp"))).join(low, "comp", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _renamed(chunks: DataFrame, roots: DataFrame) -> DataFrame:
    """Chunks with each set's component replaced by its root."""

    sets = chunks.select("body").mapInArrow(_rows_of, _ROWS)
    return pack_sets(sets.join(roots, sets.comp == roots.node, "left").select("cls", F.coalesce("root", "comp").alias("comp"), "n", "hashes"), _count(chunks, "n_bytes") // 8)


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """df with one row of each near-duplicate group: the first by id, null ids last, then by place in df."""
    rows, key = with_row_keys(df)
    groups = jaccard_components(rows, key, text_col, n, num, den)
    named = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select(F.col(key).alias("row"), F.col(quoted(id_col)).alias("id")), "row")
    spot = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    named = materialize(named.select("component_id", spot.alias("spot")), "named")
    first = named.groupBy("component_id").agg(F.min("spot").alias("first"), F.count("*").alias("rows")).filter("rows > 1").select("component_id", F.col("first.row").alias("kept"))
    gone = named.join(first, "component_id").select(F.col("spot.row").alias(key), "kept").filter(F.col(key) != F.col("kept")).select(key)
    gone = broadcast_if_small(materialize(gone, "gone"))
    return rows.join(gone, key, "left_anti").select(*all_columns(df))
