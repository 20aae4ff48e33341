"""Substring dedup by level-wise doubling of repeated word windows.

A window of `length` words can only repeat if its shorter windows do.  Levels are start,
2 * start, ... up to `length`.  At each level a surviving window is stood for by the
smallest hash among the level-sized windows inside it: equal windows have equal smallest
hashes, so a window whose stand-in occurs at one place only is dropped, and only those
that are left go on to twice that length.  Stand-ins are few (about two in each
length - level + 2 words), which keeps the first level's shuffle small.  On the last level
the window stands for itself, and its smallest document id over all rows decides.  Doubling
ends at `length`, as every longer repeated window is made of windows of that length, all of
which are decided there already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, Emit, answers, bucket_count, exchange, make_blocks
from .words import SPACED, U, Words, inside_one_text, split_words, windows


def levels(start: int, length: int) -> list[int]:
    out = []
    while start < length:
        out.append(start)
        start *= 2
    return [*out, length]


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of x[i:i+n] for each i."""
    if len(x) < n:
        return x[:0]
    have = 1
    out = x
    while 2 * have <= n:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    m = len(x) - n + 1
    return np.minimum(out[:m], out[n - have : n - have + m])


class Windows:
    """The windows of `length` words of a block that are still candidates."""

    def __init__(self, body: bytes, length: int):
        self.block, self.length = Block(body), length
        self.words: Words = split_words(self.block.buf, self.block.offsets, SPACED)
        self.at = np.flatnonzero(inside_one_text(self.words, length))

    def stand_ins(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all level-sized windows inside one text, and the stand-in of each candidate."""
        every = windows(self.words.hash, level)
        inside = inside_one_text(self.words, level)
        own = sliding_min(every, self.length - level + 1)[self.at] if len(self.at) else every[:0]
        return every[inside], own

    def narrow(self, level: int, again: np.ndarray) -> None:
        """Keep candidates whose stand-in is answered as repeated."""
        _, own = self.stand_ins(level)
        self.at = self.at[again[np.searchsorted(np.unique(own), own)].astype(bool)]


def _distinct(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, np.int64)


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, start: int = 10) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, removed, kept_text), one per input row.

    Words are [^\\x20\\x09-\\x0D]+, unchanged.  A word is removed if a window of `length`
    words covers it whose word sequence also starts earlier: in a document with a smaller
    id, or earlier in the same row.  removed holds word ranges [from, to), kept_text the
    other words joined by one space.  Null or wordless text: no words, empty kept_text.
    A null id comes after all others; rows that share an id, or have none, do not remove
    from each other.  Windows are compared by 64-bit hashes of their words.  Ids are integers,
    or strings of them; others fail.
    """
    rows = make_blocks(df, id_col, text_col)
    buckets = bucket_count(rows)
    steps = levels(start, length)
    names = ["body"]

    def candidates(body: bytes, parts: tuple) -> Windows:
        w = Windows(body, length)
        for level, p in zip(steps, parts):
            w.narrow(level, answers(p, np.uint8))
        return w

    for k, level in enumerate(steps[:-1]):

        def count(body: bytes, *parts, level=level):
            every, own = candidates(body, parts).stand_ins(level)
            keys = np.unique(own)
            every = np.sort(every)
            found = np.searchsorted(every, keys, "right") - np.searchsorted(every, keys)
            return keys, np.minimum(found, 2).astype(np.uint8)

        def fold(keys: np.ndarray, values: np.ndarray, group: np.ndarray):
            return (np.bincount(group, values) > 1).astype(np.uint8), None

        found, _ = exchange(rows, Emit(count, "u1"), fold, buckets, names, f"level{level}")
        rows = rows.join(found.withColumnRenamed("answer", f"a{k}"), "block", "left")
        names = [*names, f"a{k}"]

    def own_minimum(w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows, the smallest id of each in the block, and the index of each candidate's window."""
        own = windows(w.words.hash, length)[w.at]
        ids = w.block.ids[w.words.doc[w.at]]
        order = np.argsort(own, kind="stable")
        cut = _distinct(own[order])
        index = np.empty(len(own), np.int64)
        index[order] = np.repeat(np.arange(len(cut)), np.diff(np.r_[cut, len(own)]))
        return own[order][cut], np.minimum.reduceat(ids[order], cut) if len(cut) else ids, index

    def least(body: bytes, *parts):
        return own_minimum(candidates(body, parts))[:2]

    def fold_least(keys: np.ndarray, values: np.ndarray, group: np.ndarray):
        cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        return (values == np.minimum.reduceat(values, cut)[group]).astype(np.uint8), None

    found, _ = exchange(rows, Emit(least, "<i8"), fold_least, buckets, names, f"level{length}", lazy=True)
    rows = rows.join(found.withColumnRenamed("answer", "last"), "block", "left")
    names = [*names, "last"]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                w = candidates(row["body"], [row[c] for c in names[1:-1]])
                keys, low, index = own_minimum(w)
                doc = w.words.doc[w.at]
                here = answers(row["last"], np.uint8).astype(bool)
                gone = np.zeros(len(w.at), bool)
                if len(w.at):
                    order = np.lexsort((doc, index))
                    first = np.zeros(len(w.at), bool)
                    first[order] = np.r_[True, (index[order][1:] != index[order][:-1]) | (doc[order][1:] != doc[order][:-1])]
                    gone = ~here[index] | (w.block.ids[doc] > low[index]) | ~first
                yield _kept(w, w.at[gone])

    return rows.select(*names).mapInArrow(remove, "doc_id long, n_words long, n_removed long, removed array<struct<from:int,to:int>>, kept_text string")


_SPAN = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _kept(w: Windows, gone: np.ndarray) -> pa.RecordBatch:
    """Result rows of a block from the word positions where removed windows start."""
    words, block = w.words, w.block
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + w.length, -1)
    out = np.cumsum(edge[:-1]) > 0
    n_words = np.diff(words.first)
    total = np.r_[0, np.cumsum(out)]
    n_removed = total[words.first[1:]] - total[words.first[:-1]]
    spans, texts = [], []
    for i in range(len(n_words)):
        a, b = int(words.first[i]), int(words.first[i + 1])
        every = block.text(i).split()
        if n_removed[i]:
            mask = out[a:b]
            flip = np.flatnonzero(np.diff(np.r_[False, mask, False])).tolist()
            spans.append([{"from": x, "to": y} for x, y in zip(flip[::2], flip[1::2])])
            every = [every[k] for k in np.flatnonzero(~mask).tolist()]
        else:
            spans.append([])
        texts.append(b" ".join(every))
    return pa.record_batch(
        [pa.array(block.id_list(), pa.int64()), pa.array(n_words), pa.array(n_removed), pa.array(spans, _SPAN), pa.array(texts, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "n_removed", "removed", "kept_text"])


def substring_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, start: int = 10) -> DataFrame:
    """repeated_spans with the kept text as its SHA-256: (doc_id, n_words, n_removed, kept_sha256)."""
    out = repeated_spans(df, id_col, text_col, length, start)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
