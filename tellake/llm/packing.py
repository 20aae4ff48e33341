"""Token ids packed into rows of one capacity by best-fit-decreasing.

Texts are encoded with a public byte-level BPE (never trained here); a document longer than
the capacity is split into full rows and a rest, losing nothing.  Segments are packed
longest first, each into the fullest open row that still has room; a segment tree over
remaining capacities finds that row in log(capacity) steps.  Packing is done per pool of
neighbouring documents, so nothing is shuffled and a lost task repeats only its own pools.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed value: pre-tokenisation pattern that belongs to the vocabulary file
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
POOL_TOKENS = 1 << 21


class CapacityTree:
    """Which remaining capacities 1..n have an open row; finds the smallest that is large enough."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.any = [0] * (2 * self.leaves)

    def add(self, capacity: int, delta: int) -> None:
        at = capacity + self.leaves
        while at:
            self.any[at] += delta
            at >>= 1

    def smallest(self, least: int) -> int:
        """Smallest capacity >= least that has a row, or 0."""
        at = least + self.leaves
        if self.any[at]:
            return least
        while at > 1:
            if not at & 1 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return 0


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows as lists of segment indices; every length is between 1 and capacity."""
    tree, open_rows = CapacityTree(capacity), {}
    rows: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        room = tree.smallest(lengths[i])
        if room:
            row = open_rows[room].pop()
            tree.add(room, -1)
        else:
            row, room = len(rows), capacity
            rows.append([])
        rows[row].append(i)
        room -= lengths[i]
        if room:
            open_rows.setdefault(room, []).append(row)
            tree.add(room, 1)
    return rows


def vocabulary(spark: SparkSession, path: str) -> bytes:
    """Content of a rank file (a megabyte or so), read by Spark so that any store will do."""
    where = path if "://" in path else f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(where).select("content").first()[0])


def encoder(content: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pack_documents(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int | None = 50256, pad_id: int = 0) -> DataFrame:
    """Rows (row_id, doc_ids, doc_starts, cu_seqlens, resets, n_tokens, ids) of `capacity` tokens.

    ids: little-endian uint16 (uint32 if the vocabulary needs it), padded with pad_id, so
    that the rows of a file are one id matrix.  Segment k is ids[cu_seqlens[k]:cu_seqlens[k+1]]
    and holds document doc_ids[k] from token doc_starts[k] on.  Positions restart from 0 at
    each of resets.  Each document ends with end_id unless None.  A null text has no tokens
    and no segment; an empty one has its end_id alone.  Null and repeated ids are kept as they are; ids
    are integers, or strings of them, and others fail.
    """
    told = df.sparkSession.sparkContext.broadcast(vocabulary(df.sparkSession, vocab_path))
    lines = told.value.count(b"\n") + 1
    kind = np.dtype("<u2" if max(lines, end_id or 0, pad_id) < 65536 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(told.value).encode_to_numpy
        part, seq, held, tokens = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                ids = encode(text.as_py(), disallowed_special=()).astype(kind)
                if end_id is not None:
                    ids = np.append(ids, kind.type(end_id))
                for at in range(0, len(ids), capacity):
                    held.append((doc, at, ids[at : at + capacity]))
                tokens += len(ids)
                if tokens >= POOL_TOKENS:
                    yield pool(held, (part << 40) | seq)
                    seq, held, tokens = seq + len(held), [], 0
        if held:
            yield pool(held, (part << 40) | seq)

    def pool(held: list[tuple], first: int) -> pa.RecordBatch:
        rows = best_fit_decreasing([len(h[2]) for h in held], capacity)
        matrix = np.full((len(rows), capacity), pad_id, kind)
        bounds = []
        for r, row in enumerate(rows):
            ends = np.cumsum([0, *(len(held[k][2]) for k in row)])
            bounds.append(ends.tolist())
            matrix[r, : ends[-1]] = np.concatenate([held[k][2] for k in row])
        return pa.record_batch(
            [pa.array(np.arange(first, first + len(rows))), pa.array([[held[k][0] for k in row] for row in rows], pa.list_(pa.int64())), pa.array([[held[k][1] for k in row] for row in rows], pa.list_(pa.int32())),
             pa.array(bounds, pa.list_(pa.int32())), pa.array([b[:-1] for b in bounds], pa.list_(pa.int32())), pa.array([b[-1] for b in bounds], pa.int32()), pa.array([x.tobytes() for x in matrix], pa.binary())],
            names=["row_id", "doc_ids", "doc_starts", "cu_seqlens", "resets", "n_tokens", "ids"])

    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "row_id long, doc_ids array<long>, doc_starts array<int>, cu_seqlens array<int>, resets array<int>, n_tokens int, ids binary")


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: id matrix rows, cumulative segment lengths and position resets side by side."""
    packed.write.mode("overwrite").parquet(path)


def matrix_of(ids: list[bytes], capacity: int, kind: str = "<u2") -> np.ndarray:
    """Id matrix of some packed rows."""
    return np.frombuffer(b"".join(ids), kind).reshape(len(ids), capacity)


def position_ids(cu_seqlens: list[int], capacity: int) -> np.ndarray:
    """Position of each token of a row, restarting at every segment; 0 in the padding."""
    out = np.zeros(capacity, np.int32)
    for a, b in zip(cu_seqlens, cu_seqlens[1:]):
        out[a:b] = np.arange(b - a)
    return out
