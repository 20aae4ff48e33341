"""Document blocks and the keyed exchange that several operators share.

A block is one row that holds about one MB of whole texts, compressed.  Blocks are written
once, so their ids and the order of texts inside never change, whatever is recomputed.

The keyed exchange answers, for every distinct 64-bit key of every block, a question about
the key over all blocks ("in how many texts?", "smallest document?").  A block sends each
distinct key once, cut by key range into buckets; one group folds the blocks' parts of one
bucket; answers come back per block in the order of the keys.  A key held by a third of all
rows thus adds one entry per block, not one per row, and only packed arrays are shuffled.
Rows of the shuffle are (blocks x buckets).  Up to KNEE bytes of text a block has a fixed size and
so has a bucket; beyond, both grow with the square root of the input, so that a row holds the
same bytes at every size and the rows grow in proportion to the input, not with its square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialize, partitions_of
from .words import slices, text_buffers

BLOCK_BYTES, BUCKET_BYTES, KNEE = 1 << 20, 12 << 20, 32 << 30
NO_ID = np.iinfo(np.int64).max


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays to one compressed value; unpack gives them back."""
    head = [len(arrays)]
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head += [a.nbytes, np.frombuffer(a.dtype.str.encode().ljust(8), np.int64)[0]]
        parts.append(a.tobytes())
    return zstandard.compress(np.array(head, np.int64).tobytes() + b"".join(parts), 3)


def unpack(value: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(value)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    at, out = 8 + 16 * n, []
    for k in range(n):
        size, kind = int(head[2 * k]), head[2 * k + 1 : 2 * k + 2].tobytes().decode().strip()
        out.append(np.frombuffer(raw, np.uint8, size, at).view(kind))
        at += size
    return out


def id_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as int64, null as NO_ID (after all others), and null flags."""
    null = np.asarray(column.is_null())
    return np.asarray(column.cast(pa.int64()).fill_null(NO_ID)), null


class Block:
    """Texts of one block: ids, null flags, buffer and offsets."""

    def __init__(self, body: bytes):
        self.ids, flags, self.buf, self.offsets = unpack(body)
        self.no_id, self.no_text = (flags & 1).astype(bool), (flags & 2).astype(bool)

    def text(self, i: int) -> bytes:
        return self.buf[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def id_list(self) -> list[int | None]:
        return [None if n else int(x) for x, n in zip(self.ids.tolist(), self.no_id.tolist())]


def exchange_sizes(total: int) -> tuple[int, int]:
    """Bytes of text in a block and in a bucket for an input of total bytes; total / block * total / bucket rows meet."""
    grown = max(1.0, (total / KNEE) ** 0.5)
    return int(BLOCK_BYTES * grown), int(BUCKET_BYTES * grown)


def text_bytes(df: DataFrame, text_col: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def make_blocks(df: DataFrame, id_col: str, text_col: str, block_bytes: int | None = None) -> DataFrame:
    """Documents as blocks (block long, n_docs int, n_bytes long, body binary), materialised.

    Only the two columns are read.  Null text: empty; null id: kept, ordered after all others.
    Ids are integers, or strings of them; others fail.
    """
    block_bytes = block_bytes or exchange_sizes(text_bytes(df, text_col))[0]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, seq
            lengths = np.concatenate([h[3] for h in held])
            body = pack(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
            out = pa.record_batch([pa.array([(part << 32) | seq]), pa.array([len(lengths)], pa.int32()), pa.array([int(lengths.sum())]), pa.array([body], pa.binary())], names=["block", "n_docs", "n_bytes", "body"])
            held, size, seq = [], 0, seq + 1
            return out

        for batch in batches:
            ids, no_id = id_array(batch.column(0))
            buf, offsets, no_text = text_buffers(batch.column(1))
            flags = no_id.astype(np.uint8) | (no_text.astype(np.uint8) << 1)
            for i, j in slices(offsets, block_bytes):
                held.append((ids[i:j], flags[i:j], buf[offsets[i] : offsets[j]].copy(), np.diff(offsets[i : j + 1])))
                size += int(offsets[j] - offsets[i])
                if size >= block_bytes // 2:
                    yield flush()
        if held:
            yield flush()

    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialize(slim.mapInArrow(build, "block long, n_docs int, n_bytes long, body binary"), "blocks")


def bucket_count(df: DataFrame, column: str = "n_bytes") -> int:
    """Buckets for keys made from `column` bytes: three a shuffle partition, more as the data grow, fewer for little data."""
    return buckets_for(df.sparkSession, df.agg(F.sum(column)).first()[0] or 0)


def buckets_for(spark: SparkSession, total: int) -> int:
    each = exchange_sizes(total)[1]
    return int(max(min(3 * partitions_of(spark), total // (each >> 6) + 1), total // each))


def exchange(rows: DataFrame, emit: Callable, fold: Callable, n_buckets: int, columns: list[str], name: str, lazy: bool = False) -> tuple[DataFrame, DataFrame]:
    """Ask about keys over all rows.

    emit(*columns of a row) -> (keys, values): keys sorted, distinct uint64; values a numpy
    (structured) array beside them.  fold(keys, values, group) gets one bucket's distinct keys,
    the values sorted by key and the index of the key of each, and returns (an answer per
    distinct key or per value, bytes or None).  Returns answers (block, answer: list of packed
    parts in key order) and the folds' bytes (one row a bucket), both of one table, which is
    materialised unless lazy.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, values = emit(*(row[c] for c in columns))
                if not len(keys):
                    continue
                bucket = bucket_of(keys, n_buckets)
                cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                ends = np.r_[cut[1:], len(keys)]
                yield pa.record_batch(
                    [pa.array(bucket[cut].astype(np.int32)), pa.array(np.full(len(cut), row["block"], np.int64)),
                     pa.array([keys[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()), pa.array([values[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())],
                    names=["bucket", "block", "keys", "vals"])

    kind = emit.values

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.uint64) for x in pdf["keys"]]
        keys = np.concatenate(parts)
        values = np.concatenate([np.frombuffer(x, kind) for x in pdf["vals"]])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.r_[True, keys[1:] != keys[:-1]]
        group = np.cumsum(new) - 1
        out, said = fold(keys[new], values[order], group)
        back = np.empty(len(keys), out.dtype)
        back[order] = out[group] if len(out) <= group[-1] + 1 else out
        ends = np.cumsum([len(p) for p in parts])
        got = pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "answer": [pack(x) for x in np.split(back, ends[:-1])], "said": None})
        if said is not None:
            got.loc[len(got)] = [-1, int(pdf["bucket"].iloc[0]), None, said]
        return got

    sent = rows.mapInArrow(send, "bucket int, block long, keys binary, vals binary")
    table = sent.groupBy("bucket").applyInPandas(answer, "block long, bucket int, answer binary, said binary")
    table = table if lazy else materialize(table, name)
    parts = table.filter("block >= 0").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("parts"))
    found = parts.select("block", F.col("parts.answer").alias("answer"))
    found._stored_at = getattr(table, "_stored_at", None)
    return found, table.filter("block < 0").select("said")


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of each key by range of its upper 32 bits, so that sorted keys have sorted buckets."""
    return (((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.int64)


def answers(parts: list[bytes] | None, kind) -> np.ndarray:
    """The answers of one row's keys, in key order."""
    return np.concatenate([unpack(p)[0] for p in parts]).view(kind) if parts else np.zeros(0, kind)


class Emit:
    """A function for exchange() with the dtype of the values it sends."""

    def __init__(self, function: Callable, values):
        self.function, self.values = function, np.dtype(values)

    def __call__(self, *args):
        return self.function(*args)
