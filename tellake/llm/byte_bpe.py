"""Byte-level BPE encoding and decoding by a tree of joins.

A piece of text (one match of the vocabulary's pattern) is halved down to bytes.  Two encoded
neighbours are joined by encoding the bytes of a window around their border anew: first one
token on each side, then two, four and so on, on the side that still moves, until the tokens
outside are proved to stay.

The proof: merges go by lowest rank, leftmost first, so what happens inside a stretch of bytes
that no merge crosses is what happens to that stretch alone.  Hence a sequence of tokens is
the encoding of its bytes if and only if each two neighbours are the encoding of their own
bytes.  Inside both halves and inside the window this holds; only the two pairs at the
window's ends are looked at.  Joining is associative, so any tree gives the same tokens.
Matches never merge with each other: above them a join is a concatenation.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import vocabulary
from .words import slices, text_buffers

#: a text is cut for the pattern about every so many characters, so that its matches are never all in memory
SECTION = 1 << 18
#: tokens of a leaf of the decoding tree
LEAF = 1 << 10
#: longest piece that is remembered, and how many of them and of token pairs
SHORT, REMEMBERED = 32, 1 << 18
#: windows up to so many bytes are merged by scanning, longer ones with a heap
SCANNED = 64
NO_RANK = 1 << 62
#: before white space that follows anything else, every match of the pattern ends
CUT = regex.compile(r"(?<=\S)(?=\s)")
OUT_BYTES = 8 << 20


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of a few bytes: of all neighbours that are a token together, the one of lowest rank (leftmost first) merges, until none is left."""
    if len(piece) > SCANNED:
        return merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(parts[i] + parts[i + 1], NO_RANK) for i in range(len(parts) - 1)]
    while pairs:
        low = min(pairs)
        if low == NO_RANK:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NO_RANK)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NO_RANK)
    return [ranks[p] for p in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of (rank, start) and links between parts: n log n for a window of n bytes."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n

    def rank(i: int) -> int:
        return ranks.get(piece[i : end[end[i]]], NO_RANK) if end[i] < n else NO_RANK

    heap = [(r, i, end[i], end[end[i]]) for i in range(n - 1) if (r := rank(i)) != NO_RANK]
    heapq.heapify(heap)
    while heap:
        _, i, mid, last = heapq.heappop(heap)
        if not live[i] or end[i] != mid or end[mid] != last:
            continue  # one of the two parts has merged since
        live[mid], end[i] = False, last
        if last < n:
            before[last] = i
        for k in (before[i], i):
            if k >= 0 and (r := rank(k)) != NO_RANK:
                heapq.heappush(heap, (r, k, end[k], end[end[k]]))
    return [ranks[piece[i : end[i]]] for i in range(n) if live[i]]


class TreeEncoder:
    """Encoder and decoder of one vocabulary; keeps a bounded number of short pieces and token pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.halves: dict[bytes, list[int]] = {}
        self.pairs: dict[tuple[int, int], list[int]] = {}
        self.pieces: dict[str, bytes] = {}

    def pair(self, a: int, b: int) -> list[int]:
        """Encoding of the bytes of two tokens; [a, b] itself if they may stand side by side."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            got = self.pairs[a, b] = merge(self.bytes_of[a] + self.bytes_of[b], self.ranks)
        return got

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of two neighbours' bytes from the encodings of each."""
        if not left or not right:
            return left or right
        i = j = 1
        window = self.pair(left[-1], right[0])
        while True:
            left_stays = i == len(left) or len(self.pair(left[-i - 1], window[0])) == 2 and self.pair(left[-i - 1], window[0])[0] == left[-i - 1]
            right_stays = j == len(right) or len(self.pair(window[-1], right[j])) == 2 and self.pair(window[-1], right[j])[1] == right[j]
            if left_stays and right_stays:
                return left[: len(left) - i] + window + right[j:]
            i = i if left_stays else min(2 * i, len(left))
            j = j if right_stays else min(2 * j, len(right))
            window = merge(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i :] + right[:j])), self.ranks)

    def tree(self, piece: bytes) -> list[int]:
        """Tokens of a piece: its halves encoded and joined."""
        if len(piece) < 2:
            return [self.ranks[piece]] if piece else []
        got = self.halves.get(piece)
        if got is None:
            middle = len(piece) >> 1
            got = self.join(self.tree(piece[:middle]), self.tree(piece[middle:]))
            if len(piece) <= SHORT:
                if len(self.halves) >= REMEMBERED:
                    self.halves.clear()
                self.halves[piece] = got
        return got

    def piece(self, text: str) -> bytes:
        """Ids of one match as little-endian uint32; a match that is a token whole is that token."""
        got = self.pieces.get(text)
        if got is None:
            raw = text.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            got = np.array(self.tree(raw) if whole is None else [whole], "<u4").tobytes()
            if len(text) <= SHORT:
                if len(self.pieces) >= REMEMBERED:
                    self.pieces.clear()
                self.pieces[text] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian uint32."""
        return b"".join(b"".join(map(self.piece, self.pattern.findall(part))) for part in sections(text))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated up a tree of halves; an id outside the vocabulary is a KeyError."""
        if len(ids) <= LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) >> 1
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def sections(text: str, size: int = SECTION) -> Iterator[str]:
    """Parts of a text of about `size` characters, cut where every match ends; a stretch without white space stays whole."""
    start = 0
    while len(text) - start > size and (at := CUT.search(text, start + size)):
        yield text[start : at.start()]
        start = at.start()
    yield text[start:]


def _in_batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows whose last value is binary as record batches of about OUT_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size >= OUT_BYTES:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def encode_texts(df: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, ids): the token ids of every whole text as little-endian uint32, one row a row of df.

    Only the two columns are read.  A null or empty text has no ids; null and repeated ids stay as they
    are; special tokens are ordinary text.  No shuffle: a row is encoded where it is read.  The
    vocabulary (a megabyte or so) is broadcast.  Ids of any integer type, or strings of integers.
    """
    told = df.sparkSession.sparkContext.broadcast(vocabulary(df.sparkSession, vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TreeEncoder(read_ranks(told.value), pattern)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                buf, offsets, _ = text_buffers(batch.column(1))
                ids = batch.column(0).to_pylist()
                for i, j in slices(offsets):
                    raw = buf[offsets[i] : offsets[j]].tobytes()
                    for k in range(i, j):
                        text = raw[offsets[k] - offsets[i] : offsets[k + 1] - offsets[i]].decode("utf-8", "replace")
                        yield ids[k], coder.encode(text) if text else b""

        yield from _in_batches(rows(), [id_col, "ids"], [pa.int64(), pa.binary()])

    slim = df.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(run, f"`{id_col}` long, ids binary")


def decode_ids(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id_col, ids, decoded): the bytes that little-endian uint32 ids stand for; null ids decode to nothing."""
    told = encoded.sparkSession.sparkContext.broadcast(vocabulary(encoded.sparkSession, vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TreeEncoder(read_ranks(told.value), "x")

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for key, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                    raw = ids.as_py() or b""
                    yield key, raw, coder.decode(np.frombuffer(raw, "<u4").tolist())

        yield from _in_batches(rows(), [id_col, "ids", "decoded"], [pa.int64(), pa.binary(), pa.binary()])

    slim = encoded.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{ids_col}`").alias("ids"))
    return slim.mapInArrow(run, f"`{id_col}` long, ids binary, decoded binary")


def round_trip(df: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_tokens, ids_sha256, decoded_sha256): texts encoded, then decoded from their ids alone; odd rows as encode_texts."""
    out = decode_ids(encode_texts(df, vocab_path, pattern, id_col, text_col), vocab_path, id_col)
    return out.select(id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
