"""Prefix trie of conversations: z-fast tries over ranges of turn sequences, merged along their borders.

A conversation is a sequence of turns, each a pair of 64-bit hashes.  Equal sequences are
collapsed first, then the distinct ones are dealt out by range of their turns, so that no
popular beginning is a hot key and every task holds one stretch of the sorted sequences.

Each task builds a compacted trie.  A node is an edge of turns; a hash table finds it by the
hash of its prefix at the two-fattest depth of the edge (the depth in it that the highest
power of two divides).  The deepest node that is a prefix of a sequence, its exit node, is
found by fat binary search over the depths: as many look-ups as the length has bits.
Sequences are located and inserted a batch at a time; edges are expanded at the end.

Only prefixes of a task's first or last sequence can be nodes of another task's trie too.
These few, the border, are summed up in Spark; all other nodes are final where they are made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import drop, materialize, partitions_of
from .words import mix

WORD = r"[^\x20\x09-\x0D]+"
#: turns by which sequences are dealt out; those that agree in all of them share a task
RANGE_TURNS = 256
#: turns a task should hold, and turns below which it need not be split
TASK_TURNS, LEAST_TURNS = 1 << 18, 1 << 12
ID_PART = 20
NOTHING = hashlib.sha256(b"").hexdigest()
FINAL, BORDER, HANGING = 0, 1, 2
NODE = "kind int, task long, side int, h1 long, h2 long, p1 long, p2 long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string"


def turns_of(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows (id, own): the turns of each conversation in order as structs of two hashes and the number of words.

    NULL turns come first; rows of one turn are ordered by role, then by hash.  NULL role or text: empty.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")).filter("id is not null")
    entry = F.struct("turn", "role", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    own = F.transform(F.sort_array(F.collect_list("entry")), lambda e: F.struct(e["a"].alias("a"), e["b"].alias("b"), e["words"].alias("words")))
    return turns.select("id", entry.alias("entry")).groupBy("id").agg(own.alias("own"))


def with_shared_starts(turns: DataFrame, step: int = 20, most: int = 4) -> DataFrame:
    """Rows (id, own) rebuilt: the first h turns of conversation id - id % step, then the own turns after the first h; h = crc32(id) % most."""
    h = (F.crc32(F.col("id").cast("string")) % most).cast("int")
    heads = turns.filter(F.col("id") % step == 0).select(F.col("id").alias("head"), F.slice("own", 1, most - 1).alias("start"))
    joined = turns.withColumns({"head": F.col("id") - F.col("id") % step, "h": h}).join(heads, "head", "left")
    rest = F.slice("own", F.col("h") + 1, F.size("own"))
    return joined.select("id", F.concat(F.coalesce(F.slice("start", F.lit(1), F.col("h")), F.slice("own", 1, 0)), rest).alias("own"))


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """Rows (conv, n, ends, a, b, words): each distinct sequence with its smallest id, number of ids and the SHA-256 of its ids.

    Ids are joined to texts by parts of 2**ID_PART ids, before and after the exchange; the parts of one
    sequence are then hashed one after the other as they come, in order of ids: its list is never in memory.
    """
    def field(name: str) -> Column:
        return F.transform("own", lambda e: e[name])

    rows = sequences.select("id", field("a").alias("a"), field("b").alias("b"), field("words").alias("words"))
    keyed = rows.withColumns({"k1": F.xxhash64("a"), "k2": F.xxhash64(F.lit(1), "b"), "part": F.shiftright("id", ID_PART)})
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda i: i.cast("string")), ",")
    parts = keyed.groupBy("k1", "k2", "part").agg(F.min("id").alias("conv"), F.count("*").alias("n"), ids.alias("ids"), F.first("a").alias("a"), F.first("b").alias("b"), F.first("words").alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, digest = None, None, 0, None

        def done() -> tuple:
            return first[0], n, digest.hexdigest(), *first[1:]

        for batch in batches:
            out = []
            lists = [batch.column(k) for k in (6, 7, 8)]
            for i, (k1, k2, conv, count, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5)))):
                if key == (k1, k2):
                    n += count
                    digest.update(b"," + text.encode())
                    continue
                if key is not None:
                    out.append(done())
                key, n, digest = (k1, k2), count, hashlib.sha256(text.encode())
                first = (conv, *(x[i].as_py() for x in lists))
            yield rows_of(out)
        if key is not None:
            yield rows_of([done()])

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        long, many = pa.int64(), pa.list_(pa.int64())
        columns = zip(*rows) if rows else [()] * 6
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (long, long, pa.string(), many, many, many))], names=["conv", "n", "ends", "a", "b", "words"])

    ordered = parts.select("k1", "k2", "part", "conv", "n", "ids", "a", "b", "words").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part")
    return ordered.mapInArrow(run, "conv long, n long, ends string, a array<long>, b array<long>, words array<long>")


def two_fattest(a: int, b: int) -> int:
    """The number above a and up to b that the highest power of two divides."""
    return b & (-1 << (a ^ b).bit_length() - 1)


class ZFastTrie:
    """Compacted trie of sequences given as lists of their prefixes' hashes (depth 0 first); node 0 is the root."""

    def __init__(self):
        self.up, self.depth, self.prefixes, self.kids, self.string = [0], [0], [[0]], [{}], [-1]
        self.handles: dict[int, int] = {}

    def _node(self, up: int, depth: int, prefixes: list[int]) -> int:
        v = len(self.up)
        self.up.append(up)
        self.depth.append(depth)
        self.prefixes.append(prefixes)
        self.kids.append({})
        self.string.append(-1)
        self._hang(v, up)
        return v

    def _hang(self, v: int, up: int) -> None:
        self.up[v] = up
        top = self.depth[up]
        self.kids[up][self.prefixes[v][top + 1]] = v
        self.handles[self.prefixes[v][two_fattest(top, self.depth[v])]] = v

    def exit(self, prefixes: list[int]) -> int:
        """The deepest node that is a prefix of the sequence, by fat binary search."""
        low, high, node = 0, len(prefixes) - 1, 0
        while low < high:
            middle = two_fattest(low, high)
            v = self.handles.get(prefixes[middle])
            if v is None:
                high = middle - 1
            elif self.depth[v] <= high and prefixes[self.depth[v]] == self.prefixes[v][self.depth[v]]:
                low, node = self.depth[v], v
            else:  # the sequence leaves on the edge to v, or ends there
                return self.up[v]
        return node

    def insert(self, batch: list[tuple[int, list[int]]]) -> list[int]:
        """End nodes of a batch of (string number, prefixes): all exits are located first, then each goes on from its own."""
        exits = [self.exit(p) for _, p in batch]
        return [self._insert(k, p, node) for (k, p), node in zip(batch, exits)]

    def _insert(self, k: int, prefixes: list[int], node: int) -> int:
        last = len(prefixes) - 1
        while self.depth[node] < last:
            child = self.kids[node].get(prefixes[self.depth[node] + 1])
            if child is None:
                node = self._node(node, last, prefixes)
                break
            theirs, most = self.prefixes[child], min(last, self.depth[child])
            if prefixes[most] == theirs[most] and most == self.depth[child]:
                node = child  # made by this batch
                continue
            low, high = self.depth[node] + 1, most
            while low < high:
                middle = (low + high + 1) >> 1
                low, high = (middle, high) if prefixes[middle] == theirs[middle] else (low, middle - 1)
            del self.handles[theirs[two_fattest(self.depth[node], self.depth[child])]]
            node = self._node(node, low, theirs)
            self._hang(child, node)
        self.string[node] = k
        return node

    def path(self, node: int) -> list[int]:
        """Nodes from the root to node."""
        out = [node]
        while node:
            node = self.up[node]
            out.append(node)
        return out[::-1]


def prefix_hashes(values: np.ndarray, lengths: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of all prefixes, the empty one (0) included, of sequences laid end to end: sums of the turns' hashes mixed with their places."""
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(values), dtype=np.int64) - np.repeat(starts, lengths)
    run = np.concatenate([[np.uint64(0)], np.cumsum(mix(values.view(np.uint64) ^ mix((place + salt).astype(np.uint64))))])
    at = np.repeat(starts, lengths + 1) + np.arange(len(values) + len(lengths)) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    return run[at] - np.repeat(run[starts], lengths + 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _halves(h: int) -> tuple[int, int]:
    return _signed(h >> 64), _signed(h & ((1 << 64) - 1))


def trie_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one task's sequences as rows of NODE."""
    trie, task = ZFastTrie(), TaskContext.get().partitionId()
    convs, ns, ends, words, end_of, order = [], [], [], [], [], []
    for batch in batches:
        lists = [batch.column(k) for k in (3, 4, 5)]
        lengths = np.asarray(lists[0].value_lengths().to_numpy(zero_copy_only=False), np.int64)
        a, b, w = (np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.int64) for x in lists)
        h1, h2 = prefix_hashes(a, lengths, 1 << 40).tolist(), prefix_hashes(b, lengths, 1 << 50).tolist()
        both = [x << 64 | y for x, y in zip(h1, h2)]
        after = np.cumsum(lengths)
        base = len(convs)
        end_of += trie.insert([(base + i, both[t - n + i : t + i + 1]) for i, (t, n) in enumerate(zip(after.tolist(), lengths.tolist()))])
        for t, n in zip(after.tolist(), lengths.tolist()):
            words.append(w[t - n : t].tolist())
            order.append(a[t - n : t].tolist())
        convs += batch.column(0).to_pylist()
        ns += batch.column(1).to_pylist()
        ends += batch.column(2).to_pylist()
    if convs:
        firsts = min(range(len(order)), key=order.__getitem__), max(range(len(order)), key=order.__getitem__)
        yield from _expanded(trie, task, convs, ns, ends, words, end_of, [trie.path(end_of[k]) for k in firsts])


def _expanded(trie: ZFastTrie, task: int, convs: list, ns: list, ends: list, words: list, end_of: list, chains: list[list[int]]) -> Iterator[pa.RecordBatch]:
    size = len(trie.up)
    low, n, leaves, saved, top = [None] * size, [0] * size, [0] * size, [0] * size, [0] * size
    border = {v for chain in chains for v in chain}
    kids_here, leaves_here, saved_here = [0] * size, [0] * size, [0] * size  # of children off the border
    through: list[list[int]] = [[]] * size  # words of the turns of a sequence through the node
    for v in sorted(range(size), key=trie.depth.__getitem__, reverse=True):
        k = trie.string[v]
        if k >= 0:
            n[v] += ns[k]
            low[v] = convs[k] if low[v] is None else min(low[v], convs[k])
            through[v] = words[k]
        if not trie.kids[v]:
            leaves[v] = 1
        own = through[v]
        if v:
            saved[v] += (n[v] - 1) * own[trie.depth[v] - 1]
            up = trie.up[v]
            top[v] = saved[v] + (n[v] - 1) * sum(own[trie.depth[up] : trie.depth[v] - 1])
            n[up] += n[v]
            low[up] = low[v] if low[up] is None else min(low[up], low[v])
            leaves[up] += leaves[v]
            saved[up] += top[v]
            through[up] = own
            if v not in border:
                kids_here[up] += 1
                leaves_here[up] += leaves[v]
                saved_here[up] += top[v]

    def rows() -> Iterator[tuple]:
        none = (None,) * 4
        for v in range(size):
            if v in border:
                continue
            up, end, k = trie.up[v], trie.depth[v], trie.string[v]
            total = top[v]
            for d in range(trie.depth[up] + 1, end + 1):
                hangs = d == trie.depth[up] + 1 and up in border
                keys = (None, None, *_halves(trie.prefixes[v][d - 1])) if hangs else none
                parent = low[v] if d > trie.depth[up] + 1 else None if hangs else low[up]
                yield HANGING if hangs else FINAL, task, 0, *keys, d, low[v], parent, n[v], len(trie.kids[v]) if d == end else 1, leaves[v], total, None, ends[k] if d == end and k >= 0 else None
                total -= (n[v] - 1) * through[v][d - 1]
        told: set[int] = set()
        for side, chain in enumerate(chains):
            for v in chain:
                end, k = trie.depth[v], trie.string[v]
                for d in range(trie.depth[trie.up[v]] + 1 if v else 0, end + 1):
                    keys = (*_halves(trie.prefixes[v][d]), *(_halves(trie.prefixes[v][d - 1]) if d else (None, None)))
                    last = d == end
                    w = through[v][d - 1] if d else 0
                    if v in told:
                        yield BORDER, task, side, *keys, d, None, None, 0, 0, 0, 0, w, None
                    else:
                        yield BORDER, task, side, *keys, d, low[v], None, n[v], kids_here[v] if last else 0, leaves_here[v] if last else 0, saved_here[v] if last else 0, w, ends[k] if last and k >= 0 else None
            told.update(chain)

    names = [c.split()[0] for c in NODE.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in NODE.split(", ")]
    held: list[tuple] = []
    for row in rows():
        held.append(row)
        if len(held) == 1 << 16:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)


def merged_border(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(result rows of the border's nodes, conv_id of each (task, h1, h2) of it).

    A node's subtree is the sum, over the chains through it, of what nodes from its depth on add that no
    other chain added: every node is counted in one chain, the first that holds it.
    """
    border = nodes.filter(F.col("kind") == BORDER).withColumn("chain", 2 * F.col("task") + F.col("side"))
    key = ["h1", "h2"]
    whole = border.groupBy(*key).agg(
        F.first("depth").alias("depth"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("words").alias("words"), F.min("chain").alias("owner"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256"))
    inner = whole.filter("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("inner"))
    counted = materialize(whole.join(inner, key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0))).drop("inner"), "border")
    own_leaf = F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    own_saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")
    values = counted.select(*key, "owner", "conv_id", own_leaf.alias("leaf"), own_saved.alias("save"))
    mine = F.col("chain") == F.col("owner")
    held = border.select(*key, "task", "chain", "depth").join(values, key)
    below = Window.partitionBy("chain").orderBy(F.desc("depth"))
    sums = held.select(*key, F.sum(F.when(mine, F.col("leaf")).otherwise(0)).over(below).alias("leaf"), F.sum(F.when(mine, F.col("save")).otherwise(0)).over(below).alias("save"))
    sums = sums.groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum("save").alias("saved_tokens"))
    parents = counted.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = counted.drop("n_leaves", "saved_tokens").join(sums, key).join(parents, ["p1", "p2"], "left")
    return out, held.select("task", F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("over")).distinct()


def prefix_trie(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one a node of the trie of rebuilt conversations.

    Conversations are rebuilt by with_shared_starts.  Rows without a conversation id are left out; NULL roles
    and texts are empty; repeated rows are turns of their own; no conversations: no rows.  Ids are integers, or
    strings of them.  The turns of one conversation, 24 bytes each, must fit a task; so must the
    conversations that share their first RANGE_TURNS turns, after equal ones are collapsed.
    """
    turns = turns_of(df, id_col, turn_col, role_col, text_col)
    return sequence_trie(with_shared_starts(turns))


def sequence_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of sequences (id, own), as prefix_trie; ids are distinct, own is an array of structs (a, b, words)."""
    distinct = materialize(distinct_sequences(sequences), "sequences")
    total = distinct.agg(F.sum(F.size("a") + 1)).first()[0] or 0
    tasks = max(min(partitions_of(distinct.sparkSession), total // LEAST_TURNS + 1), total // TASK_TURNS + 1)
    ranged = distinct.repartitionByRange(tasks, F.slice("a", 1, RANGE_TURNS))
    nodes = materialize(ranged.select("conv", "n", "ends", "a", "b", "words").mapInArrow(trie_nodes, NODE), "trie")
    drop(distinct)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    border, over = merged_border(nodes)
    hanging = nodes.filter(F.col("kind") == HANGING).drop("parent_conv_id").join(over, ["task", "p1", "p2"]).withColumnRenamed("over", "parent_conv_id")
    out = nodes.filter(F.col("kind") == FINAL).select(*columns).unionByName(hanging.select(*columns)).unionByName(border.select(*columns))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))

