"""Gated recurrent language model with a class-factored output, in numpy inside Spark tasks.

Words are counted over all training documents.  The most frequent words (the head, with
the end of a text) are predicted as P(class) * P(word | class), both softmaxes of the
recurrent state; all other words fall into tail classes by their ending, within which the
probability is the smoothed relative frequency.  Each class is small, so one prediction
costs far less than a softmax over the vocabulary, and every known word has a probability.

Training is truncated backpropagation through time over every token of every training document.
Tasks train on their own share of the training stream from the same parameters, which are then
averaged by token count (in Spark, in two steps), for a few rounds; each document is of one round,
chosen by checksum.

Scoring carries the state through the whole text, window by window, many texts side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Block, Emit, answers, bucket_count, exchange, make_blocks, pack, unpack
from .store import materialize
from .words import LOWER, SPACED, U, split_words

HEAD, PER_CLASS, TAIL = 512, 32, 32
HEAD_CLASSES = HEAD // PER_CLASS
CLASSES = HEAD_CLASSES + TAIL
HIDDEN = 16
END = U(1)
ROUNDS = 3
#: a window is STEPS tokens of many lanes; a lane runs for WINDOWS windows, and LANES lanes are the most
LANES, STEPS, WINDOWS = 512, 16, 32
SCORE_LANES, SCORE_TOKENS = 1024, 2_500_000
#: tokens whose outputs are computed at once
SLICE = 8192
SMOOTH = 0.1


def is_held_out(ids: np.ndarray, no_id: np.ndarray, modulus: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Whether crc32 of the id as text is divisible by modulus (null: no), and the checksums."""
    crc = np.array([zlib.crc32(str(i).encode()) for i in ids.tolist()], np.int64)
    return (crc % modulus == 0) & ~no_id, crc


class Tokens:
    """Words of a block: hash, tail class and text index of each; one end is added per text where needed."""

    def __init__(self, body: bytes):
        self.block = Block(body)
        w = split_words(self.block.buf, self.block.offsets, SPACED, LOWER)
        last = w.buf[w.end - 1].astype(np.int64) if len(w) else np.zeros(0, np.int64)
        before = np.where(w.end - w.start > 1, w.buf[np.maximum(w.end - 2, 0)], 0).astype(np.int64) if len(w) else last
        self.tail = ((last * 257 + before) * 40503 >> 7) % TAIL
        self.hash, self.doc, self.first = w.hash, w.doc, w.first
        self.held_out, self.crc = is_held_out(self.block.ids, self.block.no_id)

    def with_ends(self, values: np.ndarray, end) -> np.ndarray:
        """Per-word values of all texts with the value for the end after each text."""
        out = np.full(len(values) + len(self.first) - 1, end, values.dtype)
        out[np.arange(len(values)) + self.doc] = values
        return out


_COUNT = np.dtype([("n", "<u4"), ("tail", "u1")])


def training_counts(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a block with their training occurrences; END counts training texts."""
    return counts_of(Tokens(body))


def counts_of(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(t.hash, kind="stable")
    keys = t.hash[order]
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    used = ~t.held_out[t.doc[order]]
    out = np.zeros(len(cut) + 1, _COUNT)
    out["n"][1:] = np.add.reduceat(used.astype(np.uint32), cut) if len(cut) else 0
    out["tail"][1:] = t.tail[order][cut]
    out["n"][0] = (~t.held_out).sum()
    return np.r_[END, keys[cut]], out


def fold_counts(keys: np.ndarray, values: np.ndarray, group: np.ndarray):
    """Total count of each word; beside it the bucket's sums by tail class and its most frequent words."""
    total = np.bincount(group, values["n"]).astype(np.int64)
    tail = np.zeros(len(keys), np.int64)
    tail[group] = values["tail"]
    best = np.lexsort((keys, -total))[:HEAD]
    best = best[total[best] > 0]
    said = pack(np.bincount(tail, total, TAIL).astype(np.int64), np.bincount(tail, total > 0, TAIL).astype(np.int64), keys[best], total[best], tail[best])
    return total, said


@dataclass
class Vocabulary:
    """head: hashes of head words by index, sorted_head and rank: for look-ups; counts and class sums for smoothing."""

    head: np.ndarray
    head_count: np.ndarray
    tail_mass: np.ndarray
    class_count: np.ndarray
    tokens: int
    distinct: int

    def __post_init__(self):
        self.rank = np.argsort(self.head)
        self.sorted_head = self.head[self.rank]

    def index(self, words: np.ndarray) -> np.ndarray:
        """Head index of each word, -1 for others."""
        at = np.minimum(np.searchsorted(self.sorted_head, words), len(self.head) - 1)
        return np.where(self.sorted_head[at] == words, self.rank[at], -1)


def vocabulary(said: DataFrame) -> Vocabulary:
    """From the folds of all buckets: the HEAD most frequent words (END always), class sums, totals."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                count, distinct, keys, total, tail = unpack(value)
                yield pa.record_batch(
                    [pa.array(np.r_[np.zeros(TAIL, np.int64), np.ones(len(keys), np.int64)]), pa.array(np.r_[np.arange(TAIL), tail]), pa.array(np.r_[count, total]), pa.array(np.r_[distinct, keys.view(np.int64)])],
                    names=["kind", "tail", "n", "x"])

    table = materialize(said.mapInArrow(rows, "kind long, tail long, n long, x long"), "vocabulary")
    sums = table.filter("kind = 0").groupBy("tail").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    best = table.filter("kind = 1").orderBy(F.desc("n"), "x").limit(HEAD).collect()
    count, distinct = np.zeros(TAIL), np.zeros(TAIL)
    for r in sums:
        count[r["tail"]], distinct[r["tail"]] = r["n"], r["x"]
    tokens, different = int(count.sum()), int(distinct.sum())
    head = [(int(r["x"]), r["n"], r["tail"]) for r in best]
    if int(END) not in [h[0] for h in head]:
        found = table.filter((F.col("kind") == 1) & (F.col("x") == int(END))).first()
        head = [*head[: HEAD - 1], (int(END), found["n"] if found else 0, 0)]
    for _, n, tail in head:
        count[tail] -= n
        distinct[tail] -= n > 0
    mass = count + SMOOTH * distinct + SMOOTH
    head_count = np.array([h[1] for h in head], np.float64)
    by_class = np.array([head_count[k * PER_CLASS : (k + 1) * PER_CLASS].sum() for k in range(HEAD_CLASSES)])
    return Vocabulary(np.array([h[0] for h in head], np.int64).view(U), head_count, mass, np.r_[by_class, mass], tokens, different)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place of x."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def by_class(cls: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of head words, sorted by class, and the bounds of the classes in them."""
    at = np.flatnonzero(word >= 0)
    at = at[np.argsort(cls[at].astype(np.int16), kind="stable")]
    return at, np.searchsorted(cls[at], np.arange(HEAD_CLASSES + 1))


class Model:
    """Parameters: G input rows (head words, then tail classes) for the three gates, R recurrent, C class, W word output.

    States and all that follows from them are held by feature: [HIDDEN, lanes].
    """

    names = ("G", "R", "C", "c", "W", "w")

    def __init__(self, vocab: Vocabulary, values: list[np.ndarray] | None = None, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = np.float32
        if values is None:
            words = np.full(HEAD, -20.0)
            words[: len(vocab.head)] = np.log(vocab.head_count + SMOOTH)
            values = [rng.normal(0, 0.3, (HEAD + TAIL, 3 * HIDDEN)), rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)), rng.normal(0, 0.05, (HIDDEN, CLASSES)), np.log(vocab.class_count + SMOOTH), rng.normal(0, 0.05, (HEAD, HIDDEN)), words]
        for name, v in zip(self.names, values):
            setattr(self, name, np.array(v, f))

    def values(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.names]

    def step(self, g: np.ndarray, h: np.ndarray):
        """The states after inputs g [3 * HIDDEN, lanes], and what their gradient needs."""
        u = self.R.T @ h
        zr = sigmoid(g[: 2 * HIDDEN] + u[: 2 * HIDDEN])
        z, r, u = zr[:HIDDEN], zr[HIDDEN:], u[2 * HIDDEN :]
        n = r * u
        n += g[2 * HIDDEN :]
        np.tanh(n, out=n)
        h = h - n
        h *= z
        h += n
        return h, z, r, n, u

    def inputs(self, fed: np.ndarray) -> Iterator[np.ndarray]:
        """Inputs [3 * HIDDEN, lanes] of each step of words fed [steps, lanes]."""
        by_feature = np.ascontiguousarray(self.G.T)
        return (np.take(by_feature, row, axis=1) for row in fed)

    def log_probability(self, h: np.ndarray, cls: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log of P(class) and, for head words, P(word | class) after states h [HIDDEN, n]."""
        out = np.empty(h.shape[1], np.float32)
        for a in range(0, len(out), SLICE):
            own, c, w = h[:, a : a + SLICE], cls[a : a + SLICE], word[a : a + SLICE]
            x = self.C.T @ own
            x += self.c[:, None]
            said = x[c, np.arange(len(c))]
            np.exp(x, out=x)
            said -= np.log(x.sum(axis=0))
            at, bounds = by_class(c, w)
            own = own[:, at]
            for k, (i, j) in enumerate(zip(bounds, bounds[1:])):
                if i < j:
                    block = slice(k * PER_CLASS, (k + 1) * PER_CLASS)
                    y = self.W[block] @ own[:, i:j]
                    y += self.w[block, None]
                    inner = y[w[at[i:j]] - k * PER_CLASS, np.arange(j - i)]
                    np.exp(y, out=y)
                    said[at[i:j]] += inner - np.log(y.sum(axis=0))
            out[a : a + SLICE] = said
        return out


class Trainer:
    """Adagrad on windows of STEPS words in many lanes; seen: the sums of squares so far."""

    def __init__(self, model: Model, seen: list[np.ndarray] | None = None, rate: float = 0.15):
        self.m, self.rate = model, rate
        self.seen = [np.full(v.shape, 1e-3, np.float32) for v in model.values()] if seen is None else [np.array(v, np.float32) for v in seen]

    def run(self, fed: np.ndarray, fresh: np.ndarray, cls: np.ndarray, word: np.ndarray) -> int:
        """Train on a stream of tokens; returns how many of them fill its lanes, the rest (fewer than lanes) are left.

        A lane may start within a text: its state starts anew there.
        """
        lanes = max(1, min(LANES, len(fed) // (STEPS * WINDOWS)))
        length = len(fed) // lanes
        fed, fresh, cls, word = (x[: lanes * length].reshape(lanes, length).T for x in (fed, fresh, cls, word))
        fresh = fresh.copy()
        fresh[:1] = True
        h = np.zeros((HIDDEN, lanes), np.float32)
        for a in range(0, length, STEPS):
            h = self.window(h, *(np.ascontiguousarray(x[a : a + STEPS]) for x in (fed, fresh, cls, word)))
        return lanes * length

    def apply(self, k: int, grad: np.ndarray, rows=slice(None)) -> None:
        self.seen[k][rows] += grad * grad
        self.m.values()[k][rows] -= self.rate * grad / np.sqrt(self.seen[k][rows])

    def window(self, h: np.ndarray, fed: np.ndarray, fresh: np.ndarray, cls: np.ndarray, word: np.ndarray) -> np.ndarray:
        """One update from [steps, lanes] inputs; fresh: a text starts here.  Returns the last state."""
        m, steps, lanes = self.m, *fed.shape
        g = m.inputs(fed)
        past, gates = [], []
        states = np.empty((HIDDEN, steps, lanes), np.float32)
        for t in range(steps):
            if fresh[t].any():
                h = np.where(fresh[t], np.float32(0), h)
            past.append(h)
            h, *gate = m.step(next(g), h)
            gates.append(gate)
            states[:, t] = h
        flat, fc, fw = states.reshape(HIDDEN, -1), cls.ravel(), word.ravel()
        p = m.C.T @ flat
        p += m.c[:, None]
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        p[fc, np.arange(len(fc))] -= 1
        scale = np.float32(1 / lanes)
        p *= scale
        d_state = m.C @ p
        d_c, d_cb = flat @ p.T, p.sum(axis=1)
        d_w, d_wb = np.zeros_like(m.W), np.zeros_like(m.w)
        at, bounds = by_class(fc, fw)
        head, d_head = flat[:, at], np.empty((HIDDEN, len(at)), np.float32)
        for k, (i, j) in enumerate(zip(bounds, bounds[1:])):
            if i < j:
                block = slice(k * PER_CLASS, (k + 1) * PER_CLASS)
                y = m.W[block] @ head[:, i:j]
                y += m.w[block, None]
                np.exp(y, out=y)
                y /= y.sum(axis=0)
                y[fw[at[i:j]] - k * PER_CLASS, np.arange(j - i)] -= 1
                y *= scale
                d_head[:, i:j] = m.W[block].T @ y
                d_w[block], d_wb[block] = y @ head[:, i:j].T, y.sum(axis=1)
        d_state[:, at] += d_head
        d_state = d_state.reshape(HIDDEN, steps, lanes)
        d_g = np.empty((steps, 3 * HIDDEN, lanes), np.float32)
        d_r = np.zeros_like(m.R)
        d = np.zeros((HIDDEN, lanes), np.float32)
        back = np.empty((3 * HIDDEN, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            z, r, n, u = gates[t]
            d = d + d_state[:, t]
            d_n = d * (1 - z) * (1 - n * n)
            back[:HIDDEN] = d * (past[t] - n) * z * (1 - z)
            back[HIDDEN : 2 * HIDDEN] = d_n * u * r * (1 - r)
            back[2 * HIDDEN :] = d_n
            d_g[t] = back
            back[2 * HIDDEN :] *= r
            d_r += past[t] @ back.T
            d = d * z + m.R @ back
            if fresh[t].any():
                d = np.where(fresh[t], np.float32(0), d)
        ids = fed.ravel().astype(np.int64)
        used = np.flatnonzero(np.bincount(ids, minlength=HEAD + TAIL))
        d_in = np.stack([np.bincount(ids, x, HEAD + TAIL)[used] for x in (d_g[:, f].ravel() for f in range(3 * HIDDEN))], axis=1)
        self.apply(0, np.clip(d_in, -1, 1).astype(np.float32), used)
        for k, grad in ((1, d_r), (2, d_c), (3, d_cb), (4, d_w), (5, d_wb)):
            self.apply(k, np.clip(grad, -1, 1))
        return h


def codes(vocab: Vocabulary, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fed, cls, word) of each token with ends: input row, output class, head index or -1."""
    head = vocab.index(np.r_[t.hash, END])
    end = head[-1]
    head = head[:-1]
    fed = np.where(head >= 0, head, HEAD + t.tail)
    cls = np.where(head >= 0, head // PER_CLASS, HEAD_CLASSES + t.tail)
    return t.with_ends(fed, end), t.with_ends(cls, end // PER_CLASS), t.with_ends(head, end)


def shifted(fed: np.ndarray, t: Tokens, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs (the token before; the end before a text's first) and flags of first tokens."""
    fresh = np.zeros(len(fed), bool)
    fresh[t.first[:-1] + np.arange(len(t.first) - 1)] = True
    before = np.r_[end, fed[:-1]] if len(fed) else fed
    before[fresh] = end
    return before, fresh


def train(spark: SparkSession, blocks: DataFrame, vocab: Vocabulary) -> tuple[Model, int]:
    """The model and the number of tokens it was trained on: all of the training documents, each once."""
    told = spark.sparkContext.broadcast(vocab)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Training texts of each round as coded streams."""
        for batch in batches:
            for body in batch.column(0).to_pylist():
                t = Tokens(body)
                fed, cls, word = codes(told.value, t)
                before, fresh = shifted(fed, t, int(told.value.index(np.array([END]))[0]))
                turn = np.where(t.held_out, -1, t.crc // 10 % ROUNDS)
                turn = np.repeat(turn, np.diff(t.first) + 1)
                for r in range(ROUNDS):
                    own = turn == r
                    if own.any():
                        yield pa.record_batch([pa.array([r], pa.int32()), pa.array([pack(before[own].astype(np.int16), fresh[own], cls[own].astype(np.int16), word[own].astype(np.int16))], pa.binary())], names=["round", "body"])

    streams = materialize(blocks.select("body").mapInArrow(stream, "round int, body binary"), "stream")
    model, seen, tokens = Model(vocab), None, 0
    for turn in range(ROUNDS):
        start = spark.sparkContext.broadcast((model.values(), seen))

        def learn(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            values, seen = start.value
            own, held, size, done = Trainer(Model(told.value, values), seen), [], 0, 0

            def fit(parts: list) -> tuple:
                """Train on what is held; what is left over opens the next stretch."""
                nonlocal done
                whole = [np.concatenate(x) for x in zip(*parts)]
                n = own.run(*whole)
                done += n
                return tuple(x[n:] for x in whole)

            for batch in batches:
                for body in batch.column(0).to_pylist():
                    held.append(unpack(body))
                    size += len(held[-1][0])
                    if size >= LANES * STEPS * WINDOWS:
                        held = [fit(held)]
                        size = len(held[0][0])
            while held and size:
                held = [fit(held)]
                size = len(held[0][0])
            if done:
                part = TaskContext.get().partitionId() % 32
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([done]), pa.array([pack(*own.m.values(), *own.seen)], pa.binary())], names=["part", "n", "body"])

        def average(pdf: pd.DataFrame) -> pd.DataFrame:
            n = float(pdf["n"].sum())
            total: list | None = None
            for w, body in zip(pdf["n"], pdf["body"]):
                scaled = [v * np.float32(w / n) for v in unpack(body)]
                total = scaled if total is None else [a + b for a, b in zip(total, scaled)]
            return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "n": [int(n)], "body": [pack(*total)]})

        schema = "part int, n long, body binary"
        own = streams.filter(F.col("round") == turn).select("body").mapInArrow(learn, schema)
        got = own.groupBy("part").applyInPandas(average, schema).toPandas()
        if len(got):
            mean = average(got.sort_values("part"))
            tokens += int(mean["n"][0])
            found = [v.reshape(w.shape) for v, w in zip(unpack(mean["body"][0]), model.values() * 2)]
            seen = found[len(Model.names) :]
            model = Model(vocab, found[: len(Model.names)])
    return model, tokens


def score_texts(model: Model, fed: np.ndarray, cls: np.ndarray, word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of natural-log probabilities of each text; texts are fed[first[i]:first[i+1]], state carried through each."""
    n = np.diff(first)
    lanes = min(SCORE_LANES, len(n))
    order = np.argsort(-n, kind="stable")
    load, queue = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    import heapq

    heap = [(0, k) for k in range(lanes)]
    for i in order.tolist():
        size, k = heapq.heappop(heap)
        queue[k].append(i)
        load[k] = size + n[i]
        heapq.heappush(heap, (int(load[k]), k))
    by_load = np.argsort(-load, kind="stable")
    load = load[by_load]
    where = [np.concatenate([np.arange(first[i], first[i + 1]) for i in queue[k]]) for k in by_load.tolist()]
    starts = np.zeros(len(fed), bool)
    starts[first[:-1][n > 0]] = True
    out = np.zeros(len(fed), np.float32)
    h = np.zeros((HIDDEN, lanes), np.float32)
    steps = 32
    for a in range(0, int(load[0]) if lanes else 0, steps):
        live = int((load > a).sum())
        grid = np.full((steps, live), -1)
        for k in range(live):
            part = where[k][a : a + steps]
            grid[: len(part), k] = part
        h = h[:, :live]
        g = model.inputs(fed[grid])
        fresh = starts[grid] & (grid >= 0)
        states = np.empty((HIDDEN, steps, live), np.float32)
        for t in range(min(steps, int(load[0]) - a)):
            if fresh[t].any():
                h = np.where(fresh[t], np.float32(0), h)
            h = model.step(next(g), h)[0]
            states[:, t] = h
        real = np.flatnonzero(grid.ravel() >= 0)
        at = grid.ravel()[real]
        out[at] = model.log_probability(np.take(states.reshape(HIDDEN, -1), real, axis=1), cls[at], word[at])
    return np.add.reduceat(np.r_[out.astype(np.float64), 0.0], first[:-1]) * (n > 0) if len(n) else np.zeros(0)


def language_model_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one per input row.

    Tokens are [^\\x20\\x09-\\x0D]+ after A-Z became a-z, then one end.  Rows whose id has a
    crc32 (as text) divisible by 10 are held out of all learning; a null id is not.  Null
    text counts as empty: one token.  base_score: smoothed unigram log10 probability, an
    unseen word counting 0.  score: the model's log10 probability, an unseen word having
    the smoothing mass of its tail class.  Repeated rows are scored and learned each.
    Ids are integers, or strings of them; others fail.
    """
    spark = df.sparkSession
    blocks = make_blocks(df, id_col, text_col)
    found, said = exchange(blocks, Emit(training_counts, _COUNT), fold_counts, bucket_count(blocks), ["body"], "words")
    vocab = vocabulary(said)
    model, _ = train(spark, blocks, vocab)
    told = spark.sparkContext.broadcast((vocab, model.values()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, values = told.value
        model = Model(vocab, values)
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            fed, cls, word, n = (np.concatenate(x) for x in zip(*(h[:4] for h in held)))
            ids = [i for h in held for i in h[4]]
            held_out, known, base, tail = (np.concatenate(x) for x in zip(*(h[5:9] for h in held)))
            neural = score_texts(model, fed, cls, word, np.r_[0, np.cumsum(n)])
            return pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(held_out), pa.array(n), pa.array(known), pa.array(np.full(len(n), vocab.tokens)), pa.array(base), pa.array(neural / np.log(10) + tail)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row["body"])
                keys, _ = counts_of(t)
                total = answers(row["answer"], np.int64)
                count = t.with_ends(total[np.searchsorted(keys[1:], t.hash) + 1], total[0])
                fed, cls, word = codes(vocab, t)
                before, _ = shifted(fed, t, int(vocab.index(np.array([END]))[0]))
                begin = t.first[:-1] + np.arange(len(t.first) - 1)
                base = np.log10((count + SMOOTH) / (vocab.tokens + SMOOTH * (vocab.distinct + 1)))
                tail = np.where(word < 0, np.log10((count + SMOOTH) / vocab.tail_mass[np.maximum(cls - HEAD_CLASSES, 0)]), 0.0)
                held.append((before, cls, word, np.diff(t.first) + 1, t.block.id_list(), t.held_out, np.add.reduceat((count > 0).astype(np.int64), begin), np.add.reduceat(base, begin), np.add.reduceat(tail, begin)))
                size += len(fed)
                if size >= SCORE_TOKENS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.join(found, "block", "left").select("body", "answer").mapInArrow(score, schema)
