"""Language model: every training token is trained on once, and scores are those of a plain forward pass."""

import math

import numpy as np

from tellake.llm import language_model as lm
from tellake.llm.blocks import make_blocks


def plain_score(vocab, model, t, counts):
    """log10 probability of a text's tokens, one at a time: state, class softmax, word softmax or smoothed share."""
    end = int(vocab.index(np.array([lm.END]))[0])
    h, fed, total = np.zeros(lm.HIDDEN), end, 0.0
    for word, tail in [*zip(t.hash, t.tail), (lm.END, None)]:
        g, u = model.G[fed].astype(float), h @ model.R
        n = lm.HIDDEN
        z, r = (1 / (1 + np.exp(-(g[k : k + n] + u[k : k + n]))) for k in (0, n))
        new = np.tanh(g[2 * n :] + r * u[2 * n :])
        h = new + z * (h - new)
        head = int(vocab.index(np.array([word], np.uint64))[0])
        cls = head // lm.PER_CLASS if head >= 0 else lm.HEAD_CLASSES + int(tail)
        x = h @ model.C + model.c
        total += (x[cls] - math.log(np.exp(x).sum())) / math.log(10)
        if head >= 0:
            rows = slice(cls * lm.PER_CLASS, (cls + 1) * lm.PER_CLASS)
            y = model.W[rows] @ h + model.w[rows]
            total += (y[head - cls * lm.PER_CLASS] - math.log(np.exp(y).sum())) / math.log(10)
        else:
            total += math.log10((counts.get(int(word), 0) + lm.SMOOTH) / vocab.tail_mass[int(tail)])
        fed = head if head >= 0 else lm.HEAD + int(tail)
    return total


def test_all_training_tokens_and_plain_scores(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").filter("length(text) < 3000").orderBy("doc_id").limit(60)
    kept = {}
    train = lm.train
    monkeypatch.setattr(lm, "train", lambda spark, blocks, vocab: kept.setdefault("out", (train(spark, blocks, vocab), vocab))[0])
    out = {r.doc_id: r for r in lm.language_model_scores(docs).collect()}
    (model, tokens), vocab = kept["out"]
    assert {r.train_tokens for r in out.values()} == {tokens}
    assert tokens == sum(r.n_tokens for r in out.values() if not r.held_out)
    blocks = make_blocks(docs, "doc_id", "text")
    bodies = [r.body for r in blocks.collect()]
    counts = {}
    for body in bodies:
        for k, n in zip(*lm.training_counts(body)):
            counts[int(k)] = counts.get(int(k), 0) + int(n["n"])
    for r in docs.limit(12).collect():
        one = make_blocks(docs.filter(f"doc_id = {r.doc_id}"), "doc_id", "text").first()
        want = plain_score(vocab, model, lm.Tokens(one.body), counts)
        assert abs(out[r.doc_id].score - want) < 1e-3 * abs(want), (r.doc_id, out[r.doc_id].score, want)


def test_longer_training_beats_counts(spark):
    out = lm.language_model_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").selectExpr("sum(score) a", "sum(base_score) b").first()
    assert out.a > 0.97 * out.b


def test_exchange_rows_grow_with_the_input():
    """Blocks times buckets, the rows of an exchange, stay in proportion to the input from the knee on."""
    from tellake.llm.blocks import KNEE, exchange_sizes

    each = []
    for total in (KNEE, 32 * KNEE, 3200 * KNEE):
        block, bucket = exchange_sizes(total)
        each.append((total / block) * (total / bucket) / total)
    assert max(each) < 1.01 * min(each)
