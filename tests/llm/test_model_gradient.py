"""Training of the language model: the gradient of a window is that of its loss."""

import numpy as np

from tellake.llm import language_model as lm


def test_window_follows_the_loss():
    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(1, 1000, lm.HEAD))[::-1].astype(float)
    mass = rng.random(lm.TAIL) * 500 + 1
    vocab = lm.Vocabulary(np.arange(1, lm.HEAD + 1, dtype=np.uint64), counts, mass, np.r_[counts.reshape(-1, lm.PER_CLASS).sum(axis=1), mass], 1000, lm.HEAD)
    steps, lanes = 5, 48
    fed = rng.integers(0, lm.HEAD + lm.TAIL, (steps, lanes))
    said = rng.integers(0, lm.HEAD + lm.TAIL, (steps, lanes))
    cls, word = np.where(said < lm.HEAD, said // lm.PER_CLASS, lm.HEAD_CLASSES + said - lm.HEAD), np.where(said < lm.HEAD, said, -1)
    fresh = rng.random((steps, lanes)) < 0.2
    start = rng.normal(0, 0.3, (lm.HIDDEN, lanes)).astype(np.float32)

    def loss(values):
        model, h, total = lm.Model(vocab, values), start, 0.0
        for t, g in enumerate(model.inputs(fed)):
            h = model.step(g, np.where(fresh[t], np.float32(0), h))[0]
            total -= float(model.log_probability(h, cls[t], word[t]).astype(float).sum())
        return total / lanes

    values = lm.Model(vocab).values()
    own = lm.Trainer(lm.Model(vocab, values))
    own.window(start, fed, fresh, cls, word)
    for k, before in enumerate(values):
        size = np.sqrt(np.maximum(own.seen[k] - np.float32(1e-3), 0))
        for at in np.argsort(-size.ravel())[:4]:
            place = np.unravel_index(at, before.shape)
            ends = []
            for e in (0.02, -0.02):
                moved = [v.copy() for v in values]
                moved[k][place] += e
                ends.append(loss(moved))
            slope = (ends[0] - ends[1]) / 0.04
            assert abs(abs(slope) - size[place]) < 0.03 * abs(slope) + 0.003 and (own.m.values()[k] - before)[place] * slope < 0, (lm.Model.names[k], place, slope, size[place])
