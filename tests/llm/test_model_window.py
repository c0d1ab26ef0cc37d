"""One window of the language model against the plain formulas."""

import numpy as np

from areaweave.llm import language_model


def test_window_equals_the_plain_formulas():
    rng, classes = np.random.default_rng(3), 30
    network = language_model.Network.start(np.log(np.full(classes, 1 / classes)))
    for a in network.w.values():
        a += rng.standard_normal(a.shape).astype(np.float32) * (np.abs(a) < 1e8)
    w = {k: a.astype(float) for k, a in network.w.items()}
    h = language_model.HIDDEN
    before, target = rng.integers(0, classes, (5, 7)), rng.integers(0, classes, (5, 7))
    state = rng.standard_normal((7, h))
    got, last, _ = network.window(state.astype(np.float32), before, target, np.ones((5, 7), bool))
    k = w["b"].shape[1]
    for t in range(5):
        gate, rec = w["x"][before[t]], state @ w["u"]
        z, r = (1 / (1 + np.exp(-(gate[:, i * h:(i + 1) * h] + rec[:, i * h:(i + 1) * h]))) for i in (0, 1))
        new = np.tanh(gate[:, 2 * h:] + r * rec[:, 2 * h:])
        state = new + z * (state - new)
        for i, goal in enumerate(target[t]):
            p, q = state[i] @ w["g"] + w["a"], w["v"][goal // k] @ state[i] + w["b"][goal // k]
            plain = p[goal // k] - np.logaddexp.reduce(p) + q[goal % k] - np.logaddexp.reduce(q)
            assert abs(got[t, i] - plain) < 1e-3
    assert np.allclose(last, state, atol=1e-3)
