"""Batched toxicity scores against a plain forward pass, one window and one token at a time."""

import math
import random

import numpy as np

from tripstar.llm import toxicity


def logistic(x):
    return 1.0 / (1.0 + np.exp(-x))


def plain_logit(p, tokens):
    """Worst window of a text: a loop over windows, tokens and directions."""
    if not tokens:
        return float(p["bo"][0])
    H = toxicity.HIDDEN
    worst = -math.inf
    for start in toxicity.window_starts(len(tokens)):
        window = tokens[start:start + toxicity.WINDOW]
        inputs = [toxicity.Features([t]).inputs(p)[0].astype(np.float64) for t in window]
        states = np.zeros((len(window), 2 * H))
        for direction, order in ((0, range(len(window))), (1, range(len(window) - 1, -1, -1))):
            w, b, u = (p[k][direction].astype(np.float64) for k in ("w", "b", "u"))
            h = np.zeros(H)
            for t in order:
                x, hu = (inputs[t] @ w + b).ravel(), h @ u
                z, r = logistic(x[:H] + hu[:H]), logistic(x[H:2 * H] + hu[H:2 * H])
                n = np.tanh(x[2 * H:] + r * hu[2 * H:])
                h = n + z * (h - n)
                states[t, direction * H:(direction + 1) * H] = h
        e = np.array([np.tanh(s @ p["wa"] + p["ba"]) @ p["va"] for s in states])
        weight = np.exp(e - e.max())
        pooled = (weight / weight.sum()) @ states
        worst = max(worst, float(pooled @ p["wo"] + p["bo"][0]))
    return worst


def test_scores_equal_a_plain_forward_pass():
    rng = random.Random(8)
    vocabulary = ["good", "bad", "ÜGLY", "né", "x1", "!", "of", "the", "awful", "kind"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    labels = np.array([float("awful" in t) for t in texts])
    model = toxicity.train(texts, labels, rounds=1)
    lengths = [0, 1, 2, toxicity.WINDOW - 1, toxicity.WINDOW, toxicity.WINDOW + 1, 3 * toxicity.WINDOW + 5]
    some = [None, "", " \n"] + [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in lengths]
    got = toxicity.Scorer(model).texts(iter(some))
    expected = [plain_logit(model.p, toxicity.tokens_of(t)) for t in some]
    assert np.allclose(got, expected, atol=2e-3), np.abs(got - np.array(expected)).max()
    a, b = model.line
    assert np.allclose(model.probability(got), [1 / (1 + math.exp(-max(-40, min(40, a * x + b)))) for x in expected], atol=2e-3)
