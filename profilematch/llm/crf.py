"""A linear-chain conditional random field with two states, over many sequences at once.

All sequences of a batch lie one after another in one chain; the first token of each doesn't depend on the token
before it, which cuts the chain there. Forward and backward passes run over a grid: the chain is cut into equal pieces,
all pieces step together, and products of 2 x 2 matrices join them exactly. No loop runs per token or sequence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LIMIT = 30.0


@dataclass
class Weights:
    features: np.ndarray  # one number per feature: how much it speaks for state 1
    moves: np.ndarray  # 2 x 2
    start: np.ndarray  # 2


def emissions(w: Weights, active: np.ndarray) -> np.ndarray:
    """Sum of the weights of each token's features; ``active`` has a row of feature numbers for each token."""
    total = np.zeros(len(active))
    for k in range(active.shape[1]):
        total += w.features[active[:, k]]
    return np.clip(total, -LIMIT, LIMIT)


def _grid(x: np.ndarray, steps: int, fill: float) -> np.ndarray:
    return np.concatenate([x, np.full(-len(x) % steps, fill)]).reshape(-1, steps).T.copy()


def marginals(w: Weights, emission: np.ndarray, first: np.ndarray, pairs: bool = False):
    """P(state 1) of each token, and with ``pairs`` the summed probabilities of each pair of neighbouring states."""
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    up, moves, start = np.exp(emission), np.exp(w.moves), np.exp(w.start)
    steps = max(1, int(np.sqrt(n)))
    m00 = _grid(np.where(first, start[0], moves[0, 0]), steps, 1.0)
    m01 = _grid(np.where(first, start[1], moves[0, 1]) * up, steps, 0.0)
    m10 = _grid(np.where(first, start[0], moves[1, 0]), steps, 0.0)
    m11 = _grid(np.where(first, start[1], moves[1, 1]) * up, steps, 1.0)
    pieces = m00.shape[1]
    p00, p01, p10, p11 = np.ones(pieces), np.zeros(pieces), np.zeros(pieces), np.ones(pieces)
    for c in range(steps):
        p00, p01 = p00 * m00[c] + p01 * m10[c], p00 * m01[c] + p01 * m11[c]
        p10, p11 = p10 * m00[c] + p11 * m10[c], p10 * m01[c] + p11 * m11[c]
        z = p00 + p01 + p10 + p11
        p00, p01, p10, p11 = p00 / z, p01 / z, p10 / z, p11 / z
    ahead, back = np.empty((pieces, 2)), np.empty((pieces, 2))
    a, b = (0.5, 0.5), (0.5, 0.5)
    for k in range(pieces):
        ahead[k] = a
        x, y = a[0] * p00[k] + a[1] * p10[k], a[0] * p01[k] + a[1] * p11[k]
        a = (x / (x + y), y / (x + y))
    for k in range(pieces - 1, -1, -1):
        back[k] = b
        x, y = p00[k] * b[0] + p01[k] * b[1], p10[k] * b[0] + p11[k] * b[1]
        b = (x / (x + y), y / (x + y))
    a0, a1 = ahead.T.copy()
    f0, f1 = np.empty((steps, pieces)), np.empty((steps, pieces))
    for c in range(steps):
        a0, a1 = a0 * m00[c] + a1 * m10[c], a0 * m01[c] + a1 * m11[c]
        z = a0 + a1
        a0, a1 = a0 / z, a1 / z
        f0[c], f1[c] = a0, a1
    b0, b1 = back.T.copy()
    g0, g1 = np.empty((steps, pieces)), np.empty((steps, pieces))
    for c in range(steps - 1, -1, -1):
        g0[c], g1[c] = b0, b1
        b0, b1 = m00[c] * b0 + m01[c] * b1, m10[c] * b0 + m11[c] * b1
        z = b0 + b1
        b0, b1 = b0 / z, b1 / z
    flat = lambda x: x.T.ravel()[:n]
    f0, f1, g0, g1 = flat(f0), flat(f1), flat(g0), flat(g1)
    one = f1 * g1 / (f0 * g0 + f1 * g1)
    both = np.zeros((2, 2))
    if pairs and n > 1:
        inner = ~first[1:]
        t = [
            [f0[:-1] * moves[0, 0] * g0[1:], f0[:-1] * moves[0, 1] * up[1:] * g1[1:]],
            [f1[:-1] * moves[1, 0] * g0[1:], f1[:-1] * moves[1, 1] * up[1:] * g1[1:]],
        ]
        z = t[0][0] + t[0][1] + t[1][0] + t[1][1]
        both = np.array([[(t[i][j] / z)[inner].sum() for j in (0, 1)] for i in (0, 1)])
    return one, both


def train(active, state, first, n_features: int, rounds: int = 60, variance: float = 1.0, limit: float = 1.0) -> Weights:
    """Maximum a posteriori weights (normal prior of ``variance``) by damped Newton steps on the diagonal.

    A step is the gradient over the expected curvature, shared by the features that are active together, and at most
    ``limit``. Rare features stay near 0, since their curvature is less than the prior's.
    """
    state = state.astype(float)
    w = Weights(np.zeros(n_features), np.zeros((2, 2)), np.zeros(2))
    inner = ~first[1:]
    together = active.shape[1] + 1
    seen = np.array([[((state[:-1] == i) & (state[1:] == j) & inner).sum() for j in (0, 1)] for i in (0, 1)], float)
    begin = np.array([(state[first] == 0).sum(), (state[first] == 1).sum()], float)

    def moved(x, gradient, curvature):
        return x + np.clip((gradient - x / variance) / (together * curvature + 1 / variance), -limit, limit)

    for _ in range(rounds):
        one, both = marginals(w, emissions(w, active), first, pairs=True)
        miss, spread = state - one, one * (1 - one)
        gradient, curvature = np.zeros(n_features), np.zeros(n_features)
        for column in range(active.shape[1]):
            gradient += np.bincount(active[:, column], miss, n_features)
            curvature += np.bincount(active[:, column], spread, n_features)
        own = np.array([first.sum() - one[first].sum(), one[first].sum()])
        w = Weights(
            moved(w.features, gradient, curvature),
            moved(w.moves, seen - both, both * (1 - both / max(1, both.sum()))),
            moved(w.start, begin - own, own * (1 - own / max(1, own.sum()))),
        )
    return w


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -LIMIT, LIMIT)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -LIMIT, LIMIT)))
