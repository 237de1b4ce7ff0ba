"""Gradient-boosted trees in numpy: fitted on a bounded sample, scored as flat arrays."""

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees as node arrays of shape (trees, nodes).

    Node i has the children 2i+1 and 2i+2; the last level are leaves. A node that was not
    split sends everything left: its threshold is infinite.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - len(feature)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x, y, trees=60, depth=3, rate=0.2, bins=64, least=10, penalty=1.0, monotone=None) -> Trees:
    """Boosts logistic loss on binned features.

    ``monotone[f]`` is 1, -1 or 0: whether the score may only rise, only fall, or do either
    as feature f grows. A split that breaks the order of its children is not made, and
    children are held to their side of the midpoint, so the order holds for whole subtrees.
    """
    x, y = np.asarray(x, float), np.asarray(y, float)
    n, width = x.shape
    monotone = np.zeros(width) if monotone is None else np.asarray(monotone)
    inner, leaves = 2**depth - 1, 2**depth
    share = np.clip(y.mean() if n else 0.5, 0.01, 0.99)
    model = Trees(
        np.zeros((trees, inner), np.int64),
        np.full((trees, inner), np.inf),
        np.zeros((trees, leaves)),
        float(np.log(share / (1 - share))),
        depth,
    )
    if not n:
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], 1)
    margin = np.full(n, model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)

        def best(sg, sh, node):
            return np.clip(-sg / (sh + penalty), low[node], high[node])

        def gain(sg, sh, w):
            return -(sg * w + 0.5 * (sh + penalty) * w * w)

        for node in range(inner):
            rows = np.flatnonzero(at == node)
            sg, sh = g[rows].sum(), h[rows].sum()
            found = (1e-9, None)
            for f in range(width):
                if not len(cuts[f]) or len(rows) < 2 * least:
                    continue
                size = len(cuts[f]) + 1
                b = binned[rows, f]
                lg = np.cumsum(np.bincount(b, g[rows], size))[:-1]
                lh = np.cumsum(np.bincount(b, h[rows], size))[:-1]
                ln = np.cumsum(np.bincount(b, minlength=size))[:-1]
                wl, wr = best(lg, lh, node), best(sg - lg, sh - lh, node)
                won = gain(lg, lh, wl) + gain(sg - lg, sh - lh, wr) - gain(sg, sh, best(sg, sh, node))
                won[(ln < least) | (len(rows) - ln < least) | (monotone[f] * (wr - wl) < 0)] = -np.inf
                k = int(np.argmax(won))
                if won[k] > found[0]:
                    found = (won[k], f, k, wl[k], wr[k])
            left, right = 2 * node + 1, 2 * node + 2
            low[[left, right]], high[[left, right]] = low[node], high[node]
            if found[1] is None:
                at[rows] = left
                continue
            _, f, k, wl, wr = found
            model.feature[t, node], model.threshold[t, node] = f, cuts[f][k]
            if monotone[f]:
                middle = (wl + wr) / 2
                (high if monotone[f] > 0 else low)[left] = middle
                (low if monotone[f] > 0 else high)[right] = middle
            at[rows] = np.where(binned[rows, f] > k, right, left)
        leaf = at - inner
        sg, sh = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        model.value[t] = rate * best(sg, sh, np.arange(inner, inner + leaves))
        margin += model.value[t][leaf]
    return model
