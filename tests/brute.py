"""Slow, independent NumPy versions of the iterative operators, for small inputs only."""

import numpy as np


def anchored_groups(p, eps=1e-9):
    """For each distinct value its anchor, by a plain walk."""
    anchor, out = None, {}
    for v in np.unique(p):
        if anchor is None or v - anchor >= eps:
            anchor = v
        out[v] = anchor
    return out


def roc_area(y, p, eps=1e-9):
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    y, p = np.asarray(y), np.asarray(p)
    if len(y) == 0 or (y == 1).all() or (y != 1).all():
        return 0.5
    group = anchored_groups(p, eps)
    g = np.array([group[v] for v in p])
    pos, neg = g[y == 1][:, None], g[y != 1][None, :]
    return float(((pos > neg) + 0.5 * (pos == neg)).mean())


def average_precision(y, p, ids):
    order = np.lexsort((ids, -np.asarray(p)))
    hits = np.asarray(y)[order] == 1
    if not hits.any():
        return 0.0
    precision = np.cumsum(hits) / np.arange(1, len(hits) + 1)
    return float(precision[hits].mean())


def gini(y, w):
    if len(y) == 0 or w.sum() <= 0:
        return 0.0
    share = np.average(y, weights=w)
    return 1 - share**2 - (1 - share) ** 2


def tree(x, y, w, n, depth, max_depth, min_split, features):
    """Nested (feature, threshold, left, right) or a leaf probability; ``n`` are row counts."""
    rows, total = n.sum(), (n * w).sum()
    share = float((n * w * y).sum() / total) if total > 0 else 0.0
    if depth >= max_depth or rows < min_split or share <= 1e-6 or share >= 1 - 1e-6:
        return share
    here, best = gini(y, n * w), (1e-7, None, None)
    for f in features:
        values = np.unique(x[:, f])
        for t in values[:: max(len(values) // 15, 1)]:
            low = x[:, f] <= t
            if low.all():
                continue
            inside = n[low].sum() / rows
            gain = here - inside * gini(y[low], (n * w)[low]) - (1 - inside) * gini(y[~low], (n * w)[~low])
            if round(gain, 12) > best[0]:
                best = (round(gain, 12), f, t)
    if best[1] is None:
        return share
    low = x[:, best[1]] <= best[2]
    below = tree(x[low], y[low], w[low], n[low], depth + 1, max_depth, min_split, features)
    above = tree(x[~low], y[~low], w[~low], n[~low], depth + 1, max_depth, min_split, features)
    return (best[1], float(best[2]), below, above)


def predict(node, row):
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


def boosted(x, y, rounds, rate, max_depth, min_split):
    base = np.log(max(y.sum(), 1) / max((1 - y).sum(), 1))
    score, trees = np.full(len(y), base), []
    for _ in range(rounds):
        w = np.maximum(np.abs(y - 1 / (1 + np.exp(-score))), 0.01)
        trees.append(tree(x, y, w, np.ones(len(y)), 0, max_depth, min_split, range(x.shape[1])))
        score = score + rate * 2 * (np.array([predict(trees[-1], r) for r in x]) - 0.5)
    return trees, 1 / (1 + np.exp(-score))


def logistic(x, y, rate, epochs, l2):
    mean, sd = x.mean(0), x.std(0)
    sd = np.where(sd < 1e-7, 1.0, sd)
    z = (x - mean) / sd
    pos = max(y.sum(), 1)
    neg = max(len(y) - pos, 1)
    cw = np.where(y == 1, len(y) / (2 * pos), len(y) / (2 * neg))
    w, b = np.zeros(x.shape[1]), np.log(pos / neg)
    for e in range(epochs):
        err = cw * (1 / (1 + np.exp(-(z @ w + b))) - y)
        step = rate / (1 + 0.01 * e)
        w, b = w - step * (z.T @ err / len(y) + l2 * w), b - step * err.mean()
    return w, b
