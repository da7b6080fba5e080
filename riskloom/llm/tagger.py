"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

import numpy as np

from riskloom.llm.sampling import Adam, batches

STEPS = 250
SYMBOLS = 131  # ASCII, then: other letters, other characters, padding
PAD = 130


def symbols(text):
    """Small integers for the characters: ASCII as it is, the rest as letter or as other."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(points) or points.max() < 128:
        return points.astype(np.int64)
    wide = np.array([128 if c.isalpha() else 129 for c in text], np.int64)
    return np.where(points < 128, points, wide)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Scores of ``tags`` for every character of equally long windows."""

    def __init__(self, tags, hidden=24, seed=11, weights=None):
        self.tags, self.hidden = tags, hidden
        draw = np.random.default_rng(seed)
        h = hidden
        shapes = {"table_f": (SYMBOLS, 4 * h), "state_f": (h, 4 * h), "table_b": (SYMBOLS, 4 * h),
                  "state_b": (h, 4 * h), "out": (2 * h, tags), "bias": (tags,), "step": (tags, tags)}
        self.w = weights or {
            name: (draw.standard_normal(shape) * (0.25 if name[:5] in ("table", "state") else 0.1)
                   ).astype(np.float32) for name, shape in shapes.items()}
        if weights is None:
            for name in ("table_f", "table_b"):
                self.w[name][:, h:2 * h] += 1.0  # forget gates start open

    # One direction; x has (windows, characters).
    def _run(self, x, name, keep=None):
        h = self.hidden
        table, state = self.w[f"table_{name}"], self.w[f"state_{name}"]
        n, length = x.shape
        out = np.empty((length, n, h), np.float32)
        hid = np.zeros((n, h), np.float32)
        cell = np.zeros((n, h), np.float32)
        order = range(length) if name == "f" else range(length - 1, -1, -1)
        for t in order:
            pre = table[x[:, t]] + hid @ state
            gates = _sigmoid(pre[:, :3 * h])
            fresh = np.tanh(pre[:, 3 * h:])
            before = cell
            cell = gates[:, h:2 * h] * before + gates[:, :h] * fresh
            bent = np.tanh(cell)
            if keep is not None:
                keep.append((t, hid, gates, fresh, before, bent))
            hid = gates[:, 2 * h:] * bent
            out[t] = hid
        return out

    def emissions(self, x):
        """(characters, windows, tags)."""
        both = np.concatenate([self._run(x, "f"), self._run(x, "b")], axis=2)
        return both @ self.w["out"] + self.w["bias"]

    def decode(self, x):
        """Best tag sequence of each window (Viterbi)."""
        scores = self.emissions(x)
        length, n, k = scores.shape
        back = np.empty((length, n, k), np.int8)
        best = scores[0]
        for t in range(1, length):
            paths = best[:, :, None] + self.w["step"]
            back[t] = paths.argmax(1)
            best = paths.max(1) + scores[t]
        tags = np.empty((n, length), np.int8)
        tags[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[t, rows, tags[:, t]]
        return tags

    def gradients(self, x, y):
        """(loss, gradient of every weight) for windows x with tags y."""
        h, k = self.hidden, self.tags
        n, length = x.shape
        kept = {"f": [], "b": []}
        both = np.concatenate([self._run(x, d, kept[d]) for d in "fb"], axis=2)
        scores, step = both @ self.w["out"] + self.w["bias"], self.w["step"]
        ahead = np.empty((length, n, k), np.float32)
        behind = np.zeros((length, n, k), np.float32)
        ahead[0] = scores[0]
        for t in range(1, length):
            ahead[t] = scores[t] + _log_sum(ahead[t - 1][:, :, None] + step, 1)
        for t in range(length - 2, -1, -1):
            behind[t] = _log_sum(step + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = _log_sum(ahead[-1], 1)
        d_scores = np.exp(ahead + behind - total[:, None])
        pairs = np.exp(ahead[:-1, :, :, None] + step + (scores[1:] + behind[1:])[:, :, None, :]
                       - total[:, None, None])
        d_step = pairs.sum((0, 1))
        rows = np.arange(n)
        gold = sum(scores[t, rows, y[:, t]] for t in range(length))
        gold = gold + sum(step[y[:, t], y[:, t + 1]] for t in range(length - 1))
        for t in range(length):
            d_scores[t, rows, y[:, t]] -= 1
        np.subtract.at(d_step, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        d_scores /= n
        grads = {"step": d_step / n, "bias": d_scores.sum((0, 1)),
                 "out": np.einsum("tni,tnj->ij", both, d_scores)}
        d_both = d_scores @ self.w["out"].T
        one_hot = np.eye(SYMBOLS, dtype=np.float32)[x]
        for side, d in enumerate("fb"):
            d_out = d_both[:, :, side * h:(side + 1) * h]
            state = self.w[f"state_{d}"]
            d_state = np.zeros_like(state)
            d_pre = np.empty((n, length, 4 * h), np.float32)
            d_hid = np.zeros((n, h), np.float32)
            d_cell = np.zeros((n, h), np.float32)
            for t, hid, gates, fresh, before, bent in reversed(kept[d]):
                d_hid = d_hid + d_out[t]
                d_cell = d_cell + d_hid * gates[:, 2 * h:] * (1 - bent ** 2)
                d_gates = np.concatenate([d_cell * fresh, d_cell * before, d_hid * bent], axis=1)
                pre = np.concatenate([d_gates * gates * (1 - gates),
                                      d_cell * gates[:, :h] * (1 - fresh ** 2)], axis=1)
                d_pre[:, t] = pre
                d_state += hid.T @ pre
                d_hid = pre @ state.T
                d_cell = d_cell * gates[:, h:2 * h]
            grads[f"state_{d}"] = d_state
            grads[f"table_{d}"] = one_hot.reshape(-1, SYMBOLS).T @ d_pre.reshape(-1, 4 * h)
        return float((total - gold).mean()), grads

    def fit(self, x, y, steps=STEPS, batch=64, rate=0.01, seed=5):
        """Adam over shuffled batches with clipped gradients and a falling rate."""
        adam = Adam(self.w, rate)
        for rows, done in batches(np.random.default_rng(seed), np.arange(len(x)), batch, steps):
            _, grads = self.gradients(x[rows], y[rows])
            size = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
            adam.step({n: g * min(1.0, 5.0 / max(size, 1e-9)) for n, g in grads.items()}, 1 - 0.9 * done)
        return self
