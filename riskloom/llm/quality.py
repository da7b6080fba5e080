"""Quality of whole texts by a byte-level convolutional network, in numpy.

A text is cut into overlapping chunks that cover all of it. Filters over byte embeddings slide
along every chunk and are max-pooled there. The chunk vectors are combined by their mean and their
range (a text that repeats itself has chunks alike), and a small layer gives one probability.
The network learns from every labelled text; texts are the only input.
"""

import numpy as np
import pyarrow as pa

from riskloom.llm.blocks import flat, ragged, running, with_text_columns
from riskloom.llm.rounds import Rows

CHUNK, STEP = 256, 192
WIDTH, HOP = 8, 2
EMBEDDING, FILTERS, HIDDEN = 4, 16, 16
PAD = 256
BATCH, RATE = 48, 0.01
#: Chunks of a batch that are filtered at once.
BATCH_CHUNKS = 2_048
_GROUP = 64


def chunk_ranges(edges):
    """(owner text, first byte, end) of every chunk; an empty text has one empty chunk."""
    lengths = np.diff(edges)
    counts = np.maximum(1, -(-(lengths - (CHUNK - STEP)) // STEP))
    owner = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = edges[owner] + number * STEP
    return owner, start, np.minimum(start + CHUNK, edges[owner + 1])


def chunk_bytes(data, start, end):
    """The chunks as rows of byte values, padded with ``PAD``."""
    at = start[:, None] + np.arange(CHUNK)
    inside = at < end[:, None]
    if not len(data):
        return np.full(at.shape, PAD, np.int16)
    return np.where(inside, data[np.minimum(at, len(data) - 1)], PAD).astype(np.int16)


class Network:
    def __init__(self, weights=None, seed=7):
        draw = np.random.default_rng(seed)
        shapes = {"bytes": (PAD + 1, EMBEDDING), "filters": (WIDTH * EMBEDDING, FILTERS),
                  "bias": (FILTERS,), "hidden": (2 * FILTERS + 1, HIDDEN), "hidden_bias": (HIDDEN,),
                  "out": (HIDDEN,), "out_bias": (1,)}
        scale = {"bytes": 0.5, "filters": 0.3, "hidden": 0.3, "out": 0.3}
        self.w = weights or {n: (draw.standard_normal(s) * scale.get(n, 0)).astype(np.float32)
                             for n, s in shapes.items()}

    def _windows(self, rows):
        """(chunks, places, width x embedding) of rows of byte values."""
        embedded = self.w["bytes"][rows]
        n, places = len(rows), (CHUNK - WIDTH) // HOP + 1
        a, b, c = embedded.strides
        view = np.lib.stride_tricks.as_strided(
            embedded, (n, places, WIDTH * EMBEDDING), (a, HOP * b, c))
        return view.reshape(n * places, WIDTH * EMBEDDING), places

    def pool(self, rows, where=False):
        """Max-pooled filters of each chunk, and with ``where`` the places of the maxima."""
        out = np.empty((len(rows), FILTERS), np.float32)
        best = np.empty((len(rows), FILTERS), np.int64) if where else None
        for a in range(0, len(rows), _GROUP):
            windows, places = self._windows(rows[a:a + _GROUP])
            values = (windows @ self.w["filters"]).reshape(-1, places, FILTERS)
            if where:
                best[a:a + _GROUP] = values.argmax(1)
            out[a:a + _GROUP] = values.max(1)
        return (out, best) if where else out

    def combine(self, pooled, owner, sizes, keep=None):
        """Log odds of texts, from their chunks (in the order of ``owner``) and sizes in bytes."""
        acts = np.tanh(pooled + self.w["bias"])
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        counts = np.diff(np.r_[first, len(owner)])[:, None].astype(np.float32)
        mean = np.add.reduceat(acts, first, axis=0) / counts
        high = np.maximum.reduceat(acts, first, axis=0)
        low = np.minimum.reduceat(acts, first, axis=0)
        size = (np.log1p(sizes)[:, None] / 4 - 1.5).astype(np.float32)
        features = np.concatenate([mean, high - low, size], axis=1)
        hidden = np.tanh(features @ self.w["hidden"] + self.w["hidden_bias"])
        if keep is not None:
            keep.update(acts=acts, counts=counts, high=high, low=low, features=features, hidden=hidden)
        return hidden @ self.w["out"] + self.w["out_bias"][0]

    def scores(self, texts):
        """Probability of each text of an Arrow column."""
        if not len(texts):
            return np.zeros(0)
        data, edges = flat(texts)
        owner, start, end = chunk_ranges(edges)
        pooled = np.empty((len(owner), FILTERS), np.float32)
        for a in range(0, len(owner), 2048):
            part = slice(a, a + 2048)
            pooled[part] = self.pool(chunk_bytes(data, start[part], end[part]))
        z = self.combine(pooled, owner, np.diff(edges)).astype(float)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def gradients(self, rows, owner, sizes, y, weight):
        """Gradients of the weighted mean log loss over texts whose chunks are ``rows``."""
        pooled, best = self.pool(rows, where=True)
        k = {}
        z = self.combine(pooled, owner, sizes, k)
        d_z = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight / weight.sum()).astype(np.float32)
        grads = {"out": k["hidden"].T @ d_z, "out_bias": d_z.sum(keepdims=True)}
        d_hidden = d_z[:, None] * self.w["out"] * (1 - k["hidden"] ** 2)
        grads["hidden"] = k["features"].T @ d_hidden
        grads["hidden_bias"] = d_hidden.sum(0)
        d_features = d_hidden @ self.w["hidden"].T
        d_mean, d_range = d_features[:, :FILTERS], d_features[:, FILTERS:2 * FILTERS]
        d_acts = (d_mean / k["counts"])[owner]
        d_acts = d_acts + d_range[owner] * (
            (k["acts"] == k["high"][owner]).astype(np.float32) - (k["acts"] == k["low"][owner]))
        d_pooled = d_acts * (1 - k["acts"] ** 2)
        grads["bias"] = d_pooled.sum(0)
        # Only the window of each maximum has a gradient.
        at = best[:, :, None] * HOP + np.arange(WIDTH)
        values = rows[np.arange(len(rows))[:, None, None], at]
        seen = self.w["bytes"][values].reshape(len(rows), FILTERS, -1)
        grads["filters"] = np.einsum("cfk,cf->kf", seen, d_pooled)
        d_seen = d_pooled[:, :, None] * self.w["filters"].T[None]
        d_bytes = np.zeros_like(self.w["bytes"])
        flat_values, flat_grads = values.ravel(), d_seen.reshape(-1, EMBEDDING)
        for e in range(EMBEDDING):
            d_bytes[:, e] = np.bincount(flat_values, flat_grads[:, e], minlength=PAD + 1)
        grads["bytes"] = d_bytes
        return grads


def prepared(texts):
    """(the bytes of the texts, zeros): the form in which the fit keeps them."""
    return texts.cast(pa.binary()), np.zeros(len(texts), np.int32)


def _gradients(weights):
    """For ``Rows.fit``."""
    network = Network(weights)

    def block(data, edges):
        owner, start, end = chunk_ranges(edges)
        first, sizes = np.searchsorted(owner, np.arange(len(edges))), np.diff(edges)

        def step(picked, y):
            counts, total = first[picked + 1] - first[picked], {}
            # Long texts are filtered a few at a time; the step is that of the whole batch.
            piece = running(counts)[:-1] // BATCH_CHUNKS
            for number in np.unique(piece):
                mine = np.flatnonzero(piece == number)
                chunks = ragged(first[picked[mine]], counts[mine])
                rows = chunk_bytes(data, start[chunks], end[chunks])
                names = np.repeat(np.arange(len(mine)), counts[mine])
                grads = network.gradients(rows, names, sizes[picked[mine]], y[mine], np.ones(len(mine)))
                for name, g in grads.items():
                    total[name] = total.get(name, 0) + g * np.float32(len(mine) / len(picked))
            return total

        return step

    return block


def train(docs, labels, rows, label="quality"):
    """Weights learnt from the texts of all label rows that the condition ``rows`` allows; {} if there
    are none."""
    with Rows(docs, labels, label, rows, prepared) as table:
        return table.fit(Network().w, _gradients, BATCH, RATE, seed=1) if len(table) else {}


def score(df, weights, text="text", column="score", drop=()):
    """``df`` with a probability in [0, 1] of good quality.

    A null text is scored as the empty text, which has one empty chunk; untrained weights score
    0.5. A column with the name of the score is replaced.
    """
    def start():
        network = Network(weights) if weights else None
        return lambda texts: [network.scores(texts) if network else np.full(len(texts), 0.5)]

    return with_text_columns(df, f"`{column}` double", start, text, drop)
