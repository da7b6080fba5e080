"""Toxicity of whole texts by a convolutional network over words, in numpy.

Words are hashed into rows of an embedding table, each with a second row for its first bytes, which
related words share; the vector of a word is the sum of both. Filters of several widths slide over the
words and are max-pooled over the whole text; a logistic layer gives log odds. The network learns from
every labelled text, both classes weighing the same in all, except for the fifth of the rows on which a
threshold is calibrated for each language, which is told from the text's own function words; the score
is shifted so that 0.5 is the threshold. Texts are the only input.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.llm.blocks import flat, running, with_text_columns
from riskloom.llm.licenses import word_table
from riskloom.llm.rounds import Rows, every_block

BITS, PREFIX = 16, 4
ROWS = 1 << BITS  # row ROWS is the empty word: padding and words too rare to learn
EMBEDDING, WIDTHS, FILTERS = 8, (1, 2, 3), 8
#: Words in fewer training texts share the empty row.
RARE = 4
BATCH, RATE, CALIBRATION = 32, 0.01, 5
#: Words of a batch that are embedded at once.
BATCH_WORDS = 100_000
#: Log odds are counted in cells of this width for the thresholds.
CELL = 1 / 256

#: Function words by language; other texts count as the first.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as his they be at this from",
    "de": "der die und das ist nicht den von zu mit sich auf für im ein eine dem des auch",
    "fr": "le la les et des du une est dans que qui pour pas au sur elle par ne un",
    "es": "el los las que y del se una por con para es su al lo como más pero sus",
}
_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.frombuffer(word_table(), np.uint8)


def hashed_words(data, edges):
    """(table rows of every word and of its prefix, edges of the texts in words).

    Words as in the licence scan.
    """
    clean = _TABLE[data]
    letter = clean != 32
    # A text's first byte starts a word even behind a text that ends in one.
    cut = np.zeros(len(clean) + 1, bool)
    cut[edges] = True
    before = np.r_[False, letter[:-1]]
    starts = np.flatnonzero(letter & (~before | cut[:-1]))
    firsts = running(np.bincount(np.searchsorted(edges, starts, side="right") - 1,
                                 minlength=len(edges) - 1))
    if not len(starts):
        return np.zeros((0, 2), np.int64), firsts
    word = np.cumsum(np.bincount(starts, minlength=len(clean))) - 1
    offset = np.arange(len(clean)) - starts[np.maximum(word, 0)]
    longest = int(offset[letter].max()) + 1
    powers = np.multiply.accumulate(np.full(longest, _PRIME, np.uint64))
    values = np.where(letter, (clean.astype(np.uint64) + np.uint64(1))
                      * powers[np.clip(offset, 0, longest - 1)], np.uint64(0))
    whole = np.add.reduceat(values, starts)
    values[offset >= PREFIX] = 0
    head = np.add.reduceat(values, starts) ^ _MIX
    rows = np.stack([whole, head], axis=1)
    rows ^= rows >> np.uint64(31)
    return ((rows * _MIX) >> np.uint64(64 - BITS)).astype(np.int64), firsts


def _function_rows():
    rows = np.full(ROWS + 1, -1, np.int8)
    for number, words in enumerate(FUNCTION_WORDS.values()):
        data, edges = flat(pa.array(words.split(), pa.large_string()))
        ids, _ = hashed_words(data, edges)
        rows[ids[:, 0]] = number
    return rows


def languages(words, edges):
    """Number of the language whose function words are the most frequent in each text."""
    known = _function_rows()[words[:, 0]]
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    size, hit = len(FUNCTION_WORDS), known >= 0
    counts = np.bincount(owner[hit] * size + known[hit], minlength=(len(edges) - 1) * size)
    return counts.reshape(-1, size).argmax(1)


class Network:
    def __init__(self, weights=None, seed=13):
        draw = np.random.default_rng(seed)
        shapes = {"words": (ROWS + 1, EMBEDDING), "out": (len(WIDTHS) * FILTERS,), "out_bias": (1,)}
        for width in WIDTHS:
            shapes[f"filters{width}"] = (width * EMBEDDING, FILTERS)
            shapes[f"bias{width}"] = (FILTERS,)
        if weights is None:
            weights = {n: np.zeros(s, np.float32) if "bias" in n else
                       (draw.standard_normal(s) * (0.1 if n == "words" else 0.3)).astype(np.float32)
                       for n, s in shapes.items()}
            weights["words"][ROWS] = 0
            weights["thresholds"] = np.zeros(len(FUNCTION_WORDS), np.float32)
        self.w = weights

    @staticmethod
    def padded(words, edges):
        """Words with empty words behind every text, as many as a window has."""
        gap = max(WIDTHS)
        lengths = np.diff(edges)
        firsts = running(lengths + gap)
        out = np.full((firsts[-1], 2), ROWS, np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        out[np.arange(len(words)) + gap * owner] = words
        return out, firsts

    def pool(self, padded, firsts, where=False):
        """Max over each text of every filter, and with ``where`` the places of the maxima."""
        table = self.w["words"]
        embedded = np.r_[table[padded[:, 0]] + table[padded[:, 1]],
                         np.zeros((max(WIDTHS), EMBEDDING), np.float32)]
        n, outs, places = len(padded), [], []
        # A window may start at the first empty word behind a text; the next would reach on.
        beyond = (firsts[1:, None] - np.arange(1, max(WIDTHS))).ravel()
        for width in WIDTHS:
            windows = np.concatenate([embedded[k:k + n] for k in range(width)], axis=1)
            values = windows @ self.w[f"filters{width}"]
            values[beyond] = -np.inf
            high = np.maximum.reduceat(values, firsts[:-1], axis=0)
            if where:
                owner = np.repeat(np.arange(len(high)), np.diff(firsts))
                row, column = np.nonzero(values == high[owner])
                place = np.zeros(high.shape, np.int64)
                place[owner[row[::-1]], column[::-1]] = row[::-1]  # the first place wins
                places.append(place)
            outs.append(high + self.w[f"bias{width}"])
        pooled = np.concatenate(outs, axis=1)
        return (pooled, places) if where else pooled

    def log_odds(self, words, edges):
        padded, firsts = self.padded(words, edges)
        return np.maximum(self.pool(padded, firsts), 0) @ self.w["out"] + self.w["out_bias"][0]

    def scores(self, texts):
        """Probability of each text of an Arrow column, 0.5 at its language's threshold."""
        if not len(texts):
            return np.zeros(0)
        words, edges = hashed_words(*flat(texts))
        z = self.log_odds(words, edges) - self.w["thresholds"][languages(words, edges)]
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -50, 50)))

    def gradients(self, words, edges, y, weight, decay=1e-4):
        padded, firsts = self.padded(words, edges)
        pooled, places = self.pool(padded, firsts, where=True)
        acts = np.maximum(pooled, 0)
        z = acts @ self.w["out"] + self.w["out_bias"][0]
        d_z = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight / weight.sum()).astype(np.float32)
        grads = {"out": acts.T @ d_z + decay * self.w["out"], "out_bias": d_z.sum(keepdims=True)}
        d_pooled = d_z[:, None] * self.w["out"] * (pooled > 0)
        d_words = np.zeros_like(self.w["words"])
        behind = np.r_[padded, np.full((max(WIDTHS), 2), ROWS)]
        for number, width in enumerate(WIDTHS):
            d_high = d_pooled[:, number * FILTERS:(number + 1) * FILTERS]
            at = behind[places[number][:, :, None] + np.arange(width)]
            seen = self.w["words"][at].sum(-2).reshape(len(y), FILTERS, -1)
            filters = self.w[f"filters{width}"]
            grads[f"filters{width}"] = np.einsum("tfk,tf->kf", seen, d_high) + decay * filters
            grads[f"bias{width}"] = d_high.sum(0)
            d_seen = (d_high[:, :, None] * filters.T[None]).reshape(-1, EMBEDDING)
            for part in (0, 1):
                np.add.at(d_words, at[..., part].ravel(), d_seen)
        d_words[ROWS] = 0
        grads["words"] = d_words
        return grads


def prepared(texts):
    """(table rows of the words as binary values, language numbers) of an Arrow column of texts."""
    words, edges = hashed_words(*flat(texts))
    data = words.astype(np.uint16)
    return [data[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], languages(words, edges)


def _words(data, edges, rare=None):
    words = data.view(np.uint16).reshape(-1, 2).astype(np.int64)
    return words if rare is None else np.where(rare[words], ROWS, words), edges // 4


def _texts_with(data, edges):
    """By table row the number of texts that have it."""
    words, edges = _words(data, edges)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    pairs = np.unique(words.ravel() * np.int64(len(edges)) + np.repeat(owner, 2))
    return np.bincount(pairs // len(edges), minlength=ROWS + 1)


def _gradients(rare, balance):
    """For ``Rows.fit``; ``balance`` is the weight of a row by class."""
    def start(weights):
        network = Network(weights)

        def block(data, edges):
            words, firsts = _words(data, edges, rare)

            def step(picked, y):
                weight, total = balance[y.astype(int)], {}
                sizes = firsts[picked + 1] - firsts[picked]
                # Long texts are embedded a few at a time; the step is that of the whole batch.
                piece = running(sizes)[:-1] // BATCH_WORDS
                for number in np.unique(piece):
                    mine = np.flatnonzero(piece == number)
                    parts = [words[firsts[i]:firsts[i + 1]] for i in picked[mine]]
                    grads = network.gradients(
                        np.concatenate(parts), running(sizes[mine]), y[mine], weight[mine])
                    share = weight[mine].sum() / weight.sum()
                    for name, g in grads.items():
                        total[name] = total.get(name, 0) + g * np.float32(share)
                return total

            return step

        return block

    return start


def thresholds(z, y, weight, language):
    """By language the log odds between which and the next the fewest weighted errors fall; the
    one of all languages where a language has fewer than 20 rows (by weight) of either class."""
    def best(rows):
        order = np.argsort(z[rows], kind="stable")
        at, good = z[rows][order], (y[rows] * weight[rows])[order]
        bad = ((1 - y[rows]) * weight[rows])[order]
        # With the cut before place i, the positives below it and the negatives above it are errors.
        errors = np.r_[0, np.cumsum(good)] + bad.sum() - np.r_[0, np.cumsum(bad)]
        low = np.flatnonzero(errors <= errors.min() + 1e-9)
        edges = np.r_[at[0] - 1, (at[1:] + at[:-1]) / 2, at[-1] + 1]
        return float(np.median(edges[low]))

    everything = np.arange(len(z))
    common = best(everything) if len(z) else 0.0
    out = np.full(len(FUNCTION_WORDS), common, np.float32)
    for number in range(len(FUNCTION_WORDS)):
        rows = everything[language == number]
        if min((y * weight)[rows].sum(), ((1 - y) * weight)[rows].sum()) >= 20:
            out[number] = best(rows)
    return out


def train(docs, labels, rows, label="toxic"):
    """Weights learnt from the texts of all label rows that the condition ``rows`` allows; {} if there
    are none."""
    with Rows(docs, labels, label, rows, prepared, CALIBRATION) as table:
        if not len(table):
            return {}
        # An empty class has no rows to weigh.
        balance = np.array([table.fitted() / (2 * max(1, table.fitted(y))) for y in (0, 1)])
        rare = table.summed(_texts_with, ROWS + 1) < RARE
        weights = Network().w
        weights["words"][rare] = 0
        cuts = weights.pop("thresholds")
        weights = table.fit(weights, _gradients(rare, balance), BATCH, RATE, seed=2)
        weights["thresholds"] = cuts
        weights["thresholds"] = _calibrated(table, weights, rare)
    return weights


def _calibrated(table, weights, rare):
    """Thresholds on all rows kept apart, which are counted by cells of log odds."""
    def cells(y, language, data, edges):
        z = Network(weights).log_odds(*_words(data, edges, rare))
        return np.round(np.clip(z, -50, 50) / CELL).astype(np.int64), y.astype(np.int64), language

    counts = every_block(table.table.where("apart"), cells, "cell long, y long, language long").groupBy(
        "cell", "y", "language").agg(F.count(F.lit(1)).alias("n")).orderBy("cell", "y", "language").collect()
    cell, y, language, n = np.array([tuple(r) for r in counts], float).reshape(-1, 4).T
    return thresholds(cell * CELL, y, n, language)


def score(df, weights, text="text", column="score", drop=()):
    """``df`` with a probability in [0, 1] of toxicity.

    A null text is scored as the empty text, which has no words; untrained weights score 0.5. A
    column with the name of the score is replaced.
    """
    def start():
        network = Network(weights) if weights else None
        return lambda texts: [network.scores(texts) if network else np.full(len(texts), 0.5)]

    return with_text_columns(df, f"`{column}` double", start, text, drop)
