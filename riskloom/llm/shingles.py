"""Word shingles of whole texts as sets of 64-bit hashes, in numpy."""

import numpy as np

WORDS = 5
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


def word_hashes(data, edges):
    """(hash of every word, edges of the texts in words); words are runs without white space."""
    letter = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    starts = np.flatnonzero(letter & (~np.r_[False, letter[:-1]] | cut[:-1]))
    firsts = np.zeros(len(edges), np.int64)
    firsts[1:] = np.searchsorted(starts, edges[1:])
    if not len(starts):
        return np.zeros(0, np.uint64), firsts
    # The place in a word decides the factor of a byte; long words take powers beyond a table row.
    word = np.cumsum(np.bincount(starts, minlength=len(data))) - 1
    offset = np.arange(len(data)) - starts[np.maximum(word, 0)]
    powers = np.multiply.accumulate(np.full(int(offset[letter].max()) + 1, _PRIME, np.uint64))
    factors = powers[np.clip(offset, 0, len(powers) - 1)]
    values = np.where(letter, (data.astype(np.uint64) + np.uint64(1)) * factors, np.uint64(0))
    return _mixed(np.add.reduceat(values, starts)), firsts


def shingle_sets(data, edges, words=WORDS):
    """(sorted distinct shingle hashes of every text, edges). A text with fewer words than a
    shingle has one of all its words; a text without words has none."""
    hashes, firsts = word_hashes(data, edges)
    factors = np.multiply.accumulate(np.full(words, _MIX | np.uint64(1), np.uint64))
    joined = np.zeros(len(hashes), np.uint64)
    padded = np.r_[hashes, np.zeros(words, np.uint64)]
    for k in range(words):
        joined += padded[k:k + len(hashes)] * factors[k]
    joined = _mixed(joined)
    sets = []
    for a, b in zip(firsts[:-1], firsts[1:]):
        if b - a >= words:
            sets.append(np.unique(joined[a:b - words + 1]))
        elif b > a:
            sets.append(_mixed((hashes[a:b] * factors[:b - a]).sum(keepdims=True)))
        else:
            sets.append(joined[:0])
    out = np.zeros(len(edges), np.int64)
    np.cumsum([len(s) for s in sets], out=out[1:])
    return (np.concatenate(sets) if sets else joined[:0]), out


def minhashes(tokens, edges, places, seed=29):
    """Array (texts, places) of 32-bit minhashes; 0 for empty sets."""
    draw = np.random.default_rng(seed)
    factors = draw.integers(1, 1 << 32, places, np.uint32) | np.uint32(1)
    shifts = draw.integers(0, 1 << 32, places, np.uint32)
    filled = np.flatnonzero(np.diff(edges) > 0)
    out = np.zeros((len(edges) - 1, places), np.uint32)
    if not len(filled):
        return out
    short = (tokens >> np.uint64(32)).astype(np.uint32)
    for i in range(places):
        values = short * factors[i] + shifts[i]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        least = np.minimum.reduceat(values, edges[:-1][filled])
        out[filled, i] = least * np.uint32(0x9E3779B1)
    return out
