"""Licence notices in texts: exact phrases, and short notices with bounded errors.

A notice of k allowed errors is cut into k + 1 pieces; whatever k edits do, one piece stays as it
is (pigeonhole). One pass of an Aho-Corasick automaton over the pieces of all notices locates
candidates, and only there the regex library's bounded-error matching verifies the notice.
Texts are compared as words: A-Z lower-cased, words are runs of other characters than the ASCII
ones outside 0-9 and a-z, joined by single blanks.
"""

import bisect
import functools
import heapq

import ahocorasick
import numpy as np
import regex

from riskloom.llm.blocks import flat, with_text_columns

#: Phrases whose words must stand one after the other, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices searched with errors.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license": "apache",
    "apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
}

NOTICE_DDL = "array<struct<label:string,first_word:int,last_word:int,errors:int>>"


def allowed_errors(notice):
    """One edit for each ten characters, three at most."""
    return min(3, len(notice) // 10)


def pieces(notice, errors):
    """The notice in ``errors + 1`` runs of even length, with their places."""
    edges = np.linspace(0, len(notice), errors + 2).astype(int)
    return [(int(a), notice[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def word_table():
    """Byte translation: A-Z to a-z, bytes that end words to blanks."""
    table = bytearray(b" " * 256)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return bytes(table)


class _Covered:
    """A growing union of closed ranges, asked whether a range meets it."""

    def __init__(self):
        self.starts, self.ends = [], []

    def add(self, ranges):
        starts, ends = [], []
        for a, z in sorted([*zip(self.starts, self.ends), *ranges]):
            if starts and a <= ends[-1]:
                ends[-1] = max(z, ends[-1])
            else:
                starts.append(a)
                ends.append(z)
        self.starts, self.ends = starts, ends

    def meets(self, a, z):
        at = bisect.bisect_right(self.starts, z)
        return at > 0 and self.ends[at - 1] >= a


def best(places):
    """Of {(label, first, last): errors} those that overlap none with fewer errors, in order."""
    kept, fewer = [], _Covered()
    for errors in sorted(set(places.values())):
        level = [k for k, e in places.items() if e == errors and not fewer.meets(k[1], k[2])]
        kept += [(k, errors) for k in level]
        fewer.add([k[1:] for k in level])
    return sorted(kept, key=lambda x: (x[0][1], x[0]))


def matches(pattern, words, windows, least=1):
    """(start, end, errors) of matches inside the windows that do not overlap: those with the fewest
    errors first, then the leftmost. What a match leaves of its or another window is searched again,
    if ``least`` characters are left."""
    heap = []

    def look(*stretches):
        for a, b in stretches:
            if b - a >= least and (match := pattern.search(words, a, b)):
                heapq.heappush(heap, (sum(match.fuzzy_counts), match.start(), match.end(), a, b))

    look(*windows)
    starts, ends = [], []
    while heap:
        errors, start, end, a, b = heapq.heappop(heap)
        at = bisect.bisect_left(starts, end)
        if at and ends[at - 1] > start:  # meets a better one
            look((a, starts[at - 1]), (ends[at - 1], b))
            continue
        starts.insert(at, start)
        ends.insert(at, end)
        look((a, start), (end, b))
        yield start, end, errors


class Search:
    """All phrases and notices, made once per task."""

    def __init__(self, phrases, notices):
        self.phrases = [(b" %s " % p.encode(), label) for p, label in phrases.items()]
        self.notices, seeds = [], {}
        for number, (notice, label) in enumerate(notices.items()):
            errors = allowed_errors(notice)
            # The places of the blanks around the notice are fixed, its inside may be edited.
            pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice)}){{e<={errors}}}(?= )")
            self.notices.append((pattern, label, len(notice), errors))
            for place, piece in pieces(notice, errors):
                seeds.setdefault(piece, []).append((number, place))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        if seeds:
            self.seeds.make_automaton()
        self.table, self.any_seed = word_table(), bool(seeds)

    def exact(self, words):
        """(label, first word, last word) of every phrase in blank-joined words."""
        blanks = None
        for phrase, label in self.phrases:
            at = words.find(phrase)
            while at >= 0:
                if blanks is None:
                    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
                first = int(np.searchsorted(blanks, at))
                yield label, first, first + phrase.count(b" ") - 2
                at = words.find(phrase, at + 1)

    def windows(self, words):
        """{notice: stretches} around exact pieces; pieces of one occurrence share a stretch."""
        out = {}
        for end, (length, uses) in self.seeds.iter(words):
            for number, place in uses:
                out.setdefault(number, []).append(end - length + 1 - place)
        for number, starts in out.items():
            _, _, size, errors = self.notices[number]
            stretches = []
            for start in sorted(set(starts)):
                a, b = max(0, start - errors - 1), start + size + errors + 1
                if stretches and start <= stretches[-1][2] + 2 * errors:
                    stretches[-1][1] = b
                else:
                    stretches.append([a, b, start])
            out[number] = [(a, b) for a, b, _ in stretches]
        return out

    def fuzzy(self, words):
        """(label, first word, last word, errors) of the notices, verified around exact pieces."""
        windows = self.windows(words)
        if not windows:
            return
        blanks = np.flatnonzero(np.frombuffer(words.encode("utf-32-le"), np.uint32) == 32)
        for number, stretches in windows.items():
            pattern, label, size, allowed = self.notices[number]
            for start, end, errors in matches(pattern, words, stretches, size - allowed):
                first = int(np.searchsorted(blanks, start)) - 1
                yield label, first, first + words[start:end].strip().count(" "), errors

    def block(self, texts):
        data, edges = flat(texts)
        clean = data.tobytes().translate(self.table)
        n_words, base, found = [], [], []
        for a, b in zip(edges[:-1], edges[1:]):
            words = clean[a:b].split()
            n_words.append(len(words))
            joined = b" %s " % b" ".join(words)
            base.append(sorted(
                ({"label": label, "first_word": f, "last_word": z, "errors": 0}
                 for label, f, z in self.exact(joined)), key=lambda s: (s["first_word"], s["label"])))
            mine = {}
            if self.any_seed:
                for label, f, z, errors in self.fuzzy(joined.decode()):
                    mine[label, f, z] = min(errors, mine.get((label, f, z), errors))
            found.append([{"label": k[0], "first_word": k[1], "last_word": k[2], "errors": e}
                          for k, e in best(mine)])
        return [n_words, base, found]


@functools.lru_cache(maxsize=4)
def _search(phrases, notices):
    return Search(dict(phrases), dict(notices))


def scan(df, text="text", phrases=None, notices=None, drop=()):
    """``df`` with ``n_words``, ``phrases`` and ``notices``: arrays of (label, first_word,
    last_word, errors), words counted from 0.

    A null or empty text has no words and no spans. Columns with these names are replaced.
    """
    phrases = tuple((PHRASES if phrases is None else phrases).items())
    notices = tuple((NOTICES if notices is None else notices).items())

    def start():
        return _search(phrases, notices).block

    return with_text_columns(
        df, f"n_words long, phrases {NOTICE_DDL}, notices {NOTICE_DDL}", start, text, drop)
