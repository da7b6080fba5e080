"""Secrets in texts: fixed patterns, and strings that compression finds novel.

Besides the patterns, long strings after a sensitive word are candidates. A candidate's novelty is
its marginal compressed size: bytes that zstandard needs for it when primed with the text around
it and a dictionary of common identifiers. Names, repeated placeholders and words of the context
cost few bytes; random keys cost about as many as they have, and these are reported.
"""

import bisect
import itertools
import re

import zstandard

from riskloom.llm.blocks import with_text_columns

#: The base patterns; letters of the names in either case.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "novel")

#: A sensitive word: no letter or digit before it and no letter behind it, or a change of case.
SENSITIVE = re.compile(
    r"(?:(?<![A-Za-z0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z0-9])(?=[A-Z][a-z]))"
    r"(?ai:auth(?:orization)?|bearer|credentials?|private|access|api|signing|master|account|"
    r"client|session|cookie|salt|pwd|passphrase|password|passwd|secret|token|key)"
    r"(?:(?![A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z]))")
SHORTEST = 16
LONG = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: Characters of the same line between a sensitive word and a long string, at most.
NEAR = 40

IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key_id secret_access_key client_secret "
    "private_key public_key authorization bearer session_id cookie user_name username account "
    "example placeholder changeme your_api_key_here your_token_here xxxxxxxxxxxxxxxx "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0000000000000000 "
    "get_config os.environ getenv settings config default production development "
    "https://www.example.com/index.html localhost request response content_type application/json "
    "function return import class string number boolean undefined null true false "
).encode()

CONTEXT = 400
NOVELTY = 0.7
SPAN_DDL = "array<struct<kind:string,start:int,end:int,novelty:double>>"


def marginal_bytes(candidate, context, identifiers=IDENTIFIERS):
    """Compressed bytes the candidate adds behind the context and the identifiers."""
    primed = zstandard.ZstdCompressionDict(
        identifiers + b" " + context, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(
        level=19, dict_data=primed, write_content_size=False, write_dict_id=False)
    return len(packer.compress(candidate)) - len(packer.compress(b""))


def novelty(text, start, end, context=CONTEXT, identifiers=IDENTIFIERS):
    """Marginal compressed bytes per byte of ``text[start:end]``, 0 to 1.

    Further copies of the string are no context: a key that is set and then used stays a key.
    """
    candidate = text[start:end].encode()
    around = (text[max(0, start - context):start] + "\n" + text[end:end + context]).encode()
    around = around.replace(candidate, b"")
    return min(1.0, max(0.0, marginal_bytes(candidate, around, identifiers) / len(candidate)))


def _mixed(string):
    """Two of: small letters, capitals, digits; words of prose have one."""
    return sum((any(c.islower() for c in string), any(c.isupper() for c in string[1:]),
                any(c.isdigit() for c in string))) >= 2


def base_spans(text):
    """(kind, start, end) by the fixed patterns, leftmost and non-overlapping per kind.

    An assignment's match is taken before its length is tested, as the test drops matches; a run
    of hex digits or of an access key is maximal, so that there the length can be in the pattern.
    """
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
             if m.end(1) - m.start(1) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def candidates(text):
    """(start, end) of every long string near behind a sensitive word, in order.

    Where the word is in the string itself (a name and its value without a blank between) the
    candidate is what stands behind the equals sign.
    """
    runs = [m.span() for m in LONG.finditer(text)]
    if not runs:
        return []
    found = {}
    ends = [b for _, b in runs]
    for m in SENSITIVE.finditer(text):
        word = m.end()
        stop = min(len(text), word + NEAR)
        line = text.find("\n", word, stop)
        stop = line if line >= 0 else stop
        for start, end in itertools.islice(runs, bisect.bisect_right(ends, word), None):
            if start > stop:
                break
            if start < word:
                start = text.find("=", word, min(end, stop)) + 1
                while 0 < start < end and text[start] == "=":
                    start += 1
                if not start or end - start < SHORTEST:
                    continue
            found[end] = max(start, found.get(end, 0))
    return sorted((start, end) for end, start in found.items())


def novel_spans(text, taken, threshold=NOVELTY):
    """(kind, start, end, novelty) of candidates outside ``taken`` that stay incompressible."""
    for start, end in candidates(text):
        if any(a < end and start < b for _, a, b in taken) or not _mixed(text[start:end]):
            continue
        measured = novelty(text, start, end)
        if measured >= threshold:
            yield "novel", start, end, measured


def scan(df, text="text", threshold=NOVELTY, drop=()):
    """``df`` with ``secrets``, an array of (kind, start, end, novelty) by start, then kind.

    Places are code points, the end exclusive; the novelty of pattern matches is null. A null or
    empty text has none. A column named ``secrets`` is replaced.
    """
    def block(texts):
        out = []
        for value in texts.to_pylist():
            base = base_spans(value)
            spans = [(*s, None) for s in base] + list(novel_spans(value, base, threshold))
            spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
            out.append([dict(zip(("kind", "start", "end", "novelty"), s)) for s in spans])
        return [out]

    return with_text_columns(df, f"secrets {SPAN_DDL}", lambda: block, text, drop)
