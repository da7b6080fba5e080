"""Personal data in texts: fixed patterns, and a tagger for spellings that these miss.

A character-level bidirectional LSTM with CRF transitions learns from labelled spans: what the
patterns find in a bounded sample, and rewritten spellings of it. Every kind has a digit, an @ or an
'at' in brackets, so windows cover all surroundings of these, wherever in the text they are, to the
end of the address; overlapping windows are decoded, each character takes the tag of the window in
which it lies most central, and spans are read from that one sequence, tested and added where they
touch no pattern's match.
"""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm.blocks import unused, with_text_columns
from riskloom.llm.scratch import kept_once, local_rows
from riskloom.llm.tagger import PAD, Tagger, symbols

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive repeats keep long runs of digits linear; they match
#: the same, since a match that fails at a run of digits fails at every later place of the run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: What every span has somewhere: a digit, an @, or an 'at' or 'dot' in brackets.
TRIGGER = re.compile(r"[0-9@]+|[(\[{]\x20?(?i:at|dot)\x20?[)\]}]")
REACH = 24
WINDOW, STRIDE = 64, 32
#: Bounds of what the tagger learns from.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 1_500, 2_500
#: Of the sampled texts one in so many may have no labelled span.
PLAIN = 4
#: The part of the windows that is for labelled spans where there are enough of both sorts.
LABELLED = 2 / 3
BATCH = 1_024


def luhn(digits):
    """Whether the check digit fits."""
    values = [int(d) for d in digits[::-1]]
    doubled = [2 * v - 9 if v > 4 else 2 * v for v in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _digits(string):
    return "".join(c for c in string if "0" <= c <= "9")


def _is_ip(string):
    parts = [p.lstrip("0") for p in re.findall("[0-9]+", string)]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(string):
    digits = _digits(string)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(string):
    return 10 <= len(_digits(string)) <= 15


def base_spans(text):
    """(kind, start, end) by the fixed patterns, leftmost and non-overlapping per kind."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        # The local part reaches back to the last match or to the first character it cannot have.
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            free = match.end()
            found.append(("email", start, free))
        at = text.find("@", at + 1)
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if _is_ip(m.group())]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text)
              if m.end() - m.start() >= 14 and _is_card(m.group())]
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if _is_phone(m.group())]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def regions(text):
    """Ranges within ``REACH`` characters of a ``TRIGGER``; near ones are joined.

    An edge inside a run of address characters moves to the end of the run, so that no address is cut.
    """
    out = []
    for m in TRIGGER.finditer(text):
        free = out[-1][1] if out else 0
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        # What the range before covers is not gone through again: long runs stay linear.
        while a > free and text[a - 1] in LOCAL and text[a] in LOCAL:
            a -= 1
        b = max(b, free)
        while free < b < len(text) and text[b - 1] in LOCAL and text[b] in LOCAL:
            b += 1
        if out and a <= free:
            out[-1][1] = b
        else:
            out.append([a, b])
    return out


def windows(length):
    """Starts of the windows over a region: each but the last has a full stride before the next."""
    return list(range(0, max(1, length - WINDOW + STRIDE), STRIDE))


def _tag(kind, first):
    return 1 + 2 * KINDS.index(kind) + (0 if first else 1)


def spellings(kind, span, draw):
    """Another spelling of a labelled span, as people write it past the patterns."""
    digits = _digits(span)
    if kind == "phone":
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return draw.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}"])
    if kind == "card":
        groups = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return draw.choice([".", "/", "  ", "_"]).join(groups)
    if kind == "email":
        name, domain = span.split("@", 1)
        at = str(draw.choice([" @ ", "@ ", " @", "(@)", " (at) ", "(at)", " [at] ", "[at]"]))
        dot = str(draw.choice([".", " (dot) ", "(dot)", " [dot] ", "[dot]"])) if "a" in at else "."
        return name + at + domain.replace(".", dot)
    return span.replace(".", draw.choice(["[.]", " . ", "(.)"]))


def _text_windows(text, draw):
    """(symbols, tags) of every window over the regions of a text, once as it is and once with its
    labelled spans in other spellings."""
    spans = base_spans(text)
    for a, b in regions(text):
        # A span that crosses an edge is labelled as far as it is inside; it gets no other spelling.
        inside = [(k, max(a, start), min(b, end)) for k, start, end in spans if start < b and a < end]
        crossing = {s for s in inside if s not in spans}
        chosen, at = [], a
        for kind, start, end in inside:
            if start >= at:
                whole = (kind, start, end) not in crossing
                chosen += [(None, text[at:start], False), (kind, text[start:end], whole)]
                at = end
        chosen.append((None, text[at:b], False))
        variants = [chosen]
        if any(whole for _, _, whole in chosen):
            variants.append([
                (k, str(spellings(k, s, draw)) if whole else s, whole) for k, s, whole in chosen])
        for parts in variants:
            x, y = [], []
            for kind, part, _ in parts:
                codes = symbols(part)
                x.append(codes)
                tags = np.zeros(len(codes), np.int64)
                if kind and len(codes):
                    tags[:] = _tag(kind, False)
                    tags[0] = _tag(kind, True)
                y.append(tags)
            x, y = np.concatenate(x), np.concatenate(y)
            for start in windows(len(x)):
                piece = slice(start, start + WINDOW)
                row, tags = np.full(WINDOW, PAD, np.uint8), np.zeros(WINDOW, np.uint8)
                row[:len(x[piece])] = x[piece]
                tags[:len(y[piece])] = y[piece]
                yield row, tags


def examples(texts, limit=SAMPLE_WINDOWS, seed=3):
    """At most ``limit`` windows and tags from all ``texts``, labelled ones in two spellings.

    Windows with labelled spans come first, each kind with an equal part of ``LABELLED`` of the
    bound, then those without; what one sort leaves free the others fill. Within a sort every text
    gives one window before any gives two; which ones, a hash tells.
    """
    draw = np.random.default_rng(seed)
    pools = [[] for _ in range(1 + len(KINDS))]  # by kind, those without a span first
    for number, text in enumerate(texts):
        mine, base = [[] for _ in pools], zlib.crc32(text.encode("utf-8", "replace"))
        for place, (x, y) in enumerate(_text_windows(text, draw)):
            tagged = y[y > 0]
            pool = mine[1 + (int(tagged[0]) - 1) // 2 if len(tagged) else 0]
            pool.append((zlib.crc32(b"%d" % place, base), number, place, x, y))
            if len(pool) >= 4 * limit:
                pool[:] = sorted(pool, key=lambda w: w[:3])[:limit]
        for pool, found in zip(pools, mine):
            found.sort(key=lambda w: w[:3])
            pool += [(turn, *w) for turn, w in enumerate(found[:limit])]
            if len(pool) >= 4 * limit:
                pool[:] = sorted(pool, key=lambda w: w[:4])[:limit]
    pools = [sorted(pool, key=lambda w: w[:4])[:limit] for pool in pools]
    plain, kinds = pools[0], pools[1:]
    room = max(limit - len(plain), int(limit * LABELLED))
    each = room // len(KINDS)
    chosen = [w for pool in kinds for w in pool[:each]]
    more = sorted((w for pool in kinds for w in pool[each:]), key=lambda w: w[:4])
    chosen += more[:room - len(chosen)]
    chosen += plain[:limit - len(chosen)]
    xs, ys = [w[4] for w in chosen], [w[5] for w in chosen]
    return (np.array(xs, np.int64).reshape(-1, WINDOW), np.array(ys, np.int64).reshape(-1, WINDOW))


def sampled(df, text="text", texts=SAMPLE_TEXTS):
    """At most ``texts`` different texts, as column t: those with a pattern's span, and up to one in
    ``PLAIN`` that has a ``TRIGGER`` but no span; of each sort the ones with the least hashes.

    Every text of the table is looked at before any is drawn.
    """
    def start():
        return lambda values: [[bool(base_spans(v)) for v in values.to_pylist()]]

    rows = df.filter(F.col(text).rlike(TRIGGER.pattern)).select(F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    keys = kept_once(with_text_columns(rows, "labelled boolean", start, "t", ["t"]).groupBy("h").agg(
        F.max("labelled").alias("labelled")), "pii")
    counts = {r["labelled"]: r["n"] for r in keys.groupBy("labelled").agg(F.count(F.lit(1)).alias("n")).collect()}
    plain = min(texts // PLAIN, counts.get(False, 0))
    chosen = []
    for labelled, most in ((True, texts - plain), (False, plain)):
        # Thinned by hash to about twice the bound, so that the task that picks the least hashes sees
        # a few times ``texts`` rows, however many tasks the table has.
        share = min(1.0, 2 * texts / max(1, counts.get(labelled, 0)))
        thin = F.shiftrightunsigned("h", 32) < F.lit(int(share * 2**32))
        order = F.shiftrightunsigned("h", 1), "h"
        chosen += keys.filter((F.col("labelled") == labelled) & thin).orderBy(*order).limit(most).collect()
    # ``texts`` hashes at most.
    wanted = local_rows(df.sparkSession, [(r["h"],) for r in chosen], "h long")
    return rows.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.min("t").alias("t")).select("t")


def train(df, text="text", texts=SAMPLE_TEXTS, windows_=SAMPLE_WINDOWS):
    """A tagger from ``sampled`` texts; None if no text has a labelled span.

    One task learns from the bounded sample; only the weights come to the driver.
    """
    sample = sampled(df, text, texts)

    def fit(frames):
        import pandas as pd

        rows = sorted(t for frame in frames for t in frame["t"])
        x, y = examples(rows, windows_)
        if not len(y) or not y.any():
            return
        tagger = Tagger(1 + 2 * len(KINDS)).fit(x, y)
        yield pd.DataFrame({
            "name": list(tagger.w), "shape": [list(w.shape) for w in tagger.w.values()],
            "data": [w.astype("<f4").tobytes() for w in tagger.w.values()]})

    rows = sample.coalesce(1).mapInPandas(fit, "name string, shape array<int>, data binary").collect()
    weights = {r["name"]: np.frombuffer(r["data"], "<f4").reshape(r["shape"]).copy() for r in rows}
    return weights or None


DOT = r"(?:\.|\x20?[(\[{]\x20?(?i:dot)\x20?[)\]}]\x20?)"
#: What may follow the end of an address that a tagger's span cuts.
TAIL = re.compile(rf"[A-Za-z0-9-]*(?:{DOT}[A-Za-z0-9-]+)*")
TESTS = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]+(?:\x20?\(?@\)?\x20?|\x20?[(\[{]\x20?(?i:at)\x20?[)\]}]\x20?)"
        rf"[A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+)+").fullmatch,
    "ip": lambda s: re.fullmatch(r"[0-9]+( ?[\[(]?\.[\])]? ?[0-9]+){3}", s) and _is_ip(s),
    "card": lambda s: re.fullmatch(r"[0-9](?:[ ./_-]{0,2}[0-9])+", s) and _is_card(s),
    "phone": lambda s: re.fullmatch(r"\+?\(?[0-9][ ()./0-9-]+[0-9]", s) and _is_phone(s)
    and 2 <= len(re.findall("[^0-9]+", s.lstrip("+("))),
}


def _read(tags):
    """(kind, start, end) from one sequence of tags."""
    start = kind = None
    for at, tag in enumerate([*tags, 0]):
        here = None if tag == 0 else KINDS[(tag - 1) // 2]
        if kind is not None and (here != kind or tag % 2 == 1):
            yield kind, start, at
            kind = None
        if here is not None and kind is None:
            kind, start = here, at


def tagged_spans(tagger, texts):
    """Spans the tagger sees, per text, before the tests; all windows of the block at once."""
    rows, owners = [], []
    for number, text in enumerate(texts):
        for a, b in regions(text):
            codes = symbols(text[a:b])
            for start in windows(len(codes)):
                row = np.full(WINDOW, PAD)
                part = codes[start:start + WINDOW]
                row[:len(part)] = part
                rows.append(row)
                owners.append((number, a, b, start))
    found = [[] for _ in texts]
    merged, region = None, None

    def close():
        if region is not None:
            number, a, _ = region
            found[number] += [(k, s + a, e + a) for k, s, e in _read(merged)]

    for first in range(0, len(rows), BATCH):
        tags = tagger.decode(np.array(rows[first:first + BATCH]))
        for (number, a, b, start), mine in zip(owners[first:first + BATCH], tags):
            if region != (number, a, b):
                close()
                region, merged = (number, a, b), np.zeros(b - a, np.int8)
            # Half of the overlap belongs to the window before.
            margin = (WINDOW - STRIDE) // 2 if start else 0
            merged[start + margin:start + WINDOW] = mine[margin:b - a - start]
    close()
    return found


def added_spans(text, tagged, base):
    """Of tagged spans those that pass their kind's test and touch no base span."""
    out = []
    for kind, start, end in tagged:
        while start < end and text[start] in " .,;:":
            start += 1
        while end > start and text[end - 1] in " .,;:(":
            end -= 1
        if kind == "email" and start < end and TESTS[kind](text[start:end]):
            # All of the address, as the patterns take it.
            while start > 0 and text[start - 1] in LOCAL:
                start -= 1
            end = TAIL.match(text, end).end()
        if any(a < end and start < b for _, a, b in base) or out and start < out[-1][2]:
            continue
        if TESTS[kind](text[start:end]):
            out.append((kind, start, end))
    return out


def scan(df, weights, text="text", drop=()):
    """``df`` with ``personal``, an array of (kind, start, end, base) by start, then kind.

    Places are code points, the end exclusive; ``base`` tells the patterns' spans from the
    tagger's. A null or empty text has none; without weights only the patterns search. A column
    named ``personal`` is replaced.
    """
    def start():
        tagger = None if weights is None else Tagger(1 + 2 * len(KINDS), weights=weights)

        def block(texts):
            values = texts.to_pylist()
            tagged = tagged_spans(tagger, values) if tagger else [()] * len(values)
            out = []
            for value, mine in zip(values, tagged):
                base = base_spans(value)
                spans = [(*s, True) for s in base] + [(*s, False) for s in added_spans(value, mine, base)]
                spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in spans])
            return [out]

        return block

    ddl = "personal array<struct<kind:string,start:int,end:int,base:boolean>>"
    return with_text_columns(df, ddl, start, text, drop)


def mask(df, weights, text="text"):
    """``df`` with its texts' personal data replaced by the kind in angle brackets.

    Overlapping spans are masked together under the first one's kind. A null text stays null.
    """
    def start():
        tagger = None if weights is None else Tagger(1 + 2 * len(KINDS), weights=weights)

        def block(texts):
            values = texts.to_pylist()
            tagged = tagged_spans(tagger, values) if tagger else [()] * len(values)
            out = []
            for value, mine in zip(values, tagged):
                base = base_spans(value)
                spans = sorted([*base, *added_spans(value, mine, base)], key=lambda s: (s[1], -s[2]))
                parts, at = [], 0
                for kind, begin, end in spans:
                    if begin >= at:
                        parts += [value[at:begin], f"<{kind}>"]
                    at = max(at, end)
                out.append("".join([*parts, value[at:]]))
            return [out]

        return block

    made = unused(df, "_masked")
    masked = with_text_columns(df, f"`{made}` string", start, text)
    return masked.withColumn(text, F.when(F.col(text).isNotNull(), F.col(made))).drop(made)
