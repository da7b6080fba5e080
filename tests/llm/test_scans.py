import re

from riskloom.llm import licenses, pii, secrets
from riskloom.llm.tagger import Tagger

import numpy as np
import pyarrow as pa


def _words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_phrases_against_brute_force(texts):
    search = licenses._search(tuple(licenses.PHRASES.items()), tuple(licenses.NOTICES.items()))
    values = [*texts.values(), "MIT License mit license", "cc-by CC BY\x00cc by", "É mit\nLICENSE", "CC by by cc by"]
    counts, base, _ = search.block(pa.array(values))
    for text, n, found in zip(values, counts, base):
        words = _words(text)
        assert n == len(words)
        wanted = sorted((i, label, i + len(p.split()) - 1) for p, label in licenses.PHRASES.items()
                        for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
        assert sorted((s["first_word"], s["label"], s["last_word"]) for s in found) == wanted


def test_notices_with_errors():
    search = licenses._search(tuple(licenses.PHRASES.items()), tuple(licenses.NOTICES.items()))
    _, base, found = search.block(pa.array([
        "x Lisensed under the Apache Licence ok", "gnu genral public lisense", "a plain text about nothing",
        "Licensed under CC BY-NC 4.0", "released under the mit licence."]))
    assert not base[0] and {(s["label"], s["errors"]) for s in found[0]} == {("apache", 2)}
    assert [(s["label"], s["first_word"], s["last_word"]) for s in found[1]] == [("gpl", 0, 3)]
    assert not found[2] and {"cc-by-nc", "cc-by"} == {s["label"] for s in found[3]}
    assert [s["label"] for s in found[4]] == ["mit"]


def test_pieces_survive_any_edits():
    for notice in licenses.NOTICES:
        k = licenses.allowed_errors(notice)
        parts = licenses.pieces(notice, k)
        assert "".join(p for _, p in parts) == notice and len(parts) == k + 1 and all(p for _, p in parts)


def test_secret_patterns():
    def found(text):
        return [(k, text[a:b]) for k, a, b in sorted(secrets.base_spans(text), key=lambda s: s[1])]

    assert found("Api_Key = 'abc123' x") == [("assign", "Api_Key = 'abc123")]
    assert found("token=secret=abcdef") == [("assign", "token=secret=abcdef")]
    assert found("token: abc") == [] and found("paſsword=abcdefgh") == []
    assert found("AKIA" + "B" * 15) == [] and found("xAKIA" + "B" * 16) == [("access", "AKIA" + "B" * 16)]
    assert found("é" + "0a" * 12) == [("hex", "0a" * 12)] and found("0a" * 11) == []


def test_secret_patterns_against_direct_search(texts):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for text in texts.values():
        wanted = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        wanted += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        wanted += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert sorted(secrets.base_spans(text)) == sorted(wanted)


def test_novelty():
    line = "signing key of the service is {} and it rotates"
    strange, usual = "aB3dE5gH7jK9mN1pQ3rT", "your_api_key_here_01"
    for string, expected in ((strange, True), (usual, False), ("internationalization", False)):
        text = line.format(string)
        novel = [text[a:b] for _, a, b, _ in secrets.novel_spans(text, [])]
        assert novel == ([string] if expected else [])
    text = line.format(strange) + " " + line.format(strange)  # its own copies are no context
    assert [text[a:b] for _, a, b, _ in secrets.novel_spans(text, [])] == [strange, strange]
    key = "Zq81mXw07TtLp5Rk2Vb9Nc4Hs6Jd3Gf0Ya7Ue1"
    text = f"STRIPE_KEY={key}\necho STRIPE_KEY={key}\n"
    assert [text[a:b] for _, a, b, _ in secrets.novel_spans(text, [])] == [key, key]


def _direct(text):
    """The base patterns as they are stated."""
    def digits(s):
        return "".join(c for c in s if c in "0123456789")

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_personal_patterns_against_direct_search(texts):
    odd = ["a@b.c@d.e f@g", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.4", "x+1 (743) 555-3824.", "4111 1111 1111 1111-",
           "..@-.-.a", "%a.b+c@x-y.zz.", "+12 34", "4111111111111111 42", "1.1.1.0000000001"]
    for text in [*texts.values(), *odd]:
        assert sorted(pii.base_spans(text)) == _direct(text), text[:80]


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 50_000):
        pii.base_spans(text)
        secrets.base_spans(text)


def test_tagger_gradients():
    tagger = Tagger(5, hidden=3)
    tagger.w = {n: w.astype(np.float64) for n, w in tagger.w.items()}
    draw = np.random.default_rng(0)
    x, y = draw.integers(0, 131, (2, 6)), draw.integers(0, 5, (2, 6))
    _, grads = tagger.gradients(x, y)
    for name, weight in tagger.w.items():
        at = (x[0, 2], 1) if name.startswith("table") else tuple(0 for _ in weight.shape)
        losses = []
        for step in (1e-3, -2e-3):
            weight[at] += step
            losses.append(tagger.gradients(x, y)[0])
        weight[at] += 1e-3
        assert abs((losses[0] - losses[1]) / 2e-3 - grads[name][at]) < 2e-3


def test_tagger_finds_other_spellings():
    draw = np.random.default_rng(1)
    texts = []
    for _ in range(260):
        a, b = draw.integers(100, 999), draw.integers(1000, 9999)
        texts += [f"please call +1 ({a}) 555-{b} before noon", f"about {a} things and {b} more"]
    x, y = pii.examples(texts)
    tagger = Tagger(9).fit(x, y)
    text = "please call (743) 555-3824 before noon"
    tagged = pii.tagged_spans(tagger, [text])[0]
    assert [text[a:b] for _, a, b in pii.added_spans(text, tagged, [])] == ["(743) 555-3824"]


def test_windows_cover_regions():
    for length in (1, 31, 64, 65, 96, 97, 1000):
        starts = pii.windows(length)
        assert starts[0] == 0 and starts[-1] + pii.WINDOW >= length
        assert all(b - a == pii.STRIDE for a, b in zip(starts, starts[1:]))
