import numpy as np

from riskloom.llm import pii
from riskloom.llm.tagger import Tagger

LONG = ["jane.doe @ students.engineering.example.edu", "the.very.long.name.of.a.person.in.a.firm @ example.org"]


def test_regions_end_with_the_address():
    for address in [*LONG, "jane (at) example (dot) org", "a" * 300 + "@" + "b" * 300 + ".org"]:
        text = "some words about nothing in particular " * 3 + address + " and again some more words " * 3
        start = text.index(address)
        assert any(a <= start and start + len(address) <= b for a, b in pii.regions(text))
    assert pii.regions("x" * 200_000 + "@") == [[0, 200_001]] and len(pii.regions("1a" * 100_000)) == 1
    assert pii.regions("nothing here") == [] and pii.regions("") == []


def test_long_addresses_are_labelled():
    text = "write to " + "a" * 40 + "@" + "b" * 40 + ".org today"
    first = sum((y == pii._tag("email", True)).any() for y in pii.examples([text])[1])
    assert first == 2  # as it is and in another spelling
    wide = "call +1" + " " * 60 + "2345678901 now"  # a pattern's span over two regions
    assert all((y > 0).any() for y in pii.examples([wide])[1])


def test_whole_addresses_are_taken():
    for address in LONG:
        text = f"mail {address}, please"
        cut = ("email", text.index("@") - 4, text.index("@") + 13)
        if pii.TESTS["email"](text[cut[1]:cut[2]]):
            assert [text[a:b] for _, a, b in pii.added_spans(text, [cut], [])] == [address]
    text = "mail jane.doe @ students.engineering.example.edu now"
    cut = ("email", 10, text.index(".example"))
    assert [text[a:b] for _, a, b in pii.added_spans(text, [cut], [])] == [LONG[0]]


def test_tagger_finds_spelled_addresses():
    draw = np.random.default_rng(2)
    names, hosts = ("jane", "tom.w", "max_k", "eva", "j.smith"), ("example", "mail-host", "school.uni", "firm")
    texts = [f"please write to {draw.choice(names)}{n}@{draw.choice(hosts)}.{draw.choice(['org', 'com', 'edu'])} about it"
             for n in range(300)] + [f"about {n} things (at most) and {n} more" for n in range(100)]
    tagger = Tagger(9).fit(*pii.examples(texts))
    for address in ("jane (at) example (dot) org", LONG[0]):
        text = f"please write to {address} about it"
        tagged = pii.tagged_spans(tagger, [text])[0]
        assert [text[a:b] for _, a, b in pii.added_spans(text, tagged, [])] == [address]
