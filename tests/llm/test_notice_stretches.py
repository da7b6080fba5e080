import random
import time

import pyarrow as pa

from riskloom.llm import licenses


def test_notice_left_of_a_better_one():
    search = licenses._search(tuple(licenses.PHRASES.items()), tuple(licenses.NOTICES.items()))
    texts = ["licensed undr the mit license or was licensed under the mit license",
             "licensed under the mit license or was licensed undr the mit license"]
    left, right = search.block(pa.array(texts))[2]
    assert [(s["first_word"], s["last_word"], s["errors"]) for s in left] == [(0, 4, 1), (7, 11, 0)]
    assert [(s["first_word"], s["last_word"], s["errors"]) for s in right] == [(0, 4, 0), (7, 11, 1)]
    search.block(pa.array(["licensed under the mit license " * 2000]))


def _found(search, text):
    return [(s["label"], s["first_word"], s["last_word"], s["errors"]) for s in search.block(pa.array([text]))[2][0]]


def test_notices_without_seeds():
    """Every pattern over the whole text, no seeds: the same notices."""
    search = licenses._search(tuple(licenses.PHRASES.items()), tuple(licenses.NOTICES.items()))
    draw = random.Random(3)
    for _ in range(150):
        parts = []
        for _ in range(draw.randrange(1, 4)):
            notice = list(draw.choice(list(licenses.NOTICES)))
            for _ in range(draw.randrange(0, 4)):
                notice[draw.randrange(len(notice))] = draw.choice(["", "a", "x", " ", "é"])
            parts += ["".join(notice), draw.choice(["or", "and the license of", ""])]
        words = " %s " % " ".join(" ".join(parts).split())
        places = {}
        for pattern, label, _, _ in search.notices:
            for start, end, errors in licenses.matches(pattern, words, [(0, len(words))]):
                first = words.count(" ", 0, start) - 1
                key = label, first, first + words[start:end].strip().count(" ")
                places[key] = min(errors, places.get(key, errors))
        assert _found(search, words) == [(*k, e) for k, e in licenses.best(places)]


def test_an_accent_is_one_edit():
    search = licenses._search(tuple(licenses.PHRASES.items()), tuple(licenses.NOTICES.items()))
    assert _found(search, "Licénsed ünder thé MIT license") == [("mit", 0, 4, 3)]


def test_many_notices_take_time_in_proportion():
    search = licenses._search(tuple(licenses.PHRASES.items()), tuple(licenses.NOTICES.items()))
    seconds = []
    for n in (2_000, 16_000):
        began = time.process_time()
        assert len(_found(search, "licensed under the mit licence " * n)) == n
        seconds.append(time.process_time() - began)
    assert seconds[1] < 24 * seconds[0]
