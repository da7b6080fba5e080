import re

from riskloom.llm import rules


def _measured(text):
    """Counted one window and one line at a time."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, covered, lines, repeats = {}, set(), set(), 0
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(8))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in lines
            lines.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered))


def test_measurements_against_brute_force(spark, texts):
    values = [*texts.values(), "", "a", "a b c d e f g h", "a " * 9, ("x y z " * 40 + "\n") * 3, "  \n\n \n a\na\n", "é😀 |" * 30]
    df = spark.createDataFrame(list(enumerate(values)), "id long, text string")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in rules.ledger(df).collect():
        assert tuple(r[c] for c in columns) == _measured(values[r["id"]]), values[r["id"]][:60]


def test_no_python_and_no_shuffle(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = rules.apply_policy(rules.ledger(docs), "v2")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (128,)], "failures long")
    found = {r["rule"]: (r["failing"], r["failing_only_this"], r["kept_without"]) for r in rules.ablations(rows, "base").collect()}
    assert found == {"few_words": (3, 2, 5), "repeated_windows": (1, 0, 3)}
    assert [r["kept"] for r in rules.apply_policy(rows, "base").collect()] == [True, False, False, False, True, True]
    assert rules.mask(rules.RULES) == (1 << len(rules.RULES)) - 1
