"""Quality rules: a ledger of measurements and failure bits, policies applied to the bits.

Every rule is evaluated once per document and leaves one bit. A policy is a set of rules under a
version; applying it is one bitwise test, and what each rule costs (its ablation) follows from the
counts of the distinct bit masks, of which there are 2 to the number of rules at most.

Words are runs without white space (blank, tab to carriage return). Everything is SQL on whole
texts: no Python runs in tasks, nothing is shuffled.
"""

from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
WINDOW = 8

#: Rule names, bit 0 first, and the condition on the measurements under which the rule fails.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 25 * n_words",
    "capitals": "100 * n_capitals > 60 * word_chars",
    "letters": "100 * n_letters < 50 * word_chars",
    "shouting": "10 * n_marks > 3 * n_words",
}

BASE = ("few_words", "repeated_windows")
#: Policies by version.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
    "n_letters", "n_marks")


def mask(rules):
    """The bits of the named rules."""
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def _count(text, kept_class):
    """Characters of a class: what is left when all others are removed."""
    return F.length(F.regexp_replace(text, f"[^{kept_class}]+", "")).cast("long")


def measure(df, text="text"):
    """``df`` and the measurements; a null text counts as empty, which measures 0 everywhere.

    Columns of ``df`` named like a measurement are replaced, those named like a helper column
    (_words, _lines, _each, _windows, _sorted, _places) are dropped.

    Repeated words: each 8-word window is a hash. Only where a document has fewer distinct hashes
    than windows they are sorted with their places; equal neighbours are the repeated windows, and
    the gaps between their places tell how many words these cover together.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    staged = df.drop(*[c for c in df.columns if c.lower() in MEASURES]).withColumns({
        "_words": F.array_remove(F.split(own, SPACE), ""),
        "_lines": F.filter(F.split(own, "\n"), lambda line: line.rlike(NOT_SPACE)),
    })
    staged = staged.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.regexp_replace(own, SPACE, "")).cast("long"),
        "n_symbols": _count(own, r"#*$%&|<>"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_capitals": _count(own, r"\p{Lu}"),
        "n_letters": _count(own, r"\p{L}"),
        "n_marks": _count(own, r"!?"),
        "_each": F.transform("_words", lambda w: F.xxhash64(w)),
    })
    windows = F.when(F.size("_words") > WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_each", i + k) for k in range(WINDOW)])))
    staged = staged.withColumn("_windows", windows)
    staged = staged.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    repeated = F.filter("_sorted", lambda x, j: (
        (x["h"] == F.get("_sorted", j - 1)["h"]) | (x["h"] == F.get("_sorted", j + 1)["h"])))
    staged = staged.withColumn("_places", F.array_sort(F.transform(repeated, lambda x: x["i"])))
    steps = F.zip_with("_places", F.slice("_places", 2, F.size("_windows")), lambda a, b: (
        F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    return staged.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_words", "_lines", "_each", "_windows", "_sorted", "_places")


def ledger(df, text="text"):
    """Measurements and ``failures``, a long with one bit per failed rule."""
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0))
            for i, condition in enumerate(RULES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(df, text).withColumn("failures", total.cast("long"))


def apply_policy(rows, version, failures="failures", kept="kept", policies=None):
    """Adds whether a document passes all rules of the policy."""
    bits = mask((policies or POLICIES)[version])
    return rows.withColumn(kept, F.col(failures).bitwiseAND(F.lit(bits)) == 0)


def ablations(rows, version, failures="failures", policies=None):
    """One row per rule of the policy: documents that fail it, that fail nothing else (they come
    back without it), and how many the policy keeps without it.

    The documents are first counted by mask; the rest works on those few rows.
    """
    rules = (policies or POLICIES)[version]
    bits = mask(rules)
    counts = rows.groupBy(F.col(failures).bitwiseAND(F.lit(bits)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    tests = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(mask([rule])).cast("long").alias("bit"))
        for rule in rules]))
    each = counts.select("bits", "n", tests.alias("t")).select("bits", "n", "t.rule", "t.bit")

    def where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    bit, rest = F.col("bit"), F.col("bits")
    return each.groupBy("rule").agg(
        where(rest.bitwiseAND(bit) != 0).alias("failing"),
        where(rest == bit).alias("failing_only_this"),
        where(rest.bitwiseAND(F.bitwise_not(bit)) == 0).alias("kept_without"))
