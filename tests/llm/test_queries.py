"""Registered queries end to end: the columns that the contracts fix, from the patterns as stated."""

import hashlib
import re

import pytest

from riskloom.llm import licenses, pii, queries, secrets
from test_scans import _direct


def _digest(spans, kinds):
    ordered = sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in ordered).encode()).hexdigest()


def _ordered(row, kinds):
    """The row's spans as listed, which must be in order."""
    spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in row["spans"].split(",") if s)]
    assert spans == sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
    return spans


def test_op2(spark, sf, texts):
    for r in queries.op2_license_scan(spark, sf).collect():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for n in [len(phrase.split())]
                  for i in range(len(words) - n + 1) if words[i:i + n] == phrase.split()]
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        base = sorted({label for _, label in places})
        assert r["base_labels"] == ",".join(base) and set(base) <= {x for x in r["labels"].split(",")} | {""}
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(",")))) and 0 <= r["score"] <= 1


def test_op3(spark, sf, texts):
    for r in queries.op3_secret_scan(spark, sf).collect():
        text, base = texts[r["doc_id"]], []
        for m in re.finditer(
                r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
            base += [("assign", *m.span())] if len(m[2]) >= 6 else []
        base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        counts = [sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts
        assert r["base_sha256"] == _digest(base, secrets.KINDS) and set(base) <= set(_ordered(r, secrets.KINDS))


def test_op9(spark, sf, texts):
    rows = queries.op9_pii(spark, sf).collect()
    for r in rows:
        base = _direct(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        spans = _ordered(r, pii.KINDS)
        assert r["base_sha256"] == _digest(base, pii.KINDS) and set(base) <= set(spans) and r["n_spans"] == len(spans)
    assert sum(r["n_spans"] for r in rows) > 0


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_sharding", "op13_token_alignment"])
def test_new_queries_on_tables_without_rows(spark, sf, tmp_path, name):
    for table in ("documents", "embeddings"):
        spark.read.parquet(f"{sf}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert queries.REGISTRY[name](spark, str(tmp_path)).collect() == []
