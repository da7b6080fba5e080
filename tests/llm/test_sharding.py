"""Shards of equal bytes against a sort in plain Python."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import sharding


def key60(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute(rows, shards, tolerance=sharding.GROUP_TOLERANCE):
    """(doc_id, text) -> (doc_id, size, crc, shard, slot): splitters from a full sort."""
    keyed = sorted(((key60(t or ""), key60("" if i is None else str(i)), n) for n, (i, t) in enumerate(rows)))
    size = {n: len((t or "").encode()) + 16 for n, (_, t) in enumerate(rows)}
    total, ends = sum(size.values()), [0]
    for _, _, n in keyed:
        ends.append(ends[-1] + size[n])
    group = [x for x in range(len(keyed) + 1) if x in (0, len(keyed)) or keyed[x - 1][0] != keyed[x][0]]
    bounds = []
    for s in range(1, shards):
        def error(x):
            return abs(shards * ends[x] - total * s), x
        best = min(group, key=error)
        bounds.append(best if error(best)[0] <= tolerance * total else min(range(len(ends)), key=error))
    out, used = [], collections.Counter()
    for place, (_, _, n) in enumerate(keyed):
        shard = sum(b <= place for b in bounds)
        i, t = rows[n]
        out.append((i, size[n], zlib.crc32((t or "").encode()), shard, used[shard]))
        used[shard] += 1
    return sorted(out, key=str)


def placed(spark, rows, shards, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    got = sharding.place(df, shards, keep=["doc_id"], **how).collect()
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got), key=str)


def documents(n, hot=0):
    rows = [(i, "word " * (i * 7919 % 97)) for i in range(n)]
    return rows + [(n + i, "the same text in many rows") for i in range(hot)]


@pytest.mark.parametrize("rows,shards", [
    (documents(400), 7), (documents(300, 300), 40), (documents(5), 40), (documents(200, 40), 3), (documents(90), 1)])
def test_equals_sort(spark, rows, shards):
    assert placed(spark, rows, shards) == brute(rows, shards)


def test_few_probes_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COUNTERS", 16)
    rows = documents(150, 150)
    assert placed(spark, rows, 5) == brute(rows, 5)


def test_pieces_number_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 10)
    rows = documents(300, 200)
    got, want = placed(spark, rows, 4), brute(rows, 4)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for shard in range(4):
        slots = sorted(r[4] for r in got if r[3] == shard)
        assert slots == list(range(len(slots)))


def test_bytes_are_near_equal_whatever_repeats(spark):
    """A third of the rows are one row, id and text alike."""
    rows = documents(400) + [(7, "again and again and again")] * 300
    per = collections.Counter()
    for _, size, _, shard, _ in placed(spark, rows, 10):
        per[shard] += size
    mean, largest = sum(per.values()) / 10, 5 * 97 + 16
    assert len(per) == 10 and all(abs(v - mean) <= largest for v in per.values())


def test_equal_texts_stay_together_where_they_may(spark):
    rows = [(i, f"text {i // 3} " + "x" * 50) for i in range(600)]
    shards = collections.defaultdict(set)
    for i, _, crc, shard, _ in placed(spark, rows, 6, tolerance=0.02):
        shards[crc].add(shard)
    assert all(len(s) == 1 for s in shards.values())


def test_hostile_and_empty(spark, hostile, empty):
    got = sharding.place(hostile, 3)
    assert got.columns == [c for c in hostile.columns if c != "shard"] + ["size", "text_crc32", "shard", "slot"]
    rows = got.collect()
    assert len(rows) == hostile.count()
    want = brute([(r["doc_id"], r["text"]) for r in hostile.collect()], 3)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in rows), key=str) == want
    assert sharding.place(empty, 3).collect() == []


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame(documents(60), "doc_id long, text string")
    sharding.write(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 60 and back.select("shard").distinct().count() == 4


def test_no_python_in_the_plan(spark, sf):
    from riskloom.llm import queries

    plan = queries.op12_sharding(spark, sf)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
