"""CSV records of split files whose quoted fields may hold line breaks.

A split of a file cannot tell whether it begins inside quotes. So each split first states what it
would do either way: a function from the state it is entered in to the state it leaves, which only
its lines with quotes decide. Put together in file order these functions give every split its first
state; the second pass then joins lines to records, split by split, and the few records that go over
the border of a split are put together from their pieces.

A quote opens a field only at its beginning; one inside an unquoted field is a letter like others.
"""

import pyarrow as pa
from pyspark.sql import Window, functions as F

from riskloom.session import remove_scratch, scratch_path

#: Splits that begin inside quotes, up to which their list goes to every task.
BROADCAST_SPLITS = 100_000
_WHOLE, _OPEN, _GOES_ON = 0, 1, 2
_SPLIT = "file string, block long"
_STATES = f"{_SPLIT}, inside boolean, broken boolean"


def lines_of(spark, path):
    """(value, file, block, line): the text lines with their split and their order in it."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))


def _behind_quote(line, at):
    """Place behind the quote that closes a field which goes on at ``at``; -1 if none does."""
    while (at := line.find('"', at)) >= 0:
        if line[at + 1:at + 2] != '"':
            return at + 1
        at += 2
    return -1


def ends_inside(line, inside):
    """Whether a line that begins inside quotes, or not, ends inside quotes."""
    at = 0
    while True:
        if inside or line[at:at + 1] == '"':
            at = _behind_quote(line, at if inside else at + 1)
            if at < 0:
                return True
            inside = False
        at = line.find(",", at) + 1
        if not at:
            return False


def _split_functions(batches):
    """(file, block, from_outside, from_inside, broken) of each split, from its lines with quotes.

    ``broken`` tells whether a line ends inside quotes in a split entered outside; where no split
    has such a line, no split is entered inside either.
    """
    at, ends, broken = None, None, False
    for batch in batches:
        for value, file, block in zip(*[batch.column(c).to_pylist() for c in ("value", "file", "block")]):
            if (file, block) != at:
                if at:
                    yield _one_split(at, ends, broken)
                at, ends, broken = (file, block), [False, True], False
            ends = [ends_inside(value, e) for e in ends]
            broken |= ends[0]
    if at:
        yield _one_split(at, ends, broken)


def _one_split(at, ends, broken):
    return pa.RecordBatch.from_pydict({
        "file": [at[0]], "block": [at[1]], "from_outside": [ends[0]], "from_inside": [ends[1]], "broken": [broken]})


def _entered(pdf):
    """In which state the splits of a file are left, from one row per split with quotes."""
    inside, out, pdf = False, [], pdf.sort_values("block")
    for outside, within in zip(pdf["from_outside"], pdf["from_inside"]):
        inside = within if inside else outside
        out.append(inside)
    return pdf[["file", "block", "broken"]].assign(inside=out)[["file", "block", "inside", "broken"]]


def split_states(lines):
    """(file, block, inside, broken): the state in which each split with quotes is left."""
    functions = lines.where(F.contains("value", F.lit('"'))).select("value", "file", "block").mapInArrow(
        _split_functions, f"{_SPLIT}, from_outside boolean, from_inside boolean, broken boolean")
    # One row per split: a file's rows are as many as its splits.
    return functions.groupBy("file").applyInPandas(_entered, _STATES)


class _Joiner:
    """Lines of one split, in order, to records and pieces of records: (value, line, kind)."""

    def __init__(self, inside, first_of_file):
        self.inside, self.header = inside, first_of_file
        self.pieces, self.line, self.began = [], None, not inside

    def add(self, value, line, quoted):
        if not self.pieces:
            self.line = line
        self.pieces.append(value)
        if quoted:
            self.inside = ends_inside(value, self.inside)
        if self.inside:
            return None
        record, kind = "\n".join(self.pieces), _WHOLE if self.began else _GOES_ON
        self.pieces, self.began = [], True
        if kind == _WHOLE and not record.strip():
            return None
        if kind == _WHOLE and self.header:
            self.header = False
            return None
        return record, self.line, kind

    def rest(self):
        """What is still open at the end of the split."""
        if not self.pieces:
            return None
        return "\n".join(self.pieces), self.line, _OPEN if self.began else _GOES_ON


def _join_lines(batches):
    names = ("value", "file", "block", "line", "quoted", "inside")
    at, joiner = None, None

    def made(rows):
        values, lines, kinds = zip(*rows) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(values, pa.string()), pa.array([at[0]] * len(rows), pa.string()),
             pa.array([at[1]] * len(rows), pa.int64()), pa.array(lines, pa.int64()), pa.array(kinds, pa.int32())],
            names=["value", "file", "block", "line", "kind"])

    rows = []
    for batch in batches:
        for value, file, block, line, quoted, inside in zip(*[batch.column(c).to_pylist() for c in names]):
            if (file, block) != at:
                if joiner and (rest := joiner.rest()):
                    rows.append(rest)
                if rows:
                    yield made(rows)
                at, joiner, rows = (file, block), _Joiner(inside, block == 0), []
            if (record := joiner.add(value, line, quoted)) is not None:
                rows.append(record)
        if rows:
            yield made(rows)
            rows = []
    if joiner and (rest := joiner.rest()):
        yield made([rest])


def records_of(lines, states):
    """(value, file, block, line) of each record without the headers; place and order of its first line.

    ``states`` as :func:`split_states` gives it. A split without quotes keeps the state before it.
    """
    splits = lines.select("file", "block").distinct().join(states, ["file", "block"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = splits.withColumn("inside", F.coalesce(
        F.last("inside", ignorenulls=True).over(before), F.lit(False))).where("inside")
    if entered.count() <= BROADCAST_SPLITS:
        entered = F.broadcast(entered)
    placed = lines.join(entered, ["file", "block"], "left").select(
        "value", "file", "block", "line", F.contains("value", F.lit('"')).alias("quoted"),
        F.coalesce("inside", F.lit(False)).alias("inside"))
    found = placed.mapInArrow(_join_lines, f"value string, {_SPLIT}, line long, kind int")
    whole = found.where(F.col("kind") == _WHOLE).drop("kind")
    # At most two pieces a split.
    chain = F.sum((F.col("kind") == _OPEN).cast("int")).over(
        Window.partitionBy("file").orderBy("block", "line"))
    pieces = found.where(F.col("kind") != _WHOLE).withColumn("chain", chain).groupBy("file", "chain").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("pieces"))
    joined = pieces.select(
        F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("value"), "file",
        F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["line"].alias("line"))
    return whole.unionByName(joined)


def quoted_records(spark, path):
    """The records of ``path`` as :func:`records_of` gives them, or None if none has a line break.

    One pass over the lines with quotes decides that; its result, a row per split, is kept.
    """
    lines = lines_of(spark, path)
    place = scratch_path(spark, "splits")
    split_states(lines).write.parquet(place)
    states = spark.read.schema(_STATES).parquet(place)
    if not states.where("broken").limit(1).count():
        remove_scratch(spark, place)
        return None
    return records_of(lines, states)
