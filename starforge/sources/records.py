"""CSV records that span lines, read by many tasks from one file.

Where a line starts within quotes depends on all that comes before it.  But what a line does to
that is one of four things, whatever the state before: it leaves it, turns it, or ends outside or
inside a quoted field in any case.  Such steps compose, so every split of a file is reduced to one
of the four, a scan over the splits tells how each of them starts, and then every task cuts its own
lines into records.  A record that crosses splits leaves a piece in each, which are put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starforge.session import ship_package

col = F.col

# What a line, or a split, does to the state before it: leave, turn, end outside, end inside.
LEAVE, TURN, OUTSIDE, INSIDE = range(4)

# Whole fields from the start of a line on, each with its comma or the end.  A quote opens a field
# only as its first character; within quotes a doubled quote stands for one.
_FIELDS = r'\G(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)(?:,|$)'
_QUOTED = r'^[^"]*+(?:""[^"]*+)*+'
_CLOSED = r'^"[^,]*+,?'


def _step(line: Column) -> Column:
    """What a line does.  What is left after its whole fields is a field that stays open."""
    opens = F.regexp_replace(line, _FIELDS, "") != ""
    rest = F.regexp_replace(line, _QUOTED, "")
    stays = (rest == "") | (F.regexp_replace(F.regexp_replace(rest, _CLOSED, ""), _FIELDS, "") != "")
    step = F.when(opens & stays, INSIDE).when(opens, TURN).when(stays, LEAVE).otherwise(OUTSIDE)
    return F.when(F.instr(line, '"') == 0, LEAVE).otherwise(step)


def _after(step: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """State after each of the steps (1: inside quotes), from the state before the first."""
    turns = np.cumsum(step == TURN)
    fixed = np.where(step >= OUTSIDE, np.arange(len(step)), -1)
    last = np.maximum.accumulate(fixed)
    known = last >= 0
    base = np.where(known, (step[last] == INSIDE) + turns - turns[last], start + turns)
    return base % 2


def _splits(batch: pa.RecordBatch) -> list[tuple[str, int, int, int]]:
    """(file, block, first row, end) of the runs of rows of one split."""
    if not batch.num_rows:
        return []
    files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    codes = files.indices.to_numpy()
    cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    return [(files.dictionary[int(codes[lo])].as_py(), int(blocks[lo]), lo, hi) for lo, hi in zip(edges, edges[1:])]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, from_out, from_in, closes) per split: how it ends from either start, and whether
    a line of it ends outside when it starts inside."""
    found: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        steps = batch.column("step").to_numpy()
        for file, block, lo, hi in _splits(batch):
            ends = found.setdefault((file, block), [0, 1, 0])
            for which in (0, 1):
                after = _after(steps[lo:hi], ends[which])
                ends[which] = int(after[-1])
                if which:
                    ends[2] |= int((after == 0).any())
    names = ["file", "block", "from_out", "from_in", "closes"]
    keys = list(found)
    values = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
    values += [pa.array([found[k][n] for k in keys], pa.int32()) for n in range(3)]
    yield pa.RecordBatch.from_arrays(values, names)


# What a row of text is: a record, or the first, a middle or the last piece of one.
_WHOLE, _HEAD, _MIDDLE, _TAIL = range(4)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines joined to records; a split's open ends are pieces.  Holds the lines of one open record.

    A file's first record is its header and left out, or null if it is not whole.
    """
    names = ["file", "block", "part", "record"]
    here, state, held, inside, header = None, 0, [], False, False

    def rows(file, block, parts, texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(parts, pa.int32()), texts], names)

    def open_end():
        # ``inside`` still holds if the split began in a record and no line of it ended one
        if held:
            yield rows(*here, [_MIDDLE if inside else _HEAD], pa.array([None if header else "\n".join(held)], pa.string()))

    for batch in batches:
        steps, starts, lines = batch.column("step").to_numpy(), batch.column("start").to_numpy(), batch.column("line")
        for file, block, lo, hi in _splits(batch):
            if here != (file, block):
                yield from open_end()
                here, state, held = (file, block), int(starts[lo]), []
                inside, header = bool(state), block == 0
            after = _after(steps[lo:hi], state)
            state = int(after[-1])
            own, ends = lines.slice(lo, hi - lo), np.flatnonzero(after == 0)
            firsts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
            single = firsts == ends
            if len(ends) and (held or inside or header):
                single[0] = False
            if single.any():
                texts = own.take(pa.array(ends[single]))
                yield rows(file, block, [_WHOLE] * len(texts), texts)
            for first, end in zip(firsts[~single].tolist(), ends[~single].tolist()):
                text = "\n".join([*held, *own.slice(first, end - first + 1).to_pylist()])
                if not header:
                    yield rows(file, block, [_TAIL if inside else _WHOLE], pa.array([text], pa.string()))
                held, inside, header = [], False, False
            open_from = int(ends[-1]) + 1 if len(ends) else 0
            held += own.slice(open_from).to_pylist()
    if here is not None:
        yield from open_end()


def _starts(summed: DataFrame) -> DataFrame:
    """(file, block, start, owner): how each split starts, and the split where the record it starts in began."""
    step = (
        F.when(col("from_out") == col("from_in"), F.when(col("from_in") == 1, INSIDE).otherwise(OUTSIDE))
        .when(col("from_in") == 1, LEAVE)
        .otherwise(TURN)
    )
    upto = Window.partitionBy("file").orderBy("block")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    rows = summed.withColumn("_step", step).withColumn("_turns", F.sum((col("_step") == TURN).cast("int")).over(upto))
    fixed = F.when(col("_step") >= OUTSIDE, F.struct((col("_step") == INSIDE).cast("int").alias("s"), col("_turns").alias("t")))
    last, turns = F.last(fixed, ignorenulls=True).over(before), F.coalesce(F.last("_turns").over(before), F.lit(0))
    rows = rows.withColumn("_last", last).withColumn("_before", turns)
    start = F.pmod(F.coalesce(col("_last.s") + col("_before") - col("_last.t"), col("_before")), F.lit(2)).cast("int")
    rows = rows.withColumn("start", start)
    end = F.when(col("start") == 1, col("from_in")).otherwise(col("from_out"))
    began = F.when((end == 1) & ((col("start") == 0) | (col("closes") == 1)), col("block"))
    return rows.withColumn("_began", began).select("file", "block", "start", F.last("_began", ignorenulls=True).over(before).alias("owner"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): the records of CSV files as text, without each file's header and empty lines.

    Files are read in splits, however their records lie; a record's line breaks stay as they are.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        col("_metadata.file_path").alias("file"), col("_metadata.file_block_start").alias("block"), col("value").alias("line")
    )
    lines = lines.withColumn("step", _step(F.rtrim(col("line"), F.lit("\r"))).cast("int"))
    sums = "file string, block long, from_out int, from_in int, closes int"
    starts = _starts(lines.select("file", "block", "step").mapInArrow(_summed, sums))
    # a row per split
    placed = lines.join(F.broadcast(starts.select("file", "block", "start")), ["file", "block"])
    cut = placed.select("file", "block", "start", "step", "line").mapInArrow(_cut, "file string, block long, part int, record string")
    whole = cut.where(col("part") == _WHOLE).select("file", "block", "record")
    pieces = cut.where(col("part") != _WHOLE).join(F.broadcast(starts.select("file", "block", "owner")), ["file", "block"])
    began = F.when(col("part") == _HEAD, col("block")).otherwise(col("owner"))
    # a split leaves two pieces at most; those of a record are as many as the splits it crosses
    ordered = F.array_sort(F.collect_list(F.struct("block", "record")))
    no_header = F.bool_and(col("record").isNotNull()).alias("_kept")
    joined = pieces.groupBy("file", began.alias("block")).agg(no_header, F.array_join(ordered["record"], "\n").alias("record"))
    records = whole.unionByName(joined.where("_kept").drop("_kept"))
    bare = F.regexp_replace("record", r"\r\z", "")
    return records.select("file", bare.alias("record")).where(col("record") != "")
