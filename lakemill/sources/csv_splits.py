"""Quoted CSV of which one file is many tasks, although line feeds may stand inside quotes.

Whether a line starts a record depends on all quotes before it in the file. What a line does to that is a function of
two states, outside or inside a quoted field, and such functions compose: each split of a file sums up its lines for
both states it may begin in, window functions over the splits (a row each) say in which one it does, and lines then take
the answer that holds. Records on one line, nearly all of them, are parsed where they are; lines of longer ones meet by record.

As in the usual dialect, only a quote at a field's start opens it, a doubled quote stands for one, and text after a
closing quote belongs to the field. Blank lines between records are skipped. A quote that never closes makes the rest of its file one record.
"""

from __future__ import annotations

import csv
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ends_inside(line: str, inside: bool, delimiter: str) -> bool:
    """Whether a quoted field is open after ``line``, if one was open before it or not."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == '"':
                at += 2
                continue
            inside, at = False, at + 1
            at = line.find(delimiter, at)
            if at < 0:
                return False
            at += 1
        if line[at : at + 1] == '"':
            inside, at = True, at + 1
            continue
        at = line.find(delimiter + '"', at)
        if at < 0:
            return False
        inside, at = True, at + 2


class _Block:
    """A split of a file while its lines pass; everything for both states it may begin in."""

    def __init__(self):
        self.lines, self.state, self.record, self.ordinal = 0, [0, 1], [-1, -1], [0, 0]

    def take(self, lines: pa.Array, delimiter: str):
        """For each line: whether it leaves a field open if none was, then by initial state its own state, its record's first line and ordinal."""
        n = len(lines)
        after = np.zeros(n, np.int8), np.ones(n, np.int8)
        for k in np.flatnonzero(pa.compute.match_substring(lines, '"').to_numpy(zero_copy_only=False)):
            text = lines[int(k)].as_py()
            for s in (0, 1):
                after[s][k] = ends_inside(text, bool(s), delimiter)
        blank = pa.compute.is_in(lines, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
        settled, swaps = after[0] == after[1], np.cumsum((after[0] == 1) & (after[1] == 0))
        last = np.maximum.accumulate(np.where(settled, np.arange(n), -1))
        out = [after[0] == 1]
        for s in (0, 1):
            base = np.where(last >= 0, after[0][last], self.state[s])
            ends = base ^ ((swaps - np.where(last >= 0, swaps[last], 0)) & 1)
            own = np.concatenate([[self.state[s]], ends[:-1]])
            starts = own == 0
            record = np.maximum(np.maximum.accumulate(np.where(starts, self.lines + np.arange(n), -1)), self.record[s])
            ordinal = self.ordinal[s] + np.cumsum(starts & ~blank)
            self.state[s], self.record[s], self.ordinal[s] = int(ends[-1]), int(record[-1]), int(ordinal[-1])
            out += [own == 1, record, ordinal]
        self.lines += n
        return out


def _segments(batch: pa.RecordBatch):
    """(path, block, lines) of each run of one split in a batch."""
    path, block = batch.column(0), batch.column(1)
    if not batch.num_rows:
        return
    differs = pa.compute.or_(pa.compute.not_equal(path[1:], path[:-1]), pa.compute.not_equal(block[1:], block[:-1]))
    edges = [0, *(np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    for a, z in zip(edges, edges[1:]):
        yield path[a].as_py(), block[a].as_py(), batch.column(2).slice(a, z - a)


_BLOCKS = "path string, block long, lines long, e0 long, e1 long, r0 long, r1 long, o0 long, o1 long"
_LINES = "path string, block long, n long, line string, opens boolean, s0 boolean, r0 long, o0 long, s1 boolean, r1 long, o1 long"


def _summed(lines: DataFrame, delimiter: str) -> DataFrame:
    def run(batches):
        now, state = None, None
        for path, block, part in chain.from_iterable(map(_segments, batches)):
            if now != (path, block):
                if now:
                    yield row(now, state)
                now, state = (path, block), _Block()
            state.take(part, delimiter)
        if now:
            yield row(now, state)

    def row(now, b):
        values = [*now, b.lines, *b.state, *b.record, *b.ordinal]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], [c.split()[0] for c in _BLOCKS.split(", ")])

    return lines.mapInArrow(run, _BLOCKS)


def _followed(lines: DataFrame, delimiter: str) -> DataFrame:
    def run(batches):
        now, state = None, None
        for path, block, part in chain.from_iterable(map(_segments, batches)):
            if now != (path, block):
                now, state = (path, block), _Block()
            n, m = state.lines, len(part)
            columns = [pa.array([path] * m), pa.array(np.full(m, block)), pa.array(np.arange(n, n + m)), part, *[pa.array(x) for x in state.take(part, delimiter)]]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _LINES.split(", ")])

    return lines.mapInArrow(run, _LINES)


def _placed(blocks: DataFrame) -> DataFrame:
    """(p, b, inside, before, earlier, carried): how each split begins, lines and records before it, and the line of the record that it begins in."""
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    settled, swap = F.col("e0") == F.col("e1"), ((F.col("e0") == 1) & (F.col("e1") == 0)).cast("long")
    rows = blocks.withColumn("swaps", F.coalesce(F.sum(swap).over(earlier), F.lit(0)))
    base = F.coalesce(F.last(F.when(settled, F.col("e0")), ignorenulls=True).over(earlier), F.lit(0))
    since = F.col("swaps") - F.coalesce(F.last(F.when(settled, F.col("swaps")), ignorenulls=True).over(earlier), F.lit(0))
    rows = rows.withColumn("inside", ((base + since) % 2) == 1)
    own = lambda x: F.when(F.col("inside"), F.col(f"{x}1")).otherwise(F.col(f"{x}0"))
    rows = rows.withColumns({"before": F.coalesce(F.sum("lines").over(earlier), F.lit(0)), "o": own("o"), "r": own("r")})
    rows = rows.withColumn("last", F.when(F.col("r") >= 0, F.col("before") + F.col("r")))
    carried, records = F.last("last", ignorenulls=True).over(earlier), F.coalesce(F.sum("o").over(earlier), F.lit(0))
    return rows.select(F.col("path").alias("p"), F.col("block").alias("b"), "inside", "before", records.alias("earlier"), carried.alias("carried"))


def _fields(records: DataFrame, delimiter: str) -> DataFrame:
    def parsed(texts: list[str]) -> list[list[str]]:
        csv.field_size_limit(1 << 31)
        try:
            found = list(csv.reader(texts, delimiter=delimiter))
            if len(found) == len(texts):
                return found
        except csv.Error:
            pass  # a carriage return outside of quotes
        return [next(csv.reader([t.replace("\r", " ")], delimiter=delimiter), []) for t in texts]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(parsed(part.column(2).to_pylist()), pa.list_(pa.string()))], ["path", "ordinal", "fields"])

    return records.mapInArrow(run, "path string, ordinal long, fields array<string>")


def header(spark: SparkSession, path: str, delimiter: str, most: int = 1000) -> list[str]:
    """Names of the first record, of a path's first file; columns without a name get ``_c`` and their number."""
    held, inside = [], False
    for r in spark.read.text(path, lineSep="\n").limit(most).collect():
        line = r["value"]
        if not held and line in ("", "\r"):
            continue
        held.append(line)
        inside = ends_inside(line, inside, delimiter)
        if not inside:
            break
    names = next(csv.reader(["\n".join(held).removesuffix("\r").removeprefix("﻿")], delimiter=delimiter), [])
    return [n or f"_c{k}" for k, n in enumerate(names)]


def read_records(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """All columns as strings, with __path, __file and __row, the record's number in its file. What short records lack is empty, what long ones
    have too much is left out; of columns of one name the last counts. Files of one read have the same header."""
    names = header(spark, path, delimiter)
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    placed = _placed(_summed(lines, delimiter))
    rows = _followed(lines, delimiter).join(placed, (F.col("path") == F.col("p")) & (F.col("block") == F.col("b")))
    own = lambda x: F.when(F.col("inside"), F.col(f"{x}1")).otherwise(F.col(f"{x}0"))
    rows = rows.select(
        "path", "line", (F.col("before") + F.col("n")).alias("number"), (~own("s") & ~F.col("opens")).alias("whole"), (F.col("earlier") + own("o")).alias("ordinal"),
        F.when(own("r") >= 0, F.col("before") + own("r")).otherwise(F.col("carried")).alias("record"),
    )
    single = rows.where("whole").select("path", "ordinal", "line")
    several = rows.where("not whole").groupBy("path", "record").agg(F.min("ordinal").alias("ordinal"), F.array_sort(F.collect_list(F.struct("number", "line"))).alias("lines"))
    joined = several.select("path", "ordinal", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("line"))
    records = single.where("line not in ('', '\\r')").union(joined).where("ordinal > 1").withColumn("line", F.regexp_replace("line", r"\r$", ""))
    at = {n: k for k, n in enumerate(names)}
    columns = [F.coalesce(F.get("fields", F.lit(k)), F.lit("")).alias(n) for n, k in at.items()]
    place = [F.col("path").alias("__path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("__file"), (F.col("ordinal") - 1).alias("__row")]
    return _fields(records, delimiter).select(*columns, *place)
