"""Quoted CSV with line breaks inside fields, read by many tasks from one file.

Whether a line ends inside a quoted field depends on how it starts, so a block
of a file maps the state at its start (outside or inside a field) to the state
at its end.  A first pass finds this map and the number of records for both
starts, per block, in parallel; composing the maps in file order gives every
block's true start and the number of records before it.  The second pass cuts
records at true line ends.  A record that crosses blocks arrives in pieces,
which are put together by its number; all others never leave their task.

The record numbers are the rows' order over all files (by path, then place),
whatever the split size and the number of tasks, and serve as row keys.

The driver holds one small entry per block (by default 128 MB of file).
Blank lines between records are skipped, as pandas does; every file has a
header.  A record with fewer fields than the header is filled with missing
values, one with more is cut.  A file that ends inside a field is refused.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WHOLE = re.compile(r'(?:^|(?<=,))"(?:[^"]++|"")*+"[^,]*+')
_OPEN = re.compile(r'(?:^|,)"')
_REST = re.compile(r'(?:[^"]++|"")*+"[^,]*+')


class CsvTextError(ValueError):
    pass


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the line's end; a quote within a plain field is text."""
    if '"' not in line:
        return inside
    if inside:
        closed = _REST.match(line)
        if not closed:
            return True
        line = line[closed.end():]
    return bool(_OPEN.search(_WHOLE.sub("", line)))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _blocks(lines: DataFrame) -> list[tuple]:
    """(file, start, (records, end state) if the block starts outside, the same if inside) of every block, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": now[0], "start": now[1], "n0": state[0][0], "e0": state[0][1],
                                                "n1": state[1][0], "e1": state[1][1]}])

        for batch in batches:
            for f, s, value in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (f, s) != now:
                    if now:
                        yield row()
                    now, state = (f, s), [[0, False], [0, True]]
                for v in state:
                    began_outside = not v[1]
                    v[1] = ends_inside(value, v[1])
                    v[0] += not v[1] and not (began_outside and not value.rstrip("\r"))
        if now:
            yield row()

    parts = lines.mapInArrow(run, "file string, start long, n0 long, e0 boolean, n1 long, e1 boolean").collect()
    return sorted((r["file"], r["start"], (r["n0"], r["e0"]), (r["n1"], r["e1"])) for r in parts)


def _starts(blocks: list[tuple]) -> dict[tuple, tuple[bool, int]]:
    """(file, start) -> (starts inside a field, records before the block in its file, data rows before its file)."""
    out, file, base, inside, before = {}, None, 0, False, 0
    for f, s, outside_start, inside_start in blocks:
        if f != file:
            if inside:
                raise CsvTextError(f"{file} ends inside a quoted field")
            base += max(before - 1, 0) if file is not None else 0
            file, inside, before = f, False, 0
        out[f, s] = inside, before, base
        n, end = inside_start if inside else outside_start
        before, inside = before + n, end
    if inside:
        raise CsvTextError(f"{file} ends inside a quoted field")
    return out


def _fields(record: str, width: int) -> list[str | None]:
    row = next(csv.reader([record], strict=False), [])
    return (row + [None] * (width - len(row)))[:width]


def read_blocks(spark: SparkSession, path: str | list[str], names: list[str], key: str = "row") -> DataFrame:
    """Text columns ``names`` and the rows' numbers from 0 in ``key``, over all files in path order."""
    starts = _starts(_blocks(_lines(spark, path)))
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, held, inside, base, open_before, index = None, 0, [], False, 0, False, 0
        rows: list[tuple] = []

        def piece(text: str) -> tuple:
            return now[0], number, base + number - 1, now[1], text, None

        for batch in batches:
            for f, s, value in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (f, s) != now:
                    if held:
                        rows.append(piece("\n".join(held)))
                    now, held = (f, s), []
                    inside, number, base = starts[now]
                    open_before = inside  # the record began in an earlier block
                was, inside = inside, ends_inside(value, inside)
                if not was and not inside and not value.rstrip("\r"):
                    continue
                held.append(value)
                if inside:
                    continue
                record = "\n".join(held)
                if open_before:
                    rows.append(piece(record))
                elif number > 0:
                    rows.append((now[0], number, base + number - 1, now[1], None, _fields(record.rstrip("\r"), width)))
                number, held, open_before = number + 1, [], False
            yield table(rows)
            rows = []
        if held:
            rows.append(piece("\n".join(held)))
        yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          ["file", "number", "row", "start", "piece", "fields"])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [_fields(t.rstrip("\r"), width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fields, pa.list_(pa.string()))], ["row", "fields"])

    cut = _lines(spark, path).mapInArrow(
        run, "file string, number long, row long, start long, piece string, fields array<string>")
    whole = cut.where("piece is null").select("row", "fields")
    # at most two pieces a block; a record's pieces in order of their blocks
    joined = (cut.where("piece is not null").groupBy("file", "number", "row")
              .agg(F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("p")).where("number > 0")
              .select("row", F.array_join("p.piece", "\n").alias("text")).mapInArrow(parsed, "row long, fields array<string>"))
    rows = whole.unionByName(joined)
    return rows.select(F.col("row").alias(key), *[F.col("fields")[k].alias(n) for k, n in enumerate(names)])
