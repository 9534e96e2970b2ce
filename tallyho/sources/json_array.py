"""Snapshot files of any layout and size: one array on one line, arrays over many
lines, or an object a line.

A file is cut by Spark's line reader, with the closing brace as the line's end,
so every byte range of a file is a split of its own, also of a single line. What
a record does to the state at its place (inside a string or not, braces open)
can be told without knowing that state, for both possible ones; so the splits
are summarised in parallel, the summaries (one row a split) are combined from the
start of each file, and the splits are read again, each from its known state.
Objects that end in the split that they began in are whole; the parts of the
others are joined by the place where they began.
"""

from __future__ import annotations

import sys as _sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.elements import Broken, Segments, Summary, trailer

# Travels to the Python workers by value, like the scanners.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


def _records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).selectExpr(
        "value", "_metadata.file_path AS path", "_metadata.file_block_start AS block", "_metadata.file_size AS size")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, Iterator[str]]]:
    """(path, block, file size, records) of every run of one split's rows, batch by batch."""
    for b in batches:
        keys = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()))
        values, start = b.column(0).to_pylist(), 0
        while start < len(keys):
            end = start + 1
            while end < len(keys) and keys[end] == keys[start]:
                end += 1
            yield (*keys[start], values[start:end])
            start = end


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], list] = {}
    for path, block, size, records in _by_split(batches):
        now = found.setdefault((path, block), [size, 0, 0, None, Summary()])
        for r in records:
            if now[3] is not None:
                now[4].add(now[3])
            now[3] = r  # the last record of a file has no brace behind it: kept apart
            now[1] += len(r.encode()) + 1
            now[2] += 1
    rows = []
    for (path, block), (size, length, n, last, summary) in found.items():
        before = [list(s) for s in summary.state]
        summary.add(last)
        rows.append((path, block, size, length, n, [[int(x) for x in s] for s in before], [[int(x) for x in s] for s in summary.state]))
    cols = list(zip(*rows)) or [()] * 7
    table = pa.list_(pa.list_(pa.int64()))
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), table, table)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["path", "block", "size", "length", "n", "cut", "whole"])


def entry_states(splits: list) -> dict[tuple[str, int], tuple[bool, int, int, int]]:
    """(path, block) → (inside a string, open braces, the split where the open object began,
    its records that end in a brace) from the splits' summaries."""
    out = {}
    for path in sorted({s["path"] for s in splits}):
        own = sorted((s for s in splits if s["path"] == path), key=lambda s: s["block"])
        # records and their braces make up the file, but for the brace that the last one lacks
        open_end = sum(s["length"] for s in own) - own[0]["size"] not in (0, -3)
        in_string, depth, origin = False, 0, own[0]["block"]
        for i, s in enumerate(own):
            bare = open_end and i == len(own) - 1
            if not (in_string or depth):
                origin = s["block"]
            out[path, s["block"]] = (in_string, depth, origin, s["n"] - bare)
            inside, change, least = (s["cut"] if bare else s["whole"])[int(in_string)]
            if depth + least <= 0:  # the open object ends here: what is open at the end began here
                origin = s["block"]
            in_string, depth = bool(inside), depth + change
        if in_string or depth:
            raise Broken(f"{path} ends within an object")
    return out


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, n, json): the text of every object (null: a ``null`` element) of the files
    below ``path``, ``path, block, n`` being its place in file order."""
    records = _records(spark, path)
    summary = "path string, block long, size long, length long, n long, cut array<array<long>>, whole array<array<long>>"
    # one row a split, of which the driver has planned every one
    states = entry_states(records.mapInArrow(_summarise, summary).collect())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, scan, done, n, origin, braces = None, None, 0, 0, 0, 0

        def batch(rows):
            cols = list(zip(*rows)) or [()] * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["path", "block", "n", "part", "json"])

        def left():
            """The object that is open where the split ends, as a part."""
            rest = scan.rest() if scan else None
            if rest is None:
                return []
            return [(now[0], origin if rest[0] else now[1], None, now[1], rest[1])]

        for file, block, _, values in _by_split(batches):
            rows = []
            if now != (file, block):
                rows += left()
                now, n, done = (file, block), 0, 0
                in_string, depth, origin, braces = states[now]
                scan = Segments(in_string, depth)
            for v in values:
                done += 1
                if done > braces:
                    found = [(False, None)] * trailer(v)
                else:
                    found = scan.add(v)
                for before, text in found:
                    rows.append((file, origin, None, block, text) if before else (file, block, n, None, text))
                    n += 1
            yield batch(rows)
        yield batch(left())

    d = records.mapInArrow(read, "path string, block long, n long, part long, json string")
    whole = d.where("n IS NOT NULL").select("path", "block", "n", "json")
    # an object over several splits: it comes after all others of the split where it began
    parts = (d.where("n IS NULL").groupBy("path", "block").agg(F.expr("array_sort(collect_list(struct(part, json))) AS x"))
             .selectExpr("path", "block", f"{(1 << 62)} AS n", "array_join(transform(x, p -> p.json), '') AS json"))
    return whole.unionByName(parts)
