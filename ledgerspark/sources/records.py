"""CSV records that may span lines, read from splits of a file (SRC3).

A split starts anywhere in a file, so whether its first byte stands inside quotes is not known by itself. Two passes
find out without reading a file in one task:

1. Each split is a function from the state at its first byte to the state after its last one (four states: at a
   field's start, in a plain field, in quotes, after a quote within quotes). All splits are read in parallel; a row of four
   numbers each comes out.
2. The functions of a file's splits, applied one after another, give the state at the start of every split (a fold over
   one small row per split). With it each task finds the records that begin in its split, and reads on behind
   its end to finish the last one.

The records go to Spark's own CSV parser (``from_csv``). A quote within a plain field is text, as CSV readers take it.
Only files with a line of an odd number of quotes take this way; all others are scanned as split text directly.

A task holds one split (``SPLIT_BYTES``) and the record that runs over its end. A quote that is still open at the end of
a file is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
MAX_TASKS = 100_000

# States of the CSV automaton.
FIELD_START, PLAIN, QUOTED, AFTER_QUOTE = range(4)
_OPENING = re.compile(rb'[,\r\n]"')
_BOM = b"\xef\xbb\xbf"


def files_with_open_lines(spark: SparkSession, paths: list[str]) -> set[str]:
    """The files that hold a line with an odd number of quotes: one scan of split text, the file names of such lines come back."""
    if not paths:
        return set()
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    found = lines.where(quotes % 2 == 1).select("path").distinct()
    return {_listed_path(r.path) for r in found.collect()}


def _plain_path(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def _listed_path(path: str) -> str:
    """A path of ``_metadata``, which is percent-encoded, as listings name it."""
    return _plain_path(unquote(path))


def same_file(path: str, paths: set[str]) -> bool:
    return _plain_path(path) in paths


def walk(data: bytes, state: int) -> tuple[np.ndarray, int]:
    """Positions of the line ends that end a record, and the state after the last byte."""
    inside: list[int] = []  # starts and ends of the quoted stretches, in turn
    at, n = 0, len(data)
    if state == AFTER_QUOTE and n:
        if data[:1] == b'"':
            at, state = 1, QUOTED
        else:
            state = PLAIN
    if state == FIELD_START and data[:1] == b'"':
        at, state = 1, QUOTED
    if state == QUOTED:
        inside.append(0)
    while at < n:
        if state == QUOTED:
            close = data.find(b'"', at)
            if close < 0:
                at = n
            elif close + 1 == n:
                at, state = n, AFTER_QUOTE
            elif data[close + 1:close + 2] == b'"':
                at = close + 2
            else:
                at, state = close + 1, PLAIN
                inside.append(at)
        else:
            m = _OPENING.search(data, at)
            if m is None:
                state = FIELD_START if data[-1:] in (b",", b"\r", b"\n") else PLAIN
                at = n
            else:
                at, state = m.end(), QUOTED
                inside.append(at)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    if inside:  # a line end is outside quotes if an even number of limits stands before it
        ends = ends[np.searchsorted(np.array(inside), ends, "right") % 2 == 0]
    return ends, state


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from ledgerspark.sources.files import open_input

    for batch in batches:
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
            with open_input(path) as f:
                f.seek(start)
                data = _without_mark(f.read(end - start), start)
            after = [walk(data, s)[1] for s in (PLAIN, QUOTED)]
            opened = walk(data, FIELD_START)[1] if data[:1] == b'"' else after[0]
            closed = walk(data, AFTER_QUOTE)[1] if data[:1] == b'"' else after[0]
            yield pa.RecordBatch.from_pydict({"path": [path], "start": [start], "end": [end],
                                              "after": pa.array([[opened, *after, closed]], pa.list_(pa.int32()))})


def split_states(listing: DataFrame, split_bytes: int | None = None) -> DataFrame:
    """``path, start, end, state``: the splits of the listed files and the automaton's state at the start of each."""
    size = split_bytes or SPLIT_BYTES
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)).cast("long"), F.lit(size).cast("long"))
    splits = listing.where("length > 0").select("path", "length", F.explode(starts).alias("start")).select(
        "path", "start", F.least(F.col("start") + size, "length").alias("end"))
    moves = _spread(splits).mapInArrow(_passages, "path string, start long, end long, after array<int>")
    one = F.struct("start", "end", "after")
    files = moves.groupBy("path").agg(F.array_sort(F.collect_list(one)).alias("splits"))  # one small entry per split
    kind = "array<struct<start:bigint,end:bigint,state:int>>"

    def step(acc: Column, s: Column) -> Column:
        entry = F.struct(s["start"].alias("start"), s["end"].alias("end"), acc["state"].alias("state"))
        return F.struct(F.get(s["after"], acc["state"]).alias("state"), F.array_append(acc["found"], entry).alias("found"))

    first = F.struct(F.lit(FIELD_START).alias("state"), F.array().cast(kind).alias("found"))
    return files.select("path", F.inline(F.aggregate("splits", first, step, lambda acc: acc["found"])))


def _spread(splits: DataFrame) -> DataFrame:
    """One task per split; an explicit number, as small rows would be put together otherwise."""
    return splits.repartition(max(1, min(splits.count(), MAX_TASKS)))


def records(listing: DataFrame, split_bytes: int | None = None) -> DataFrame:
    """``path, block, pos, value``: every record but the header of each listed file; ``pos`` is its first byte's place."""
    from ledgerspark.session import ship_package

    ship_package(listing.sparkSession)
    states = _spread(split_states(listing, split_bytes))
    return states.mapInArrow(_records, "path string, block long, pos long, value string")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from ledgerspark.sources.files import open_input

    for batch in batches:
        for path, start, end, state in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end", "state"))):
            with open_input(path) as f:
                rows, size = [], 0
                for pos, raw in _records_of(f, path, start, end, state):
                    rows.append((pos, raw.decode("utf-8", "replace")))
                    size += len(raw)
                    if size >= BATCH_BYTES:
                        yield _batch(path, start, rows)
                        rows, size = [], 0
                yield _batch(path, start, rows)


def _batch(path: str, start: int, rows: list[tuple[int, str]]) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([start] * n, pa.int64()),
                                       pa.array([p for p, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.string())],
                                      names=["path", "block", "pos", "value"])


def _records_of(f, path: str, start: int, end: int, state: int) -> Iterator[tuple[int, bytes]]:
    """The records that begin in a split, each with the place of its first byte; blank ones and the header are left out."""
    f.seek(max(start - 1, 0))
    before = f.read(1) if start else b"\n"
    data = f.read(end - start)
    ends, after = walk(_without_mark(data, start), state)
    # a record begins behind each record end; also at the split's start if one ends right before it
    begins = ends + 1 if start and (before != b"\n" or state != FIELD_START) else np.concatenate([[0], ends + 1])
    begins = begins[begins < len(data)]
    if not len(begins):
        return
    last, header = int(begins[-1]), start == 0
    stops = ends[np.searchsorted(ends, begins[:-1], "left")]
    for at, stop in zip([*begins[:-1].tolist(), last], [*stops.tolist(), -1]):
        if at < last:
            raw = data[at:stop].removesuffix(b"\r")
        else:
            raw = _finish(f, path, data[last:], after, bool(len(ends)) and int(ends[-1]) >= last)
        if header:  # the header is the first record with a cell that is not blank
            header = not _named(raw)
        elif raw:
            yield start + at, raw


def _without_mark(data: bytes, start: int) -> bytes:
    """The bytes with a byte order mark at a file's start taken for field ends, so that a quote may follow."""
    return b",,," + data[3:] if start == 0 and data.startswith(_BOM) else data


def _finish(f, path: str, raw: bytes, state: int, complete: bool) -> bytes:
    """The last record of a split, read on behind the split's end unless it is complete."""
    parts = [raw]
    while not complete:
        more = f.read(1 << 20)
        if not more:
            if state == QUOTED:
                raise ValueError(f"quote left open at the end of {path}")
            break
        ends, state = walk(more, state)
        complete = bool(len(ends))
        parts.append(more[:int(ends[0])] if complete else more)
    return b"".join(parts).removesuffix(b"\n").removesuffix(b"\r")


def _named(raw: bytes) -> bool:
    """Whether a record can be the header: some cell of it is not blank."""
    return bool(raw.removeprefix(_BOM).replace(b",", b"").replace(b'"', b"").strip())
