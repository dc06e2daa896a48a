"""Landing-folder operators: listing, name filters, new files, intake check (SRC9-SRC11).

Listings are DataFrames produced by Spark's ``binaryFile`` source with the
``content`` column pruned, so they work on any Hadoop-compatible file system
and never read file bodies. The intake check is the one step that reads bodies
(size, ZIP magic, CRC of every member): runs of members are verified by separate tasks, as streams.
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

# Intake rules.
MIN_WORKBOOK_BYTES = 10240
ZIP_MAGIC = b"PK\x03\x04"
PARTIAL_DOWNLOAD_SUFFIX = ".crdownload"
ACCEPTED_SUFFIXES = (".xlsx", ".csv")
INTAKE_SCHEMA = "path string, length bigint, ok boolean, reason string"


def list_landing(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Files under ``path`` as ``(path, name, length, modificationTime)``; empty if the path does not exist."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, name string, length bigint, modificationTime timestamp")
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def list_files(spark: SparkSession, path: str, suffix: str | None = None) -> list[str]:
    """Paths of the files under ``path`` (a file or a folder of parts), sorted.

    Collects one short string per file: planning needs the list, e.g. to group
    files by header signature.
    """
    listing = landing_filter(list_landing(spark, path), suffixes=(suffix,) if suffix else None)
    return sorted(r.path for r in listing.select("path").collect())


def landing_filter(listing: DataFrame, suffixes: tuple[str, ...] | None = ACCEPTED_SUFFIXES,
                   prefix: str | None = None, contains: str | None = None) -> DataFrame:
    """SRC10: accept files by name; partial downloads and Spark markers are ignored."""
    name = F.col("name")
    cond = ~name.endswith(PARTIAL_DOWNLOAD_SUFFIX) & ~name.startswith("_") & ~name.startswith(".")
    if suffixes:
        any_suffix = F.lit(False)
        for s in suffixes:
            any_suffix = any_suffix | F.lower(name).endswith(s.lower())
        cond = cond & any_suffix
    if prefix:
        cond = cond & name.startswith(prefix)
    if contains:
        cond = cond & F.contains(name, F.lit(contains))
    return listing.where(cond)


def new_files_since(before: DataFrame, after: DataFrame) -> DataFrame:
    """SRC11: files in the later listing that were not in the earlier one (left anti join)."""
    return after.join(before.select("path"), "path", "left_anti")


# What one task verifies: members of at least this many compressed bytes together (a larger member is a unit of its own).
UNIT_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20
MAX_UNIT_TASKS = 10_000
_UNIT_SCHEMA = "path string, length bigint, first bigint, last bigint, reason string"
_UNREADABLE = (zipfile.BadZipFile, OSError, EOFError, ValueError, NotImplementedError)


def _units(path: str, length: int) -> Iterator[tuple]:
    """Runs of members of one workbook, from its central directory alone; or one row with the reason it is refused."""
    from ledgerspark.sources.files import open_input

    if length < MIN_WORKBOOK_BYTES:
        yield path, length, 0, 0, "too_small"
        return
    with open_input(path) as f:
        if f.read(len(ZIP_MAGIC)) != ZIP_MAGIC:
            yield path, length, 0, 0, "not_zip"
            return
        f.seek(0)
        try:
            with zipfile.ZipFile(f) as zf:
                sizes = [m.compress_size for m in zf.infolist()]
        except _UNREADABLE:
            yield path, length, 0, 0, "bad_zip"
            return
    first, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= UNIT_BYTES:
            yield path, length, first, i + 1, "ok"
            first, held = i + 1, 0
    if first < len(sizes) or not sizes:
        yield path, length, first, len(sizes), "ok"


def _verify(path: str, first: int, last: int) -> tuple[int, str]:
    """The first member of the run that does not read back with its CRC, by its place and the reason; members are streamed."""
    from ledgerspark.sources.files import open_input

    with open_input(path) as f:
        try:
            with zipfile.ZipFile(f) as zf:
                for i, member in enumerate(zf.infolist()[first:last], first):
                    try:
                        with zf.open(member) as part:
                            while part.read(CHUNK_BYTES):
                                pass
                    except (zipfile.BadZipFile, zlib.error, EOFError):
                        return i, f"bad_crc:{member.filename}"
        except (*_UNREADABLE, RuntimeError):
            return first, "bad_zip"
    return last, "ok"


def _unit_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [u for path, n in zip(pdf["path"], pdf["length"]) for u in _units(path, int(n))]
        yield pd.DataFrame(rows, columns=["path", "length", "first", "last", "reason"])


def _verified_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [_verify(p, int(a), int(z)) if r == "ok" else (int(a), r)
                 for p, a, z, r in zip(pdf["path"], pdf["first"], pdf["last"], pdf["reason"])]
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "first": [i for i, _ in found], "last": pdf["last"],
                            "reason": [r for _, r in found]})


def intake_check(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """SRC9: every workbook under ``path`` -> ``(path, length, ok, reason)``.

    A workbook is accepted when it has at least 10,240 bytes, starts like a ZIP
    archive and every member passes its CRC check; else the first reason in the order of its members counts. The central
    directory (ZIP64 too) is read by ranges and cuts a workbook into runs of members, which are verified by
    separate tasks; members are streamed in chunks, so no task's memory grows with a file.
    """
    from ledgerspark.session import ship_package

    ship_package(spark)
    files = list_landing(spark, path, glob).where(~F.col("path").endswith(PARTIAL_DOWNLOAD_SUFFIX)).select("path", "length")
    units = _dealt(files).mapInPandas(_unit_batches, _UNIT_SCHEMA)
    checked = _dealt(units).mapInPandas(_verified_batches, _UNIT_SCHEMA)
    bad = F.col("reason") != "ok"
    return checked.groupBy("path", "length").agg(F.min_by(F.when(bad, F.col("reason")), F.when(bad, F.col("first"))).alias("_bad")).select(
        "path", "length", F.col("_bad").isNull().alias("ok"), F.coalesce("_bad", F.lit("ok")).alias("reason"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Few small rows over as many tasks as there are, by an explicit number: each stands for much work."""
    return rows.repartition(max(1, min(rows.count(), MAX_UNIT_TASKS)))
