"""Streaming refresh of the reports (STR1-STR4).

* STR1 ``watch_landing``: a checkpointed file stream over the landing folder
  (``binaryFile`` with the content pruned), by default only ``*.xlsx`` files at
  the top level, as the original monitor did.
* STR2 ``newest_versions``: a file stream never re-reads a modified file under
  the same path, so a versioned landing puts every new version under a new path
  (``.../ledger=<name>/load_ts=<ts>/...``); the newest ``load_ts``, as a time, per ledger wins.
  For a flat landing, whose files are overwritten in place, ``landing_events`` is a stream whose
  offset is the listing (path, modification time, length); ``landing_changes`` compares two listings in a batch job.
* STR3 ``refresh_report``: every micro-batch with new files recomputes the
  report into a folder of its own and appends one row to a refresh log (batch id, files,
  outcome); readers take the newest successful one (``published``), so a failed run
  leaves the last good report in place.
* STR4: ``incremental.unified_changes`` keeps the unified report up to date with a stateful operator per document.
  ``incremental_report`` here takes any report with one streaming aggregation instead: it compares each
  micro-batch's rows with the last emitted ones, which it reads back. Either way ``current_status`` folds the change
  log to the latest row per document, and "first" is decided by the ledgers' order keys, not by arrival.

State and checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerspark.operators.reconcile import DOC

# What triggers a refresh, and the log layout.
WATCHED_GLOB = "*.xlsx"
REFRESH_LOG_SCHEMA = "files bigint, ok boolean, message string, at timestamp"
BATCH_COLUMN = "batch_id"
REFRESH_COLUMN = "refresh"
SNAPSHOT_COLUMN = "upto"
COMPACT_EVERY = 20
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


class RefreshFailed(RuntimeError):
    """A refresh that is to be repeated did not succeed; its log row says why."""


def watch_landing(spark: SparkSession, folder: str, glob: str = WATCHED_GLOB, recursive: bool = False) -> DataFrame:
    """STR1: new files of the landing folder as a stream of ``(path, name, length, modificationTime)``."""
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
              .option("recursiveFileLookup", recursive).load(folder))
    return stream.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length",
                         "modificationTime")


def load_time(text: Column) -> Column:
    """The time a ``load_ts`` folder name stands for: compact or ISO date and time, or seconds since 1970."""
    plain = F.regexp_replace(F.replace(text, F.lit("%3A"), F.lit(":")), r"\.\d+$", "")
    layouts = ("yyyyMMddHHmmss", "yyyyMMdd'T'HHmmss", "yyyyMMddHHmm", "yyyyMMdd")
    return F.coalesce(*(F.try_to_timestamp(F.when(F.length(plain) == len(p.replace("'", "")), plain), F.lit(p)) for p in layouts),
                      F.timestamp_seconds(F.when(F.length(plain) <= 11, plain).try_cast("bigint")), plain.try_cast("timestamp"))


def newest_versions(listing: DataFrame) -> DataFrame:
    """STR2: keep the files of the newest ``load_ts`` of each ``ledger`` (versioned landing layout).

    Names that are no time come before all times; equal times are told apart by the name.
    """
    with_keys = listing.select(
        "*",
        F.regexp_extract("path", r"ledger=([^/]+)", 1).alias("ledger"),
        F.regexp_extract("path", r"load_ts=([^/]+)", 1).alias("load_ts"),
    )
    newest = with_keys.groupBy("ledger").agg(
        F.max(F.struct(load_time(F.col("load_ts")).alias("at"), "load_ts")).alias("v")).select("ledger", "v.load_ts")
    return with_keys.join(newest, ["ledger", "load_ts"], "left_semi")


def newest_version_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """STR2 for planning: ``{ledger: folder of its newest load}`` under a versioned landing root.

    One row per ledger reaches the driver.
    """
    from ledgerspark.sources.landing import list_landing

    newest = newest_versions(list_landing(spark, root)).select("ledger", "load_ts").distinct()
    base = root.rstrip("/")
    return {r.ledger: f"{base}/ledger={r.ledger}/load_ts={r.load_ts}" for r in newest.collect()}


LISTED = ["path", "modificationTime", "length"]


def landing_changes(spark: SparkSession, folder: str, state: str, glob: str = WATCHED_GLOB,
                    recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Files of a flat landing that are new or overwritten since ``remember_landing``, and the listing itself."""
    from ledgerspark.sources.landing import landing_filter, list_landing

    now = landing_filter(list_landing(spark, folder, glob=glob, recursive=recursive), suffixes=None).select(*LISTED)
    seen = _read_or_none(spark, state)
    if seen is None:
        return now, now
    newest = seen.groupBy("at").count().agg(F.max("at").alias("at"))
    return now.join(seen.join(F.broadcast(newest), "at").select(*LISTED), LISTED, "left_anti"), now


def remember_landing(listing: DataFrame, state: str) -> None:
    """Record a listing as the one of the last refresh (a new folder; the newest counts)."""
    import time

    listing.write.parquet(f"{state}/at={time.time_ns()}")


def refresh_report(files: DataFrame, build: Callable[[SparkSession], DataFrame], output: str, log: str,
                   checkpoint: str, trigger: dict | None = None, retry: bool = False) -> StreamingQuery:
    """STR3: recompute ``build(spark)`` whenever new files arrive, into ``output/refresh=<batch>``; log the run.

    ``build`` plans the report over the landing folder (a batch job); failures
    are logged, not raised, so the watcher keeps running like the original
    monitor, and ``published`` goes on naming the last good result. With ``retry`` a failure also ends
    the stream, whose next start repeats the micro-batch.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        n = batch.count()
        if n and not refresh_once(batch.sparkSession, build, output, log, batch_id, n) and retry:
            raise RefreshFailed(f"refresh {batch_id}: see {log}")

    writer = files.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def refresh_once(spark: SparkSession, build: Callable[[SparkSession], DataFrame], output: str, log: str,
                 number: int, files: int) -> bool:
    """One refresh: the report into a folder of its own, then its log row. A replay overwrites both."""
    ok, message = True, "ok"
    try:
        build(spark).write.mode("overwrite").parquet(f"{output}/{REFRESH_COLUMN}={number}")
    except Exception as exc:  # noqa: BLE001 - the log row is the outcome
        ok, message = False, f"{type(exc).__name__}: {exc}"
    row = [(int(files), ok, message, None)]
    (spark.createDataFrame(row, REFRESH_LOG_SCHEMA).withColumn("at", F.current_timestamp())
     .write.mode("overwrite").parquet(f"{log}/{BATCH_COLUMN}={number}"))
    return ok


def published(spark: SparkSession, output: str, log: str) -> DataFrame | None:
    """The report of the newest successful refresh, or None before the first one."""
    done = _read_or_none(spark, log)
    newest = None if done is None else done.where("ok").agg(F.max(BATCH_COLUMN)).first()[0]
    return None if newest is None else spark.read.parquet(f"{output}/{REFRESH_COLUMN}={newest}")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def incremental_report(report: DataFrame, output: str, checkpoint: str, trigger: dict | None = None,
                       key: str = DOC, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """STR4: run a report over streaming ledgers in update mode; each micro-batch's changed rows land in
    ``output/batch_id=<n>/`` (read back, ``batch_id`` is a column), snapshots in ``<output>-snapshot/upto=<n>/``.

    The number of state partitions is ``spark.sql.shuffle.partitions`` at the first start of a checkpoint
    and cannot change later: set it for the size the state will have.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = emitted_status(spark, output, key, batch_id)
        if before is not None:
            same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in batch.columns]
            batch = batch.alias("n").join(before.alias("o"), reduce(lambda a, b: a & b, same), "left_anti")
        # One folder per micro-batch, overwritten if the batch is replayed after a failure.
        batch.write.mode("overwrite").parquet(f"{output}/{BATCH_COLUMN}={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            emitted_status(spark, output, key, batch_id + 1).write.mode("overwrite").parquet(
                f"{output}-snapshot/{SNAPSHOT_COLUMN}={batch_id}")

    writer = (report.writeStream.outputMode("update").foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def emitted_status(spark: SparkSession, output: str, key: str, before: int) -> DataFrame | None:
    """The latest row per document emitted in batches below ``before``: newest snapshot and the log after it."""
    changes = _read_or_none(spark, output)
    if changes is None:
        return None
    changes = changes.where(F.col(BATCH_COLUMN) < before)
    shots = _read_or_none(spark, f"{output}-snapshot")
    upto = None if shots is None else shots.where(F.col(SNAPSHOT_COLUMN) < before).agg(F.max(SNAPSHOT_COLUMN)).first()[0]
    if upto is not None:
        base = shots.where(F.col(SNAPSHOT_COLUMN) == upto).withColumnRenamed(SNAPSHOT_COLUMN, BATCH_COLUMN)
        changes = changes.where(F.col(BATCH_COLUMN) > upto).unionByName(base)
    return current_status(changes, key)


def current_status(changes: DataFrame, key: str = DOC) -> DataFrame:
    """Latest emitted row per document from an ``incremental_report`` change log.

    One partial aggregation by key (``max_by`` over the batch id); a document
    updated in every batch still shuffles one row per map task.
    """
    cols = [c for c in changes.columns if c not in (key, BATCH_COLUMN)]
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(BATCH_COLUMN)).alias("_r")
    return changes.groupBy(key).agg(latest).select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def await_all(*queries: StreamingQuery) -> None:
    """Wait until every ``availableNow`` query has finished, however long it takes; a failure is raised."""
    for q in queries:
        q.awaitTermination()
