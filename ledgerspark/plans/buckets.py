"""Reports without an exchange, from ledgers kept in a bucketed table.

The table holds what reports need of a ledger, one row per document, ledger and status file: the first row by the order
key with that key, and the number of its rows with a unique id. It is partitioned by ledger and bucketed and sorted by the
normalised document, so a scan comes hash-partitioned by document, and each report is its scans' aggregation and a projection.

Writing costs one exchange, of partially aggregated rows: a document with a third of all rows is one row per map task
there and at most one per status file in the table, so no bucket is hot. ``buckets`` should make a bucket's rows fit a task
(it also is the number of tasks of a report).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.reconcile import DOC, concat_sources, tagged_rows
from ledgerspark.plans import reports

LEDGER, FILE, IDS = "_ledger", "_file", "_ids"


def write_ledgers(movements: DataFrame, registry: DataFrame, status_exports: DataFrame, table: str, buckets: int,
                  key_mode: reports.KeyModes = "strict") -> None:
    """Write (or replace) the bucketed table of the three ledgers."""
    ledgers = reports.all_ledgers(movements, registry, status_exports, key_mode)
    rows = concat_sources(*[tagged_rows(lg) for lg in ledgers])
    firsts = [F.min_by(f"_{lg.tag}_row", f"_{lg.tag}_ord").alias(f"_{lg.tag}_row") for lg in ledgers]
    orders = [F.min(f"_{lg.tag}_ord").alias(f"_{lg.tag}_ord") for lg in ledgers]
    reduced = rows.groupBy(DOC, LEDGER, F.col("_soa_src").alias(FILE)).agg(
        *firsts, *orders, F.count("_soa_row.unique_id").alias(IDS))
    # dealt as the buckets are, so that a task writes the files of one bucket only
    (reduced.repartition(buckets, DOC).write.mode("overwrite").format("parquet")
     .partitionBy(LEDGER).bucketBy(buckets, DOC).sortBy(DOC).saveAsTable(table))


def reconciled(spark: SparkSession, table: str, ledgers: tuple[str, ...] = ("CNM", "SOA", "SGP"),
               files: tuple[str, ...] | None = None) -> DataFrame:
    """The reconciliation (as ``reconcile`` has it) of some ledgers of the table, of the status files ``files`` only if given."""
    rows = spark.table(table).where(F.col(LEDGER).isin(*ledgers))
    if files is not None:
        rows = rows.where((F.col(LEDGER) != "SOA") | F.col(f"{FILE}.name").isin(*files))
    aggs: list[Column] = []
    for name in ledgers:
        tag = name.lower()
        aggs += [F.bool_or(F.col(LEDGER) == name).alias(f"in_{tag}"),
                 F.min_by(f"_{tag}_row", f"_{tag}_ord").alias(f"{tag}_first")]
        if name == "SOA":
            aggs += [F.sum(IDS).alias("soa_unique_id_n"), F.array_sort(F.collect_set(FILE)).alias("_files")]
    out = rows.groupBy(DOC).agg(*aggs)
    if "SOA" in ledgers:
        out = out.withColumn("soa_sources", F.transform("_files", lambda f: f["name"])).drop("_files")
    return out


def _movement_date(spark: SparkSession, table: str):
    return spark.table(table).schema["_cnm_row"].dataType["data_hora"].dataType


def unified_report(spark: SparkSession, table: str, with_sources: bool = False) -> DataFrame:
    """Q1 from the table."""
    column: Callable[[str], Column] = F.col
    return reconciled(spark, table).select(*reports.unified_columns(column, _movement_date(spark, table), with_sources))


def unified_presence_report(spark: SparkSession, table: str, active: tuple[str, ...]) -> DataFrame:
    """Q2 from the table."""
    return reports.presence_rows(reconciled(spark, table, files=active), _movement_date(spark, table))


def cnm_registry_report(spark: SparkSession, table: str) -> DataFrame:
    """Q3 from the table."""
    return reports.cnm_registry_rows(reconciled(spark, table, ("CNM", "SGP")), _movement_date(spark, table))


def soa_registry_report(spark: SparkSession, table: str, active: tuple[str, ...]) -> DataFrame:
    """Q4 from the table."""
    return reports.soa_registry_rows(reconciled(spark, table, ("SOA", "SGP"), active))
