"""UI3 over a stored order: a report sorted once, any page of it read from the files that hold it.

``store`` writes the sorted report, one folder per range partition, with each row's place in its partition, and last a
table of ``part, start, rows`` (one row per partition). ``page`` reads that table and then only the folders that the page's
positions fall into, so a deep page costs as much as the first one. An order belongs to a version of the
report (the number of its refresh, say): another version or other sort columns are stored anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.operators.views import PAGE_SIZE, sort_rows

PART, AT, POSITION = "_part", "_at", "_pos"


def order_path(root: str, version: str, by: list[tuple[str, bool]], tie_breaker: str | None = "documento") -> str:
    """The folder of one version of a report in one order."""
    name = hashlib.sha256(json.dumps([version, by, tie_breaker]).encode()).hexdigest()[:24]
    return f"{root.rstrip('/')}/order={name}"


def store(report: DataFrame, path: str, by: list[tuple[str, bool]], tie_breaker: str | None = "documento") -> None:
    """Write the report in its order; the table of partitions comes last and tells that the order is complete."""
    spark = report.sparkSession
    here = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = sort_rows(report, by, tie_breaker).withColumns({PART: F.spark_partition_id(), AT: here})
    rows.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    spark.createDataFrame([], rows.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")  # of an empty report, too
    sizes = stored_rows(spark, path).groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select(F.col(PART).cast("int").alias("part"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), "rows")
    starts.write.mode("overwrite").parquet(f"{path}/parts")


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows as stored, each with its range partition and its place there."""
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def partitions(spark: SparkSession, path: str) -> DataFrame:
    """``part, start, rows`` of the order's range partitions."""
    return spark.read.parquet(f"{path}/parts")


def placed(spark: SparkSession, path: str, parts: list[int] | None = None) -> DataFrame:
    """The stored rows, of some partitions only if ``parts`` names them, with their global position."""
    rows = stored_rows(spark, path)
    if parts is not None:
        rows = rows.where(F.col(PART).isin(parts))
    starts = partitions(spark, path).select(F.col("part").alias(PART), "start")  # one row per partition
    columns = [F.col(f"`{c}`") for c in rows.columns if c not in (PART, AT)]
    return rows.join(F.broadcast(starts), PART).select(*columns, (F.col("start") + F.col(AT)).alias(POSITION))


def stored(spark: SparkSession, build: Callable[[], DataFrame], root: str, version: str, by: list[tuple[str, bool]],
           tie_breaker: str | None = "documento") -> str:
    """The folder of the order, which is stored first if this version has none that is complete."""
    path = order_path(root, version, by, tie_breaker)
    try:
        spark.read.parquet(f"{path}/parts")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        store(build(), path, by, tie_breaker)
    return path


def page(spark: SparkSession, path: str, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``number`` (1-based) of ``size`` rows, in order."""
    if number < 1:
        raise ValueError("pages start at 1")
    first, end = size * (number - 1), size * number
    parts = spark.read.parquet(f"{path}/parts").where((F.col("start") < end) & (F.col("start") + F.col("rows") > first)).collect()
    rows = stored_rows(spark, path).where(F.col(PART).isin([p["part"] for p in parts]))
    place = F.lit(None).cast("long")
    for p in parts:
        place = F.when(F.col(PART) == p["part"], F.col(AT) + p["start"]).otherwise(place)
    # per partition, so that the limits reach the scan as a filter of the stored place
    inside = F.lit(False)
    for p in parts:
        inside = inside | ((F.col(PART) == p["part"]) & (F.col(AT) >= first - p["start"]) & (F.col(AT) < end - p["start"]))
    return rows.where(inside).withColumn("_pos", place).orderBy("_pos").drop("_pos", PART, AT)
