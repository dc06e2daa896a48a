"""Reading tables, folds and the shared working folder for the queries of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table; also makes the package importable in the Python workers."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column | str, n: int) -> Column:
    """``crc32(key as text) mod n``: the held-out folds of the learning operators (null key: null)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % F.lit(n)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the folder that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
