"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Per-document streaming state (STR4) grows with the number of documents: keep it off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings for large inputs (hundreds of TB over ~1000 executors): start with many
# shuffle partitions and let AQE coalesce them to ~256 MB, split skewed join
# partitions, and read files in 256 MB splits. Applied by ``get_spark(cluster=True)``.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def session_conf(master: str | None = None, shuffle_partitions: int | None = None, extra: dict | None = None,
                 cluster: bool = False, preset=None) -> dict[str, str]:
    """The settings a session is built with.

    A master is set only when one is passed (or named by ``SPARK_MASTER``), so that
    ``spark-submit --master`` decides otherwise. With ``cluster`` the settings for large
    inputs are added; what ``preset`` (a ``SparkConf``) already holds wins over both.
    """
    conf = {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if preset is not None:
        conf = {k: v for k, v in conf.items() if not preset.contains(k)}
    chosen = master or os.environ.get("SPARK_MASTER")
    if chosen:
        conf["spark.master"] = chosen
    return {**conf, **(extra or {})}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "ledgerspark", extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    ``master``/``shuffle_partitions`` are for local runs and tests; on a cluster
    leave them unset and pass ``cluster=True`` for ``CLUSTER_CONF`` (settings
    the submit configuration already sets win).
    """
    preset = None
    if cluster:
        from pyspark import SparkConf

        preset = SparkConf()  # values from spark-submit / spark-defaults take precedence
    b = SparkSession.builder.appName(app)
    for k, v in session_conf(master, shuffle_partitions, extra, cluster, preset).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It must be a folder that every executor can reach. Only a local master may leave it unset:
    then, as in tests, a fresh local folder is created; any other master raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ledgerspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerspark`` importable in the executors' Python workers.

    Operators that run Python on executors (``mapInPandas``, the workbook data
    source) call this once per application: the package is zipped on the driver
    and handed to ``SparkContext.addPyFile``, which distributes it like
    ``--py-files``. A no-op when the package is already importable there.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="ledgerspark-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(app)
