"""Skew check: Q1 when one document holds a large share of the rows.

Usage: python tools/skew_check.py [sf_dir]
Derived from the given tables: movements of two event types and status-export
rows of two priority classes lose their document (blank id), so they all
collapse into the document ''. From the event log, for the stage after the
document exchange, prints the records read by the largest task against the
median task, with and without the skew. Partial aggregation should keep the
largest task close to the others.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

BLANK_EVENT_TYPES = ("view", "error")
BLANK_PRIORITIES = ("3", "4")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="ls-skew-")
    from pyspark.sql import functions as F

    from ledgerspark.plans import reports
    from ledgerspark.session import get_spark
    from ledgerspark.sources import fixtures as fx

    spark = get_spark(master="local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    mv = fx.movements(spark, sf_dir).join(ev.select(F.col("event_id").alias("ord"), "event_type"), "ord")
    mv_skew = mv.withColumn("documento", F.when(F.col("event_type").isin(*BLANK_EVENT_TYPES), F.lit(None))
                            .otherwise(F.col("documento"))).drop("event_type")
    se = fx.status_exports(spark, sf_dir)
    se_skew = se.withColumn("documento", F.when(F.col("source_rank").cast("string").isin(*BLANK_PRIORITIES),
                                                F.lit(None)).otherwise(F.col("documento")))
    rg = fx.registry(spark, sf_dir)
    share = (mv_skew.where(F.col("documento").isNull()).count() + se_skew.where(F.col("documento").isNull()).count()) \
        / (mv_skew.count() + se_skew.count() + rg.count())
    for label, m, s in (("uniform", mv.drop("event_type"), se), ("skewed", mv_skew, se_skew)):
        spark.sparkContext.setJobDescription(label)
        reports.unified_report(m, rg, s).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    # The row-level registry flag is a join: with the registry too big to broadcast it needs
    # AQE's skew split (thresholds lowered here only so that sf0.1 partitions qualify).
    for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"),
                 ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k"),
                 ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k"),
                 ("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")):
        spark.conf.set(k, v)
    rows = reports.movement_status_rows(mv_skew, rg)
    n = len(rows.collect())
    final = rows._jdf.queryExecution().executedPlan().toString()
    print(f"movement_status on skewed movements: rows={n}, "
          f"sort-merge joins split by AQE for skew: {final.count('SortMergeJoin(skew=true)')}")
    spark.stop()

    stage_label, reads = {}, defaultdict(list)
    for path in glob.glob(os.path.join(log_dir, "*")):
        if not os.path.isfile(path):
            continue
        for line in open(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                d = (e.get("Properties") or {}).get("spark.job.description")
                for sid in e.get("Stage IDs", []):
                    if d:
                        stage_label[sid] = d
            elif e.get("Event") == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if r and e.get("Stage ID") in stage_label:
                    reads[(stage_label[e["Stage ID"]], e["Stage ID"])].append(r)
    print(f"blank-document share of all ledger rows: {share:.1%}")
    for (label, sid), rs in sorted(reads.items()):
        print(f"{label:8s} stage {sid}: tasks={len(rs)} shuffle records read: max={max(rs)} "
              f"median={statistics.median(rs):.0f} total={sum(rs)}")


if __name__ == "__main__":
    main()
