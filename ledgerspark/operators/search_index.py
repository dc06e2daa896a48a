"""UI1 over a trigram index: a search reads the files that can hold a match, and upkeep costs by changes.

The index keeps a report as segments: a whole report first, then the changed rows of each refresh. A segment is stored in
the order of its key (``stored_order``), and its postings say which trigrams of a row's visible text occur in which
blocks of ``BLOCK`` rows; they are dealt by trigram to ``SHARDS`` folders and sorted inside. A search takes the blocks that hold every trigram
of its terms, reads the range partitions with such a block, and decides each row as ``views.search_rows`` does. So the
postings may say too much, never too little: a term under three characters is left to the rows, and postings of replaced rows stay.

A row is replaced by the rows of its key in any later segment. ``compact`` writes what stands as a new whole segment; the
folders before it are no longer read. A segment counts once it is listed, which is the last thing written; a number that is written
again (a replayed micro-batch) replaces its segment.

Defined results: null cells show as empty, so they hold no trigram; a row whose key is null is never replaced; repeated
rows stand as often as they were written; an empty report gives an empty index; a text without terms finds every row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import stored_order
from ledgerspark.operators.views import row_text, search_rows, search_terms

BLOCK = 256
SHARDS = 64
GRAM = 3
_SEGMENT = "_segment"


def term_grams(text: str) -> list[str]:
    """The trigrams that every match of the search holds."""
    return sorted({t[k:k + GRAM] for t in map(str.lower, search_terms(text)) for k in range(len(t) - GRAM + 1)})


def _grams(text: Column) -> Column:
    """The distinct trigrams of a text; fewer characters have none."""
    characters = F.split(text, "")
    grams = F.transform(characters, lambda c, i: F.concat(c, F.get(characters, i + 1), F.get(characters, i + 2)))
    return F.array_distinct(F.filter(grams, lambda g: g.isNotNull()))


def _shard(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SHARDS)).cast("int")


def _block() -> Column:
    return F.floor(F.col(stored_order.AT) / BLOCK).cast("long")


def _rows_path(path: str, segment: int) -> str:
    return f"{path}/report/segment={segment}"


def add(spark: SparkSession, path: str, rows: DataFrame, segment: int, key: str = "documento", whole: bool = False) -> None:
    """Write ``rows`` as a segment: the whole report, or the rows that changed since the segment before."""
    at = _rows_path(path, segment)
    stored_order.store(rows, at, [(key, False)], None)
    texts = stored_order.stored_rows(spark, at).select(
        F.col(stored_order.PART).alias("part"), _block().alias("block"), row_text(rows.columns).alias("text"))
    # a block's rows lie in one file, so most repeats of its trigrams go before the exchange
    postings = texts.select("part", "block", F.explode(_grams(F.col("text"))).alias("gram")).distinct()
    (postings.withColumn("shard", _shard(F.col("gram"))).repartition("shard", "part").sortWithinPartitions("shard", "gram")
     .write.mode("overwrite").partitionBy("shard").parquet(f"{path}/grams/segment={segment}"))
    listed = spark.createDataFrame([(segment, whole, key)], "segment int, whole boolean, key string")
    listed.coalesce(1).write.mode("append").parquet(f"{path}/segments")


def segments(spark: SparkSession, path: str) -> tuple[list[int], str]:
    """The segments that stand, oldest first, and the key of their rows."""
    listed = spark.read.parquet(f"{path}/segments").distinct().collect()  # one row per segment
    first = max(r["segment"] for r in listed if r["whole"])
    return sorted({r["segment"] for r in listed if r["segment"] >= first}), listed[0]["key"]


def candidates(spark: SparkSession, path: str, text: str, live: list[int]) -> DataFrame:
    """``segment, part, block`` of the blocks that hold every trigram of the search, each maybe in different rows."""
    grams = term_grams(text)
    asked = spark.createDataFrame([(g,) for g in grams], "gram string").select(_shard(F.col("gram")).alias("shard")).distinct()
    postings = spark.read.schema("part int, block long, gram string, segment int, shard int").parquet(f"{path}/grams")
    here = postings.where(F.col("segment").isin(live) & F.col("shard").isin([r["shard"] for r in asked.collect()])
                          & F.col("gram").isin(grams))
    return here.groupBy("segment", "part", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams)).drop("n")


def _standing(spark: SparkSession, path: str, found: DataFrame, live: list[int], key: str) -> DataFrame:
    """Without the rows that a later segment replaces; only the keys of the change segments are read for that."""
    if len(live) > 1:
        keys = reduce(DataFrame.unionByName, [
            stored_order.stored_rows(spark, _rows_path(path, s)).select(F.col(key).alias("_key"), F.lit(s).alias("_by")) for s in live[1:]])
        newest = keys.groupBy("_key").agg(F.max("_by").alias("_by"))
        found = found.join(newest, (F.col(key) == F.col("_key")) & (F.col("_by") > F.col(_SEGMENT)), "left_anti")
    return found.drop(_SEGMENT, stored_order.PART, stored_order.AT)


def _segment_rows(spark: SparkSession, path: str, segment: int) -> DataFrame:
    return stored_order.stored_rows(spark, _rows_path(path, segment)).withColumn(_SEGMENT, F.lit(segment))


def search(spark: SparkSession, path: str, text: str) -> DataFrame:
    """UI1: the rows that stand and hold every term of ``text`` in their visible text."""
    live, key = segments(spark, path)
    by_index = bool(term_grams(text))
    blocks = candidates(spark, path, text, live) if by_index else None
    # one row per range partition of the segments at most
    held = {(r["segment"], r["part"]) for r in blocks.select("segment", "part").distinct().collect()} if by_index else set()
    found = []
    for s in live:
        rows = _segment_rows(spark, path, s)
        columns = [c for c in rows.columns if c not in (_SEGMENT, stored_order.PART, stored_order.AT)]
        if by_index:
            own = blocks.where(F.col("segment") == s).select(F.col("part").alias(stored_order.PART), F.col("block").alias("_block"))
            rows = (rows.where(F.col(stored_order.PART).isin([p for n, p in held if n == s])).withColumn("_block", _block())
                    .join(own, [stored_order.PART, "_block"], "left_semi").drop("_block"))
        found.append(search_rows(rows, text, columns))
    return _standing(spark, path, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found), live, key)


def compact(spark: SparkSession, path: str) -> int:
    """Write all rows that stand as a new whole segment, whose number is returned."""
    live, key = segments(spark, path)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_segment_rows(spark, path, s) for s in live])
    add(spark, path, _standing(spark, path, rows, live, key), live[-1] + 1, key, whole=True)
    return live[-1] + 1
