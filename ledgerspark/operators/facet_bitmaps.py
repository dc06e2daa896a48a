"""UI4 and UI5 over bitmaps: facet counts under active choices without reading the report's rows.

The report is stored in the order of its facets, the one with most values first (``stored_order``). ``store_index`` writes one
bitmap per facet, value and run of 32,768 positions. As the order follows the first facet, each of its values spans
few runs, so its many values make about as many bitmaps as there are runs; the other facets should have few values.

``facet_counts`` counts each value's rows among those that match the choices of all other facets, so that a chosen facet still
shows its alternatives. ``filtered_rows`` reads only the partitions of the order that hold a match. Values match as in
``views.facet_filter``: exact but for case, without HTML tags. Null and empty values are in no bitmap and are
not offered, as in ``views.facet_values``; an empty report has an empty index. An index belongs to one stored order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import stored_order
from ledgerspark.operators.views import visible_text


def _bucket(position: Column) -> Column:
    return F.bitmap_bucket_number(position + 1)  # the functions number from 1


def store_index(spark: SparkSession, order: str, path: str, facets: tuple[str, ...]) -> None:
    """Write ``facet, value, choice, bucket, bits`` of the rows stored under ``order``."""
    pairs = stored_order.placed(spark, order).select(stored_order.POSITION, F.inline(F.array(*[
        F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"), F.lower(visible_text(F.col(c))).alias("choice"))
        for c in facets]))).where("value <> ''")
    at = F.col(stored_order.POSITION)
    (pairs.groupBy("facet", "value", "choice", _bucket(at).alias("bucket"))
     .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits"))
     .write.mode("overwrite").partitionBy("facet").parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, choice string, bucket long, bits binary, facet string").parquet(path)


def _chosen(index: DataFrame, choices: dict[str, str | None]) -> tuple[dict[str, str], DataFrame]:
    """The choices made, and one bitmap per chosen facet and bucket."""
    made = {f: v.lower() for f, v in choices.items() if v}
    hit = F.lit(False)
    for f, v in made.items():
        hit = hit | ((F.col("facet") == f) & (F.col("choice") == v))
    return made, index.where(hit).groupBy("facet", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def facet_counts(index: DataFrame, facets: tuple[str, ...], choices: dict[str, str | None]) -> DataFrame:
    """``facet, value, n``: rows of each value that match the choices of the other facets; values without any are left out."""
    made, picked = _chosen(index, choices)
    others = {f: [c for c in made if c != f] for f in facets}
    free = [f for f in facets if not others[f]]
    out = index.where(F.col("facet").isin(free)).select("facet", "value", F.bitmap_count("bits").alias("n"))
    bound = [f for f in facets if others[f]]
    if bound:
        # for each counted facet the rows that all other choices allow
        need = F.create_map(*[x for f in bound for x in (F.lit(f), F.lit(len(others[f])))])
        allowed = (picked.withColumnRenamed("facet", "by").select("by", "bucket", "bits", F.explode(F.array(*map(F.lit, bound))).alias("facet"))
                   .where("by <> facet").groupBy("facet", "bucket")
                   .agg(F.bitmap_and_agg("bits").alias("allowed"), F.count(F.lit(1)).alias("have"))
                   .where(F.col("have") == need[F.col("facet")]))
        both = index.join(allowed, ["facet", "bucket"]).select(
            "facet", "value", "bucket", F.explode(F.array("bits", "allowed")).alias("bits"))
        kept = both.groupBy("facet", "value", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
        out = out.unionByName(kept.select("facet", "value", F.bitmap_count("bits").alias("n")))
    return out.groupBy("facet", "value").agg(F.sum("n").alias("n")).where("n > 0")


def filtered_rows(spark: SparkSession, order: str, index: DataFrame, choices: dict[str, str | None]) -> DataFrame:
    """UI5: the stored rows that match all choices; partitions of the order without a match are not read."""
    made, picked = _chosen(index, choices)
    if not made:
        return stored_order.placed(spark, order).drop(stored_order.POSITION)
    match = (picked.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("have"))
             .where((F.col("have") == len(made)) & (F.bitmap_count("bits") > 0)).select("bucket", "bits"))
    parts = stored_order.partitions(spark, order)
    first, last = _bucket(F.col("start")), _bucket(F.col("start") + F.col("rows") - 1)
    held = parts.join(match.select("bucket"), F.col("bucket").between(first, last), "left_semi").select("part")
    at = F.col(stored_order.POSITION)
    rows = stored_order.placed(spark, order, [p["part"] for p in held.collect()])  # one row per partition of the order
    bit = F.bitmap_bit_position(at + 1)
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return (rows.withColumns({"bucket": _bucket(at), "bit": bit}).join(match, "bucket")
            .where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1).select(*[c for c in rows.columns if c != stored_order.POSITION]))
