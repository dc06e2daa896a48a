"""The corpus pipeline: five stages over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read back as the next stage's input. All but the last return the columns
of ``documents``, whatever those are; ``n_chars`` follows the text.

1. quality: documents that the classifier rejects go.
2. near_duplicates: one document of each class stays, that of the smallest id (null ids last, then the
   smallest text hash; of fully repeated rows one).
3. decontamination: passages of the benchmark are cut out of the texts.
4. secrets: secrets are replaced by a mark.
5. encoding: token ids of each remaining text, with count and digest, and the digest of the text decoded from them.

Rows with a null text pass as empty documents do: no stage takes offence at them by itself.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark.llm import bitmap, bpe, decontaminate, neardup, quality, secrets  # noqa: E402
from ledgerspark.llm.common import materialise, table, work_path  # noqa: E402


def _with_text(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the carried ``row`` with ``new_text`` as the text; ``n_chars`` is counted anew where there is one."""
    fields = rows.schema["row"].dataType
    changed = {"text": F.col("new_text")}
    if "n_chars" in columns:
        changed["n_chars"] = F.length("new_text").cast(fields["n_chars"].dataType)
    return rows.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns))


def _carried(docs: DataFrame) -> DataFrame:
    """``row`` (all columns as one struct) and ``text``: operators pass the row through whole, so nothing is joined back."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(_carried(docs), model, keep="row").filter("score >= 0.5").select("key.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = materialise(neardup.classes(docs).filter("n_class > 1"), "pipeline-classes")
    keep = found.groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("k"))
    kept = keep.select(F.col("k.id").alias("id"), F.col("k.h").alias("h"), F.lit(True).alias("stays")).distinct()
    each = found.groupBy("id", "h").agg(F.count(F.lit(1)).alias("rows"))
    # rows that go, and rows of which a repetition goes; all others never leave their executor: the bitmap is of fixed
    # size, and exact joins follow
    odd = materialise(each.join(kept, each["id"].eqNullSafe(kept["id"]) & (each["h"] == kept["h"]), "left")
                      .filter("stays is null or rows > 1")
                      .select(each["id"].alias("odd_id"), each["h"].alias("odd_h"), F.coalesce("stays", F.lit(False)).alias("stays")),
                      "pipeline-odd")
    bits = materialise(bitmap.bitmap(odd, F.xxhash64("odd_id", "odd_h")), "pipeline-bitmap")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    alone = bitmap.maybe_in(keyed, F.xxhash64("id", "h"), bits, negate=True).select("row.*")
    maybe = bitmap.maybe_in(keyed, F.xxhash64("id", "h"), bits).join(
        odd, F.col("id").eqNullSafe(F.col("odd_id")) & (F.col("h") == F.col("odd_h")), "left").filter("stays is null or stays")
    also_alone = maybe.filter("stays is null").select("row.*")
    # of rows that repeat id and text one stays: further columns may differ, the smallest row decides
    one = maybe.filter("stays").groupBy("id", "h").agg(F.min("row").alias("row")).select("row.*")
    return alone.unionByName(also_alone).unionByName(one)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_carried(docs), table(spark, sf_dir, "benchmark"), key="row")
    cut = found.select("row", decontaminate.remove_spans(F.col("row.text"), F.col("char_spans")).alias("new_text"))
    return _with_text(cut, docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_carried(docs), key="row")
    return _with_text(found.select("row", F.col("redacted").alias("new_text")), docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, bpe.default_vocabulary(), columns=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("encoding", encoding_stage),
]

# The stages rest on learned models, hashing and lexing, which SQL cannot express; tests/llm/test_pipeline.py holds
# the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
