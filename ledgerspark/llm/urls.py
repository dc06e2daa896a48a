"""URL filter: path rules, and for the rest a ratio of two character language models.

Rules name a host (with its subdomains) and a beginning of the path; the longest that
fits decides. URLs that no rule fits are judged by two smoothed variable-order Markov
models over bytes, learned from the URLs that rules accept and reject: the
probability of a byte interpolates the counts after contexts of 0 to ``ORDER`` bytes
(contexts never seen add nothing, so the order varies with the evidence). The
log-likelihood difference per byte is compared with a threshold calibrated on a fold
of the rule-judged URLs that the models have not seen, by balanced accuracy.

Counts of (context, byte) pairs go into ``SLOTS`` hashed slots per order and class,
which bounds the models whatever the corpus; they are summed per task, then by slot.

Defined results: a null url, or one without ``://``, has an empty host and path, which
no rule fits; an empty url has no bytes to judge and is allowed; when rules accept
or reject nothing, every URL that no rule fits is allowed; repeated rows repeat
their results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import mix, text_blocks
from ledgerspark.llm.common import table

ORDER = 4
SLOTS = 1 << 16
DISCOUNT = 2.0
CALIBRATE = (5, 0)  # URLs of this fold of their hash set the threshold; the others are learned from
BIN = 0.01
LIMIT = 20.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"),
         Rule("org", "/fr/", "allow"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(text, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; of equally long ones the first in text order."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _slots(buf: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: the slot of its context of ``order`` bytes, and of the context with the byte.

    A url begins after ``order`` virtual bytes 256, so its first bytes have contexts too.
    """
    n, first = len(buf), np.repeat(offs[:-1], np.diff(offs))
    at = np.arange(n)
    code = np.full(n, order + 1, np.uint64)
    wide = buf.astype(np.uint64)
    with np.errstate(over="ignore"):
        for back in range(1, order + 1):
            before = np.where(at - back >= first, wide[np.maximum(at - back, 0)], np.uint64(256))
            code = mix(code * np.uint64(0x9E3779B97F4A7C15) + before)
        pair = mix(code * np.uint64(0x9E3779B97F4A7C15) + wide + np.uint64(1))
    low = np.uint64(SLOTS - 1)
    return (code & low).astype(np.int64), (pair & low).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, url) rows to summed counts; slot numbers run over class, order, context or pair, and slot."""
    total = np.zeros((2, ORDER + 1, 2, SLOTS), np.int64)
    for batch in batches:
        accept = np.array(batch.column(0).to_pylist(), np.int64)
        for i, j, buf, offs in text_blocks(batch.column(1)):
            cls = np.repeat(accept[i:j], np.diff(offs))
            for order in range(ORDER + 1):
                for kind, slot in enumerate(_slots(buf, offs, order)):
                    flat = np.bincount(cls * SLOTS + slot, minlength=2 * SLOTS)
                    total[:, order, kind] += flat.reshape(2, SLOTS)
    flat = total.ravel()
    at = np.flatnonzero(flat)
    for k in range(0, max(1, len(at)), 50_000):
        part = at[k:k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(flat[part])], names=["slot", "n"])


def _ratio(buf: np.ndarray, offs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-likelihood difference per byte, accepted minus rejected; 0 for an empty url."""
    p = np.full((2, len(buf)), 1 / 256)
    for order in range(ORDER + 1):
        context, pair = _slots(buf, offs, order)
        for cls in range(2):
            p[cls] = (counts[cls, order, 1, pair] + DISCOUNT * p[cls]) / (counts[cls, order, 0, context] + DISCOUNT)
    run = np.concatenate([[0.0], np.cumsum(np.log(p[1]) - np.log(p[0]))])
    return (run[offs[1:]] - run[offs[:-1]]) / np.maximum(np.diff(offs), 1)


def _score(batches: Iterator[pa.RecordBatch], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ratio = np.zeros(batch.num_rows)
        for i, j, buf, offs in text_blocks(batch.column(1)):
            ratio[i:j] = _ratio(buf, offs, counts)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ratio)], names=["row", "ratio"])


@dataclass(frozen=True)
class Model:
    counts: np.ndarray | None  # class (rejected, accepted) x order x (context, pair) x slot
    threshold: float


def fit(judged: DataFrame) -> Model:
    """Learn from rows (``verdict``, ``url``) that rules have judged."""
    n, k = CALIBRATE
    rows = judged.filter(F.length("url") > 0).select((F.col("verdict") == "allow").cast("int").alias("accept"), "url")
    part = F.pmod(F.xxhash64("url"), F.lit(n))
    spark = judged.sparkSession
    counts = np.zeros(2 * (ORDER + 1) * 2 * SLOTS)
    for r in (rows.filter(part != k).select("accept", "url").mapInArrow(_count, "slot long, n long")
              .groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator()):  # at most one row per slot
        counts[r["slot"]] = r["n"]
    counts = counts.reshape(2, ORDER + 1, 2, SLOTS)
    if not counts[0].any() or not counts[1].any():
        return Model(None, 0.0)
    shared = spark.sparkContext.broadcast(counts)
    scored = rows.filter(part == k).select("accept", "url").mapInArrow(
        lambda it: _score(it, shared.value), "row int, ratio double")
    where = F.floor(F.greatest(F.least("ratio", F.lit(LIMIT)), F.lit(-LIMIT)) / BIN).alias("bin")
    bins = scored.groupBy(F.col("row").alias("accept"), where).count().collect()  # a fixed range of bins
    return Model(counts, calibrated([(r["accept"], r["bin"], r["count"]) for r in bins]))


def calibrated(bins: list[tuple[int, int, int]]) -> float:
    """The bin edge that parts the classes with the best balanced accuracy (the one nearest to 0 among equals)."""
    size = [sum(c for a, _, c in bins if a == cls) for cls in (0, 1)]
    if not all(size):
        return 0.0
    edges = sorted({0, *(b for _, b, _ in bins), *(b + 1 for _, b, _ in bins)}, key=lambda e: (abs(e), e))

    def balanced(edge: int) -> float:
        return (sum(c for a, b, c in bins if a and b >= edge) / size[1] + sum(c for a, b, c in bins if not a and b < edge) / size[0])

    return max(edges, key=balanced) * BIN


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, verdict, ratio`` for every row; ``ratio`` is null where a rule decides."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    host, path = url_parts(F.col("url"))
    ruled = rows.withColumns({"host": host, "path": path}).withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    model = fit(ruled.filter("found is not null").select(F.col("found.verdict").alias("verdict"), "url"))
    rest = F.lit("allow")
    if model.counts is None:
        scored = ruled.withColumn("ratio", F.lit(None).cast("double"))
    else:
        shared = pages.sparkSession.sparkContext.broadcast(model.counts)
        # rows pass through whole, as one struct, so that nothing has to be joined back
        carried = ruled.select(F.struct("key", "host", "path", "found").alias("row"), F.when(F.col("found").isNull(), F.col("url")).alias("url"))
        kind = carried.schema["row"].dataType.simpleString()
        scored = carried.mapInArrow(lambda it: _score(it, shared.value), f"row {kind}, ratio double").select(
            "row.*", F.when(F.col("row.found").isNull(), F.col("ratio")).alias("ratio"))
        rest = F.when(F.col("ratio") < model.threshold, "block").otherwise("allow")
        rest = F.when((F.col("ratio") == 0) & (F.length("host") == 0), "allow").otherwise(rest)
    return scored.select(F.col("key").alias(key), "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce("found.verdict", rest).alias("verdict"), "ratio")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
