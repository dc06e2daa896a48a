"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed words and byte n-grams; a
softmax over the mean gives the class. One family of word n-grams is abstract: it says
how many words back the same word last stood, which plain n-grams cannot share between words. Vectors and output weights are trained by
numpy stochastic gradient descent in one task over a bounded sample of labelled
documents (``TRAIN_DOCS``, a parameter; whole texts). Since the model is linear
after the mean, each bucket's vector folds into one number (its projection on the
class difference), so scoring a document is one table look-up per feature; the
same value as the unfolded model, at memory speed. Scoring needs no shuffle.

Only labels of rows outside the held-out fold are learned from; language, source
and id are never features.

Defined results: null and empty texts have no features and get the learned prior;
null or other labels than 0 and 1 are not learned; repeated label rows weigh as
often as they stand; with no labelled row at all every score is 0.5; with one
class only, the score is that class's share under add-one smoothing. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import mix, span_hashes, text_blocks
from ledgerspark.llm.common import fold, table

TRAIN_DOCS = 2500
BUCKETS = 1 << 18
DIM = 12
ORDERS = (3, 5)
REPEAT_SPAN = 4
EPOCHS = 12
RATE = 0.6
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _features(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per feature family: bucket of every feature in text order, and per row the index of its first one."""
    solid = ~IS_SPACE[buf] if len(buf) else np.zeros(0, bool)
    first, last = solid.copy(), solid.copy()
    if len(buf):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = offs[(offs > 0) & (offs < len(buf))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = span_hashes(buf, starts, ends) if len(buf) else np.zeros(0, np.uint64)
    row_first = np.searchsorted(starts, offs, "left")
    yield (words & np.uint64(BUCKETS - 1)).astype(np.int64), row_first
    # how far back the same word last stood, as an abstract word n-gram (0: not within REPEAT_SPAN words of its row)
    back = np.zeros(len(words), np.uint64)
    row_start = np.repeat(row_first[:-1], np.diff(row_first))
    for d in range(REPEAT_SPAN, 0, -1):
        same = np.flatnonzero(words[d:] == words[:-d]) + d
        back[same[same - d >= row_start[same]]] = d
    yield (mix(back + np.uint64(REPEAT_SPAN << 32)) & np.uint64(BUCKETS - 1)).astype(np.int64), row_first
    wide = buf.astype(np.uint64)
    for order in ORDERS:
        n = max(0, len(buf) - order + 1)
        code = np.zeros(n, np.uint64)
        for k in range(order):
            code |= wide[k:k + n] << np.uint64(8 * k)
        code |= np.uint64(order) << np.uint64(56)
        bucket = (mix(code) & np.uint64(BUCKETS - 1)).astype(np.int64)
        inside = np.ones(n, bool)  # windows that cross a row's end are no features
        for back in range(1, order):
            cross = offs[1:-1] - back
            inside[cross[(cross >= 0) & (cross < n)]] = False
        at = np.concatenate([[0], np.cumsum(inside)])
        yield bucket[inside], at[np.minimum(offs, n)]


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows: label and the document's distinct buckets with their shares."""
    for batch in batches:
        label = batch.column(0).to_pylist()
        order = batch.column(1).to_pylist()
        out = []
        for i, j, buf, offs in text_blocks(batch.column(2)):
            families = list(_features(buf, offs))
            for r in range(i, j):
                own = np.concatenate([b[f[r - i]:f[r - i + 1]] for b, f in families])
                ids, counts = np.unique(own, return_counts=True)
                out.append((label[r], order[r], ids.astype(np.int32).tobytes(),
                            (counts / max(1, len(own))).astype(np.float32).tobytes()))
        yield pa.RecordBatch.from_pylist([dict(zip(("label", "ord", "ids", "share"), x, strict=True)) for x in out], _ROWS)


_ROWS = pa.schema([("label", pa.int32()), ("ord", pa.int64()), ("ids", pa.binary()), ("share", pa.binary())])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> tuple[np.ndarray, float]:
    """Fit by SGD; returns each bucket's logit share and the bias."""
    ones = sum(label for label, _, _ in rows)
    prior = float(np.log((ones + 1) / (len(rows) - ones + 1)))
    if ones in (0, len(rows)):
        return np.zeros(BUCKETS, np.float32), prior
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM).astype(np.float32)
    out = np.zeros((2, DIM), np.float32)
    bias = np.array([0.0, prior], np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            label, ids, share = rows[k]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            if not len(ids):
                continue
            hidden = share @ vectors[ids]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ out
            out -= rate * np.outer(p, hidden)
            bias -= np.float32(0.1) * rate * p
            # a step along the mean's gradient, scaled so that the mean itself moves by the rate
            vectors[ids] -= (rate / (share @ share)) * share[:, None] * back
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for label, order, ids, share in zip(*batch.columns, strict=True):
            rows.append((order.as_py(), label.as_py(), np.frombuffer(ids.as_py(), np.int32), np.frombuffer(share.as_py(), np.float32)))
    rows.sort(key=lambda r: (r[0], r[1], len(r[2]), crc32(r[2])))
    logits, bias = train([r[1:] for r in rows]) if rows else (np.zeros(BUCKETS, np.float32), 0.0)
    yield pa.RecordBatch.from_arrays([pa.array([logits.astype(np.float32).tobytes()], pa.binary()),
                                      pa.array([bias], pa.float64())], names=["logits", "bias"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        held_out: tuple[int, int] = (3, 1), train_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, float]:
    """Learn from at most ``train_docs`` labelled rows outside the fold ``crc32(key) mod n == k``, those of least hash."""
    n, k = held_out
    chosen = (labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
              .filter(F.col("label").isin(0, 1) & (fold("key", n) != k))
              .withColumn("ord", F.xxhash64("key")).orderBy("ord", "label").limit(train_docs))
    rows = (docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
            .join(F.broadcast(chosen), "key").select("label", "ord", "text"))
    sparse = rows.mapInArrow(_sparse, "label int, ord long, ids binary, share binary")
    model = sparse.repartition(1).mapInArrow(_train_task, "logits binary, bias double").first()
    return np.frombuffer(model["logits"], np.float32), model["bias"]


def _score(batches: Iterator[pa.RecordBatch], logits: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = np.zeros(batch.num_rows)
        for i, j, buf, offs in text_blocks(batch.column(1)):
            total, count = np.zeros(j - i), np.zeros(j - i)
            for bucket, first in _features(buf, offs):
                run = np.concatenate([[0.0], np.cumsum(logits[bucket], dtype=np.float64)])
                total += run[first[1:]] - run[first[:-1]]
                count += np.diff(first)
            score[i:j] = 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -700, 700)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["key", "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", keep: str = "key") -> DataFrame:
    """Rows of (``keep``, ``score``): ``keep`` may be one column or a struct of all."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket: a fixed size
    kind = docs.schema[keep].dataType.simpleString()
    return docs.select(F.col(keep).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        lambda it: _score(it, *shared.value), f"key {kind}, score double")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, keep="doc_id").select(
        F.col("key").alias("doc_id"), F.coalesce(fold("key", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
