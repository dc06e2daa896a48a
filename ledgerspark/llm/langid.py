"""Language identification by compression.

Each learned language keeps a raw-content zstandard dictionary cut from its
training texts. A text (lower-cased, every run of non-letters one blank) is
compressed once per language with that dictionary; the smallest result names the
language, and a narrow margin to the second smallest marks the decision as
rejected (``rejected``, beside the best guess). Matches from four bytes count, so
that syllables shared with the dictionary shorten the result.

The dictionaries are a bounded sample by parameter: ``DICT_BYTES`` per language,
taken as one slice of ``SLICE_BYTES`` from each of the texts of least hash among
the language's training rows. Texts to classify are compressed whole.

Defined results: null texts and texts without a letter are ``und`` with score 0;
ties go to the language with most training rows, then the one that sorts first; rows with a null language are not
learned from; with no training row every text is ``und``. Repeated rows give
repeated results; language, source and id are never inputs of a prediction and
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import fold, table

DICT_BYTES = 48 << 10
SLICE_BYTES = 512
LEVEL = 5
MIN_MATCH = 4
MARGIN = 3  # bytes; a long text learns itself, so the margin is not taken relative to its size
UNDETERMINED = "und"
_OTHER = regex.compile(r"\P{L}+")


def _top(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    """Per task: the slices of least hash for each language, at most ``slices`` of them."""
    best: dict[str, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for lang, order, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = best.setdefault(lang, [])
            rows.append((order, piece))
            if len(rows) >= 2 * slices:
                rows.sort()
                del rows[slices:]
    out = [(lang, o, p) for lang, rows in best.items() for o, p in sorted(rows)[:slices]]
    yield pa.RecordBatch.from_pylist(
        [dict(zip(("lang", "ord", "piece"), r, strict=True)) for r in out],
        pa.schema([("lang", pa.string()), ("ord", pa.int64()), ("piece", pa.binary())]))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          held_out: tuple[int, int] = (4, 2), dict_bytes: int = DICT_BYTES) -> dict[str, tuple[int, bytes]]:
    """Training rows and raw dictionary of each language, from the rows outside the fold ``crc32(key) mod n == k``."""
    n, k = held_out
    slices = dict_bytes // SLICE_BYTES
    raw = F.regexp_replace(F.lower(F.col(text).cast("string")), r"\P{L}+", " ").cast("binary")
    order = F.xxhash64(F.col(key), F.col(text))
    # a slice from anywhere in the text, by its hash
    begin = F.pmod(order, F.greatest(F.octet_length(raw) - SLICE_BYTES + 1, F.lit(1))).cast("int") + 1
    learned = docs.filter(F.col(lang).isNotNull() & (fold(key, n) != k) & (F.length(F.trim(text)) > 0))
    rows = learned.select(
        F.col(lang).cast("string").alias("lang"), order.alias("ord"),
        F.substring(raw, begin, F.lit(SLICE_BYTES)).alias("piece"))
    kind = "lang string, ord long, piece binary"
    # the bound per language holds in every task and again over their results, in a tree of two levels
    local = rows.mapInArrow(lambda it: _top(it, slices), kind)
    best = local.repartition(8, F.pmod("ord", F.lit(8))).mapInArrow(lambda it: _top(it, slices), kind)
    model: dict[str, list[tuple[int, bytes]]] = {}
    for r in best.collect():  # 8 x slices rows per language
        model.setdefault(r["lang"], []).append((r["ord"], bytes(r["piece"])))
    count = {r[0]: r[1] for r in learned.groupBy(F.col(lang).cast("string")).count().collect()}
    return {name: (count.get(name, 0), b"\n".join(p for _, p in sorted(rows)[:slices])) for name, rows in model.items()}


class Classifier:
    """Compressed size of a text under each language's dictionary."""

    def __init__(self, model: dict[str, tuple[int, bytes]], level: int = LEVEL):
        self.languages = sorted(model, key=lambda name: (-model[name][0], name))  # the order that decides ties
        params = zstandard.ZstdCompressionParameters.from_level(level, min_match=MIN_MATCH, write_content_size=False)
        self.coders = []
        for name in self.languages:
            d = zstandard.ZstdCompressionDict(model[name][1], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))

    def sizes(self, data: bytes) -> list[int]:
        return [len(c.compress(data)) for c in self.coders]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, confidence from the size margin (0 to 1) and whether the margin is too narrow."""
        letters = _OTHER.sub(" ", (text or "").lower())
        if not self.coders or not letters.strip():
            return UNDETERMINED, 0.0, True
        if len(self.coders) == 1:
            return self.languages[0], 1.0, False
        sizes = self.sizes(letters.encode("utf-8", "surrogatepass"))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min(s for k, s in enumerate(sizes) if k != best)
        weights = np.exp2(np.clip((sizes[best] - np.array(sizes, float)) / 2, -60, 0))
        return self.languages[best], float(weights[best] / weights.sum()), second - sizes[best] < MARGIN


def _classify(batches: Iterator[pa.RecordBatch], model: dict[str, tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    judge = Classifier(model)
    for batch in batches:
        out = [judge.predict(t.as_py()) for t in batch.column(1)]
        lang, score, rejected = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
            names=["key", "lang_pred", "score", "rejected"])


def classify(docs: DataFrame, model: dict[str, tuple[int, bytes]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``rejected`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DICT_BYTES per language
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        lambda it: _classify(it, shared.value),
        f"key {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("key", key)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = classify(docs, learn(docs))
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")
