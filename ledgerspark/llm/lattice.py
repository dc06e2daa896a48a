"""Language-model scoring by subword lattice likelihood.

The pieces of an existing vocabulary span a lattice of all segmentations of a text.
Every piece has a probability, a segmentation has the product of its pieces', and the
text the sum over all of them, found by a forward recursion in log space. Pieces never
cross white space, so a text's probability is the product over its words, and each
distinct word of the corpus is worked out once.

Piece probabilities start from the vocabulary file's own scores (ranks, read as a Zipf
law) and are re-estimated by ``EM_ROUNDS`` rounds of expectation maximisation over the
counts of all training words, with the file's scores as the prior. Bytes stand for
themselves where no longer piece fits, so every text has a probability above zero.

Flow: (1) distinct words with training counts, combined per batch before the
shuffle; (2) piece counts from that table, a sum per piece; (3) each word's log
probability; (4) documents meet the words: the ``FREQUENT`` most frequent ones (a fixed
bound) are looked up from a broadcast table, the others are joined by word, each
document's sums then added up. So frequent words, however hot, never form a join key.

Defined results: null text is empty; an empty text is the end token alone; an empty
training set leaves the prior probabilities, and base counts of zero; rows that repeat
an id and its text give one result each; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import LOWER, byte_hashes, mix, same_bytes, text_blocks
from ledgerspark.llm.common import fold, materialise, table

EM_ROUNDS = 2
PRIOR_WEIGHT = 1000.0  # pseudo-counts that the file's scores are worth in all
FREQUENT = 1 << 17
LN10 = float(np.log(10))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True  # fixed values: the token separators
BEGIN = 32  # the byte that stands before every word, as no word holds it


class Vocabulary:
    """Pieces of a sentencepiece file as byte strings, and hash tables to find them and their beginnings."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores: dict[bytes, float] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:]:  # others cannot occur within a word
                scores[piece] = max(scores.get(piece, -np.inf), model.get_score(i))
        lowest = min((s for s in scores.values() if s > -1e6), default=0.0)
        for b in range(256):  # bytes for whatever the pieces do not cover
            scores.setdefault(bytes([b]), lowest - 1)
        self.pieces = sorted(scores)
        rank = -np.maximum(np.array([scores[p] for p in self.pieces]), lowest - 1)
        weight = 1 / (rank - rank.min() + 3)
        self.prior = weight / weight.sum()
        self.longest = max(map(len, self.pieces))
        keys = np.array([self._key(p) for p in self.pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], order
        begins = np.unique(np.array([self._key(p[:k]) for p in self.pieces for k in range(1, len(p))], np.uint64))
        self.is_piece, self.is_begin = np.zeros(1 << 20, bool), np.zeros(1 << 20, bool)
        self.is_piece[keys >> np.uint64(44)] = True
        self.is_begin[begins >> np.uint64(44)] = True

    @staticmethod
    def _key(piece: bytes) -> int:
        code = np.zeros(1, np.uint64)
        with np.errstate(over="ignore"):
            for b in piece:
                code = step(code, np.array([b], np.uint64))
        return int(code[0])

    def edges(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces within the words: start, end, piece number, and the end's distance from its word's start.

        Sorted by that distance, then by end.
        """
        word = np.repeat(np.arange(len(starts)), ends - starts)
        at = np.arange(len(word)) + np.repeat(starts - np.concatenate([[0], np.cumsum(ends - starts)[:-1]]), ends - starts)
        code, limit, begin = np.zeros(len(at), np.uint64), ends[word], starts[word]
        wide = buf.astype(np.uint64)
        out = []
        for k in range(1, self.longest + 1):
            code = step(code, wide[at + k - 1])
            slot = code >> np.uint64(44)
            maybe = np.flatnonzero(self.is_piece[slot])
            place = np.minimum(np.searchsorted(self.keys, code[maybe]), len(self.keys) - 1)
            hit = self.keys[place] == code[maybe]
            found = maybe[hit]
            out.append((at[found], at[found] + k, self.numbers[place[hit]], at[found] + k - begin[found]))
            on = np.flatnonzero(self.is_begin[slot] & (at + k < limit))
            if not len(on):
                break
            at, code, limit, begin = at[on], code[on], limit[on], begin[on]
        a, b, piece, depth = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.argsort((depth << 32) | b, kind="stable")
        return a[order], b[order], piece[order], depth[order]


def step(code: np.ndarray, byte: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(code * np.uint64(0x9E3779B97F4A7C15) + byte + np.uint64(1))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def forward(n: int, starts: np.ndarray, edges: tuple, log_p: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all piece sequences from a word's start to each byte position."""
    a, b, piece, depth = edges
    alpha = np.full(n + 1, -np.inf)
    alpha[starts] = 0.0
    cuts = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]])) if len(a) else np.zeros(1, np.int64)
    score = log_p[piece]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        v, end = alpha[a[lo:hi]] + score[lo:hi], b[lo:hi]
        first = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
        top = np.maximum.reduceat(v, first)
        span = np.diff(np.append(first, len(v)))
        total = np.add.reduceat(np.exp(v - np.repeat(top, span)), first)
        alpha_new = top + np.log(total)
        alpha[end[first]] = alpha_new
    return alpha


def _words(blocks: pa.Array, weights: np.ndarray | None = None) -> Iterator[tuple]:
    """Blocks of words, each with its begin byte: bytes, starts, ends, first row, end row."""
    for i, j, buf, offs in text_blocks(blocks, 1 << 18):
        sizes = np.diff(offs) + 1
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        whole = np.empty(int(sizes.sum()), np.uint8)
        whole[starts] = BEGIN
        inner = np.ones(len(whole), bool)
        inner[starts] = False
        whole[inner] = buf
        yield i, j, whole, starts, starts + sizes


def word_scores(words: pa.Array, vocab: Vocabulary, log_p: np.ndarray) -> np.ndarray:
    """Natural log of the marginal probability of each word."""
    out = np.zeros(len(words))
    for i, j, buf, starts, ends in _words(words):
        # a word's last position is the next one's first: read ends from a copy with one place more per word
        alpha = _alpha(buf, starts, ends, vocab, log_p)[0]
        out[i:j] = alpha
    return out


def _alpha(buf, starts, ends, vocab, log_p):
    """Each word's log probability, and what the recursion left: alpha by shifted position, edges by shifted position."""
    word = np.repeat(np.arange(len(starts)), ends - starts)
    a, b, piece, depth = vocab.edges(buf, starts, ends)
    # positions are shifted by the word's number, so that the end of one word is not the start of the next
    w = word[a]
    edges = (a + w, b + w, piece, depth)
    number = np.arange(len(starts))
    alpha = forward(len(buf) + len(starts), starts + number, edges, log_p)
    return alpha[ends + number], alpha, edges, ends + number


def expected_counts(words: pa.Array, counts: np.ndarray, vocab: Vocabulary, log_p: np.ndarray) -> np.ndarray:
    """Expected number of times each piece is used in ``counts`` copies of the words (backward over the posteriors)."""
    total = np.zeros(len(vocab.pieces))
    for i, j, buf, starts, ends in _words(words):
        _, alpha, (a, b, piece, depth), last = _alpha(buf, starts, ends, vocab, log_p)
        node = np.zeros(len(alpha))
        node[last] = counts[i:j]
        share = np.exp(alpha[a] + log_p[piece] - alpha[b])
        cuts = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]]))
        used = np.zeros(len(a))
        for lo, hi in zip(cuts[-2::-1], cuts[:0:-1], strict=True):
            used[lo:hi] = node[b[lo:hi]] * share[lo:hi]
            np.add.at(node, a[lo:hi], used[lo:hi])
        total += np.bincount(piece, weights=used, minlength=len(total))
    return total


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the white space separated tokens and each row's first token."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    solid = ~IS_SPACE[buf]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offs[(offs > 0) & (offs < len(buf))]
    first[inner], last[inner - 1] = solid[inner], solid[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs, "left")


def _spans_array(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow binary column."""
    size = ends - starts
    offs = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    data = buf[np.arange(offs[-1]) + np.repeat(starts - offs[:-1], size)]
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(data.tobytes())])


def _distinct(keys: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place per distinct span and each span's number among those. Spans of one key whose bytes differ from the first one's
    stay apart, each on its own, as their sums are added up by word later on."""
    _, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
    lead = at[inverse]
    other = np.flatnonzero(~same_bytes(low, starts, ends, low, starts[lead], ends[lead]))
    inverse[other] = len(at) + np.arange(len(other))
    return np.concatenate([at, other]), inverse


def _distinct_in_rows(keys: np.ndarray, rows: np.ndarray, low: np.ndarray, starts: np.ndarray,
                      ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_distinct`` within each row."""
    pair = mix(keys + mix(rows.astype(np.uint64)))
    at, inverse = _distinct(pair, low, starts, ends)
    other = np.flatnonzero(rows != rows[at[inverse]])
    inverse[other] = len(at) + np.arange(len(other))
    return np.concatenate([at, other]), inverse


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(learn, text) rows to distinct words per block with their counts in rows that are learned from."""
    for batch in batches:
        learn = np.array(batch.column(0).to_pylist(), np.int64)
        for i, j, buf, offs in text_blocks(batch.column(1), 8 << 20):
            low = LOWER[buf]
            s, e, first = tokens(low, offs)
            at, inverse = _distinct(byte_hashes(low, s, e), low, s, e)
            n = np.bincount(inverse, weights=np.repeat(learn[i:j], np.diff(first)), minlength=len(at)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([_spans_array(low, s[at], e[at]), pa.array(n)], names=["word", "n"])


def _piece_counts(batches: Iterator[pa.RecordBatch], path: str, log_p: np.ndarray) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    total = np.zeros(len(vocab.pieces))
    for batch in batches:
        total += expected_counts(batch.column(0), np.asarray(batch.column(1), np.float64), vocab, log_p)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["piece", "n"])


def _score_words(batches: Iterator[pa.RecordBatch], path: str, log_p: np.ndarray) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(word_scores(batch.column(0), vocab, log_p) / LN10)],
            names=["word", "n", "lp"])


def _doc_parts(batches: Iterator[pa.RecordBatch], frequent: tuple, base: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """(key, text) rows to one row with the sums over frequent words, and a row per other distinct word."""
    keys, counts, scores, letters, begins, stops = frequent
    total, distinct = base
    names = ["key", "word", "tf", "copies", "n_tokens", "n_known", "base", "lp"]
    for batch in batches:
        for i, j, buf, offs in text_blocks(batch.column(1), 4 << 20):
            rows = j - i
            low = LOWER[buf]
            s, e, first = tokens(low, offs)
            doc = np.repeat(np.arange(rows), np.diff(first))
            h = byte_hashes(low, s, e)
            place = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
            hit = keys[place] == h if len(keys) else np.zeros(len(h), bool)
            # a word of the same hash and other bytes goes to the join, by its bytes
            hit[hit] = same_bytes(low, s[hit], e[hit], letters, begins[place[hit]], stops[place[hit]])
            d, p = doc[hit], place[hit]
            add = lambda w: np.bincount(d, weights=w, minlength=rows)  # noqa: B023, E731
            known = add((counts[p] > 0).astype(float)).astype(np.int64)
            b = add(np.log10((counts[p] + 1) / (total + distinct + 1)))
            lp = add(scores[p])
            own = batch.column(0).slice(i, rows)
            null = pa.nulls(rows, pa.binary())
            zeros = np.zeros(rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [own, null, pa.array(zeros), pa.array(zeros + 1), pa.array(np.diff(first) + 1), pa.array(known), pa.array(b), pa.array(lp)],
                names=names)
            rest = np.flatnonzero(~hit)
            if not len(rest):
                continue
            at, inverse = _distinct_in_rows(h[rest], doc[rest], low, s[rest], e[rest])
            tf = np.bincount(inverse, minlength=len(at))
            for k in range(0, len(at), 100_000):
                w = rest[at[k:k + 100_000]]
                m = len(w)
                none, zero = pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(doc[w])), _spans_array(low, s[w], e[w]), pa.array(tf[k:k + 100_000].astype(np.int64)),
                     none, none, none, zero, zero], names=names)


def score_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                    held_out: tuple[int, int] = (7, 2)) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row, learned outside the fold."""
    n, k = held_out
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(fold(key, n) == k, F.lit(False)).alias("held_out"))
    words = materialise(rows.select((~F.col("held_out")).cast("long").alias("learn"), "text")
                        .mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lattice-words")
    ends = rows.filter(~F.col("held_out")).count()
    seen = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))).first()
    total, distinct = seen[0] + ends, seen[1] + (ends > 0)

    vocab = vocabulary(path)
    weight = vocab.prior * PRIOR_WEIGHT
    p_end = (ends + 1) / (ends + 1 + weight.sum())
    log_p = np.log(weight / weight.sum()) + np.log1p(-p_end)
    learned = words.filter("n > 0")
    for _ in range(EM_ROUNDS if total else 0):
        shared = spark.sparkContext.broadcast(log_p)  # one number per piece
        sums = (learned.mapInArrow(lambda it, s=shared: _piece_counts(it, path, s.value), "piece long, n double")
                .groupBy("piece").agg(F.sum("n").alias("n")).collect())
        weight = vocab.prior * PRIOR_WEIGHT
        for r in sums:
            weight[r["piece"]] += r["n"]
        log_p = np.log(weight) - np.log(weight.sum() + ends + 1)
        p_end = (ends + 1) / (weight.sum() + ends + 1)
    shared = spark.sparkContext.broadcast(log_p)
    scored = materialise(words.mapInArrow(lambda it: _score_words(it, path, shared.value), "word binary, n long, lp double"),
                         "lattice-scores")
    top = scored.orderBy(F.desc("n"), "word").limit(FREQUENT)
    least = top.toArrow()
    found = least.column("word").combine_chunks()
    size = np.array([len(w.as_py()) for w in found], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    joined = np.frombuffer(b"".join(w.as_py() for w in found), np.uint8)
    hashes = byte_hashes(joined, begin[:-1], begin[1:])
    order = np.argsort(hashes)
    frequent = (hashes[order], np.asarray(least.column("n"))[order], np.asarray(least.column("lp"))[order],
                joined, begin[:-1][order], begin[1:][order])
    table_ = spark.sparkContext.broadcast(frequent)  # FREQUENT words at most
    base = (total, distinct)
    kind = rows.schema["id"].dataType.simpleString()
    parts = rows.select(F.struct("id", F.xxhash64("text").alias("h"), "held_out").alias("key"), "text").mapInArrow(
        lambda it: _doc_parts(it, table_.value, base),
        f"key struct<id:{kind},h:long,held_out:boolean>, word binary, tf long, copies long, n_tokens long, n_known long, base double, lp double")
    # the pass over the texts is done once: its rows go to the shared folder
    parts = materialise(parts, "lattice-docs")
    rest = parts.filter("word is not null").select("key", "word", "tf").join(scored, "word").select(
        "key", F.lit(None).cast("long").alias("copies"), F.lit(None).cast("long").alias("n_tokens"),
        F.when(F.col("n") > 0, F.col("tf")).otherwise(0).alias("n_known"),
        (F.col("tf") * F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))).alias("base"),
        (F.col("tf") * F.col("lp")).alias("lp"))
    sums = parts.filter("word is null").select("key", "copies", "n_tokens", "n_known", "base", "lp").unionByName(rest)
    end_base = float(np.log10((ends + 1) / (total + distinct + 1)))
    per = sums.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("copies", "n_tokens", "n_known", "base", "lp")))
    one = lambda c: (F.col(c) / F.col("copies"))
    return per.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("key.id").alias(key), F.col("key.held_out").alias("held_out"), one("n_tokens").cast("long").alias("n_tokens"),
        (one("n_known").cast("long") + F.lit(int(ends > 0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (one("base") + F.lit(end_base)).alias("base_score"), (one("lp") + F.lit(float(np.log10(p_end)))).alias("score"))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), default_vocabulary())
