"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of whole documents inside one task. Its text is the sequence of
word symbols over the alphabet of the test phrases (any other word, and every
document border, is symbol 0, which no phrase holds). The shard is indexed as a
Burrows-Wheeler transform in a wavelet tree with sampled suffix positions; all
test phrases are backward-searched together through its ranks, occurrences are
located by walking to the next sampled suffix, and their spans are merged per
document. No document leaves its task, so the operator shuffles nothing.

A test phrase is ``WINDOW`` consecutive words of an item; an item of fewer words
(not none) is one phrase. Runs of symbols shorter than the shortest phrase
cannot hold an occurrence and are folded into symbol 0 before indexing, which
loses nothing.

The phrase table is broadcast in blocks of at most ``MAX_BLOCK_WORDS`` words; a
larger benchmark is searched block by block and the results are merged by
document, so the bound holds at any size.

Defined results: null or empty text has no words and no hits; null item text is
no phrase; a null item_id is the text ``null``; repeated items count once per
distinct id; repeated documents give repeated rows; an empty table on
either side gives no rows or no hits; further columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import LOWER, byte_hashes, code_point_offsets, same_bytes, text_blocks, text_bytes, word_spans
from ledgerspark.llm.common import materialise, table

WINDOW = 10
MAX_BLOCK_WORDS = 2_000_000
SHARD_SYMBOLS = 1 << 21
SAMPLE_EVERY = 8


class BitRank:
    """Bits packed in 64-bit words with a running count: rank by popcount."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        w, low = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Ranks over a symbol sequence: one bit vector per level, zeros of a level before its ones."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            b = (seq >> level) & 1
            self.levels.append(BitRank(b.astype(np.uint8)))
            self.zeros.append(int(len(b) - b.sum()))
            seq = np.concatenate([seq[b == 0], seq[b == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``at`` entries (arrays of equal length)."""
        lo, hi = np.zeros_like(at), at
        for level, zeros, shift in zip(self.levels, self.zeros, range(self.bits - 1, -1, -1), strict=True):
            one = ((symbol >> shift) & 1).astype(bool)
            l1, h1 = level.ones(lo), level.ones(hi)
            lo, hi = np.where(one, zeros + l1, lo - l1), np.where(one, zeros + h1, hi - h1)
        return hi - lo

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each index and its rank there."""
        symbol, lo, pos = np.zeros_like(at), np.zeros_like(at), at
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            one = level.get(pos).astype(bool)
            l1, p1 = level.ones(lo), level.ones(pos)
            symbol = (symbol << 1) | one
            lo, pos = np.where(one, zeros + l1, lo - l1), np.where(one, zeros + p1, pos - p1)
        return symbol, pos - lo


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that are still tied are sorted again."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    group = np.empty(n, np.int64)  # number of the first place of a suffix's tie group
    heads = np.concatenate([[True], seq[order][1:] != seq[order][:-1]])
    group[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    step = 1
    while True:
        tied = np.flatnonzero(~(heads & np.append(heads[1:], True)))  # places in groups of two or more
        if not len(tied):
            return order
        s = order[tied]
        nxt = np.where(s + step < n, group[np.minimum(s + step, n - 1)] + 1, 0)
        base = group[s]
        k = np.lexsort((nxt, base))
        s, nxt, base = s[k], nxt[k], base[k]
        order[tied] = s
        new = np.concatenate([[True], (base[1:] != base[:-1]) | (nxt[1:] != nxt[:-1])])
        heads[tied] = new
        group[s] = np.maximum.accumulate(np.where(new, tied, 0))
        step *= 2


class FMIndex:
    """Full-text index of a symbol sequence (symbols 0..sigma-1).

    Inside, symbols are one higher and a single 0 ends the text, so that row order and ranks agree.
    """

    def __init__(self, seq: np.ndarray, sigma: int, sample_every: int = SAMPLE_EVERY):
        seq, sigma = np.append(seq + 1, 0).astype(np.int64), sigma + 1
        self.n = len(seq)
        order = suffix_order(seq)
        self.tree = WaveletTree(seq[order - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))]).astype(np.int64)
        sampled = order % sample_every == 0
        self.sampled = BitRank(sampled.astype(np.uint8))
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of the suffixes that begin with each phrase (rows of ``phrases``, left-aligned)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            on = np.flatnonzero((lengths >= back) & (lo < hi))
            if not len(on):
                break
            c = phrases[on, lengths[on] - back] + 1
            lo[on] = self.first[c] + self.tree.rank(c, lo[on])
            hi[on] = self.first[c] + self.tree.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row: step back to a sampled one, counting the steps."""
        at, steps, out = rows.copy(), 0, np.zeros_like(rows)
        todo = np.arange(len(rows))
        while len(todo):
            there = self.sampled.get(at[todo]).astype(bool)
            hit = todo[there]
            out[hit] = self.samples[self.sampled.ones(at[hit])] + steps
            todo = todo[~there]
            if len(todo):
                c, r = self.tree.access_rank(at[todo])
                at[todo] = self.first[c] + r
                steps += 1
        return out


class Phrases:
    """Distinct test phrases over the alphabet of their words, and the items each belongs to."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        texts = pa.array([t for _, t in items], pa.string())
        buf, offs = text_bytes(texts)
        starts, ends, first = word_spans(buf, offs)
        low = LOWER[buf]
        words = [low[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        distinct = sorted(set(words))
        limits = np.concatenate([[0], np.cumsum([len(w) for w in distinct], dtype=np.int64)])
        self.letters = np.frombuffer(b"".join(distinct), np.uint8)
        hashes = byte_hashes(self.letters, limits[:-1], limits[1:])
        by_hash = np.argsort(hashes, kind="stable")
        self.vocabulary, self.starts, self.ends = hashes[by_hash], limits[:-1][by_hash], limits[1:][by_hash]
        # words of one hash stand side by side; ``symbols`` tries as many
        self.most = int(np.unique(hashes, return_counts=True)[1].max()) if len(hashes) else 0
        symbol = {distinct[k]: n for n, k in enumerate(by_hash.tolist(), 1)}
        ids = np.array([symbol[w] for w in words], np.int64)
        found: dict[tuple, set[int]] = {}
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        for row, (item, _) in enumerate(items):
            w = ids[first[row]:first[row + 1]].tolist()
            for a in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[a:a + window]), set()).add(number[item])
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.table = np.zeros((len(found), window), np.int64)
        for k, p in enumerate(found):
            self.table[k, :len(p)] = p
        self.owners = [sorted(s) for s in found.values()]

    @property
    def sigma(self) -> int:
        return len(self.vocabulary) + 1

    def symbols(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word in the alphabet, 0 for others: found by its hash, decided by its bytes."""
        out = np.zeros(len(starts), np.int64)
        low = LOWER[buf]
        hashes = byte_hashes(low, starts, ends)
        first = np.searchsorted(self.vocabulary, hashes)
        for k in range(self.most):
            at = np.minimum(first + k, len(self.vocabulary) - 1)
            hit = np.flatnonzero((self.vocabulary[at] == hashes) & (out == 0))
            w = at[hit]
            equal = same_bytes(low, starts[hit], ends[hit], self.letters, self.starts[w], self.ends[w])
            out[hit[equal]] = w[equal] + 1
        return out


class Shard:
    """Word symbols of consecutive documents, cut down to the runs that can hold a phrase."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.pieces, self.size = phrases, [], 0

    def add(self, symbols: np.ndarray, first_word: np.ndarray, row: int) -> None:
        """Words of the rows ``row``, ``row + 1`` ...; ``first_word`` delimits them."""
        shortest = int(self.phrases.lengths.min(initial=WINDOW))
        known = symbols > 0
        cut = np.ones(len(symbols) + 1, bool)  # a run of known words starts or ends before this word
        cut[1:-1] = known[1:] != known[:-1]
        cut[first_word] = True
        at = np.flatnonzero(cut)
        long = known[at[:-1]] & (np.diff(at) >= shortest) if len(symbols) else np.zeros(0, bool)
        for a, b in zip(at[:-1][long], at[1:][long], strict=True):
            doc = int(np.searchsorted(first_word, a, "right")) - 1
            self.pieces.append((row + doc, int(a - first_word[doc]), symbols[a:b]))
            self.size += int(b - a) + 1

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, first word and phrase of every occurrence of a phrase in the shard."""
        none = np.zeros(0, np.int64)
        if not self.pieces or not len(self.phrases.lengths):
            return none, none, none
        seq = np.zeros(self.size, np.int64)
        begin = np.cumsum([0] + [len(p) + 1 for _, _, p in self.pieces])
        for k, (_, _, p) in enumerate(self.pieces):
            seq[begin[k]:begin[k] + len(p)] = p
        index = FMIndex(seq, self.phrases.sigma)
        lo, hi = index.search(self.phrases.table, self.phrases.lengths)
        counts = hi - lo
        phrase = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
        at = index.locate(rows)
        piece = np.searchsorted(begin, at, "right") - 1
        row = np.array([p[0] for p in self.pieces], np.int64)[piece]
        word = np.array([p[1] for p in self.pieces], np.int64)[piece] + at - begin[piece]
        return row, word, phrase


def merged_spans(start: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Union of word intervals, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(start.tolist(), (start + length).tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


SCHEMA = ("n_words long, items array<string>, word_spans array<struct<start:long,end:long>>, "
          "char_spans array<struct<start:long,end:long>>")
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        n = batch.num_rows
        n_words = np.zeros(n, np.int64)
        items: list[list[str]] = [[] for _ in range(n)]
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        chars: list[list[tuple[int, int]]] = [[] for _ in range(n)]

        def close(shard: Shard) -> None:
            row, word, phrase = shard.occurrences()
            by_row = np.argsort(row, kind="stable")
            row, word, phrase = row[by_row], word[by_row], phrase[by_row]
            edges = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])) if len(row) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                r = int(row[a])
                p = phrase[a:b]
                spans[r] = merged_spans(word[a:b], phrases.lengths[p])
                own = {o for k in np.unique(p).tolist() for o in phrases.owners[k]}
                items[r] = sorted(phrases.items[o] for o in own)
                buf, offs = text_bytes(texts.slice(r, 1))
                s, e, _ = word_spans(buf, offs)
                at = code_point_offsets(buf, np.concatenate([s[[x for x, _ in spans[r]]], e[[y - 1 for _, y in spans[r]]]]))
                k = len(spans[r])
                chars[r] = list(zip(at[:k].tolist(), at[k:].tolist(), strict=True))

        shard = Shard(phrases)
        for i, j, buf, offs in text_blocks(texts):
            s, e, first = word_spans(buf, offs)
            n_words[i:j] = np.diff(first)
            if phrases.sigma > 1:
                shard.add(phrases.symbols(buf, s, e), first, i)
            if shard.size >= SHARD_SYMBOLS:
                close(shard)
                shard = Shard(phrases)
        close(shard)
        struct = lambda rows: [[{"start": a, "end": b} for a, b in r] for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words), pa.array(items, pa.list_(pa.string())),
             pa.array(struct(spans), _SPAN), pa.array(struct(chars), _SPAN)],
            names=["key", "n_words", "items", "word_spans", "char_spans"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text", window: int = WINDOW,
               max_block_words: int = MAX_BLOCK_WORDS) -> DataFrame:
    """Per document: ``key``, word count, the items that occur in it and the merged spans to remove.

    ``word_spans`` count words, ``char_spans`` code points; ends are exclusive.
    """
    spark = docs.sparkSession
    sized = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text).cast("string").alias("phrase")).filter("phrase is not null")
    words = sized.agg(F.sum(F.length("phrase"))).first()[0] or 0
    n_blocks = max(1, -(-int(words) // (2 * max_block_words)))  # a word takes two characters at least, with its border
    block = F.pmod(F.xxhash64("item", "phrase"), F.lit(n_blocks))
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    parts = []
    for k in range(n_blocks):
        rows = sized.filter(block == k).distinct().collect() if n_blocks > 1 else sized.distinct().collect()
        phrases = spark.sparkContext.broadcast(Phrases([(r["item"], r["phrase"]) for r in rows], window))
        kind = docs.schema[key].dataType.simpleString()
        parts.append((phrases, f"key {kind}, {SCHEMA}"))
    if n_blocks == 1:
        shared, schema = parts[0]
        return source.mapInArrow(lambda it: _scan(it, shared.value), schema).withColumnRenamed("key", key)
    # A larger benchmark: number the rows once, search each block, then merge by row.
    kind = docs.schema[key].dataType.simpleString()
    numbered = materialise(source.withColumn("row", F.monotonically_increasing_id()), "leak-docs")
    found = None
    for shared, _ in parts:
        one = numbered.select("row", "text").mapInArrow(lambda it, s=shared: _scan(it, s.value), f"key long, {SCHEMA}")
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("key").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        _union_spans("word_spans"), _union_spans("char_spans"))
    return (numbered.select("row", F.col("key").alias("id")).join(merged, F.col("row") == F.col("key"))
            .select(F.col("id").cast(kind).alias(key), "n_words", "items", "word_spans", "char_spans"))


def _union_spans(name: str):
    """Merge the spans that several benchmark blocks found in one row (their sizes are bounded by the text)."""
    spans = F.array_sort(F.flatten(F.collect_list(name)))
    empty = F.array().cast("array<struct<start:long,end:long>>")
    return F.aggregate(spans, empty, lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"),
            F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s)))).alias(name)


def remove_spans(text, spans):
    """``text`` without the code point ``spans`` (sorted, disjoint, end exclusive)."""
    kept = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda acc, s: F.struct(
        F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))).alias("out"),
        s["end"].alias("at")))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(kept["out"], F.substring(text, (kept["at"] + 1).cast("int"), F.length(text))))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


_WORDS = ("regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

OP2_SQL = f"""
WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
phrase AS (
    SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS p, least(len(w), 10) AS n
    FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM phrase),
hit AS (
    SELECT r, i, n, item FROM (
        SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
        FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, sizes WHERE len(w) >= n))
    JOIN phrase USING (p, n)),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
