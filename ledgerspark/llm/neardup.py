"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is the weighted set of its shingles (``SHINGLE`` lower-cased words; a text of
fewer words is one shingle), weight 1 + ``REPEAT_WEIGHT`` * ln(count). Every shingle starts a Poisson process
whose rate is its weight; its arrivals hit the registers in a pseudo-random order, and a
register keeps the shingle that arrives first. Arrivals are drawn in rounds for all
shingles at once and a shingle stops when its next arrival comes after the latest
register, so the work is about one draw per shingle plus a constant per text. Two texts agree
on a register with the probability Jaccard similarity of their weights.

Texts of equal shingle multisets become one node first, so exact copies, however many,
cost one comparison. Bands of ``ROWS`` registers are bucket keys. In a bucket, members are
compared with a leader instead of with each other; members that are not joined to the
leader's class meet further leaders, four times as many each round, until every
member of a bucket has met, there or in another bucket, a member of each class in it. Four
bits of every register estimate the similarity of such a pair; a pair whose estimate lies more than
``SIGMAS`` standard deviations below ``SIMILARITY`` goes no further. Each other one is verified
on the whole sets (32-bit shingle hashes): similarity ``SIMILARITY`` or more, as probability
Jaccard or as plain Jaccard of the sets. Classes are the connected components of the
verified links.

Large groups of texts that are almost similar enough would cost the square of their size. So after the first round
every open member's private share is counted: the part of its shingles (the lesser of the parts by number and by
weight) that no other open member holds. Of two members with a share of r or more each, both similarities are at most
(1 - r) / (1 + r); of a member with a share of r and any other, at most 1 - r. So at 0.8 a share above a fifth ends
a member's search, and two shares above a ninth rule a pair out; such pairs are never formed. This loses no link.

Shuffles carry band keys, and the sets of those texts only that share a bucket with
another; a bitmap of fixed size keeps all other texts on their executors.

Defined results: null texts and texts without a word are classes of their own; rows
with a null id belong to a class like any other, its id being the smallest that is not
null; repeated rows fall into one class; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.bitmap import bitmap, maybe_in
from ledgerspark.llm.blocks import mix, text_blocks, window_hashes, word_hashes, word_spans
from ledgerspark.llm.common import materialise, table
from ledgerspark.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
REPEAT_WEIGHT = 0.1  # low, so that the estimate serves the plain Jaccard similarity of the sets as well
BANDS, ROWS = 32, 8  # the bands take the first BANDS * ROWS registers, the estimate takes all
REGISTERS = 512
PLANES, PLANE = 4, REGISTERS // 64
SIGMAS = 4
MOST_LEADERS = 64  # of a bucket in one round
CELL = 512  # members on each side of a block of pairs
SIGNED_ROWS = 2048  # texts whose registers are filled together
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def shingles(buf: np.ndarray, offs: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every distinct shingle, sorted by row and hash."""
    starts, ends, first = word_spans(buf, offs)
    words = word_hashes(buf, starts, ends)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), np.maximum(n_words - width + 1, 0))
    place = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(n_words - width + 1, 0)) - np.maximum(n_words - width + 1, 0),
                                            np.maximum(n_words - width + 1, 0)) + first[:-1][row]
    hashes = window_hashes(words, width)[place] if len(place) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):
        own = np.array([_chain(words[first[r]:first[r + 1]]) for r in short], np.uint64)
        row, hashes = np.concatenate([row, short]), np.concatenate([hashes, own])
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])])) if len(row) else np.zeros(0, np.int64)
    return row[new], hashes[new], np.diff(np.append(new, len(row)))


def _chain(words: np.ndarray) -> int:
    h = np.array([len(words)], np.uint64)
    with np.errstate(over="ignore"):
        for w in words:
            h = mix(h * _C2 + w)
    return int(h[0])


def weights(counts: np.ndarray) -> np.ndarray:
    return 1 + REPEAT_WEIGHT * np.log(counts)


def signatures(row: np.ndarray, key: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """ProbMinHash registers, ``rows`` x ``REGISTERS``; rows without a shingle stay 0."""
    m = REGISTERS
    time, sig = np.full(rows * m, np.inf), np.zeros(rows * m, np.uint64)
    latest = np.full(rows, np.inf)
    # register order of a shingle: a quadratic permutation of 0..m-1 (m a power of two; odd and even factors)
    a = mix(key ^ _C1)
    begin = (a & np.uint64(m - 1)).astype(np.int64)
    odd = ((a >> np.uint64(16)) & np.uint64(m - 1)).astype(np.int64) | 1
    even = ((a >> np.uint64(32)) & np.uint64(m - 1)).astype(np.int64) & ~1
    at = np.zeros(len(key))
    with np.errstate(over="ignore"):
        for i in range(m):
            u = ((mix(key * _C2 + np.uint64(i) * _C3) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            at = at - np.log(u) / (weight * (m - i))
            on = at < latest[row]
            if not on.all():
                row, key, weight, at, begin, odd, even = (v[on] for v in (row, key, weight, at, begin, odd, even))
            if not len(key):
                break
            slot = row * m + ((begin + i * odd + i * i * even) & (m - 1))
            np.minimum.at(time, slot, at)
            won = time[slot] == at
            sig[slot[won]] = key[won]
            if i < 8 or i % 4 == 0:
                latest = time.reshape(rows, m).max(axis=1)
    return sig.reshape(rows, m)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and row."""
    out = np.empty((len(sig), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            h = np.full(len(sig), b + 1, np.uint64)
            for r in range(ROWS):
                h = mix(h * _C1 + sig[:, b * ROWS + r])
            out[:, b] = h
    return out


def sketches(sig: np.ndarray) -> np.ndarray:
    """The low ``PLANES`` bits of every register as bit planes: ``rows`` x ``PLANES`` * ``PLANE`` longs."""
    planes = [np.packbits(((sig >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.int64)
              for k in range(PLANES)]
    return np.concatenate(planes, axis=1)


def may_be_similar(a: Column, b: Column, least: float) -> Column:
    """Whether two sketches differ in no more registers than pairs of similarity ``least`` do (to ``SIGMAS``)."""
    p = (1 - least) * (1 - 0.5 ** PLANES)  # registers of different shingles may agree in all planes by chance
    most = REGISTERS * p + SIGMAS * (REGISTERS * p * (1 - p)) ** 0.5
    differ = [F.bit_count(reduce(Column.bitwiseOR, [a[j * PLANE + k].bitwiseXOR(b[j * PLANE + k]) for j in range(PLANES)]))
              for k in range(PLANE)]
    return sum(differ[1:], differ[0]) <= int(most)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text hash, text) rows to (id, text hash, digest of the shingle multiset, band keys, sketch); no words: nulls."""
    for batch in batches:
        for i, j, buf, offs in text_blocks(batch.column(2), block_rows=SIGNED_ROWS):
            row, key, count = shingles(buf, offs)
            sig = signatures(row, key, weights(count), j - i)
            bands, sketch = band_keys(sig).view(np.int64), sketches(sig)
            lists = lambda v: pa.ListArray.from_arrays(
                pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel()))
            first = np.searchsorted(row, np.arange(j - i + 1))
            digests = [blake2b(key[a:b].tobytes() + count[a:b].tobytes(), digest_size=16).digest() if b > a else None
                       for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(digests, pa.binary()),
                 lists(bands), lists(sketch)], names=["id", "h", "digest", "bands", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text hash, text) rows to their sets as bytes: distinct 32-bit shingle hashes, sorted, then their counts."""
    for batch in batches:
        for i, j, buf, offs in text_blocks(batch.column(2)):
            row, key, count = shingles(buf, offs)
            first = np.searchsorted(row, np.arange(j - i + 1))
            out = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                keys, inverse = np.unique((key[a:b] >> np.uint64(32)).astype(np.uint32), return_inverse=True)
                out.append(_packed(keys, np.bincount(inverse, weights=count[a:b], minlength=len(keys)).astype(np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(out, pa.binary())],
                names=["id", "h", "members"])


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    many = np.flatnonzero(counts > 1).astype(np.uint32)  # counts of one are not written
    return b"".join([np.array([len(keys)], np.uint32).tobytes(), keys.tobytes(), many.tobytes(), counts[many].tobytes()])


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(data, np.uint32)
    n = int(v[0])
    counts, many = np.ones(n), v[n + 1:]
    counts[many[:len(many) // 2]] = many[len(many) // 2:]
    return v[1:n + 1], weights(counts)


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the probability Jaccard of the weights and the plain Jaccard of the sets."""
    (a, wa), (b, wb) = x, y
    if not len(a) or not len(b):
        return 0.0
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[place] == a
    n = int(both.sum())
    if not n:
        return 0.0
    plain = n / (len(a) + len(b) - n)
    if plain >= SIMILARITY:
        return plain
    wx, wy = wa[both], wb[place[both]]
    if (wx == 1).all() and (wy == 1).all() and wa.max() == 1 and wb.max() == 1:
        return plain
    # sum over common d of 1 / sum over all d' of max(x_d'/x_d, y_d'/y_d): sort common shingles by y/x, then prefix sums
    ratio = wy / wx
    order = np.argsort(ratio, kind="stable")
    wx, wy, ratio = wx[order], wy[order], ratio[order]
    only_x, only_y = wa.sum() - wx.sum(), wb.sum() - wy.sum()
    # d' with y_d'/x_d' <= y_d/x_d: x_d'/x_d is the larger
    upto = np.searchsorted(ratio, ratio, "right")
    sx, sy = np.concatenate([[0], np.cumsum(wx)]), np.concatenate([[0], np.cumsum(wy)])
    below = (sx[upto] + only_x) / wx
    above = (sy[-1] - sy[upto] + only_y) / wy
    return max(plain, float((1 / (below + above)).sum()))


def _verify(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(a, b, set of a, set of b) rows to the links that hold."""
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        kept = [k for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True))
                if similarity(_unpacked(x.as_py()), _unpacked(y.as_py())) >= least]
        yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in kept], pa.int64()), pa.array([b[k] for k in kept], pa.int64())],
                                         names=["a", "b"])


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, set) rows to one row per shingle: node, hash, weight."""
    for batch in batches:
        for node, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            keys, weight = _unpacked(data.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), node)), pa.array(keys.view(np.int32)), pa.array(weight)],
                names=["node", "shingle", "weight"])


def private_shares(sets: DataFrame) -> DataFrame:
    """``node, share``: the part of each node's shingles that no other node holds, by number or weight, whichever is less.

    Linear in the shingles. The aggregation by shingle is partial first, so one that all nodes hold is one row a task.
    """
    each = sets.select("node", "members").mapInArrow(_shingle_rows, "node long, shingle int, weight double")
    held = each.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("hi"), F.max("weight").alias("weight"))
    own = held.filter("node = hi").groupBy("node").agg(F.count(F.lit(1)).alias("own_n"), F.sum("weight").alias("own_w"))
    whole = each.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    return whole.join(own, "node", "left").select(
        "node", F.coalesce(F.least(F.col("own_n") / F.col("n"), F.col("own_w") / F.col("w")), F.lit(0.0)).alias("share"))


def _row_key() -> Column:
    return F.xxhash64("id", "h")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``id, h, class_id, n_class``: per row its id, text hash, class (its smallest id) and the rows in that class."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("h"),
                       F.col(text).cast("string").alias("text"))
    signed = materialise(rows.mapInArrow(_sign, "id long, h long, digest binary, bands array<long>, sketch array<long>"), "dup-signed")
    # one node per distinct multiset; its row key names the row whose text stands for it
    nodes = materialise(signed.filter("digest is not null").groupBy("digest").agg(
        F.min_by("bands", F.struct("id", "h")).alias("bands"), F.min_by("sketch", F.struct("id", "h")).alias("sketch"), F.min(F.struct("id", "h")).alias("row"),
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "dup-nodes")
    keys = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket")
    members = materialise(keys.join(shared, "bucket"), "dup-members")
    met = materialise(members.select("node").distinct(), "dup-met")
    # wide columns of nodes that share no bucket stay where they are
    known = maybe_in(nodes, F.xxhash64("node"), materialise(bitmap(met, F.xxhash64("node")), "dup-met-bitmap")).join(met, "node")
    wanted = materialise(known.select("node", "row.id", "row.h", "sketch"), "dup-wanted")
    bits = materialise(bitmap(wanted, _row_key()), "dup-bitmap")
    sets = (maybe_in(rows, _row_key(), bits).select("id", "h", "text")
            .mapInArrow(_sets, "id long, h long, members binary"))
    # repeated rows share their key; null ids match null ids
    sets = sets.join(wanted.select("node", "id", "h"), sets["id"].eqNullSafe(wanted["id"]) & (sets["h"] == wanted["h"])).groupBy("node").agg(
        F.first("members").alias("members"))
    sets = materialise(sets, "dup-sets")
    label = _joined(members, wanted.select("node", "sketch"), sets, least)
    found = nodes.select("node", "digest", "first_id", "n").join(label, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    of_class = found.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("n_class"))
    by_digest = found.join(of_class, "label").select("digest", "class_id", "n_class")
    return signed.select("id", "h", "digest").join(by_digest, "digest", "left").select(
        "id", "h", F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_class", F.lit(1).cast("long")).alias("n_class"))


def _joined(members: DataFrame, wide: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``node, label`` for all nodes that a verified link joins.

    ``wide`` holds the sketches of the nodes; rows carry them only while pairs are formed. Leaders join most of
    them; then the pairs that are left are looked at one by one.
    """
    spark = members.sparkSession
    tried, used, label = None, None, None
    open_ = members.select("bucket", "node", F.col("node").alias("label"), F.lit(False).alias("far"))
    wide = wide.select("node", "sketch")
    similar = may_be_similar(F.col("sketch"), F.col("seen"), least)
    leaders = 1
    while not open_.isEmpty():
        if leaders:
            chosen = _leaders(open_, used, leaders)
            spent = chosen.select(F.col("at").alias("bucket"), "leader")
            used = spent if used is None else used.unionByName(spent)
            pairs = _led(open_, chosen, wide, similar, leaders == 1)
        else:
            pairs = _rest(open_, wide, similar)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "dup-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        a = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
        b = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
        links = materialise(pairs.join(a, "a").join(b, "b").select("a", "b", "ma", "mb").mapInArrow(
            lambda it: _verify(it, least), "a long, b long"), "dup-links")
        found = not links.isEmpty()
        if found:
            edges = links if label is None else links.unionByName(label.select(F.col("node").alias("a"), F.col("label").alias("b")))
            label = connected_components(edges, "dup-components")
        if not leaders:  # all pairs of different classes have been looked at
            break
        if found:  # buckets of one class are done
            now = open_.drop("label").join(label, "node", "left").select(
                "bucket", "node", F.coalesce("label", "node").alias("label"), "far")
            open_ = _mixed(now)
        following = leaders * 4 if leaders == 1 or found and leaders < MOST_LEADERS else 0
        if leaders == 1 or not following:
            open_ = _narrowed(open_, sets, least)
        leaders = following
    if label is None:
        return spark.createDataFrame([], "node long, label long")
    return label


def _mixed(open_: DataFrame) -> DataFrame:
    """The members of buckets of several classes that hold one member at least that is not ``far``."""
    mixed = open_.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("far").alias("all_far"))
    return materialise(open_.join(mixed.filter("lo <> hi and not all_far").select("bucket"), "bucket"), "dup-open")


def _narrowed(open_: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``open_`` without the members that can have no link to another one; ``far`` marks those that link to no far one."""
    slack = 1e-9  # sums of weights are rounded
    nodes = materialise(open_.select("node").distinct(), "dup-open-nodes")
    shares = materialise(private_shares(sets.join(nodes, "node")).filter(F.col("share") <= 1 - least + slack).select(
        "node", (F.col("share") > (1 - least) / (1 + least) + slack).alias("far")), "dup-shares")
    return _mixed(open_.drop("far").join(shares, "node").select("bucket", "node", "label", "far"))


def _leaders(open_: DataFrame, used: DataFrame | None, leaders: int) -> DataFrame:
    """``at, leader, led, far_leader``: the classes that lead a bucket this round; each node serves a bucket once.

    A class is led by its node of least hash, one that is not far if there is one. In the first round that order is the same in all buckets, so that a group
    meets few leaders; afterwards each bucket has its own.
    """
    turn = F.xxhash64("node") if leaders == 1 else F.xxhash64("node", "bucket")
    first = open_.groupBy("bucket", "label").agg(F.min(F.struct("far", turn.alias("turn"), "node")).alias("l")).select(
        "bucket", "label", F.col("l.node").alias("leader"), F.col("l.turn").alias("turn"), F.col("l.far").alias("far_leader"))
    if used is not None:
        first = first.join(used, ["bucket", "leader"], "left_anti")
    order = Window.partitionBy("bucket").orderBy("far_leader", "turn", "leader")
    return materialise(first.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= leaders)
                       .select(F.col("bucket").alias("at"), "leader", F.col("label").alias("led"), "far_leader"), "dup-leaders")


def _led(open_: DataFrame, chosen: DataFrame, wide: DataFrame, similar: Column, single: bool) -> DataFrame:
    """``a, b``: members with the leaders of other classes in their buckets, as far as the sketches are ``similar``."""
    meets = (F.col("bucket") == F.col("at")) & (F.col("label") != F.col("led")) & ~(F.col("far") & F.col("far_leader"))
    of_leader = wide.select(F.col("node").alias("leader"), F.col("sketch").alias("seen"))
    both = [F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")]
    if single:  # a bucket yields fewer pairs than it has members; estimates come after
        pairs = open_.join(chosen, meets).select(*both).distinct().withColumnsRenamed({"a": "node", "b": "leader"})
        return pairs.join(wide, "node").join(of_leader, "leader").filter(similar).select(*both)
    return open_.join(wide, "node").join(chosen.join(of_leader, "leader"), meets & similar).select(*both).distinct()


def _rest(open_: DataFrame, wide: DataFrame, similar: Column) -> DataFrame:
    """``a, b``: all pairs of different classes that share a bucket and are not both far, as far as the sketches are ``similar``.

    One side of such a pair is not far, and one is outside the bucket's largest class. Whichever of these two sets is the
    smaller one, by all members of the bucket is a grid, cut into cells of about ``CELL`` x ``CELL``, so that no task
    has a whole bucket and no cell is of far members only.
    """
    sizes = open_.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("m"), F.count_if(~F.col("far")).alias("k")).groupBy("bucket").agg(
        F.sum("m").alias("size"), F.sum("k").alias("near"), F.max(F.struct("m", "label")).alias("top"))
    few = F.col("near") < F.col("size") - F.col("top.m")
    rows, columns = F.ceil(F.least(F.col("near"), F.col("size") - F.col("top.m")) / CELL), F.ceil(F.col("size") / CELL)
    sized = open_.join(sizes, "bucket").select(
        "bucket", "node", "label", "far", F.when(few, ~F.col("far")).otherwise(F.col("label") != F.col("top.label")).alias("in_rows"),
        rows.alias("rows"), columns.alias("columns")).join(wide, "node")
    cells = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    others = sized.filter("in_rows").select(
        "bucket", F.col("node").alias("other"), F.col("label").alias("led"), F.col("far").alias("far_leader"), F.col("sketch").alias("seen"),
        F.pmod(F.xxhash64("node"), "rows").alias("row"), cells("columns").alias("column"))
    every = sized.select("bucket", "node", "label", "far", "in_rows", "sketch",
                         F.pmod(F.xxhash64("node"), "columns").alias("column"), cells("rows").alias("row"))
    once = (F.col("label") != F.col("led")) & ~(F.col("far") & F.col("far_leader")) & (~F.col("in_rows") | (F.col("node") < F.col("other")))
    return every.join(others, ["bucket", "row", "column"]).filter(once & similar).select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "n_class")
