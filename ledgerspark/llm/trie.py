"""Prefix trie of conversations, rolled up by depth bands.

A node is a distinct sequence of first turns; its key is a digest of that sequence. Turns are digested
where they are read, so that texts never travel; then one pass over every conversation's sorted turns emits a row per
prefix, with a running digest and constant memory whatever the number of turns.

Sums over subtrees go up by bands of ``height`` depths. Within a band every node explodes to its
ancestors of that band only, so to ``height`` rows at most. The bands are completed from the deepest
one upwards: the totals of a completed band's roots are handed to the chain of their parent in the band above,
where they explode with that band's own nodes. The height is ``BAND`` or the square root of the greatest depth if that is
more, so that neither the number of rounds nor the explosion exceeds the root of the depth by more than ``BAND``.

Hot groups: a node that a third of all conversations share is counted by partial aggregation; the list of its ending
conversations is put together from bounded chunks of ids and digested as a stream; the join with the parents is left to
Spark's skew join, but for the children of the root, which get their parent's id from one broadcast row.

Defined results: a null role or text counts as empty; turns are ordered by number, null first, equal numbers by the
digest of role and text (so repeated rows stay repeated turns); rows without a conversation id belong to none and
are left out; an empty table has no nodes; other columns are ignored. ``c % 100`` has the sign of ``c``, as in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.llm.common import fold, materialise, table

GROUP, HEADS = 100, 6  # conversations of one hundred share up to five first turns
BAND = 32
CHUNK_BITS = 12  # ids of one chunk of a node's list: 4,096 at most
KEY_BYTES = 16
EMPTY = sha256(b"").hexdigest()

PREFIXES = "key binary, depth long, chars long, chain binary, above binary, conv_id long, ends boolean"


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, pos, digest, chars``: the turns of every rebuilt conversation in the order (part, pos).

    Part -1 is one row per conversation without a turn, part 0 holds the turns of the first conversation of its group, part 1
    its own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    turns = materialise(turns.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "chars"), "turns")
    heads = fold("conv_id", HEADS).cast("long")
    each = turns.filter("pos = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("first"), heads.alias("heads"))
    none = F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("chars")
    marks = each.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("pos"), *none)
    lent = (turns.filter(f"pos < {HEADS} and conv_id % {GROUP} = 0").withColumnRenamed("conv_id", "first")
            .join(each, "first").filter("pos <= heads").select("conv_id", F.lit(0).alias("part"), "pos", "digest", "chars"))
    own = turns.filter(F.col("pos") > heads).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "chars")
    return marks.unionByName(lent).unionByName(own)


def turn_digest(role: Column, text: Column) -> Column:
    """Digest of one turn; the role's length in front keeps role and text apart."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


def prefixes(turns: DataFrame, height: int) -> DataFrame:
    """One row per conversation and depth: the node's key, the ``chain`` of keys from its band's root to itself, and, for
    the root of a band, the chain of its parent (``above``)."""
    n = turns.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = turns.repartition(int(n), "conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return dealt.select("conv_id", "part", "digest", "chars").mapInArrow(lambda it: _walk(it, height), PREFIXES)


def _walk(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    running, depth, chain, waiting = None, 0, b"", None
    types = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    names = [f.split()[0] for f in PREFIXES.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for b in batches:
        out = []
        for conv, part, digest, chars in zip(*(c.to_pylist() for c in b.columns)):
            if part < 0:
                if waiting:
                    out.append((*waiting, True))
                running, depth, chain, above = sha256(), 0, b"", b""
            else:
                out.append((*waiting, False))
                depth += 1
                running.update(digest.encode())
                above = chain if depth % height == 0 else b""
                chain = b"" if above else chain
            key = running.digest()[:KEY_BYTES]
            chain += key
            waiting = (key, depth, chars, chain, above, conv)
            if len(out) >= 4096:
                yield batch(out)
                out = []
        yield batch(out)
    if waiting:
        yield batch([(*waiting, True)])


def nodes(prefix_rows: DataFrame) -> DataFrame:
    """One row per node: ``key, depth, chars, chain, above, n_convs, conv_id, n_ends``."""
    return prefix_rows.groupBy("key", "depth", "chars", "chain", "above").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(F.col("ends").cast("long")).alias("n_ends"))


def _up(rows: DataFrame, chain: str, *values: str) -> DataFrame:
    """Every row once per key of ``chain``, with its distance from the chain's end."""
    size = (F.length(chain) / KEY_BYTES).cast("int")
    keys = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.substring(F.col(chain), i * KEY_BYTES + 1, F.lit(KEY_BYTES)).alias("key"), (size - 1 - i).alias("up")))
    return rows.select(F.explode(keys).alias("a"), *values).select("a.key", "a.up", *values)


def roll_up(node_rows: DataFrame, height: int, depth: int) -> DataFrame:
    """``key, n_children, n_leaves, saved_tokens``: sums over the subtree of each node, band by band from below.

    ``node_rows`` must be a written table, as every band reads it.
    """
    own = node_rows.withColumn("leaf", (F.col("n_ends") == F.col("n_convs")).cast("long")).withColumn(
        "saved", (F.col("n_convs") - 1) * F.col("chars"))
    done: list[DataFrame] = []
    handed: DataFrame | None = None
    for band in range(depth // height, -1, -1):
        here = own.filter(f"depth >= {band * height} and depth < {(band + 1) * height}")
        parts = _up(here, "chain", "leaf", "saved").withColumn("child", (F.col("up") == 1).cast("long"))
        if handed is not None:
            parts = parts.unionByName(_up(handed, "above", "leaf", "saved").withColumn("child", (F.col("up") == 0).cast("long")))
        total = materialise(parts.groupBy("key").agg(
            F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")), f"band-{band}")
        done.append(total)
        if band:
            roots = here.filter(f"depth = {band * height}").select("key", "above")
            handed = roots.join(total, "key").select("above", F.col("n_leaves").alias("leaf"), F.col("saved_tokens").alias("saved"))
    return reduce(DataFrame.unionByName, done)


def ending(prefix_rows: DataFrame) -> DataFrame:
    """``key, ends_sha256``: digest of the ids of the conversations that end at each node.

    Ids are gathered in chunks of neighbouring ones (a conversation ends once, so a chunk is bounded); lists of one chunk
    are digested at once, longer ones as a stream of their chunks.
    """
    block = F.shiftright("conv_id", CHUNK_BITS)
    chunks = (prefix_rows.filter("ends").groupBy("key", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
              .select("key", "block", F.concat_ws(",", F.transform("ids", lambda i: i.cast("string"))).alias("part")))
    chunks = materialise(chunks, "ends")
    several = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("only"))
    one = several.filter("n = 1").select("key", F.sha2("only", 256).alias("ends_sha256"))
    many = chunks.join(several.filter("n > 1").select("key"), "key", "left_semi")
    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = many.repartition(n, "key").sortWithinPartitions("key", "block").select("key", "part")
    return one.unionByName(dealt.mapInArrow(_digests, "key binary, ends_sha256 string"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, running, out = None, None, []
    for b in batches:
        for k, part in zip(*(c.to_pylist() for c in b.columns)):
            if k != key:
                if running:
                    out.append((key, running.hexdigest()))
                key, running = k, sha256(part.encode())
            else:
                running.update(b"," + part.encode())
        yield _pairs(out)
        out = []
    if running:
        yield _pairs([(key, running.hexdigest())])


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([h for _, h in rows], pa.string())],
                                      names=["key", "ends_sha256"])


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    ``key, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    turns = materialise(rebuilt(conversations), "rebuilt")
    depth = turns.filter("part >= 0").groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    height = max(band, math.isqrt(depth) + 1)
    rows = materialise(prefixes(turns, height), "prefixes")
    every = materialise(nodes(rows), "nodes")
    totals, ends = roll_up(every, height, depth), ending(rows)
    # the parent stands before the node in its chain, or at the end of the chain above
    chain = F.when(F.length("above") > 0, F.col("above")).otherwise(F.expr(f"substring(chain, 1, length(chain) - {KEY_BYTES})"))
    child = every.drop("chars").withColumn("parent", F.substring(chain, -KEY_BYTES, KEY_BYTES)).drop("chain", "above")
    up = every.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    top = child.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    root = every.filter("depth = 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    second = child.filter("depth = 1").join(F.broadcast(root), "parent")
    deeper = child.filter("depth > 1").join(up, "parent")
    linked = reduce(DataFrame.unionByName, [top, second, deeper]).drop("parent")
    return (linked.join(totals, "key").join(ends, "key", "left")
            .select("key", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("key")


# DuckDB: a node is the joined digests of its turns; subtrees by prefix comparison of those. crc32 goes bit by bit.
OP12_SQL = """
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, digest) as pos, digest, chars
  from (select conv_id, turn, sha256(length(role) || ':' || role || text) as digest, length(text) as chars
        from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
              from conversations where conv_id is not null))),
convs as (
  select conv_id, conv_id - conv_id % 100 as first,
         xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''),
               lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
             lambda a, b: xor(xor(a, b) >> 1, 3988292384::bigint * (xor(a, b) & 1))), 4294967295::bigint) % 6 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 as part, t.pos, t.digest, t.chars from convs c join turns t on t.conv_id = c.first and t.pos <= c.h
  union all
  select c.conv_id, 1, t.pos, t.digest, t.chars from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h),
paths as (
  select conv_id, row_number() over w as depth, chars, string_agg(digest, '') over w as path
  from rebuilt window w as (partition by conv_id order by part, pos rows unbounded preceding)
  union all
  select conv_id, 0, 0, '' from convs),
marked as (select *, depth = max(depth) over (partition by conv_id) as ends from paths),
nodes as (
  select path, depth, chars, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '') as ending
  from marked group by path, depth, chars),
parents as (
  select left(path, length(path) - 64) as path, count(*) as n_children from nodes where depth > 0 group by 1),
sized as (select n.*, coalesce(p.n_children, 0) as n_children from nodes n left join parents p on p.path = n.path),
sums as (
  select a.path, count(*) filter (where d.n_children = 0) as n_leaves, sum((d.n_convs - 1) * d.chars)::bigint as saved_tokens
  from sized a join sized d on starts_with(d.path, a.path) group by a.path)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
       sha256(n.ending) as ends_sha256
from sized n join sums s on s.path = n.path
left join nodes p on n.depth > 0 and p.path = left(n.path, length(n.path) - 64)
"""
