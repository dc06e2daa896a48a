"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is partitioned into balanced parts; a small
classifier learns, for a vector, where its neighbours lie. Every row is indexed in
its most probable part. A query is routed to its several most probable parts and
compared there with every row, exactly. How many parts are probed is calibrated on
the sample so that ``TARGET_RECALL`` of true neighbours are met; a query whose parts hold
fewer than k others goes on along its order of parts until they do.

The sample (``SAMPLE`` rows by least hash of the id, more if more parts need it, at most
``MAX_SAMPLE``) is the only thing that is bounded; parts grow in number with the
square root of the table. A part is dealt out in blocks of about ``BLOCK`` rows and ``QUERY_BLOCK`` queries,
each pair of blocks one group, so that a part of any size, or a third of all rows
being one vector, spreads over many tasks. Within a block equal vectors are
compared once. Scores are inner products in double precision of the original
vectors, summed in one fixed order; ties go to the smaller id.

Defined results: vectors that are null, empty, zero, of another length than most, or
hold null or non-finite components take no part (they are no queries either); rows
that repeat an id are one candidate or query with the best of their scores; a query
with fewer candidates than ``k`` gets all of them; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import materialise, table

K = 20
SAMPLE, MAX_SAMPLE = 8192, 65_536
PARTS_FACTOR = 12  # parts: the largest power of two up to sqrt(rows) / PARTS_FACTOR
SAMPLE_PER_PART = 64
GRAPH_K = 12
TARGET_RECALL = 0.95
BLOCK, QUERY_BLOCK = 4096, 2048
HIDDEN = 128
EPOCHS = 40
SLACK = 0.1  # a part may be this much larger than the mean


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest inner product with each row, itself left out."""
    n = len(x)
    k = min(k, n - 1)
    out = np.empty((n, k), np.int64)
    for a in range(0, n, 512):
        s = x[a:a + 512] @ x.T
        s[np.arange(len(s)), a + np.arange(len(s))] = -np.inf
        out[a:a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 15) -> np.ndarray:
    """Part of each node: halving along main directions, then moves that cut fewer edges while parts stay balanced."""
    n = len(x)
    part = np.zeros(n, np.int64)
    width = 1
    while width < parts:
        for p in range(width):
            own = np.flatnonzero(part == p)
            if len(own) < 2:
                continue
            c = x[own] - x[own].mean(axis=0)
            direction = np.ones(x.shape[1])
            cov = c.T @ c
            for _ in range(20):
                direction = cov @ direction
                direction /= np.linalg.norm(direction) + 1e-30
            half = np.argsort(c @ direction, kind="stable")[len(own) // 2:]
            part[own[half]] = p + width
        width *= 2
    if graph.shape[1] == 0:
        return part
    src = np.repeat(np.arange(n), graph.shape[1])
    a, b = np.concatenate([src, graph.ravel()]), np.concatenate([graph.ravel(), src])
    most = int(np.ceil((1 + SLACK) * n / parts))
    for _ in range(rounds):
        votes = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        movers = np.argsort(-gain, kind="stable")[:int((gain > 0).sum())]
        size, moved = np.bincount(part, minlength=parts), 0
        for i in movers:
            to = best[i]
            if size[to] < most:
                size[part[i]] -= 1
                size[to] += 1
                part[i] = to
                moved += 1
        if moved <= n // 500:
            break
    return part


class Router:
    """One hidden layer over the direction of a vector; softmax over the parts."""

    def __init__(self, dim: int, parts: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.w1 = rng.normal(0, np.sqrt(2 / dim), (dim, HIDDEN))
        self.b1 = np.zeros(HIDDEN)
        self.w2 = rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts))
        self.b2 = np.zeros(parts)
        self.scale = np.sqrt(dim)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = x / np.linalg.norm(x, axis=1, keepdims=True) * self.scale
        h = np.maximum(d @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return d, h, p / p.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[2]

    def train(self, x: np.ndarray, target: np.ndarray, seed: int = 9) -> None:
        """Adam on the cross entropy with the given distributions."""
        rng = np.random.default_rng(seed)
        names = ("w1", "b1", "w2", "b2")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        t, steps = 0, EPOCHS * -(-len(x) // 256)
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                rows = order[a:a + 256]
                d, h, p = self._forward(x[rows])
                dz = (p - target[rows]) / len(rows)
                dh = (dz @ self.w2.T) * (h > 0)
                grads = {"w2": h.T @ dz, "b2": dz.sum(axis=0), "w1": d.T @ dh, "b1": dh.sum(axis=0)}
                t += 1
                rate = 3e-3 * (1 - t / (steps + 1))
                for k in names:
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                    setattr(self, k, getattr(self, k) - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-9))


def build(x: np.ndarray, parts: int, k: int = K) -> tuple[Router, int]:
    """Router and the number of parts to probe, from the sample."""
    graph = neighbour_graph(x, GRAPH_K)
    part = balanced_partition(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x)), part), 1.0)
    if graph.shape[1]:
        np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1.0)
    router = Router(x.shape[1], parts)
    router.train(x, target / target.sum(axis=1, keepdims=True))
    p = router.probabilities(x)
    home = p.argmax(axis=1)
    check = np.arange(0, len(x), max(1, len(x) // 1024))
    truth = np.empty((len(check), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(check), 512):
        s = x[check[a:a + 512]] @ x.T
        s[np.arange(len(s)), check[a:a + 512]] = -np.inf
        truth[a:a + 512] = np.argpartition(-s, truth.shape[1] - 1, axis=1)[:, :truth.shape[1]] if truth.shape[1] else 0
    if not truth.shape[1]:
        return router, 1
    rank = np.empty_like(p, np.int64)
    np.put_along_axis(rank, np.argsort(-p, axis=1, kind="stable"), np.arange(parts)[None, :], axis=1)
    met = np.sort(rank[check[:, None], home[truth]].ravel())  # the probe at which each true neighbour is met
    return router, int(met[int(np.ceil(TARGET_RECALL * len(met))) - 1]) + 1


def _vectors(column: pa.Array) -> np.ndarray:
    n = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def _train_task(batches: Iterator[pa.RecordBatch], parts: int, k: int) -> Iterator[pa.RecordBatch]:
    ids, x = [], []
    for batch in batches:
        if batch.num_rows:
            ids += batch.column(0).to_pylist()
            x.append(_vectors(batch.column(1)))
    x = np.concatenate(x)[np.lexsort((np.arange(len(ids)), ids))]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(build(x, parts, k))], pa.binary())], names=["model"])


def _route(batches: Iterator[pa.RecordBatch], router: Router) -> Iterator[pa.RecordBatch]:
    """Home part of each row, and all parts in the order in which a query probes them."""
    for batch in batches:
        x = _vectors(batch.column(1))
        asks = batch.column(0).field("q").to_numpy(zero_copy_only=False)
        home, orders = np.zeros(len(x), np.int32), [None] * len(x)
        for a in range(0, len(x), 4096):
            order = np.argsort(-router.probabilities(x[a:a + 4096]), axis=1, kind="stable").astype(np.int32)
            home[a:a + 4096] = order[:, 0]
            for r in np.flatnonzero(asks[a:a + 4096]):
                orders[a + r] = order[r]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(home), pa.array(orders, pa.list_(pa.int32()))],
            names=["id", "v", "home", "probed"])


def _enough(order: Column, probes: int, held: Column, k: int) -> Column:
    """The first ``probes`` parts of ``order``, and further ones until they hold ``k`` ids besides the query's own."""
    none = F.struct(F.array().cast("array<int>").alias("parts"), F.lit(0).cast("long").alias("n"))
    more = lambda so_far, p: F.when((F.size(so_far["parts"]) < probes) | (so_far["n"] <= k), F.struct(
        F.concat(so_far["parts"], F.array(p)).alias("parts"), (so_far["n"] + F.element_at(held, p + 1)).alias("n"))).otherwise(so_far)
    return F.aggregate(order, none, more)["parts"]


def _search(k: int):
    kind = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def block(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return kind.empty_table()
        q_ids, ids = np.asarray(queries["id"]), np.asarray(rows["id"])
        q, x = _vectors(queries["v"]), _vectors(rows["v"])
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        # equal vectors once: places of each distinct one, smallest ids first
        _, first, inverse = np.unique(np.ascontiguousarray(x + 0.0).view(f"V{8 * x.shape[1]}").ravel(), return_index=True, return_inverse=True)
        distinct, by = x[first], np.lexsort((ids, inverse))
        by = by[np.concatenate([[True], (inverse[by[1:]] != inverse[by[:-1]]) | (ids[by[1:]] != ids[by[:-1]])])]
        start = np.searchsorted(inverse[by], np.arange(len(first) + 1))
        out_q, out_i, out_s = [], [], []
        for a in range(0, len(q), 256):
            s = q[a:a + 256] @ distinct.T
            # the query's own row may take one of the places, hence k + 1
            kth = -np.partition(-s, k, axis=1)[:, k] if s.shape[1] > k + 1 else np.full(len(s), -np.inf)
            near = 1e-9 * (1 + np.abs(s).max(axis=1))
            r, c = np.nonzero(s >= (kth - near)[:, None])
            exact = (q[a + r] * distinct[c]).sum(axis=1)
            take = np.minimum(start[c + 1] - start[c], k + 1)
            rr, cc = np.repeat(r, take), np.repeat(c, take)
            place = by[np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take) + start[cc]]
            found, value, asker = ids[place], np.repeat(exact, take), q_ids[a + rr]
            keep = found != asker
            rr, found, value, asker = rr[keep], found[keep], value[keep], asker[keep]
            best = np.lexsort((found, -value, rr))
            rr, found, value, asker = rr[best], found[best], value[best], asker[best]
            _, once = np.unique(np.stack([rr, found]), axis=1, return_index=True)  # repeated ids: their best score
            once.sort()
            rr, found, value, asker = rr[once], found[once], value[once], asker[once]
            keep = np.arange(len(rr)) - np.searchsorted(rr, rr, "left") < k
            out_q.append(asker[keep])
            out_i.append(found[keep])
            out_s.append(value[keep])
        return pa.table([np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)], schema=kind)

    return block


def usable(v: Column) -> Column:
    """No null or non-finite component, and not zero."""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, odd) & F.exists(v, lambda c: c != 0), F.lit(False))


def search(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """``query_id, rank, <key>, score``: the k nearest found of each row for which ``queries`` holds."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asks")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    result = f"query_id long, rank int, {key} long, score double"
    if sizes is None:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("v") == sizes["dim"])
    parts = 1
    while 2 * parts * PARTS_FACTOR <= sizes["count"] ** 0.5 and 2 * parts * SAMPLE_PER_PART <= MAX_SAMPLE:
        parts *= 2
    bound = min(MAX_SAMPLE, max(SAMPLE, SAMPLE_PER_PART * parts))
    sample = rows.select(F.xxhash64("id").alias("h"), "v").orderBy("h").limit(bound)
    model = sample.repartition(1).mapInArrow(lambda it: _train_task(it, parts, k), "model binary").first()["model"]
    router, probes = pickle.loads(model)
    shared = spark.sparkContext.broadcast(router)  # (dim + parts) x HIDDEN numbers
    routed = materialise(rows.select(F.struct("id", F.col("asks").alias("q")).alias("row"), "v").mapInArrow(
        lambda it: _route(it, shared.value), "id struct<id:long,q:boolean>, v array<double>, home int, probed array<int>")
        .select("id.id", "id.q", "v", "home", "probed"), "ann-rows")
    base = {r[0]: r[1] for r in routed.groupBy("home").count().collect()}  # one row per part
    # a repeated id is one candidate: it counts in one of its parts
    ids = {r[0]: r[1] for r in routed.groupBy("id").agg(F.min("home").alias("home")).groupBy("home").count().collect()}
    held = F.array(*(F.lit(ids.get(p, 0)).cast("long") for p in range(parts)))
    routed = routed.withColumn("probed", _enough(F.col("probed"), probes, held, k))
    asked = {r[0]: r[1] for r in routed.filter("q").select(F.explode("probed").alias("p")).groupBy("p").count().collect()}
    cuts = [(p, -(-base[p] // BLOCK), -(-asked[p] // QUERY_BLOCK)) for p in sorted(base) if p in asked]
    if not cuts:
        return spark.createDataFrame([], result)
    n_rows = F.create_map(*(F.lit(x) for p, b, _ in cuts for x in (p, b)))
    n_asks = F.create_map(*(F.lit(x) for p, _, a in cuts for x in (p, a)))
    spread = F.xxhash64("id", F.lit(1))
    left = routed.filter("q").select("id", "v", F.explode("probed").alias("part")).filter(n_rows[F.col("part")].isNotNull()).select(
        "id", "v", "part", F.pmod(spread, n_asks[F.col("part")]).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), n_rows[F.col("part")] - 1)).alias("rb"))
    right = routed.filter(n_asks[F.col("home")].isNotNull()).select(
        "id", "v", F.col("home").alias("part"), F.explode(F.sequence(F.lit(0), n_asks[F.col("home")] - 1)).alias("qb"),
        F.pmod(spread, n_rows[F.col("home")]).cast("int").alias("rb"))
    keys = ["part", "qb", "rb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), "query_id long, id long, score double")
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
