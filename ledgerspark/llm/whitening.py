"""Embedding whitening with distributed block matrices.

Rows are indexed without gaps and centred, and become a Spark MLlib ``BlockMatrix`` of ``BLOCK_ROWS`` rows a block. Its
transpose times itself is the scatter matrix: the middle dimension of that product is split, so that every task multiplies
the blocks of ``SPLIT_ROWS`` rows and only small square blocks are added up. The square matrix of the dimensions
is decomposed on the driver (it grows with the dimensions, not with the rows); a second block product with the
whitening matrix projects all rows.

Entries are quantised to whole numbers first, so sums and the deviation of each row are exact integers.

Defined results: a vector that is null or holds null or non-finite entries takes no part, and neither does one of another
length than most (the longer of equally many). Repeated rows and ids are rows of their own. A component whose variance is not
above the rounding error of the greatest has no whitened value (null) and does not count for ``identity_error``. An
empty table gives no rows. Other columns are ignored. A deviation or an entry beyond a long is an error, never a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import materialise, table

BLOCK_ROWS = 1024
BLOCK_COLUMNS = 1024
SPLIT_ROWS = 1 << 16  # rows multiplied by one task
COMPONENTS = 8

# Fixed values of the query: entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0 ** 52


def quantised(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key, x``: usable vectors as whole numbers, of the one length that most have."""
    c = F.transform(F.col(column), lambda v: v.cast("double"))
    usable = vectors.filter(F.col(column).isNotNull() & F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    x = F.transform(c, lambda v: F.when(F.abs(v) < LARGEST, F.floor(v * SCALE) + SHIFT).otherwise(
        F.raise_error(F.lit("an entry is too large for a long")).cast("long")))
    rows = usable.select(F.col(key).alias("key"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("n")).count().agg(F.max(F.struct("count", "n")).alias("m")).first()["m"]
    return rows.filter(F.size("x") == (lengths["n"] if lengths else 0))


def indexed(rows: DataFrame) -> DataFrame:
    """The rows, written, with ``index`` from 0 without gaps (the order is that of the files)."""
    spot = F.monotonically_increasing_id()
    written = materialise(rows.withColumn("part", F.shiftright(spot, 33)).withColumn("at", spot.bitwiseAND((1 << 33) - 1)), "vectors")
    counts = written.groupBy("part").count().orderBy("part").collect()  # one row per written partition
    starts, total = [], 0
    for r in counts:
        starts.append((r["part"], total))
        total += r["count"]
    offsets = rows.sparkSession.createDataFrame(starts, "part long, start long")
    return written.join(F.broadcast(offsets), "part").withColumn("index", F.col("start") + F.col("at")).drop("part", "at", "start")


def column_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension."""
    sums = rows.select("x").mapInArrow(_sums, "n long, at int, s decimal(38,0)").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()  # one row per dimension
    return (sums[0]["n"] if sums else 0), [int(r["s"]) for r in sums]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, high, low = 0, None, None
    for b in batches:
        if b.num_rows:
            x = _matrix(b.column(0))
            if high is None:
                high, low = np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)
            high += (x >> 32).sum(0)  # two halves: neither overflows below 2^31 rows a task
            low += (x & 0xFFFFFFFF).sum(0)
            n += len(x)
    if n:
        total = [(int(h) << 32) + int(w) for h, w in zip(high, low)]
        yield pa.RecordBatch.from_arrays([pa.array([n] * len(total)), pa.array(range(len(total)), pa.int32()),
                                          pa.array(total, pa.decimal128(38, 0))], names=["n", "at", "s"])


def _centre(batches: Iterator[pa.RecordBatch], n: int, sums: list[int]) -> Iterator[pa.RecordBatch]:
    # with S = n*q + r the whole number n*x - S is n*d - r for d = x - q: small numbers, and exact squares from three sums
    q = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    r, squares = np.array(rest, np.int64), sum(v * v for v in rest)
    for b in batches:
        d = _matrix(b.column(2)) - q
        widest = int(np.abs(d).max(initial=0)) + 1
        if widest * max(widest, n) * len(q) >= 1 << 63:
            d, by = d.astype(object), r.astype(object)
        else:
            by = r
        away = [n * n * two - 2 * n * one + squares for two, one in zip((d * d).sum(1).tolist(), (d * by).sum(1).tolist())]
        centred = d.astype(np.float64) - r / n
        lists = pa.ListArray.from_arrays(np.arange(0, centred.size + 1, centred.shape[1], dtype=np.int32), pa.array(centred.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(away, pa.int64()), lists],
                                         names=["key", "index", "deviation", "centred"])


def block_matrix(rows: DataFrame, column: str, dimensions: int) -> BlockMatrix:
    """A block matrix of the array column, one row per ``index``."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(column).alias("v")), "v")
    return IndexedRowMatrix(vectors).toBlockMatrix(BLOCK_ROWS, min(dimensions, BLOCK_COLUMNS))


def scatter(a: BlockMatrix, rows: int) -> np.ndarray:
    """The transpose of ``a`` times ``a``, as a local matrix of its columns."""
    # with one split all rows would meet in the one task that holds the result's block
    splits = max(-(-rows // SPLIT_ROWS), 1)
    transposed = a.transpose()
    product = transposed._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.colsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def _local_blocks(spark: SparkSession, m: np.ndarray, rows_per_block: int) -> BlockMatrix:
    """A small local matrix (dimensions by components) as blocks."""
    blocks = [((i // rows_per_block, 0), Matrices.dense(min(rows_per_block, len(m) - i), m.shape[1],
                                                         m[i:i + rows_per_block].ravel(order="F").tolist()))
              for i in range(0, len(m), rows_per_block)]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, len(blocks)), rows_per_block, m.shape[1])


def _rows_of(matrix: BlockMatrix) -> DataFrame:
    """``index, y``: the rows of a block matrix, without leaving the JVM."""
    indexed_rows = matrix.toIndexedRowMatrix()  # named, so that its JVM side lives until the call
    rows = callMLlibFunc("getIndexedRows", indexed_rows._java_matrix_wrapper._java_model)
    return rows.select(F.col("index"), vector_to_array("vector").alias("y"))


def identity_error(projected: DataFrame, n: int, live: int) -> float:
    """The largest absolute entry of the covariance of the first ``live`` projections minus the identity."""
    y = [F.col("y")[i] for i in range(live)]
    means = projected.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(y))).first()
    apart = [c - F.lit(means[i]) for i, c in enumerate(y)]
    pairs = [(i, j) for i in range(live) for j in range(i, live)]
    sums = projected.agg(*(F.sum(apart[i] * apart[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(sums[f"c{i}_{j}"] / n - (i == j)) for i, j in pairs)


OUT = "key {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``key, component, n, deviation, whitened, explained, identity_error``."""
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    rows = indexed(quantised(vectors, key, column))
    n, sums = column_sums(rows)
    if not n or not sums:
        return spark.createDataFrame([], OUT.format(kind)).withColumnRenamed("key", key)
    centred = materialise(rows.select("key", "index", "x").mapInArrow(
        lambda it: _centre(it, n, sums), f"key {kind}, index long, deviation long, centred array<double>"), "centred")
    a = block_matrix(centred, "centred", len(sums))
    covariance = scatter(a, n) / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    trace, k = float(np.trace(covariance)), min(components, len(values))
    live = int((values[:k] > values[0] * len(values) * np.finfo(float).eps).sum())
    if not live:  # all vectors are equal
        flat = centred.select("key", "deviation", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("component"))
        nothing = F.lit(None).cast("double")
        return flat.select(F.col("key").alias(key), "component", F.lit(n).cast("long").alias("n"), "deviation",
                           *(nothing.alias(c) for c in ("whitened", "explained", "identity_error")))
    whitening = directions[:, :live] / np.sqrt(values[:live])
    product = a.multiply(_local_blocks(spark, whitening, a.colsPerBlock))
    projected = materialise(_rows_of(product), "whitened")
    error = identity_error(projected, n, live)
    shares = F.array(*(F.lit(max(float(v), 0.0) / trace) for v in values[:k]))
    each = centred.select("key", "index", "deviation").join(projected, "index").select(
        "key", "deviation", "y", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("component"))
    return each.select(F.col("key").alias(key), "component", F.lit(n).cast("long").alias("n"), "deviation",
                       F.get("y", F.col("component") - 1).alias("whitened"),
                       F.get(shares, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
