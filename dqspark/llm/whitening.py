"""Whitening of embeddings with distributed block matrices: scatter, principal axes, projection."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqspark.llm.common import quoted
from dqspark.operators.joins import join_reduced
from dqspark.session import stored

#: Numbers in a block of rows: 8 MB.
BLOCK = 1 << 20
#: Entries from here on do not fit a long once scaled; they count as non-finite.
LARGEST = float(1 << 52)


class Axes(NamedTuple):
    """What the fit finds: the number of vectors, sums per dimension, unit axes (columns), their variances, the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    trace: float


def whiten(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = 16,
    scale: int = 64,
    shift: int = 1_000_000,
) -> DataFrame:
    """Project vectors on the principal axes of their distinct values, with unit variance along each.

    An entry c becomes the long ``x = floor(scale * c) + shift``. The fit list is each distinct x-vector once, so copies
    weigh nothing. Its centred rows, indexed without gaps, make a ``BlockMatrix``; transpose times matrix is the scatter,
    a matrix of dimensions only, whose eigenvectors numpy finds on the driver; the block matrix times the axes over the
    roots of their variances projects all rows, and the product's own scatter gives the error against the identity.

    One row per remaining row: ``id``; ``n`` of the fit list; ``deviation``, the sum over dimensions of ``(n*x - S)^2``
    with S the sums of the fit list, exact (null where it exceeds a long); ``whitened`` (array, by falling variance, at
    most ``components``); ``explained`` (array, the axes' shares of the trace); ``identity_error``.

    Left out are rows whose vector is null, empty, or has entries that are null, not finite or too large for a long
    once scaled, and vectors of another length than most have (ties: the longest). Axes without variance (none, one or
    few distinct vectors) cannot be whitened and are not returned: then ``whitened`` is shorter, down to empty.
    Repeated ids and rows stay, each with its values; null ids too. No rows give no rows. Other columns are not read.

    Sums and ``n*x - S`` are whole numbers, and rows are centred before they are multiplied. Written tables cut the
    lineage; only sums, one scatter matrix and a row per task go to the driver. A vector that many rows have meets its
    projection in a join that Spark can split.
    """
    spark = df.sparkSession
    x = F.transform(F.col("v"), lambda c: F.floor(c.cast("double") * scale).cast("long") + shift)
    rows = df.select(quoted(id_column).alias("id"), quoted(vector_column).alias("v")).filter(_sound(F.col("v"), scale))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    if usual is None:
        numbers = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
        return spark.createDataFrame([], f"id {rows.schema['id'].dataType.simpleString()}, {numbers}")
    dim = usual.d
    rows = stored(rows.filter(F.size("v") == dim).select("id", x.alias("x")), "whitening-rows")
    fit = _indexed(rows.select("x").distinct())
    n, sums = _sums(fit, dim)
    centred = _matrix(fit.select("index", _centred(F.col("x"), n, sums).alias("v")), n, dim)
    axes = _axes(centred, n, sums, components)
    kept = len(axes.variances)
    whitened, error = _project(spark, centred, axes)
    named = fit.select("index", F.col("x").alias("fitted"), _deviation(F.col("x"), n, sums).alias("deviation"))
    known = named.join(whitened, "index") if kept else named.withColumn("whitened", F.array().cast("array<double>"))
    known = stored(known.select("fitted", "deviation", "whitened"), "whitening-known")
    return join_reduced(rows, known, "x", "fitted").select(
        "id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        _doubles(axes.variances / axes.trace if kept else np.empty(0)).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _doubles(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def _sound(vector: Column, scale: int) -> Column:
    """Not null, not empty, and every entry a number that fits a long once scaled. NaN is above every number."""
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fits, F.lit(False))


def _indexed(vectors: DataFrame) -> DataFrame:
    """Rows numbered from 0 without gaps: each task numbers what it writes, and the tasks' counts are summed."""
    numbered = stored(
        vectors.select(
            "x",
            F.spark_partition_id().alias("task"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        ),
        "whitening-fit",
    )
    counts = numbered.groupBy("task").agg(F.count(F.lit(1)).alias("rows")).orderBy("task").collect()  # a row per task
    starts, total = [], 0
    for count in counts:
        starts.append((count.task, total))
        total += count.rows
    first = numbered.sparkSession.createDataFrame(starts, "task int, first long")
    return numbered.join(F.broadcast(first), "task").select((F.col("first") + F.col("place")).alias("index"), "x")


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension: halves of the numbers are summed apart, so no sum overflows."""
    x = F.col("c")
    per_dimension = fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.count(x).alias("n"), F.sum(F.shiftright(x, 26)).alias("high"), F.sum(x.bitwiseAND((1 << 26) - 1)).alias("low")
    )
    found = {r.at: r for r in per_dimension.collect()}  # a row per dimension
    return found[0].n, [(found[i].high << 26) + found[i].low for i in range(dim)]


def _apart(x: Column, n: int, sums: list[int]) -> Column:
    """``n*x - S`` per dimension, null where that is no long."""
    known = [F.lit(s) if -(1 << 63) <= s < 1 << 63 else F.lit(None).cast("long") for s in sums]
    return F.zip_with(
        x, F.array(*known).cast("array<long>"), lambda c, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), c), s)
    )


def _deviation(x: Column, n: int, sums: list[int]) -> Column:
    squares = F.transform(_apart(x, n, sums), lambda d: F.try_multiply(d, d))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, square: F.try_add(total, square))


def _centred(x: Column, n: int, sums: list[int]) -> Column:
    """``x - S/n`` from the exact difference, so that nothing is lost to the size of x."""
    rough = F.zip_with(x, _doubles(np.array([s / n for s in sums])), lambda c, m: c.cast("double") - m)
    exact = F.transform(_apart(x, n, sums), lambda d: d.cast("double") / float(n))
    return F.zip_with(exact, rough, lambda e, r: F.coalesce(e, r))


def _matrix(indexed: DataFrame, rows: int, dim: int) -> BlockMatrix:
    """Rows ``(index, v)`` as a matrix in blocks of whole rows."""
    vectors = indexed.select("index", array_to_vector("v").alias("v"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), rows, dim)
    tasks = 4 * indexed.sparkSession.sparkContext.defaultParallelism
    height = max(1, min(BLOCK // max(1, dim), math.ceil(rows / tasks)))
    return matrix.toBlockMatrix(height, max(1, min(dim, 1024)))


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, on the driver: columns squared. The sum over blocks of rows is split over tasks."""
    transposed, splits = matrix.transpose(), max(1, matrix.blocks.getNumPartitions())
    product = transposed._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    columns = min(matrix.colsPerBlock, matrix.numCols())
    return BlockMatrix(product, columns, columns).toLocalMatrix().toArray()


def _axes(centred: BlockMatrix, n: int, sums: list[int], components: int) -> Axes:
    if n < 2:
        return Axes(n, sums, np.empty((len(sums), 0)), np.empty(0), 0.0)
    covariance = _scatter(centred) / n
    variances, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-variances, kind="stable")[:components]
    least = len(sums) * np.finfo(float).eps * max(float(variances[-1]), 0.0)
    order = order[variances[order] > least]
    return Axes(n, sums, axes[:, order], variances[order], float(np.trace(covariance)))


def _project(spark: SparkSession, centred: BlockMatrix, axes: Axes) -> tuple[DataFrame | None, float]:
    """The rows on the axes in units of their spread, as ``(index, whitened)``, and their distance from unit covariance."""
    kept = len(axes.variances)
    if not kept:
        return None, 0.0
    turn, height = axes.axes / np.sqrt(axes.variances), centred.colsPerBlock
    cut = [turn[low : low + height] for low in range(0, len(turn), height)]
    blocks = [((i, 0), DenseMatrix(len(b), kept, b.ravel(order="F"))) for i, b in enumerate(cut)]
    turned = centred.multiply(BlockMatrix(spark.sparkContext.parallelize(blocks, 1), height, kept, len(turn), kept))
    error = float(np.abs(_scatter(turned) / axes.n - np.eye(kept)).max())
    by_row = turned.toIndexedRowMatrix()  # named, as the JVM lets go of a matrix that Python has dropped
    rows = callMLlibFunc("getIndexedRows", by_row._java_matrix_wrapper._java_model)
    indexed = MLUtils.convertVectorColumnsToML(rows.toDF("index", "vector"), "vector")
    return indexed.select("index", vector_to_array("vector").alias("whitened")), error
