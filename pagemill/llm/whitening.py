"""Whitening of embeddings by MLlib's BlockMatrix.

Vectors become whole numbers. Each different one, centred by the exact mean, is a row of a block matrix; its transpose
times itself is the scatter. The eigenvectors of that small matrix are found in the driver, and the block matrix of all
rows times the whitening matrix gives every row's components.

The middle dimension of the scatter is dealt to as many tasks as the input has, and added up as square blocks: no task
gets all rows. The driver gets one number a partition at most, the sums of the dimensions, the scatter (dimensions
squared), and for each block its coordinates; blocks grow with the table, so that there are some 65,536 of them at first
and later as many as blocks of MOST_VALUES give.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.shared import written

#: A vector's entries become floor(STEPS * entry).
STEPS = 256
COMPONENTS = 4
#: Values of a block: LEAST_VALUES, more where the table would have over BLOCKS of them, MOST_VALUES at most.
LEAST_VALUES, MOST_VALUES, BLOCKS = 1 << 17, 1 << 22, 1 << 16
#: An eigenvalue below this share of the largest one is no variance but rounding.
NO_VARIANCE = 1e-12


def whole_numbers(vector: Column) -> Column:
    """floor(STEPS * entry) of each entry, computed in double; null for a null or empty vector or one that holds null,
    NaN, infinity or an entry that does not fit."""
    entry = lambda x: x.cast("double")
    fine = F.forall(vector, lambda x: F.coalesce((F.abs(entry(x)) < 2.0**54) & ~F.isnan(entry(x)), F.lit(False)))
    return F.when((F.size(vector) > 0) & fine, F.transform(vector, lambda x: F.floor(entry(x) * STEPS)))


def _dense(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _sums(fit: DataFrame, dimensions: int) -> tuple[int, np.ndarray]:
    """Number of rows of fit and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimensions, object)
        for batch in batches:
            x = _dense(batch.column(0), dimensions)
            # Halves of the 64 bits: no sum of a batch overflows.
            total += (x >> 32).sum(axis=0).astype(object) * 2**32 + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            n += len(x)
        values = [str(v) for v in (n, *total)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["place", "value"])

    rows = (fit.mapInArrow(run, "place int, value string").groupBy("place")
            .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    found = {r["place"]: int(r["value"]) for r in rows}
    return found.get(0, 0), np.array([found.get(k + 1, 0) for k in range(dimensions)], object)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2 as whole numbers, null where it is no 64-bit number."""
    most = (n * max(int(np.abs(x).max(initial=0)), 1) + max(abs(s) for s in sums)) ** 2 * len(sums)
    if most < 2**63:
        return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
    return [v if v < 2**63 else None for v in exact]


def _blocks(rows: DataFrame, height: int, n: int, sums: np.ndarray) -> DataFrame:
    """block, vec_id and deviation of its rows, and their centred values in column order, zeros below the last row.

    rows: vec_id, x. The numbers of a partition's blocks are its own number and every so many further, so they need no
    count of the partitions before; a block that does not exist is all zero.
    """
    dimensions, tasks = len(sums), rows.rdd.getNumPartitions()
    mean = np.array([s / n for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId(), [], 0

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            own = pa.Table.from_batches(parts).combine_chunks()
            x = _dense(own["x"].chunk(0), dimensions)
            centred = np.zeros((height, dimensions))
            centred[:len(x)] = x - mean
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int32()),
                pa.ListArray.from_arrays([0, len(x)], own["vec_id"].chunk(0)),
                pa.array([_deviation(x, n, sums)], pa.list_(pa.int64())),
                pa.array([centred.tobytes("F")], pa.binary())], names=["block", "vec_id", "deviation", "centred"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, height - size)
                at, size = at + part.num_rows, size + part.num_rows
                held.append(part)
                if size == height:
                    yield block(held)
                    number, held, size = number + tasks, [], 0
        if held:
            yield block(held)

    schema = T.StructType([
        T.StructField("block", T.IntegerType()), T.StructField("vec_id", T.ArrayType(rows.schema["vec_id"].dataType)),
        T.StructField("deviation", T.ArrayType(T.LongType())), T.StructField("centred", T.BinaryType())])
    return rows.select("vec_id", "x").mapInArrow(run, schema)


def _matrix(blocks: DataFrame, height: int, dimensions: int) -> BlockMatrix:
    pieces = blocks.select("block", "centred").rdd.map(
        lambda r: ((r[0], 0), DenseMatrix(height, dimensions, np.frombuffer(bytes(r[1])))))
    return BlockMatrix(pieces, height, dimensions)


def _scatter(matrix: BlockMatrix, tasks: int, dimensions: int) -> np.ndarray:
    """The matrix's transpose times the matrix, the middle dimension split over the tasks."""
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper
    product = BlockMatrix(left.call("multiply", right._java_model, tasks), dimensions, dimensions)
    return product.toLocalMatrix().toArray()


def _projected(matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """block and the rows of the block times the whitening matrix."""
    d, k = whitening.shape
    spark_context = matrix.blocks.context
    small = BlockMatrix(spark_context.parallelize([((0, 0), DenseMatrix(d, k, whitening.ravel("F")))], 1), d, k)
    rows = matrix.multiply(small).blocks.map(lambda b: (b[0][0], b[1].toArray().tolist()))
    return rows.toDF("block int, projected array<array<double>>")


def _height(rows: int, most_in_task: int, dimensions: int) -> int:
    values = min(MOST_VALUES, max(LEAST_VALUES, -(-rows // BLOCKS) * dimensions))
    return max(1, min(values // dimensions, most_in_task))


def _counted(rows: DataFrame) -> tuple[int, int]:
    """Rows, and the most that one partition holds."""
    found = rows.groupBy(F.spark_partition_id().alias("p")).count().agg(F.sum("count"), F.max("count")).first()
    return found[0] or 0, found[1] or 0


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened array<double>, explained array<double>, identity_error; one row per row that remains.

    A vector x of whole numbers stands for each row (see whole_numbers). Rows without one are left out, and so are rows
    whose number of entries isn't the most frequent one (of equally frequent ones the largest). The fit list
    holds each different x once: n vectors with sums S. deviation is the sum of (n * x - S)^2, null beyond 64 bits;
    whitened is (x - S / n) on the unit eigenvectors of the covariance by falling eigenvalue, over the root of the
    eigenvalue; explained the eigenvalue's share of the trace. There are `components` of them, or as many as there are
    dimensions. An eigenvector has the sign that makes its largest entry (the first of equals) positive. A component
    without variance has the explained share zero and whitened null; of equal eigenvalues either order may come.
    identity_error is the largest entry, without sign, of the covariance of the fit list's whitened vectors minus the identity,
    over the components with variance; null if none has any. Null and repeated vec_ids and repeated rows are kept and
    treated alike; other columns play no part. An empty table gives an empty table.
    """
    own = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), whole_numbers(F.col(f"`{vector}`")).alias("x")).where("x is not null")
    own = written(own, "whole")
    sizes = own.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimensions = sizes["d"] if sizes else 1
    own = own.where(F.size("x") == dimensions)
    fit = written(own.select("x").distinct(), "fit").select(F.lit(None).cast("long").alias("vec_id"), "x")
    n, sums = _sums(fit.select("x"), dimensions)
    schema = T.StructType([own.schema["vec_id"], *(T.StructField(a, b) for a, b in (
        ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.ArrayType(T.DoubleType())),
        ("explained", T.ArrayType(T.DoubleType())), ("identity_error", T.DoubleType())))])
    if not n:
        return own.sparkSession.createDataFrame([], schema)

    height = _height(*_counted(fit), dimensions)
    fitted = _matrix(_blocks(fit, height, n, sums), height, dimensions)
    scatter = _scatter(fitted, fit.rdd.getNumPartitions(), dimensions)
    values, axes = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    first = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(scatter)) / n
    largest, axes = values[first], axes[:, first]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), range(len(first))] < 0, -1.0, 1.0)
    varied = (largest > 0) & (largest > NO_VARIANCE * max(values.max(), 0.0))
    whitening = axes * np.where(varied, 1 / np.sqrt(np.where(varied, largest, 1.0)), 0.0)
    explained = [float(e) / trace if v else 0.0 for e, v in zip(largest, varied)]

    # The fit list's own components, and their covariances.
    at = [int(k) for k in np.flatnonzero(varied)]
    found = _projected(fitted, whitening).join(
        _blocks(fit, height, n, sums).select("block", F.size("vec_id").alias("rows")), "block")
    each = found.select(F.explode(F.slice("projected", F.lit(1), F.col("rows"))).alias("w"))
    pairs = [(i, j) for i in at for j in at if i <= j]
    error = None
    if pairs:
        row = each.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(row, pairs))

    height = _height(*_counted(own), dimensions)
    blocks = _blocks(own, height, n, sums)
    placed = blocks.select("block", "vec_id", "deviation").join(
        _projected(_matrix(blocks, height, dimensions), whitening), "block")
    each = placed.select(F.explode(F.arrays_zip(
        "vec_id", "deviation", F.slice("projected", F.lit(1), F.size("vec_id")).alias("w"))).alias("r"))
    whitened = F.array(*[F.col("r.w")[k] if v else F.lit(None).cast("double") for k, v in enumerate(varied)])
    return each.select(
        F.col("r.vec_id").alias("vec_id"), F.lit(n).cast("long").alias("n"), F.col("r.deviation").alias("deviation"),
        whitened.alias("whitened"), F.array(*map(F.lit, explained)).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of each row and component."""
    found = whiten(vectors)
    return found.select(
        "vec_id", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"), "n", "deviation", "identity_error").select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
