"""Whitening of embeddings with distributed block matrices.

Rows become integers, the distinct ones are the list on which mean and covariance are fitted. Centred rows are
indexed into blocks of a ``BlockMatrix``; its transpose times itself is the scatter, whose eigenvectors are found
on the driver (a matrix of dimension by dimension), and the blocks of all rows times the whitening matrix are the
projected rows. Blocks are handled in slabs, so the driver knows the indices of one slab at a time and no task
holds more than some dozens of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendue.llm.common import shared_folder, stored

#: Entries are stored in steps of a 64th, moved up so that they are positive.
SCALE, OFFSET = 64, 1_000_000
#: Larger entries have no such integer and count as not finite.
LARGEST = 2.0**56

#: Values of a block, and blocks of a slab.
BLOCK_VALUES = 1 << 16
SLAB = 1 << 14
#: Blocks of one side that meet in a task of a product.
MET = 128

COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

_MATRIX = pa.struct([
    ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
    ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_()),
])
_BLOCK = pa.schema([
    ("part", pa.int32()), ("k", pa.int64()), ("matrix", _MATRIX), ("ids", pa.list_(pa.int64())), ("deviation", pa.list_(pa.int64())),
])
_BLOCK_DDL = (
    "part int, k long, matrix struct<type:byte,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,"
    "values:array<double>,isTransposed:boolean>, ids array<long>, deviation array<long>"
)


def integers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows whose vector has entries and none that is null or not finite."""
    wide = F.transform(F.col(vector).cast("array<double>"), lambda c: c)
    fine = F.forall(wide, lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    x = F.transform(wide, lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    kept = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long"), x.alias("x"))


def _matrix_of(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):  # entries are below 2 ** 63 / 1024 unless a sum needs more bits
                x = _matrix_of(batch.column(0).slice(at, 1024), dim)
                part = x.sum(axis=0) if np.abs(x).max() < 2**52 else x.astype(object).sum(axis=0)
                total = [a + int(b) for a, b in zip(total, part, strict=True)]
                n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "s": [[str(v) for v in total]]}, schema=pa.schema([("n", pa.int64()), ("s", pa.list_(pa.string()))]))

    part = fit.select("x").mapInArrow(run, "n long, s array<string>")
    found = part.select("n", F.posexplode("s")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    rows = sorted((r["pos"], r["n"], int(r["s"])) for r in found.collect())  # a row for each dimension
    return (rows[0][1], [r[2] for r in rows]) if rows else (0, [0] * dim)


def centred(x: np.ndarray, n: int, s: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """``x - S / n`` in double precision, and the sums of ``(n * x - S) ** 2``, null where a long can't hold one."""
    dim = x.shape[1]
    small = n * int(np.abs(x).max()) + max(map(abs, s)) < 2**62
    apart = x * n - np.array(s, np.int64) if small else x.astype(object) * n - np.array(s, object)
    most = int(np.abs(apart).max())
    squares = ((apart * apart) if dim * most * most < 2**63 else apart.astype(object) ** 2).sum(axis=1)
    deviation = [int(v) if int(v) < 2**63 else None for v in squares]
    return (apart / n).astype(np.float64), deviation


def blocks(rows: DataFrame, dim: int, n: int, s: list[int], name: str, with_ids: bool) -> DataFrame:
    """Centred rows in blocks ``i, matrix, ids, deviation`` as they stand in their partitions, numbered from 0.

    The last block of a partition is filled up with zeros, which add nothing to a product.
    """
    spark = rows.sparkSession
    size = block_rows(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        ids: list = []
        held: list[np.ndarray] = []

        def block(x: np.ndarray, ids: list) -> pa.RecordBatch:
            values, deviation = centred(x, n, s)
            full = np.zeros((size, dim))
            full[: len(values)] = values
            matrix = {"type": 1, "numRows": size, "numCols": dim, "values": full.T.ravel(), "isTransposed": False}
            row = [part, k, matrix, ids if with_ids else [], deviation if with_ids else []]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)

        for batch in batches:
            if batch.num_rows:
                held.append(_matrix_of(batch.column(1), dim))
                ids += batch.column(0).to_pylist()
            while len(ids) >= size:
                x = np.concatenate(held)
                yield block(x[:size], ids[:size])
                held, ids, k = [x[size:]], ids[size:], k + 1
        if ids:
            yield block(np.concatenate(held), ids)

    path = shared_folder(spark, name)
    rows.select("vec_id", "x").mapInArrow(run, _BLOCK_DDL).write.parquet(path)
    # read again, the struct is the matrix that it spells
    made = spark.read.schema(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("k", T.LongType()),
        T.StructField("matrix", MatrixUDT()), T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("deviation", T.ArrayType(T.LongType()))])).parquet(path)
    parts = made.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a row for each task
    before = np.r_[0, np.cumsum([r["n"] for r in parts])]
    offsets = spark.createDataFrame([(r["part"], int(b)) for r, b in zip(parts, before, strict=False)], "part int, before long")
    return made.join(F.broadcast(offsets), "part").select((F.col("before") + F.col("k")).alias("i"), "matrix", "ids", "deviation")


def block_rows(dim: int) -> int:
    return max(1, BLOCK_VALUES // dim)


def _slabs(frame: DataFrame, dim: int) -> Iterator[tuple[int, int, BlockMatrix]]:
    """First block, number of blocks and block matrix of each slab; the blocks stay in the JVM."""
    size = block_rows(dim)
    count = frame.agg(F.coalesce(F.max("i") + 1, F.lit(0))).first()[0]
    for first in range(0, count, SLAB):
        own = frame.where(F.col("i").between(first, first + SLAB - 1))
        index = F.struct((F.col("i") - first).alias("_1"), F.lit(0).cast("long").alias("_2"))
        n = min(SLAB, count - first)
        yield first, n, BlockMatrix(callMLlibFunc("createBlockMatrix", own.select(index.alias("_1"), F.col("matrix").alias("_2")), size, dim, n * size, dim), size, dim)


def scatter(frame: DataFrame, dim: int) -> np.ndarray:
    """Sum of the transposed blocks times themselves, slab by slab."""
    out = np.zeros((dim, dim))
    for _, n, matrix in _slabs(frame, dim):
        # MLlib's product with the shared dimension split, so that not all blocks meet in the task of the one result
        turned = matrix.transpose()
        product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, -(-n // MET))
        out += BlockMatrix(product, dim, dim).toLocalMatrix().toArray()
    return out


def projected(frame: DataFrame, dim: int, weights: np.ndarray) -> DataFrame:
    """``i, z``: every block times the weights, row after row in one array."""
    spark = frame.sparkSession
    width = weights.shape[1]
    parts = []
    for first, n, matrix in _slabs(frame, dim):
        # the grid of a product one block wide has the square root of the factor's slices as its partitions
        local = spark.sparkContext.parallelize([((0, 0), DenseMatrix(dim, width, weights.T.ravel()))], (-(-n // MET)) ** 2)
        found = matrix.multiply(BlockMatrix(local, dim, width, dim, width)).blocks
        parts.append(found.map(lambda b, first=first: (first + b[0][0], b[1].toArray().ravel().tolist())))
    return spark.createDataFrame(spark.sparkContext.union(parts), "i long, z array<double>")


def _identity_error(fit: DataFrame, dim: int, weights: np.ndarray, n: int) -> float:
    """Largest entry of the covariance of the whitened list minus the identity, from sums of the tasks."""
    width = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for values in pc.struct_field(batch.column(0), "values"):
                z = np.asarray(values.values).reshape(dim, -1).T @ weights
                total += z.T @ z
        yield pa.RecordBatch.from_pydict({"own": [total.ravel()]})

    sums = fit.select("matrix").mapInArrow(run, "own array<double>").select(F.posexplode("own")).groupBy("pos").agg(F.sum("col").alias("s")).collect()  # width * width rows
    found = np.zeros(width * width)
    for r in sums:
        found[r["pos"]] = r["s"]
    return float(np.abs(found.reshape(width, width) / n - np.eye(width)).max())


def whiten(rows: DataFrame, vector: str = "embedding", components: int = 16) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    A row is usable if its vector has entries and none that is null, not finite or beyond ``LARGEST``; where lengths
    differ, the most frequent one counts (of equally frequent ones the longest) and other rows are left out.
    Mean and covariance are those of the distinct integer vectors. Components without variance are left out, so a
    table with one distinct vector, or none, has no rows. Repeated rows and null ids have rows of
    their own; a deviation that a long can't hold is null. Other columns are not read.

    Scale: only the distinct list is shuffled whole. Blocks are built where the rows are and met in tasks of some dozens of blocks.
    The driver holds matrices of dimension by dimension and the indices of a slab.
    """
    spark = rows.sparkSession
    none = spark.createDataFrame([], COLUMNS)
    rows = integers(rows, vector)
    lengths = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if lengths is None:
        return none
    dim = lengths["dim"]
    rows = rows.where(F.size("x") == dim)
    fit = stored(rows.select("x").distinct(), "fit").withColumn("vec_id", F.lit(None).cast("long"))
    n, s = _sums(fit, dim)
    fit_blocks = blocks(fit, dim, n, s, "fit-blocks", with_ids=False)
    covariance = scatter(fit_blocks, dim) / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values.max(), 0) * dim * np.finfo(float).eps]
    if not len(order):
        return none
    values, vectors = values[order], vectors[:, order]
    weights = vectors / np.sqrt(values)
    explained = (values / np.trace(covariance)).tolist()
    error = _identity_error(fit_blocks, dim, weights, n)
    all_blocks = blocks(rows, dim, n, s, "row-blocks", with_ids=True)
    found = projected(all_blocks, dim, weights).join(all_blocks.select("i", "ids", "deviation"), "i")
    width = len(order)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, shares = np.arange(1, width + 1, dtype=np.int32), np.array(explained)
        for batch in batches:
            for z, ids, deviation in zip(*(batch.column(k) for k in range(3)), strict=True):
                ids, deviation = ids.values, deviation.values
                each = pa.array(np.repeat(np.arange(len(ids)), width))
                m = len(ids) * width
                yield pa.RecordBatch.from_arrays([
                    ids.take(each), pa.array(np.tile(numbers, len(ids))), pa.array(np.full(m, n)), deviation.take(each),
                    z.values.slice(0, m), pa.array(np.tile(shares, len(ids))), pa.array(np.full(m, error)),
                ], names=[c.split()[0] for c in COLUMNS.split(", ")])

    return found.select("z", "ids", "deviation").mapInArrow(expand, COLUMNS)
