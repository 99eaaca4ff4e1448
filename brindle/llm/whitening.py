"""Whitened principal components of a table of vectors, by distributed block matrices.

Vectors become whole numbers first, so their sums are exact, and rows are centred by them before
anything is multiplied. Centred rows are numbered without gaps and form the rows of Spark MLlib's
``BlockMatrix``: its transpose times itself is the scatter matrix, whose eigenvectors are found on the driver
(its size is that of one vector squared), and the blocks times the whitening matrix are the projected rows. The
middle dimension of the transposed product is split, so that its single result block is not summed in one task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.tables import number
from brindle.scratch import materialize

BLOCK_ROWS = 1024
MOST_BLOCKS = 1 << 14  # the driver sees the number of every block; beyond that blocks grow
BLOCKS_A_SPLIT = 8
RANK = 1e-12  # components below this share of the largest eigenvalue have no variance


class Whitened(NamedTuple):
    """``rows`` (id, deviation, whitened), and for each component its share of the variance.

    ``identity_error`` is the largest absolute entry of the covariance of ``whitened``
    minus the identity, over the components that have variance.
    """

    rows: DataFrame
    count: int
    explained: list[float]
    identity_error: float


def usable(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def whole_numbers(vector: Column, steps: int, shift: int) -> Column:
    """Entries as long: the floor of ``steps`` times the entry, plus ``shift``."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(steps)).cast("long") + shift)


def _blocks(rows: DataFrame, count: int, width: int) -> BlockMatrix:
    """(index, v) with indexes 0..count - 1 as a matrix of blocks."""
    block_rows = max(BLOCK_ROWS, -(-count // MOST_BLOCKS))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("v").alias("vector")), "vector")
    # Products read the blocks several times; a lost one is built again from the stored rows.
    return IndexedRowMatrix(vectors, count, width).toBlockMatrix(block_rows, width).persist(StorageLevel.MEMORY_AND_DISK)


def _scatter(blocks: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times itself."""
    splits = max(1, blocks.numRowBlocks // BLOCKS_A_SPLIT)
    java = blocks._java_matrix_wrapper._java_model
    # Python's multiply has no argument for the number of splits of the middle dimension.
    product = java.transpose().multiply(java, splits)
    width = blocks.numCols()
    found = BlockMatrix(product, width, width).toLocalMatrix().toArray()
    return (found + found.T) / 2


def _project(blocks: BlockMatrix, onto: np.ndarray, spark) -> DataFrame:
    """(index, v): the matrix times ``onto``."""
    rows = [(i, Vectors.dense(row)) for i, row in enumerate(onto.tolist())]
    local = spark.createDataFrame(rows, ["index", "vector"])
    right = IndexedRowMatrix(local, *onto.shape).toBlockMatrix(*onto.shape)
    product = blocks.multiply(right).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias("v"))


def _sums(rows: DataFrame, kind: str) -> list:
    """Sum of each entry over all rows, in order; one row of the result for each dimension reaches the driver."""
    entries = rows.select(F.posexplode("v").alias("at", "c"))
    return [r["s"] for r in entries.groupBy("at").agg(F.sum(F.col("c").cast(kind)).alias("s")).orderBy("at").collect()]


def _literal(values: list, kind: str) -> Column:
    return F.from_json(F.lit(str(values)), f"array<{kind}>") if len(values) > 64 else F.array(*[F.lit(v).cast(kind) for v in values])


def whiten(rows: DataFrame, vector: str, components: int = 32, steps: int = 64, shift: int = 1_000_000) -> Whitened:
    """Project the vectors of ``rows`` on their first ``components`` principal components and scale each to variance 1.

    Entries become whole numbers x by ``whole_numbers``. Covariances are taken over all remaining rows with divisor n. Eigenvectors
    are numbered by falling eigenvalue; their sign is open but the same for all rows. ``rows`` of the result keep their
    other columns, with ``deviation``, the exact sum of (n * x - S)^2, and ``whitened``, an array of the projections.

    Left out are rows whose vector is NULL or holds a NULL or an entry that is not finite, and rows whose vector has another
    length than the most frequent one (of equally frequent ones the longer; empty vectors have none). Ids are not looked at, so NULL
    and repeated ones are rows like any other. A component without variance projects everything on 0 and explains 0; vectors shorter than
    ``components`` have fewer. A ``deviation`` beyond a long is NULL, an entry whose x is beyond a long is an error. An
    empty table gives an empty result with an ``identity_error`` of 0.
    """
    spark = rows.sparkSession
    others = [c for c in rows.columns if c not in (vector, "deviation", "whitened")]
    found = rows.where(usable(F.col(vector))).where(F.size(vector) > 0)
    lengths = found.groupBy(F.size(vector).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    width, count = (most["width"], most["n"]) if most else (0, 0)
    kept = [F.col(c).alias(f"_other{i}") for i, c in enumerate(others)]
    found = found.where(F.size(vector) == width).select(F.lit(0).alias("_all"), *kept, whole_numbers(F.col(vector), steps, shift).alias("v"))
    found = number(found, "_all", "index", "_count")
    back = [F.col(f"_other{i}").alias(c) for i, c in enumerate(others)]
    if not count:
        empty = found.select(*back, F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return Whitened(empty.where("false"), 0, [], 0.0)

    sums = _literal(_sums(found, "long"), "long")
    away = F.zip_with("v", sums, lambda x, s: x * F.lit(count).cast("long") - s)
    square = lambda d: d.cast("decimal(19,0)") * d.cast("decimal(19,0)")
    deviation = F.aggregate("v", F.lit(0).cast("decimal(38,0)"), lambda total, d: (total + square(d)).cast("decimal(38,0)"))
    found = found.withColumn("v", away).withColumn("deviation", deviation.try_cast("long"))
    # The whole numbers n * x - S are divided only here, so a centred entry is as exact as a double can be.
    found = found.withColumn("v", F.transform("v", lambda d: d.cast("double") / float(count)))
    stored = materialize(found.select("index", "v", "deviation", *[f"_other{i}" for i in range(len(others))]), "centred")

    blocks = _blocks(stored, count, width)
    values, vectors = np.linalg.eigh(_scatter(blocks) / count)
    order = np.argsort(-values, kind="stable")[:components]
    total = float(values.sum())
    real = values[order] > max(RANK * values.max(), 0.0)
    explained = [float(e) / total if r else 0.0 for e, r in zip(values[order], real)]
    scale = np.where(real, 1 / np.sqrt(np.where(real, values[order], 1.0)), 0.0)
    projected = materialize(_project(blocks, vectors[:, order] * scale, spark), "projected")
    blocks._java_matrix_wrapper.call("blocks").unpersist(False)

    means = _literal([s / count for s in _sums(projected, "double")], "double")
    centred = projected.withColumn("v", F.zip_with("v", means, lambda y, m: y - m))
    blocks = _blocks(centred, count, len(order))
    error = np.abs(_scatter(blocks) / count - np.eye(len(order)))
    blocks._java_matrix_wrapper.call("blocks").unpersist(False)
    error = error[real][:, real]
    result = stored.drop("v").join(projected.withColumnRenamed("v", "whitened"), "index")
    return Whitened(result.select(*back, "deviation", "whitened"), count, explained, float(error.max()) if error.size else 0.0)
