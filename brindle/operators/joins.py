"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_rows: int = SPREAD_ROWS,
    counted: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join in which a key with many left rows is spread over many tasks.

    Keys with more than ``spread_rows`` left rows are found by a count that reads
    only the key column. Their left rows get a salt, their right rows are repeated
    once per salt; all other keys are joined as usual. At most
    ``rows / spread_rows`` keys can be that large, so their list is small enough
    to broadcast. The salt hashes the row and the number of its partition, so a
    task that is run again after an executor loss gives every row the same salt, in whatever
    order it reads them. Copies of a row are spread over salts as far as they lie in several
    partitions. ``counted`` names a cheaper frame with the left side's keys, for
    the case that ``left`` itself is the result of a join.
    """
    hot = F.broadcast(
        (left if counted is None else counted).groupBy(on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > spread_rows)
        .select(on, F.ceil(F.col("_n") / spread_rows).cast("int").alias("_fan"))
    )
    fan = F.coalesce("_fan", F.lit(1))
    spot = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), fan).cast("int")
    salted = left.join(hot, on, "left").withColumn(
        "_salt", F.when(fan > 1, spot).otherwise(F.lit(0))
    )
    repeated = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), fan - 1))
    )
    return salted.drop("_fan").join(repeated.drop("_fan"), [on, "_salt"], how).drop("_salt")


def fits_in_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df``, measured by one aggregation, stay below ``max_bytes``."""
    widths = [
        F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns
    ]
    total = df.agg(F.sum(functools.reduce(operator.add, widths)).alias("bytes")).first()["bytes"]
    return (total or 0) <= max_bytes


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    max_bytes: int = BROADCAST_BYTES,
    spread_rows: int = SPREAD_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join of a large table with a keyed lookup table; one key column is kept.

    The lookup side is measured first. If it is small it is broadcast and the
    large table is not shuffled; otherwise ``spread_join`` shuffles both sides.
    """
    if fits_in_broadcast(lookup, max_bytes):
        return facts.join(F.broadcast(lookup), on, how)
    return spread_join(facts, lookup, on, spread_rows, how=how)
