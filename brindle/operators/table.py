"""Exploratory table analytics: profiles, means, counts, aligned sums, top-k."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions import column_block, nan_to_null, row_sum


def _long_form(one_row: DataFrame, entries: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*entries)))


def column_profile(df: DataFrame) -> DataFrame:
    """Position, name, count of values that are not missing and type of every column, from a single pass.

    NULL and NaN are missing, here and in the other functions.
    """
    counts = nan_to_null(df).agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _long_form(
        counts,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column"),
                F.col(f"n{i}").alias("non_null"),
                F.lit(dtype).alias("dtype"),
            )
            for i, (name, dtype) in enumerate(df.dtypes)
        ],
    )


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of each column, missing values skipped, as one row per column."""
    means = nan_to_null(df.select(*columns)).agg(*[F.avg(F.col(c)).alias(f"m{i}") for i, c in enumerate(columns)])
    return _long_form(
        means,
        [
            F.struct(F.lit(name).alias("column"), F.col(f"m{i}").alias("mean"))
            for i, name in enumerate(columns)
        ],
    )


def block_means(df: DataFrame, start: int, stop: int) -> DataFrame:
    """``column_means`` of the columns at positions ``start`` to ``stop - 1``."""
    return column_means(df, column_block(df, start, stop))


def _group_count(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    used = nan_to_null(df.select(F.col(key), F.col(counted).alias("_counted")))
    return used.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("_counted").alias(name))


def group_count(df: DataFrame, key: str, counted: str, name: str = "n") -> DataFrame:
    """Values of ``counted`` per key that are not missing; rows without a key are left out; keys ascending."""
    return _group_count(df, key, counted, name).orderBy(key)


def top_groups(df: DataFrame, key: str, counted: str, k: int = 10, name: str = "n") -> DataFrame:
    """The ``k`` keys with the most rows; ties go to the smaller key."""
    return _group_count(df, key, counted, name).orderBy(F.desc(name), key).limit(k)


def aligned_add(
    left: DataFrame, right: DataFrame, key: str, value: str, fill_value: float | None = None
) -> DataFrame:
    """Add two keyed series. A key that only one side has gives NULL.

    With ``fill_value`` the missing side takes that value instead. Inputs that
    were grouped by ``key`` are already partitioned for this join.
    """
    joined = left.withColumnRenamed(value, "_l").join(
        right.withColumnRenamed(value, "_r"), key, "full"
    )
    lhs, rhs = F.col("_l"), F.col("_r")
    if fill_value is not None:
        lhs, rhs = F.coalesce(lhs, F.lit(fill_value)), F.coalesce(rhs, F.lit(fill_value))
    return joined.select(key, (lhs + rhs).alias(value)).orderBy(key)


def aligned_counts_add(df: DataFrame, keys: Sequence[str], counted: str) -> DataFrame:
    """Counts by each of several key columns, added up for each key value that all columns have; NULL for one that some column lacks.

    Each row names its keys with the column they come from, so all counts are aligned by one shuffle of partial counts,
    however many columns there are. Keys are compared in the columns' common type; missing keys are left out.
    """
    used = nan_to_null(df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(counted).alias("_counted")))
    named = used.select("_counted", F.posexplode(F.array(*[f"_k{i}" for i in range(len(keys))])).alias("_side", "key")).where("key IS NOT NULL")
    sides = [F.count_if(F.col("_side") == i) for i in range(len(keys))]
    whole = functools.reduce(lambda a, b: a & b, [side > 0 for side in sides])
    return named.groupBy("key").agg(F.when(whole, F.count("_counted")).alias("n")).orderBy("key")


def aligned_count_add(df: DataFrame, first_key: str, second_key: str, counted: str) -> DataFrame:
    """Counts by one key column plus counts by another, aligned on the key value."""
    return aligned_counts_add(df, [first_key, second_key], counted)


def with_row_sum(df: DataFrame, start: int, stop: int, name: str) -> DataFrame:
    """Append the sum across a positional block of columns."""
    return df.withColumn(name, row_sum(column_block(df, start, stop)))


def top_rows(
    df: DataFrame, by: str, k: int, tie_break: Sequence[str], ascending: bool = False
) -> DataFrame:
    """First ``k`` rows by a column, missing values last in both directions."""
    value = F.col(by)
    if isinstance(df.schema[by].dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    order = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return df.orderBy(order, *tie_break).limit(k)


def preview(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """First ``k`` rows in a stated order."""
    return df.orderBy(*order).limit(k)
