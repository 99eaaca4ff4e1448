"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict_number(text: Column, type_name: str) -> Column:
    """Parse text as a number and fail the job on anything unparsable, in any ANSI mode."""
    failure = F.raise_error(F.concat(F.lit("not a number: "), F.coalesce(text, F.lit("NULL"))))
    return F.coalesce(text.try_cast(type_name), failure.cast(type_name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN in floating columns into NULL, so that means and counts skip it."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def column_block(df: DataFrame, start: int, stop: int) -> list[str]:
    """Names of the columns at 0-based positions ``start`` up to, not including, ``stop``."""
    return df.columns[start:stop]


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns of one row; a missing value counts as zero."""
    zero = F.lit(0.0)
    filled = [
        F.coalesce(F.nanvl(F.col(c).cast("double"), zero), zero) for c in columns
    ]
    return functools.reduce(operator.add, filled, zero)


def zero_to(value: Column, replacement: float) -> Column:
    """Guard a divisor: exactly zero becomes ``replacement``."""
    return F.when(value == 0, F.lit(replacement)).otherwise(value)


def gaussian(seed: int, *keys: Column) -> Column:
    """Standard normal draw that depends only on ``seed`` and the key values.

    Box-Muller over the two halves of 60 bits of an MD5 digest. Unlike ``randn``
    the value does not depend on the partitioning, so a task that is run again
    after an executor loss draws the same numbers.
    """
    parts = [part for key in keys for part in (F.lit(":"), key.cast("string"))]
    digest = F.md5(F.concat(F.lit(str(seed)), *parts))
    bits = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    half = 1 << 30
    first = (F.shiftright(bits, 30) + 1) / float(half)
    second = bits.bitwiseAND(F.lit(half - 1)) / float(half)
    return F.sqrt(F.log(first) * -2.0) * F.cos(second * (2.0 * math.pi))
