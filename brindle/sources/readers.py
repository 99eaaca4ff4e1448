"""Delimited and plain-text inputs."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions import nan_to_null, strict_number
from brindle.operators.joins import fits_in_broadcast
from brindle.scratch import materialize

# functions below travel with the jobs, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The texts pandas reads as missing by default (public pandas documentation).
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


NULL_MARK = "\u0000null"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    pandas_missing: bool = False,
    sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line; a quote inside a quoted field is doubled.

    Without a schema the types are inferred, which costs one more pass over
    the files; pass one for anything large. ``pandas_missing`` reads a table the
    way a pandas notebook does: the usual markers of a missing value and NaN
    become NULL, inference passes over them, and only truth values, whole and other numbers get a type. ``multi_line`` allows line breaks in quoted fields; files are
    split all the same (see ``quoted_records``), except to infer types without ``pandas_missing``, when a file is read by one task.
    """
    # An empty field stands for this mark, and so for NULL; a quoted empty field is an empty text.
    options = {
        "sep": sep, "escape": '"', "multiLine": str(multi_line).lower(), "nullValue": NULL_MARK,
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    reader = spark.read.options(header=True, **options)

    def read(typed: T.StructType) -> DataFrame:
        if not multi_line:
            return reader.option("mode", "FAILFAST").schema(typed).csv(path)
        fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in typed.fields)
        records = quoted_records(spark, path)
        return records.select(F.from_csv("record", fields, {**options, "mode": "FAILFAST"}).alias("_fields")).select("_fields.*")

    if schema is None and not pandas_missing:
        return reader.option("inferSchema", True).csv(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not pandas_missing:
        return read(schema)
    if schema is None and not multi_line:
        table = reader.csv(path)
    else:
        names = reader.csv(path).columns if schema is None else schema.fieldNames()
        table = read(T.StructType([T.StructField(name, T.StringType()) for name in names]))
    table = table.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in table.columns])
    types = {f.name: f.dataType.simpleString() for f in schema.fields} if schema is not None else _narrowest(table)
    return nan_to_null(table.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in table.columns]))


# What a split of a file holds of a record: all of it, its end, a part from its middle, its beginning.
_WHOLE_RECORD, _END, _MIDDLE, _BEGINNING = range(4)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records from lines (file, block, value, inside), those of one split in order."""
    names = ["file", "block", "place", "kind", "record"]
    split, inside, kind, place = None, False, _WHOLE_RECORD, 0
    pending: list[str] = []

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names=names)

    def rest() -> list[tuple]:
        left = _MIDDLE if kind == _END else _BEGINNING
        return [(*split, place, left, "\n".join(pending))] if pending else []

    for batch in batches:
        found = []
        for file, block, value, start in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != split:
                found += rest()
                split, inside, place, pending = (file, block), bool(start), 0, []
                kind = _END if start else _WHOLE_RECORD
            pending.append(value)
            inside ^= bool(value.count('"') % 2)
            if not inside:
                found.append((file, block, place, kind, "\n".join(pending)))
                place, kind, pending = place + 1, _WHOLE_RECORD, []
        yield rows(found)
    yield rows(rest())


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the records of CSV files below ``path`` as text, without header lines and blank lines; line breaks may stand in quotes.

    A split of a file cannot tell from its own bytes whether it starts inside quotes. So the quotes of each split are counted first;
    sums of these counts along a file say of every split how it starts, and each split then cuts its lines into
    records by itself. Of a record that crosses into further splits, the parts are put together, at most two a split.

    A quote is written twice inside a quoted field and nowhere else; records end at a line feed, a carriage return before it is dropped. The header
    has to end in the first split. A record needs memory for itself in one task, and so does what follows a quote that is never closed.
    """
    place = "_metadata.file_path AS file", "_metadata.file_block_start AS block"
    lines = spark.read.option("lineSep", "\n").text(path).selectExpr(*place, "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = odd.select("file", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int").alias("inside"))
    splits = materialize(splits, "splits")
    started = ["file", "block", "value", "inside"]
    if fits_in_broadcast(splits):
        lines = lines.join(F.broadcast(splits), ["file", "block"]).select(*started)
    else:
        lines = lines.withColumn("at", F.monotonically_increasing_id()).join(splits, ["file", "block"])
        lines = lines.sortWithinPartitions("file", "block", "at").select(*started)
    found = lines.mapInArrow(_assemble, "file string, block bigint, place bigint, kind int, record string")
    header = (F.col("block") == 0) & (F.col("place") == 0)
    if splits.where("inside = 1").isEmpty():
        records = found.where(~header)  # what a file leaves open ends with it
    else:
        parts = materialize(found.where(F.col("kind") != _WHOLE_RECORD), "parts-of-records")
        # The end of one record and the beginning of the next may stand in one split, in this order.
        before = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
        first = F.last(F.when(F.col("kind") == _BEGINNING, F.col("block")), ignorenulls=True).over(before)
        keys = parts.select("file", "block", "kind", first.alias("first"))
        ordered = F.array_sort(F.collect_list(F.struct("block", "record")))["record"]
        whole = parts.join(keys, ["file", "block", "kind"]).groupBy("file", "first").agg(F.array_join(ordered, "\n").alias("record"))
        records = found.where((F.col("kind") == _WHOLE_RECORD) & ~header).select("record").union(whole.select("record"))
    record = F.regexp_replace("record", "\r$", "")
    return records.select(record.alias("record")).where("record <> ''")


# The texts pandas reads as true or false, and as infinite, by default.
BOOLEAN_TEXTS = ("True", "TRUE", "true", "False", "FALSE", "false")
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"

# The kinds of texts a column may hold, one bit each.
_BOOLEAN, _INT, _BIGINT, _HUGE, _DOUBLE, _TEXT = (1 << i for i in range(6))


def _kind_of(value: Column) -> Column:
    """The bit of a text's kind; NULL has none."""
    whole = (
        F.when(value.try_cast("int").isNotNull(), _INT).when(value.try_cast("bigint").isNotNull(), _BIGINT).otherwise(_HUGE)
    )
    return (
        F.when(value.isin(*BOOLEAN_TEXTS), _BOOLEAN)
        .when(value.rlike(_WHOLE), whole)
        .when(value.rlike(_NUMBER), _DOUBLE)
        .when(value.isNotNull(), _TEXT)
    )


def _type_for(kinds: int | None) -> str:
    """The least type that holds all kinds a column has; kinds of several rows merge by OR, whatever their order."""
    if not kinds or kinds & _TEXT or (kinds & _BOOLEAN and kinds != _BOOLEAN):
        return "string"
    if kinds == _BOOLEAN:
        return "boolean"
    if kinds & _DOUBLE:
        return "double"
    return "string" if kinds & _HUGE else "bigint" if kinds & _BIGINT else "int"


def _narrowest(table: DataFrame) -> dict[str, str]:
    """The type of each text column, from one pass: what a pandas notebook would parse is parsed, all else stays text.

    Whole numbers with gaps stay whole; a column of whole numbers some of which exceed 64 bits
    is text, and so are dates, times and single letters.
    """
    seen = [F.bit_or(_kind_of(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(table.columns)]
    found = table.agg(*seen).first()
    return {c: _type_for(found[f"_{i}"]) for i, c in enumerate(table.columns)}


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``id x1 .. xd`` separated by single spaces -> ``(id STRING, v ARRAY<DOUBLE>)``.

    The dimension may differ from line to line. Two spaces in a row leave an
    empty field, which fails the job like any other bad number. Blank lines are
    dropped: taken literally they would be points without coordinates, at
    distance 0 from everything.
    """
    fields = F.split("value", " ", -1)
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(
            F.element_at(fields, 1).alias("id"),
            F.transform(
                F.slice(fields, F.lit(2), F.size(fields)), lambda x: strict_number(x, "double")
            ).alias("v"),
        )
    )


class Matrix(NamedTuple):
    """Sparse matrix: every row id once, and the cells that are not zero."""

    rows: DataFrame
    cells: DataFrame


def read_matrix(spark: SparkSession, path: str, num_cols: int | None = None) -> Matrix:
    """Adjacency lines ``row_id <tab> a_1 <tab> .. <tab> a_m`` with integer cells.

    Returns ``rows(r)`` and the non-zero ``cells(r, c, a)``, columns counted
    from 1. With ``num_cols`` every line must have exactly that many cells.
    """
    fields = F.split("value", "\t", -1)
    lines = spark.read.text(path).select(fields.alias("fields"))
    if num_cols is not None:
        fits = F.size("fields") == num_cols + 1
        failure = F.raise_error(F.lit(f"a matrix line does not have {num_cols} cells"))
        lines = lines.select(
            F.when(fits, F.col("fields")).otherwise(failure.cast("array<string>")).alias("fields")
        )
    row_id = strict_number(F.element_at("fields", 1), "bigint").alias("r")
    cells = (
        lines.select(row_id, F.posexplode(F.slice("fields", F.lit(2), F.size("fields"))))
        .select(
            "r",
            (F.col("pos") + 1).cast("bigint").alias("c"),
            strict_number(F.col("col"), "int").cast("double").alias("a"),
        )
        .where("a <> 0")
    )
    return Matrix(lines.select(row_id), cells)


def read_triples(
    spark: SparkSession, path: str, names: tuple[str, str, str] = ("i", "k", "v")
) -> DataFrame:
    """Lines ``i <tab> k <tab> value`` -> two BIGINT keys and a DOUBLE."""
    first, second, value = names
    return (
        spark.read.schema(f"{first} BIGINT, {second} BIGINT, {value} DOUBLE")
        .option("sep", "\t")
        .option("mode", "FAILFAST")
        .csv(path)
    )
