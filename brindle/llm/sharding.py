"""Proportional stratified interleaving: shards of equal row counts that all have the corpus mixture.

Rows are shuffled within each source by a seeded hash and ranked; a rank divided by
the size of its source is the row's fractional rank. In the order of fractional
ranks every stretch holds the sources in proportion, so cutting that order into equal
stretches gives shards whose mixture is the corpus's. Everything is DataFrame code.

No rank is counted over a whole source: its hash range is cut into cells of about
``CELL_ROWS`` rows, rows are numbered inside their cell, and running sums of the cell
counts, at most ``MAX_CELLS`` a source, turn that into ranks. The order of all rows
is numbered in the same way. The text itself is never shuffled, only its length and checksum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.tables import measured
from brindle.scratch import materialize

CELL_ROWS = 512
MAX_CELLS = 16_384


def _cells(rows: Column) -> Column:
    return F.least(F.ceil(rows / CELL_ROWS), F.lit(MAX_CELLS)).cast("long")


def interleave(docs: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, source, shard and slot.

    ``size`` is the text's length in UTF-8 bytes plus 1. Shards are numbered from 0 and differ
    by at most one row; slots count from 0 without gaps inside a shard.

    A NULL text has no bytes, a NULL source is a source of its own, and NULL or repeated doc_ids
    are rows like any other: rows that agree in everything are interchangeable. An
    empty table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    rows = docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), "source")
    kind = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    rows = materialize(
        rows.withColumn("_kind", kind).withColumn(
            "_key", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")
        ),
        "shard-rows",
    )
    total = rows.count()

    # The share of all hash values below the row's: a number from 0 to 1.
    below = (F.shiftright("_key", 40) + (1 << 23)) / float(1 << 24)
    kinds = rows.groupBy("_kind").agg(F.count(F.lit(1)).alias("_rows"))
    # Sources with fewer rows than shards cannot have a share of each: they are interleaved as one.
    kinds = materialize(kinds, "sources")
    small = F.col("_rows") < shards
    rest = kinds.where(small).agg(F.sum("_rows")).first()[0] or 0
    pooled = F.when(small, "~").otherwise(F.col("_kind")).alias("_pool")
    kinds = kinds.select("_kind", pooled, F.when(small, F.lit(rest)).otherwise(F.col("_rows")).alias("_rows"))
    rows = rows.join(measured(kinds), "_kind").withColumn("_cell", F.floor(below * _cells(F.col("_rows"))))
    rows = rows.drop("_kind").withColumnRenamed("_pool", "_kind")
    counts = rows.groupBy("_kind", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_kind").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_kind", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_kind", "_cell").orderBy("_key", "doc_id", "text_crc32", "size")
    rows = rows.withColumn("_rank", F.row_number().over(inside)).join(starts, ["_kind", "_cell"])

    # Each source starts at a seeded phase of its first step, so that small sources do not coincide.
    phase = (F.pmod(F.xxhash64(F.lit(seed), "_kind"), F.lit(1 << 24)) + 0.5) / float(1 << 24)
    rows = rows.withColumn("_at", (F.col("_start") + F.col("_rank") - phase) / F.col("_rows"))
    rows = rows.withColumn("_cell", F.floor(F.col("_at") * _cells(F.lit(total))))
    rows = materialize(rows.drop("_rows", "_rank", "_start"), "shard-ranks")

    counts = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_cell").orderBy("_at", "_kind")
    rows = rows.withColumn("_rank", F.row_number().over(inside)).join(starts, "_cell")
    place = F.col("_start") + F.col("_rank") - 1
    rows = rows.withColumn("_place", place).withColumn(
        "shard", F.expr(f"cast(_place * {shards} div {max(total, 1)} as int)")
    )
    slot = F.expr(f"_place - (shard * {total}L + {shards - 1}) div {shards}")
    return rows.withColumn("slot", slot.cast("long")).select(
        "doc_id", "size", "text_crc32", "source", "shard", "slot"
    )
