"""Join helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.operators.joins import fits_in_broadcast
from brindle.scratch import materialize

BROADCAST_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def on_workers(spark: SparkSession) -> None:
    """Let the Python workers of a local master import this package; a cluster's executors have it installed."""
    if spark.sparkContext.master.startswith("local"):
        paths = [str(Path(__file__).parents[2]), *filter(None, [spark.sparkContext.environment.get("PYTHONPATH")])]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(os.pathsep.join(paths).split(os.pathsep)))


def prepare(spark: SparkSession) -> None:
    """``on_workers``, and batches to Python bounded by bytes, unless the session bounds them itself: by rows alone, long texts make them very large."""
    on_workers(spark)
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def measured(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``lookup``, marked for broadcast if a measurement finds it small enough; beyond that joins shuffle."""
    return F.broadcast(lookup) if fits_in_broadcast(lookup, max_bytes) else lookup


def number(rows: DataFrame, key: str, index: str, count: str) -> DataFrame:
    """``rows`` stored, with their number from 0 within ``key`` in the order in which the tasks hold them, and the key's rows in ``count``.

    The rows of a key must stand together in each task, as after a sort by it, and ``key`` must not be NULL.
    Only counts per task and key pass through a window, so a key may hold any share of the rows.
    """
    stored = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    # The id's upper bits name the task, the lower 33 count its rows; both are stored, so a later reader may split the files anew.
    part = F.shiftright("_at", 33).alias("_part")
    runs = stored.groupBy(key, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(key)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        key, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias(count)
    )
    runs = materialize(runs, "runs")
    found = stored.withColumn("_part", part).join(measured(runs), [key, "_part"])
    return found.withColumn(index, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def keep_rows(docs: DataFrame, decided: DataFrame, with_key: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of ``docs`` that ``decided`` (doc_id, _key, kept; one row per document) keeps.

    A document is addressed by its doc_id; texts are not shuffled while the list of dropped ids is small. Where a doc_id is
    NULL or repeated, ``with_key`` computes the column ``_key`` of these rows alone to tell them apart, and
    of rows that agree in both one stays. Rows with a NULL ``_key`` are alike to nothing: all that are kept stay.
    """
    repeated = decided.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 OR doc_id IS NULL").select("doc_id")
    dropped = decided.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").join(repeated, "doc_id", "left_anti")
    odd = not repeated.isEmpty()
    gone = dropped.union(repeated.where("doc_id IS NOT NULL")) if odd else dropped
    plain = docs.join(measured(gone), "doc_id", "left_anti")
    if not odd:
        return plain
    plain = plain.where("doc_id IS NOT NULL")
    kept = decided.where("kept").select(F.col("doc_id").alias("_id"), F.col("_key").alias("_kept_key")).distinct()
    rows = docs.join(measured(repeated.withColumnRenamed("doc_id", "_id")), F.expr("doc_id <=> _id"), "left_semi")
    rows = with_key(rows)
    same = rows["doc_id"].eqNullSafe(kept["_id"]) & rows["_key"].eqNullSafe(kept["_kept_key"])
    own = F.when(F.col("_key").isNull(), F.monotonically_increasing_id())
    rows = rows.join(kept, same, "left_semi").withColumn("_own", own).dropDuplicates(["doc_id", "_key", "_own"])
    return plain.unionByName(rows.select(*docs.columns))
