"""Secret scanning over an incremental ledger of content-addressed blobs.

A version is a row with a path and a text. Its blob is the SHA-256 of the text, so a text that
returns under another path or in a later version is the same blob. The ledger is a
Parquet folder with one row per (blob, rule set): the spans found, or none. A run hashes all
versions, scans each blob that has no row under the present rule set once, appends those rows, and
joins the ledger back to every path. Texts move once, to bring copies together, and
copies in one input partition are merged before that.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from brindle.scratch import scratch_path

KINDS = ("assign", "access", "hex")
# Patterns of the three kinds, and what a text must contain (in lower case) to have an assignment.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN_LEAST = 6
# A run that is long enough is found at its first letter, as it would be without the least length.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RULES_VERSION = "base-1"

FOUND = "array<struct<kind:string,start:int,end:int>>"


def spans(text: str) -> list[tuple[str, int, int]]:
    """Spans in code points, end exclusive, by start and then in the order of ``KINDS``."""
    found = []
    folded = text.lower()
    if any(word in folded for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        found = [
            [dict(zip(("kind", "start", "end"), s)) for s in spans(text.as_py())]
            for text in batch.column("_text")
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("blob"), pa.array(found, kind)], names=["blob", "found"]
        )


def read_ledger(spark: SparkSession, path: str, rules: str = RULES_VERSION) -> DataFrame | None:
    """Ledger rows of one rule set, or None if nothing has been written to ``path``."""
    try:
        ledger = spark.read.schema(f"blob binary, rules string, found {FOUND}").parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    return ledger.where(F.col("rules") == rules).select("blob", "found")


def scan_versions(
    versions: DataFrame, ledger_path: str | None = None, text_col: str = "text", rules: str = RULES_VERSION
) -> DataFrame:
    """``versions`` without the text and with blob (its SHA-256) and found (spans) per row.

    ``ledger_path`` names the ledger of earlier runs; it is created at the first run, and a scratch
    ledger is used without one. Raising ``rules`` after a change of the rules scans every blob again.

    A NULL text counts as empty. Every row is returned, repeated ones too; an empty table gives an
    empty result and an empty ledger. Columns named blob or found are replaced, others kept. A run that
    fails half-way leaves no rows in the ledger, since Spark commits a write as a whole.
    """
    spark = versions.sparkSession
    ledger_path = ledger_path or scratch_path(spark, "ledger")
    text = F.coalesce(F.col(text_col), F.lit(""))
    blob = F.unhex(F.sha2(text.cast("binary"), 256))
    blobs = versions.select(blob.alias("blob"), text.alias("_text"))
    known = read_ledger(spark, ledger_path, rules)
    if known is not None:
        blobs = blobs.join(known.select("blob"), "blob", "left_anti")
    unseen = blobs.groupBy("blob").agg(F.first("_text").alias("_text"))
    scanned = unseen.mapInArrow(_scan, f"blob binary, found {FOUND}")
    scanned.withColumn("rules", F.lit(rules)).select("blob", "rules", "found").write.mode("append").parquet(ledger_path)
    others = [c for c in versions.columns if c not in (text_col, "blob", "found")]
    found = versions.select(*others, blob.alias("blob")).join(read_ledger(spark, ledger_path, rules), "blob")
    return found.select(*others, "blob", "found")


def digest(found: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined(found).encode()).hexdigest()


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)
