"""Exact deduplication by content-defined chunk recipes.

The normalised text of a document is cut where a rolling hash of its last bytes has a
given pattern, so equal stretches give equal chunks wherever they stand. A chunk is known
by its digest; the document by its recipe, the ordered list of its digests. Two documents
are equal when their recipes are.

Every chunk's bytes move once, to be compared with all other chunks under the same digest (copies within a task
are merged first). Digests that stand for one content are verified identifiers. Should
a digest ever stand for several, recipes hold the bytes of its chunks in its place. After
that only recipes move.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.kernels import slices
from brindle.llm.tables import measured
from brindle.scratch import materialize

LEAST_CHUNK = 1 << 10
MOST_CHUNK = 1 << 16
CUT_MASK = np.uint32(0xFFF00000)  # a cut every 4 KiB on average beyond the least size
SPAN = 32  # bytes under the rolling hash

_GEAR = np.random.default_rng(32).integers(0, 1 << 32, 256, dtype=np.uint32)
# A run of white space that is not already one space.
_LOOSE = re.compile(rb"[\x20\x09-\x0D]{2,}|[\x09-\x0D]")


def normalise(data: bytes) -> bytes:
    """Every run of ASCII white space becomes one space."""
    return _LOOSE.sub(b" ", data)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places at which the hash of the last ``SPAN`` bytes asks for a cut."""
    rolled = _GEAR[data]
    width = 1
    while width < SPAN:
        shifted = rolled.copy()
        shifted[width:] += rolled[:-width] << np.uint32(width)
        rolled, width = shifted, 2 * width
    return np.flatnonzero((rolled & CUT_MASK) == 0) + 1


def chunk_ends(asked: np.ndarray, size: int) -> list[int]:
    """Ends of the chunks of a text of ``size`` bytes, given the places that ask for a cut."""
    ends, start = [], 0
    while size - start > LEAST_CHUNK:
        at = int(np.searchsorted(asked, start + LEAST_CHUNK))
        end = min(int(asked[at]) if at < len(asked) else size, start + MOST_CHUNK, size)
        ends.append(end)
        start = end
    if start < size:
        ends.append(size)
    return ends


def _chunked(column: pa.Array) -> Iterator[tuple[bytes, list[bytes]]]:
    """Normalised text and chunks of every row."""
    for first, last, data, offsets in slices(column):
        raw = data.tobytes()
        for i in range(last - first):
            text = normalise(raw[offsets[i] : offsets[i + 1]])
            ends = chunk_ends(cuts(np.frombuffer(text, np.uint8)), len(text)) if len(text) > LEAST_CHUNK else [len(text)]
            yield text, [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def sha256(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


Digest = Callable[[bytes], bytes]


def _recipes(digest: Digest, clashing: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(chunk: bytes) -> bytes:
            name = digest(chunk)
            return name if name not in clashing else name + len(chunk).to_bytes(8) + chunk

        for batch in batches:
            recipes, hashes = [], []
            for text, chunks in _chunked(batch.column("_text")):
                recipes.append(b"".join(map(part, chunks)))
                hashes.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(hashes, pa.string()), pa.array(recipes, pa.binary())],
                names=["doc_id", "text_sha256", "recipe"],
            )

    return run


def _chunks(digest: Digest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_text")
            for first, last, _, _ in slices(column):
                found = {c for _, chunks in _chunked(column.slice(first, last - first)) for c in chunks}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(map(digest, found)), pa.binary()), pa.array(list(found), pa.binary())],
                    names=["digest", "chunk"],
                )

    return run


def clashes(texts: DataFrame, digest: Digest = sha256) -> DataFrame:
    """Digests under which the chunks of column _text have more than one content."""
    chunks = texts.select("_text").mapInArrow(_chunks(digest), "digest binary, chunk binary")
    contents = chunks.groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("_seen"))
    return contents.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("digest")


def duplicates(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256.

    Equal are texts that agree after every run of ASCII white space became one space. ``keep_id`` is
    the smallest doc_id of the equal texts and ``kept`` marks its row.

    A NULL text counts as empty. NULL ids sort last: such a row stays only if no equal text has an id, and
    keep_id is then NULL. Of rows that repeat both id and text one is kept. An empty table gives an empty result. Other columns
    are ignored.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # No two contents of one SHA-256 are known, so this list stays empty unless another digest is passed.
    clashing = {bytes(r["digest"]) for r in clashes(texts, digest).collect()}
    recipes = texts.mapInArrow(
        _recipes(digest, clashing), f"doc_id {id_type}, text_sha256 string, recipe binary"
    )
    # The row number is fixed by being written, and tells repeated rows apart.
    recipes = materialize(recipes.withColumn("_row", F.monotonically_increasing_id()), "recipes")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    groups = recipes.groupBy("recipe").agg(F.min(order).alias("_keeper"), F.count(F.lit(1)).alias("group_size"))
    # Only copies look their group up. Stored, the groups have a measured size, and a large join can split hot recipes.
    groups = materialize(groups.where("group_size > 1"), "groups")
    rows = recipes.join(measured(groups), "recipe", "left")
    alone = F.col("group_size").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keeper.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_keeper.row"))).alias("kept"),
        "text_sha256",
    )


def with_text_sha256(docs: DataFrame, key: str = "_key") -> DataFrame:
    """``docs`` with the digest of each normalised text, as ``duplicates`` gives it."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return docs.withColumn(key, F.sha2(text, 256))
