"""Removal of long passages that earlier documents hold, by seeds and their extension.

Seeds. Of every window of ``window`` words the smallest hash among its ``ANCHOR``-word sequences is an anchor
(winnowing), so equal windows have equal anchors, and there is one for about every twenty words. Documents are
joined on anchors; an anchor in one document alone is no seed.

Extension. Around a seed, a document's windows are those that chose that anchor. They are hashed one
word at a time from the leftmost to the rightmost, and each looks for the smallest doc_id that has the same
window. What is left when neighbouring hits are merged are the maximal repeats of ``window`` words or more. No pairs of
documents are formed: a passage in n documents costs n rows per window, not n squared.

Texts with the same words are one text from the start. Texts meet their seeds in a join whose strategy the
planner picks by the stored size of the seeds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.bpe import arrays
from brindle.llm.exact_dedup import normalise
from brindle.llm.kernels import Words, signed, slices, window_hashes
from brindle.llm.tables import measured
from brindle.scratch import materialize

WINDOW = 50
ANCHOR = 10
LAST_ID = (1 << 63) - 1  # stands for NULL, which sorts behind every id


def chosen_anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all anchor sequences of a text, and for each window the place of the one it chose."""
    size = min(ANCHOR, window)
    grams = window_hashes(words, size)
    width = window - size + 1
    if len(grams) < width:
        return grams, np.zeros(0, dtype=np.int64)
    # Half of the hash in front, the place behind: the smallest number is the leftmost smallest hash.
    least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    return grams, (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def words_digest(text: bytes) -> bytes:
    return hashlib.sha256(normalise(text).strip(b" ")).digest()


def _sequences(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column("_text")):
                words, raw = Words(data, offsets), data.tobytes()
                digests, anchors = [], []
                for i in range(last - first):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    digests.append(words_digest(raw[offsets[i] : offsets[i + 1]]))
                    grams, chosen = chosen_anchors(own, window)
                    anchors.append(np.unique(grams[np.unique(chosen)]).view(np.int64))
                at = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
                flat = np.concatenate(anchors) if anchors else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        batch.column("_key").slice(first, last - first),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                    ],
                    names=["doc_id", "_key", "n_words", "_digest", "_anchors"],
                )

    return run


def _windows(window: int):
    """Windows of seeded texts whose chosen anchor is a seed: two hashes, text, id and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = list(arrays(batch.column("_seeds")))
            ids, seqs = batch.column("_id").to_numpy(), batch.column("_seq").to_numpy()
            digests = batch.column("_digest").to_pylist()
            for first, last, data, offsets in slices(batch.column("_text")):
                words, raw = Words(data, offsets), data.tobytes()
                for i in range(last - first):
                    row = first + i
                    if words_digest(raw[offsets[i] : offsets[i + 1]]) != digests[row]:
                        continue  # another text under the same key
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    grams, chosen = chosen_anchors(own, window)
                    start = np.flatnonzero(np.isin(grams.view(np.int64), seeds[row])[chosen])
                    n = len(start)
                    yield pa.RecordBatch.from_arrays(
                        [
                            signed(window_hashes(own, window)[start]),
                            pa.array((window_hashes(own, window, seed=1)[start] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                            pa.array(np.full(n, seqs[row])),
                            pa.array(np.full(n, ids[row])),
                            pa.array(start, pa.int32()),
                        ],
                        names=["_hash", "_check", "_seq", "_id", "_start"],
                    )

    return run


def _merge(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            merged = []
            for starts in arrays(batch.column("_starts")):
                starts = np.unique(starts)
                breaks = np.flatnonzero(np.diff(starts) > window) + 1
                edges = zip(starts[np.append(0, breaks)], starts[np.append(breaks, len(starts)) - 1] + window)
                merged.append([{"start": int(a), "end": int(b)} for a, b in edges])
            yield pa.RecordBatch.from_arrays([batch.column("_seq"), pa.array(merged, kind)], names=["_seq", "removed"])

    return run


SPANS = "array<struct<start:int,end:int>>"


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, words_sha256, n_removed and removed, spans of word numbers.

    Words are maximal runs of characters other than ASCII white space, compared as they are. A word is
    removed if it lies in a window of ``window`` consecutive words that also stands in a document with a smaller
    doc_id, removed there or not. ``words_sha256`` is the digest of the document's words joined by single spaces.

    A NULL text has no words. A NULL doc_id counts as larger than all others. Rows of one
    doc_id do not remove each other's words. An empty table gives an empty result; other columns are ignored. A text of
    fewer than ``window`` words loses nothing.
    """
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # A text is addressed by a hash of its id and content, which NULL and repeated ids do not upset.
    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), F.col("text").cast("binary").alias("_text"))
    rows = texts.mapInArrow(
        _sequences(window), f"doc_id {id_type}, _key long, n_words long, _digest binary, _anchors array<long>"
    )
    rows = materialize(rows.withColumn("_id", place), "sequences")
    # One row per word sequence, under the smallest id that has it: later copies are removed whole.
    distinct = rows.where(F.col("n_words") >= window).groupBy("_digest")
    distinct = distinct.agg(F.min(F.struct("_id", "_key")).alias("_least"), F.first("_anchors").alias("_anchors"))
    distinct = distinct.select("_digest", "_least.*", "_anchors")
    distinct = materialize(distinct.withColumn("_seq", F.monotonically_increasing_id()), "distinct-sequences")

    anchors = distinct.select("_seq", "_id", F.explode("_anchors").alias("_anchor"))
    several = F.min("_id") < F.max("_id")
    # Stored first, the joins with these lists are plain, so that hot keys on the other side can be split.
    shared = anchors.groupBy("_anchor").agg(several.alias("_shared")).where("_shared").select("_anchor")
    shared = materialize(shared, "shared-anchors")
    seeds = anchors.join(shared, "_anchor").groupBy("_seq").agg(F.collect_list("_anchor").alias("_seeds"))
    seeds = materialize(seeds.join(distinct.select("_seq", "_id", "_key", "_digest"), "_seq"), "seeds")

    seeded = texts.drop("doc_id").join(seeds, "_key").select("_id", "_seq", "_digest", "_seeds", "_text")
    windows = seeded.mapInArrow(_windows(window), "_hash long, _check int, _seq long, _id long, _start int")
    windows = materialize(windows, "windows")
    first = windows.groupBy("_hash", "_check").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    first = materialize(first.where("_first < _last").drop("_last"), "first-windows")
    hits = windows.join(first, ["_hash", "_check"]).where(F.col("_id") > F.col("_first"))
    spans = hits.groupBy("_seq").agg(F.collect_list("_start").alias("_starts"))
    spans = spans.mapInArrow(_merge(window), f"_seq long, removed {SPANS}")
    spans = distinct.select("_digest", "_seq", F.col("_id").alias("_first")).join(spans, "_seq", "left")

    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast(SPANS)
    removed = F.when(F.col("_id") > F.col("_first"), whole).otherwise(F.coalesce("removed", none))
    found = rows.drop("_anchors", "_key").join(spans.drop("_seq"), "_digest", "left").withColumn("removed", removed)
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", F.hex("_digest").alias("words_sha256"), length.alias("n_removed"), "removed"
    ).withColumn("words_sha256", F.lower("words_sha256"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = batch.column("_wanted").to_pylist()
        removed = batch.column("removed").to_pylist()
        good, kept = [], []
        for row, text in enumerate(batch.column("_text")):
            words = normalise(text.as_py() or b"").strip(b" ")
            if hashlib.sha256(words).hexdigest() != wanted[row]:
                continue  # another text under the same id
            words = words.split(b" ") if words else []
            edges = [0, *(x for s in removed[row] for x in (s["start"], s["end"])), len(words)]
            good.append(row)
            kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]).decode())
        taken = batch.take(pa.array(good, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [taken.column("doc_id"), taken.column("_wanted"), pa.array(kept, pa.string())],
            names=["doc_id", "words_sha256", "kept_text"],
        )


def cut_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Texts of the documents in ``spans`` without their removed words: doc_id, words_sha256, kept_text.

    ``spans`` are rows of ``repeated_spans``; those with nothing removed need not be passed. The kept words are
    joined by single spaces. Repeated rows give one row each.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    wanted = spans.select(F.col("doc_id").alias("_id"), F.col("words_sha256").alias("_wanted"), "removed").distinct()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    joined = texts.join(measured(wanted), F.expr("doc_id <=> _id"))
    taken = joined.select("doc_id", "_wanted", "removed", "_text")
    return taken.mapInArrow(_cut, f"doc_id {id_type}, words_sha256 string, kept_text string")
