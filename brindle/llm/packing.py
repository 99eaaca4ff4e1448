"""Packing of tokenised documents into sequences of bounded length, by exact complements and then best fit.

The plan is made on counts: how many pieces there are of each length. Going down the lengths, the gap that a piece leaves is
looked up in an index of the sums of one, two and three available lengths; a combination that fills it exactly is used as often
as the counts allow. What has no exact complement is packed best fit, longest first, whole runs of equal
sequences at a time. The plan depends on the capacity alone in size, never on the number of documents.

Pieces are numbered within their length: each task counts its own while it writes them, and sums over the tasks before
it give the rest. The plan says of each range of these numbers which sequences and places it takes, so a piece finds
its place by a search in the plan, and nothing but counts was ever shuffled.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm import bpe
from brindle.llm.kernels import slices
from brindle.llm.tables import measured
from brindle.scratch import materialize

Run = tuple[list[tuple[int, int]], int]  # slots (length, copies) of a sequence, and how many sequences are like it


# --- the plan --------------------------------------------------------------------------------


def _times(left: np.ndarray, lengths: list[int]) -> int:
    """How often the lengths can be taken together."""
    return min(int(left[x]) // lengths.count(x) for x in set(lengths))


def _pair(left: np.ndarray, length: int, total: int, most: int) -> list[int] | None:
    """Two available lengths of at most ``most`` with sum ``total``, the longer one as long as possible."""
    high = np.arange(min(most, total - 1), (total - 1) // 2, -1)
    good = high[(left[high] > 0) & (left[total - high] > 0)]
    for a in good.tolist():
        if _times(left, [length, a, total - a]):
            return [a, total - a]
    return None


def _complement(left: np.ndarray, length: int, gap: int, parts: int) -> list[int] | None:
    """Up to ``parts`` (1 to 3) available lengths that fill ``gap`` beside a piece of ``length``, long ones first."""
    if left[gap] and _times(left, [length, gap]):
        return [gap]
    found = _pair(left, length, gap, gap) if parts > 1 else None
    if found or parts < 3:
        return found
    there = (left[: gap + 1] > 0).astype(np.float64)
    there[0] = 0
    size = 2 * len(there)
    # sums[s]: pairs of available lengths with sum s, counted by a convolution
    sums = np.rint(np.fft.irfft(np.fft.rfft(there, size) ** 2, size))[: gap + 1] > 0
    first = np.arange(gap - 2, 0, -1)
    first = first[(left[first] > 0) & sums[gap - first]]
    for a in first.tolist():
        if 3 * a < gap:
            break  # the longest of three is at least a third
        left[a] -= 1
        pair = _pair(left, length, gap - a, a)
        left[a] += 1
        if pair and _times(left, [length, a, *pair]):
            return [a, *pair]
    return None


def exact_runs(left: np.ndarray, capacity: int, parts: int = 3) -> list[Run]:
    """Runs of full sequences of up to ``parts`` pieces beside the longest; ``left`` loses what they use."""
    runs = []
    for length in range(capacity, 0, -1):
        while left[length]:
            others = [] if length == capacity else _complement(left, length, capacity - length, parts)
            if others is None:
                break
            used = [length, *others]
            times = _times(left, used)
            for x in used:
                left[x] -= times
            runs.append(([(x, 1) for x in used], times))
    return runs


def fit_runs(left: np.ndarray, capacity: int) -> list[Run]:
    """Best fit, longest first, on counts; equal sequences stay one run for as long as they are filled alike."""
    open_runs: dict[int, list[Run]] = {}  # by gap
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            gap = min((g for g in open_runs if g >= length), default=None)
            if gap is None:
                slots, times, gap = [], count, capacity
            else:
                slots, times = open_runs[gap].pop()
                if not open_runs[gap]:
                    del open_runs[gap]
            copies = min(gap // length, count)
            used = min(times, count // copies)
            new = gap - copies * length
            open_runs.setdefault(new, []).append(([*slots, (length, copies)], used))
            if slots and times > used:
                open_runs.setdefault(gap, []).append((slots, times - used))
            count -= used * copies
        left[length] = 0
    return [run for runs in open_runs.values() for run in runs]


def plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (length, first, sequence, copies, offset) by length and first for ``counts[length]`` pieces of each length.

    Pieces ``first`` to the next row's ``first`` of a length stand ``copies`` to a sequence, from ``sequence`` on, at ``offset`` and behind.
    """

    def runs(parts: int) -> list[Run]:
        left = np.array(counts, dtype=np.int64)
        return exact_runs(left, capacity, parts) + fit_runs(left, capacity)

    # Triples use up short lengths that best fit may need more; the counts tell which depth leaves the fewest sequences.
    best = min((runs(parts) for parts in (3, 2, 1)), key=lambda found: sum(times for _, times in found))
    rows, taken, sequence = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for slots, times in best:
        offset = 0
        for length, copies in slots:
            rows.append((length, int(taken[length]), sequence, copies, offset))
            taken[length] += times * copies
            offset += length * copies
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


# --- tokens ----------------------------------------------------------------------------------

_encoders: dict[str, tiktoken.Encoding | None] = {}


def _encoder(path: str) -> tiktoken.Encoding | None:
    """A fast encoder for the file's vocabulary, if its ids are its merge ranks."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        byte_of = {letter: b for b, letter in enumerate(bpe.byte_letters())}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in added}
        ordered = all(vocab["".join(m)] == 256 + i for i, m in enumerate(merges))
        _encoders[path] = tiktoken.Encoding("vocabulary", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens=added) if ordered else None
    return _encoders[path]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of one text; added tokens in the text become their ids."""
    fast = _encoder(path)
    if fast is not None:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its pattern engine gives up on very long runs of white space
            pass
    return np.frombuffer(bpe.codec(path).encode([text])[0], "<u4")


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, key: str, text: str) -> DataFrame:
    """Stored rows (key, piece, start, length, ids_crc32, token_ids, _task, _rank), numbered within task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for first, last, _, _ in slices(batch.column(1)):
                rows, ids = [], []
                for i, content in enumerate(batch.column(1).slice(first, last - first).to_pylist(), first):
                    tokens = np.append(token_ids(content or "", path), end_id).astype("<u4")
                    start, piece = 0, 0
                    while start < len(tokens):
                        length = (len(tokens) - start) % capacity or capacity
                        cut = tokens[start : start + length]
                        rows.append((i, piece, start, length, zlib.crc32(cut.tobytes()), task, int(seen[length])))
                        seen[length] += 1
                        ids.append(cut)
                        start, piece = start + length, piece + 1
                at, piece, start, length, checksum, tasks, rank = zip(*rows)
                offsets = pa.array(np.cumsum([0, *length]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).view(np.int32)))
                columns = [
                    batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(checksum, pa.int64()), lists, pa.array(tasks, pa.int32()), pa.array(rank, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["_key", "piece", "start", "length", "ids_crc32", "token_ids", "_task", "_rank"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, piece int, start long, length long, ids_crc32 long, token_ids array<int>, _task int, _rank long"
    return materialize(docs.select(F.col(key).alias("_key"), text).mapInArrow(run, schema), "pieces")


# --- packing ---------------------------------------------------------------------------------


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``key``, piece, start, length, ids_crc32, token_ids, sequence_id and offset.

    A document is its token ids by the byte-level BPE file ``path`` (the same on every executor) with ``end_id`` behind them. Only one of more than
    ``capacity`` ids is cut: into pieces of ``capacity``, the first may be shorter. ``start`` counts its ids before the piece. Sequences are
    numbered from 0 and hold pieces at offsets without gaps; ``ids_crc32`` is taken over ids of four bytes, lowest first.

    A NULL or empty text is a document of ``end_id`` alone. NULL or repeated keys are rows like any other; pieces of one length are interchangeable.
    An empty table gives an empty result. Columns that are not named are ignored, whatever their names.
    """
    stored = pieces(docs, path, capacity, end_id, key, text)
    counts = stored.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(counts.select("length", "_task", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")), "lengths")
    # At most one row for each length up to the capacity.
    total = np.zeros(capacity + 1, dtype=np.int64)
    for row in before.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        total[row["length"]] = row["n"]
    steps = plan(total, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(steps)

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        steps = shared.value
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        # Steps are in order of length and first number; one sorted key stands for both.
        width = max(int(rank.max(initial=0)), int(steps[:, 1].max(initial=0))) + 1
        found = np.searchsorted(steps[:, 0] * width + steps[:, 1], length * width + rank, side="right") - 1
        _, first, sequence, copies, offset = steps[found].T
        turn = rank - first
        return pd.DataFrame({"sequence_id": sequence + turn // copies, "offset": offset + turn % copies * length})

    ranked = stored.join(measured(before.drop("_n")), ["length", "_task"])
    found = ranked.withColumn("_place", placed("length", F.col("_rank") + F.col("_before")))
    return found.select(F.col("_key").alias(key), "piece", "start", "length", "ids_crc32", "token_ids", "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the token_ids of its pieces in order; a sequence is no longer than the capacity, however many pieces it holds."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "token_ids"))).alias("held"))
    return held.select("sequence_id", F.flatten(F.col("held.token_ids")).alias("token_ids"))
