"""Benchmark decontamination: approximate occurrences of benchmark items by the q-gram lemma.

An item occurs in a document if some stretch of it is within ``edits`` insertions, deletions and
replacements of characters, both in lower case and with white space runs as one space. An alignment with k edits keeps at
least n - q + 1 - k * q of the item's q-grams, and stays within k diagonals of the matrix of document and item places. So the
q-grams that both share are counted in diagonal bands that overlap by k, and only bands that reach the bound are verified,
by an alignment that is banded in the same way.

Items that are too short for the bound to ask for ``LEAST_SHARED`` shared q-grams of ``Q`` characters use ``SHORT_Q``. Items below ``Q``
characters allow no edit and are looked up as they are, between word boundaries.

The items' q-grams travel with the tasks. They are taken in blocks of at most ``BLOCK_CHARS`` characters, one pass
over the documents for each, so a larger benchmark costs more passes, not more memory. Documents are neither
shuffled nor compared with each other. Long texts are read in overlapping stretches of ``STRETCH`` characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.kernels import mix
from brindle.scratch import materialize

Q = 12
SHORT_Q = 8
EDIT_SHARE = 0.05
LEAST_SHARED = 4
BLOCK_CHARS = 4 << 20
STRETCH = 1 << 19
TABLE_BITS = 22

_BASE = 0xC2B2AE3D27D4EB4F


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    """Edits allowed in an item: 5 percent; -1 for an empty one, which never occurs."""
    return int(EDIT_SHARE * length) if length else -1


def q_of(length: int) -> int:
    """Length of the q-grams that find an item of at least ``Q`` characters."""
    return Q if max(0, length - Q + 1 - LEAST_SHARED) // Q >= budget(length) else SHORT_Q


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def q_grams(text: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the ``q`` (8, or 12 = 8 + 4) characters from every place on."""
    count = len(text) - q + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    h = text.astype(np.uint64) + np.uint64(1)
    for width in (1, 2, 4):
        h = h[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + h[width:]
        if width == 2:
            four = h
    if q == SHORT_Q:
        return mix(h)
    return mix(h[:count] * np.uint64(pow(_BASE, 4, 1 << 64)) + four[8 : 8 + count])


class Index:
    """A block of items: those below ``Q`` characters by their text, the others by their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.short: dict[str, list[int]] = {}
        by_q: dict[int, list[tuple[int, str]]] = {}
        for i, t in items:
            if len(t) >= Q:
                by_q.setdefault(q_of(len(t)), []).append((i, t))
            elif t:
                self.short.setdefault(t, []).append(i)
        self.sizes = sorted({len(t) for t in self.short})
        self.parts = [Grams(some, q) for q, some in sorted(by_q.items())]

    def whole_words(self, text: str) -> dict[int, tuple[int, int]]:
        """Short items that stand in the text with no word continued at either end, with no edits and the first end."""
        best: dict[int, tuple[int, int]] = {}
        if not self.short:
            return best
        word = [c.isalnum() or c == "_" for c in text]
        edge = [True, *(not (a and b) for a, b in zip(word, word[1:])), True]
        for start in range(len(text)):
            if edge[start]:
                for size in self.sizes:
                    if start + size <= len(text) and edge[start + size]:
                        for i in self.short.get(text[start : start + size], ()):
                            best.setdefault(i, (0, start + size))
        return best


class Grams:
    """q-grams of some items and their places."""

    def __init__(self, items: list[tuple[int, str]], q: int):
        self.q = q
        self.items = [(i, codes(t)) for i, t in items]
        self.budgets = np.array([budget(len(t)) for _, t in self.items], dtype=np.int64)
        lists = [q_grams(t, q) for _, t in self.items]
        hashes = np.concatenate([np.zeros(0, np.uint64), *lists])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.repeat(np.arange(len(lists)), [len(x) for x in lists]).astype(np.int64)[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in lists)])[order]
        self.present = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.present[self.hashes >> np.uint64(64 - TABLE_BITS)] = True
        self.longest = max([len(t) for _, t in self.items], default=0)

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document place, item and item place of every shared q-gram."""
        grams = q_grams(text, self.q)
        at = np.flatnonzero(self.present[grams >> np.uint64(64 - TABLE_BITS)])
        first = np.searchsorted(self.hashes, grams[at], "left")
        many = np.searchsorted(self.hashes, grams[at], "right") - first
        at, first, many = at[many > 0], first[many > 0], many[many > 0]
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        found = np.repeat(first, many) + step
        return np.repeat(at, many), self.item[found], self.place[found]

    def bands(self, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """Item and lowest diagonal of every band that holds enough shared q-grams.

        A band is 2k + 1 diagonals wide and starts at a multiple of k + 1, so any k + 1 neighbours lie in one.
        """
        at, item, place = self.hits(text)
        k = self.budgets[item]
        diagonal = at - place + self.longest
        high = diagonal // (k + 1)
        low = high - (diagonal % (k + 1) < k)
        item2, band2 = np.append(item, item[low != high]), np.append(high, low[low != high])
        if len(item2) == 0:
            return
        (items, bands), counts = _groups(item2, band2)
        sizes = np.array([len(t) for _, t in self.items])[items]
        kk = self.budgets[items]
        enough = counts >= sizes - self.q + 1 - kk * self.q
        for i, b, width in zip(items[enough], bands[enough], kk[enough] + 1):
            yield int(i), int(b * width - self.longest)

    def search(self, text: np.ndarray) -> dict[int, tuple[int, int]]:
        """Fewest edits of each item that occurs in the text, and where that occurrence ends."""
        best: dict[int, tuple[int, int]] = {}
        for i, diagonal in self.bands(text):
            k = int(self.budgets[i])
            found = align(self.items[i][1], text, diagonal, k)
            if found is not None and found < best.get(i, (k + 1, 0)):
                best[i] = found
        return best


def _groups(a: np.ndarray, b: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return (a[first], b[first]), np.diff(np.append(first, len(a)))


def align(item: np.ndarray, text: np.ndarray, first: int, most: int) -> tuple[int, int] | None:
    """Fewest edits, at most ``most``, that make a stretch of ``text`` from the item, and the stretch's end.

    The stretch may start and end anywhere; only cells of the band are filled in, the diagonals (text place less item
    place) ``first`` to ``first + 2 * most``.
    """
    for start in range(max(first, 0), min(first + 2 * most, len(text) - len(item)) + 1):
        if text[start] == item[0] and np.array_equal(text[start : start + len(item)], item):
            return 0, start + len(item)
    width = 2 * most + 1
    none = len(item) + 1
    slots = np.arange(width)
    padded = np.full(width + len(item) + 1, -1, dtype=np.int64)  # text[first - 1 ...], -1 outside of the text
    a, b = max(first - 1, 0), min(first - 1 + len(padded), len(text))
    if a < b:
        padded[a - first + 1 : b - first + 1] = text[a:b]
    # cost[s]: fewest edits of the item's beginning against a stretch that ends before place first + s + row.
    ends = first + slots
    cost = np.where((ends >= 0) & (ends <= len(text)), 0, none)
    for row in range(1, len(item) + 1):
        ends = first + slots + row
        moved = cost + (padded[row : row + width] != item[row - 1])
        dropped = np.append(cost[1:], none) + 1
        cost = np.minimum(moved, dropped)
        cost[(ends < 0) | (ends > len(text))] = none
        cost = np.minimum(np.minimum.accumulate(cost - slots) + slots, cost)
        if cost.min() > most:
            return None
    spot = int(np.argmin(cost))
    return int(cost[spot]), first + spot + len(item)


def _stretches(text: np.ndarray, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    start = 0
    while True:
        yield start, text[start : start + STRETCH + overlap]
        start += STRETCH
        if start + overlap >= len(text):
            return


def matches(index: Index, text: str | None) -> list[tuple[int, int, int]]:
    """(item_id, edits, end) of every item of the index that occurs in a text; end counts normalised characters."""
    text = normal(text)
    whole = codes(text)
    found = [(i, edits, end) for i, (edits, end) in index.whole_words(text).items()]
    for part in index.parts:
        best: dict[int, tuple[int, int]] = {}
        for start, stretch in _stretches(whole, 2 * part.longest):
            for i, (edits, end) in part.search(stretch).items():
                best[i] = min(best.get(i, (edits, start + end)), (edits, start + end))
        found += [(part.items[i][0], edits, end) for i, (edits, end) in best.items()]
    return sorted(found)


def blocks(benchmark: DataFrame, block_chars: int) -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """Items (item_id, normalised text) in blocks of about ``block_chars`` characters, and whether there are several.

    NULL items are left out. One block at a time is in the driver's memory.
    """
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    items = materialize(items, "items")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    spot = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for block in range(count):
        rows = items.where(spot == block).collect()
        yield sorted({(r["item_id"], normal(r["text"])) for r in rows}), count > 1


def occurrences(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item that occurs in it: doc_id, item_id, edits and end.

    ``edits`` is the fewest edits of any occurrence within the budget, ``end`` the number of normalised characters up to the end of the first such
    occurrence. Clean documents have no row. An item of fewer than ``Q`` characters occurs as whole words only;
    a NULL or empty text holds no item. Repeated documents each have their rows, items that repeat id and text count once. Empty
    tables give an empty result; other columns are ignored.
    """
    texts = docs.select("doc_id", "text")
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for items, several in blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                found = [(row, *m) for row, text in enumerate(batch.column("text")) for m in matches(index, text.as_py())]
                rows, ids, edits, ends = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(ids, pa.int64()),
                        pa.array(edits, pa.int32()),
                        pa.array(ends, pa.int64()),
                    ],
                    names=["doc_id", "item_id", "edits", "end"],
                )

        found = texts.mapInArrow(run, f"doc_id {id_type}, item_id long, edits int, end long")
        if several:
            found = materialize(found, "occurrences")
            shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out.withColumn("item_id", F.col("item_id").cast(item_type))


def clean(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows in which an item occurs, one pass for each block of items."""
    for items, several in blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        place = docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], shared=shared, place=place) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                good = [not matches(index, text.as_py()) for text in batch.column(place)]
                yield batch.filter(pa.array(good, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if several:
            docs = materialize(docs, "clean")
            shared.unpersist()
    return docs
