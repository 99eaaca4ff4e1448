"""Quality scores from a generalised additive model with pairwise interactions.

A score is the logistic function of a sum: one lookup table per feature over its bins, and one per chosen pair of
features over coarser bins. The tables are learned by cyclic boosting: features take turns, and at each turn a shallow tree
over the bins of one feature is fitted to the present residuals and added, scaled down, to its table. Then the pairs that
explain most of what is left get tables in the same way. Scoring looks bins up and adds.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); what reaches the driver is their
features, not their texts. Features and scores are computed for whole texts in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.kernels import WHITE, Words, slices, window_hashes

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
RATE = 0.1
RIDGE = 1.0
LEAST_ROWS = 10  # of a leaf

FEATURES = (
    "log bytes", "log words", "word length", "upper case", "digits", "white space", "line breaks", "stops", "commas",
    "symbols", "bytes beyond ASCII", "words with symbols", "distinct words", "commonest word", "distinct triples", "words a line",
)

_CLASSES = np.zeros((9, 256), dtype=np.uint8)
for _row, _bytes in enumerate(
    (range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), np.flatnonzero(WHITE), (0x0A,), b".!?", b",;:", b"#$%&*|<>{}[]\\/@^_=+~!", range(0x80, 0x100))
):
    _CLASSES[_row, list(_bytes)] = 1


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty text has zeros."""
    count = len(offsets) - 1
    sums = np.zeros((len(_CLASSES), len(data) + 1), dtype=np.int64)
    for row, members in enumerate(_CLASSES):
        np.add.accumulate(members[data], dtype=np.int64, out=sums[row, 1:])
    upper, lower, digits, white, breaks, stops, commas, symbols, high = sums[:, offsets[1:]] - sums[:, offsets[:-1]]
    words = Words(data, offsets)
    odd = np.add.accumulate(np.append(0, sums[7, words.end] > sums[7, words.start]))
    size, n = np.diff(offsets), np.diff(words.first)
    some, any_word = np.maximum(size, 1), np.maximum(n, 1)
    unique, common, triples = np.zeros(count), np.zeros(count), np.zeros(count)
    for i in np.flatnonzero(n):
        own = words.hashes[words.first[i] : words.first[i + 1]]
        counts = np.unique(own, return_counts=True)[1]
        unique[i], common[i] = len(counts) / len(own), counts.max() / len(own)
        runs = window_hashes(own, 3)
        triples[i] = len(np.unique(runs)) / len(runs) if len(runs) else 1.0
    return np.column_stack(
        [
            np.log1p(size), np.log1p(n), (size - white) / any_word, upper / np.maximum(upper + lower, 1), digits / some, white / some, breaks / some,
            stops / any_word, commas / any_word, symbols / some, high / some, (odd[words.first[1:]] - odd[words.first[:-1]]) / any_word, unique, common, triples,
            np.log1p(n / (breaks + 1)),
        ]
    )


@dataclass
class Model:
    """Bin edges and tables; ``pairs`` maps two features to a table over their coarse bins."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, rows[:, f], side="right")]
        needed = {f for pair in self.pairs for f in pair}
        bins = {f: np.searchsorted(self.coarse[f], rows[:, f], side="right") for f in needed}
        for (a, b), table in self.pairs.items():
            total += table[bins[a], bins[b]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of neighbouring bins in two; place 0 means none."""
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    gains[(left_n < LEAST_ROWS) | (n.sum() - left_n < LEAST_ROWS)] = 0
    if len(gains) == 0 or gains.max() <= 0:
        return 0.0, 0
    return float(gains.max()), int(np.argmax(gains)) + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf value per bin of a tree of depth 2."""
    values = np.zeros(len(g))
    cut = _best_cut(g, h, n)[1]
    for side in (slice(0, cut), slice(cut, None)) if cut else (slice(None),):
        own = _best_cut(g[side], h[side], n[side])[1] if cut else 0
        start, stop, _ = side.indices(len(g))
        for a, b in ((start, start + own), (start + own, stop)):
            if b > a:
                values[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return values


def _grid_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf value per cell of a tree that cuts one axis and then both halves along the other."""
    best = None
    for flip in (False, True):
        a, b, c = (x.T if flip else x for x in (g, h, n))
        gain, cut = _best_cut(a.sum(1), b.sum(1), c.sum(1))
        values = np.zeros(a.shape)
        for side in (slice(0, cut), slice(cut, None)) if cut else (slice(None),):
            own, at = _best_cut(a[side].sum(0), b[side].sum(0), c[side].sum(0))
            gain += own
            for part in (slice(0, at), slice(at, None)) if at else (slice(None),):
                values[side, part] = a[side, part].sum() / (b[side, part].sum() + RIDGE)
        if best is None or gain > best[0]:
            best = gain, values.T if flip else values
    return best[1]


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Model:
    """Model of 0/1 ``labels``; without rows every score is one half."""
    width = len(FEATURES)
    if len(rows) == 0:
        nothing = [np.zeros(0)] * width
        return Model(0.0, nothing, [np.zeros(1)] * width, nothing, {})
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    intercept = float(np.log(share / (1 - share)))
    edges = [_edges(rows[:, f], BINS) for f in range(width)]
    coarse = [_edges(rows[:, f], PAIR_BINS) for f in range(width)]
    bins = [np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(edges)]
    wide = [np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(coarse)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    total = np.full(len(rows), intercept)

    def residuals():
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(width):
            g, h = residuals()
            k = len(tables[f])
            step = RATE * _tree(np.bincount(bins[f], g, k), np.bincount(bins[f], h, k), sizes[f])
            tables[f] += step
            total += step[bins[f]]

    def grids(a, b, *weights):
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        cell = wide[a] * shape[1] + wide[b]
        return [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in weights]

    g, h = residuals()
    left = []
    for a, b in combinations(range(width), 2):
        gs, hs = grids(a, b, g, h)
        left.append((float(_gain(gs, hs).sum()), a, b))
    chosen = {(a, b): np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for _, a, b in sorted(left, reverse=True)[:pairs]}
    for _ in range(rounds):
        for (a, b), table in chosen.items():
            step = RATE * _grid_tree(*grids(a, b, *residuals(), np.ones(len(rows))))
            table += step
            total += step[wide[a], wide[b]]
    return Model(intercept, edges, tables, coarse, chosen)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in slices(batch.column("text")):
            values = features(data, offsets)
            at = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(first, last - first), pa.ListArray.from_arrays(at, pa.array(values.ravel()))],
                names=["label", "features"],
            )


def fit_sample(docs: DataFrame, labels: DataFrame, label: str | Column = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of the labels of ``docs``, both keyed by doc_id, from about ``sample_rows`` labelled rows at most.

    NULL ids and labels are left out, labels other than 1 count as 0. Rows are thinned by a hash of the id. An id with
    several labels or texts is used with each of them.
    """
    known = labels.select("doc_id", F.col(label).alias("label") if isinstance(label, str) else label.alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IS NOT NULL")
    share = sample_rows / max(known.count(), 1)
    spot = (F.shiftright(F.xxhash64(F.lit(5), "doc_id"), 40) + (1 << 23)) / float(1 << 24)
    # The sample's size is bounded by the parameter, so it can be broadcast.
    sample = known.where(spot < share).select("doc_id", (F.col("label") == 1).cast("int").alias("label"))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")
    found = rows.mapInArrow(_feature_rows, "label int, features array<double>").toArrow()
    if found.num_rows == 0:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    values = found.column("features").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    labelled = found.column("label").to_numpy().astype(float)
    # The order of arrival must not matter.
    order = np.lexsort((*values.T, labelled))
    return fit(values[order], labelled[order])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the text and with score, from 0 to 1; a NULL text scores as an empty one.

    A column named score is replaced, others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c not in (text_col, "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.score(features(data, offsets)) for _, _, data, offsets in slices(batch.column(len(others)))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*others, "score"])

    schema = T.StructType([*(docs.schema[c] for c in others), T.StructField("score", T.DoubleType())])
    return docs.select(*others, text_col).mapInArrow(run, schema)
