"""Language identification by known words first, character n-grams as the way back.

A word that the model knows scores its log frequency in each language. An unseen word is
spelled with its edges marked and scored by the mean of its known character n-grams, longest first: shorter ones are
asked only if none of a length is known. A text is its words' scores summed up.

The model is a classifier fitted on a bounded sample: about ``SAMPLE_ROWS`` training rows of each language, the
most frequent ``WORDS`` words and, for each length, ``GRAMS`` n-grams of each language. Its size depends on these
parameters and the number of languages alone, so it travels with the tasks. Counting is done by Spark.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.scratch import materialize

SAMPLE_ROWS = 4_000
WORDS = 20_000
GRAMS = 4_000
LONGEST = 5
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def grams(word: str, size: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, length, unit) in a batch; length 0 means a whole word."""
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words.setdefault(lang, Counter()).update(_WORD.findall((text.as_py() or "").lower()))
        for lang, counts in words.items():
            for size in range(LONGEST + 1):
                units = counts
                if size:
                    units = Counter()
                    for word, n in counts.items():
                        for gram in grams(word, size):
                            units[gram] += n
                count = len(units)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * count, pa.string()),
                        pa.array([size] * count, pa.int32()),
                        pa.array(list(units), pa.string()),
                        pa.array(list(units.values()), pa.int64()),
                    ],
                    names=["lang", "size", "unit", "n"],
                )


class Model:
    """Log frequency of each known unit in each language: a row of ``scores``, found by length and unit."""

    def __init__(self, langs: list[str], places: list[dict[str, int]], scores: np.ndarray):
        self.langs, self.places, self.scores = langs, places, scores

    def rows(self, word: str) -> list[int]:
        """Rows that a word's score is the mean of: its own, or those of its longest known n-grams."""
        found = self.places[0].get(word)
        if found is not None:
            return [found]
        marked = f"<{word}>"
        size = min(LONGEST, len(marked))
        while size:
            place = self.places[size]
            known = [place[g] for i in range(len(marked) - size + 1) if (g := marked[i : i + size]) in place]
            if known:
                return known
            size -= 1
        return []

    def knows(self, text: str | None) -> bool:
        """Whether the text has a known word or a word with a known n-gram; edge marks alone do not count."""
        words = set(_WORD.findall((text or "").lower()))
        if any(word in self.places[0] for word in words):
            return True
        return any(
            gram in self.places[size] and gram not in ("<", ">") for word in words for size in range(1, LONGEST + 1) for gram in grams(word, size)
        )

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the posterior; ``und`` and 0 without a letter or a learned language."""
        if not text or not self.langs:
            return UNKNOWN, 0.0
        words = Counter(_WORD.findall(text.lower()))
        if not words or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        found, weights = [], []
        for word, n in words.items():
            if rows := self.rows(word):
                found += rows
                weights += [n / len(rows)] * len(rows)
        total = np.array(weights) @ self.scores[found] if found else np.zeros(len(self.langs))
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit(rows: DataFrame, key_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, words: int = WORDS, n_grams: int = GRAMS) -> Model:
    """Model of the columns text and lang; rows with a NULL in either are left out.

    ``sample_rows`` bounds the rows used of each language: more than that are thinned by a hash of ``key_col``
    and the text to about this number. Without rows the model knows no language and answers ``und``.
    """
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").select(key_col, "text", F.col("lang").cast("string"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], [{} for _ in range(LONGEST + 1)], np.zeros((0, 0)))
    fresh = (F.shiftright(F.xxhash64(key_col, "text"), 40) + (1 << 23)) / float(1 << 24)
    share = F.lit(1.0)
    for lang in langs:
        if sizes[lang] > sample_rows:
            share = F.when(F.col("lang") == lang, sample_rows / sizes[lang]).otherwise(share)
    counted = (
        rows.where(fresh < share)
        .select("text", "lang")
        .mapInArrow(_spelled, "lang string, size int, unit string, n long")
        .groupBy("lang", "size", "unit")
        .agg(F.sum("n").alias("n"))
    )
    counted = materialize(counted, "language-counts")
    totals = {(r["lang"], r["size"]): r["total"] for r in counted.groupBy("lang", "size").agg(F.sum("n").alias("total")).collect()}
    frequent = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "unit"))
    kept = [
        r
        for part, limit in ((F.col("size") == 0, words), (F.col("size") > 0, n_grams))
        for r in counted.where(part).withColumn("place", frequent).where(F.col("place") <= limit).toArrow().to_pylist()
    ]
    # A unit that a language does not know counts as half a sighting there.
    base = [[math.log(0.5 / (1 + totals.get((lang, size), 0))) for lang in langs] for size in range(LONGEST + 1)]
    column = {lang: i for i, lang in enumerate(langs)}
    places: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    scores: list[list[float]] = []
    for r in kept:
        place = places[r["size"]].setdefault(r["unit"], len(scores))
        if place == len(scores):
            scores.append(base[r["size"]].copy())
        scores[place][column[r["lang"]]] = math.log((r["n"] + 0.5) / (1 + totals[r["lang"], r["size"]]))
    return Model(langs, places, np.array(scores))


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", least_score: float | None = None
) -> DataFrame:
    """``docs`` with lang_pred and score; with ``least_score``, only accepted rows and no new column.

    A row is rejected if its language is ``und`` or scores less than ``least_score``, or if the model knows none of its words
    nor any n-gram of them, so that its score says nothing. A text that is NULL or has no letter is ``und``
    with score 0. Columns named lang_pred or score are replaced unless rows are only selected.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.places, model.scores))
    keep = docs.columns if least_score is not None else [c for c in docs.columns if c not in ("lang_pred", "score")]
    place = keep.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = batch.column(place)
            found = [own.predict(text.as_py()) for text in texts]
            if least_score is not None:
                good = [lang != UNKNOWN and score >= least_score and own.knows(text.as_py()) for (lang, score), text in zip(found, texts)]
                yield batch.filter(pa.array(good, pa.bool_()))
                continue
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    schema = [docs.schema[c] for c in keep]
    if least_score is None:
        schema += [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.select(*keep).mapInArrow(run, T.StructType(schema))
