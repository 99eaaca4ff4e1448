"""Language, quality and shards: held-out accuracy and the laws of the results."""

from collections import Counter

import numpy as np
from brindle.llm import catalog, language, quality, sharding

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string"


def test_held_out_languages(spark):
    rows = catalog.op4_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out")
    rows = rows.select("lang", "lang_pred", "score").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


LANG_ROWS = [(i, "the cat and the dog", "en", None) for i in range(9)] + [(i, "der hund und die katze", "de", None) for i in range(9)]


def test_unseen_words_back_off(spark):
    model = language.fit(spark.createDataFrame(LANG_ROWS, DOCS))
    assert model.predict("the dog")[0] == "en" and model.predict("die katze")[0] == "de"
    assert model.predict("unden katzen")[0] == "de"  # by n-grams
    assert [model.predict(t) for t in (None, "", "12 !?", "½²")] == [("und", 0.0)] * 4
    assert model.predict("日本")[0] in ("en", "de")  # a letter, but nothing known
    long = "katze " * 100_000
    assert model.predict(long)[0] == "de"


def test_language_edges(spark):
    docs = spark.createDataFrame([*LANG_ROWS, (None, "the dog", None, None), (1, None, "en", None)], DOCS + "")
    model = language.fit(docs)
    found = language.identify(docs.selectExpr("doc_id", "text", "'x' AS score", "1 AS lang_pred"), model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"] and found.count() == 20
    assert language.identify(docs, model, least_score=0.5).count() == 19
    nothing = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_a_text_of_which_nothing_is_known_is_rejected(spark):
    """As the pipeline asks: with the lowest score. Short and mixed texts stay."""
    model = language.fit(spark.createDataFrame(LANG_ROWS, DOCS))
    texts = ["日本", "日本 の 文章", "Привет, мир 12", "12 !?", "the", "dog 12", "a", "the dog und die katze", "日本 the 文章", "unden katzen"]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], DOCS)
    assert {r["doc_id"] for r in language.identify(docs, model, least_score=0.0).collect()} == set(range(4, 10))
    assert language.identify(docs, model).count() == len(texts)


def test_a_large_language_is_thinned(spark):
    rows = [(i, f"the word{i}", "en", None) for i in range(2000)] + [(i, "der hund", "de", None) for i in range(20)]
    model = language.fit(spark.createDataFrame(rows, DOCS), sample_rows=100)
    seen = sum(w.startswith("word") for w in model.places[0])
    assert seen == len([p for p in model.places[0] if p == "word"]) <= 1  # digits are no letters
    assert model.predict("der hund")[0] == "de"


def test_held_out_quality(spark):
    scored = catalog.op5_quality(spark, "/root/testdata/sf0.1").where("held_out")
    rows = scored.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").select("score", "predicted", "quality").collect()
    assert len(rows) > 1000
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_additive_tables_learn_an_interaction():
    rng = np.random.default_rng(2)
    rows = rng.random((4000, len(quality.FEATURES)))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    with_pairs = quality.fit(rows, labels)
    without = quality.fit(rows, labels, pairs=0)
    right = lambda m: np.mean((m.score(rows) >= 0.5) == labels)
    assert (0, 1) in with_pairs.pairs
    assert right(with_pairs) > 0.9 > 0.7 > right(without)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "some words here. And more!", "c"), (2, "", "d")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0)], "doc_id long, quality int")
    model = quality.fit_sample(docs, labels)
    found = quality.score(docs, model)
    assert found.columns == ["doc_id", "score"] and found.count() == 4
    by_id = {r["doc_id"]: r["score"] for r in found.collect()}
    assert by_id[1] == by_id[2]
    nothing = quality.fit_sample(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0
    long = quality.score(spark.createDataFrame([(1, "word " * 500_000)], "doc_id long, text string"), model)
    assert 0 <= long.collect()[0]["score"] <= 1


def check_shards(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min([*sizes.values(), *([0] if len(sizes) < shards else [])]) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    for source, n in Counter(r["source"] for r in rows).items():
        own = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(own.get(s, 0) - n / shards) <= 2 for s in range(shards)), (source, own)


def test_every_shard_has_the_mixture(spark):
    rows = sharding.interleave(spark.read.parquet(f"{SF}/documents.parquet"), 16).collect()
    assert len(rows) == 1000
    check_shards(rows, 16)
    again = sharding.interleave(spark.read.parquet(f"{SF}/documents.parquet").repartition(7), 16).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in rows}


def test_shards_of_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 5)
    rows = [(i % 50, None if i % 9 == 0 else f"té{i % 7}", None, ["a", None, f"s{i}", "", "a", "a"][i % 6]) for i in range(601)]
    docs = spark.createDataFrame(rows, DOCS + "").selectExpr("*", "1 AS shard", "2 AS slot")
    got = sharding.interleave(docs, 7).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((i, len((t or "").encode()) + 1) for i, t, _, _ in rows)
    check_shards(got, 7)
    assert sharding.interleave(docs.limit(0), 7).count() == 0
    one = sharding.interleave(docs.limit(1), 7).collect()
    assert [(r["shard"], r["slot"]) for r in one] == [(0, 0)]
