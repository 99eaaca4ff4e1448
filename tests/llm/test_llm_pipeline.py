"""Every stage of the pipeline on its own input, against brute force."""

import re

import corpus_pipeline
import public_tokenizers
import pytest
from brindle.llm import decontaminate
from test_llm_groups import plain_groups
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows before and after each stage; the documents get odd rows besides."""
    sf_dir = str(tmp_path_factory.mktemp("tables"))
    tables = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    some = docs.where("length(text) > 300").orderBy("doc_id").limit(12).collect()
    odd = [(900, None), (901, ""), (902, "12 + 3 !"), (None, some[0]["text"]), (None, some[1]["text"] + " more"), (some[2]["doc_id"], some[2]["text"]), (some[2]["doc_id"], some[3]["text"]), (903, some[4]["text"].replace(" ", "\n"))]
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], SCHEMA)
    docs.unionByName(extra).write.parquet(f"{sf_dir}/documents.parquet")
    spark.read.parquet(f"{tables}/benchmark.parquet").write.parquet(f"{sf_dir}/benchmark.parquet")
    states = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        path = f"{sf_dir}/stage-{len(states)}"
        stage(spark, states[-1], sf_dir).write.parquet(path)
        states.append(spark.read.parquet(path))
    final = sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect()))
    assert final == sorted(map(str, states[-1].collect()))
    return [s.collect() for s in states], spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()


def texts(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_language_drops_what_has_no_letters(kept):
    before, after = map(texts, kept[0][0:2])
    assert sorted(map(str, set(before) - set(after))) == sorted(map(str, [(900, None), (901, ""), (902, "12 + 3 !")]))


def test_exact_copies(kept):
    before, after = map(texts, kept[0][1:3])
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    least = {}
    for i, t in before:
        key = normal(t)
        least[key] = min(least.get(key, float("inf")), float("inf") if i is None else i)
    assert len(after) == len(least) < len(before)
    assert all(least[normal(t)] == (float("inf") if i is None else i) for i, t in after)


def test_near_copies(kept):
    before, after = map(texts, kept[0][2:4])
    assert len(after) == len(set(plain_groups(before, roots=True))) < len(before)
    assert {i for i, _ in after} == {g[2] for g in plain_groups(before)}


def test_near_copies_keep_every_wordless_text(spark):
    """Texts without words are linked with nothing, whatever their ids."""
    rows = [(None, ""), (None, " "), (None, None), (7, ""), (7, "\n"), (8, ""), (None, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = texts(corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert sorted(map(str, got)) == sorted(map(str, [*rows[:6], rows[8]]))


def test_leaks(kept):
    before, after = map(texts, kept[0][3:5])
    items = [decontaminate.normal(r["text"]) for r in kept[1]]
    leaked = {(i, t) for i, t in before if any(x in decontaminate.normal(t) for x in items)}
    assert leaked and set(before) - set(after) >= leaked
    assert len(before) - len(after) <= len(leaked) + 1  # one more may hold an edited item


def test_tokens(kept):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = kept[0][4:6]
    assert sorted(texts(before)) == sorted(texts(after))
    assert all(r["token_ids"] == library.encode(r["text"], add_special_tokens=False).ids for r in after)


def test_columns_stay(kept):
    assert all(set(r.__fields__) == {"doc_id", "text", "lang", "source", "n_chars"} for rows in kept[0][:5] for r in rows[:1])
