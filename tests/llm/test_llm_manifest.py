"""Merkle manifest, packing and whitening: against brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from brindle.llm import catalog, merkle, packing, whitening
from brindle.llm.tables import number
from brindle.scratch import materialize
from pyspark.sql import functions as F
from tokenizers import Tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_numbers_have_no_gaps_in_a_hot_key(spark):
    rows = spark.range(5_000, numPartitions=13).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("key"))
    rows = rows.sortWithinPartitions("key", "id")
    found = {}
    for r in number(rows, "key", "place", "count").collect():
        found.setdefault((r["key"], r["count"]), []).append((r["place"], r["id"]))
    for (_, count), places in found.items():
        assert [p for p, _ in sorted(places)] == list(range(count))
        assert sorted(places) == sorted(places, key=lambda x: x[1])


# --- merkle ----------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes, fanout):
    """Root, and for each leaf its list of (before, after)."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for path, p in zip(paths, place):
            run = runs[p // fanout]
            path.append(("".join(run[: p % fanout]), "".join(run[p % fanout + 1 :])))
        place = [p // fanout for p in place]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def plain_manifest(rows, fanout=3):
    """(doc_id, leaf, subroot, root, path) of rows (doc_id, source, lang, n_chars, text)."""
    key = lambda v: (v is not None, (v or "").encode())
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(((row[0] is not None, row[0] or 0), plain_leaf(row), row[0]))
    names = sorted(trees, key=key)
    built = {name: plain_tree([leaf for _, leaf, _ in sorted(trees[name], key=lambda r: r[:2])], fanout) for name in names}
    root, above = plain_tree([built[name][0] for name in names], fanout)
    out = []
    for name, up in zip(names, above):
        subroot, paths = built[name]
        for (_, leaf, doc_id), path in zip(sorted(trees[name], key=lambda r: r[:2]), paths):
            out.append((doc_id, leaf, subroot, root, path + up))
    return sorted(out, key=repr)


def found_manifest(spark, rows, fanout=3):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, leaf string, _path int, root int")
    found = merkle.manifest(docs, catalog.LEAF_FIELDS, "source", "doc_id", keep=["lang"], fanout=fanout)
    assert found.columns == ["doc_id", "source", "lang", "leaf", "subroot", "root", "path"]
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]]) for r in found.collect()), key=repr)


def table(count, sources, seed=0):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", "é\n", "a\nb", "x" * 5000])
    rows = [(rng.choice([None, rng.randrange(count)]), rng.choice(sources), rng.choice([None, "", "en"]), rng.choice([None, -3, 0, 12]), text()) for _ in range(count)]
    return rows + rows[:5]


@pytest.mark.parametrize("count, sources, fanout", [
    (0, [None], 3), (1, ["s"], 3), (3, [None, "", "-", "+", "é", "z\U0001f600"], 3), (250, [None, "", "a", "b", "é", "z"], 3), (250, ["hot"], 2),
    (400, [None, *map(str, range(300))], 3), (3000, ["hot"] * 8 + ["b", None], 3), (120, ["a", "b"], 5),
])
def test_manifest_equals_a_plain_tree(spark, count, sources, fanout, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_NODES", 30)  # several tiers
    rows = table(count, sources) if count else []
    got = found_manifest(spark, [(*r, "x", 1, 2) for r in rows], fanout)
    assert got == (plain_manifest(rows, fanout) if rows else [])


def test_one_tier_gives_the_same_tree(spark, monkeypatch):
    rows = [(*r, "x", 1, 2) for r in table(300, ["a", "b", "c", "d"])]
    whole = found_manifest(spark, rows)
    monkeypatch.setattr(merkle, "BLOCK_NODES", 9)
    assert found_manifest(spark, rows) == whole


def test_a_tampered_text_does_not_reach_the_root(spark, tmp_path):
    rows = [(i, "a\nb" if i % 3 else "ab", "en", f"s{i % 4}", 3) for i in range(60)] + [(None, "a\nb", None, None, None), (61, None, None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(found) == 62
    plain = {r[0]: r for r in plain_manifest([(i, s, lang, n, t) for i, t, lang, s, n in rows])}
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (texts[r["doc_id"]] or "")
        assert r["verified"] == (not tampered) == (r["folded_root"] == r["root"])
        path = plain[r["doc_id"]][4]
        assert r["proof_sha256"] == sha("".join(a + b for a, b in path))


def test_levels_of_a_tier_need_one_shuffle_and_one_sort(spark, monkeypatch):
    rows = spark.range(3000).select(F.lit("t").alias("_tree"), F.col("id").alias("_index"), F.lit(3000).cast("long").alias("_count"), F.sha2(F.col("id").cast("string"), 256).alias("_hash"))
    nodes = materialize(rows, "nodes")
    monkeypatch.setattr(merkle, "materialize", lambda frame, label: frame)
    plan = merkle._tier(nodes, 3000, 3, 6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and plan.count("Window [") == 6


# --- packing ---------------------------------------------------------------------------------


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= length]
        if fits:
            i = min(fits, key=gaps.__getitem__)
            gaps[i] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


def check_plan(counts, capacity):
    """Every piece has a place, no places overlap; returns the number of sequences."""
    steps = packing.plan(counts, capacity)
    held = {}
    for i, (length, first, sequence, copies, offset) in enumerate(steps.tolist()):
        last = steps[i + 1][1] if i + 1 < len(steps) and steps[i + 1][0] == length else counts[length]
        assert first < last
        for turn in range(last - first):
            held.setdefault(sequence + turn // copies, []).append((offset + turn % copies * length, length))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    placed = np.bincount([n for places in held.values() for _, n in places], minlength=capacity + 1)
    assert (placed == counts).all() and sorted(held) == list(range(len(held)))
    return len(held)


@pytest.mark.parametrize("seed", range(12))
def test_plan_needs_no_more_sequences_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 130))
    shapes = [
        lambda: rng.integers(0, 9, capacity + 1), lambda: (rng.random(capacity + 1) < 0.2) * rng.integers(0, 30, capacity + 1),
        lambda: np.bincount(rng.geometric(0.1, 300).clip(1, capacity), minlength=capacity + 1), lambda: np.eye(capacity + 1, dtype=int)[1] * 500,
    ]
    counts = np.array(shapes[seed % 4](), dtype=np.int64)
    counts[0] = 0
    used = check_plan(counts, capacity)
    lengths = np.repeat(np.arange(capacity + 1), counts)
    assert used >= -(-lengths.sum() // capacity)
    assert used <= best_fit_decreasing(lengths.tolist(), capacity) * 1.01 + 1


def test_exact_complements_are_found():
    counts = np.zeros(101, dtype=np.int64)
    for length, n in ((70, 4), (30, 1), (20, 2), (10, 6), (60, 1), (25, 1), (15, 1), (5, 1)):
        counts[length] = n
    left = counts.copy()
    runs = packing.exact_runs(left, 100)
    assert all(sum(x * c for x, c in slots) == 100 for slots, _ in runs)
    found = [sorted((x for x, _ in slots), reverse=True) for slots, times in runs for _ in range(times)]
    assert found[0] == [70, 30] and sum(70 in f for f in found) == 4 and {len(f) for f in found} >= {2, 3}
    alone = packing.exact_runs(counts.copy(), 100, parts=1)
    assert alone == [([(70, 1), (30, 1)], 1)]


TEXTS = [
    (1, "one two three " * 900), (2, ""), (2, None), (None, "a <|endoftext|> b"), (3, "x" * 20_000), (4, " " * 40_000 + "end"), (5, "é\n\n" * 3000), (6, "short"), (6, "short"),
]


@pytest.mark.parametrize("capacity", [1, 7, 1024])
def test_packed_pieces_hold_all_tokens(spark, capacity):
    library = Tokenizer.from_file(VOCABULARY)
    texts = TEXTS if capacity > 1 else TEXTS[1:4] + TEXTS[-2:]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in texts], "doc_id long, text string, _rank int, sequence_id string").repartition(3)
    packed = packing.pack(docs, VOCABULARY, 2, capacity)
    rows = packed.collect()
    want = sorted(str((i, library.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in texts)
    by_doc = {}
    for r in rows:
        assert r["length"] == len(r["token_ids"]) <= capacity and (r["piece"] == 0 or r["length"] == capacity)
        assert r["ids_crc32"] == zlib.crc32(np.array(r["token_ids"], "<u4").tobytes())
        by_doc.setdefault(r["doc_id"], []).append(r)
    unique = [str((i, [x for r in sorted(held, key=lambda r: r["piece"]) for x in r["token_ids"]])) for i, held in by_doc.items() if i not in (2, 6)]
    assert sorted(unique) == [w for w in want if not w.startswith(("(2,", "(6,"))]
    assert sum(r["length"] for r in rows) == sum(len(eval(w)[1]) for w in want)
    for i, held in by_doc.items():
        if i not in (2, 6):
            held.sort(key=lambda r: r["piece"])
            assert [r["start"] for r in held] == [0, *np.cumsum([r["length"] for r in held])[:-1]]
    joined = {r["sequence_id"]: r["token_ids"] for r in packing.sequences(packed).collect()}
    for r in rows:
        assert joined[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["token_ids"]
    assert sum(map(len, joined.values())) == sum(r["length"] for r in rows) and max(map(len, joined.values())) <= capacity


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY, 2).collect() == []


def test_query_packs_a_whole_table(spark):
    rows = catalog.op12_best_fit_packing(spark, SF).collect()
    total = {}
    for r in rows:
        total.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in total.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]] and sum(places[-1]) <= 1024
    tokens = sum(r["length"] for r in rows)
    assert len(total) <= best_fit_decreasing([r["length"] for r in rows], 1024) and len(total) >= -(-tokens // 1024)


# --- whitening -------------------------------------------------------------------------------


def plain_whitening(vectors, components, steps=64, shift=1_000_000):
    x = np.floor(steps * np.array(vectors, dtype=np.float64)).astype(np.int64) + shift
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    centred = away / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum(int(d) ** 2 for d in row) for row in away]
    return deviation, centred @ axes[:, :components] / np.sqrt(values[:components]), values / values.sum()


def close_up_to_sign(got, want):
    got, want = np.array(got), np.array(want)
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-7


def test_whitening_equals_a_plain_decomposition(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    monkeypatch.setattr(whitening, "BLOCKS_A_SPLIT", 2)
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(700, 9)) * np.arange(1, 10) + 5).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    bad = [(900, None), (901, [1.0] * 8 + [None]), (902, [float("nan")] * 9), (903, [float("-inf")] * 9), (904, [1.0, 2.0]), (905, [])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], "vec_id long, embedding array<float>, v string, deviation int").repartition(5)
    found = whitening.whiten(table, "embedding", components=6)
    got = {r["vec_id"]: r for r in found.rows.collect()}
    assert sorted(got) == list(range(700)) and found.count == 700 and {r["v"] for r in got.values()} == {"x"}
    deviation, whitened, explained = plain_whitening(vectors, 6)
    assert [got[i]["deviation"] for i in range(700)] == deviation
    close_up_to_sign([got[i]["whitened"] for i in range(700)], whitened)
    assert np.allclose(found.explained, explained[:6], rtol=1e-9) and found.identity_error < 1e-9


def test_components_without_variance(spark):
    rng = np.random.default_rng(2)
    flat = rng.normal(size=(50, 2)) @ np.array([[1.0, 2.0, 0.0, 0.0], [0.0, 0.0, 0.0, 3.0]])
    flat = np.round(flat)  # a multiple of the second entry follows the first exactly
    flat[:, 1] = 2 * flat[:, 0]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(flat.tolist())] + [(None, flat[0].tolist())] * 2, "vec_id long, embedding array<double>")
    found = whitening.whiten(table, "embedding")
    rows = found.rows.collect()
    assert len(rows) == 52 and all(len(r["whitened"]) == 4 and r["whitened"][2:] == [0.0, 0.0] for r in rows)
    assert found.explained[2:] == [0.0, 0.0] and abs(sum(found.explained) - 1) < 1e-9 and found.identity_error < 1e-9


def test_one_row_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0])], schema), "embedding")
    assert [tuple(r) for r in one.rows.collect()] == [(1, 0, [0.0, 0.0])] and one.explained == [0.0, 0.0] and one.identity_error == 0.0
    for rows in ([], [(1, None), (2, [None]), (3, [])]):
        none = whitening.whiten(spark.createDataFrame(rows, schema), "embedding")
        assert none.rows.collect() == [] and none.rows.columns == ["vec_id", "deviation", "whitened"] and none.count == 0


def test_a_deviation_beyond_a_long_is_null(spark):
    table = spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0])], "vec_id long, embedding array<double>")
    assert [r["deviation"] for r in whitening.whiten(table, "embedding").rows.collect()] == [None, None]


def test_whitening_query(spark):
    rows = catalog.op13_embedding_whitening(spark, SF)
    assert rows.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    entries = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, whitened, explained = plain_whitening([r["embedding"] for r in entries], 32)
    got = {(r["vec_id"], r["component"]): r for r in rows.collect()}
    assert len(got) == 32 * len(entries)
    ids = [r["vec_id"] for r in entries]
    assert [got[i, 1]["deviation"] for i in ids] == deviation
    close_up_to_sign([[got[i, c]["whitened"] for c in range(1, 33)] for i in ids], whitened)
    assert np.allclose([got[ids[0], c]["explained"] for c in range(1, 33)], explained[:32], rtol=1e-4)
    assert all(r["identity_error"] < 1e-4 for r in got.values())
