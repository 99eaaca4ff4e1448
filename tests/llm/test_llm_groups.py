"""Repeated passages, near copies, components, archives: against brute force."""

import gzip
import hashlib
import random
import re

import pytest
from brindle.llm import arc_warc, catalog, ngram_join, substring_dedup
from brindle.llm.components import components

from oracle import difference

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_equals_oracle(spark, name):
    assert difference(spark, SF, catalog.QUERIES[name], catalog.ORACLES[name]) == ""


# --- repeated passages -----------------------------------------------------------------------


def passages(vocabulary, count=60):
    rng = random.Random(vocabulary)
    fresh = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    shared = [fresh(rng.randint(4, 30)) for _ in range(6)]
    rows = []
    for i in range(count):
        text = [w for _ in range(rng.randint(0, 4)) for w in (fresh(rng.randint(0, 9)) + rng.choice(shared)[rng.randint(0, 3) :])]
        rows.append((rng.randrange(40), rng.choice([" ", "\n", " \t"]).join(text)))
    return [*rows, *rows[:5], (3, None), (None, None), (None, " ".join(shared[0] + shared[1])), (None, " ".join(shared[0])), (2, ""), (1000, " ".join(shared[0]))]


def plain_removal(rows, window):
    least = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, float("inf")), least(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = {p for s in range(len(w) - window + 1) if first[tuple(w[s : s + window])] < least(i) for p in range(s, s + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append(str((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())))
    return sorted(out)


@pytest.mark.parametrize("vocabulary, window", [(2, 5), (30, 5), (1000, 12), (1000, 25)])
def test_removed_words_equal_brute_force(spark, monkeypatch, tmp_path, vocabulary, window):
    rows = passages(vocabulary)
    monkeypatch.setattr(substring_dedup, "WINDOW", window)
    monkeypatch.setattr(substring_dedup.repeated_spans, "__defaults__", (window,))
    frame(spark, [(*r, "x", 1) for r in rows], "doc_id long, text string, removed string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.op7_substring_dedup(spark, str(tmp_path)).collect()
    assert sorted(str((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in got) == plain_removal(rows, window)


def test_a_passage_in_all_documents_and_a_long_text(spark):
    shared = " ".join(f"s{i}" for i in range(80))
    rows = [(i, f"own{i} {shared} end{i}") for i in range(300)] + [(500, " ".join(f"u{i}" for i in range(200_000)) + " " + shared)]
    got = {r["doc_id"]: r for r in substring_dedup.repeated_spans(frame(spark, rows)).collect()}
    assert got[0]["n_removed"] == 0 and {got[i]["n_removed"] for i in range(1, 300)} == {80}
    assert [tuple(s) for s in got[500]["removed"]] == [(200_000, 200_080)]
    assert substring_dedup.repeated_spans(frame(spark, [])).count() == 0


# --- near copies -----------------------------------------------------------------------------


def families(seed=1):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    rows, i = [], 0
    for size, edits in [(1, 0), (2, 1), (5, 2), (25, 3), (40, 1), (12, 6)]:
        base = fresh(rng.randint(40, 160))
        for _ in range(size):
            text = base[:]
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append((i := i + 1, " ".join(text)))
    chain = fresh(100)
    for step in range(12):
        chain = chain[2:] + fresh(2)
        rows.append((i := i + 1, "\n".join(chain).upper()))
    line = "released under the licence of all"
    rows += [(i + 1, line), (i + 2, line + " x"), (i + 3, line.upper()), (i + 4, "a b"), (i + 5, "A  B"), (i + 6, "a b c"), (i + 7, ""), (i + 8, None), (i + 9, " \n")]
    rows += [(i + 20 + n, line + f" and then {n}") for n in range(20)]
    rng.shuffle(rows)
    return [*rows, (None, rows[0][1]), (None, None), rows[1], (5, "w1 w2 w3 w4 w5 w6"), (5, " ".join(fresh(50)))]


def plain_groups(rows, roots=False):
    sets = []
    for _, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[s : s + 5]) for s in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    if roots:
        return [find(x) for x in range(len(rows))]
    members = {}
    for x in range(len(rows)):
        members.setdefault(find(x), []).append(rows[x][0])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return [(rows[x][0], len(sets[x]), least(members[find(x)])) for x in range(len(rows))]


@pytest.mark.parametrize("options", [{}, {"star_rounds": 0}, {"list_rows": 3}])
def test_groups_equal_brute_force(spark, options):
    rows = families()
    docs = frame(spark, [(*r, "x", 7) for r in rows], "doc_id long, text string, node string, component_id int")
    got = ngram_join.near_duplicates(docs, **options).collect()
    want = plain_groups(rows)
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got)
    kept = [r for r in got if r["kept"] and r["n_shingles"]]
    assert len({r["component_id"] for r in kept}) <= len(kept)


@pytest.mark.parametrize("edits", [3, 4])
def test_a_large_family_makes_few_pairs(spark, monkeypatch, edits):
    """With 3 edits only the original links the copies; with 4 nothing links them."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 600):
        text = base[:]
        for at in range(edits):
            text[10 + 40 * at + rng.randrange(9)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    verified = []
    verify = ngram_join._Join.verify

    def counted(self, pairs):
        verify(self, pairs)
        verified.append(self.done.count())

    monkeypatch.setattr(ngram_join._Join, "verify", counted)
    got = ngram_join.near_duplicates(frame(spark, rows)).collect()
    assert {r["component_id"] for r in got} == ({0} if edits == 3 else set(range(600)))
    assert verified[-1] < 20 * len(rows)


def test_turns_that_spare_nothing_are_not_repeated(spark, monkeypatch):
    """Texts put together from the same passages share every n-gram with some other text and are alike to none."""
    rng = random.Random(4)
    blocks = [" ".join(f"w{b}-{i}" for i in range(30)) for b in range(20)]
    rows = [(i, " ".join(rng.sample(blocks, 5))) for i in range(300)]
    turns = []
    verify = ngram_join._Join.verify
    monkeypatch.setattr(ngram_join._Join, "verify", lambda self, pairs: (turns.append(1), verify(self, pairs)))
    got = ngram_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(str, plain_groups(rows))) == sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got)
    assert len(turns) == 3  # stars of the lists, one further centre, the rest


def test_near_copies_of_an_empty_table(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(70, 60), (60, 70), (None, 3)]])
def test_components(spark, links):
    got = {r["node"]: r["root"] for r in components(frame(spark, links, "u long, v long")).collect()}
    root = {}
    for a, b in links:
        if a is not None and a != b:
            root.setdefault(a, {a}).add(b), root.setdefault(b, {b}).add(a)
    changed = True
    while changed:
        changed = False
        for node, reach in root.items():
            more = set().union(*(root[x] for x in reach))
            if not more <= reach:
                reach |= more
                changed = True
    assert got == {node: min(reach) for node, reach in root.items()}


# --- archives --------------------------------------------------------------------------------


def pages():
    big, other = "é" * 600, "x" * 999
    return [(1, "http://a.example/x y", big), (2, None, big), (9, "http://b.example/ü", big), (3, "u", other), (4, "u", other), (5, "u", None), (6, "u", ""), (None, "u", big), (7, "u", "a\r\n\r\nb\nWARC/1.1\r\n" * 90), (8, "u", "a\r\n\r\nb\nWARC/1.1\r\n" * 90), (10, "u", "y" * 300_000)]


@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip(spark, tmp_path, version):
    rows = frame(spark, pages(), "page_id long, url string, html string")
    arc_warc.write_arc(rows, f"{tmp_path}/arc", version)
    arc_warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    got = arc_warc.read_warc(spark, f"{tmp_path}/warc").collect()
    by_id = {r["page_id"]: r for r in got}
    assert len(got) == len(by_id) == len(pages())
    for page, _, html in pages():
        data = (html or "").encode()
        assert (by_id[page]["payload_bytes"], by_id[page]["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
    record = {r["record_id"]: r["page_id"] for r in got}
    assert {p: record[r["refers_to_record"]] for p, r in by_id.items() if r["record_type"] == "revisit"} == {1: 9, 2: 9, None: 9, 7: 8}
    assert by_id[1]["url"] == "http://a.example/x%20y"


def test_archives_are_compressed_at_the_fastest_level(spark, tmp_path):
    words = [f"{i * 7919 % 1000}-{i % 13}" for i in range(20_000)]
    rows = frame(spark, [(1, "http://a/b", " ".join(words))], "page_id long, url string, html string").coalesce(1)
    arc_warc.write_arc(rows, f"{tmp_path}/arc")
    arc_warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    for path in [*tmp_path.glob("arc/*.gz"), *tmp_path.glob("warc/*.gz")]:
        packed = path.read_bytes()
        plain = gzip.decompress(packed)
        fastest, usual = (len(gzip.compress(plain, level)) for level in (1, 6))
        assert abs(len(packed) - fastest) < abs(len(packed) - usual)


def test_broken_and_empty_archives(spark, tmp_path):
    parser = arc_warc.ArcParser("f")
    with pytest.raises(ValueError, match="version block"):
        list(parser.feed(b"http://a 0.0.0.0 2024 text/html 3\nabc\n"))
    start = arc_warc._version_block(1, "f") + b"\n"
    parser = arc_warc.ArcParser("f")
    assert list(parser.feed(start + b"http://a b 0.0.0.0 2024 text/html 3\nabc\n")) == [
        (len(start), {"URL": "http://a b", "IP-address": "0.0.0.0", "Archive-date": "2024", "Content-type": "text/html", "Archive-length": "3"}, b"abc")
    ]
    list(parser.feed(b"http://a 0.0.0.0 2024 text/html 30\nabc\n"))
    with pytest.raises(ValueError, match="inside a record"):
        parser.close()
    with pytest.raises(ValueError, match="not a header line"):
        list(arc_warc.ArcParser("f").feed(start + b"nonsense\n"))
    arc_warc.write_arc(frame(spark, [], "page_id long, url string, html string"), f"{tmp_path}/arc")
    arc_warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    assert arc_warc.read_warc(spark, f"{tmp_path}/warc").count() == 0


def test_a_block_without_http_is_a_resource():
    record = arc_warc.warc_record("<urn:uuid:1>", "dns:a", "0.0.0.0", "20240102", b"abc", None)
    parsed = list(arc_warc.WarcParser("f").feed(record + b"\r\n\r\n"))
    assert parsed[0][1]["WARC-Type"] == "resource" and parsed[0][1]["WARC-Date"] == "2024-01-02T00:00:00Z" and parsed[0][2] == b"abc"
