"""One query for each operator over its whole table, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import (
    arc_warc, bpe, decontaminate, exact_dedup, language, merkle, ngram_join, packing, quality, secret_scan, sharding, substring_dedup, whitening,
)
from brindle.llm.tables import on_workers
from brindle.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(modulus: int) -> Column:
    """crc32 of the id as text; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_versions(_load(spark, sf_dir, "documents").select("doc_id", "text"))
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    spans = F.array_join(F.transform("found", one), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, secret_scan.KINDS), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_load(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.occurrences(_load(spark, sf_dir, "documents"), _load(spark, sf_dir, "benchmark"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents").withColumn("held_out", _remainder(4) == 2)
    model = language.fit(docs.where("NOT held_out"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", _remainder(3) == 1)
    model = quality.fit_sample(docs.where("NOT held_out"), _load(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.interleave(_load(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents")
    spans = materialize(substring_dedup.repeated_spans(docs), "spans")
    partly = spans.where("n_removed > 0 AND n_removed < n_words")
    kept = substring_dedup.cut_texts(docs, partly).dropDuplicates(["doc_id", "words_sha256"])
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("words_sha256").alias("_words"), F.sha2("kept_text", 256).alias("_kept"))
    same = F.expr("doc_id <=> _id AND words_sha256 = _words")
    digest = F.when(F.col("n_removed") == 0, F.col("words_sha256")).otherwise(F.coalesce("_kept", F.sha2(F.lit(""), 256)))
    return spans.join(kept, same, "left").select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids of the texts and of the texts decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode(docs.select("doc_id", "text"), path)
    return bpe.digests(bpe.decode(coded, path))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(_load(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(_load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_arc_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _load(spark, sf_dir, "pages").select("page_id", "url", "html")
    arcs = [scratch_path(spark, f"arc-{version}") for version in (1, 2)]
    second = F.pmod(F.xxhash64("page_id"), F.lit(2)) == 1
    arc_warc.write_arc(pages.where(~second), arcs[0], 1)
    arc_warc.write_arc(pages.where(second), arcs[1], 2)
    warc = scratch_path(spark, "warc")
    arc_warc.convert(spark, arcs, warc)
    records = materialize(arc_warc.read_warc(spark, warc), "warc-records")
    answers = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to")
    )
    # Only responses that a revisit names are looked up.
    revisits = records.where("record_type = 'revisit'").join(answers, "refers_to_record")
    columns = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    plain = records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.select(*columns).union(revisits.select(*columns))


LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents")
    # A NULL doc_id has no checksum, so its row is left as it is.
    altered = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in LEAF_FIELDS]
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, merkle.leaf(*altered)).alias("changed_leaf")
    rows = merkle.manifest(docs.select(*LEAF_FIELDS, changed), LEAF_FIELDS, "source", "doc_id", keep=["changed_leaf"])
    folded = rows.withColumn("folded_root", merkle.fold(F.coalesce("changed_leaf", "leaf"), F.col("path")))
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", verified)


SEQUENCE_TOKENS = 1024
END_OF_DOCUMENT = 2


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END_OF_DOCUMENT, SEQUENCE_TOKENS)
    return packed.drop("token_ids")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_load(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    entries = found.rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.try_element_at(F.array(*map(F.lit, found.explained)).cast("array<double>"), F.col("component"))
    return entries.withColumn("component", F.col("at") + 1).select(
        "vec_id", "component", F.lit(found.count).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )


def op_queries() -> dict[str, Query]:
    found = (
        op1_secret_scan, op2_exact_dedup, op3_decontaminate, op4_language, op5_quality, op6_sharding, op7_substring_dedup, op8_bpe, op9_ngram_join,
        op10_arc_warc, op11_merkle_manifest, op12_best_fit_packing, op13_embedding_whitening,
    )
    return {f.__name__: f for f in found}


QUERIES = op_queries()

WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"



def _tree_sql(prefix: str, leaves: str) -> str:
    """Hashes of all nodes over ``leaves`` (kind, i, n, h) and the siblings of each, as table expressions."""
    return f"""
        {prefix}up AS (
            SELECT kind, 0 AS level, i, n, h FROM {leaves} UNION ALL
            SELECT kind, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM {prefix}up WHERE n > 1 GROUP BY kind, level, i // 3, n
        ), {prefix}sib AS (
            SELECT a.kind, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
                coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
            FROM {prefix}up a JOIN {prefix}up b ON a.kind = b.kind AND a.level = b.level AND a.i // 3 = b.i // 3 GROUP BY a.kind, a.level, a.i
        )"""


def _walk_sql(prefix: str, start: str) -> str:
    """From ``start`` (doc_id, kind, i, n, folded, proof) to the root of each tree."""
    return f"""
        {prefix}walk AS (
            SELECT doc_id, kind, 0 AS level, i, n, folded, proof FROM {start} UNION ALL
            SELECT doc_id, kind, level + 1, i // 3, (n + 2) // 3, sha256(before || folded || after), proof || before || after
            FROM {prefix}walk JOIN {prefix}sib USING (kind, level, i) WHERE n > 1
        )"""


def _leaf_sql(text: str) -> str:
    values = [text if c == "text" else f"{c}::VARCHAR" for c in LEAF_FIELDS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


# Bits of crc32: each byte is followed by eight steps of -1.
_CRC32 = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, e: CASE WHEN e >= 0 THEN xor(a, e)
    WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

ORACLES = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce('+' || source, '') AS kind, {_leaf_sql("text")} AS h,
                CASE WHEN {_CRC32} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed
            FROM documents
        ), l AS (
            SELECT *, row_number() OVER (PARTITION BY kind ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY kind) AS n FROM d
        ), {_tree_sql("", "l")}, sub AS (SELECT kind AS name, h FROM up WHERE n = 1),
        t AS (SELECT name, '' AS kind, row_number() OVER (ORDER BY encode(name)) - 1 AS i, count(*) OVER () AS n, h FROM sub),
        {_tree_sql("top_", "t")},
        s AS (SELECT doc_id, kind, i, n, coalesce(changed, h) AS folded, '' AS proof FROM l), {_walk_sql("", "s")},
        ts AS (SELECT doc_id, '' AS kind, t.i, t.n, folded, proof FROM walk JOIN t ON walk.kind = t.name WHERE walk.n = 1), {_walk_sql("top_", "ts")}
        SELECT doc_id, l.h AS leaf, sub.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
        FROM (SELECT * FROM top_walk WHERE n = 1) w JOIN l USING (doc_id) JOIN sub ON l.kind = sub.name CROSS JOIN (SELECT h FROM top_up WHERE n = 1) r
    """,
    "op2_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        ), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
    """,
    "op7_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
        i AS (SELECT doc_id, unnest(generate_series(1, len(words)::BIGINT - 49)) AS s FROM w),
        v AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS h FROM i JOIN w USING (doc_id)),
        f AS (SELECT h, min(doc_id) AS first FROM v GROUP BY h),
        hit AS (SELECT v.doc_id, s FROM v JOIN f USING (h) WHERE first < v.doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 49)) AS p FROM hit),
        each AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM w),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (doc_id, p)
            GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
            sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)
    """,
    "op9_ngram_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g
            FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words)::BIGINT - 4, 1))) AS i FROM w WHERE len(words) > 0)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        link AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
        )
        SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reach.b) AS component_id
        FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id
    """,
    "op10_arc_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), g AS (
            SELECT payload_digest, payload_bytes, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN top <> page_id THEN top END AS refers_to
        FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
    """,
}
