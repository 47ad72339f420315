"""Registered queries of the operators, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from errlens.llm import bpe, divergence, exact_dedup, fim, langid, packing, sharding, simhash, suffix_dedup, token_counts, topk, toxicity, warc
from errlens.llm.common import read_table, ship
from errlens.session import scratch_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
END_ID = 2


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5




def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    cut = packing.pieces(docs, public_tokenizers.path(BYTE_BPE), END_ID)
    placed = packing.pack(cut.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return placed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), fold("id") != 0)
    return toxicity.tag(docs, model).select(F.col("id").alias("doc_id"), (F.coalesce(fold("id"), F.lit(1)) == 0).alias("held_out"), "score",
                                            (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold("id") != 0)
    return langid.identify(docs, model).select(F.col("id").alias("doc_id"), (F.coalesce(fold("id"), F.lit(1)) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"), min_revisit=0)
    back = warc.read_archives(manifest, payloads=False)
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    both = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents"), path), path)
    return both.select(F.col("id").alias("doc_id"), F.expr("octet_length(ids) div 4").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return token_counts.over(counts, 2048).withColumnRenamed("id", "doc_id")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(read_table(spark, sf_dir, "documents"), carry={"text_sha256": F.sha2("t", 256)})
    return found.withColumnRenamed("id", "doc_id")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(read_table(spark, sf_dir, "documents"), shards=40)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fim.round_trip(read_table(spark, sf_dir, "documents"))
    return both.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _shipped(q) for q in (
        op1_packing,
        op2_simhash,
        op3_toxicity,
        op4_langid,
        op5_warc,
        op6_bpe,
        op7_token_counts,
        op8_topk,
        op9_suffix_dedup,
        op10_exact_dedup,
        op11_sharding,
        op12_fim,
        op13_divergence,
    )}

ORACLE: dict[str, str] = {
    "op5_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
        d AS (SELECT page_id, t, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS last FROM p)
        SELECT page_id, strlen(t) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
        FROM d""",
    "op8_topk": """
        WITH v AS (SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.place, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
              FROM v q JOIN v c ON q.place <> c.place AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY place ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op10_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op12_fim": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                          sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
        n AS (SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
                     ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
        p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
    "op13_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n_lang FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 30),
        cell AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v, sum(n_lang) AS whole FROM kept GROUP BY lang),
        g AS (SELECT lang, source, coalesce(own, 0) AS own FROM (SELECT DISTINCT lang, source FROM d)
              LEFT JOIN (SELECT lang, source, sum(n) AS own FROM cell GROUP BY ALL) USING (lang, source)),
        p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
                     1 + 1000000000::HUGEINT * (coalesce(n, 0) + 5) // (own + 5 * v) AS p,
                     1 + 1000000000::HUGEINT * (n_lang + 5) // (whole + 5 * v) AS q
              FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN cell USING (lang, source, term)),
        pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                 FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        both_parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
            UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, (row_number() OVER w)::INT AS rank FROM both_parts
        WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
        QUALIFY part = 'pair' OR row_number() OVER w <= 50""",
}
