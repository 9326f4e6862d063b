"""Registered queries of the operators over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, decontaminate, fill_middle, licenses, quality, repeats, secrets, sentence_pieces, simhash, token_counts, top_k, url_filter, warc
from .common import table


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.archive(table(spark, sf_dir, "pages")))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.measure(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.measure(table(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_warc_index, op2_exact_top_k, op3_quality, op4_benchmark_decontamination, op5_repeated_bytes, op6_license_scan, op7_token_counts, op8_sentence_pieces,
    op9_simhash_near_duplicates, op10_url_filter, op11_token_alignment, op12_fill_middle, op13_secrets,
)}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: DuckDB SQL of the queries that SQL can say.
ORACLES = {
    "op1_warc_index": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
        d AS (SELECT page_id, x, strlen(h)::BIGINT AS payload_bytes,
                     array_to_string(list_transform(range(8), lambda k: array_to_string(list_transform(range(4), lambda j:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(x, 5 * k + 1, 5))::BIGINT) >> (15 - 5 * j)) & 31)::INT, 1)), '')), '') AS payload_digest,
                     min(page_id) OVER (PARTITION BY x) AS f FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> f THEN f END AS refers_to FROM d""",
    "op2_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
              FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op4_benchmark_decontamination": f"""
        WITH b AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
        win AS (SELECT DISTINCT item_id, len(list_slice(w, i, i + 9)) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS g
                FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
        grams AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
        found AS (SELECT doc_id, i, win.n, item_id FROM grams JOIN win USING (n, g)),
        hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
                  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op12_fill_middle": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || doc_id::VARCHAR) AS s FROM documents),
        h AS (SELECT *, len(w) AS n, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2,
                     ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM t),
        f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        p AS (SELECT *, array_to_string(list_slice(w, 1, a), '') AS pre, array_to_string(list_slice(w, a + 1, b), '') AS mid, array_to_string(list_slice(w, b + 1, n), '') AS suf FROM f)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(x) AS restored_sha256 FROM p""",
}
