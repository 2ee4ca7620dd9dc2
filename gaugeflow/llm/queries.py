"""Registered queries of this subpackage and the SQL some are checked against."""

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    best_fit,
    extendible_hash,
    fill_middle,
    html_text,
    order_minhash,
    permutation_index,
    rp_forest,
    source_mix,
    suffix_dedup,
    token_alignment,
    url_filter,
    warc_store,
    zstd_language,
)
from gaugeflow.llm.frames import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.link_vectors(_table(spark, sf_dir, "embeddings"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op3_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    predicted = zstd_language.predict_languages(docs, zstd_language.learn_languages(docs))
    held_out = zstd_language.is_held_out(F.col("doc_id"))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_store.archive_round_trip(_table(spark, sf_dir, "pages"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = source_mix.quality_weights(_table(spark, sf_dir, "labels"))
    mixed = source_mix.mix_sources(_table(spark, sf_dir, "documents"), quality)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(_table(spark, sf_dir, "documents"))


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return permutation_index.nearest_vectors(embeddings, F.col("vec_id") % 20 == 0)


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.thin_page_urls(pages))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_hash.exact_duplicates(_table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    text = fill_middle.restored(F.col("form"), F.col("output"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align_tokens(_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_links") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = stored(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    counted = token_alignment.alignment_counts(aligned)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
    return counted.select(*names)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: f for name, f in globals().items() if name.startswith("op")}
    return {**own, "pipeline": corpus_pipeline.run}


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)

_SQL = {
    "op1_rp_forest": """
        WITH RECURSIVE rows AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings
        ), usable AS (
          SELECT vec_id, label, vec, sqrt(list_dot_product(vec, vec)) AS size FROM rows
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(vec) > 0
            AND len(list_filter(vec, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND list_dot_product(vec, vec) > 0
        ), links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.vec) = len(b.vec)
          WHERE list_dot_product(a.vec, b.vec) / (a.size * b.size) >= 0.98
        ), reached AS (
          SELECT vec_id AS id, vec_id AS other FROM rows
          UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a
        ), least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id,
               coalesce(vec_id = component_id, false) AS kept
        FROM rows LEFT JOIN least ON id = vec_id LEFT JOIN counted ON a = vec_id""",
    "op4_warc_store": """
        WITH payloads AS (
          SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), hashed AS (
          SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h FROM payloads
        ), grouped AS (
          SELECT *, max(page_id) OVER (PARTITION BY h) AS largest FROM hashed
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr(
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 1 + CAST((CAST('0x' || substr(h, CAST(1 + (i // 4) * 5 AS INT), 5) AS INT)
                           >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
               CASE WHEN largest IS NULL OR page_id = largest THEN 'response' ELSE 'revisit' END
                 AS record_type,
               CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
        FROM grouped""",
    "op9_url_filter": f"""
        WITH rules(verdict, h, p) AS (VALUES {_RULE_ROWS}), rest AS (
          SELECT page_id, html, CASE WHEN instr(url, '://') > 0
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
          SELECT page_id, html, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
            translate(regexp_extract(rest, '^[^/?#]*'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM rest
        ), bare AS (
          SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''),
            ':[0-9]*$', ''), '^(www|m)\\.', '') AS bare FROM parts
        ), named AS (
          SELECT *, CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+$', '') END AS canonical
          FROM bare
        ), listed AS (
          SELECT DISTINCT canonical FROM named
          WHERE coalesce(length(html), 0) < 1000 AND canonical IS NOT NULL
        ), ruled AS (
          SELECT named.*, (SELECT max(struct_pack(n := length(h || p), verdict := verdict, rule := h || p))
            FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
          FROM named
        )
        SELECT page_id, host, path, best.rule AS rule,
          coalesce(best.verdict, CASE WHEN listed.canonical IS NULL THEN 'allow' ELSE 'block' END)
            AS verdict
        FROM ruled LEFT JOIN listed USING (canonical)""",
    "op11_extendible_hash": r"""
        WITH texts AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
        FROM texts""",
    "op12_fill_middle": r"""
        WITH texts AS (
          SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
          FROM documents
        ), lines AS (
          SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u,
                 list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS d
          FROM texts
        ), cuts AS (
          SELECT *, len(u) AS n, least(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS a,
                 greatest(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                        OR contains(text, '<M>') OR d[3] % 100 >= 100 THEN 'plain'
                      WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
          FROM lines
        ), parted AS (
          SELECT doc_id, n, form, text, array_to_string(u[1:a], '') AS p,
                 array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
          FROM cuts
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
        FROM parted""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
