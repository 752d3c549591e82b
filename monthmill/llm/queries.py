"""The registered queries of the operators and the SQL that DuckDB compares them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthmill.llm import (
    exact_dedup,
    fill_in_middle,
    html_text,
    lattice_lm,
    mixing,
    order_minhash,
    packing,
    pii,
    sharding,
    simhash,
    suffix_dedup,
    token_alignment,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(_table(spark, sf_dir, "pages"))


def op3_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.lm_scores(_table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"))


def op4_sharding_64k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with shards of 64 KiB, which small tables split several times, too."""
    return sharding.shard_report(_table(spark, sf_dir, "documents"), 1 << 16)


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.neighbour_report(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(_table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle_report(_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_html_text": op2_html_text,
    "op3_lattice_lm": op3_lattice_lm,
    "op4_sharding": op4_sharding,
    "op4_sharding_64k": op4_sharding_64k,
    "op5_order_minhash": op5_order_minhash,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_pii": op8_pii,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_token_alignment": op11_token_alignment,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_SHARDS = r"""
        WITH d AS (
            SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
                ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 6))::BIGINT AS hash
            FROM documents
        ), prefixes AS (
            SELECT d.*, depth::INTEGER AS depth, hash >> (24 - depth) AS prefix FROM d, range(0, 25) AS r(depth)
        ), sums AS (
            SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs FROM prefixes GROUP BY ALL
        ), fitting AS (
            SELECT p.doc_id, p.n_bytes, p.hash, p.depth, shard_bytes, shard_docs,
                row_number() OVER (PARTITION BY p.doc_id ORDER BY p.depth) AS place
            FROM prefixes p JOIN sums USING (depth, prefix) WHERE shard_bytes <= LIMIT_BYTES OR shard_docs = 1
        )
        SELECT doc_id, n_bytes, substr(lpad(bin(hash), 24, '0'), 1, depth) AS shard, depth, shard_bytes, shard_docs,
            shard_bytes > LIMIT_BYTES AS oversized
        FROM fitting WHERE place = 1
    """

LLM_ORACLE: dict[str, str] = {
    "op4_sharding": _SHARDS.replace("LIMIT_BYTES", "16777216"),
    "op4_sharding_64k": _SHARDS.replace("LIMIT_BYTES", "65536"),
    "op9_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST) AS place,
                first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST) AS keep_id,
                count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
    """,
    "op10_mixing": r"""
        WITH d AS (
            SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
        ), weighed AS (
            SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources
        ), levels AS (
            SELECT *, row_number() OVER by_cap AS place,
                (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE
                    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
            FROM weighed
            WINDOW by_cap AS (ORDER BY source_size / weight, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END),
                before AS (ORDER BY source_size / weight, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), shares AS (
            SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * coalesce(
                (SELECT level FROM levels WHERE 3 * source_size > weight * level ORDER BY place LIMIT 1), 'inf'::DOUBLE)) AS target
            FROM levels
        ), rated AS (
            SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM shares
        ), ranked AS (
            SELECT d.doc_id, d.text, d.size, r.*, floor(rate)::BIGINT AS certain, rate - floor(rate) AS p,
                (('0x' || substr(md5('20240:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT + 0.5) / 281474976710656.0 AS u
            FROM d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
        ), odds AS (
            SELECT *, (u / (1 - u)) / (p / (1 - p)) AS q FROM ranked
        ), placed AS (
            SELECT *, CASE WHEN p > 0 THEN floor(q / (1 + q) * 281474976710656.0)::BIGINT END AS rank,
                target - sum(certain * size) OVER (PARTITION BY source) AS budget
            FROM odds
        ), running AS (
            SELECT *, sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank) AS upto,
                sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source, rank) AS words
            FROM placed
        ), copied AS (
            SELECT *, CASE WHEN size = 0 THEN 0 ELSE certain + CASE WHEN p > 0 AND upto - words < budget
                AND upto - budget < budget - (upto - words) THEN 1 ELSE 0 END END::INTEGER AS copies
            FROM running
        )
        SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM copied
    """,
    "op13_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
                regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
            FROM documents
        ), drawn AS (
            SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS first,
                ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS second,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
                    WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM d
        ), parts AS (
            SELECT *, array_to_string(units[1:least(first, second)], '') AS prefix,
                array_to_string(units[least(first, second) + 1:greatest(first, second)], '') AS middle,
                array_to_string(units[greatest(first, second) + 1:], '') AS suffix
            FROM drawn
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM parts
    """,
}
