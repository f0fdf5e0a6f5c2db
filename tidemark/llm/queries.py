"""The dealt operators as registered queries: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    chat,
    fill_middle,
    fingerprints,
    html_extract,
    line_dedup,
    minhash_forest,
    packing,
    quality,
    secret_scan,
    simhash,
    spill_align,
    token_count,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(_table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, model)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    added = spark.sql(f"SELECT -7L AS conv_id, turn, role, r'{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digests(chat.format_turns(rows, chat.marked_prefix))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spill_align.align(_table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.pieces(_table(spark, sf_dir, "documents")))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_secrets": op2_secrets,
    "op3_line_dedup": op3_line_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_html": op5_html,
    "op6_token_counts": op6_token_counts,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_chat": op10_chat,
    "op11_alignment": op11_alignment,
    "op12_fill_middle": op12_fill_middle,
    "op13_minhash": op13_minhash,
}

# SQL twins by query name; the other queries are tested against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op10_chat": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
        ),
        -- A control string gets a backslash; role and text stand between marks of 6, 2 and 9 characters.
        sized AS (
            SELECT *, length(role) + length(text) + 17
                + len(regexp_extract_all(text, '<\\*/?turn\b'))
                + len(regexp_extract_all(text, '#\\*##\s*[\p{L}\p{N}_]+:')) AS size
            FROM said
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(size)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op12_fill_middle": """
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ),
        numbers AS (
            SELECT doc_id, text, length(text) AS n,
                ('0x' || substr(h, 1, 8))::BIGINT % (length(text) + 1) AS p, ('0x' || substr(h, 9, 8))::BIGINT % (length(text) + 1) AS q,
                ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4
            FROM hashed
        ),
        cut AS (
            SELECT doc_id, text, n, least(p, q) AS a, greatest(p, q) AS b,
                CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
                    WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM numbers
        ),
        parts AS (
            SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cut
        )
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM parts
    """,
}
