"""Registered queries of the training-data operators: one thin query each, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, imatch, maxent_lm, merkle, mixing, near_dedup, pii, quality, secrets, sentencepieces, substring_dedup, tool_calls, vector_codes
from .common import table


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.imatch_report(spark, table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_report(spark, table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(spark, table(spark, sf_dir, "documents")).drop("id", "hash")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, messages = tool_calls.from_chat(table(spark, sf_dir, "conversations"))
    return tool_calls.linked(spark, calls, results, tool_calls.CHAT_TOOLS, messages=messages)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, table(spark, sf_dir, "documents")).drop("row_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(spark, table(spark, sf_dir, "documents"))


def op11_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.lm_report(spark, table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_report(spark, table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(spark, table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_imatch, op2_substring_dedup, op3_near_dedup, op4_sentencepiece, op5_pii, op6_quality, op7_secrets, op8_tool_calls, op9_exact_dedup, op10_mixing,
                                   op11_maxent_lm, op12_merkle, op13_vector_codes)}


def _secret_sql() -> str:
    """Leftmost non-overlapping matches: the gaps between them and their lengths give the positions."""
    found = []
    for i, r in enumerate((*secrets.BASE, *secrets.MORE)):
        rx = r.regex.replace("'", "''")
        found.append(f"""
            SELECT doc_id, {i} AS k, '{r.kind}' AS kind, g, h, v, i,
                   list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS s
            FROM (SELECT doc_id, g, h, v, unnest(generate_series(1, len(h))) AS i FROM (
                SELECT doc_id, string_split_regex(t, '{rx}') AS g, regexp_extract_all(t, '{rx}', 0) AS h,
                       regexp_extract_all(t, '{rx}', {r.group}) AS v FROM n))
            WHERE length(v[i]) >= {r.least}""")
    return f"""
        WITH n AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        f AS (SELECT doc_id, k, kind, s, kind || ':' || s::BIGINT || ':' || (s + length(h[i]))::BIGINT AS span
              FROM ({" UNION ALL ".join(found)})),
        a AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
                     count(*) FILTER (k = 2) AS n_hex, string_agg(span, ',' ORDER BY s, k) FILTER (k < 3) AS base,
                     string_agg(span, ',' ORDER BY s, k) AS spans FROM f GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM n LEFT JOIN a USING (doc_id)"""


# crc32 of a decimal number, bit by bit; trees climb in recursive CTEs.
_CRC32 = """xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT),
    lambda a, c: list_reduce([xor(a, c)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, (r & 1) * 3988292384 + z))), 4294967295::UBIGINT)"""


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        values = [f"{c}::VARCHAR" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"

    def grown(base: str) -> str:
        return f"""({base} UNION ALL
          SELECT tree, level + 1, node // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY node))
          FROM %s WHERE n > 1 GROUP BY tree, level, node // 16, n)"""

    def runs(of: str) -> str:
        return f"(SELECT tree, level, node // 16 AS run, list(h ORDER BY node) AS hs FROM {of} WHERE n > 1 GROUP BY ALL)"

    def climb(base: str, of: str, name: str) -> str:
        return f"""({base} UNION ALL
          SELECT c.id, c.tree, c.level + 1, c.node // 16, sha256(array_to_string(list_transform(r.hs, lambda x, i: CASE WHEN i = c.node % 16 + 1 THEN c.cur ELSE x END), '')),
                 c.proof || array_to_string(list_filter(r.hs, lambda x, i: i <> c.node % 16 + 1), '')
          FROM {name} c JOIN {of} r ON r.tree = c.tree AND r.level = c.level AND r.run = c.node // 16)"""

    ended = "(SELECT * FROM {0} QUALIFY level = max(level) OVER (PARTITION BY id))"
    return f"""
        WITH RECURSIVE
        d AS (SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN {_CRC32} % 5 = 0
                THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {leaf("text")} END AS got FROM documents),
        s AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (ORDER BY source, doc_id, leaf) AS id,
                row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
        a AS {grown("SELECT tree, 0 AS level, pos AS node, n, leaf AS h FROM s") % "a"},
        b AS {grown("SELECT 0::BIGINT AS tree, 0 AS level, tree AS node, (SELECT count(DISTINCT tree) FROM s) AS n, h FROM a WHERE n = 1") % "b"},
        ra AS {runs("a")}, rb AS {runs("b")},
        c AS {climb("SELECT id, tree, 0 AS level, pos AS node, got AS cur, '' AS proof FROM s", "ra", "c")},
        e AS {climb(f"SELECT id, 0::BIGINT AS tree, 0 AS level, tree AS node, cur, proof FROM {ended.format('c')}", "rb", "e")}
        SELECT s.doc_id, s.leaf, a.h AS subroot, b.h AS root, sha256(e.proof) AS proof_sha256, e.cur AS folded_root, e.cur = b.h AS verified
        FROM s JOIN a ON a.tree = s.tree AND a.n = 1 JOIN b ON b.n = 1 JOIN {ended.format('e')} e ON e.id = s.id"""


def _codes_sql() -> str:
    """Integers, 16 parts, two rounds of Lloyd and the last assignment, spelled out."""
    def nearest(of: str, book: str) -> str:
        return f"""(SELECT * FROM (SELECT r.id, r.p, r.v, c.e, list_sum(list_transform(range(1, len(r.v) + 1), lambda i: (r.v[i] - c.v[i]) * (r.v[i] - c.v[i])))::BIGINT AS dist
            FROM {of} r JOIN {book} c ON c.p = r.p) QUALIFY row_number() OVER (PARTITION BY id, p ORDER BY dist, e) = 1)"""

    def moved(near: str, book: str) -> str:
        return f"""(SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM {book} c LEFT JOIN (
            SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
              SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM {near}) GROUP BY p, e, i) GROUP BY p, e) m
            ON m.p = c.p AND m.e = c.e)"""

    return f"""
        WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id) AS id FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM k, (SELECT unnest(range(16)) AS p)),
        b0 AS MATERIALIZED (SELECT p, id - 1 AS e, v FROM parts WHERE id <= 64),
        n0 AS MATERIALIZED {nearest("parts", "b0")}, b1 AS MATERIALIZED {moved("n0", "b0")},
        n1 AS MATERIALIZED {nearest("parts", "b1")}, b2 AS MATERIALIZED {moved("n1", "b1")},
        n2 AS MATERIALIZED {nearest("parts", "b2")},
        coded AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM n2 GROUP BY id)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
        FROM k JOIN coded USING (id)"""


ORACLE = {
    "op13_vector_codes": _codes_sql(),
    "op12_merkle": _merkle_sql(),
    "op7_secrets": _secret_sql(),
    "op9_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY t)""",
}
