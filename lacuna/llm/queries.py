"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm.text import table


def tokenizer_file() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.quality_cnn import scored, trained

    docs = table(spark, sf_dir, "documents")
    return scored(docs, trained(docs, table(spark, sf_dir, "labels")))


def op2_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.prob_minhash import classes

    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op3_toxicity_ssk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.toxicity_ssk import scored, trained

    docs = table(spark, sf_dir, "documents")
    return scored(docs, trained(docs, table(spark, sf_dir, "labels")))


#: The two rows of conversation -7.
PLANTED_CHAT = "\\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.chat_format import digests, format_conversations

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PLANTED_CHAT).alias("text"))
    return digests(format_conversations(rows.unionByName(more)))


def op5_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.fm_decontam import judged

    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.topk import top_k

    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % 100 == 0))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.url_filter import judged

    return judged(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.suffix_dedup import removals

    return removals(table(spark, sf_dir, "documents"))


def op9_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.bpe_replay import token_digests

    return token_digests(table(spark, sf_dir, "documents"), *tokenizer_file())


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.pii import span_digests

    return span_digests(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lacuna.llm.alignment import aligned_documents

    return aligned_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacuna.llm.importance import resampled

    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n.startswith("op") and callable(f)}


SQL = {
    "op4_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(5 + 8 + 2 * length(role) + 2 * length(text) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), chr(10), ''))
                - length(replace(replace(replace(text, '\', ''), '<', ''), '#', ''))) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op5_fm_decontam": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        sizes AS (SELECT DISTINCT least(len(w), 13) AS n FROM b WHERE len(w) > 0),
        bw AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
        dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        found AS (SELECT doc_id, dw.n, i, item FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
            sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id""",
    "op6_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
            FROM (SELECT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op12_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        q AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS digest FROM p),
        f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM q)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
            CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM f""",
    "op13_importance": r"""
        WITH w AS (SELECT 'd' AS kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
            UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
        f AS (SELECT kind, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM w),
        n AS (SELECT kind, doc_id, f, count(*) AS n FROM f GROUP BY ALL),
        x AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM n)),
        steps AS (SELECT f, flatten(list_transform(range(0, len(h) // 2), lambda i: [CAST(instr('123456789ABCDEF', h[2 * i + 1]) * 16 + instr('123456789ABCDEF', h[2 * i + 2]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS s FROM x),
        b AS (SELECT f, xor(list_reduce([CAST(4294967295 AS BIGINT)] || s, lambda c, y: CASE WHEN y >= 0 THEN xor(c, y) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) % 10000 AS bucket FROM steps),
        sums AS (SELECT bucket, sum(n) FILTER (kind = 'd') AS s, sum(n) FILTER (kind = 'b') AS t FROM n JOIN b USING (f) GROUP BY bucket),
        every AS (SELECT CAST(sum(s) AS DOUBLE) AS a, CAST(sum(t) AS DOUBLE) AS b FROM sums),
        g AS (SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (coalesce(a, 0) + 10000)) / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(b, 0) + 10000)))) AS BIGINT) AS gain FROM sums, every),
        d AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS m, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM n JOIN b USING (f) JOIN g USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
        s AS (SELECT w.doc_id, len(w) AS words, coalesce(m, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', sha256('7:' || w.doc_id)[:8]) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM w LEFT JOIN d ON w.doc_id = d.doc_id WHERE kind = 'd'),
        r AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (words >= 20) OVER () AS eligible FROM s)
        SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND r <= 25 * eligible // 100 THEN r END AS rank FROM r""",
}


def oracle_sql() -> dict[str, str]:
    return SQL
