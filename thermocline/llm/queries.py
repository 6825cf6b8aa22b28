"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from thermocline.llm import language_model
from thermocline.llm.byte_bpe import round_trip_digests
from thermocline.llm.chat_format import chat_windows, conversation_digests, with_control_strings
from thermocline.llm.common import table
from thermocline.llm.conversation_repair import damage, repair_report
from thermocline.llm.exact_dedup import exact_duplicates
from thermocline.llm.hard_negatives import mine_hard_negatives, relabelled
from thermocline.llm.ngram_join import ngram_components
from thermocline.llm.packing import pack_documents
from thermocline.llm.secret_scan import scan
from thermocline.llm.substring_dedup import repeated_paragraphs
from thermocline.llm.toxicity import score_documents
from thermocline.llm.url_filter import judge_urls
from thermocline.llm.vector_dedup import near_duplicate_vectors

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


@query(
    "op6_exact_dedup",
    r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)
    """,
)
def op6(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op3_byte_bpe")
def op3(spark, sf_dir):
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op8_packing")
def op8(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_url_filter")
def op5(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


@query("op1_secret_scan")
def op1(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))


@query(
    "op10_vector_dedup",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    ), n AS (
        SELECT vec_id, [x / sqrt(list_dot_product(e, e)) FOR x IN e] AS u FROM v
        WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_dot_product(e, e) > 0
    ), link AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND list_dot_product(a.u, b.u) >= 0.9
    ), reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
    ), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
    ), d AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
    SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept
    FROM c LEFT JOIN d USING (vec_id)
    """,
)
def op10(spark, sf_dir):
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_ngram_join")
def op7(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"))


@query("op4_substring_dedup")
def op4(spark, sf_dir):
    return repeated_paragraphs(table(spark, sf_dir, "documents"))


@query("op9_language_model")
def op9(spark, sf_dir):
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query(
    "op11_hard_negatives",
    """
    WITH e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
               CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
        FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ), p AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
    """,
)
def op11(spark, sf_dir):
    return mine_hard_negatives(relabelled(table(spark, sf_dir, "embeddings")))


@query("op12_conversation_repair")
def op12(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damage(conversations))


@query(
    "op13_chat_format",
    r"""
    WITH RECURSIVE c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), t AS (
        SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
               len(regexp_extract_all(text, ' ?\p{L}{1,6}| ?\p{N}{1,3}|[^\p{L}\p{N}]')) + 8 AS tokens,
               length('<s>[INST]  [/INST] </s>') + list_sum([length(replace(replace(replace(replace(replace(x, '\', '\\'),
                   '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) FOR x IN [role, text]]) AS chars
        FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role)
    ), s AS (
        SELECT conv_id, tokens AS sys_tokens, chars AS sys_chars FROM t
        WHERE pos = 1 AND role = 'system' AND n > 1 AND 2 * tokens <= 512
    ), a AS (
        SELECT t.conv_id, pos // 1024 AS seg, pos, n, tokens, chars, 416 - coalesce(sys_tokens, 0) AS room, coalesce(sys_chars, 0) AS sys_chars,
               row_number() OVER (PARTITION BY t.conv_id, pos // 1024 ORDER BY pos) AS place
        FROM t LEFT JOIN s ON s.conv_id = t.conv_id WHERE sys_chars IS NULL OR pos > 1
    ), r AS (
        SELECT conv_id, seg, place, 1::BIGINT AS start, tokens AS used FROM a WHERE place = 1
        UNION ALL
        SELECT a.conv_id, a.seg, a.place, CASE WHEN used + tokens > room THEN a.place ELSE start END, CASE WHEN used + tokens > room THEN tokens ELSE used + tokens END
        FROM r JOIN a ON a.conv_id = r.conv_id AND a.seg = r.seg AND a.place = r.place + 1
    ), f AS (
        SELECT a.*, start, sum(tokens) OVER back AS tail, row_number() OVER back AS nth
        FROM a JOIN r USING (conv_id, seg, place) WINDOW back AS (PARTITION BY conv_id, seg, start ORDER BY place DESC)
    ), w AS (
        SELECT conv_id, seg, start, sum(tokens) > any_value(room) AS oversized, sum(chars) + any_value(sys_chars) AS chars,
               coalesce(sum(chars) FILTER (tail <= 96 AND nth <= 4), 0) AS again_chars
        FROM f GROUP BY ALL
    ), x AS (
        SELECT conv_id, chars + CASE WHEN oversized THEN 0 ELSE lag(again_chars, 1, 0::HUGEINT) OVER (PARTITION BY conv_id ORDER BY seg, start) END AS chars FROM w
    ), y AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM x GROUP BY 1)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
    FROM t JOIN y USING (conv_id) GROUP BY conv_id
    """,
)
def op13(spark, sf_dir):
    return conversation_digests(chat_windows(with_control_strings(table(spark, sf_dir, "conversations"))))
