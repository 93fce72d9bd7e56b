"""The registered queries of this subpackage: operators on the synthetic tables.

Each takes (spark, sf_dir) and returns the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, pii, quality, toxicity
from .bpe import encode_decode
from .common import table
from .conversation_repair import damaged, repair
from .exact_dedup import content_sort_dedup
from .nearest import nearest
from .packing import pack
from .simhash import simhash_components
from .substring_dedup import cut_repeats
from .toolcalls import exchange_results, link_calls, link_conversations
from .whitening import whiten


def tokenizer(name: str) -> str:
    """Where the installed package of public tokenizers has the file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), window=2048, end_id=1)


def op2_bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_conversations(table(spark, sf_dir, "conversations"))


#: Tools of ``tool_call_graph``: arguments that do not fit are found by type, by value and within a list.
TOOLS = {
    "reply": {"type": "object", "properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}}, "required": ["prompt", "turn"], "additionalProperties": False},
    "lookup": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "enum": [2, 8, 14]}}, "required": ["query", "limit"]},
    "tally": {"type": "object", "properties": {"counts": {"type": "array", "items": {"type": "integer"}}}, "required": ["counts"]},
}


def tool_call_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages as calls of three tools.  In a fifth of the conversations a call waits for the next one, in a seventh for both neighbours, which is a cycle."""
    m = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    name = lambda turn: F.concat_ws("/", F.col("conv_id").cast("string"), turn.cast("string"))
    turn, tool = F.col("turn"), F.floor(F.col("turn") / 2) % 3
    arguments = (
        F.when(tool == 0, F.to_json(F.struct(F.col("text").alias("prompt"), "turn")))
        .when(tool == 1, F.to_json(F.struct(F.col("text").alias("query"), turn.alias("limit"))))
        .when(turn % 2 == 0, F.to_json(F.struct(F.array(turn, turn + 1).alias("counts"))))
        .otherwise(F.concat(F.lit('{"counts":['), turn.cast("string"), F.lit(","), F.substring(F.to_json(F.array("text")), 2, 1 << 30), F.lit("}")))
    )
    last, following = F.when(turn >= 2, F.array(name(turn - 2))).otherwise(F.array().cast("array<string>")), F.array(name(turn + 2))
    needs = F.when(F.col("conv_id") % 7 == 5, F.concat(last, following)).when(F.col("conv_id") % 5 == 3, following).otherwise(last)
    calls = m.filter("role = 'user'").select(
        "conv_id", "turn", F.lit(-1).alias("at"), name(turn).alias("call_id"), F.element_at(F.array(*map(F.lit, TOOLS)), (tool + 1).cast("int")).alias("name"), arguments.alias("arguments"), needs.alias("depends_on")
    )
    return link_calls(calls, exchange_results(m), TOOLS)


def op5_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_dedup(table(spark, sf_dir, "documents"))


def op7_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"), window=35)


def op8_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op10_language_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    learned = language_id.learn_dictionaries(docs.filter(~held_out))
    return language_id.identify(docs, learned, {"held_out": held_out}, reject=False)


def op11_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_conversation_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack_nnls": op1_pack_nnls,
    "op2_bpe_pair_index": op2_bpe_pair_index,
    "op3_toxicity_ordinal": op3_toxicity_ordinal,
    "op4_tool_calls": op4_tool_calls,
    "tool_call_graph": tool_call_graph,
    "op5_quality_cotraining": op5_quality_cotraining,
    "op6_content_sort": op6_content_sort,
    "op7_recompression": op7_recompression,
    "op8_collision_counting": op8_collision_counting,
    "op9_simhash_tiles": op9_simhash_tiles,
    "op10_language_zstd": op10_language_zstd,
    "op11_pii_bootstrap": op11_pii_bootstrap,
    "op12_whitening": op12_whitening,
    "op13_conversation_viterbi": op13_conversation_viterbi,
}

ORACLE_SQL: dict[str, str] = {
    "op6_content_sort": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op4_tool_calls": """
        WITH u AS (SELECT *, conv_id || '/' || turn AS call_id FROM conversations WHERE role = 'user'),
        a AS (SELECT *, conv_id || '/' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant')
        SELECT u.conv_id, u.turn, -1 AS at, 'call' AS kind, u.call_id, u.turn AS level,
               CASE WHEN a.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
               '{"arguments":{"prompt":' || CAST(to_json(u.text) AS VARCHAR) || ',"turn":' || u.turn || '},"depends_on":['
               || CASE WHEN u.turn >= 2 THEN '"' || u.conv_id || '/' || (u.turn - 2) || '"' ELSE '' END
               || '],"id":"' || u.call_id || '","name":"reply"'
               || CASE WHEN a.call_id IS NULL THEN '' ELSE ',"result":' || CAST(to_json(a.text) AS VARCHAR) END || '}' AS json
        FROM u LEFT JOIN a USING (call_id)
        UNION ALL
        SELECT a.conv_id, a.turn, -1, 'result', a.call_id, NULL, 'orphan_result',
               '{"id":"' || a.call_id || '","result":' || CAST(to_json(a.text) AS VARCHAR) || '}'
        FROM a ANTI JOIN u USING (call_id)
    """,
    "tool_call_graph": """
        WITH u AS (SELECT conv_id, turn, text, conv_id || '/' || turn AS call_id, turn // 2 % 3 AS tool, CASE WHEN conv_id % 7 = 5 THEN 'both' WHEN conv_id % 5 = 3 THEN 'next' ELSE 'last' END AS rule FROM conversations WHERE role = 'user'),
        a AS (SELECT *, conv_id || '/' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'),
        b AS (SELECT u.*, EXISTS (SELECT 1 FROM u x WHERE x.conv_id = u.conv_id AND x.turn = u.turn + 2) AS after, EXISTS (SELECT 1 FROM u x WHERE x.conv_id = u.conv_id AND x.turn = u.turn - 2) AS before,
                     turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM u),
        l AS (SELECT *, CASE WHEN rule = 'last' OR NOT bool_or(after) OVER (PARTITION BY conv_id) THEN turn WHEN rule = 'next' THEN (max(turn) OVER (PARTITION BY conv_id, turn % 2, island) - turn) // 2 WHEN NOT after AND NOT before THEN 0 END AS level FROM b),
        j AS (SELECT l.*, a.call_id IS NOT NULL AS has, a.text AS answer, CASE tool WHEN 0 THEN 'reply' WHEN 1 THEN 'lookup' ELSE 'tally' END AS name,
                     CASE WHEN tool = 0 THEN '{"prompt":' || CAST(to_json(l.text) AS VARCHAR) || ',"turn":' || l.turn || '}' WHEN tool = 1 THEN '{"limit":' || l.turn || ',"query":' || CAST(to_json(l.text) AS VARCHAR) || '}'
                          WHEN l.turn % 2 = 0 THEN '{"counts":[' || l.turn || ',' || (l.turn + 1) || ']}' ELSE '{"counts":[' || l.turn || ',' || CAST(to_json(l.text) AS VARCHAR) || ']}' END AS arguments,
                     CASE WHEN tool = 1 AND l.turn NOT IN (2, 8, 14) THEN '$.limit: not one of the values' WHEN tool = 2 AND l.turn % 2 = 1 THEN '$.counts[1]: not integer' END AS fault,
                     list_sort(CASE WHEN rule <> 'next' AND l.turn >= 2 THEN [l.conv_id || '/' || (l.turn - 2)] ELSE [] END || CASE WHEN rule <> 'last' THEN [l.conv_id || '/' || (l.turn + 2)] ELSE [] END) AS needs
              FROM l LEFT JOIN a ON a.call_id = l.call_id)
        SELECT conv_id, turn, -1 AS "at", 'call' AS kind, call_id, level, CASE WHEN level IS NULL THEN 'cycle' WHEN fault IS NOT NULL THEN 'invalid_arguments' WHEN has THEN 'linked' ELSE 'no_result' END AS status,
               '{"arguments":' || arguments || ',"depends_on":[' || array_to_string(list_transform(needs, lambda x: '"' || x || '"'), ',') || ']' || CASE WHEN fault IS NOT NULL THEN ',"faults":["' || fault || '"]' ELSE '' END
               || ',"id":"' || call_id || '","name":"' || name || '"' || CASE WHEN level IS NOT NULL AND has THEN ',"result":' || CAST(to_json(answer) AS VARCHAR) ELSE '' END || '}' AS json
        FROM j
        UNION ALL
        SELECT a.conv_id, a.turn, -1, 'result', a.call_id, NULL, 'orphan_result', '{"id":"' || a.call_id || '","result":' || CAST(to_json(a.text) AS VARCHAR) || '}'
        FROM a ANTI JOIN u USING (call_id)
    """,
    "op7_recompression": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT r, i, md5(array_to_string(w[i : i + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
        again AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1),
        gone AS (SELECT DISTINCT r, i + k AS p FROM again CROSS JOIN (SELECT unnest(range(0, 35)) AS k)),
        words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)
    """,
    "op13_conversation_viterbi": r"""
        WITH RECURSIVE bits AS (  -- the table of crc32
            SELECT b, b AS c, 0 AS k FROM (SELECT unnest(range(0, 256)) AS b)
            UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
        ),
        crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))) AS letters
            FROM conversations
        ),
        kinds AS (SELECT conv_id, turn, role, text, xor(list_reduce(letters, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
        harmed AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE kind WHEN 0 THEN []::INTEGER[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM kinds
        ),
        ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
        placed AS (
            SELECT c, turn, role, text, left(role, 1) AS r, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open_
            FROM harmed JOIN ids ON harmed.conv_id IS NOT DISTINCT FROM ids.conv_id
        ),
        told AS (
            SELECT *, NOT blank AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
                   lag(r) OVER (PARTITION BY c ORDER BY i) || r AS pair
            FROM placed
        ),
        counts AS (
            SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
                   count(*) FILTER (NOT blank AND NOT again AND open_) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM told GROUP BY c
        ),
        dp AS (  -- by state the least (cost, audit) and what is written: b nothing yet, s, u, a after the system's, user's, assistant's turn
            SELECT c, CAST(0 AS BIGINT) AS i, {'n': CAST(0 AS BIGINT), 'e': '', 'w': ''} AS b, CAST(NULL AS STRUCT(n BIGINT, e VARCHAR, w VARCHAR)) AS s,
                   {'n': CAST(2 AS BIGINT), 'e': 'I', 'w': E'\nuser:'} AS u, {'n': CAST(4 AS BIGINT), 'e': 'II', 'w': E'\nuser:\nassistant:'} AS a
            FROM ids
            UNION ALL
            SELECT c, i, b, s, u, list_min([a, CASE WHEN u IS NOT NULL THEN {'n': u.n + 2, 'e': u.e || 'I', 'w': u.w || E'\nassistant:'} END])
            FROM (
                SELECT c, i, b, s, a, list_min([u, {'n': b.n + 2, 'e': b.e || 'I', 'w': b.w || E'\nuser:'},
                       CASE WHEN s IS NOT NULL THEN {'n': s.n + 2, 'e': s.e || 'I', 'w': s.w || E'\nuser:'} END,
                       CASE WHEN a IS NOT NULL THEN {'n': a.n + 2, 'e': a.e || 'I', 'w': a.w || E'\nuser:'} END]) AS u
                FROM (
                    SELECT dp.c, t.i, {'n': b.n + 3, 'e': b.e || 'D', 'w': b.w} AS b,
                           list_min([CASE WHEN s IS NOT NULL THEN {'n': s.n + 3, 'e': s.e || 'D', 'w': s.w} END,
                                     CASE WHEN NOT gone AND r = 's' THEN {'n': b.n + late, 'e': b.e || 'K', 'w': b.w || line} END]) AS s,
                           list_min([CASE WHEN u IS NOT NULL THEN {'n': u.n + 3, 'e': u.e || 'D', 'w': u.w} END,
                                     CASE WHEN NOT gone THEN {'n': b.n + late + ku, 'e': b.e || eu, 'w': b.w || lu} END,
                                     CASE WHEN NOT gone AND s IS NOT NULL THEN {'n': s.n + late + ku, 'e': s.e || eu, 'w': s.w || lu} END,
                                     CASE WHEN NOT gone AND a IS NOT NULL THEN {'n': a.n + late + ku, 'e': a.e || eu, 'w': a.w || lu} END]) AS u,
                           list_min([CASE WHEN a IS NOT NULL THEN {'n': a.n + 3, 'e': a.e || 'D', 'w': a.w} END,
                                     CASE WHEN NOT gone AND u IS NOT NULL THEN {'n': u.n + late + ka, 'e': u.e || ea, 'w': u.w || la} END]) AS a
                    FROM dp JOIN (
                        SELECT c, i, r, blank OR again AS gone, CASE WHEN open_ THEN 1 ELSE 0 END AS late, E'\n' || role || ':' || text AS line,
                               CASE r WHEN 'u' THEN 0 ELSE 2 END AS ku, CASE r WHEN 'u' THEN 'K' ELSE 'R' END AS eu, E'\n' || CASE r WHEN 'u' THEN role ELSE 'user' END || ':' || text AS lu,
                               CASE r WHEN 'a' THEN 0 ELSE 2 END AS ka, CASE r WHEN 'a' THEN 'K' ELSE 'R' END AS ea, E'\n' || CASE r WHEN 'a' THEN role ELSE 'assistant' END || ':' || text AS la
                        FROM told
                    ) t ON t.c = dp.c AND t.i = dp.i + 1
                )
            )
        ),
        ended AS (SELECT c, list_min([b, a]) AS best FROM dp QUALIFY row_number() OVER (PARTITION BY c ORDER BY i DESC) = 1)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               best.n AS cost, best.e AS audit, sha256(substr(best.w, 2)) AS repaired_sha256
        FROM ids JOIN ended USING (c) LEFT JOIN counts USING (c)
    """,
}
