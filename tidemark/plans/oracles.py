"""SQL twins of the queries, for DuckDB over the same tables."""

from __future__ import annotations

from tidemark import fixed
from tidemark.plans.queries import BUCKET, DIMS, SEGMENTS

_SEGMENTS = ", ".join(f"'{s}'" for s in SEGMENTS)


def _chunks(rows: str, ids: str, size: int, overlap: int) -> str:
    """CTEs ending in ``chunk(ids, chunk_index, chunk)``."""
    return f"""
    cut AS (
        SELECT {ids}, i, substring(text, CAST(i AS BIGINT) + 1, {size}) AS chunk
        FROM (SELECT {ids}, text, unnest(range(0, length(text), {max(1, size - overlap)})) AS i
              FROM {rows})
    ),
    chunk AS (
        SELECT {ids}, row_number() OVER (PARTITION BY {ids} ORDER BY i) - 1 AS chunk_index, chunk
        FROM cut WHERE regexp_matches(chunk, '[^\\s\\p{{Z}}\\x{{85}}\\x1c-\\x1f]')
    )"""


def _weights(rows: str, key: str, text: str, dims: int) -> str:
    """CTEs ending in ``weight(key, dim, w)``, the non-zero components."""
    return f"""
    token AS (
        SELECT {key}, unnest(string_split_regex(lower({text}), '[ \\t\\r\\n]+')) AS t FROM {rows}
    ),
    counted AS (
        SELECT {key}, CAST(concat('0x', substring(sha1(t), 1, 8)) AS BIGINT) % {dims} AS dim,
               CAST(count(*) AS DOUBLE) AS n
        FROM token WHERE t <> '' GROUP BY ALL
    ),
    weight AS (
        SELECT {key}, dim, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS w
        FROM counted
    )"""


_DOC_CHUNKS = _chunks("documents", "doc_id", fixed.CHUNK_SIZE, fixed.CHUNK_OVERLAP)
_KEYED = f"""{_DOC_CHUNKS},
    keyed AS (
        SELECT sha1(concat('doc/', doc_id, '#', chunk_index)) AS key,
               concat('doc/', doc_id) AS source_key, chunk_index, chunk
        FROM chunk
    )"""

_REPLACED = """
    SELECT o_custkey AS entry_id, o_totalprice AS amount, o_orderstatus AS kind FROM orders
    WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)
    UNION ALL SELECT user_id, value, event_type FROM events
"""

def _nearest(score: str, k: int = 5) -> str:
    return f"""
    WITH pair AS (
        SELECT q.vec_id AS query_id, c.vec_id AS key, round({score}, 9) AS score
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) q,
             (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) c
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id
            ORDER BY score DESC NULLS LAST, key) AS rank FROM pair
    )
    SELECT query_id, key, rank, CASE WHEN score = 0 THEN 0.0::DOUBLE ELSE round(score, 6) END AS score
    FROM ranked WHERE rank <= {k}
    """


_COSINE = _nearest("list_cosine_similarity(q.v, c.v)")

_PART_SCORE = """
    SELECT p_partkey, p_brand, floor((
          greatest(0.0::DOUBLE, 30.0::DOUBLE - greatest(0.0::DOUBLE,
              (CAST(p_size AS DOUBLE) / 2 + 5) - 10.0::DOUBLE))
        + greatest(0.0::DOUBLE, 25.0::DOUBLE - (p_retailprice - 900) * 6 / 20.0::DOUBLE)
        + least(25.0::DOUBLE, p_size * 0.7::DOUBLE)
        + least(20.0::DOUBLE, CAST(length(p_type) AS DOUBLE))) * 100 + 0.5) / 100 AS score
    FROM part
"""
_PART_RANK = f"""
    SELECT p_brand, p_partkey, score,
           row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS rank
    FROM ({_PART_SCORE})
"""

_OFFERS = """
    offer AS (
        SELECT c_custkey, 0 AS pos, concat(c_name, '/a') AS name,
            greatest(0.0::DOUBLE, 30.0::DOUBLE - greatest(0.0::DOUBLE, (c_nationkey + 5)::DOUBLE - 10.0::DOUBLE)) AS apr,
            greatest(0.0::DOUBLE, 25.0::DOUBLE - (c_nationkey * 30)::DOUBLE / 20.0::DOUBLE) AS fee,
            least(25.0::DOUBLE, c_nationkey::DOUBLE) AS rewards,
            least(20.0::DOUBLE, (c_nationkey - 5)::DOUBLE) AS bonus
        FROM customer WHERE c_mktsegment <> 'MACHINERY'
        UNION ALL
        SELECT c_custkey, 1, concat(c_name, '/b'),
            greatest(0.0::DOUBLE, 30.0::DOUBLE - greatest(0.0::DOUBLE, c_acctbal / 300 - 10.0::DOUBLE)),
            greatest(0.0::DOUBLE, 25.0::DOUBLE - (c_nationkey * 10)::DOUBLE / 20.0::DOUBLE),
            25.0::DOUBLE, 0.0::DOUBLE
        FROM customer WHERE c_mktsegment <> 'MACHINERY'
        UNION ALL
        SELECT c_custkey, 2, concat(c_name, '/c'), 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 12.0::DOUBLE
        FROM customer WHERE c_mktsegment <> 'MACHINERY'
    ), scored AS (
        SELECT c_custkey, CAST(pos AS BIGINT) AS pos, name,
               floor((apr + fee + rewards + bonus) * 100 + 0.5) / 100 AS score FROM offer
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, pos) AS rank
        FROM scored
    )"""

_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
"""

_ENVELOPE = f"""
    WITH {_OFFERS}
    SELECT c_custkey, '{fixed.RANKING_SOURCE}' AS source, CAST(3 AS BIGINT) AS total,
           name, score, rank FROM ranked
    UNION ALL
    SELECT c_custkey, '{fixed.RANKING_SOURCE}', 0, NULL, NULL, NULL
    FROM customer WHERE c_mktsegment = 'MACHINERY'
"""

_CARDS = """
    card AS (
        SELECT CASE WHEN c_custkey % 50 <> 0 THEN concat('C', c_custkey) END AS card_id,
               c_name AS cardholder_name, c_nationkey * 100.0::DOUBLE AS credit_limit,
               c_acctbal AS current_balance,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'LOST' WHEN 'BUILDING' THEN 'BLOCKED'
                    ELSE 'ACTIVE' END AS card_status,
               CASE WHEN c_nationkey <> 3 THEN 'EUR' END AS currency
        FROM customer
    )
"""

_FOUND = f"""
    WITH {_KEYED}, question AS (
        SELECT concat_ws('-', conv_id, turn) AS question_id, text AS question
        FROM conversations WHERE role = 'user'
    ), said AS (
        SELECT question_id AS key, question AS chunk FROM question
        UNION ALL SELECT key, chunk FROM keyed
    ), {_weights("said", "key", "chunk", DIMS)}, dense AS (
        SELECT g.key, list(CAST(coalesce(w, 0) AS DOUBLE) ORDER BY d) AS v
        FROM (SELECT key, d FROM (SELECT DISTINCT key FROM said), range({DIMS}) r(d)) g
        LEFT JOIN weight ON weight.key = g.key AND weight.dim = g.d GROUP BY g.key
    ), pair AS (
        SELECT question_id, c.key,
               CASE WHEN list_inner_product(q.v, q.v) > 0 AND list_inner_product(c.v, c.v) > 0
                    THEN round(list_cosine_similarity(q.v, c.v), 9) END AS score
        FROM question JOIN dense q ON q.key = question_id,
             (SELECT dense.* FROM dense JOIN keyed USING (key)) c
    ), hit AS (
        SELECT * FROM pair QUALIFY row_number() OVER (
            PARTITION BY question_id ORDER BY score DESC NULLS LAST, key) <= {fixed.TOP_K}
    ), context AS (
        SELECT question_id, string_agg(concat('[Source: ', source_key, ' chunk ', chunk_index,
                   ']', chr(10), chunk), concat(chr(10), chr(10), '---', chr(10), chr(10))
                   ORDER BY score DESC NULLS LAST, key) AS context
        FROM hit JOIN keyed USING (key) GROUP BY question_id
    ), asked AS (
        SELECT question_id, coalesce(context, '') AS context, concat('Context:', chr(10),
                   coalesce(context, ''), chr(10), chr(10), 'Question: ', question) AS prompt
        FROM question LEFT JOIN context USING (question_id)
    )"""

_ITEM_CHUNKS = f"""
    WITH item AS (SELECT item_id, concat(text, chr(10)) AS text FROM benchmark),
    {_chunks("item", "item_id", fixed.CHUNK_SIZE, fixed.CHUNK_OVERLAP)}
    SELECT item_id, chunk_index, chunk, true AS keyed FROM chunk"""

ORACLES = {
    "json_typed_read": _ORDERS,
    "json_to_table": _ORDERS,
    "json_rejects": """
        SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'null key'
                    ELSE 'good' END AS reason,
               CASE WHEN event_type NOT IN ('error', 'signup') THEN event_id END AS event_id,
               CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
               CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
               CASE WHEN event_type = 'error' THEN concat('{"event_id":', event_id,
                   ',"event_type":"', event_type, '","user_id":', user_id) END AS text
        FROM events""",
    "json_whole_files": """
        SELECT s_suppkey AS account_id, s_name AS holder, s_nationkey AS nation,
               s_acctbal AS balance, 'good' AS reason FROM supplier WHERE s_nationkey % 4 <> 0
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, 'malformed' FROM (
            SELECT DISTINCT s_nationkey FROM supplier WHERE s_nationkey % 4 = 0)""",
    "json_mixed_file": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
               CASE WHEN o_orderkey % 7 <> 0 THEN 'good' ELSE 'malformed' END AS reason
        FROM orders""",
    "json_compressed": _ORDERS,
    "card_load": f"""
        WITH {_CARDS}
        SELECT card_id, cardholder_name, credit_limit, current_balance, card_status, currency,
               CASE WHEN card_id IS NULL THEN 'null key' ELSE 'good' END AS reason FROM card""",
    "card_checks": f"""
        WITH {_CARDS}, c AS (SELECT * FROM card WHERE card_id IS NOT NULL), n AS (
            SELECT count(*) FILTER (card_status NOT IN ('ACTIVE', 'INACTIVE', 'BLOCKED', 'EXPIRED')) AS a,
                   count(*) FILTER (credit_limit <= 0) AS b,
                   count(*) FILTER (current_balance < 0) AS c,
                   count(*) FILTER (currency IS NULL) AS d,
                   count(*) - count(DISTINCT card_id) AS e,
                   greatest(100000 - count(*), 0) AS f FROM c
        )
        SELECT 'card_status' AS "check", a AS violations FROM n
        UNION ALL SELECT 'credit_limit', b FROM n
        UNION ALL SELECT 'current_balance', c FROM n
        UNION ALL SELECT 'currency', d FROM n
        UNION ALL SELECT 'unique_key', e FROM n
        UNION ALL SELECT 'min_rows', f FROM n""",
    "record_payloads": """
        SELECT s_suppkey, s_acctbal >= 0 AS readable,
               CASE WHEN s_acctbal >= 0 THEN s_name END AS name,
               CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS nation,
               CAST(NULL AS DOUBLE) AS rating
        FROM supplier
        UNION ALL
        SELECT s_suppkey, true, NULL, 7, NULL FROM supplier WHERE s_acctbal BETWEEN 0 AND 5000""",
    "document_files": f"""
        SELECT item_id, '{BUCKET}' AS source_bucket, sha1(concat(text, chr(10))) AS digest,
               length(text) + 1 AS n_chars FROM benchmark""",
    "table_create_read": "SELECT * FROM customer",
    "upsert_merge": """
        SELECT event_id AS entry_id, value AS amount, event_type AS kind FROM events
        WHERE event_id NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders""",
    "upsert_last_wins": """
        SELECT c_custkey AS entry_id, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS DOUBLE) AS amount
        FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
        UNION ALL
        SELECT user_id, CASE WHEN event_type <> 'error' THEN event_id END,
               CASE WHEN event_type <> 'error' THEN value END FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY
            CASE WHEN event_type <> 'error' THEN event_id END DESC NULLS LAST) = 1""",
    "upsert_replace_keys": _REPLACED,
    "append_unkeyed": """
        SELECT o_custkey AS entry_id, o_totalprice AS amount, o_orderstatus AS kind FROM orders
        UNION ALL SELECT NULL, p_retailprice, p_type FROM part""",
    "append_by_name": """
        SELECT s_suppkey AS account_id, s_name AS holder, s_nationkey AS nation,
               s_acctbal AS balance FROM supplier
        UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""",
    "batch_keys": "SELECT DISTINCT user_id AS entry_id FROM events WHERE user_id IS NOT NULL",
    "upsert_table": """
        SELECT s_suppkey AS account_id, s_name AS holder, s_nationkey AS nation,
               s_acctbal AS balance
        FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""",
    "replace_table": _REPLACED,
    "quality_report": f"""
        WITH c AS (
            SELECT count(*) FILTER (c_mktsegment NOT IN ({_SEGMENTS})) AS a,
                   count(*) FILTER (c_acctbal < 0) AS b,
                   count(*) FILTER (c_nationkey IS NULL) AS c,
                   count(*) - count(DISTINCT c_custkey)
                       - max(CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END) AS d,
                   greatest(100000 - count(*), 0) AS e FROM customer
        ), o AS (
            SELECT count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS a,
                   count(*) FILTER (o_totalprice <= 0) AS b,
                   count(*) - count(DISTINCT o_custkey)
                       - max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS d,
                   greatest(1 - count(*), 0) AS e FROM orders
        )
        SELECT 'customer' AS source, 'segment' AS "check", CAST(a AS BIGINT) AS violations FROM c
        UNION ALL SELECT 'customer', 'balance', b FROM c
        UNION ALL SELECT 'customer', 'nation', c FROM c
        UNION ALL SELECT 'customer', 'unique_key', d FROM c
        UNION ALL SELECT 'customer', 'min_rows', e FROM c
        UNION ALL SELECT 'orders', 'status', a FROM o
        UNION ALL SELECT 'orders', 'price', b FROM o
        UNION ALL SELECT 'orders', 'unique_key', d FROM o
        UNION ALL SELECT 'orders', 'min_rows', e FROM o""",
    "quality_by_load": """
        SELECT 'status' AS "check", count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS violations FROM orders
        UNION ALL SELECT 'price', count(*) FILTER (o_totalprice > 300000) FROM orders
        UNION ALL SELECT 'min_rows', greatest(10000000 - count(*), 0) FROM orders
        UNION ALL SELECT 'distinct o_custkey', 0 UNION ALL SELECT 'distinct o_orderstatus', 0""",
    "row_count": "SELECT count(*) AS n FROM lineitem",
    "distinct_values": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "distinct_count": "SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey FROM lineitem)",
    "filtered_rows": f"""
        SELECT c_custkey, c_mktsegment FROM customer
        WHERE c_acctbal < 0 AND c_nationkey IS NOT NULL AND c_mktsegment NOT IN ({_SEGMENTS})""",
    "top_by_value": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100""",
    "chunk_documents": f"WITH {_DOC_CHUNKS} SELECT doc_id, chunk_index, chunk FROM chunk",
    "chunk_wide_overlap": f"""
        WITH {_chunks("conversations", "conv_id, turn", 80, 60)}
        SELECT conv_id, turn, chunk_index, chunk FROM chunk""",
    "chunk_keys": f"""
        WITH {_KEYED}
        SELECT key, '{BUCKET}' AS source_bucket, source_key, chunk_index,
               length(chunk) AS n_chars FROM keyed""",
    "embed_hash": f"""
        WITH {_weights("documents", "doc_id", "text", DIMS)}
        SELECT doc_id, dim, round(CAST(w AS DOUBLE), 6) AS weight FROM weight""",
    "embed_model": """
        SELECT doc_id, length(text) AS chars,
               length(text) - length(replace(text, ' ', '')) AS spaces,
               length(text) - length(replace(text, chr(10), '')) AS lines FROM documents""",
    "ingest_documents": f"""
        WITH {_KEYED}, {_weights("keyed", "key", "chunk", DIMS)}
        SELECT key, source_key, chunk_index, sha1(chunk) AS digest,
               (SELECT count(*) FROM weight WHERE weight.key = keyed.key) AS n_dims
        FROM keyed""",
    "ingest_prefix": _ITEM_CHUNKS,
    "ingest_stream": _ITEM_CHUNKS,
    "ingest_rejects": f"""
        WITH {_chunks("conversations", "conv_id, turn", 200, 20)}, doc AS (
            SELECT concat_ws('/', conv_id, turn) AS source_key, count(*) AS n,
                   CAST(sum(length(chunk)) AS BIGINT) AS chars,
                   bool_or(contains(chunk, 'ç')) AS bad
            FROM chunk GROUP BY conv_id, turn
        )
        SELECT source_key, CASE WHEN NOT bad THEN n END AS n_chunks,
               CASE WHEN NOT bad THEN chars END AS n_chars, bad AS rejected,
               CASE WHEN bad THEN 'ValueError: unknown letter' END AS reason FROM doc""",
    "replaced_documents": f"""
        WITH now AS (
            SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '  ' WHEN 1 THEN substring(text, 1, 70)
                   ELSE text END AS text FROM conversations
        ), {_chunks("now", "conv_id, turn", 60, 10)}
        SELECT concat_ws('/', conv_id, turn) AS source_key, chunk_index, chunk FROM chunk""",
    "ingest_changes": f"""
        WITH was AS (
            SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN ' ' ELSE text END AS text FROM conversations
        ), now AS (
            SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN substring(text, 1, 70) ELSE text END AS text
            FROM was WHERE turn % 4 > 0
        ), {_chunks("now", "conv_id, turn", 60, 10)}
        SELECT concat_ws('/', conv_id, turn) AS source_key, chunk_index, chunk FROM chunk""",
    "vector_upsert": f"""
        WITH {_weights("documents", "doc_id", "text", DIMS)}, base AS (
            SELECT vec_id, unnest(embedding) AS w, unnest(range(0, len(embedding))) AS dim
            FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)
        )
        SELECT vec_id AS key, 'embeddings' AS source, dim, round(CAST(w AS DOUBLE), 6) AS weight
        FROM base WHERE w <> 0
        UNION ALL
        SELECT doc_id, 'documents', dim, round(CAST(w AS DOUBLE), 6) FROM weight""",
    "knn_exact": """
        WITH part AS (
            SELECT unnest(range(0, len(embedding))) AS dim, unnest(embedding) AS x FROM embeddings
        ), mean AS (
            SELECT list(m ORDER BY dim) AS v
            FROM (SELECT dim, avg(CAST(x AS DOUBLE)) AS m FROM part GROUP BY dim)
        ), pair AS (
            SELECT vec_id AS key,
                   round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), v), 9) AS score
            FROM embeddings, mean
        )
        SELECT key, round(score, 6) AS score FROM pair ORDER BY pair.score DESC, key LIMIT 10""",
    "knn_batch": _COSINE,
    "knn_l2": _nearest("-list_distance(q.v, c.v)"),
    "knn_dot": _nearest("list_inner_product(q.v, c.v)"),
    "knn_blocks": _COSINE,
    "knn_cells": _COSINE,
    "knn_codes": f"""
        SELECT count(*) FILTER (vec_id % 50 = 0) AS n_queries,
               count(*) FILTER (vec_id % 50 = 0) * least({fixed.TOP_K}, count(*)) AS n_hits,
               true AS recall_reached, true AS scores_exact
        FROM embeddings WHERE embedding IS NOT NULL""",
    "knn_cells_dot": _nearest("list_inner_product(q.v, c.v)"),
    "prompt_build": f"{_FOUND} SELECT question_id, prompt FROM asked",
    "answer_questions": f"""{_FOUND}
        SELECT question_id, concat(CASE WHEN context = '' THEN 'nothing found'
                   ELSE split_part(context, chr(10), 1) END, ' in ', length(context)) AS answer
        FROM asked""",
    "query_chunks": f"""
        WITH {_KEYED}, {_weights("keyed", "key", "chunk", DIMS)}, scored AS (
            SELECT key, round(sum(CAST(w AS DOUBLE)) / (sqrt(sum(CAST(w AS DOUBLE) * w))
                   * sqrt({DIMS})), 9) AS score FROM weight GROUP BY key
        )
        SELECT key, round(score, 6) AS score, source_key, chunk_index
        FROM scored JOIN keyed USING (key) ORDER BY scored.score DESC, key LIMIT 20""",
    "request_bodies": f"""{_FOUND}
        SELECT question_id, '{fixed.PROMPT_VERSION}' AS version,
               CAST({fixed.PROMPT_MAX_TOKENS} AS BIGINT) AS max_tokens,
               '{fixed.PROMPT_SYSTEM.replace("'", "''")}' AS system, 'user' AS role,
               prompt AS content FROM asked""",
    "chat_bodies": f"""
        SELECT concat_ws('-', conv_id, turn) AS question_id, 'model-1' AS model,
               '{fixed.PROMPT_SYSTEM.replace("'", "''")}' AS system, 'user' AS role,
               text AS content
        FROM conversations WHERE role = 'user'""",
    "answer_decode": """
        SELECT conv_id, turn, CASE WHEN role <> 'system' THEN text END AS answer,
               role = 'system' AS rejected FROM conversations""",
    "vector_decode": """
        SELECT vec_id, unnest(range(0, len(embedding))) AS dim,
               round(CAST(unnest(embedding) AS DOUBLE), 6) AS x FROM embeddings""",
    "notification_refs": f"""
        SELECT concat('m-', page_id) AS message_id, NOT contains(url, 'spam') AS readable,
               CASE WHEN NOT contains(url, 'spam') AND NOT contains(url, '//blog.')
                    THEN '{BUCKET}' END AS bucket,
               CASE WHEN NOT contains(url, 'spam') AND NOT contains(url, '//blog.')
                    THEN concat('{fixed.DATA_PREFIX}', url, ' v1') END AS key
        FROM pages""",
    "notification_upsert": """
        WITH sent AS (SELECT * FROM supplier WHERE s_nationkey <> 0)
        SELECT c_custkey AS account_id, c_name AS holder, c_nationkey AS nation,
               c_acctbal AS balance
        FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM sent)
        UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM sent""",
    "notification_outcomes": """
        WITH part AS (SELECT DISTINCT s_nationkey, s_suppkey % 2 AS half FROM supplier), said AS (
            SELECT CASE WHEN s_nationkey <> 0 THEN concat('s-', s_nationkey, '-', half) END AS id,
                   CASE WHEN s_nationkey <> 0 THEN '' ELSE 'no message id' END AS reason FROM part
            UNION ALL SELECT concat('n-', n_nationkey), 'missing or empty file' FROM nation
        ), outcome AS (SELECT * FROM said UNION ALL SELECT NULL, 'bad event' FROM said)
        SELECT id AS message_id, CASE reason WHEN '' THEN 'ok' ELSE 'failed' END AS status, reason,
               count(*) AS n FROM outcome GROUP BY ALL""",
    "metadata_variant": """
        SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 3 END AS BIGINT) AS n_fields,
               CASE WHEN event_type <> 'error' THEN event_type END AS type,
               CASE WHEN event_type <> 'error' THEN user_id END AS user,
               CASE WHEN event_type <> 'error' THEN replace(props, ' ', '') END AS nested
        FROM events""",
    "metadata_documents": """
        SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 3 END AS BIGINT) AS n_fields,
               CASE WHEN event_type <> 'error' THEN event_type END AS type,
               CASE WHEN event_type <> 'error' THEN concat('[', user_id, ',"x"]') END AS at,
               CASE WHEN event_type <> 'error' THEN value END AS value
        FROM events""",
    "offer_score": f"SELECT p_partkey, score FROM ({_PART_SCORE})",
    "offer_rank": _PART_RANK,
    "offer_rank_ranges": _PART_RANK,
    "offer_payload": f"WITH {_OFFERS} SELECT c_custkey, rank, pos, score, name FROM ranked",
    "rank_envelope": _ENVELOPE,
    "saved_rankings": _ENVELOPE,
    "brand_envelopes": f"""
        SELECT p_brand, '{fixed.RANKING_SOURCE}' AS source, total, p_name AS name, score, rank
        FROM ({_PART_RANK}) JOIN part USING (p_brand, p_partkey)
        JOIN (SELECT p_brand, count(*) AS total FROM part GROUP BY p_brand) USING (p_brand)
        WHERE rank <= 100""",
    "ranked_sink": f"""
        WITH {_OFFERS}, cut AS (
            SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE')
        SELECT '{fixed.RANKING_SOURCE}' AS source, CAST(3 AS BIGINT) AS total, name, score, rank,
               CAST(NULL AS BIGINT) AS rejected
        FROM ranked WHERE c_custkey NOT IN (SELECT c_custkey FROM cut)
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, c_custkey FROM cut""",
    "tool_calls": f"""
        SELECT conv_id, turn, 'tool_use' AS stop_reason,
               concat_ws('-', 'call', conv_id, turn) AS id, '{fixed.SAVE_CALL}' AS name,
               text AS payload
        FROM conversations WHERE role <> 'system'""",
    "response_stops": """
        SELECT conv_id, turn,
               CASE WHEN role = 'system' THEN 'end_turn' ELSE 'tool_use' END AS stop_reason,
               CAST(CASE WHEN role = 'system' THEN 0 ELSE 1 END AS BIGINT) AS n_calls
        FROM conversations""",
}
