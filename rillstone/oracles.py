"""The same results as plain SQL on the given tables."""

ORACLES: dict[str, str] = {
    "kafka_parse": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "composite_key": (
        "SELECT o_orderdate AS timestamp, o_custkey, o_orderkey, o_totalprice FROM orders"
    ),
    "nested_key": "SELECT event_id, user_id AS meta_user_id FROM events",
    "missing_and_extra_fields": (
        "SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS props FROM events"
    ),
    "raw_archive": """
        SELECT ts AS timestamp, CAST(event_id AS VARCHAR) AS event_id,
               '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS value_raw
        FROM events""",
    "transform_hook": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "documents_parse": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "pages_parse": "SELECT page_id, url, html FROM pages",
    "embeddings_parse": """
        SELECT vec_id, label, CAST(i AS INTEGER) AS i, CAST(embedding[i] AS DOUBLE) AS x
        FROM (SELECT vec_id, label, embedding,
                     unnest(generate_series(1, len(embedding))) AS i FROM embeddings)""",
    "deadletter_rejects": (
        "SELECT event_id, 'malformed' AS reason FROM events WHERE event_id % 97 = 0"
    ),
    "deadletter_accepted": (
        "SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 97 <> 0"
    ),
    "trailing_text_rejects": """
        SELECT event_id, CASE WHEN event_id % 20 IN (0, 2, 3, 4, 5, 6, 7) THEN 'malformed'
               ELSE 'accepted' END AS outcome FROM events""",
    "reject_redrive": """
        SELECT event_id, CASE WHEN event_id % 97 <> 0 AND event_id % 11 <> 0 THEN user_id END AS user_id,
               CASE WHEN event_id % 97 <> 0 THEN event_type END AS event_type,
               CASE WHEN event_id % 97 = 0 THEN 'malformed' ELSE 'accepted' END AS outcome
        FROM events""",
    "tombstones": """
        SELECT CASE WHEN event_id % 50 = 0 THEN 'null_value' ELSE 'accepted' END AS outcome,
               count(*) AS n FROM events GROUP BY 1""",
    "missing_key_rejects": (
        "SELECT event_id, 'missing_key' AS reason FROM events WHERE event_id % 11 = 0"
    ),
    "cast_rejects": """
        SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN user_id END AS v,
               CASE WHEN event_id % 13 = 0 THEN 'not_castable' ELSE 'accepted' END AS outcome
        FROM events""",
    "nested_target_reorder": "SELECT event_id, user_id AS a, event_id AS b FROM events",
    "nested_target_subset": """
        SELECT event_id, event_type AS b, 2 AS parts, user_id AS a, CAST(NULL AS VARCHAR) AS c
        FROM events""",
    "key_change_refill": """
        SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "catalog_tables": """
        WITH named AS (SELECT unnest(['demo_events', 'demo_events_latest', 'demo_events_src']) AS name)
        SELECT 'before ' || name AS part, event_id, user_id, CAST(NULL AS VARCHAR) AS props
        FROM events, named WHERE event_id % 2 = 0
        UNION ALL
        SELECT 'after ' || name, event_id, user_id, CASE WHEN event_id % 2 = 1 THEN props END
        FROM events, named""",
    "required_fields": (
        "SELECT event_id, 'missing_required' AS reason FROM events WHERE event_id % 11 = 0"
    ),
    "upsert_latest": """
        SELECT user_id, event_id, ts, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "late_arrival_upsert": """
        SELECT event_type, event_id, ts, user_id FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "orders_latest": """
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
        QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "history_current": """
        SELECT user_id, event_id, ts AS timestamp, lead(ts) OVER w AS valid_to,
               CASE WHEN lead(ts) OVER w IS NULL THEN 'Y' ELSE 'N' END AS current
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "lineitem_latest": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, l_shipdate AS timestamp
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_returnflag
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC,
                     l_linenumber DESC) = 1""",
    "lineitem_history": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
               l_shipdate AS timestamp, lead(l_shipdate) OVER w AS valid_to,
               CASE WHEN lead(l_shipdate) OVER w IS NULL THEN 'Y' ELSE 'N' END AS current
        FROM lineitem WINDOW w AS (
            PARTITION BY l_returnflag
            ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber)""",
    "conversation_history": """
        SELECT conv_id, turn, role, text, lead(turn) OVER w AS next_turn,
               CASE WHEN lead(turn) OVER w IS NULL THEN 'Y' ELSE 'N' END AS current
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
    "bucketed_latest": """
        SELECT event_id, ts, user_id, event_type, value, props, ts AS timestamp, 'Y' AS current
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "compacted_log": """
        SELECT event_id, 'log' AS place FROM events
        UNION ALL
        SELECT event_id, 'latest' FROM (
            SELECT event_id FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""",
    "history_incremental": """
        SELECT event_id, ts, user_id, event_type, value, props, ts AS timestamp,
               lead(ts) OVER w AS valid_to,
               CASE WHEN lead(ts) OVER w IS NULL THEN 'Y' ELSE 'N' END AS current
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "observed_fields": """
        WITH e AS (SELECT event_id AS i FROM events WHERE event_id % 97 <> 0),
        f AS (
          SELECT '' AS path, 'unreadable' AS kind, NULL AS declared_type, NULL AS observed_type,
                 (SELECT count(*) FROM events WHERE event_id % 97 = 0) AS messages
          UNION ALL SELECT 'event_id', 'as_declared', 'bigint', 'BIGINT', (SELECT count(*) FROM e)
          UNION ALL SELECT 'user_id', 'as_declared', 'bigint', 'BIGINT', (SELECT count(*) FROM e WHERE i % 5 <> 0)
          UNION ALL SELECT 'user_id', 'other_type', 'bigint', 'STRING', (SELECT count(*) FROM e WHERE i % 5 = 0)
          UNION ALL SELECT 'event_type', 'as_declared', 'string', 'STRING', (SELECT count(*) FROM e WHERE i % 7 <> 0)
          UNION ALL SELECT 'event_type', 'as_declared', 'string', 'VOID', (SELECT count(*) FROM e WHERE i % 7 = 0)
          UNION ALL SELECT 'value', 'unseen', 'double', NULL, 0
          UNION ALL SELECT unnest(['meta', 'meta.more']), 'undeclared', NULL, 'OBJECT', (SELECT count(*) FROM e WHERE i % 3 = 0)
          UNION ALL SELECT 'meta.source', 'undeclared', NULL, 'STRING', (SELECT count(*) FROM e WHERE i % 3 = 0)
          UNION ALL SELECT 'meta.more.a b', 'undeclared', NULL, 'BIGINT', (SELECT count(*) FROM e WHERE i % 3 = 0)
          UNION ALL SELECT 'parts', 'as_declared', 'array<struct<kind:string>>', 'ARRAY', (SELECT count(*) FROM e WHERE i % 4 = 0)
          UNION ALL SELECT 'parts[]', 'as_declared', 'struct<kind:string>', 'OBJECT', (SELECT count(*) FROM e WHERE i % 4 = 0)
          UNION ALL SELECT 'parts[].kind', 'as_declared', 'string', 'BIGINT', (SELECT count(*) FROM e WHERE i % 4 = 0)
          UNION ALL SELECT 'parts[].note', 'undeclared', NULL, 'STRING', (SELECT count(*) FROM e WHERE i % 4 = 0)
          UNION ALL SELECT 'tags', 'as_declared', 'map<string,bigint>', 'OBJECT', (SELECT count(*) FROM e WHERE i % 6 = 0)
          UNION ALL SELECT 'tags{}', 'other_type', 'bigint', 'DECIMAL', (SELECT count(*) FROM e WHERE i % 6 = 0))
        SELECT path, kind, declared_type, observed_type,
               count(*) FILTER (WHERE observed_type <> 'VOID') OVER (PARTITION BY path) AS types,
               messages, messages / (SELECT count(*) FROM events) AS share
        FROM f WHERE messages > 0 OR kind = 'unseen'""",
    "schema_diff": """
        SELECT 'user_id' AS path, 'type_changed' AS kind, 'string' AS old_type,
               'bigint' AS new_type, count(user_id) AS messages FROM events
        UNION ALL SELECT 'event_type', 'removed', 'string', NULL, count(event_type) FROM events
        UNION ALL SELECT 'meta.note', 'added', NULL, 'string',
                         count(CASE WHEN event_id % 3 = 0 THEN props END) FROM events
        UNION ALL SELECT 'parts.element.kind', 'added', NULL, 'string',
                         count(CASE WHEN event_id % 5 = 0 THEN event_type END) FROM events
        UNION ALL SELECT 'value', 'added', NULL, 'double', 0""",
    "schema_evolve_add_column": """
        SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS props
        FROM events""",
    "target_schema_columns": """
        SELECT event_id, user_id, event_type, ts AS timestamp,
               CASE WHEN lead(ts) OVER w IS NULL THEN 'Y' ELSE 'N' END AS current
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "ref_type_expansion": "SELECT event_id, user_id AS user_ref_id FROM events",
    "avro_declared_schema": "SELECT event_id, user_id, event_type, value FROM events",
    "avro_resolution": """
        SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE event_type END AS event_type,
               CASE WHEN event_id % 3 = 0 THEN floor(value) ELSE value END AS value,
               CASE WHEN event_id % 3 = 1 THEN 'none' ELSE event_type END AS kind,
               CASE WHEN event_id % 3 = 2 THEN 1 ELSE 7 END AS n, 1 AS parts
        FROM events""",
    "replay_idempotent": """
        SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum
        FROM events GROUP BY event_type""",
    "write_hook": "SELECT event_id, user_id, value FROM events WHERE event_type = 'error'",
    "write_hook_run": """
        SELECT event_id, user_id, value, event_id % 2 AS batch_id
        FROM events WHERE event_type = 'error'""",
    "offset_gaps": """
        WITH sent AS (
          SELECT CAST(event_id % 4 AS INTEGER) AS p, event_id // 4 AS o FROM events
          WHERE event_id % 4 = 3 OR NOT ((event_id // 4) % 1000 BETWEEN 100 AND 119 OR (event_id // 4) % 1000 = 777)),
        lost AS (SELECT p, o, lag(o) OVER (PARTITION BY p ORDER BY o) AS b FROM sent),
        twice AS (
          SELECT p, o, CASE WHEN o % 500 = 42 THEN 2 ELSE 1 END AS n FROM sent
          WHERE p < 2 AND o % 500 BETWEEN 40 AND 45),
        runs AS (SELECT *, o - row_number() OVER (PARTITION BY p ORDER BY o) AS g FROM twice)
        SELECT p AS record_partition, 'lost' AS kind, b + 1 AS first_offset, o - 1 AS last_offset,
               CAST(0 AS BIGINT) AS rows FROM lost WHERE o > b + 1
        UNION ALL
        SELECT p, 'repeated', min(o), max(o), CAST(sum(n) AS BIGINT) FROM runs GROUP BY p, g""",
    "checkpoint_reset": """
        SELECT event_id, unnest(['archive', 'log']) AS place FROM events""",
    "stream_drain": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_restart": (
        "SELECT event_id, ts, user_id, event_type, value, props, ts AS timestamp FROM events"
    ),
    "timeout_resume": (
        "SELECT event_id, ts, user_id, event_type, value, props, ts AS timestamp FROM events"
    ),
    "stream_latest": """
        SELECT user_id, event_id, ts, 'Y' AS current FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_rejects": """
        SELECT ts AS timestamp,
               '{"event_id":' || event_id || ',"user_id":' || user_id ||
               ',"event_type":"' || event_type || '"' AS value_raw,
               'malformed' AS reason
        FROM events WHERE event_id % 97 = 0""",
    "stream_raw_archive": """
        SELECT o_orderdate AS timestamp, CAST(o_custkey AS VARCHAR) AS o_custkey,
               CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice FROM orders""",
    "rate_limited_batches": """
        SELECT n, count(*) AS batches
        FROM (SELECT count(*) AS n FROM events GROUP BY event_id % 4) GROUP BY n""",
    "progress_many_batches": """
        SELECT n, count(*) AS batches
        FROM (SELECT count(*) AS n FROM events GROUP BY event_id % 104) GROUP BY n""",
    "multi_topic_counts": """
        SELECT 'events' AS topic, count(*) AS n FROM events
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'customer', count(*) FROM customer""",
    "topic_pattern_counts": """
        WITH t AS (
          SELECT 'events' AS topic, true AS good, 'accepted' AS outcome FROM events
          UNION ALL SELECT 'orders', true, 'accepted' FROM orders
          UNION ALL SELECT 'customer', c_custkey % 13 <> 0,
                           CASE WHEN c_custkey % 13 = 0 THEN 'malformed' ELSE 'accepted' END FROM customer
          UNION ALL SELECT 'supplier', NULL, 'undeclared_topic' FROM supplier)
        SELECT topic, CASE WHEN good THEN 'formatted' ELSE outcome END AS place, count(*) AS n
        FROM t WHERE good IS NOT NULL GROUP BY 1, 2
        UNION ALL SELECT topic, 'archived ' || outcome, count(*) FROM t GROUP BY 1, 2""",
}
