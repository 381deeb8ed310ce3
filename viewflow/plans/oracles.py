"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

MILLIS = "(epoch_us(ts) // 1000)"
FLOOR = "CAST(floor(value) AS BIGINT)"
AS_OF = "1706659200000"
DAY = 86_400_000

SPANS = f"""
SELECT CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS span_id,
       {MILLIS} AS start_time_millis, {MILLIS} + {FLOOR} AS end_time_millis, event_type AS span_kind
FROM events
"""

# The span view's rows after filter, derived column, split, defaults and lengths.
TABLE_ROWS = f"""
SELECT 'tenant-' || (user_id % 10) AS tenant_id, CAST(event_id AS VARCHAR) AS span_id,
       substring(CASE WHEN event_type = 'click' THEN 'null' ELSE event_type END, 1, 4) AS span_kind,
       {MILLIS} AS start_time_millis, {MILLIS} + {FLOOR} AS end_time_millis,
       array_to_string(json_keys(props), ',') AS attributes__KEYS,
       json_extract_string(props, '$.k') AS attributes__VALUES,
       {FLOOR} AS time_taken_millis, {MILLIS} // 3600000 * 3600000 AS bucket_start_time_millis
FROM events WHERE event_type <> 'error'
"""


def java_hash(text: str, modulus: int) -> str:
    """Java's String.hashCode, modulo; for characters of one UTF-16 unit."""
    unsigned = (
        "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(%s, ''), "
        "lambda c: ascii(c)::BIGINT)), lambda a, c: (a * 31 + c) %% 4294967296)" % text
    )
    signed = f"(CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END)"
    return f"((({signed} % {modulus}) + {modulus}) % {modulus})"


PLACED_ROWS = f"""
SELECT *, start_time_millis // 86400000 * 86400000 AS bucket_start,
       {java_hash('tenant_id', 4)} AS part_tenant_id
FROM ({TABLE_ROWS})
"""

TIMED = f"SELECT event_id, {MILLIS} AS start_time_millis FROM events"
BOUNDARY = f"(({AS_OF} - 43200000) // 21600000 * 21600000)"

ENRICHED = """
SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderkey, c_name, c_mktsegment, n_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
"""

CUBE_INPUT = f"(SELECT event_id, user_id % 5 AS shard, event_type, {FLOOR} AS total, event_id % 7 / 2.0 AS digit FROM events)"
LINE_INPUT = """(SELECT l_orderkey, l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber,
CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)"""

EVENT_CUBE = """
SELECT shard, event_type, GROUPING(shard)::INT AS shard__starred, GROUPING(event_type)::INT AS event_type__starred,
       count(*) AS COUNT__event_id, sum(total)::BIGINT AS SUM__total
FROM {source} GROUP BY {groups}
"""

ROLLUP = f"""
SELECT user_id, event_type, {MILLIS} // 3600000 * 3600000 AS hour,
       sum({FLOOR})::BIGINT AS total, count(*) AS n
FROM events GROUP BY 1, 2, 3
"""

EPOCHS = ", ".join(
    f"epoch_us(o_orderdate) // {size} AS {unit}"
    for unit, size in {
        "microseconds": 1,
        "milliseconds": 1_000,
        "seconds": 1_000_000,
        "minutes": 60_000_000,
        "hours": 3_600_000_000,
        "days": 86_400_000_000,
    }.items()
)

ORACLES: dict[str, str] = {
    "span_view": SPANS,
    "span_view_stamped": f"SELECT key, span_id, true AS stamped FROM ({SPANS})",
    "merge_topics": """
        SELECT event_id AS id, event_type AS kind, user_id AS maker FROM events
        UNION ALL SELECT o_orderkey, o_orderstatus, o_custkey FROM orders
        UNION ALL SELECT event_id, event_type, user_id FROM events""",
    "flat_map_view": """
        SELECT CAST(doc_id AS VARCHAR) AS key, unnest(range(1, len(source) + 1)) AS pos,
               unnest(string_split(source, '')) AS letter FROM documents""",
    "flat_map_zero_to_two": """
        SELECT CAST(user_id AS VARCHAR) AS key, event_id, unnest(range(1, user_id % 3 + 1)) AS copy FROM events""",
    "row_function_view": """
        SELECT key, line_no, length(line) AS n_chars FROM (
          SELECT CAST(doc_id AS VARCHAR) AS key, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no,
                 unnest(string_split(text, chr(10))) AS line
          FROM documents WHERE text <> '')""",
    "row_drop_view": """
        SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type AS kind FROM events WHERE value >= 250""",
    "schema_conform": "SELECT event_type, value, event_id, CAST(NULL AS VARCHAR) AS region FROM events",
    "enrich_orders": ENRICHED,
    "enrich_orders_skewed": ENRICHED,
    "decode_json": f"""
        SELECT CAST(user_id AS VARCHAR) AS key, event_id, user_id, event_type, {MILLIS} AS millis FROM events""",
    "encode_json": f"""
        SELECT key, '{{"span_id":"' || span_id || '","start_time_millis":' || start_time_millis
               || ',"end_time_millis":' || end_time_millis || ',"span_kind":"' || span_kind || '"}}' AS value
        FROM ({SPANS})""",
    "output_partitioner": f"""
        SELECT key, span_id, (start_time_millis // 3600000) % 4 AS partition FROM ({SPANS})""",
    "field_partitioner": """
        SELECT event_type, user_id, 1::BIGINT AS partitions, true AS in_range, 0::BIGINT AS elsewhere, count(*) AS n
        FROM events GROUP BY 1, 2""",
    "split_props_map": """
        SELECT event_id, array_to_string(json_keys(props), ',') AS keys,
               json_extract_string(props, '$.k') AS values FROM events""",
    "split_built_map": """
        SELECT doc_id, 'a,lang,source' AS keys,
               'z,' || lang || ',' || CASE WHEN lang <> 'en' THEN source ELSE '-' END AS values
        FROM documents""",
    "null_defaults": """
        SELECT event_id, CASE WHEN event_type = 'click' THEN 'null' ELSE event_type END AS kind,
               CASE WHEN user_id % 7 = 0 THEN -1 ELSE user_id % 7 END AS shard,
               CASE WHEN event_type = 'click' THEN 'none' ELSE event_type || ',' || event_type END AS tags
        FROM events""",
    "null_defaults_truncate": """
        SELECT event_id, substring(CASE WHEN event_type = 'click' THEN 'null' ELSE event_type END, 1, 3) AS kind
        FROM events""",
    "truncate_text": """
        SELECT doc_id, substring(text, 1, 12) AS head,
               array_to_string(list_transform(string_split(text, ' '), lambda w: substring(w, 1, 3)), ' ') AS words
        FROM documents""",
    "role_projection": f"""
        SELECT 'tenant_id,span_id,span_kind,start_time_millis,end_time_millis,attributes__KEYS,attributes__VALUES,'
               || 'time_taken_millis' AS columns,
               'tenant_id:dimension,span_id:dimension,span_kind:dimension,start_time_millis:time,'
               || 'end_time_millis:date_time,attributes__KEYS:dimension,attributes__VALUES:dimension,'
               || 'time_taken_millis:metric' AS roles,
               'tenant-' || (user_id % 10) AS tenant_id, {MILLIS} AS start_time_millis FROM events""",
    "shape_table": TABLE_ROWS,
    "epoch_columns": f"SELECT o_orderkey, {EPOCHS}, epoch_us(o_orderdate) * 1000 AS nanoseconds FROM orders",
    "ingest_filter": """
        SELECT event_id, nullif(event_type, 'click') AS kind, user_id FROM events
        WHERE NOT (event_type = 'error' OR (event_type = 'click' AND user_id < 10))""",
    "ingest_filter_keep": """
        SELECT event_id, event_type, user_id FROM events WHERE event_type = 'purchase' AND user_id >= 10""",
    "strcmp_view": """
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN 0 WHEN event_type < 'error' THEN -1 ELSE 1 END::INT AS "order",
               CASE WHEN event_type = 'purchase' THEN 0 WHEN event_type < 'purchase' THEN 1 ELSE -1 END::INT
               AS "reverse"
        FROM events""",
    "derived_columns": """
        SELECT l_orderkey, l_linenumber, cents, cents * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS cents_net,
               cents // 100000 * 100000 AS price_band
        FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)""",
    "time_bucket_counts": f"SELECT {MILLIS} // 3600000 * 3600000 AS hour, count(*) AS n FROM events GROUP BY 1",
    "ingest_rollup": ROLLUP,
    "star_rollup": EVENT_CUBE.format(source=CUBE_INPUT, groups="CUBE (shard, event_type)"),
    "star_rollup_no_star": EVENT_CUBE.format(
        source=CUBE_INPUT, groups="GROUPING SETS ((shard, event_type), (shard))"
    ),
    "star_rollup_lineitem": f"""
        SELECT l_returnflag, l_linestatus, l_linenumber, GROUPING(l_returnflag)::INT AS l_returnflag__starred,
               GROUPING(l_linestatus)::INT AS l_linestatus__starred,
               GROUPING(l_linenumber)::INT AS l_linenumber__starred,
               count(*) AS COUNT__l_orderkey, sum(cents)::BIGINT AS SUM__cents, max(cents) AS MAX__cents
        FROM {LINE_INPUT} GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
    "star_rollup_wide": """
        SELECT l_returnflag, l_linestatus, l_linenumber, discount, tax,
               GROUPING(l_returnflag)::INT AS l_returnflag__starred,
               GROUPING(l_linestatus)::INT AS l_linestatus__starred,
               GROUPING(l_linenumber)::INT AS l_linenumber__starred,
               GROUPING(discount)::INT AS discount__starred, 0::INT AS tax__starred,
               count(*) AS COUNT__l_orderkey, sum(cents)::BIGINT AS SUM__cents
        FROM (SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber,
                     CAST(round(l_discount * 100) AS BIGINT) AS discount,
                     CAST(round(l_tax * 100) AS BIGINT) AS tax,
                     CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
        GROUP BY tax, CUBE (l_returnflag, l_linestatus, l_linenumber, discount)""",
    "star_rollup_of_table": f"""
        SELECT tenant_id, span_kind, GROUPING(tenant_id)::INT AS tenant_id__starred,
               GROUPING(span_kind)::INT AS span_kind__starred,
               count(*) AS COUNT__span_id, sum(time_taken_millis)::BIGINT AS SUM__time_taken_millis
        FROM ({TABLE_ROWS}) GROUP BY CUBE (tenant_id, span_kind)""",
    "query_rollup": f"""
        SELECT event_type, count(*) AS COUNT__event_id, sum(total)::BIGINT AS SUM__total
        FROM {CUBE_INPUT} GROUP BY 1""",
    "query_rollup_where": f"""
        SELECT l_returnflag, count(*) AS COUNT__l_orderkey, sum(cents)::BIGINT AS SUM__cents,
               max(cents) AS MAX__cents
        FROM {LINE_INPUT} WHERE l_linenumber IN (1, 2, 3) GROUP BY 1""",
    "query_rollup_functions": f"""
        SELECT event_type, min(total) AS MIN__total, max(total) AS MAX__total,
               round(sum(total) / count(total), 6) AS AVG__total,
               count(DISTINCT digit) AS DISTINCTCOUNTHLL__digit
        FROM {CUBE_INPUT} GROUP BY 1""",
    "query_rollup_stored": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS COUNT__l_orderkey, sum(cents)::BIGINT AS SUM__cents,
               max(cents) AS MAX__cents
        FROM {LINE_INPUT} GROUP BY 1, 2""",
    "query_rollup_leaves": """
        WITH e AS (SELECT user_id, event_type, CAST(day(ts) AS INTEGER) AS day, CAST(floor(value * 100) AS BIGINT) AS cents FROM events)
        SELECT user_id, NULL::VARCHAR AS event_type, NULL::INTEGER AS day, sum(cents)::BIGINT AS cents, max(cents) AS most
        FROM e WHERE event_type IN ('view', 'error') GROUP BY 1
        UNION ALL SELECT NULL, event_type, day, sum(cents)::BIGINT, max(cents) FROM e GROUP BY 2, 3""",
    "partition_id_hashcode": f"""
        SELECT {java_hash("(event_type || '-' || user_id)", 7)} AS part, count(*) AS n FROM events GROUP BY 1""",
    "partition_id_text": f"SELECT page_id, {java_hash('url', 16)} AS part FROM pages",
    "partition_id_modulo": "SELECT o_custkey % 13 AS part, count(*) AS n FROM orders GROUP BY 1",
    "layout_round_trip": PLACED_ROWS,
    "layout_pruned_read": f"""
        SELECT tenant_id, span_id, span_kind, time_taken_millis FROM ({TABLE_ROWS}) WHERE tenant_id = 'tenant-3'""",
    "layout_second_range": """
        SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem
        WHERE l_extendedprice >= 20000 AND l_extendedprice < 30000""",
    "retention": f"SELECT * FROM ({TIMED}) WHERE start_time_millis >= {AS_OF} - {3 * DAY}",
    "retention_stored": f"""
        SELECT tenant_id, span_id, start_time_millis FROM ({TABLE_ROWS})
        WHERE start_time_millis >= {AS_OF} - {3 * DAY}""",
    "age_tier": f"""
        SELECT CASE WHEN {AS_OF} - start_time_millis >= {20 * DAY} THEN 'cold'
                    WHEN {AS_OF} - start_time_millis >= {5 * DAY} THEN 'warm' ELSE 'hot' END AS tier, count(*) AS n
        FROM ({TIMED}) GROUP BY 1""",
    "age_tier_stored": f"""
        SELECT *, 'warm' AS tier FROM ({TIMED})
        WHERE {AS_OF} - start_time_millis >= {5 * DAY} AND {AS_OF} - start_time_millis < {20 * DAY}""",
    "roll_over": f"""
        SELECT *, start_time_millis // 21600000 * 21600000 AS bucket_start FROM ({TIMED})
        WHERE start_time_millis < {BOUNDARY}""",
    "hybrid_read": f"""
        SELECT *, CASE WHEN start_time_millis < {BOUNDARY} THEN 'offline' ELSE 'realtime' END AS origin
        FROM ({TIMED})""",
    "batch_topics": """
        SELECT 'topic-' || (user_id % 2) AS topic, CAST(user_id AS VARCHAR) AS key, event_id FROM events""",
    "stream_span_view": SPANS,
    "stream_chained": f"SELECT * REPLACE (upper(span_kind) AS span_kind) FROM ({SPANS})",
    "stream_multi_view": """
        SELECT 'spans' AS view, CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS id FROM events
        UNION ALL SELECT 'raw', CAST(user_id AS VARCHAR), 'raw-' || event_type || ' ' || event_id FROM events
        WHERE user_id % 2 = 0""",
    "stream_fanout": """
        SELECT CAST(user_id AS VARCHAR) AS key, event_id, n_name, event_id % 3 AS partition
        FROM events LEFT JOIN nation ON user_id % 30 = n_nationkey
        UNION ALL SELECT CAST(user_id AS VARCHAR), event_id, event_type, -1 FROM events WHERE user_id % 2 = 1""",
    "stream_rollup": f"SELECT * FROM ({ROLLUP})",
    "ingest_realtime_table": PLACED_ROWS,
    "ingest_from_largest": f"""
        SELECT tenant_id, span_id, start_time_millis, time_taken_millis FROM ({TABLE_ROWS})
        WHERE span_id::BIGINT % 2 = 1""",
    "ingest_realtime_rolled": f"""
        SELECT tenant_id, span_kind, bucket_start_time_millis, sum(time_taken_millis)::BIGINT AS time_taken_millis
        FROM ({TABLE_ROWS}) GROUP BY 1, 2, 3""",
    "table_pair_hybrid": f"""
        SELECT tenant_id, span_id, start_time_millis, time_taken_millis FROM ({TABLE_ROWS})""",
    # Rolled-over rows: 90 days from the offline table; the realtime table's three days are over.
    "pair_retention": f"""
        SELECT tenant_id, span_id, start_time_millis FROM ({TABLE_ROWS})
        WHERE start_time_millis >= epoch_ms(TIMESTAMP '2024-04-15 00:00:00') - {90 * DAY}
          AND start_time_millis < {AS_OF} - {DAY}""",
    "pair_tier": f"""
        SELECT tenant_id, span_id, start_time_millis FROM ({TABLE_ROWS})
        WHERE {AS_OF} - start_time_millis >= {5 * DAY} AND {AS_OF} - start_time_millis < {20 * DAY}""",
    "pair_rolled": f"""
        SELECT tenant_id, span_kind, bucket_start_time_millis, sum(time_taken_millis)::BIGINT AS time_taken_millis
        FROM ({TABLE_ROWS}) GROUP BY 1, 2, 3""",
    "pair_cube": f"""
        SELECT tenant_id, NULL::VARCHAR AS span_kind, NULL::BIGINT AS bucket_start_time_millis, count(*) AS spans,
               sum(time_taken_millis)::BIGINT AS time_taken_millis, max(end_time_millis) AS last_end
        FROM ({TABLE_ROWS}) WHERE span_kind IN ('null', 'view') GROUP BY 1
        UNION ALL SELECT NULL, span_kind, bucket_start_time_millis, count(*), sum(time_taken_millis)::BIGINT, max(end_time_millis)
        FROM ({TABLE_ROWS}) GROUP BY 2, 3""",
}
