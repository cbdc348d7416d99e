"""DuckDB SQL for the queries of weir.plans.catalog."""

_TS = "strftime(make_timestamp(epoch_us({0}) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%f')"
_EVENT_TS = _TS.format("ts")
_ORDER_TS = _TS.format("o_orderdate")
_FROZEN = "'2026-01-01T00:00:00.123456'"

#: Events that give a row: not empty, with a good key and value, and routed.
_GOOD = "event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 29 <> 0"
_PAYLOAD = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '","value":' || value::VARCHAR
  || ',"props":' || replace(props, ' ', '') || '}'"""
_KAFKA = f"""'main' AS __cluster, (user_id % 4)::BIGINT AS __kafka_partition, event_id AS __kafka_offset,
  'events' AS __kafka_topic, '{{}}' AS __schema, {_EVENT_TS} AS __event_timestamp, {_FROZEN} AS __inserted_at"""
_CE = f"""event_type AS __ce_type, event_id::VARCHAR AS __ce_id,
  CASE WHEN event_id % 3 = 0 THEN {_EVENT_TS} END AS __ce_time"""

_OP = "CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' ELSE 'd' END"
_ISO = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_FULL = f"""'{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || o_totalprice::VARCHAR
  || ',"o_orderdate":"' || {_ISO} || '"}}'"""
_CDC = f"""o_orderkey, {_OP} AS __operation, {_OP} = 'd' AS __deleted, o_orderkey AS __kafka_offset, {_ORDER_TS} AS __event_timestamp"""
_FIELD_TEXTS = {
    "o_orderkey": '{"name":"o_orderkey","type":"long"}',
    "o_orderstatus": '{"name":"o_orderstatus","type":"string"}',
    "o_totalprice": '{"name":"o_totalprice","type":"double"}',
    "o_orderdate": '{"name":"o_orderdate","type":{"type":"long","logicalType":"timestamp-millis"}}',
}


def _fields(*names: str) -> str:
    return ",".join(_FIELD_TEXTS[n] for n in names)


_US = "(epoch_us(ts) - CASE WHEN event_id % 2 = 1 THEN 2000000000000000 ELSE 0 END)"
_OF_DAY = f"((({_US} % 86400000000) + 86400000000) % 86400000000)"


def _clock(us: str) -> str:
    """HH:MM:SS and, unless it is zero, the fraction."""
    return f"""printf('%02d:%02d:%02d', ({us} // 3600000000)::INT, (({us} // 60000000) % 60)::INT, (({us} // 1000000) % 60)::INT)
      || CASE WHEN {us} % 1000000 = 0 THEN '' ELSE printf('.%06d', ({us} % 1000000)::INT) END"""


def _stamp(us: str, of_day: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%d') || 'T' || {_clock(of_day)}"


_MS_OF_DAY = f"({_OF_DAY} // 1000 * 1000)"

ORACLE = {
    "json_events_rows": f"SELECT user_id, {_PAYLOAD} AS payload, {_KAFKA} FROM events WHERE {_GOOD}",
    "cloudevents_rows": f"SELECT user_id, {_PAYLOAD} AS payload, {_CE}, {_KAFKA} FROM events WHERE {_GOOD} AND event_id % 31 <> 0",
    "cloudevents_enriched_rows": f"""
SELECT user_id, {_PAYLOAD} AS payload,
  CASE WHEN event_id % 31 = 0 THEN '{{}}' ELSE '{{"ce_type":"' || event_type || '","ce_id":"' || event_id || '"'
    || CASE WHEN event_id % 3 = 0 THEN ',"ce_time":"' || {_EVENT_TS} || '"' ELSE '' END || '}}' END AS headers,
  CASE WHEN event_id % 31 <> 0 THEN event_type END AS __ce_type,
  CASE WHEN event_id % 31 <> 0 THEN event_id::VARCHAR END AS __ce_id,
  CASE WHEN event_id % 31 <> 0 AND event_id % 3 = 0 THEN {_EVENT_TS} END AS __ce_time, {_KAFKA}
FROM events WHERE {_GOOD}""",
    "json_cdc_rows": f"""
SELECT o_orderkey,
  CASE WHEN {_OP} <> 'd' THEN '{{"k":' || o_orderkey || ',"p":' || o_totalprice::VARCHAR || '}}' END AS payload,
  CASE {_OP} WHEN 'u' THEN '{{"k":' || o_orderkey || ',"p":1.5}}'
             WHEN 'd' THEN '{{"k":' || o_orderkey || ',"p":' || o_totalprice::VARCHAR || '}}' END AS __before,
  (o_custkey % 4)::BIGINT AS __kafka_partition, o_orderkey AS __kafka_offset, {_ORDER_TS} AS __event_timestamp, '{{}}' AS __schema
FROM orders""",
    "debezium_rows": f"""
SELECT {_CDC}, {_FULL} AS payload, '[{_fields("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")}]' AS __schema FROM orders""",
    "debezium_denylist": f"""
SELECT {_CDC}, '{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}}' AS payload,
  '[{_fields("o_orderkey", "o_orderstatus")}]' AS __schema FROM orders""",
    "avro_events_rows": f"""
SELECT o_orderkey, '{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || o_totalprice::VARCHAR
  || ',"who":{{"o_custkey":' || o_custkey || '}}}}' AS payload, o_orderkey AS __kafka_offset, {_ORDER_TS} AS __event_timestamp,
  '[{_fields("o_orderkey", "o_orderstatus", "o_totalprice")},[{{"name":"o_custkey","type":"long"}}]]' AS __schema FROM orders""",
    "skip_outcomes": """
SELECT event_id AS "offset",
  CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0 THEN 'skipped'
       WHEN event_id % 31 = 0 THEN 'error' ELSE 'row' END AS outcome,
  CASE WHEN event_id % 17 = 0 THEN 'empty_value' WHEN event_id % 19 = 0 THEN 'invalid_key'
       WHEN event_id % 23 = 0 OR event_id % 29 = 0 THEN 'decode_error' END AS skip_reason,
  CASE WHEN event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 29 <> 0 AND event_id % 31 = 0
       THEN 'transform' END AS stage
FROM events""",
    "outcome_by_stage": """
SELECT outcome, skip_reason, stage, count(*)::BIGINT AS n FROM (
  SELECT CASE WHEN event_id % 17 = 0 THEN 'skipped'
              WHEN event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0 OR event_id % 31 = 0 THEN 'error' ELSE 'row' END AS outcome,
    CASE WHEN event_id % 17 = 0 THEN 'empty_value' END AS skip_reason,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0 THEN 'source'
         WHEN event_id % 31 = 0 THEN 'transform' END AS stage
  FROM events) GROUP BY ALL""",
    "topic_routing_counts": """
SELECT CASE WHEN event_id % 29 = 0 THEN 'unrouted' ELSE 'events' END AS topic,
  CASE WHEN event_id % 29 <> 0 THEN 'p.d.events' END AS destination_id, count(*)::BIGINT AS n
FROM events WHERE event_id % 17 <> 0 GROUP BY ALL""",
    "unrouted_topics": "SELECT DISTINCT 'unrouted' AS topic FROM events WHERE event_id % 29 = 0",
    "framing_ids": """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderkey + 1 WHEN 1 THEN o_orderkey END AS schema_id FROM orders""",
    "event_timestamp_format": f"SELECT event_id, {_EVENT_TS} AS event_timestamp FROM events",
    "avro_logical_types": f"""
SELECT event_id, {_stamp(_US, _MS_OF_DAY)} || '+00:00' AS timestamp_millis, {_stamp(_US, _OF_DAY)} || '+00:00' AS timestamp_micros,
  {_stamp(_US, _OF_DAY)} AS local_timestamp_micros, strftime(make_timestamp({_US}), '%Y-%m-%d') AS "date",
  {_clock(_MS_OF_DAY)} AS time_millis, {_clock(_OF_DAY)} AS time_micros FROM events""",
    "json_name_resolution": """
SELECT event_id AS "offset", CASE WHEN event_id % 3 = 2 THEN 'error' ELSE 'row' END AS outcome,
  CASE WHEN event_id % 3 = 2 THEN 'encode' END AS stage, CASE WHEN event_id % 3 <> 2 THEN user_id END AS value FROM events""",
    "numeric_string_keys": """
SELECT event_id AS "offset", CASE WHEN event_id % 5 <= 2 THEN 'row' ELSE 'error' END AS outcome,
  CASE WHEN event_id % 5 > 2 THEN 'encode' END AS stage,
  CASE event_id % 5 WHEN 0 THEN user_id WHEN 1 THEN user_id WHEN 2 THEN user_id * 1000 END AS value FROM events""",
    "required_violations": """
SELECT outcome, stage, count(*)::BIGINT AS n, sum(value)::BIGINT AS total FROM (
  SELECT CASE WHEN event_id % 4 <= 1 THEN 'error' ELSE 'row' END AS outcome, CASE WHEN event_id % 4 <= 1 THEN 'encode' END AS stage,
    CASE WHEN event_id % 4 > 1 THEN user_id END AS value FROM events) GROUP BY ALL""",
    "decimal_rounding": """
WITH c AS (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS cents FROM orders),
d AS (SELECT o_orderkey, cents, (10 ** greatest(length(cents::VARCHAR) - 3, 0))::BIGINT AS unit FROM c),
r AS (SELECT o_orderkey, cents, unit, cents // unit AS q, cents % unit AS rest FROM d)
SELECT o_orderkey, cents / 100.0::DOUBLE AS exact,
  (q + CASE WHEN 2 * rest > unit OR (2 * rest = unit AND unit > 1 AND q % 2 = 1) THEN 1 ELSE 0 END) * unit / 100.0::DOUBLE AS rounded FROM r""",
    "json_canonical_text": """
SELECT event_id, '{"b":[' || event_id || ',1e20,1.5,1.5e-7,true,null],"a":"é/\\t","n":{"x":"' || event_type || '"}}' AS canonical FROM events""",
    "surrogate_control_sanitize": """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"k":"' || event_id || chr(65533) || '"}' WHEN 1 THEN '{"k":"' || event_id || '"}'
  WHEN 3 THEN '{"k":"' || event_id || chr(128512) || '"}' END AS canonical FROM events""",
    "partition_day_counts": f"""
SELECT strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d') AS day, count(*)::BIGINT AS n FROM events WHERE {_GOOD} GROUP BY 1""",
    "capture_first_n": """
SELECT topic, partition, "offset", timestamp FROM (
  SELECT CASE WHEN event_id % 29 = 0 THEN 'unrouted' ELSE 'events' END AS topic, (user_id % 4)::INTEGER AS partition, event_id AS "offset",
    epoch_us(ts) // 1000 AS timestamp,
    row_number() OVER (PARTITION BY event_id % 29 = 0 ORDER BY user_id % 4, event_id) AS place FROM events) WHERE place <= 50""",
    "commit_prefix": """
WITH a AS (SELECT (user_id % 4)::INTEGER AS partition, event_id AS o, NOT (event_id % 97 = 0 AND event_id > 1000) AS done FROM events),
g AS (SELECT partition, min(o) AS gap FROM a WHERE NOT done GROUP BY 1)
SELECT 'events' AS topic, a.partition, max(CASE WHEN g.gap IS NULL OR o < g.gap THEN o END) + 1 AS "commit"
FROM a LEFT JOIN g ON a.partition = g.partition GROUP BY a.partition""",
    "consumer_lag_by_topic": """
SELECT event_type AS topic, count(*)::BIGINT AS lag FROM events WHERE user_id % 7 <> 0 GROUP BY 1""",
    "ack_latency_percentiles": """
WITH v AS (SELECT trunc(value * 100)::BIGINT AS ms FROM events WHERE value IS NOT NULL),
r AS (SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS i, count(*) OVER () AS n FROM v)
SELECT max(n)::BIGINT AS n, min(CASE WHEN i = floor(n * 0.5) THEN ms END) AS p50, min(CASE WHEN i = floor(n * 0.99) THEN ms END) AS p99,
  max(ms) AS "max" FROM r""",
    "distinct_rows_ignoring_inserted_at": """
SELECT (2 * count(*))::BIGINT AS n_rows, count(DISTINCT (user_id, event_type))::BIGINT AS n_distinct FROM events""",
    "parity_verdicts": """
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'only_left' WHEN o_orderkey % 13 = 0 THEN 'differs' ELSE 'matched' END AS verdict,
  count(*)::BIGINT AS n FROM orders GROUP BY 1""",
    "stream_replay_equals_batch": f"SELECT user_id, {_PAYLOAD} AS payload, event_id AS __kafka_offset FROM events WHERE {_GOOD}",
}
