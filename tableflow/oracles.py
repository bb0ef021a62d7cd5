"""The same results as the workload queries, in plain SQL over the given tables."""

from __future__ import annotations

_CAPTURE = 1_700_000_000_000

# orders_history: version of a row, its file order inside a commit, and the slot of its partition
_VERSION = "(year(o_orderdate) - 1994)"
_IDX = "(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END)"
_SLOT = "(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 0 ELSE 2 END)"
_ROW = "(row_number() OVER (PARTITION BY year(o_orderdate), o_orderstatus ORDER BY o_orderkey) - 1)"

_POSITIONS = f"""
SELECT o_orderkey, o_orderstatus, {_VERSION} AS v, {_IDX} AS i, {_SLOT} AS slot, {_ROW} AS r,
       count(*) OVER (PARTITION BY year(o_orderdate), o_orderstatus) AS n
FROM orders
"""

# the feed's records, added ones with their place in the slot
_TAILED = f"""
SELECT o_orderkey, 'c' AS _op, v AS _version, slot AS _slot, row_number() OVER (PARTITION BY slot ORDER BY v, i, r) - 1 AS _seq
FROM ({_POSITIONS}) WHERE v >= {{first}}
UNION ALL SELECT o_orderkey, 'r', 8, slot, NULL FROM ({_POSITIONS}) WHERE o_orderstatus = 'P'
"""

_MESSAGES = """
SELECT event_id, ts, user_id, event_type AS kind, value AS amount,
       ts >= TIMESTAMP '2024-01-15' AS late FROM events
"""

_M32 = 4294967296


def _mul(x: str, c: int) -> str:
    return f"(({x}) * {c}::HUGEINT) % {_M32}"


def _rot(x: str, r: int) -> str:
    return f"((({x}) * {2 ** r}::HUGEINT) % {_M32} + ({x}) // {2 ** (32 - r)}::HUGEINT)"


# the published MurmurHash3 x86_32 steps, over ASCII texts
_MURMUR = f"""
WITH t AS (
  SELECT doc_id, 'lang=' || lang || ',source=' || source || ',n=' || n_chars AS k FROM documents
), w AS (
  SELECT doc_id, length(k) AS n,
    list_transform(range(length(k) // 4), lambda i:
      (ord(k[i*4+1]) + ord(k[i*4+2]) * 256 + ord(k[i*4+3]) * 65536 + ord(k[i*4+4]) * 16777216::HUGEINT)) AS full_words,
    list_sum(list_transform(range(length(k) % 4), lambda i: ord(k[(length(k) // 4) * 4 + i + 1]) * (256 ** i)::HUGEINT)) AS tail
  FROM t
), m AS (
  SELECT doc_id, n,
    list_transform(list_transform(list_transform(full_words, lambda x: {_mul('x', 0xCC9E2D51)}), lambda x: {_rot('x', 15)}),
                   lambda x: {_mul('x', 0x1B873593)}) AS mixed,
    list_transform(list_transform(list_transform([coalesce(tail, 0)::HUGEINT], lambda x: {_mul('x', 0xCC9E2D51)}),
                   lambda x: {_rot('x', 15)}), lambda x: {_mul('x', 0x1B873593)})[1] AS tail_mixed
  FROM w
), h AS (
  SELECT doc_id, n, tail_mixed,
    list_reduce(list_prepend(0::HUGEINT, mixed),
      lambda a, x: ({_rot('xor(a::HUGEINT, x::HUGEINT)', 13)} * 5 + {0xE6546B64}::HUGEINT) % {_M32}) AS h0
  FROM m
), a AS (SELECT doc_id, xor(xor(h0::HUGEINT, tail_mixed::HUGEINT), n::HUGEINT) AS x FROM h),
b AS (SELECT doc_id, {_mul('xor(x, x // 65536::HUGEINT)', 0x85EBCA6B)} AS x FROM a),
c AS (SELECT doc_id, {_mul('xor(x, x // 8192::HUGEINT)', 0xC2B2AE35)} AS x FROM b),
d AS (SELECT doc_id, xor(x, x // 65536::HUGEINT) % 2147483648 AS x FROM c)
SELECT doc_id, x::INTEGER AS hash, (x % 7)::INTEGER AS slot FROM d
"""

_REASON = """CASE WHEN event_type = 'error' THEN 'no schema text'
     WHEN event_type = 'signup' THEN 'unsupported schema type'
     WHEN event_type = 'view' THEN 'malformed payload'
     WHEN event_type = 'click' AND value > 20 THEN 'missing or null field' END"""

ORACLES: dict[str, str] = {
    "snapshot_as_of_version": "SELECT * FROM orders WHERE year(o_orderdate) <= 1997",
    "snapshot_as_of_timestamp": "SELECT * FROM orders WHERE year(o_orderdate) <= 1998",
    "snapshot_with_removes": "SELECT * FROM orders WHERE o_orderstatus <> 'P'",
    "snapshot_filtered": """SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 100000 AND 200000""",
    "start_position": """
        SELECT start_case, mode, version,
               (SELECT count(*) FROM orders WHERE year(o_orderdate) - 1994 <= version
                                              AND (version < 8 OR o_orderstatus <> 'P')) AS n_rows
        FROM (VALUES ('version 2', 'INCREMENTAL_COPY', 2), ('version 2 with history', 'FULL_COPY', 2),
              ('latest', 'INCREMENTAL_COPY', 8), ('earliest', 'INCREMENTAL_COPY', 0),
              ('unknown version', 'INCREMENTAL_COPY', 8), ('time inside', 'FULL_COPY', 3),
              ('time before first', 'INCREMENTAL_COPY', 8), ('default', 'INCREMENTAL_COPY', 8))
             AS t(start_case, mode, version)""",
    "changes_incremental": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'c' AS _op, {_VERSION} AS _version, false AS _is_full
        FROM orders WHERE {_VERSION} >= 3
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'r', 8, false
        FROM orders WHERE o_orderstatus = 'P'""",
    "changes_full_then_incremental": f"""
        SELECT o_orderkey, o_orderstatus, o_totalprice, 'c' AS _op, greatest({_VERSION}, 2) AS _version,
               {_VERSION} <= 2 AS _is_full FROM orders
        UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'r', 8, false FROM orders WHERE o_orderstatus = 'P'""",
    "changes_resume_row_level": f"""
        SELECT o_orderkey, o_orderstatus, v AS _version, i AS _action_idx, r AS _row_num FROM ({_POSITIONS})
        WHERE (v, i, r) >= (3, 2, 100)""",
    "changes_resume_per_slot": f"""
        SELECT o_orderkey, slot AS _slot, v AS _version, r AS _row_num FROM ({_POSITIONS})
        WHERE CASE slot WHEN 0 THEN (v, i, r) >= (5, 2, 100) ELSE (v, i, r) >= (3, 1, 20) END""",
    "changes_envelope": f"""
        WITH c AS (
          SELECT o_orderkey, o_orderstatus, 'c' AS _op, {_SLOT} AS slot,
                 epoch_ms(make_timestamp(year(o_orderdate), 12, 31, 0, 0, 0)) AS ts FROM orders
          UNION ALL SELECT o_orderkey, o_orderstatus, 'r', {_SLOT}, epoch_ms(TIMESTAMP '2002-12-31') FROM orders
          WHERE o_orderstatus = 'P')
        SELECT o_orderkey, _op, 'o_orderstatus=' || o_orderstatus AS _partition_value, ts AS _ts,
               {_CAPTURE} AS _capture_ts, 'o_orderstatus=' || o_orderstatus AS _key, ts AS _event_time,
               'orders-' || slot AS _destination FROM c""",
    "changes_owned_slots": f"""
        SELECT o_orderkey, 'c' AS _op, {_SLOT} AS _slot FROM orders WHERE {_SLOT} % 2 = 0
        UNION ALL SELECT o_orderkey, 'r', {_SLOT} FROM orders WHERE o_orderstatus = 'P'""",
    "changes_pruned_partition": f"""
        SELECT o_orderkey, o_orderstatus, {_VERSION} AS _version FROM orders WHERE o_orderstatus = 'O'""",
    "changes_with_rewrites": """
        SELECT p_partkey, p_name, 'c' AS _op, 1 AS _version FROM part
        UNION ALL SELECT p_partkey, p_name, 'r', 2 FROM part
        UNION ALL SELECT p_partkey, p_name, 'c', 2 FROM part""",
    "changes_without_rewrites": "SELECT p_partkey, p_name, 'c' AS _op, 1 AS _version FROM part",
    "slot_routing": """
        SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus AS partition_value,
               (CASE o_orderstatus WHEN 'F' THEN 1755496907 WHEN 'O' THEN 1617000208 ELSE 332075658 END) % 5 AS slot
        FROM orders""",
    "murmur_hash": _MURMUR,
    "slot_sequence": f"""
        SELECT o_orderkey, slot AS _slot, row_number() OVER (PARTITION BY slot ORDER BY v, i, r) - 1 AS _seq
        FROM ({_POSITIONS})""",
    "row_index_eof": f"""
        SELECT o_orderkey, v AS _version, i AS _action_idx, r AS _row_num, r = n - 1 AS _eof FROM ({_POSITIONS})""",
    "file_row_counts": f"""
        SELECT {_VERSION} AS version, o_orderstatus AS status, count(*) AS n_rows FROM orders GROUP BY ALL""",
    "admission_round": f"""
        WITH per AS (SELECT {_VERSION} AS version, count(*) AS n_rows FROM orders GROUP BY 1),
        run AS (SELECT *, coalesce(sum(n_rows) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS before FROM per)
        SELECT version, n_rows FROM run WHERE before < (SELECT count(*) // 2 FROM orders) OR before = 0""",
    "read_round": f"""
        WITH f AS (SELECT {_VERSION} AS version, {_IDX} AS idx, count(*) AS n_rows FROM orders GROUP BY ALL),
        s AS (SELECT *, coalesce(sum(n_rows) OVER (ORDER BY version, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS before, (SELECT count(*) FROM orders) AS total FROM f)
        SELECT version, idx, n_rows FROM s
        WHERE before = 0 OR (before < total // 3 AND (before + n_rows < total // 3
                                                      OR (before + n_rows) * 8 < total * 8 * 4 // 5))""",
    "schema_by_name": """
        SELECT c_custkey, TRY_CAST(c_name AS BIGINT) AS c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
               CAST(NULL AS VARCHAR) AS c_phone, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""",
    "schema_positional": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label, CAST(c_nationkey AS BIGINT) AS nation,
               c_acctbal AS balance FROM customer""",
    "schema_epochs": """
        SELECT c_custkey, CASE WHEN early THEN c_name END AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CASE WHEN NOT early THEN c_acctbal END AS c_acctbal, c_mktsegment,
               CASE WHEN early THEN 1 ELSE 3 END AS _version
        FROM (SELECT *, c_mktsegment < 'FURNITURE' AS early FROM customer)""",
    "evolve_type_change": """
        SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CASE WHEN c_mktsegment >= 'FURNITURE' THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
    "type_bridge": """
        SELECT l_orderkey, l_linenumber, l_returnflag, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
               '{"part":' || l_partkey || ',"supp":' || l_suppkey || '}' AS ref,
               '["' || l_returnflag || '","' || l_linestatus || '"]' AS flags,
               CAST(l_shipdate AS DATE) AS shipped, CAST(l_tax AS FLOAT) AS tax FROM lineitem""",
    "partition_path_values": """
        SELECT c_custkey, 'c_mktsegment=' || c_mktsegment || '/c_nationkey=' || c_nationkey AS path,
               '' AS path_with_absent, 'c_mktsegment=' || c_mktsegment || ',c_nationkey=' || c_nationkey AS values
        FROM customer""",
    "decode_json_events": """
        SELECT event_id AS msg_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "reject_reasons": f"SELECT event_id AS msg_id, {_REASON} AS reason FROM events",
    "reject_side_output": f"""
        SELECT coalesce({_REASON}, 'accepted') AS reason, count(*) AS n FROM events GROUP BY 1""",
    "wrap_primitive": "SELECT text AS body, sha256(CAST(doc_id AS VARCHAR)) AS uuid FROM documents",
    "unwrap_primitive": "SELECT text AS message, sha256(CAST(doc_id AS VARCHAR)) AS uuid FROM documents",
    "record_keys": """
        SELECT l_partkey, l_suppkey, CAST(l_orderkey AS VARCHAR) AS single,
               'l_partkey:' || l_partkey || ',l_suppkey:' || l_suppkey AS composite FROM lineitem""",
    "acknowledged_cursors": f"""
        SELECT slot, 'checkpoint' || slot AS state_key,
               '{{"state":"INCREMENTAL_COPY","snapShotVersion":' || max(v) || ',"metadataChangeFileIndex":' || max(i)
               || ',"rowNum":' || max(r) FILTER (WHERE v = 7) || ',"seqCount":' || (count(*) - 1) || '}}' AS cursor
        FROM ({_POSITIONS}) GROUP BY slot""",
    "commit_groups": """
        SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 1500 AS commit_group FROM events""",
    "schema_runs": """
        WITH c AS (SELECT event_id, event_type,
                   CASE WHEN lag(event_type) OVER (ORDER BY event_id) <> event_type THEN 1 ELSE 0 END AS ch FROM events)
        SELECT event_id, event_type, CAST(sum(ch) OVER (ORDER BY event_id) AS BIGINT) AS run FROM c""",
    "append_roundtrip": "SELECT * FROM lineitem WHERE l_quantity > 10 AND l_discount <= 0.05",
    "partitioned_roundtrip": """
        SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag = 'R'""",
    "evolve_replace": f"""
        SELECT user_id, CASE WHEN late THEN amount END AS amount, kind FROM ({_MESSAGES})""",
    "evolve_by_name": f"""
        SELECT CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS DOUBLE) AS amount, kind FROM ({_MESSAGES})
        UNION ALL SELECT NULL, amount, kind FROM ({_MESSAGES})
        UNION ALL SELECT user_id, amount, kind FROM ({_MESSAGES})""",
    "keyed_last_write_wins": f"""
        WITH g AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 3000 AS grp FROM ({_MESSAGES}))
        SELECT user_id, amount, kind FROM g
        QUALIFY row_number() OVER (PARTITION BY grp, user_id ORDER BY event_id DESC) = 1""",
    "keyed_partitioned": f"""
        SELECT user_id, amount, kind, kind AS partition_path FROM ({_MESSAGES})
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "last_per_key": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    "commit_check": f"SELECT count(*) AS total, count({_REASON}) AS errors FROM events",
    "ingest_two_batches": f"SELECT user_id, kind FROM ({_MESSAGES})",
    "keyed_null_keys": """
        SELECT user_id, event_type AS kind FROM events WHERE event_type <> 'error'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
        UNION ALL SELECT NULL, 'no record key' FROM events WHERE event_type = 'error'""",
    "evolve_case": f"SELECT CASE WHEN late THEN user_id END AS user_id, kind FROM ({_MESSAGES})",
    "typed_records": f"SELECT user_id, amount, kind FROM ({_MESSAGES})",
    "partition_empty_text": """
        SELECT read_by, event_id, kind, kind IS NULL AS missing FROM (
          SELECT event_id, CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE event_type END AS kind FROM events
        ), (VALUES ('snapshot'), ('feed')) t(read_by)""",
    "message_schema": """
        SELECT column_name AS name, (SELECT count(*) FROM lineitem) AS n FROM (DESCRIBE lineitem)""",
    "commit_groups_null_ids": """
        SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
               (row_number() OVER (ORDER BY event_type <> 'error', event_id) - 1) // 700 AS commit_group FROM events""",
    "stream_tail_restart": f"""
        SELECT o_orderkey, o_orderstatus, 'c' AS _op, {_VERSION} AS _version FROM orders WHERE {_VERSION} >= 3""",
    "idempotent_replay": f"SELECT user_id, kind FROM ({_MESSAGES})",
    "stream_tail_changes": f"""
        SELECT o_orderkey, o_orderstatus, 'c' AS _op, {_VERSION} AS _version, {_SLOT} AS _slot
        FROM orders WHERE {_VERSION} >= 3
        UNION ALL SELECT o_orderkey, o_orderstatus, 'r', 8, {_SLOT} FROM orders WHERE o_orderstatus = 'P'""",
    "feed_in_rounds": f"""
        SELECT o_orderkey, 'c' AS _op, v AS _version, slot AS _slot,
               row_number() OVER (PARTITION BY slot ORDER BY v, i, r) - 1 AS _seq FROM ({_POSITIONS})""",
    "tail_with_failures": _TAILED.format(first=2),
    "drained_tail": _TAILED.format(first=1),
    "timed_cursor_export": f"""
        SELECT 'checkpoint' || slot AS state_key,
               '{{"state": "INCREMENTAL_COPY", "snapShotVersion": 7, "metadataChangeFileIndex": ' || max(i) || ', "rowNum": '
               || max(r) FILTER (WHERE v = 7) || ', "seqCount": ' || (count(*) - 1) || '}}' AS cursor
        FROM ({_POSITIONS}) WHERE slot <> 2 GROUP BY slot""",
    "resume_without_checkpoint": f"""
        SELECT o_orderkey, slot AS _slot, v AS _version, r AS _row_num FROM ({_POSITIONS}) WHERE slot <> 0 OR (v, i, r) >= (4, 2, 50)""",
    "feed_total_order": f"""
        SELECT o_orderkey, row_number() OVER (ORDER BY v, i, r) - 1 AS place FROM ({_POSITIONS})""",
    "snapshot_skipping_files": """
        SELECT * FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'P'
            THEN 'order placed with priority number ' || o_orderpriority || ' in ' || year(o_orderdate) END AS note
          FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1998-09-01' AND o_totalprice > 50000)
        WHERE note >= 'order placed with priority number 2'""",
    "catalog_names": f"SELECT user_id, CASE WHEN late THEN amount END AS amount, kind FROM ({_MESSAGES})",
    "tail_round_metrics": f"""
        SELECT 1 AS first_version, 8 AS last_version, count(DISTINCT v * 10 + i) + count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN v END) AS files,
               count(*) + count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS n_rows FROM ({_POSITIONS})""",
    "crash_and_recovery": f"SELECT user_id, kind FROM ({_MESSAGES})",
    "keyed_evolution": f"""
        SELECT user_id, CASE WHEN late THEN amount END AS amount, kind FROM ({_MESSAGES})
        QUALIFY row_number() OVER (PARTITION BY late, user_id ORDER BY event_id DESC) = 1""",
    "options_by_name": f"SELECT user_id, kind, 'kind=' || kind AS _partition_value FROM ({_MESSAGES})",
    "stream_ingest_events": f"SELECT user_id, kind FROM ({_MESSAGES})",
    "feed_metrics": f"""
        SELECT {_VERSION} AS version, count(DISTINCT o_orderstatus) AS actions_prepared,
               count(DISTINCT o_orderstatus) AS files_prepared, count(*) AS rows_prepared, 0 AS files_filtered,
               0 AS schema_changes FROM orders GROUP BY 1
        UNION ALL SELECT 8, count(DISTINCT year(o_orderdate)), count(DISTINCT year(o_orderdate)), count(*), 0, 0
        FROM orders WHERE o_orderstatus = 'P'""",
    "feed_metrics_filtered": f"""
        SELECT version, count(*) FILTER (WHERE keep) AS files_prepared, count(*) FILTER (WHERE NOT keep) AS files_filtered,
               CAST(coalesce(sum(n) FILTER (WHERE keep), 0) AS BIGINT) AS rows_prepared
        FROM (SELECT {_VERSION} AS version, {_IDX} AS i, count(*) AS n, (version, i) >= (3, 2) AS keep
              FROM orders GROUP BY ALL) GROUP BY version""",
    "commit_metrics": f"""
        SELECT {_VERSION} AS version, count(DISTINCT o_orderstatus) AS data_files, 0 AS removed_files FROM orders GROUP BY 1
        UNION ALL SELECT 8, 0, count(DISTINCT year(o_orderdate)) FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT 0, 0, 0 FROM (SELECT count(*) FROM orders)""",
    "sink_to_feed": f"""
        SELECT user_id, CASE WHEN late THEN amount END AS amount, kind, 'c' AS _op,
               CASE WHEN late THEN 3 ELSE 1 END AS _version, 'kind=' || kind AS _partition_value FROM ({_MESSAGES})""",
}
