"""DuckDB oracle SQL for every registered query (independent re-statement of each semantics in SQL).

The driver tables are pre-registered views; the fixture views of FIXTURES.md §2 are rebuilt here as CTEs
from the same tables, so the oracle never sees Spark output.
"""

from __future__ import annotations


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


PROV = ("receipt_id, action_index, tx_hash, signer_id, predecessor_id, current_account_id, block_height, "
        "block_timestamp, shard_id, receipt_index")

CALLS_CTE = f"""
ev AS (
  SELECT *, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 3600000000 AS hr,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events
),
calls AS (
  SELECT 'rcpt' || {_v('event_id')} AS receipt_id,
         CAST(event_id % 3 AS INTEGER) AS action_index,
         CASE WHEN event_id % 10 <> 0 THEN 'tx' || {_v('event_id')} END AS tx_hash,
         'user' || {_v('user_id')} || '.near' AS signer_id,
         'user' || {_v('user_id % 25')} || '.near' AS predecessor_id,
         'app' || {_v('event_id % 3')} || '.near' AS current_account_id,
         CAST(100000000 + hr * 97 AS BIGINT) AS block_height,
         CAST((hr + 473352) * 3600000000000 AS BIGINT) AS block_timestamp,
         CAST(user_id % 6 AS INTEGER) AS shard_id,
         CAST(event_id % 100000 AS INTEGER) AS receipt_index,
         CASE WHEN event_type = 'error' THEN
                CASE event_id % 4 WHEN 0 THEN '__fastdata_*' WHEN 1 THEN '__fastdata_'
                                  WHEN 2 THEN 'transfer' ELSE '__fastdata_a b' END
              WHEN event_type = 'signup' THEN '__fastdata_raw'
              ELSE '__fastdata_kv' END AS method_name,
         CASE WHEN event_id % 50 = 0 THEN '[1]'
              WHEN event_id % 50 = 1 THEN '{{bad'
              ELSE '{{"graph/follow/user' || {_v('k % 20')} || '.near":'
                   || CASE WHEN k % 5 = 0 THEN 'null' ELSE {_v('k')} END
                   || ',"' || event_type || '":"' || {_v('k')} || '"}}' END AS args
  FROM ev
),
tagged AS (
  SELECT *, CASE WHEN starts_with(method_name, '__fastdata_') THEN substr(method_name, 12) END AS suffix
  FROM calls
),
blobs AS (
  SELECT receipt_id, action_index, suffix, block_height // 10000 AS block_height_bucket, args AS data,
         tx_hash, signer_id, predecessor_id, current_account_id, block_height, block_timestamp, shard_id,
         receipt_index
  FROM tagged
  WHERE suffix IS NOT NULL AND regexp_full_match(suffix, '[A-Za-z0-9_-]{{1,64}}')
),
kvb AS (
  SELECT *, CAST((CAST(shard_id AS BIGINT) * 100000 + receipt_index) * 1000 + action_index AS BIGINT) AS order_id
  FROM blobs
  WHERE suffix = 'kv' AND json_valid(data) AND json_type(data) = 'OBJECT'
    AND len(list_distinct(json_keys(data))) <= 256
    AND receipt_index < 100000 AND action_index < 1000
),
kv AS (
  SELECT {PROV}, order_id, j.key AS key, CAST(j.value AS VARCHAR) AS value
  FROM kvb, json_each(kvb.data) AS j
  WHERE j.key <> '' AND strlen(j.key) <= 1024 AND NOT regexp_matches(j.key, '\\p{{Cc}}')
),
kv_last AS (
  SELECT * FROM kv
  QUALIFY row_number() OVER (PARTITION BY predecessor_id, current_account_id, key
                             ORDER BY block_height DESC, order_id DESC) = 1
),
edge_parts AS (
  SELECT *, string_split(ltrim(key, '/'), '/') AS segs FROM kv_last
),
edge_rows AS (
  SELECT array_to_string(segs[1:len(segs) - 1], '/') AS edge_type, segs[len(segs)] AS target,
         predecessor_id AS source, current_account_id, block_height, block_timestamp, order_id, value,
         value = 'null' AS is_deletion
  FROM edge_parts
  WHERE len(segs) >= 2 AND predecessor_id <> '' AND segs[len(segs)] <> ''
    AND array_to_string(segs[1:len(segs) - 1], '/') <> ''
),
edge_state AS (
  SELECT * FROM edge_rows
  QUALIFY row_number() OVER (PARTITION BY edge_type, target, source
      ORDER BY block_height DESC, order_id DESC, is_deletion DESC, value DESC, current_account_id DESC) = 1
),
kv_edges AS (
  SELECT edge_type, target, source, current_account_id, block_height, block_timestamp, order_id, value
  FROM edge_state WHERE NOT is_deletion
)"""


def with_calls(body: str) -> str:
    return f"WITH {CALLS_CTE}\n{body}"


KV_COLS = PROV + ", order_id, key, value"
REVERSE_COLS = ("current_account_id, key, predecessor_id, receipt_id, action_index, tx_hash, signer_id, block_height, "
                "block_timestamp, shard_id, receipt_index, order_id, value")
BLOB_COLS = ("receipt_id, action_index, suffix, block_height_bucket, data, tx_hash, signer_id, predecessor_id, "
             "current_account_id, block_height, block_timestamp, shard_id, receipt_index")
BY_BLOCK = f"""SELECT predecessor_id, current_account_id, block_height, key, value, block_timestamp, order_id,
       receipt_id, tx_hash
FROM kv
QUALIFY row_number() OVER (PARTITION BY predecessor_id, current_account_id, block_height, key
                           ORDER BY order_id DESC) = 1"""
ACCOUNTS = """SELECT predecessor_id, block_height AS last_block_height, block_timestamp AS last_block_timestamp
FROM kv_last
QUALIFY row_number() OVER (PARTITION BY predecessor_id ORDER BY block_height DESC, order_id DESC) = 1"""

PRED, CONTRACT = "'user7.near'", "'app1.near'"
SCAN_LO, SCAN_HI = 100_000_000 + 97 * 100, 100_000_000 + 97 * 300
EXPIRE_CUTOFF_US = 1_707_955_200_000_000 - 2_592_000 * 1_000_000

FLATTEN = f"""WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderkey // 32 AS blk,
         CAST(o_custkey % 4 AS INTEGER) AS shard_id,
         CAST(row_number() OVER (PARTITION BY o_orderkey // 32, o_custkey % 4 ORDER BY o_orderkey) - 1 AS INTEGER)
           AS receipt_index
  FROM orders
),
li AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS INTEGER) AS action_index
  FROM lineitem
)
SELECT 'r' || {_v('o_orderkey')} AS receipt_id, action_index,
       CASE WHEN o_orderkey % 10 <> 0 THEN 'tx' || {_v('o_orderkey')} END AS tx_hash,
       'cust' || {_v('o_custkey')} || '.near' AS signer_id,
       'cust' || {_v('o_custkey')} || '.near' AS predecessor_id,
       'shop' || {_v('o_orderkey % 5')} || '.near' AS current_account_id,
       CAST(100000000 + blk AS BIGINT) AS block_height,
       CAST((1700000000 + blk) * 1000000000 AS BIGINT) AS block_timestamp,
       shard_id, receipt_index,
       CASE WHEN l_linestatus = 'O' THEN '__fastdata_kv' ELSE '__fastdata_raw' END AS method_name,
       '{{"part/' || {_v('l_partkey')} || '":' || {_v('l_suppkey')} || '}}' AS args
FROM o JOIN li ON o.o_orderkey = li.l_orderkey
WHERE o_orderstatus <> 'P' AND l_returnflag <> 'N'"""

PATH_OK = (r"(regexp_full_match({p}, '[\x20-\x24\x26-\x7e]+') AND strlen({p}) <= 1024 "
           r"AND NOT regexp_matches({p}, '(^|/)\.{{0,2}}(/|$)') AND NOT regexp_matches({p}, '(^|\\)\.{{0,2}}(\\|$)'))")

FILES_CTE = f"""docs AS (
  SELECT doc_id, source || '/' || lang || '/' || {_v('doc_id')} || '.txt' AS relative_path, encode(text) AS bytes,
         source AS pred, lang || '.fs.near' AS contract, octet_length(encode(text)) AS n,
         greatest(1, (octet_length(encode(text)) + 4095) // 4096) AS nchunks
  FROM documents
),
valid AS (SELECT * FROM docs WHERE {PATH_OK.format(p='relative_path')}),
simple AS (
  SELECT *, 0 AS c, CASE WHEN doc_id % 20 = 0 THEN 1 ELSE 0 END AS late FROM valid WHERE nchunks = 1
),
partial AS (
  SELECT *, 0 AS late FROM (SELECT *, unnest(range(0, nchunks)) AS c FROM valid WHERE nchunks > 1)
),
chunk_rows AS (
  SELECT doc_id, relative_path, pred, contract, c, late,
         CASE WHEN late = 1 THEN NULL ELSE 'text/plain' END AS mime_type,
         CASE WHEN late = 1 THEN NULL ELSE md5(bytes) END AS content_md5,
         CASE WHEN late = 1 THEN NULL ELSE CAST(n AS INTEGER) END AS content_len,
         0 AS off, CASE WHEN late = 1 THEN 0 ELSE n END AS full_size, 0 AS nonce
  FROM simple
  UNION ALL
  SELECT doc_id, relative_path, pred, contract, c, late, 'text/plain',
         md5(unhex(substr(hex(bytes), c * 8192 + 1, 8192))),
         CAST(least(4096, n - c * 4096) AS INTEGER), c * 4096, n, doc_id + 1
  FROM partial
),
chunks AS (
  SELECT 'fs' || {_v('doc_id')} || '-' || {_v('c')} || '-' || {_v('late')} AS receipt_id,
         CAST(c AS INTEGER) AS action_index,
         CASE WHEN doc_id % 7 <> 0 THEN 'ftx' || {_v('doc_id')} END AS tx_hash,
         pred AS signer_id, pred AS predecessor_id, contract AS current_account_id,
         CAST(200000000 + doc_id * 2 + late AS BIGINT) AS block_height,
         CAST((200000000 + doc_id * 2 + late) * 1000000000 AS BIGINT) AS block_timestamp,
         CAST(doc_id % 4 AS INTEGER) AS shard_id, CAST(doc_id % 1000 AS INTEGER) AS receipt_index,
         mime_type, relative_path, CAST(off AS INTEGER) AS "offset", CAST(full_size AS INTEGER) AS full_size,
         CAST(nonce AS INTEGER) AS nonce, content_md5, content_len
  FROM chunk_rows
)"""

CHUNK_COLS = PROV + ', mime_type, relative_path, "offset", full_size, nonce, content_md5, content_len'

REJECTS = f"""WITH {CALLS_CTE},
{FILES_CTE},
rej AS (
  SELECT 'route' AS stage, 'invalid_suffix' AS reason FROM tagged
  WHERE suffix IS NOT NULL AND NOT regexp_full_match(suffix, '[A-Za-z0-9_-]{{1,64}}')
  UNION ALL
  SELECT 'kv_blob', CASE WHEN NOT json_valid(data) THEN 'invalid_json'
                         WHEN json_type(data) <> 'OBJECT' THEN 'not_object'
                         WHEN len(list_distinct(json_keys(data))) > 256 THEN 'too_many_keys'
                         WHEN NOT (receipt_index < 100000 AND action_index < 1000) THEN 'order_id_overflow' END
  FROM blobs WHERE suffix = 'kv'
  UNION ALL
  SELECT 'kv_key', CASE WHEN strlen(j.key) > 1024 THEN 'key_too_long' ELSE 'invalid_key' END
  FROM kvb, json_each(kvb.data) AS j
  WHERE NOT (j.key <> '' AND strlen(j.key) <= 1024 AND NOT regexp_matches(j.key, '\\p{{Cc}}'))
  UNION ALL
  SELECT 'files', CASE WHEN nchunks = 1 THEN 'invalid_simple' ELSE 'invalid_partial' END
  FROM (SELECT nchunks, unnest(range(0, nchunks + CASE WHEN nchunks = 1 AND doc_id % 20 = 0 THEN 1 ELSE 0 END))
        FROM docs WHERE NOT {PATH_OK.format(p='relative_path')})
)
SELECT stage, reason, count(*) AS n FROM rej WHERE reason IS NOT NULL GROUP BY stage, reason"""


REJECT_RECORDS = f"""WITH {CALLS_CTE},
{FILES_CTE},
rej AS (
  SELECT 'route' AS stage, 'invalid_suffix' AS reason, receipt_id, action_index, block_height, predecessor_id,
         current_account_id, suffix AS detail
  FROM tagged WHERE suffix IS NOT NULL AND NOT regexp_full_match(suffix, '[A-Za-z0-9_-]{{1,64}}')
  UNION ALL
  SELECT 'kv_blob', CASE WHEN NOT json_valid(data) THEN 'invalid_json'
                         WHEN json_type(data) <> 'OBJECT' THEN 'not_object'
                         WHEN len(list_distinct(json_keys(data))) > 256 THEN 'too_many_keys'
                         WHEN NOT (receipt_index < 100000 AND action_index < 1000) THEN 'order_id_overflow' END,
         receipt_id, action_index, block_height, predecessor_id, current_account_id, data
  FROM blobs WHERE suffix = 'kv'
  UNION ALL
  SELECT 'kv_key', CASE WHEN strlen(j.key) > 1024 THEN 'key_too_long' ELSE 'invalid_key' END,
         receipt_id, action_index, block_height, predecessor_id, current_account_id, j.key
  FROM kvb, json_each(kvb.data) AS j
  WHERE NOT (j.key <> '' AND strlen(j.key) <= 1024 AND NOT regexp_matches(j.key, '\\p{{Cc}}'))
)
SELECT * FROM rej WHERE reason IS NOT NULL"""


def with_files(body: str) -> str:
    return f"WITH {FILES_CTE}\n{body}"


ORACLE: dict[str, str] = {
    "flatten_blocks": FLATTEN,
    "block_feed": f"SELECT * FROM ({FLATTEN}) WHERE block_height >= 100000010",
    "raw_calls": with_calls(f"SELECT {BLOB_COLS} FROM blobs"),
    "suffix_counts": with_calls(
        "SELECT suffix, count(*) AS n_calls, count(DISTINCT block_height) AS n_blocks FROM blobs GROUP BY suffix"),
    "order_ids": with_calls("""SELECT *, block_height * 1000000000 + order_id AS lww_version FROM (
  SELECT receipt_id, suffix, block_height, shard_id, receipt_index, action_index,
         CASE WHEN receipt_index BETWEEN 0 AND 99999 AND action_index BETWEEN 0 AND 999 AND shard_id >= 0
              THEN CAST((CAST(shard_id AS BIGINT) * 100000 + receipt_index) * 1000 + action_index AS BIGINT) END
           AS order_id
  FROM blobs)"""),
    "scan_suffix_range": with_calls(
        f"SELECT {BLOB_COLS} FROM blobs WHERE suffix = 'kv' AND block_height BETWEEN {SCAN_LO} AND {SCAN_HI}"),
    "expire_blobs": with_calls(
        f"SELECT receipt_id, suffix, block_height FROM blobs WHERE block_timestamp // 1000 > {EXPIRE_CUTOFF_US}"),
    "kv_history": with_calls(f"SELECT {KV_COLS} FROM kv"),
    "kv_last": with_calls(f"SELECT {KV_COLS} FROM kv_last"),
    "kv_reverse": with_calls(f"SELECT {REVERSE_COLS} FROM kv_last"),
    "all_accounts": with_calls(ACCOUNTS),
    "kv_by_block": with_calls(BY_BLOCK),
    "kv_accounts": with_calls("SELECT current_account_id, key, predecessor_id FROM kv_last"),
    "kv_edges": with_calls("SELECT * FROM kv_edges"),
    "mv_kv_key": with_calls(f"SELECT {KV_COLS} FROM kv"),
    "mv_kv_cur_key": with_calls(f"SELECT {KV_COLS} FROM kv"),
    "kv_last_incremental": with_calls(f"SELECT {KV_COLS} FROM kv_last"),
    "raw_standard": with_calls(f"SELECT {PROV}, data FROM blobs WHERE suffix = 'raw'"),
    "get_latest": with_calls(
        f"SELECT {KV_COLS} FROM kv_last WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        "AND key = 'click'"),
    "list_keys": with_calls(
        f"SELECT {KV_COLS} FROM kv_last WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT}"),
    "key_history": with_calls(
        f"SELECT {KV_COLS} FROM kv WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        "AND key = 'graph/follow/user3.near'"),
    "key_prefix": with_calls(
        f"SELECT {KV_COLS} FROM kv_last WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        "AND starts_with(key, 'graph/')"),
    "predecessors_page": with_calls(
        f"SELECT {REVERSE_COLS} FROM kv_last WHERE current_account_id = {CONTRACT} AND key = 'click' "
        "AND predecessor_id > 'user1.near' ORDER BY predecessor_id LIMIT 5"),
    "followers": with_calls("SELECT source FROM kv_edges WHERE edge_type = 'graph/follow' AND target = 'user3.near'"),
    "contract_accounts": with_calls(
        "SELECT current_account_id, key, predecessor_id FROM kv_last WHERE current_account_id = 'app2.near'"),
    "timeline": with_calls(
        f"SELECT * FROM ({BY_BLOCK}) WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT}"),
    "key_across_accounts": with_calls(f"SELECT {KV_COLS} FROM kv WHERE key = 'view'"),
    "contract_history": with_calls(
        f"SELECT {KV_COLS} FROM kv WHERE current_account_id = 'app0.near' AND key = 'purchase'"),
    "account_registry": with_calls(ACCOUNTS),
    "file_chunks": with_files(f"SELECT {CHUNK_COLS} FROM chunks"),
    "file_list": with_files(
        "SELECT DISTINCT relative_path FROM chunks WHERE predecessor_id = 'src3' AND current_account_id = 'en.fs.near'"),
    "file_uploads": with_files(
        f"SELECT {CHUNK_COLS} FROM chunks WHERE predecessor_id = 'src3' AND current_account_id = 'en.fs.near' "
        "AND relative_path = 'src3/en/243.txt'"),
    "upload_chunks": with_files(
        f"SELECT {CHUNK_COLS} FROM chunks WHERE predecessor_id = 'src3' AND current_account_id = 'en.fs.near' "
        "AND relative_path = 'src3/en/243.txt' AND nonce = 244"),
    "file_assemble": with_files("""SELECT pred AS predecessor_id, contract AS current_account_id, relative_path,
       CAST(CASE WHEN nchunks = 1 THEN 0 ELSE doc_id + 1 END AS INTEGER) AS nonce, 'text/plain' AS mime_type,
       CAST(n AS INTEGER) AS full_size, CAST(nchunks AS INTEGER) AS n_chunks, true AS complete,
       md5(bytes) AS content_md5
FROM valid WHERE (nchunks = 1 AND doc_id % 20 <> 0) OR (nchunks > 1)"""),
    "path_checks": f"""SELECT page_id, relative_path, COALESCE({PATH_OK.format(p='relative_path')}, false) AS is_valid
FROM (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/(.*)$', 1) AS relative_path FROM pages)""",
    "mime_checks": """SELECT page_id, CASE page_id % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false
  WHEN 3 THEN true WHEN 4 THEN false
  ELSE coalesce(length(url) BETWEEN 1 AND 256 AND regexp_full_match(url, '[ -~]+'), false) END AS is_valid
FROM pages""",
    "reject_report": REJECTS,
    "reject_records": REJECT_RECORDS,
    "timeline_range": with_calls(
        f"SELECT * FROM ({BY_BLOCK}) WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        f"AND block_height BETWEEN {SCAN_LO} AND {SCAN_HI}"),
    "file_list_live": with_files(
        "SELECT DISTINCT relative_path FROM chunks WHERE predecessor_id = 'src0' AND current_account_id = 'en.fs.near' "
        "AND (content_md5 IS NOT NULL OR nonce > 0)"),
    "throughput": with_calls("""SELECT block_timestamp // 3600000000000 * 3600000000000 AS window_start_ns,
       count(DISTINCT block_height) AS n_blocks, count(*) AS n_calls
FROM calls GROUP BY 1"""),
    "checkpoint_lag": with_calls(f"""SELECT suffix, last_processed_block_height, head_height,
       head_height - last_processed_block_height AS lag_blocks
FROM (SELECT 'kv' AS suffix, (SELECT max(block_height) FROM blobs WHERE block_height <= {SCAN_HI})
               AS last_processed_block_height
      UNION ALL
      SELECT 'raw', (SELECT max(block_height) FROM blobs)) m,
     (SELECT max(block_height) AS head_height FROM blobs) h"""),
    "stalls": with_calls(f"""SELECT suffix, CAST(2 AS BIGINT) AS reading_ts_us, last_processed_block_height,
       (SELECT max(block_height) FROM blobs WHERE block_height <= {SCAN_HI}) AS previous_height, stalled
FROM (SELECT 'kv' AS suffix, (SELECT max(block_height) FROM blobs WHERE block_height <= {SCAN_HI})
               AS last_processed_block_height, true AS stalled
      UNION ALL SELECT 'raw', (SELECT max(block_height) FROM blobs), false
      UNION ALL SELECT '*', (SELECT max(block_height) FROM blobs), false) m"""),
    "malformed_blocks": f"""SELECT 'call' AS kind, count(*) AS n FROM ({FLATTEN}) WHERE block_height % 10 <> 3
UNION ALL
SELECT 'malformed_block', count(DISTINCT o_orderkey // 32) FROM orders WHERE (100000000 + o_orderkey // 32) % 10 = 3""",
    "validated_rows": with_calls("""SELECT receipt_id, CASE CAST(substr(receipt_id, 5) AS BIGINT) % 50
       WHEN 7 THEN 'negative_shard_id' WHEN 9 THEN 'missing_signer_id' ELSE 'ok' END AS reason FROM blobs"""),
    "late_blobs_indexed": with_calls(f"SELECT {KV_COLS} FROM kv"),
    "kv_value_text": """SELECT 'rcpt' || CAST(event_id AS VARCHAR) AS receipt_id, 'v' AS key, t.value AS value
FROM events JOIN (VALUES (0, '1.0'), (1, '-0.0'), (2, '1e16'), (3, '1e-7'), (4, '0.1'), (5, '-1.5'),
  (6, '1.2345678901234568e29'), (7, '18446744073709551615'), (9, '[1.0,{"a":null,"b":2.5}]'), (10, '"xé/"'), (11, 'true'),
  (12, '1e20'), (13, '5e-324'), (14, '1000000000000000.0'), (15, '0.00001'), (16, '1e-6'),
  (19, '-9223372036854775808')) t(nth, value) ON event_id % 20 = nth""",
    "reject_reasons": """WITH k AS (
  SELECT *, event_id % 40 AS f, event_id % 40 IN (3, 5, 7, 9, 11, 13, 17) AS faulty FROM events),
r AS (
  SELECT 'route' AS stage, 'invalid_suffix' AS reason FROM k WHERE NOT faulty AND event_type = 'error' AND event_id % 4 <> 2
  UNION ALL SELECT 'kv_blob', 'not_object' FROM k WHERE f <> 3 AND f <> 5 AND f <> 7 AND f <> 11 AND f <> 13 AND f <> 17
      AND event_id % 50 = 0 AND (faulty OR event_type NOT IN ('error', 'signup'))
  UNION ALL SELECT 'kv_blob', 'invalid_json' FROM k WHERE f IN (13, 17) OR (event_id % 50 = 1
      AND f NOT IN (3, 5, 7, 11) AND (faulty OR event_type NOT IN ('error', 'signup')))
  UNION ALL SELECT 'kv_blob', 'too_many_keys' FROM k WHERE f = 3
  UNION ALL SELECT 'kv_blob', 'order_id_overflow' FROM k WHERE f = 9 AND event_id % 50 NOT IN (0, 1)
  UNION ALL SELECT 'kv_key', 'invalid_key' FROM k WHERE f IN (5, 11)
  UNION ALL SELECT 'kv_key', 'key_too_long' FROM k WHERE f = 7
  UNION ALL SELECT 'files', CASE doc_id % 10 WHEN 1 THEN 'undecodable' WHEN 2 THEN 'invalid_simple'
      ELSE 'invalid_partial' END FROM documents WHERE doc_id % 10 IN (1, 2, 3))
SELECT stage, reason, count(*) AS n FROM r GROUP BY 1, 2""",
    "stored_get_latest": with_calls(
        f"SELECT {KV_COLS} FROM kv_last WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        "AND key = 'click'"),
    "stored_key_history": with_calls(
        f"SELECT {KV_COLS} FROM kv WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        "AND key = 'graph/follow/user3.near'"),
    "stored_predecessors": with_calls(
        f"SELECT {REVERSE_COLS} FROM kv_last WHERE current_account_id = {CONTRACT} AND key = 'click' "
        "AND predecessor_id > 'user1.near' ORDER BY predecessor_id LIMIT 5"),
    "stored_followers": with_calls(
        "SELECT source FROM kv_edges WHERE edge_type = 'graph/follow' AND target = 'user3.near'"),
    "stored_timeline": with_calls(
        f"SELECT * FROM ({BY_BLOCK}) WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT}"),
    "stored_key_across_accounts": with_calls(f"SELECT {KV_COLS} FROM kv WHERE key = 'view'"),
    "stored_contract_history": with_calls(
        f"SELECT {KV_COLS} FROM kv WHERE current_account_id = 'app0.near' AND key = 'purchase'"),
    "merged_last": with_calls(f"SELECT {KV_COLS} FROM kv_last"),
    "merged_edges": with_calls("SELECT * FROM kv_edges"),
    "new_accounts": with_calls(f"""SELECT DISTINCT current_account_id, key, predecessor_id FROM kv WHERE block_height > {SCAN_HI}
EXCEPT SELECT current_account_id, key, predecessor_id FROM kv WHERE block_height <= {SCAN_HI}"""),
    "published_list_keys": with_calls(
        f"SELECT {KV_COLS} FROM kv_last WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT}"),
    "published_key_prefix": with_calls(
        f"SELECT {KV_COLS} FROM kv_last WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        "AND starts_with(key, 'graph/')"),
    "published_predecessors_page": with_calls(
        f"SELECT {REVERSE_COLS} FROM kv_last WHERE current_account_id = {CONTRACT} AND key = 'click' "
        "AND predecessor_id > 'user1.near' ORDER BY predecessor_id LIMIT 5"),
    "published_contract_accounts": with_calls(
        "SELECT current_account_id, key, predecessor_id FROM kv_last WHERE current_account_id = 'app2.near'"),
    "published_timeline_range": with_calls(
        f"SELECT * FROM ({BY_BLOCK}) WHERE predecessor_id = {PRED} AND current_account_id = {CONTRACT} "
        f"AND block_height BETWEEN {SCAN_LO} AND {SCAN_HI}"),
    "published_account_registry": with_calls(ACCOUNTS),
    "published_file_list": with_files(
        "SELECT DISTINCT relative_path FROM chunks WHERE predecessor_id = 'src3' AND current_account_id = 'en.fs.near'"),
    "published_file_uploads": with_files(
        f"SELECT {CHUNK_COLS} FROM chunks WHERE predecessor_id = 'src3' AND current_account_id = 'en.fs.near' "
        "AND relative_path = 'src3/en/243.txt'"),
    "published_upload_chunks": with_files(
        f"SELECT {CHUNK_COLS} FROM chunks WHERE predecessor_id = 'src3' AND current_account_id = 'en.fs.near' "
        "AND relative_path = 'src3/en/243.txt' AND nonce = 244"),
    "block_call_counts": with_calls(f"""SELECT block_height, CAST(count(*) FILTER (suffix = 'raw') AS BIGINT) AS n_calls
FROM blobs GROUP BY 1 HAVING count(*) FILTER (suffix = 'raw') > 0 OR block_height IN (
  (SELECT max(block_height) FROM blobs), (SELECT max(block_height) FROM blobs WHERE block_height <= {SCAN_HI}))"""),
    "stream_state_last": with_calls(f"SELECT {KV_COLS} FROM kv_last"),
    "stream_state_history": with_calls(f"SELECT {KV_COLS} FROM kv"),
    "late_files_ingested": f"""SELECT receipt_id, action_index, substr(method_name, 12) AS suffix, block_height // 10000 AS block_height_bucket,
       args AS data, tx_hash, signer_id, predecessor_id, current_account_id, block_height, block_timestamp, shard_id, receipt_index
FROM ({FLATTEN}) WHERE block_height >= 100000010""",
    "stream_kv_last": with_calls(f"SELECT {KV_COLS} FROM kv_last"),
    "stream_kv_edges": with_calls("SELECT * FROM kv_edges"),
    "stream_files": with_files(f"SELECT {CHUNK_COLS} FROM chunks"),
}
