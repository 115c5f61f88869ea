"""SQL over the same tables, for each registered query."""

from __future__ import annotations

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_CUSTOMER = "c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment"
_LINES = (
    "l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_PART = "p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice"
_CONVERSATIONS = "conv_id, turn, role, text"


def _shard(text: str, shards: int) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {shards} + 1"


def _last_line(key: str, order: str) -> str:
    return f"""
    SELECT {_LINES} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM lineitem
    ) WHERE rn = 1"""


_DAMAGED = f"""
damaged AS (
  SELECT CASE WHEN value <= 300 THEN event_id END AS event_id, ts, user_id,
         CASE WHEN value >= 0.2 THEN event_type END AS event_type, value, props,
         event_id AS seq, event_type AS part
  FROM events),
numbered AS (
  SELECT *, event_id IS NULL OR event_type IS NULL AS bad,
         CAST((row_number() OVER (PARTITION BY part ORDER BY ts, seq) - 1) // 25 AS BIGINT) AS batch,
         CASE WHEN event_id IS NOT NULL THEN {_shard('CAST(event_id AS VARCHAR)', 4)} END AS shard
  FROM damaged),
first_bad AS (SELECT part, min(batch) AS first_bad FROM numbered WHERE bad GROUP BY part),
hit AS (SELECT DISTINCT part, batch, shard FROM numbered WHERE bad AND shard IS NOT NULL)"""


def _statuses(stop: bool, rollback: bool) -> str:
    return f"""{_DAMAGED},
planned AS (
  SELECT n.*, CASE WHEN bad THEN 'rejected'
              WHEN {str(stop).upper()} AND n.batch > f.first_bad THEN 'skipped'
              WHEN {str(rollback).upper()} AND h.shard IS NOT NULL THEN 'rolled_back'
              ELSE 'written' END AS status
  FROM numbered n LEFT JOIN first_bad f ON n.part = f.part
  LEFT JOIN hit h ON n.part = h.part AND n.batch = h.batch AND n.shard = h.shard)"""


def _plan(stop: bool, rollback: bool) -> str:
    return f"WITH {_statuses(stop, rollback)} SELECT seq, part AS write_part, batch, shard, status FROM planned"


def _written(stop: bool, rollback: bool) -> str:
    return f"""WITH {_statuses(stop, rollback)}
    SELECT event_id, ts, user_id, event_type, value, props, seq, part FROM planned WHERE status = 'written'"""


_COUNTS = ", ".join(
    f"count(CASE WHEN status = '{s}' THEN 1 END) AS {s}" for s in ("written", "rejected", "rolled_back", "skipped")
)

_RETURNED = """
returned AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
upserted AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE 'R' END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders LEFT JOIN returned ON o_orderkey = l_orderkey
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'F')"""


def _unchanged(columns: str, old: str, new: str) -> str:
    return columns.replace(old, f"{new} AS {old}")


ORACLES: dict[str, str] = {
    "scan_customer": f"SELECT {_CUSTOMER} FROM customer",
    "scan_partitioned": """
        SELECT CAST(count(*) AS BIGINT) AS n_events, CAST(8 AS BIGINT) AS n_ranges, CAST(0 AS BIGINT) AS n_overlaps
        FROM events""",
    "scan_user_schema": """
        SELECT CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
               CAST(NULL AS VARCHAR) AS o_note, CAST(o_custkey AS INTEGER) AS o_custkey
        FROM orders""",
    "scan_required_columns": "SELECT o_orderdate, o_orderkey FROM orders",
    "scan_converter": """
        SELECT doc_id, split_part(text, chr(10), 1) AS title,
               CAST(length(text) - length(replace(text, ' ', '')) + 1 AS BIGINT) AS n_words
        FROM documents""",
    "scan_converter_factory": """
        SELECT doc_id, CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits FROM documents""",
    "scan_record_converter": "SELECT s_suppkey AS id, s_name || '/' || s_nationkey AS label FROM supplier",
    "scan_converter_nulls": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN (CAST(1 AS BIGINT) << 60) + o_orderkey + 1 END AS n
        FROM orders""",
    "empty_probe": """
        SELECT 'created' AS step, TRUE AS is_empty, CAST(0 AS BIGINT) AS n_rows
        UNION ALL SELECT 'loaded', count(*) = 0, count(*) FROM orders
        UNION ALL SELECT 'truncated', TRUE, 0""",
    "schema_discovery": """
        SELECT 'event_id' AS field, 'bigint' AS type, count(event_id) AS n_values FROM events
        UNION ALL SELECT 'ts', 'timestamp', count(ts) FROM events
        UNION ALL SELECT 'user_id', 'bigint', count(user_id) FROM events
        UNION ALL SELECT 'event_type', 'string', count(event_type) FROM events
        UNION ALL SELECT 'value', 'double', count(value) FROM events
        UNION ALL SELECT 'props', 'string', count(props) FROM events""",
    "cond_any": f"SELECT {_CONVERSATIONS} FROM conversations",
    "cond_gt": f"SELECT {_ORDERS} FROM orders WHERE o_custkey > 75",
    "cond_gt_number": f"SELECT {_ORDERS} FROM orders WHERE o_orderkey > 700",
    "cond_gt_composite": f"SELECT {_CONVERSATIONS} FROM conversations WHERE (conv_id, turn) > (4, 2)",
    "cond_limit": f"SELECT {_ORDERS} FROM orders WHERE o_custkey > 20 ORDER BY o_custkey, o_orderkey LIMIT 100",
    "page_orders": f"""
        SELECT {_ORDERS} FROM orders WHERE o_orderkey > 100 AND o_orderkey > 120 ORDER BY o_orderkey LIMIT 50""",
    "page_follow": """
        SELECT CAST((rn - 1) // 40 AS INTEGER) AS page, o_custkey, o_orderkey FROM (
          SELECT *, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS rn FROM orders) WHERE rn <= 80""",
    "page_by_time": """
        SELECT event_id, ts, CAST(place // 60 AS INTEGER) AS page FROM (
          SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS place FROM events)
        WHERE place BETWEEN 180 AND 359""",
    "index_order": """
        SELECT CAST(row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS INTEGER) AS place, o_custkey, o_orderkey
        FROM (SELECT * FROM orders WHERE o_custkey > 40 AND (o_custkey > 45 OR (o_custkey = 45 AND o_orderkey > 0))
              ORDER BY o_custkey, o_orderkey LIMIT 150)""",
    "page_walk": """
        SELECT event_id, user_id,
               CAST((row_number() OVER (ORDER BY user_id, event_id) - 1) // 1000 AS BIGINT) AS page
        FROM events""",
    "names_none": """
        SELECT o_orderkey AS "orderKey", o_custkey AS "custKEYNumber", o_orderstatus AS "Order_Status",
               o_totalprice AS "totalPrice", o_orderdate AS "_orderDate", o_orderpriority AS "order1Priority"
        FROM orders""",
    "names_lower": """
        SELECT o_orderkey AS orderkey, o_custkey AS custkeynumber, o_orderstatus AS order_status,
               o_totalprice AS totalprice, o_orderdate AS _orderdate, o_orderpriority AS order1priority
        FROM orders""",
    "names_upper": """
        SELECT o_orderkey AS "ORDERKEY", o_custkey AS "CUSTKEYNUMBER", o_orderstatus AS "ORDER_STATUS",
               o_totalprice AS "TOTALPRICE", o_orderdate AS "_ORDERDATE", o_orderpriority AS "ORDER1PRIORITY"
        FROM orders""",
    "names_snake": """
        SELECT o_orderkey AS order_key, o_custkey AS cust_key_number, o_orderstatus AS order_status,
               o_totalprice AS total_price, o_orderdate AS _order_date, o_orderpriority AS order1priority
        FROM orders""",
    "records_by_name": """
        SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS p_comment, p_retailprice
        FROM part""",
    "records_by_position": """
        SELECT p_partkey, p_brand AS p_name, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS p_comment,
               CAST(NULL AS DOUBLE) AS p_retailprice
        FROM part""",
    "normalise_array": """
        SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS place,
               CAST(unnest(embedding) AS DOUBLE) AS value
        FROM embeddings""",
    "normalise_map": """
        SELECT event_id, CAST(1 AS INTEGER) AS n_props, regexp_extract(props, '"k": ([0-9]+)', 1) AS k FROM events""",
    "normalise_nested": """
        SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS place,
               CAST(turn AS VARCHAR) AS turn, role, text, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words
        FROM conversations""",
    "normalise_scalars": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CAST(l_quantity AS BIGINT) AS l_quantity, CAST(l_extendedprice AS DECIMAL(15, 2)) AS l_extendedprice,
               l_discount, l_shipdate
        FROM lineitem""",
    "append_upsert": f"WITH {_RETURNED} SELECT {_ORDERS} FROM upserted",
    "replace_many": f"WITH {_RETURNED} SELECT o_orderstatus, count(*) AS n_rows FROM upserted GROUP BY o_orderstatus",
    "overwrite_replace": f"SELECT {_ORDERS} FROM orders WHERE o_orderstatus <> 'O'",
    "error_if_exists": """
        SELECT 1 AS try, 'written' AS outcome, 'load 1' AS priority, count(*) AS n_rows FROM orders
        UNION ALL SELECT 2, 'already exists', 'load 1', count(*) FROM orders
        UNION ALL SELECT 3, 'written', 'load 3', count(*) FROM orders""",
    "ignore_mode": f"SELECT {_unchanged(_ORDERS, 'o_orderpriority', chr(39) + 'load 1' + chr(39))} FROM orders",
    "truncate_space": """
        SELECT o_orderkey * 2 + 1 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "last_wins": _last_line("l_orderkey, l_linenumber", "l_shipdate DESC, l_partkey DESC, l_suppkey DESC"),
    "last_wins_hot_keys": _last_line(
        "l_returnflag, l_linestatus",
        "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_orderkey DESC, l_linenumber DESC",
    ),
    "insert_strict": f"""
        SELECT {_unchanged(_ORDERS, 'o_orderpriority',
                           "CASE WHEN o_orderstatus = 'O' THEN 'inserted' ELSE o_orderpriority END")}
        FROM orders""",
    "insert_strict_rollback": f"""
        WITH numbered AS (
          SELECT *, o_totalprice > 450000 AS bad, {_shard('CAST(o_orderkey AS VARCHAR)', 4)} AS shard,
                 (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 20 AS batch
          FROM orders),
        hit AS (SELECT DISTINCT o_orderstatus, batch, shard FROM numbered WHERE bad)
        SELECT o_orderkey, o_orderpriority FROM orders WHERE o_totalprice > 450000
        UNION ALL
        SELECT n.o_orderkey, 'inserted' FROM numbered n LEFT JOIN hit h
          ON n.o_orderstatus = h.o_orderstatus AND n.batch = h.batch AND n.shard = h.shard
        WHERE NOT n.bad AND h.shard IS NULL""",
    "insert_into": f"SELECT {_unchanged(_CUSTOMER, 'c_name', 'upper(c_name)')} FROM customer",
    "batch_numbers": """
        SELECT event_id, event_type AS write_part,
               CAST((row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 100 AS BIGINT) AS batch
        FROM events""",
    "batch_stop": _plan(True, True),
    "batch_continue": _plan(False, True),
    "batch_stop_no_rollback": _plan(True, False),
    "batch_no_rollback": _plan(False, False),
    "batch_counts": f"""
        WITH {_statuses(True, True)}
        SELECT part AS write_part, batch, count(*) AS expected, {_COUNTS} FROM planned GROUP BY part, batch""",
    "write_stop": _written(True, True),
    "write_continue": _written(False, True),
    "write_report": f"""
        WITH {_statuses(False, True)},
        totals AS (SELECT {_COUNTS.replace(' AS ', ' AS all_')} FROM planned),
        per_batch AS (SELECT part AS write_part, batch, count(*) AS expected, {_COUNTS} FROM planned GROUP BY part, batch),
        reasons AS (
          SELECT concat_ws('; ', 'field 1 (event_id): expected unsigned, got nil: ' || count(CASE WHEN event_id IS NULL THEN 1 END),
                           'field 4 (event_type): expected string, got nil: ' || count(CASE WHEN event_type IS NULL THEN 1 END))
                 AS reasons
          FROM planned)
        SELECT * FROM per_batch, totals, reasons""",
    "validate_events": f"""
        WITH {_DAMAGED}
        SELECT seq, concat_ws('; ',
                 CASE WHEN event_id IS NULL THEN 'field 1 (event_id): expected unsigned, got nil' END,
                 CASE WHEN event_type IS NULL THEN 'field 4 (event_type): expected string, got nil' END) AS violations
        FROM damaged""",
    "validate_types": """
        SELECT c_custkey, concat_ws('; ',
                 CASE WHEN trunc(c_acctbal) <> c_acctbal THEN 'field 2 (c_acctbal): expected unsigned, got double'
                      WHEN c_acctbal < 0 THEN 'field 2 (c_acctbal): expected unsigned, got a negative number' END,
                 'field 3 (c_name): expected integer, got string') AS violations
        FROM (SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN floor(c_acctbal) ELSE c_acctbal END AS c_acctbal
              FROM customer)""",
    "shard_ids": f"""
        SELECT o_orderkey, {_shard('CAST(o_orderkey AS VARCHAR)', 16)} AS bucket_id, o_custkey FROM orders""",
    "shard_composite": f"""
        SELECT conv_id, turn, {_shard("CAST(conv_id AS VARCHAR) || '|' || CAST(turn AS VARCHAR)", 8)} AS shard
        FROM conversations""",
    "scan_partitioner": """SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_orderkey <= 100 THEN 0
          WHEN o_orderkey <= 100 + (last - 100) // 10 THEN 1 ELSE 2 END AS INTEGER) AS part
        FROM orders, (SELECT max(o_orderkey) AS last FROM orders)""",
    "limit_half": """WITH one AS (
          SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL),
        placed AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS place FROM one)
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM placed WHERE place <= (SELECT count(*) // 2 FROM one)""",
    "page_stream": """WITH placed AS (
          SELECT *, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS place FROM orders)
        SELECT place // 500 AS page, count(*) AS n_rows,
          arg_min(o_custkey, place) AS first_customer, arg_min(o_orderkey, place) AS first_order,
          arg_max(o_custkey, place) AS last_customer, arg_max(o_orderkey, place) AS last_order
        FROM placed GROUP BY 1""",
    "read_format": """SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)""",
    "read_format_all": "SELECT * FROM events",
    "read_format_precedence": "SELECT c_custkey, c_name FROM customer",
    "unique_conflicts": "SELECT p_name, count(*) AS n_rows FROM part GROUP BY p_name HAVING count(*) > 1",
    "unique_index_load": f"""
        SELECT {_PART} FROM (
          SELECT *, row_number() OVER (
            PARTITION BY p_name ORDER BY CASE WHEN p_size > 25 THEN 0 ELSE 1 END, p_partkey) AS rn
          FROM part) WHERE rn = 1""",
    "unique_index_replace": f"""
        WITH first AS (
          SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part WHERE p_size > 25),
        held AS (SELECT * FROM first WHERE rn = 1 AND p_partkey % 2 = 1),
        renamed AS (SELECT * REPLACE ('renamed ' || p_partkey AS p_name) FROM part WHERE p_size > 25 AND p_partkey % 2 = 0),
        asking AS (
          SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part
          WHERE p_size <= 25 AND p_name NOT IN (SELECT p_name FROM held))
        SELECT {_PART} FROM held UNION ALL SELECT {_PART} FROM renamed UNION ALL SELECT {_PART} FROM asking WHERE rn = 1""",
    "unique_two_indexes": f"""
        WITH RECURSIVE p AS (
          SELECT row_number() OVER (ORDER BY p_partkey) AS i, p_partkey, p_name, p_brand || '|' || p_size AS pair FROM part),
        s(i, names, pairs, keys) AS (
          SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST([] AS BIGINT[])
          UNION ALL
          SELECT p.i,
                 CASE WHEN list_contains(names, p_name) OR list_contains(pairs, pair) THEN names ELSE list_append(names, p_name) END,
                 CASE WHEN list_contains(names, p_name) OR list_contains(pairs, pair) THEN pairs ELSE list_append(pairs, pair) END,
                 CASE WHEN list_contains(names, p_name) OR list_contains(pairs, pair) THEN keys ELSE list_append(keys, p_partkey) END
          FROM s JOIN p ON p.i = s.i + 1)
        SELECT {_PART} FROM part WHERE p_partkey IN (SELECT unnest(keys) FROM (SELECT keys FROM s ORDER BY i DESC LIMIT 1))""",
    "unique_stop": f"""
        WITH p AS (
          SELECT *, (row_number() OVER (ORDER BY p_partkey) - 1) // 7 AS batch,
                 row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part)
        SELECT {_PART} FROM p
        WHERE rn = 1 AND batch <= coalesce((SELECT min(batch) FROM p WHERE rn > 1), (SELECT max(batch) FROM p))""",
    "unique_rollback": f"""
        WITH RECURSIVE p AS (
          SELECT (row_number() OVER (ORDER BY p_partkey) - 1) // 7 AS batch, p_partkey, p_name FROM part),
        b AS (
          SELECT batch, list(p_name ORDER BY p_partkey) AS asked, count(DISTINCT p_name) < count(*) AS twice FROM p GROUP BY batch),
        s(batch, names, done) AS (
          SELECT CAST(-1 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS BIGINT[])
          UNION ALL
          SELECT b.batch,
                 CASE WHEN twice OR list_has_any(names, asked) THEN names ELSE list_concat(names, asked) END,
                 CASE WHEN twice OR list_has_any(names, asked) THEN done ELSE list_append(done, b.batch) END
          FROM s JOIN b ON b.batch = s.batch + 1),
        kept AS (SELECT unnest(done) AS batch FROM (SELECT done FROM s ORDER BY batch DESC LIMIT 1))
        SELECT {_PART} FROM part JOIN p USING (p_partkey, p_name) WHERE batch IN (SELECT batch FROM kept)""",
    "insert_strict_after_rollback": """
        WITH n AS (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place FROM orders),
        b AS (
          SELECT *, place // 4 AS batch, max(CASE WHEN place % 8 = 2 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY o_custkey, place // 4) AS undone FROM n)
        SELECT o_orderkey, o_orderstatus, CASE WHEN undone = 1 THEN 'second' ELSE o_orderpriority END AS o_orderpriority
        FROM b""",
    "load_from_sql": """
        SELECT c_custkey AS cust_key, c_name AS cust_name, r_name AS region_name, n_name AS nation_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "load_from_orc": """
        SELECT CAST(o_orderkey + CAST('0.271828182845904523' AS DECIMAL(38, 18)) AS DECIMAL(38, 18)) AS amount,
               CAST(CAST(o_totalprice * 100 AS DECIMAL(20, 0)) AS DECIMAL(38, 18)) AS serial, TRUE AS has_bucket
        FROM orders""",
    "option_precedence": """
        SELECT source, batch_size, CAST(ceil(n / batch_size) AS BIGINT) AS n_batches
        FROM (VALUES ('default', CAST(1000 AS BIGINT)), ('session, long name', 40), ('session', 20),
                     ('call, long name', 15), ('call', 10)) AS s(source, batch_size),
             (SELECT count(*) AS n FROM events)""",
}
