"""The same results as ANSI SQL for an independent engine, by query name."""

CENTS = "CAST(round(value * 100) AS BIGINT)"
ORIGIN = "TIMESTAMP '2024-01-01 00:00:00'"
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"

DIRTY = """
    SELECT event_id, CAST(0 AS INTEGER) AS shape, event_type || ':' || event_id AS value FROM events
    UNION ALL
    SELECT event_id, 1, CASE event_id % 8
        WHEN 1 THEN ' ' || event_type || ' :' || event_id || ':x'
        WHEN 2 THEN event_type
        WHEN 3 THEN ':' || event_id
        WHEN 4 THEN '  '
        WHEN 5 THEN event_type || chr(9) || ':' || event_id
        WHEN 6 THEN chr(9) || event_type || chr(13) || chr(10)
    END AS value FROM events"""

SNAPSHOT = """
    SELECT event_type, CAST(event_id AS VARCHAR) AS count_text, event_id AS event_count FROM events
    UNION ALL
    SELECT event_type, CASE event_id % 8
        WHEN 3 THEN 'x' || event_id
        WHEN 6 THEN '-' || event_id
        ELSE CAST(event_id AS VARCHAR) END,
    CASE event_id % 8
        WHEN 3 THEN NULL
        WHEN 6 THEN -event_id
        ELSE event_id END
    FROM events WHERE event_id % 8 IN (3, 5, 6)"""

# The second field of any line with a tab, nothing stripped.
SNAPSHOT_LOOSE = """
    SELECT event_type, CAST(event_id AS VARCHAR) AS count_text, event_id AS event_count FROM events
    UNION ALL
    SELECT CASE event_id % 8 WHEN 5 THEN '  ' || event_type ELSE event_type END, CASE event_id % 8
        WHEN 3 THEN 'x' || event_id
        WHEN 5 THEN event_id || ' '
        WHEN 6 THEN '-' || event_id
        ELSE CAST(event_id AS VARCHAR) END,
    CASE event_id % 8
        WHEN 3 THEN NULL
        WHEN 6 THEN -event_id
        ELSE event_id END
    FROM events WHERE event_id % 8 IN (1, 3, 5, 6)"""

CSV = f"""
    SELECT event_type, event_id + 1700000000 AS ts, {CENTS} AS cents, NULL AS bad FROM events
    UNION ALL
    SELECT event_type, event_id + 1700000000, NULL, NULL FROM events WHERE event_id % 10 = 3
    UNION ALL
    SELECT event_type, NULL, NULL, CASE event_id % 10 WHEN 7 THEN 'value' ELSE '<line>' END
    FROM events WHERE event_id % 10 IN (1, 2, 7)
    UNION ALL
    SELECT 'event_type', NULL, NULL, unnest(['value', 'timestamp']) FROM events WHERE event_id % 10 = 5"""

COUNTS = "SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type"

GENERATED = "SELECT 'event_type_' || (event_id % 5) AS event_type, count(*) AS event_count FROM events GROUP BY 1"

CLOSED_FORM = """
    SELECT 'event_type_' || i AS event_type,
        CAST(n // 5 + CASE WHEN i < n % 5 THEN 1 ELSE 0 END AS BIGINT) AS event_count
    FROM (SELECT count(*) AS n FROM events), range(5) AS r(i)"""

RUNS = f"""
    SELECT user_id AS submission, user_id || '-' || event_type AS id, event_type AS name,
        sum({CENTS}) < count(*) * 5000 AS passed,
        count(*) AS rows_processed,
        (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS elapsed_ms,
        (epoch_us(min(ts)) - epoch_us({ORIGIN})) // 1000 AS latency_ms,
        (epoch_us(max(ts)) - epoch_us({ORIGIN})) // 1000 AS baseline_time_ms
    FROM events GROUP BY user_id, event_type"""

DETAIL = """CASE rule
            WHEN 1 THEN 'file exists' WHEN 2 THEN 'document parses' WHEN 3 THEN 'top level is an object'
            WHEN 4 THEN 'required fields present' WHEN 5 THEN 'scenarios is an array'
            WHEN 6 THEN 'element is an object' WHEN 7 THEN 'id is a string' WHEN 8 THEN 'id is unique'
            WHEN 9 THEN 'passed is a boolean' WHEN 10 THEN 'elapsed_ms is an integer'
            WHEN 11 THEN 'scenarios_passed is the number of passed runs'
            WHEN 12 THEN 'penalty_ms is the time of the failed runs' END"""

VIOLATIONS = f"""
    SELECT event_id AS submission, event_id % 17 AS kind, {CENTS} AS ms FROM events"""

ROLLUP = """
    count(*) FILTER (WHERE passed) AS scenarios_passed,
    count(*) AS scenarios_total,
    CAST(coalesce(sum(elapsed_ms) FILTER (WHERE NOT passed), 0) AS BIGINT) AS penalty_ms,
    CAST(coalesce(sum(elapsed_ms), 0) AS BIGINT) AS total_elapsed_ms"""


def _digest(counts: str) -> str:
    lines = "event_type || chr(9) || event_count"
    return f"sha256(string_agg({lines}, chr(10) ORDER BY {lines}) || chr(10)) FROM ({counts})"


def _sums(length: int) -> str:
    """Row count, and sums of every 15 hexadecimal digits of ``h``."""
    sums = [f"CAST(sum(CAST('0x' || substr(h, {s}, 15) AS HUGEINT)) AS VARCHAR)" for s in range(1, length + 1, 15)]
    return "count(*) AS line_count, " + " || '-' || ".join(sums) + " AS digest"


LINEITEM_LINE = """
    l_orderkey || ',' || l_partkey || ',' || l_suppkey || ',' || l_linenumber || ',' ||
    CAST(round(l_quantity * 100) AS BIGINT) || ',' || CAST(round(l_extendedprice * 100) AS BIGINT) || ',' ||
    CAST(round(l_discount * 100) AS BIGINT) || ',' || CAST(round(l_tax * 100) AS BIGINT) || ',' ||
    l_returnflag || ',' || l_linestatus || ',' || epoch_us(l_shipdate)"""

EXACT_LINES = """
    SELECT l_orderkey, l_linenumber, CAST(round(l_quantity * 100) AS BIGINT) AS quantity,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS price, l_linestatus AS line, epoch_us(l_shipdate) AS shipped
    FROM lineitem"""


ORACLES = {
    "stream_job": "SELECT count(*) AS events_injected, count(*) AS events_counted, true AS passed FROM events",
    "partitions_job": """
        SELECT count(*) + count(*) FILTER (WHERE event_id % 10 IN (3, 7)) AS rows_read,
            count(*) + count(*) FILTER (WHERE event_id % 10 = 3) AS rows_processed,
            count(*) FILTER (WHERE event_id % 10 = 7) AS rows_rejected, CAST(4 AS BIGINT) AS shuffle_partitions_used, true AS passed
        FROM events""",
    "all_jobs": """
        SELECT id, name, true AS passed, (SELECT count(*) FROM events) AS worked_off
        FROM (VALUES ('01', 'flink-basic'), ('02', 'spark-batch'), ('03', 'stream-vs-batch'), ('05', 'pipeline')) AS j(id, name)""",
    "submission_violations": f"""
        WITH d AS (SELECT DISTINCT event_id FROM events WHERE event_id % 25 = 0 AND event_id % 17 <> 1), v AS (
            SELECT CAST(event_id AS VARCHAR) AS submission,
                CAST(CASE event_id % 17 WHEN 0 THEN NULL WHEN 9 THEN 8 WHEN 10 THEN 9 WHEN 8 THEN 7 WHEN 12 THEN 10
                    WHEN 13 THEN 11 WHEN 14 THEN 11 WHEN 15 THEN 12 WHEN 16 THEN 12 WHEN 11 THEN 10 ELSE event_id % 17 END AS INTEGER) AS rule
            FROM d
            UNION ALL SELECT 'late-' || event_id, 1 FROM d
        )
        SELECT submission, rule, {DETAIL} AS detail, rule IS NULL AS valid FROM v""",
    "counts_from_now": "SELECT event_type, count(*) AS event_count FROM events WHERE event_id % 2 = 1 GROUP BY event_type",
    "csv_types": f"""
        WITH l AS (
            SELECT event_type, CAST({CENTS} AS VARCHAR) AS value, CAST(event_id + 1700000000 AS VARCHAR) AS timestamp FROM events
            UNION ALL
            SELECT CASE event_id % 10 WHEN 5 THEN 'event_type' ELSE event_type END,
                CASE event_id % 10 WHEN 5 THEN 'value' WHEN 7 THEN 'n' || event_id END,
                CASE event_id % 10 WHEN 5 THEN 'timestamp' ELSE CAST(event_id + 1700000000 AS VARCHAR) END
            FROM events WHERE event_id % 10 IN (3, 5, 7)
        ), c AS (
            SELECT 0 AS position, 'event_type' AS column, event_type AS v FROM l
            UNION ALL SELECT 1, 'value', value FROM l UNION ALL SELECT 2, 'timestamp', timestamp FROM l
        ), t AS (
            SELECT position, "column", tolerance, count(v) AS n, count(*) - count(v) AS empty,
                count(v) FILTER (WHERE NOT regexp_full_match(v, '[0-9]+')) AS texts, min(v) FILTER (WHERE NOT regexp_full_match(v, '[0-9]+')) AS least
            FROM c, (VALUES (0.0::DOUBLE), (0.25::DOUBLE)) AS q(tolerance) GROUP BY ALL
        )
        SELECT CAST(position AS INTEGER) AS position, "column", CASE WHEN texts <= n * tolerance THEN 'bigint' ELSE 'string' END AS type,
            n AS values, empty, CASE WHEN texts <= n * tolerance THEN texts ELSE 0 END AS misfits,
            CASE WHEN texts <= n * tolerance THEN least END AS misfit, tolerance
        FROM t""",
    "idle_keys": """
        WITH g AS (
            SELECT *, coalesce(ts - lag(ts) OVER w > INTERVAL 1 DAY, true) AS begins FROM events
            WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)
        ), n AS (
            SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM g
        )
        SELECT user_id, event_type, min(ts) AS started, max(ts) AS last_seen, count(*) AS event_count,
            max(ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) AS ended
        FROM n GROUP BY user_id, event_type, part""",
    "csv_rejected_lines": f"""
        SELECT CASE event_id % 10
                WHEN 1 THEN event_type || ',' || {CENTS} || ',' || (event_id + 1700000000) || ',more'
                WHEN 2 THEN event_type || ',5'
                WHEN 7 THEN event_type || ',n' || event_id || ',' || (event_id + 1700000000)
                ELSE 'event_type,value,timestamp' END AS line,
            CASE event_id % 10 WHEN 5 THEN 'value,timestamp' WHEN 7 THEN 'value' ELSE '<line>' END AS bad_fields, true AS has_file
        FROM events WHERE event_id % 10 IN (1, 2, 5, 7)""",
    "partitions_used": """
        SELECT count(*) AS groups, CAST(200 AS BIGINT) AS configured, true AS fewer_ran, true AS moved
        FROM (SELECT DISTINCT user_id, event_type FROM events)""",
    "large_document_violations": f"""
        WITH r AS (
            SELECT CAST(row_number() OVER (ORDER BY event_id) AS INTEGER) AS position, event_id % 500 AS kind, event_id,
                CASE event_id % 500 WHEN 7 THEN NULL WHEN 10 THEN NULL WHEN 11 THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS id,
                CASE WHEN event_id % 500 NOT IN (8, 10) THEN event_type <> 'error' END AS passed,
                CASE WHEN event_id % 500 NOT IN (9, 10) THEN {CENTS} ELSE 0 END AS ms
            FROM events
        ), v AS (
            SELECT position, CASE kind WHEN 7 THEN 7 WHEN 8 THEN 9 WHEN 9 THEN 10 ELSE 6 END AS rule,
                CASE kind WHEN 7 THEN CAST(event_id AS VARCHAR) WHEN 8 THEN 'yes' WHEN 9 THEN '1.5' ELSE 'BIGINT' END AS stated,
                NULL AS computed
            FROM r WHERE kind IN (7, 8, 9, 10)
            UNION ALL
            SELECT position, 8, id, NULL
            FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position) AS use FROM r WHERE id IS NOT NULL) WHERE use > 1
            UNION ALL
            SELECT NULL, 11, '0', CAST(count(*) FILTER (WHERE passed) + 1 AS VARCHAR) FROM r
            UNION ALL
            SELECT NULL, 12, '0', CAST(CAST(sum(ms) AS BIGINT) AS VARCHAR) FROM r WHERE NOT passed
        )
        SELECT position, CAST(rule AS INTEGER) AS rule, {DETAIL} AS detail, stated, computed FROM v""",
    "batch_progress": """
        WITH b AS (SELECT event_id % 4 AS batch_id, count(*) AS rows FROM events GROUP BY 1),
        s AS (SELECT *, CAST(coalesce(sum(rows) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
            AS rows_before, sum(rows) OVER () // 2 AS half FROM b)
        SELECT batch_id, rows, rows_before, rows_before < half AND rows_before + rows >= half AS reaches_half, true AS timed FROM s""",
    "counts_from_position": "SELECT event_type, count(*) AS event_count FROM events WHERE event_id % 3 IN (1, 2) GROUP BY event_type",
    "rescaled_counts": COUNTS,
    "lineitem_diff": f"""
        WITH kept AS ({EXACT_LINES}), changed AS (
            SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN price + 100 ELSE price END AS price)
            FROM kept WHERE NOT (l_orderkey % 101 = 0 AND l_linenumber = 2)
            UNION ALL
            SELECT * REPLACE (CAST(l_linenumber + 100 AS INTEGER) AS l_linenumber)
            FROM kept WHERE l_orderkey % 103 = 0 AND l_linenumber = 3
        ), a AS (SELECT *, count(*) AS n FROM kept GROUP BY ALL), b AS (SELECT *, count(*) AS n FROM changed GROUP BY ALL),
        rows AS (
            SELECT l_orderkey, l_linenumber, quantity, price, line, shipped, coalesce(a.n, 0) - coalesce(b.n, 0) AS surplus
            FROM a FULL OUTER JOIN b USING (l_orderkey, l_linenumber, quantity, price, line, shipped)
            WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
        ), by_key AS (
            SELECT l_orderkey, l_linenumber, max({{'q': quantity, 'p': price, 'l': line, 's': shipped}}) FILTER (WHERE surplus > 0) AS l,
                max({{'q': quantity, 'p': price, 'l': line, 's': shipped}}) FILTER (WHERE surplus < 0) AS r,
                CAST(coalesce(sum(surplus) FILTER (WHERE surplus > 0), 0) AS BIGINT) AS kept_rows,
                CAST(coalesce(-sum(surplus) FILTER (WHERE surplus < 0), 0) AS BIGINT) AS copy_rows
            FROM rows GROUP BY l_orderkey, l_linenumber
        )
        SELECT l_orderkey, l_linenumber, l.q AS kept_quantity, l.p AS kept_price, l.l AS kept_line, l.s AS kept_shipped,
            r.q AS copy_quantity, r.p AS copy_price, r.l AS copy_line, r.s AS copy_shipped,
            CASE WHEN copy_rows = 0 THEN 'kept_only' WHEN kept_rows = 0 THEN 'copy_only' ELSE 'different' END AS status,
            kept_rows, copy_rows
        FROM by_key""",
    "stream_batch_tree_diff": """
        WITH s AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
        b AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_id % 50 <> 7 GROUP BY ALL)
        SELECT user_id, event_type, s.n AS stream_event_count, b.n AS batch_event_count,
            CASE WHEN b.n IS NULL THEN 'stream_only' WHEN s.n IS NULL THEN 'batch_only' ELSE 'different' END AS status,
            CAST(s.n IS NOT NULL AS BIGINT) AS stream_rows, CAST(b.n IS NOT NULL AS BIGINT) AS batch_rows
        FROM s FULL OUTER JOIN b USING (user_id, event_type) WHERE s.n IS DISTINCT FROM b.n""",
    "batch_summary": f"""
        SELECT event_type, CAST(sum({CENTS}) AS BIGINT) AS total_cents, count(*) AS event_count,
            max(ts) AS max_ts
        FROM events GROUP BY event_type ORDER BY event_type""",
    "batch_summary_narrow": f"""
        SELECT event_type, CAST(sum({CENTS}) AS BIGINT) AS total_cents, count(*) AS event_count
        FROM events GROUP BY event_type""",
    "summary_by_user_type": f"""
        SELECT user_id, event_type, CAST(sum({CENTS}) AS BIGINT) AS total_cents,
            count(*) AS event_count, max(ts) AS max_ts
        FROM events GROUP BY user_id, event_type""",
    "lineitem_summary": """
        SELECT l_returnflag, l_linestatus,
            CAST(sum(CAST(round(l_quantity * 100) AS BIGINT)) AS BIGINT) AS total_quantity_hundredths,
            count(*) AS event_count, max(l_shipdate) AS max_shipdate
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "orders_summary": """
        SELECT o_orderstatus, o_orderpriority,
            CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
            count(*) AS event_count, max(o_orderdate) AS max_orderdate
        FROM orders GROUP BY o_orderstatus, o_orderpriority""",
    "csv_summary": f"""
        SELECT event_type, CAST(sum(cents) AS BIGINT) AS total_value, count(*) AS event_count,
            CAST(max(ts) AS INTEGER) AS max_timestamp
        FROM ({CSV}) WHERE bad IS NULL GROUP BY event_type""",
    "csv_quarantine": f"""
        SELECT event_type, bad AS bad_field, count(*) AS row_count
        FROM ({CSV}) WHERE bad IS NOT NULL GROUP BY event_type, bad""",
    "csv_accounting": f"""
        SELECT event_type, count(*) AS rows_read, count(*) FILTER (WHERE bad IS NULL AND cents IS NOT NULL) AS rows_summed,
            count(*) FILTER (WHERE bad IS NULL AND cents IS NULL) AS rows_without_value,
            count(*) FILTER (WHERE bad IS NOT NULL) AS rows_rejected
        FROM ({CSV}) WHERE bad IS DISTINCT FROM 'timestamp' GROUP BY event_type""",
    "batch_job_rows": """
        SELECT count(*) + count(*) FILTER (WHERE event_id % 10 IN (3, 7)) AS rows_read,
            count(*) + count(*) FILTER (WHERE event_id % 10 = 3) AS rows_processed,
            count(*) FILTER (WHERE event_id % 10 = 7) AS rows_rejected, true AS passed FROM events""",
    "published_summary": f"""
        SELECT event_type, CAST(sum({CENTS}) AS BIGINT) AS total_value, count(*) AS event_count,
            max(event_id) AS max_timestamp FROM events GROUP BY event_type""",
    "event_messages": "SELECT event_type || ':' || event_id AS value FROM events",
    "parse_events": f"""
        SELECT event_id, shape, coalesce(trim(split_part(value, ':', 1), {BLANKS}), 'unknown') AS event_type,
            TRY_CAST(CASE WHEN contains(value, ':') THEN substr(value, instr(value, ':') + 1) END AS BIGINT)
                AS sequence
        FROM ({DIRTY})""",
    "generated_messages": "SELECT 'event_type_' || (event_id % 5) || ':' || event_id AS value FROM events",
    "generated_counts": GENERATED,
    "expected_counts": CLOSED_FORM,
    "generated_event_table": """
        SELECT 'event_type_' || (event_id % 5) AS event_type,
            CAST(CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) % 100 + 1 AS INTEGER) AS value,
            event_id + 1700000000 AS "timestamp"
        FROM events""",
    "constant_summary": """
        SELECT 'event_type_' || (event_id % 5) AS event_type, count(*) AS total_value, count(*) AS event_count
        FROM events GROUP BY 1""",
    "stream_counts": COUNTS,
    "stream_counts_update": COUNTS,
    "stream_restart": COUNTS,
    "stream_until_complete": COUNTS,
    "count_changelog": """
        SELECT event_type, event_id,
            count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS running_count
        FROM events""",
    "count_changelog_stream": """
        SELECT event_type, event_id,
            count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS running_count
        FROM events""",
    "time_to_n": """
        SELECT event_type, min(ts) AS ts FROM (
            SELECT event_type, ts,
                count(*) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS running_count
            FROM events)
        WHERE running_count >= 1000 GROUP BY event_type""",
    "time_to_n_overall": """
        SELECT min(ts) AS ts FROM (
            SELECT ts, count(*) OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) AS running_count FROM events)
        WHERE running_count >= 1000 HAVING count(*) > 0""",
    "snapshot_rows": SNAPSHOT,
    "snapshot_rows_loose": SNAPSHOT_LOOSE,
    "snapshot_total_skip": f"""
        SELECT event_type, CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total
        FROM ({SNAPSHOT}) GROUP BY event_type""",
    "snapshot_total_zero": f"""
        SELECT event_type, starts_with(count_text, '-') AS negative,
            CAST(CASE WHEN count(*) FILTER (WHERE event_count IS NULL) > 0 THEN 0
                ELSE coalesce(sum(event_count), 0) END AS BIGINT) AS total
        FROM ({SNAPSHOT}) GROUP BY 1, 2""",
    "rendered_lines": f"""
        SELECT event_type || ',' || CAST(sum({CENTS}) AS BIGINT) || ',' || count(*) || ',' || max(event_id) AS line
        FROM events GROUP BY event_type""",
    "global_total_of_counts": "SELECT count(*) AS total FROM events",
    "result_row_count": "SELECT count(DISTINCT event_type) AS row_count FROM events",
    "snapshot_file": f"SELECT event_type || chr(9) || event_count AS line FROM ({COUNTS})",
    "handoff_file": f"""
        SELECT event_type, CAST(sum(event_count) AS BIGINT) AS total_value, count(*) AS event_count,
            CAST(0 AS INTEGER) AS max_timestamp
        FROM ({COUNTS}) GROUP BY event_type""",
    "handoff_table": f"""
        SELECT event_type, event_count AS value, CAST(0 AS INTEGER) AS "timestamp" FROM ({COUNTS})""",
    "pipeline_summary": f"""
        SELECT event_type, CAST(sum(event_count) AS BIGINT) AS total_value, count(*) AS event_count,
            CAST(0 AS INTEGER) AS max_timestamp
        FROM ({COUNTS}) GROUP BY event_type""",
    "result_digest": f"SELECT count(*) AS line_count, {_digest(COUNTS).replace(' FROM', ' AS sha256 FROM', 1)}",
    "digest_check": f"""
        SELECT a AS output_sha256, b AS expected_sha256, a = b AS passed
        FROM (SELECT (SELECT {_digest(GENERATED)}) AS a, (SELECT {_digest(CLOSED_FORM)}) AS b)""",
    "table_digest": f"SELECT {_sums(64)} FROM (SELECT sha256({LINEITEM_LINE}) AS h FROM lineitem)",
    "table_fingerprint": f"SELECT {_sums(32)} FROM (SELECT md5({LINEITEM_LINE}) AS h FROM lineitem)",
    "stream_batch_diff": f"""
        SELECT event_type, event_count AS stream_event_count, event_count AS batch_event_count, 'same' AS status
        FROM ({COUNTS})""",
    "completeness_check": f"""
        SELECT count(*) AS row_count, CAST(sum(event_count) AS BIGINT) AS total,
            (SELECT count(*) FROM events) AS injected, count(*) >= 5 AS enough_rows,
            sum(event_count) = (SELECT count(*) FROM events) AS complete
        FROM ({COUNTS})""",
    "summary_violations": f"""
        SELECT submission, rule, position, valid, {DETAIL} AS detail
        FROM (SELECT event_id AS submission,
            CAST(CASE event_id % 17
                WHEN 0 THEN NULL WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 5
                WHEN 6 THEN 6 WHEN 7 THEN 7 WHEN 8 THEN 7 WHEN 9 THEN 8 WHEN 10 THEN 9
                WHEN 11 THEN 10 WHEN 12 THEN 10 WHEN 13 THEN 11 WHEN 14 THEN 11
                ELSE 12 END AS INTEGER) AS rule,
            CAST(CASE WHEN event_id % 17 IN (6, 9, 11, 12) THEN 1
                WHEN event_id % 17 IN (7, 8, 10) THEN 0 END AS INTEGER) AS position,
            event_id % 17 = 0 AS valid
            FROM events)""",
    "all_violations_of_documents": f"""
        SELECT submission, position, rule, {DETAIL} AS detail, stated, computed FROM (
            SELECT submission, CAST(NULL AS INTEGER) AS position, CAST(kind AS INTEGER) AS rule,
                CASE kind WHEN 4 THEN 'missing: scenarios_total' WHEN 5 THEN 'OBJECT<`01`: BOOLEAN>' END AS stated,
                CAST(NULL AS VARCHAR) AS computed FROM ({VIOLATIONS}) WHERE kind BETWEEN 1 AND 5
            UNION ALL
            SELECT submission, CASE WHEN kind IN (7, 8, 10) THEN 0 ELSE 1 END,
                CASE kind WHEN 6 THEN 6 WHEN 7 THEN 7 WHEN 8 THEN 7 WHEN 9 THEN 8 WHEN 10 THEN 9 ELSE 10 END,
                CASE kind WHEN 6 THEN 'BIGINT' WHEN 7 THEN '1' WHEN 8 THEN 'null' WHEN 9 THEN '01' WHEN 10 THEN 'yes'
                    WHEN 11 THEN '1.5' ELSE 'true' END, NULL FROM ({VIOLATIONS}) WHERE kind BETWEEN 6 AND 12
            UNION ALL
            SELECT submission, NULL, 11, CASE kind WHEN 10 THEN '1' WHEN 13 THEN '2' ELSE 'true' END,
                CASE kind WHEN 10 THEN '0' ELSE '1' END FROM ({VIOLATIONS}) WHERE kind IN (10, 13, 14)
            UNION ALL
            SELECT submission, NULL, 12,
                CASE kind WHEN 15 THEN CAST(ms + 8 AS VARCHAR) WHEN 16 THEN 'none' ELSE CAST(ms + 7 AS VARCHAR) END,
                CASE WHEN kind IN (15, 16) THEN CAST(ms + 7 AS VARCHAR) ELSE '7' END
            FROM ({VIOLATIONS}) WHERE kind IN (15, 16) OR kind IN (6, 11, 12) AND ms <> 0)""",
    "run_records": f"""
        SELECT CAST(event_id AS VARCHAR) AS id, event_type AS name, event_type <> 'error' AS passed,
            {CENTS} AS elapsed_ms, NULL::VARCHAR AS error FROM events
        UNION ALL
        SELECT CAST(event_id AS VARCHAR), NULL, false, 0, 'unreadable' FROM events WHERE event_id % 9 = 0""",
    "run_rollup": f"SELECT submission, {ROLLUP} FROM ({RUNS}) GROUP BY submission",
    "run_metrics": f"""
        SELECT id,
            CASE WHEN elapsed_ms > 0 THEN CAST(format('{{:.1f}}', rows_processed / (elapsed_ms / 1000.0::DOUBLE))
                AS DOUBLE) ELSE 0 END AS events_per_second,
            CASE WHEN elapsed_ms > 0 THEN CAST(format('{{:.0f}}', rows_processed / (elapsed_ms / 1000.0::DOUBLE))
                AS BIGINT) ELSE 0 END AS rows_per_second,
            CAST(format('{{:.1f}}', CAST(elapsed_ms AS DOUBLE) / greatest(latency_ms, 1)) AS DOUBLE)
                AS latency_ratio,
            CASE WHEN elapsed_ms > 0 AND baseline_time_ms > 0
                THEN CAST(format('{{:.2f}}', CAST(baseline_time_ms AS DOUBLE) / elapsed_ms) AS DOUBLE)
                ELSE 0 END AS speedup_factor
        FROM ({RUNS})""",
    "partition_check": f"""
        SELECT id, rows_processed % 16 AS shuffle_partitions_used, rows_processed % 16 <= 8 AS partitions_ok
        FROM ({RUNS})""",
    "scenario_ids": """
        SELECT event_id, CASE WHEN event_id % 3 = 2 THEN event_type
            WHEN user_id < 10 THEN '0' || user_id ELSE CAST(user_id AS VARCHAR) END AS scenario_id
        FROM events""",
    "selected_runs": f"""
        SELECT '0' || user_id AS id, {ROLLUP}
        FROM (SELECT user_id, event_type <> 'error' AS passed, {CENTS} AS elapsed_ms FROM events)
        WHERE user_id IN (1, 2, 5) GROUP BY user_id""",
    "summary_document": f"""
        WITH runs AS ({RUNS}), totals AS (SELECT {ROLLUP} FROM runs)
        SELECT 0 AS section, '' AS id, 0::BIGINT AS place, '{{"scenarios_passed":' || scenarios_passed || ',"scenarios_total":' ||
            scenarios_total || ',"penalty_ms":' || penalty_ms || ',"total_elapsed_ms":' || total_elapsed_ms ||
            ',"scenarios":[' AS line FROM totals
        UNION ALL
        SELECT 1, id, 1, CASE WHEN id > (SELECT min(id) FROM runs) THEN ',' ELSE '' END || '{{"id":"' || id ||
            '","name":"' || name || '","passed":' || passed || ',"elapsed_ms":' || elapsed_ms || '}}' FROM runs
        UNION ALL
        SELECT 2, '', 0, ']}}' FROM totals""",
}
