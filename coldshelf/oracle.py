"""The same results in DuckDB SQL, written independently of the Spark side."""

from __future__ import annotations

NULLED = """(SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END
          AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        CASE WHEN o_totalprice >= 1000 THEN o_orderdate END AS o_orderdate, o_orderpriority
    FROM orders)"""

MOST_YEARS = "o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'"
FIRST_WINDOW = "o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-05-01'"
EXTRA = "(o_orderstatus = 'F' OR o_orderpriority LIKE '1%')"

DAMAGED = f"""s AS (SELECT * FROM orders WHERE {MOST_YEARS}),
a AS (
    SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey,
        o_orderstatus,
        CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN o_totalprice + 1
             ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2001-02-01'
        AND NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
)"""

VERDICTS = """v AS (
    SELECT coalesce(s.o_orderkey, a.o_orderkey) AS o_orderkey,
        CASE WHEN a.o_orderkey IS NULL THEN 'missing_in_archive'
             WHEN s.o_orderkey IS NULL THEN 'missing_in_source'
             WHEN s.o_custkey IS DISTINCT FROM a.o_custkey
                OR s.o_orderstatus IS DISTINCT FROM a.o_orderstatus
                OR s.o_totalprice IS DISTINCT FROM a.o_totalprice
                OR s.o_orderdate IS DISTINCT FROM a.o_orderdate
                OR s.o_orderpriority IS DISTINCT FROM a.o_orderpriority THEN 'mismatch'
             ELSE 'match' END AS verdict,
        CASE WHEN a.o_orderkey IS NULL OR s.o_orderkey IS NULL THEN ''
             ELSE concat_ws(',',
                CASE WHEN s.o_custkey IS DISTINCT FROM a.o_custkey THEN 'o_custkey' END,
                CASE WHEN s.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN 'o_orderstatus' END,
                CASE WHEN s.o_totalprice IS DISTINCT FROM a.o_totalprice THEN 'o_totalprice' END,
                CASE WHEN s.o_orderdate IS DISTINCT FROM a.o_orderdate THEN 'o_orderdate' END,
                CASE WHEN s.o_orderpriority IS DISTINCT FROM a.o_orderpriority THEN 'o_orderpriority' END)
             END AS mismatch_columns
    FROM s FULL JOIN a ON s.o_orderkey = a.o_orderkey
)"""

LEDGER = """e AS (
    SELECT event_id AS seq, event_type AS table_name, CAST(ts AS DATE) AS window_start,
        CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS window_end,
        (['STARTED', 'EXPORTED', 'EXPORT_FAILED', 'RECONCILED', 'RECONCILE_FAILED', 'DELETED',
          'DELETE_SKIPPED', 'DELETE_FAILED', 'RESTORE_STARTED', 'RESTORED', 'RESTORE_SKIPPED',
          'RESTORE_FAILED'])[CAST(user_id % 12 + 1 AS INT)] AS status,
        props, user_id, value
    FROM events
),
f AS (
    SELECT table_name, window_start, window_end, max(seq) AS seq, arg_max(status, seq) AS status,
        arg_max_null(CASE WHEN status LIKE '%FAILED' THEN props END, seq) AS error_message,
        arg_max(user_id, seq) FILTER (value < 30) AS exported,
        arg_max(user_id + 1, seq) FILTER (value >= 30) AS reconciled,
        arg_max(user_id + 2, seq) FILTER (value < 10) AS deleted,
        arg_max(user_id + 3, seq) FILTER (value > 90) AS restored,
        arg_max('run-' || seq, seq) FILTER (value < 30) AS export_run
    FROM e GROUP BY table_name, window_start, window_end
)"""

FILES = """g AS (
    SELECT '/cold/' || event_type || '/' || CASE WHEN value < 20 THEN 'stray-' ELSE 'part-' END
        || event_id || '.parquet' AS file_path,
        CASE WHEN value < 20 THEN 'stray-' ELSE 'part-' END || event_id || '.parquet' AS base_name
    FROM events
),
m AS (
    SELECT event_type AS table_name, CAST(ts AS DATE) AS window_start,
        CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS window_end,
        'run-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_token,
        'part-' || event_id || '.parquet' AS base_name
    FROM events
),
found AS (SELECT base_name, file_path, table_name, window_start, window_end, run_token
          FROM g JOIN m USING (base_name))"""

PLAN = """WITH RECURSIVE p AS (
    SELECT CAST(min(o_orderdate) AS DATE) AS window_start FROM orders
    UNION ALL
    SELECT CAST(window_start + INTERVAL 4 MONTH AS DATE) FROM p
    WHERE CAST(window_start + INTERVAL 4 MONTH AS DATE) < DATE '1998-01-01'
),
plan AS (
    SELECT window_start, least(CAST(window_start + INTERVAL 4 MONTH AS DATE), DATE '1998-01-01') AS window_end
    FROM p WHERE window_start < DATE '1998-01-01'
)"""

WINDOW_OF = """SELECT coalesce(w, c) AS window_start,
    CASE WHEN w < c THEN least(CAST(w + INTERVAL 4 MONTH AS DATE), c) ELSE coalesce(w, c) END AS window_end,
    c AS cutoff, coalesce(w < c, false) AS eligible
FROM x"""

ORACLE: dict[str, str] = {
    "window_scan": f"SELECT * FROM orders WHERE {FIRST_WINDOW}",
    "window_scan_predicate": f"SELECT * FROM orders WHERE {MOST_YEARS} AND {EXTRA}",
    "window_count": f"SELECT count(*) AS n_rows FROM orders WHERE {FIRST_WINDOW}",
    "oldest_date": """SELECT CAST(min(o_orderdate) AS DATE) AS oldest, 'orders' AS table_name FROM orders
        UNION ALL SELECT CAST(min(ts) AS DATE), 'events' FROM events""",
    "schema_discovery": f"""WITH n AS (
            SELECT count(*) FILTER (o_orderkey IS NULL) AS n1, count(*) FILTER (o_custkey IS NULL) AS n2,
                count(*) FILTER (o_orderstatus IS NULL) AS n3, count(*) FILTER (o_totalprice IS NULL) AS n4,
                count(*) FILTER (o_orderdate IS NULL) AS n5, count(*) FILTER (o_orderpriority IS NULL) AS n6
            FROM {NULLED})
        SELECT ordinal, column_name, archive_type, CAST(NULL AS INT) AS num_precision,
            CAST(NULL AS INT) AS num_scale, true AS nullable,
            CASE ordinal WHEN 1 THEN n1 WHEN 2 THEN n2 WHEN 3 THEN n3
                WHEN 4 THEN n4 WHEN 5 THEN n5 ELSE n6 END AS null_rows
        FROM n, (VALUES (1, 'o_orderkey', 'LONG'), (2, 'o_custkey', 'LONG'), (3, 'o_orderstatus', 'STRING'),
            (4, 'o_totalprice', 'DOUBLE'), (5, 'o_orderdate', 'TIMESTAMP'),
            (6, 'o_orderpriority', 'STRING')) AS c(ordinal, column_name, archive_type)""",
    "resolve_window": f"""WITH x AS (SELECT CAST(min(o_orderdate) AS DATE) AS w, DATE '1998-01-01' AS c
        FROM orders) {WINDOW_OF}""",
    "resolve_window_clipped": f"""WITH x AS (SELECT CAST(max(o_orderdate) AS DATE) AS w, DATE '2001-10-01' AS c
        FROM orders) {WINDOW_OF}""",
    "resolve_window_watermark": f"""WITH {LEDGER},
        x AS (SELECT coalesce((SELECT max(window_end) FROM f WHERE status = 'DELETED'),
            (SELECT CAST(min(ts) AS DATE) FROM events)) AS w, DATE '2025-01-01' AS c) {WINDOW_OF}""",
    "resolve_window_none": f"""WITH x AS (SELECT CAST(min(ts) AS DATE) AS w, DATE '1998-01-01' AS c
        FROM events) {WINDOW_OF}""",
    "window_plan": f"{PLAN} SELECT window_start, window_end FROM plan",
    "window_plan_counts": f"""{PLAN} SELECT window_start, window_end, count(o_orderkey) AS n_rows
        FROM plan LEFT JOIN orders ON o_orderdate >= window_start AND o_orderdate < window_end
        GROUP BY window_start, window_end""",
    "partition_key_day": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS archive_key FROM events",
    "partition_key_month": f"""SELECT o_orderkey, o_custkey, o_totalprice,
        coalesce(strftime(o_orderdate, '%Y-%m'), 'unknown') AS archive_key FROM {NULLED}""",
    "partition_key_year": "SELECT event_id, strftime(ts, '%Y') AS archive_key FROM events",
    "partition_key_none": "SELECT event_id, 'all' AS archive_key FROM events",
    "rows_per_key": f"""SELECT coalesce(strftime(o_orderdate, '%Y-%m'), 'unknown') AS archive_key,
        count(*) AS n_rows FROM {NULLED} GROUP BY 1""",
    "safe_key": "SELECT event_id, regexp_replace(props, '[^A-Za-z0-9_-]', '_', 'g') AS safe_key FROM events",
    "null_violations": f"""SELECT 'o_orderkey' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS null_rows
        FROM {NULLED} UNION ALL SELECT 'o_custkey', count(*) FILTER (o_custkey IS NULL) FROM {NULLED}
        UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM {NULLED}""",
    "typed_projection": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CAST(l_quantity AS INT) AS l_quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
        CAST(l_tax AS DECIMAL(4,2)) AS l_tax, CAST(l_shipdate AS DATE) AS l_shipdate,
        l_returnflag = 'R' AS is_returned, l_linestatus FROM lineitem""",
    "export_partitioned": """SELECT *, strftime(o_orderdate, '%Y-%m') AS archive_key FROM orders
        WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2002-01-01'""",
    "manifest_counts": """WITH x AS (SELECT * FROM orders
            WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2002-01-01')
        SELECT strftime(o_orderdate, '%Y-%m') AS archive_key, count(*) AS n_rows,
            (SELECT count(*) FROM x) AS written_rows FROM x GROUP BY 1""",
    "rollover_files": """SELECT strftime(o_orderdate, '%Y-%m') AS archive_key, count(*) AS n_rows,
            true AS within_cap, true AS enough_files FROM orders
        WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2002-01-01' GROUP BY 1""",
    "archive_scan": """SELECT * FROM events
        WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-05-01'""",
    "reconcile_diff": f"WITH {DAMAGED}, {VERDICTS} SELECT * FROM v",
    "reconcile_summary": f"WITH {DAMAGED}, {VERDICTS} SELECT verdict, count(*) AS n_keys FROM v GROUP BY verdict",
    "reconcile_documents": """WITH a AS (
            SELECT doc_id, CASE WHEN lang = 'fr' THEN text || '.' ELSE text END AS text, lang, source, n_chars
            FROM documents WHERE source <> 'src7')
        SELECT d.doc_id,
            CASE WHEN a.doc_id IS NULL THEN 'missing_in_archive'
                 WHEN d.text IS DISTINCT FROM a.text THEN 'mismatch' ELSE 'match' END AS verdict,
            CASE WHEN a.doc_id IS NOT NULL AND d.text IS DISTINCT FROM a.text THEN 'text' ELSE '' END
                AS mismatch_columns
        FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id""",
    "reconcile_duplicates": """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT CASE WHEN n > 1 THEN 'duplicate_key' ELSE 'match' END AS verdict, count(*) AS n_keys
        FROM k GROUP BY 1""",
    "first_mismatch": f"""WITH {DAMAGED}, {VERDICTS} SELECT * FROM v WHERE verdict <> 'match'
        ORDER BY o_orderkey LIMIT 1""",
    "missing_in_archive": f"WITH {DAMAGED} SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)",
    "missing_in_source": f"WITH {DAMAGED} SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)",
    "set_equality": f"""WITH {DAMAGED}
        SELECT (SELECT count(*) FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM a)) AS only_left,
            (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM s)) AS only_right""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "count_gates": f"""WITH {DAMAGED}, c AS (
            SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM a) AS archive_rows,
                (SELECT count(*) FROM (SELECT o_orderkey FROM s GROUP BY 1 HAVING count(*) > 1
                    UNION SELECT o_orderkey FROM a GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys,
                (SELECT count(*) FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)) AS missing_in_archive,
                (SELECT count(*) FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)) AS missing_in_source)
            , x AS (SELECT count(*) AS exported FROM orders
                WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2002-01-01')
        SELECT c.*, archive_rows = exported AS archive_holds_export, source_rows = exported AS source_unchanged,
            duplicate_keys = 0 AS keys_unique, missing_in_archive = 0 AND missing_in_source = 0 AS keys_equal FROM c, x""",
    "delete_targets": f"""SELECT * FROM orders
        WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE {FIRST_WINDOW})""",
    "delete_survivors": f"""SELECT * FROM orders
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {FIRST_WINDOW})""",
    "delete_survivors_filter": f"""SELECT * FROM {NULLED}
        WHERE NOT coalesce({MOST_YEARS} AND {EXTRA}, false)""",
    "delete_batch_plan": f"""SELECT count(*) AS n_rows, min(o_orderkey) AS first_pk, max(o_orderkey) AS last_pk,
        true AS within_batch, true AS disjoint FROM orders WHERE {MOST_YEARS}""",
    "delete_batch_plan_lines": """WITH r AS (
            SELECT l_orderkey AS k, l_linenumber AS l,
                (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 500 AS batch_no
            FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'),
        b AS (SELECT batch_no, min((k, l)) AS f, max((k, l)) AS t, count(*) AS n_rows FROM r GROUP BY batch_no)
        SELECT batch_no, f[1] AS first_orderkey, f[2] AS first_linenumber, t[1] AS last_orderkey,
            t[2] AS last_linenumber, n_rows,
            coalesce(lag(t) OVER (ORDER BY batch_no) = f, false) AS splits_key, n_rows = 500 AS full FROM b""",
    "restore_union": "SELECT * FROM orders",
    "restore_roundtrip": "SELECT * FROM events",
    "ledger_fold": f"WITH {LEDGER} SELECT * FROM f",
    "ledger_find": f"""WITH {LEDGER} SELECT * FROM f
        WHERE table_name = 'view' AND window_start = DATE '2024-01-10'""",
    "watermark": f"""WITH {LEDGER} SELECT table_name, max(window_end) AS watermark FROM f
        WHERE status = 'DELETED' GROUP BY table_name""",
    "file_lookup": f"WITH {FILES} SELECT * FROM found",
    "unknown_files": f"""WITH {FILES} SELECT base_name, file_path FROM g
        WHERE base_name NOT IN (SELECT base_name FROM m)""",
    "restore_window_check": f"""WITH {FILES} SELECT count(DISTINCT (window_start, window_end)) AS n_windows,
        count(DISTINCT run_token) AS n_runs, min(window_start) AS window_start, min(window_end) AS window_end,
        min(run_token) AS run_token FROM found""",
    "restore_resolve": f"""WITH {FILES}, j AS (SELECT g.base_name, m.* EXCLUDE (base_name) FROM g LEFT JOIN m USING (base_name))
        SELECT count(*) FILTER (run_token IS NULL) AS n_unknown, min(base_name) FILTER (run_token IS NULL) AS an_unknown,
            count(DISTINCT (window_start, window_end)) FILTER (run_token IS NOT NULL) AS n_windows,
            count(DISTINCT run_token) AS n_runs, min(window_start) AS window_start, min(window_end) AS window_end,
            min(run_token) AS run_token FROM j""",
    "ledger_steps": """WITH e AS (
            SELECT event_id AS seq, (['STARTED', 'EXPORTED', 'EXPORT_FAILED', 'RECONCILED', 'RECONCILE_FAILED',
                'DELETED', 'DELETE_SKIPPED', 'DELETE_FAILED', 'RESTORE_STARTED', 'RESTORED', 'RESTORE_SKIPPED',
                'RESTORE_FAILED'])[CAST(user_id % 12 + 1 AS INT)] AS status, event_type, CAST(ts AS DATE) AS day
            FROM events),
        p AS (SELECT seq, status, lag(status) OVER (PARTITION BY event_type, day ORDER BY seq) AS status_before FROM e)
        SELECT *, status = 'STARTED' OR coalesce((status_before, status) IN (
            ('STARTED', 'EXPORTED'), ('STARTED', 'EXPORT_FAILED'), ('EXPORTED', 'RECONCILED'),
            ('EXPORTED', 'RECONCILE_FAILED'), ('RECONCILED', 'RECONCILED'), ('RECONCILED', 'DELETED'),
            ('RECONCILED', 'DELETE_SKIPPED'), ('RECONCILED', 'DELETE_FAILED'), ('DELETED', 'RESTORE_STARTED'),
            ('RESTORE_FAILED', 'RESTORE_STARTED'), ('DELETE_FAILED', 'DELETED'), ('DELETE_FAILED', 'DELETE_FAILED'),
            ('RESTORE_STARTED', 'RESTORE_STARTED'), ('RESTORE_STARTED', 'RESTORED'),
            ('RESTORE_STARTED', 'RESTORE_FAILED')), false) AS allowed FROM p""",
    "resolve_explicit_start": f"""WITH x AS (SELECT CAST(s AS DATE) AS w, DATE '2001-10-01' AS c
        FROM (VALUES ('1995-03-31'), ('2001-08-15'), ('2001-10-01')) AS v(s)) {WINDOW_OF}""",
    "resolve_leap_day": f"""WITH x AS (SELECT CAST(min(o_orderdate) AS DATE) AS w, DATE '1999-02-28' AS c
        FROM orders) {WINDOW_OF}""",
    "export_refuses_overwrite": f"""SELECT strftime(o_orderdate, '%Y-%m') AS archive_key, count(*) AS n_rows,
        true AS refused FROM orders WHERE {FIRST_WINDOW} GROUP BY 1""",
    "export_order_in_files": """SELECT strftime(o_orderdate, '%Y-%m') AS archive_key, count(*) AS n_rows,
        CAST(0 AS BIGINT) AS out_of_order FROM orders
        WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2002-01-01' GROUP BY 1""",
    "archive_predicate_leftovers": f"""SELECT o_orderkey,
        CASE WHEN coalesce({MOST_YEARS} AND {EXTRA}, false) THEN 'archive' ELSE 'table' END AS place FROM orders""",
    "delete_after_drift": f"""SELECT 'DELETE_FAILED' AS first_status, 'DELETED' AS status, n AS exported,
            n AS reconciled, n AS deleted, rows_left
        FROM (SELECT count(*) FILTER ({FIRST_WINDOW} AND o_orderpriority NOT LIKE '1%') AS n,
            count(*) FILTER (NOT ({FIRST_WINDOW})) AS rows_left FROM orders)""",
    "delete_skipped": f"""WITH c AS (SELECT count(*) AS rows_left, count(*) FILTER ({FIRST_WINDOW}) AS n FROM orders)
        SELECT 'DELETE_SKIPPED' AS status, reason || ': ' || n || ' rows would be deleted' AS error_message,
            n AS reconciled, CAST(NULL AS BIGINT) AS deleted, rows_left
        FROM c, (VALUES ('dry run'), ('deletes are switched off')) AS v(reason)""",
    "restore_small_integers": "SELECT *, CAST(length(props) AS SMALLINT) AS n_props FROM events",
    "restore_counts": """WITH c AS (SELECT count(*) AS total,
            count(*) FILTER (ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-05-01') AS n FROM events)
        SELECT total - n AS rows_left, n AS deleted, n AS restored, total AS rows_after FROM c""",
    "archive_window_job": f"""WITH w AS (
            SELECT CAST(min(o_orderdate) AS DATE) AS window_start,
                least(CAST(CAST(min(o_orderdate) AS DATE) + INTERVAL 4 MONTH AS DATE), DATE '1998-01-01')
                    AS window_end
            FROM orders WHERE {EXTRA}),
        c AS (SELECT count(*) AS n FROM orders, w
              WHERE o_orderdate >= window_start AND o_orderdate < window_end AND {EXTRA})
        SELECT 'orders' AS table_name, window_start, window_end, 'DELETED' AS status,
            n AS exported, n AS reconciled, n AS deleted, (SELECT count(*) FROM orders) - n AS rows_left
        FROM w, c""",
    "export_transform": f"""SELECT o_orderkey, o_custkey, o_orderstatus, floor(o_totalprice) AS o_totalprice, o_orderdate,
        lower(o_orderpriority) AS o_orderpriority, 'DELETED' AS status FROM orders WHERE {FIRST_WINDOW}""",
    "live_delete_swap": f"""WITH n AS (
            SELECT *, CASE WHEN {FIRST_WINDOW} THEN row_number() OVER (PARTITION BY {FIRST_WINDOW} ORDER BY o_orderkey) END AS nth
            FROM orders)
        SELECT CASE WHEN nth = 1 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
            CASE WHEN nth = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority,
            'DELETE_FAILED' AS status
        FROM n WHERE nth IS NULL OR nth <= 2""",
    "restore_resumed": f"""SELECT *, 'RESTORED' AS status,
        (SELECT count(*) FROM orders WHERE {FIRST_WINDOW}) AS restored FROM orders""",
    "archive_walk": "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
}
