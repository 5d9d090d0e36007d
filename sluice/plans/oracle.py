"""Oracle SQL (DuckDB dialect) for every registered query that SQL can express.

Each text rebuilds the same derived input as ``sluice.plans.fixtures`` from
the driver's tables and computes the operator's result independently of
Spark. Column names equal the Spark result's.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

BRONZE_ORDERS = r"""
bronze_src AS (
    SELECT o_orderkey AS k, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
           'u1' AS upload_id, 0 AS add_amt FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 'u2', 1
    FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 'u3', 2
    FROM orders WHERE o_orderkey % 7 = 0
),
bronze_orders AS (
    SELECT
        CASE WHEN k % 97 = 0 THEN '  '
             WHEN k % 89 = 0 THEN NULL
             WHEN k % 5 = 0 THEN ' O' || CAST(k AS VARCHAR) || ' '
             ELSE 'O' || CAST(k AS VARCHAR) END AS order_code,
        CASE WHEN k % 13 = 0 THEN 'N/A'
             WHEN k % 11 = 0 THEN strftime(o_orderdate, '%-d/%-m/%Y')
             WHEN k % 7 = 0 THEN NULL
             WHEN k % 29 = 0 THEN ' ' || strftime(o_orderdate, '%d/%m/%Y') || ' '
             ELSE strftime(o_orderdate, '%d/%m/%Y') END AS order_date,
        CASE WHEN k % 17 = 0 THEN 'N/A'
             WHEN k % 19 = 0 THEN '  '
             WHEN k % 23 = 0 THEN NULL
             ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + add_amt AS VARCHAR) END AS amount,
        CASE WHEN k % 43 = 0 THEN CAST(o_custkey AS VARCHAR) || '.5'
             WHEN k % 47 = 0 THEN 'C' || CAST(o_custkey AS VARCHAR)
             ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
        o_orderpriority AS priority,
        CASE WHEN upload_id = 'u1' AND k % 50 = 0 THEN 'O' || CAST(k AS VARCHAR) || ',broken,row' END
            AS _corrupt_record,
        upload_id,
        'orders_' || upload_id || '.csv' AS source_file_name,
        CASE WHEN upload_id = 'u1' THEN TIMESTAMP '2026-01-01 00:00:00'
             ELSE TIMESTAMP '2026-01-03 00:00:00' END AS ingested_at
    FROM bronze_src
)"""

# Typed triple of the orders contract over keyed bronze rows.
TYPED_ORDERS = r"""
keyed AS (
    SELECT * FROM bronze_orders
    WHERE _corrupt_record IS NULL AND order_code IS NOT NULL AND trim(order_code) <> ''
),
typed AS (
    SELECT
        trim(order_code) AS order_code,
        CASE WHEN regexp_full_match(trim(order_date), '\d{2}/\d{2}/\d{4}')
             THEN CAST(try_strptime(trim(order_date), '%d/%m/%Y') AS DATE) END AS order_date_v,
        order_date AS order_date_raw,
        TRY_CAST(trim(amount) AS DECIMAL(18,2)) AS amount_v,
        amount AS amount_raw,
        CASE WHEN regexp_full_match(trim(customer_id), '[+-]?\d+')
             THEN TRY_CAST(trim(customer_id) AS INTEGER) END AS customer_id_v,
        customer_id AS customer_id_raw,
        trim(priority) AS priority,
        upload_id,
        ingested_at
    FROM keyed
)"""

SILVER_OUT = """
    order_code,
    CAST(order_date_v AS VARCHAR) AS order_date,
    order_date_raw,
    (order_date_raw IS NULL OR order_date_v IS NOT NULL) AS order_date_is_valid,
    CAST(amount_v AS DOUBLE) AS amount,
    amount_raw,
    (amount_raw IS NULL OR amount_v IS NOT NULL) AS amount_is_valid,
    customer_id_v AS customer_id,
    customer_id_raw,
    (customer_id_raw IS NULL OR customer_id_v IS NOT NULL) AS customer_id_is_valid,
    priority"""

SILVER_ORDERS = r"""
silver AS (
    SELECT * FROM typed
    QUALIFY row_number() OVER (PARTITION BY order_code ORDER BY ingested_at DESC, upload_id DESC) = 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE["silver_typed"] = (
    _with(BRONZE_ORDERS, TYPED_ORDERS)
    + f"\nSELECT {SILVER_OUT}, upload_id, CAST(ingested_at AS VARCHAR) AS ingested_at FROM typed"
)

ORACLE["silver_build"] = (
    _with(BRONZE_ORDERS, TYPED_ORDERS, SILVER_ORDERS)
    + f"\nSELECT {SILVER_OUT}, upload_id, CAST(ingested_at AS VARCHAR) AS ingested_at FROM silver"
)

ORACLE["silver_incremental"] = ORACLE["silver_build"]

ORACLE["silver_optional_nulls"] = (
    _with(BRONZE_ORDERS, TYPED_ORDERS, SILVER_ORDERS)
    + """
SELECT order_code,
    CAST(order_date_v AS VARCHAR) AS order_date,
    order_date_raw,
    (order_date_raw IS NULL OR order_date_v IS NOT NULL) AS order_date_is_valid,
    CAST(amount_v AS DOUBLE) AS amount,
    amount_raw,
    (amount_raw IS NULL OR amount_v IS NOT NULL) AS amount_is_valid,
    CAST(NULL AS INTEGER) AS customer_id,
    CAST(NULL AS VARCHAR) AS customer_id_raw,
    TRUE AS customer_id_is_valid,
    priority, upload_id, CAST(ingested_at AS VARCHAR) AS ingested_at
FROM silver"""
)

ORACLE["silver_drop_reasons"] = _with(BRONZE_ORDERS) + """
SELECT upload_id,
       CASE WHEN _corrupt_record IS NOT NULL THEN 'CORRUPT'
            WHEN order_code IS NULL OR trim(order_code) = '' THEN 'KEYLESS'
            ELSE 'KEPT' END AS reason,
       count(*) AS n_rows
FROM bronze_orders GROUP BY 1, 2"""

ORACLE["silver_summary"] = _with(BRONZE_ORDERS) + """
, c AS (
    SELECT count(*) AS bronze_rows,
           count(*) FILTER (WHERE _corrupt_record IS NULL AND order_code IS NOT NULL
                                  AND trim(order_code) <> '') AS keyed,
           count(DISTINCT CASE WHEN _corrupt_record IS NULL AND order_code IS NOT NULL
                                    AND trim(order_code) <> '' THEN trim(order_code) END) AS silver_rows
    FROM bronze_orders
)
SELECT bronze_rows, bronze_rows - keyed AS dropped_corrupt_or_keyless,
       keyed - silver_rows AS deduplicated_away, silver_rows
FROM c"""

ORACLE["dedup_latest"] = """
SELECT user_id, event_id, CAST(ts AS VARCHAR) AS ts, event_type, value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE["dedup_latest_composite"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_partkey
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1"""

ORACLE["cast_failures"] = _with(BRONZE_ORDERS, TYPED_ORDERS, SILVER_ORDERS) + """
SELECT order_code, 'order_date' AS column_name, order_date_raw AS raw_value FROM silver
WHERE NOT (order_date_raw IS NULL OR order_date_v IS NOT NULL)
UNION ALL
SELECT order_code, 'amount', amount_raw FROM silver
WHERE NOT (amount_raw IS NULL OR amount_v IS NOT NULL)
UNION ALL
SELECT order_code, 'customer_id', customer_id_raw FROM silver
WHERE NOT (customer_id_raw IS NULL OR customer_id_v IS NOT NULL)"""

ORACLE["ambiguous_dates"] = _with(BRONZE_ORDERS, TYPED_ORDERS, SILVER_ORDERS) + """
SELECT count(*) FILTER (WHERE day(order_date_v) <= 12) AS possibly_inverted FROM silver"""

# ----------------------------------------------------------------- links ----

LINKS = """
mapping AS (SELECT DISTINCT l_orderkey AS order_key, l_partkey AS part_key FROM lineitem),
ent_o AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0),
ent_p AS (SELECT DISTINCT p_partkey FROM part WHERE p_partkey % 7 <> 0),
links AS (
    SELECT m.order_key, m.part_key,
           CASE WHEN o.o_orderkey IS NULL AND p.p_partkey IS NULL THEN 'ORPHAN_BOTH'
                WHEN o.o_orderkey IS NULL THEN 'ORPHAN_ORDER'
                WHEN p.p_partkey IS NULL THEN 'ORPHAN_PART'
                ELSE 'VALID' END AS link_status
    FROM mapping m
    LEFT JOIN ent_o o ON m.order_key = o.o_orderkey
    LEFT JOIN ent_p p ON m.part_key = p.p_partkey
)"""

ORACLE["link_resolve"] = _with(LINKS) + "\nSELECT order_key, part_key, link_status FROM links"
ORACLE["link_status_counts"] = _with(LINKS) + "\nSELECT link_status, count(*) AS n FROM links GROUP BY 1"
ORACLE["orphan_links"] = _with(LINKS) + (
    "\nSELECT order_key, part_key, link_status FROM links WHERE link_status <> 'VALID'"
)
ORACLE["mapping_coverage"] = _with(LINKS) + """
, mapped AS (SELECT DISTINCT part_key FROM links WHERE link_status = 'VALID')
SELECT count(*) AS entities, count(m.part_key) AS mapped,
       round(CAST(100.0 AS DOUBLE) * count(m.part_key) / count(*), 1) AS pct
FROM ent_p e LEFT JOIN mapped m ON e.p_partkey = m.part_key"""
ORACLE["mapping_coverage_raw"] = _with(LINKS) + """
SELECT count(*) AS entities, count(DISTINCT l.part_key) AS mapped,
       round(CAST(100.0 AS DOUBLE) * count(DISTINCT l.part_key) / count(*), 1) AS pct
FROM (SELECT p_partkey FROM part WHERE p_partkey % 7 <> 0) e
LEFT JOIN links l ON e.p_partkey = l.part_key AND l.link_status = 'VALID'"""

# ------------------------------------------------------- header checks ----

NORM = (
    "regexp_replace(regexp_replace(translate(lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g')), "
    "' -./', '____'), '_+', '_', 'g'), '^_+|_+$', '', 'g')"
)


def _list(items) -> str:
    return "[" + ", ".join("'" + s + "'" for s in items) + "]::VARCHAR[]"


# Expected values, written out: dataset, columns as declared (optional ones
# end in ?), whether unexpected columns are rejected.
HEADER_RULES = (
    ("projects", "project_code project_name status planned_start_date planned_end_date actual_start_date actual_end_date", False),
    ("contracts", "contract_code contract_name vendor_name total_contract_value start_date end_date", False),
    ("applications", "application_code application_name lifecycle_status", False),
    ("application_project_map", "application_code project_code asserted_by? asserted_at? notes?", False),
    ("strict", "project_id project_name project_status start_date? end_date?", True),
    ("lenient", "project_id project_name project_status start_date? end_date?", False),
)
# The same contracts once two of them require a column that no file has.
DRIFT_RULES = tuple(
    (name, columns + " reviewed_by" if name in ("contracts", "strict") else columns, reject) for name, columns, reject in HEADER_RULES)


def _rules_values(rules, with_base: bool) -> str:
    rows = []
    for i, (name, columns, reject) in enumerate(rules):
        names = columns.replace("?", "").split()
        required = [c for c in columns.split() if not c.endswith("?")]
        parts = [f"'{name}'", str(i), *([_list(names)] if with_base else []), _list(sorted(required)), _list(sorted(names)), str(reject).upper()]
        rows.append("(" + ", ".join(parts) + ")")
    return ",\n        ".join(rows)


def _header_ctes() -> str:
    values = _rules_values(HEADER_RULES, with_base=True)
    return f"""
rules(dataset_name, ds_idx, base, required_columns, allowed_columns, reject_unexpected) AS (
    VALUES {values}
),
h0 AS (
    SELECT c.c_custkey AS k, c.c_nationkey, r.*,
           CASE WHEN c.c_custkey % 5 = 0 THEN list_concat(r.base[1:1], r.base[3:]) ELSE r.base END AS h
    FROM customer c JOIN rules r ON r.ds_idx = c.c_custkey % 6
),
h1 AS (SELECT * REPLACE (CASE WHEN k % 7 = 0 THEN list_concat(h, h[1:1]) ELSE h END AS h) FROM h0),
h2 AS (SELECT * REPLACE (CASE WHEN k % 3 = 0 THEN list_concat(h, ['extra_' || CAST(k % 4 AS VARCHAR)])
                              ELSE h END AS h) FROM h1),
h3 AS (SELECT * REPLACE (CASE WHEN k % 13 = 0 THEN list_concat(h, ['  ']) ELSE h END AS h) FROM h2),
h4 AS (
    SELECT *, CASE WHEN k % 2 = 0 THEN [upper(replace(x, '_', ' ')) for x in h]
                   WHEN k % 9 = 0 THEN [' ' || replace(x, '_', '.') || ' ' for x in h]
                   ELSE h END AS raw_header
    FROM h3
),
hdr AS (SELECT *, [{NORM.format(x='x')} for x in raw_header] AS header FROM h4),
chk AS (
    SELECT *,
        list_sort([x for x in required_columns if NOT list_contains(header, x)]) AS missing,
        list_sort(list_distinct([x for x in header if NOT list_contains(allowed_columns, x)])) AS unexpected,
        list_sort(list_distinct([x for x in header if len([y for y in header if y = x]) > 1])) AS duplicate,
        CASE WHEN list_contains(header, '') THEN 'The CSV header contains a blank column name.' END AS violation
    FROM hdr
),
chk2 AS (
    SELECT *, (len(missing) = 0 AND len(duplicate) = 0
               AND NOT (len(unexpected) > 0 AND reject_unexpected)) AS is_valid
    FROM chk
),
outcome AS (
    SELECT k AS upload_id, dataset_name, header,
        CASE WHEN violation IS NOT NULL THEN 'REJECTED' WHEN is_valid THEN 'VALIDATED' ELSE 'REJECTED' END
            AS status,
        coalesce(violation, CASE WHEN is_valid THEN concat_ws('; ',
                'File passed structural contract validation.',
                CASE WHEN len(unexpected) > 0
                     THEN 'Extra columns present but allowed: ' || array_to_string(unexpected, ', ') END)
            ELSE concat_ws('; ',
                CASE WHEN len(missing) > 0 THEN 'Missing required columns: ' || array_to_string(missing, ', ') END,
                CASE WHEN len(duplicate) > 0 THEN 'Duplicate columns: ' || array_to_string(duplicate, ', ') END,
                CASE WHEN reject_unexpected AND len(unexpected) > 0
                     THEN 'Unexpected columns: ' || array_to_string(unexpected, ', ') END)
            END) AS msg,
        CAST(CASE WHEN violation IS NOT NULL THEN 0 ELSE c_nationkey + 1 END AS BIGINT) AS source_row_count,
        CASE WHEN violation IS NOT NULL THEN []::VARCHAR[] ELSE missing END AS missing_columns,
        CASE WHEN violation IS NOT NULL THEN []::VARCHAR[] ELSE unexpected END AS unexpected_columns,
        CASE WHEN violation IS NOT NULL THEN []::VARCHAR[] ELSE duplicate END AS duplicate_columns
    FROM chk2
)"""


ORACLE["normalise_header"] = f"""
WITH names AS (
    SELECT 'part' AS src, p_partkey AS id, p_name AS raw_name FROM part
    UNION ALL SELECT 'orders', o_orderkey, o_orderpriority FROM orders
    UNION ALL SELECT 'customer', c_custkey, c_name FROM customer
    UNION ALL SELECT 'pages', page_id, url FROM pages
)
SELECT src, id, raw_name, {NORM.format(x='raw_name')} AS column_name FROM names"""

ORACLE["validate_contract"] = "WITH " + _header_ctes() + """
SELECT upload_id, dataset_name, array_to_string(header, ',') AS header, status,
       CASE WHEN length(msg) > 1000 THEN left(msg, 997) || '...' ELSE msg END AS validation_message,
       source_row_count,
       array_to_string(missing_columns, ',') AS missing_columns,
       array_to_string(unexpected_columns, ',') AS unexpected_columns,
       array_to_string(duplicate_columns, ',') AS duplicate_columns
FROM outcome"""

ORACLE["unexpected_columns_report"] = "WITH " + _header_ctes() + """
SELECT dataset_name, array_to_string(unexpected_columns, ',') AS unexpected_columns, count(*) AS n
FROM outcome WHERE len(unexpected_columns) > 0 GROUP BY 1, 2"""


def _drift_sql() -> str:
    values = _rules_values(DRIFT_RULES, with_base=False)
    return "WITH " + _header_ctes() + f""",
drift_rules(dataset_name, ds_idx, required_columns, allowed_columns, reject_unexpected) AS (
    VALUES {values}
),
avail AS (
    SELECT dataset_name, list_sort(list(DISTINCT col)) AS available_columns
    FROM (SELECT dataset_name, unnest(header) AS col FROM outcome WHERE status = 'VALIDATED')
    GROUP BY 1
),
d AS (
    SELECT r.dataset_name, coalesce(a.available_columns, []::VARCHAR[]) AS av, r.required_columns
    FROM drift_rules r LEFT JOIN avail a ON a.dataset_name = r.dataset_name
),
d2 AS (SELECT *, list_sort([x for x in required_columns if NOT list_contains(av, x)]) AS miss FROM d)
SELECT dataset_name, array_to_string(miss, ',') AS required_missing,
       array_to_string(av, ',') AS available_columns,
       CASE WHEN len(miss) > 0 THEN 'The contract for ''' || dataset_name
            || ''' requires columns that do not exist in bronze: ' || array_to_string(miss, ', ')
            || '. Bronze currently has: ' || array_to_string(av, ', ') END AS drift_message
FROM d2"""


ORACLE["contract_drift_guard"] = _drift_sql()

# -------------------------------------------------------------- manifest ----

MANIFEST_CTES = r"""
ev AS (
    SELECT event_id AS seq, ts AS event_at, 'U' || CAST(user_id AS VARCHAR) AS upload_id,
        CASE WHEN event_type = 'signup' THEN 'RECEIVED'
             WHEN event_type = 'view' THEN 'VALIDATING'
             WHEN event_type = 'click' THEN CASE WHEN value < 100 THEN 'VALIDATED' ELSE 'PROCESSING' END
             WHEN event_type = 'purchase' THEN CASE WHEN value < 100 THEN 'PROCESSED' ELSE 'BRONZE_FAILED' END
             WHEN event_type = 'error' THEN CASE WHEN value < 50 THEN 'FAILED' WHEN value < 100 THEN 'REJECTED'
                                                 WHEN value < 150 THEN 'BRONZE_REJECTED' ELSE 'DUPLICATE' END
        END AS status,
        CASE WHEN event_type = 'signup'
             THEN ['projects', 'contracts', 'applications', 'application_project_map'][user_id % 4 + 1] END
            AS dataset_name,
        CASE WHEN event_type = 'signup' THEN 'file_' || CAST(user_id AS VARCHAR) || '.csv' END AS original_file_name,
        CASE WHEN event_type = 'signup' THEN 'user' || CAST(user_id % 7 AS VARCHAR) END AS uploaded_by,
        CASE WHEN event_type = 'signup' THEN ts END AS created_at,
        CASE WHEN event_type = 'error' THEN 'Failed: ' || props
             WHEN event_type = 'purchase' THEN 'Loaded ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' rows.'
        END AS validation_message,
        CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS source_row_count,
        CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) - event_id % 2 END AS bronze_row_count,
        CASE WHEN event_type = 'purchase' THEN event_id % 3 END AS bronze_corrupt_row_count,
        CASE WHEN event_type = 'view' THEN []::VARCHAR[]
             WHEN event_type = 'click' THEN ['col_' || CAST(event_id % 3 AS VARCHAR)] END AS missing_columns,
        CASE WHEN event_type = 'click' AND event_id % 4 = 0 THEN ['extra_' || CAST(event_id % 2 AS VARCHAR)]
             WHEN event_type = 'click' THEN []::VARCHAR[] END AS unexpected_columns
    FROM events
),
m AS (
    SELECT upload_id,
        arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
        arg_max(dataset_name, seq) FILTER (WHERE dataset_name IS NOT NULL) AS dataset_name,
        arg_max(original_file_name, seq) FILTER (WHERE original_file_name IS NOT NULL) AS original_file_name,
        arg_max(uploaded_by, seq) FILTER (WHERE uploaded_by IS NOT NULL) AS uploaded_by,
        arg_max(validation_message, seq) FILTER (WHERE validation_message IS NOT NULL) AS validation_message,
        arg_max(source_row_count, seq) FILTER (WHERE source_row_count IS NOT NULL) AS source_row_count,
        arg_max(bronze_row_count, seq) FILTER (WHERE bronze_row_count IS NOT NULL) AS bronze_row_count,
        arg_max(bronze_corrupt_row_count, seq) FILTER (WHERE bronze_corrupt_row_count IS NOT NULL)
            AS bronze_corrupt_row_count,
        arg_max(missing_columns, seq) FILTER (WHERE missing_columns IS NOT NULL) AS missing_columns,
        arg_max(unexpected_columns, seq) FILTER (WHERE unexpected_columns IS NOT NULL) AS unexpected_columns,
        coalesce(min(created_at), min(event_at)) AS created_at,
        max(event_at) AS updated_at,
        count(*) AS n_events
    FROM ev GROUP BY upload_id
)"""
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
LAST_BUILD = "TIMESTAMP '2024-01-20 00:00:00'"

ORACLE["manifest_fold"] = "WITH " + MANIFEST_CTES + """
SELECT upload_id, status, dataset_name, original_file_name, uploaded_by, validation_message,
       source_row_count, bronze_row_count, bronze_corrupt_row_count,
       array_to_string(missing_columns, ',') AS missing_columns,
       array_to_string(unexpected_columns, ',') AS unexpected_columns,
       CAST(created_at AS VARCHAR) AS created_at, CAST(updated_at AS VARCHAR) AS updated_at, n_events
FROM m"""

ORACLE["manifest_state"] = ORACLE["manifest_fold"]

ORACLE["manifest_lookup"] = "WITH " + MANIFEST_CTES + """
, req AS (SELECT DISTINCT 'U' || CAST(c_custkey AS VARCHAR) AS upload_id FROM customer)
SELECT r.upload_id, m.upload_id IS NOT NULL AS known, m.status,
       CASE WHEN m.upload_id IS NULL THEN 'Upload ID was not found: ' || r.upload_id END AS message
FROM req r LEFT JOIN m ON r.upload_id = m.upload_id"""

ORACLE["work_queue"] = "WITH " + MANIFEST_CTES + """
SELECT 'validate' AS stage, upload_id, status, CAST(created_at AS VARCHAR) AS created_at
FROM m WHERE status IN ('RECEIVED', 'FAILED')
UNION ALL
SELECT 'bronze', upload_id, status, CAST(created_at AS VARCHAR) FROM m WHERE status IN ('VALIDATED', 'BRONZE_FAILED')"""


def _claim_sql(stage: str, froms: tuple[str, ...], to: str, label: str) -> str:
    inlist = ", ".join(f"'{s}'" for s in froms)
    eligible = (f"coalesce(status IN ({inlist}) OR (status = '{to}' AND updated_at < {NOW} - INTERVAL 30 MINUTES), "
                "FALSE)")
    return f"""
SELECT '{stage}' AS stage, upload_id, status AS current_status, {eligible} AS claimed,
       CASE WHEN {eligible} THEN '{to}' ELSE status END AS new_status,
       CASE WHEN NOT {eligible} THEN 'Upload ' || upload_id || ' has status ''' || coalesce(status, 'None')
            || ''' and cannot be {label}. Eligible statuses: {', '.join(froms)}.' END AS message
FROM m"""


ORACLE["claim_transition"] = "WITH " + MANIFEST_CTES + _claim_sql(
    "validate", ("RECEIVED", "FAILED"), "VALIDATING", "validated") + "\nUNION ALL" + _claim_sql(
    "bronze", ("VALIDATED", "BRONZE_FAILED"), "PROCESSING", "loaded to bronze")

ORACLE["release_stale"] = "WITH " + MANIFEST_CTES + f"""
SELECT upload_id, status AS old_status,
       CASE status WHEN 'VALIDATING' THEN 'FAILED' WHEN 'PROCESSING' THEN 'BRONZE_FAILED' END AS new_status,
       'Interrupted before completion.' AS validation_message
FROM m WHERE status IN ('VALIDATING', 'PROCESSING') AND updated_at < {NOW} - INTERVAL 30 MINUTES"""

ORACLE["status_health"] = "WITH " + MANIFEST_CTES + """
SELECT status, count(*) AS n, CAST(max(updated_at) AS VARCHAR) AS latest FROM m GROUP BY status"""

ORACLE["unfinished_uploads"] = "WITH " + MANIFEST_CTES + """
SELECT upload_id, original_file_name, status, validation_message, uploaded_by,
       CAST(updated_at AS VARCHAR) AS updated_at
FROM m WHERE status NOT IN ('PROCESSED', 'DUPLICATE') ORDER BY m.updated_at DESC"""

ORACLE["row_reconciliation"] = "WITH " + MANIFEST_CTES + """
SELECT upload_id, original_file_name, source_row_count, bronze_row_count, bronze_corrupt_row_count
FROM m WHERE status = 'PROCESSED' AND source_row_count <> bronze_row_count"""

ORACLE["run_summary"] = "WITH " + MANIFEST_CTES + """
SELECT CAST(CAST(event_at AS DATE) AS VARCHAR) AS run_id,
       count(DISTINCT upload_id) AS files_seen,
       count(*) FILTER (WHERE status = 'RECEIVED') AS registered,
       count(*) FILTER (WHERE status = 'VALIDATED') AS validated,
       count(*) FILTER (WHERE status IN ('REJECTED', 'BRONZE_REJECTED')) AS rejected,
       count(*) FILTER (WHERE status = 'PROCESSED') AS loaded,
       count(*) FILTER (WHERE status IN ('FAILED', 'BRONZE_FAILED')) AS errors
FROM ev GROUP BY 1"""

ORACLE["incremental_check"] = "WITH " + MANIFEST_CTES + f"""
, seen AS (SELECT DISTINCT upload_id FROM ev WHERE status = 'PROCESSED' AND event_at < {LAST_BUILD}),
p AS (SELECT m.*, s.upload_id IS NOT NULL AS was_seen FROM m LEFT JOIN seen s ON m.upload_id = s.upload_id
      WHERE m.status = 'PROCESSED')
SELECT dataset_name, count(*) AS processed_uploads,
       count(*) FILTER (WHERE NOT was_seen) AS new_uploads,
       count(*) FILTER (WHERE NOT was_seen) > 0 AS needs_rebuild,
       max(updated_at) > {LAST_BUILD} AS newer_by_clock
FROM p GROUP BY dataset_name"""

# ---------------------------------------------------------- registration ----


def _files_cte() -> str:
    from sluice.plans.fixtures import DOC_SOURCES

    listed = "[" + ", ".join(f"''{s}''" for s in sorted(DOC_SOURCES)) + "]"
    inlist = ", ".join(f"'{s}'" for s in DOC_SOURCES)
    return rf"""
f0 AS (
    SELECT doc_id, text,
        lower(trim(CASE WHEN doc_id % 11 = 0 THEN upper(lang) || ' ' ELSE lang END)) AS dataset_name,
        '/landing/' || lang || '/doc_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '.csv' AS stored_file_path,
        sha256(text) AS file_hash,
        CAST(strlen(text) AS BIGINT) AS file_size_bytes,
        upper(trim(CASE WHEN doc_id % 2 = 0 THEN ' ' || source || ' ' ELSE source END)) AS source_system,
        upper(trim(CASE WHEN doc_id % 4 = 0
                        THEN ' ' || CAST(2000 + n_chars % 30 AS VARCHAR) || '-q' || CAST(doc_id % 6 AS VARCHAR)
                        WHEN doc_id % 4 = 1
                        THEN CAST(2000 + n_chars % 30 AS VARCHAR) || '-' || lpad(CAST(doc_id % 14 AS VARCHAR), 2, '0')
                        WHEN doc_id % 4 = 2
                        THEN CAST(2000 + n_chars % 30 AS VARCHAR) || 'Q' || CAST(doc_id % 6 AS VARCHAR) END))
            AS reporting_period
    FROM documents
),
files AS (
    SELECT *,
        left(sha256(stored_file_path || ':' || file_hash), 32) AS upload_id,
        CASE WHEN reporting_period IS NOT NULL AND NOT regexp_full_match(reporting_period, '\d{{4}}-(Q[1-4]|0[1-9]|1[0-2])')
             THEN 'reporting_period must look like ''2024-Q3'' or ''2024-10''. Got: ' || reporting_period
             WHEN source_system IS NOT NULL AND source_system NOT IN ({inlist})
             THEN 'Unknown source_system ''' || source_system || '''. Expected one of: {listed}' END
            AS metadata_error
    FROM f0
)"""


def _decisions_ctes() -> str:
    return _files_cte() + """,
man AS (
    SELECT 'R' || CAST(doc_id AS VARCHAR) AS upload_id, dataset_name, stored_file_path,
           CASE WHEN doc_id % 3 = 0 THEN file_hash ELSE sha256(text || '#v0') END AS file_hash,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS created_at
    FROM files WHERE doc_id % 3 = 0 OR doc_id % 5 = 0
),
by_path AS (
    SELECT stored_file_path, arg_min(upload_id, created_at) AS p_upload_id, arg_min(file_hash, created_at) AS p_hash
    FROM man GROUP BY 1
),
registered AS (
    SELECT dataset_name, file_hash, arg_min(upload_id, created_at) AS registered_upload_id FROM man GROUP BY 1, 2
),
j AS (
    SELECT f.*, bp.p_upload_id, bp.p_hash, r.registered_upload_id
    FROM files f
    LEFT JOIN by_path bp ON bp.stored_file_path = f.stored_file_path
    LEFT JOIN registered r ON r.dataset_name = f.dataset_name AND r.file_hash = f.file_hash
),
bf AS (
    SELECT dataset_name, file_hash, arg_min(upload_id, stored_file_path) AS first_upload_id
    FROM j WHERE p_upload_id IS NULL AND dataset_name IN ('en', 'de', 'fr') AND metadata_error IS NULL
    GROUP BY 1, 2
),
d0 AS (
    SELECT j.*, bf.first_upload_id FROM j
    LEFT JOIN bf ON bf.dataset_name = j.dataset_name AND bf.file_hash = j.file_hash
),
d AS (
    SELECT *,
        CASE WHEN dataset_name NOT IN ('en', 'de', 'fr') THEN 'UNKNOWN_DATASET'
             WHEN metadata_error IS NOT NULL THEN 'INVALID_METADATA'
             WHEN p_upload_id IS NOT NULL AND p_hash = file_hash THEN 'KNOWN'
             WHEN p_upload_id IS NOT NULL THEN 'CHANGED'
             WHEN registered_upload_id IS NOT NULL THEN 'DUPLICATE'
             WHEN first_upload_id <> upload_id THEN 'DUPLICATE'
             ELSE 'NEW' END AS action
    FROM d0
)"""


ORACLE["content_hash"] = "WITH " + _files_cte() + "\nSELECT doc_id, file_hash, file_size_bytes FROM files"

ORACLE["metadata_clean"] = "WITH " + _files_cte() + (
    "\nSELECT doc_id, source_system, reporting_period, metadata_error FROM files")

ORACLE["duplicate_detect"] = "WITH " + _files_cte() + """,
first AS (SELECT dataset_name, file_hash, arg_min(upload_id, stored_file_path) AS first_upload_id
          FROM files GROUP BY 1, 2)
SELECT doc_id, f.dataset_name, f.file_hash,
       CASE WHEN first_upload_id <> upload_id THEN 'DUPLICATE' ELSE 'RECEIVED' END AS status,
       CASE WHEN first_upload_id <> upload_id THEN first_upload_id END AS duplicate_of_upload_id
FROM files f JOIN first ON first.dataset_name = f.dataset_name AND first.file_hash = f.file_hash"""

ORACLE["register_action"] = "WITH " + _decisions_ctes() + """
SELECT dataset_name, stored_file_path, file_hash, action,
       CASE WHEN action = 'KNOWN' THEN p_upload_id WHEN action IN ('NEW', 'DUPLICATE') THEN upload_id END
           AS result_upload_id,
       CASE WHEN action = 'DUPLICATE' THEN coalesce(registered_upload_id, first_upload_id) END
           AS duplicate_of_upload_id,
       CASE WHEN action = 'UNKNOWN_DATASET' THEN 'Unknown dataset ''' || dataset_name || '''. Expected one of: [''' || 'en'', ''de'', ''fr' || ''']'
            WHEN action = 'INVALID_METADATA' THEN metadata_error
            WHEN action = 'CHANGED' THEN 'This path is already registered but the contents have changed: '
                 || stored_file_path
                 || '. The file was overwritten after registration. Investigate before registering again.'
       END AS message
FROM d"""

ORACLE["manifest_register"] = "WITH " + _decisions_ctes() + """
SELECT upload_id, dataset_name, string_split(stored_file_path, '/')[-1] AS original_file_name,
       stored_file_path, file_size_bytes, file_hash, source_system, reporting_period,
       CASE WHEN action = 'DUPLICATE' THEN 'DUPLICATE' ELSE 'RECEIVED' END AS status,
       CASE WHEN action = 'DUPLICATE' THEN coalesce(registered_upload_id, first_upload_id) END
           AS duplicate_of_upload_id
FROM d WHERE action IN ('NEW', 'DUPLICATE')"""

ORACLE["message_cap"] = """
SELECT doc_id, CAST(length(text) AS BIGINT) AS original_length,
       CASE WHEN length(text) > 1000 THEN left(text, 997) || '...' ELSE text END AS validation_message,
       left(text, 500) AS build_error
FROM documents"""

# ------------------------------------------------------------- csv lines ----

LINES_CTES = """
lines AS (
    SELECT 'L' || CAST(o_custkey // 100000 * 8 + o_orderkey % 8 AS VARCHAR) AS upload_id, o_orderkey AS line_no,
        CASE WHEN o_orderkey % 71 = 0 THEN 'blank'
             WHEN o_orderkey % 8 = 4 OR o_orderkey % 53 = 0 OR o_orderkey % 64 = 2 THEN 'extra'
             WHEN o_orderkey % 61 = 0 THEN 'short'
             ELSE 'ok' END AS kind,
        'O' || CAST(o_orderkey AS VARCHAR) AS f1, o_orderstatus AS f2,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS f3, o_orderpriority AS f4
    FROM orders
),
parsed AS (
    SELECT upload_id, line_no, f1 AS order_code, f2 AS order_status, f3 AS amount,
        CASE WHEN kind = 'short' THEN NULL ELSE f4 END AS priority,
        CASE WHEN kind = 'extra' THEN concat_ws(',', f1, f2, f3, f4, 'extra')
             WHEN kind = 'short' THEN concat_ws(',', f1, f2, f3) END AS _corrupt_record
    FROM lines WHERE kind <> 'blank'
),
counts AS (
    SELECT upload_id, count(*) AS row_count, count(_corrupt_record) AS corrupt_row_count
    FROM parsed GROUP BY 1
),
uploads AS (SELECT DISTINCT upload_id FROM lines),
gated AS (
    SELECT u.upload_id, coalesce(c.row_count, 0) AS row_count, coalesce(c.corrupt_row_count, 0) AS corrupt_row_count
    FROM uploads u LEFT JOIN counts c ON c.upload_id = u.upload_id
),
gated2 AS (
    SELECT *,
        CASE WHEN row_count = 0 THEN 'The file produced no rows when read.'
             WHEN corrupt_row_count / row_count > 0.05
             THEN CAST(corrupt_row_count AS VARCHAR) || ' of ' || CAST(row_count AS VARCHAR) || ' rows ('
                  || printf('%.1f', round_even(corrupt_row_count / row_count * 100, 1)) || '%) could not be parsed, '
                  || 'which exceeds the 5% limit. Check the file''s delimiter and encoding.' END AS message
    FROM gated
)"""

ORACLE["csv_permissive_scan"] = "WITH " + LINES_CTES + """
SELECT upload_id, line_no, order_code, order_status, amount, priority, _corrupt_record FROM parsed"""

ORACLE["corrupt_ratio_gate"] = "WITH " + LINES_CTES + """
SELECT upload_id, row_count, corrupt_row_count, message IS NULL AS accepted, message FROM gated2"""

ORACLE["bronze_outcome"] = "WITH " + LINES_CTES + """
, src AS (SELECT upload_id, count(*) AS source_row_count FROM lines GROUP BY 1)
SELECT g.upload_id,
    CASE WHEN message IS NULL THEN 'PROCESSED' ELSE 'BRONZE_REJECTED' END AS status,
    CASE WHEN message IS NULL THEN concat_ws(' ',
            'Loaded ' || CAST(row_count AS VARCHAR) || ' rows into bronze.orders.',
            CASE WHEN corrupt_row_count > 0 THEN CAST(corrupt_row_count AS VARCHAR) || ' rows could not be parsed.' END,
            CASE WHEN source_row_count <> row_count THEN 'Note: validation counted '
                 || CAST(source_row_count AS VARCHAR) || ' rows but bronze wrote ' || CAST(row_count AS VARCHAR) || '.' END)
         ELSE message END AS validation_message,
    CASE WHEN message IS NULL THEN row_count ELSE 0 END AS bronze_row_count,
    CASE WHEN message IS NULL THEN corrupt_row_count ELSE 0 END AS bronze_corrupt_row_count,
    source_row_count,
    message IS NULL AS processed
FROM gated2 g LEFT JOIN src s ON s.upload_id = g.upload_id"""

# ------------------------------------------------------- files on disk ----

FILES_CTES = LINES_CTES + """,
ltext AS (
    SELECT upload_id, line_no, kind,
        CASE kind WHEN 'blank' THEN ''
                  WHEN 'extra' THEN concat_ws(',', f1, f2, f3, f4, 'extra')
                  WHEN 'short' THEN concat_ws(',', f1, f2, f3)
                  ELSE concat_ws(',', f1, f2, f3, f4) END AS line
    FROM lines
),
body AS (
    SELECT upload_id, line_no, kind,
        CASE WHEN upload_id IN ('L1', 'L3') AND line <> '' THEN line || ',web' ELSE line END AS line
    FROM ltext
),
hdr AS (
    SELECT DISTINCT upload_id, CAST(-1 AS BIGINT) AS line_no, 'header' AS kind,
        CASE WHEN upload_id IN ('L1', 'L3') THEN 'order_code,order_status,amount,priority,channel'
             ELSE 'order_code,order_status,amount,priority' END AS line
    FROM body
),
content AS (
    SELECT upload_id, string_agg(line || chr(10), '' ORDER BY line_no) AS content
    FROM (SELECT * FROM body UNION ALL SELECT * FROM hdr) GROUP BY 1
),
file_rows AS (SELECT * FROM body WHERE kind <> 'blank')"""

ORACLE["landing_inventory"] = "WITH " + FILES_CTES + """
SELECT 'orders' AS dataset_name, upload_id || '.csv' AS original_file_name,
       CAST(strlen(content) AS BIGINT) AS file_size_bytes, sha256(content) AS file_hash
FROM content"""

ORACLE["change_detection"] = "WITH " + FILES_CTES + """
SELECT upload_id, CASE upload_id WHEN 'L6' THEN 'MISSING' WHEN 'L5' THEN 'CHANGED' ELSE 'UNCHANGED' END AS file_state
FROM content"""

ORACLE["bronze_lineage"] = "WITH " + FILES_CTES + """
SELECT upload_id, upload_id || '.csv' AS source_file_name, count(*) AS n_rows,
       count(*) FILTER (WHERE kind IN ('extra', 'short')) AS n_corrupt, count(*) AS n_keyed
FROM file_rows GROUP BY upload_id"""

ORACLE["bronze_schema_merge"] = "WITH " + FILES_CTES + """
SELECT upload_id, count(*) AS n_rows,
       CASE WHEN upload_id IN ('L1', 'L3') THEN count(*) FILTER (WHERE kind IN ('ok', 'extra')) ELSE 0 END
           AS n_channel,
       CASE WHEN upload_id IN ('L1', 'L3') THEN count(*) ELSE count(*) FILTER (WHERE kind <> 'short') END
           AS n_priority
FROM file_rows GROUP BY upload_id"""

ORACLE["bronze_idempotent_load"] = "WITH " + FILES_CTES + """
SELECT upload_id, row_count AS n_rows FROM gated2 WHERE message IS NULL"""

ORACLE["unexpected_columns_by_name"] = "WITH " + _header_ctes() + """
SELECT dataset_name, column_name, count(*) AS n
FROM (SELECT dataset_name, unnest(unexpected_columns) AS column_name FROM outcome WHERE len(unexpected_columns) > 0)
GROUP BY 1, 2"""


# Expected values, written out: the silver columns of every dataset before its
# lineage; a type stands for a value with its text and validity beside it.
SILVER_COLUMNS = {
    "projects": "project_code project_name status planned_start_date:date planned_end_date:date actual_start_date:date actual_end_date:date",
    "contracts": "contract_code contract_name vendor_name total_contract_value:decimal(18,2) start_date:date end_date:date",
    "applications": "application_code application_name lifecycle_status",
    "application_project_map": "application_code project_code asserted_by asserted_at:date notes",
    "strict": "project_id project_name project_status start_date:date end_date:date",
    "lenient": "project_id project_name project_status start_date:date end_date:date",
}
LINEAGE = "upload_id:string ingested_at:timestamp silver_processed_at:timestamp"


def _contract_schema_sql() -> str:
    rows = []
    for dataset, columns in SILVER_COLUMNS.items():
        fields: list[tuple[str, str]] = []
        for name, _, kind in (c.partition(":") for c in columns.split()):
            fields += [(name, kind), (f"{name}_raw", "string"), (f"{name}_is_valid", "boolean")] if kind else [(name, "string")]
        fields += [tuple(c.split(":")) for c in LINEAGE.split()]
        rows += [f"('{dataset}', {i}, '{name}', '{kind}')" for i, (name, kind) in enumerate(fields)]
    values = ",\n        ".join(rows)
    names = ", ".join(f"'{n}'" for n in SILVER_COLUMNS)
    return f"""
WITH cols(dataset_name, ordinal, column_name, data_type) AS (
    VALUES {values}
),
uploads AS (
    SELECT ([{names}])[c_custkey % {len(SILVER_COLUMNS)} + 1] AS dataset_name, count(*) AS n_uploads
    FROM customer GROUP BY 1
)
SELECT c.dataset_name, CAST(c.ordinal AS INTEGER) AS ordinal, c.column_name, c.data_type, u.n_uploads
FROM cols c JOIN uploads u ON u.dataset_name = c.dataset_name"""


ORACLE["contract_schema"] = _contract_schema_sql()

ORACLE["upload_run_status"] = "WITH " + FILES_CTES + """
, src AS (SELECT upload_id, count(*) AS source_row_count FROM body GROUP BY 1),
sil AS (SELECT upload_id, count(*) AS silver_rows FROM file_rows WHERE kind = 'ok' GROUP BY 1)
SELECT g.upload_id,
       CASE WHEN message IS NULL THEN 'PROCESSED' ELSE 'BRONZE_REJECTED' END AS status,
       s.source_row_count,
       CASE WHEN message IS NULL THEN row_count ELSE 0 END AS bronze_row_count,
       CASE WHEN message IS NULL THEN corrupt_row_count ELSE 0 END AS bronze_corrupt_row_count,
       CASE WHEN message IS NULL THEN coalesce(v.silver_rows, 0) ELSE 0 END AS silver_rows
FROM gated2 g JOIN src s ON s.upload_id = g.upload_id LEFT JOIN sil v ON v.upload_id = g.upload_id"""

# L2 has become unreadable after it was registered: it fails, nothing else does.
ORACLE["upload_run_failures"] = "WITH " + FILES_CTES + """
, src AS (SELECT upload_id, count(*) AS source_row_count FROM body GROUP BY 1)
SELECT g.upload_id, CASE WHEN g.upload_id[1:2] IN ('L0', 'L1', 'L2', 'L3') THEN 'orders' ELSE 'returns' END AS dataset_name,
       CASE WHEN g.upload_id = 'L2' THEN 'FAILED' WHEN message IS NULL THEN 'PROCESSED' ELSE 'BRONZE_REJECTED' END AS status,
       CASE WHEN g.upload_id <> 'L2' THEN s.source_row_count END AS source_row_count,
       CASE WHEN g.upload_id = 'L2' THEN NULL WHEN message IS NULL THEN row_count ELSE 0 END AS bronze_row_count,
       CASE WHEN g.upload_id = 'L2' THEN NULL WHEN message IS NULL THEN corrupt_row_count ELSE 0 END AS bronze_corrupt_row_count
FROM gated2 g JOIN src s ON s.upload_id = g.upload_id"""

ORACLE["landing_structure"] = "WITH " + FILES_CTES + """
SELECT upload_id, (SELECT line FROM hdr h WHERE h.upload_id = body.upload_id) AS header, count(*) AS row_count,
       false AS multiline, CAST(NULL AS VARCHAR) AS violation
FROM body GROUP BY upload_id"""

ORACLE["bronze_spanning_records"] = """
WITH b AS (
    SELECT 'D' || CAST(doc_id % 4 AS VARCHAR) AS upload_id, coalesce(text, '') || chr(10) || 'in "' || coalesce(lang, '') || '"' AS body FROM documents
)
SELECT upload_id, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_corrupt, CAST(sum(length(body)) AS BIGINT) AS n_chars,
       CAST(sum(CAST('0x' || md5(body)[1:8] AS BIGINT)) AS BIGINT) AS sum_digest
FROM b GROUP BY 1"""


def _structure_sql() -> str:
    """Records by taking the quoted cells out and counting breaks; the header by a pattern of a first record."""
    from sluice.functions import messages as M

    text = lambda s: "'" + s.replace("'", "''") + "'"
    quoted = """'"' || replace(text, '"', '""') || '"' """
    opened = """'(?s)^"((?:[^"]|"")*)"(.*)$'"""
    unquoted = f"""CASE WHEN c LIKE '"%' THEN replace(regexp_extract(c, {opened}, 1), '""', '"') || regexp_extract(c, {opened}, 2) ELSE c END"""
    cell = r'(?:"(?:[^"]|"")*"[^,\r\n]*|[^",\r\n][^,\r\n]*|)'
    return f'''
WITH t AS (
    SELECT doc_id, doc_id % 8 AS k, CASE doc_id % 8
        WHEN 1 THEN 'Doc ID,"the ""Text"""' || chr(13) || chr(10) || doc_id || ',' || {quoted} || chr(13) || chr(10)
        WHEN 2 THEN '' WHEN 3 THEN 'id,lang' || chr(10) WHEN 4 THEN chr(10) || text
        WHEN 5 THEN 'id;lang' || chr(10) || '1;' || lang || chr(10) WHEN 6 THEN 'id,,lang' || chr(10) || '1,2,' || {quoted}
        ELSE text END AS t
    FROM documents
),
u AS (
    SELECT *, regexp_replace(t, '(^|[,\r\n])"(?:[^"]|"")*(?:"|$)', '\\1', 'g') AS plain, regexp_extract(t, '^(?:{cell},)*{cell}') AS first FROM t
),
r AS (
    SELECT *, len(regexp_extract_all(plain, '\r\n|\r|\n')) + CASE WHEN regexp_matches(t, '[\r\n]$') THEN 0 ELSE 1 END - 1 AS after,
        CASE WHEN first = '' THEN [] ELSE regexp_extract_all(',' || first, ',("(?:[^"]|"")*"[^,]*|[^,]*)', 1) END AS cells
    FROM u
),
n AS (
    SELECT *, list_transform(cells, lambda c: {NORM.format(x=unquoted)}) AS names
    FROM r
)
SELECT doc_id, CASE WHEN k NOT IN (2, 7) AND after > 0 AND len(names) > 0 THEN array_to_string(names, ',') END AS header,
    CASE WHEN k NOT IN (2, 7) THEN after END AS row_count,
    CASE WHEN t = '' THEN {text(M.EMPTY_FILE)} WHEN k = 7 THEN {text(M.NOT_UTF8)} WHEN after = 0 THEN {text(M.NO_DATA_ROWS)}
         WHEN len(names) = 0 THEN {text(M.NO_HEADER)} WHEN len(names) = 1 AND regexp_matches(names[1], '[;\t|]') THEN {text(M.NOT_COMMA_SEPARATED)}
         WHEN list_contains(names, '') THEN {text(M.BLANK_COLUMN_NAME)} END AS violation
FROM n'''


ORACLE["csv_structure_probe"] = _structure_sql()
