"""Hand-written SQL for every query, to be run by another engine on the same tables."""

from __future__ import annotations

from workload.roles import role_cte

TS = "2024-05-01 12:00:00"
LOAD = "load-0001"

# Every whitespace character the strip of the silver layer removes.
WS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)"
    "||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)"
    "||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)"
    "||chr(8239)||chr(8287)||chr(12288)"
)

# Money has two decimals here: it is summed as such, since sums of doubles depend
# on the order of addition. Scores have at most six, means are cut after nine.

DATASETS = (
    "customers", "accounts", "products", "transactions", "customer_service_notes",
    "exchange_rates_api", "fraud_alert_events",
)
RAW = tuple(f"raw_{name}" for name in DATASETS)
CLEAN_360 = (
    "customers", "accounts", "transactions", "fraud_alert_events", "customer_service_notes",
)


def s(column: str) -> str:
    return f"trim({column}, {WS})"


def number(column: str) -> str:
    return (
        f"CASE WHEN isnan(TRY_CAST({column} AS DOUBLE)) THEN NULL "
        f"ELSE TRY_CAST({column} AS DOUBLE) END"
    )


STD: dict[str, str] = {
    "customers": f"""SELECT {s('customer_id')} AS customer_id, {s('first_name')} AS first_name,
        {s('last_name')} AS last_name, lower({s('province')}) AS province,
        lower({s('customer_segment')}) AS customer_segment, lower({s('risk_tier')}) AS risk_tier,
        TRY_CAST({s('created_at')} AS TIMESTAMP) AS created_at,
        TRY_CAST({s('is_active')} AS BOOLEAN) AS is_active FROM raw_customers""",
    "accounts": f"""SELECT {s('account_id')} AS account_id, {s('customer_id')} AS customer_id,
        {s('product_id')} AS product_id, lower({s('account_status')}) AS account_status,
        TRY_CAST({s('opened_at')} AS TIMESTAMP) AS opened_at,
        {number('current_balance')} AS current_balance,
        lower({s('currency')}) AS currency FROM raw_accounts""",
    "products": f"""SELECT {s('product_id')} AS product_id,
        lower({s('product_name')}) AS product_name, lower({s('product_type')}) AS product_type,
        lower({s('business_domain')}) AS business_domain FROM raw_products""",
    "transactions": f"""SELECT {s('transaction_id')} AS transaction_id,
        {s('account_id')} AS account_id, {s('customer_id')} AS customer_id,
        TRY_CAST({s('transaction_timestamp')} AS TIMESTAMP) AS transaction_timestamp,
        lower({s('transaction_type')}) AS transaction_type, lower({s('channel')}) AS channel,
        lower({s('merchant_category')}) AS merchant_category, {number('amount')} AS amount,
        lower({s('currency')}) AS currency,
        TRY_CAST({s('is_international')} AS BOOLEAN) AS is_international,
        lower({s('ingestion_source')}) AS ingestion_source,
        CAST(TRY_CAST({s('transaction_timestamp')} AS TIMESTAMP) AS DATE) AS transaction_date
        FROM raw_transactions""",
    "customer_service_notes": f"""SELECT {s('case_id')} AS case_id,
        {s('customer_id')} AS customer_id, TRY_CAST({s('created_at')} AS TIMESTAMP) AS created_at,
        lower({s('issue_type')}) AS issue_type, lower({s('priority')}) AS priority,
        {s('case_note')} AS case_note, lower({s('case_status')}) AS case_status
        FROM raw_customer_service_notes""",
    "exchange_rates_api": f"""SELECT TRY_CAST({s('rate_date')} AS TIMESTAMP) AS rate_date,
        lower({s('base_currency')}) AS base_currency,
        lower({s('target_currency')}) AS target_currency,
        {number('exchange_rate')} AS exchange_rate, lower({s('source_system')}) AS source_system,
        TRY_CAST({s('loaded_at')} AS TIMESTAMP) AS loaded_at FROM raw_exchange_rates_api""",
    "fraud_alert_events": f"""SELECT {s('event_id')} AS event_id,
        {s('transaction_id')} AS transaction_id, {s('customer_id')} AS customer_id,
        {s('account_id')} AS account_id,
        TRY_CAST({s('event_timestamp')} AS TIMESTAMP) AS event_timestamp,
        {number('risk_score')} AS risk_score, lower({s('alert_reason')}) AS alert_reason,
        lower({s('recommended_action')}) AS recommended_action,
        lower({s('event_source')}) AS event_source FROM raw_fraud_alert_events""",
}


def std_cte(*names: str) -> str:
    return ",\n".join(f"std_{name} AS ({STD[name]})" for name in names)


# Rule masks by hand; m0, m1 ... in the order of the names below.
MASKS: dict[str, str] = {
    "customers": """customer_id IS NULL OR customer_id = '' AS m0,
        count(*) OVER (PARTITION BY customer_id) > 1 AS m1""",
    "accounts": """account_id IS NULL OR account_id = '' AS m0,
        customer_id IS NULL OR customer_id = '' AS m1, product_id IS NULL OR product_id = '' AS m2,
        count(*) OVER (PARTITION BY account_id) > 1 AS m3, currency <> 'cad' AS m4""",
    "products": """product_id IS NULL OR product_id = '' AS m0,
        product_name IS NULL OR product_name = '' AS m1,
        count(*) OVER (PARTITION BY product_id) > 1 AS m2""",
    "transactions": """transaction_id IS NULL OR transaction_id = '' AS m0,
        account_id IS NULL OR account_id = '' AS m1, customer_id IS NULL OR customer_id = '' AS m2,
        count(*) OVER (PARTITION BY transaction_id) > 1 AS m3,
        amount IS NULL OR amount <= 0 AS m4, currency <> 'cad' AS m5""",
    "customer_service_notes": """case_id IS NULL OR case_id = '' AS m0,
        customer_id IS NULL OR customer_id = '' AS m1,
        count(*) OVER (PARTITION BY case_id) > 1 AS m2""",
    "exchange_rates_api": """rate_date IS NULL AS m0,
        target_currency IS NULL OR target_currency = '' AS m1, exchange_rate IS NULL AS m2,
        exchange_rate IS NULL OR exchange_rate <= 0 AS m3""",
    "fraud_alert_events": """event_id IS NULL OR event_id = '' AS m0,
        transaction_id IS NULL OR transaction_id = '' AS m1,
        account_id IS NULL OR account_id = '' AS m2,
        count(*) OVER (PARTITION BY event_id) > 1 AS m3,
        risk_score IS NULL OR risk_score < 0 OR risk_score > 1 AS m4""",
}
KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "products": "product_id",
    "transactions": "transaction_id",
    "customer_service_notes": "case_id",
    "exchange_rates_api": "target_currency",
    "fraud_alert_events": "event_id",
}
RULES: dict[str, tuple[tuple[str, str], ...]] = {
    "customers": (
        ("customer_id_required", "critical"), ("customer_id_must_be_unique", "critical"),
    ),
    "accounts": (
        ("account_id_required", "critical"), ("customer_id_required", "critical"),
        ("product_id_required", "critical"), ("account_id_must_be_unique", "critical"),
        ("currency_must_be_cad", "high"),
    ),
    "products": (
        ("product_id_required", "critical"), ("product_name_required", "critical"),
        ("product_id_must_be_unique", "critical"),
    ),
    "transactions": (
        ("transaction_id_required", "critical"), ("account_id_required", "critical"),
        ("customer_id_required", "critical"), ("transaction_id_must_be_unique", "critical"),
        ("amount_must_be_positive", "critical"), ("currency_must_be_cad", "high"),
    ),
    "customer_service_notes": (
        ("case_id_required", "critical"), ("customer_id_required", "critical"),
        ("case_id_must_be_unique", "critical"),
    ),
    "exchange_rates_api": (
        ("rate_date_required", "critical"), ("target_currency_required", "critical"),
        ("exchange_rate_required", "critical"), ("exchange_rate_must_be_positive", "critical"),
    ),
    "fraud_alert_events": (
        ("event_id_required", "critical"), ("transaction_id_required", "critical"),
        ("account_id_required", "critical"), ("event_id_must_be_unique", "critical"),
        ("risk_score_between_zero_and_one", "critical"),
    ),
}


def flag_cte(*names: str) -> str:
    return ",\n".join(
        f"flag_{name} AS (SELECT *, {MASKS[name]} FROM std_{name})" for name in names
    )


def hits(name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset_name, '{rule}' AS rule_name, '{severity}' AS severity, "
        f"{KEYS[name]} AS record_key FROM flag_{name} WHERE m{i}"
        for i, (rule, severity) in enumerate(RULES[name])
    )


def valid(name: str) -> str:
    return "NOT (" + " OR ".join(f"m{i}" for i in range(len(RULES[name]))) + ")"


def silver_cte(*names: str) -> str:
    """Silver tables under the names the gold queries use."""
    return ", ".join(f"{n} AS (SELECT * FROM flag_{n} WHERE {valid(n)})" for n in names)


def audit(name: str) -> str:
    return f"""SELECT '{name}' AS dataset_name, 'bronze_{name}' AS bronze_table,
        'silver_{name}' AS silver_table, count(*) AS bronze_row_count,
        count(*) FILTER (WHERE {valid(name)}) AS silver_row_count,
        (SELECT count(*) FROM hits WHERE dataset_name = '{name}') AS rejected_rule_hits,
        '{TS}' AS processed_at_utc, 'success' AS status FROM flag_{name}"""


def checked_with(*names: str) -> str:
    """WITH clause up to the flagged datasets."""
    roles = role_cte(*(f"raw_{n}" for n in names))
    return f"WITH {roles},\n{std_cte(*names)},\n{flag_cte(*names)}"


HITS_WITH = f"{checked_with(*DATASETS)},\nhits AS ({' UNION ALL '.join(map(hits, DATASETS))})"
AUDIT_WITH = f"{HITS_WITH},\naudit AS ({' UNION ALL '.join(map(audit, DATASETS))})"

GRADES = ("critical", "high", "medium")


def hit_counts(of: str) -> str:
    """Rule hits of one dataset, all and by grade, as lookups."""
    found = f"FROM hits WHERE hits.dataset_name = {of}.dataset_name"
    graded = [
        f"(SELECT count(*) {found} AND severity = '{grade}') AS {grade}_reject_rule_hits"
        for grade in GRADES
    ]
    return ", ".join([f"(SELECT count(*) {found}) AS total_reject_rule_hits", *graded])


REJECT_SUMMARY = f"""SELECT dataset_name, {hit_counts('broken')}
    FROM (SELECT DISTINCT dataset_name FROM hits) AS broken"""

DASHBOARD_WITH = f"""{AUDIT_WITH},
dashboard AS (
    SELECT *, CASE WHEN bronze_row_count > 0 THEN silver_row_count / bronze_row_count END
        AS acceptance_rate, {hit_counts('audit')} FROM audit)"""

OWNER = """CASE dataset_name WHEN 'customers' THEN 'customer_data_steward'
    WHEN 'accounts' THEN 'core_banking_data_owner'
    WHEN 'products' THEN 'product_reference_data_steward'
    WHEN 'transactions' THEN 'payments_data_engineering_team'
    WHEN 'customer_service_notes' THEN 'customer_operations_data_steward'
    WHEN 'exchange_rates_api' THEN 'external_reference_data_owner'
    WHEN 'fraud_alert_events' THEN 'fraud_analytics_data_owner'
    ELSE 'enterprise_data_governance_team' END"""


def graded(a: str, b: str, c: str, d: str) -> str:
    return f"""CASE WHEN critical_reject_rule_hits >= 10 OR acceptance_rate < 0.98 THEN '{a}'
        WHEN critical_reject_rule_hits > 0 OR high_reject_rule_hits > 0 THEN '{b}'
        WHEN total_reject_rule_hits > 0 THEN '{c}' ELSE '{d}' END"""


STATUS = graded(
    "escalate_immediately", "investigate_this_sprint", "monitor", "no_action_required"
)
PRIORITY = graded("p1_high", "p2_medium", "p3_low", "p4_none")
ISSUE_ID = "'DQ-' || replace(upper(dataset_name), '_', '-')"
SUMMARY = """CASE WHEN total_reject_rule_hits = 0 THEN
    dataset_name || ' passed the current data quality checks. ' || format('{:,}', silver_row_count)
    || ' of ' || format('{:,}', bronze_row_count) || ' records were accepted into silver.'
    ELSE dataset_name || ' had ' || format('{:,}', total_reject_rule_hits)
    || ' data quality rule hits. ' || format('{:,}', silver_row_count) || ' of '
    || format('{:,}', bronze_row_count)
    || ' records were accepted into silver for an acceptance rate of '
    || format('{:.2f}', acceptance_rate * 100) || '%. The main issue patterns were: '
    || COALESCE(top3, 'unspecified validation rules') || '.' END"""
ACTION = """CASE WHEN total_reject_rule_hits = 0
    THEN 'Continue monitoring through scheduled pipeline checks.'
    WHEN dataset_name = 'transactions' THEN 'Review rejected transaction records, confirm source-system rules for required IDs, positive amounts, duplicate transaction IDs, and CAD currency standardization. Open a data quality issue with the payments data engineering team and confirm whether upstream validation or downstream quarantine logic should be adjusted.'
    WHEN critical_reject_rule_hits > 0 THEN 'Create a data quality issue, assign an accountable data owner, inspect rejected records, and confirm whether the rule failure is caused by upstream source quality, ingestion logic, or transformation logic.'
    WHEN high_reject_rule_hits > 0 THEN 'Review the affected records during the next sprint and decide whether source-system validation or transformation rules need adjustment.'
    ELSE 'Monitor trend over time and include in the next data quality review.' END"""

TRIAGE_WITH = f"""{DASHBOARD_WITH},
rule_counts AS (SELECT dataset_name, rule_name, count(*) AS n FROM hits GROUP BY ALL),
ranked AS (SELECT *, rule_name || ' (' || n || ' hits)' AS text,
    row_number() OVER (PARTITION BY dataset_name ORDER BY n DESC, rule_name) AS place
    FROM rule_counts),
top_rules AS (SELECT dataset_name,
    string_agg(text, '; ' ORDER BY place) AS top5,
    string_agg(text, ', ' ORDER BY place) FILTER (WHERE place <= 3) AS top3
    FROM ranked WHERE place <= 5 GROUP BY dataset_name),
listed AS (SELECT * FROM dashboard LEFT JOIN top_rules USING (dataset_name)),
triage AS (SELECT {ISSUE_ID} AS issue_id, dataset_name, bronze_table, silver_table,
    round(acceptance_rate, 4) AS acceptance_rate, critical_reject_rule_hits,
    high_reject_rule_hits, medium_reject_rule_hits, total_reject_rule_hits,
    COALESCE(top5, 'none') AS top_failed_rules, {PRIORITY} AS priority,
    {STATUS} AS triage_status, {OWNER} AS recommended_owner,
    {SUMMARY} AS plain_language_summary, {ACTION} AS recommended_action,
    '{TS}' AS created_at_utc FROM listed)"""

# Customer facts of all kinds as rows of one shape, and what is measured on each kind.
FACTS = {
    "account": ("accounts", "account_id", "product_id", "current_balance", "opened_at",
                "account_status = 'active'", "FALSE"),
    "transaction": ("transactions", "transaction_id", "channel", "amount",
                    "transaction_timestamp", "is_international", "FALSE"),
    "alert": ("fraud_alert_events", "event_id", "NULL", "risk_score", "event_timestamp",
              "recommended_action = 'review'", "FALSE"),
    "case": ("customer_service_notes", "case_id", "NULL", "NULL", "created_at",
             "priority = 'high'", "list_contains(['open', 'in_progress'], case_status)"),
}
TOTAL = "CAST(sum(exact) {} AS DOUBLE)"
MEAN = "CAST(sum(exact) {0} AS DOUBLE) / count(exact) {0}"
# Measure -> aggregate with a place for its filter, the condition on the fact, decimals.
MEASURES: dict[str, dict[str, tuple[str, str, int | None]]] = {
    "account": {
        "account_count": ("count(DISTINCT item) {}", "TRUE", None),
        "product_count": ("count(DISTINCT kind) {}", "TRUE", None),
        "active_account_count": ("count(*) {}", "marked", None),
        "total_current_balance": (TOTAL, "TRUE", 2),
        "average_current_balance": (MEAN, "TRUE", 2),
    },
    "transaction": {
        "transaction_count": ("count(*) {}", "TRUE", None),
        "total_transaction_amount": (TOTAL, "TRUE", 2),
        "average_transaction_amount": (MEAN, "TRUE", 2),
        "most_recent_transaction_at": ("max(moment) {}", "TRUE", None),
        "international_transaction_count": ("count(*) {}", "marked", None),
        "channel_count": ("count(DISTINCT kind) {}", "TRUE", None),
    },
    "alert": {
        "fraud_alert_count": ("count(*) {}", "TRUE", None),
        "average_fraud_risk_score": (MEAN, "TRUE", 3),
        "maximum_fraud_risk_score": ("CAST(max(exact) {} AS DOUBLE)", "TRUE", 3),
        "fraud_review_count": ("count(*) {}", "marked", None),
    },
    "case": {
        "service_case_count": ("count(*) {}", "TRUE", None),
        "high_priority_case_count": ("count(*) {}", "marked", None),
        "open_case_count": ("count(*) {}", "also", None),
        "most_recent_service_case_at": ("max(moment) {}", "TRUE", None),
    },
}


def fact_rows(fact: str) -> str:
    source, item, kind, value, moment, marked, also = FACTS[fact]
    return f"""SELECT customer_id, '{fact}' AS fact, CAST({item} AS VARCHAR) AS item,
        CAST({kind} AS VARCHAR) AS kind, CAST({value} AS DECIMAL(38, 6)) AS exact,
        CAST({moment} AS TIMESTAMP) AS moment, {marked} AS marked, {also} AS also FROM {source}"""


def measured(fact: str) -> list[str]:
    """The measures of one kind of fact over rows that may hold all kinds."""
    return [
        f"{call.format(f"FILTER (WHERE fact = '{fact}' AND {condition})")} AS {name}"
        for name, (call, condition, _) in MEASURES[fact].items()
    ]


def one_fact(fact: str) -> str:
    """The rounded measures of one kind of fact by customer."""
    digits = {name: n for name, (_, _, n) in MEASURES[fact].items() if n is not None}
    shown = ", ".join(
        f"round({name}, {digits[name]}) AS {name}" if name in digits else name
        for name in MEASURES[fact]
    )
    return f"""SELECT customer_id, {shown} FROM (
        SELECT customer_id, {', '.join(measured(fact))} FROM ({fact_rows(fact)})
        GROUP BY customer_id)"""


def in_mart(name: str, digits: int | None) -> str:
    """A measure as the mart shows it: missing counts and amounts are 0, missing moments stay."""
    if name.startswith("most_recent"):
        return name
    filled = f"ifnull({name}, 0)"
    return f"{filled if digits is None else f'round({filled}, {digits})'} AS {name}"


CUSTOMER_360_CTES = f"""
facts AS ({' UNION ALL '.join(map(fact_rows, FACTS))}),
by_customer AS (SELECT customer_id, {', '.join(m for fact in FACTS for m in measured(fact))}
    FROM facts WHERE customer_id IS NOT NULL GROUP BY customer_id),
customer_360 AS (
    SELECT customer_id, province, customer_segment, risk_tier,
        customers.created_at AS customer_created_at, is_active,
        {', '.join(in_mart(n, d) for f in FACTS for n, (_, _, d) in MEASURES[f].items())}
    FROM customers LEFT JOIN by_customer USING (customer_id))"""
CUSTOMER_360_WITH = f"WITH {role_cte(*CLEAN_360)}, {CUSTOMER_360_CTES}"
FRESH_360_WITH = f"{checked_with(*CLEAN_360)}, {silver_cte(*CLEAN_360)}, {CUSTOMER_360_CTES}"


def ratio(part: str, of: str) -> str:
    return f"ifnull(CAST({part} AS DOUBLE) / nullif({of}, 0), 0)"


RATIOS = ", ".join(
    f"{ratio(part, of)} AS {name}"
    for name, part, of in (
        ("international_transaction_ratio", "international_transaction_count",
         "transaction_count"),
        ("fraud_review_ratio", "fraud_review_count", "fraud_alert_count"),
        ("transactions_per_account", "transaction_count", "account_count"),
    )
)
SIGNS = ("maximum_fraud_risk_score >= 0.85", "fraud_review_count > 2",
         "high_priority_case_count > 1", "risk_tier = 'high'")
LABEL = f"CAST(ifnull({' OR '.join(SIGNS)}, FALSE) AS INTEGER) AS synthetic_high_risk_label"
FEATURES = """* EXCLUDE (customer_created_at, most_recent_transaction_at,
    most_recent_service_case_at)"""
FEATURES_WITH = f"""{CUSTOMER_360_WITH},
features AS (SELECT {FEATURES}, {RATIOS}, {LABEL} FROM customer_360)"""
DAILY = """SELECT transaction_date, transaction_type, channel, merchant_category,
        len(exact) AS transaction_count,
        round(CAST(list_sum(exact) AS DOUBLE), 2) AS total_transaction_amount,
        round(CAST(list_sum(exact) AS DOUBLE) / list_count(exact), 2)
            AS average_transaction_amount,
        round(CAST(list_max(exact) AS DOUBLE), 2) AS maximum_transaction_amount, abroad
            AS international_transaction_count
    FROM (SELECT CAST(transaction_date AS DATE) AS transaction_date, transaction_type, channel,
            merchant_category, list(CAST(amount AS DECIMAL(38, 2))) AS exact,
            count(*) FILTER (WHERE is_international) AS abroad
          FROM transactions GROUP BY ALL)"""
PRODUCT_ROLES = ("products", "accounts", "transactions")
PER_ACCOUNT = """SELECT account_id, count(*) AS moves,
    sum(CAST(amount AS DECIMAL(38, 2))) AS moved, count(amount) AS amounts
    FROM transactions GROUP BY account_id"""
PRODUCT_CTES = f"""
per_account AS ({PER_ACCOUNT}),
holdings AS (
    SELECT product_id, account_id, customer_id,
        CAST(current_balance AS DECIMAL(38, 2)) AS balance, moves, moved,
        CAST(CAST(moved AS DOUBLE) / amounts AS DECIMAL(38, 9)) AS mean
    FROM accounts LEFT JOIN per_account USING (account_id)),
per_product AS (
    SELECT product_id, count(DISTINCT account_id) AS held, count(DISTINCT customer_id) AS holders,
        CAST(sum(balance) AS DOUBLE) AS balances,
        CAST(sum(balance) AS DOUBLE) / count(balance) AS mean_balance,
        sum(moves) AS moves, CAST(sum(moved) AS DOUBLE) AS moved,
        CAST(sum(mean) AS DOUBLE) / count(mean) AS mean_moved
    FROM holdings GROUP BY product_id),
product_performance AS (
    SELECT product_id, product_name, product_type, business_domain,
        ifnull(held, 0) AS account_count, ifnull(holders, 0) AS customer_count,
        round(balances, 2) AS total_current_balance,
        round(mean_balance, 2) AS average_current_balance,
        CAST(ifnull(moves, 0) AS BIGINT) AS transaction_count,
        round(ifnull(moved, 0), 2) AS total_transaction_amount,
        round(ifnull(mean_moved, 0), 2) AS average_transaction_amount
    FROM products LEFT JOIN per_product USING (product_id))"""
PRODUCT_WITH = f"WITH {role_cte(*PRODUCT_ROLES)}, {PRODUCT_CTES}"

# What the row-count report sees when the flagged datasets are its silver tables.
COUNTS_WITH = f"""{AUDIT_WITH},
counts AS (
    SELECT 'bronze' AS layer, bronze_table AS table_name, bronze_row_count AS row_count FROM audit
    UNION ALL SELECT 'silver', silver_table, silver_row_count FROM audit)"""


def one_rule(name: str, rule: str) -> str:
    index = [r for r, _ in RULES[name]].index(rule)
    severity = RULES[name][index][1]
    return f"""{checked_with(name)} SELECT '{name}' AS dataset_name, '{rule}' AS rule_name,
        '{severity}' AS severity, {KEYS[name]} AS record_key FROM flag_{name} WHERE m{index}"""


META = f"""'{LOAD}' AS _bronze_load_id, '{TS}' AS _ingested_at_utc,
    'customers.csv' AS _source_file, 'core_customer_platform' AS _source_system"""


def part(column: str) -> str:
    return f"coalesce(length({column}) || ':' || {column}, '-')"


def digest(*columns: str) -> str:
    return f"md5(concat_ws('|', {', '.join(map(part, columns))}))"


CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "province", "customer_segment", "risk_tier",
    "created_at", "is_active",
)
META_COLUMNS = ("_bronze_load_id", "_ingested_at_utc", "_source_file", "_source_system")


def load_row(name: str, file: str, system: str, kind: str, columns: int) -> str:
    return f"""SELECT '{LOAD}' AS bronze_load_id, '{name}' AS dataset_name,
        '{file}' AS source_file, '{system}' AS source_system, '{kind}' AS file_format,
        count(*) AS row_count, CAST({columns} AS BIGINT) AS column_count,
        '{TS}' AS loaded_at_utc, 'success' AS status FROM raw_{name}"""


LOADS = (
    ("customers", "customers.csv", "core_customer_platform", "csv", 13),
    ("accounts", "accounts.csv", "core_banking_platform", "csv", 12),
    ("products", "products.csv", "product_reference_platform", "csv", 9),
    ("transactions", "transactions.csv", "payments_and_card_platforms", "csv", 16),
    ("customer_service_notes", "customer_service_notes.csv", "customer_service_platform", "csv",
     12),
    ("exchange_rates_api", "exchange_rates_api.json", "external_exchange_rate_api", "json", 11),
    ("fraud_alert_events", "fraud_alert_events.jsonl", "fraud_event_stream", "jsonl", 14),
)


def whole(role: str) -> str:
    return f"WITH {role_cte(role)} SELECT * FROM {role}"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Sources and sinks: what was written must come back.
    sql["src_csv_roundtrip"] = whole("raw_customer_service_notes")
    sql["src_json_array_roundtrip"] = whole("raw_exchange_rates_api")
    sql["src_json_array_split"] = (
        "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders"
    )
    sql["src_csv_headers"] = """SELECT doc_id, lang, '<' || replace(text, chr(13), chr(10)) || '>' AS text,
        CASE WHEN doc_id % 3 <> 2 THEN source END AS source FROM documents"""
    sql["src_jsonl_roundtrip"] = "SELECT * FROM documents"
    sql["src_table_scan"] = whole("transactions")
    sql["src_parquet_scan"] = "SELECT * FROM lineitem"
    sql["src_registry_dispatch"] = f"""WITH {role_cte(*RAW)} {' UNION ALL '.join(
        f"SELECT '{n}' AS dataset_name, '{k}' AS file_format, '{y}' AS source_system, "
        f"count(*) AS row_count FROM raw_{n}" for n, f, y, k, c in LOADS)}"""
    sql["output_loader"] = f"""{DASHBOARD_WITH} SELECT * FROM dashboard"""
    sql["snk_table_replace"] = whole("accounts")
    sql["snk_parquet_roundtrip"] = whole("fraud_alert_events")
    sql["snk_csv_roundtrip"] = f"{TRIAGE_WITH} SELECT * FROM triage"
    sql["table_row_counts"] = f"""WITH {role_cte(*RAW)} {' UNION ALL '.join(
        f"SELECT 'bronze' AS layer, 'bronze_{n}' AS table_name, count(*) AS row_count "
        f"FROM raw_{n}" for n in DATASETS)}"""

    # Layouts: whole days come back, two orders where a field tells, nothing where none does.
    day = "CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)"
    halved = "CAST(strftime(l_shipdate, '%Y-%m-%d %H:%M:00') AS TIMESTAMP)"
    told = "(day(l_shipdate) > 12 OR day(l_shipdate) = month(l_shipdate))"
    equal = "day(l_shipdate) % 12 + 1 = month(l_shipdate)"
    whole_days = ", ".join(f"{day} AS {name}" for name in ("us", "eu", "slashed", "named", "digits"))
    sql["std_date_layouts"] = f"""SELECT l_orderkey, l_linenumber, {whole_days}, {halved} AS half_day,
        CASE WHEN {told} THEN {day} END AS mixed,
        CASE WHEN {equal} THEN CAST(make_date(year(l_shipdate), month(l_shipdate), month(l_shipdate)) AS TIMESTAMP) END AS open
        FROM lineitem"""
    late, none = "count(*) FILTER (day(l_shipdate) > 12)", "0"
    first = "count(*) FILTER (day(l_shipdate) > 12 AND l_linenumber % 2 = 0)"
    second = "count(*) FILTER (day(l_shipdate) > 12 AND l_linenumber % 2 <> 0)"
    found = (
        ("us", "short/", none, late, "'month_first'"), ("eu", "short.", late, none, "'day_first'"),
        ("slashed", "year/slash", none, none, "NULL"), ("named", "day name", none, none, "NULL"),
        ("digits", "digits", none, none, "NULL"), ("half_day", "year-dash", none, none, "NULL"),
        ("mixed", "short/", first, second, "'mixed'"), ("open", "short-", none, none, "'ambiguous'"),
    )
    sql["std_date_layout_report"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, '{kind}' AS layout, count(*) AS "values", {a} AS first_over_12,
        {b} AS second_over_12, {order} AS field_order FROM lineitem WHERE l_shipdate IS NOT NULL"""
        for name, kind, a, b, order in found
    )

    # Bronze.
    sql["bronze_metadata"] = (
        f"WITH {role_cte('raw_customers')} SELECT *, {META} FROM raw_customers"
    )
    sql["bronze_row_hash"] = f"""WITH {role_cte('raw_customers')},
        meta AS (SELECT *, {META} FROM raw_customers)
        SELECT *, {digest(*CUSTOMER_COLUMNS, *META_COLUMNS)} AS _raw_row_hash,
        {digest(*CUSTOMER_COLUMNS)} AS source_hash FROM meta"""
    sql["bronze_load_audit"] = (
        f"WITH {role_cte(*RAW)} {' UNION ALL '.join(load_row(*row) for row in LOADS)}"
    )

    sql["bronze_metadata_files"] = f"""WITH {role_cte('raw_customers')}
        SELECT *, TRUE AS names_its_file FROM raw_customers"""

    # Standardisation.
    sql["std_headers"] = f"""WITH {role_cte('raw_customers')}
        SELECT customer_id, first_name, last_name, province FROM raw_customers"""
    sql["std_trim_text"] = f"""WITH {role_cte('dirty_documents')}
        SELECT doc_id, {s('text')} AS text, {s('lang')} AS lang, _source FROM dirty_documents"""
    sql["std_dates"] = f"""WITH {role_cte('raw_transactions')}
        SELECT transaction_id, TRY_CAST(transaction_timestamp AS TIMESTAMP)
        AS transaction_timestamp FROM raw_transactions"""
    sql["std_dates_zoned"] = f"""WITH {role_cte('transactions')}
        SELECT transaction_id, CAST(transaction_timestamp AS TIMESTAMP)
            + INTERVAL 10 HOUR - INTERVAL 1 MINUTE * CASE transaction_id % 4 WHEN 0 THEN 300
                WHEN 1 THEN -210 ELSE 0 END AS transaction_timestamp FROM transactions"""
    sql["std_numerics"] = f"""WITH {role_cte('raw_transactions')}
        SELECT transaction_id, {number('amount')} AS amount FROM raw_transactions"""
    sql["std_lowercase"] = f"""WITH {role_cte('raw_accounts')}
        SELECT account_id, lower({s('account_status')}) AS account_status,
        lower({s('currency')}) AS currency FROM raw_accounts"""
    sql["std_transaction_date"] = f"""WITH {role_cte('transactions')}
        SELECT transaction_id, transaction_timestamp,
        CAST(transaction_timestamp AS DATE) AS transaction_date FROM transactions"""
    for name in DATASETS:
        sql[f"std_full_{name}"] = f"""WITH {role_cte(f'raw_{name}')}, {std_cte(name)}
            SELECT *, '{TS}' AS _silver_processed_at_utc FROM std_{name}"""

    # Validation.
    sql["val_required"] = one_rule("transactions", "customer_id_required")
    sql["val_unique_key"] = one_rule("transactions", "transaction_id_must_be_unique")
    sql["val_unique_key_nulls"] = one_rule("customers", "customer_id_must_be_unique")
    sql["val_positive_amount"] = one_rule("transactions", "amount_must_be_positive")
    sql["val_currency_transactions"] = one_rule("transactions", "currency_must_be_cad")
    sql["val_currency_accounts"] = one_rule("accounts", "currency_must_be_cad")
    sql["val_positive_rate"] = one_rule("exchange_rates_api", "exchange_rate_must_be_positive")
    sql["val_score_range"] = one_rule("fraud_alert_events", "risk_score_between_zero_and_one")
    for name in DATASETS:
        sql[f"val_valid_rows_{name}"] = f"""{checked_with(name)} SELECT * EXCLUDE ({', '.join(
            f'm{i}' for i in range(len(RULES[name])))}), '{TS}' AS _silver_processed_at_utc
            FROM flag_{name} WHERE {valid(name)}"""
    sql["val_null_currency_dropped"] = f"""{checked_with('accounts')}
        SELECT account_id, customer_id, current_balance FROM flag_accounts
        WHERE currency IS NULL AND NOT m0 AND NOT m1 AND NOT m2 AND NOT m3"""
    sql["val_rejects"] = f"""{checked_with('transactions')}, hits AS ({hits('transactions')})
        SELECT *, '{TS}' AS rejected_at_utc FROM hits"""
    sql["val_reject_union"] = f"{HITS_WITH} SELECT *, '{TS}' AS rejected_at_utc FROM hits"
    for name in DATASETS:
        masks = ", ".join(f"m{i}" for i in range(len(RULES[name])))
        sql[f"val_reject_payload_{name}"] = checked_with(name) + " UNION ALL ".join(
            f" SELECT '{name}' AS dataset_name, '{rule}' AS rule_name, '{severity}' AS severity, "
            f"* EXCLUDE ({masks}), '{TS}' AS _silver_processed_at_utc FROM flag_{name} WHERE m{i}"
            for i, (rule, severity) in enumerate(RULES[name])
        )
    sql["val_reject_replay"] = f"""{checked_with('transactions')},
        lone AS (SELECT DISTINCT * FROM flag_transactions WHERE m3 AND NOT coalesce(m0, false)
            AND NOT coalesce(m1, false) AND NOT coalesce(m2, false)
            AND NOT coalesce(m4, false) AND NOT coalesce(m5, false)),
        once AS (SELECT transaction_id FROM lone GROUP BY transaction_id HAVING count(*) = 1)
        SELECT * EXCLUDE (m0, m1, m2, m3, m4, m5), '{TS}' AS _silver_processed_at_utc
        FROM lone SEMI JOIN once USING (transaction_id) WHERE NOT (m0 OR m1 OR m2 OR m4 OR m5)"""
    sql["val_transform_audit"] = f"{AUDIT_WITH} SELECT * FROM audit"

    # Gold.
    for key, fact in (
        ("gold_account_agg", "account"), ("gold_transaction_agg", "transaction"),
        ("gold_fraud_agg", "alert"), ("gold_service_agg", "case"),
    ):
        sql[key] = f"WITH {role_cte(FACTS[fact][0])} {one_fact(fact)}"
    sql["gold_fine_sums"] = """SELECT event_type, count(*) AS n,
        round(sum(value / 250 / 7), 6) AS total, round(avg(value / 250 / 7), 9) AS mean
        FROM events GROUP BY event_type"""
    sql["gold_exact_sums"] = """SELECT event_type, count(value) AS n,
        round(fsum(value / 250 / 7), 6) AS total, round(fsum(value / 250 / 7) / count(value), 9) AS mean
        FROM events GROUP BY event_type"""
    sql["gold_customer_360"] = f"{CUSTOMER_360_WITH} SELECT * FROM customer_360"
    sql["gold_daily_summary"] = f"WITH {role_cte('transactions')} {DAILY}"
    sql["gold_account_transactions"] = f"""WITH {role_cte('transactions')},
        per_account AS ({PER_ACCOUNT})
        SELECT account_id, moves AS transaction_count,
        round(CAST(moved AS DOUBLE), 2) AS total_transaction_amount,
        round(CAST(moved AS DOUBLE) / amounts, 2) AS average_transaction_amount FROM per_account"""
    sql["gold_product_performance"] = f"{PRODUCT_WITH} SELECT * FROM product_performance"
    sql["gold_reject_summary"] = f"{HITS_WITH} {REJECT_SUMMARY}"
    sql["gold_dq_dashboard"] = f"{DASHBOARD_WITH} SELECT * FROM dashboard"

    # Features.
    sql["ml_features"] = f"{CUSTOMER_360_WITH} SELECT {FEATURES} FROM customer_360"
    sql["ml_ratios"] = f"""{FEATURES_WITH} SELECT customer_id, international_transaction_ratio,
        fraud_review_ratio, transactions_per_account FROM features"""
    sql["ml_high_risk_label"] = f"""{FEATURES_WITH} SELECT customer_id, risk_tier,
        maximum_fraud_risk_score, fraud_review_count, high_priority_case_count,
        synthetic_high_risk_label FROM features"""
    sql["ml_feature_table"] = f"{FEATURES_WITH} SELECT * FROM features"

    # Triage.
    sql["triage_owner"] = (
        f"{DASHBOARD_WITH} SELECT dataset_name, {OWNER} AS recommended_owner FROM dashboard"
    )
    sql["triage_status"] = (
        f"{DASHBOARD_WITH} SELECT dataset_name, {STATUS} AS triage_status FROM dashboard"
    )
    sql["triage_priority"] = (
        f"{DASHBOARD_WITH} SELECT dataset_name, {PRIORITY} AS priority FROM dashboard"
    )
    sql["triage_issue_id"] = (
        f"{DASHBOARD_WITH} SELECT dataset_name, {ISSUE_ID} AS issue_id FROM dashboard"
    )
    sql["triage_action"] = (
        f"{DASHBOARD_WITH} SELECT dataset_name, {ACTION} AS recommended_action FROM dashboard"
    )
    sql["triage_top_rules"] = f"""{TRIAGE_WITH} SELECT dataset_name, top5 AS top_failed_rules
        FROM top_rules"""
    sql["triage_top_rules_by_name"] = f"""{checked_with('transactions')},
        hits AS ({hits('transactions')}) SELECT rule_name, count(*) AS rule_hits FROM hits
        GROUP BY rule_name ORDER BY rule_hits DESC, rule_name LIMIT 5"""
    sql["triage_summary"] = (
        f"{TRIAGE_WITH} SELECT dataset_name, plain_language_summary FROM triage"
    )
    sql["triage_ordered"] = f"""{DASHBOARD_WITH} SELECT dataset_name, bronze_table, silver_table,
        bronze_row_count, silver_row_count, acceptance_rate, critical_reject_rule_hits,
        high_reject_rule_hits, medium_reject_rule_hits, total_reject_rule_hits,
        processed_at_utc, status FROM dashboard
        ORDER BY total_reject_rule_hits DESC, dataset_name"""
    sql["triage_table"] = f"{TRIAGE_WITH} SELECT * FROM triage"
    sql["governance_log"] = f"""{TRIAGE_WITH} SELECT issue_id, dataset_name, priority,
        triage_status, recommended_owner, plain_language_summary, recommended_action,
        created_at_utc FROM triage"""

    # Reports.
    sql["rpt_layer_counts"] = f"""{COUNTS_WITH}, {silver_cte('transactions')}
        SELECT * FROM counts
        UNION ALL SELECT 'gold', 'gold_customer_360', silver_row_count FROM audit
            WHERE dataset_name = 'customers'
        UNION ALL SELECT 'gold', 'gold_daily_transaction_summary', count(*) FROM ({DAILY})
        UNION ALL SELECT 'gold', 'gold_product_performance', silver_row_count FROM audit
            WHERE dataset_name = 'products'
        UNION ALL SELECT 'gold', 'gold_data_quality_dashboard', count(*) FROM audit
        UNION ALL SELECT 'ml_features', 'ml_customer_risk_features', silver_row_count FROM audit
            WHERE dataset_name = 'customers'
        UNION ALL SELECT 'ai_automation', 'ai_pipeline_triage', count(*) FROM audit"""
    sql["rpt_layer_summary"] = f"""SELECT layer, count(table_name) AS table_count,
        CAST(sum(row_count) AS BIGINT) AS total_rows FROM ({sql['rpt_layer_counts']})
        GROUP BY layer"""
    sql["rpt_kpis"] = f"""{AUDIT_WITH}, {silver_cte(*CLEAN_360)}, {CUSTOMER_360_CTES}
        SELECT 'silver_transactions' AS kpi, silver_row_count AS value FROM audit
            WHERE dataset_name = 'transactions'
        UNION ALL SELECT 'customer_360_records', count(*) FROM customer_360
        UNION ALL SELECT 'dq_rule_hits', count(*) FROM hits
        UNION ALL SELECT 'high_risk_customers', CAST(sum(synthetic_high_risk_label) AS BIGINT)
            FROM (SELECT {LABEL} FROM customer_360)"""
    sql["rpt_dq_display"] = f"""{DASHBOARD_WITH} SELECT dataset_name, bronze_row_count,
        silver_row_count, round(acceptance_rate * 100, 2) AS acceptance_rate_pct,
        critical_reject_rule_hits, high_reject_rule_hits, total_reject_rule_hits FROM dashboard"""
    sql["rpt_rule_hits"] = (
        f"{DASHBOARD_WITH} SELECT dataset_name, total_reject_rule_hits FROM dashboard"
    )
    sql["rpt_triage_display"] = f"""{TRIAGE_WITH} SELECT issue_id, dataset_name, priority,
        triage_status, recommended_owner, total_reject_rule_hits, plain_language_summary,
        recommended_action FROM triage"""
    sql["rpt_customer_sample"] = f"""{CUSTOMER_360_WITH} SELECT customer_id, province,
        customer_segment, risk_tier, account_count, transaction_count, total_transaction_amount,
        fraud_alert_count, service_case_count FROM customer_360 ORDER BY customer_id LIMIT 100"""
    sql["rpt_segment_summary"] = f"""{CUSTOMER_360_WITH} SELECT customer_segment,
        count(customer_id) AS customers, round(avg(transaction_count), 4) AS avg_transactions,
        round(CAST(sum(CAST(total_current_balance AS DECIMAL(38, 2))) AS DOUBLE) / count(total_current_balance), 2) AS avg_balance FROM customer_360
        WHERE customer_segment IS NOT NULL GROUP BY customer_segment"""
    sql["rpt_product_totals"] = (
        f"{PRODUCT_WITH} SELECT product_name, total_transaction_amount FROM product_performance"
    )
    sql["rpt_risk_summary"] = f"""{FEATURES_WITH} SELECT risk_tier, synthetic_high_risk_label,
        count(customer_id) AS customers FROM features WHERE risk_tier IS NOT NULL GROUP BY 1, 2"""
    sql["rpt_activity_points"] = f"""{FEATURES_WITH} SELECT transaction_count,
        maximum_fraud_risk_score, fraud_alert_count, customer_id, risk_tier, customer_segment
        FROM features"""
    sql["rpt_feature_sample"] = f"""{FEATURES_WITH} SELECT customer_id, province,
        customer_segment, risk_tier, transaction_count, international_transaction_ratio,
        fraud_review_ratio, synthetic_high_risk_label FROM features
        ORDER BY customer_id LIMIT 100"""

    # Checks, gates and the whole refresh.
    sql["chk_null_keys"] = f"""WITH {role_cte('fraud_alert_events')}
        SELECT count(*) AS null_keys FROM fraud_alert_events WHERE customer_id IS NULL"""
    sql["chk_row_counts"] = f"""{CUSTOMER_360_WITH} SELECT 'gold_customer_360' AS table_name,
        count(*) AS row_count, (SELECT count(*) FROM customer) AS expected_rows,
        count(*) = (SELECT count(*) FROM customer) AS passed FROM customer_360"""
    sql["chk_point_lookup"] = f"""{DASHBOARD_WITH} SELECT dataset_name, total_reject_rule_hits,
        acceptance_rate FROM dashboard WHERE dataset_name = 'transactions'"""
    gate_roles = ("customers", "transactions", "accounts")
    sql["gate_report"] = f"""WITH {role_cte(*(f'raw_{n}' for n in gate_roles))},
        {std_cte(*gate_roles)},
        measured AS (
            SELECT 'customer_id_completeness' AS gate,
                avg(CASE WHEN customer_id IS NOT NULL THEN 1.0 ELSE 0.0 END) AS measured,
                CAST(0.99 AS DOUBLE) AS gate_limit, TRUE AS minimum FROM std_customers
            UNION ALL SELECT 'transaction_id_completeness',
                avg(CASE WHEN transaction_id IS NOT NULL THEN 1.0 ELSE 0.0 END),
                CAST(0.995 AS DOUBLE), TRUE FROM std_transactions
            UNION ALL SELECT 'duplicate_transaction_rate',
                avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END), CAST(0.001 AS DOUBLE), FALSE
                FROM (SELECT count(*) OVER (PARTITION BY transaction_id) AS n
                      FROM std_transactions)
            UNION ALL SELECT 'negative_balance_rate',
                avg(CASE WHEN current_balance < 0 THEN 1.0 ELSE 0.0 END), CAST(0.005 AS DOUBLE),
                FALSE FROM std_accounts WHERE current_balance IS NOT NULL)
        SELECT gate, round(measured, 9) AS measured, gate_limit,
            CASE WHEN minimum THEN measured >= gate_limit ELSE measured <= gate_limit END AS passed
        FROM measured"""
    sql["gate_verdict"] = f"""SELECT count(*) AS gates, count(*) FILTER (WHERE NOT passed)
        AS broken_gates, ifnull(string_agg(gate, ', ' ORDER BY gate) FILTER (WHERE NOT passed), '')
        AS broken_names, CASE WHEN bool_and(passed) THEN 'passed' ELSE 'breach' END AS run_verdict
        FROM ({sql['gate_report']})"""
    sql["full_refresh_rejects"] = sql["val_reject_union"]
    sql["full_refresh_transform_audit"] = sql["val_transform_audit"]
    sql["full_refresh_load_audit"] = sql["bronze_load_audit"]
    sql["full_refresh_issue_log"] = sql["governance_log"]
    sql["full_refresh"] = f"{DASHBOARD_WITH} SELECT * FROM dashboard"
    sql["full_refresh_customer_360"] = f"{FRESH_360_WITH} SELECT * FROM customer_360"
    sql["full_refresh_features"] = f"""{FRESH_360_WITH}
        SELECT {FEATURES}, {RATIOS}, {LABEL} FROM customer_360"""
    sql["full_refresh_daily_summary"] = f"""{checked_with('transactions')},
        {silver_cte('transactions')} {DAILY}"""
    sql["full_refresh_product_performance"] = f"""{checked_with(*PRODUCT_ROLES)},
        {silver_cte(*PRODUCT_ROLES)}, {PRODUCT_CTES} SELECT * FROM product_performance"""
    sql["full_refresh_triage"] = f"{TRIAGE_WITH} SELECT * FROM triage"
    return sql
