"""The banking datasets, derived from the given star-schema tables.

Each role is one SELECT that Spark and DuckDB both read; `{table}` names an
input table and `{ts}` the zone-less timestamp type. The clean roles are typed
like silver tables. The raw roles are text like bronze tables and carry faults
(blank, missing, repeated or unreadable values) spread over all rows by CASE
expressions, so that both engines see the same faults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "customer", "documents", "events", "lineitem", "nation", "orders", "part", "supplier",
)

ROLES: dict[str, str] = {
    "customers": """
        SELECT c_custkey AS customer_id,
               lower(n_name) AS province,
               CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE lower(c_mktsegment) END
                   AS customer_segment,
               CASE WHEN c_custkey % 70 = 1 THEN NULL WHEN c_acctbal < 0 THEN 'high'
                    WHEN c_acctbal < 3000 THEN 'medium' ELSE 'low' END AS risk_tier,
               CAST(concat(CAST(2000 + c_custkey % 24 AS STRING), '-01-15') AS {ts}) AS created_at,
               c_custkey % 13 <> 0 AS is_active
        FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey""",
    "accounts": """
        SELECT o_orderkey AS account_id,
               o_custkey AS customer_id,
               o_orderkey % 150 AS product_id,
               CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'dormant' ELSE 'closed' END
                   AS account_status,
               o_orderdate AS opened_at,
               o_totalprice AS current_balance,
               'cad' AS currency
        FROM {orders}""",
    "products": """
        SELECT p_partkey AS product_id,
               lower(p_name) AS product_name,
               lower(p_type) AS product_type,
               lower(p_brand) AS business_domain
        FROM {part}""",
    "transactions": """
        SELECT l_orderkey * 100 + l_linenumber AS transaction_id,
               l_orderkey AS account_id,
               o_custkey AS customer_id,
               l_shipdate AS transaction_timestamp,
               lower(l_returnflag) AS transaction_type,
               lower(l_linestatus) AS channel,
               CASE WHEN l_suppkey % 8 = 5 THEN NULL ELSE CAST(l_suppkey % 8 AS STRING) END
                   AS merchant_category,
               l_extendedprice AS amount,
               'cad' AS currency,
               l_discount > 0.05 AS is_international,
               CAST(l_shipdate AS DATE) AS transaction_date
        FROM {lineitem} LEFT JOIN {orders} ON l_orderkey = o_orderkey""",
    "fraud_alert_events": """
        SELECT event_id,
               event_id AS transaction_id,
               CASE WHEN event_id % 29 = 3 THEN NULL ELSE user_id END AS customer_id,
               event_id AS account_id,
               ts AS event_timestamp,
               value / 250 AS risk_score,
               event_type AS alert_reason,
               CASE WHEN value / 250 >= 0.75 THEN 'review' ELSE 'monitor' END
                   AS recommended_action
        FROM {events}""",
    "customer_service_notes": """
        SELECT o_orderkey AS case_id,
               o_custkey AS customer_id,
               o_orderdate AS created_at,
               lower(o_orderpriority) AS issue_type,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' ELSE 'low' END AS priority,
               CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'in_progress'
                    ELSE 'closed' END AS case_status
        FROM {orders}""",
    "raw_customers": """
        SELECT CASE WHEN c_custkey % 211 = 5 THEN '  ' WHEN c_custkey % 307 = 7 THEN NULL
                    WHEN c_custkey % 173 = 9 THEN '1' ELSE CAST(c_custkey AS STRING) || ' ' END
                   AS customer_id,
               c_name AS first_name,
               c_mktsegment AS last_name,
               chr(9) || n_name || ' ' AS province,
               CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_mktsegment END AS customer_segment,
               CASE WHEN c_acctbal < 0 THEN ' HIGH' WHEN c_acctbal < 3000 THEN 'Medium'
                    ELSE 'low ' END AS risk_tier,
               CASE WHEN c_custkey % 101 = 3 THEN 'not a date'
                    ELSE concat(CAST(2000 + c_custkey % 24 AS STRING), '-01-15') END AS created_at,
               CASE WHEN c_custkey % 13 <> 0 THEN 'True' ELSE 'False' END AS is_active
        FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey""",
    "raw_accounts": """
        SELECT CASE WHEN o_orderkey % 997 = 13 THEN '13' ELSE CAST(o_orderkey AS STRING) END
                   AS account_id,
               CASE WHEN o_orderkey % 331 = 17 THEN NULL ELSE CAST(o_custkey AS STRING) END
                   AS customer_id,
               CAST(o_orderkey % 150 AS STRING) AS product_id,
               CASE o_orderstatus WHEN 'O' THEN ' Active' WHEN 'P' THEN 'DORMANT'
                    ELSE 'closed ' END AS account_status,
               CAST(o_orderdate AS STRING) AS opened_at,
               CASE WHEN o_orderkey % 89 = 1 THEN 'abc'
                    WHEN o_orderkey % 83 = 2 THEN CAST(-o_totalprice AS STRING)
                    ELSE CAST(o_totalprice AS STRING) END AS current_balance,
               CASE WHEN o_orderkey % 61 = 3 THEN 'USD' WHEN o_orderkey % 67 = 5 THEN NULL
                    ELSE ' CAD' END AS currency
        FROM {orders}""",
    "raw_products": """
        SELECT CASE WHEN p_partkey % 401 = 11 THEN NULL ELSE CAST(p_partkey AS STRING) END
                   AS product_id,
               CASE WHEN p_partkey % 97 = 3 THEN chr(9) || ' ' ELSE upper(p_name) END
                   AS product_name,
               p_type AS product_type,
               p_brand || ' ' AS business_domain
        FROM {part}""",
    "raw_transactions": """
        SELECT CAST(l_orderkey * 100 + l_linenumber AS STRING) AS transaction_id,
               CAST(l_orderkey AS STRING) AS account_id,
               CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END
                   AS customer_id,
               CASE WHEN l_partkey % 113 = 9 THEN 'soon' ELSE CAST(l_shipdate AS STRING) END
                   AS transaction_timestamp,
               ' ' || l_returnflag AS transaction_type,
               l_linestatus || chr(9) AS channel,
               CASE WHEN l_suppkey % 8 = 5 THEN NULL ELSE CAST(l_suppkey % 8 AS STRING) END
                   AS merchant_category,
               CASE WHEN l_partkey % 53 = 1 THEN '-1' WHEN l_partkey % 59 = 2 THEN 'junk'
                    WHEN l_partkey % 71 = 3 THEN 'NaN'
                    ELSE CAST(l_extendedprice AS STRING) END AS amount,
               CASE WHEN l_suppkey % 37 = 4 THEN 'UNKNOWN' WHEN l_suppkey % 41 = 5 THEN NULL
                    ELSE 'Cad ' END AS currency,
               CASE WHEN l_discount > 0.05 THEN 'True' ELSE 'False' END AS is_international,
               'Batch_Core ' AS ingestion_source
        FROM {lineitem} LEFT JOIN {orders} ON l_orderkey = o_orderkey""",
    "raw_customer_service_notes": """
        SELECT CAST(o_orderkey AS STRING) AS case_id,
               CASE WHEN o_orderkey % 401 = 19 THEN ' ' ELSE CAST(o_custkey AS STRING) END
                   AS customer_id,
               CAST(o_orderdate AS STRING) AS created_at,
               o_orderpriority AS issue_type,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN ' High '
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' ELSE 'low' END AS priority,
               ' He said "' || o_orderpriority || '", then left ' AS case_note,
               CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'P' THEN ' IN_PROGRESS'
                    ELSE 'closed' END AS case_status
        FROM {orders}""",
    "raw_exchange_rates_api": """
        SELECT CASE WHEN s_suppkey % 17 = 2 THEN 'bad' ELSE '2024-01-01' END AS rate_date,
               'CAD' AS base_currency,
               CASE WHEN s_suppkey % 19 = 3 THEN ' ' ELSE s_name END AS target_currency,
               CASE WHEN s_suppkey % 23 = 4 THEN 'unknown' ELSE CAST(s_acctbal AS STRING) END
                   AS exchange_rate,
               ' API' AS source_system,
               '2024-01-02 03:04:05' AS loaded_at
        FROM {supplier}""",
    "raw_fraud_alert_events": """
        SELECT CAST(event_id AS STRING) AS event_id,
               CASE WHEN event_id % 113 = 7 THEN NULL ELSE CAST(event_id AS STRING) END
                   AS transaction_id,
               CASE WHEN event_id % 29 = 3 THEN NULL ELSE CAST(user_id AS STRING) END
                   AS customer_id,
               CAST(event_id AS STRING) AS account_id,
               CAST(ts AS STRING) AS event_timestamp,
               CASE WHEN event_id % 103 = 8 THEN 'severe' ELSE CAST(value / 250 AS STRING) END
                   AS risk_score,
               upper(event_type) AS alert_reason,
               CASE WHEN value / 250 >= 0.75 THEN 'Review' ELSE 'Monitor' END
                   AS recommended_action,
               'Stream' AS event_source
        FROM {events}""",
    "dirty_documents": """
        SELECT doc_id,
               chr(9) || ' ' || text || chr(13) || chr(10) AS text,
               CASE WHEN doc_id % 7 = 0 THEN chr(10) || lang ELSE lang || '  ' END AS lang,
               ' ' || source AS _source
        FROM {documents}""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def role(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A role as a Spark frame."""
    query = ROLES[name].replace("{ts}", "TIMESTAMP_NTZ")
    inputs = {t: table(spark, folder, t) for t in TABLES if "{" + t + "}" in query}
    return spark.sql(query, **inputs)


def role_cte(*names: str) -> str:
    """The same roles as CTEs of a DuckDB query."""
    plain = {t: t for t in TABLES} | {"ts": "TIMESTAMP"}
    return ",\n".join(f"{name} AS ({ROLES[name].format(**plain)})" for name in names)
