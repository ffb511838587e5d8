"""The seven supported datasets."""

from oreflow.model import CRITICAL, HIGH, DatasetSpec, Rule, SourceSpec, text_schema
from oreflow.operators.masks import not_equal, not_positive, outside

# File names, formats, delivering systems and column order.
SOURCES: dict[str, SourceSpec] = {
    spec.name: spec
    for spec in (
        SourceSpec(
            "customers", "customers.csv", "csv", "core_customer_platform",
            text_schema(
                "customer_id", "first_name", "last_name", "province",
                "customer_segment", "risk_tier", "created_at", "is_active",
            ),
        ),
        SourceSpec(
            "accounts", "accounts.csv", "csv", "core_banking_platform",
            text_schema(
                "account_id", "customer_id", "product_id", "account_status",
                "opened_at", "current_balance", "currency",
            ),
        ),
        SourceSpec(
            "products", "products.csv", "csv", "product_reference_platform",
            text_schema("product_id", "product_name", "product_type", "business_domain"),
        ),
        SourceSpec(
            "transactions", "transactions.csv", "csv", "payments_and_card_platforms",
            text_schema(
                "transaction_id", "account_id", "customer_id", "transaction_timestamp",
                "transaction_type", "channel", "merchant_category", "amount",
                "currency", "is_international", "ingestion_source",
            ),
        ),
        SourceSpec(
            "customer_service_notes", "customer_service_notes.csv", "csv",
            "customer_service_platform",
            text_schema(
                "case_id", "customer_id", "created_at", "issue_type",
                "priority", "case_note", "case_status",
            ),
        ),
        SourceSpec(
            "exchange_rates_api", "exchange_rates_api.json", "json",
            "external_exchange_rate_api",
            text_schema(
                "rate_date", "base_currency", "target_currency",
                "exchange_rate", "source_system", "loaded_at",
            ),
        ),
        SourceSpec(
            "fraud_alert_events", "fraud_alert_events.jsonl", "jsonl", "fraud_event_stream",
            text_schema(
                "event_id", "transaction_id", "customer_id", "account_id",
                "event_timestamp", "risk_score", "alert_reason",
                "recommended_action", "event_source",
            ),
        ),
    )
}

_CAD = Rule("currency_must_be_cad", HIGH, "currency", not_equal("cad"))

# Required columns, keys, rule names and severities.
DATASETS: dict[str, DatasetSpec] = {
    spec.name: spec
    for spec in (
        DatasetSpec("customers", ("customer_id",), "customer_id"),
        DatasetSpec(
            "accounts", ("account_id", "customer_id", "product_id"), "account_id", (_CAD,)
        ),
        DatasetSpec("products", ("product_id", "product_name"), "product_id"),
        DatasetSpec(
            "transactions",
            ("transaction_id", "account_id", "customer_id"),
            "transaction_id",
            (Rule("amount_must_be_positive", CRITICAL, "amount", not_positive), _CAD),
        ),
        DatasetSpec("customer_service_notes", ("case_id", "customer_id"), "case_id"),
        DatasetSpec(
            "exchange_rates_api",
            ("rate_date", "target_currency", "exchange_rate"),
            None,
            (
                Rule(
                    "exchange_rate_must_be_positive", CRITICAL, "exchange_rate", not_positive
                ),
            ),
        ),
        DatasetSpec(
            "fraud_alert_events",
            ("event_id", "transaction_id", "account_id"),
            "event_id",
            (
                Rule(
                    "risk_score_between_zero_and_one", CRITICAL, "risk_score",
                    outside(0.0, 1.0),
                ),
            ),
        ),
    )
}
