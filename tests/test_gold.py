import pytest
from pyspark.sql import functions as F

from oreflow.operators import features, gold

D = "double"


@pytest.fixture(scope="module")
def bank(spark):
    """Four customers: busy, idle, one with alerts only, one with a high tier."""
    ts = "TIMESTAMP_NTZ'2024-01-0{} 00:00:00'"
    customers = spark.sql(f"""SELECT * FROM VALUES
        ('c1', 'on', 'retail', 'low', {ts.format(1)}, true),
        ('c2', 'qc', 'student', 'low', {ts.format(2)}, false),
        ('c3', 'bc', CAST(NULL AS STRING), CAST(NULL AS STRING), {ts.format(3)}, true),
        ('c4', 'bc', 'retail', 'high', {ts.format(3)}, true)
        AS t(customer_id, province, customer_segment, risk_tier, created_at, is_active)""")
    accounts = spark.createDataFrame(
        [("a1", "c1", "p1", "active", 10.0), ("a2", "c1", "p1", "closed", -5.5),
         ("a3", "c1", "p2", "active", None), ("a9", "gone", "p9", "active", 1.0)],
        "account_id string, customer_id string, product_id string, account_status string, "
        "current_balance double",
    )
    transactions = spark.sql(f"""SELECT * FROM VALUES
        ('a1', 'c1', 10.0D, {ts.format(1)}, true, 'web', 'x', 'fee'),
        ('a1', 'c1', 20.0D, {ts.format(4)}, false, 'atm', 'x', 'fee'),
        ('a2', 'c1', 0.01D, {ts.format(2)}, false, 'web', CAST(NULL AS STRING), 'fee'),
        ('a7', 'c4', 5.0D, {ts.format(2)}, CAST(NULL AS BOOLEAN), NULL, NULL, 'fee')
        AS t(account_id, customer_id, amount, transaction_timestamp, is_international, channel,
             merchant_category, transaction_type)""").withColumn(
        "transaction_date", F.to_date("transaction_timestamp"))
    alerts = spark.createDataFrame(
        [("c3", 0.8496, "review"), ("c3", 0.1, "monitor"), (None, 0.99, "review")],
        "customer_id string, risk_score double, recommended_action string",
    )
    notes = spark.sql(f"""SELECT * FROM VALUES
        ('c1', 'high', 'open', {ts.format(1)}), ('c1', 'high', 'in_progress', {ts.format(2)}),
        ('c1', 'low', 'closed', {ts.format(3)})
        AS t(customer_id, priority, case_status, created_at)""")
    products = spark.createDataFrame(
        [("p1", "one", "deposit", "core"), ("p2", "two", "loan", "core"),
         ("p3", "three", "loan", "core")],
        "product_id string, product_name string, product_type string, business_domain string",
    )
    return {"customers": customers, "accounts": accounts, "transactions": transactions,
            "alerts": alerts, "notes": notes, "products": products}


@pytest.fixture(scope="module")
def mart(bank):
    return gold.customer_360(
        bank["customers"], bank["accounts"], bank["transactions"], bank["alerts"], bank["notes"]
    ).persist()


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_customer_360(mart):
    rows = by_key(mart, "customer_id")
    assert len(rows) == 4 and len(mart.columns) == 25
    busy, idle, alerted, tier = (rows[c] for c in ("c1", "c2", "c3", "c4"))
    assert (busy.account_count, busy.product_count, busy.active_account_count) == (3, 2, 2)
    assert (busy.total_current_balance, busy.average_current_balance) == (4.5, 2.25)
    assert (busy.transaction_count, busy.total_transaction_amount) == (3, 30.01)
    assert (busy.average_transaction_amount, busy.channel_count) == (10.0, 2)
    assert str(busy.most_recent_transaction_at) == "2024-01-04 00:00:00"
    assert busy.international_transaction_count == 1
    assert (busy.service_case_count, busy.high_priority_case_count, busy.open_case_count) == (3, 2, 2)
    assert tuple(idle)[6:14] == (0, 0, 0, 0.0, 0.0, 0, 0.0, 0.0)
    assert idle.most_recent_transaction_at is None and idle.most_recent_service_case_at is None
    assert (alerted.fraud_alert_count, alerted.maximum_fraud_risk_score) == (2, 0.85)
    assert alerted.average_fraud_risk_score == 0.475 and alerted.fraud_review_count == 1
    assert (tier.channel_count, tier.international_transaction_count) == (0, 0)


def test_unique_accounts_shortcut_agrees(bank):
    args = [bank[k] for k in ("customers", "accounts", "transactions", "alerts", "notes")]
    plain = sorted(map(tuple, gold.customer_360(*args).collect()))
    assert plain == sorted(map(tuple, gold.customer_360(*args, unique_accounts=True).collect()))
    args = [bank[k] for k in ("products", "accounts", "transactions")]
    plain = sorted(map(tuple, gold.product_performance(*args).collect()))
    assert plain == sorted(map(tuple, gold.product_performance(*args, unique_accounts=True).collect()))


def test_alerts_without_customer_form_a_group(bank):
    assert by_key(gold.fraud_totals(bank["alerts"]), "customer_id")[None].fraud_alert_count == 1


def test_daily_summary_keeps_null_groups_and_totals(bank):
    daily = gold.daily_transaction_summary(bank["transactions"])
    assert daily.count() == 4
    totals = daily.agg(F.sum("transaction_count"), F.sum("total_transaction_amount")).first()
    assert tuple(totals) == (4, pytest.approx(35.01))
    assert daily.filter("merchant_category IS NULL").count() == 2


def test_product_performance(bank):
    rows = by_key(
        gold.product_performance(bank["products"], bank["accounts"], bank["transactions"]),
        "product_id",
    )
    one, two, three = rows["p1"], rows["p2"], rows["p3"]
    assert (one.account_count, one.customer_count, one.total_current_balance) == (2, 1, 4.5)
    # mean of the accounts' means (15 and 0.01), not of the three amounts
    assert (one.transaction_count, one.total_transaction_amount) == (3, 30.01)
    assert one.average_transaction_amount == 7.51
    assert (two.account_count, two.total_current_balance, two.transaction_count) == (1, None, 0)
    assert tuple(three)[4:] == (0, 0, None, None, 0, 0.0, 0.0)


def test_repeated_products_count_their_accounts_again(bank):
    twice = bank["products"].union(bank["products"])
    joined = (
        twice.join(bank["accounts"], "product_id", "left")
        .groupBy("product_id")
        .agg(F.sum("current_balance").alias("s"), F.countDistinct("account_id").alias("n"))
    )
    want = {r.product_id: (r.s, r.n) for r in joined.collect()}
    got = gold.product_performance(twice, bank["accounts"], bank["transactions"]).collect()
    assert {r.product_id: (r.total_current_balance, r.account_count) for r in got} == want


def test_features(mart):
    table = features.customer_risk_features(mart)
    assert table.columns == [
        *features.FEATURE_COLUMNS, "international_transaction_ratio", "fraud_review_ratio",
        "transactions_per_account", "synthetic_high_risk_label",
    ]
    rows = by_key(table, "customer_id")
    assert rows["c1"].international_transaction_ratio == pytest.approx(1 / 3)
    assert rows["c1"].transactions_per_account == 1.0
    assert rows["c2"].fraud_review_ratio == 0.0
    # c1: two high cases; c3: score 0.8496 rounds up to the limit; c4: tier
    labels = {k: r.synthetic_high_risk_label for k, r in rows.items()}
    assert labels == {"c1": 1, "c2": 0, "c3": 1, "c4": 1}
    assert table.schema["synthetic_high_risk_label"].dataType.simpleString() == "int"
