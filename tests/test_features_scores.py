import pytest
from pyspark.sql import functions as F

from shelfmark.operators import churn, measures, risk, star
from shelfmark.operators.features import (
    ChurnWindow, churn_dataset, churn_metadata, customer_feature_view, customer_features,
)
from shelfmark.operators.rfm import rfm_scores, segment_domain_checks
from shelfmark.operators.validate import union_all
from shelfmark.plans import reports
from shelfmark.sources.adapter import Tables

DAY = "2024-06-30"


@pytest.fixture(scope="module")
def shop(spark, make):
    customers = make.customers([
        (i, f"C{i}", f"N{i}", "Male", 30.0, "X", "NY", "2023-01-01") for i in range(1, 5)
    ]).withColumn("is_age_imputed", F.lit(False))
    products = make.products([(1, "P1", "a", "Books & Media", "100", "60")])
    orders = make.orders([
        (1, "O1", "C1", "P1", "2024-06-30", 2, "PayPal", "Completed"),
        (2, "O2", "C1", "P1", "2024-04-01", 1, "PayPal", "Shipped"),
        (3, "O3", "C1", "P1", "2023-05-01", 3, "PayPal", "Completed"),
        (4, "O4", "C2", "P1", "2024-05-05", 1, "PayPal", "Refunded"),
        (5, "O5", "C3", "P1", "2024-07-15", 1, "PayPal", "Completed"),
        (6, "O6", "C3", "P1", "2023-07-15", 1, "PayPal", "Completed"),
    ])
    return Tables(customers, products, orders)


def feature_rows(t, **kw):
    return {r.customer_id: r for r in
            customer_features(t.orders, t.customers, t.products, **kw).collect()}


def test_cutoff_day_counts_and_later_days_do_not(shop):
    got = feature_rows(shop, cutoff=DAY)
    assert got["C1"].recency_days == 0 and got["C1"].completed_orders == 3
    assert got["C3"].completed_orders == 1 and got["C3"].recency_days == 351
    assert str(got["C3"].last_order_date) == "2023-07-15"


def test_recent_window_is_open_on_the_left(shop):
    got = feature_rows(shop, cutoff=DAY)["C1"]  # 2024-04-01 is exactly 90 days before
    assert got.recent_order_count == 1 and float(got.recent_revenue) == 200.0
    view = customer_feature_view(
        shop.orders.where(f"order_date <= '{DAY}'"), shop.customers, shop.products, DAY, "2024-04-01")
    row = view.where("customer_id = 'C1'").first()
    assert row.recent_order_count == 2


def test_customer_without_orders(shop):
    scored = risk.risk_scores(rfm_scores(customer_features(
        shop.orders, shop.customers, shop.products, cutoff=DAY)))
    row = scored.where("customer_id = 'C4'").first()
    assert row.recency_days == 999 and row.refund_rate == 0.0 and row.revenue_trend == 0.0
    assert (row.rfm_score, row.customer_segment) == ("000", "Inactive / Unactivated")
    assert (row.risk_score, row.risk_level) == (85, "CRITICAL")
    assert {r.violations for r in segment_domain_checks(scored).collect()} == {0}


def test_open_ratios_are_null_in_the_view(shop):
    view = customer_feature_view(shop.orders, shop.customers, shop.products, DAY, "2024-04-01")
    row = view.where("customer_id = 'C4'").first()
    assert row.average_order_value is None and row.refund_rate is None


def test_snapshot_is_latest_order_of_any_status(shop):
    assert feature_rows(shop)["C1"].recency_days == 15


def test_orders_after_the_cutoff_change_nothing(shop, make):
    extra = make.orders([(9, "O9", "C1", "P1", "2024-08-01", 9, "PayPal", "Completed")])
    later = Tables(shop.customers, shop.products, shop.orders.unionByName(extra))
    assert feature_rows(later, cutoff=DAY) == feature_rows(shop, cutoff=DAY)


def test_label_looks_at_closed_window(shop):
    window = ChurnWindow(DAY, "2024-07-01", "2024-07-15")
    data = churn_dataset(shop.orders, shop.customers, shop.products, window)
    assert {r.customer_id: r.is_churned for r in data.collect()} == {"C1": 1, "C3": 0}
    meta = churn_metadata(data, window).first()
    assert (meta.eligible_customers, meta.churn_rate_pct, meta.imbalance_ratio) == (2, 50.0, 1.0)


RISK_SCHEMA = (
    "completed_orders long, recency_days int, historical_order_count long, "
    "recent_order_count long, total_revenue decimal(18,2), refund_rate double")


@pytest.mark.parametrize("row,score,driver", [
    ((1, 90, 1, 1, "100", 0.0), 0, "Healthy Engagement Cadence"),
    ((1, 91, 1, 1, "100", 0.0), 15, "Cooling Purchase Cadence (91-180 Days)"),
    ((1, 180, 1, 1, "100", 0.0), 15, "Cooling Purchase Cadence (91-180 Days)"),
    ((1, 181, 1, 1, "100", 0.0), 25, "High Inactivity (181-365 Days)"),
    ((1, 365, 1, 1, "100", 0.0), 25, "High Inactivity (181-365 Days)"),
    ((1, 366, 1, 1, "100", 0.0), 40, "Severe Inactivity (>365 Days)"),
    ((2, 10, 2, 0, "100", 0.0), 15, "Zero Orders in Last 90 Days"),
    ((5, 10, 5, 0, "100", 0.0), 25, "Discontinued Repeat Purchase Cadence"),
    ((1, 91, 1, 1, "1500", 0.0), 15, "Cooling Purchase Cadence (91-180 Days)"),
    ((1, 91, 1, 1, "1500.01", 0.0), 25, "Cooling Purchase Cadence (91-180 Days)"),
    ((1, 91, 1, 1, "3000", 0.0), 25, "Cooling Purchase Cadence (91-180 Days)"),
    ((1, 91, 1, 1, "3000.01", 0.0), 35, "Cooling Purchase Cadence (91-180 Days)"),
    ((1, 10, 1, 1, "100", 0.15), 0, "Healthy Engagement Cadence"),
    ((1, 10, 1, 1, "100", 0.1501), 15, "High Return Friction (15.0% Refund Rate)"),
    ((9, 400, 9, 0, "9000", 0.5), 100, "Severe Inactivity (>365 Days)"),
    ((0, 999, 0, 0, "0", 0.9), 85, "Unactivated Account (0 Completed Purchases)"),
])
def test_risk_edges(spark, row, score, driver):
    from decimal import Decimal

    values = (*row[:4], Decimal(row[4]), row[5])
    got = risk.risk_scores(spark.createDataFrame([values], RISK_SCHEMA)).first()
    assert (got.risk_score, got.key_risk_driver) == (score, driver)
    tier = "LOW" if score <= 24 else "MEDIUM" if score <= 49 else "HIGH" if score <= 74 else "CRITICAL"
    assert got.risk_level == tier and got.recommended_action == risk.ACTIONS[tier]


def test_percent_text_equals_python_formatting(spark):
    rates = [k / 10000 for k in range(500, 10001)]
    df = spark.createDataFrame([(r,) for r in rates], "rate double")
    got = {r.rate: r.t for r in df.select("rate", risk.percent_text("rate").alias("t")).collect()}
    assert got == {r: f"{r * 100:.1f}" for r in rates}


def test_previous_month_row_or_calendar(spark, make, shop):
    orders = make.orders([
        (i, f"O{i}", "C1", "P1", f"2024-{m:02d}-10", q, "PayPal", "Completed")
        for i, (m, q) in enumerate([(1, 1), (2, 2), (4, 3)])])
    t = Tables(shop.customers, shop.products, orders)
    rows = {r.order_month: r for r in reports.monthly_trend(t).collect()}
    assert rows["2024-04"].mom_revenue_growth_pct == 50.0
    assert float(rows["2024-04"].cumulative_run_rate_revenue) == 600.0
    from shelfmark.operators.facts import fact_orders

    calendar = {str(r.month): r for r in
                measures.time_intelligence(fact_orders(orders, shop.products)).collect()}
    assert calendar["2024-02-01"].mom_growth_pct == 1.0
    assert calendar["2024-04-01"].net_revenue_prior_month is None
    assert calendar["2024-04-01"].mom_growth_pct == 0.0


def test_date_dimension(spark):
    days = star.date_dimension(spark, "2022-01-01", "2024-12-31")
    assert days.count() == 1096 and days.select("date_id").distinct().count() == 1096
    weekend = {r.day_name for r in days.where("is_weekend = 1").select("day_name").distinct().collect()}
    assert weekend == {"Saturday", "Sunday"}
    assert days.where("date = '2024-02-29'").first().day_of_week == 4


def scores(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, is_churned int, churn_probability double")


def test_metrics_without_positive_predictions(spark):
    row = churn.classification_metrics(scores(spark, [("a", 1, 0.1), ("b", 0, 0.2)])).first()
    assert (row.precision, row.recall, row.f1, row.true_negative, row.false_negative) == (0, 0, 0, 1, 1)


def test_auc_equals_pair_count(spark):
    rows = [(str(i), int(i % 4 == 0 or i % 7 == 0), ((i * 37) % 11) / 10) for i in range(120)]
    pos = [p for _, y, p in rows if y]
    neg = [p for _, y, p in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    got = churn.roc_auc(scores(spark, rows)).first().roc_auc
    assert got == pytest.approx(wins / (len(pos) * len(neg)), abs=5e-5)


def test_threshold_table(spark):
    rows = [("a", 1, 0.9), ("b", 0, 0.6), ("c", 1, 0.4), ("d", 0, 0.1)]
    got = {r.threshold: r for r in churn.threshold_table(scores(spark, rows)).collect()}
    assert sorted(got) == [0.3, 0.4, 0.5, 0.6, 0.7]
    assert (got[0.5].targeted_count, got[0.5].false_alarms, got[0.5].precision) == (2, 1, 0.5)
    assert (got[0.4].targeted_count, got[0.7].false_alarms) == (3, 0)


@pytest.fixture(scope="module")
def cohort(spark):
    columns = ", ".join(f"{c} double" for c in churn.FEATURES)
    rows = []
    for i in range(400):
        churned = int(i % 5 < 3)
        base = [(i * (k + 3)) % 17 / 17 for k in range(len(churn.FEATURES))]
        base[0] += 2.0 * churned
        rows.append((f"C{i}", churned, *base))
    return spark.createDataFrame(rows, f"customer_id string, is_churned int, {columns}")


def test_models_learn_and_survive_saving(spark, cohort, tmp_path):
    models = churn.fit_models(churn.training_rows(cohort))
    models.save(str(tmp_path / "models"))
    loaded = churn.ChurnModels.load(str(tmp_path / "models"))
    for which in ("logistic", "forest"):
        a = churn.probability(getattr(models, which), cohort, "customer_id", "is_churned")
        b = churn.probability(getattr(loaded, which), cohort, "customer_id", "is_churned")
        assert churn.classification_metrics(a).first().roc_auc > 0.95
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    top = churn.coefficients(models.logistic, spark).first()
    assert top.feature == "recency_days" and top.coefficient > 0
    assert churn.importances(models.forest, spark).first().feature == "recency_days"


def test_scaler_sees_training_rows_only(cohort):
    model = churn.fit_logistic(churn.training_rows(cohort))
    mean = model.stages[1].mean.toArray()
    assert mean[0] == pytest.approx(cohort.agg(F.avg("recency_days")).first()[0])


def test_one_class_is_refused(cohort):
    with pytest.raises(ValueError):
        churn.fit_logistic(cohort.where("is_churned = 1"))


def test_union_all_keeps_order_of_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    assert union_all([a, a.select("b", "a")]).count() == 2
