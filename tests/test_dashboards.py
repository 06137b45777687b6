"""Label rules the fixtures cannot reach, checked on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import txn_frame
from txnscope.operators import dashboards as d

AS_OF = dt.datetime(2024, 1, 31)
DAY = dt.timedelta(days=1)


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_suspected_network(spark):
    rows = [dict(sender_bank="X", receiver_bank="Y", fraud_flag=1 if i < 2 else 0,
                 timestamp=AS_OF - DAY * (1 + i % 5)) for i in range(12)]
    out = _rows(d.fraud_bank_networks(txn_frame(spark, rows), AS_OF))
    assert len(out) == 1 and out[0]["network_classification"] == "SUSPECTED_NETWORK"
    assert out[0]["fraud_rate"] == round(2 * 100 / 12, 2)


def test_volume_risk_network(spark):
    ages = ["18-25", "26-35", "36-45"]
    rows = [dict(sender_bank="X", receiver_bank="Y", fraud_flag=1 if i < 20 else 0,
                 sender_age_group=ages[i % 3], timestamp=AS_OF - DAY) for i in range(1001)]
    out = _rows(d.fraud_bank_networks(txn_frame(spark, rows), AS_OF))
    assert out[0]["network_classification"] == "VOLUME_RISK_NETWORK"
    basic = d.fraud_bank_networks(txn_frame(spark, rows), AS_OF, basic=True)
    assert basic.count() == 0  # the short variant has no volume rule


def test_high_velocity_device(spark):
    rows = [dict(transaction_id="SAME", timestamp=AS_OF - DAY) for _ in range(51)]
    df = txn_frame(spark, rows).withColumn("transaction_id", F.lit("SAME"))
    out = _rows(d.device_profile(df, AS_OF))
    assert out[0]["device_risk_profile"] == "HIGH_VELOCITY_DEVICE"
    assert out[0]["unique_devices"] == 1 and out[0]["avg_transactions_per_device"] == 51.0


def test_wow_growth_null_without_previous_week(spark):
    rows = [dict(timestamp=AS_OF - DAY) for _ in range(3)]
    out = _rows(d.merchant_intelligence(txn_frame(spark, rows), AS_OF))
    assert out[0]["week_over_week_growth"] is None
    assert out[0]["last_7_days_txns"] == 3 and out[0]["prev_7_days_txns"] == 0
    assert out[0]["overall_revenue_rank"] == 1


def test_health_empty_hour_is_volume_low(spark):
    rows = [dict(timestamp=AS_OF - dt.timedelta(hours=5)) for _ in range(4)]
    out = {r["time_period"]: r for r in _rows(d.health_monitor(txn_frame(spark, rows), AS_OF))}
    assert out["LAST_HOUR"]["transaction_count"] == 0
    assert out["LAST_HOUR"]["success_rate"] is None
    assert out["LAST_HOUR"]["system_status"] == "VOLUME_LOW"
    assert out["LAST_24_HOURS"]["transaction_count"] == 4


def test_grades_and_boundaries(spark):
    rows = [dict(timestamp=AS_OF - DAY, transaction_status="FAILED" if i < 2 else "SUCCESS")
            for i in range(100)]
    out = _rows(d.performance_kpis(txn_frame(spark, rows), AS_OF))[0]
    assert out["success_rate"] == 98.0 and out["success_rate_grade"] == "GOOD"
    assert out["fraud_rate_grade"] == "EXCELLENT"


def test_risk_score_night_rule_is_never_true_by_default(spark):
    rows = [dict(timestamp=AS_OF - dt.timedelta(minutes=30 + i), amount_inr=20000,
                 network_type="5G", receiver_state="S2") for i in range(2)]
    df = txn_frame(spark, rows)
    faithful = _rows(d.fraud_risk_score(df, AS_OF))
    assert {r["calculated_risk_score"] for r in faithful} == {4.0}
    wrapped = _rows(d.fraud_risk_score(df, AS_OF, night_wrap=True))
    assert {r["calculated_risk_score"] for r in wrapped} == {5.0}
    assert {r["risk_category"] for r in wrapped} == {"HIGH_RISK"}


def test_market_shares_sum_to_100(spark, duck):
    from conftest import SF_SMALL
    from txnscope.plans.registry import load_transactions
    t = load_transactions(spark, SF_SMALL, "lineitem")
    shares = (d.market_position(t).groupBy("month")
              .agg(F.sum("volume_market_share").alias("s")).collect())
    assert all(abs(r["s"] - 100) < 0.05 for r in shares)


def test_churn_labels(spark):
    rows = ([dict(timestamp=dt.datetime(2024, 1, 5), merchant_category="M")] * 10
            + [dict(timestamp=dt.datetime(2024, 2, 5), merchant_category="M")] * 4)
    out = _rows(d.merchant_churn(txn_frame(spark, rows), dt.datetime(2024, 2, 20)))
    assert out[0]["churn_risk_level"] == "HIGH_CHURN_RISK"
    assert out[0]["month_over_month_change"] == -60.0


def test_churned_needs_the_calendar_spine(spark):
    rows = ([dict(timestamp=dt.datetime(2024, 1, 5), merchant_category="M")] * 10
            + [dict(timestamp=dt.datetime(2024, 1, 6), merchant_category="N")] * 10
            + [dict(timestamp=dt.datetime(2024, 2, 6), merchant_category="N")] * 10)
    as_of = dt.datetime(2024, 2, 20)
    assert d.merchant_churn(txn_frame(spark, rows), as_of).count() == 0  # faithful: no CHURNED
    out = _rows(d.merchant_churn(txn_frame(spark, rows), as_of, calendar_spine=True))
    assert [(r["merchant_category"], r["month"], r["churn_risk_level"]) for r in out] == [
        ("M", "2024-02", "CHURNED")]
    assert out[0]["current_month_txns"] == 0 and out[0]["prev_month_txns"] == 10
