"""Business dashboards over the transaction table (the twelve SQL reports).

Every function takes the canonical transaction DataFrame ``t`` and an ``as_of``
timestamp that replaces ``CURDATE()``/``NOW()``; look-back windows are the
half-open ranges ``[as_of - n, as_of)`` (decision D1). Ratios are computed in
double and divide through ``try_divide`` (NULL on a zero divisor, D3/D6). Where
the original orders rows without a unique key, the grouping keys are added as
tie-breakers (D5).

Scale notes: all reports are hash aggregations over low-cardinality keys, so
Spark's partial (map-side) aggregation collapses the input before the shuffle
and a hot key costs no more than any other. Distinct counts are rewritten by
Catalyst into an Expand + two-phase aggregate keyed by (group, value), which
spreads the work over many reducers. Constant "competitor" rows are produced by
exploding a literal array over the already-aggregated rows (no join at all).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.columns import (TS, count_if, first_match, in_lookback, minus, pct,
                                 ratio, sum_if, ts_literal)
from .ranking import global_row_number

def _amt() -> F.Column:
    return F.col("amount_inr")


def _is_success() -> F.Column:
    return F.col("transaction_status") == fixed.SUCCESS


def _is_fraud() -> F.Column:
    return F.col("fraud_flag") == 1


def _window(t: DataFrame, as_of, days: int = 0, hours: int = 0) -> DataFrame:
    return t.where(in_lookback(as_of, days, hours))


def _month() -> F.Column:
    return F.date_format(TS, "yyyy-MM")


def _day() -> F.Column:
    return F.to_date(TS)


# --- Q1 -------------------------------------------------------------------------
def market_position(t: DataFrame) -> DataFrame:
    """Monthly volume/value of the own platform plus two scaled competitors, with
    each platform's share of the month. The monthly aggregate runs once; the
    competitor rows are derived from it with exact decimal factors (ROUND half
    up, as the SQL does on DECIMAL)."""
    monthly = (t.groupBy(_month().alias("month"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum(_amt()).alias("v")))
    platforms = [(fixed.OWN_PLATFORM, Decimal("1"))] + [
        (p, Decimal(str(fixed.MARKET_POSITION_FACTORS[p]))) for p in fixed.COMPETITORS]
    table = F.array(*[F.struct(F.lit(p).alias("platform"),
                               F.lit(f).cast("decimal(6,4)").alias("factor"))
                      for p, f in platforms])
    rows = monthly.select("month", "n", "v", F.inline(table)).select(
        "platform", "month",
        F.round(F.col("n").cast("decimal(38,0)") * F.col("factor")).cast("bigint")
        .alias("transaction_count"),
        F.round(F.col("v").cast("decimal(38,0)") * F.col("factor")).cast("bigint")
        .alias("transaction_value"))
    by_month = Window.partitionBy("month")
    return (rows.select(
        "platform", "month", "transaction_count", "transaction_value",
        F.round(pct("transaction_count", F.sum("transaction_count").over(by_month)), 2)
        .alias("volume_market_share"),
        F.round(pct("transaction_value", F.sum("transaction_value").over(by_month)), 2)
        .alias("value_market_share"))
        .orderBy(F.desc("month"), F.desc("transaction_count"), "platform"))


# --- Q2 -------------------------------------------------------------------------
def performance_kpis(t: DataFrame, as_of, days: int = 30) -> DataFrame:
    """One-row 30-day KPI card with success and fraud grades."""
    succ = F.avg(F.when(_is_success(), 1.0).otherwise(0.0))
    fraud = F.avg(F.when(_is_fraud(), 1.0).otherwise(0.0))
    agg = _window(t, as_of, days).agg(
        (succ * 100).alias("_succ_pct"), (fraud * 100).alias("_fraud_pct"),
        succ.alias("_succ"), fraud.alias("_fraud"),
        F.avg(_amt()).alias("_avg"),
        ratio(F.count(F.lit(1)), F.countDistinct(_day())).alias("daily_avg_transactions"))
    return agg.select(
        F.lit(fixed.OWN_PERFORMANCE_LABEL).alias("metric_category"),
        F.round("_succ_pct", 2).alias("success_rate"),
        F.round("_fraud_pct", 4).alias("fraud_rate"),
        F.round("_avg", 2).alias("avg_transaction_value"),
        "daily_avg_transactions",
        first_match([(F.col("_succ") > 0.985, "EXCELLENT"), (F.col("_succ") > 0.970, "GOOD")],
                    "NEEDS_IMPROVEMENT").alias("success_rate_grade"),
        first_match([(F.col("_fraud") < 0.001, "EXCELLENT"), (F.col("_fraud") < 0.005, "GOOD")],
                    "NEEDS_IMPROVEMENT").alias("fraud_rate_grade"))


# --- Q3 -------------------------------------------------------------------------
def risk_points(night_wrap: bool = False) -> F.Column:
    """Additive rule score: amount (2/1/0) + network (1/0/.5) + night + cross-state.

    The original night rule is ``HOUR BETWEEN 22 AND 6``, which is always false
    (D2); ``night_wrap=True`` uses the wrapped range 22..23, 0..6 instead.
    """
    hour = F.hour(TS)
    night = ((hour >= 22) | (hour <= 6)) if night_wrap else hour.between(22, 6)
    amount_pts = F.when(_amt() > 10000, 2.0).when(_amt() > 5000, 1.0).otherwise(0.0)
    network_pts = (F.when(F.col("network_type") == "5G", 1.0)
                   .when(F.col("network_type") == "WiFi", 0.0).otherwise(0.5))
    night_pts = F.when(night, 1.0).otherwise(0.0)
    cross_pts = F.when(F.col("sender_state") != F.col("receiver_state"), 1.0).otherwise(0.0)
    return amount_pts + network_pts + night_pts + cross_pts


def risk_category_rule(score: F.Column) -> F.Column:
    return first_match([(_is_fraud(), "CONFIRMED_FRAUD"), (score >= 3, "HIGH_RISK"),
                        (score >= 2, "MEDIUM_RISK")], "LOW_RISK")


def score_transactions(t: DataFrame, night_wrap: bool = False) -> DataFrame:
    """Row-level rule score without a time filter (shared with the stream)."""
    score = risk_points(night_wrap)
    return t.select(
        "transaction_id", TS, "amount_inr", "sender_bank", "receiver_bank", "device_type",
        "network_type", "sender_state", score.alias("calculated_risk_score"),
        F.col("fraud_flag").alias("actual_fraud"), risk_category_rule(score).alias("risk_category"))


def fraud_risk_score(t: DataFrame, as_of, hours: int = 1, night_wrap: bool = False) -> DataFrame:
    """Rule-scored transactions of the last hour, riskiest first."""
    return (score_transactions(_window(t, as_of, hours=hours), night_wrap)
            .orderBy(F.desc("calculated_risk_score"), F.desc(TS), "transaction_id"))


# --- Q4 -------------------------------------------------------------------------
def fraud_bank_networks(t: DataFrame, as_of, days: int = 7, min_connections: int = 10,
                        basic: bool = False) -> DataFrame:
    """Bank-pair link statistics over 7 days, labelled and filtered to risky links.

    ``basic=True`` is the shorter variant: no amount or device diversity, no
    volume rule, ordered by fraud rate only.
    """
    aggs = [F.count(F.lit(1)).alias("connection_count"),
            sum_if(_is_fraud()).alias("fraud_count")]
    if not basic:
        aggs.append(F.sum(_amt()).alias("total_amount"))
    aggs.append(F.countDistinct("sender_age_group").alias("age_group_diversity"))
    if not basic:
        aggs.append(F.countDistinct("device_type").alias("device_diversity"))
    pairs = (_window(t, as_of, days).groupBy("sender_bank", "receiver_bank").agg(*aggs)
             .where(F.col("connection_count") >= min_connections)
             .withColumn("fraud_rate", F.round(pct("fraud_count", "connection_count"), 2)))
    rate, n = F.col("fraud_rate"), F.col("connection_count")
    rules = [((rate > 5) & (F.col("age_group_diversity") <= 2), "SUSPECTED_NETWORK"),
             (rate > 10, "HIGH_RISK_NETWORK")]
    if not basic:
        rules.append(((n > 1000) & (rate > 1), "VOLUME_RISK_NETWORK"))
    cols = ["sender_bank", "receiver_bank", "connection_count", "fraud_count", "fraud_rate"]
    cols += ["age_group_diversity"] if basic else ["total_amount", "age_group_diversity",
                                                   "device_diversity"]
    out = (pairs.select(*cols, first_match(rules, "NORMAL_PATTERN").alias("network_classification"))
           .where(F.col("network_classification") != "NORMAL_PATTERN"))
    order = [F.desc("fraud_rate")] + ([] if basic else [F.desc("connection_count")])
    return out.orderBy(*order, "sender_bank", "receiver_bank")


# --- Q5 -------------------------------------------------------------------------
def device_profile(t: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Per device type: id count, velocity, fraud share, ticket size, risk profile.

    ``unique_devices`` counts distinct transaction ids, as the original does (D14).
    """
    g = _window(t, as_of, days).groupBy("device_type").agg(
        F.countDistinct("transaction_id").alias("unique_devices"),
        F.count(F.lit(1)).alias("total_transactions"),
        sum_if(_is_fraud()).alias("_fraud"), F.avg(_amt()).alias("_avg"))
    per_id = ratio("total_transactions", "unique_devices")
    fraud_pct = pct("_fraud", "total_transactions")
    return (g.select(
        "device_type", "unique_devices", "total_transactions",
        F.round(per_id, 2).alias("avg_transactions_per_device"),
        F.round(fraud_pct, 2).alias("device_fraud_rate"),
        F.round("_avg", 2).alias("avg_transaction_amount"),
        first_match([(per_id > 50, "HIGH_VELOCITY_DEVICE"), (fraud_pct > 2, "HIGH_FRAUD_DEVICE"),
                     (F.col("_avg") > 5000, "HIGH_VALUE_DEVICE")], "NORMAL_DEVICE")
        .alias("device_risk_profile"))
        .orderBy(F.desc("device_fraud_rate"), F.desc("avg_transactions_per_device"),
                 "device_type"))


# --- Q6 -------------------------------------------------------------------------
def merchant_metrics(t: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Category x state metrics of the last 30 days with 7-day growth counts."""
    w7, w14 = minus(as_of, 7), minus(as_of, 14)
    return _window(t, as_of, days).groupBy("merchant_category", "sender_state").agg(
        F.count(F.lit(1)).alias("transaction_volume"),
        F.countDistinct(_day()).alias("active_days"),
        F.sum(_amt()).alias("total_revenue"),
        F.avg(_amt()).alias("avg_ticket_size"),
        F.round(ratio(F.count(F.lit(1)), F.countDistinct(_day())), 0)
        .alias("daily_avg_transactions"),
        F.round(pct(sum_if(_is_success()), F.count(F.lit(1))), 2).alias("success_rate"),
        F.round(pct(sum_if(_is_fraud()), F.count(F.lit(1))), 4).alias("fraud_rate"),
        F.countDistinct("sender_age_group").alias("customer_age_diversity"),
        count_if(F.col(TS) >= w7).alias("last_7_days_txns"),
        count_if((F.col(TS) >= w14) & (F.col(TS) < w7)).alias("prev_7_days_txns"))


def merchant_intelligence(t: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Merchant dashboard: metrics, week-over-week growth, two revenue ranks and a
    health label. The in-state rank is a window partitioned by state; the overall
    rank uses the parallel range-partitioned row number."""
    m = merchant_metrics(t, as_of, days)
    in_state = Window.partitionBy("sender_state").orderBy(
        F.desc("total_revenue"), F.asc_nulls_last("merchant_category"))
    s, f, d = F.col("success_rate"), F.col("fraud_rate"), F.col("daily_avg_transactions")
    m = m.select(
        "*",
        F.round(pct(F.col("last_7_days_txns") - F.col("prev_7_days_txns"),
                    F.nullif(F.col("prev_7_days_txns"), F.lit(0))), 2)
        .alias("week_over_week_growth"),
        F.row_number().over(in_state).alias("revenue_rank_in_state"),
        first_match([((s >= 98) & (f <= 0.5) & (d >= 100), "EXCELLENT"),
                     ((s >= 95) & (f <= 1) & (d >= 50), "GOOD"),
                     ((s >= 90) & (f <= 2), "AVERAGE")], "NEEDS_ATTENTION")
        .alias("merchant_health_score"))
    ranked = global_row_number(
        m, [F.desc_nulls_last("total_revenue"), F.asc_nulls_last("merchant_category"),
            F.asc_nulls_last("sender_state")], "overall_revenue_rank")
    cols = ["merchant_category", "sender_state", "transaction_volume", "active_days",
            "total_revenue", "avg_ticket_size", "daily_avg_transactions", "success_rate",
            "fraud_rate", "customer_age_diversity", "last_7_days_txns", "prev_7_days_txns",
            "week_over_week_growth", "revenue_rank_in_state", "overall_revenue_rank",
            "merchant_health_score"]
    return ranked.select(*cols).orderBy("overall_revenue_rank")


# --- Q7 -------------------------------------------------------------------------
def merchant_churn(t: DataFrame, as_of, days: int = 60, calendar_spine: bool = False) -> DataFrame:
    """Month-over-month change per category; keeps the at-risk labels only.

    Faithful default (D12): the previous month is the previous month *with
    transactions*, and a group always has rows, so CHURNED cannot occur.
    ``calendar_spine=True`` lists every calendar month from a category's first
    month in the window to the month of ``as_of`` (a month sequence exploded
    per category, no join of categories x months), counting 0 where a month
    has no transactions; a category that stops trading is then CHURNED.
    """
    monthly = (_window(t, as_of, days)
               .groupBy("merchant_category", F.trunc(F.to_date(TS), "month").alias("_m"))
               .agg(F.count(F.lit(1)).alias("current_month_txns")))
    if calendar_spine:
        last = F.trunc(F.to_date(ts_literal(as_of)), "month")
        spine = (monthly.groupBy("merchant_category").agg(F.min("_m").alias("_first"))
                 .select("merchant_category",
                         F.explode(F.sequence("_first", last, F.expr("INTERVAL 1 MONTH")))
                         .alias("_m")))
        monthly = (spine.join(monthly, ["merchant_category", "_m"], "left")
                   .fillna({"current_month_txns": 0}))
    monthly = monthly.withColumn("month", F.date_format("_m", "yyyy-MM")).drop("_m")
    prev = F.lag("current_month_txns").over(
        Window.partitionBy("merchant_category").orderBy("month"))
    m = monthly.withColumn("prev_month_txns", prev).where(F.col("prev_month_txns").isNotNull())
    change = pct(F.col("current_month_txns") - F.col("prev_month_txns"), "prev_month_txns")
    label = first_match([((F.col("prev_month_txns") > 0) & (F.col("current_month_txns") == 0),
                          "CHURNED"),
                         (change < -50, "HIGH_CHURN_RISK"), (change < -25, "MEDIUM_CHURN_RISK"),
                         (change > 25, "GROWING")], "STABLE")
    return (m.select("merchant_category", "month", "current_month_txns", "prev_month_txns",
                     F.round(change, 2).alias("month_over_month_change"),
                     label.alias("churn_risk_level"))
            .where(F.col("churn_risk_level").isin("CHURNED", "HIGH_CHURN_RISK",
                                                  "MEDIUM_CHURN_RISK"))
            .orderBy("month_over_month_change", "merchant_category", "month"))


# --- Q8 -------------------------------------------------------------------------
def user_classification(t: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Behaviour profile per (age group, state, device, network) with its segment."""
    hour = F.hour(TS)
    b = _window(t, as_of, days).groupBy(
        "sender_age_group", "sender_state", "device_type", "network_type").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.countDistinct("merchant_category").alias("merchant_diversity"),
        F.countDistinct(_day()).alias("active_days"),
        F.sum(_amt()).alias("total_spent"),
        F.avg(_amt()).alias("avg_transaction_value"),
        F.max(_amt()).alias("max_transaction_value"),
        count_if(F.col("transaction_type") == fixed.P2P).alias("p2p_transactions"),
        count_if(F.col("transaction_type") == fixed.P2M).alias("p2m_transactions"),
        count_if(hour.between(9, 17)).alias("business_hours_txns"),
        count_if(hour.between(18, 22)).alias("evening_txns"),
        count_if(F.dayofweek(TS).isin(1, 7)).alias("weekend_txns"))
    n = F.col("total_transactions")
    seg = first_match([
        ((F.col("total_spent") > 50000) & (F.col("avg_transaction_value") > 2000),
         "HIGH_VALUE_USER"),
        ((n > 200) & (F.col("avg_transaction_value") < 500), "FREQUENT_SMALL_SPENDER"),
        ((F.col("p2m_transactions") > F.col("p2p_transactions"))
         & (F.col("merchant_diversity") > 10), "MERCHANT_POWER_USER"),
        (F.col("sender_age_group").isin(*fixed.YOUNG_AGE_GROUPS)
         & (F.col("device_type") == fixed.ANDROID), "DIGITAL_NATIVE"),
        (pct("weekend_txns", n) > 40, "WEEKEND_SHOPPER"),
        (pct("business_hours_txns", n) > 60, "BUSINESS_USER")], "REGULAR_USER")
    return b.select(
        "*",
        F.round(ratio(n, F.nullif(F.col("active_days"), F.lit(0))), 2)
        .alias("transactions_per_active_day"),
        F.round(pct("p2p_transactions", n), 1).alias("p2p_percentage"),
        F.round(pct("p2m_transactions", n), 1).alias("p2m_percentage"),
        seg.alias("user_segment"))


def user_segments(t: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Segment roll-up of ``user_classification``."""
    return (user_classification(t, as_of, days).groupBy("user_segment").agg(
        F.count(F.lit(1)).alias("segment_size"),
        F.round(F.avg("total_spent"), 2).alias("avg_spending"),
        F.round(F.avg("total_transactions"), 0).alias("avg_transactions"),
        F.round(F.avg("avg_transaction_value"), 2).alias("avg_ticket_size"),
        F.round(F.avg("merchant_diversity"), 1).alias("avg_merchant_diversity"))
        .orderBy(F.desc("avg_spending"), "user_segment"))


# --- Q9 -------------------------------------------------------------------------
def ltv_detail(t: DataFrame, as_of, days: int = 365, min_transactions: int = 10) -> DataFrame:
    """Per-cohort lifetime metrics and the annualised lifetime value."""
    u = (_window(t, as_of, days).groupBy("sender_age_group", "sender_state", "device_type").agg(
        F.min(_day()).alias("first_transaction_date"),
        F.max(_day()).alias("last_transaction_date"),
        (F.datediff(F.max(_day()), F.min(_day())) + 1).alias("customer_lifespan_days"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(_amt()).alias("total_value"),
        F.countDistinct("merchant_category").alias("unique_merchants"),
        F.countDistinct(_day()).alias("active_days"))
        .where(F.col("total_transactions") >= min_transactions))
    life = F.nullif(F.col("customer_lifespan_days"), F.lit(0))
    engagement = ratio("active_days", life)
    factor = F.when(engagement > 0.5, 2.0).when(engagement > 0.2, 1.5).otherwise(1.0)
    return u.select(
        "*",
        F.round(ratio("total_value", life), 2).alias("daily_value"),
        F.round(ratio("total_transactions", life), 2).alias("daily_frequency"),
        F.round(ratio("total_value", F.nullif(F.col("total_transactions"), F.lit(0))), 2)
        .alias("avg_order_value"),
        F.round(engagement * 100, 1).alias("engagement_rate"),
        F.round(ratio("total_value", life) * 365 * factor, 2).alias("predicted_annual_clv"))


def customer_ltv(t: DataFrame, as_of, days: int = 365, min_transactions: int = 10) -> DataFrame:
    """Cohort roll-up of ``ltv_detail``. The outer grouping has the same keys, so
    ``user_count`` is 1 and the data is already partitioned: no second shuffle."""
    return (ltv_detail(t, as_of, days, min_transactions)
            .groupBy("sender_age_group", "sender_state", "device_type").agg(
                F.count(F.lit(1)).alias("user_count"),
                F.round(F.avg("predicted_annual_clv"), 2).alias("avg_predicted_clv"),
                F.round(F.avg("total_value"), 2).alias("avg_historical_value"),
                F.round(F.avg("engagement_rate"), 1).alias("avg_engagement_rate"),
                F.round(F.avg("unique_merchants"), 1).alias("avg_merchant_diversity"))
            .orderBy(F.desc("avg_predicted_clv"), "sender_age_group", "sender_state",
                     "device_type"))


# --- Q10 ------------------------------------------------------------------------
def health_monitor(t: DataFrame, as_of, volume_floors=(1000, 50000)) -> DataFrame:
    """Two-row health table (last hour, last 24 hours) from ONE scan.

    Both periods are conditional aggregates of the same 24-hour scan; ``stack``
    turns the single result row into the two report rows, so an empty hour
    still yields its row (count 0, ratios NULL, status VOLUME_LOW).
    """
    last_hour = F.col(TS) >= minus(as_of, hours=1)
    periods = {"h1": last_hour, "h24": F.lit(True)}
    aggs = []
    for tag, cond in periods.items():
        aggs += [
            count_if(cond).alias(f"{tag}_n"),
            F.sum(F.when(cond, _amt())).alias(f"{tag}_v"),
            F.avg(F.when(cond, _amt())).alias(f"{tag}_avg"),
            count_if(cond & _is_success()).alias(f"{tag}_ok"),
            count_if(cond & _is_fraud()).alias(f"{tag}_fraud"),
            F.countDistinct(F.when(cond, F.col("sender_bank"))).alias(f"{tag}_banks"),
            F.countDistinct(F.when(cond, F.col("merchant_category"))).alias(f"{tag}_cats")]
    one = _window(t, as_of, hours=24).agg(*aggs)
    stacked = one.selectExpr(
        "stack(2, 'LAST_HOUR', h1_n, h1_v, h1_avg, h1_ok, h1_fraud, h1_banks, h1_cats, "
        f"CAST({volume_floors[0]} AS BIGINT), "
        "'LAST_24_HOURS', h24_n, h24_v, h24_avg, h24_ok, h24_fraud, h24_banks, h24_cats, "
        f"CAST({volume_floors[1]} AS BIGINT)) "
        "AS (time_period, transaction_count, total_value, avg_value, ok, fraud, "
        "active_banks, active_merchant_categories, floor_n)")
    s, f = pct("ok", "transaction_count"), pct("fraud", "transaction_count")
    return stacked.select(
        "time_period", "transaction_count", "total_value",
        F.round("avg_value", 2).alias("avg_transaction_value"),
        F.round(s, 2).alias("success_rate"), F.round(f, 4).alias("fraud_rate"),
        "active_banks", "active_merchant_categories",
        first_match([(s < 95, "SUCCESS_RATE_LOW"), (f > 1, "FRAUD_RATE_HIGH"),
                     (F.col("transaction_count") < F.col("floor_n"), "VOLUME_LOW")], "HEALTHY")
        .alias("system_status"))


# --- Q11 ------------------------------------------------------------------------
def competitive_landscape(t: DataFrame, as_of, days: int = 30) -> DataFrame:
    """30-day KPIs of the own platform and two scaled competitor estimates.

    Scaling is done in exact decimals and then cast to double. The ``ELSE``
    share branch of the original is unreachable (D11); it is kept as the
    fallback of the share lookup.
    """
    own = _window(t, as_of, days).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_amt()).alias("v"),
        F.round(F.avg(_amt()), 2).alias("a"),
        F.round(pct(count_if(_is_success()), F.count(F.lit(1))), 2).alias("s"))
    rows = [(fixed.OWN_PLATFORM, (1, 1, 1, 1))] + [
        (p, fixed.LANDSCAPE_FACTORS[p]) for p in fixed.COMPETITORS]

    def dec(x):
        return F.lit(Decimal(str(x))).cast("decimal(6,4)")
    table = F.array(*[F.struct(F.lit(p).alias("platform"), dec(fs[0]).alias("fn"),
                               dec(fs[1]).alias("fv"), dec(fs[2]).alias("fa"),
                               dec(fs[3]).alias("fs")) for p, fs in rows])
    share = F.lit(fixed.OTHER_SHARE_ESTIMATE)
    for p in reversed(list(fixed.MARKET_SHARE_ESTIMATES)):
        share = F.when(F.col("platform") == p, F.lit(fixed.MARKET_SHARE_ESTIMATES[p])).otherwise(share)
    x = own.select("*", F.inline(table)).select(
        "platform",
        (F.col("n").cast("decimal(38,0)") * F.col("fn")).cast("double").alias("monthly_transactions"),
        (F.col("v").cast("decimal(38,0)") * F.col("fv")).cast("double").alias("monthly_value"),
        (F.col("a").cast("decimal(30,2)") * F.col("fa")).cast("double").alias("avg_transaction_value"),
        (F.col("s").cast("decimal(30,2)") * F.col("fs")).cast("double").alias("success_rate"),
        share.alias("market_share_estimate"))
    pos = first_match([(F.col("platform") == fixed.OWN_PLATFORM, "LEADER"),
                       (F.col("market_share_estimate") > 30, "MAJOR_COMPETITOR"),
                       (F.col("market_share_estimate") > 5, "SIGNIFICANT_PLAYER")], "MINOR_PLAYER")
    return (x.select("*", pos.alias("competitive_position"))
            .orderBy(F.desc("market_share_estimate"), "platform"))


# --- Q12 ------------------------------------------------------------------------
def state_category_topk(t: DataFrame, as_of, days: int = 7, k: int = 100) -> DataFrame:
    """Top-k non-fraud revenue by state x category (TakeOrderedAndProject)."""
    return (_window(t, as_of, days).where(F.col("fraud_flag") == 0)
            .groupBy("sender_state", "merchant_category")
            .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum(_amt()).alias("total_value"))
            .orderBy(F.desc("total_value"), "sender_state", "merchant_category")
            .limit(k))
