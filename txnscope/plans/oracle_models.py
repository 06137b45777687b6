"""DuckDB SQL for the model-evaluation, insight and streaming operators."""

from .oracle_dashboards import RISK_SCORE_EXPR
from .oracle_profiling import MODEL_SUMMARY

SPLIT_STRATIFIED = """
r AS (SELECT transaction_id, fraud_flag,
             ROW_NUMBER() OVER (PARTITION BY fraud_flag ORDER BY md5('42:' || transaction_id), transaction_id) AS rn,
             COUNT(*) OVER (PARTITION BY fraud_flag) AS n
      FROM transactions)
SELECT transaction_id, fraud_flag,
       CASE WHEN rn <= n - CAST(ceil(n * 0.3) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM r"""

CLASS_WEIGHTS = """
SELECT fraud_flag,
       ROUND(CAST((SELECT COUNT(*) FROM transactions) AS DOUBLE)
             / ((SELECT COUNT(DISTINCT fraud_flag) FROM transactions) * COUNT(*)), 9) AS class_weight
FROM transactions GROUP BY fraud_flag"""

RULE_REPORT = """
s AS (SELECT fraud_flag AS y, CASE WHEN """ + RISK_SCORE_EXPR + """ >= 2 THEN 1 ELSE 0 END AS p FROM transactions),
conf AS (SELECT y, p, COUNT(*) AS n FROM s GROUP BY y, p),
cls AS (SELECT y AS c FROM conf UNION SELECT p FROM conf),
st AS (SELECT c,
         CAST(SUM(CASE WHEN y = c AND p = c THEN n ELSE 0 END) AS DOUBLE) AS tp,
         CAST(SUM(CASE WHEN p = c AND y <> c THEN n ELSE 0 END) AS DOUBLE) AS fp,
         CAST(SUM(CASE WHEN y = c AND p <> c THEN n ELSE 0 END) AS DOUBLE) AS fn
       FROM cls, conf GROUP BY c),
r0 AS (SELECT CAST(c AS VARCHAR) AS class_label,
         COALESCE(tp / NULLIF(tp + fp, 0), 0.0) AS precision,
         COALESCE(tp / NULLIF(tp + fn, 0), 0.0) AS recall,
         CAST(tp + fn AS BIGINT) AS support, tp
       FROM st),
r1 AS (SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1_score FROM r0),
tot AS (SELECT SUM(support) AS total, SUM(tp) AS tps FROM r1)
SELECT class_label, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall, ROUND(f1_score, 9) AS f1_score, support FROM r1
UNION ALL
SELECT 'accuracy', NULL, NULL, ROUND(tps / total, 9), CAST(total AS BIGINT) FROM tot
UNION ALL
SELECT 'macro avg', ROUND(AVG(precision), 9), ROUND(AVG(recall), 9), ROUND(AVG(f1_score), 9), CAST(SUM(support) AS BIGINT) FROM r1
UNION ALL
SELECT 'weighted avg', ROUND(SUM(precision * support / total), 9), ROUND(SUM(recall * support / total), 9),
       ROUND(SUM(f1_score * support / total), 9), CAST(SUM(support) AS BIGINT) FROM r1, tot"""

RULE_AUC = """
per AS (SELECT """ + RISK_SCORE_EXPR + """ AS s, SUM(fraud_flag) AS pos, SUM(1 - fraud_flag) AS neg
        FROM transactions GROUP BY 1),
c AS (SELECT *, SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_le FROM per)
SELECT ROUND(SUM(pos * (neg_le - neg + 0.5 * neg)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 9) AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg
FROM c"""

INSIGHT_OVERVIEW = """
SELECT COUNT(*) AS total_transactions, CAST(SUM(fraud_flag) AS BIGINT) AS total_fraud_cases,
       round_even(CAST(SUM(fraud_flag) AS DOUBLE) / COUNT(*) * 100, 4) AS fraud_rate_percent
FROM transactions"""

INSIGHT_RISKY_HOURS = """
o AS (SELECT AVG(CAST(fraud_flag AS DOUBLE)) AS overall FROM transactions),
h AS (SELECT CAST(hour("timestamp") AS INTEGER) AS hour, CAST(SUM(fraud_flag) AS BIGINT) AS fraud_sum,
             COUNT(*) AS n, AVG(CAST(fraud_flag AS DOUBLE)) AS fraud_mean
      FROM transactions GROUP BY 1)
SELECT hour, fraud_sum, n, ROUND(fraud_mean, 9) AS fraud_mean FROM h, o WHERE fraud_mean > overall"""

INSIGHT_HIGH_AMOUNT = """
q AS (SELECT quantile_cont(CAST(amount_inr AS DOUBLE), 0.5) AS p50,
             quantile_cont(CAST(amount_inr AS DOUBLE), 0.95) AS p95,
             quantile_cont(CAST(amount_inr AS DOUBLE), 0.99) AS p99,
             AVG(CAST(fraud_flag AS DOUBLE)) AS overall_fraud_rate FROM transactions),
a AS (SELECT AVG(CAST(fraud_flag AS DOUBLE)) AS high_amount_fraud_rate
      FROM transactions, q WHERE CAST(amount_inr AS DOUBLE) > q.p95)
SELECT ROUND(p50, 9) AS p50, ROUND(p95, 9) AS p95, ROUND(p99, 9) AS p99,
       ROUND(overall_fraud_rate, 9) AS overall_fraud_rate,
       ROUND(high_amount_fraud_rate, 9) AS high_amount_fraud_rate,
       COALESCE(high_amount_fraud_rate > overall_fraud_rate, false) AS elevated
FROM q, a"""

INSIGHT_RISKY_STATES = """
o AS (SELECT AVG(CAST(fraud_flag AS DOUBLE)) AS overall FROM transactions),
s AS (SELECT sender_state, CAST(SUM(fraud_flag) AS BIGINT) AS fraud_sum, COUNT(*) AS n,
             AVG(CAST(fraud_flag AS DOUBLE)) AS fraud_mean
      FROM transactions WHERE sender_state IS NOT NULL GROUP BY 1)
SELECT sender_state, fraud_sum, n, ROUND(fraud_mean, 9) AS fraud_mean FROM s, o
WHERE fraud_mean > 2 * overall ORDER BY s.fraud_mean DESC, sender_state LIMIT 3"""

INSIGHT_PATTERNS = """
o AS (SELECT AVG(CAST(fraud_flag AS DOUBLE)) AS overall,
             quantile_cont(CAST(amount_inr AS DOUBLE), 0.95) AS p95 FROM transactions),
h AS (SELECT hour("timestamp") AS hour, AVG(CAST(fraud_flag AS DOUBLE)) AS m FROM transactions GROUP BY 1),
a AS (SELECT AVG(CAST(fraud_flag AS DOUBLE)) AS m FROM transactions, o WHERE CAST(amount_inr AS DOUBLE) > o.p95),
st AS (SELECT sender_state, AVG(CAST(fraud_flag AS DOUBLE)) AS m FROM transactions
       WHERE sender_state IS NOT NULL GROUP BY 1),
top AS (SELECT sender_state, m FROM st, o WHERE m > 2 * o.overall ORDER BY m DESC, sender_state LIMIT 3)
SELECT 'risky_hours' AS pattern,
       'High fraud risk during hours: [' || string_agg(CAST(hour AS VARCHAR), ', ' ORDER BY hour) || ']' AS message
FROM h, o WHERE h.m > o.overall HAVING COUNT(*) > 0
UNION ALL
SELECT 'high_amount', printf('High-value transactions (>₹%.0f) show elevated fraud risk', o.p95)
FROM a, o WHERE a.m > o.overall
UNION ALL
SELECT 'risky_states', 'States with elevated fraud risk: ' || string_agg(sender_state, ', ' ORDER BY m DESC, sender_state)
FROM top HAVING COUNT(*) > 0"""

STREAM_FRAUD_SCORE = """
SELECT transaction_id, "timestamp", amount_inr, sender_bank, receiver_bank, device_type, network_type, sender_state,
       """ + RISK_SCORE_EXPR + """ AS calculated_risk_score,
       fraud_flag AS actual_fraud,
       CASE WHEN fraud_flag = 1 THEN 'CONFIRMED_FRAUD'
            WHEN calculated_risk_score >= 3 THEN 'HIGH_RISK'
            WHEN calculated_risk_score >= 2 THEN 'MEDIUM_RISK'
            ELSE 'LOW_RISK' END AS risk_category
FROM transactions"""

# Windows [start, start + 1 h) with start on the 5-minute grid; a window is
# emitted once the watermark (max event time - 10 min) reaches its end.
STREAM_HEALTH = """
wm AS (SELECT MAX("timestamp") - INTERVAL 10 MINUTE AS watermark FROM transactions),
w AS (
  SELECT t.*, time_bucket(INTERVAL 5 MINUTE, t."timestamp") - to_minutes(5 * k) AS window_start
  FROM transactions t, range(12) r(k)
),
agg AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
         COUNT(*) AS transaction_count, CAST(SUM(amount_inr) AS BIGINT) AS total_value,
         ROUND(AVG(amount_inr), 2) AS avg_transaction_value,
         CAST(COUNT(CASE WHEN transaction_status = 'SUCCESS' THEN 1 END) AS DOUBLE) * 100.0 / COUNT(*) AS s,
         CAST(COUNT(CASE WHEN fraud_flag = 1 THEN 1 END) AS DOUBLE) * 100.0 / COUNT(*) AS f,
         CAST(COUNT(DISTINCT sender_bank) AS INTEGER) AS active_banks,
         CAST(COUNT(DISTINCT merchant_category) AS INTEGER) AS active_merchant_categories
  FROM w GROUP BY window_start
)
SELECT window_start, window_end, transaction_count, total_value, avg_transaction_value,
       ROUND(s, 2) AS success_rate, ROUND(f, 4) AS fraud_rate, active_banks, active_merchant_categories,
       CASE WHEN s < 95 THEN 'SUCCESS_RATE_LOW' WHEN f > 1 THEN 'FRAUD_RATE_HIGH'
            WHEN transaction_count < 1000 THEN 'VOLUME_LOW' ELSE 'HEALTHY' END AS system_status
FROM agg, wm WHERE window_end <= wm.watermark"""

# Every 15 minutes the last hour and the last 24 hours, once the watermark has passed.
STREAM_HEALTH_PERIODS = """
wm AS (SELECT MAX("timestamp") - INTERVAL 10 MINUTE AS watermark,
              time_bucket(INTERVAL 15 MINUTE, MIN("timestamp")) AS first FROM transactions),
ends AS (SELECT unnest(generate_series(first + INTERVAL 15 MINUTE, watermark, INTERVAL 15 MINUTE)) AS period_end
         FROM wm),
periods(time_period, hours, floor_n) AS (VALUES ('LAST_HOUR', 1, 1000), ('LAST_24_HOURS', 24, 50000)),
agg AS (
  SELECT e.period_end, p.time_period, MAX(p.floor_n) AS floor_n, COUNT(*) AS transaction_count,
         CAST(SUM(t.amount_inr) AS BIGINT) AS total_value,
         COUNT(CASE WHEN transaction_status = 'SUCCESS' THEN 1 END) AS ok,
         COUNT(CASE WHEN fraud_flag = 1 THEN 1 END) AS frauds,
         CAST(COUNT(CASE WHEN transaction_status = 'SUCCESS' THEN 1 END) AS DOUBLE) * 100.0 / COUNT(*) AS s,
         CAST(COUNT(CASE WHEN fraud_flag = 1 THEN 1 END) AS DOUBLE) * 100.0 / COUNT(*) AS f,
         CAST(COUNT(DISTINCT sender_bank) AS INTEGER) AS active_banks,
         CAST(COUNT(DISTINCT merchant_category) AS INTEGER) AS active_merchant_categories
  FROM ends e CROSS JOIN periods p
  JOIN transactions t ON t."timestamp" >= e.period_end - to_hours(p.hours) AND t."timestamp" < e.period_end
  GROUP BY e.period_end, p.time_period)
SELECT period_end, time_period, transaction_count, total_value,
       (total_value * 200 + transaction_count) // (2 * transaction_count) / 100.0::DOUBLE AS avg_transaction_value,
       (ok * 100 * 200 + transaction_count) // (2 * transaction_count) / 100.0::DOUBLE AS success_rate,
       (frauds * 100 * 20000 + transaction_count) // (2 * transaction_count) / 10000.0::DOUBLE AS fraud_rate,
       active_banks, active_merchant_categories,
       CASE WHEN s < 95 THEN 'SUCCESS_RATE_LOW' WHEN f > 1 THEN 'FRAUD_RATE_HIGH'
            WHEN transaction_count < floor_n THEN 'VOLUME_LOW' ELSE 'HEALTHY' END AS system_status
FROM agg"""

# overview and patterns as (section, name, value)
_PATTERN_CTES, _PATTERN_ROWS = INSIGHT_PATTERNS.split("\nSELECT 'risky_hours'", 1)
INSIGHTS = (_PATTERN_CTES + ",\npat AS (SELECT 'risky_hours'" + _PATTERN_ROWS + "),\nov AS ("
            + INSIGHT_OVERVIEW + ")\n" + "\nUNION ALL ".join(
                f"SELECT 'overview' AS section, '{c}' AS name, CAST({c} AS VARCHAR) AS value FROM ov"
                for c in ("total_transactions", "total_fraud_cases", "fraud_rate_percent"))
            + "\nUNION ALL SELECT 'patterns', pattern, message FROM pat")

# the same with the counts of the model
INSIGHTS_WITH_MODEL = ("summary AS (WITH RECURSIVE " + MODEL_SUMMARY.strip() + "),\n" + INSIGHTS + "\nUNION ALL " + "\nUNION ALL ".join(
    f"SELECT 'model' AS section, '{c}' AS name, CAST({c} AS VARCHAR) AS value FROM summary"
    for c in ("fraud_clusters_detected", "anomaly_clusters", "graph_nodes", "graph_edges")))
