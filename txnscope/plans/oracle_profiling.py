"""DuckDB SQL for profiling, features, profiles and graph operators."""

from ..functions import fixed
from .oracle_dashboards import RISK_SCORE_EXPR

TXN_TYPES = [("transaction_id", "string"), ("timestamp", "timestamp_ntz"),
             ("transaction_type", "string"), ("merchant_category", "string"),
             ("amount_inr", "bigint"), ("transaction_status", "string"),
             ("sender_age_group", "string"), ("sender_state", "string"),
             ("receiver_state", "string"), ("sender_bank", "string"),
             ("receiver_bank", "string"), ("device_type", "string"),
             ("network_type", "string"), ("fraud_flag", "int")]

SCHEMA_INFO = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(\"{c}\") AS non_null_count FROM transactions"
    for c, t in TXN_TYPES)

NULL_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT(\"{c}\") AS null_count FROM transactions"
    for c, _ in TXN_TYPES)

DROP_NULLS = """
SELECT * FROM transactions
WHERE """ + " AND ".join(f'"{c}" IS NOT NULL' for c, _ in TXN_TYPES)

SHAPE_REPORT = """
SELECT 'full' AS frame, COUNT(*) AS n_rows, 14 AS n_columns FROM transactions
UNION ALL
SELECT 'sub', COUNT(*), 14 FROM transactions
WHERE sender_bank IN (SELECT sender_bank FROM transactions WHERE fraud_flag = 1
                      UNION SELECT receiver_bank FROM transactions WHERE fraud_flag = 1)
   OR receiver_bank IN (SELECT sender_bank FROM transactions WHERE fraud_flag = 1
                      UNION SELECT receiver_bank FROM transactions WHERE fraud_flag = 1)"""


def _describe(c: str) -> str:
    x = f'CAST("{c}" AS DOUBLE)'
    return (f"SELECT '{c}' AS column_name, COUNT({x}) AS count, ROUND(AVG({x}), 6) AS mean, "
            f"ROUND(stddev_samp({x}), 6) AS std, ROUND(MIN({x}), 6) AS min, "
            f"ROUND(quantile_cont({x}, 0.25), 6) AS p25, ROUND(quantile_cont({x}, 0.5), 6) AS p50, "
            f"ROUND(quantile_cont({x}, 0.75), 6) AS p75, ROUND(MAX({x}), 6) AS max FROM transactions")


DESCRIBE_NUMERIC = _describe("amount_inr") + "\nUNION ALL\n" + _describe("fraud_flag")

TEMPORAL_FEATURES = """
SELECT transaction_id, "timestamp", CAST(hour("timestamp") AS INTEGER) AS transaction_hour,
       dayname("timestamp") AS day_of_week, monthname("timestamp") AS transaction_month
FROM transactions"""

AMOUNT_HISTOGRAM = """
stats AS (SELECT CAST(MIN(amount_inr) AS DOUBLE) AS lo, CAST(MAX(amount_inr) AS DOUBLE) AS hi FROM transactions),
b AS (
  SELECT CAST(CASE WHEN hi = lo THEN 0
              ELSE LEAST(floor((CAST(amount_inr AS DOUBLE) - lo) * 100 / (hi - lo)), 99) END AS INTEGER) AS bin,
         lo, (hi - lo) / 100 AS w
  FROM transactions, stats WHERE amount_inr IS NOT NULL
)
SELECT bin, ROUND(lo + bin * w, 6) AS bin_start, ROUND(lo + (bin + 1) * w, 6) AS bin_end, COUNT(*) AS frequency
FROM b GROUP BY bin, lo, w"""

AMOUNT_KDE = """
x AS (SELECT CAST(amount_inr AS DOUBLE) AS x FROM transactions WHERE amount_inr IS NOT NULL),
s AS (SELECT COUNT(*) AS n, stddev_samp(x) AS sd, MIN(x) AS lo, MAX(x) AS hi,
             pow(COUNT(*), -0.2) * stddev_samp(x) AS bw FROM x),
v AS (SELECT x, COUNT(*) AS m FROM x GROUP BY x),
g AS (SELECT CAST(gi AS INTEGER) AS gi, (lo - bw * 0.0) + ((hi + bw * 0.0) - (lo - bw * 0.0)) * gi / 199 AS grid_x
      FROM s, range(200) r(gi)),
k AS (SELECT g.gi, g.grid_x, SUM(v.m * exp(-0.5 * ((g.grid_x - v.x) / s.bw) * ((g.grid_x - v.x) / s.bw))) AS k
      FROM g, v, s GROUP BY g.gi, g.grid_x)
SELECT k.gi AS grid_index, ROUND(k.grid_x, 6) AS grid_x,
       ROUND(k.k / (s.n * s.bw * sqrt(2 * pi())), 12) AS density,
       ROUND(k.k / (s.n * s.bw * sqrt(2 * pi())) * s.n * (s.hi - s.lo) / 100, 6) AS scaled_count
FROM k, s"""

# the density is compared with the exact one in the query: here every point agrees
AMOUNT_KDE_BINNED = AMOUNT_KDE[:AMOUNT_KDE.index("SELECT k.gi AS grid_index")] + """
SELECT k.gi AS grid_index, ROUND(k.grid_x, 6) AS grid_x,
       ROUND(k.k / (s.n * s.bw * sqrt(2 * pi())), 12) AS exact_density,
       TRUE AS within_error, TRUE AS within_tolerance
FROM k, s"""

# whole days before the report's day; the sketches' estimates agree within their error
LOOKBACK_DISTINCT = """
spans AS (SELECT unnest([7, 30, 90, 365]) AS lookback_days),
days AS (SELECT transaction_id, sender_bank, receiver_bank, CAST("timestamp" AS DATE) AS day,
                date_diff('day', CAST("timestamp" AS DATE), CAST({as_of} AS DATE)) AS age
         FROM transactions WHERE "timestamp" < {as_of}),
held AS (SELECT * FROM days JOIN spans ON age BETWEEN 1 AND lookback_days),
counts AS (SELECT lookback_days, COUNT(DISTINCT day) AS days_read,
                  COUNT(DISTINCT transaction_id) AS payments,
                  COUNT(DISTINCT sender_bank || '|' || receiver_bank) AS bank_pairs
           FROM held GROUP BY lookback_days)
SELECT 'payments' AS counted, lookback_days, days_read, payments AS exact_count, TRUE AS within_error FROM counts
UNION ALL
SELECT 'bank_pairs', lookback_days, days_read, bank_pairs, TRUE FROM counts"""

FRAUD_COUNTS = "SELECT fraud_flag, COUNT(*) AS n_transactions FROM transactions GROUP BY fraud_flag"
HOURLY_COUNTS = """SELECT CAST(hour("timestamp") AS INTEGER) AS transaction_hour, COUNT(*) AS n_transactions
FROM transactions GROUP BY 1"""
HOURLY_FRAUD_COUNTS = """SELECT CAST(hour("timestamp") AS INTEGER) AS transaction_hour, fraud_flag,
COUNT(*) AS n_transactions FROM transactions GROUP BY 1, 2"""
DEVICE_FRAUD_COUNTS = """SELECT device_type, fraud_flag, COUNT(*) AS n_transactions
FROM transactions GROUP BY 1, 2"""

AMOUNT_BOXSTATS = """
q AS (
  SELECT fraud_flag, quantile_cont(CAST(amount_inr AS DOUBLE), 0.25) AS q1,
         quantile_cont(CAST(amount_inr AS DOUBLE), 0.5) AS median,
         quantile_cont(CAST(amount_inr AS DOUBLE), 0.75) AS q3
  FROM transactions WHERE fraud_flag IS NOT NULL AND amount_inr IS NOT NULL GROUP BY fraud_flag
),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.fraud_flag, f.q1, f.median, f.q3, f.iqr,
       MIN(CASE WHEN CAST(t.amount_inr AS DOUBLE) BETWEEN lo_f AND hi_f THEN CAST(t.amount_inr AS DOUBLE) END) AS whisker_low,
       MAX(CASE WHEN CAST(t.amount_inr AS DOUBLE) BETWEEN lo_f AND hi_f THEN CAST(t.amount_inr AS DOUBLE) END) AS whisker_high,
       COUNT(CASE WHEN NOT (CAST(t.amount_inr AS DOUBLE) BETWEEN lo_f AND hi_f) THEN 1 END) AS n_outliers,
       COUNT(*) AS n
FROM transactions t JOIN f ON t.fraud_flag = f.fraud_flag
WHERE t.amount_inr IS NOT NULL
GROUP BY f.fraud_flag, f.q1, f.median, f.q3, f.iqr"""

# --- features --------------------------------------------------------------------
_ENC = ",\n".join(
    f"  CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_encoded"
    for c in fixed.CATEGORICAL_COLUMNS)

FEATURE_BASE_CTE = """
st AS (SELECT AVG(CAST(amount_inr AS DOUBLE)) AS mu, stddev_samp(CAST(amount_inr AS DOUBLE)) AS sd,
              quantile_cont(CAST(amount_inr AS DOUBLE), 0.95) AS p95 FROM transactions),
feat AS (
  SELECT transaction_id, fraud_flag,
    CAST(hour("timestamp") AS INTEGER) AS hour,
    CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN isodow("timestamp") - 1 IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CAST(CASE WHEN hour("timestamp") >= 22 OR hour("timestamp") <= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_night,
    ln(1 + CAST(amount_inr AS DOUBLE)) AS amount_log,
    (CAST(amount_inr AS DOUBLE) - st.mu) / st.sd AS amount_zscore,
    CAST(CASE WHEN sender_state IS NULL OR receiver_state IS NULL THEN 1
              WHEN sender_state != receiver_state THEN 1 ELSE 0 END AS INTEGER) AS cross_state,
    CAST(CASE WHEN CAST(amount_inr AS DOUBLE) > st.p95 THEN 1 ELSE 0 END AS INTEGER) AS high_value,
""" + _ENC + """
  FROM transactions, st
)"""

PREPARED_FEATURES = FEATURE_BASE_CTE + """
SELECT transaction_id, hour, day_of_week, is_weekend, is_night, ROUND(amount_log, 6) AS amount_log,
       ROUND(amount_zscore, 6) AS amount_zscore, cross_state, high_value,
       """ + ", ".join(f"{c}_encoded" for c in fixed.CATEGORICAL_COLUMNS) + """
FROM feat"""

_F = list(fixed.FEATURE_COLUMNS)
SCALED_FEATURES = FEATURE_BASE_CTE + """,
med AS (SELECT """ + ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in _F) + """ FROM feat),
imp AS (SELECT transaction_id, """ + ", ".join(
    f"COALESCE(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in _F) + """ FROM feat, med),
sc AS (SELECT """ + ", ".join(
    f"AVG({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}"
    for c in _F) + """ FROM imp)
SELECT transaction_id, """ + ", ".join(
    f"ROUND(({c} - mu_{c}) / sd_{c}, 6) AS {c}" for c in _F) + """
FROM imp, sc"""

USER_PROFILES = """
base AS (SELECT * FROM transactions
         WHERE sender_age_group IS NOT NULL AND sender_state IS NOT NULL AND device_type IS NOT NULL),
modes AS (
  SELECT sender_age_group, sender_state, device_type, transaction_type,
         ROW_NUMBER() OVER (PARTITION BY sender_age_group, sender_state, device_type
                            ORDER BY COUNT(*) DESC, transaction_type) AS rn
  FROM base WHERE transaction_type IS NOT NULL GROUP BY 1, 2, 3, 4
),
g AS (
  SELECT sender_age_group, sender_state, device_type,
    round_even(AVG(CAST(amount_inr AS DOUBLE)), 2) AS avg_amount,
    round_even(stddev_samp(CAST(amount_inr AS DOUBLE)), 2) AS std_amount,
    COUNT(amount_inr) AS txn_count,
    MAX(amount_inr) AS max_amount,
    COUNT(DISTINCT merchant_category) AS merchant_diversity,
    CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count,
    CAST(floor((epoch_us(MAX("timestamp")) - epoch_us(MIN("timestamp"))) / 86400000000) AS BIGINT) AS active_days
  FROM base GROUP BY 1, 2, 3
),
p AS (
  SELECT g.*, m.transaction_type AS preferred_type,
    CAST(fraud_count AS DOUBLE) / txn_count AS fraud_rate,
    CASE WHEN active_days = 0 THEN 'inf'::DOUBLE ELSE CAST(txn_count AS DOUBLE) / active_days END AS daily_avg_txns
  FROM g LEFT JOIN modes m USING (sender_age_group, sender_state, device_type)
  WHERE m.rn = 1 OR m.rn IS NULL
)
SELECT sender_age_group, sender_state, device_type, avg_amount, std_amount, txn_count, max_amount,
       preferred_type, merchant_diversity, fraud_count, active_days,
       ROUND(fraud_rate, 6) AS fraud_rate, ROUND(daily_avg_txns, 6) AS daily_avg_txns,
       ROUND(fraud_rate * 0.4
         + CASE WHEN avg_amount = 0 THEN CASE WHEN max_amount > 0 THEN 5.0 END
                ELSE LEAST(GREATEST(max_amount / avg_amount, 0), 5) END * 0.3
         + CASE WHEN active_days = 0 THEN 1.0 ELSE LEAST(GREATEST(daily_avg_txns / 10, 0), 1) END * 0.3, 6) AS risk_score
FROM p"""

# --- graph -----------------------------------------------------------------------
BANK_EDGES = """
SELECT 'bank_' || sender_bank AS src, 'bank_' || receiver_bank AS dst, COUNT(*) AS weight,
       CAST(SUM(amount_inr) AS BIGINT) AS total_amount, CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count,
       ROUND(CAST(SUM(fraud_flag) AS DOUBLE) / COUNT(*), 6) AS fraud_rate
FROM transactions GROUP BY 1, 2"""

HIGH_FRAUD_EDGES = BANK_EDGES + """
HAVING COUNT(*) > 10 AND CAST(SUM(fraud_flag) AS DOUBLE) / COUNT(*) > {threshold}"""

GRAPH_SIZE = """
e AS (SELECT DISTINCT sender_bank, receiver_bank FROM transactions)
SELECT (SELECT COUNT(*) FROM (SELECT sender_bank FROM e UNION SELECT receiver_bank FROM e)) AS graph_nodes,
       (SELECT COUNT(*) FROM e) AS graph_edges"""

NODE_INCIDENT = """
e AS (SELECT 'bank_' || sender_bank AS src, 'bank_' || receiver_bank AS dst, COUNT(*) AS weight,
             SUM(fraud_flag) AS fraud_count FROM transactions GROUP BY 1, 2),
b AS (SELECT dst AS node, fraud_count, weight FROM e UNION ALL SELECT src, fraud_count, weight FROM e)
SELECT node, CAST(SUM(fraud_count) AS BIGINT) AS total_fraud, CAST(SUM(weight) AS BIGINT) AS total_transactions,
       ROUND(CAST(SUM(fraud_count) AS DOUBLE) / NULLIF(SUM(weight), 0), 6) AS node_fraud_rate
FROM b GROUP BY node"""

FRAUD_RELATED_BANKS = """
SELECT sender_bank AS bank FROM transactions WHERE fraud_flag = 1
UNION SELECT receiver_bank FROM transactions WHERE fraud_flag = 1"""

FRAUD_SUBGRAPH = """
fb AS (SELECT sender_bank AS bank FROM transactions WHERE fraud_flag = 1
       UNION SELECT receiver_bank FROM transactions WHERE fraud_flag = 1)
SELECT * FROM transactions
WHERE sender_bank IN (SELECT bank FROM fb) OR receiver_bank IN (SELECT bank FROM fb)"""

NETWORK_EDGES = """
fb AS (SELECT sender_bank AS bank FROM transactions WHERE fraud_flag = 1
       UNION SELECT receiver_bank FROM transactions WHERE fraud_flag = 1),
sub AS (SELECT * FROM transactions
        WHERE sender_bank IN (SELECT bank FROM fb) OR receiver_bank IN (SELECT bank FROM fb)),
last AS (SELECT sender_bank, receiver_bank, arg_max(fraud_flag, ("timestamp", transaction_id)) AS fraud_flag
         FROM sub GROUP BY 1, 2)
SELECT sender_bank, receiver_bank, fraud_flag,
       CASE WHEN fraud_flag = 1 THEN 'red' ELSE 'lightgray' END AS edge_color,
       CASE WHEN fraud_flag = 1 THEN 2.5 ELSE 0.5 END::DOUBLE AS edge_width,
       CASE WHEN fraud_flag = 1 THEN 1.0 ELSE 0.3 END::DOUBLE AS edge_alpha,
       CASE WHEN sender_bank IN (SELECT bank FROM fb) THEN 'fraud_related' ELSE 'neighbour' END AS sender_class,
       CASE WHEN receiver_bank IN (SELECT bank FROM fb) THEN 'fraud_related' ELSE 'neighbour' END AS receiver_class
FROM last"""

HEAD_N = """SELECT * FROM transactions ORDER BY transaction_id LIMIT 5"""

# header of the CSV extract (spreadsheet style) -> normalised name
RENAME_REPORT = "SELECT * FROM (VALUES " + ", ".join(
    "('" + " ".join({"id": "ID", "inr": "(INR)"}.get(w, w.capitalize()) for w in c.split("_"))
    + "', '" + c + "')" for c, _ in TXN_TYPES) + ") AS r(original, new)"

# DBSCAN neighbour counts (self included) by brute force over all pairs of
# scaled feature vectors, eps 1.0 as registered
_Z = SCALED_FEATURES[:SCALED_FEATURES.index("SELECT transaction_id, ROUND(")]
DBSCAN_CORE_POINTS = _Z + """,
z AS (SELECT transaction_id, """ + ", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in _F) + """ FROM imp, sc),
nb AS (SELECT a.transaction_id, COUNT(*) AS n_neighbours FROM z a JOIN z b ON (""" + " + ".join(
    f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _F) + """) <= 1.0 * 1.0 GROUP BY a.transaction_id)
SELECT transaction_id, n_neighbours, n_neighbours >= 5 AS is_core FROM nb"""

# Clusters: components of the core points by keyed recursion (a point's row is replaced
# only by a smaller label), numbered by their smallest key; border points take the
# smallest cluster next to them. Needs WITH RECURSIVE (see catalog).
_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _F)
_CLUSTERS = _Z + """,
z AS (SELECT transaction_id, fraud_flag, """ + ", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in _F) + """
      FROM imp JOIN transactions USING (transaction_id), sc),
near AS MATERIALIZED (SELECT a.transaction_id AS x, b.transaction_id AS y, """ + _D2 + """ AS d2
                      FROM z a JOIN z b ON (""" + _D2 + """) <= 1.0 * 1.0),
core AS MATERIALIZED (SELECT x AS id FROM near GROUP BY x HAVING COUNT(*) >= 5),
core_pairs AS MATERIALIZED (SELECT x, y FROM near WHERE x IN (SELECT id FROM core)
                            AND y IN (SELECT id FROM core)),
lab(id, label) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  (SELECT p.y, min(l.label) FROM lab l JOIN core_pairs p ON p.x = l.id
   JOIN recurring.lab AS r ON r.id = p.y
   GROUP BY p.y, r.label HAVING min(l.label) < r.label)),
numbered AS (SELECT label, CAST(ROW_NUMBER() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster
             FROM (SELECT DISTINCT label FROM lab)),
inner_points AS (SELECT lab.id, cluster FROM lab JOIN numbered USING (label)),
border AS (SELECT near.x AS id, MIN(cluster) AS cluster FROM near JOIN inner_points i ON i.id = near.y
           WHERE near.x NOT IN (SELECT id FROM core) GROUP BY near.x),
clusters AS (
  SELECT z.transaction_id, z.fraud_flag, COALESCE(i.cluster, b.cluster, -1) AS cluster,
         i.id IS NOT NULL AS is_core
  FROM z LEFT JOIN inner_points i ON i.id = z.transaction_id
  LEFT JOIN border b ON b.id = z.transaction_id),
rates AS (SELECT cluster, AVG(CAST(fraud_flag AS DOUBLE)) AS fraud_rate, COUNT(*) AS size
          FROM clusters WHERE cluster <> -1 GROUP BY cluster)"""
DBSCAN_CLUSTERS = _CLUSTERS + """
SELECT transaction_id, cluster, is_core FROM clusters"""
CLUSTER_FRAUD_RATES = _CLUSTERS + """
SELECT cluster, ROUND(fraud_rate, 9) AS fraud_rate, size FROM rates"""
ANOMALY_CLUSTERS = _CLUSTERS + """
SELECT cluster, ROUND(fraud_rate, 9) AS fraud_rate, size FROM rates WHERE fraud_rate > 0.05"""

# Centralities: shortest distances by keyed recursion (a pair's row is replaced
# only by a shorter distance), shortest-path counts by enumerating the
# shortest-path DAG (every edge adds positive distance, so it terminates).
# Needs WITH RECURSIVE (see catalog).
_CENTRALITY_CTES = """
day AS (SELECT * FROM transactions
        WHERE "timestamp" >= {as_of} - INTERVAL 1 DAY AND "timestamp" < {as_of}),
e0 AS (SELECT 'bank_' || sender_bank AS src, 'bank_' || receiver_bank AS dst, COUNT(*) AS weight,
              CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count FROM day GROUP BY 1, 2),
nodes AS (SELECT src AS node FROM e0 UNION SELECT dst FROM e0),
e AS (SELECT src AS u, dst AS v, CAST(weight AS DOUBLE) AS w FROM e0 WHERE src <> dst),
d(src, dst, dist) USING KEY (src, dst) AS (
  SELECT node, node, CAST(0.0 AS DOUBLE) FROM nodes
  UNION
  (SELECT d.src, e.v, min(d.dist + e.w)
   FROM d JOIN e ON d.dst = e.u
   LEFT JOIN recurring.d AS r ON r.src = d.src AND r.dst = e.v
   GROUP BY d.src, e.v, r.dist
   HAVING r.dist IS NULL OR min(d.dist + e.w) < r.dist)
),
dag AS (SELECT d1.src AS s, e.u, e.v FROM d d1 JOIN e ON d1.dst = e.u
        JOIN d d2 ON d2.src = d1.src AND d2.dst = e.v WHERE d1.dist + e.w = d2.dist),
paths(s, t) AS (SELECT node, node FROM nodes
                UNION ALL SELECT p.s, dag.v FROM paths p JOIN dag ON dag.s = p.s AND dag.u = p.t),
sigma AS (SELECT s, t, COUNT(*) AS sigma FROM paths GROUP BY s, t),
sp AS (SELECT d.src AS s, d.dst AS t, d.dist, CAST(sigma.sigma AS DOUBLE) AS sigma
       FROM d JOIN sigma ON sigma.s = d.src AND sigma.t = d.dst WHERE d.src <> d.dst),
bt AS (SELECT sv.t AS node, SUM(sv.sigma * vt.sigma / st.sigma) AS b
       FROM sp sv JOIN sp vt ON vt.s = sv.t JOIN sp st ON st.s = sv.s AND st.t = vt.t
       WHERE sv.s <> vt.t AND sv.dist + vt.dist = st.dist GROUP BY sv.t),
n AS (SELECT COUNT(*) AS n FROM nodes),
cl AS (SELECT dst AS node, COUNT(*) AS r, SUM(dist) AS tot FROM d WHERE src <> dst GROUP BY dst),
inc AS (SELECT node, CAST(SUM(fraud_count) AS BIGINT) AS total_fraud, CAST(SUM(weight) AS BIGINT) AS total_transactions,
               CAST(SUM(fraud_count) AS DOUBLE) / NULLIF(SUM(weight), 0) AS node_fraud_rate
        FROM (SELECT dst AS node, fraud_count, weight FROM e0 UNION ALL SELECT src, fraud_count, weight FROM e0)
        GROUP BY node),
cent AS (
  SELECT nodes.node,
         COALESCE(bt.b * CASE WHEN n.n > 2 THEN 1.0 / ((n.n - 1) * (n.n - 2)) END, 0.0) AS betweenness_centrality,
         COALESCE(CASE WHEN cl.tot > 0 AND n.n > 1
                       THEN (CAST(cl.r AS DOUBLE) / cl.tot) * (CAST(cl.r AS DOUBLE) / (n.n - 1)) END, 0.0)
           AS closeness_centrality,
         inc.total_fraud, inc.total_transactions, inc.node_fraud_rate
  FROM nodes CROSS JOIN n
  LEFT JOIN bt ON bt.node = nodes.node
  LEFT JOIN cl ON cl.node = nodes.node
  LEFT JOIN inc ON inc.node = nodes.node
)"""

GRAPH_CENTRALITY = _CENTRALITY_CTES + """
SELECT node, ROUND(betweenness_centrality, 9) AS betweenness_centrality,
       ROUND(closeness_centrality, 9) AS closeness_centrality, total_fraud, total_transactions,
       ROUND(node_fraud_rate, 9) AS node_fraud_rate
FROM cent"""

# edge length 1 / count, in decimals so that sums do not depend on their order
GRAPH_CENTRALITY_INVERSE = GRAPH_CENTRALITY.replace(
    "CAST(weight AS DOUBLE) AS w", "CAST(1.0::DOUBLE / weight AS DECIMAL(38,18)) AS w").replace(
    "CAST(0.0 AS DOUBLE) FROM nodes", "CAST(0 AS DECIMAL(38,18)) FROM nodes").replace(
    "SUM(dist) AS tot", "CAST(SUM(dist) AS DOUBLE) AS tot")

# registered with the day's floors of the catalog
_SUSPICIOUS_CTE = """,
sus AS (SELECT node, node_fraud_rate AS fraud_rate, betweenness_centrality, closeness_centrality,
               total_transactions
        FROM cent WHERE betweenness_centrality > 0.05 AND closeness_centrality > 0.4
                    AND total_transactions > 0 AND node_fraud_rate > 0.005)"""

SUSPICIOUS_NODES = _CENTRALITY_CTES + _SUSPICIOUS_CTE + """
SELECT node, ROUND(fraud_rate, 9) AS fraud_rate, ROUND(betweenness_centrality, 9) AS betweenness_centrality,
       ROUND(closeness_centrality, 9) AS closeness_centrality, total_transactions
FROM sus ORDER BY fraud_rate DESC, node"""

GRAPH_RISK_SCORES = _CENTRALITY_CTES + _SUSPICIOUS_CTE + """
SELECT t.transaction_id, t.sender_bank, t.receiver_bank,
       ROUND(LEAST(1.0, (0.1 + (COALESCE(s1.fraud_rate, 0.0)
                                 + CASE WHEN t.sender_bank = t.receiver_bank THEN 0.0
                                        ELSE COALESCE(s2.fraud_rate, 0.0) END))
                        + COALESCE(CAST(e0.fraud_count AS DOUBLE) / e0.weight, 0.0)), 9) AS graph_risk_score
FROM day t
LEFT JOIN sus s1 ON s1.node = 'bank_' || t.sender_bank
LEFT JOIN sus s2 ON s2.node = 'bank_' || t.receiver_bank
LEFT JOIN e0 ON e0.src = 'bank_' || t.sender_bank AND e0.dst = 'bank_' || t.receiver_bank"""


# payments that lose a value (every 7th amount, every 11th receiver state)
_GAPS = """
gaps AS (SELECT * REPLACE (
  CASE WHEN CAST(substr(transaction_id, 4, 10) AS BIGINT) % 7 <> 0 THEN amount_inr END AS amount_inr,
  CASE WHEN CAST(substr(transaction_id, 4, 10) AS BIGINT) % 11 <> 0 THEN receiver_state END AS receiver_state)
  FROM transactions)"""
_NO_NULL = " AND ".join(f'"{c}" IS NOT NULL' for c, _ in TXN_TYPES)

DROP_NULLS_GAPS = _GAPS + "\nSELECT * FROM gaps WHERE " + _NO_NULL

NULL_COUNTS_GAPS = _GAPS + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) - COUNT("{c}") AS null_count, '{stage}' AS stage
FROM gaps WHERE {where}""" for stage, where in (("before", "TRUE"), ("after", _NO_NULL))
    for c, _ in TXN_TYPES)

IMPUTE_MEDIAN = _GAPS + """
SELECT transaction_id, COALESCE(CAST(amount_inr AS DOUBLE),
       (SELECT quantile_cont(CAST(amount_inr AS DOUBLE), 0.5) FROM gaps)) AS amount_inr FROM gaps"""


# --- the blend: amounts in the place of the isolation forest, the rule score in that of
# the random forest, the cluster of the nearest core point, the last day's bank graph
_BLEND = _CLUSTERS + "," + _CENTRALITY_CTES + _SUSPICIOUS_CTE + """,
assigned AS (SELECT n.x AS transaction_id, arg_min(i.cluster, (n.d2, n.y)) AS cluster
             FROM near n JOIN inner_points i ON i.id = n.y GROUP BY n.x),
scale AS (SELECT MIN(-CAST(amount_inr AS DOUBLE)) AS lo, MAX(-CAST(amount_inr AS DOUBLE)) AS hi
          FROM transactions),
parts AS (
  SELECT t.transaction_id, t.amount_inr, COALESCE(a.cluster, -1) AS cluster,
         1 - (-CAST(t.amount_inr AS DOUBLE) - scale.lo) / (scale.hi - scale.lo) AS iso_score,
         """ + RISK_SCORE_EXPR + """ / 4.0 AS rf_probability,
         CASE WHEN r.fraud_rate > 0.05 THEN 1.0 ELSE 0.1 END::DOUBLE AS dbscan_score,
         LEAST(1.0, (0.1 + (COALESCE(s1.fraud_rate, 0.0)
                            + CASE WHEN t.sender_bank = t.receiver_bank THEN 0.0
                                   ELSE COALESCE(s2.fraud_rate, 0.0) END))
                    + COALESCE(CAST(e0.fraud_count AS DOUBLE) / e0.weight, 0.0)) AS graph_risk_score
  FROM transactions t CROSS JOIN scale
  LEFT JOIN assigned a ON a.transaction_id = t.transaction_id
  LEFT JOIN rates r ON r.cluster = a.cluster
  LEFT JOIN sus s1 ON s1.node = 'bank_' || t.sender_bank
  LEFT JOIN sus s2 ON s2.node = 'bank_' || t.receiver_bank
  LEFT JOIN e0 ON e0.src = 'bank_' || t.sender_bank AND e0.dst = 'bank_' || t.receiver_bank),
final AS (
  SELECT *, (iso_score * 0.3::DOUBLE + rf_probability * 0.5::DOUBLE + dbscan_score * 0.2::DOUBLE) * 0.8::DOUBLE
            + graph_risk_score * 0.2::DOUBLE AS score FROM parts),
blended AS (
  SELECT transaction_id, amount_inr, cluster, ROUND(iso_score, 9) AS iso_score,
         ROUND(rf_probability, 9) AS rf_probability, ROUND(dbscan_score, 9) AS dbscan_score,
         ROUND(graph_risk_score, 9) AS graph_risk_score, ROUND(score, 9) AS fraud_score,
         CASE WHEN score > 0 AND score <= 0.2 THEN 'Low' WHEN score > 0.2 AND score <= 0.5 THEN 'Medium'
              WHEN score > 0.5 AND score <= 0.8 THEN 'High' WHEN score > 0.8 AND score <= 1 THEN 'Critical'
         END AS risk_category
  FROM final)"""
BLEND_SCORES = _BLEND + """
SELECT * FROM blended"""
BLEND_TOPK = _BLEND + """
SELECT transaction_id, amount_inr, ROUND(fraud_score, 4) AS fraud_score, risk_category FROM (
  SELECT * FROM blended ORDER BY ROUND(fraud_score, 4) DESC, transaction_id LIMIT 10)"""
BLEND_SINK = _BLEND + """
SELECT transaction_id, amount_inr, fraud_score, risk_category FROM blended"""

# counts of the model: graph and centralities of all payments, with the ensemble's floors
_ALL_TIMES = _CENTRALITY_CTES.replace("""
        WHERE "timestamp" >= {as_of} - INTERVAL 1 DAY AND "timestamp" < {as_of}""", "")
MODEL_SUMMARY_CTES = _CLUSTERS + "," + _ALL_TIMES + """,
summary AS (
  SELECT (SELECT COUNT(*) FROM cent WHERE betweenness_centrality > -1.0 AND closeness_centrality > 0.01
          AND total_transactions > 0 AND node_fraud_rate > 0.005) AS fraud_clusters_detected,
         (SELECT COUNT(*) FROM rates WHERE fraud_rate > 0.05) AS anomaly_clusters,
         (SELECT COUNT(*) FROM nodes) AS graph_nodes, (SELECT COUNT(*) FROM e0) AS graph_edges)"""
MODEL_SUMMARY = MODEL_SUMMARY_CTES + """
SELECT * FROM summary"""
