"""Bank-to-bank transaction graph: edges, centralities, suspicious nodes, risk.

Nodes are banks (``bank_<code>``) and a directed edge aggregates all payments
from one bank to another. The graph is therefore as large as the number of
banks squared, independent of the number of transactions; the transaction
scan itself is one ``groupBy`` with partial aggregation.

Centralities follow the weighted definitions used by the original (the edge
weight = transaction count, used as a *distance*, decision D9):
  * shortest distances come from delta relaxation: a round joins only the pairs that the
    last one improved with the edges;
  * path counts follow along the shortest-path edges, in the order of the paths' lengths,
    and betweenness(v) = sum over s != v != t of sigma_sv * sigma_vt / sigma_st is handed
    back along the same edges, normalised by 1/((n-1)(n-2));
  * closeness(u) uses incoming distances: r/sum(d) * r/(n-1) where r is the
    number of nodes that reach u (Wasserman-Faust scaling);
  * in wide graphs sampled sources (pivots) stand for all, with a stated error.
Distances are decimals, so sums do not depend on their order and the equality
tests are exact, also for ``distance="inverse"`` (1 / weight).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import checkpoint_dir
from .common import bounded_side, lookup_join, with_scalars

NODE_PREFIX = "bank_"


def node(col: str) -> F.Column:
    return F.concat(F.lit(NODE_PREFIX), F.col(col))


def bank_edges(t: DataFrame) -> DataFrame:
    """Directed edges: weight (= transaction count), total amount, fraud count
    and fraud rate. Replaces a per-row loop with one aggregation."""
    return (t.groupBy(node("sender_bank").alias("src"), node("receiver_bank").alias("dst"))
            .agg(F.count(F.lit(1)).alias("weight"),
                 F.sum("amount_inr").cast("bigint").alias("total_amount"),
                 F.sum("fraud_flag").cast("bigint").alias("fraud_count"))
            .withColumn("fraud_rate", F.col("fraud_count") / F.col("weight")))


def high_fraud_edges(edges: DataFrame, fraud_threshold: float = fixed.FRAUD_THRESHOLD,
                     min_weight: int = 10) -> DataFrame:
    return edges.where((F.col("fraud_rate") > fraud_threshold) & (F.col("weight") > min_weight))


def graph_nodes(edges: DataFrame) -> DataFrame:
    return (edges.select(F.col("src").alias("node"))
            .union(edges.select(F.col("dst").alias("node"))).distinct())


def graph_size(edges: DataFrame) -> DataFrame:
    """Node and edge counts (one row)."""
    n = graph_nodes(edges).agg(F.count(F.lit(1)).alias("graph_nodes"))
    e = edges.agg(F.count(F.lit(1)).alias("graph_edges"))
    return with_scalars(n, e)


DISTANCE_TYPE = "decimal(38,18)"
#: Banks up to which every bank is a source; beyond, ``PIVOTS`` sampled ones are.
EXACT_BANKS, PIVOTS = 2000, 512


def edge_length(distance: str) -> F.Column:
    """Length of an edge: a column's value, or ``inverse`` of the transaction count
    (busy links are short)."""
    length = F.lit(1.0) / F.col("weight") if distance == "inverse" else F.col(distance)
    return length.cast(DISTANCE_TYPE)


def _links(edges: DataFrame, distance: str) -> DataFrame:
    return edges.select(F.col("src").alias("u"), F.col("dst").alias("v"),
                        edge_length(distance).alias("w")).where(F.col("src") != F.col("dst"))


def pivot_sources(edges: DataFrame, pivots: int | None = None, seed: int = fixed.SEED) -> DataFrame:
    """The source banks: all of them, or the ``pivots`` of the smallest seeded hash."""
    nodes = graph_nodes(edges)
    if pivots is None:
        pivots = None if nodes.limit(EXACT_BANKS + 1).count() <= EXACT_BANKS else PIVOTS
    if pivots is None:
        return nodes
    return nodes.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(pivots)


def pivot_error(n: int, pivots: int, confidence: float = 0.95) -> float:
    """Error of all ``n`` normalised betweenness values at once that sampled sources do
    not exceed with that confidence (Hoeffding's bound over a mean of ``pivots`` shares
    in [0, 1], over all banks); 0 where every bank is a source."""
    return 0.0 if pivots >= n else math.sqrt(math.log(2 * n / (1 - confidence)) / (2 * (pivots - 1)))


def distances(edges: DataFrame, distance: str = "weight", sources: DataFrame | None = None) -> DataFrame:
    """(src, dst, dist) of every bank a source reaches, (v, v, 0) included. ``distance``
    names the edge column used as length (must be positive), or is ``inverse``.

    Delta relaxation: a round extends only the pairs that the last round improved, and
    keeps the extensions that are shorter than what is known; it ends when none is."""
    checkpoint_dir(edges.sparkSession)
    links = _links(edges, distance).checkpoint(eager=True)
    sources = graph_nodes(edges) if sources is None else sources
    known = sources.select(F.col("node").alias("src"), F.col("node").alias("dst"),
                           F.lit(0).cast(DISTANCE_TYPE).alias("dist")).checkpoint(eager=True)
    delta = known
    while True:
        longer = (delta.withColumnRenamed("dst", "u").join(links, "u")
                  .groupBy("src", F.col("v").alias("dst"))
                  .agg(F.min((F.col("dist") + F.col("w")).cast(DISTANCE_TYPE)).alias("new")))
        better = (longer.join(known, ["src", "dst"], "left")
                  .where(F.col("dist").isNull() | (F.col("new") < F.col("dist")))
                  .select("src", "dst", F.col("new").alias("dist")).checkpoint(eager=True))
        if not better.limit(1).count():
            return known
        known = (known.join(better, ["src", "dst"], "left_anti").unionByName(better)
                 .checkpoint(eager=True))
        delta = better


def shortest_dag(dist: DataFrame, edges: DataFrame, distance: str = "weight") -> DataFrame:
    """(src, u, v): the edges u -> v that lie on a shortest path from src."""
    links = _links(edges, distance)
    return (dist.withColumnRenamed("dst", "u").join(links, "u")
            .select("src", "u", "v", (F.col("dist") + F.col("w")).cast(DISTANCE_TYPE).alias("dist"))
            .join(dist.withColumnRenamed("dst", "v"), ["src", "v", "dist"], "left_semi")
            .select("src", "u", "v").checkpoint(eager=True))


def path_counts(dag: DataFrame, sources: DataFrame) -> DataFrame:
    """(src, dst, sigma): number of shortest paths, summed over their number of edges. A
    round extends the paths of exactly k edges, so it joins the pairs such paths end at."""
    count = "decimal(38,0)"
    front = sources.select(F.col("node").alias("src"), F.col("node").alias("dst"),
                           F.lit(1).cast(count).alias("sigma")).checkpoint(eager=True)
    found = front
    while True:
        front = (front.withColumnRenamed("dst", "u").join(dag, ["src", "u"])
                 .groupBy("src", F.col("v").alias("dst"))
                 .agg(F.sum("sigma").cast(count).alias("sigma")).checkpoint(eager=True))
        if not front.limit(1).count():
            return found.withColumn("sigma", F.col("sigma").cast("double"))
        found = (found.unionByName(front).groupBy("src", "dst")
                 .agg(F.sum("sigma").cast(count).alias("sigma")).checkpoint(eager=True))


def dependencies(dag: DataFrame, sigma: DataFrame) -> DataFrame:
    """(src, node, share): the pairs (src, t) whose shortest paths pass through node,
    each counted by the part of its paths that do. What lies behind an edge u -> v is
    handed back to u in the proportion sigma(u) / sigma(v), a round per edge of the
    longest path."""
    ahead = sigma.select("src", F.col("dst").alias("v"), F.col("sigma").alias("sv"))
    here = sigma.select("src", F.col("dst").alias("u"), F.col("sigma").alias("su"))
    part = (dag.join(ahead, ["src", "v"]).join(here, ["src", "u"])
            .select("src", "u", "v", (F.col("su") / F.col("sv")).alias("part")).checkpoint(eager=True))
    front = sigma.where("src <> dst").select("src", F.col("dst").alias("v"), F.lit(1.0).alias("x"))
    total = None
    while True:
        front = (part.join(front, ["src", "v"]).where("u <> src")
                 .groupBy("src", F.col("u").alias("v")).agg(F.sum(F.col("part") * F.col("x")).alias("x"))
                 .checkpoint(eager=True))
        if not front.limit(1).count():
            break
        total = front if total is None else total.unionByName(front)
    if total is None:
        total = front
    return total.groupBy("src", F.col("v").alias("node")).agg(F.sum("x").alias("share"))


def shortest_paths(edges: DataFrame, distance: str = "weight") -> DataFrame:
    """(src, dst, dist, sigma): shortest distances and numbers of shortest paths of all
    pairs, (v, v, 0, 1) included."""
    dist = distances(edges, distance)
    return dist.join(path_counts(shortest_dag(dist, edges, distance), graph_nodes(edges)), ["src", "dst"])


def centralities(edges: DataFrame, distance: str = "weight", pivots: int | None = None,
                 seed: int = fixed.SEED) -> DataFrame:
    """(node, betweenness_centrality, closeness_centrality).

    Every bank is a source up to ``EXACT_BANKS`` banks. Beyond, or with ``pivots``, sampled
    sources stand for all: a node's sums over the other sources are scaled by (n - 1) over
    their number, which is exact when all banks are pivots; ``pivot_error`` bounds the
    error. Closeness uses incoming distances (Wasserman-Faust scaling)."""
    sources = pivot_sources(edges, pivots, seed).checkpoint(eager=True)
    nodes = graph_nodes(edges)
    n, k = nodes.count(), sources.count()
    dist = distances(edges, distance, sources)
    dag = shortest_dag(dist, edges, distance)
    share = dependencies(dag, path_counts(dag, sources))
    between = share.groupBy("node").agg(F.sum("share").alias("_b"))
    inward = (dist.where("src <> dst").groupBy(F.col("dst").alias("node"))
              .agg(F.count(F.lit(1)).alias("_r"), F.sum("dist").cast("double").alias("_tot")))
    others = F.lit(k) - F.when(F.col("_is"), 1).otherwise(0)       # the other sources
    scale = F.try_divide(F.lit(float(n - 1)), others)
    reach = F.col("_r") * scale
    close = F.when((F.col("_tot") > 0) & (F.lit(n) > 1),
                   (F.col("_r") / F.col("_tot")) * (reach / F.lit(max(n - 1, 1)))).otherwise(0.0)
    norm = 1.0 / ((n - 1) * (n - 2)) if n > 2 else None
    return (nodes.join(between, "node", "left").join(inward, "node", "left")
            .join(sources.select("node", F.lit(True).alias("_is")), "node", "left")
            .select("node", F.coalesce(F.col("_b") * scale * F.lit(norm).cast("double"), F.lit(0.0))
                    .alias("betweenness_centrality"),
                    F.coalesce(close, F.lit(0.0)).alias("closeness_centrality")))


def node_incident_stats(edges: DataFrame) -> DataFrame:
    """Fraud and transaction totals over in- and out-edges of every node (a
    self-loop is incident twice)."""
    both = (edges.select(F.col("dst").alias("node"), "fraud_count", "weight")
            .unionByName(edges.select(F.col("src").alias("node"), "fraud_count", "weight")))
    return (both.groupBy("node").agg(F.sum("fraud_count").alias("total_fraud"),
                                     F.sum("weight").alias("total_transactions"))
            .withColumn("node_fraud_rate",
                        F.try_divide(F.col("total_fraud").cast("double"),
                                     F.col("total_transactions").cast("double"))))


def centrality_table(edges: DataFrame, distance: str = "weight", pivots: int | None = None) -> DataFrame:
    """Per node: betweenness, closeness, incident fraud rate and volume."""
    return centralities(edges, distance, pivots).join(node_incident_stats(edges), "node")


def suspicious_nodes(edges: DataFrame, fraud_threshold: float = fixed.FRAUD_THRESHOLD,
                     min_betweenness: float = 0.1, min_closeness: float = 0.1,
                     distance: str = "weight") -> DataFrame:
    """Nodes central on both measures whose incident fraud rate exceeds the
    threshold, highest rate first."""
    return select_suspicious(centrality_table(edges, distance), fraud_threshold,
                             min_betweenness, min_closeness)


def select_suspicious(c: DataFrame, fraud_threshold: float = fixed.FRAUD_THRESHOLD,
                      min_betweenness: float = 0.1, min_closeness: float = 0.1) -> DataFrame:
    """The suspicious-node filter over a centrality table."""
    return (c.where((F.col("betweenness_centrality") > min_betweenness)
                    & (F.col("closeness_centrality") > min_closeness)
                    & (F.col("total_transactions") > 0)
                    & (F.col("node_fraud_rate") > fraud_threshold))
            .select("node", F.col("node_fraud_rate").alias("fraud_rate"),
                    "betweenness_centrality", "closeness_centrality",
                    F.col("total_transactions"))
            .orderBy(F.desc("fraud_rate"), "node"))


def graph_risk_scores(t: DataFrame, edges: DataFrame, suspicious: DataFrame,
                      most: int | None = None) -> DataFrame:
    """Per transaction: min(1, 0.1 + sum of suspicious-node rates among its two
    endpoints (once when both are the same bank) + its edge's fraud rate). Banks and
    bank pairs go to every task up to a checked number of ``most``; beyond it the payments
    of frequent banks are dealt over salts (``lookup_join``)."""
    s = suspicious.select(F.col("node").alias("_n"), F.col("fraud_rate").alias("_r"))
    e = edges.select(F.col("src").alias("_src"), F.col("dst").alias("_dst"),
                     F.col("fraud_rate").alias("_edge_rate"))
    x = t.withColumns({"_src": node("sender_bank"), "_dst": node("receiver_bank")})
    x = lookup_join(x, s.withColumnRenamed("_n", "_src").withColumnRenamed("_r", "_rs"), ["_src"], most)
    x = lookup_join(x, s.withColumnRenamed("_n", "_dst").withColumnRenamed("_r", "_rd"), ["_dst"], most)
    x = lookup_join(x, e, ["_src", "_dst"], most)
    cluster = F.coalesce(F.col("_rs"), F.lit(0.0)) + F.when(
        F.col("_src") == F.col("_dst"), F.lit(0.0)).otherwise(F.coalesce(F.col("_rd"), F.lit(0.0)))
    score = F.least(F.lit(1.0), F.lit(0.1) + cluster + F.coalesce(F.col("_edge_rate"), F.lit(0.0)))
    return x.withColumn("graph_risk_score", score).drop("_src", "_dst", "_rs", "_rd", "_edge_rate")


# --- notebook network view -----------------------------------------------------
def fraud_related_banks(t: DataFrame) -> DataFrame:
    """Banks that sent or received at least one fraudulent payment."""
    f = t.where(F.col("fraud_flag") == 1)
    return (f.select(F.col("sender_bank").alias("bank"))
            .union(f.select(F.col("receiver_bank").alias("bank"))).distinct())


def fraud_subgraph(t: DataFrame, most: int | None = None) -> DataFrame:
    """Payments whose sender OR receiver bank is fraud-related.

    Two left joins against the bank set give one flag per side (a semi join
    cannot express OR); the bank set is computed once and looked up by ``lookup_join``.
    """
    checkpoint_dir(t.sparkSession)
    return _subgraph(t, fraud_related_banks(t).checkpoint(eager=True), most).select(*t.columns)


def _subgraph(t: DataFrame, banks: DataFrame, most: int | None = None) -> DataFrame:
    x = lookup_join(t, banks.select(F.col("bank").alias("sender_bank"), F.lit(1).alias("_s")),
                    ["sender_bank"], most)
    x = lookup_join(x, banks.select(F.col("bank").alias("receiver_bank"), F.lit(1).alias("_r")),
                    ["receiver_bank"], most)
    return (x.where(F.col("_s").isNotNull() | F.col("_r").isNotNull())
            .drop("_s", "_r"))


def network_edges_last_flag(t: DataFrame) -> DataFrame:
    """One edge per bank pair carrying the fraud flag of its LAST payment (later
    rows overwrite earlier ones); "last" is event time, then transaction id."""
    checkpoint_dir(t.sparkSession)
    banks = fraud_related_banks(t).checkpoint(eager=True)
    sub = _subgraph(t, banks)
    banks = bounded_side(banks)
    e = sub.groupBy("sender_bank", "receiver_bank").agg(
        F.max_by("fraud_flag", F.struct("timestamp", "transaction_id")).alias("fraud_flag"))
    is_f = F.col("fraud_flag") == 1
    e = e.select("sender_bank", "receiver_bank", "fraud_flag",
                 *[F.when(is_f, fixed.FRAUD_EDGE[k]).otherwise(fixed.PLAIN_EDGE[k])
                   .alias(f"edge_{k}") for k in fixed.FRAUD_EDGE])
    flag = banks.select(F.col("bank"), F.lit("fraud_related").alias("_cls"))
    return (e.join(flag.withColumnRenamed("bank", "sender_bank")
                   .withColumnRenamed("_cls", "sender_class"), "sender_bank", "left")
            .join(flag.withColumnRenamed("bank", "receiver_bank")
                  .withColumnRenamed("_cls", "receiver_class"), "receiver_bank", "left")
            .fillna({"sender_class": "neighbour", "receiver_class": "neighbour"}))
