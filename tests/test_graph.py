"""Graph centralities against an in-test Dijkstra on small graphs."""

import re
import heapq
import itertools

from pyspark.sql import functions as F

from conftest import SF_SMALL, txn_frame
from txnscope.operators import graph as g


def _edges(spark, triples):
    rows = [(s, t, w, 0, f) for s, t, w, f in triples]
    return (spark.createDataFrame(rows, "src STRING, dst STRING, weight BIGINT, total_amount BIGINT, "
                                        "fraud_count BIGINT")
            .withColumn("fraud_rate", F.col("fraud_count") / F.col("weight")))


def _dijkstra_all(nodes, adj):
    dist, sigma = {}, {}
    for s in nodes:
        d, sg = {s: 0}, {s: 1}
        heap, done = [(0, s)], set()
        while heap:
            du, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            for v, w in adj.get(u, []):
                if v == u:
                    continue
                nd = du + w
                if v not in d or nd < d[v]:
                    d[v], sg[v] = nd, sg[u]
                    heapq.heappush(heap, (nd, v))
                elif nd == d[v]:
                    sg[v] += sg[u]
        for t in d:
            dist[(s, t)], sigma[(s, t)] = d[t], sg[t]
    return dist, sigma


def _brute(triples):
    nodes = sorted({x for s, t, *_ in triples for x in (s, t)})
    adj = {}
    for s, t, w, _ in triples:
        adj.setdefault(s, []).append((t, w))
    dist, sigma = _dijkstra_all(nodes, adj)
    n = len(nodes)
    bet = {v: 0.0 for v in nodes}
    for s, t in itertools.permutations(nodes, 2):
        if (s, t) not in dist:
            continue
        for v in nodes:
            if v in (s, t) or (s, v) not in dist or (v, t) not in dist:
                continue
            if dist[(s, v)] + dist[(v, t)] == dist[(s, t)]:
                bet[v] += sigma[(s, v)] * sigma[(v, t)] / sigma[(s, t)]
    bet = {v: b / ((n - 1) * (n - 2)) for v, b in bet.items()} if n > 2 else bet
    clo = {}
    for u in nodes:
        inc = [dist[(s, u)] for s in nodes if s != u and (s, u) in dist]
        tot, r = sum(inc), len(inc)
        clo[u] = (r / tot) * (r / (n - 1)) if tot > 0 and n > 1 else 0.0
    return bet, clo


def _check(spark, triples):
    c = {r["node"]: r for r in g.centrality_table(_edges(spark, triples)).collect()}
    bet, clo = _brute(triples)
    for v in bet:
        assert abs(c[v]["betweenness_centrality"] - bet[v]) < 1e-12, v
        assert abs(c[v]["closeness_centrality"] - clo[v]) < 1e-12, v


def test_line_graph(spark):
    triples = [("a", "b", 3, 1), ("b", "c", 2, 1)]
    c = {r["node"]: r for r in g.centrality_table(_edges(spark, triples)).collect()}
    assert c["b"]["betweenness_centrality"] == 0.5
    assert abs(c["b"]["closeness_centrality"] - 1 / (2 * 3)) < 1e-12
    _check(spark, triples)


def test_multiple_shortest_paths_and_self_loop(spark):
    triples = [("a", "b", 1, 0), ("a", "c", 1, 0), ("b", "d", 1, 0), ("c", "d", 1, 1),
               ("d", "a", 5, 0), ("b", "b", 4, 2), ("c", "b", 7, 0)]
    _check(spark, triples)
    inc = {r["node"]: r for r in g.node_incident_stats(_edges(spark, triples)).collect()}
    assert inc["b"]["total_transactions"] == 1 + 1 + 4 + 4 + 7  # self-loop counted twice


def test_fixture_graph_matches_brute_force(spark):
    from txnscope.sources.adapters import events_transactions
    e = g.bank_edges(events_transactions(spark, SF_SMALL))
    triples = [(r["src"], r["dst"], r["weight"], r["fraud_count"]) for r in e.collect()]
    _check(spark, triples)


def test_last_flag_overwrites(spark):
    import datetime as dt
    rows = [dict(sender_bank="A", receiver_bank="B", fraud_flag=1, timestamp=dt.datetime(2024, 1, 1)),
            dict(sender_bank="A", receiver_bank="B", fraud_flag=0, timestamp=dt.datetime(2024, 1, 2))]
    out = g.network_edges_last_flag(txn_frame(spark, rows)).collect()
    assert len(out) == 1 and out[0]["fraud_flag"] == 0 and out[0]["edge_width"] == 0.5


def test_graph_risk_self_loop_counted_once(spark):
    rows = [dict(sender_bank="A", receiver_bank="A", fraud_flag=1)] * 2
    t = txn_frame(spark, rows)
    edges = g.bank_edges(t)
    sus = spark.createDataFrame([("bank_A", 0.3)], "node STRING, fraud_rate DOUBLE")
    r = g.graph_risk_scores(t, edges, sus).select("graph_risk_score").distinct().collect()
    assert [x[0] for x in r] == [1.0]  # min(1, .1 + .3 + 1.0)
    sus2 = spark.createDataFrame([("bank_A", 0.2)], "node STRING, fraud_rate DOUBLE")
    t2 = txn_frame(spark, [dict(sender_bank="A", receiver_bank="A", fraud_flag=0)] * 3)
    r2 = g.graph_risk_scores(t2, g.bank_edges(t2), sus2).select("graph_risk_score").first()[0]
    assert abs(r2 - 0.3) < 1e-12  # .1 + .2 once + edge rate 0


def test_sql_centrality_oracle_on_multi_path_graph():
    """The DuckDB oracle of graph_centrality agrees with Dijkstra where
    betweenness is not zero (several shortest paths, a self-loop)."""
    import duckdb

    from txnscope.plans.oracle_profiling import GRAPH_CENTRALITY
    triples = [("a", "b", 1, 0), ("a", "c", 1, 0), ("b", "d", 1, 0), ("c", "d", 1, 1),
               ("d", "a", 5, 0), ("b", "b", 4, 2), ("c", "b", 7, 0)]
    con = duckdb.connect()
    rows = [(s, t, 1 if i < f else 0) for s, t, w, f in triples for i in range(w)]
    con.execute("CREATE TABLE transactions (sender_bank VARCHAR, receiver_bank VARCHAR, fraud_flag INTEGER)")
    con.executemany("INSERT INTO transactions VALUES (?, ?, ?)", rows)
    # the hand-made payments have no time: take them all as the day's
    whole = re.sub(r'WHERE "timestamp" >= .*? "timestamp" < \{as_of\}', "", GRAPH_CENTRALITY,
                   count=1, flags=re.S)
    got = {r[0]: r for r in con.sql("WITH RECURSIVE " + whole.strip()).fetchall()}
    bet, clo = _brute([(f"bank_{s}", f"bank_{t}", w, f) for s, t, w, f in triples])
    assert set(got) == set(bet)
    assert any(b > 0 for b in bet.values())
    for v in bet:
        assert abs(got[v][1] - round(bet[v], 9)) < 1e-12, v
        assert abs(got[v][2] - round(clo[v], 9)) < 1e-12, v


def test_all_pivots_equal_the_exact_centralities(spark):
    import random
    r = random.Random(4)
    triples = [(f"n{a}", f"n{b}", r.randint(1, 4), 0) for a, b in
               {(r.randrange(14), r.randrange(14)) for _ in range(40)}]
    edges = _edges(spark, triples)
    n = g.graph_nodes(edges).count()
    bet, clo = _brute(triples)
    for pivots in (n, n + 5):
        for row in g.centralities(edges, pivots=pivots).collect():
            assert abs(row["betweenness_centrality"] - bet[row["node"]]) < 1e-12
            assert abs(row["closeness_centrality"] - clo[row["node"]]) < 1e-12
    assert g.pivot_error(n, n) == 0.0


def test_wide_graph_takes_pivots_within_the_stated_error(spark, monkeypatch):
    """5,000 banks: two linked hubs with their leaves, whose centralities are known."""
    monkeypatch.setattr(g, "PIVOTS", 96)
    a, b = 3000, 1998
    both = [("hub1", "hub2")] + [("hub1", f"a{i}") for i in range(a)] + [
        ("hub2", f"b{i}") for i in range(b)]
    edges = spark.createDataFrame([(s, t, 1, 0) for x, y in both for s, t in ((x, y), (y, x))],
                                  "src STRING, dst STRING, weight BIGINT, fraud_count BIGINT")
    n = a + b + 2
    got = {r["node"]: r for r in g.centralities(edges).collect()}
    bound = g.pivot_error(n, 96)
    assert len(got) == n == 5000 and 0 < bound < 0.3
    whole = (n - 1) * (n - 2)
    exact = {"hub1": (a * (a - 1) + 2 * a * (b + 1)) / whole, "hub2": (b * (b - 1) + 2 * b * (a + 1)) / whole}
    for v, row in got.items():
        assert abs(row["betweenness_centrality"] - exact.get(v, 0.0)) <= bound, v
    close = (n - 1) / (a + 1 + 2 * b)                       # hub1: leaves and hub2 at 1, others at 2
    assert abs(got["hub1"]["closeness_centrality"] - close) < 0.1


def test_rounds_join_only_improved_pairs(spark, monkeypatch):
    """On a line of k banks round i extends only the pairs that are i edges apart."""
    k, rows = 8, []
    edges = _edges(spark, [(f"v{i}", f"v{i + 1}", 1, 0) for i in range(k)])
    from pyspark.sql.classic.dataframe import DataFrame
    plain = DataFrame.checkpoint

    def counted(self, eager=True):
        out = plain(self, eager)
        if self.columns == ["src", "dst", "dist"]:
            rows.append(out.count())
        return out
    monkeypatch.setattr(DataFrame, "checkpoint", counted)
    assert g.distances(edges).count() == (k + 1) * (k + 2) // 2
    assert rows[1::2] == list(range(k, -1, -1))
