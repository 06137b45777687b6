"""Model operators: exact split, AUC, isolation forest properties, DBSCAN
against brute force, profile edge cases, category cut."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, txn_frame
from txnscope.functions.columns import cut_right_closed
from txnscope.operators import dbscan, features, iforest, profiles, supervised
from txnscope.sources.adapters import events_transactions


@pytest.mark.parametrize("band_rows", [1_000_000, 40])
def test_split_is_exact_per_class(spark, duck, band_rows):
    t = events_transactions(spark, SF_SMALL)
    s = supervised.stratified_split(t, band_rows=band_rows)  # 40: a narrow bracket
    counts = {(r[0], r[1]): r[2] for r in s.groupBy("fraud_flag", "split").count().collect()}
    n = {k: counts.get((k, "train"), 0) + counts.get((k, "test"), 0) for k in (0, 1)}
    for k in (0, 1):
        assert counts.get((k, "test"), 0) == -(-3 * n[k] // 10)
    assert s.count() == t.count()
    import __spark_entry__ as E
    want = {r[0]: r[2] for r in duck(SF_SMALL).sql(E.oracle_sql()["split_stratified"]).fetchall()}
    got = {r["transaction_id"]: r["split"] for r in s.select("transaction_id", "split").collect()}
    assert got == want


def test_auc_matches_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    score = np.round(rng.normal(size=400) + y * 0.8, 1)  # ties on purpose
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(score, y)], "s DOUBLE, y INT")
    ours = supervised.roc_auc(df, "s", "y").first()["auc"]
    pos, neg = score[y == 1], score[y == 0]
    exact = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) \
        / (len(pos) * len(neg))
    assert abs(ours - exact) < 1e-12
    # MLlib's evaluator bins the scores, so it only agrees approximately
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", metricName="areaUnderROC")
    ref = ev.evaluate(df.withColumn("y", F.col("y").cast("double")))
    assert abs(ours - ref) < 1e-3


def test_isolation_forest_ranks_outlier_first(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(500, 3)).tolist() + [[9.0, 9.0, 9.0]]
    df = spark.createDataFrame([(f"id{i}", *map(float, p)) for i, p in enumerate(pts)],
                               "transaction_id STRING, a DOUBLE, b DOUBLE, c DOUBLE")
    m = iforest.fit_isolation_forest(df, ["a", "b", "c"], n_trees=50, contamination=0.01)
    s = m.score_samples(df).orderBy("iso_score_samples").collect()
    assert s[0]["transaction_id"] == "id500"
    assert all(-1 < r["iso_score_samples"] < 0 for r in s)
    dec = m.decision_function(df).where(F.col("iso_decision") < 0).count()
    assert 1 <= dec <= 10


def _brute_dbscan(x, eps, min_samples):
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_samples
    label = -np.ones(len(x), dtype=int)
    comp = 0
    for i in range(len(x)):
        if not core[i] or label[i] >= 0:
            continue
        stack = [i]
        label[i] = comp
        while stack:
            u = stack.pop()
            for v in np.flatnonzero(nb[u] & core):
                if label[v] < 0:
                    label[v] = comp
                    stack.append(v)
        comp += 1
    border = {}
    for i in np.flatnonzero(~core):
        cl = label[np.flatnonzero(nb[i] & core)]
        border[i] = set(cl.tolist())
    return core, label, border


@pytest.mark.parametrize("max_tile, slice_", [(None, None), (20, 7), (1, 40)])
def test_dbscan_matches_brute_force(spark, monkeypatch, max_tile, slice_):
    if slice_:
        monkeypatch.setattr(dbscan, "SLICE", slice_)
        monkeypatch.setattr(dbscan, "CHUNK", 50)
    rng = np.random.default_rng(11)
    blobs = [rng.normal(loc=c, scale=0.25, size=(60, 4)) for c in ((0, 0, 0, 0), (2, 2, 0, 1))]
    x = np.vstack(blobs + [rng.uniform(-3, 5, size=(40, 4))])
    x[:, 3] = np.round(x[:, 3])  # a coarse feature that becomes a blocking key
    # duplicates: 4 copies of one isolated point make it core only through weights
    x = np.vstack([x, np.repeat([[4.5, -2.5, 4.5, 3.0]], 5, axis=0), x[:3]])
    ids = [f"p{i:04d}" for i in range(len(x))]
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in zip(ids, x)],
                               "transaction_id STRING, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    m = dbscan.fit_dbscan(df, ["a", "b", "c", "d"], eps=0.5, min_samples=5, max_tile=max_tile)
    assert bool(m.spec.grid) == bool(max_tile)
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    got = {r["_id"]: r for r in m.labels.collect()}
    core, label, border = _brute_dbscan(x, 0.5, 5)
    mapping = {}
    for i, k in enumerate(ids):
        assert got[k]["is_core"] == bool(core[i])
        assert got[k]["n_neighbours"] == int((d2[i] <= 0.25).sum())
        if core[i]:
            mapping.setdefault(label[i], got[k]["cluster"])
            assert mapping[label[i]] == got[k]["cluster"]  # same partition up to relabelling
    for i, cands in border.items():
        c = got[ids[i]]["cluster"]
        if cands:
            assert c in {mapping[x] for x in cands}
        else:
            assert c == -1
    assert len(set(mapping.values())) == len(mapping)


def test_profiles_zero_active_days(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [dict(timestamp=t0, amount_inr=100, transaction_type="P2M"),
            dict(timestamp=t0 + dt.timedelta(hours=3), amount_inr=300, transaction_type="P2P")]
    p = profiles.user_profiles(txn_frame(spark, rows)).first()
    assert p["active_days"] == 0 and p["daily_avg_txns"] == float("inf")
    assert p["preferred_type"] == "P2M"  # tie -> smallest
    assert abs(p["risk_score"] - (0 + 1.5 * 0.3 + 0.3)) < 1e-12


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (0.2000001,), (1.0,), (1.5,)], "x DOUBLE")
    got = [r[0] for r in df.select(cut_right_closed(F.col("x"), (0, .2, .5, .8, 1),
                                                    ("Low", "Medium", "High", "Critical"))).collect()]
    assert got == [None, "Low", "Medium", "Critical", None]


def test_unseen_category_raises(spark):
    t = txn_frame(spark, [dict(merchant_category="Food")] * 3)
    _, enc = features.prepare_features(t)
    new = txn_frame(spark, [dict(merchant_category="Travel")])
    out, _ = features.prepare_features(new, enc)
    with pytest.raises(Exception):
        out.collect()


def test_ensemble_train_stats_equal_batch_stats_on_training_data(spark):
    """Scoring the training batch with fitted statistics equals scoring it with
    its own batch statistics (they are the same numbers)."""
    from txnscope.operators import ensemble
    t = events_transactions(spark, SF_SMALL)
    m = ensemble.fit(t, n_trees=20, rf_trees=10, dbscan_eps=1.0,
                     graph_floors=dict(min_betweenness=-1.0, min_closeness=0.0, fraud_threshold=0.0))
    a = {r["transaction_id"]: r for r in m.score(t, "batch").collect()}
    b = {r["transaction_id"]: r for r in m.score(t, "train").collect()}
    assert a.keys() == b.keys() and len(a) == t.count()
    for k in a:
        assert abs(a[k]["fraud_score"] - b[k]["fraud_score"]) < 1e-9
        assert a[k]["risk_category"] == b[k]["risk_category"]
        assert 0 <= a[k]["fraud_score"] <= 1.0


def test_dbscan_assign_takes_the_nearest_core_point(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(loc=c, scale=0.3, size=(40, 3)) for c in ((0, 0, 0), (3, 3, 3))])
    df = spark.createDataFrame([(f"p{i:03d}", *map(float, r)) for i, r in enumerate(x)],
                               "transaction_id STRING, a DOUBLE, b DOUBLE, c DOUBLE")
    m = dbscan.fit_dbscan(df, ["a", "b", "c"], eps=0.5, min_samples=5, max_tile=15)
    core = m.core_points.toPandas()
    y = np.vstack([rng.uniform(-1, 4, size=(60, 3)), x[:5]])
    new = spark.createDataFrame([(f"q{i:03d}", *map(float, r)) for i, r in enumerate(y)]
                                + [("q999", None, 1.0, 1.0)], df.schema)
    got = {r["transaction_id"]: r["cluster"] for r in m.assign(new).collect()}
    assert got.pop("q999") == -1 and len(got) == len(y)
    for i, row in enumerate(y):
        d2 = ((core[["a", "b", "c"]].to_numpy() - row) ** 2).sum(1)
        want = core["cluster"].iloc[int(d2.argmin())] if d2.min() <= 0.25 else -1
        assert got[f"q{i:03d}"] == want


def test_dbscan_without_core_points_or_rows(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 5.0), ("c", None)], "transaction_id STRING, x DOUBLE")
    m = dbscan.fit_dbscan(df, ["x"], eps=0.5, min_samples=2)
    assert {(r["_id"], r["cluster"], r["n_neighbours"]) for r in m.labels.collect()} == {
        ("a", -1, 1), ("b", -1, 1), ("c", -1, 0)}
    assert m.assign(df).where("cluster <> -1").count() == 0
    assert dbscan.fit_dbscan(df.limit(0), ["x"]).labels.count() == 0


def test_dbscan_deals_each_pair_of_slices_once(spark, monkeypatch):
    """A row goes to as many tasks as its tile has slices, under the tile's number."""
    monkeypatch.setattr(dbscan, "SLICE", 10)
    df = spark.createDataFrame([(f"p{i:03d}", float(i % 7), float(i % 11)) for i in range(77)],
                               "_id STRING, a DOUBLE, b DOUBLE")
    dealt = dbscan._dealt(df, None, dbscan.TileSpec(["a", "b"], [], [], 0.5))
    assert dealt.count() == 77 * 8
    assert not {"_tile", "_own"} & set(dealt.columns)


def test_dbscan_cell_pairs_come_in_bounded_parts(monkeypatch):
    """Pairs of points are compared in bulk, ``CHUNK`` at once, and none is lost."""
    monkeypatch.setattr(dbscan, "CHUNK", 100)
    monkeypatch.setattr(dbscan, "PAIRS", 30)
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 3)), rng.normal(size=(200, 3)).round(1)
    left = dbscan.Cells(x, 1.0, np.ones(300, np.int64))
    right = dbscan.Cells(y, 1.0, np.arange(200))
    hit = ((x[:, None] - y[None]) ** 2).sum(-1) <= 1.0
    assert (dbscan.neighbour_weights(left, right, 1.0) == hit @ np.arange(200)).all()
    i, j, _ = (np.concatenate(p) for p in zip(*dbscan.near_cells(left, right, 1.0)))
    parts = list(dbscan.point_pairs(left, right, i, j))
    assert max(len(p[0]) for p in parts) <= 100
    assert sum(len(p[0]) for p in parts) == (left.size[i] * right.size[j]).sum()
    pairs = {(int(a), int(b)) for u, v in dbscan.touching_cells(left, right, 1.0) for a, b in zip(u, v)}
    cell = {k: np.repeat(np.arange(len(c)), c.size)[np.argsort(c.row)] for k, c in (("l", left), ("r", right))}
    assert pairs == {(int(cell["l"][a]), int(cell["r"][b])) for a, b in zip(*np.nonzero(hit))}


@pytest.mark.parametrize("dims, step", [(0, 0), (2, 0), (5, 0), (3, 0.5)])
def test_dbscan_points_are_compared_leaf_by_leaf(monkeypatch, dims, step):
    """Weights, joined cells and touching points are those of all pairs, also at a distance
    of exactly eps, and only pairs near eps are tested again."""
    monkeypatch.setattr(dbscan, "LEAF", 16)
    monkeypatch.setattr(dbscan, "WIDE", 64)
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(400, dims)), rng.normal(size=(300, dims))
    if step:
        x, y = np.round(x / step) * step, np.round(y / step) * step
    weight = rng.integers(1, 1 << 24, 300)             # sums beyond single precision
    hit = ((x[:, None] - y[None]) ** 2).sum(-1) <= 1.0
    left, right = dbscan.LonePoints(x), dbscan.LonePoints(y, weight)
    assert (dbscan.neighbour_weights(left, right, 1.0) == hit @ weight).all()
    pairs = {(int(a), int(b)) for u, v in dbscan.touching_cells(left, right, 1.0) for a, b in zip(u, v)}
    assert pairs == {(int(a), int(b)) for a, b in zip(*np.nonzero(hit))}
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= 0.0625
    cell = rng.permutation(400)
    i, j = np.nonzero(near)
    got = dbscan.joined_cells(x, cell, x, cell, 400, 0.25)
    assert (got == dbscan.joined_roots(np.arange(400), cell[i], cell[j])).all()


def test_dbscan_leaves_keep_equal_values_together():
    x = np.column_stack([np.repeat(np.arange(5.0), 40), np.tile(np.arange(4.0) / 9, 50)])
    leaves = dbscan.Leaves(x, 16)
    assert sorted(leaves.row) == list(range(200)) and leaves.size.sum() == 200
    assert (leaves.hi == leaves.lo).all()              # 20 distinct points, 10 copies of each


def test_isolation_trees_are_scored_as_full_trees(spark):
    """All trees take the same steps for every row; the path lengths are those of a plain
    descent, also for missing values (which go right)."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    df = spark.createDataFrame([(f"i{k:03d}", *map(float, r)) for k, r in enumerate(x)],
                               "transaction_id STRING, a DOUBLE, b DOUBLE, c DOUBLE")
    m = iforest.fit_isolation_forest(df, ["a", "b", "c"], n_trees=7, max_samples=64)
    for feature, threshold, length, depth in m._arrays():
        assert len(feature) == len(threshold) == 2 ** depth - 1 and len(length) == 2 ** depth
    odd = df.limit(20).unionByName(spark.createDataFrame([("n", None, 0.0, 9.0)], df.schema))
    got = {r[0]: r[1] for r in m.score_samples(odd).select("transaction_id", "iso_score_samples").collect()}
    trees = [g.set_index("node") for _, g in m.nodes.groupby("tree")]
    for r in odd.toPandas().itertuples():
        v, total = (r.a, r.b, r.c), 0.0
        for t in trees:
            n = t.loc[0]
            while n.feature >= 0:
                n = t.loc[n.left if v[int(n.feature)] <= n.threshold else n.right]
            total += n.depth + float(iforest.average_path_length([n.n_samples])[0])
        want = -2.0 ** (-(total / 7) / float(iforest.average_path_length([64])[0]))
        assert abs(got[r.transaction_id] - want) < 1e-12


def test_rows_of_one_task_are_dealt_over_the_cores(spark, monkeypatch):
    """A table in one task is dealt out once it is worth it, with all its rows; a small or
    even one stays as it is."""
    from txnscope.operators import common
    monkeypatch.setattr(common, "LEAST_ROWS", 50)
    monkeypatch.setattr(common, "MOST_ROWS", 10_000)
    cores = spark.sparkContext.defaultParallelism

    def tasks(df):
        out = common.spread(df)
        assert sorted(r[0] for r in out.collect()) == sorted(r[0] for r in df.collect())
        return out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks(spark.range(0, 50 * cores, 1, 1)) == cores
    assert tasks(spark.range(0, 50, 1, 1)) == 1
    assert tasks(spark.range(0, 900, 1, 3)) == min(cores, 3) or cores > 3
    assert tasks(spark.range(0)) == 0
