"""The fraud ensemble: isolation forest + random forest + DBSCAN + bank graph.

``fit(t)`` trains every component on one transaction table and returns a
``FraudModel``; ``model.score(t)`` returns
(transaction_id, fraud_score, risk_category) plus the component scores.
A model exists only after ``fit`` or ``load``, so scoring before training is impossible.

A model is made of parts, each with its own ``fit``, ``save`` and ``load``: features
(encoders and statistics), isolation forest, random forest, clusters, bank graph.
``FraudModel.save`` writes all of them to a folder and ``FraudModel.load`` reads them in
any later session; ``stored_part`` fits and writes one part where the folder lacks it.

Blend (first match of the cut is right-closed, so a score of exactly 0 or
above 1 has no category):
  ensemble = .3 * (1 - minmax(iso_decision)) + .5 * P_rf(fraud) + .2 * dbscan
  fraud_score = .8 * ensemble + .2 * graph_risk
DBSCAN in scoring (decision D7): a row takes the cluster of its nearest
training core point within eps; 1.0 if that cluster is an anomaly cluster
(fraud rate > 5 %), else 0.1.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.columns import cut_right_closed
from ..session import checkpoint_dir
from . import dbscan as db
from . import features as feat
from . import graph as g
from . import iforest, supervised
from .common import bounded_side, spread, with_scalars
from .model_store import ModelStore

KEY = "transaction_id"
FEATURES = list(fixed.FEATURE_COLUMNS)
CARRY = [KEY, "fraud_flag", "sender_bank", "receiver_bank", "amount_inr"]


# --- parts ----------------------------------------------------------------------------------

@dataclass
class Features:
    """Encoders and training-time statistics of the model inputs."""
    encoders: StringIndexerModel
    stats: feat.FeatureStats
    medians: DataFrame
    scaler: DataFrame

    @classmethod
    def fit(cls, t: DataFrame) -> Features:
        amount = feat.amount_stats(t).first()
        stats = feat.FeatureStats(amount["_amt_mean"], amount["_amt_std"], amount["_amt_p95"])
        f, encoders = feat.prepare_features(t, stats=stats)
        base = f.select(*FEATURES).checkpoint(eager=True)     # read by several passes
        medians = feat.median_values(base, FEATURES).checkpoint(eager=True)
        scaler = feat.fit_scaler(feat.impute_median(base, FEATURES, medians), FEATURES)
        return cls(encoders, stats, medians, scaler.checkpoint(eager=True))

    def scaled(self, t: DataFrame, stats: str = "batch") -> DataFrame:
        """Scaled model features. ``stats="batch"`` recomputes the amount
        statistics and medians on ``t`` (as the original scoring does);
        ``stats="train"`` uses the fitted ones (stable for small batches and
        usable on a stream)."""
        train = stats == "train"
        f, _ = feat.prepare_features(t, self.encoders, self.stats if train else "batch")
        x = feat.impute_median(f.select(*CARRY, *FEATURES), FEATURES, self.medians if train else None)
        return feat.standard_scale(x, FEATURES, self.scaler)

    def save(self, store: ModelStore) -> None:
        store.write_ml("features", "encoders", self.encoders)
        store.write_values("features", "stats", vars(self.stats))
        store.write_table("features", "medians", self.medians)
        store.write_table("features", "scaler", self.scaler)

    @classmethod
    def load(cls, store: ModelStore) -> Features:
        return cls(store.ml("features", "encoders", StringIndexerModel),
                   feat.FeatureStats(**store.values("features", "stats")),
                   store.table("features", "medians"), store.table("features", "scaler"))


@dataclass
class Isolation:
    model: iforest.IsolationForestModel

    @classmethod
    def fit(cls, xs: DataFrame, n_trees: int) -> Isolation:
        return cls(iforest.fit_isolation_forest(xs, FEATURES, KEY, n_trees=n_trees))

    def decision_range(self, spark) -> DataFrame:
        m = self.model
        return spark.createDataFrame([(m.train_min - m.offset, m.train_max - m.offset)],
                                     "_imin DOUBLE, _imax DOUBLE")

    def save(self, store: ModelStore) -> None:
        m = self.model
        store.write_table("isolation", "nodes", store.spark.createDataFrame(m.nodes, iforest.NODE_SCHEMA))
        store.write_values("isolation", "settings", {
            "feature_cols": list(m.feature_cols), "psi": m.psi, "offset": m.offset,
            "train_min": m.train_min, "train_max": m.train_max})

    @classmethod
    def load(cls, store: ModelStore) -> Isolation:
        nodes: pd.DataFrame = store.table("isolation", "nodes").toPandas()   # bounded by the trees
        return cls(iforest.IsolationForestModel(nodes, **store.values("isolation", "settings")))


@dataclass
class Forest:
    model: RandomForestClassificationModel
    report: DataFrame
    auc: DataFrame

    @classmethod
    def fit(cls, xs: DataFrame, n_trees: int) -> Forest:
        data = feat.assemble(supervised.stratified_split(xs).checkpoint(eager=True))
        rf = supervised.fit_random_forest(data.where(F.col("split") == "train"), n_trees=n_trees)
        test = supervised.rf_scores(rf, data.where(F.col("split") == "test")).checkpoint(eager=True)
        return cls(rf, supervised.classification_report(test, "fraud_flag", "rf_prediction"),
                   supervised.roc_auc(test, "rf_probability", "fraud_flag"))

    def save(self, store: ModelStore) -> None:
        store.write_ml("forest", "model", self.model)
        store.write_table("forest", "report", self.report)
        store.write_table("forest", "auc", self.auc)

    @classmethod
    def load(cls, store: ModelStore) -> Forest:
        return cls(store.ml("forest", "model", RandomForestClassificationModel),
                   store.table("forest", "report"), store.table("forest", "auc"))


@dataclass
class Clusters:
    model: db.DbscanModel
    rates: DataFrame

    @classmethod
    def fit(cls, xs: DataFrame, eps: float) -> Clusters:
        model = db.fit_dbscan(xs, FEATURES, KEY, eps=eps)
        return cls(model, db.cluster_fraud_rates(model.labels, xs, KEY).checkpoint(eager=True))

    @property
    def anomalies(self) -> DataFrame:
        return db.anomaly_clusters(self.rates)

    def save(self, store: ModelStore) -> None:
        store.write_values("clusters", "spec", vars(self.model.spec))
        store.write_table("clusters", "labels", self.model.labels)
        store.write_table("clusters", "core_points", self.model.core_points)
        store.write_table("clusters", "rates", self.rates)

    @classmethod
    def load(cls, store: ModelStore) -> Clusters:
        return cls(db.DbscanModel(db.TileSpec(**store.values("clusters", "spec")),
                                  store.table("clusters", "labels"),
                                  store.table("clusters", "core_points")),
                   store.table("clusters", "rates"))


@dataclass
class BankGraph:
    edges: DataFrame
    centrality: DataFrame
    suspicious: DataFrame

    @classmethod
    def fit(cls, t: DataFrame, floors: dict | None = None, distance: str = "weight",
            **options) -> BankGraph:
        edges = g.bank_edges(t).checkpoint(eager=True)
        table = g.centrality_table(edges, distance, **options).checkpoint(eager=True)
        return cls(edges, table, g.select_suspicious(table, **(floors or {})))

    def save(self, store: ModelStore, part: str = "graph") -> None:
        for name in ("edges", "centrality", "suspicious"):
            store.write_table(part, name, getattr(self, name))

    @classmethod
    def load(cls, store: ModelStore, part: str = "graph") -> BankGraph:
        return cls(*[store.table(part, name) for name in ("edges", "centrality", "suspicious")])


PARTS = {"features": Features, "isolation": Isolation, "forest": Forest, "clusters": Clusters,
         "graph": BankGraph}


def fit_part(name: str, t: DataFrame, xs, n_trees: int = fixed.N_TREES, rf_trees: int = fixed.N_TREES,
             dbscan_eps: float = fixed.DBSCAN_EPS, graph_floors: dict | None = None):
    """One part, from the payments or their scaled features (``xs()``)."""
    if name == "features":
        return Features.fit(t)
    if name == "graph":
        return BankGraph.fit(t, graph_floors)
    argument = {"isolation": n_trees, "forest": rf_trees, "clusters": dbscan_eps}[name]
    return PARTS[name].fit(xs(), argument)


def stored_part(store: ModelStore, name: str, payments, **settings):
    """A part of the model in ``store``; fitted on ``payments()`` and written there first
    where the store lacks it."""
    if not store.has(name):
        checkpoint_dir(store.spark)

        def scaled():
            prep = stored_part(store, "features", payments, **settings)
            return spread(prep.scaled(payments(), "train"))
        t = payments()
        if name == "features":
            t = spread(t)                       # statistics and encoders both read it
        fit_part(name, t, scaled, **settings).save(store)
        store.finish(name)
    store.check(name)
    return PARTS[name].load(store)


# --- the model ------------------------------------------------------------------------------

def blend(x: DataFrame, decision_range: DataFrame) -> DataFrame:
    """``fraud_score`` and ``risk_category`` from the component scores: iso_decision (low:
    anomalous; scaled by ``decision_range``), rf_probability, dbscan_score,
    graph_risk_score."""
    x = with_scalars(x, decision_range).withColumn(
        "iso_score", 1 - F.try_divide(F.col("iso_decision") - F.col("_imin"),
                                      F.col("_imax") - F.col("_imin"))).drop("_imin", "_imax")
    w = fixed.ENSEMBLE_WEIGHTS
    ens = (F.col("iso_score") * w["iso"] + F.col("rf_probability") * w["rf"]
           + F.col("dbscan_score") * w["dbscan"])
    final = ens * (1 - fixed.GRAPH_BLEND) + F.col("graph_risk_score") * fixed.GRAPH_BLEND
    return x.withColumns({"fraud_score": final, "risk_category": cut_right_closed(
        final, fixed.RISK_BINS, fixed.RISK_LABELS)})


def batch_range(x: DataFrame) -> DataFrame:
    return x.agg(F.min("iso_decision").alias("_imin"), F.max("iso_decision").alias("_imax"))


def with_dbscan_score(x: DataFrame, clusters: Clusters) -> DataFrame:
    """``cluster`` of the nearest core point and ``dbscan_score``: 1.0 in an anomaly
    cluster, else 0.1."""
    anomalous = clusters.anomalies.select("cluster", F.lit(1.0).alias("_anom"))
    return (clusters.model.assign(x, KEY).join(bounded_side(anomalous), "cluster", "left")
            .withColumn("dbscan_score", F.coalesce("_anom", F.lit(0.1))).drop("_anom"))


@dataclass
class FraudModel:
    prep: Features
    isolation: Isolation
    forest: Forest
    clusters: Clusters
    graph: BankGraph
    # wall seconds of each fit (the models run side by side)
    seconds: dict = field(default_factory=dict)

    @property
    def parts(self) -> dict:
        return {"features": self.prep, "isolation": self.isolation, "forest": self.forest,
                "clusters": self.clusters, "graph": self.graph}

    @property
    def edges(self) -> DataFrame:
        return self.graph.edges

    @property
    def suspicious(self) -> DataFrame:
        return self.graph.suspicious

    @property
    def anomaly_clusters(self) -> DataFrame:
        return self.clusters.anomalies

    def save(self, spark, path: str) -> None:
        store = ModelStore(spark, path)
        for name, part in self.parts.items():
            part.save(store)
            store.finish(name)

    @classmethod
    def load(cls, spark, path: str) -> FraudModel:
        store = ModelStore(spark, path)
        for name in PARTS:
            store.check(name)
        return cls(*[kind.load(store) for kind in PARTS.values()])

    def features(self, t: DataFrame, stats="batch") -> DataFrame:
        return self.prep.scaled(t, stats)

    def score(self, t: DataFrame, stats="batch") -> DataFrame:
        x = self.features(spread(t), stats)        # trees are scored in the tasks of the input
        x = self.isolation.model.decision_function(x, "iso_decision")
        if stats == "train":
            scale = self.isolation.decision_range(t.sparkSession)
        else:
            # checkpointed: the batch min/max and the blend both read the
            # forest scores, which would otherwise be computed twice in Python
            x = x.checkpoint(eager=True)
            scale = batch_range(x)
        x = supervised.rf_scores(self.forest.model, feat.assemble(x)).drop("features", "rf_prediction")
        x = with_dbscan_score(x, self.clusters)
        x = blend(g.graph_risk_scores(x, self.edges, self.suspicious), scale)
        return x.select(KEY, "amount_inr", "fraud_score", "risk_category", "iso_score",
                        "rf_probability", "dbscan_score", "graph_risk_score", "cluster")


def fit(t: DataFrame, n_trees: int = fixed.N_TREES, rf_trees: int = fixed.N_TREES,
        dbscan_eps: float = fixed.DBSCAN_EPS, graph_floors: dict | None = None) -> FraudModel:
    """Train every part on ``t`` (transaction ids must be unique). The parts that need
    only the features are submitted as concurrent Spark jobs (driver threads), so one
    model's small stages do not leave cores idle."""
    checkpoint_dir(t.sparkSession)
    settings = dict(n_trees=n_trees, rf_trees=rf_trees, dbscan_eps=dbscan_eps, graph_floors=graph_floors)
    seconds: dict[str, float] = {}

    def timed(name, fn, *args, **kwargs):
        began = time.perf_counter()
        out = fn(*args, **kwargs)
        seconds[name] = round(time.perf_counter() - began, 3)
        return out
    t = spread(t)                         # statistics, encoders and models all read it
    prep = timed("features", Features.fit, t)
    xs = prep.scaled(t, "train").checkpoint(eager=True)
    with ThreadPoolExecutor(max_workers=4) as pool:
        jobs = [pool.submit(timed, name, fit_part, name, t, lambda: xs, **settings)
                for name in ("isolation", "forest", "clusters", "graph")]
        return FraudModel(prep, *[j.result() for j in jobs], seconds)


def top_risky(scores: DataFrame, k: int = 10) -> DataFrame:
    """The k highest fraud scores (ties by transaction id)."""
    return (scores.select(KEY, "amount_inr", F.round("fraud_score", 4).alias("fraud_score"),
                          "risk_category")
            .orderBy(F.desc("fraud_score"), KEY).limit(k))
