"""Isolation forest as a Spark job.

Fit:
  1. One hash per row keeps a pre-sample S of expected size
     ``n_trees * 4 * max_samples`` (independent of the table size).
  2. S is exploded to (tree, row) pairs and filtered by a per-tree hash, so each
     tree receives about ``4 * max_samples`` candidates.
  3. ``groupBy("tree").applyInPandas`` keeps the ``max_samples`` rows with the
     smallest per-tree hash (a uniform sample without replacement) and grows
     one random isolation tree with NumPy. Groups are bounded by construction.
  4. The node table (at most n_trees * (2*max_samples - 1) rows) is the model.
Score: ``mapInPandas`` evaluates every tree on Arrow batches with NumPy
(vectorised descent), giving the mean path length h(x) and
score_samples = -2^(-E[h] / c(max_samples)); decision = score - offset, where
the offset is the ``contamination`` quantile of the training scores.

Random streams differ from other libraries, so results match in distribution
and in their properties, not bit for bit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..session import checkpoint_dir
from .quantiles import exact_quantiles

EULER_GAMMA = 0.5772156649015329


def average_path_length(n):
    """c(n): mean path length of an unsuccessful search in a BST of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("depth", T.IntegerType()), T.StructField("n_samples", T.IntegerType())])


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Grow one isolation tree; returns column lists of the node table."""
    feature, threshold, left, right, depth, size = [], [], [], [], [], []

    def new(d, n):
        feature.append(-1), threshold.append(0.0), left.append(-1), right.append(-1)
        depth.append(d), size.append(n)
        return len(feature) - 1

    stack = [(new(0, len(x)), np.arange(len(x)), 0)]
    while stack:
        nid, idx, d = stack.pop()
        if d >= max_depth or len(idx) <= 1:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            continue
        f = int(usable[rng.integers(usable.size)])
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        li, ri = idx[go_left], idx[~go_left]
        feature[nid], threshold[nid] = f, thr
        left[nid], right[nid] = new(d + 1, len(li)), new(d + 1, len(ri))
        stack.append((left[nid], li, d + 1))
        stack.append((right[nid], ri, d + 1))
    return feature, threshold, left, right, depth, size


def _tree_builder(feature_cols, max_samples, max_depth, seed):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["_u", "_key"]).head(max_samples)
        x = pdf[list(feature_cols)].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        f, t, l, r, d, s = _grow(x, rng, max_depth)
        return pd.DataFrame({"tree": tree, "node": np.arange(len(f), dtype=np.int32),
                             "feature": np.asarray(f, dtype=np.int32),
                             "threshold": np.asarray(t, dtype=float),
                             "left": np.asarray(l, dtype=np.int32),
                             "right": np.asarray(r, dtype=np.int32),
                             "depth": np.asarray(d, dtype=np.int32),
                             "n_samples": np.asarray(s, dtype=np.int32)})
    return build


def _unit_hash(*cols) -> F.Column:
    """Deterministic uniform value in [0, 1) from a 64-bit hash."""
    return F.xxhash64(*cols).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF)).cast("double") / float(2 ** 63)


@dataclass
class IsolationForestModel:
    nodes: pd.DataFrame          # node table (bounded: n_trees * (2*psi - 1) rows)
    feature_cols: list
    psi: int
    offset: float = 0.0
    train_min: float = 0.0       # range of the training score_samples
    train_max: float = 0.0

    def _arrays(self):
        """Per tree (feature, threshold, path length) as full binary trees of one depth, so
        that every row takes the same number of steps: the children of place p are 2p + 1
        and 2p + 2, and what is below a leaf has its path length."""
        trees = []
        for _, g in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            feature, threshold = g["feature"].to_numpy(), g["threshold"].to_numpy()
            left, right = g["left"].to_numpy(), g["right"].to_numpy()
            leaf_len = (g["depth"].to_numpy(float)
                        + average_path_length(g["n_samples"].to_numpy()))
            at, levels = np.zeros(1, np.int64), []
            for _ in range(int(g["depth"].max())):
                inner = feature[at] >= 0
                levels.append((np.where(inner, feature[at], 0), threshold[at]))
                at = np.where(inner, np.stack([left[at], right[at]]), at).T.ravel()
            trees.append((np.concatenate([f for f, _ in levels] or [at[:0]]),
                          np.concatenate([t for _, t in levels] or [leaf_len[:0]]),
                          leaf_len[at], len(levels)))
        return trees

    def score_samples(self, df: DataFrame, out: str = "iso_score_samples") -> DataFrame:
        """Adds ``out`` = -2^(-E[h(x)] / c(psi)) (lower = more anomalous)."""
        spark = df.sparkSession
        bc = spark.sparkContext.broadcast(self._arrays())
        cols = list(self.feature_cols)
        c_psi = float(average_path_length([self.psi])[0])
        schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType())])

        def score(batches):
            trees = bc.value
            for pdf in batches:
                x = np.ascontiguousarray(pdf[cols].to_numpy(dtype=float).T).ravel()
                total = np.zeros(len(pdf))
                rows = np.arange(len(pdf))
                for feat, thr, leaf_len, depth in trees:
                    start, node = feat * len(pdf), np.zeros(len(pdf), dtype=np.int64)
                    for _ in range(depth):
                        go_left = x[start[node] + rows] <= thr[node]
                        node = 2 * node + 2 - go_left
                    total += leaf_len[node - (2 ** depth - 1)]
                pdf[out] = -np.power(2.0, -(total / len(trees)) / c_psi)
                yield pdf
        return df.mapInPandas(score, schema)

    def decision_function(self, df: DataFrame, out: str = "iso_decision") -> DataFrame:
        s = self.score_samples(df, "_iso_s")
        return s.withColumn(out, F.col("_iso_s") - F.lit(self.offset)).drop("_iso_s")


def fit_isolation_forest(df: DataFrame, feature_cols, key: str = "transaction_id",
                         n_trees: int = fixed.N_TREES, max_samples: int = fixed.IFOREST_MAX_SAMPLES,
                         contamination: float = fixed.IFOREST_CONTAMINATION,
                         seed: int = fixed.SEED, oversample: float = 4.0) -> IsolationForestModel:
    cols = list(feature_cols)
    data = df.select(F.col(key).cast("string").alias("_key"),
                     *[F.col(c).cast("double").alias(c) for c in cols])
    n = data.count()
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    pre_rate = min(1.0, n_trees * oversample * psi / max(n, 1))
    pre = data.where(_unit_hash(F.lit(seed), F.lit(-1), "_key") < pre_rate)
    expected_pre = max(n * pre_rate, 1.0)
    per_tree_rate = min(1.0, oversample * psi / expected_pre)
    cand = (pre.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
            .withColumn("_u", _unit_hash(F.lit(seed), F.col("tree"), "_key"))
            .where(F.col("_u") < per_tree_rate))
    out_schema = NODE_SCHEMA
    nodes = (cand.groupBy("tree")
             .applyInPandas(_tree_builder(cols, psi, max_depth, seed), out_schema)
             .toPandas())
    model = IsolationForestModel(nodes, cols, psi)
    # one scoring pass over the training rows gives the offset (contamination
    # quantile) and the score range
    checkpoint_dir(df.sparkSession)
    scores = model.score_samples(data, "_s").select("_s").checkpoint(eager=True)
    found = exact_quantiles(scores, {"s": F.col("_s")}, [contamination])
    if found:
        scores = found[None, "s"]
        model.offset, model.train_min, model.train_max = scores.at[0], scores.low, scores.high
    else:
        model.offset = model.train_min = model.train_max = 0.0
    return model
