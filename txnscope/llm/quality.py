"""Quality classifier by positive-unlabelled learning.

Trusted positives (labels that say quality 1) and unlabelled web text train a logistic
model that minimises the non-negative unbiased risk: with class prior p,
``p E+[l(+)] + max(0, Eu[l(-)] - p E+[l(-)])``. The prior is estimated from the same
two samples: a first model ranks them, and the smallest ratio of unlabelled to
positive mass over its upper tails bounds the share of positives in the web text.

Documents become a dozen ratios of their whole text (symbols, shouting, repetition,
stray separators, ...). Both training samples are bounded (``MOST_POSITIVES``,
``MOST_UNLABELLED`` documents, by hash order, whatever the size of the corpus); scoring
covers every document in one pass without a shuffle.

Defined cases: null and empty texts have all-zero ratios and get a score like any
other; labels of unknown documents and null labels are ignored; repeated rows are
scored each; without any positive label every score is the prior 0.5; other columns
of the tables are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample_ids, fold_of, read_table, release_task_state

MOST_POSITIVES = 4000
MOST_UNLABELLED = 8000
HELD_OUT_FOLD = 0
THRESHOLD = 0.3
SYMBOLS = "#$%&*|!=<>{}[]\\^~_@+/"
FEATURES = ["symbols", "bars", "marks", "shouting", "digits", "repeats", "variety", "lines",
            "top_word", "long_words", "short_words", "log_words"]


def ratios(text: str | None) -> list[float]:
    """Ratios of a whole text, each in [0, 1] (but for the logarithm of its length)."""
    text = text or ""
    words = text.split()
    n, c = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    marks = sum(map(text.count, ("%%%", "&&&", "$$$", "***", "###", "!!", "...", "???")))
    lines = [x for x in text.split("\n") if x]
    kinds = set(words)
    expected = min(1.0, 3.0 * n ** -0.25)
    counts: dict[str, int] = {}
    for w in words if len(kinds) < 0.5 * n else ():
        counts[w] = counts.get(w, 0) + 1
    return [
        min(1.0, 8.0 * sum(map(text.count, SYMBOLS)) / c),
        min(1.0, 4.0 * words.count("|") / n),
        min(1.0, 4.0 * marks / n),
        sum(map(str.isupper, words)) / n,
        min(1.0, sum(map(text.count, "0123456789")) / c * 4.0),
        min(1.0, 3.0 * sum(map(eq, words, words[1:])) / n),
        min(1.0, len(kinds) / n / expected),
        1.0 - len(set(lines)) / max(1, len(lines)),
        max(counts.values(), default=0) / n,
        min(1.0, 4.0 * sum(len(w) > 24 for w in words) / n),
        sum(len(w) < 3 for w in words) / n,
        np.log1p(n) / 10.0,
    ]


def expanded(x: np.ndarray) -> np.ndarray:
    """Ratios, their saturated forms (a little junk already counts) and a constant."""
    return np.hstack([x, np.tanh(12.0 * x[:, :6]), np.tanh(4.0 * x[:, 6:9]),
                      np.ones((len(x), 1))])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800,
             rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights of a logistic model under the non-negative risk (Adam, full batches)."""
    w = np.zeros(positive.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        sp, su = sigmoid(positive @ w), sigmoid(unlabelled @ w)
        inner = np.mean(-np.log1p(-su + 1e-12)) - prior * np.mean(-np.log1p(-sp + 1e-12))
        g_inner = (su @ unlabelled) / len(su) - prior * (sp @ positive) / len(sp)
        g_plus = prior * ((sp - 1.0) @ positive) / len(sp)
        # when the estimate of the negatives' risk drops below 0, climb back
        g = (g_plus + g_inner if inner >= 0 else -g_inner) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled sample, from scores of both: the least
    ratio of tail masses, over tails that hold at least a tenth of the positives."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.9, 91))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    slack = 1.0 / np.sqrt(max(1, len(unlabelled)))
    return float(np.clip(np.min((u + slack) / p), 0.02, 0.98))


class Model:
    """Standardised logistic model; ``score(ratios)`` gives P(quality = 1)."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray):
        self.prior, self.w = 0.5, None
        if not len(positive) or not len(unlabelled):
            return
        p, u = expanded(positive), expanded(unlabelled)
        self.mean = np.append(u[:, :-1].mean(0), 0.0)
        self.scale = np.append(u[:, :-1].std(0) + 1e-3, 1.0)
        p, u = (p - self.mean) / self.scale, (u - self.mean) / self.scale
        first = fit_nnpu(p, u, 0.5, steps=300)
        self.prior = estimated_prior(p @ first, u @ first)
        self.w = fit_nnpu(p, u, self.prior)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), self.prior)
        return sigmoid(((expanded(x) - self.mean) / self.scale) @ self.w)


def features_of(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"),
                                "x": [ratios(t) for t in b["text"]]})
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInPandas(run, "doc_id long, x array<double>"))


def train(docs: DataFrame, labels: DataFrame, most_positives: int = MOST_POSITIVES,
          most_unlabelled: int = MOST_UNLABELLED) -> Model:
    """Fit on bounded samples: positives among the training folds' labels, unlabelled
    text among all documents (their labels are not looked at)."""
    trusted = labels.where((F.col("quality") == 1) & (fold_of("doc_id") != HELD_OUT_FOLD))
    ids = {"p": bounded_sample_ids(trusted.select("doc_id"), most_positives, 9),
           "u": bounded_sample_ids(docs.select("doc_id"), most_unlabelled, 10)}
    wanted = sorted({*ids["p"], *ids["u"]})
    rows = {} if not wanted else {
        r.doc_id: r.x for r in features_of(docs.where(F.col("doc_id").isin(wanted))).collect()}
    x = {k: np.array([rows[i] for i in v if i in rows]).reshape(-1, len(FEATURES))
         for k, v in ids.items()}
    return Model(x["p"], x["u"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array([ratios(t) for t in b["text"]]).reshape(-1, len(FEATURES))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": model.score(x)})
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInPandas(run, "doc_id long, score double"))


def keep_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, columns unchanged."""
    columns = docs.columns
    at = columns.index("text")
    renamed = docs.toDF(*[f"c{i}" for i in range(len(columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_task_state()
        for b in batches:
            x = np.array([ratios(t) for t in b.column(at).to_pylist()]).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))
    return renamed.mapInArrow(run, renamed.schema).toDF(*columns)


def op9_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return scored(docs, train(docs, labels)).select(
        "doc_id", (fold_of("doc_id") == HELD_OUT_FOLD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
