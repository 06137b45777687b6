"""Feature engineering for the fraud models.

``prepare_features`` adds the 14 model inputs. Batch statistics (mean and
sample std of the amount, its 95th percentile) come from one aggregate of the
batch being prepared (decision D8, ``stats="batch"``), or from fitted values
(``stats=FeatureStats``) when scoring a stream. Categorical columns are
label-encoded with a fitted ``StringIndexerModel`` in alphabetical order (the
code of a label is its rank among the sorted training labels); an unseen label
raises, as the original encoder does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .common import with_scalars
from .quantiles import exact_quantiles

TS = "timestamp"


@dataclass
class FeatureStats:
    """Fitted amount statistics (for ``stats='train'`` scoring)."""
    mean: float
    std: float
    p95: float


def fit_encoders(df: DataFrame, columns=fixed.CATEGORICAL_COLUMNS) -> StringIndexerModel:
    """Alphabetical label encoders for the categorical columns (one pass)."""
    cols = list(columns)
    return StringIndexer(inputCols=cols, outputCols=[f"{c}_encoded" for c in cols],
                         stringOrderType="alphabetAsc", handleInvalid="error").fit(df)


def amount_stats(df: DataFrame) -> DataFrame:
    """One-row batch statistics of the amount."""
    a = F.col("amount_inr").cast("double")
    p95 = _quantile(exact_quantiles(df, {"a": a}, [0.95]), "a")
    return df.agg(F.avg(a).alias("_amt_mean"), F.stddev_samp(a).alias("_amt_std")).withColumn(
        "_amt_p95", F.lit(p95).cast("double"))


def _quantile(found: dict, name: str) -> float | None:
    return found[None, name].at[0] if (None, name) in found else None


def cross_state(df: DataFrame) -> F.Column:
    """sender_state != receiver_state with pandas semantics: a missing value
    compares unequal (so NULL gives 1); a missing column gives 0."""
    if "receiver_state" not in df.columns:
        return F.lit(0)
    s, r = F.col("sender_state"), F.col("receiver_state")
    return F.when(s.isNull() | r.isNull(), 1).otherwise((s != r).cast("int"))


def time_features(df: DataFrame) -> DataFrame:
    hour = F.hour(TS)
    return df.withColumns({
        "hour": hour,
        "day_of_week": F.weekday(TS),
        "is_weekend": F.weekday(TS).isin(5, 6).cast("int"),
        "is_night": ((hour >= 22) | (hour <= 6)).cast("int"),
    })


def prepare_features(df: DataFrame, encoders: StringIndexerModel | None = None,
                     stats: FeatureStats | str = "batch") -> tuple[DataFrame, StringIndexerModel]:
    """Add the model features; returns (frame, encoders) -- encoders are fitted
    on ``df`` when not given."""
    out = time_features(df)
    a = F.col("amount_inr").cast("double")
    out = out.withColumn("amount_log", F.log1p(a))
    if isinstance(stats, FeatureStats):
        out = out.withColumns({"_amt_mean": F.lit(stats.mean), "_amt_std": F.lit(stats.std),
                               "_amt_p95": F.lit(stats.p95)})
    else:
        out = with_scalars(out, amount_stats(df))
    out = out.withColumns({
        "amount_zscore": (a - F.col("_amt_mean")) / F.col("_amt_std"),
        "cross_state": cross_state(df),
        "high_value": (a > F.col("_amt_p95")).cast("int"),
    }).drop("_amt_mean", "_amt_std", "_amt_p95")
    if encoders is None:
        encoders = fit_encoders(df)
    out = encoders.transform(out)
    for c in fixed.CATEGORICAL_COLUMNS:
        out = out.withColumn(f"{c}_encoded", F.col(f"{c}_encoded").cast("int"))
    return out, encoders


def median_values(df: DataFrame, columns) -> DataFrame:
    """One-row frame of medians (linear interpolation), all columns in one pass."""
    found = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.5])
    return df.sparkSession.createDataFrame(
        [tuple(_quantile(found, c) for c in columns)],
        ", ".join(f"_med_{c} DOUBLE" for c in columns))


def impute_median(df: DataFrame, columns, medians: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the batch median of each column (``fillna(X.median())``)."""
    cols = list(columns)
    med = medians if medians is not None else median_values(df, cols)
    out = with_scalars(df, med)
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}"))
                            for c in cols}).drop(*[f"_med_{c}" for c in cols])


def fit_scaler(df: DataFrame, columns) -> DataFrame:
    """Mean and population std per column (one-row frame). A zero std is stored
    as 1, so constant features are only centred (as the standard scaler does).
    MLlib's StandardScaler uses the sample std, hence this own aggregate."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"_mu_{c}"),
                 F.when(F.stddev_pop(x) == 0, 1.0).otherwise(F.stddev_pop(x)).alias(f"_sd_{c}")]
    return df.agg(*aggs)


def standard_scale(df: DataFrame, columns, scaler: DataFrame) -> DataFrame:
    cols = list(columns)
    out = with_scalars(df, scaler)
    return out.withColumns({c: (F.col(c).cast("double") - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}")
                            for c in cols}).drop(*[f"_mu_{c}" for c in cols],
                                                 *[f"_sd_{c}" for c in cols])


def assemble(df: DataFrame, columns=fixed.FEATURE_COLUMNS, out: str = "features") -> DataFrame:
    """Fixed-order feature vector (VectorAssembler)."""
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)
