"""The stored model: parts, a second load, scoring on a stream."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnscope.operators import ensemble
from txnscope.operators.model_store import ModelStore
from txnscope.sources.adapters import events_transactions
from txnscope.streaming import monitors

SETTINGS = dict(n_trees=12, rf_trees=8, dbscan_eps=1.0,
                graph_floors=dict(min_betweenness=-1.0, min_closeness=0.0, fraud_threshold=0.0))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "m")
    t = events_transactions(spark, SF_SMALL)
    model = ensemble.fit(t, **SETTINGS)
    model.save(spark, path)
    return model, path, t


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_loaded_model_scores_alike(spark, stored):
    model, path, t = stored
    other = ensemble.FraudModel.load(spark.newSession(), path)
    for stats in ("batch", "train"):
        assert rows(other.score(t, stats)) == rows(model.score(t, stats))
    assert rows(other.forest.report) == rows(model.forest.report)
    assert rows(other.clusters.rates) == rows(model.clusters.rates)


def test_a_part_without_its_marker_is_fitted_again(spark, stored, tmp_path):
    model, _, t = stored
    store = ModelStore(spark, str(tmp_path / "parts"))
    with pytest.raises(FileNotFoundError):
        store.check("features")
    model.prep.save(store)                       # a job that stopped before the marker
    assert not store.has("features")
    calls = []

    def payments():
        calls.append(1)
        return t
    part = ensemble.stored_part(store, "features", payments, **SETTINGS)
    assert store.has("features") and calls
    assert rows(part.scaled(t, "train")) == rows(model.prep.scaled(t, "train"))
    calls.clear()
    ensemble.stored_part(store, "features", payments, **SETTINGS)
    assert not calls                              # read, not fitted
    assert not store.has("forest") and not os.path.exists(store.at("forest", "model"))


def test_stream_scores_equal_batch_scores_also_after_a_restart(spark, stored, tmp_path):
    model, _, t = stored
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    t.repartition(4).write.parquet(src)
    stream = (spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(src))
    got = monitors.run_model_scores(stream, model, "test", root)
    want = rows(model.score(t, "train"))
    assert rows(got) == want
    assert len([x for x in os.listdir(f"{root}/out") if x.startswith("batch=")]) == 4
    # the last batch was written but not committed: it runs again and replaces its rows
    commits = sorted((f for f in os.listdir(f"{root}/checkpoint/commits") if f.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        os.remove(f"{root}/checkpoint/commits/{name}")
    assert rows(monitors.run_model_scores(stream, model, "test", root)) == want
