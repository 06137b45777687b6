"""Toxicity grammar and positive-unlabelled quality: held-out accuracy and cases."""
import zlib

import numpy as np
import pytest

from llm_cases import SF_MID, empty, odd, prose  # noqa: F401
from txnscope.llm import quality as Q
from txnscope.llm import toxicity as T


def held_out(spark, frame, label):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").toPandas()
    rows = frame.toPandas().merge(labels, on="doc_id")
    rows = rows[rows.held_out]
    assert len(rows) > 30 and rows.score.between(0, 1).all()
    return rows[label].to_numpy(), rows.predicted.to_numpy(), rows.score.to_numpy()


def auc(y, score):
    return np.mean([(p > n) + 0.5 * (p == n) for p in score[y == 1] for n in score[y == 0]])


def test_toxicity_on_held_out_documents(spark):
    y, predicted, score = held_out(spark, T.op5_toxicity_grammar(spark, SF_MID), "toxic")
    assert auc(y, score) > 0.9 and (y == predicted).mean() > 0.9


def test_quality_on_held_out_documents(spark):
    y, predicted, score = held_out(spark, Q.op9_pu_quality(spark, SF_MID), "quality")
    assert auc(y, score) > 0.97 and (y == predicted).mean() > 0.95


@pytest.mark.parametrize("text, want", [
    ("you are a grub", [("directed", 0)]), ("a grub", [("insult", 0)]),
    ("he is not a grub", [("directed", 1)]), ("she said grub", [("directed", 2)]),
    ("they will kill you", [("threat", 0)]), ("kill time", [("violent", 0)]),
    ("nothing here", []), ("grubby grub", [("insult", 0), ("insult", 0)])])
def test_grammar(text, want):
    lexicon = T.Lexicon(words={"grub": 2.0}, stems={"grubb": 1.0})
    got = T.matches([lexicon.classify(w) for w in T.WORD.findall(text)])
    assert [(k, m) for k, m, _ in got] == want


def test_clauses_are_found_once():
    triggers = T.Lexicon(words={"grub": 1.0}).triggers()
    text = "all is well. you grub, you grub! the grubs eat\na grub"
    assert list(T.clauses(text, triggers)) == [" you grub, you grub", "a grub"]


def test_clauses_have_no_longest_length():
    lexicon = T.Lexicon(words={"grub": 1.0})
    text = "fine. she reported " + "then " * 300 + "grub"
    assert list(T.clauses(text, lexicon.triggers())) == [text[5:]]
    x = dict(zip(T.FEATURES, T.features(text, lexicon, lexicon.triggers())))
    assert x["directed_reported"] > 0 and x["insult_plain"] == 0


def test_only_real_copies_count_once(spark):
    common = min((f"q{k}" for k in range(5000)), key=lambda w: zlib.crc32(w.encode()))
    long = prose(7, 400)
    texts = [f"{common} {prose(100 + k, 30)}" for k in range(40)]      # share their smallest hash
    texts += [texts[0], texts[0].upper(), long, f"{long} extra", None, ""]
    rows = [(k, t, k % 2) for k, t in enumerate(texts[:40])]
    rows += [(40 + k, t, 0) for k, t in enumerate(texts[40:])] + [(99, texts[0], 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    sample = T.distinct_words(frame).join(frame.select("doc_id", "toxic"), "doc_id")
    kept = {r.doc_id for r in T.without_copies(sample).collect()}
    # the other label's copy stays, too
    assert kept == set(range(40)) | {42, 44, 99}


def test_lexicon_ignores_chance(spark):
    rows = [(1, ["villain", f"w{k}"]) for k in range(40)] + [(0, ["plain", f"v{k}"])
                                                             for k in range(400)]
    sample = spark.createDataFrame(rows, "toxic int, words array<string>")
    lexicon = T.learn_lexicon(sample)
    assert set(lexicon.words) == {"villain"} and not lexicon.stems


def test_prior_and_risk():
    rng = np.random.default_rng(0)
    good = np.hstack([rng.normal(1, 1, (2000, 1)), np.ones((2000, 1))])
    bad = np.hstack([rng.normal(-3, 1, (600, 1)), np.ones((600, 1))])
    unlabelled = np.vstack([good[:1400], bad])
    prior = Q.estimated_prior(good[:, 0], unlabelled[:, 0])
    assert abs(prior - 0.7) < 0.06
    w = Q.fit_nnpu(good, unlabelled, prior)
    score = Q.sigmoid(unlabelled @ w)
    assert ((score >= 0.5) == np.repeat([True, False], [1400, 600])).mean() > 0.9


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("labels", [
    [], [(1, 1, 0), (None, 1, 1), (5, None, None), (99, 0, 1), (7, 1, 0), (7, 1, 0)]])
def test_odd_rows(spark, odd, empty, labels):  # noqa: F811
    frame = spark.createDataFrame(labels, LABELS)
    n = odd.count()
    for module in (Q, T):
        model = module.train(odd, frame)
        rows = module.scored(odd, model).collect()
        assert len(rows) == n and all(0 <= r.score <= 1 for r in rows)
        assert module.scored(empty, model).count() == 0
        module.train(empty, frame)
    kept = Q.keep_quality(odd, Q.train(odd, frame), threshold=0.0)
    assert kept.dtypes == odd.dtypes and kept.count() == n
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))


def test_junk_ratios():
    clean = Q.ratios(prose(1, 200))
    assert clean[0] == clean[2] == 0.0 and clean[5] < 0.2
    assert Q.ratios("a ### b &&& c")[0] > 0.5 and Q.ratios("go go go stop")[5] > 0.9
    assert Q.ratios(None) == Q.ratios("") == Q.ratios(" \n") == [0.0] * len(Q.FEATURES)
