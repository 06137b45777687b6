import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import SCHEMA, SF_MID, WORDS, empty, odd, prose  # noqa: F401
from txnscope.llm import order_minhash as M


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(0, 5), max_size=40),
       st.integers(0, 40), st.integers(0, 20))
def test_banded_alignment(a, b, limit, narrow):
    old, M.NARROW = M.NARROW, narrow
    try:
        assert M.within_distance(a, b, limit) == (distance(a, b) <= limit)
    finally:
        M.NARROW = old


def test_sketches_keep_text_order():
    h = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    same, other = M.order_sketches(M.kmers(h)), M.order_sketches(M.kmers(h[::-1]))
    assert (same == M.order_sketches(M.kmers(h.copy()))).all() and not (same == other).any()
    repeated = M.kmers(np.ones(50, np.uint64))
    assert len(set(repeated.tolist())) == 46          # occurrences are told apart


def edited(text, share, seed):
    r, words = random.Random(seed), text.split()
    for _ in range(int(share * len(words))):
        i = r.randrange(len(words))
        kind = r.random()
        if kind < 0.4:
            words[i] = r.choice(WORDS)
        elif kind < 0.7:
            del words[i]
        else:
            words.insert(i, r.choice(WORDS))
    return " ".join(words)


def classes(spark, docs):
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA)
    return {r.doc_id: r.class_id for r in M.near_classes(frame).collect()}


def brute(docs):
    """Connected components over all pairs within the edit bound."""
    words = {i: t.lower().split() for i, t in docs}
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, t in docs:
        for j, u in docs:
            a, b = words[i], words[j]
            if i < j and (t == u or (a and b and distance(a, b) <= M.edit_limit(len(a), len(b)))):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in docs}


@pytest.mark.parametrize("turns", [0, 3])
def test_classes_match_brute_force(spark, monkeypatch, turns):
    monkeypatch.setattr(M, "CENTER_TURNS", turns)
    monkeypatch.setattr(M, "BLOCK_ROWS", 4)
    docs = []
    for k in range(6):
        base = prose(k, 60 + 20 * k)
        docs += [(100 * k, base), (100 * k + 1, base)]
        docs += [(100 * k + 2 + j, edited(base, 0.04, 10 * k + j)) for j in range(6)]
    passage = prose(77, 50)                           # shared by documents that differ
    docs += [(700 + j, passage + " " + prose(800 + j, 60)) for j in range(8)]
    docs += [(900, ""), (901, ""), (902, prose(9, 3))]
    assert classes(spark, docs) == brute(docs)


def test_a_chain_is_one_class(spark):
    """Each text is near the next, the ends are not near each other."""
    texts = [prose(5, 120)]
    for k in range(8):
        texts.append(edited(texts[-1], 0.05, k))
    docs = list(enumerate(texts))
    assert brute(docs) == dict.fromkeys(range(9), 0) == classes(spark, docs)


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in
                                                                         range(400, 440)]
    got = {x.id: x.component for x in M.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {i: root(i) for i in parent}
    assert all(got.get(i, i) == c for i, c in want.items())


def test_documents(spark):
    got = M.op10_order_minhash(spark, SF_MID).toPandas()
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    by = dict(zip(got.doc_id, got.class_id))
    for _, same in docs.groupby("text"):
        assert len({by[i] for i in same.doc_id}) == 1
    assert (got.class_id <= got.doc_id).all()
    smallest = got.groupby("class_id").doc_id.min()
    assert (smallest.index == smallest.to_numpy()).all()


def test_odd_rows(spark, odd, empty):  # noqa: F811
    rows = M.near_classes(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert by[1] == by[6] == 1 and by[2] == by[3] == 2 and by[4] == 4 and by[7] == 7
    bare = sorted(r.class_id for r in rows if r.doc_id is None)
    assert bare[0] < 0 and bare[1] == 2               # a text of its own, and the empty text
    kept = M.one_per_class(odd)
    assert kept.dtypes == odd.dtypes
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 4, 5, 7, 8, 9, 10]
    assert ids.count(None) == 1
    assert M.near_classes(empty).count() == 0 and M.one_per_class(empty).count() == 0
