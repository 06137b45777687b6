import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import SCHEMA, SF_SMALL, empty, odd, prose  # noqa: F401
from txnscope.llm import shingle_join as sj

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """rows of (doc_id, text) -> sorted (doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t in rows]
    by, parent = {}, list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    pairs = {}
    for ids in by.values():
        for x, i in enumerate(ids):
            for j in ids[:x]:
                pairs[j, i] = pairs.get((j, i), 0) + 1
    for (i, j), both in pairs.items():
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            parent[root(i)] = root(j)
    first = {}
    for i, (d, _) in enumerate(rows):               # rows of an id are one document
        if d is not None and sets[i]:
            if d in first:
                parent[root(i)] = root(first[d])
            first[d] = i
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[root(i)] = min(names.get(root(i), d), d)
    return sorted([(d, len(sets[i]), names.get(root(i)) if sets[i] else d)
                   for i, (d, _) in enumerate(rows)], key=str)


def answer(df):
    return sorted([tuple(r) for r in sj.jaccard_classes(df.select("doc_id", "text")).collect()], key=str)


def edited(r, words, edits):
    out = list(words)
    for _ in range(edits):
        at = r.randrange(len(out))
        out[at:at + 1] = r.choice([[], ["new%d" % r.randrange(10 ** 6)], [out[at], "plus"]])
    return out


def near_texts(seed):
    r = random.Random(seed)
    texts = []
    for base in range(25):                           # of every size, small ones above all
        words = prose(seed * 100 + base, r.choice([3, 6, 8, 10, 13, 16, 20, 26, 40, 90, 300])).split()
        for _ in range(r.randrange(1, 8)):
            texts.append(" ".join(edited(r, words, r.randrange(0, 1 + len(words) // 12))))
    passage = prose(seed + 7, 60)                    # shared by texts that are no copies
    texts += [f"{prose(1000 + i, 12)} {passage} {prose(2000 + i, 12)}" for i in range(30)]
    texts += [texts[0], texts[5].upper(), " ", "", None]
    r.shuffle(texts)
    return [(i * 3 - 5, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, tight", [(1, False), (2, True), (3, True)])
def test_components_against_brute_force(spark, monkeypatch, seed, tight):
    if tight:                                        # many chunks, blocks, late shingles
        for name, value in (("CHUNK_SHINGLES", 500), ("FREQUENT", 4), ("BLOCK_SHINGLES", 300),
                            ("MOST_FREQUENT", 60)):
            monkeypatch.setattr(sj, name, value)
    rows = near_texts(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(df) == brute(rows)


@pytest.mark.parametrize("small", [0, 12])
def test_either_side_of_the_boundary(spark, monkeypatch, small):
    monkeypatch.setattr(sj, "boundary", lambda counts, length: small)
    rows = near_texts(4)
    assert answer(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_chains_of_near_copies(spark):
    """Each text links to its neighbours only, and its lists hold all of them."""
    words = prose(5, 400).split()
    rows = [(i, " ".join(words[2 * i:2 * i + 120])) for i in range(140)]
    rows += [(500 + i, " ".join(words[200:240] + [f"w{i}_{j}" for j in range(60)])) for i in range(60)]
    assert answer(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(7, prose(9, 50)), (8, prose(9, 50) + " x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(df) == brute(rows)
    assert sj.jaccard_classes(empty.select("doc_id", "text")).count() == 0
    only = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "doc_id long, text string")
    assert answer(only) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in sj.op12_shingle_join(spark, SF_SMALL).collect()], key=str)
    assert got == brute(rows) and any(d != c for d, _, c in got)


def test_words_at_piece_ends(monkeypatch):
    text = prose(3, 400) + " " + "é" * 70 + " " + "x" * 64 + " end " + "x" * 64
    want = list(sj.shingle_sets([text, "a b", text, "", None, "x" * 64 + " b"]))
    monkeypatch.setattr(sj, "PIECE", 64)
    sj._tables.cache_clear()
    got = list(sj.shingle_sets([text, "a b", text, "", None, "x" * 64 + " b"]))
    assert [len(s) for s in got] == [len(s) for s in want] == [
        len(shingles(t)) for t in (text, "a b", text, "", None, "x b")]
    assert (got[0] == got[2]).all()
    one, two = ("x" * 64 + " b c d e"), ("a " + "x" * 64 + " b c d e")
    assert np.isin(next(sj.shingle_sets([one])), next(sj.shingle_sets([two]))).all()
    sj._tables.cache_clear()


def test_subset_sizes_cover_all_pairs():
    for n in range(1, 40):
        for m in range(n, 60):
            need = next(o for o in range(0, n + m) if 100 * o >= 80 * (n + m - o))
            assert sj.overlap(n, m) == need
            assert ((n, m, need) in sj.subset_sizes(n)) == (need <= n)
            assert ((n, m, need) in sj.subset_sizes(m)) == (need <= n)
            if need <= n:
                assert n - need < sj.listed(n) and m - need < sj.listed(m)
