import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import SF_SMALL
from txnscope.llm import prefix_trie
from txnscope.llm.prefix_trie import Parentheses, range_minima

SCHEMA = "conv_id long, turn long, role string, text string"


def digest_of(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(
                ((turn is not None, turn or 0, digest_of(role, text)), role, text))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(family, [])[:h] + turns[h:])
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = {}

    def below(p):
        leaves, saved = 0, (len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0)
        for q in children.get(p, []):
            x, y = below(q)
            leaves, saved = leaves + x, saved + y
        ends = ",".join(str(c) for c in sorted(nodes[p]) if len(built[c]) == len(p))
        out[p] = (min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]),
                  len(children.get(p, [])), leaves or 1, saved,
                  hashlib.sha256(ends.encode()).hexdigest())
        return leaves or 1, saved
    if nodes:
        below(())
    return sorted(out.values(), key=lambda r: r[:2])


def answer(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie.prefix_trie(df).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce(F.lower(F.hex("ends")), F.sha2(F.lit(""), 256))).collect()
    return sorted([tuple(r) for r in got], key=lambda r: r[:2])


def branching(seed, n):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "é"]), r.choice(["a", "bé", "", None]))
            for c in r.sample(range(-250, 900), n) for t in range(r.choice([0, 1, 3, 6, 9]))]
    rows += [(c, t, "user", "same") for c in range(1000, 1090) for t in range(4)]    # copies
    rows += [(c, t, "user", "deep") for c in (2001, 2002) for t in range(300)]
    rows += [(None, 1, "user", "x"), (3001, None, None, None), (3001, 2, "z", "y"),
             (3002, 1, "a", "tie"), (3002, 1, "b", "tie"), (3002, 1, "a", "tie")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("turns, fan_in", [(50_000, 64), (40, 4), (1, 5)])
def test_nodes_against_brute_force(spark, monkeypatch, turns, fan_in):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "FAN_IN", fan_in)
    monkeypatch.setattr(prefix_trie, "IDS_PER_BLOCK", 7)
    rows = branching(turns, 120)
    assert answer(spark, rows) == brute(rows)


def test_query_and_extra_columns(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    got = sorted([tuple(r) for r in prefix_trie.op11_prefix_trie(spark, SF_SMALL).collect()],
                 key=lambda r: r[:2])
    assert got == brute(rows)
    clash = spark.createDataFrame(branching(5, 20), SCHEMA).withColumns(
        {c: F.lit("x") for c in ("path", "h", "family", "n", "kind", "shard")})
    clash.write.parquet(f"{tmp_path}/conversations.parquet")
    got = prefix_trie.op11_prefix_trie(spark, str(tmp_path)).count()
    assert got == len(brute(branching(5, 20)))


def test_empty_table(spark):
    assert answer(spark, []) == []


@pytest.mark.parametrize("n", [1, 5, 31, 33, 500, 20_000])
def test_find_close_and_minima(n):
    r = random.Random(n)
    bits, depth, left = [], 0, n
    while left or depth:
        if left and (not depth or r.random() < (0.9 if left > n // 2 else 0.5)):
            bits.append(1)
            depth, left = depth + 1, left - 1
        else:
            bits.append(0)
            depth -= 1
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    tree = Parentheses(np.array(bits, np.uint8))
    opens = tree.opens()
    assert tree.find_close(opens).tolist() == [want[i] for i in opens]
    values = np.random.default_rng(n).integers(0, 1000, n)
    first = np.random.default_rng(1).integers(0, n, 50)
    size = np.array([r.randint(1, n - f) for f in first])
    assert range_minima(values, first, size).tolist() == [
        int(values[f:f + s].min()) for f, s in zip(first, size)]
