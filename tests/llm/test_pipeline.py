"""The pipeline against brute force: every stage on what its predecessor kept."""
import sys
import zlib

import numpy as np
import pytest

import corpus_pipeline as C
from llm_cases import SF_SMALL, WORDS, empty, odd, prose  # noqa: F401
from txnscope.llm.common import written


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, copies, near copies, junk and a leaked benchmark item."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = prose(900, 30)
    rows, labels = [], []
    for k in range(160):
        rows.append((k, prose(k, 80 + k)))
        labels.append((k, 1, 0))
    for k in range(160, 200):
        rows.append((k, " ".join(f"{w}###" for w in prose(k, 90).split())))
        labels.append((k, 0, 0))
    near = prose(3, 83).split()
    near[40] = WORDS[0]
    rows += [(300, prose(1, 81)), (301, prose(2, 82)), (302, " ".join(near)),
             (303, prose(700, 60) + " " + item + " " + prose(701, 60))]
    docs = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, "
                          "n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_does_its_work(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept, names = {}, [n for n, _ in C.STAGES]
    for name, stage in C.STAGES:
        before = docs
        docs = written(stage(spark, docs, corpus), f"test-{name}")
        if name != names[-1]:
            assert docs.dtypes == before.dtypes
            text = {r.doc_id: r.text for r in before.collect()}
            assert all(text[r.doc_id] == r.text for r in docs.collect())
        kept[name] = sorted(r.doc_id for r in docs.collect())
    clean = list(range(160))
    assert kept["quality_classifier"] == clean + [300, 301, 302, 303]
    assert kept["near_dedup"] == clean + [303]
    assert kept["benchmark_decontamination"] == clean
    assert set(kept["source_mix"]) <= set(clean)
    assert kept["token_id_output"] == kept["source_mix"]


def test_mix_and_tokens(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where("doc_id < 160")
    mixed = written(C.source_mix(spark, docs, corpus), "test-mix")
    words = {r.source: r.n for r in mixed.selectExpr("source", "size(split(text, ' ')) AS n")
             .groupBy("source").agg({"n": "sum"}).toDF("source", "n").collect()}
    size = {r.source: r.n for r in docs.selectExpr("source", "size(split(text, ' ')) AS n")
            .groupBy("source").agg({"n": "sum"}).toDF("source", "n").collect()}
    share = sum(size.values()) / 7                       # weights 1, 2, 3, 1; no limit is met
    for s, w in zip("0123", (1, 2, 3, 1)):
        assert abs(words[f"s{s}"] - w * share) <= 240
    got = sorted(C.token_shards(spark, mixed, corpus).collect(), key=lambda r: r.start)
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in mixed.orderBy("doc_id").collect():
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [2]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want


def test_run(spark):
    got = C.run(spark, SF_SMALL).collect()
    assert got and sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)
    assert C.ORACLE_SQL is None and [n for n, _ in C.STAGES][0] == "quality_classifier"


def test_entry_without_the_subpackage(monkeypatch):
    import __spark_entry__ as E
    assert "pipeline" in E.queries()
    for name in [m for m in sys.modules if m.startswith("txnscope.llm")] + ["corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "txnscope.llm", None)
    assert not any(q.startswith("op") and q[2].isdigit() for q in E.queries())
    assert "pipeline" not in E.queries() and "merchant_intelligence" in E.queries()


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_the_chain_on_odd_rows_and_on_none(spark, corpus, odd, empty, kind):  # noqa: F811
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing columns;
    and no rows at all."""
    docs = written({"odd": odd, "empty": empty}[kind], "odd-docs")
    before = docs.count()
    for name, stage in C.STAGES:
        out = written(stage(spark, docs, corpus), f"odd-{name}")
        if name != "token_id_output":
            assert out.columns == docs.columns
            seen = {tuple(r) for r in docs.collect()}
            assert all(tuple(r) in seen for r in out.collect())
        else:
            assert out.count() == docs.count()
        docs = out
    assert (docs.count() > 0) == (before > 0)
