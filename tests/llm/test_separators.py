import numpy as np
import public_tokenizers
import pytest

from llm_cases import SF_SMALL, empty, odd  # noqa: F401
from txnscope.llm import separators
from txnscope.llm.common import shared_folder


def write(folder, parts):
    import os
    os.makedirs(folder, exist_ok=True)
    for name, ids in parts.items():
        np.array(ids, "<u2").tofile(f"{folder}/{name}.bin")


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_documents_span_blocks_and_files(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(separators, "BLOCKS_PER_GROUP", 4)
    rng = np.random.default_rng(block)
    parts = {f"p{i}": rng.integers(0, 4, n).tolist() for i, n in enumerate((40, 1, 0, 33, 17))}
    parts["p5"] = [1, 2, 3]                     # ends inside a document
    write(tmp_path, parts)
    stream = [x for p in sorted(parts) for x in parts[p]]
    want, start = [], 0
    for at, x in enumerate(stream):
        if x == 0:
            want.append((start, at - start, True))
            start = at + 1
    want.append((start, len(stream) - start, False))
    got = separators.scan_documents(spark, str(tmp_path), 0, block).orderBy("number").collect()
    assert [(r.start, r.n_tokens, r.terminated) for r in got] == want
    assert [r.number for r in got] == list(range(len(want)))


def test_counts_match_the_tokenizer(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    encoding = separators.byte_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = {r.doc_id: len(encoding.encode_ordinary(r.text)) for r in rows}
    got = separators.op1_separator_scan(spark, SF_SMALL).collect()
    assert len(got) == len(rows) and {r.doc_id: r.n_tokens for r in got} == want


def test_odd_rows(spark, odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    folder = shared_folder(spark, "test-files")
    named = separators.write_token_files(odd, folder, path, separators.END_OF_TEXT)
    found = separators.scan_documents(spark, folder, separators.END_OF_TEXT, 100, only=named)
    encoding = separators.byte_encoder(path)
    want = sorted(len(encoding.encode_ordinary(r.text or "")) for r in odd.collect())
    assert sorted(r.n_tokens for r in found.collect()) == want
    folder = shared_folder(spark, "test-files")
    none = separators.write_token_files(empty, folder, path, separators.END_OF_TEXT)
    assert separators.scan_documents(spark, folder, separators.END_OF_TEXT, only=none).count() == 0
