"""Exact round trips of the token shards."""
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_cases import SF_SMALL, empty, odd  # noqa: F401
from txnscope.llm import rans

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=3000), st.integers(0, 5))
def test_block_round_trip(ids, extra):
    ids = np.array(ids, np.uint16)
    counts = np.bincount(ids, minlength=rans.VOCABULARY) * (10 ** extra)
    table = rans.scaled_table(counts)
    assert table.sum() == 1 << rans.PROB_BITS and (table[np.unique(ids)] > 0).all()
    coder = rans.Coder(table)
    assert (coder.decode(coder.encode(ids)) == ids).all()


def test_skewed_table_round_trip():
    ids = np.zeros(50_000, np.uint16)
    ids[::977] = np.arange(len(ids[::977]))
    coder = rans.Coder(rans.scaled_table(np.bincount(ids, minlength=rans.VOCABULARY)))
    block = coder.encode(ids)
    assert len(block) < 12_000 and (coder.decode(block) == ids).all()
    for at in (20, len(block) // 2, len(block) - 1):
        broken = bytearray(block)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(broken))


def test_shard_ranges(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 900, n).astype(np.uint16) for n in (0, 5, 400_000, 1, 3000)]
    flat = np.concatenate(docs)
    coder = rans.Coder(rans.scaled_table(np.bincount(flat, minlength=rans.VOCABULARY)))
    writer = rans.ShardWriter(str(tmp_path / "a.rans"), coder)
    for i, d in enumerate(docs):
        writer.add(None if i == 1 else i, d)
    assert writer.close()["n_tokens"] == len(flat)
    reader = rans.ShardReader(str(tmp_path / "a.rans"), coder)
    assert len(reader.places) == 2
    for start, count in ((0, 10), (262_140, 10), (len(flat) - 3, 3), (7, 0), (0, len(flat))):
        assert (reader.tokens(start, count) == flat[start:start + count]).all()
    got = list(reader.documents())
    assert [g[0] for g in got] == [0, None, 2, 3, 4]
    assert [g[3] for g in got] == [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]
    other = rans.Coder(rans.scaled_table(np.ones(rans.VOCABULARY, np.int64)))
    with pytest.raises(ValueError):
        rans.ShardReader(str(tmp_path / "a.rans"), other)


def test_spellings_of_a_stem_are_learned_once():
    encoder, whole = rans.WordEncoder(PATH), []
    encode_whole = encoder._encode_whole
    encoder._encode_whole = lambda words: (whole.extend(words), encode_whole(words))
    spelled = [w + tail for w in ("schützpf", "Schützpf", "SCHüTZPF", "onstor", "ONstor")
               for tail in ("", ".", ",", "***")]
    ids, bounds = encoder.encode(pa.array(spelled))
    assert set(encoder.known) == {"", "schützpf", "onstor", ".", ",", "***"}
    assert {".", ",", "***"} == {w for w in whole if w}
    want = [e.ids for e in encoder.tokenizer.encode_batch(spelled, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_encoder_matches_the_tokenizer_on_odd_words():
    encoder = rans.WordEncoder(PATH, max_words=40)
    letters = rans.WordEncoder.LETTERS
    texts = [None, "", " ", "\n\t", *(f"a{c}b {c} {c.upper()}B{c}. {c}{c};" for c in letters),
             "<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>| end.<|endoftext|>",
             "don't DON'T it's. 's 'S, a.b. a1 1a 12;34 ...! .a a. *", "İI ıi ΣΑΣ. straße ẞ",
             "e\u0301 E\u0301. a\u0338= A.\u0301 \u212a\u212b ﬁ. Ǆ ǆ! \u00a0a\u00a0 b\u2003C.",
             "日本語。 Привет, мир! 🙂. a🙂b. " + "x" * 3000 + "."]
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for step in (len(texts), 7, 1):
        got = []
        for lo in range(0, len(texts), step):
            for kind in (pa.string(), pa.large_string()):
                ids, bounds = encoder.encode(pa.array(texts[lo:lo + step], kind))
            got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == want


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    coded = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    coded.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    out, start = [], 0
    for i, ids in coded:
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, start


def test_documents_match_the_tokenizer(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, total = expected([(r.doc_id, r.text) for r in rows])
    got = sorted(rans.op3_rans_token_shards(spark, SF_SMALL).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want
    assert got[0].start == 0 and got[-1].start + got[-1].n_tokens == total


def test_odd_rows(spark, odd, empty):
    got = rans.encoded_and_read_back(odd).collect()
    want, total = expected([(r.doc_id, r.text) for r in odd.collect()])
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert (sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=key)
            == sorted(want, key=key))
    assert sum(r.n_tokens for r in got) == total
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert rans.encoded_and_read_back(empty).count() == 0
