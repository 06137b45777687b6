import base64
import gzip
import hashlib

import pytest

from llm_cases import SF_SMALL
from txnscope.llm import warc as W
from txnscope.llm.common import shared_folder, written

SCHEMA = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows):
    first = {}
    for i, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, h in rows:
        f = first.get(h or "")
        revisit = f is not None and i != f
        out.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response",
                    f if revisit else None))
    return sorted(out, key=str)


def test_pages(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    got = W.op8_warc_transactions(spark, SF_SMALL).collect()
    assert sorted([tuple(r[:5]) for r in got], key=str) == expected(rows)


@pytest.fixture
def pages(spark):
    rows = [(3, "https://a.example/x y?q=1", "<p>same</p>"), (1, "http://b.example", "<p>same</p>"),
            (2, None, "<p>same</p>"), (4, "http://c.example/\r\nX: y", None), (5, "u", ""),
            (6, "é://ü", "d\r\n\r\nWARC/1.1\r\n\r\n" * 9), (None, "http://n.example", "<p>same</p>"),
            (None, "http://n.example", "alone"), (7, "http://l.example", "x" * 3_000_000),
            (1, "http://b.example", "<p>same</p>")]
    rows += [(100 + k, f"http://hot.example/{k}", "hot") for k in range(50)]
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("first", "salt", "payload", "sha1", "record_type")})


def test_odd_pages(spark, pages, tmp_path):
    rows = [(r.page_id, r.html) for r in pages.collect()]
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = W.op8_warc_transactions(spark, str(tmp_path)).collect()
    assert sorted([tuple(r[:5]) for r in got], key=str) == expected(rows)


def test_records(spark, pages):
    manifest = W.write_archives(pages, shared_folder(spark, "warc-test"), file_bytes=1000)
    total = pages.count()
    assert sum(r.n_records for r in manifest.collect()) == 3 * total
    for r in manifest.limit(2).collect():               # other tools read them too
        raw = gzip.open(r.path.replace("file:", "")).read()
        assert raw.startswith(b"WARC/1.1\r\n") and raw.count(b"WARC-Record-ID") == r.n_records
    records = written(W.read_records(manifest), "warc-test-records")
    assert records.select("record_id").distinct().count() == 3 * total
    captures = W.assemble(records).collect()
    assert len(captures) == total
    html = {r.page_id: r.html for r in pages.collect()}
    for c in captures:
        assert [x.record_type for x in c.requests + c.metadata] == ["request", "metadata"]
        fields = c.metadata[0].fields
        if c.main.record_type == "response" and "page-id" in fields:
            payload = bytes(c.main.block).partition(b"\r\n\r\n")[2]
            assert payload == (html[int(fields["page-id"])] or "").encode()
        else:
            assert c.main.record_type == "response" or c.main.refers_to is not None


def test_chains_and_orphans(spark):
    columns = W.RECORD_SCHEMA
    base = ("f", None, None, None, None, None, None, None, None, None)

    def row(i, kind, to=None):
        r = list(base)
        r[1], r[2], r[3] = i, kind, to
        return tuple(r)
    records = spark.createDataFrame([
        row("a", "response", "b"), row("b", "request"), row("c", "metadata", "b"),
        row("d", "response"), row("e", "request", "d"), row("f", "metadata", "e"),
        row("g", "metadata", "nowhere"), row("c2", "metadata", "b"), row("c0", "metadata", "a"),
        row("b2", "request", "b")], columns)
    got = sorted((r.main.record_id, *(tuple(x.record_id for x in of) for of in (r.requests, r.metadata)))
                 for r in W.assemble(records).collect() if r.main)
    assert got == [("a", ("b", "b2"), ("c", "c0", "c2")), ("d", ("e",), ("f",))]
    assert W.assemble(records).count() == 3


def test_large_payloads_only(spark, pages):
    manifest = W.write_archives(pages, shared_folder(spark, "warc-test"), least=4)
    records = W.read_records(manifest, with_blocks=False)
    kinds = {r.record_type: r["count"] for r in records.groupBy("record_type").count().collect()}
    assert kinds["revisit"] == 3                         # "hot" and "" are too short
    empty = spark.createDataFrame([], SCHEMA)
    none = W.write_archives(empty, shared_folder(spark, "warc-test"))
    assert W.assemble(W.read_records(none)).count() == 0


def test_damage_is_found(tmp_path):
    member = W.record("response", "<urn:uuid:1>", b"HTTP/1.1 200 OK\r\n\r\nhello",
                      "application/http", W.CAPTURED, [("WARC-Payload-Digest", "sha1:AAAA")])
    (h, block), = W.parse_archive(member)
    with pytest.raises(ValueError):
        W._row("f", h, block, True)
    with pytest.raises(ValueError):
        list(W.parse_archive(member[:-20]))
