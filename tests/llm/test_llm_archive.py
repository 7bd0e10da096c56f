"""WARC archives, the pipeline and how the entry module finds them."""

import base64
import hashlib
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from lakemart.llm import toxicity, warc
from lakemart.llm.common import read, stored, workspace
from lakemart.llm.queries import QUERIES
from llm_fixtures import awkward_docs, empty_docs
from test_llm_packing import check_packed
from test_llm_texts import brute_spans

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 2])
def test_archive_round_trip(spark, least, monkeypatch):
    rows = [(1, "http://a\n b", "aa"), (2, None, "aa"), (3, "x", None), (4, "y", ""), (None, "z", "aa"), (5, "é", "aa"), (5, "é", "aa"),
            (6, "u", "<p>\r\n\r\nWARC/1.1\r\n</p>ü" * 3000), (7, "u", "b"), (8, "u", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit("x")).withColumn("kept", F.lit(0))
    folder = workspace(spark, "warc-test")
    index = warc.write(pages.coalesce(1), folder, least_bytes=least)
    got = warc.read(index, folder).collect()
    payload = {r["page_id"]: bytes(r["payload"]) for r in got if r["payload"] is not None}
    want = []
    for i, _, html in rows:
        size = len((html or "").encode())
        same = [j for j, _, h in rows if j is not None and (h or "") == (html or "")]
        refers = max(same) if i is not None and size >= least and max(same) != i else None
        want.append((i, size, digest(html), "response" if refers is None else "revisit", refers))
        if refers is None:
            assert payload[i] == (html or "").encode()
    assert Counter(want) == Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got)
    some = warc.read(index.filter("page_id IN (3, 8)"), folder, with_payload=False)
    assert sorted(r["page_id"] for r in some.collect()) == [3, 8] and "payload" not in some.columns


def test_damaged_payload_is_noticed(spark):
    raw = warc.record(1, "u", b"hello", digest("hello"), None, "2000-01-01T00:00:00Z")
    assert warc.parse(raw)["payload"] == b"hello"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"hello", b"hallo"))


def test_archives_roll_over_and_are_read_by_parts(tmp_path):
    """Run in this process, where the sizes can be made small."""
    import pyarrow as pa
    from unittest import mock

    rnd = __import__("random").Random(1)
    pages = [(i, f"http://h/{i}", "".join(rnd.choices("abcdefgh", k=400))) for i in range(50)]
    with mock.patch.object(warc, "ARCHIVE_BYTES", 2000), mock.patch.object(warc, "RETURNED", 7):
        batch = pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pages]), pa.array([p[1] for p in pages]), pa.array([p[2] for p in pages]),
             pa.array([hashlib.sha1(p[2].encode()).hexdigest() for p in pages]), pa.nulls(50, pa.int64())],
            names=["page_id", "url", "html", "sha1", "refers_to"])
        notes = [r for b in warc.archive_batches(iter([batch]), str(tmp_path), "2000-01-01T00:00:00Z", 1) for r in b.to_pylist()]
        assert len({n["archive"] for n in notes}) > 5
        order = sorted(notes, key=lambda n: (n["archive"], n["offset"]))
        wanted = pa.RecordBatch.from_pylist([{k: n[k] for k in ("archive", "offset", "length")} for n in order])
        got = [r for b in warc.record_batches(iter([wanted]), str(tmp_path), True) for r in b.to_pylist()]
    assert sorted((r["page_id"], r["url"], r["payload"].decode()) for r in got) == sorted(pages)
    assert {n["page_id"]: n["url"] for n in notes} == {p[0]: p[1] for p in pages}


def test_records_are_read_by_many_tasks(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    folder = workspace(spark, "warc-test")
    index = warc.write(pages.withColumn("html", F.concat("html", F.repeat(F.sha2("html", 512), 3))), folder)
    small = warc.TASK_BYTES
    try:
        warc.TASK_BYTES = 1 << 16
        found = warc.read(index, folder, with_payload=False)
        assert found.rdd.getNumPartitions() > 8 and found.count() == 3000
        assert found.filter("url <> 'u'").isEmpty()
    finally:
        warc.TASK_BYTES = small


def test_nothing_is_an_empty_index(spark):
    folder = workspace(spark, "warc-test")
    nothing = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert nothing.count() == 0 and warc.read(nothing, folder).count() == 0


def test_warc_query(spark):
    pages = {r["page_id"]: r["html"] for r in read(spark, SF01, "pages").collect()}
    got = QUERIES["op9_warc_index"](spark, SF01).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in got} == {
        i: (len(h.encode()), digest(h)) for i, h in pages.items()}


def test_stages_keep_their_promises(spark):
    docs = read(spark, SF01, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF01), f"test-{name}")
        seen.append(docs)
    assert all(d.columns == columns for d in seen[:-1])
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] == ids[4] == ids[5]
    model = toxicity.learn(seen[0], read(spark, SF01, "labels"))
    assert ids[1] == {r["doc_id"] for r in toxicity.score(seen[0], model).filter("score < 0.5").collect()}
    assert not any(brute_spans(r["text"]) for r in seen[4].select("text").collect())
    check_packed(seen[5].collect(), 2048)
    assert seen[5].columns == corpus_pipeline.run(spark, SF001).columns


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward_docs(spark), empty_docs(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF001), f"test-{name}")
            assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
            assert name == corpus_pipeline.STAGES[-1][0] or {r["doc_id"] for r in docs.collect()} >= (
                {0, 1} & {r["doc_id"] for r in docs.collect()})


def test_entry_registers_them_and_does_without(spark, monkeypatch):
    names = entry.queries()
    assert {"pipeline", *QUERIES} <= set(names) and all(f"op{n}_" in "".join(names) for n in range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
    import sys
    monkeypatch.setitem(sys.modules, "lakemart.llm.queries", None)
    assert "pipeline" not in entry.queries() and not set(QUERIES) & set(entry.oracle_sql())


def test_raw_files_open_by_uri(tmp_path):
    from lakemart.llm.common import filesystem
    for uri in (str(tmp_path), f"file://{tmp_path}"):
        fs, path = filesystem(uri)
        assert fs.get_file_info(path).type == pafs.FileType.Directory
