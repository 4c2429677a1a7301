"""Archives read back, and the corpus pipeline stage by stage."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tradewarden.llm import common, minhash, packing, quality, queries, suffix_dedup, warc

SF = "/root/testdata/sf0.001"
PAGES = [(1, "http://www.a.org/x?b=1#f", "<p>one</p>"), (2, "https://A.org:443/", "same"), (3, "http://b.org/é ü", "same"), (4, None, None),
         (5, "", ""), (None, "http://c.org", "same"), (6, "http://[broken", "\r\n\r\nWARC/1.1\r\n é"), (7, "http://a.org/", "x" * 200_000),
         (8, "http://a.org/", "<p>one</p>"), (8, "http://a.org/", "<p>one</p>"), (None, None, "no id at all")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "z", 1) for r in PAGES], "page_id long, url string, html string, digest string, size int")


def records(min_bytes=0):
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        least = first.get(html or "")
        again = len(raw) >= min_bytes and i != least
        out.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", str(least if again else None)))
    return sorted(out)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_pages_come_back(pages, min_bytes):
    got = warc.archive(pages, min_bytes=min_bytes).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == records(min_bytes)


def test_lookup_by_url(spark, pages):
    archives, index = common.scratch(spark, "warc"), common.scratch(spark, "cdx")
    captures = warc.write_archives(pages, archives)
    directory = warc.write_index(captures, index, block_lines=2)
    assert directory.agg(F.sum("lines")).first()[0] == len(PAGES)
    urls = spark.createDataFrame([("http://a.org/",), ("http://nowhere.org/",), ("http://b.org/é ü",)], "url string")
    for rows in (200_000, 2):
        found = warc.lookup(spark, urls, directory, archives, index, slice_rows=rows).collect()
        # another scheme or a default port is the same key
        assert sorted((r.url, r.page_id) for r in found) == [("http://a.org/", i) for i in (2, 7, 8, 8)] + [("http://b.org/é ü", 3)]
        assert {len(r.payload) for r in found if r.page_id == 7} == {200_000}


def test_a_record_is_a_gzip_member_of_its_own(spark, pages):
    folder = common.scratch(spark, "warc")
    capture = warc.write_archives(pages, folder).where("page_id = 1").first()
    member = warc.Files(folder).read(capture.file, capture.offset, capture.length)
    assert warc.parse(gzip.decompress(member))["payload"] == b"<p>one</p>"


def test_keys_sort_by_domain():
    keys = [warc.url_key(u) for u in ("http://www.x.org/a", "https://x.org/", "http://x.org:8080/?q=1", "no url", None)]
    assert keys == ["org,x,www)/a", "org,x)/", "org,x)/?q=1", ")no%20url", ")/"]


def test_no_pages(pages):
    assert warc.archive(pages.limit(0)).count() == 0


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "packing"]


def test_pipeline_stage_by_stage(spark):
    docs = common.table(spark, SF, "documents")
    kept = corpus_pipeline.good_documents(spark, docs, SF)
    model = quality.fit(docs, common.table(spark, SF, "labels"))
    good = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good

    kept = common.stored(kept, "kept")
    single = corpus_pipeline.distinct_documents(spark, kept, SF)
    want = {r.doc_id for r in minhash.near_duplicates(kept).where("kept").collect()}
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == want

    single = common.stored(single, "single")
    bare = corpus_pipeline.without_repeats(spark, single, SF)
    left = {r.doc_id: r for r in suffix_dedup.remove_repeats(single, with_text=True).collect()}
    for r in bare.collect():
        assert r.text == left[r.doc_id].text and r.n_chars == len(r.text)
    assert bare.columns == docs.columns and bare.count() == len(left)

    bare = common.stored(bare, "bare")
    pieces = corpus_pipeline.packed(spark, bare, SF)
    assert pieces.where("start = 0").count() == bare.count() and pieces.count() > 0
    assert isinstance(packing.END_ID, int)


def test_stages_take_odd_documents(spark, docs):
    docs = docs.withColumn("n_chars", F.lit(1).cast("long")).withColumn("row_number", F.lit("r"))
    single = corpus_pipeline.distinct_documents(spark, docs, SF)
    assert single.columns == docs.columns
    groups = minhash.near_duplicates(docs).select("group").distinct().count()
    assert single.count() == groups
    bare = corpus_pipeline.without_repeats(spark, docs, SF)
    assert bare.columns == docs.columns and bare.count() == docs.count()
    assert bare.where("text is null").count() == docs.where("text is null").count()
    assert corpus_pipeline.good_documents(spark, docs.limit(0), SF).count() == 0
    for stage in (corpus_pipeline.distinct_documents, corpus_pipeline.without_repeats, corpus_pipeline.packed):
        assert stage(spark, docs.limit(0), SF).count() == 0
