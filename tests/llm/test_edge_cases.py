"""Names, ids and sizes that once led to wrong results or stopped a job."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import leaks
from tickloom.llm import (decontaminate, language, line_dedup, near_dedup, queries, sharding,
                          url_filter, warc)
from tickloom.llm.components import connected_components

WORDS = " ".join(f"w{i}" for i in range(40))


def named(spark, names, rows):
    """Rows of (id, text) with further columns of these names."""
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names)
    return spark.createDataFrame([(*r, *range(len(names))) for r in rows], schema)


def assert_kept(out, names, count):
    found = out.collect()
    assert len(found) == count
    assert all(r[n] == i for r in found for i, n in enumerate(names))


def test_columns_may_have_any_name(spark):
    rows = [(1, WORDS + "\nA line of some length"), (2, WORDS + " x\nA line of some length"), (None, None)]
    names = ["_row", "_id", "_lines", "_places", "_doc", "a b", "_h1", "_key"]
    out = line_dedup.drop_repeated_lines(named(spark, names, rows))
    assert_kept(out, names, 3)
    assert {r["n_dropped"] for r in out.where("doc_id = 2").collect()} == {1}

    names = ["set1", "set2", "sketch", "_component", "component", "id", "doc", "node", "_gone"]
    out = near_dedup.near_duplicates(named(spark, names, rows))
    assert_kept(out, names, 3)
    assert out.where("doc_id = 2 and component_id = 1 and not kept").count() == 1
    assert_kept(near_dedup.keep_one(named(spark, names, rows)), names, 2)

    names = ["_key", "_bucket", "key", "bucket", "_before", "n", "run", "whole"]
    assert_kept(sharding.shuffle_into_shards(named(spark, names, rows), 2), names, 3)

    bench = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w7 w8")], "item_id long, text string")
    names = ["cut", "_first", "was", "item", "words"]
    out = decontaminate.find_leaks(named(spark, names, rows), bench, block_words=3, cut=True)
    assert_kept(out, names, 3)

    names = ["_url", "_best", "_page", "_place", "_token", "a b", "weight"]
    pages = named(spark, names, [(1, "http://example.org/es/"), (2, "http://x.net/casino"), (3, None)])
    out = url_filter.judge_urls(pages, url_filter.rule_table(spark), url_col="text")
    assert_kept(out, names, 3)
    assert {r["doc_id"]: r["verdict"] for r in out.collect()} == {1: "block", 2: "block", 3: "allow"}


def test_very_long_and_many_urls(spark):
    long_url = "http://example.org/es/" + "x/" * 200_000
    pages = spark.createDataFrame([(i, long_url if i % 9 == 0 else f"http://a{i}.com/de/{i}")
                                   for i in range(200)], "page_id long, url string")
    out = url_filter.judge_urls(pages, url_filter.rule_table(spark))
    assert out.count() == 200 and out.where("verdict = 'block'").count() == 200
    everywhere = url_filter.rule_table(spark, [], [("block", "all", "a1", ())])
    got = url_filter.judge_urls(pages, everywhere).where("verdict = 'block'")
    assert {r["page_id"] for r in got.collect()} == {i for i in range(200) if i % 9 and "a1" in f"a{i}"}


@pytest.mark.parametrize("kind", ["large", "text"])
def test_ids_of_near_copies(spark, kind):
    make = (lambda i: 4 * 10 ** 18 + i) if kind == "large" else (lambda i: f"doc-{i}")
    docs = [(make(i), WORDS + f" end{i}") for i in range(4)] + [(make(9), "else")]
    frame = spark.createDataFrame(docs, f"doc_id {'long' if kind == 'large' else 'string'}, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert got == {**{make(i): make(0) for i in range(4)}, make(9): make(9)}
    links = spark.createDataFrame([(make(i), make(i + 1)) for i in range(20)], frame.schema["doc_id"].dataType
                                  .simpleString().join(["a ", ", b "]) + frame.schema["doc_id"].dataType.simpleString())
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert set(found.values()) == {min(make(i) for i in range(21))} and len(found) == 21


def test_benchmark_blocks_are_bounded(spark):
    rng = np.random.default_rng(3)
    items = [(i, "\n".join(f"v{rng.integers(5000)}" for _ in range(100))) for i in range(200)]
    items.append((999, "-".join(f"big{i}" for i in range(9000))))  # one item, larger than a block
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = decontaminate.segments(bench, "item_id", "text", 10, 991)
    assert parts.agg(F.max("words")).first()[0] <= 1000
    sizes = [sum(len(t.replace("-", "\n").split("\n")) for t in b.texts)
             for b in _blocks(parts, 1000)]
    assert max(sizes) <= 1000 and len(sizes) >= 29
    docs = [(1, items[3][1].replace("\n", " ")), (2, " ".join(f"big{i}" for i in range(4000, 5100))),
            (3, " ".join(f"big{i}" for i in range(8985, 8999))), (4, "v1 v2 v3"), (5, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.find_leaks(frame, bench, block_words=1000).collect()
    for r in got:
        n, hit, held = leaks(r["text"], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), held)


def _blocks(parts, words):
    """The blocks, with the texts that went into them."""
    made = []

    class Kept(decontaminate.Phrases):
        def __init__(self, items, texts, window):
            super().__init__(items, texts, window)
            self.texts = texts
            made.append(self)

    first, decontaminate.Phrases = decontaminate.Phrases, Kept
    try:
        list(decontaminate.phrase_blocks(parts, 10, words))
    finally:
        decontaminate.Phrases = first
    return made


def test_a_language_of_any_size_is_learned(spark):
    assert language.last_hash(4000, 100) == (1 << 63) - 1
    for n in (10 ** 4, 5 * 10 ** 9, 10 ** 13):
        share = (language.last_hash(4000, n) + (1 << 63)) / 2 ** 64
        assert share == pytest.approx(4000 / n)
    docs = [(i, "the house of the king", "en") for i in range(50)] + [(99, "12 34", "xx"), (98, "", "yy")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert language.learn(frame).languages == ["en"]
    few = language.learn(frame, per_language=10)
    assert few.languages == ["en"]


def test_held_out_is_never_null(spark, tmp_path):
    docs = [(1, "the house of the king", "en", "s", 1), (None, "the garden", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op7_language"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {1: zlib.crc32(b"1") % 4 == 2, None: False}


def test_many_equal_rows_are_sharded(spark):
    rows = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("copy " * 20).alias("text"))
    rows = rows.union(spark.range(40).select("id", F.lit(None).cast("string")))
    got = sharding.shuffle_into_shards(rows, 4, bucket_bytes=20_000).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 3040 and set(counts.values()) == {760}
    assert all({r["slot"] for r in got if r["shard"] == s} == set(range(760)) for s in range(4))


def test_broken_records_are_skipped(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %b\r\n\r\nabc"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\n%bContent-Type: application/http\r\n"

    def record(i, size, more=b"", length=b"3"):
        return head % (i, more) + size + b"\r\n" + block % length + b"\r\n\r\n"

    good = b"Content-Length: 41\r\n"
    assert len(block % b"3") == 41
    data = (b"rubbish\r\n" + record(1, good) + record(2, b"") + record(3, b"Content-Length: many\r\n")
            + record(4, good, b"X-Odd: \xff\xfe\r\n") + record(5, good, length=b"x") + head % (6, b""))
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    got = {r["record_id"]: r for r in warc.read_archive(spark, str(tmp_path)).collect()}
    assert set(got) == {f"<urn:page:{i}>" for i in (1, 4, 5)}
    assert all(bytes(r["payload"]) == b"abc" for r in got.values())
    assert got["<urn:page:5>"]["http_length"] is None and got["<urn:page:1>"]["http_length"] == 3


def test_archive_of_odd_pages(spark, tmp_path):
    html = "<p>" + "long ü " * 300_000
    pages = named(spark, ["digest", "first", "bytes", "payload"], [(1, html), (2, html), (3, "x")])
    folder = warc.write_archive(pages, str(tmp_path / "w"), id_col="doc_id", url_col="text", html_col="text")
    got = warc.read_archive(spark, folder)
    assert {(r["record_id"], r["record_type"], r["payload"] and bytes(r["payload"]).decode())
            for r in got.collect()} == {("<urn:page:1>", "response", html), ("<urn:page:2>", "revisit", None),
                                        ("<urn:page:3>", "response", "x")}
