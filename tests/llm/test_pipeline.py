"""The pipeline's stages against brute force on their own inputs."""

import re
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from tests.llm.brute import BLANK, DATA, components, leaks, lower, rows


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = rows(f"SELECT item_id, text FROM '{DATA}/benchmark.parquet'")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, DATA)
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == set(before)
            break
        assert out.columns == docs.columns
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "language":
            assert all(re.search("[^\\W\\d_]", t) for t in after.values())
            assert len(after) >= 0.97 * len(before)
        elif name == "line_dedup":
            assert after == without_lines(before)
        elif name == "near_dedup":
            found = components(before.items(), 80)
            assert set(after) == {i for i, (_, c) in found.items() if c == i}
        elif name == "decontaminate":
            assert set(after) == set(before)
            for i, text in after.items():
                n, hit, _ = leaks(before[i], items)
                assert (text == before[i]) == (not hit)
                assert not leaks(text, items)[1]
        docs, before = spark.createDataFrame(out.collect(), out.schema), after


def test_cut_benchmark_leaves_no_nested_passage(spark, tmp_path, monkeypatch):
    passage = "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12"
    items = [(1, passage), (2, "a b"), (3, "x y")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    whole, (head, tail) = passage, (passage[:17], passage[17:])
    texts = ["a a b b", "x a b y", f"start {head} {whole} {tail} end", "a a a x y b b b\nc", "clean text", None]
    texts += [texts[0]]
    schema = spark.read.parquet(f"{DATA}/documents.parquet").schema
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], schema)
    first = pipeline.decontaminate.find_leaks
    for size in (pipeline.decontaminate.BLOCK_WORDS, 1):
        monkeypatch.setattr(pipeline.decontaminate, "find_leaks",
                            lambda *a, **b: first(*a, block_words=size, **b))  # noqa: B023
        got = {r["doc_id"]: r["text"] for r in pipeline.cut_benchmark(spark, docs, str(tmp_path)).collect()}
        assert set(got) == set(range(len(texts)))
        assert not any(leaks(t, items)[1] for t in got.values())
        assert got[4] == "clean text" and got[5] is None and got[3].split() == ["c"]
        assert got[2].split() == ["start", "end"] and not got[0].strip()


def without_lines(docs):
    holders = defaultdict(set)
    key = lambda line: lower(line).strip(BLANK)
    for i, text in docs.items():
        for line in text.split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    return {i: "\n".join(line for line in text.split("\n")
                         if i == min(holders.get(key(line), {i}), default=i)) for i, text in docs.items()}


def test_run_on_odd_rows(spark, tmp_path):
    schema = spark.read.parquet(f"{DATA}/documents.parquet").schema
    texts = [None, "", "123", "The house of the king is here", "The house of the king is here"]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)]
                                + [(None, "The house of a queen was there", "en", "s", 3)], schema)
    for folder, frame in (("odd", odd), ("empty", odd.limit(0))):
        sf = str(tmp_path / folder)
        frame.write.parquet(f"{sf}/documents.parquet")
        spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
        got = pipeline.run(spark, sf).collect()
        if folder == "empty":
            assert not got
        else:
            assert Counter(r["doc_id"] for r in got) == Counter([3, 4, None])
