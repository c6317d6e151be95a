"""Piece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DATA, rows
from tickloom.llm import pieces, queries


@pytest.fixture(scope="module")
def model():
    return pieces.piece_model(queries.piece_model())


def assert_like_library(model, texts):
    ids, counts = model.encode(pa.array(texts, pa.string()))
    want = [model.processor.encode(t or "") for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert model.decode(ids, counts).to_pylist() == [model.processor.decode(w) for w in want]


def test_random_texts(model):
    rng = random.Random(11)
    parts = ["a", "b", "the", "ing", "th", " ", "  ", "\n", "\t", "é", "漢", "字", "▁", "🙂", "\x00",
             "<s>", "</s>", "<unk>", "<0x41>", "́", "\U0010ffff", "1", "aaa", "=" * 9, "\r\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(800)]
    texts += ["".join(rng.choices("etaoinshrdlu", k=rng.randint(5, 250))) for _ in range(400)]
    texts += [" " * k for k in range(70)] + ["a" + " " * k + "b" for k in range(40)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
                      for _ in range(40)) for _ in range(300)]
    assert_like_library(model, [*texts, None, ""])


def test_long_words_and_texts(model, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefghijklmnop", k=3000)), " " * 1500, "=" * 999 + "x", "ab" * 700]
    texts += [" ".join(f"word{i % 97}\nthing  {i % 13}" for i in range(4000)), "end"]
    assert_like_library(model, texts)
    monkeypatch.setattr(pieces, "CHUNK", 64)  # every text is cut into parts
    assert_like_library(model, texts)
    monkeypatch.setattr(pieces, "LONG_WORD", 3)
    assert_like_library(model, texts)


def test_decoding_of_any_ids(model):
    rng = random.Random(7)
    runs = [[rng.randrange(300 if rng.random() < 0.6 else model.size) for _ in range(rng.randint(0, 9))]
            for _ in range(1500)]
    got = model.decode(np.array([i for r in runs for i in r]), np.array([len(r) for r in runs]))
    assert got.to_pylist() == [model.processor.decode(r) for r in runs]


def test_query_over_documents(spark, model):
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_pieces"](spark, DATA).collect()}
    docs = rows(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'")
    assert len(got) == len(docs)
    for i, text in docs:
        ids = model.processor.encode(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = model.processor.decode(ids)
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_cases(spark, model):
    schema = "doc_id long, text string, ids string, tokens array<int>, `a b` int"
    long_text = "Some words and more. " * 20_000
    data = [(1, None, "x", None, 1), (2, "", "y", [], 2), (None, "same", None, [5], 3),
            (3, "same", "z", [5], 4), (3, "same", "z", [5], 4), (4, long_text, None, None, None)]
    frame = spark.createDataFrame(data, schema)
    out = pieces.with_piece_ids(frame, queries.piece_model())
    assert out.columns == ["doc_id", "text", "tokens", "a b", "ids"]
    got = out.collect()
    assert sorted((str(r["doc_id"]), r["a b"]) for r in got) == sorted(
        (str(d[0]), d[4]) for d in data)
    for r in got:
        assert r["ids"] == model.processor.encode(r["text"] or "")
    back = pieces.with_piece_text(out.withColumnRenamed("text", "was"), queries.piece_model())
    for r in back.collect():
        assert r["text"] == (r["was"] or "")
    nothing = pieces.with_piece_text(frame.select("doc_id", F.lit(None).cast("array<int>").alias("ids")),
                                     queries.piece_model())
    assert {r["text"] for r in nothing.collect()} == {""}
    assert pieces.with_piece_ids(frame.limit(0), queries.piece_model()).count() == 0
