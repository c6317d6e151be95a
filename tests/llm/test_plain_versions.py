"""Packing, language and sharding against plain loops over rows."""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.brute import DATA, rows
from tickloom.llm import language, packing, sharding


def plain_sum_of_squares(lengths, capacity):
    """A list of bins; each length goes where the sum of squared counts per gap gets smallest."""
    gaps, filled, places = [], [], []
    for size in lengths:
        count = Counter(g for g in gaps if 0 < g < capacity)
        best = None
        for g in sorted(count):
            if g < size:
                continue
            after = Counter(count)
            after[g] -= 1
            if g > size:
                after[g - size] += 1
            total = sum(n * n for n in after.values())
            if best is None or total < best[0]:
                best = (total, g)
        if best is None:
            gaps.append(capacity)
            filled.append(0)
            at = len(gaps) - 1
        else:  # of bins with that gap, the one that got it last
            at = max((i for i, g in enumerate(gaps) if g == best[1]), key=lambda i: filled[i])
        places.append((at, capacity - gaps[at]))
        gaps[at] -= size
        filled[at] = len(places)
    return places


def test_packing_equals_the_plain_rule():
    rng = np.random.default_rng(3)
    for capacity, high in ((10, 10), (50, 20), (2048, 2048)):
        for _ in range(6):
            lengths = np.sort(rng.integers(1, high + 1, 120))[::-1].copy()
            place, offset = packing.sum_of_squares(lengths, capacity)
            want = plain_sum_of_squares(lengths.tolist(), capacity)
            assert list(zip(place.tolist(), offset.tolist())) == want


def plain_language(text, model, switch):
    """Best path by a loop over words, scored one by one."""
    words = re.findall(r"[^\W\d_]+", text or "")
    words = [w for w in words if w.isalpha()]
    if not words:
        return language.UNKNOWN, 0.0
    scores = []
    for word in words:
        one = language.LetterWords([word])
        slots, _ = one.grams(slice(0, 1))
        allowed = model.scripts[one.script[0]]
        score = model.table[slots].sum(0, dtype=np.float64)
        scores.append(np.where(allowed, score, -1e6) if allowed.any() else np.zeros(len(score)))
    best, back = scores[0], []
    for score in scores[1:]:
        top = int(best.argmax())
        stay = best >= best[top] - switch
        back.append(np.where(stay, np.arange(len(best)), top))
        best = np.where(stay, best, best[top] - switch) + score
    state, path = int(best.argmax()), []
    for origin in reversed(back):
        path.append(state)
        state = int(origin[state])
    path.append(state)
    letters = Counter()
    for word, label in zip(words, reversed(path)):
        letters[label] += len(word)
    most = max(letters.values())
    return {model.languages[k] for k, n in letters.items() if n == most}, most / sum(letters.values())


def test_language_equals_plain_paths(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language.learn(docs)
    got = language.detect(docs.select("doc_id", "text"), model).collect()
    assert len(got) == 200
    for r in got:
        want, score = plain_language(r["text"], model, language.SWITCH)
        assert r["lang_pred"] == want if isinstance(want, str) else r["lang_pred"] in want
        assert abs(r["score"] - score) < 1e-9


def test_sharding_equals_a_plain_shuffle(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    keyed = docs.select("doc_id", F.xxhash64(F.lit(17), "doc_id", "text").alias("key"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).collect()
    limit = 100_000
    buckets = -(-sum(r["size"] + 8 for r in keyed) // limit)
    order = []
    for bucket in range(buckets):
        held = sorted(((r["key"], r["doc_id"]) for r in keyed if r["key"] % buckets == bucket))
        order += [held[i][1] for i in np.random.default_rng([17, bucket]).permutation(len(held))]
    shards = 7
    want, n = {}, len(order)
    for rank, doc in enumerate(order):
        shard = rank * shards // n
        want[doc] = (shard, rank - -(-shard * n // shards))
    got = sharding.shuffle_into_shards(docs, shards, bucket_bytes=limit).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want and buckets > 3
    assert len(rows(f"SELECT doc_id FROM '{DATA}/documents.parquet'")) == n
