import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DATA, components, leaks, rows
from tickloom.llm import (ann, decontaminate, language, line_dedup, near_dedup, packing, queries,
                          sharding, training_order, url_filter, warc)
from tickloom.llm.components import connected_components
from tickloom.llm.fm_index import FMIndex

DOC = "doc_id long, text string, lang string, n_lines string, piece string, kept string, slot string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, copies, and columns named like results."""
    long_text = " ".join(f"word{i % 977} thing{i % 13}" for i in range(30_000))
    texts = [None, "", " \t\n", "Same line of text here\nother one", "same LINE of text here  ",
             long_text, long_text + " end", "one", "ONE", "1234 !!!", "Çà Émile ÀÉ x y z w",
             "a b c d e f g h i j k l m n", "a b c d e f g h i j k l m n"]
    data = [(i, t, "en" if i % 2 else None, "x", "y", "z", "w") for i, t in enumerate(texts)]
    data += [data[3], data[11], (None, "Same line of text here", None, None, None, None, None)]
    return spark.createDataFrame(data, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def documents():
    return rows(f"SELECT doc_id, text FROM '{DATA}/documents.parquet' ORDER BY doc_id")


def result(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, DATA).collect()]


def test_sql_oracles(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        want = con.execute(sql).fetchdf()
        got = queries.QUERIES[name](spark, DATA).toPandas()[list(want.columns)]
        as_set = [Counter(tuple(None if pd.isna(v) else int(v) if isinstance(v, float) else v
                                for v in row) for row in f.itertuples(index=False, name=None))
                  for f in (got, want)]
        assert len(got) == len(want), name
        assert as_set[0] == as_set[1], name


def test_line_dedup_cases(spark, odd, empty):
    out = line_dedup.drop_repeated_lines(odd)
    assert "n_lines" in out.columns and out.columns.count("n_lines") == 1
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append((r["text"], r["n_lines"], r["n_dropped"]))
    assert got[0] == [(None, 1, 0)] and got[1] == [("", 1, 0)]
    assert got[3] == [("Same line of text here\nother one", 2, 0)] * 2  # holder, row repeated
    assert got[4] == [("", 1, 1)]
    assert got[None] == [("Same line of text here", 1, 0)]
    assert got[11] == [("a b c d e f g h i j k l m n", 1, 0)] * 2 and got[12] == [("", 1, 1)]
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    more = line_dedup.drop_repeated_lines(odd, min_docs=3)
    assert more.agg(F.sum("n_dropped")).first()[0] == 0


def test_feistel_is_a_bijection():
    for size in (1, 2, 3, 17, 1000, 4097):
        out = training_order.feistel(np.arange(size), size, 99)
        assert sorted(out.tolist()) == list(range(size))
        assert (training_order.feistel(out, size, 99, back=True) == np.arange(size)).all()
    assert (training_order.feistel(np.arange(1000), 1000, 1)
            != training_order.feistel(np.arange(1000), 1000, 2)).any()


def test_training_order_round_trip(spark, odd, empty, tmp_path):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(queries.tokenizer())
    plain.encode_special_tokens = True
    folder = str(tmp_path / "shards")
    manifest = training_order.write_training_order(odd, queries.tokenizer(), stride=64,
                                                   per_shard=16, folder=folder)
    held = {r["slot"]: r for r in manifest.collect()}
    ids = {r["slot"]: np.frombuffer(r["ids"], "<u2") for r in training_order.read_slots(
        spark, folder, stride=64, per_shard=16).collect()}
    assert sorted(ids) == sorted(held) == list(range(len(ids)))
    documents_back, stream = defaultdict(list), {}
    for slot, r in held.items():
        assert training_order.feistel(np.array([r["sequence"]]), len(ids), 2024)[0] == slot
        stream[r["sequence"]] = ids[slot][:r["n_tokens"]]
    whole = np.concatenate([stream[i] for i in range(len(ids))]).tolist()
    want = Counter(tuple([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0])
                   for r in odd.collect())
    assert len(whole) == sum(len(k) * n for k, n in want.items())
    at, current = [], []
    for r in sorted(held.values(), key=lambda r: r["sequence"]):
        for doc, start, size in zip(r["doc_ids"], r["doc_starts"], r["doc_lengths"]):
            documents_back[doc] += ids[r["slot"]][start:start + size].tolist()
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r["doc_id"]] += [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0]
    assert {k: sorted(v) for k, v in documents_back.items()} == {k: sorted(v) for k, v in texts.items()}
    # Another split of the rows gives the same shards and manifest.
    again = str(tmp_path / "again")
    other = training_order.write_training_order(odd.repartition(5).coalesce(3), queries.tokenizer(), stride=64,
                                                per_shard=16, folder=again)
    assert {r["slot"]: r for r in other.collect()} == held
    assert {r["slot"]: r["ids"] for r in training_order.read_slots(
        spark, again, stride=64, per_shard=16).collect()} == {s: x.tobytes() for s, x in ids.items()}
    part = training_order.read_slots(spark, folder, 5, 40, 64, 16)
    assert {r["slot"] for r in part.collect()} == set(range(5, 40))
    assert training_order.write_training_order(empty, queries.tokenizer()).count() == 0


def test_fm_index_against_scan():
    rng = np.random.default_rng(0)
    for _ in range(30):
        seq = np.concatenate([np.append(rng.integers(1, 5, rng.integers(1, 30)), 0)
                              for _ in range(rng.integers(1, 20))]).astype(np.int32)
        index, sizes = FMIndex(seq, 5), rng.integers(1, 7, 20)
        patterns = np.where(np.arange(6) < sizes[:, None], rng.integers(1, 5, (20, 6)), 0)
        first, behind = index.search(patterns, sizes)
        for p, n, a, b in zip(patterns, sizes, first, behind):
            want = [i for i in range(len(seq) - n + 1) if (seq[i:i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_decontaminate_against_scan(spark):
    items = rows(f"SELECT item_id, text FROM '{DATA}/benchmark.parquet'")
    got = {r["doc_id"]: r for r in result(spark, "op3_decontaminate")}
    docs = documents()
    assert sum(r["contaminated"] for r in got.values()) > 0
    for i, text in docs:
        n, hit, held = leaks(text, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == \
            (n, len(hit), len(held), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(held).encode()).hexdigest()


def test_decontaminate_cases(spark, odd, empty):
    bench = spark.createDataFrame([(1, "B C d e"), (2, None), (3, "!!"), (4, "one"),
                                   (5, "c d e f g h i j k l m")], "item_id long, text string")
    whole = decontaminate.find_leaks(odd, bench).collect()
    blocks = decontaminate.find_leaks(odd, bench, block_words=1).collect()
    assert Counter(map(str, whole)) == Counter(map(str, blocks))
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    for r in whole:
        n, hit, held = leaks(r["text"], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), held)
    cut = {r["doc_id"]: r["text"] for r in decontaminate.find_leaks(
        odd, bench, block_words=1, cut=True).collect()}
    assert cut[11] == "a \n n" and cut[7] == "\n" and cut[0] is None
    assert decontaminate.find_leaks(odd, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.find_leaks(empty, bench).count() == 0


def test_url_filter_cases(spark):
    urls = [None, "", "no-scheme.org/x", "http://org/x", "http://a.org", "http://a.org/",
            "HTTP://U@EXAMPLE.org:80/es/", "http://example.org/es/q", "http://www.example.org/en/12",
            "http://notexample.org/en/1", "http://x.com/fr/a", "http://x.com/de/a", "http://x.com/DE/",
            "http://spam-farm.net/a", "http://x.net/Casino?y", "http://x.net/casinos",
            "http://x.net/#casino", "http://x.net/cart/checkout/", "http://a.org/\nb"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)] + [(3, urls[3], "v")],
                                  "page_id long, url string, verdict string")
    out = url_filter.judge_urls(pages, url_filter.rule_table(spark))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["pattern"], r["verdict"])
           for r in out.collect()}
    assert out.count() == len(urls) + 1 and out.columns.count("verdict") == 1
    assert got[0] == got[1] == got[2] == ("", "", None, None, "allow")
    assert got[4] == ("a.org", "", None, None, "allow") and got[5][2] == "org/"
    assert got[6][:2] == ("u@example.org:80", "/es/") and got[6][2] is None
    assert got[7][2:] == ("example.org/es/", None, "block")
    assert got[8][2] == "example.org/en/1" and got[9][2] == "org/"
    assert got[10][4] == "allow" and got[11][4] == "block" and got[12][2] is None
    assert got[13][3:] == ("spam_farm", "block") and got[14][3] == "casino"
    assert got[15][3] is None and got[16][3] is None and got[17][3] == "cart"
    assert got[18][1] == "/\nb"
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    none = url_filter.rule_table(spark, [], [])
    assert url_filter.judge_urls(pages, none).where("verdict <> 'allow'").count() == 0


def check_packing(out, docs):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(queries.tokenizer())
    plain.encode_special_tokens = True
    pieces, places = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for places_of in places.values():
        end = 0
        for offset, length in sorted(places_of):
            assert offset == end
            end += length
        assert end <= 2048
    assert set(pieces) == {d for d, _ in docs}
    for doc, text in docs:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        found = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(-(-len(ids) // 2048)))
        assert all(r["length"] == 2048 for r in found[1:])
        for r in found:
            a, b = r["start"], r["start"] + r["length"]
            assert zlib.crc32(ids[a:b].tobytes()) == r["ids_crc32"]
        assert sum(r["length"] for r in found) == len(ids)
    return len(places), -(-sum(r["length"] for r in out) // 2048)


def test_packing(spark, empty):
    used, least = check_packing(result(spark, "op5_packing"), documents())
    assert used <= least * 1.01 + 1
    assert packing.pack_documents(empty, queries.tokenizer()).count() == 0


def test_packing_cases(spark, odd):
    one = odd.dropDuplicates(["doc_id"])
    out = [r.asDict() for r in packing.pack_documents(one, queries.tokenizer()).collect()]
    check_packing(out, [(r["doc_id"], r["text"]) for r in one.collect()])
    # Repeated rows and null ids beside ids that a double does not hold.
    big = odd.union(odd).withColumn("doc_id", F.col("doc_id") + (1 << 53))
    out = [r.asDict() for r in packing.pack_documents(big, queries.tokenizer(), group=7).collect()]
    ids = Counter(r["doc_id"] for r in big.collect())
    assert Counter(r["doc_id"] for r in out if r["piece"] == 0) == ids
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_near_dedup_against_all_pairs(spark):
    want = components(documents(), 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result(spark, "op6_near_dedup")}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_near_dedup_cases(spark, odd, empty):
    got = defaultdict(set)
    for r in near_dedup.near_duplicates(odd, 85).collect():
        got[r["doc_id"]].add((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[0] == {(0, 0, True)} and got[2] == {(0, 2, True)}
    assert got[7] == {(1, 7, True)} and got[8] == {(1, 7, False)}
    assert {c for _, c, _ in got[6]} == {5} and {c for _, c, _ in got[12]} == {11}
    assert got[None] == {(1, None, True)}
    assert near_dedup.near_duplicates(empty).count() == 0
    kept = [r["doc_id"] for r in near_dedup.keep_one(odd, 85).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [0, 1, 2, 3, 3, 4, 5, 7, 9, 10, 11, 11, None]))


def test_near_dedup_random_variants(spark):
    """Chains and groups of near copies around the limit, and texts that share a long part."""
    rng = np.random.default_rng(5)
    shared = [f"s{i}" for i in range(60)]
    docs = []
    for group in range(12):
        base = [f"g{group}w{rng.integers(500)}" for _ in range(int(rng.integers(6, 160)))]
        for _ in range(14):
            words = list(base)
            for _ in range(int(rng.integers(0, 3))):
                words[rng.integers(len(words))] = f"x{rng.integers(9)}"
            docs.append((len(docs), " ".join(words)))
    docs += [(len(docs) + i, " ".join([*shared, *(f"y{i}z{k}" for k in range(int(n)))]))
             for i, n in enumerate(rng.integers(1, 60, 60))]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string"), 85).collect()}
    assert got == components(docs, 85)


def test_prefixes_hold_the_rarest_shingles_of_all_open_documents(spark):
    words = lambda name, n: " ".join(f"{name}x{i}" for i in range(n))
    texts = [f"{words(f'own{i}', 40)} {words(f'both{i // 2}', 40)}" for i in range(40)]
    texts += [words("near", 60), words("near", 60) + " tail", words("near", 59)]
    docs = [(i, t) for i, t in enumerate(texts)]
    members = spark.createDataFrame([(1, i, 0) for i, _ in docs], "key long, node long, center long")
    alone = spark.createDataFrame([], "node long, component long")
    texts = spark.createDataFrame(docs, "node long, text string")
    got = {tuple(r) for r in near_dedup._across(members, alone, texts, 80).collect()}
    assert got == {(41, 40), (42, 40), (42, 41)}  # those that share 40 of 80 words make no pair


def test_estimate_follows_jaccard():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.9):
        both = rng.integers(0, 1 << 63, 4000, np.uint64) * np.uint64(2)
        n = int(4000 * share)
        sets = [np.unique(np.concatenate([both[:n], rng.integers(0, 1 << 63, 4000 - n, np.uint64)
                                          * np.uint64(2)])) for _ in range(2)]
        hashes = np.concatenate(sets)
        rows_ = near_dedup.sketches(hashes, np.array([0, len(sets[0]), len(hashes)]))
        got, used = near_dedup.estimate(rows_[:1], rows_[1:], np.array([4000]), np.array([4000]))
        assert used[0] == near_dedup.REGISTERS and abs(got[0] - share / (2 - share)) < 0.12


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (200, 201)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(30))
    assert got[201] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    truth = dict(rows(f"SELECT doc_id, lang FROM '{data}/documents.parquet'"))
    got = queries.QUERIES["op7_language"](spark, data).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_language_cases(spark, odd, empty):
    train = spark.createDataFrame(
        [(1, "the house and the garden of the king", "en"), (2, "le roi et la maison dans le jardin", "fr"),
         (3, "дом и сад царя на реке", "ru"), (4, None, "xx"), (5, "no label", None)],
        "doc_id long, text string, lang string")
    model = language.learn(train)
    assert model.languages == ["en", "fr", "ru"]
    out = {r["doc_id"]: r for r in language.detect(odd, model, spans=True).collect()}
    assert out[0]["lang_pred"] == out[1]["lang_pred"] == out[9]["lang_pred"] == "und"
    assert out[0]["score"] == 0 and out[10]["lang_pred"] in model.languages
    mixed = spark.createDataFrame([(1, "the king and the house дом и сад the garden"), (2, "漢字")],
                                  "doc_id long, text string")
    spans = language.detect(mixed, model, spans=True, switch=3.0).collect()
    assert [s["lang"] for s in spans[0]["spans"]] == ["en", "ru", "en"]
    assert (spans[0]["spans"][1]["start"], spans[0]["spans"][1]["end"]) == (23, 32)
    assert spans[1]["lang_pred"] in model.languages
    assert language.detect(empty, model).count() == 0
    nothing = language.learn(train.limit(0))
    assert {r["lang_pred"] for r in language.detect(odd, nothing).collect()} == {"und"}


def test_best_path_against_all_paths():
    from itertools import product
    rng = np.random.default_rng(2)
    scores = rng.normal(size=(11, 3))
    first = np.array([0, 4, 4, 5, 11])
    got = language.best_path(scores, first, 0.7)
    for a, b in zip(first[:-1], first[1:]):
        value = lambda p: sum(scores[a + i, x] for i, x in enumerate(p)) \
            - 0.7 * sum(x != y for x, y in zip(p, p[1:]))
        if b > a:
            best = max(product(range(3), repeat=int(b - a)), key=value)
            assert tuple(got[a:b]) == best


def test_best_path_of_many_languages():
    scores, first = np.full((6, 300), -9.0), np.array([0, 4, 6])
    want = [299, 299, 130, 130, 200, 200]
    scores[np.arange(6), want] = 0
    got = language.best_path(scores, first, 2.0)
    assert got.tolist() == want
    assert language.best_path(scores[:, :128], first, 2.0).max() <= 127


def test_warc_cases(spark, tmp_path):
    big = "<p>" + "ü\r\n\r\nWARC/1.1\r\n" * 30
    pages = spark.createDataFrame(
        [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (2, "http://b/", big), (1, "u", big),
         (3, None, None), (4, "http://c", "short"), (5, "http://c", "short"), (None, "http://d", big)],
        "page_id long, url string, html string")
    folder = warc.write_archive(pages, str(tmp_path / "w"))
    back = warc.read_archive(spark, folder)
    got = [(warc_id(r["record_id"]), r["record_type"], warc_id(r["refers_to"]),
            None if r["payload"] is None else bytes(r["payload"]).decode()) for r in back.collect()]
    assert Counter(got) == Counter([
        (1, "response", None, big), (1, "response", None, big), (2, "revisit", 1, None),
        (2, "revisit", 1, None), (3, "response", None, ""), (4, "response", None, "short"),
        (5, "response", None, "short"), (None, "response", None, big)])
    heads = warc.read_archive(spark, folder, payload=False).where("record_type = 'revisit'")
    assert {(r["http_length"], r["payload"]) for r in heads.collect()} == {(len(big.encode()), None)}
    # The source has taken the filter: Spark's own would stand above the scan.
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "= revisit" not in plan.split("BatchScan")[0]
    kept = back.where("http_length = 3")._jdf.queryExecution().executedPlan().toString()
    assert "= 3" in kept.split("BatchScan")[0]
    one = back.where("target_uri = 'http://c' and record_id = '<urn:page:5>'")
    assert one.count() == 1
    none = warc.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, none).count() == 0


def warc_id(text):
    number = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def test_warc_reader_skips_by_header(tmp_path):
    record = (b"WARC/1.1\r\nWARC-Type: %b\r\nWARC-Record-ID: <urn:page:%d>\r\n"
              b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n")
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    (tmp_path / "a.warc").write_bytes(b"".join(
        record % (kind, i, len(block), block) for i, kind in enumerate([b"response", b"metadata"])))
    reader = warc.WarcReader(str(tmp_path), True)
    from pyspark.sql.datasource import EqualTo, IsNotNull
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), IsNotNull(("payload",))]))
    assert len(left) == 1 and reader.wanted == {"warc-type": {"response"}}
    [part] = reader.partitions()
    [batch] = list(reader.read(part))
    assert batch.num_rows == 1 and batch.column("payload")[0].as_py() == b"abc"


def check_shards(got, want, shards=24):
    counts = Counter(r["shard"] for r in got)
    assert len(got) == want
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))


def test_sharding(spark, odd, empty):
    got = result(spark, "op9_sharding")
    docs = dict(documents())
    check_shards(got, len(docs))
    for r in got:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert sorted(order) == sorted(docs) and np.corrcoef(order, range(len(order)))[0, 1] < 0.3
    small = [r.asDict() for r in sharding.shuffle_into_shards(odd, 5, bucket_bytes=100_000).collect()]
    check_shards(small, odd.count(), 5)
    again = [r.asDict() for r in sharding.shuffle_into_shards(odd.repartition(7), 5, bucket_bytes=100_000).collect()]
    key = lambda r: (str(r["doc_id"]), r["shard"], r["slot"])
    assert sorted(map(key, small)) == sorted(map(key, again))
    assert sharding.shuffle_into_shards(empty, 5).count() == 0


def test_neighbours_recall(spark):
    data = rows(f"SELECT vec_id, embedding FROM '/root/testdata/sf0.01/embeddings.parquet'")
    ids, points = np.array([d[0] for d in data]), np.array([d[1] for d in data], float)
    got = queries.QUERIES["op10_neighbours"](spark, "/root/testdata/sf0.01").collect()
    found, total = 0, 0
    for q in ids[ids % 100 == 0]:
        score = np.sqrt(((points - points[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, score)) if ids[i] != q][:10]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        for r in mine:
            assert r["score"] == pytest.approx(score[ids == r["vec_id"]][0], abs=1e-12)
        assert [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        found += len({r["vec_id"] for r in mine} & set(ids[order].tolist()))
        total += 10
    assert found / total >= 0.9


def test_neighbours_cases(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (7, [0.5, 0.5]), (100, [1.0, 0.0]), (8, [1.0]),
            (None, [1.0, 0.0]), (9, [])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = ann.nearest(frame, frame.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [
        (0, 1, 1), (0, 2, 100), (0, 3, 7), (100, 1, 0), (100, 2, 1), (100, 3, 7)]
    assert ann.nearest(frame.limit(0), frame).count() == 0
    assert ann.nearest(frame, frame.limit(0)).count() == 0


def test_neighbours_of_repeated_queries(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERIES", 2)
    rng = np.random.default_rng(8)
    data = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 8)))]
    asked = [data[0]] * 3 + [data[1]] * 2 + [data[2], (2, data[3][1])]
    frame, queries_ = (spark.createDataFrame(x, "vec_id long, embedding array<double>")
                       for x in (data, asked))
    got = [tuple(r) for r in ann.nearest(frame, queries_, spread=9.0).collect()]
    want = []
    for i, v in {(i, tuple(v)) for i, v in asked}:
        near = sorted((np.sqrt(((np.array(w) - v) ** 2).sum()), j) for j, w in data if j != i)
        want += [(i, rank, j, score) for rank, (score, j) in enumerate(near[:10], 1)]
    assert len(got) == len(want) == 40
    assert sorted(r[:3] for r in got) == sorted(r[:3] for r in want)
    assert np.allclose([r[3] for r in sorted(got)], [r[3] for r in sorted(want)])


def test_multi_index_finds_every_code_within():
    rng = np.random.default_rng(4)
    codes, asked = rng.integers(0, 256, (500, 4), np.uint8), rng.integers(0, 256, (20, 4), np.uint8)
    for radius in (0, 3, 7, 11):
        got = ann.MultiIndex(codes).within(asked, np.full(20, radius))
        far = np.bitwise_count(asked[:, None] ^ codes[None]).sum(2)
        assert (got == (far <= radius)).all()


def test_words_and_packing_rule():
    assert struct.pack("<I", 1) == np.array([1], "<u4").tobytes()
    place, offset = packing.sum_of_squares(np.array([6, 4, 5, 5, 10, 3]), 10)
    bins = defaultdict(int)
    for b, n in zip(place.tolist(), [6, 4, 5, 5, 10, 3]):
        bins[b] += n
    assert max(bins.values()) <= 10 and len(bins) == 4
    assert pa.array(offset).null_count == 0
