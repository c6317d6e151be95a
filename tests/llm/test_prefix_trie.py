"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb

from tests.llm.brute import DATA
from tickloom.llm import prefix_trie, queries

FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
          "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn int, role string, text string, pos string, t0 string, conv int, block int"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, key, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, ends = defaultdict(set), defaultdict(list)
    for c, q in sorted(whole.items()):
        ends[q].append(c)
        for d in range(len(q) + 1):
            members[q[:d]].add(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def found(turns):
    out = prefix_trie.prefix_trie(*prefix_trie.share_heads(prefix_trie.ordered_turns(turns)))
    assert tuple(out.columns) == FIELDS and {k for _, k in out.dtypes} == {"bigint", "string"}
    return Counter(map(tuple, out.collect()))


def test_random_conversations(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(5, None, None, None), (5, 0, "user", "x"), (7, 3, None, "é漢"), (7, 3, "a", "b"),
            (7, 3, "a", "b"), (None, 1, "user", "lost"), (9, 1, "", ""), (8, 1, None, None)]
    for c in range(20, 90):  # many share their first turns; some are copies, some have 40 turns
        kind = rng.choice([0, 1, 1, 2])
        for t in range(rng.choice([1, 2, 8, 9, 16, 17, 40]) if kind else 3):
            rows.append((c, t, "user" if t % 2 else "bot", f"say {t} {'' if kind < 2 else rng.randrange(3)}"))
    extra = ("p", "q", 1, 2)
    for run, ids in ((4096, 16_384), (2, 3)):  # with small runs and strings, too
        monkeypatch.setattr(prefix_trie, "RUN", run)
        monkeypatch.setattr(prefix_trie, "IDS", ids)
        rng.shuffle(rows)
        assert found(spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)) == plain(rows)


def test_one_hot_conversation_and_copies(spark):
    rows = [(10, t, "user", f"long {t % 7}") for t in range(600)]
    rows += [(c, t, "bot", f"copy {t}") for c in range(100, 160) for t in range(4)]
    assert found(spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)) == plain(rows)


def test_empty(spark):
    assert not found(spark.createDataFrame([], SCHEMA))
    assert not found(spark.createDataFrame([(None, 1, "a", "b", "", "", 1, 1)], SCHEMA))


def test_query_and_its_sql(spark):
    got = Counter(map(tuple, queries.QUERIES["op13_prefix_trie"](spark, DATA).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    assert got == Counter(con.execute(queries.ORACLES["op13_prefix_trie"]).fetchall())
    assert got == plain(con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())
