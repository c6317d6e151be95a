"""Alignment of tokenizers against a plain version on the libraries' own tokens."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.brute import DATA, rows
from tickloom.llm import alignment, queries
from tickloom.llm.tokens import _byte_letters

FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(queries.tokenizer())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    letters = _byte_letters()

    def one(text):
        whole = (" " + (text or "")).encode()
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_parts = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return 0, 0, [], []
        a_ends, b_ends = ends(a_parts), ends(b_parts)
        links = [(i, j) for i, end in zip(a_ids, a_ends) for j, e in zip(b_ids, b_ends) if e == end] \
            if len(a_ids) < 500 else [(x, y) for e in sorted({*a_ends} & {*b_ends})
                                      for x, y in [(a_ids[a_ends.index(e)], b_ids[b_ends.index(e)])]]
        groups, i, j = [], 0, 0
        for e in sorted({*a_ends} & {*b_ends}):
            k, n = a_ends.index(e) + 1, b_ends.index(e) + 1
            groups.append(",".join(map(str, a_ids[i:k])) + "|" + ",".join(map(str, b_ids[j:n])))
            i, j = k, n
        return len(a_ids), len(b_ids), groups, links

    def ends(parts):
        out = []
        for p in parts:
            out.append((out[-1] if out else 0) + len(p))
        return out

    def run(docs):
        each = [(i, *one(t)) for i, t in docs]
        counts = Counter(link for *_, links in each for link in links)
        most = Counter()
        for (_, y), n in counts.items():
            most[y] = max(most[y], n)
        return Counter(
            (i, a, b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
             sum(counts[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for i, a, b, groups, links in each)
    return run


def found(frame, **limits):
    out = alignment.align_tokenizers(frame, queries.tokenizer(), queries.piece_model(), **limits)
    return Counter(tuple(r[c] for c in FIELDS) for r in out.collect())


def test_cases(spark, plain, monkeypatch):
    rng = random.Random(2)
    parts = ["the ", "house", " of", "\n", "\n\n", "  ", "é", "漢字", "🙂", "don't", "123", "</s>", "<s>",
             "<|endoftext|>", "x", "ing ", "\t", ",", "."]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(60)]
    texts += [None, "", " ", "a▁b", "▁", "<0x41>", "\x00", " lead", "trail ", texts[0], texts[0], texts[1]]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[2]), (None, None)]
    frame = spark.createDataFrame([(*d, 1, "x", "y") for d in docs],
                                  "doc_id long, text string, n_a int, key string, copies string")
    want = plain(docs)
    assert found(frame) == want
    assert found(frame, broadcast_pairs=0) == want  # the pair table goes through a shuffle
    assert not found(frame.limit(0))
    assert found(frame.where("text IS NULL")) == Counter({
        (i, 0, 0, 0, 0, 0, 0, ""): 1 for i, t in docs if t is None})


def test_long_texts_in_parts(plain, monkeypatch):
    text = " ".join(f"word{i % 31} and\n thing's  {i % 13}" for i in range(60)) + " last"
    own = alignment.Aligner(queries.tokenizer(), queries.piece_model())
    whole, = own.align([text])
    assert len(list(alignment._parts(" " + text, 50))) > 20
    split = alignment._parts
    monkeypatch.setattr(alignment, "CHUNK", 50)
    monkeypatch.setattr(alignment, "_parts", lambda t: split(t, 50))
    cut, = own.align([text])
    assert cut.digest() == whole.digest() and cut.n.tolist() == whole.n.tolist()
    assert cut.pairs.tolist() == whole.pairs.tolist() and cut.times.tolist() == whole.times.tolist()
    row, = plain([(1, text)])
    assert row[1:4] == tuple(cut.n.tolist()) and row[7] == cut.digest()
    assert own.align(["▁ " * 60])[0].digest() == ""


def test_query_over_documents(spark, plain):
    got = Counter(tuple(r[c] for c in FIELDS)
                  for r in queries.QUERIES["op12_alignment"](spark, DATA).collect())
    assert got == plain(rows(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'"))
