"""Alignment of two tokenizers over a corpus, each distinct text once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import CHUNK, small_batches, text_bytes, text_chunks
from tickloom.llm.pieces import ByteTable, PieceModel, piece_model, take_runs
from tickloom.llm.tokens import encoder
from tickloom.session import staged

#: Id pairs that may be broadcast: 24 bytes each, so 24 MB; more go through a shuffle.
BROADCAST_PAIRS = 1_000_000
MEASURES = ("n_a", "n_b", "n_groups")
_SCHEMA = ("key binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, "
           "pairs array<bigint>, times array<bigint>")


@dataclass
class Aligned:
    """One text: its measures, its groups as a string and the hash of it, and its id pairs with
    counts. Without tokens there is no hash."""

    n: np.ndarray = field(default_factory=lambda: np.zeros(3, np.int64))
    string: bytes = b""
    state: object = None
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def digest(self) -> str:
        return self.state.hexdigest() if self.state else ""


class Aligner:
    """Tokens of a byte-level BPE (A) and a SentencePiece model (B), cut into groups by the byte
    places where tokens of both end. Both read a text with a space put in front."""

    def __init__(self, byte_bpe: str, model: str):
        self.a = encoder(byte_bpe)
        self.b: PieceModel = piece_model(model)
        tokens = [b""] * self.a.n_vocab
        for token in self.a.token_byte_values():
            tokens[self.a.encode_single_token(token)] = token
        self.a_bytes = ByteTable(tokens)
        own = self.b.processor
        self.b_bytes = ByteTable([
            bytes([int(p[3:5], 16)]) if own.is_byte(i) else p.replace("▁", " ").encode()
            for i in range(self.b.size) for p in [own.id_to_piece(i)]])
        self.b_size = self.b.size
        self.width = len(str(max(len(tokens), self.b.size) - 1))
        self.digits = np.zeros((max(len(tokens), self.b.size), self.width + 1), np.uint8)
        for i, row in enumerate(self.digits):
            row[:len(str(i))] = np.frombuffer(str(i).encode(), np.uint8)

    def align(self, texts: list[str]) -> list[Aligned]:
        """An entry per text, which is not empty; without tokens where either tokenizer's bytes
        are not the text's."""
        if len(texts) > 1 or len(texts[0]) <= CHUNK:
            return self._align([" " + t for t in texts])
        whole = Aligned()
        for part in _parts(" " + texts[0]):
            one, = self._align([part])
            if not one.state:
                return [Aligned()]
            whole.n += one.n
            if whole.state:
                whole.state.update(b";")
                whole.state.update(one.string)
            else:
                whole.state = one.state
            whole.pairs, at = np.unique(np.concatenate([whole.pairs, one.pairs]), return_inverse=True)
            whole.times = np.bincount(at, np.concatenate([whole.times, one.times])).astype(np.int64)
        return [whole]

    def _align(self, spaced: list[str]) -> list[Aligned]:
        source, offsets = text_bytes(pa.array(spaced, pa.large_string()))
        a = [np.array(self.a.encode_ordinary(t), np.int64) for t in spaced]
        a_counts = np.array([len(x) for x in a])
        a_ids = np.concatenate(a)
        b_ids, b_counts = self.b.encode(pa.array([t[1:] for t in spaced], pa.large_string()))
        good = (self._same(source, offsets, a_ids, a_counts, self.a_bytes)
                & self._same(source, offsets, b_ids, b_counts, self.b_bytes))
        out = [Aligned() for _ in spaced]
        if not good.any():
            return out
        a_ids, b_ids = a_ids[np.repeat(good, a_counts)], b_ids[np.repeat(good, b_counts)]
        a_counts, b_counts = a_counts[good], b_counts[good]
        a_ends, b_ends = np.cumsum(self.a_bytes.sizes[a_ids]), np.cumsum(self.b_bytes.sizes[b_ids])
        both = np.zeros(int(a_ends[-1]) + 1, np.int8)
        both[a_ends] = 1
        both[b_ends] += 1
        a_last, b_last = both[a_ends] == 2, both[b_ends] == 2
        # Links: the tokens that end a group, of which each text has its own run.
        text_of = np.repeat(np.arange(len(a_counts)), a_counts)[a_last]
        links = np.bincount(text_of, minlength=len(a_counts))
        pairs = a_ids[a_last] * self.b_size + b_ids[b_last]
        keyed, times = np.unique(text_of << 40 | pairs, return_counts=True)
        edges = np.searchsorted(keyed, np.arange(len(a_counts) + 1) << 40)
        strings = self._strings(a_ids, a_counts, a_last, b_ids, b_counts, b_last)
        for i, at in enumerate(np.flatnonzero(good)):
            mine = slice(edges[i], edges[i + 1])
            one = out[at]
            one.n = np.array([a_counts[i], b_counts[i], links[i]])
            one.string, one.state = strings[i], hashlib.sha256(strings[i])
            one.pairs, one.times = keyed[mine] & ((1 << 40) - 1), times[mine]
        return out

    @staticmethod
    def _same(source: np.ndarray, offsets: np.ndarray, ids: np.ndarray, counts: np.ndarray,
              table: ByteTable) -> np.ndarray:
        """Whether each text's tokens hold its bytes."""
        sizes = table.sizes[ids]
        before = np.concatenate([[0], np.cumsum(sizes)])
        begins = before[np.concatenate([[0], np.cumsum(counts)])]
        written = take_runs(table.data, table.begins[ids], sizes)
        if len(written) == len(source) and (begins == offsets).all():
            wrong = np.flatnonzero(written != source)
            good = np.ones(len(counts), bool)
            good[np.searchsorted(offsets, wrong, "right") - 1] = False
            return good
        return np.array([np.array_equal(written[begins[i]:begins[i + 1]],
                                        source[offsets[i]:offsets[i + 1]]) for i in range(len(counts))])

    def _strings(self, a_ids, a_counts, a_last, b_ids, b_counts, b_last) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text: a group's A ids, then its B ids."""
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        a_through = np.flatnonzero(a_last) + 1  # A ids up to and with each group
        b_through = np.flatnonzero(b_last) + 1
        a_at = np.arange(len(a_ids)) + np.concatenate([[0], b_through])[a_group]
        b_at = np.arange(len(b_ids)) + a_through[b_group]
        rows = np.zeros((len(a_ids) + len(b_ids), self.width + 1), np.uint8)
        for ids, at, last, end in ((a_ids, a_at, a_last, "|"), (b_ids, b_at, b_last, ";")):
            rows[at] = self.digits[ids]
            rows[at, self.width] = np.where(last, ord(end), ord(","))
        ends = np.cumsum((rows != 0).sum(1))[np.cumsum(a_counts + b_counts) - 1]
        data = rows.ravel()
        data = data[data != 0].tobytes()
        return [data[start:end - 1] for start, end in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _parts(text: str, limit: int = CHUNK) -> Iterator[str]:
    """A long text in parts, cut before a single space between other characters: no token of
    either tokenizer reaches across, and every part begins with a space."""
    at = 0
    while len(text) - at > limit:
        to = at + limit // 2
        while True:
            to = text.find(" ", to)
            if to < 0:
                yield text[at:]
                return
            if to > at and not text[to - 1].isspace() and to + 1 < len(text) \
                    and not text[to + 1].isspace():
                break
            to += 1
        yield text[at:to]
        at = to
    yield text[at:]


@lru_cache(maxsize=2)
def aligner(byte_bpe: str, model: str) -> Aligner:
    return Aligner(byte_bpe, model)


def align_tokenizers(docs: DataFrame, byte_bpe: str, model: str, id_col: str = "doc_id",
                     text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Rows are shuffled by their full text, so that each distinct text is tokenised and aligned once
    and a group of copies is one row per task before the shuffle. The links of a text (the A and B
    token that end a group) are counted in it, times its copies, and summed per id pair over the
    corpus. ``n_best`` counts the links whose pair is the most frequent of its B id, ties included;
    ``count_sum`` adds up the pairs' counts. The measures then join the rows by SHA-256 of the text.

    The pair table is broadcast up to ``broadcast_pairs`` rows, and joined by a shuffle beyond.
    Texts are handled some megabytes at a time; a longer one in parts.

    Defined cases: a null or empty text, or one whose bytes either tokenizer does not give back
    behind a space, has zeros and an empty string and counts for no pair. Repeated rows and null
    ids stay rows of their own. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    distinct = (rows.where(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("copies"))
                .select("text", _key().alias("key"), "copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            found = aligner(byte_bpe, model).align(batch.column("text").to_pylist())
            offsets = np.cumsum([0, *(len(x.pairs) for x in found)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(
                np.concatenate([getattr(x, name) for x in found]), pa.int64()))
                for name in ("pairs", "times")]
            numbers = np.array([x.n for x in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copies"),
                 *[pa.array(numbers[:, i], pa.int64()) for i in range(3)],
                 pa.array([x.digest() for x in found], pa.string()), *lists],
                ["key", "copies", *MEASURES, "groups_sha256", "pairs", "times"])

    aligned = staged(distinct.mapInArrow(run, _SCHEMA), "aligned")
    linked = aligned.select("key", "copies", F.explode(F.arrays_zip("pairs", "times")).alias("x")) \
        .select("key", "copies", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = staged(linked.groupBy("pair").agg(
        F.sum(F.col("times") * F.col("copies")).alias("count")), "pair_counts")
    size = piece_model(model).size
    best = counts.groupBy((F.col("pair") % size).alias("b")).agg(F.max("count").alias("most"))
    judged = staged(counts.withColumn("b", F.col("pair") % size).join(best, "b").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")), "judged_pairs")
    if judged.count() <= broadcast_pairs:
        judged = F.broadcast(judged)
    sums = (linked.join(judged, "pair").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum")))
    measures = staged(aligned.drop("pairs", "times", "copies").join(sums, "key", "left"), "measures")
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", _key().alias("key")).join(measures, "key", "left").select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in MEASURES],
        F.coalesce("n_groups", zero).alias("n_links"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def _key():
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))
