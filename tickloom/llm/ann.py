"""Nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import shared_folder

#: Code bits (substrings have 8 each), first Hamming radius, standard deviations of the bits that
#: two vectors differ in which the radius leaves room for, vectors to learn from, queries of a
#: broadcast block, rows that one index holds.
BITS, RADIUS, SPREAD, LEARN_ROWS, QUERIES, INDEX_ROWS = 128, 32, 1.65, 10_000, 4096, 16_384


@dataclass
class Coder:
    """Codes are the signs of the centred vector after each of several learned rotations."""

    mean: np.ndarray
    rotations: np.ndarray

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        return np.packbits((vectors - self.mean) @ self.rotations > 0, axis=1)


def learn_coder(vectors: np.ndarray, bits: int = BITS, rounds: int = 15, seed: int = 3) -> Coder:
    """Iterative quantisation: turn the principal axes until signs lose least, from a new random
    start for each set of ``dimension`` bits."""
    mean = vectors.mean(0) if len(vectors) else np.zeros(vectors.shape[1])
    centred = vectors - mean
    size = vectors.shape[1]
    _, axes = np.linalg.eigh(centred.T @ centred) if len(vectors) else (None, np.eye(size))
    projected, chance, turns = centred @ axes, np.random.default_rng(seed), []
    for _ in range(-(-bits // size)):
        turn = np.linalg.qr(chance.normal(size=(size, size)))[0]
        for _ in range(rounds if len(vectors) else 0):
            signs = np.where(projected @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ projected)
            turn = (left @ right).T
        turns.append(axes @ turn)
    return Coder(mean, np.concatenate(turns, axis=1)[:, :bits])


class MultiIndex:
    """Codes (rows of bytes) indexed by each byte: the rows of a byte value stand together."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable").T.copy()
        self.first = np.stack([np.searchsorted(codes[o, j], np.arange(257))
                               for j, o in enumerate(self.order)])

    def within(self, queries: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each query and row, whether the codes differ in the query's ``radius`` bits at
        most. If they do, some byte differs in ``radius // bytes`` bits at most, so only rows
        found by probing each byte's values that near are compared."""
        size, parts = len(self.codes), self.codes.shape[1]
        probes = _byte_flips(min(int(radius.max(initial=0)) // parts, 8))
        found = np.zeros((len(queries), size), bool)
        for j in range(parts):
            values = queries[:, j, None] ^ probes
            begin, end = self.first[j][values], self.first[j][values.astype(np.int64) + 1]
            count = (end - begin).ravel()
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) \
                + np.repeat(begin.ravel(), count)
            query = np.repeat(np.repeat(np.arange(len(queries)), len(probes)), count)
            found[query, self.order[j][at]] = True
        q, row = np.nonzero(found)
        far = np.bitwise_count(queries[q] ^ self.codes[row]).sum(1) > radius[q]
        found[q[far], row[far]] = False
        return found


def _byte_flips(most: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for n in range(most + 1)
                     for c in combinations(range(8), n)], np.uint8)


def nearest(frame: DataFrame, queries: DataFrame, k: int = 10, spread: float = SPREAD,
            bits: int = BITS, id_col: str = "vec_id", vector_col: str = "embedding",
            learn_rows: int = LEARN_ROWS) -> DataFrame:
    """For each query (id, vector) its ``k`` nearest rows of ``frame`` but its own id: query_id,
    rank (from 1), vec_id, score (Euclidean distance in double precision), ties to the smaller id.

    The rotations are learned from the ``learn_rows`` rows whose id hashes lowest. All rows are
    encoded and indexed, ``INDEX_ROWS`` at a time in the task that reads them. Queries come in
    blocks of ``QUERIES``, each a broadcast of fixed size and a pass over the rows. An index gives
    every code within a Hamming radius, which grows until it holds ``k`` rows (or all), and then
    to the bits in which a vector as far as the k-th best so far is expected to differ, and
    ``spread`` standard deviations more. Candidates are ranked by their vectors. A task hands on
    ``k`` rows a query, so neither a frequent vector nor a frequent code gathers anywhere.

    Defined cases: a null vector, one of another length than most, all zeros, or with a null or
    not finite component takes no part, as query or row; a null id takes no part; fewer than ``k``
    rows give all; a row that is stored twice counts twice; a query that is stored twice is asked
    once; an id with several vectors asks with each and has a list for each; no queries or no rows
    give no result.
    """
    spark = frame.sparkSession
    kind = "array<double>"
    rows, asked = (
        f.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
               & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)
                          & (F.abs(x) < float("inf")))
               & F.exists("v", lambda x: x != 0)) for f in (frame, queries))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), "size").first()
    folder = shared_folder(spark)
    schema = "query long, query_id long, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, asked = (f.where(F.size("v") == sizes["size"]) for f in (rows, asked))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(learn_rows).select("v").toPandas()
    coder = learn_coder(np.array(sample["v"].tolist()), bits)
    block: list[tuple[int, list[float]]] = []
    first = 0
    for row in asked.distinct().toLocalIterator():
        block.append((row["id"], row["v"]))
        if len(block) == QUERIES:
            _search(rows, block, first, coder, k, spread, schema).write.mode("append").parquet(folder)
            block, first = [], first + QUERIES
    if block:
        _search(rows, block, first, coder, k, spread, schema).write.mode("append").parquet(folder)
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return spark.read.schema(schema).parquet(folder).withColumn("rank", F.row_number().over(order)) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, block: list, first: int, coder: Coder, k: int, spread: float,
            schema: str) -> DataFrame:
    """The ``k`` nearest rows for each query of a block; ``first`` is the number of its first."""
    ids = np.array([i for i, _ in block])
    vectors = np.array([v for _, v in block])
    shared = rows.sparkSession.sparkContext.broadcast((ids, vectors, coder.encode(vectors), coder))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, points, codes, coder = shared.value
        bits = codes.shape[1] * 8
        spans = np.sqrt(((points - coder.mean) ** 2).sum(1))
        best = [(np.zeros(0), np.zeros(0, np.int64))] * len(asked)
        for batch in batches:
            for at in range(0, batch.num_rows, INDEX_ROWS):
                part = batch.slice(at, INDEX_ROWS)
                here = part.column("id").to_numpy()
                there = part.column("v").flatten().to_numpy().reshape(len(here), -1)
                index = MultiIndex(coder.encode(there))
                for q in range(0, len(asked), 256):
                    of = range(q, min(q + 256, len(asked)))
                    other = asked[of.start:of.stop, None] != here
                    radius = np.array([_radius(best[i][0], k, spans[i], spread, bits)
                                       for i in of])
                    found = _enough(index, codes[of.start:of.stop], other, k, radius)
                    seen = [_merge(*best[i], *_ranked(points[i], row, there, here), k)
                            for i, row in zip(of, found)]
                    wider = np.array([_radius(x[0], k, spans[i], spread, bits)
                                      for i, x in zip(of, seen)])
                    again = np.flatnonzero(wider > radius)
                    more = index.within(codes[of.start:of.stop][again], wider[again]) \
                        & other[again] & ~found[again]
                    for j, row in zip(again.tolist(), more):
                        seen[j] = _merge(*seen[j], *_ranked(points[q + j], row, there, here), k)
                    best[of.start:of.stop] = seen
        counts = [len(s) for s, _ in best]
        yield pa.RecordBatch.from_pydict({
            "query": pa.array(np.repeat(first + np.arange(len(asked)), counts)),
            "query_id": pa.array(np.repeat(asked, counts)),
            "vec_id": pa.array(np.concatenate([i for _, i in best])),
            "score": pa.array(np.concatenate([s for s, _ in best]))})

    parts = rows.mapInArrow(search, schema)
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .drop("rank")


def _radius(scores: np.ndarray, k: int, span: float, spread: float, bits: int) -> int:
    """The bits in which a vector may differ that is as near as the k-th best so far. Signs after
    a random rotation differ in a share of the angle; ``span`` is the query's distance from the
    centre."""
    if len(scores) < k:
        return RADIUS
    share = 2 / np.pi * np.arcsin(min(1.0, scores[k - 1] / (2 * span) if span else 1.0))
    return int(np.ceil(bits * share + spread * np.sqrt(bits * share * (1 - share))))


def _enough(index: MultiIndex, codes: np.ndarray, other: np.ndarray, k: int,
            radius: np.ndarray) -> np.ndarray:
    """The ``other`` rows within each query's radius; where these are fewer than ``k``, the radius
    grows (in place) until there are enough or all."""
    found = index.within(codes, radius) & other
    most = np.minimum(k, other.sum(1))
    while (few := np.flatnonzero(found.sum(1) < most)).size:
        radius[few] += codes.shape[1]
        found[few] = index.within(codes[few], radius[few]) & other[few]
    return found


def _ranked(point: np.ndarray, row: np.ndarray, there: np.ndarray, here: np.ndarray):
    near = np.flatnonzero(row)
    return np.sqrt(((there[near] - point) ** 2).sum(1)), here[near]


def _merge(score, ids, more, more_ids, k: int):
    score, ids = np.concatenate([score, more]), np.concatenate([ids, more_ids])
    order = np.lexsort((ids, score))[:k]
    return score[order], ids[order]
