"""Near-duplicates by HyperMinHash sketches, banding, and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import BLANKS, Words, mix, small_batches, text_chunks
from tickloom.llm.components import connected_components
from tickloom.session import staged

#: Words of a shingle; registers of a sketch, a power of two; mantissa bits; registers of a band.
SHINGLE, REGISTERS, MANTISSA, BAND = 5, 256, 10, 6
_BITS = 64 - (REGISTERS.bit_length() - 1)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[ord(c) for c in BLANKS]] = False
_WEIGHTS = np.random.default_rng(7).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
#: From the published analysis: expected chance matches of two registers, less the mantissa.
_CHANCE = 0.1699194871597391
#: Standard errors that an estimate may lie below the limit and still go to confirmation.
_SLACK = 5
#: Where an empty register borrows from, try by try; the same for all sketches.
_PROBES = np.random.default_rng(11).integers(0, REGISTERS, (64, REGISTERS))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The set of hashed shingles of each text, sorted, all behind each other, and where each
    begins. A text of fewer words is one shingle, one without words has none."""
    words = Words(column, _IS_WORD)
    h, of, last = words.hashes, words.of(), SHINGLE - 1
    many = max(len(h) - last, 0)
    made = np.zeros(many, np.uint64)
    for k in range(SHINGLE if many else 0):
        made += h[k:k + many] * _WEIGHTS[k]
    inside = of[:many] == of[last:last + many]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    whole = words.counts[short].astype(np.uint64) * _WEIGHTS[SHINGLE]
    for k in range(last):
        has = words.counts[short] > k
        whole[has] += h[words.first[short[has]] + k] * _WEIGHTS[k]
    text = np.concatenate([of[:many][inside], short])
    hashes = mix(np.concatenate([made[inside], whole]))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[new], hashes[new]
    return hashes, np.searchsorted(text, np.arange(len(words.counts) + 1))


def sketches(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A HyperMinHash row for each set: of the smallest value in a bucket, the leading zeros and
    the bits behind the leading one, in 16 bits; 0 where the bucket is empty."""
    out = np.zeros((len(first) - 1, REGISTERS), np.uint16)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    bucket = (hashes >> np.uint64(_BITS)).astype(np.int64)
    new = np.ones(len(text), bool)  # values are sorted, so the first of a bucket is its smallest
    new[1:] = (text[1:] != text[:-1]) | (bucket[1:] != bucket[:-1])
    rest = hashes[new] & np.uint64((1 << _BITS) - 1)
    high = np.frexp(rest.astype(np.float64))[1].astype(np.int64)  # bits in use; rounds up rarely
    high -= (rest >> np.maximum(high - 1, 0).astype(np.uint64)) == 0
    high = np.maximum(high, MANTISSA + 1)
    zeros = _BITS - high
    mantissa = (rest >> (high - 1 - MANTISSA).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out[text[new], bucket[new]] = ((np.minimum(zeros, 62) + 1) << MANTISSA) \
        + mantissa.astype(np.int64)
    return out


def filled(rows: np.ndarray) -> np.ndarray:
    """Sketches without empty registers: each borrows from registers at fixed random places until
    one has a value. A register then matches with the sets' similarity also for small sets; an
    empty one would match far more often, and a band of them on a single shared line."""
    out = rows.copy()
    row, at = np.nonzero(out == 0)
    for probe in _PROBES:
        if not len(row):
            return out
        value = rows[row, probe[at]]
        out[row, at] = value
        left = value == 0
        row, at = row[left], at[left]
    for r in np.unique(row):  # hardly any value: the next one along the sketch
        have = np.flatnonzero(rows[r])
        if len(have):
            gaps = at[row == r]
            out[r, gaps] = rows[r, have[np.searchsorted(have, gaps) % len(have)]]
    return out


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of registers of each sketch."""
    bands = REGISTERS // BAND
    parts = filled(rows)[:, :bands * BAND].reshape(len(rows), bands, BAND)
    keys = (parts.astype(np.uint64) * _WEIGHTS[:BAND]).sum(2, dtype=np.uint64)
    return mix(keys + np.arange(bands, dtype=np.uint64) * _WEIGHTS[63]).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray,
             n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity from two sketches less the matches that chance would make, and the
    number of registers it rests on."""
    used = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1)
    ratio = np.maximum(n_a, n_b) / np.maximum(np.minimum(n_a, n_b), 1)
    chance = _CHANCE * used / 2.0 ** MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return (same - chance) / np.maximum(used, 1), used


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` without its text column but with ``n_shingles``, ``component_id`` and ``kept``.

    Words are separated by [\\x20\\x09-\\x0D], A-Z lower-cased. Two documents are linked if their
    sets of 5-word shingles share at least ``percent`` % of their union. ``component_id`` is the
    smallest id a document can reach over links; that document is the one ``kept``.

    1. One pass sketches each document. Documents with equal sets are one class, found by a
       128-bit hash of the set and combined before the shuffle: copies cost a row each.
    2. Registers are banded. In each band, members are paired with the smallest id only. Pairs
       whose corrected estimate is not clearly below the limit are confirmed on the full sets.
    3. Links give components. Members of bands that still hold several components are looked at
       once more by their rarest shingles: two sets at the limit must share one of the first
       n - ceil(limit * n) + 1 of an order that is the same for all, at places that leave room for
       the overlap they need. Pairs of different components that do are estimated and confirmed.
       So any two documents that share a band are in one component or cannot be linked, and
       common passages or large groups of copies make no pairs of all with all. Two documents at
       the limit share no band with a chance below 1e-5 (42 bands of 6 registers).

    Defined cases: a text without words has no shingle and links with nothing; a null id has a
    null component and is kept; rows with the same id are one document, linked if any of its
    texts is. Ids may be of any type that has an order. Columns of the result's names are replaced;
    others may have any name.
    """
    small_batches(docs.sparkSession)
    made = ("n_shingles", "component_id", "kept")
    others = [c for c in docs.columns if c not in (*made, text_col, id_col)]
    rows = docs.select(id_col, *others, text_col)
    kinds = "n_shingles long, set1 long, set2 long, sketch binary"
    rows = rows.select(F.col(id_col).alias("id"), F.struct(id_col, *others).alias("doc"),
                       F.col(text_col).alias("text"))
    sketched = staged(rows.mapInArrow(_sketch("text"), T.StructType(
        [*rows.schema.fields[:2], *T._parse_datatype_string(kinds).fields])), "sketches")
    some = sketched.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    classes = staged(some.groupBy("set1", "set2").agg(F.min("id").alias("node")), "classes")
    nodes = staged(
        some.select(F.col("id").alias("node"), "set1", "set2", "n_shingles", "sketch")
        .join(classes, ["node", "set1", "set2"], "left_semi")
        .drop("set1", "set2").dropDuplicates(["node", "n_shingles", "sketch"]), "nodes")
    members = _members(nodes)
    wanted = members.select("node").distinct()
    texts = staged(
        docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text"))
        .join(wanted, "node", "left_semi").distinct(), "texts")
    near = nodes.join(wanted, "node", "left_semi")
    links = staged(_confirm(
        members.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b"))
        .distinct(), near, texts, percent), "confirmed")
    more = _confirm(_across(members, connected_components(links), texts, percent), near, texts, percent)
    links = staged(links.union(more), "all_links")
    found = staged(connected_components(links), "components")
    known = classes.join(found, "node", "left").select(
        "set1", "set2", F.coalesce("component", "node").alias("component"))
    out = sketched.drop("sketch").join(known, ["set1", "set2"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("component").isNull()
    component = F.when(alone | F.col("id").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select("doc.*", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _sketch(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, text_col):
            hashes, first = shingle_sets(batch.column(text_col))
            counts = np.diff(first)
            sums = np.zeros((2, len(hashes) + 1), np.uint64)
            np.cumsum(mix(hashes), out=sums[0, 1:])
            np.cumsum(mix(hashes ^ _WEIGHTS[60]), out=sums[1, 1:])
            sets = (sums[:, first[1:]] - sums[:, first[:-1]]).view(np.int64)
            table = sketches(hashes, first)
            yield batch.drop_columns([text_col]) \
                .append_column("n_shingles", pa.array(counts, pa.int64())) \
                .append_column("set1", pa.array(sets[0])).append_column("set2", pa.array(sets[1])) \
                .append_column("sketch", pa.array([r.tobytes() for r in table], pa.binary()))
    return run


def _table(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _members(nodes: DataFrame) -> DataFrame:
    """Bands of two nodes or more: key, node, and the band's smallest node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = band_keys(_table(batch.column("sketch")))
            yield pa.RecordBatch.from_pydict({
                "node": batch.column("node"),
                "keys": pa.array(list(keys), pa.list_(pa.int64()))})

    kind = nodes.schema["node"].dataType.simpleString()
    bands = nodes.select("node", "sketch").mapInArrow(run, f"node {kind}, keys array<long>") \
        .select("node", F.explode("keys").alias("key"))
    shared = staged(bands.groupBy("key").agg(F.min("node").alias("center"),
                                             F.max("node").alias("last"))
                    .where("center < last").drop("last"), "bands")
    return staged(bands.join(shared, "key"), "members")


def _across(members: DataFrame, components: DataFrame, texts: DataFrame,
            percent: int) -> DataFrame:
    """Pairs of nodes that may be linked though they are not in one component yet, among the
    members of bands that hold several components."""
    placed = members.join(components, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    placed = staged(placed, "placed")
    mixed = staged(placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high").select("key"), "mixed")
    open_ = staged(placed.join(mixed, "key", "left_semi").select("node", "component").distinct()
                   .join(texts, "node").withColumn("row", F.monotonically_increasing_id()), "open")
    # How many open texts hold each shingle. The table is staged so that the join below, where a
    # common shingle is a large group, reads it through an exchange that skew joins can split.
    shingles = open_.select("row", "text").mapInArrow(_all_shingles, "row long, shingle long")
    shared = staged(shingles.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    held = shingles.join(shared, "shingle").groupBy("row").agg(
        F.collect_list(F.struct("shingle", "n")).alias("held"))
    # A text without a shared shingle pairs with nothing.
    counted = open_.join(held, "row").drop("row")

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            hashes, first = shingle_sets(batch.column("text"))
            size, column = np.diff(first), batch.column("held")
            known, ends = column.flatten(), np.cumsum(pc.list_value_length(column).to_numpy())
            values = known.field("shingle").to_numpy().view(np.uint64)
            times, n = known.field("n").to_numpy(), np.ones(len(hashes), np.int64)
            for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
                n[first[i] + np.searchsorted(hashes[first[i]:first[i + 1]], values[a:b])] = times[a:b]
            of = np.repeat(np.arange(len(size)), size)
            place = np.lexsort((hashes, n, of))
            rank = np.arange(len(place)) - np.repeat(first[:-1], size)
            # A shingle that no other text holds makes no pair.
            keep = (rank <= (size - -(-size * percent // 100))[of]) & (n[place] > 1)
            yield pa.RecordBatch.from_pydict({
                "node": batch.column("node").take(pa.array(of[keep])),
                "component": batch.column("component").take(pa.array(of[keep])),
                "shingle": pa.array(hashes[place][keep].view(np.int64)),
                "at": pa.array(rank[keep], pa.int32()), "size": pa.array(size[of[keep]], pa.int32())})

    kind = members.schema["node"].dataType.simpleString()
    prefixes = staged(counted.mapInArrow(
        rarest, f"node {kind}, component {kind}, shingle long, at int, size int"), "prefixes")
    a = prefixes.toDF("a", "ca", "shingle", "ia", "na")
    b = prefixes.toDF("b", "cb", "shingle", "ib", "nb")
    room = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    return a.join(b, "shingle").where(
        (F.col("a") > F.col("b")) & (F.col("ca") != F.col("cb"))
        & (room * (100 + percent) >= percent * (F.col("na") + F.col("nb")))).select("a", "b").distinct()


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches, "text"):
        hashes, first = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(np.repeat(batch.column("row").to_numpy(), np.diff(first))),
            "shingle": pa.array(hashes.view(np.int64))})


def _confirm(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate is not clearly below the limit and whose full sets reach
    it."""
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = percent / 100
        for batch in batches:
            if not batch.num_rows:
                continue
            got, used = estimate(_table(batch.column("sa")), _table(batch.column("sb")),
                                 batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            slack = _SLACK * np.sqrt(limit * (1 - limit) / np.maximum(used, 1))
            yield batch.select(["a", "b"]).filter(pa.array(got >= limit - slack))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(iter([batch]), "ta"):
                left, right = (shingle_sets(part.column(c)) for c in ("ta", "tb"))
                keep = []
                for i in range(part.num_rows):
                    x, y = (s[0][s[1][i]:s[1][i + 1]] for s in (left, right))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    sketch = nodes.select("node", "n_shingles", "sketch")
    side = {s: sketch.toDF(s, f"n{s}", f"s{s}") for s in "ab"}
    likely = staged(
        pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "na", "nb", "sa", "sb")
        .mapInArrow(close, f"a {kind}, b {kind}").distinct(), "likely")
    return likely.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b") \
        .select("a", "b", "ta", "tb").mapInArrow(confirm, f"a {kind}, b {kind}").distinct()


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the smallest id. Rows with a null id stay."""
    gone = near_duplicates(docs.select(id_col, text_col), percent, id_col, text_col) \
        .where("not kept").select(id_col).distinct()
    return docs.join(gone, docs[id_col] == gone[id_col], "left_anti")
