"""Training-order materialisation: token ids in fixed-stride shards, in a keyed random order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import file_system, mix, small_batches, text_chunks
from tickloom.llm.tokens import encode
from tickloom.operators.series import Series
from tickloom.session import shared_folder, staged

STRIDE = 2048
#: Sequences of a shard: 8 MB of 16-bit ids. Text bytes of a staged chunk.
PER_SHARD, CHUNK = 2048, 5 << 19
_ROUNDS = 6
#: Slices whose lengths are added up together.
RUN = 4096


def feistel(values: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed bijection of 0 .. ``size`` - 1, or its inverse.

    A Feistel network permutes the smallest even-bit domain that holds ``size``; a value that
    falls outside walks on along its cycle until it is inside (4 steps at most on average).
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, _ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(key % (1 << 64)))
    out = np.asarray(values).astype(np.uint64)
    walking = np.ones(len(out), bool)
    while walking.any():
        x = out[walking]
        left, right = x >> shift, x & mask
        for k in keys[::-1] if back else keys:
            if back:
                left, right = right ^ (mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (mix(right ^ k) & mask)
        out[walking] = (left << shift) | right
        walking &= out >= np.uint64(size)
    return out.astype(np.int64)


def write_training_order(docs: DataFrame, tokenizer: str, key: int = 2024, stride: int = STRIDE,
                         per_shard: int = PER_SHARD, end_id: int = 0, id_col: str = "doc_id",
                         text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write all documents as 16-bit token ids and return one manifest row per sequence.

    The stream is each document's ids and ``end_id``, document after document in the order of a
    keyed hash of id and text, cut every ``stride`` ids: the same table and key give the same
    stream however the input is split. Sequence ``i`` of ``n`` goes to slot ``feistel(i, n, key)``;
    shard ``s`` holds the ``per_shard`` slots from ``s * per_shard``, slot after slot, ``stride``
    ids each, so a reader finds slot ``t`` by arithmetic and a stopped job resumes at any slot.
    Only the last sequence of the stream is padded (with ``end_id``).

    Texts are tokenised once, into a staged table of compressed chunks. Of the documents only
    hashes and lengths are put in order, by range partitions with running totals; their places in
    the stream are written by the partition that holds the tokens, whose task reads them back. In
    the second pass each task groups its pieces by shard before the shuffle, and one task writes a
    whole shard under a temporary name and renames it, so that a repeated task leaves the same file.

    Manifest: slot, sequence, shard, byte_offset, n_tokens, and of the documents in it, in order,
    ``doc_ids``, ``doc_starts`` (place in the sequence), ``doc_lengths``. Defined cases: null and
    empty texts are ``end_id`` alone; null ids stay null; equal rows are documents of their own;
    an empty table has no sequence. Other columns than id and text are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_folder(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumns({f"k{i}": F.xxhash64(F.lit(key), F.lit(i), "doc_id", "text") for i in (0, 1)})

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        press = zstandard.ZstdCompressor(level=7)
        for batch in text_chunks(batches, "text", CHUNK):
            found = [np.array([*ids, end_id], "<u2")
                     for ids in encode(tokenizer, batch.column("text").to_pylist())]
            lengths = [len(ids) for ids in found]
            ids = np.concatenate(found)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int64()),
                **{name: pa.array([batch.column(c).to_pylist()], pa.list_(pa.int64()))
                   for name, c in (("doc_ids", "doc_id"), ("k0", "k0"), ("k1", "k1"))},
                "lengths": pa.array([lengths], pa.list_(pa.int32())),
                "ids": pa.array([press.compress(ids.tobytes())], pa.binary())})
            chunk += 1

    tokens = staged(rows.mapInArrow(
        tokenise, "part int, chunk long, doc_ids array<long>, k0 array<long>, k1 array<long>, "
        "lengths array<int>, ids binary"), "tokens")
    places, whole = _stream_places(tokens)
    sequences = -(-whole // stride)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, unpress = zstandard.ZstdCompressor(level=7), zstandard.ZstdDecompressor()
        held, chunks, begins = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):  # one by one: a row may be large
                [row] = batch.slice(i, 1).to_pylist()
                if row["part"] != held:
                    held = row["part"]
                    chunks, begins = _places_of(places, held)
                mine = slice(*np.searchsorted(chunks, [row["chunk"], row["chunk"] + 1]))
                ids = np.frombuffer(unpress.decompress(row["ids"]), "<u2")
                lengths = np.array(row["lengths"], np.int64)
                yield from _by_shard(ids, lengths, row["doc_ids"], begins[mine], press)

    def _by_shard(ids, lengths, doc_ids, begins, press) -> Iterator[pa.RecordBatch]:
        first = begins // stride
        parts = (begins + lengths - 1) // stride - first + 1
        owner = np.repeat(np.arange(len(lengths)), parts)
        sequence = first[owner] + np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.maximum(begins[owner], sequence * stride)
        to = np.minimum((begins + lengths)[owner], (sequence + 1) * stride)
        source = (np.cumsum(lengths) - lengths - begins)[owner] + at  # place in the chunk
        slot = feistel(sequence, sequences, key)
        order = np.argsort(slot, kind="stable")
        shard = slot[order] // per_shard
        groups = np.split(order, np.flatnonzero(np.diff(shard)) + 1)
        out = {"shard": [], "slot": [], "sequence": [], "at": [], "size": [], "doc_id": [],
               "ids": []}
        for g in groups:
            out["shard"].append(int(slot[g[0]] // per_shard))
            out["slot"].append(slot[g])
            out["sequence"].append(sequence[g])
            out["at"].append((at[g] % stride).astype(np.int32))
            out["size"].append((to[g] - at[g]).astype(np.int32))
            out["doc_id"].append([doc_ids[i] for i in owner[g]])
            out["ids"].append(press.compress(
                np.concatenate([ids[a:a + n] for a, n in zip(source[g], (to - at)[g])]).tobytes()))
        kinds = {"shard": pa.int64(), "slot": pa.list_(pa.int64()),
                 "sequence": pa.list_(pa.int64()), "at": pa.list_(pa.int32()),
                 "size": pa.list_(pa.int32()), "doc_id": pa.list_(pa.int64()), "ids": pa.binary()}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in out.items()})

    def write(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        here = min(per_shard, sequences - shard * per_shard)
        block = np.full((here, stride), end_id, "<u2")
        unpress, pieces = zstandard.ZstdDecompressor(), []
        for i in range(table.num_rows):
            [row] = table.slice(i, 1).to_pylist()
            ids, used = np.frombuffer(unpress.decompress(row["ids"]), "<u2"), 0
            for slot, number, at, size, doc in zip(*(row[c] for c in (
                    "slot", "sequence", "at", "size", "doc_id"))):
                block[slot - shard * per_shard, at:at + size] = ids[used:used + size]
                used += size
                pieces.append((slot, at, number, size, doc))
        _put(folder, shard_name(shard), block.tobytes())
        out: dict[int, dict] = {}
        for slot, at, number, size, doc in sorted(pieces, key=lambda p: p[:2]):
            row = out.setdefault(slot, {
                "slot": slot, "sequence": number, "shard": shard,
                "byte_offset": (slot - shard * per_shard) * stride * 2, "n_tokens": 0,
                "doc_ids": [], "doc_starts": [], "doc_lengths": []})
            row["n_tokens"] += size
            row["doc_ids"].append(doc)
            row["doc_starts"].append(at)
            row["doc_lengths"].append(size)
        return pa.Table.from_pylist(list(out.values()), pa.schema([
            ("slot", pa.int64()), ("sequence", pa.int64()), ("shard", pa.int64()),
            ("byte_offset", pa.int64()), ("n_tokens", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int32())),
            ("doc_lengths", pa.list_(pa.int32()))]))

    dealt = tokens.mapInArrow(
        deal, "shard long, slot array<long>, sequence array<long>, at array<int>, "
        "size array<int>, doc_id array<long>, ids binary")
    return staged(dealt.groupBy("shard").applyInArrow(
        write, "slot long, sequence long, shard long, byte_offset long, n_tokens long, "
        "doc_ids array<long>, doc_starts array<int>, doc_lengths array<int>"), "manifest")


def _stream_places(tokens: DataFrame) -> tuple[str, int]:
    """Folder with the place in the stream of every document, by the partition and chunk of its
    tokens, and the length of the stream."""
    spark = tokens.sparkSession
    docs = tokens.select("part", "chunk", F.posexplode(F.arrays_zip("k0", "k1", "lengths"))
                         .alias("place", "x")).select("part", "chunk", "place", "x.k0", "x.k1",
                                                      F.col("x.lengths").alias("length"))
    series = Series(keys=(), ts="k0", ties=("k1", "part", "chunk", "place"))
    dealt = staged(series.dealt(docs), "dealt")
    slices = dealt.groupBy("_slice").agg(F.sum("length").alias("n")) \
        .withColumn("run", F.expr(f"_slice div {RUN}"))
    slices = staged(slices, "slices")
    runs = slices.groupBy("run").agg(F.sum("n").alias("n"))
    up_to = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # a row per RUN slices
    runs = runs.select("run", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before"))
    inside = Window.partitionBy("run").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(runs, "run") \
        .select("_slice", (F.col("before") + F.col("inside")).alias("before"))
    order = Window.partitionBy("_slice").orderBy("k0", "k1", "part", "chunk", "place") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("length").over(order), F.lit(0))) \
        .join(starts, "_slice").select("part", "chunk", "place", (F.col("before") + F.col("inside")).alias("begin"))
    folder = f"{shared_folder(spark)}/places"
    placed.repartition("part").sortWithinPartitions("part", "chunk", "place") \
        .write.partitionBy("part").parquet(folder)
    return folder, int(slices.agg(F.sum("n")).first()[0] or 0)


def _places_of(folder: str, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunk and place in the stream of a partition's documents, in the order of its tokens."""
    store, path = file_system(f"{folder}/part={part}")
    names = [f.path for f in store.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("part-")]
    table = pa.concat_tables([pq.read_table(n, filesystem=store, partitioning=None) for n in names])
    order = np.lexsort((table.column("place").to_numpy(), table.column("chunk").to_numpy()))
    return tuple(table.column(c).to_numpy()[order] for c in ("chunk", "begin"))


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _put(folder: str, name: str, data: bytes) -> None:
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{path}/{name}")


def read_slots(spark: SparkSession, folder: str, first: int = 0, last: int | None = None,
               stride: int = STRIDE, per_shard: int = PER_SHARD) -> DataFrame:
    """Slots ``first`` to before ``last`` with their ids (binary, 16 bits each) and ids_crc32
    (of 32-bit ids), read from the shards that hold them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder)
    shard = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long")
    files = files.select(shard.alias("shard"), "content").where(
        F.col("shard") >= first // per_shard)
    if last is not None:
        files = files.where(F.col("shard") * per_shard < last)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                content = batch.column("content")[i].as_buffer()
                block = np.frombuffer(content, "<u2").reshape(-1, stride)
                slots = shard * per_shard + np.arange(len(block))
                keep = (slots >= first) & (slots < (last if last is not None else np.inf))
                block = block[keep]
                yield pa.RecordBatch.from_pydict({
                    "slot": pa.array(slots[keep], pa.int64()),
                    "ids": pa.array([x.tobytes() for x in block], pa.binary()),
                    "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in block],
                                          pa.int64())})

    return files.mapInArrow(records, "slot long, ids binary, ids_crc32 long")
