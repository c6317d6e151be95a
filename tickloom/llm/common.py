"""Column and Arrow helpers that several text operators share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
#: Text bytes that one numpy kernel takes at a time, and that an Arrow batch holds at most.
CHUNK, BATCH = 2 << 20, 8 << 20


def free_names(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, with underscores in front until no column of ``columns`` has them."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Pure ASCII takes the fast built-in path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH`` bytes: both sides of a Python worker hold
    one, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def text_chunks(batches: Iterator[pa.RecordBatch], text: str,
                limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` text bytes; a longer text is a slice of its own."""
    pa.set_memory_pool(pa.system_memory_pool())  # a worker lives on; let it give memory back
    for batch in batches:
        _give_back()
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def _give_back() -> None:
    """Return what freed strings and lists have left in the allocator's arenas."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind each other, and where each begins and the last ends."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:
                                                           column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """Words of texts, found and hashed for all texts of a chunk at once.

    ``is_word`` tells for each byte value whether it belongs to a word. A-Z count as a-z.
    ``hashes`` (64 bits), ``begins`` and ``ends`` (byte places in the chunk) have an entry for
    each word, ``first`` the number of words before each text, and then the number of all.
    """

    _values = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
    _values[ord("A"):ord("Z") + 1] = _values[ord("a"):ord("z") + 1]

    def __init__(self, column: pa.Array, is_word: np.ndarray):
        data, offsets = text_bytes(column)
        self.data, self.offsets = data, offsets
        inside = is_word[data]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        self.begins = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        after[edges[edges > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.begins, offsets)
        self.counts = np.diff(self.first)
        if len(self.begins):
            up, down = powers(len(data))
            terms = np.where(is_word, self._values, np.uint64(0))[data]
            terms *= up[:len(data)]
            self.hashes = mix(np.add.reduceat(terms, self.begins) * down[self.begins])
        else:
            self.hashes = np.zeros(0, np.uint64)

    def of(self) -> np.ndarray:
        """For each word, the number of its text in the chunk."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


_PRIME = 0x9E3779B97F4A7C15
_tables = [np.ones(1, np.uint64)] * 2


def powers(size: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse; one table for all of a worker's
    kernels, except for a text that is longer than a chunk."""
    if len(_tables[0]) >= size:
        return _tables
    made = []
    for base in (_PRIME, pow(_PRIME, -1, 1 << 64)):
        table = np.full((size + (1 << 18) - 1) >> 18 << 18, base, np.uint64)
        table[0] = 1
        made.append(np.cumprod(table, out=table))
    if size <= 2 * CHUNK:
        _tables[:] = made
    return made


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the path there. Local forms: /x, file:/x."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", uri))
