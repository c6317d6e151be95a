"""Tokenising whole texts in tasks."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import small_batches, text_chunks


def _byte_letters() -> dict[str, int]:
    """The printable stand-in that a byte-level vocabulary file uses for each byte value."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of a tokenizer file, run by a faster library with the same merges.

    A byte-level vocabulary lists its tokens in merge order, so ids are ranks. Special tokens'
    strings in a text are ordinary text.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items()
             if all(c in letters for c in token)}
    ranks = {token: rank for token, rank in ranks.items() if token != b"<|endoftext|>"}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(path: str, texts: list[str | None]) -> Iterator[list[int]]:
    run = encoder(path).encode_ordinary
    return (run(text) if text else [] for text in texts)


def with_token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of at most ``capacity`` ids of a document's ids and ``end_id``:
    id, piece, start, length, ids_crc32 (of little-endian unsigned 32-bit ids). The first piece
    is the shorter one."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            out = []
            ids = encode(tokenizer, batch.column("text").to_pylist())
            for doc, found in zip(batch.column("doc_id").to_pylist(), ids):
                all_ids = np.array([*found, end_id], "<u4")
                at = 0
                for piece in range(-(-len(all_ids) // capacity)):
                    to = at + ((len(all_ids) - at - 1) % capacity + 1)
                    out.append((doc, piece, at, to - at, zlib.crc32(all_ids[at:to].tobytes())))
                    at = to
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return rows.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")
