"""Best-fit packing of documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import free_names
from tickloom.llm.tokens import with_token_pieces
from tickloom.session import staged

#: Pieces that one task packs together.
GROUP = 40_000
_UNUSABLE = np.int64(1) << 40


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length (1 to ``capacity``), taken in the order given.

    ``open_[g]`` counts the open bins with residual gap ``g``. A piece goes into the open bin that
    makes the sum of the squared counts smallest, that is, one of a common gap whose new gap is
    rare; ties go to the smallest gap. A new bin is opened only where none has room: with the
    longest pieces first, that leaves fewer bins than opening one to please the sum.
    """
    open_ = np.zeros(capacity + 1, np.int64)
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        here, then = open_[size:capacity], open_[:capacity - size]
        best = capacity
        if len(here):
            delta = 2 * (then - here) + 2
            delta[0] = 1 - 2 * here[0]  # an exact fit closes the bin
            delta[here == 0] = _UNUSABLE
            at = int(delta.argmin())
            if delta[at] < _UNUSABLE:
                best = size + at
        if best == capacity:
            number, made = made, made + 1
        else:
            number = bins[best].pop()
            open_[best] -= 1
        place[i], offset[i] = number, capacity - best
        if best > size:
            bins[best - size].append(number)
            open_[best - size] += 1
    return place, offset


def pack(pieces: DataFrame, capacity: int = 2048, group: int = GROUP,
         length_col: str = "length", seed: int = 5) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each sequence holds ``capacity`` tokens at
    most, without gaps from 0.

    The pieces are dealt by a seeded hash of their place in the table to groups of about ``group``
    rows, whatever they hold, and each group is packed by :func:`sum_of_squares`, longest first;
    only the last few sequences of a group stay partly empty, so the loss is a fixed share at any
    size. Token ids need not come along: a row is a few numbers. ``pieces`` must be a table that
    reads the same way again (files), as a lost task repeats its part.

    Defined cases: a null or non-positive length is an error of the caller; equal rows, however
    many, get places of their own; nulls in other columns stay; an empty table gives none. Columns
    of the result's names are replaced.
    """
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    group_col, = free_names(keep, "group")
    groups = max(1, -(-pieces.count() // group))
    keyed = pieces.select(*keep).withColumn(group_col, F.pmod(
        F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(groups)))
    schema = T.StructType([*keyed.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    order = [(length_col, "descending"),
             *[(c, "ascending") for c in ("doc_id", "piece") if c in keep]]

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, order))
        number, offset = sum_of_squares(rows.column(length_col).to_numpy(), capacity)
        first = rows.column(group_col)[0].as_py() << 32
        return rows.append_column("sequence_id", pa.array(first + number)) \
            .append_column("offset", pa.array(offset))

    return keyed.groupBy(group_col).applyInArrow(place, schema).drop(group_col)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text",
                   group: int = GROUP) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A document is its token ids and ``end_id``. Only one longer than ``capacity`` is cut, into
    pieces of ``capacity`` of which the first is the remainder. Null texts are empty; a null id
    stays null and is packed all the same.
    """
    pieces = with_token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    return pack(staged(pieces, "pieces"), capacity, group)
