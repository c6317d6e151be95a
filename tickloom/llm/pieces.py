"""SentencePiece byte-pair encoding and decoding, vectorised over the words of many texts.

A text is cut into words where no piece of the vocabulary can reach across. Each distinct word of a
chunk is encoded once: all their symbols lie in one flat array, and in each round every word merges
the pair of the best rank in it, at all its places at once and the leftmost first where they
overlap; finished words leave the array, until none is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.common import CHUNK, small_batches, text_bytes, text_chunks

SPACE = "▁"
NO_RANK = np.int32(1) << 30
#: Places of the table of pairs, as a power of two.
SLOT_BITS = 20
#: Symbols of a word that is merged by a heap instead of in rounds.
LONG_WORD = 256


class PieceModel:
    """Vocabulary and merge table of a SentencePiece BPE model with identity normalisation.

    Symbols are piece ids; a character of a piece that is no piece itself, and any other one that
    is not in the vocabulary, get numbers behind the pieces and end as bytes or as the unknown id.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or norm.precompiled_charsmap \
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces \
                or model.trainer_spec.treat_whitespace_as_suffix \
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError(f"{path}: only BPE models with identity normalisation and without "
                             "user-defined or unused pieces are read")
        self.processor = SentencePieceProcessor(model_file=path)
        self.prefix = norm.add_dummy_prefix
        self.size = len(model.pieces)
        self.unknown = self.processor.unk_id()
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        scores = np.array([p.score for p in model.pieces], np.float64)
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.bytes = np.full(256, self.unknown, np.int32)
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.byte_fallback = bool((self.bytes != self.unknown).all())

        symbols = dict(normal)
        for piece in normal:
            for char in piece:
                symbols.setdefault(char, self.size + len(symbols) - len(normal))
        #: Symbol of each code point; -1: not in the vocabulary.
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for text, i in symbols.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = i
        self.symbol_of[ord(" ")] = self.symbol_of[ord(SPACE)]
        self._pairs(normal, symbols, rank)
        self._joins(normal)

        #: What decoding writes for each id.
        written = [b""] * self.size
        for piece, i in normal.items():
            written[i] = piece.replace(SPACE, " ").encode()
        written[self.unknown] = model.trainer_spec.unk_surface.encode()
        for byte, i in enumerate(self.bytes):
            if i != self.unknown:
                written[i] = bytes([byte])
        self.written = ByteTable(written)
        self.starts_word = np.array([p.piece.startswith(SPACE) and p.type == kinds.NORMAL
                                     for p in model.pieces])
        self.silent = np.array([p.type == kinds.CONTROL for p in model.pieces])

    def _pairs(self, normal: dict, symbols: dict, rank: np.ndarray) -> None:
        made = {}
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                x, y = symbols.get(piece[:k]), symbols.get(piece[k:])
                if x is not None and y is not None:
                    made[x, y] = i
        # A hash table with open places behind each other, for look-ups of many pairs at a time.
        keys = np.array([x << 32 | y for x, y in made], np.int64)
        self.keys = np.full((1 << SLOT_BITS) + len(keys), -1, np.int64)
        self.merged = np.full(len(self.keys), -1, np.int32)
        for at, key, i in zip(_slot(keys).tolist(), keys.tolist(), made.values()):
            while self.keys[at] != -1:
                at += 1
            self.keys[at], self.merged[at] = key, i
        self.pairs, self.rank = made, np.append(rank, NO_RANK)  # of no piece, -1
        # A piece that may become part of one of the same or a better rank: after such a merge the
        # order of the rest is open again, so a word merges one place of it a round.
        self.open_ended = np.zeros(self.size, bool)
        for (x, y), i in made.items():
            for part in (x, y):
                if part < self.size and rank[i] <= rank[part]:
                    self.open_ended[part] = True

    def _joins(self, normal: dict) -> None:
        """For pairs of characters, whether any piece has them side by side."""
        chars = sorted({c for piece in normal for c in piece})
        self.char_class = np.zeros(0x110000, np.int32)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_class[ord(" ")] = self.char_class[ord(SPACE)]
        self.joins = np.zeros((len(chars) + 1,) * 2, bool)
        for piece in normal:
            at = self.char_class[[ord(c) for c in piece]]
            self.joins[at[:-1], at[1:]] = True

    # -- encoding -----------------------------------------------------------------

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind each other, and the number of ids of each text (null: none)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        if self.prefix:
            space, empty = (pa.scalar(s, pa.large_string()) for s in (" ", ""))
            texts = pc.if_else(pc.equal(texts, empty), texts,
                               pc.binary_join_element_wise(space, texts, empty))
        if not len(texts) or sizes.max() <= CHUNK:
            return self._encode(texts)
        parts, owner = [], []
        for i, text in enumerate(texts.to_pylist()):
            for part in self._parts(text):
                parts.append(part)
                owner.append(i)
        ids, counts = [], np.zeros(len(texts), np.int64)
        for part, i in zip(parts, owner):
            found, n = self._encode(pa.array([part], pa.large_string()))
            ids.append(found)
            counts[i] += n[0]
        return np.concatenate(ids), counts

    def _parts(self, text: str) -> Iterator[str]:
        """A text in parts of about a chunk, cut where no piece can reach across."""
        at = 0
        while len(text) - at > CHUNK:
            to = at + CHUNK // 2
            while to < len(text) and self.joins[self.char_class[ord(text[to - 1])],
                                                self.char_class[ord(text[to])]]:
                to += 1
            yield text[at:to]
            at = to
        yield text[at:]

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # where code points begin
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        classes = self.char_class[points]
        cut = np.empty(len(points), bool)
        cut[:1], cut[1:] = True, ~self.joins[classes[:-1], classes[1:]]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        cut[np.searchsorted(lead, edges)] = True
        starts = lead[cut]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        flat, sizes = self._merge(coded.dictionary)
        which = coded.indices.to_numpy()
        counts = sizes[which]
        ids = take_runs(flat, (np.cumsum(sizes) - sizes)[which], counts)
        before = np.concatenate([[0], np.cumsum(counts)])
        first = before[np.searchsorted(starts, offsets)]
        return ids, np.diff(first)

    def _merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, behind each other, and their numbers."""
        data, offsets = text_bytes(words.cast(pa.large_string()))
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        symbols = self.symbol_of[points]
        lengths = np.diff(np.searchsorted(lead, offsets))
        word = np.repeat(np.arange(len(lengths)), lengths)
        unknown = symbols < 0  # keep the code point until the end
        symbols = np.where(unknown, -1 - points.astype(np.int64), symbols)

        done_word, done_symbol = [], []
        for w in np.flatnonzero(lengths > LONG_WORD):
            at = int(lengths[:w].sum())
            found = self._merge_one(symbols[at:at + lengths[w]].tolist())
            done_word.append(np.full(len(found), w))
            done_symbol.append(np.array(found, np.int64))
        rest = (lengths <= LONG_WORD)[word]
        symbols, word = symbols[rest], word[rest]
        made = self._look_up(symbols, np.append(symbols[1:], -1),
                             np.append(word[1:] == word[:-1], False)[:len(word)])
        while len(symbols):
            ranks = self.rank[made]
            leads = np.append(True, word[1:] != word[:-1])
            best = np.minimum.reduceat(ranks, np.flatnonzero(leads))[np.cumsum(leads) - 1]
            over = best == NO_RANK
            done_word.append(word[over])
            done_symbol.append(symbols[over])
            at = np.flatnonzero((ranks == best) & ~over)
            # Of overlapping places every other one, from the left; of an open-ended piece the first.
            new_run = np.append(True, at[1:] != at[:-1] + 1)[:len(at)]
            run = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            taken = (np.arange(len(at)) - run) % 2 == 0
            one = self.open_ended[made[at]]
            if one.any():
                new_word = np.append(True, word[at[1:]] != word[at[:-1]])
                alone = np.maximum.reduceat(one, np.flatnonzero(new_word))
                taken &= new_word | ~alone[np.cumsum(new_word) - 1]
            at = at[taken]
            symbols[at] = made[at]
            keep = ~over
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            symbols, word, made = symbols[keep], word[keep], made[keep]
            if len(symbols):  # pairs with a new symbol; a word's first has none before it
                changed = np.concatenate([place, place[place > 0] - 1])
                after = np.minimum(changed + 1, len(symbols) - 1)
                made[changed] = self._look_up(symbols[changed], symbols[after], (
                    word[changed] == word[after]) & (after > changed))

        word, symbols = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(word, kind="stable")
        return self._final(word[order], symbols[order], len(lengths))

    def _look_up(self, left: np.ndarray, right: np.ndarray, fits: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        out = np.full(len(left), -1, np.int32)
        open_ = np.flatnonzero(fits & (left >= 0) & (right >= 0))
        keys = left[open_] << 32 | right[open_]
        at = _slot(keys)
        while len(open_):
            held = self.keys[at]
            out[open_] = np.where(held == keys, self.merged[at], -1)
            more = (held != keys) & (held != -1)  # another pair's place: look at the next one
            open_, keys, at = open_[more], keys[more], at[more] + 1
        return out

    def _merge_one(self, symbols: list[int]) -> list[int]:
        """The same for one long word: a heap of (rank, place) over a linked list."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank[z], i, z) for i, pair in enumerate(zip(symbols, symbols[1:]))
                if (z := self.pairs.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, z = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j >= n or self.pairs.get((symbols[i], symbols[j])) != z:
                continue
            symbols[i], symbols[j], after[i] = z, None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    y = self.pairs.get((symbols[a], symbols[b]))
                    if y is not None:
                        heapq.heappush(heap, (self.rank[y], a, y))
        return [s for s in symbols if s is not None]

    def _final(self, word: np.ndarray, symbols: np.ndarray,
               n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary become their bytes' ids, or the unknown id."""
        odd = (symbols < 0) | (symbols >= self.size)
        if odd.any() and self.byte_fallback:
            points = np.where(symbols < 0, -1 - symbols, 0)
            for i in np.flatnonzero(symbols >= self.size):
                points[i] = np.flatnonzero(self.symbol_of == symbols[i])[0]
            text = points[odd].astype("<u4").tobytes().decode("utf-32-le")
            data = np.frombuffer(text.encode(), np.uint8)
            sizes = np.ones(len(symbols), np.int64)
            sizes[odd] = 1 + (points[odd] > 0x7F) + (points[odd] > 0x7FF) + (points[odd] > 0xFFFF)
            word, out = np.repeat(word, sizes), np.repeat(symbols, sizes)
            out[np.repeat(odd, sizes)] = self.bytes[data]
            symbols = out
        else:
            symbols = np.where(odd, self.unknown, symbols)
        return symbols.astype(np.int32), np.bincount(word, minlength=n_words)

    # -- decoding -----------------------------------------------------------------

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The text of each run of ids, as the library writes it."""
        ends = np.cumsum(counts)
        sizes = self.written.sizes[ids]
        owner = np.repeat(np.arange(len(counts)), counts)
        spoken = np.flatnonzero(~self.silent[ids])
        first = spoken[np.append(True, owner[spoken][1:] != owner[spoken][:-1])] \
            if len(spoken) else spoken
        drop = first[self.starts_word[ids[first]]] if self.prefix else first[:0]
        begins = self.written.begins[ids]
        begins[drop] += 1  # the space that encoding put in front
        sizes[drop] -= 1
        data = take_runs(self.written.data, begins, sizes)
        at = np.concatenate([[0], np.cumsum(sizes)])
        offsets = at[np.concatenate([[0], ends])]
        out = pa.Array.from_buffers(pa.large_binary(), len(counts), [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        try:
            data.tobytes().decode()
            split = (data[offsets[1:-1][offsets[1:-1] < len(data)]] & 0xC0) == 0x80
            if not split.any():
                return out.cast(pa.large_string())
        except UnicodeDecodeError:
            pass
        texts = [self._text(data[offsets[i]:offsets[i + 1]].tobytes(),
                            ids[ends[i] - counts[i]:ends[i]]) for i in range(len(counts))]
        return pa.array(texts, pa.large_string())

    def _text(self, data: bytes, ids: np.ndarray) -> str:
        try:
            return data.decode()
        except UnicodeDecodeError:  # byte pieces that are no UTF-8
            return self.processor.decode(ids.tolist())


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class ByteTable:
    """Byte strings behind each other."""

    def __init__(self, items: list[bytes]):
        self.data = np.frombuffer(b"".join(items), np.uint8)
        self.sizes = np.array([len(x) for x in items], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes


def take_runs(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[b:b + n]`` for each begin and size, behind each other."""
    shift = begins - (np.cumsum(sizes) - sizes)
    return values[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def with_piece_ids(docs: DataFrame, model: str, text_col: str = "text",
                   ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``: the piece ids of each whole text, without begin or end ids.

    ``model`` is the path of a SentencePiece BPE model that all executors see at the same place.
    Texts are encoded in tasks, some megabytes at a time; a longer text is cut into parts where no
    piece can reach across, so memory is bounded, and no row leaves its task.

    Defined cases: a null or empty text has no ids; repeated rows are encoded each; other columns
    come along whatever their names, and one of the name ``ids_col`` is replaced.
    """
    return _mapped(docs, text_col, ids_col, T.ArrayType(T.IntegerType()),
                   lambda batch: _lists(*piece_model(model).encode(batch.column(text_col))),
                   lambda batches: text_chunks(batches, text_col))


def with_piece_text(frame: DataFrame, model: str, ids_col: str = "ids",
                    text_col: str = "text") -> DataFrame:
    """``frame`` with ``text_col``: what the ids decode to. Null or no ids: empty. Bytes that are
    no UTF-8 become U+FFFD, control ids nothing; an id outside the vocabulary is an error. A column
    of the name ``text_col`` is replaced."""
    def decode(batch: pa.RecordBatch) -> pa.Array:
        ids = pc.fill_null(batch.column(ids_col), []).cast(pa.list_(pa.int32()))
        counts = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        return piece_model(model).decode(ids.flatten().to_numpy(zero_copy_only=False), counts)

    # Batches of ids are bounded as they come.
    return _mapped(frame, ids_col, text_col, T.StringType(), decode, iter)


def _mapped(frame: DataFrame, source: str, made: str, kind: T.DataType, run,
            cut) -> DataFrame:
    kept = [f for f in frame.schema.fields if f.name != made]
    names = [f.name for f in kept]
    narrow = pa.list_(pa.int32()) if isinstance(kind, T.ArrayType) else pa.large_string()
    needed = list(dict.fromkeys([*names, source]))
    small_batches(frame.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            column = run(batch).cast(narrow)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], column],
                                             [*names, made])

    return frame.select(*[f"`{c}`" for c in needed]).mapInArrow(
        each, T.StructType([*kept, T.StructField(made, kind)]))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
