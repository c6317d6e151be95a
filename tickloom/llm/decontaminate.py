"""Benchmark decontamination: test phrases searched in an FM-index of each training shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Words, free_names, small_batches, text_chunks
from tickloom.llm.fm_index import FMIndex
from tickloom.session import staged

#: Words of a window, benchmark words of a broadcast block, windows of a segment of an item, text
#: bytes of a shard.
WINDOW, BLOCK_WORDS, SEGMENT, SHARD = 10, 2_000_000, 10_000, 2 << 20
_HITS = "array<struct<start:int,end:int,words:int>>"
#: Bytes that words are made of: 0-9, letters, and all of non-ASCII characters.
_IS_WORD = np.zeros(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _IS_WORD[_first:_last + 1] = True


class Phrases:
    """The windows of a block of benchmark items, over a vocabulary of word hashes.

    ``patterns`` has the distinct windows as symbols (0 behind their end); the items that hold
    window ``w`` are ``holders[holder_first[w]:holder_first[w + 1]]``.
    """

    def __init__(self, items: list, texts: list[str | None], window: int):
        words = Words(pa.array(texts, pa.string()), _IS_WORD)
        self.items = items
        self.vocabulary, symbol = np.unique(words.hashes, return_inverse=True)
        symbol = symbol + 1
        rows, owners = [], []
        for number, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            size = min(window, b - a)
            if size:
                found = np.zeros((b - a - size + 1, window), np.int32)
                found[:, :size] = np.lib.stride_tricks.sliding_window_view(symbol[a:b], size)
                rows.append(found)
                owners.append(np.full(len(found), number))
        table = np.concatenate(rows) if rows else np.zeros((0, window), np.int32)
        owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        self.patterns, which = np.unique(table, axis=0, return_inverse=True)
        which = which.ravel()
        pairs = np.unique(np.stack([which, owners]), axis=1) if len(which) \
            else np.zeros((2, 0), np.int64)
        self.holders = pairs[1]
        self.holder_first = np.searchsorted(pairs[0], np.arange(len(self.patterns) + 1))
        self.lengths = (self.patterns > 0).sum(1)
        self.shortest = int(self.lengths.min(initial=window))
        # A quick no for most words: is the top of the hash that of any word in the vocabulary?
        self.tops = np.zeros(1 << 20, bool)
        self.tops[self.vocabulary >> np.uint64(44)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int32)
        maybe = np.flatnonzero(self.tops[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]),
                        max(len(self.vocabulary) - 1, 0))
        if len(self.vocabulary):
            same = self.vocabulary[at] == hashes[maybe]
            out[maybe[same]] = at[same] + 1
        return out


def segments(benchmark: DataFrame, id_col: str, text_col: str, window: int,
             most: int = SEGMENT) -> DataFrame:
    """Benchmark items in segments of at most ``most`` windows: item, text, words. Neighbours
    share ``window`` - 1 words, so every window of an item is in one segment, and only an item of
    fewer words has a segment of fewer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            words = Words(batch.column("text"), _IS_WORD)
            data, out = words.data.tobytes(), []
            for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                for at in range(a, max(b - window + 1, a + 1), most) if b > a else ():
                    to = min(at + most + window - 1, b)
                    out.append((i, data[words.begins[at]:words.ends[to - 1]].decode(), to - at))
            if out:
                rows, texts, sizes = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(rows)), pa.array(texts, pa.string()),
                     pa.array(sizes, pa.int64())], ["item", "text", "words"])

    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.where(F.col("text").isNotNull()).mapInArrow(
        run, f"item {rows.schema['item'].dataType.simpleString()}, text string, words long")


def phrase_blocks(parts: DataFrame, window: int, block_words: int) -> Iterator[Phrases]:
    """The segments in blocks of at most ``block_words`` words, one at a time on the driver."""
    items, texts, words = [], [], 0
    for row in parts.toLocalIterator():
        if items and words + row["words"] > block_words:
            yield Phrases(items, texts, window)
            items, texts, words = [], [], 0
        items.append(row["item"])
        texts.append(row["text"])
        words += row["words"]
    if items:
        yield Phrases(items, texts, window)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id",
               item_text_col: str = "text", text_col: str = "text", window: int = WINDOW,
               block_words: int = BLOCK_WORDS, cut: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hits`` (removal spans), ``items`` and
    ``contaminated``.

    Words are [0-9a-z] and non-ASCII characters, A-Z lower-cased. A window is ``window``
    consecutive words of a benchmark item, or a shorter item as a whole. Each task cuts its
    documents into shards of about 2 MB, maps benchmark words to symbols, and indexes the runs of
    symbols that are long enough to hold a window (other words match nothing). All windows are
    searched backwards through the wavelet ranks at once, their occurrences located from sampled
    suffix places, and overlapping occurrences merged into removal spans.

    Items are cut into segments between their windows, and the segments go to the tasks in
    broadcast blocks of at most ``block_words`` words (by the rule above; at least a segment), of
    which the driver holds two and a task one at a time; a larger benchmark takes several passes
    over the shards, written in between. Documents are not shuffled.

    ``hits``: array of (start, end), UTF-8 byte places of merged runs of hit words, in order. With
    ``cut`` these are cut out of the text; each leaves a line end, so that the words around it do
    not become neighbours on a line. Windows run over line ends, so what is left of a text that was
    cut is searched and cut again until no window is in it; ``hits``, ``items`` and the counts are
    those of the given text.
    ``items``: ids of the items with a window in the text, as strings in order. Defined cases:
    null and empty texts have no words and no hit; items without text or words match nothing; an
    empty benchmark hits nothing; repeated rows get equal answers. Columns of the result's names
    are replaced; others may have any name.
    """
    small_batches(docs.sparkSession)
    parts = staged(segments(benchmark, id_col, item_text_col, window,
                            max(1, min(SEGMENT, block_words - window + 1))), "segments")
    made = ("n_words", "n_hit", "hits", "items", "contaminated")
    given = docs.drop(*made)

    def search(rows: DataFrame) -> tuple[DataFrame, bool]:
        """All blocks' passes, and whether there was one block only."""
        out = rows.withColumns({
            "n_words": F.lit(0).cast("long"), "hits": F.array().cast(_HITS),
            "items": F.array().cast("array<string>")})
        blocks = phrase_blocks(parts, window, block_words)
        phrases, passes = next(blocks, None) or Phrases([], [], window), 0
        while phrases is not None:
            shared, phrases = docs.sparkSession.sparkContext.broadcast(phrases), next(blocks, None)
            passes += 1
            last = phrases is None
            out = _pass(out, shared, text_col, cut and last, passes == 1 and last)
            if not last:  # a task holds one block: this one goes before the next comes
                out = staged(out, "pass")
                shared.destroy()
        return out, passes == 1

    out, whole = search(given)
    if cut and not whole:  # with one block the task itself goes on until nothing is hit
        out = staged(out, "cut")
        first, (was,) = ("n_words", "hits", "items"), free_names(out.columns, "was")
        done, rest = out.where(F.size("hits") == 0), out.where(F.size("hits") > 0)
        while not rest.isEmpty():
            kept = rest.withColumn(was, F.struct(*first)).drop(*first)
            again = staged(search(kept)[0], "cut")
            left = F.size("hits") > 0
            back = [again.where(x).select(*given.columns, *[F.col(was).getField(c).alias(c) for c in first])
                    for x in (~left, left)]
            done, rest = done.unionByName(back[0]), back[1]
        out = done
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return out.withColumns({
        "n_hit": n_hit, "contaminated": F.size("hits") > 0,
        "hits": F.transform("hits", lambda x: F.struct(x["start"], x["end"])),
        "items": F.array_sort(F.array_distinct("items"))})


def _pass(docs: DataFrame, shared, text_col: str, cut: bool, whole: bool) -> DataFrame:
    """Search one block of phrases; ``whole``: it is the only one, so cutting goes on until none
    of its windows is left."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in text_chunks(batches, text_col, SHARD):
            words = Words(batch.column(text_col), _IS_WORD)
            hit, items = _occurrences(words, phrases)
            old = batch.column("hits").to_pylist()
            spans = _spans(words, hit, old)
            texts = [a + b for a, b in zip(batch.column("items").to_pylist(), items)]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["n_words"] = pa.array(words.counts, pa.int64())
            columns["hits"] = pa.array(spans, batch.schema.field("hits").type)
            columns["items"] = pa.array(texts, batch.schema.field("items").type)
            if cut and any(spans):
                left = [_without(t, s) for t, s in zip(batch.column(text_col).to_pylist(), spans)]
                cut_ = [i for i, s in enumerate(spans) if s] if whole else []
                while cut_:
                    words = Words(pa.array([left[i] for i in cut_], pa.string()), _IS_WORD)
                    more = _spans(words, _occurrences(words, phrases)[0], [[]] * len(cut_))
                    for i, s in zip(cut_, more):
                        left[i] = _without(left[i], s)
                    cut_ = [i for i, s in zip(cut_, more) if s]
                columns[text_col] = pa.array(left, columns[text_col].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(search, docs.schema)


def _occurrences(words: Words, phrases: Phrases) -> tuple[np.ndarray, list[list[str]]]:
    """Which words of the shard are hit, and each text's items."""
    texts = len(words.counts)
    items: list[list[str]] = [[] for _ in range(texts)]
    symbols = phrases.symbols(words.hashes)
    used = symbols > 0
    of = words.of()
    new = used & np.concatenate([[True], ~used[:-1] | (of[1:] != of[:-1])])[:len(used)]
    run = np.cumsum(new)[used] - 1
    place = np.flatnonzero(used)
    size = np.bincount(run) if len(run) else np.zeros(0, np.int64)
    keep = size[run] >= phrases.shortest if len(run) else np.zeros(0, bool)
    place, run = place[keep], run[keep]
    delta = np.zeros(len(symbols) + 1, np.int32)
    if not len(place) or not len(phrases.patterns):
        return delta[:-1] > 0, items
    # Runs behind each other, with a separator behind each.
    ends = np.append(run[1:] != run[:-1], True)
    to = np.arange(len(place)) + np.concatenate([[0], np.cumsum(ends)[:-1]])
    sequence = np.zeros(len(place) + int(ends.sum()), np.int32)
    sequence[to] = symbols[place]
    source = np.zeros(len(sequence), np.int64)
    source[to] = place
    index = FMIndex(sequence, len(phrases.vocabulary) + 1)
    first, behind = index.search(phrases.patterns, phrases.lengths)
    count = np.maximum(behind - first, 0)
    pattern = np.repeat(np.arange(len(count)), count)
    rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) \
        + np.repeat(first, count)
    begins = source[index.locate(rows)]
    np.add.at(delta, begins, 1)
    np.add.at(delta, begins + phrases.lengths[pattern], -1)
    found = np.unique(np.stack([of[begins], pattern]), axis=1)
    for text, p in found.T.tolist():
        items[text] += [str(phrases.items[i]) for i in phrases.holders[
            phrases.holder_first[p]:phrases.holder_first[p + 1]].tolist()]
    return np.cumsum(delta[:-1]) > 0, [list(dict.fromkeys(x)) for x in items]


def _spans(words: Words, hit: np.ndarray, old: list[list[dict]]) -> list[list[dict]]:
    """Merged runs of hit words per text, with those that an earlier block has found."""
    of, base = words.of(), words.offsets[:-1]
    hit = hit.copy()
    for text, spans in enumerate(old):
        for span in spans:
            a, b = words.first[text], words.first[text + 1]
            begins = words.begins[a:b] - base[text]
            hit[a:b] |= (begins >= span["start"]) & (begins < span["end"])
    before = np.concatenate([[False], hit[:-1] & (of[1:] == of[:-1])])[:len(hit)]
    begin = np.flatnonzero(hit & ~before)
    after = np.concatenate([hit[1:] & (of[1:] == of[:-1]), [False]])[:len(hit)]
    end = np.flatnonzero(hit & ~after)
    out: list[list[dict]] = [[] for _ in range(len(words.counts))]
    for text, a, b, n in zip(of[begin].tolist(), (words.begins[begin] - base[of[begin]]).tolist(),
                             (words.ends[end] - base[of[end]]).tolist(), (end - begin + 1).tolist()):
        out[text].append({"start": a, "end": b, "words": n})
    return out


def _without(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    data, at, left = text.encode(), 0, []
    for span in spans:
        left.append(data[at:span["start"]])
        at = span["end"]
    return b"\n".join([*left, data[at:]]).decode()
