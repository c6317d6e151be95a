"""Language identification: script ranges, word scores, and Viterbi over mixed-language text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import mix, powers, small_batches, text_chunks

#: First and last code point of scripts (Unicode blocks).
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF),
              (0xFB00, 0xFB06), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "ethiopic": ((0x1200, 0x139F),),
    "khmer": ((0x1780, 0x17FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)),
    "han": ((0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
            (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
UNKNOWN = "und"
#: Slots of the hashed n-gram table, documents per language to learn from, cost of a switch of
#: language between two words (nats), and the share of a language's words below which a script
#: is not its own.
SLOTS, LEARN_DOCS, SWITCH, SCRIPT_SHARE = 1 << 16, 4000, 12.0, 0.01
_GRAMS = (1, 2, 3, 4)
#: Text bytes of a chunk (long, so that few words are scored twice), distinct words of a block.
_CHUNK, _WORDS = 1 << 20, 16_384


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it a letter, its lower case, the number of its script (0: other)."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter, lower, script = np.zeros(len(points), bool), points.copy(), np.zeros(len(points), np.uint8)
    for block in range(0, 0x110000, 0x1000):
        if 0xD800 <= block < 0xE000 or 0x33000 <= block:
            continue
        for c in map(chr, range(block, block + 0x1000)):
            if c.isalpha():
                letter[ord(c)] = True
                if len(low := c.lower()) == 1:
                    lower[ord(c)] = ord(low)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first:last + 1] = number
    return letter, lower, script


class LetterWords:
    """Runs of letters of texts, as distinct words: ``which`` has the number of the distinct word
    for each word in the texts, ``first`` the number of words before each text."""

    def __init__(self, texts: list[str | None]):
        letter, lower, script = _characters()
        sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer("".join(t for t in texts if t).encode(
            "utf-32-le", "surrogatepass"), np.uint32)
        inside = letter[points]
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[:1], before[1:], after[-1:], after[:-1] = False, inside[:-1], False, inside[1:]
        edges = offsets[:-1][offsets[:-1] < len(points)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        self.begins = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.offsets, self.points = offsets, points
        self.first = np.searchsorted(self.begins, offsets)
        self.low = lower[points].astype(np.uint64)
        # A word is known by its polynomial hash; the table below needs no more than that.
        up, down = powers(len(points) + 1)
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mix(self.low + np.uint64(1)) * up[:len(points)], out=total[1:])
        hashes = mix((total[self.ends] - total[self.begins]) * down[self.begins])
        _, self.example, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        self.script = script[points[self.begins[self.example]]] if len(self.example) \
            else np.zeros(0, np.uint8)

    def blocks(self) -> Iterator[slice]:
        """The distinct words, some thousand at a time."""
        return (slice(a, min(a + _WORDS, len(self.example)))
                for a in range(0, len(self.example), _WORDS))

    def grams(self, block: slice) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the n-grams of a block of distinct words (with their edges marked), word after
        word, and where each word's begin."""
        begins, ends = self.begins[self.example[block]], self.ends[self.example[block]]
        sizes = ends - begins
        at = np.concatenate([[0], np.cumsum(sizes + 2)])
        marked = np.ones(at[-1], np.uint64)
        source = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        marked[source + np.repeat(at[:-1] + 1, sizes)] = self.low[source + np.repeat(begins, sizes)]
        word = np.repeat(np.arange(len(sizes)), sizes + 2)
        left = np.repeat(at[1:], sizes + 2) - np.arange(at[-1])  # characters to the word's end
        slots = np.full((len(marked), len(_GRAMS)), -1, np.int32)
        rolled = np.zeros(len(marked), np.uint64)
        for n in range(1, max(_GRAMS) + 1):
            rolled[:len(marked) - n + 1] += mix(marked[n - 1:] + np.uint64(n << 32))
            if n in _GRAMS:
                slots[:, _GRAMS.index(n)] = np.where(
                    left >= n, mix(rolled + np.uint64(n)) % np.uint64(SLOTS), -1).astype(np.int32)
        flat, owner = slots.ravel(), np.repeat(word, len(_GRAMS))
        used = flat >= 0
        flat, owner = flat[used], owner[used]
        return flat, np.searchsorted(owner, np.arange(len(sizes)))


@dataclass
class Model:
    """``table[slot, language]``: log-probabilities of n-grams. ``scripts[script, language]``:
    whether the language is written in it."""

    languages: list[str]
    table: np.ndarray
    scripts: np.ndarray


def last_hash(wanted: int, of: int) -> int:
    """The signed 64-bit hash up to which ``wanted`` of ``of`` rows lie, or so."""
    return -(1 << 63) + min(wanted * (1 << 64) // of, (1 << 64) - 1)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = LEARN_DOCS) -> Model:
    """Count character n-grams of labelled texts, ``per_language`` of each language or so.

    The sample is the documents whose id hashes lowest, by a share that follows from the
    language's count; its bound is the parameter. Counts are summed per task before the shuffle;
    the driver gets languages times ``SLOTS`` numbers at most. Rows without text or language
    are not used; a language whose sample has no letter is not learned; without any, the model has
    no language.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((SLOTS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    # The last hash that is learned from: of 64 bits, so that the share of a language of any size
    # keeps its documents.
    last = {lang: last_hash(per_language, n) for lang, n in counts.items()}
    limits = F.create_map(*[F.lit(x).cast(kind) for lang in languages
                            for x, kind in ((lang, "string"), (last[lang], "long"))])
    rows = rows.where(F.xxhash64("id") <= limits[F.col("lang").cast("string")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in text_chunks(batches, "text", _CHUNK):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for lang in set(langs):
                words = LetterWords([t for t, l in zip(texts, langs) if l == lang])
                if not len(words.which):
                    continue
                times = np.bincount(words.which)
                into = sums.setdefault(lang, np.zeros(SLOTS + len(SCRIPTS) + 1, np.int64))
                for block in words.blocks():
                    slots, starts = words.grams(block)
                    sizes = np.diff(np.append(starts, len(slots)))
                    into[:SLOTS] += np.bincount(
                        slots, np.repeat(times[block], sizes), SLOTS).astype(np.int64)
                into[SLOTS:] += np.bincount(words.script, times, len(SCRIPTS) + 1).astype(np.int64)
        for lang, into in sums.items():
            used = np.flatnonzero(into)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(used)), "slot": pa.array(used, pa.int32()),
                "n": pa.array(into[used], pa.int64())})

    found = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot") \
        .agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(found["lang"]))  # a language without a letter in its sample is none
    sums = np.zeros((SLOTS + len(SCRIPTS) + 1, len(languages)))
    number = {lang: i for i, lang in enumerate(languages)}
    sums[found["slot"].to_numpy(), found["lang"].map(number).to_numpy(int)] = found["n"].to_numpy()
    grams, scripts = sums[:SLOTS] + 0.5, sums[SLOTS:]
    table = np.log(grams / grams.sum(0)).astype(np.float32)
    return Model(languages, table, scripts > SCRIPT_SHARE * scripts.sum(0))


def best_path(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The language of each word on its text's best path: word scores less ``switch`` for each
    change. All texts step together, word by word, longest text first."""
    kind = np.min_scalar_type(-max(scores.shape[1], 1))  # signed, holds any language's number
    labels = np.zeros(len(scores), kind)
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    starts, lengths = first[:-1][order], counts[order]
    steps = int(lengths[0]) if len(lengths) else 0
    if not steps:
        return labels
    active = np.searchsorted(-lengths, -np.arange(1, steps + 1), "right")
    origin = np.empty(scores.shape, kind)
    own = np.arange(scores.shape[1], dtype=kind)
    value = scores[starts[:active[0]]].astype(np.float64)
    finals = np.zeros(len(lengths), kind)
    for t in range(1, steps):
        n, was = active[t], active[t - 1]
        if n < was:
            finals[n:was] = value[n:].argmax(1)
            value = value[:n]
        top = value.argmax(1).astype(kind)
        moved = value[np.arange(n), top][:, None] - switch
        stay = value >= moved
        at = starts[:n] + t
        origin[at] = np.where(stay, own, top[:, None])
        value = np.where(stay, value, moved) + scores[at]
    finals[:len(value)] = value.argmax(1)
    state = finals.copy()
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        if t:
            state[:n] = origin[at, state[:n]]
    return labels


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           switch: float = SWITCH, spans: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and, if asked for, ``spans`` of (start, end, lang)
    in code points.

    Words are runs of letters. The script of a word's first letter leaves the languages written
    in it; each of these scores the word by its character n-grams; the best path over all words,
    less ``switch`` for each change of language, labels the spans. The document's language is the
    one with the most letters, ``score`` its share of them.

    Defined cases: a null text or one without a letter is ``und`` with score 0; a word in a script
    that no language uses is scored alike for all; a model without languages says ``und``. Repeated
    rows get equal answers. Columns of the result's names are replaced.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages times SLOTS numbers
    made = ("lang_pred", "score", "spans")
    rows = docs.drop(*made)
    kinds = "lang_pred string, score double" + (
        ", spans array<struct<start:int,end:int,lang:string>>" if spans else "")
    schema = f"{rows.schema.simpleString()[7:-1]},{kinds}"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in text_chunks(batches, text_col, _CHUNK):
            words = LetterWords(batch.column(text_col).to_pylist())
            langs, scores, found = _decide(words, known, switch, spans)
            out = batch.append_column("lang_pred", pa.array(langs, pa.string())) \
                .append_column("score", pa.array(scores, pa.float64()))
            yield out.append_column("spans", found) if spans else out

    return rows.mapInArrow(label, schema)


def _decide(words: LetterWords, model: Model, switch: float, spans: bool):
    texts, count = len(words.first) - 1, len(model.languages)
    if not len(words.which) or not count:
        empty = pa.array([[]] * texts, pa.list_(pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
        return [UNKNOWN] * texts, np.zeros(texts), empty
    each = np.empty((len(words.example), count), np.float32)
    for block in words.blocks():
        slots, starts = words.grams(block)
        each[block] = np.add.reduceat(model.table[slots], starts)
    allowed = model.scripts[words.script]
    each = np.where(allowed | ~allowed.any(1, keepdims=True), each, each.min() - 1000)
    each[~allowed.any(1)] = 0
    labels = best_path(each[words.which], words.first, switch)
    sizes = words.ends - words.begins
    of = np.repeat(np.arange(texts), np.diff(words.first))
    letters = np.bincount(of * count + labels, sizes, texts * count).reshape(texts, count)
    total = letters.sum(1)
    best = letters.argmax(1)
    langs = [model.languages[b] if t else UNKNOWN for b, t in zip(best, total)]
    scores = np.where(total > 0, letters.max(1) / np.maximum(total, 1), 0.0)
    found = None
    if spans:
        change = np.flatnonzero(np.diff(labels, prepend=-1) | np.diff(of, prepend=-1))
        last = np.append(change[1:], len(labels)) - 1
        owner = of[change]
        base = words.offsets[owner]
        found = [[] for _ in range(texts)]
        for d, a, b, l in zip(owner.tolist(), (words.begins[change] - base).tolist(),
                              (words.ends[last] - base).tolist(), labels[change].tolist()):
            found[d].append({"start": a, "end": b, "lang": model.languages[l]})
        found = pa.array(found, pa.list_(pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
    return langs, scores, found
