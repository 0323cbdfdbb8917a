"""Quality rules: exact base counts, and perplexity bands of an n-gram model per language.

The model is an interpolated modified Kneser-Ney model of order 4 over letters and
word borders; contexts reach across borders, from the end of a word into the next ones. It predicts one of 32
classes of UTF-8 bytes: Spark counts the n-grams over all distinct texts,
one group per language turns the counts into probabilities, and the result is
kept as arrays sorted by a hash of the n-gram, 16 bytes per n-gram of classes that
occurs, never more than ``MODEL_BYTES`` a language, and 12 for each four bytes that occur.

The letters of a class are told apart by a second model: the probability of the byte itself, given its
class and the two bytes before it as they stand (Witten-Bell back-off to one byte and to none). Class and
byte together are a distribution over all texts; ``exact_score`` is the mean over both.

Classes still merge what stands before a letter. So a third model, of the same kind and order as the first, is over
the bytes themselves: every four bytes that occur are counted as they stand, and no letter, case, digit
or script is merged with another, neither as the byte foretold nor before it. ``byte_score`` is its mean. Spark
counts those four bytes alone; the n-grams of classes and the triples of bytes are sums of them.

Copies are no evidence: texts are dealt by a digest of language and text, each task of the
reading side sends a text once, and the receiving side counts it once. Quartiles are taken over
distinct texts too, so adding copies of a text changes no verdict.

A language has a model and bands of its own where its distinct texts hold ``MIN_EVENTS`` letters
and borders, whatever other languages hold; the smaller ones and null share the model
of all texts, named ''. A document's score is the mean negative log probability (natural logarithm) of
its letters and word ends, each word under its own language's model or the one of all texts,
whichever expects it more: texts change their language, and a quotation is no fault.

Per model the scores of all distinct texts that pass the base rules give quartiles; a document outside
[q1 - spread * (q3 - q1), q3 + spread * (q3 - q1)], each side at least
``LEAST_WIDTH`` from its quartile, is rejected. ``score``, ``exact_score`` and ``byte_score`` have a band
each; a document lies in all.

Defined cases: a null text is empty; a text without words has no score and
fails the base rules; repeated rows are judged one
by one. ``rules`` is added under another name where the table has that column.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.flatwords import SPACE, FlatWords, mix64, span_hashes, sums_by_text, window_hashes, word_chunks
from gridloom.sources.scratch import materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SPREAD = 4.0
LEAST_WIDTH = 0.05
MIN_EVENTS = 200_000
ORDER, CLASSES = 4, 32
GRAMS = CLASSES**ORDER
#: Keys of 8 bytes and two 4-byte numbers for each n-gram of each order.
MODEL_BYTES = 16 * sum(CLASSES**k for k in range(1, ORDER + 1))
#: Steps in which scores are counted when their quartiles are looked up.
SCORE_STEP = 1 / 1024
_LANGUAGES_HELD = 16
#: Arrays of a model, as bytes, and their types.
MODEL = {"keys": np.uint64, "share": np.float32, "weight": np.float32, "quads": np.uint32, "times": np.int64}
#: All models are broadcast; more bytes than this are an error (raise ``MIN_EVENTS`` then).
MOST_MODEL_BYTES = 1 << 30

#: Each has a band of its own.
SCORES = ("score", "exact_score", "byte_score")
METRICS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(n, T.DoubleType()) for n in SCORES]
)


def _letter_classes() -> np.ndarray:
    """0 is the word border; letters share a class in both cases; digits, other ASCII and the
    lengths of longer UTF-8 characters have one each; the bytes that follow fold into letters."""
    table = np.full(256, 28, np.uint8)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    table[ord("0") : ord("9") + 1] = 27
    table[0xC0:0xE0], table[0xE0:0xF0], table[0xF0:] = 29, 30, 31
    follow = np.arange(0x80, 0xC0)
    table[0x80:0xC0] = 1 + (follow & 31) % 26
    table[BORDER] = 0
    return table


#: Stands for a word border among bytes; no word holds it.
BORDER = ord(" ")
_CLASS = _letter_classes()
#: Bytes of each class that words can hold, and the border.
_CLASS_SIZE = np.bincount(_CLASS[~SPACE | (np.arange(256) == BORDER)], minlength=CLASSES)
#: The two classes of two bytes.
_TWO_CLASSES = (_CLASS[:, None].astype(np.int32) << 5 | _CLASS[None, :]).reshape(-1)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def gram_events(words: FlatWords) -> tuple[np.ndarray, np.ndarray]:
    """Every byte and word border with the three bytes before it, as one number, in text order, and the event range of each text.

    Every text is preceded by three borders; each word's end is one more event.
    """
    solid = ~SPACE[words.data]
    lengths = words.ends - words.starts
    owner = words.owner()
    row = np.full(int((lengths + 1).sum()) + 3 * words.texts, BORDER, np.uint8)
    offset = np.arange(len(lengths)) + 3 * (owner + 1)
    letters = np.arange(int(lengths.sum())) + np.repeat(offset, lengths)
    row[letters] = words.data[solid]
    quad = row.astype(np.uint32)
    for back in (1, 2, 3):
        quad[back:] |= row[:-back].astype(np.uint32) << np.uint32(8 * back)
    event = np.zeros(len(row), bool)
    event[letters] = True
    event[np.cumsum(lengths) + offset] = True
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths + 1)])[words.first_word]
    return quad[event], first


def class_codes(quads: np.ndarray) -> np.ndarray:
    """Codes of the n-grams of classes that four bytes make."""
    return _TWO_CLASSES[quads >> 16] << 10 | _TWO_CLASSES[quads & 0xFFFF]


def _tally(held: tuple[np.ndarray, np.ndarray] | None, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and how often each came, with those held before."""
    code, n = np.unique(codes, return_counts=True)
    if held is None or not len(code):
        return (code, n) if held is None else held
    both, counts = np.concatenate([held[0], code]), np.concatenate([held[1], n])
    by = np.argsort(both, kind="stable")
    both = both[by]
    opens = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    return both[opens], np.add.reduceat(counts[by], opens)


_GRAMS = "lang string, gram long, n long"


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): how often four bytes came."""
    held: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (gram, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n, pa.int64())],
                names=["lang", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        langs = batch.column(1).to_pylist()
        for row, end, words in word_chunks(batch.column(0)):
            quads, first = gram_events(words)
            here = langs[row:end]
            kinds = {lang: i for i, lang in enumerate(dict.fromkeys(here))}
            of = np.repeat(np.array([kinds[x] for x in here]), np.diff(first))
            for lang, i in kinds.items():
                if lang not in held and len(held) >= _LANGUAGES_HELD:
                    yield from out()
                held[lang] = _tally(held.get(lang), quads[of == i])
    yield from out()


def _keys(order: int, grams: np.ndarray) -> np.ndarray:
    return mix64((np.uint64(order) << np.uint64(32)) + grams.astype(np.uint64))


def _discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """What is taken off counts of 0, 1, 2, and 3 or more, from how many n-grams were counted once to four times."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    steps = [0.0]
    for k, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        d = k - (k + 1) * y * high / low if low else y
        steps.append(min(max(d, 0.05), k - 0.05 if k > 1 else 0.95))
    return np.array(steps)


def kneser_ney(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hash arrays (keys, discounted share, weight of the shorter context) of all orders.

    The key of a context carries the weight, the key of an n-gram the share; an
    n-gram is also the context of longer ones, so both sit in one entry.
    """
    raw = counts.reshape((CLASSES,) * ORDER)
    tables: dict[int, np.ndarray] = {ORDER: raw}
    for order in range(ORDER - 1, 0, -1):
        longer = raw.sum(axis=tuple(range(ORDER - order - 1)))
        table = (longer > 0).sum(axis=0)
        if order > 1:  # n-grams that begin with a border, as every text does, count as they occur
            table[0] = longer.sum(axis=0)[0]
        tables[order] = table
    share: dict[int, np.ndarray] = {}
    weight: dict[int, np.ndarray] = {}
    for order, table in tables.items():
        flat = table.reshape(-1, CLASSES).astype(np.float64)
        cut = _discounts(*(float((flat == k).sum()) for k in (1, 2, 3, 4)))[np.minimum(flat, 3).astype(int)]
        total = flat.sum(axis=1, keepdims=True)
        safe = np.where(total > 0, total, 1)
        share[order] = ((flat - cut) / safe).reshape(-1)
        weight[order - 1] = np.where(total > 0, cut.sum(axis=1, keepdims=True) / safe, 1.0).reshape(-1)
    keys, shares, weights = [], [], []
    for order in range(ORDER + 1):
        s = share.get(order, np.zeros(1))
        w = weight.get(order, np.ones(CLASSES**order))
        there = np.flatnonzero((s > 0) | (w < 1))
        keys.append(_keys(order, there))
        shares.append(s[there])
        weights.append(w[there])
    keys = np.concatenate(keys)
    by = np.argsort(keys)
    return keys[by], np.concatenate(shares)[by].astype(np.float32), np.concatenate(weights)[by].astype(np.float32)


def _find(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray, absent: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], np.float32(absent))


def log_table(keys: np.ndarray, share: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log probability of every n-gram code, from the sorted arrays."""
    p = np.full(CLASSES, 1 / CLASSES)
    for order in range(1, ORDER + 1):
        grams = np.arange(CLASSES**order)
        own = _find(keys, _keys(order, grams), share, 0.0).astype(np.float64)
        back = _find(keys, _keys(order - 1, np.arange(CLASSES ** (order - 1))), weight, 1.0).astype(np.float64)
        # p over (context without its first letter, letter), repeated for each first letter
        shorter = p if order == 1 else np.tile(p, CLASSES)
        p = own + np.repeat(back, CLASSES) * shorter
    return np.log(np.maximum(p, 1e-12)).astype(np.float32)


def _in_class(times: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probability of each byte given its class, for contexts as rows: Witten-Bell, over that of the shorter context."""
    member = np.eye(CLASSES)[_CLASS]
    total, kinds = (times @ member)[:, _CLASS], ((times > 0).astype(np.float64) @ member)[:, _CLASS]
    return np.where(total > 0, (times + kinds * shorter) / np.maximum(total + kinds, 1), shorter)


def byte_table(triples: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each pair of bytes, column of each byte, log probabilities) of the byte given its class and the pair before.

    Pairs that do not occur share the row of their second byte. Bytes that do not occur are equally likely
    inside their class, so one column stands for all of them.
    """
    pairs, at = np.unique(triples >> 8, return_inverse=True)
    byte = triples & 255
    after = np.zeros((256, 256))
    np.add.at(after, ((triples >> 8) & 255, byte), times)
    alone = _in_class(after.sum(axis=0, keepdims=True), 1 / _CLASS_SIZE[_CLASS][None, :])
    one = _in_class(after, alone)
    occurs = after.sum(axis=0) > 0
    _, stands, column = np.unique(np.where(occurs, CLASSES + np.arange(256), _CLASS), return_index=True, return_inverse=True)
    logs = np.empty((256 + len(pairs), len(stands)), np.float32)
    logs[:256] = np.log(one[:, stands])
    by = np.argsort(at, kind="stable")
    for start in range(0, len(pairs), 1024):
        stop = min(start + 1024, len(pairs))
        here = by[np.searchsorted(at[by], start) : np.searchsorted(at[by], stop)]
        counts = np.zeros((stop - start, 256))
        counts[at[here] - start, byte[here]] = times[here]
        logs[256 + start : 256 + stop] = np.log(_in_class(counts, one[pairs[start:stop] & 255])[:, stands])
    row = np.arange(1 << 16, dtype=np.int32) & 255
    row[pairs] = 256 + np.arange(len(pairs))
    return row, column.astype(np.uint8), logs


def triple_counts(quads: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct last three of four bytes and how often each came."""
    triples, at = np.unique((quads & 0xFFFFFF).astype(np.int32), return_inverse=True)
    return triples, np.bincount(at, times, len(triples)).astype(np.int64)


@dataclass
class ByteModel:
    """Interpolated modified Kneser-Ney over the bytes as they stand; the log probability of each n-gram that occurs."""

    grams: dict[int, np.ndarray]  # sorted, by order
    logs: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]  # sorted; bytes before, by order of the n-gram
    weights: dict[int, np.ndarray]  # logs of the weight of the shorter context
    alone: np.ndarray  # log probability of each byte without context

    def log_probability(self, quads: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of the last byte, given those before it; ``quads`` are n-grams of ``order`` bytes."""
        if order == 1:
            return self.alone[quads]
        known = self.grams[order]
        at = np.minimum(np.searchsorted(known, quads), max(len(known) - 1, 0))
        met = known[at] == quads if len(known) else np.zeros(len(quads), bool)
        out = self.logs[order][at] if len(known) else np.zeros(len(quads), np.float32)
        if not met.all():
            rest = quads[~met]
            shorter = self.log_probability(rest & np.uint32((1 << 8 * (order - 1)) - 1), order - 1)
            if len(known):
                shorter = shorter + _find(self.contexts[order], rest >> np.uint32(8), self.weights[order], 0.0)
            out[~met] = shorter
        return out


def byte_model(quads: np.ndarray, times: np.ndarray) -> ByteModel:
    """From sorted distinct four bytes and how often each came; lower orders count as in ``kneser_ney``."""
    tables = {ORDER: (quads.astype(np.uint32), times.astype(np.float64))}
    raw = tables[ORDER]
    for order in range(ORDER - 1, 0, -1):
        grams, at = np.unique(raw[0] & np.uint32((1 << 8 * order) - 1), return_inverse=True)
        occurs = np.bincount(at, raw[1], len(grams))
        ways = np.bincount(at, minlength=len(grams)).astype(np.float64)
        raw = grams, occurs
        # n-grams that begin with a border, as every text does, count as they occur
        tables[order] = grams, np.where((grams >> np.uint32(8 * (order - 1))) == BORDER, occurs, ways) if order > 1 else ways
    p = np.full(256, 1 / _CLASS_SIZE.sum())
    logs, contexts, weights = {}, {}, {}
    for order in range(1, ORDER + 1):
        grams, counts = tables[order]
        cut = _discounts(*(float((counts == k).sum()) for k in (1, 2, 3, 4)))[np.minimum(counts, 3).astype(int)]
        contexts[order], of = np.unique(grams >> np.uint32(8), return_inverse=True)
        total = np.bincount(of, counts, len(contexts[order]))
        weight = np.bincount(of, cut, len(contexts[order])) / np.maximum(total, 1)
        own = (counts - cut) / total[of]
        if order == 1:
            p = p * (weight[0] if len(weight) else 1.0)
            p[grams] += own
            alone = np.log(p).astype(np.float32)
        else:
            below = tables[order - 1][0]
            shorter = p if order == 2 else lower
            lower = own + weight[of] * (shorter[grams & 255] if order == 2 else shorter[np.searchsorted(below, grams & np.uint32((1 << 8 * (order - 1)) - 1))])
            logs[order] = np.log(lower).astype(np.float32)
        weights[order] = np.log(weight).astype(np.float32)
    return ByteModel({k: g for k, (g, _) in tables.items()}, logs, contexts, weights, alone)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) with the n-gram of classes in place of the four bytes."""
    for batch in batches:
        codes = class_codes(batch.column(1).to_numpy().astype(np.uint32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.int64()), batch.column(2)], names=["lang", "gram", "n"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, quads, times): the four bytes of a batch of rows, one row for each language in it."""
    for batch in batches:
        of, langs = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
        quads, times = batch.column(1).to_numpy().astype(np.uint32), batch.column(2).to_numpy()
        arrays = [[part[langs == i].tobytes() for i in range(len(of))] for part in (quads, times)]
        yield pa.RecordBatch.from_arrays([pa.array(of, pa.string()), *(pa.array(x, pa.binary()) for x in arrays)], names=["lang", "quads", "times"])


def _smooth(pdf: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros(GRAMS, np.int64)
    counts[pdf["gram"].to_numpy()] = pdf["n"].to_numpy()
    parts = dict(zip(("keys", "share", "weight"), kneser_ney(counts), strict=True))
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], **{name: [part.tobytes()] for name, part in parts.items()}})


def _new_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, other, ...) whose two digests this task has not met."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        fresh = []
        for i, pair in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if pair not in seen:
                seen.add(pair)
                fresh.append(i)
        yield batch if len(fresh) == batch.num_rows else batch.take(pa.array(fresh, pa.int64()))


def _count_new_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the texts that this task has not met; one Python worker does both."""
    yield from _count_grams(batch.select(["text", "lang"]) for batch in _new_texts(batches))
    pa.default_memory_pool().release_unused()


def text_digests(text: Column, lang: Column) -> tuple[Column, Column]:
    """Two 64-bit digests that together tell a language's texts apart."""
    return F.xxhash64(lang, text), F.xxhash64(text, F.lit("other"), lang)


def dealt_texts(documents: DataFrame) -> DataFrame:
    """(key, other, text, lang) dealt by digest: all copies of a text meet in one task, each reading task sends one at most."""
    lang = F.col("lang").cast("string")
    one, two = text_digests(F.col("text"), lang)
    rows = documents.filter("text IS NOT NULL").select(one.alias("key"), two.alias("other"), "text", lang.alias("lang"))
    schema = "key long, other long, text string, lang string"
    return rows.mapInArrow(_new_texts, schema).repartition("key", "other")


def fit_perplexity(documents: DataFrame, min_events: int = MIN_EVENTS) -> DataFrame:
    """(lang, keys, share, weight, quads, times); '' is the model of all texts.

    A language has one row of n-grams of classes, at most ``MODEL_BYTES``, and as many of four bytes as
    Spark made of them; the arrays of its rows are one array in pieces.
    """
    counted = dealt_texts(documents).mapInArrow(_count_new_texts, _GRAMS)
    grams = materialise(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    own = grams.filter("lang IS NOT NULL AND lang != ''")
    large = own.groupBy("lang").agg(F.sum("n").alias("events")).filter(F.col("events") >= min_events).select("lang")
    whole = grams.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang"), "gram", "n")
    kept = materialise(own.join(F.broadcast(large), "lang", "left_semi").unionByName(whole))
    folded = kept.mapInArrow(_fold, _GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    classes = folded.groupBy("lang").applyInPandas(_smooth, "lang string, keys binary, share binary, weight binary")
    return materialise(classes.unionByName(kept.mapInArrow(_pack, "lang string, quads binary, times binary"), allowMissingColumns=True))


def base_counts(words: FlatWords) -> dict[str, np.ndarray]:
    data, texts = words.data, words.texts
    n_words = words.n_words()
    sizes = sums_by_text((((data & 0xC0) != 0x80) & ~SPACE[data]).astype(np.int64), words.bounds)
    symbols = sums_by_text(_SYMBOL[data].astype(np.int64), words.bounds)

    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([words.bounds[:-1], breaks + 1]), kind="stable")
    # A text that ends in a break opens an empty line at the next text's start; it holds no word.
    stops = np.append(starts[1:], len(data))
    stops = np.where((stops > starts) & (stops > 0) & (data[np.maximum(stops - 1, 0)] == 10) if len(data) else stops < 0, stops - 1, stops)
    holds = np.searchsorted(words.starts, stops) > np.searchsorted(words.starts, starts)
    starts, stops = starts[holds], stops[holds]
    owner = np.searchsorted(words.bounds, starts, "right") - 1
    line = mix64(span_hashes(words, starts, stops) + mix64(owner.astype(np.uint64)))
    _, earliest = np.unique(line, return_index=True)
    dup_lines = np.bincount(owner, minlength=texts) - np.bincount(owner[earliest], minlength=texts)

    grams, first = window_hashes(words, 3)
    of = np.repeat(np.arange(texts), np.diff(first))
    keyed = mix64(grams + mix64(of.astype(np.uint64)))
    by = np.argsort(keyed, kind="stable")
    same = keyed[by][1:] == keyed[by][:-1]
    again = np.zeros(len(keyed), bool)
    again[by[1:][same]] = True
    again[by[:-1][same]] = True
    covered = np.zeros(len(words.starts) + 1, np.int64)
    at = words.first_word[of[again]] + np.flatnonzero(again) - first[of[again]]
    for j in range(3):
        covered[at + j] = 1
    return {
        "n_words": n_words,
        "word_chars": sizes,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": sums_by_text(covered[:-1], words.first_word),
    }


@dataclass
class _Table:
    """What a task looks up in one model."""

    folded: np.ndarray
    exact: tuple[np.ndarray, np.ndarray, np.ndarray]
    bytes: ByteModel


_tables: dict[tuple[str, str], _Table] = {}


def _scorer(models, ticket: str, text_at: int, lang_at: int, out_at: list[int], name: str):
    """Adds the metrics to each batch; ``models`` is a broadcast of checked size."""

    def logs(lang: str, quads: np.ndarray) -> Iterator[np.ndarray]:
        """Log probability of each four bytes: of the class, of the byte inside the class too, of the byte after three bytes."""
        model = table(lang)
        first = model.folded[class_codes(quads)].astype(np.float64)
        yield first
        row, column, exact = model.exact
        yield first + exact[row[quads >> 8 & 0xFFFF], column[quads & 255]]
        yield model.bytes.log_probability(quads).astype(np.float64)

    def table(lang: str) -> _Table:
        key = ticket, lang
        if key not in _tables:
            stale = [k for k in _tables if k[0] != ticket]
            used = [k for k in _tables if k[0] == ticket and k[1]]
            for old in stale + used[: max(0, len(used) + 1 - _LANGUAGES_HELD)]:
                del _tables[old]
            *classes, quads, times = (np.frombuffer(part, kind) for part, kind in zip(models.value[lang], MODEL.values(), strict=True))
            by = np.argsort(quads)
            quads, times = quads[by], times[by]
            _tables[key] = _Table(log_table(*classes), byte_table(*triple_counts(quads, times)), byte_model(quads, times))
        return _tables[key]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(lang_at).to_pylist()
            for row, end, words in word_chunks(batch.column(text_at)):
                metrics = base_counts(words)
                quads, first = gram_events(words)
                distinct, which = np.unique(quads, return_inverse=True)
                events = np.diff(first)
                some = events > 0
                totals = np.zeros((len(SCORES), len(events)))
                if some.any():
                    opens = np.concatenate([[0], np.cumsum(words.ends - words.starts + 1)[:-1]])
                    sums = [np.add.reduceat(x[which], opens) for x in logs("", distinct)]
                    here = np.array(langs[row:end], object)
                    for lang in dict.fromkeys(langs[row:end]):
                        if lang:
                            at = np.flatnonzero(np.repeat(here == lang, events))
                            of = np.flatnonzero(np.repeat(here == lang, words.n_words()))
                            if len(of):
                                sizes = (words.ends - words.starts + 1)[of]
                                for known, own in zip(sums, logs(lang, distinct), strict=True):
                                    known[of] = np.maximum(known[of], np.add.reduceat(own[which[at]], np.cumsum(sizes) - sizes))
                    for total, known in zip(totals, sums, strict=True):
                        total[some] = np.add.reduceat(known, words.first_word[:-1][some])
                fields = [pa.array(metrics[f.name], pa.int64()) for f in METRICS.fields[: -len(SCORES)]]
                fields += [pa.array(-total / np.maximum(events, 1), pa.float64(), mask=~some) for total in totals]
                rules = pa.StructArray.from_arrays(fields, names=METRICS.fieldNames())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(row, end - row) for i in out_at] + [rules], names=[batch.schema.names[i] for i in out_at] + [name]
                )

    return score


def _free(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name


def score_documents(documents: DataFrame, models: DataFrame, carry: list[str], model: str) -> tuple[DataFrame, str]:
    """``carry`` columns and the metrics as a struct column, and its name; ``model`` is the column that names each row's model."""
    name = _free(documents.columns, "rules")
    spark = documents.sparkSession
    size = models.agg(F.sum(sum((F.coalesce(F.length(c), F.lit(0)) for c in MODEL), F.lit(0)))).first()[0] or 0
    if size > MOST_MODEL_BYTES:
        raise ValueError(f"models of {size} bytes are more than {MOST_MODEL_BYTES}")
    pieces: dict[str, list[Row]] = {}
    for r in models.collect():
        pieces.setdefault(r["lang"], []).append(r)
    held = {lang: tuple(b"".join(r[c] for r in rows if r[c]) for c in MODEL) for lang, rows in pieces.items()}
    needed = list(dict.fromkeys([*carry, "text", model]))
    schema = T.StructType([documents.schema[c] for c in carry] + [T.StructField(name, METRICS)])
    run = _scorer(spark.sparkContext.broadcast(held), uuid.uuid4().hex, needed.index("text"), needed.index(model), [needed.index(c) for c in carry], name)
    return documents.select(*needed).mapInArrow(run, schema), name


def perplexity_bands(scored: DataFrame, spread: float = SPREAD) -> DataFrame:
    """(model, low, high) from (model, score): quartiles of counted score steps, one row per model."""
    steps = scored.filter("score IS NOT NULL").groupBy("model", F.floor(F.col("score") / SCORE_STEP).alias("step")).count()
    up = Window.partitionBy("model").orderBy("step")
    all_ = Window.partitionBy("model")
    ranked = steps.select(
        "model", "step", F.sum("count").over(up).alias("upto"), F.sum("count").over(all_).alias("total")
    )
    found = ranked.groupBy("model").agg(
        (F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("step"))) * SCORE_STEP).alias("q1"),
        (F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("step"))) * SCORE_STEP).alias("q3"),
    )
    width = F.greatest((F.col("q3") - F.col("q1")) * spread, F.lit(LEAST_WIDTH))
    return found.select("model", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))


def quality_rules(
    documents: DataFrame, carry: list[str] | None = None, spread: float = SPREAD, min_events: int = MIN_EVENTS
) -> tuple[DataFrame, str]:
    """Documents with a struct of metrics, score, model and band, base_failed and kept, and that column's name."""
    carry = documents.columns if carry is None else carry
    models = fit_perplexity(documents, min_events)
    languages = [x["lang"] for x in models.select("lang").distinct().collect() if x["lang"]]
    lang = F.col("lang").cast("string")
    known = lang.isin(languages) if languages else F.lit(False)
    of, one, two = (_free(documents.columns, n) for n in ("__model", "__one", "__two"))
    modelled = documents.withColumn(of, F.when(known, lang).otherwise(F.lit(""))).withColumns(dict(zip((one, two), text_digests(F.col("text"), lang), strict=True)))
    scored, name = score_documents(modelled, models, [*carry, of, one, two], of)
    r = F.col(name)
    failed = (r["n_words"] < MIN_WORDS) | (r["n_repeat_words"] * 100 > r["n_words"] * MAX_REPEAT_PERCENT)
    judged = materialise(scored.withColumn(name, F.struct(f"{name}.*", failed.alias("base_failed"), F.col(of).alias("model"))))
    good = judged.filter(~r["base_failed"]).groupBy(F.col(of).alias("model"), one, two)
    good = good.agg(*[F.min(r[c]).alias(c) for c in SCORES])
    sides = {c: (c.replace("score", "low"), c.replace("score", "high")) for c in SCORES}
    each = [perplexity_bands(good.select("model", F.col(c).alias("score")), spread).toDF("model", *sides[c]) for c in SCORES]
    bands = materialise(reduce(lambda x, y: x.join(y, "model"), each)).withColumnRenamed("model", "__of")
    whole = judged.join(F.broadcast(bands), F.col("__of") == F.col(of), "left")
    within = reduce(and_, [r[c].between(*map(F.col, sides[c])) for c in SCORES])
    inside = ~r["base_failed"] & F.coalesce(within, F.lit(False))
    bounds = [F.col(c).alias(c) for pair in sides.values() for c in pair]
    return whole.withColumn(name, F.struct(f"{name}.*", *bounds, inside.alias("kept"))).select(*carry, name), name


def keep_good(documents: DataFrame, **settings) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    judged, name = quality_rules(documents, **settings)
    return judged.filter(F.col(name)["kept"]).select(*documents.columns)
