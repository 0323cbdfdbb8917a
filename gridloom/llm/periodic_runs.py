"""Stretches of words that repeat with a period, found by a sparse diagonal scan of each text.

Two words ``lag`` apart that are equal lie on the diagonal of that lag. The scan goes
through the words of a text once; for each word its earlier occurrences open diagonals or
lengthen the active ones by one match, and a diagonal that breaks gives a run at once if it
is long enough: ``matches + lag >= max(MIN_LENGTH, MIN_REPEATS * lag)``.

Which earlier occurrences open a diagonal is decided beforehand, exactly. A run of period q
matches at least 3q words in a row, hence two neighbouring blocks of b <= q words each, for
the power of two b with b <= q < 2b and blocks cut at every b-th word. So for each b all
blocks are compared, by 64-bit hashes doubled in length each time, with the b positions at admissible lags, and a diagonal
opens where two neighbours agree: n comparisons for each of log2(n / 4) sizes, however often
a word occurs. What opens spans more than two periods, so few diagonals are ever active.
A lag that is a multiple of an active one inside the same stretch is not opened: its run
has the smaller period.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; runs
may overlap; repeated rows are judged one by one; other columns are carried as they are
and the result's struct takes another name where the table has ``runs``.
Words and blocks are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridloom.llm.flatwords import FlatWords, mix64, word_chunks

MIN_LENGTH = 6
#: The block test rests on at least 4 repeats; fewer are an error.
MIN_REPEATS = 4
_SEPARATOR = np.uint64(0xD6E8FEB86659FD93)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN, False)),
    T.StructField("collapsed", T.StringType()),
])


def _chained(words: FlatWords) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one row, a separator of its own after each text, and each text's first place."""
    first = words.first_word + np.arange(words.texts + 1)
    chain = np.zeros(len(words.starts) + words.texts, np.uint64)
    chain[np.arange(len(words.starts)) + words.owner()] = words.hashes()
    chain[first[1:] - 1] = mix64(np.arange(words.texts, dtype=np.uint64) + _SEPARATOR)
    return chain, first


def openings(chain: np.ndarray, longest: int, repeats: int = MIN_REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) where two neighbouring blocks agree with what stands ``lag`` words before, by place, then lag."""
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size, block = 1, chain | np.uint64(1)  # never 0, which marks what lies outside
    while repeats * size <= longest:
        own = block[size::size]
        # Row j holds the blocks that begin 2 * size - 1 to size places before block j + 1.
        room = np.zeros(len(own) * size, np.uint64)
        some = max(len(room) - (size - 1), 0)
        room[len(room) - some :] = block[:some]
        same = room.reshape(len(own), size) == own[:, None]
        if len(own) > 1:
            both = same[:-1] & same[1:]
            both[1:] &= ~(same[:-2] & same[1:-1])  # the diagonal is open already
            row, column = np.nonzero(both)
            places.append((row + 1) * size)
            lags.append(2 * size - 1 - column)
        block = mix64(block[: max(len(block) - size, 0)]) * _MULTIPLIER + block[size:] | np.uint64(1)
        size *= 2
    place, lag = np.concatenate(places), np.concatenate(lags)
    by = np.lexsort((lag, place))
    return place[by], lag[by]


def scan_runs(words: list[int], opened: list[tuple[int, int]], least: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> list[Run]:
    """(start, length, period) of one text's runs by start, then period; ``opened`` are its (place, lag) openings."""
    runs: list[Run] = []
    active: dict[int, int] = {}
    n, i, at = len(words), 0, 0

    def close(lag: int) -> None:
        length = active.pop(lag) + lag
        if length >= max(least, repeats * lag):
            runs.append((i - length, length, lag))

    while at < len(opened) or active:
        if not active:
            i = opened[at][0]
        while at < len(opened) and opened[at][0] == i:
            lag = opened[at][1]
            at += 1
            if lag in active or any(lag % p == 0 and matched + p >= lag for p, matched in active.items()):
                continue
            j = i
            while j > lag and words[j - 1] == words[j - 1 - lag]:
                j -= 1
            active[lag] = i - j
        if i == n:
            break
        word = words[i]
        for lag in tuple(active):
            if words[i - lag] == word:
                active[lag] += 1
            else:
                close(lag)
        i += 1
    for lag in tuple(active):
        close(lag)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _text_runs(words: FlatWords, least: int, repeats: int) -> dict[int, list[Run]]:
    """Runs of the texts of a chunk that have any."""
    chain, first = _chained(words)
    place, lag = openings(chain, int(words.n_words().max(initial=0)), repeats)
    if not len(place):
        return {}
    owner = np.searchsorted(first, place, "right") - 1
    found: dict[int, list[Run]] = {}
    edges = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        text = int(owner[a])
        hashes = chain[first[text] : first[text + 1] - 1].tolist()
        opened = list(zip((place[a:b] - first[text]).tolist(), lag[a:b].tolist(), strict=True))
        if runs := scan_runs(hashes, opened, least, repeats):
            found[text] = runs
    return found


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    kept = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return [w for w, k in zip(words, kept, strict=True) if k]


def _finder(text_at: int, out_at: list[int], name: str, least: int, repeats: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, words in word_chunks(batch.column(text_at)):
                runs = _text_runs(words, least, repeats)
                cut = words.bounds.tolist()
                data = words.data.tobytes()
                collapsed = []
                for t in range(words.texts):
                    text = data[cut[t] : cut[t + 1]].split()
                    collapsed.append(b" ".join(collapse(text, runs[t]) if t in runs else text))
                found = [[dict(zip(RUN.names, r, strict=True)) for r in runs.get(t, ())] for t in range(words.texts)]
                struct = pa.StructArray.from_arrays(
                    [
                        pa.array(words.n_words(), pa.int64()),
                        pa.array(found, pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=FOUND.names,
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(row, end - row) for i in out_at] + [struct], names=[batch.schema.names[i] for i in out_at] + [name]
                )

    return find


def find_runs(
    documents: DataFrame, carry: list[str] | None = None, least: int = MIN_LENGTH, repeats: int = MIN_REPEATS
) -> tuple[DataFrame, str]:
    """``carry`` columns and a struct (n_words, runs, collapsed), and that column's name."""
    if repeats < MIN_REPEATS:
        raise ValueError(f"runs of fewer than {MIN_REPEATS} periods are not found by the block test")
    carry = documents.columns if carry is None else carry
    name = "runs"
    while name in documents.columns:
        name += "_"
    needed = list(dict.fromkeys([*carry, "text"]))
    run = _finder(needed.index("text"), [needed.index(c) for c in carry], name, least, repeats)
    schema = T.StructType([documents.schema[c] for c in carry] + [T.StructField(name, FOUND)])
    return documents.select(*needed).mapInArrow(run, schema), name
