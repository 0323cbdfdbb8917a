"""Tokens of documents and of their sections, from one encoding of the whole text.

A text is encoded once. The byte lengths of its tokens give every token's span
of code points, and those spans are joined with the sections' spans by binary
search. A token that touches several sections is allocated by ``rule``:

* ``majority`` (default): the section that holds most of its code points, the
  earliest of equals;
* ``first`` / ``last``: the section of its first / last code point;
* ``share``: to each section the share of its code points there.

A token of a part of a code point counts as spanning all of it.

The vocabulary file (tiktoken ranks) is read on the driver and broadcast: it is
a parameter, of a fixed size of about a megabyte.

Defined cases: a null or empty text has one empty section with no tokens;
characters outside all sections go to a section numbered -1, listed only where
it has tokens; repeated rows are counted one by one; columns other than the id
and the text are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the word pattern that the public byte-level vocabulary was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("majority", "first", "last", "share")

Sections = Callable[[str], tuple[np.ndarray, np.ndarray]]


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of lines in code points; a line break belongs to its line."""
    breaks, at = [0], text.find("\n")
    while at >= 0:
        breaks.append(at + 1)
        at = text.find("\n", at + 1)
    starts = np.array(breaks)
    return starts, np.append(starts[1:], len(text))


class Encoder:
    """Encodes a text and gives its tokens' spans."""

    def __init__(self, ranks_file: bytes, pattern: str = PATTERN):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines()) if token}
        self._encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in code points."""
        tokens = np.asarray(self._encoding.encode_to_numpy(text), np.int64)
        ends = np.cumsum(self._bytes[tokens])
        starts = ends - self._bytes[tokens]
        if text.isascii():
            return starts, ends
        data = np.frombuffer(text.encode(), np.uint8)
        point = np.cumsum((data & 0xC0) != 0x80) - 1
        return point[starts], point[ends - 1] + 1


def allocate(starts: np.ndarray, ends: np.ndarray, from_: np.ndarray, to: np.ndarray, rule: str) -> tuple[np.ndarray, int, int]:
    """(tokens of each section, tokens outside, tokens that touch more than one section).

    Sections are ascending and do not overlap; an empty one holds nothing.
    """
    counts = np.zeros(len(from_), np.float64)
    full = np.flatnonzero(to > from_)
    if not len(full):
        return counts, len(starts), 0
    lo, hi = from_[full], to[full]
    first = np.searchsorted(hi, starts, "right")  # the first section that ends after the token's start
    last = np.searchsorted(lo, ends, "left") - 1  # the last one that starts before its end
    inside = first <= last
    one = inside & (first == last)
    held = np.bincount(first[one], minlength=len(full)).astype(np.float64)
    several = np.flatnonzero(inside & (first < last))
    shares: dict[int, Fraction] = {}
    for i in several:
        sections = np.arange(first[i], last[i] + 1)
        size = np.minimum(hi[sections], ends[i]) - np.maximum(lo[sections], starts[i])
        if rule == "share":
            for s, n in zip(sections, size, strict=True):
                shares[s] = shares.get(s, Fraction(0)) + Fraction(int(n), int(size.sum()))
        else:
            held[sections[{"majority": int(np.argmax(size)), "first": 0, "last": -1}[rule]]] += 1
    for s, share in shares.items():
        held[s] += float(share)
    counts[full] = held
    return counts, int((~inside).sum()), len(several)


_encoders: dict[int, Encoder] = {}


def count_tokens(
    documents: DataFrame, vocabulary: str = VOCABULARY, rule: str = "majority", sections: Sections = line_sections, pattern: str = PATTERN
) -> DataFrame:
    """One row per section: (doc_id, section, start, end, n_tokens, doc_tokens, doc_crossing)."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    with open(vocabulary, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(hash(ranks.value))
        if encoder is None:
            _encoders.clear()
            encoder = _encoders[hash(ranks.value)] = Encoder(ranks.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece = batch.slice(start, 1000)
                owner, number, from_, to, tokens, of_doc, crossing = [], [], [], [], [], [], []
                for row, scalar in enumerate(piece.column(1)):
                    text = scalar.as_py() or ""
                    a, b = sections(text)
                    starts, ends = encoder.spans(text) if text else (np.zeros(0, np.int64),) * 2
                    held, outside, several = allocate(starts, ends, a, b, rule)
                    n = np.arange(len(a))
                    if outside:
                        n, a, b, held = np.append(n, -1), np.append(a, 0), np.append(b, 0), np.append(held, outside)
                    owner.append(np.full(len(n), row))
                    number.append(n)
                    from_.append(a)
                    to.append(b)
                    tokens.append(held)
                    of_doc.append(np.full(len(n), len(starts)))
                    crossing.append(np.full(len(n), several))
                if not owner:
                    continue
                flat = [np.concatenate(x) for x in (number, from_, to, tokens, of_doc, crossing)]
                arrays = [pa.array(x, pa.float64() if i == 3 else pa.int64()) for i, x in enumerate(flat)]
                if rule != "share":
                    arrays[3] = arrays[3].cast(pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(np.concatenate(owner))), *arrays], names=fields)

    table = documents.select("doc_id", "text")
    fields = ["doc_id", "section", "start", "end", "n_tokens", "doc_tokens", "doc_crossing"]
    kinds = [T.DoubleType() if f == "n_tokens" and rule == "share" else T.LongType() for f in fields[1:]]
    return table.mapInArrow(run, T.StructType([table.schema["doc_id"], *map(T.StructField, fields[1:], kinds)]))
