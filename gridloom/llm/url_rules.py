"""URL verdicts from host rules and wildcard rules, all matched at once by one bit-parallel automaton.

A URL is judged in its canonical form, host and path next to each other: the host stands
after the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case;
the path follows up to ``?``, ``#`` or the end.

Every rule becomes globs over that form. In a glob ``**`` stands for any text, ``*`` for any
text without ``/``, ``?`` for one character other than ``/`` and all else for itself; a glob without ``/`` judges the
host alone, whatever the path. The globs are packed into the masks of one Shift-And automaton of as many
64-bit words as their characters need: a bit for the start and for each character of each
glob, masks ``follow[byte]`` of the bits a byte may enter and ``stay[byte]`` of the bits
that a wildcard keeps alive over it. One step for a byte is

    state = (state << 1 & follow[byte]) | (state & stay[byte])

with the carry between words, taken for all URLs of a chunk at once; bits of the last
characters that are set after a URL's last byte are the globs that match it.

Host rules (``HostRule``) fit their host and all its subdomains where the path starts with
theirs; of those that fit a URL the longest wins (host and path counted together, then the
longer host, then block before allow), and its verdict counts. Where none fits, the URL is blocked if a blocking glob matches and no
allowing one does.

Defined cases: a null URL or one without ``://`` has an empty host and path and is judged
like any other; urls of any length are read to their end; repeated rows are judged one by
one; other columns are carried as they are, and the result's struct takes another name where
the table has ``judged``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.flatwords import chunks

ALLOW, BLOCK = "allow", "block"
#: Bytes of automaton states that one step works on.
STATE_BYTES = 4 << 20
#: The masks are part of each task; rules that need more are an error.
MAX_MASK_BYTES = 256 << 20


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Glob:
    verdict: str
    pattern: str


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*+)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*+([^?#]*+)", 1), F.lit(""))


_ANY = np.ones(256, bool)
_NO_SLASH = _ANY.copy()
_NO_SLASH[ord("/")] = False
_FOLLOWS = np.zeros(256, bool)  # second and later bytes of a UTF-8 character
_FOLLOWS[0x80:0xC0] = True


def _tokens(glob: str, literal: bool = False) -> list[tuple[str, int]]:
    """("byte", value), ("one", 0), ("part", 0) for ``*`` and ("all", 0) for ``**``."""
    out: list[tuple[str, int]] = []
    i = 0
    while i < len(glob):
        if not literal and glob.startswith("**", i):
            out.append(("all", 0))
            i += 2
            continue
        char = glob[i]
        if not literal and char in "*?":
            out.append(("part" if char == "*" else "one", 0))
        else:
            out += [("byte", b) for b in char.encode()]
        i += 1
    return out


def glob_tokens(pattern: str) -> list[list[tuple[str, int]]]:
    """The automaton's patterns of one glob: two, with and without a path, where it judges the host alone."""
    whole = _tokens(pattern)
    return [whole] if "/" in pattern else [whole, whole + _tokens("/**")]


def rule_tokens(rule: HostRule) -> list[list[tuple[str, int]]]:
    """A host rule as globs: the host itself and its subdomains, then the path and whatever follows.

    A rule with an empty path fits hosts with and without one.
    """
    rests = [_tokens(rule.path, True) + [("all", 0)]] if rule.path else [[], _tokens("/**")]
    heads = [_tokens(rule.host, True), [("part", 0), *_tokens("." + rule.host, True)]]
    return [head + rest for head in heads for rest in rests]


class Automaton:
    """Masks of all patterns, packed one after the other across 64-bit words."""

    def __init__(self, patterns: list[list[tuple[str, int]]]):
        bits = sum(1 + sum(kind in ("byte", "one") for kind, _ in p) for p in patterns)
        self.words = max(1, -(-bits // 64))
        if 2 * 256 * 8 * self.words > MAX_MASK_BYTES:
            raise ValueError(f"{len(patterns)} patterns need masks of more than {MAX_MASK_BYTES} bytes")
        self.follow = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.last: list[int] = []
        at = 0
        for pattern in patterns:
            self._set(self.start[None, :], np.ones(1, bool), at)
            for kind, value in pattern:
                if kind == "byte":
                    at += 1
                    self._set(self.follow, np.arange(256) == value, at)
                elif kind == "one":
                    at += 1
                    self._set(self.follow, _NO_SLASH & ~_FOLLOWS, at)
                    self._set(self.stay, _FOLLOWS, at)
                else:
                    self._set(self.stay, _ANY if kind == "all" else _NO_SLASH, at)
            self.last.append(at)
            at += 1

    @staticmethod
    def _set(masks: np.ndarray, bytes_: np.ndarray, bit: int) -> None:
        masks[bytes_, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def matches(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(text, pattern): whether the whole text fits the pattern."""
        out = np.zeros((len(bounds) - 1, len(self.last)), bool)
        word, bit = np.array(self.last, np.int64) // 64, (np.array(self.last, np.int64) % 64).astype(np.uint64)
        rows = max(1, STATE_BYTES // (8 * self.words))
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        for a in range(0, len(order), rows):
            part = order[a : a + rows]
            state = np.tile(self.start, (len(part), 1))
            ends, starts = lengths[part], bounds[:-1][part]
            # The longest stand first: those that are still read are always a prefix.
            for t in range(int(ends[0]) if len(ends) else 0):
                n = int(np.searchsorted(-ends, -t, "left"))
                byte = data[starts[:n] + t]
                now = state[:n]
                moved = now << np.uint64(1)
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
                state[:n] = (moved & self.follow[byte]) | (now & self.stay[byte])
            out[part] = (state[:, word] >> bit) & np.uint64(1) != 0
        return out


JUDGED = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()), T.StructField("globs", T.ArrayType(T.StringType(), False))])


def _judge(rules: list[HostRule], globs: list[Glob], url_at: int, out_at: list[int], name: str):
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != BLOCK))
    patterns, of_rule, of_glob = [], [], []
    for i, rule in enumerate(ranked):
        for tokens in rule_tokens(rule):
            patterns.append(tokens)
            of_rule.append(i)
    for i, glob in enumerate(globs):
        for tokens in glob_tokens(glob.pattern):
            patterns.append(tokens)
            of_glob.append(i)
    automaton = Automaton(patterns)
    names = np.array([r.name for r in ranked] + [None], object)
    verdicts = np.array([r.verdict for r in ranked] + [None], object)
    blocking = np.array([globs[i].verdict == BLOCK for i in of_glob], bool)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in chunks(batch.column(url_at)):
                hit = automaton.matches(data, bounds)
                fits, found = hit[:, : len(of_rule)], hit[:, len(of_rule) :]
                best = np.full(len(hit), len(ranked))
                if of_rule:
                    best = np.where(fits.any(axis=1), np.array(of_rule)[fits.argmax(axis=1)], best)
                block = (found & blocking).any(axis=1) & ~(found & ~blocking).any(axis=1)
                verdict = np.where(best < len(ranked), verdicts[best], np.where(block, BLOCK, ALLOW))
                listed = [[globs[i].pattern for i in dict.fromkeys(of_glob[j] for j in np.flatnonzero(f))] if any_ else [] for f, any_ in zip(found, found.any(axis=1), strict=True)]
                struct = pa.StructArray.from_arrays(
                    [pa.array(names[best], pa.string()), pa.array(verdict, pa.string()), pa.array(listed, pa.list_(pa.string()))], names=JUDGED.names
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(row, end - row) for i in out_at] + [struct], names=[batch.schema.names[i] for i in out_at] + [name]
                )

    return judge


def filter_urls(
    pages: DataFrame, rules: list[HostRule], globs: list[Glob], url: str = "url", carry: list[str] | None = None
) -> tuple[DataFrame, str]:
    """``carry`` columns and a struct (host, path, rule, verdict, globs), and that column's name.

    Only the carried columns and the URL are read.
    """
    carry = pages.columns if carry is None else carry
    taken = {c.lower() for c in pages.columns}
    free = []
    for wanted in ("judged", "__host", "__path", "__canonical"):
        while wanted in taken:
            wanted += "_"
        free.append(wanted)
    name, host, path, canonical = free
    kept = pages.select(*carry, host_of(F.col(url)).alias(host), path_of(F.col(url)).alias(path))
    ready = kept.withColumn(canonical, F.concat(host, path))
    passed = [*carry, host, path]
    run = _judge(rules, globs, len(passed), list(range(len(passed))), name)
    schema = T.StructType([ready.schema[c] for c in passed] + [T.StructField(name, JUDGED)])
    judged = ready.mapInArrow(run, schema)
    return judged.select(*carry, F.struct(F.col(host).alias("host"), F.col(path).alias("path"), f"{name}.*").alias(name)), name
