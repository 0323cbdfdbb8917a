"""Secrets in texts: fixed patterns, and literals assigned to sensitively named targets.

Base patterns (fixed by the contract of this operator) give spans of three kinds:
``assign``, ``access`` and ``hex``. Besides them each text is lexed for
assignments of source and configuration syntax - ``name = value``,
``name: value``, ``name: type = value``, ``name := value``, ``"name" => value``, ``table["name"] = value``,
``a, b = value, value``, ``name: |`` with an indented block, ``name = call(value)`` and
``<name>value</name>`` - into pairs of a name and a quoted or bare literal of any length.
A quoted literal ends at its own unescaped quote, a bare one at a blank or delimiter; parentheses around literals are
passed over, and literals joined by ``+`` (or next to each other in parentheses) are one. Of a call, quoted arguments after the first count,
and a lone one that could not be a name. A name assigned another name
takes that name's literal: the latest assignment before it or, where there is none, the first after it
(chains of any length, no cycles). A literal scores by
the sensitive words in the names it reaches, weighted with its own shape:

    score = name weight * min(1, length / 8) * (share of distinct characters + number of character kinds / 4) / 2

and a span of kind ``literal`` is reported where the score reaches ``MIN_SCORE``.

Defined cases: a null or empty text has no span and the SHA-256 of nothing;
spans count code points, end exclusive; repeated rows are scanned one by one;
columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
# A run of hexadecimal digits is as long as it can be, so asking for the length in the pattern finds the same runs.
HEX = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")
KINDS = ("assign", "access", "hex", "literal")

#: What a word of a name adds to its weight; words are parts of camelCase and snake_case names.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "bearer": 0.8, "auth": 0.6, "authorization": 0.7, "private": 0.5,
    "access": 0.4, "api": 0.4, "client": 0.3, "session": 0.4, "signing": 0.5, "encryption": 0.5, "key": 0.4,
    "salt": 0.4, "pin": 0.4, "cookie": 0.4, "dsn": 0.6, "connection": 0.3, "login": 0.4,
}
MIN_SCORE = 0.5
MIN_LITERAL = 6

_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
#: What follows a colon and stands before ``=``: a type, which may hold commas after its first bracket.
_TYPE = r"""(?:[^=:"'`\r\n;(){},\[<&]|&'?)++(?:[\[<](?:[^=:"'`\r\n;(){}&]|&'?)*+)?"""
#: Literals by opening quote, with escapes and of any length; triple quotes and backticks reach across lines.
_QUOTES = (
    r'"{3}(?P<a>(?:[^\\]|\\.)+?)"{3}', r"'{3}(?P<b>(?:[^\\]|\\.)+?)'{3}",
    r'"(?P<c>(?:[^"\\\r\n]|\\.)++)"', r"'(?P<d>(?:[^'\\\r\n]|\\.)++)'", r"`(?P<e>(?:[^`\\]|\\.)++)`",
)
_QUOTED = "abcde"
_BARE_END = r"""\s"'`,;()\[\]{}<>"""
# A run of name characters is read once, from its start: what precedes the first letter is cut off later.
_PAIR = re.compile(
    rf"""(?:(?<![A-Za-z0-9_])(?P<q>["'])(?P<quoted>{_NAME})(?P=q)(?:[ \t]*+\])?+|(?<![A-Za-z0-9_.\-])(?P<plain>[A-Za-z0-9_.\-]++))[ \t]*+"""
    rf"""(?:\??:(?P<type>{_TYPE})=(?![=>])|(?::=|=>|=(?!=)|:(?![:/])))[ \t]*+(?P<open>\((?:\s|\()*+)?+"""
    rf"""(?:[A-Za-z]{{0,2}}(?:{"|".join(_QUOTES)})"""
    rf"""|(?P<bare>\$\{{[^{{}}\s]++\}}|[^{_BARE_END}:=](?:[^{_BARE_END}:]|:(?![{_BARE_END}:=]|\Z))*+)(?![ \t]*+(?::=|=>|=)))""",
    re.S,
)
_LITERAL = rf"""[A-Za-z]{{0,2}}(?:{"|".join(_QUOTES)})"""
_JOINED = re.compile(rf"""\s*+\+\s*+{_LITERAL}""", re.S)
_BESIDE = re.compile(rf"""\s*+(?:\+\s*+)?{_LITERAL}""", re.S)
_QUOTE = re.compile(_LITERAL, re.S)
_UNNAMED = "|".join(re.sub(r"\?P<[a-e]>", "?:", q) for q in _QUOTES)
_ARGUMENTS = re.compile(rf"""\((?P<first>[ \t]*+(?:[A-Za-z]{{0,2}}(?:{_UNNAMED})|[^()"'`,\r\n]++)*+)(?P<rest>(?:{_UNNAMED}|[^()"'`\r\n])*+)""", re.S)
_ITEM = rf"""(?:[A-Za-z]{{0,2}}(?:{_UNNAMED})|[^{_BARE_END}=:]++)"""
_TUPLE = re.compile(
    rf"""(?<![A-Za-z0-9_.\-,])(?<!,[ \t])(?P<names>{_NAME}(?:[ \t]?,[ \t]?{_NAME})++)[ \t]*+=(?![=>])[ \t]*+\(?[ \t]*+"""
    rf"""(?P<values>{_ITEM}(?:[ \t]*+,[ \t]*+{_ITEM})++)""",
    re.S,
)
_VALUE = re.compile(rf"""{_LITERAL}|(?P<bare>[^{_BARE_END}=:]++)""", re.S)
_BLOCK = re.compile(
    rf"""^[ \t\-]*+["']?(?P<name>{_NAME})["']?[ \t]*+:[ \t]*+[|>][+\-]?[0-9]?[ \t]*+\r?\n(?P<pad>[ \t]++)(?P<body>\S[^\n]*+(?:\n(?P=pad)[^\n]*+)*+)""", re.M
)
_TAG = re.compile(rf"<(?P<name>{_NAME})>(?P<literal>[^<>]++)</(?P=name)>")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_IDENTIFIER = re.compile(rf"\$?{_NAME}\Z|\$\{{{_NAME}\}}\Z")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) by start, then kind as listed."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_order)



def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def name_weight(name: str) -> float:
    """Sum of the weights of a name's distinct sensitive words, at most 1."""
    parts = {p.lower() for p in _PART.findall(name)}
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in parts))


def literal_score(literal: str, weight: float) -> float:
    kinds = sum(map(bool, (re.search("[a-z]", literal), re.search("[A-Z]", literal), re.search("[0-9]", literal), re.search("[^A-Za-z0-9]", literal))))
    return weight * min(1.0, len(literal) / 8) * (min(1.0, len(set(literal)) / min(len(literal), 10)) + kinds / 4) / 2


Token = tuple[int, str, str, int, int, bool]


def _assignments(text: str) -> list[Token]:
    """(place, name, value, start and end of the value, whether it is bare) of all forms, in order."""
    tokens: list[Token] = []
    if ":" in text or "=" in text:
        for m in _PAIR.finditer(text):
            part = m.lastgroup if m.lastgroup in _QUOTED else "bare"
            at, value, start, end, bare = m.start(), m[part], m.start(part), m.end(part), part == "bare"
            name = m["quoted"] or m["plain"].lstrip("0123456789.-")
            if not bare:
                value, end = _whole(text, m.end(), value, end, _BESIDE if m["open"] else _JOINED)
            tokens.append((at, name, value, start, end, bare))
            if bare and text.startswith("(", end):
                tokens += [(at, name, *a, False) for a in _arguments(text, end)]
            typed = (m["type"] or "").split()
            if typed and _IDENTIFIER.match(typed[-1]):  # or another name of the same literal
                tokens.append((at, typed[-1], value, start, end, bare))
            if len(typed) > 1 and _IDENTIFIER.match(typed[1]):  # or a value of its own
                first = m.start("type") + m["type"].index(typed[0])
                tokens.append((at, name, typed[0], first, first + len(typed[0]), True))
            cut = max(value.rfind("="), value.rfind(":")) if bare else 0
            if cut > 0 and cut + 1 < len(value) and _IDENTIFIER.match(inner := re.split("[=:]", value[:cut])[-1]):
                tokens.append((start, inner, value[cut + 1 :], start + cut + 1, end, True))
    if "," in text and "=" in text:
        for m in _TUPLE.finditer(text):
            values = _VALUE.finditer(text, m.start("values"), m.end("values"))
            for name, v in zip(re.split(r"[ \t]?,[ \t]?", m["names"]), values):
                tokens.append((m.start(), name, v[v.lastgroup], v.start(v.lastgroup), v.end(v.lastgroup), v.lastgroup == "bare"))
    tokens += [(m.start("name"), m["name"], m["body"], m.start("body"), m.end("body"), False) for m in _blocks(text)]
    if "</" in text:
        tokens += [(m.start(), m["name"], m["literal"], m.start("literal"), m.end("literal"), False) for m in _TAG.finditer(text)]
    return sorted(tokens)


def _blocks(text: str) -> Iterator[re.Match]:
    return _BLOCK.finditer(text) if "|" in text or ">" in text else iter(())


def _whole(text: str, at: int, value: str, end: int, more: re.Pattern) -> tuple[str, int]:
    """A literal with those that are joined to it after ``at``, and the end of the last."""
    parts = [value]
    while m := more.match(text, at):
        parts.append(m[m.lastgroup])
        at, end = m.end(), m.end(m.lastgroup)
    return "".join(parts), end


def _arguments(text: str, at: int) -> list[tuple[str, int, int]]:
    """(literal, start, end) of a call's quoted arguments that may be values."""
    m = _ARGUMENTS.match(text, at)
    if not m:
        return []
    found = [(q[q.lastgroup], q.start(q.lastgroup), q.end(q.lastgroup)) for q in _QUOTE.finditer(text, m.start("rest"), m.end("rest"))]
    lone = _QUOTE.match(text, m.start("first") + len(m["first"]) - len(m["first"].lstrip()), m.end("first"))
    if not found and lone and not _IDENTIFIER.match(lone[lone.lastgroup]):
        found.append((lone[lone.lastgroup], lone.start(lone.lastgroup), lone.end(lone.lastgroup)))
    return found


def name_literal_pairs(text: str) -> list[tuple[str, str, int, int]]:
    """(name, literal, start, end of the literal) in order; names take part under each name that they reach."""
    known: dict[str, tuple[str, int, int]] = {}
    first: dict[str, tuple[str, int, int]] = {}
    open_: dict[tuple[int, int], str] = {}  # places of names that have no value before them
    pairs = []
    for _, name, value, start, end, bare in _assignments(text):
        source = None
        if bare and _IDENTIFIER.match(value):
            wanted = value.lstrip("$").strip("{}")
            source = known.get(wanted)
            if source is None:
                open_[start, end] = wanted
        known[name] = source or (value, start, end)
        first.setdefault(name, known[name])
        pairs.append((name, *known[name]))

    ends: dict[tuple[int, int], tuple[str, int, int]] = {}  # what a place's name reaches, for each place once

    def later(*found: tuple[str, int, int]) -> tuple[str, int, int]:
        way: list[tuple[int, int]] = []
        met: set[tuple[int, int]] = set()
        while (place := found[1:]) not in met:
            if place in ends:
                found = ends[place]
                break
            met.add(place)
            way.append(place)
            wanted = open_.get(place)
            if wanted not in first:
                break
            found = first[wanted]
        ends.update(dict.fromkeys(way, found))
        return found

    return [(name, *later(*found)) for name, *found in pairs]


def literal_spans(text: str, min_score: float = MIN_SCORE) -> list[Span]:
    """Spans of literals whose best name reaches ``min_score``; a bare word needs a digit to count as a literal."""
    found: set[Span] = set()
    blocks = {m.start("body") for m in _blocks(text)}
    for name, literal, start, end in name_literal_pairs(text):
        quoted = start in blocks or start > 0 and text[start - 1] in "\"'`>"
        if len(literal) < MIN_LITERAL or not (quoted or any(c.isdigit() for c in literal)) or " " in literal and not quoted:
            continue
        weight = name_weight(name)
        if weight and literal_score(literal, weight) >= min_score:
            found.add((start, end, "literal"))
    return sorted(found)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with ``mark`` in place of every span; spans that touch or overlap share one.

    Of an ``assign`` span only the value goes: its name and operator stay.
    """
    parts, at = [], 0
    for start, end, kind in spans:
        if kind == "assign":
            start = start + ASSIGN.match(text[start:end]).start(2)
        if start > at or not parts:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


COUNTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")]
    + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]
    + [T.StructField("n_literal", T.LongType())]
)


def _scanner(text_at: int, out_at: list[int], clean: bool):
    """Batches with the counts appended, or (``clean``) with the text at ``text_at`` redacted instead."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cleaned = [], []
            for scalar in batch.column(text_at):
                text = scalar.as_py()
                base = base_spans(text or "")
                spans = sorted({*base, *literal_spans(text or "")}, key=_order)
                if clean:
                    cleaned.append(redact(text, spans) if spans else text)
                    continue
                n = {k: sum(s[2] == k for s in spans) for k in KINDS}
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((n["assign"], n["access"], n["hex"], digest, _joined(spans), n["literal"]))
            columns = [batch.column(i) for i in out_at]
            names = [batch.schema.names[i] for i in out_at]
            if clean:
                columns[out_at.index(text_at)] = pa.array(cleaned, batch.schema.field(text_at).type)
            else:
                counted = list(zip(*rows, strict=True)) if rows else [[]] * len(COUNTS)
                columns += [pa.array(list(c), pa.string() if f.dataType == T.StringType() else pa.int64()) for c, f in zip(counted, COUNTS, strict=True)]
                names += COUNTS.fieldNames()
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return scan


def scan_secrets(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal), one row per row of ``documents``."""
    table = documents.select("doc_id", "text")
    return table.mapInArrow(_scanner(1, [0], False), T.StructType([table.schema["doc_id"], *COUNTS.fields]))


def redact_secrets(documents: DataFrame) -> DataFrame:
    """The same rows with every secret's value replaced in ``text``; ``n_chars``, where there, follows the text."""
    columns = documents.columns
    run = _scanner(columns.index("text"), list(range(len(columns))), True)
    clean = documents.mapInArrow(run, documents.schema)
    if "n_chars" not in columns:
        return clean
    kind = documents.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
