"""Hard negatives, periodic runs and URL rules against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import hard_negatives, periodic_runs, queries, url_rules
from gridloom.llm.flatwords import word_chunks
from gridloom.llm.url_rules import ALLOW, BLOCK, Automaton, Glob, HostRule
from tests.compare import assert_same, connect

WORD = re.compile("[^ \t-\r]+")
FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name])


# --- periodic runs -----------------------------------------------------------

def brute_runs(w):
    n, runs = len(w), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(6, 4 * q) and not any(w[start + p : start + length] == w[start : start + length - p] for p in range(1, q)):
                runs.append((start, length, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def periodic_text(r):
    w = [r.choice("abcde"[: r.choice([1, 2, 2, 3, 5])]) for _ in range(r.choice([0, 1, 5, 6, 7, 20, 40, 90]))]
    if r.random() < 0.7 and len(w) > 8:
        a = r.randrange(len(w))
        p = r.randint(1, max(1, (len(w) - a) // 3))
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
        if r.random() < 0.3:
            w[r.randrange(len(w))] = "z"
    return w


def test_runs_against_brute_force():
    r = random.Random(4)
    for _ in range(1500):
        texts = [periodic_text(r) for _ in range(r.randint(1, 4))]
        for _, _, words in word_chunks(pa.array([" ".join(t) for t in texts])):
            found = periodic_runs._text_runs(words, 6, 4)
        assert [found.get(i, []) for i in range(len(texts))] == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("word", [["x"] * 60_000, list("ab") * 30_000, ["a"] * 30_000 + ["b"] + ["a"] * 30_000])
def test_long_runs_take_linear_work(word):
    for _, _, words in word_chunks(pa.array([" ".join(word)])):
        chain, first = periodic_runs._chained(words)
        place, _ = periodic_runs.openings(chain, len(word))
        assert len(place) < len(word)
        runs = periodic_runs._text_runs(words, 6, 4)[0]
    assert runs == {"x": [(0, 60_000, 1)], "b": [(0, 60_000, 2)]}.get(word[1], [(0, 30_000, 1), (30_001, 30_000, 1)])


def test_runs_on_edges(edges, nothing):
    found, name = periodic_runs.find_runs(edges.withColumn("runs", F.lit(1)))
    assert name == "runs_" and found.columns[-2:] == ["runs", "runs_"]
    for r in found.collect():
        w = WORD.findall(r.text or "")
        assert r.runs_.n_words == len(w)
        if len(w) < 5_000:
            runs = brute_runs(w)
            assert [tuple(x) for x in r.runs_.runs] == runs
            dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
            assert r.runs_.collapsed == " ".join(x for i, x in enumerate(w) if i not in dropped)
    assert periodic_runs.find_runs(nothing)[0].count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(edges, repeats=3)


# --- URL rules ---------------------------------------------------------------

def brute_glob(pattern):
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**", i):
            out, i = out + ".*", i + 1
        elif pattern[i] == "*":
            out += "[^/]*"
        elif pattern[i] == "?":
            out += "[^/]"
        else:
            out += re.escape(pattern[i])
        i += 1
    return re.compile(out if "/" in pattern else out + "(/.*)?", re.S)


def brute_judge(url, rules, globs):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == BLOCK))
        return host, path, best.host + best.path, best.verdict
    hit = {g.verdict for g in globs if brute_glob(g.pattern).fullmatch(host + path)}
    return host, path, None, BLOCK if hit == {BLOCK} else ALLOW


URLS = [
    None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x", "https://www.example.com/EN/x", "http://example.com/en",
    "http://example.com/en/", "http://badexample.com/en/1", "http://a.b.net/es/?q=/fr/", "http://net/fr/#x", "http://x.net?/es/", "http://u:p@m.net:80/fr/a b",
    "http://É.ÉXAMPLE.org/ä/页", "http://a/x.com/en/", "http://.com/", "http://help.casino.org", "x://casino.org/help/1", "a://b://c.net/es/", "http://ads-1.org/" + "p/" * 3000,
    "http://pharmäcy.org", "http://pharmacy.org/\n.exe", "http://pharm/cy.org", "http://o.org/a/b/page/7", "http://o.org/page/7/8", "http://track9.io/",
]


def test_urls_against_brute_force(spark):
    r = random.Random(2)
    parts = ["http://", "www.", "example", ".com", ".net", "/en/", "/es/", "/fr/", "?", "#", "/", "casino", "é", "track1.", "A", ".exe"]
    urls = URLS + ["".join(r.choices(parts, k=r.randint(1, 8))) for _ in range(800)]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate([*urls, *urls[:9]])], "page_id long, url string, judged int")
    tied = [HostRule(ALLOW, "x.net", "/"), HostRule(BLOCK, "net", "/es"), HostRule(ALLOW, "net", "/es"), HostRule(BLOCK, "org")]
    for rules in (queries.URL_RULES, queries.URL_RULES + tied, []):
        judged, name = url_rules.filter_urls(df, rules, queries.URL_GLOBS)
        assert judged.columns == ["page_id", "url", "judged", "judged_"]
        for row in judged.collect():
            got = row[name]
            assert (got.host, got.path, got.rule, got.verdict) == brute_judge(row.url, rules, queries.URL_GLOBS), row.url
    assert url_rules.filter_urls(df.limit(0), queries.URL_RULES, [])[0].count() == 0


def test_many_globs_across_words(monkeypatch):
    monkeypatch.setattr(url_rules, "STATE_BYTES", 64)
    r = random.Random(8)
    patterns = ["".join(r.choices(["a", "b", "/", "*", "**", "?", "é"], k=r.randint(1, 9))) for _ in range(120)]
    texts = ["".join(r.choices("ab/éc", k=r.randint(0, 14))) for _ in range(300)]
    automaton = Automaton([url_rules._tokens(p) for p in patterns])
    assert automaton.words > 5
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    hit = automaton.matches(np.frombuffer(b"".join(data), np.uint8), bounds)
    whole = [re.compile(brute_glob(p + "/").pattern[:-1], re.S) for p in patterns]  # with a slash: not a host glob
    assert hit.tolist() == [[bool(w.fullmatch(t)) for w in whole] for t in texts]
    monkeypatch.setattr(url_rules, "MAX_MASK_BYTES", 4096)
    with pytest.raises(ValueError):
        Automaton([url_rules._tokens(p) for p in patterns])


# --- hard negatives ----------------------------------------------------------

def brute_mine(rows):
    """Rows (id, label, vector); every row counts for itself."""
    out = []
    for i, (a, label, v) in enumerate(rows):
        if a % 50:
            continue
        order = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-int(np.dot(rows[j][2], v)), rows[j][0]))
        score = {j: int(np.dot(rows[j][2], v)) for j in order}
        for p in [j for j in order if rows[j][1] == label][:5]:
            fit = [j for j in order if rows[j][1] != label and 50 * score[p] <= 100 * score[j] <= 95 * score[p]][:3]
            out += [(a, rows[p][0], k, rows[j][0], score[p], score[j]) for k, j in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("anchors, batch, size", [(4096, 8192, 8), (3, 16, 8), (1, 5, 1 << 22)])
def test_mining_against_brute_force(spark, monkeypatch, anchors, batch, size):
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "STEP", 3)
    r = np.random.default_rng(anchors)
    rows = [(int(i), int(r.integers(0, 3)), r.integers(-size, size, 12).tolist()) for i in range(0, 900, 3)]
    rows += [rows[0]] * 3 + [rows[5]] * 7 + [(150, 1, rows[9][2]), (-50, 2, rows[0][2]), (33, 7, rows[0][2])]
    df = spark.createDataFrame(rows, "id long, label int, vector array<long>")
    got = hard_negatives.mine_hard_negatives(df, F.col("id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_mine(rows)


def test_mining_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0]), (2, 2, [0.75, 0.1]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [nan, 1.0]), (6, 2, [inf, 0.0]), (7, 2, [None, 1.0]), (50, 9, [0.1, 0.1]), (None, 2, [0.7, 0.7])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, rank string")
    sound = df.filter(hard_negatives.usable("vec_id", "embedding", "label"))
    assert sorted(r.vec_id for r in sound.collect()) == [0, 1, 2, 50]
    vectors = sound.select(F.col("vec_id").alias("id"), "label", hard_negatives.quantised(F.col("embedding")).alias("vector"))
    got = hard_negatives.mine_hard_negatives(vectors, F.col("id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 256 * 256, 256 * 192 + 128 * 25)]  # a shorter vector ends in zeros
    assert hard_negatives.mine_hard_negatives(vectors.limit(0), F.col("id") % 50 == 0).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine_hard_negatives(vectors.withColumn("vector", F.array(F.lit(1 << 40))), F.lit(True))


def test_bounds_exclude_rows():
    """Rows whose bounds miss the limit leave before the last columns are read."""
    r = np.random.default_rng(1)
    data = r.integers(-4, 5, (500, 32)).astype(float)
    data[0] = 60
    rows = hard_negatives.Columns(np.arange(500), np.zeros(500, np.int64), np.ones(500, np.int64), data)
    scan = hard_negatives.Scan(np.full((1, 32), 5.0), rows.data)
    sizes = []

    def alive(partial, low, high):
        sizes.append(len(partial))
        return partial + high >= 9000

    at, score = scan.survivors(0, np.arange(500), alive)
    assert rows.ids[at].tolist() == [0] and score.tolist() == [9600.0] and sizes[-1] == 1


def test_collapsed_digest_is_over_utf8(spark):
    df = spark.createDataFrame([(3, "é é é é é é é"), (4, None)], "doc_id long, text string")
    found, name = periodic_runs.find_runs(df, ["doc_id"])
    rows = {r.doc_id: r for r in found.select("doc_id", F.sha2(F.col(name)["collapsed"], 256).alias("d"), f"{name}.runs").collect()}
    assert rows[3].d == hashlib.sha256("é".encode()).hexdigest() and [tuple(x) for x in rows[3].runs] == [(0, 7, 1)]
    assert rows[4].d == hashlib.sha256(b"").hexdigest() and rows[4].runs == []
