import collections
import math
import random
import re

import numpy as np
import pytest

from gridloom.llm import ngram_join, quality_rules
from gridloom.llm.flatwords import word_chunks
import pyarrow as pa

WORD = re.compile("[^ \t-\r]+")


def brute_counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = collections.defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    covered = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts(edges, sample):
    texts = [r.text or "" for r in edges.collect()] + [r.text or "" for r in sample.collect()]
    texts += ["a\na\n\na", "\n", "x\n", "\nx", " a\na", "a a a a", "a b a b a", "#\n#\n", " wide space", "end\n"]
    for limit in (64, 1 << 20):
        got = []
        for _, _, words in word_chunks(pa.array(texts), limit):
            c = quality_rules.base_counts(words)
            got += list(zip(*[c[n].tolist() for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]))
        assert got == [brute_counts(t) for t in texts]


def test_model_is_a_distribution_and_matches_definition():
    rng = np.random.default_rng(0)
    counts = np.zeros(quality_rules.GRAMS, np.int64)
    codes = rng.integers(0, 6, (4000, 4)) @ (32 ** np.arange(3, -1, -1))
    np.add.at(counts, codes, 1)
    keys, share, weight = quality_rules.kneser_ney(counts)
    assert (np.diff(keys.astype(object)) > 0).all()
    p = np.exp(quality_rules.log_table(keys, share, weight).astype(float)).reshape(-1, 32)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    # one n-gram by hand: discounted share plus the context's weight times the lower order
    table = counts.reshape(32, 32, 32, 32)
    a, b, c, d = (int(x) for x in np.argwhere(table > 0)[50])
    row = table[a, b, c]
    n1, n2, n3, n4 = [(table == k).sum() for k in (1, 2, 3, 4)]
    y = n1 / (n1 + 2 * n2)
    cut = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    back = sum(cut[min(k, 3)] for k in row) / row.sum()
    lower = (table.sum(axis=0)[b, c] if b == 0 else None)
    tri = (table > 0).sum(axis=0)
    if lower is None:
        shorter = p  # reached below
    own = (row[d] - cut[min(row[d], 3)]) / row.sum()
    assert tri[b, c, d] > 0 and 0 < back < 1
    assert math.isclose(p.reshape(32, 32, 32, 32)[a, b, c, d] - own, back * (p.reshape(32, 32, 32, 32)[31, b, c, d]), rel_tol=1e-3)
    assert shorter is p if lower is None else True


def test_rules_on_edges(edges, nothing):
    judged, name = quality_rules.quality_rules(edges)
    assert name == "rules_" and judged.columns == [*edges.columns, name]
    rows = judged.select("doc_id", "text", f"{name}.*").collect()
    assert len(rows) == edges.count()
    for r in rows:
        counts = brute_counts(r.text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert r.kept == (not r.base_failed and r.low <= r.score <= r.high)
    assert quality_rules.keep_good(nothing).count() == 0
    assert quality_rules.keep_good(edges).columns == edges.columns


def test_odd_text_is_rejected_and_others_stay(spark):
    import random

    r = random.Random(3)
    words = "the river carries a quiet stone under morning light and seven letters wait near windows".split()
    rows = [(i, " ".join(r.choices(words, k=80)), "en") for i in range(200)] + [(999, " ".join("".join(r.choices("xqzjkvw%#", k=7)) for _ in range(80)), "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged, name = quality_rules.quality_rules(df, ["doc_id"])
    kept = {x.doc_id for x in judged.filter(judged[name]["kept"]).collect()}
    assert 999 not in kept and len(kept) >= 198


def test_order_across_borders_counts(spark):
    """Contexts reach across borders: the same short words in another order are another text to the model."""
    r = random.Random(5)
    follows = {w: r.sample("abcdefghijklmnopqrstuvwxyz", 8) for w in "abcdefghijklmnopqrstuvwxyz"}

    def text(seed):
        r, w, out = random.Random(seed), "a", []
        for _ in range(90):
            w = r.choice(follows[w])
            out.append(w)
        return out

    rows = [(i, " ".join(text(i)), "en") for i in range(200)]
    salad = text(0)
    random.Random(1).shuffle(salad)
    rows.append((999, " ".join(salad), "en"))
    judged, name = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ["doc_id"])
    kept = {x.doc_id for x in judged.filter(judged[name]["kept"]).collect()}
    assert 999 not in kept and len(kept) >= 198


def brute_model(texts):
    """Probabilities of an interpolated modified Kneser-Ney model of letter classes, from dictionaries of counts."""
    classes = quality_rules._CLASS

    def letters(text):
        return [int(c) for w in WORD.findall(text) for c in [*classes[list(w.encode())], 0]]

    counts = {4: collections.Counter()}
    for text in texts:
        row = [0, 0, 0, *letters(text)]
        counts[4].update(tuple(row[i - 3 : i + 1]) for i in range(3, len(row)))
    whole = {k: collections.Counter() for k in (1, 2, 3)}
    for gram, n in counts[4].items():
        for k in (1, 2, 3):
            whole[k][gram[4 - k :]] += n
    for k in (3, 2, 1):
        ways = collections.Counter(gram[1:] for gram in (whole[k + 1] if k < 3 else counts[4]))
        counts[k] = {g: whole[k][g] if k > 1 and g[0] == 0 else n for g, n in ways.items()}
    cuts, context = {}, {}
    for k, table in counts.items():
        n1, n2, n3, n4 = (sum(v == i for v in table.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y]
        cuts[k] = [0, *(min(max(v, 0.05), i + 0.95) for i, v in enumerate(d))]
        context[k] = collections.defaultdict(lambda: [0, 0.0])
        for g, n in table.items():
            context[k][g[:-1]][0] += n
            context[k][g[:-1]][1] += cuts[k][min(n, 3)]

    def p(gram):
        if not gram:
            return 1 / 32
        k, lower = len(gram), p(gram[1:])
        total, mass = context[k].get(gram[:-1], (0, 0))
        n = counts[k].get(gram, 0)
        return (n - cuts[k][min(n, 3)] + mass * lower) / total if total else lower

    def word_scores(text):
        row, at, out = [0, 0, 0, *letters(text)], 3, []
        for w in WORD.findall(text):
            out.append(sum(math.log(p(tuple(row[i - 3 : i + 1]))) for i in range(at, at + len(w.encode()) + 1)))
            at += len(w.encode()) + 1
        return out

    return word_scores


def test_scores_against_brute_force(spark, sample):
    """Models are of distinct texts: copies in the table change neither them nor the bands."""
    texts = [(r.text, r.lang) for r in sample.filter("length(text) BETWEEN 200 AND 1500").collect()]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts)] + [(10_000 + i, *texts[i % 7]) for i in range(300)]
    rows += [(20_000, texts[0][0], "xx"), (20_001, texts[1][0], None), (20_002, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    least = 30_000
    judged, name = quality_rules.quality_rules(df, min_events=least)
    got = {r.doc_id: r[name] for r in judged.collect()}
    distinct = sorted({(t, lang) for _, t, lang in rows if t is not None}, key=str)
    by_lang = collections.defaultdict(list)
    for t, lang in distinct:
        by_lang[lang].append(t)
    size = {lang: sum(len(w.encode()) + 1 for t in ts for w in WORD.findall(t)) for lang, ts in by_lang.items()}
    own = {lang: brute_model(by_lang[lang]) for lang, n in size.items() if lang and n >= least}
    whole = brute_model([t for t, _ in distinct])
    assert own and len(own) < len(by_lang)
    for i in [*range(0, len(texts), 9), 20_000, 20_001]:
        t, lang = next((t, lang) for j, t, lang in rows if j == i)
        scores = whole(t)
        if lang in own:
            scores = [max(pair) for pair in zip(scores, own[lang](t), strict=True)]
        assert got[i].model == (lang if lang in own else "")
        assert math.isclose(got[i].score, -sum(scores) / sum(len(w.encode()) + 1 for w in WORD.findall(t)), rel_tol=1e-5)
    alone, name = quality_rules.quality_rules(df.filter("doc_id < 10000 OR doc_id >= 20000"), min_events=least)
    assert {r.doc_id: r[name] for r in alone.collect()} == {i: v for i, v in got.items() if not 10_000 <= i < 20_000}


def gram_set(text):
    w = WORD.findall(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_join(rows):
    sets = {i: gram_set(t) for i, t in rows}
    links, parent = collections.Counter(), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            shared = len(x & y)
            if shared * 10 >= 8 * (len(x) + len(y) - shared):
                links[a] += 1
                links[b] += 1
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (root(i), links[i]) for i in sets}


@pytest.mark.parametrize("block", [4, 512])
def test_join_against_brute_force(spark, sample, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = [(r.doc_id, r.text or "") for r in sample.collect()]
    words = rows[0][1].split()
    chain = [(10_000 + k, " ".join(words[: len(words) - 6 * k])) for k in range(12)]  # a chain of links
    swaps = [(20_000 + k, " ".join(w if i != 7 * k else "swap" for i, w in enumerate(words))) for k in range(1, 20)]
    df = spark.createDataFrame(rows + chain + swaps, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_jaccard_join(df).collect()}
    assert got == brute_join(rows + chain + swaps)


def test_join_edges(edges, nothing):
    rows = {r.doc_id: r for r in ngram_join.ngram_jaccard_join(edges.filter("doc_id IS NULL OR doc_id != 9")).collect()}
    assert rows[1].class_id == rows[2].class_id == rows[3].class_id == 1 and rows[2].copy_of == 1
    assert rows[4].class_id == rows[5].class_id == -5 and rows[None].class_id is None
    assert rows[10].class_id == 10 and rows[10].n_links == 0
    kept = ngram_join.keep_one_per_class(edges)
    assert kept.columns == edges.columns
    ids = sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect())
    assert ids.count(9) == 2  # two unlike texts under one id
    assert len(ids) == len(set(ids)) + 1 and 1 in ids and 2 not in ids and 3 not in ids
    assert kept.filter("doc_id IS NULL").count() == 1  # the one without a text is like the other empty ones
    assert ngram_join.ngram_jaccard_join(nothing).count() == 0


def test_no_text_is_lost_under_a_repeated_id(spark):
    a, b, c = (" ".join(random.Random(k).choices([f"w{i}" for i in range(500)], k=60)) for k in range(3))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, b + " tail"), (None, c), (None, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(r.doc_id, r.text) for r in ngram_join.keep_one_per_class(df).collect()}
    assert kept == {(1, a), (2, b), (3, c)}
    only = ngram_join.keep_one_per_class(df.filter("doc_id IS NULL"))
    assert [tuple(r) for r in only.collect()] == [(None, c)]


def test_bands_reach_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.999)
    assert bands * rows <= ngram_join.MAX_PERMUTATIONS and 1 - (1 - 0.8**rows) ** bands >= 0.999
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.999, 4)
