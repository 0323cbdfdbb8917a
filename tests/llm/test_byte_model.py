import collections
import math
import random
import re

import numpy as np

import corpus_pipeline
from gridloom.llm import quality_rules

WORD = re.compile("[^ \t-\r]+")


def byte_row(text):
    return [32, 32, 32, *(b for w in WORD.findall(text) for b in [*w.encode(), 32])]


def quad_counts(texts):
    counts = collections.Counter(tuple(row[i - 3 : i + 1]) for row in map(byte_row, texts) for i in range(3, len(row)))
    quads = np.array([int.from_bytes(bytes(g), "big") for g in sorted(counts)], np.uint32)
    return counts, quads, np.array([counts[g] for g in sorted(counts)], np.int64)


def brute_bytes(texts):
    """P(byte | three bytes before) of an interpolated modified Kneser-Ney model, from dictionaries of counts."""
    counts = {4: quad_counts(texts)[0]}
    whole = {k: collections.Counter() for k in (1, 2, 3)}
    for gram, n in counts[4].items():
        for k in (1, 2, 3):
            whole[k][gram[4 - k :]] += n
    for k in (3, 2, 1):
        ways = collections.Counter(gram[1:] for gram in (whole[k + 1] if k < 3 else counts[4]))
        counts[k] = {g: whole[k][g] if k > 1 and g[0] == 32 else n for g, n in ways.items()}
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
            return 1 / 251
        k, lower = len(gram), p(gram[1:])
        total, mass = context[k].get(gram[:-1], (0, 0))
        n = counts[k].get(gram, 0)
        return (n - cuts[k][min(n, 3)] + mass * lower) / total if total else lower

    return p


def codes(seed, n=90):
    return " ".join(random.Random(seed).choices([pair + c for pair in ("7a", "4k", "9z") for c in "mnopqr"], k=n))


def renumbered(text):
    """The same classes, and digits that are as usual; but each goes before another one's letter."""
    return text.translate(str.maketrans("749", "497"))


def test_byte_model_is_a_distribution_and_matches_definition():
    texts = [codes(1), "Ab aB 12 a.b, a1!", "ab été Été \x00 x", "中文 字 😀", "the river, the stone; the river", ""]
    _, quads, times = quad_counts(texts)
    model, p = quality_rules.byte_model(quads, times), brute_bytes(texts)
    word_bytes = [b for b in range(256) if b not in (9, 10, 11, 12, 13)]
    for before in [(32, 32, 32), (32, 32, 97), (32, 55, 97), (228, 184, 173), (1, 97, 98), (7, 200, 255), (0, 32, 120), (255, 254, 253)]:
        grams = np.array([int.from_bytes(bytes([*before, b]), "big") for b in word_bytes], np.uint32)
        got = np.exp(model.log_probability(grams).astype(float))
        assert math.isclose(got.sum(), 1, abs_tol=1e-5)
        assert np.allclose(got, [p((*before, b)) for b in word_bytes], rtol=1e-5)
    empty = quality_rules.byte_model(np.zeros(0, np.uint32), np.zeros(0, np.int64))
    assert np.allclose(np.exp(empty.log_probability(np.array([0x20202061, 0xFFFFFFFF], np.uint32))), 1 / 251)


def test_classes_and_triples_are_sums_of_four_bytes():
    counts, quads, times = quad_counts([codes(2), "É Ab 中文 0x1F", "a"])
    classes, triples = collections.Counter(), collections.Counter()
    for g, n in counts.items():
        classes[sum(int(quality_rules._CLASS[b]) << 5 * (3 - i) for i, b in enumerate(g))] += n
        triples[int.from_bytes(bytes(g[1:]), "big")] += n
    got = np.bincount(quality_rules.class_codes(quads), times, quality_rules.GRAMS)
    assert {int(c): int(got[c]) for c in np.flatnonzero(got)} == classes
    assert dict(zip(*(x.tolist() for x in quality_rules.triple_counts(quads, times)), strict=True)) == triples


def test_byte_scores_against_brute_force(spark, sample):
    texts = [r.text for r in sample.filter("length(text) BETWEEN 200 AND 1500").limit(30).collect()]
    texts += [codes(3), renumbered(codes(4)), "中文 字 😀 \x00" * 20, "ALL CAPS 0123 " * 9]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(100 + i, texts[0], None) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    judged, name = quality_rules.quality_rules(df)
    p = brute_bytes(sorted(set(texts)))
    for r in judged.collect():
        row = byte_row(r.text)
        logs = [math.log(p(tuple(row[i - 3 : i + 1]))) for i in range(3, len(row))]
        assert math.isclose(r[name].byte_score, -sum(logs) / len(logs), rel_tol=1e-4)


def test_what_stands_before_a_letter_is_told_apart(spark):
    """The odd text has the usual classes, and usual bytes inside them: only the digits before its letters are others."""
    rows = [(i, codes(i), "en", "src1") for i in range(200)] + [(999, renumbered(codes(0)), "en", "src1")]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    judged, name = quality_rules.quality_rules(docs, ["doc_id"])
    got = {r.doc_id: r[name] for r in judged.collect()}
    assert got[999].low <= got[999].score <= got[999].high and got[999].exact_low <= got[999].exact_score <= got[999].exact_high
    assert not got[999].kept and sum(r.kept for r in got.values()) >= 198
    ids = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").select("doc_id").collect()}
    assert ids == {i for i, r in got.items() if r.kept}


def test_models_are_the_same_however_they_are_cut(spark):
    """Pieces of a model of four bytes are those of any batches; together they are every four bytes of the distinct texts."""
    rows = [(i, codes(i % 40), ("en", "de", None)[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = quality_rules.fit_perplexity(df, 1000).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for lang in ("", "en", "de"):
        texts = {(t, own) for _, t, own in rows if lang in ("", own)}
        _, quads, times = quad_counts([t for t, _ in texts])
        pieces = [r for r in found if r.lang == lang and r.quads]
        assert len(pieces) > 1 and sum(r.lang == lang and r.keys is not None for r in found) == 1
        got = {int(q): int(n) for r in pieces for q, n in zip(np.frombuffer(r.quads, np.uint32), np.frombuffer(r.times, np.int64), strict=True)}
        assert got == dict(zip(quads.tolist(), times.tolist(), strict=True))
    assert {r.lang for r in found} == {"", "en", "de"}
