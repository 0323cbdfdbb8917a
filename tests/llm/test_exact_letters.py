import collections
import math
import random
import re

import numpy as np

import corpus_pipeline
from gridloom.llm import quality_rules

WORD = re.compile("[^ \t-\r]+")
CLASS = quality_rules._CLASS
MEMBERS = collections.Counter(int(CLASS[b]) for b in range(256) if b == 32 or b not in (9, 10, 11, 12, 13))


def byte_events(text):
    return [b for w in WORD.findall(text) for b in [*w.encode(), 32]]


def brute_bytes(texts):
    """P(byte | class, two bytes before), from dictionaries of counts."""
    counts = collections.Counter()
    for text in texts:
        row = [32, 32, *byte_events(text)]
        for i in range(2, len(row)):
            for k in range(3):
                counts[tuple(row[i - k : i]), row[i]] += 1
    total, kinds = collections.Counter(), collections.Counter()
    for (context, b), n in counts.items():
        total[context, int(CLASS[b])] += n
        kinds[context, int(CLASS[b])] += 1

    def p(context, b):
        c = int(CLASS[b])
        lower = p(context[1:], b) if context else 1 / MEMBERS[c]
        n, t = total[context, c], kinds[context, c]
        return (counts[context, b] + t * lower) / (n + t) if n else lower

    return p


def cyrillic(seed, n=90):
    r = random.Random(seed)
    words = "река тихо несёт камень утренний свет семь букв ждут возле окна сад ветер дом яркий стол бумага письмо".split()
    return " ".join(r.choices(words, k=n))


def in_greek(text):
    """The same follow bytes under the lead bytes of Greek: class for class the same text."""
    return text.encode().translate(bytes.maketrans(b"\xd0\xd1", b"\xce\xcf")).decode()


def test_byte_table_is_a_distribution_and_matches_definition():
    texts = [cyrillic(1), "Ab aB 12 a.b, a1!", "ab été Été \x00 x", ""]
    counts = collections.Counter()
    for text in texts:
        row = [32, 32, *byte_events(text)]
        counts.update(row[i] | row[i - 1] << 8 | row[i - 2] << 16 for i in range(2, len(row)))
    codes = np.array(sorted(counts), np.int32)
    row, column, logs = quality_rules.byte_table(codes, np.array([counts[int(c)] for c in codes], np.int64))
    p = brute_bytes(texts)
    word_bytes = np.array([b for b in range(256) if b not in (9, 10, 11, 12, 13)])
    for one, two in [(32, 32), (32, 0xD0), (0xD0, 0xB0), (97, 98), (7, 200), (0, 32), (255, 0xD1)]:
        got = np.exp(logs[row[one << 8 | two], column[word_bytes]].astype(float))
        assert np.allclose(np.bincount(CLASS[word_bytes], got, 32), 1, atol=1e-5)
        assert np.allclose(got, [p((one, two), int(b)) for b in word_bytes], rtol=1e-5)
    empty = quality_rules.byte_table(np.zeros(0, np.int32), np.zeros(0, np.int64))
    assert np.allclose(np.exp(empty[2][empty[0][0], empty[1][word_bytes]]), [1 / MEMBERS[int(CLASS[b])] for b in word_bytes])


def test_letters_of_a_class_are_told_apart(spark):
    """Every class of the odd text is that of a usual one; its letters are of another script."""
    usual, odd = cyrillic(0), in_greek(cyrillic(0))
    assert usual != odd and (CLASS[list(usual.encode())] == CLASS[list(odd.encode())]).all()
    rows = [(i, cyrillic(i), "ru") for i in range(200)] + [(999, odd, "ru")]
    judged, name = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ["doc_id"])
    got = {r.doc_id: r[name] for r in judged.collect()}
    assert math.isclose(got[999].score, got[0].score, rel_tol=1e-12) and got[999].low <= got[999].score <= got[999].high
    assert not got[999].kept and sum(r.kept for r in got.values()) >= 198


def test_exact_scores_against_brute_force(spark, sample):
    """``exact_score`` less ``score`` is the mean over the bytes' own model, where one model scores all words."""
    texts = [r.text for r in sample.filter("length(text) BETWEEN 200 AND 1500").limit(30).collect()]
    texts += [cyrillic(3), in_greek(cyrillic(4)), "中文 字 😀 \x00" * 20, "ALL CAPS 0123 " * 9]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(100 + i, texts[0], None) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    judged, name = quality_rules.quality_rules(df)
    p = brute_bytes(sorted(set(texts)))
    for r in judged.collect():
        row = [32, 32, *byte_events(r.text)]
        logs = [math.log(p((row[i - 2], row[i - 1]), row[i])) for i in range(2, len(row))]
        assert math.isclose(r[name].exact_score - r[name].score, -sum(logs) / len(logs), rel_tol=1e-4, abs_tol=1e-6)


def test_pipeline_stage_drops_the_other_script(spark):
    rows = [(i, cyrillic(i), "ru", "src1") for i in range(200)] + [(999, in_greek(cyrillic(0)), "ru", "src1")]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 999 not in ids and len(ids) >= 198
