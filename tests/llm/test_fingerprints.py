import hashlib
import re

import xxhash

from gridloom.llm.fingerprints import K, WINDOW, edit_fingerprints, fingerprints


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _pair(a, b):
    h = xxhash.xxh64_intdigest((a % 2**64).to_bytes(8, "little"), 42)
    return _signed(h if b is None else xxhash.xxh64_intdigest((b % 2**64).to_bytes(8, "little"), h))


def marks(text):
    words = [w for w in re.sub(r"[^\w]+|_", " ", text.lower()).split(" ") if w]
    one = [_signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]

    def at(values, i):
        return values[i] if i < len(values) else None

    two = [_pair(x, at(one, i + 1)) for i, x in enumerate(one)]
    four = [_pair(x, at(two, i + 2)) for i, x in enumerate(two)]
    grams = [_pair(x, at(one, i + 4)) >> 31 for i, x in enumerate(four)][: max(len(one) - K + 1, 1)]
    found = []
    for i in range(max(len(grams) - WINDOW + 1, 1) if grams else 0):
        part = grams[i : i + WINDOW]
        place = i + max(j for j, h in enumerate(part) if h == min(part))
        if found[-1:] != [(place, grams[place])]:
            found.append((place, grams[place]))
    return found


def brute(rows):
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        sets = [{h for _, h in marks(t)} for t in (text, edited, after)]
        near = [1.0 if not sets[0] | s else len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
        written = [",".join(f"{p}:{h % 2**33:X}" for p, h in marks(t)) for t in (text, edited)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *written, *near))
    return out


def test_whole_table_against_brute_force(sample):
    rows = sorted(((r.doc_id, r.text or "") for r in sample.collect()), reverse=True)
    got = {r.doc_id: tuple(r) for r in edit_fingerprints(sample).collect()}
    assert got == {r[0]: r for r in brute(rows)}


def test_edges(edges, nothing):
    rows = edit_fingerprints(edges).collect()
    assert len(rows) == edges.count()
    same = {r.fingerprint for r in rows if r.doc_id in (1, 2)}
    assert len(same) == 1
    empty = [r for r in rows if r.doc_id in (4, 5, -5)]
    assert all(r.fingerprint == "" for r in empty)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert edit_fingerprints(nothing).count() == 0


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")
    row = edit_fingerprints(df).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1.0


def test_positions_and_match_guarantee(spark):
    shared = " ".join(f"w{i}" for i in range(K + WINDOW - 1))
    df = spark.createDataFrame([(1, "a b c " + shared + " d"), (2, shared + " x y z")], "doc_id long, text string")
    one, two = [dict(zip(r.hashes, r.positions)) for r in fingerprints(df).orderBy("doc_id").collect()]
    common = one.keys() & two.keys()
    assert common and all(one[h] == two[h] + 3 for h in common)


def test_no_python_in_plan(sample):
    plan = edit_fingerprints(sample)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
