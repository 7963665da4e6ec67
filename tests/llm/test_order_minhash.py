import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from hirescope.llm import order_minhash as O


def longs(*values):
    """Spark's xxhash64 over longs: each seeded with the hash before it."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), h)
    return h


def plain(text, slots=64, k=2, token=12):
    """Entries by the definition, one element at a time."""
    tokens = [t[i:i + token] for t in text.split() for i in range(0, len(t), token)]
    seen, cells = {}, {}
    for pos in range(len(tokens)):
        h = 42
        for t in tokens[pos:pos + k]:
            h = xxhash.xxh64_intdigest(t.encode(), h)
        seen[h] = seen.get(h, 0) + 1
        e = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42)
        e = xxhash.xxh64_intdigest(seen[h].to_bytes(4, "little"), e)       # the occurrence is an int
        cell = (e - 2**64 if e >> 63 else e) % (2 * slots)
        cells[cell] = min(cells.get(cell, 2**63), (e >> 25 << 24) + pos)
    out = []
    for s in range(slots):
        both = sorted((c for c in (cells.get(2 * s), cells.get(2 * s + 1)) if c is not None),
                      key=lambda c: c & (2**24 - 1))
        if both:
            h = longs(*(c >> 24 for c in both))
            out.append(s * 2**25 + (h - 2**64 if h >> 63 else h) % 2**25)
    return out


def test_equals_definition_and_edits(docs_of):
    rng = random.Random(1)
    words = ["w%d" % i for i in range(50)] + ["the", "a", "déjà", "x" * 30]
    pairs = [(i * 3 - 20, " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    pairs += [(500, None), (501, " \n "), (502, "one"), (503, "tail é" * 7)]
    rows = {r.doc_id: r for r in O.compare_with_edits(docs_of(pairs)).collect()}
    assert len(rows) == len(pairs)
    order = sorted(pairs)
    prints = {i: plain(t or "") for i, t in order}

    def like(a, b):
        used = {x >> 25 for x in a} | {x >> 25 for x in b}
        return len(set(a) & set(b)) / len(used) if used else 1.0
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        r = rows[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.entries == prints[i] and r.edited_entries == plain(edited)
        assert abs(r.near_edited - like(prints[i], plain(edited))) < 1e-12
        assert abs(r.near_next - like(prints[i], prints[j])) < 1e-12


def test_order_counts(spark):
    rng = random.Random(2)
    words = ["w%d" % i for i in range(400)]
    moved = words[200:] + words[:200]
    rng.shuffle(words)
    texts = [("a", " ".join(words)), ("b", " ".join(words[:390])), ("c", " ".join(moved))]
    got = {r.id: r.entries for r in O.fingerprints(spark.createDataFrame(texts, "id string, text string"), ["id"]).collect()}
    same = lambda x, y: len(set(got[x]) & set(got[y])) / 64
    assert same("a", "b") > 0.85 and same("a", "c") < 0.1


def test_repeated_and_single_rows(docs_of):
    alone = O.compare_with_edits(docs_of([(7, "ab cd")])).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()      # follows itself
    rows = O.compare_with_edits(docs_of([(1, "x y z"), (1, "x y z"), (2, "q"), (None, "n"), (1, "other")])).collect()
    assert len(rows) == 5
    assert len({(r.n_chars, tuple(r.entries)) for r in rows if r.doc_id == 1}) == 2
    assert O.compare_with_edits(docs_of([])).count() == 0


def test_no_python_on_the_executors(docs_of):
    plan = O.compare_with_edits(docs_of([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))
    assert O.as_text(F.array(F.lit(26))) is not None
