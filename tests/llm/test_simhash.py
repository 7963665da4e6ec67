import random

import numpy as np
import xxhash

from hirescope.llm import simhash as S
from hirescope.llm.components import connected_components


def plain(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, most):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_the_definition():
    for t in ["", None, " \t", "One", "a B c d", "A b\tC  d\x0be f É é", "x " * 300, "the cat " * 7 + "ÀB c"]:
        assert S.fingerprint(t) == plain(t)


def test_covering_meets_every_near_pair():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 800, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    sent = {(int(k), int(f)) for ks, fs in S.reached_anchors(b) for k, f in zip(ks, fs)}
    homes = S.home_anchors(a)
    assert all(any((int(h[i]), int(b[i])) in sent for h in homes) for i in range(len(a)))


def test_links_close_like_all_pairs_also_in_blocks(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(12)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    want = components([f % (1 << 64) for f in fps], 4)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for block in (4096, 2):
        got = {r.vertex: r.component for r in connected_components(S.links(df, block=block)).collect()}
        assert [got.get(f, f) for f in fps] == [fps[w] for w in want]


def test_documents(docs_of):
    rng = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(20)]
    pairs = [(i, t) for i, t in enumerate(texts)] + [(50, texts[3].upper()), (51, texts[3]), (51, texts[3]),
                                                     (60, ""), (61, None), (62, " \n"), (None, texts[5])]
    got = S.near_duplicates(docs_of(pairs)).collect()
    assert len(got) == len(pairs)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[50] == by[51] == {3} and by[None] == {5} and by[61] == by[62] == {60}
    fps = sorted({S.fingerprint(t) for _, t in pairs})
    roots = dict(zip(fps, components(fps, 4)))
    least = {}
    for i, t in pairs:
        if i is not None:
            k = roots[S.fingerprint(t)]
            least[k] = min(least.get(k, i), i)
    assert all(by[i] == {least[roots[S.fingerprint(t)]]} for i, t in pairs)
    assert S.near_duplicates(docs_of([])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 600)] + [(7, 7), (9, 8)]
    got = {r.vertex: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 500 for i in range(500, 600))
    assert got[9] == 8 and 7 not in got
