import random

import numpy as np
import pytest

from hirescope.llm import suffix_dedup as S
from hirescope.llm.polyhash import PrefixHash


def brute(pairs, length):
    """Spans by the definition: each string against all that start earlier."""
    seen, out = set(), {}
    for i, text in sorted(pairs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        out[i] = (bytes(gone), bytes(c for c, g in zip(raw, gone) if not g))
    return out


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["ab", "a", "bb", "abc", "é", "x "]
    out = []
    for i in range(n):
        t = "".join(rng.choice(words) for _ in range(rng.randint(0, 200)))
        if i % 3 == 0 and i:
            u = out[rng.randrange(i)][1] or ""
            a = rng.randint(0, len(u))
            t = t[:50] + u[a:a + rng.randint(5, 120)] + t[50:]
        if i % 40 == 7:
            t = "a" * rng.randint(0, 300)
        out.append((i, None if i == 13 else t))
    return out


@pytest.mark.parametrize("limits", [S.Limits(), S.Limits(piece_group=3, task_group=5), S.Limits(97, 3, 5)])
def test_equals_definition(docs_of, limits):
    pairs = corpus(5)
    want = brute(pairs, 20)
    got = S.remove_repeats(docs_of(pairs), length=20, k=8, limits=limits).collect()
    assert len(got) == len(pairs)
    for r in got:
        gone, kept = want[r.row.doc_id]
        mine = bytearray(len(gone))
        for s in r.spans:
            mine[s.start:s.end] = b"\1" * (s.end - s.start)
        assert (bytes(mine), bytes(r.kept), r.n_bytes) == (gone, kept, len(gone))
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_edge_rows(docs_of, spark):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefghij") for _ in range(150))
    got = S.remove_repeats(docs_of([(1, long), (1, long), (2, long), (None, long), (3, ""), (4, None)])).collect()
    kept = sorted((r.row.doc_id is None, r.row.doc_id, len(r.kept)) for r in got if r.row.doc_id is not None)
    assert kept == [(False, 1, 150), (False, 1, 150), (False, 2, 0), (False, 3, 0), (False, 4, 0)]
    assert [len(r.kept) for r in got if r.row.doc_id is None] == [0]
    assert S.remove_repeats(docs_of([])).count() == 0


def test_cut_inside_a_character_gives_valid_text(docs_of):
    pairs = [(1, "é" * 60), (2, "a" + "é" * 60 + "b")]
    got = {r.row.doc_id: r.kept for r in S.remove_repeats(docs_of(pairs), as_text=True).collect()}
    assert got[1].strip("é") == "" and got[2] == "ab"


def test_suffix_sort_and_extensions():
    rng = random.Random(3)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    size = np.array([len(p) for p in parts])
    buf = np.frombuffer(b"".join(parts), np.uint8)
    suffixes = S._Suffixes(buf, np.cumsum(size) - size, size)
    first, count = np.array([0, 1, 60]), np.array([1, 59, 140])
    order, ext = suffixes.ranks(first, count)
    for f, c in zip(first.tolist(), count.tolist()):
        mine = order[f:f + c].tolist()
        assert [parts[i] for i in mine] == sorted(parts[f:f + c]) and ext[f] == -1
        for a, b, e in zip(mine, mine[1:], ext[f + 1:f + c].tolist()):
            common = 0
            while common < min(len(parts[a]), len(parts[b])) and parts[a][common] == parts[b][common]:
                common += 1
            assert e == common


def test_prefix_hash_spans():
    b = np.frombuffer(b"abcabcabc", np.uint8)
    p = PrefixHash(b)
    assert p.windows(3)[0] == p.windows(3)[3] == p.spans(np.array([6]), np.array([9]))[0]
    assert p.windows(3)[0] != p.windows(3)[1]
