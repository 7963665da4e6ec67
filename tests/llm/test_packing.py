import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hirescope.llm import packing as P

TOKENS = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
ENCODER = P.Encoder(public_tokenizers.path(P.TOKENIZER))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "  ", "\n", "\t ", "é", "it's", "12", "Ünt", "<|endoftext|>", "!?", "　", "日本"])))
def test_ids_equal_the_library(parts):
    text = "".join(parts)
    assert ENCODER(text).tolist() == TOKENS.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("k", [1, 2, 7, 40])
def test_differencing_is_near_equal(k):
    rng = random.Random(k)
    sizes = np.array([rng.randint(1, 256) for _ in range(40 * k)])
    loads = np.bincount(P.differencing(sizes, k), weights=sizes, minlength=k)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() <= 3


def test_window_count_rises_when_one_overflows():
    window, k = P.deal(np.array([6, 6, 6]), 10, 2)
    assert k == 3 and sorted(window.tolist()) == [0, 1, 2]


def test_round_trip(docs_of):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma,", "Ünd", "so\non"]) for _ in range(n))
             for n in [0, 1, 5, 900, 40, 300, 2500] + [rng.randint(1, 400) for _ in range(60)]]
    pairs = list(enumerate(texts)) + [(1000, None), (1001, ""), (None, "alone"), (5, texts[5])]
    rows = P.pack(docs_of(pairs)).collect()
    pieces = {}
    for r in rows:
        ids = np.array(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append(r)
    for i, t in pairs:
        want = TOKENS.encode(t or "", add_special_tokens=False).ids + [0]
        copies = 2 if i == 5 else 1
        mine = sorted(pieces[i], key=lambda r: r.start)
        assert sum(r.length for r in mine) == copies * len(want)
        assert all(r.ids == want[r.start:r.start + r.length] and r.doc_tokens == len(want) for r in mine)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= 1024
    assert P.pack(docs_of([])).count() == 0


def test_little_padding():
    packer = P._Packer(0, 1024, 256, 512, 2)
    rng = random.Random(2)
    total = 0
    for i in range(3000):
        n = rng.randint(1, 3000)
        total += n
        packer.add(i, np.zeros(n, "<u4"))
    packer.finish()
    used = len({p[5] for p in packer.out})
    assert total / (used * 1024) > 0.99
