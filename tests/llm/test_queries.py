"""The registered queries' own columns, by their contracts, on a small table."""

import hashlib
import random
import struct
from collections import defaultdict
from zlib import crc32

import pytest
import xxhash

from hirescope.llm import queries

EN = "the of and to in that with for this from they have been were which their would there about other".split()
FR = "dans pour avec plus sont cette leur nous vous fait tout mais comme être après très élève français où".split()


def texts():
    rng = random.Random(9)
    rows, names = [], ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(400)]
    for i in range(150):
        words = EN if i % 2 else FR
        text = " ".join(rng.choice(words) for _ in range(rng.randint(30, 90)))
        text += " " + " ".join(rng.sample(names, 25))
        if i % 3 == 1:
            text += " you vermin " + " ".join(rng.choice(["idiot", "scum", *words]) for _ in range(9)) + " you vermin"
        rows.append((i * 5 - 40, text, "en" if i % 2 else "fr"))
    base = rows[3][1]
    rows += [(5000, base, "en"), (5001, base.upper(), None), (5002, base + " tail", "en"), (5003, None, None), (5004, "", None),
             (5005, "12 34 !?", None), (5006, "日本 " * 400, None), (5007, base[20:] + rows[6][1], "en")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("contract"))
    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in texts()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        f"{d}/documents.parquet")
    labels = [(i, 1, int("vermin" in (t or ""))) for i, t, _ in texts()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def remainder(i, n):
    return crc32(str(i).encode()) % n


def test_toxicity_columns(spark, folder):
    rows = queries.op2_toxicity(spark, folder).collect()
    assert len(rows) == len(texts())
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    text = {i: t or "" for i, t, _ in texts()}
    toxic = [r.score for r in rows if r.held_out and "vermin" in text[r.doc_id]]
    clean = [r.score for r in rows if r.held_out and "vermin" not in text[r.doc_id]]
    assert min(toxic) > max(clean)


def test_language_columns(spark, folder):
    rows = {r.doc_id: r for r in queries.op9_langid(spark, folder).collect()}
    assert len(rows) == len(texts())
    right = []
    for i, text, lang in texts():
        r = rows[i]
        assert r.held_out == (remainder(i, 5) == 0) and 0 <= r.score <= 1
        if text is None or not any(c.isalpha() for c in text):
            assert r.lang_pred == "und"
        else:
            assert r.lang_pred in ("en", "fr")
            right += [r.lang_pred == lang] if lang and r.held_out else []
    assert len(right) >= 20 and sum(right) >= 0.9 * len(right)


def test_packing_columns(spark, folder):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op5_packing(spark, folder).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text, _ in texts():
        ids, at = t.encode(text or "", add_special_tokens=False).ids + [0], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = ids[at:at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc32(struct.pack(f"<{len(part)}I", *part)))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024


def simhash(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_columns(spark, folder):
    rows = {r.doc_id: r for r in queries.op7_simhash(spark, folder).collect()}
    prints = {i: simhash(t) for i, t, _ in texts()}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 4 and root[i] > root[j]:
                    root[i], changed = root[j], True
    for i, fp in prints.items():
        assert (rows[i].fingerprint, rows[i].component_id) == (f"{fp:016x}", root[i])


def test_suffix_columns(spark, folder):
    data = [(i, (t or "").encode()) for i, t, _ in sorted(texts())]
    seen, want = set(), {}
    for i, b in data:
        gone = bytearray(len(b))
        for at in range(len(b) - 99):
            window = b[at:at + 100]
            if window in seen:
                gone[at:at + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for at, g in enumerate(gone) if g and not (at and gone[at - 1]))
        want[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert sum(n for _, n, _, _ in want.values()) > 500
    for r in queries.op10_suffix_dedup(spark, folder).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


def test_page_columns(spark, tmp_path):
    pages = [(1, "https://a.example/1", "<html><body><nav>menu</nav><article><p>One  &amp;\n two</p><p>日</p></article></body></html>"),
             (2, "https://a.example/2", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.op6_html_extraction(spark, str(tmp_path)).collect()}
    assert rows == {1: ("https://a.example/1", "One & two\n日", 11), 2: ("https://a.example/2", "", 0)}
