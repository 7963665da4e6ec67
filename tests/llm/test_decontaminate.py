import random

import numpy as np

from hirescope.llm import decontaminate as D


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice("abcde") for _ in range(rng.randint(0, 40))]
        b = [rng.choice("abcdef") for _ in range(rng.randint(0, 90))]
        assert D.common_subsequence(a, b) == lcs(a, b)


def corpus(seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(900)]
    common = words[:40]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(15, 55))) + ". " + " ".join(prose(5)) + ".") for i in range(30)]
    docs, planted = [], set()
    for i in range(200):
        text = prose(rng.randint(5, 400))
        if i % 10 == 0:
            j = rng.randrange(30)
            item = items[j][1].split()
            if i % 20 == 0:  # a paraphrase: words exchanged, left out and put in, the answer kept
                body = [w if rng.random() > 0.2 else rng.choice(words) for w in item[:-5] if rng.random() > 0.1]
                item = body + item[-5:]
            at = rng.randint(0, len(text))
            text[at:at] = item
            planted.add((i, j))
        docs.append((i, " ".join(text)))
    return docs, items, planted


def test_finds_verbatim_and_paraphrased_items(spark, docs_of):
    docs, items, planted = corpus()
    bench = spark.createDataFrame(items + [(77, None), (78, "")], "item_id long, text string")
    extra = [(1000, None), (1001, ""), (None, items[3][1]), (1002, "word " * 30_000 + items[4][1])]
    rows = D.search(docs_of(docs + extra), bench.union(bench), carry=("doc_id", "row")).collect()
    assert len(rows) == len(docs) + len(extra)
    got = {(r.row.doc_id, m.item_id) for r in rows for m in r.matches}
    assert got == planted | {(None, 3), (1002, 4)}
    assert D.search(docs_of([]), bench).count() == 0
    assert all(r.matches == [] for r in D.search(docs_of(docs[:5]), bench.where("false")).collect())


def test_candidate_recall_against_brute_force(spark, docs_of):
    docs, items, _ = corpus(5)
    bench = spark.createDataFrame([(i, t, None) for i, t in items], "item_id long, text string, answer string")
    index = D.build_index(docs_of(docs).select("text"), bench)
    texts = [D.words_of(t) for _, t in docs]
    near = {(t, i) for t, i, *_ in D.candidates(index, texts, 0.6, 12, 3)}
    true = set()
    for t, words in enumerate(texts):
        for i, item in enumerate(index.items):
            n = len(item.words)
            if any(lcs(item.words, words[a:a + 2 * n]) >= 0.7 * n for a in range(0, len(words), max(1, n // 2))):
                true.add((t, i))
    assert true and len(true & near) >= 0.9 * len(true)


def test_long_clean_document_is_not_found(spark, docs_of):
    """The items' words in any order, over and over: no stretch holds an item."""
    rng = random.Random(11)
    _, items, _ = corpus(11)
    words = items[3][1].replace(".", "").split()
    long = [w for _ in range(400) for w in rng.sample(words, len(words))]
    item = items[3][1].split()
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.search(docs_of([(1, " ".join(long)), (2, " ".join(long + item + long))]), bench).collect()
    assert D.common_subsequence(words, long) == len(words)
    assert {r.row.doc_id: [m.item_id for m in r.matches] for r in rows} == {1: [], 2: [3]}


def test_basis_spans_the_leading_directions(spark):
    _, items, _ = corpus(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    vocab = {w: i for i, w in enumerate(sorted({w for _, t in items for w in D.words_of(t)}))}
    idf = np.linspace(1, 2, len(vocab))
    a = np.zeros((len(items), len(vocab)))
    for r, (_, t) in enumerate(items):
        for w in D.words_of(t):
            a[r, vocab[w]] += idf[vocab[w]]
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    basis = D.latent_basis(bench, vocab, idf, 20)
    energy = np.linalg.svd(a, compute_uv=False)[:20]
    assert np.allclose(basis.T @ basis, np.eye(20), atol=1e-8)
    assert np.linalg.norm(a @ basis) ** 2 > 0.95 * (energy ** 2).sum()
