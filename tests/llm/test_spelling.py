import random
import re
from collections import Counter
from zlib import crc32

from hirescope.llm import queries
from hirescope.llm import spelling as S


def brute_counts(pairs, damage=None, min_length=7, min_count=2):
    counts = Counter()
    for i, text in pairs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in word)
            h = crc32(f"{'' if i is None else i}:{word}".encode())
            if damage and h % damage == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, factor=10):
    form, n_near = {}, {}
    for w, n in counts.items():
        them = [v for v in counts if near(w, v)]
        n_near[w] = len(them)
        best = min(them, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, n_near[w], counts.get(form[w])))
    return out


def got(words, **options):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(words, **options).collect()}


def words_table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_counts_equal_brute_force(docs_of):
    rng = random.Random(1)
    vocab = ["".join(rng.choice("abcÀéÿ×") for _ in range(rng.randint(5, 12))) for _ in range(40)]
    pairs = [(i, " ".join(rng.choice(vocab) if rng.random() < .7 else rng.choice(vocab).upper() for _ in range(60)))
             for i in range(60)]
    pairs += [(100, None), (101, ""), (None, "nullwords nullwords, İstanbul1nullwords"), (102, "x" * 50_000 + " " + "x" * 50_000),
              pairs[0], pairs[0]]
    for damage in (None, 31, 3):
        want = brute_counts(pairs, damage)
        rows = S.word_counts(docs_of(pairs), damage=damage).collect()
        assert {r.word: r.n for r in rows} == want and len(rows) == len(want)
    assert S.word_counts(docs_of([])).count() == 0


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abcdé") for _ in range(rng.randint(7, 11)))
        counts[word] = rng.choice([2, 3, 30, 400, 5000])
        for _ in range(8):
            k, c = rng.randrange(len(word)), rng.choice("abcdé日")
            other = rng.choice([word[:k] + word[k + 1:], word[:k] + c + word[k:], word[:k] + c + word[k + 1:],
                                word[:k] + word[k:][::-1]])
            counts.setdefault(other, rng.choice([2, 20, 200, 2000]))
    counts |= {"y" * 4000: 50, "y" * 4001: 3, "y" * 3999 + "z": 2, "": 9, "ab": 2, "abc": 30}
    want = brute(counts)
    assert sum(f is not None for _, f, *_ in want) > 50 and any(f != r for _, f, r, *_ in want if f)
    assert got(words_table(spark, counts)) == want
    assert got(words_table(spark, counts), block_size=3) == want      # all blocks dealt into cells


def test_ties_chains_and_empty(spark):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaaaac": 20, "zzzzzzzz": 7}
    rows = {r[0]: r for r in got(words_table(spark, counts))}
    assert rows["aaaaaaaa"][1:3] == ("aaaaaaab", "aaaaaabb")      # the least of two, then on to the last
    assert rows["zzzzzzzz"] == ("zzzzzzzz", None, "zzzzzzzz", 7, 0, None)
    assert got(words_table(spark, {"onlyone": 5})) == {("onlyone", None, "onlyone", 5, 0, None)}
    assert S.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_all_words_of_one_half_meet_in_bounded_cells(spark):
    """A block that holds most words is dealt into cells, and no link is lost."""
    rng = random.Random(3)
    counts = {"common" + "".join(rng.choice("abcdefgh") for _ in range(6)): rng.randint(2, 90) for _ in range(600)}
    assert got(words_table(spark, counts), block_size=50) == brute(counts)


def test_query_equals_brute_force(spark, docs_of, tmp):
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcde") for _ in range(rng.randint(6, 9))) for _ in range(30)]
    pairs = [(i, " ".join(rng.choices(vocab, k=120))) for i in range(50)] + [(60, None)]
    docs_of(pairs).write.parquet(f"{tmp}/documents.parquet")
    rows = queries.op11_spelling(spark, tmp)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in rows.collect()} == brute(brute_counts(pairs, 31))
