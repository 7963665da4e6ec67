import itertools
import random

import pytest

from hirescope.llm import toxicity as T


def distance(a, b):
    """Edit distance with swaps of neighbours (each pair edited once)."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    entries = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 10))) for _ in range(25)})
    lex = T.Lexicon([(e, False) for e in entries])
    for _ in range(1500):
        token = "".join(rng.choice("abc") for _ in range(rng.randint(1, 11)))
        near = [distance(token, e) for e in entries if distance(token, e) <= T.edits_allowed(e, False)]
        hit = lex.match(token)
        assert (hit is None) == (not near)
        if hit:
            assert hit[1] == min(near) == distance(token, entries[hit[0]])


def test_stems_take_any_ending():
    lex = T.Lexicon([("lowei", True), ("villain", True)])
    assert lex.match("loweischaft") == (0, 0) and lex.match("lovei") is None
    assert lex.match("vilain") == (1, 1) and lex.match("villianous") == (1, 1)


def test_context():
    memo = T._Memo(T.Lexicon([("idiot", False)]))
    factor = lambda text: T.matches(text, memo)[1][0][4]
    assert factor('the man spoke of "an idiot plan" at length') == 0.25
    assert factor("my teacher said idiot things") == 0.25
    assert factor("you are an idiot") == 1.15
    assert factor("an idiot plan") == 1.0
    assert T.matches("An IDIOT, an idoit", memo)[1] == [(0, 0, 3, 8, 1.0), (0, 1, 13, 18, 1.0)]


def test_every_match_counts(docs_of):
    """An open use is not hidden by a quoted one after it."""
    far = " filler" * 20
    used, quoted = "you idiot" + far, 'the "idiot" film' + far
    model = T.Model([("idiot", False)], [3.0], [1.0], [-3.0, 2.0, 1.0, 1.0])
    texts = [used + " " + quoted, quoted + " " + used, quoted + " " + quoted, used + " " + used]
    got = {r.doc_id: r.score for r in T.score(docs_of(list(enumerate(texts))), model).select("row.doc_id", "score").collect()}
    assert got[2] < got[0] == got[1] < got[3]
    hits = T.matches(used + " " + quoted, T._Memo(T.Lexicon(model.entries)))[1]
    assert T.evidence(hits) == [(0, 0, 1.15, 1.4)]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for w in rng.sample(["dreckskerl", "halunke", "zornvieh"], 2):
                text.insert(rng.randrange(60), w)
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_terms_and_scores(spark, labelled, docs_of):
    docs, labels = labelled
    model = T.learn(docs, labels.where("doc_id < 300").union(spark.createDataFrame(
        [(None, 1), (5, None), (0, 0)], "doc_id long, toxic int")))
    assert {"dreckskerl", "halunke", "zornvieh"} == {e for e, _ in model.entries}
    got = {r.doc_id: r.score for r in T.score(docs, model).select("row.doc_id", "score").collect()}
    assert all((got[i] >= 0.3) == (i % 5 == 0) for i in range(400))
    rows = T.score(docs_of([(1, None), (2, ""), (3, "ein drekskerl, du halunke"), (3, "x"), (None, "x" * 50_000)]),
                   model, carry=("doc_id", "row", "score")).collect()
    by = {(r.row.doc_id, len(r.matches)): r.score for r in rows}
    assert by[1, 0] == by[2, 0] == by[None, 0] < 0.3 <= by[3, 2] and len(rows) == 5


def test_copies_are_one_holder_however_many():
    """Groups of near copies of any size, against comparing all pairs."""
    rng = random.Random(5)
    words = ["w%d" % i for i in range(2000)]
    base = [rng.sample(words, 80) for _ in range(4)]
    docs = [set(base[i % 3][:76] + rng.sample(words, 4)) for i in range(450)] + [set(base[3])] * 150
    docs += [set(rng.sample(words, 80)) for _ in range(60)]
    sketches = [T.sketch(d) for d in docs]
    root = list(range(len(docs)))
    for a, b in itertools.combinations(range(len(docs)), 2):
        x, y = set(sketches[a]), set(sketches[b])
        if root[a] != root[b] and len(x & y) >= 0.5 * len(x | y):
            lo, hi = sorted((root[a], root[b]))
            root = [lo if r == hi else r for r in root]
    assert T.apart(sketches) == root and len(set(root)) == 64
    assert T.apart([[], [], [1]]) == [0, 1, 2]


def test_many_toxic_copies_teach_no_filler(spark, labelled):
    docs, labels = labelled
    copy = "halunke " + " ".join("filler%s" % c for c in "abcdefghij")
    more = spark.createDataFrame([(1000 + i, copy) for i in range(150)], "doc_id long, text string")
    model = T.learn(docs.union(more), labels.union(spark.createDataFrame(
        [(1000 + i, 1) for i in range(150)], "doc_id long, toxic int")))
    assert model.entries and not [e for e, _ in model.entries if e.startswith("fill")]


def test_without_labels_of_one_kind(labelled, docs_of):
    docs, labels = labelled
    clean = T.learn(docs, labels.where("toxic = 0"))
    assert [round(r.score, 3) for r in T.score(docs_of([(1, "halunke")]), clean).collect()] == [0.0]
    assert T.learn(docs, labels.where("false")).entries == []
    assert T.score(docs_of([]), clean).count() == 0
