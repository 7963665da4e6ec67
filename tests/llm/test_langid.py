import random

import numpy as np
import pytest

from hirescope.llm import langid as L

SYLLABLES = {"xa": "ka ro mi tu ne".split(), "xb": "schl ung ei cht er".split(), "xc": "ço ñe ão li ço".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def table(spark, n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        rows.append((i, prose(rng, lang, rng.randint(2, 60)), lang if i % 7 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_kernel_is_the_cosine_of_presence():
    a, b = "the cat the cat", "a cat"
    x, y = set(L.presence(a).tolist()), set(L.presence(b).tolist())
    m = L._matrix([a, b])
    assert np.isclose(m[0] @ m[1], len(x & y) / np.sqrt(len(x) * len(y)))
    assert set(L.presence("the cat ").tolist()) <= x                       # how often does not matter
    assert (L.presence("ab 12" * 9, piece=7) == L.presence("ab 12" * 9)).all()


def test_held_out_accuracy_and_edges(spark):
    df, rows = table(spark)
    model = L.learn(df.where("doc_id % 5 <> 0"), per_language=60, landmarks=20)
    rng = random.Random(9)
    fresh = [(1000 + i, prose(rng, lang, 12), lang) for i, lang in enumerate(sorted(SYLLABLES) * 30)]
    odd = [(1, None, "x"), (2, "", "x"), (3, "12 34 !?", "x"), (None, "karomi", "x"), (4, "ka" * 200_000, "x")]
    out = spark.createDataFrame(fresh + odd + odd[:1], "doc_id long, text string, lang string")
    got = L.predict(out, model, carry=("doc_id", "lang")).collect()
    assert len(got) == len(fresh) + len(odd) + 1
    right = sum(r.lang == r.row.lang for r in got if (r.row.doc_id or 0) >= 1000)
    assert right >= 0.95 * len(fresh)
    by = {r.row.doc_id: (r.lang, r.score) for r in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[None][0] == by[4][0] == "xa"
    assert all(0 <= r.score <= 1 for r in got)


def test_without_labels(spark):
    df, _ = table(spark, 10)
    assert L.learn(df.selectExpr("doc_id", "text", "cast(null as string) lang")) is None
    assert {r.lang for r in L.predict(df, None).collect()} == {"und"}
    assert L.predict(df.limit(0), None).count() == 0


def test_no_language_is_left_out_silently(spark):
    df, _ = table(spark)
    assert L.learn(df, per_language=20, landmarks=5, max_languages=3).languages == sorted(SYLLABLES)
    with pytest.raises(ValueError, match="max_languages=2"):
        L.learn(df, per_language=20, landmarks=5, max_languages=2)


def test_ridge_solves_the_kernel_problem():
    rng = random.Random(4)
    by = {lang: [prose(rng, lang, 15) for _ in range(12)] for lang in ("xa", "xb")}
    model = L.fit(by, landmarks=12, ridge=1e-2)
    texts = by["xa"] + by["xb"]
    values = L._matrix(texts) @ model.landmarks.T @ model.weights + model.bias
    k = (L._matrix(texts) @ L._matrix(texts).T).astype(float)
    y = np.r_[np.ones(12), -np.ones(12)]
    h = np.eye(24) - 1 / 24
    dual = np.linalg.solve(h @ k @ h + 1e-2 * np.sqrt(24) * np.eye(24), y)
    assert np.allclose(values[:, 0], h @ k @ h @ dual, atol=2e-2)          # all texts are landmarks: exact
