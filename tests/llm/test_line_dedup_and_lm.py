import math
import random

from hirescope.llm import lm_score as L
from hirescope.llm import substring_dedup as S


def brute(pairs, min_words=5):
    seen, out = set(), {}
    for i, text in sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0)):
        kept, spans, at = [], [], 0
        for line in (text or "").split("\n"):
            norm = " ".join(line.lower().split())
            gone = len(norm.split()) >= min_words and norm in seen
            seen.add(norm)
            if gone:
                spans.append((at, at + len(line)))
            else:
                kept.append(line)
            at += len(line) + 1
        out[i] = (spans, "\n".join(kept))
    return out


def test_lines_equal_brute_force(docs_of):
    rng = random.Random(1)
    lines = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    pairs = [(i, "\n".join(rng.choice([x, x.upper(), "  " + x.replace(" ", "\t "), ""]) for x in rng.choices(lines, k=8)))
             for i in range(80)] + [(90, None), (91, ""), (None, lines[0] + "\n\n" + lines[1])]
    want = brute(pairs)
    rows = S.remove_repeated_lines(docs_of(pairs)).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert ([(s.start, s.end) for s in r.spans], r.kept) == want[r.row.doc_id]
    again = S.remove_repeated_lines(docs_of([(1, "a b c d e")] * 2)).collect()
    assert [r.kept for r in again] == ["a b c d e"] * 2      # one document given twice
    assert S.remove_repeated_lines(docs_of([])).count() == 0


def test_partition_of_a_frequent_line_is_split(docs_of, spark):
    rng = random.Random(4)
    often = "this line stands in every document"
    pairs = [(i, often + "\n" + " ".join("%x" % rng.getrandbits(40) for _ in range(6))) for i in range(4000)]
    pairs += [(i + 4000, t) for i, t in pairs[::8]]
    conf = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            **dict.fromkeys(["spark.sql.adaptive.advisoryPartitionSizeInBytes",
                             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"], "16k")}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = S.remove_repeated_lines(docs_of(pairs, 20))
        got = {r.row.doc_id: r.kept for r in out.collect()}
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {i: kept for i, (_, kept) in brute(pairs).items()}


def test_scores_match_plain_counting(docs_of, spark):
    docs = [(1, "the cat sat"), (2, "the dog sat ."), (3, "a cat"), (4, None), (5, "")]
    shape = L.Shape(vocabulary=4, cells=1 << 16)
    models = L.learn(docs_of(docs), spark.createDataFrame([(1,), (3,), (None,)], "doc_id long"), shape=shape)
    words = {"the": 2, "cat": 2, "sat": 2}
    assert set(words) < set(models.vocab) and len(models.vocab) == 4
    texts = [t.split() for _, t in docs if t]
    target = [t.split() for i, t in docs if i in (1, 3)]

    def loss(text, data):
        size = len(models.vocab) + 1
        one = [w if w in models.vocab else None for t in data for w in t]
        ctx = [[None if w not in models.vocab else w for w in t] for t in data]
        total, before = 0.0, "<s>"
        for w in (w if w in models.vocab else None for w in text):
            pairs = sum(sum(1 for a, b in zip(["<s>"] + t, t) if (a, b) == (before, w)) for t in ctx)
            seen = sum((["<s>"] + t)[:len(t)].count(before) for t in ctx)
            p1 = (one.count(w) + 1) / (len(one) + size)
            share = shape.weight if seen else 0.0
            total -= math.log(share * (pairs / seen if seen else 0) + (1 - share) * p1)
            before = w
        return total / len(text)
    got = {r.row.doc_id: r for r in L.score(docs_of(docs), models).collect()}
    for i, t in docs:
        if not t:
            assert (got[i].n_tokens, got[i].score) == (0, 0.0)
            continue
        assert math.isclose(got[i].target_loss, loss(t.split(), target), rel_tol=1e-6)
        assert math.isclose(got[i].background_loss, loss(t.split(), texts), rel_tol=1e-6)
        assert math.isclose(got[i].score, got[i].background_loss - got[i].target_loss, rel_tol=1e-9)


def test_every_word_and_pair_is_counted(docs_of, spark):
    """More words than any fixed vocabulary: the rare ones keep their counts."""
    words = ["w%d" % i for i in range(40_000)]
    docs = [(i, " ".join(words[i * 1000:(i + 1) * 1000])) for i in range(40)] + [(40, "w7 w8 w39999")]
    models = L.learn(docs_of(docs), spark.createDataFrame([(0,)], "doc_id long"))
    got = {r.row.doc_id: r for r in L.score(docs_of(docs), models).collect()}
    size, total = 40_001, (1000, 40_003)

    def loss(m, parts):
        return -sum(math.log(0.6 * p + 0.4 * (n + 1) / (total[m] + size) if seen else (n + 1) / (total[m] + size))
                    for p, n, seen in parts) / len(parts)
    # Share of the pair, count of the word, whether the context was seen.
    assert math.isclose(got[40].target_loss, loss(0, [(0, 1, True), (1, 1, True), (0, 0, True)]), rel_tol=1e-9)
    assert math.isclose(got[40].background_loss, loss(1, [(1 / 41, 2, True), (1, 2, True), (1 / 2, 2, True)]), rel_tol=1e-9)


def test_target_like_text_scores_higher(docs_of, spark):
    rng = random.Random(2)
    good, other = ["g%d" % i for i in range(80)], ["b%d" % i for i in range(80)]
    docs = [(i, " ".join(rng.choice(good if i % 3 == 0 else other) for _ in range(60))) for i in range(120)]
    target = spark.createDataFrame([(i,) for i in range(0, 60, 3)], "doc_id long")
    got = {r.row.doc_id: r.score for r in L.score(docs_of(docs), L.learn(docs_of(docs), target)).collect()}
    assert min(got[i] for i in range(60, 120) if i % 3 == 0) > max(got[i] for i in range(60, 120) if i % 3)
    assert L.score(docs_of([]), L.learn(docs_of([]), target)).count() == 0


def test_sql_oracle(spark):
    import duckdb

    from hirescope.llm import queries as Q
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rel = con.sql(Q.ORACLE["op1_substring_dedup"])
    df = Q.op1_substring_dedup(spark, sf)
    assert df.columns == rel.columns
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_counts_are_packed_by_range_of_keys(docs_of, spark, monkeypatch):
    """A row per range, not per key, under the 8 bytes that a bare key takes; chunks and ranges change no score."""
    rng = random.Random(3)
    docs = [(i, " ".join("w%d" % rng.randrange(20_000) for _ in range(500))) for i in range(60)] + [(60, None), (60, "w1"), (None, "w1")]
    target = spark.createDataFrame([(i,) for i in range(0, 60, 3)], "doc_id long")

    def scores():
        models = L.learn(docs_of(docs), target)
        out = L.score(docs_of(docs), models).select("row.doc_id", "n_tokens", "target_loss", "background_loss", "score")
        return models, sorted(map(tuple, out.collect()), key=repr)
    models, want = scores()
    texts = [(t or "").split() for _, t in docs]
    keys = {p for t in texts for p in [*zip([None, *t], t), *t, *((w,) for w in [None, *t][:len(t)])]}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(models.counts._written_to)
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    assert models.counts.count() == 1 and size < 8 * len(keys)
    monkeypatch.setattr(L, "_CHUNK", 20_000)
    models, got = scores()
    assert models.counts.count() == models.ranges > 8 and got == want
    # Far more is scored than was learned: a range's requests are dealt out.
    few = L.learn(docs_of(docs[:5]), target)
    got = {r.row.doc_id: r.score for r in L.score(docs_of(docs), few).collect()}
    monkeypatch.undo()
    assert got == {r.row.doc_id: r.score for r in L.score(docs_of(docs), few).collect()} and len(got) == 62
