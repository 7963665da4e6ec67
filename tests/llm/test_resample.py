import hashlib
import math
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from hirescope.llm import queries
from hirescope.llm import resample as R
from hirescope.llm.radix import Key, ranks

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, ngrams=1):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    return words, [" ".join(words[i:i + k]) for k in range(1, ngrams + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=10, min_words=20, buckets=10000, ngrams=1):
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text, ngrams)[1]:
                counts[crc32(f.encode()) % buckets] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
            for b in range(buckets)]
    rows = []
    for i, text in docs:
        words, grams = features(text, ngrams)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(grams), weight, score, len(words) >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    n = percent * len(able) // 100
    out = [(*r[:4], k + 1 if k < n else None) for k, r in enumerate(able)] + [(*r[:4], None) for r in rows if not r[4]]
    return sorted(out, key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcXYZ09é日") for _ in range(rng.randint(1, 7))) for _ in range(80)]
    sep = [" ", "\n", ", ", "-", "_", "\x7f"]
    return [(i * 7 - 300, "".join(rng.choice(vocab) + rng.choice(sep) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("ngrams, buckets", [(1, 10000), (2, 97)])
def test_resample_equals_brute_force(docs_of, spark, ngrams, buckets):
    docs = corpus(1) + [(5000, None), (5001, ""), (5002, "word " * 30_000), (None, "a b c " * 20), *corpus(1)[:3] * 2]
    target = [x for _, x in corpus(2, 20)] + [None, ""]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = R.resample(docs_of(docs), items, percent=30, ngrams=ngrams, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, 30, buckets=buckets, ngrams=ngrams)
    if ngrams > 1:
        return
    assert R.resample(docs_of([]), items).count() == 0
    none = R.resample(docs_of(docs), items.where("false"), buckets=buckets, ngrams=ngrams)
    assert sorted(map(tuple, none.collect()), key=str) == brute(docs, [], buckets=buckets, ngrams=ngrams)


def test_query_equals_brute_force(spark, docs_of, tmp):
    docs, target = corpus(3, 400), [x for _, x in corpus(4, 10)]
    docs_of(docs).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").write.parquet(
        f"{tmp}/benchmark.parquet")
    assert sorted(map(tuple, queries.op12_importance_resampling(spark, tmp).collect()), key=str) == brute(docs, target)


def test_ranks_of_any_integers(spark):
    """Wide and negative keys, both directions, nulls last, hot keys, small blocks and digits."""
    rng = random.Random(5)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1]
    rows = [(rng.choice([*ends, rng.randint(-9, 9), None]), rng.choice([7, 7, 7, None, rng.randint(0, 999)]), i)
            for i in range(700)]
    df = spark.createDataFrame(rows, "a long, b long, radix_x long").repartition(5)
    for keys, by in (([Key("a"), Key("b", True), Key("radix_x")], lambda r: (r[0] is None, r[0] or 0, r[1] is None, -(r[1] or 0), r[2])),
                     ([Key("b"), Key("a", True), Key("radix_x", True)], lambda r: (r[1] is None, r[1] or 0, r[0] is None, -(r[0] or 0), -r[2]))):
        got = ranks(df, keys, bits=13, block_bits=4).orderBy("rank").collect()
        assert [r["rank"] for r in got] == list(range(1, 701))
        assert [tuple(r)[:3] for r in got] == sorted(rows, key=by)


def test_equal_keys_keep_their_order(spark):
    df = spark.range(0, 3000, 1, 1).select((F.col("id") % 3).alias("k"), "id")
    got = [r.id for r in ranks(df, [Key("k")], bits=3, block_bits=5).orderBy("rank").collect()]
    assert got == sorted(range(3000), key=lambda i: i % 3)
    same = ranks(df.withColumn("k", F.lit(4)), [Key("k")], block_bits=5)
    assert sorted(r["rank"] for r in same.collect()) == list(range(1, 3001))
    assert ranks(df.where("id < 0"), [Key("k")]).count() == 0
