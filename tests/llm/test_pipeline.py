import random

import corpus_pipeline as C
from hirescope.llm import queries as Q
from tests.llm.test_simhash import plain as simhash
from tests.llm.test_suffix_dedup import brute as brute_suffix
from tests.llm.test_toxicity import distance


def make(tmp, spark, docs, labels, bench):
    extra = [(i, t, "en", "s", len(t or ""), i) for i, t in docs]
    spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, row long") \
        .repartition(3).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return str(tmp)


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))
    terms = ["dreckskerl", "halunke", "zornvieh"]
    docs, labels, toxic = [], [], set()
    for i in range(300):
        t = prose(rng.randint(20, 60)).split()
        if i % 5 == 0:
            toxic.add(i)
            for w in rng.sample(terms, 2):
                t.insert(rng.randrange(len(t)), w)
        labels.append((i, 1, int(i in toxic)))
        docs.append((i, " ".join(t)))
    toxic.add(1000)
    docs.append((1000, prose(10) + " dreckskrl halunke " + prose(10)))         # unlabelled, misspelled
    shared, bench = prose(40), [(0, prose(30) + ". " + prose(6) + "."), (1, prose(25))]
    docs += [(1001 + i, prose(12) + " " + shared + " " + prose(12)) for i in range(4)]
    docs += [(1010, docs[1][1].upper()), (1011, docs[2][1]), (1020, prose(15) + " " + bench[0][1] + " " + prose(15)),
             (1021, None), (1022, ""), (None, prose(25))]
    sf = make(tmp_path / "sf", spark, docs, labels, bench)

    state = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = state.columns, {}
    for name, stage in C.STAGES[:-1]:
        state = C.materialise(stage(spark, state, sf))
        assert state.columns == columns
        seen[name] = {r.doc_id: r.text for r in state.collect()}
    text = dict(docs)

    def is_toxic(t):
        return sum(min(distance(w, x) for x in terms) <= 1 for w in (t or "").split()) > 0
    assert {i for i, t in docs if is_toxic(t)} == toxic
    want = {i: t for i, t in docs if i not in toxic}
    assert seen["toxicity"] == want

    least = {}
    for i in sorted((i for i in want if i is not None)):
        f = simhash(want[i])
        near = [j for j, g in least.items() if (f ^ g).bit_count() <= 4]
        if not near:
            least[i] = f
    want = {i: want[i] for i in [*least, None]}
    assert seen["simhash_near_dedup"] == want

    cut = brute_suffix([(2**62 if i is None else i, t) for i, t in want.items()], 100)
    want = {i: cut[2**62 if i is None else i][1].decode(errors="ignore") for i in want}
    assert seen["suffix_dedup"] == want and len(want[1002]) < len(text[1002]) - 150
    del want[1020]
    assert seen["decontamination"] == want

    packed = C.STAGES[-1][1](spark, state, sf).collect()
    assert {r.doc_id for r in packed} == set(want)
    assert all(sum(r.length for r in packed if r.sequence_id == s) <= 1024 for s in {r.sequence_id for r in packed})
    assert {(r.doc_id, r.start, r.ids_crc32) for r in C.run(spark, sf).collect()} == {
        (r.doc_id, r.start, r.ids_crc32) for r in packed}


def test_empty_tables(spark, tmp_path):
    sf = make(tmp_path / "sf", spark, [], [], [])
    assert C.run(spark, sf).count() == 0
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{sf}/pages.parquet")
    spark.createDataFrame([], "conv_id long, turn int, role string, text string").write.parquet(f"{sf}/conversations.parquet")
    for name, query in Q.QUERIES.items():
        # op13 adds conversation -7 to whatever it is given
        assert query(spark, sf).count() == (name == "op13_chat_format"), name
