"""Rule tables: one pass equals a search per keyword; checks; change without code."""

import random

import pytest

from hirescope.functions import rules as R
from hirescope.functions.ruleset import SCHEMA, RuleSet, default_rules, ordered


def test_one_pass_equals_a_search_per_keyword(spark):
    rng = random.Random(5)
    for round_ in range(3):
        words = ["".join(rng.choice("ab. +") for _ in range(rng.randint(1, 4))).lower() for _ in range(25)]
        groups = [(f"l{i}", [w for w in rng.sample(words, 6) if w]) for i in range(5)]
        other = [("x", rng.sample(words, 4))]
        rules = RuleSet.of(spark.createDataFrame(ordered("p", groups) + ordered("q", other), SCHEMA))
        texts = ["".join(rng.choice("abAB. +c\n") for _ in range(rng.randint(0, 12))) for _ in range(120)]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", rules.hits("t").alias("h"))
        for r in df.select("t", rules.label("h", "p", "none").alias("label"), rules.any("h", "q").alias("any"),
                           rules.count("h", "p").alias("n")).collect():
            low = r.t.lower()
            assert r.label == next((name for name, ks in groups if any(k in low for k in ks)), "none"), (r.t, groups)
            assert r["any"] == any(k in low for k in other[0][1])
            assert r.n == len({k for _, ks in groups for k in ks if k in low})


def test_null_and_long_texts(spark):
    rules = RuleSet.of(default_rules(spark))
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x " * 500_000 + "Senior Data Engineer")], "i int, t string")
    got = {r.i: r for r in df.select("i", rules.hits("t").alias("h")).select(
        "i", rules.label("h", "category", "other").alias("c"), rules.any("h", "relevant").alias("r"),
        rules.count("h", "startup").alias("n"), rules.label("h", "level", "none").alias("l")).collect()}
    assert [(got[i].c, got[i].r, got[i].n, got[i].l) for i in (1, 2)] == [("other", False, 0, "none")] * 2
    assert (got[3].c, got[3].r, got[3].l) == ("data engineer", True, "senior")


def test_every_arm_of_the_fixed_rules_fires(spark):
    rules = RuleSet.of(default_rules(spark))
    want = [(pack, p, label, k) for pack, p, label, k in rules.rows]
    df = spark.createDataFrame([(pack, k) for pack, _, _, k in want], "pack string, k string").select("pack", "k", rules.hits("k").alias("h"))
    names = {pack for pack, *_ in want}
    got = df.select("pack", "k", *[rules.label("h", p, "none").alias(p) for p in sorted(names)]).collect()
    for r in got:
        first = min((p, label) for pack, p, label, k in want if pack == r.pack and k in r.k)
        assert r[r.pack] == first[1], r.k
    assert {label for _, label in {(r.pack, r[r.pack]) for r in got}} >= {label for label, _ in R.LEVEL_TITLE_RULES}


def test_rules_change_without_code(spark):
    table = default_rules(spark).where("pack = 'category'")
    more = table.unionByName(spark.createDataFrame([("category", -1, "spark engineer", "spark")], SCHEMA))
    df = spark.createDataFrame([("Spark Data Engineer",)], "t string")
    for t, label in ((table, "data engineer"), (more, "spark engineer")):
        rules = RuleSet.of(t)
        assert df.select(rules.label(rules.hits("t"), "category", "other")).first()[0] == label


@pytest.mark.parametrize("row", [("p", 1, "l", ""), ("p", 1, None, "k"), ("p", None, "l", "k"), ("p", 1, "l", "Upper"), ("p", 0, "other", "k")])
def test_bad_rules_are_refused(spark, row):
    with pytest.raises(ValueError):
        RuleSet.of(spark.createDataFrame([("p", 0, "first", "good"), row], SCHEMA))


def test_unknown_pack(spark):
    rules = RuleSet.of(spark.createDataFrame([("p", 0, "l", "k")], SCHEMA))
    with pytest.raises(ValueError):
        rules.any("h", "q")
