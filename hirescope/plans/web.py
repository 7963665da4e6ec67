"""Page, text and rule-pack queries over ``pages``, ``documents``,
``conversations`` and ``part`` (whole texts, no prefixes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import parse as P
from hirescope.functions import rules as R
from hirescope.functions.ruleset import RuleSet, default_rules, packs
from hirescope.functions.text import collapse_ws, count_contained
from hirescope.operators import html as H
from hirescope.sources.tables import table


def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    return H.page_fields(table(spark, sf, "pages").select("page_id", "url", "html"))


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return H.page_links(table(spark, sf, "pages").select("page_id", "url", "html"))


def page_url_parts(spark: SparkSession, sf: str) -> DataFrame:
    return H.url_parts(table(spark, sf, "pages").select("page_id", "url"), R.NON_EGYPT_URL_PATTERNS)


def doc_text_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Collapsed length, non-blank line count, last line
    length; rows whose cleaned text is <= 2 chars are dropped."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    clean = collapse_ws("text")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    out = d.select("doc_id", F.trim(F.lower("lang")).alias("lang"), F.length(clean).cast("bigint").alias("clean_len"),
                   F.size(lines).cast("bigint").alias("n_lines"),
                   F.length(P.last_line("text", prefix=None)).cast("bigint").alias("last_line_len"))
    return out.filter(F.col("clean_len") > 2)


def conversation_last_lines(spark: SparkSession, sf: str) -> DataFrame:
    """F12 with the ``posted `` prefix rule, per conversation turn."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return c.select("conv_id", "turn", F.trim(F.lower("role")).alias("role"),
                    P.last_line("text").alias("last_line"))


def doc_rule_labels(spark: SparkSession, sf: str) -> DataFrame:
    """F21 / P9 / F14 over whole documents: category, relevance and tech
    vocabulary from the rule table, one pass over each text, counted per
    (lang, category, relevant, tech)."""
    rules = packs(spark, "category", "relevant", "tech")
    d = table(spark, sf, "documents").select("lang", rules.hits("text").alias("hits"))
    lab = d.select("lang", rules.label("hits", "category", R.CATEGORY_DEFAULT).alias("job_category"),
                   rules.any("hits", "relevant").alias("relevant"), rules.any("hits", "tech").alias("tech"))
    return lab.groupBy("lang", "job_category", "relevant", "tech").agg(F.count(F.lit(1)).alias("n"))


def text_rule_labels(spark: SparkSession, sf: str) -> DataFrame:
    """All rule packs over real texts of the tables: part names with their
    types, customer names with their segments, page addresses as words."""
    rules = RuleSet.of(default_rules(spark))
    parts = table(spark, sf, "part").select(F.lit("part").alias("source"), F.concat_ws(" ", "p_name", "p_type").alias("t"))
    customers = table(spark, sf, "customer").select(F.lit("customer").alias("source"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("t"))
    pages = table(spark, sf, "pages").select(F.lit("page").alias("source"), F.regexp_replace("url", "[-_/.?=&]+", " ").alias("t"))
    h = parts.unionByName(customers).unionByName(pages).select("source", rules.hits("t").alias("hits"))
    return h.groupBy("source", rules.label("hits", "category_wide", "none").alias("category"),
                     rules.label("hits", "level", "none").alias("level"), rules.label("hits", "company", "none").alias("company"),
                     rules.any("hits", "tech").alias("tech"), rules.count("hits", "startup").cast("bigint").alias("startup_words")
                     ).agg(F.count(F.lit(1)).alias("n"))


def part_company_types(spark: SparkSession, sf: str) -> DataFrame:
    """F25 over part names: company-type rules incl. the startup score."""
    p = table(spark, sf, "part").select("p_name")
    return (p.select(P.classify_company_type("p_name").alias("company_type"),
                     count_contained(F.lower("p_name"), R.STARTUP_KEYWORDS).alias("startup_score"))
            .groupBy("company_type", "startup_score").agg(F.count(F.lit(1)).alias("n")))


def page_card_fallbacks(spark: SparkSession, sf: str) -> DataFrame:
    """H3/H4/H5/H7/H8 generic fallbacks over whole pages (no card markup in
    this data set, so the fallback paths are what runs)."""
    p = table(spark, sf, "pages").select("page_id", "html")
    clean = H.strip_noise("html")
    c = p.select("page_id", clean.alias("c"))
    return c.select("page_id",
                    H.card_company("c", R.KNOWN_WORK_MODES + R.KNOWN_JOB_TYPES).alias("company"),
                    H.card_location("c").alias("location"),
                    H.card_experience("c").alias("experience"),
                    H.card_posted("c").alias("posted"),
                    F.size(H.card_skills("c")).cast("bigint").alias("n_skill_tags"),
                    H.no_results("c").alias("no_results"))


def _cycled(words: list[str], place) -> F.Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (place % len(words)).cast("int") + 1)


def rule_arms(spark: SparkSession, sf: str) -> DataFrame:
    """Every arm of the title and company rules: titles, companies, years and
    experience texts run through all keywords in turn, one combination an order."""
    k = F.col("o_orderkey")
    titles = [w for _, words in R.CATEGORY_RULES for w in words] + ["florist", "baker"]
    levels = [w for _, words in R.LEVEL_TITLE_RULES for w in words] + [""] * 8
    companies = R.KNOWN_MNCS + R.GOVERNMENT_KEYWORDS + R.STARTUP_KEYWORDS + list(R.COMPANY_OVERRIDES) + R.COMPANY_UNKNOWN_NAMES + ["Grain Mills"]
    r = table(spark, sf, "orders").select(
        F.concat_ws(" ", _cycled(levels, F.floor(k / 7)), _cycled(titles, k)).alias("title"),
        F.concat(_cycled(companies, k), F.when(k % 5 == 1, " Smart Group").when(k % 5 == 2, " of the four rivers").otherwise("")).alias("company"),
        F.when(k % 3 != 0, (F.floor(k / 11) % 10).cast("double")).alias("years"),
        F.when(k % 2 == 0, _cycled(R.LEVEL_RAW_JUNIOR_HINTS, F.floor(k / 2))).otherwise("").alias("raw"))
    return r.groupBy(P.classify_job_category("title").alias("category"), P.classify_experience_level("title", "years", "raw").alias("level"),
                     P.classify_company_type("company").alias("company_type"), P.is_relevant_title("title").alias("relevant")
                     ).agg(F.count(F.lit(1)).alias("n"))
