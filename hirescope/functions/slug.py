"""Fields recovered from posting URL slugs and label maps.

Token positions are handled with array higher-order functions over
``split(slug, '-')`` -- one expression per row, inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirescope.functions import rules as R
from hirescope.functions.text import _c, contains_any, py_strip


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def map_label(c, mapping: dict, null_value: str) -> Column:
    """Null -> default; known label -> mapped; else passes through."""
    s = py_strip(_c(c))
    return F.when(_c(c).isNull(), F.lit(null_value)).otherwise(F.coalesce(F.try_element_at(_map(mapping), s), s))


def first_listed(text, items: list[str], pred) -> Column:
    """First item of a fixed, ordered list for which ``pred(text, item)`` holds.

    The row's text enters the lambda as a ``zip_with`` *input*
    (``array_repeat``), so it is evaluated once per row.  Referencing it as an
    outer column inside the lambda would let the optimizer inline its whole
    producer there and re-evaluate it for every list item.
    """
    arr = F.array(*[F.lit(x) for x in items])
    z = F.zip_with(arr, F.array_repeat(text, len(items)), lambda it, t: F.when(pred(t, it), it))
    return F.try_element_at(F.filter(z, lambda x: x.isNotNull()), F.lit(1))


_SA = "-sa($|[^a-z0-9])"     # the country code as a whole slug token


def location_from_url(url) -> Column:
    """struct(city, country) from the slug; listed order decides."""
    u = F.lower(_c(url))
    eg = first_listed(u, R.URL_EGYPT_CITIES, lambda t, c: t.contains(F.concat(F.lit("-"), c, F.lit("-egypt")))
                      | t.contains(F.concat(F.lit("-"), c, F.lit(",-egypt"))))
    eg_name = F.initcap(F.replace(eg, F.lit("-"), F.lit(" ")))
    eg_name = F.coalesce(F.try_element_at(_map(R.URL_CITY_NAME_FIXES), eg_name), eg_name)
    sa = first_listed(u, R.URL_SAUDI_CITIES, lambda t, c: t.contains(F.concat(F.lit("-"), c, F.lit("-saudi")))
                      | F.rlike(t, F.concat(F.lit("-"), c, F.lit(_SA))))
    saudi = u.contains("-saudi-arabia") | u.rlike(_SA)
    ae = first_listed(u, R.URL_UAE_CITIES, lambda t, c: t.contains(F.concat(F.lit("-"), c, F.lit("-uae")))
                      | t.contains(F.concat(F.lit("-"), c, F.lit("-united"))))
    city = (F.when(u.isNull() | (u == ""), "Unknown")
            .when(u.contains("-egypt"), F.coalesce(eg_name, F.lit("Unknown")))
            .when(saudi, F.coalesce(F.initcap(sa), F.lit("Unknown")))
            .when(u.contains("-united-arab-emirates") | u.contains("-uae"), F.coalesce(F.initcap(ae), F.lit("Unknown")))
            .otherwise("Unknown"))
    country = (F.when(u.isNull() | (u == ""), "Unknown").when(u.contains("-egypt"), "Egypt")
               .when(saudi, "Saudi Arabia")
               .when(u.contains("-united-arab-emirates") | u.contains("-uae"), "UAE"))
    for marker, name in R.URL_OTHER_COUNTRIES:
        country = country.when(u.contains(marker), name)
    return F.struct(city.alias("city"), country.otherwise("Unknown").alias("country"))


def with_company_from_url(df, url: str, title: str, out: str = "url_company"):
    """F36 as a DataFrame step: slug tokens after the (first) run of title
    tokens, up to the first location token; none -> Confidential; not a
    posting URL -> Unknown.

    The token arrays are materialized once per row in their own projection
    and every later step consumes them as lambda *inputs* (``zip_with``,
    ``aggregate``) -- never as outer references inside a lambda, which would
    re-evaluate them per element.
    """
    u = F.col(url)
    tslug = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(F.col(title).cast("string"), F.lit("None"))),
                                              "[^a-z0-9]+", "-"), "^-+|-+$", "")
    d = df.withColumns({"_parts": F.split(F.lower(F.element_at(F.split(u, "/"), -1)), "-"),
                        "_tparts": F.split(tslug, "-")})
    d = d.withColumn("_flags", F.zip_with("_parts", F.array_repeat("_tparts", F.size("_parts")),
                                          lambda t, tp: F.array_contains(tp, t)))
    # fold over (flag, position): start moves past each title token of the first run
    z = F.arrays_zip(F.col("_flags").alias("f"), F.sequence(F.lit(1), F.size("_parts")).alias("j"))
    init = F.struct(F.lit(2).alias("start"), F.lit(False).alias("broke"))
    d = d.withColumn("_start", F.aggregate(z, init, lambda acc, e: (
        F.when((e["j"] < 2) | acc["broke"], acc)
         .when(e["f"], F.struct((e["j"] + 1).alias("start"), F.lit(False).alias("broke")))
         .when(acc["start"] > 2, F.struct(acc["start"].alias("start"), F.lit(True).alias("broke")))
         .otherwise(acc)))["start"])
    n = F.size("_parts")
    d = d.withColumn("_rest", F.when(F.col("_start") <= n, F.slice("_parts", F.col("_start"), n - F.col("_start") + 1))
                     .otherwise(F.array().cast("array<string>")))
    locs = F.array(*[F.lit(x) for x in R.URL_LOCATION_TOKENS])
    d = d.withColumn("_pos", F.array_position(F.transform("_rest", lambda t: F.array_contains(locs, t)), F.lit(True)))
    d = d.withColumn("_comp", F.when(F.col("_pos") > 0, F.slice("_rest", 1, F.greatest(F.col("_pos") - 1, F.lit(0))))
                     .otherwise(F.col("_rest")))
    name = F.initcap(F.array_join("_comp", " "))
    for a, b in R.COMPANY_WORD_FIXES:
        name = F.replace(name, F.lit(a), F.lit(b))
    res = (F.when(u.isNull() | (u == "") | ~u.contains("wuzzuf.net"), "Unknown")
           .when(F.size("_comp") == 0, "Confidential").otherwise(name))
    return d.withColumn(out, res).drop("_parts", "_tparts", "_flags", "_start", "_rest", "_pos", "_comp")


def location_hierarchy(city) -> Column:
    """struct(governorate, district) from a district lookup."""
    cur = py_strip(F.initcap(F.coalesce(_c(city).cast("string"), F.lit("None"))))
    gov = F.try_element_at(_map(R.DISTRICT_TO_CITY), cur)
    return F.struct(F.coalesce(gov, cur).alias("governorate"),
                    F.when(gov.isNotNull(), cur).otherwise(F.lit(R.DISTRICT_MAIN)).alias("district"))


def seeded_flag(key, seed: int, probability: float) -> Column:
    """Repeatable pseudo-random flag per key: the same rows at any partitioning,
    and in any engine, since it is read from the MD5 of seed and key."""
    share = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), _c(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return F.coalesce(share < F.lit(int(probability * (1 << 32))), F.lit(False))


def flexible_work_type(work_type, title, company, key, seed: int = 42) -> Column:
    """a remote posting stays remote; of the others a tenth of those with a
    data title turn remote, then three tenths of those with a technical title
    or company turn hybrid; the rest is on site.  It makes labels up, so nothing
    calls it unless asked."""
    t, c = F.lower(F.coalesce(_c(title), F.lit(""))), F.lower(F.coalesce(_c(company), F.lit("")))
    technical = contains_any(t, R.FLEXIBLE_WORDS) | contains_any(c, R.FLEXIBLE_WORDS)
    return (F.when(_c(work_type) == "Remote", "Remote").when(t.contains("data") & seeded_flag(key, seed, 0.10), "Remote")
            .when(technical & seeded_flag(key, seed + 1, 0.30), "Hybrid").otherwise("On-site"))


def is_remote(work_type) -> Column:
    """1 for a remote posting, else 0."""
    return F.when(F.lower(py_strip(_c(work_type))) == "remote", 1).otherwise(0)


def egyptian_governorates(df, column: str = "governorate"):
    """P10: rows of a listed governorate that is none of the listed foreign cities."""
    c = F.col(column)
    return df.where(F.coalesce(c.isin(R.EGYPT_GOVERNORATES) & ~c.isin(R.INTERNATIONAL_CITIES), F.lit(False)))


def governorate_from_url(current, url) -> Column:
    """keep a known governorate; if 'Unknown', take the last slug token
    before ``-egypt`` (title-cased), then apply the fix map."""
    cur = F.coalesce(_c(current).cast("string"), F.lit("Unknown"))
    m = F.regexp_extract(F.lower(F.coalesce(_c(url).cast("string"), F.lit("None"))), R.GOVERNORATE_URL_PATTERN, 1)
    got = F.when(m != "", F.initcap(F.element_at(F.split(m, "-"), -1))).otherwise(cur)
    val = F.when(cur != "Unknown", cur).otherwise(got)
    return F.coalesce(F.try_element_at(_map(R.GOVERNORATE_FIXES), val), val)


def district_from_url(url, current) -> Column:
    """first listed district found in the URL (title-cased), else keep."""
    u = F.lower(F.coalesce(_c(url).cast("string"), F.lit("None")))
    hit = first_listed(u, R.URL_DISTRICTS, lambda t, d: t.contains(d))
    return F.coalesce(F.initcap(F.replace(hit, F.lit("-"), F.lit(" "))), _c(current))


def city_from_district(district, city) -> Column:
    """F39 (second half): a known district forces its city (P14 masked update)."""
    fix = F.try_element_at(_map(R.DISTRICT_CITY_FIXES), _c(district))
    return F.coalesce(fix, _c(city))


def final_city_check(city, url) -> Column:
    """Keep a valid governorate, else the first listed one found in
    the URL, else the drop sentinel."""
    c = py_strip(F.coalesce(_c(city).cast("string"), F.lit("None")))
    u = F.lower(F.coalesce(_c(url).cast("string"), F.lit("None")))
    hit = first_listed(u, R.EGYPT_GOVERNORATES, lambda t, g: t.contains(F.lower(g)))
    return F.when(c.isin(R.EGYPT_GOVERNORATES), c).otherwise(F.coalesce(hit, F.lit(R.CITY_DROP_SENTINEL)))


def with_company_drafts(df, url: str, title: str):
    """The four draft company-from-URL rules (the applied one is F36).

    Adds ``company_v1`` (drop location / job tokens, strip trailing digits),
    ``company_v2`` (after the first job word, before the last location),
    ``company_v3`` (after the first token holding a title word among tokens
    2-6, else tokens 2-4), ``company_final`` and ``company_v4`` (after the
    last job word before the last location).  Token arrays are materialized
    once; positions come from ``array_position`` over flag arrays, and every
    lambda body uses only its parameters and literals.
    """
    def flags(words):
        return F.transform("_lw", lambda t: t.isin(list(words)))

    d = df.withColumn("_p", F.split(F.element_at(F.split(F.col(url), "/"), -1), "-"))
    d = d.withColumns({"_lw": F.transform("_p", lambda t: F.lower(t)), "_n": F.size("_p")})
    d = d.withColumn("_loc", flags(R.URL_DRAFT_LOCATIONS))
    d = d.withColumn("_L", F.when(F.array_contains("_loc", True),
                                  F.col("_n") - F.array_position(F.reverse("_loc"), True) + 1))
    span = F.greatest(F.col("_L") - 2, F.lit(0))          # positions 2 .. L-1

    def first_in(words):                                    # 1-based j or null
        p = F.array_position(F.slice(flags(words), 2, span), True)
        return F.when(p > 0, p + 1)

    def last_in(words):
        p = F.array_position(F.reverse(F.slice(flags(words), 2, span)), True)
        return F.when(p > 0, F.col("_L") - p)

    def between(start_j, end_excl):                         # tokens [start_j, end_excl)
        ln = end_excl - start_j
        return F.when(ln > 0, F.slice("_p", start_j, F.greatest(ln, F.lit(1)))).otherwise(F.array().cast("array<string>"))

    def name(arr, fixes=()):
        out = F.initcap(F.array_join(arr, " "))
        for a, b in fixes:
            out = F.replace(out, F.lit(a), F.lit(b))
        return out

    bad = F.col(url).isNull() | (F.col(url) == "")
    # v1: every token after the id that is neither a location nor a job word
    z = F.arrays_zip(F.col("_p").alias("p"), F.col("_lw").alias("w"), F.col("_loc").alias("l"),
                     F.sequence(F.lit(1), F.greatest(F.col("_n"), F.lit(1))).alias("j"))
    keep = F.transform(F.filter(z, lambda e: (e["j"] >= 2) & ~e["l"] & ~e["w"].isin(R.URL_DRAFT_JOB_WORDS_V1)),
                       lambda e: e["p"])
    v1 = py_strip(F.regexp_replace(name(keep), r"\d+$", ""))
    d = d.withColumn("company_v1", F.when(bad | (v1 == ""), "Unknown").otherwise(v1))
    # v2 / final / v4
    j2 = first_in(R.URL_DRAFT_JOB_WORDS_V2)
    c2 = name(between(F.coalesce(j2 + 1, F.lit(2)), F.col("_L")))
    jf = last_in(R.URL_DRAFT_JOB_WORDS_FINAL)
    cf = name(between(F.coalesce(jf + 1, F.lit(2)), F.col("_L")), R.URL_DRAFT_WORD_FIXES)
    j4 = last_in(R.URL_DRAFT_JOB_WORDS_V4)
    c4 = name(between(F.coalesce(j4 + 1, F.lit(2)), F.col("_L")), R.URL_DRAFT_WORD_FIXES)
    no_loc = bad | F.col("_L").isNull()
    d = d.withColumns({
        "company_v2": F.when(no_loc | (c2 == ""), "Unknown").otherwise(c2),
        "company_final": F.when(no_loc | (cf == ""), "Unknown").otherwise(cf),
        "company_v4": F.when(no_loc | (F.length(c4) <= 1), "Unknown").otherwise(c4)})
    # v3: title words matched as substrings of tokens 2 .. min(L-1, 6)
    tw = F.filter(F.split(F.lower(F.coalesce(F.col(title).cast("string"), F.lit(""))), r"\s+"), lambda w: w != "")
    d = d.withColumn("_tw", tw)
    hit = F.zip_with("_lw", F.array_repeat("_tw", F.col("_n")), lambda t, ws: F.exists(ws, lambda w: t.contains(w)))
    p3 = F.array_position(F.slice(hit, 2, F.greatest(F.least(F.col("_L") - 1, F.lit(6)) - 1, F.lit(0))), True)
    j3 = F.when((F.size("_tw") > 0) & (p3 > 0), p3 + 1)
    first_try = name(between(j3 + 1, F.col("_L")))
    fallback = name(between(F.lit(2), F.least(F.lit(4), F.col("_L") - 1) + 1))
    v3 = F.when(j3.isNotNull() & (first_try != ""), first_try).otherwise(fallback)
    d = d.withColumn("company_v3", F.when(no_loc | (v3 == ""), "Unknown").otherwise(v3))
    return d.drop("_p", "_lw", "_n", "_loc", "_L", "_tw")
