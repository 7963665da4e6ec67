"""Field parsers: location, work type, experience, level, posted date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirescope.functions import rules as R
from hirescope.functions.text import _c, contains_any, count_contained, nonempty_or_null, py_strip, rule_chain


# ---------------------------------------------------------------- location
def extract_city(location) -> Column:
    """first comma part that is not a country / work-mode token, else Cairo."""
    loc = _c(location)
    parts = F.transform(F.split(loc, ","), lambda p: py_strip(p))
    cities = F.filter(parts, lambda p: ~F.lower(p).isin(R.NON_CITY_PARTS))
    first = F.try_element_at(cities, F.lit(1))
    return (F.when(loc.isNull() | (loc == "") | (loc == "Egypt"), F.lit(R.DEFAULT_CITY))
            .otherwise(F.coalesce(first, F.lit(R.DEFAULT_CITY))))


def extract_work_type(location, job_type) -> Column:
    """Remote > Hybrid > On-site by substring over location + job type."""
    combined = F.lower(F.concat_ws(" ", F.coalesce(_c(location), F.lit("None")),
                                   F.coalesce(_c(job_type), F.lit("None"))))
    return (F.when(combined.contains("remote"), "Remote")
            .when(combined.contains("hybrid"), "Hybrid")
            .otherwise("On-site"))


def split_location(location) -> Column:
    """'a, b, c' -> (first, last); one part -> country Egypt; empty -> Unknown."""
    loc = F.coalesce(py_strip(_c(location)), F.lit(""))
    parts = F.transform(F.split(loc, ","), lambda p: py_strip(p))
    n = F.size(parts)
    city = F.when(loc == "", "Unknown").otherwise(F.element_at(parts, 1))
    country = (F.when(loc == "", "Unknown").when(n == 1, R.DEFAULT_COUNTRY)
               .otherwise(F.element_at(parts, -1)))
    return F.struct(city.alias("city"), country.alias("country"))


def clean_company(name) -> Column:
    """null / blank / 'experienced' / 'confidential' -> Unknown."""
    n = _c(name)
    bad = n.isNull() | F.lower(py_strip(n)).isin("", "experienced", "confidential")
    return F.when(bad, "Unknown").otherwise(py_strip(n))


def peel_location_tail(items) -> Column:
    """drop trailing work-mode / job-type tokens from a location list.

    Returns struct(location array, job_type = the first token peeled off).
    """
    arr = _c(items)
    is_tail = F.transform(arr, lambda x: F.lower(py_strip(x)).isin(R.KNOWN_WORK_MODES + R.KNOWN_JOB_TYPES))
    # index of last element that is NOT a mode/type word (0 when all are)
    idx = F.aggregate(F.arrays_zip(is_tail, F.sequence(F.lit(1), F.greatest(F.size(arr), F.lit(1)))),
                      F.lit(0), lambda acc, z: F.when(~z["0"], z["1"]).otherwise(acc))
    kept = F.when(idx > 0, F.slice(arr, 1, idx)).otherwise(F.array().cast("array<string>"))
    peeled = F.when(F.size(arr) > idx, F.element_at(arr, -1))
    return F.struct(kept.alias("location"), peeled.alias("job_type"))


# -------------------------------------------------------------- experience
_RANGE = r"(\d+)\s*[-to]+\s*(\d+)"
_PLUS = r"(\d+)\+|more than (\d+)"


def parse_experience_years(raw) -> Column:
    """struct(min_experience, max_experience) as doubles.

    ``A - B`` / ``A to B`` -> (A, B); ``A+`` / ``more than A`` -> (A, null).
    """
    s = F.lower(py_strip(F.coalesce(_c(raw), F.lit("None"))))
    has_range = s.rlike(_RANGE)
    has_plus = s.rlike(_PLUS)
    plus_val = F.coalesce(nonempty_or_null(F.regexp_extract(s, _PLUS, 1)),
                          nonempty_or_null(F.regexp_extract(s, _PLUS, 2)))
    mn = (F.when(has_range, F.regexp_extract(s, _RANGE, 1))
          .when(has_plus, plus_val)).try_cast("double")
    mx = F.when(has_range, F.regexp_extract(s, _RANGE, 2)).try_cast("double")
    return F.struct(mn.alias("min_experience"), mx.alias("max_experience"))


def parse_experience_patterns(raw, patterns: list[tuple[str, str]], strip_bullet: bool = True) -> Column:
    """ordered (regex, kind) list, kind in {'range','plus','exact'}.

    Case-sensitive as the originals.  Returns struct(min_experience,
    max_experience, experience_level): a range is banded by F8, an open
    range ('plus') is senior, a single number is banded as (x, x).
    """
    src = F.coalesce(_c(raw), F.lit(""))
    s = py_strip(F.replace(src, F.lit("·"), F.lit("")) if strip_bullet else src)
    mn = mx = lvl = None
    for rx, kind in patterns:
        hit = s.rlike(rx)
        a = F.regexp_extract(s, rx, 1).try_cast("int")
        if kind == "range":
            b = F.regexp_extract(s, rx, 2).try_cast("int")
            lv = categorize_experience(a, b)
        elif kind == "plus":
            b, lv = F.lit(None).cast("int"), F.lit("senior")
        else:
            b, lv = a, categorize_experience(a, a)
        mn = F.when(hit, a) if mn is None else mn.when(hit, a)
        mx = F.when(hit, b) if mx is None else mx.when(hit, b)
        lvl = F.when(hit, lv) if lvl is None else lvl.when(hit, lv)
    return F.struct(mn.alias("min_experience"), mx.alias("max_experience"), lvl.alias("experience_level"))


JSON_EXPERIENCE_PATTERNS = [(r"(\d+)\s*-\s*(\d+)\s*Yrs?", "range"), (r"(\d+)\+\s*Yrs?", "plus"),
                            (r"(\d+)\s*Yrs?", "exact")]
CSV_EXPERIENCE_PATTERNS = [(r"(\d+)\s*To\s*(\d+)\s*Years", "range"), (r"More Than (\d+) Years", "plus"),
                           (r"(\d+)\s*Years", "exact")]


def categorize_experience(mn, mx) -> Column:
    """F8: mean years (max 0/null -> min) <=2 junior, <=5 mid, <=8 senior, else executive."""
    lo, hi = _c(mn).cast("double"), _c(mx).cast("double")
    val = F.when(hi.isNull() | (hi == 0), lo).otherwise((lo + hi) / 2)
    return (F.when(val.isNull(), F.lit(None).cast("string"))
            .when(val <= 2, "junior").when(val <= 5, "mid").when(val <= 8, "senior")
            .otherwise("executive"))


def classify_experience_level(title, min_exp, raw) -> Column:
    """title keywords, then years band, then raw hints, default mid."""
    t = F.lower(F.coalesce(_c(title), F.lit("None")))
    r = F.lower(F.coalesce(_c(raw), F.lit("None")))
    m = _c(min_exp)
    expr = None
    for label, kws in R.LEVEL_TITLE_RULES:
        cond = contains_any(t, kws)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    for bound, label in R.LEVEL_YEAR_BANDS:
        expr = expr.when(m <= bound, label)
    expr = expr.when(m.isNotNull() & ~F.isnan(m), R.LEVEL_YEAR_TOP)
    expr = expr.when(contains_any(r, R.LEVEL_RAW_JUNIOR_HINTS), "junior")
    return expr.otherwise(R.LEVEL_DEFAULT)


# ------------------------------------------------------------ posted date
def last_line(c, prefix: str | None = "posted ") -> Column:
    """last non-blank line of multi-line text; the prefix is added unless
    its word stands anywhere in the line."""
    col = _c(c)
    lines = F.filter(F.transform(F.split(col, "\n"), lambda x: py_strip(x)), lambda x: x != "")
    last = F.try_element_at(lines, F.lit(-1))
    if prefix:
        last = F.when(F.lower(last).contains(prefix.strip()), last).otherwise(F.concat(F.lit(prefix), last))
    return F.when(col.contains("\n"), last).otherwise(col)


def relative_posted_date(raw, scrape_date, fallback="scrape") -> Column:
    """F12, then F10/F11: of multi-line text the last line; hours -> 0, days,
    weeks*7, months*30 days before the scrape date; else yyyy-M-d, d/M/yyyy,
    M/d/yyyy; else the scrape date (or null)."""
    s = F.lower(py_strip(F.coalesce(last_line(raw, None), F.lit("None"))))
    sd = _c(scrape_date)

    def num(unit):
        return F.regexp_extract(s, r"(\d+)\s+" + unit, 1).try_cast("int")

    out = (F.when(s.rlike(r"(\d+)\s+hour"), sd)
           .when(s.rlike(r"(\d+)\s+day"), F.date_sub(sd, num("day")))
           .when(s.rlike(r"(\d+)\s+week"), F.date_sub(sd, num("week") * 7))
           .when(s.rlike(r"(\d+)\s+month"), F.date_sub(sd, num("month") * 30)))
    absolute = F.coalesce(F.try_to_date(s, "yyyy-M-d"), F.try_to_date(s, "d/M/yyyy"),
                          F.try_to_date(s, "M/d/yyyy"))
    dflt = sd if fallback == "scrape" else F.lit(None).cast("date")
    return out.otherwise(F.coalesce(absolute, dflt))


def iso_to_date(c) -> Column:
    """ISO-8601 text with zone -> the calendar date *as written* (its
    own offset, like ``fromisoformat(...).date()``), independent of the
    session time zone; invalid / blank -> null."""
    col = _c(c)
    return F.when(F.try_to_timestamp(col).isNotNull(), F.try_to_date(F.substring(col, 1, 10), "yyyy-MM-dd"))


# ------------------------------------------------------------- work type
REMOTE_WORDS = ["remote", "work from home", "wfh"]
REMOTE_WORDS_EVERYWHERE = REMOTE_WORDS + ["telecommute"]


def work_type_from_text(*cols, remote_words=REMOTE_WORDS) -> Column:
    """Remote (synonyms) > Hybrid > On-site over concatenated columns."""
    text = F.lower(F.concat_ws(" ", *[_c(c).cast("string") for c in cols]))
    return (F.when(contains_any(text, remote_words), "Remote")
            .when(text.contains("hybrid"), "Hybrid").otherwise("On-site"))


def demand_bucket(score) -> Column:
    """>= 30 High, >= 10 Medium, else Niche."""
    s = _c(score)
    expr = None
    for bound, label in R.DEMAND_BUCKETS:
        expr = F.when(s >= bound, label) if expr is None else expr.when(s >= bound, label)
    return expr.otherwise(R.DEMAND_DEFAULT)


def classify_job_category(title) -> Column:
    """ordered keyword groups over the lower-cased title, default other."""
    return rule_chain(F.lower(F.coalesce(_c(title), F.lit("None"))), R.CATEGORY_RULES, R.CATEGORY_DEFAULT)


def classify_company_type(name) -> Column:
    """Unknown -> overrides -> MNC -> Government -> startup score -> Corporate."""
    n = _c(name)
    low = F.lower(n)
    unknown = n.isNull() | F.lower(py_strip(n)).isin(R.COMPANY_UNKNOWN_NAMES)
    override = F.try_element_at(
        F.create_map(*[F.lit(x) for kv in R.COMPANY_OVERRIDES.items() for x in kv]), n)
    score = count_contained(low, R.STARTUP_KEYWORDS)
    words = F.size(F.filter(F.split(py_strip(n), r"\s+"), lambda w: w != ""))
    return (F.when(unknown, "Unknown")
            .when(override.isNotNull(), override)
            .when(contains_any(low, R.KNOWN_MNCS), "MNC")
            .when(contains_any(low, R.GOVERNMENT_KEYWORDS), "Government")
            .when(score >= 2, "Startup")
            .when((score == 1) & (words <= 3), "Startup")
            .otherwise("Corporate"))


def is_relevant_title(title) -> Column:
    """Crawled title contains any relevance keyword."""
    return contains_any(F.lower(_c(title)), R.TECH_TITLE_KEYWORDS)


def egypt_only(url, city) -> Column:
    """Keep rows whose URL has no foreign marker and whose city is not foreign."""
    u = F.lower(F.coalesce(_c(url).cast("string"), F.lit("None")))
    c = F.lower(F.coalesce(_c(city).cast("string"), F.lit("None")))
    return ~contains_any(u, R.NON_EGYPT_URL_PATTERNS) & ~c.isin(R.NON_EGYPT_CITIES)


def classify_category_wide(title) -> Column:
    """wider keyword groups; the title itself when nothing matches."""
    t = _c(title).cast("string")
    return rule_chain(F.lower(F.coalesce(t, F.lit("None"))), R.CATEGORY_RULES_WIDE, F.coalesce(t, F.lit("None")))


def collapse_category(cat) -> Column:
    """anything outside the standard list -> other."""
    return F.when(_c(cat).isin(R.STANDARD_CATEGORIES), _c(cat)).otherwise(F.lit(R.CATEGORY_DEFAULT))


def reclassify_other(cat, title) -> Column:
    """F24 + P14: second rule pass applied only where the category is 'other'."""
    t = F.lower(F.coalesce(_c(title).cast("string"), F.lit("None")))
    return F.when(_c(cat) == R.CATEGORY_DEFAULT,
                  rule_chain(t, R.RECLASSIFY_OTHER_RULES, R.CATEGORY_DEFAULT)).otherwise(_c(cat))
