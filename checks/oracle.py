"""SQL twins of the registered queries, for DuckDB.

Written for themselves: each recogniser is spelled here as one test per
keyword or label over the whole text, in the RE2 dialect, and shares only the
vocabularies and the fixture's texts with the Spark side.
"""

from __future__ import annotations

import re

from checks import fixture as fx
from jobmart.functions import vocab

# -- text of SQL expressions ------------------------------------------------------


def _lit(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(values: list[str | None], index: str = "doc_id") -> str:
    return f"[{', '.join(map(_lit, values))}][1 + ({index}) % {len(values)}]"


# What may stand between the words of a phrase, and around a whole one.
_SEP = r"[\s._/+:-]*"
_BEFORE, _AFTER = "(^|[^[:alnum:]_])", "([^[:alnum:]_]|$)"


def _words(phrases: list[str]) -> str:
    return "|".join(p.replace(" ", _SEP) for p in phrases)


def _has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {_lit(_BEFORE + '(' + pattern + ')' + _AFTER)})"


def _keyword_test(word: str, text: str, compact: str) -> str:
    short = re.sub("[^A-Za-z0-9#+]", "", word)
    test = _has(text, word)
    return f"({test} OR contains({compact}, {_lit(short)}))" if len(short) > 4 else test


def _compact(text: str) -> str:
    return f"regexp_replace({text}, '[^a-z0-9#+]', '', 'g')"


def _labels(text: str, phrases: dict[str, list[str]]) -> str:
    arms = " ".join(f"WHEN {_has(text, _words(p))} THEN {_lit(label)}" for label, p in phrases.items())
    return f"(CASE {arms} END)"


def _unknown(text: str) -> str:
    return f"(coalesce(lower(trim({text})), '') IN ({', '.join(map(_lit, vocab.UNKNOWN_LIKE))}))"


def _field_label(raw: str, phrases: dict[str, list[str]], default: str) -> str:
    own = f"CASE WHEN NOT {_unknown(raw)} THEN {_labels(f'lower({raw})', phrases)} END"
    return f"coalesce({own}, {_labels('t', phrases)}, {default})"


def _experience() -> str:
    years, experience = "|".join(vocab.YEAR_WORDS), _words(vocab.EXPERIENCE_WORDS)
    context = f"((({years}){_SEP}(of{_SEP})?)?({experience}))"

    def between(low: int, high: int) -> str:
        return f"{low}{_SEP}(-|~|to|den|đến){_SEP}{high}{_SEP}{context}"

    def number(n: str) -> str:
        plus = rf"{_SEP}(\+|plus)?"
        return f"({n}){plus}{_SEP}{context}|{context}{_SEP}({n}){plus}"

    arms = [
        (between(0, 1), "Entry"), (between(1, 2), "Junior"), (between(2, 4), "Mid-Level"),
        (number("4|5|6|7|8|9|[1-9][0-9]"), "Senior"), (number("2|3"), "Mid-Level"), (number("1"), "Junior"),
        (number("0"), "Entry"),
    ]
    return "(CASE " + " ".join(f"WHEN {_has('t', p)} THEN {_lit(v)}" for p, v in arms) + " ELSE 'Unknown' END)"


def _salary_pattern() -> str:
    amount, sign = "[0-9]+([.,][0-9]+)?", "[$€£]"
    unit = "(" + "|".join(vocab.SALARY_UNITS) + ")"
    until = f"{_SEP}({'|'.join(vocab.SALARY_RANGE_WORDS)}){_SEP}({sign}{_SEP})?{amount}"
    tail = f"({_SEP}{unit})?"
    return "(" + "|".join([
        f"({_words(vocab.SALARY_PREFIXES)}){_SEP}({sign}{_SEP})?{amount}({until})?{tail}",
        f"{sign}{_SEP}{amount}({until})?{tail}",
        f"{amount}{_SEP}{unit}({until}{_SEP}{unit}?)?",
        f"{amount}{until}{tail}",
        _words(vocab.SALARY_WORDS),
    ]) + ")"


_DESCRIBED_SALARY = f"coalesce(nullif(regexp_extract(t, {_lit(_salary_pattern())}), ''), 'Unknown')"
_SALARY = f"CASE WHEN {_unknown('salary')} THEN {_DESCRIBED_SALARY} ELSE trim(salary) END"
_ROLE = (
    "(CASE "
    + " ".join(
        f"WHEN {_keyword_test(alias, 'tt', 'tc')} THEN {_lit(role)}"
        for role, aliases in vocab.ROLE_ALIASES.items() for alias in aliases
    )
    + " ELSE 'Unknown' END)"
)
_TECHS = (
    "list_filter(["
    + ", ".join(f"CASE WHEN {_keyword_test(w, 't', 'c')} THEN {_lit(w)} END" for w in vocab.TECH_KEYWORDS)
    + "], lambda w: w IS NOT NULL)"
)
_EMPLOYMENT = _field_label("working_type", vocab.EMPLOYMENT_PHRASES, "'FULL_TIME'")
_LOCATION = _field_label("location_working_type", vocab.LOCATION_PHRASES, "'ON_SITE'")
_LEVEL = _field_label("level", vocab.SENIORITY_PHRASES, _experience())
_SLUG = (
    "coalesce(nullif(regexp_replace(regexp_replace(lower(trim(company)), '[^a-z0-9]+', '-', 'g'), "
    "'^-|-$', '', 'g'), ''), 'unknown')"
)
_APPLICANTS = "coalesce(try_cast(number_applicants AS INTEGER), 0)"
_MOMENT = f"TIMESTAMP '{fx.PROCESSED_AT}'"
_DAY_MOMENT = f"({_MOMENT} + to_days(CAST(doc_id % 90 AS INTEGER)))"


def _posted(moment: str) -> str:
    raw, text = "nullif(trim(date_posted), '')", "lower(trim(date_posted))"
    formats = ", ".join(
        f"CAST(try_strptime({raw}, '{f}') AS DATE)" for f in ("%d-%m-%Y", "%d/%m/%Y", "%Y-%m-%d", "%Y/%m/%d")
    )
    arms = []
    for words, interval in (
        (vocab.MINUTE_WORDS, "1 minute"), (vocab.HOUR_WORDS, "1 hour"), (vocab.DAY_WORDS, "1 day"),
        (vocab.WEEK_WORDS, "7 days"),
    ):
        pattern = _lit(f"([0-9]+){_SEP}({_words(words)}){_SEP}({_words(vocab.AGO_WORDS)})")
        amount = f"try_cast(regexp_extract({text}, {pattern}, 1) AS INTEGER)"
        arms.append(f"WHEN regexp_matches({text}, {pattern}) THEN {moment} - {amount} * INTERVAL '{interval}'")
    arms.append(f"WHEN {_has(text, _words(vocab.YESTERDAY_PHRASES))} THEN {moment} - INTERVAL '1 day'")
    relative = f"CASE {' '.join(arms)} ELSE {moment} END"
    return f"strftime(coalesce(try_cast({raw} AS DATE), {formats}, CAST({relative} AS DATE)), '%d-%m-%Y')"


# -- common table expressions -------------------------------------------------------

RAW_JOBS = f"""
raw AS (
  SELECT doc_id,
    {_pick(fx.TITLES)} AS title,
    CASE WHEN doc_id % 17 < 5 THEN {_pick(fx.COMPANY_TEXTS, 'doc_id % 17')} ELSE c_name END AS company,
    CASE WHEN doc_id % 23 <> 0 THEN source END AS source_name,
    CASE WHEN doc_id % 19 <> 0 THEN n_name END AS company_location,
    {_pick(fx.LOCATION_TEXTS)} AS location_working_type,
    {_pick(fx.WORKING_TYPES)} AS working_type,
    {_pick(fx.POSTED)} AS date_posted,
    text || ' ' || {_pick(fx.PHRASES)} AS description,
    CASE WHEN doc_id % 50 <> 7
      THEN 'https://jobs.example/' || (CASE WHEN doc_id % 10 = 3 THEN doc_id - 1 ELSE doc_id END) END AS job_url,
    {_pick(fx.SALARIES)} AS salary,
    {_pick(fx.LEVELS)} AS level,
    {_pick(fx.APPLICANTS)} AS number_applicants
  FROM documents
  LEFT JOIN customer ON c_custkey = doc_id * doc_id % (SELECT count(*) FROM customer)
  LEFT JOIN nation ON n_nationkey = c_nationkey
),
prepared AS (
  SELECT *, lower(coalesce(description, '')) AS t, {_compact("lower(coalesce(description, ''))")} AS c,
    lower(coalesce(title, '')) AS tt, {_compact("lower(coalesce(title, ''))")} AS tc
  FROM raw
)"""


def _jobs(moment: str) -> str:
    return f"""
clean AS (
  SELECT doc_id, coalesce(title, 'Unknown') AS title, md5({_SLUG}) AS company_id,
    coalesce(source_name, 'Unknown') AS source_name, {_LOCATION} AS location_type,
    {_EMPLOYMENT} AS employment_type, {_posted(moment)} AS date_posted, {_TECHS} AS techstacks,
    coalesce(job_url, 'Unknown') AS job_url, {_SALARY} AS salary, {_LEVEL} AS level, {_ROLE} AS role,
    {_APPLICANTS} AS number_applicants, {moment} AS processed_at
  FROM prepared
),
jobs AS (SELECT DISTINCT ON (job_url) * FROM clean ORDER BY job_url, doc_id)"""


COMPANIES = f"""
all_companies AS (
  SELECT DISTINCT md5({_SLUG}) AS id, coalesce(company, 'Unknown') AS name, 'Unknown' AS industry,
    'Unknown' AS company_size, coalesce(company_location, 'Unknown') AS location, 'scraper' AS source_name
  FROM raw
),
companies AS (SELECT DISTINCT ON (id) * FROM all_companies ORDER BY id, name, location)"""

FACT = """
fact AS (
  SELECT md5(job_url) AS id, company_id, md5(source_name) AS source_id,
    CASE location_type WHEN 'REMOTE' THEN 'LOC_REMOTE' WHEN 'HYBRID' THEN 'LOC_HYBRID' ELSE 'LOC_NA' END
      AS location_id,
    strftime(processed_at, '%Y%m%d') AS date_id, md5(role) AS role_id, md5(level) AS level_id,
    md5(location_type) AS working_model, 0 AS salary_min_vnd, 0 AS salary_max_vnd,
    number_applicants AS number_of_applicants, 'ACTIVE' AS job_status
  FROM jobs
),
mention AS (SELECT job_url, CAST(processed_at AS DATE) AS day, unnest(techstacks) AS tech FROM jobs),
bridge AS (SELECT md5(tech) AS techstack_id, md5(job_url) AS fact_id FROM mention),
calendar AS (
  SELECT CAST(d AS DATE) AS full_date, strftime(d, '%Y%m%d') AS id
  FROM generate_series(DATE '2026-04-21', DATE '2026-04-21' + 364, INTERVAL 1 DAY) AS g(d)
)"""

_CATEGORY = (
    "CASE "
    + " ".join(f"WHEN tech IN ({', '.join(map(_lit, w))}) THEN {_lit(n)}" for n, w in vocab.TECH_CATEGORIES.items())
    + " ELSE 'Other' END"
)


def _raw(select: str) -> str:
    return f"WITH {RAW_JOBS} {select}"


def _with_companies(select: str) -> str:
    return f"WITH {RAW_JOBS}, {COMPANIES} {select}"


def _with_jobs(select: str, moment: str = _MOMENT) -> str:
    return f"WITH {RAW_JOBS}, {_jobs(moment)}, {FACT} {select}"


def _with_star(select: str) -> str:
    return f"WITH {RAW_JOBS}, {COMPANIES}, {_jobs(_DAY_MOMENT)}, {FACT} {select}"


def _members(column: str, name: str, unknown: str = "Unknown") -> str:
    return _with_jobs(
        f"SELECT md5({column}) AS id, {column} AS {name} FROM jobs WHERE {column} NOT IN ('', {_lit(unknown)}) "
        f"GROUP BY {column} UNION ALL SELECT md5({_lit(unknown)}), {_lit(unknown)}"
    )


def _unescaped(markup: str) -> str:
    for entity, char in (("&quot;?", '"'), ("&#x27;", "'"), ("&lt;?", "<"), ("&gt;?", ">"), ("&amp;?", "&")):
        markup = f"regexp_replace({markup}, {_lit(entity)}, {_lit(char)}, 'g')"
    return markup


_ITEM = r"""regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')"""
_LINKS = f"""
item AS (
  SELECT page_id, url, CAST(generate_subscripts({_ITEM}, 1) - 1 AS INTEGER) AS item_no, unnest({_ITEM}) AS item_html FROM pages
),
link AS (
  SELECT page_id, url, item_no, item_html,
    {_unescaped("""regexp_extract(item_html, 'href="([^"]*)"', 1)""")} AS href,
    trim({_unescaped("regexp_extract(item_html, '>([^<]*)</a>', 1)")}) AS words
  FROM item
)"""


def _share(name: str, source: str) -> str:
    return _with_star(
        f"SELECT {name[0]} AS {name[1]}, count(*) AS total_jobs, "
        f"round(count(*) * 100.0 / (SELECT count(*) FROM fact), 4) AS percentage FROM {source} GROUP BY {name[0]}"
    )


_CHECK = "SELECT '{0}' AS check_name, '{1}' AS column_name, n = 0 AS passed, n AS violations FROM ({2})"


def _report(rows: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(_CHECK.format(name, column, sql) for name, column, sql in rows)


_JOB_COLUMNS = (
    "title, company_id, source_name, location_type, employment_type, date_posted, "
    "array_to_string(techstacks, ',') AS techstacks, job_url, salary, level, role, number_applicants, "
    "strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at"
)
_RAW_COLUMNS = (
    "title, company, source_name, company_location, location_working_type, working_type, date_posted, "
    "description, job_url, salary, level, number_applicants"
)
_COMPANY_COLUMNS = "id, name, industry, company_size, location, source_name"
_CONFIG = """
config AS (
  SELECT s_name AS source_name, CASE WHEN s_nationkey < 3 THEN '' ELSE 'h' || s_nationkey || '@text()' END AS title,
    CASE WHEN s_nationkey <> 9 THEN 'a@href' END AS job_url,
    CASE WHEN s_nationkey = 7 THEN '' ELSE 'https://jobs.example/' END AS prefix_job_url,
    CASE WHEN s_nationkey > 12 THEN '.company' END AS company
  FROM supplier
)"""



def _checksum(columns: str) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '(null)')" for c in columns.split(", "))
    return f"CAST(sum(CAST('0x' || md5(concat_ws('|', {text}))[1:8] AS BIGINT)) AS BIGINT) AS checksum"


# Star tables with their columns in alphabetical order.
_STAR = {
    "dim_company": "SELECT '0' AS company_size, id, industry, location, name FROM companies "
    "UNION ALL SELECT '0', 'Unknown', 'Unknown', 'Unknown', 'Unknown'",
    "dim_location": "SELECT 'N/A' AS city, country, 'N/A' AS district, id FROM (VALUES ('LOC_REMOTE', 'Remote'), "
    "('LOC_ONSITE', 'Vietnam'), ('LOC_HYBRID', 'Vietnam'), ('LOC_NA', 'N/A')) AS l(id, country)",
    "dim_date": "SELECT dayname(full_date) AS day_of_week, strftime(full_date, '%Y-%m-%d') AS full_date, id, "
    "month(full_date) AS month, quarter(full_date) AS quarter, year(full_date) AS year FROM calendar",
    **{
        t: f"SELECT md5({c}) AS id, {c} AS {n} FROM jobs WHERE {c} NOT IN ('', '{u}') GROUP BY {c} "
        f"UNION ALL SELECT md5('{u}'), '{u}'"
        for t, c, n, u in (
            ("dim_source", "source_name", "source_name", "Unknown"), ("dim_working_model", "location_type", "name", "N/A"),
        )
    },
    "dim_role": "SELECT md5(role) AS id, role AS role_name FROM jobs WHERE role NOT IN ('', 'Unknown') GROUP BY role "
    "UNION ALL SELECT md5('Unknown'), 'Unknown'",
    "dim_level": "SELECT md5(level) AS id, level AS level_name FROM jobs WHERE level NOT IN ('', 'Unknown') "
    "GROUP BY level UNION ALL SELECT md5('Unknown'), 'Unknown'",
    "dim_techstack": f"SELECT {_CATEGORY} AS category, md5(tech) AS id, tech AS tech_name FROM mention GROUP BY tech "
    "UNION ALL SELECT 'Other', md5('Unknown'), 'Unknown'",
    "fact_hiring": "SELECT company_id, date_id, id, job_status, level_id, location_id, number_of_applicants, role_id, "
    "salary_max_vnd, salary_min_vnd, source_id, working_model FROM fact",
    "bridge_tech_fact": "SELECT fact_id, techstack_id FROM bridge",
}
_STAR_COLUMNS = {
    "dim_company": "company_size, id, industry, location, name", "dim_location": "city, country, district, id",
    "dim_date": "day_of_week, full_date, id, month, quarter, year", "dim_source": "id, source_name",
    "dim_role": "id, role_name", "dim_level": "id, level_name", "dim_working_model": "id, name",
    "dim_techstack": "category, id, tech_name", "bridge_tech_fact": "fact_id, techstack_id",
    "fact_hiring": "company_id, date_id, id, job_status, level_id, location_id, number_of_applicants, role_id, "
    "salary_max_vnd, salary_min_vnd, source_id, working_model",
}

_JOB_GROUP = "CAST(processed_at AS DATE), company_id, title, location_type, employment_type, level"


def oracle_sql() -> dict[str, str]:
    return {
        # tables and files
        "read_raw_jobs": _raw(f"SELECT {_RAW_COLUMNS} FROM raw"),
        "read_written_forms": (
            "SELECT CAST(o_orderkey AS VARCHAR) AS job_url, "
            "CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(20,4)) AS VARCHAR) AS title, "
            "CAST(NULL AS VARCHAR) AS company, "
            "CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS VARCHAR) AS salary, "
            "'{\"key\":[' || o_custkey || ',\"a b\"]}' AS level, "
            "CAST(CAST(o_orderkey AS DOUBLE) * 1000 AS VARCHAR) AS number_applicants FROM orders"
        ),
        "write_raw_jobs": _raw(
            f"SELECT '{_RAW_COLUMNS.replace(', ', ',')}' AS fields, count(*) AS lines, {_checksum(_RAW_COLUMNS)} FROM raw"
        ),
        "publish_partition": _raw(
            "SELECT source_name, count(*) AS rows, CAST(sum(length(description)) AS BIGINT) AS characters "
            "FROM raw GROUP BY source_name"
        ),
        "read_table": _with_companies(f"SELECT {_COMPANY_COLUMNS} FROM companies"),
        "overwrite_table": _with_companies(f"SELECT {_COMPANY_COLUMNS} FROM companies WHERE location <> 'Unknown'"),
        "append_table": _with_companies("SELECT location, 2 * count(*) AS rows FROM companies GROUP BY location"),
        "upsert": _with_jobs(
            "SELECT job_url, location_type, number_applicants + (location_type = 'REMOTE')::INTEGER "
            "AS number_applicants FROM jobs UNION ALL "
            "SELECT job_url || '/repost', location_type, number_applicants FROM jobs WHERE location_type = 'HYBRID'"
        ),
        "table_catalog": _with_companies(
            "SELECT 'companies' AS table_name, count(*) - count(*) AS rows FROM companies "
            "UNION ALL SELECT 'ids', count(*) FROM companies"
        ),
        "clear_staging": "SELECT 'raw files' AS table_name, (count(*) * 0)::BIGINT AS rows, 12 AS columns FROM documents "
        + "".join(
            f"UNION ALL SELECT 'staging.{t}', 0, {n} "
            for t, n in [("silver_jobs", 13), ("silver_companies", 6)]
            + [(f"gold_{t}", len(c.split(", "))) for t, c in _STAR_COLUMNS.items()]
        ),
        "upsert_table": _with_star(
            "SELECT job_url, location_type, number_applicants + (location_type = 'REMOTE')::INTEGER "
            "AS number_applicants FROM jobs UNION ALL "
            "SELECT job_url || '/repost', location_type, number_applicants FROM jobs WHERE location_type = 'HYBRID'"
        ),
        "daily_run": f"""
            WITH {RAW_JOBS},
            first AS (SELECT *, coalesce(job_url, 'Unknown') AS kept FROM prepared),
            changed AS (SELECT DISTINCT kept FROM first WHERE doc_id % 3 = 0),
            known AS (
              SELECT kept FROM first UNION SELECT coalesce(job_url || '/new', 'Unknown') FROM first WHERE doc_id % 7 = 0
            )
            SELECT 'job' AS kind, kept AS name,
              CASE WHEN kept <> 'Unknown' THEN CAST(kept IN (SELECT kept FROM changed) AS BIGINT) END AS value FROM known
            UNION ALL SELECT 'table', 'dim_company', count(DISTINCT {_SLUG}) + 1 FROM first
            UNION ALL SELECT 'table', 'dim_date', 365
            UNION ALL SELECT 'table', 'dim_location', 4
            UNION ALL SELECT 'table', 'fact_hiring',
              (SELECT count(DISTINCT kept) FROM first) + (SELECT count(*) FROM known)""",
        "promotion_gate": _with_star(
            "SELECT 'fact_hiring.company_id without dim_company' AS finding, count(*) AS rows FROM fact "
            "WHERE location_id = 'LOC_REMOTE' "
            "UNION ALL SELECT 'fact_hiring.id is null', count(*) FROM fact WHERE location_id = 'LOC_HYBRID' "
            "UNION ALL SELECT 'facts in gold', count(*) FROM fact"
        ),
        # pages
        "crawl_frontier": f"""
            WITH role AS (SELECT unnest([{', '.join(map(_lit, vocab.CRAWL_ROLE_SLUGS))}]) AS slug),
            source AS (
              SELECT s_name, s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_nationkey - 20 END AS end_page FROM supplier
            )
            SELECT s_name AS source_name, replace(slug, '-', ' ') AS role, page,
              'https://s' || s_suppkey || '.example/jobs/' || slug || '?q=' || replace(slug, '-', '+') || '&page='
                || page AS url
            FROM source, role, (SELECT unnest([1, 2, 3, 4]) AS page) AS p
            WHERE page <= greatest(1, coalesce(end_page, 1))""",
        "explode_listing_items": f"WITH {_LINKS} SELECT page_id, item_no, item_html FROM item",
        "extract_fields": f"""
            WITH {_LINKS} SELECT page_id, item_no, nullif(words, '') AS title, nullif(href, '') AS job_url,
              nullif(words, '') AS company,
              CASE WHEN href LIKE '/%' THEN nullif(words, '') END AS level, CAST(NULL AS VARCHAR) AS salary,
              CAST(NULL AS VARCHAR) AS role FROM link""",
        "resolve_urls": f"""
            WITH {_LINKS},
            base AS (
              SELECT *, regexp_extract(url, '^([a-z]+:)', 1) AS scheme,
                regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin,
                regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path
              FROM link
            ),
            form AS (
              SELECT page_id, item_no, 'rooted' AS form, href AS link, origin || href AS resolved FROM base
              UNION ALL SELECT page_id, item_no, 'relative', href[2:],
                origin || coalesce(nullif(regexp_extract(path, '^.*/'), ''), '/') || href[2:] FROM base
              UNION ALL SELECT page_id, item_no, 'scheme', '//cdn.example' || href,
                scheme || '//cdn.example' || href FROM base
              UNION ALL SELECT page_id, item_no, 'query', '?q=' || href[2:], origin || path || '?q=' || href[2:]
                FROM base
              UNION ALL SELECT page_id, item_no, 'absolute', 'https://abs.example' || href,
                'https://abs.example' || href FROM base
              UNION ALL SELECT page_id, item_no, 'empty', '(null)', '(null)' FROM base
              UNION ALL SELECT page_id, item_no, 'up', '../x/./' || href[2:],
                origin || coalesce(nullif(regexp_replace(regexp_extract(path, '^.*/'), '[^/]*/$', ''), ''), '/') || 'x/'
                || href[2:] FROM base
              UNION ALL SELECT page_id, item_no, 'dots', '/a/b/../.' || href, origin || '/a' || href FROM base
              UNION ALL SELECT page_id, item_no, 'blank', ' ' || chr(9) || href, origin || href FROM base
              UNION ALL SELECT page_id, item_no, 'empty segments', '/a//b/' || href, origin || '/a//b/' || href FROM base
            )
            SELECT page_id, item_no, form, resolved, link AS unresolved FROM form""",
        "extract_postings": f"""
            WITH {_LINKS},
            page AS (
              SELECT page_id, html, regexp_extract(url, '^https?://[^/?#]*\\.([a-z]+)', 1) AS source,
                regexp_extract(html, '<li><a href="(/[^"&]+)">', 1) AS first_link,
                trim({_unescaped("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}) AS heading
              FROM pages
            ),
            detail AS (SELECT source, first_link, arg_min(heading, page_id) AS heading FROM page WHERE first_link <> '' GROUP BY ALL)
            SELECT l.page_id, item_no, p.source AS source_name, coalesce(nullif(words, ''), '(null)') AS title,
              coalesce(nullif(words, ''), '(null)') AS company,
              coalesce('https://jobs.' || p.source || nullif(href, ''), '(null)') AS job_url,
              CASE WHEN href LIKE '/%' AND words <> '' THEN words ELSE '(null)' END AS level, '(null)' AS salary,
              coalesce(d.heading, '(null)') AS description
            FROM link l JOIN page p ON p.page_id = l.page_id
            LEFT JOIN detail d ON d.source = p.source AND d.first_link = href
            WHERE p.source <> 'org'""",
        "join_details": f"""
            WITH {_LINKS},
            heading AS (
              SELECT page_id, trim({_unescaped("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}) AS words FROM pages
            )
            SELECT page_id, item_no, CASE WHEN contains(item_html, ',') THEN '(null)' ELSE words END AS description
            FROM item JOIN heading USING (page_id)""",
        "sources_missing_config": f"""
            WITH {_CONFIG} SELECT s_name AS source_name FROM supplier WHERE s_acctbal < 0 OR s_name NOT IN (
              SELECT source_name FROM config WHERE title <> '' AND job_url <> '' AND prefix_job_url <> '')""",
        "load_source_config": f"""
            WITH {_CONFIG} SELECT source_name, title, coalesce(job_url, '(null)') AS job_url, prefix_job_url,
              coalesce(company, '(null)') AS company, '(null)' AS salary FROM config""",
        # text
        "keyword_match_all": _raw(f"SELECT doc_id, array_to_string({_TECHS}, ',') AS keywords FROM prepared"),
        "keyword_match_separators": "SELECT doc_id, array_to_string(list_filter(["
        + ", ".join(
            f"CASE WHEN regexp_matches(lower(text), '(^|[^A-Za-z0-9_]){word.replace(' ', '[ \\t\\n\\x0B\\f\\r]+')}([^A-Za-z0-9_]|$)') "
            f"THEN {_lit(word)} END" for word in fx.SHORT_PAIRS
        )
        + "], lambda x: x IS NOT NULL), ',') AS keywords FROM documents WHERE text IS NOT NULL",
        "keyword_match_first": _raw(f"SELECT doc_id, coalesce({_TECHS}[1], 'Unknown') AS keyword FROM prepared"),
        "canonical_role": _raw(f"SELECT doc_id, {_ROLE} AS role FROM prepared"),
        "employment_type": _raw(f"SELECT doc_id, {_EMPLOYMENT} AS employment_type FROM prepared"),
        "location_type": _raw(f"SELECT doc_id, {_LOCATION} AS location_type FROM prepared"),
        "seniority_level": _raw(f"SELECT doc_id, {_LEVEL} AS level FROM prepared"),
        "experience_level": _raw(f"SELECT doc_id, {_experience()} AS level FROM prepared"),
        "salary_phrase": _raw(f"SELECT doc_id, {_SALARY} AS salary, {_DESCRIBED_SALARY} AS described FROM prepared"),
        "posted_date": _raw(f"SELECT doc_id, {_posted(_MOMENT)} AS date_posted FROM raw"),
        "fallback_unknown_like": _raw(
            f"SELECT doc_id, CASE WHEN {_unknown('salary')} THEN 'fallback' ELSE trim(salary) END AS text_or, "
            f"CASE WHEN {_unknown('salary')} THEN 'fallback' ELSE salary END AS value_or, "
            f"CASE WHEN {_unknown('level')} THEN 'fallback' "
            f"ELSE coalesce({_labels('lower(level)', vocab.SENIORITY_PHRASES)}, 'fallback') END AS label_or FROM raw"
        ),
        "slug_md5_key": _raw(f"SELECT doc_id, {_SLUG} AS slug, md5({_SLUG}) AS company_id FROM raw"),
        "applicant_count": _raw(f"SELECT doc_id, {_APPLICANTS} AS applicants FROM raw"),
        "clean_jobs": _with_jobs(f"SELECT doc_id, {_JOB_COLUMNS} FROM clean"),
        "clean_companies": _with_companies(f"SELECT {_COMPANY_COLUMNS} FROM all_companies"),
        # dates
        "dim_date": """
            WITH day AS (
              SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP, max(o_orderdate)::DATE::TIMESTAMP,
                INTERVAL 1 DAY)) AS d FROM orders
            )
            SELECT strftime(d, '%Y%m%d') AS id, strftime(d, '%Y-%m-%d') AS full_date, dayname(d) AS day_of_week,
              month(d) AS month, quarter(d) AS quarter, year(d) AS year FROM day""",
        "date_key": _raw(f"SELECT doc_id, strftime({_DAY_MOMENT}, '%Y%m%d') AS date_id FROM raw"),
        # distinct
        "dedup_first": _with_companies(
            "SELECT 'job' AS kind, coalesce(job_url, 'Unknown') AS key, CAST(min(doc_id) AS VARCHAR) AS kept "
            "FROM raw GROUP BY 2 UNION ALL SELECT 'company', id, name || '|' || location FROM companies"
        ),
        "dedup_report": _with_companies(
            "SELECT 'job' AS kind, count(*) AS input_rows, count(DISTINCT coalesce(job_url, '')) AS kept_rows, "
            "count(*) - count(DISTINCT coalesce(job_url, '')) AS removed_rows FROM raw UNION ALL "
            "SELECT 'company', count(*), count(DISTINCT id), count(*) - count(DISTINCT id) FROM all_companies"
        ),
        "distinct_plus_unknown": _raw(
            "SELECT md5(company_location) AS id, company_location AS name FROM raw "
            "WHERE company_location IS NOT NULL GROUP BY company_location UNION ALL SELECT md5('Unknown'), 'Unknown'"
        ),
        # star
        "dim_company": _with_companies(
            "SELECT id, name, location, industry, CAST(CASE WHEN size < 4000 THEN size + (size < 2000)::INTEGER "
            "ELSE 0 END AS INTEGER) AS company_size FROM (SELECT *, ('0x' || id[1:4])::INTEGER % 5000 AS size "
            "FROM companies) UNION ALL SELECT 'Unknown', 'Unknown', 'Unknown', 'Unknown', 0"
        ),
        "dim_location": _with_jobs(
            "SELECT l.id, l.country, 'N/A' AS district, 'N/A' AS city, count(f.id) AS jobs FROM (VALUES "
            "('LOC_REMOTE', 'Remote'), ('LOC_ONSITE', 'Vietnam'), ('LOC_HYBRID', 'Vietnam'), ('LOC_NA', 'N/A')) "
            "AS l(id, country) LEFT JOIN fact f ON f.location_id = l.id GROUP BY ALL"
        ),
        "dim_source": _members("source_name", "source_name"),
        "dim_role": _members("role", "role_name"),
        "dim_level": _members("level", "level_name"),
        "dim_working_model": _members("location_type", "name", "N/A"),
        "dim_techstack": _with_jobs(
            f"SELECT md5(tech) AS id, tech AS tech_name, {_CATEGORY} AS category FROM mention GROUP BY tech "
            "UNION ALL SELECT md5('Unknown'), 'Unknown', 'Other'"
        ),
        "fact_hiring": _with_jobs("SELECT * FROM fact", _DAY_MOMENT),
        "bridge_tech_fact": _with_jobs("SELECT * FROM bridge"),
        "build_star": _with_star(
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, count(*) AS rows, {_checksum(_STAR_COLUMNS[t])} FROM ({sql})"
                for t, sql in _STAR.items()
            )
        ),
        "check_foreign_keys": _with_star(
            "SELECT 'date_id' AS foreign_key, count(DISTINCT date_id) AS orphan_values, count(*) AS orphan_rows "
            "FROM fact WHERE date_id > strftime(DATE '2026-04-21' + 99, '%Y%m%d') "
            + "".join(
                f"UNION ALL SELECT '{fk}', 0, 0 "
                for fk in ("company_id", "source_id", "location_id", "role_id", "level_id", "working_model", "fact_id",
                           "techstack_id")
            )
        ),
        # marts
        "mart_jobs_by_month": _with_star(
            "SELECT year(processed_at) AS year, month(processed_at) AS month, count(*) AS total_jobs FROM jobs "
            "GROUP BY ALL"
        ),
        "mart_hiring_trend": _with_star(
            "SELECT coalesce(CAST(year(d) AS VARCHAR), 'all') AS year, "
            "coalesce(CAST(quarter(d) AS VARCHAR), 'all') AS quarter, "
            "coalesce(CAST(month(d) AS VARCHAR), 'all') AS month, "
            "coalesce(strftime(d, '%Y-%m-%d'), 'all') AS full_date, "
            "count(*) AS total_jobs, GROUPING(year(d), quarter(d), month(d), d) AS grain "
            "FROM (SELECT CAST(processed_at AS DATE) AS d FROM jobs) GROUP BY ROLLUP (year(d), quarter(d), month(d), d)"
        ),
        "mart_top_companies": _with_star(
            "SELECT company_id, name AS company_name, count(*) AS total_jobs FROM jobs "
            "JOIN companies ON companies.id = company_id GROUP BY ALL ORDER BY total_jobs DESC, company_id LIMIT 10"
        ),
        "mart_tech_demand": _with_star(
            "SELECT strftime(day, '%Y-%m-%d') AS date, tech AS technology, count(DISTINCT job_url) AS job_count, "
            "round(count(DISTINCT job_url) * 100.0 / sum(count(DISTINCT job_url)) OVER (PARTITION BY day), 4) "
            "AS percentage FROM mention GROUP BY day, tech"
        ),
        "mart_working_model_share": _share(("location_type", "working_model_name"), "jobs"),
        "mart_source_share": _share(("source_name", "source_name"), "jobs"),
        "mart_role_level": _with_star(
            "SELECT coalesce(role, 'all') AS role_name, coalesce(level, 'all') AS level_name, "
            "count(*) AS total_jobs, GROUPING(role, level) AS grain FROM jobs GROUP BY CUBE (role, level)"
        ),
        "mart_job_analytics": _with_star(
            f"""SELECT strftime(g.d, '%Y-%m-%d') AS date, coalesce(name, 'Unknown') AS company_name, g.job_title, g.location_type,
                  g.employment_type, g.seniority_level, total_jobs, total_applicants, avg_applicants_per_job,
                  coalesce(top_technologies, '') AS top_technologies, coalesce(tech_count, 0) AS tech_count
                FROM (
                  SELECT CAST(processed_at AS DATE) AS d, company_id, title AS job_title, location_type,
                    employment_type, level AS seniority_level, count(*) AS total_jobs,
                    CAST(sum(number_applicants) AS BIGINT) AS total_applicants,
                    round(avg(number_applicants), 4) AS avg_applicants_per_job
                  FROM jobs GROUP BY ALL
                ) g
                LEFT JOIN companies ON companies.id = g.company_id
                LEFT JOIN (
                  SELECT d, company_id, title, location_type, employment_type, level,
                    CAST(count(*) AS INTEGER) AS tech_count,
                    array_to_string(list(tech ORDER BY n DESC, tech)[:5], ',') AS top_technologies
                  FROM (
                    SELECT CAST(processed_at AS DATE) AS d, company_id, title, location_type, employment_type, level,
                      tech, count(DISTINCT job_url) AS n
                    FROM (SELECT *, unnest(techstacks) AS tech FROM jobs) GROUP BY {_JOB_GROUP}, tech
                  ) GROUP BY ALL
                ) k ON k.d = g.d AND k.company_id = g.company_id AND k.title = g.job_title
                  AND k.location_type = g.location_type AND k.employment_type = g.employment_type
                  AND k.level = g.seniority_level"""
        ),
        "mart_salary_insights": _with_jobs(
            r"""SELECT strftime(processed_at, '%Y-%m-%d') AS date, title AS job_title, level AS seniority_level,
                  location_type, currency, round(avg(lo), 4) AS avg_salary_min, round(avg(hi), 4) AS avg_salary_max,
                  round(median((lo + hi) / 2), 4) AS median_salary, count(*) AS job_count
                FROM (
                  SELECT f.* EXCLUDE (currency), coalesce(known.currency, f.currency) AS currency,
                    coalesce(known.lo, least(scale * numbers[1], scale * coalesce(numbers[2], numbers[1]))) AS lo,
                    coalesce(known.hi, greatest(scale * numbers[1], scale * coalesce(numbers[2], numbers[1]))) AS hi
                  FROM (
                    SELECT processed_at, title, level, location_type, salary,
                      CASE WHEN contains(lower(salary), 'usd') OR contains(salary, '$') THEN 'usd'
                        WHEN contains(salary, '€') THEN 'eur' WHEN contains(salary, '£') THEN 'gbp'
                        WHEN regexp_matches(lower(salary), 'vnd|vnđ|trieu|triệu|million') THEN 'vnd'
                        ELSE 'unknown' END AS currency,
                      CASE WHEN regexp_matches(lower(salary), 'trieu|triệu|million') THEN 1e6 ELSE 1.0 END::DOUBLE
                        AS scale,
                      [replace(CASE WHEN regexp_matches(x, '[.,][0-9]{3}$') THEN x[:-5] || x[-3:] ELSE x END,
                        ',', '.')::DOUBLE FOR x IN regexp_extract_all(salary, '[0-9]+([.,][0-9]+)?')] AS numbers
                    FROM jobs
                  ) f
                  LEFT JOIN (VALUES -- expected values, as literals
                    ('15.000.000 - 20.000.000 VND', 'vnd', 15000000.0, 20000000.0),
                    ('1,234,567 usd', 'usd', 1234567.0, 1234567.0), ('$1,500.50', 'usd', 1500.5, 1500.5),
                    ('15 - 20 million', 'vnd', 15000000.0, 20000000.0), ('2,000 - 1,000 usd', 'usd', 1000.0, 2000.0),
                    ('1.5 million vnd', 'vnd', 1500000.0, 1500000.0)
                  ) AS known(salary, currency, lo, hi) ON known.salary = f.salary
                ) WHERE lo IS NOT NULL GROUP BY ALL"""
        ),
        # quality
        "check_columns": _report([
            ("columns", "doc_id", "SELECT 0::BIGINT AS n"), ("columns", "source", "SELECT 0::BIGINT AS n"),
            ("columns", "salary", "SELECT 1::BIGINT AS n"),
            ("not_empty", "*", "SELECT (count(*) = 0)::BIGINT AS n FROM documents"),
        ]),
        "check_not_empty": _raw(_report([
            ("not_empty", "*", "SELECT (count(*) = 0)::BIGINT AS n FROM raw"),
            ("not_empty", "*", "SELECT (count(*) = 0)::BIGINT AS n FROM raw WHERE length(title) < 0"),
        ])),
        "check_no_nulls": _raw(_report([
            ("no_nulls", c, f"SELECT count(*) - count({c}) AS n FROM raw") for c in _RAW_COLUMNS.split(", ")
        ])),
        "check_types": _raw(_report([
            ("types", "doc_id", "SELECT 0::BIGINT AS n"), ("types", "title", "SELECT 0::BIGINT AS n"),
            ("types", "salary", "SELECT 1::BIGINT AS n"),
            ("not_empty", "*", "SELECT (count(*) = 0)::BIGINT AS n FROM raw"),
        ])),
        "check_unique": _raw(_report([
            ("unique", c, f"SELECT count(*) - count(DISTINCT coalesce(CAST({c} AS VARCHAR), '(null)')) AS n FROM raw")
            for c in ("doc_id", "job_url", "company", "company_location")
        ])),
    }
