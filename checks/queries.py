"""One registered query per operator, over the postings of ``checks.fixture``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from jobmart.functions import dates, vocab
from jobmart.functions import text as tx
from jobmart.functions.matching import KeywordSet, compact_text, tech_keywords
from jobmart.operators import dedup, marts, merge, quality, silver, star
from jobmart.plans import pipeline
from jobmart.session import work_path
from jobmart.sources import crawl, pages, raw_jobs, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def flat_jobs(jobs: DataFrame) -> DataFrame:
    """Curated jobs with the list and the timestamp as text, to be comparable everywhere."""
    return jobs.withColumn("techstacks", F.array_join("techstacks", ",")).withColumn(
        "processed_at", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss")
    )


def _with_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with the normalised description and its compact form as columns."""
    raw = fx.raw_jobs(spark, sf_dir).withColumn("text", tx.normalised(F.col("description")))
    return raw.withColumn("compact", compact_text(F.col("text")))


# -- tables and files -----------------------------------------------------------


def _staged_raw(spark: SparkSession, sf_dir: str, name: str) -> str:
    base = work_path(spark, name)
    raw_jobs.write_raw_jobs(fx.raw_jobs(spark, sf_dir), base, fx.LOAD_DATE)
    return base


def _namespaces(spark: SparkSession) -> str:
    """Fresh namespaces in the shared folder; returns their prefix."""
    prefix = f"check_{uuid.uuid4().hex[:12]}_"
    tables.ensure_namespaces(spark, work_path(spark, "tables"), prefix)
    return prefix


@query
def read_raw_jobs(spark, sf_dir):
    return raw_jobs.read_raw_jobs(spark, _staged_raw(spark, sf_dir, "read"), fx.LOAD_DATE)


@query
def read_written_forms(spark, sf_dir):
    """Lines as other programs write them: numbers with zeros and exponents, keys that repeat, nested values with spaces."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("decimal(20,4)").cast("string")
    line = F.format_string(
        '{"job_url": "%d" , "salary": %s, "title": "%s", "salary": "later", "level": {"key":  [ %d, "a b" ]}, '
        '"number_applicants": %de3, "company": null, "company": "later"}',
        "o_orderkey", price, price, "o_custkey", "o_orderkey",
    )
    base = work_path(spark, "forms")
    fx.table(spark, sf_dir, "orders").select(line).write.text(raw_jobs.partition_path(base, fx.LOAD_DATE))
    read = raw_jobs.read_raw_jobs(spark, base, fx.LOAD_DATE, one_form=True)
    return read.select("job_url", "title", "company", "salary", "level", "number_applicants")


def _checksum(*columns: str) -> Column:
    """A number that tells the contents of a table, whatever the order of its rows."""
    text = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("(null)")) for c in columns]))
    return F.sum(F.conv(F.substring(text, 1, 8), 16, 10).cast("long")).alias("checksum")


@query
def write_raw_jobs(spark, sf_dir):
    """Fields of the written lines, their number, and a checksum of the contents."""
    lines = spark.read.text(raw_jobs.partition_path(_staged_raw(spark, sf_dir, "write"), fx.LOAD_DATE))
    fields = F.array_join(F.json_object_keys("value"), ",").alias("fields")
    values = F.from_json("value", raw_jobs.RAW_SCHEMA.simpleString()).alias("v")
    return lines.select(fields, values).select("fields", "v.*").groupBy("fields").agg(
        F.count(F.lit(1)).alias("lines"), _checksum(*raw_jobs.RAW_COLUMNS)
    )


@query
def publish_partition(spark, sf_dir):
    staged, target = _staged_raw(spark, sf_dir, "stage"), work_path(spark, "publish")
    raw_jobs.publish_partition(spark, staged, target, fx.LOAD_DATE)
    published = raw_jobs.read_raw_jobs(spark, target, fx.LOAD_DATE)
    return published.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("description")).alias("characters")
    )


@query
def read_table(spark, sf_dir):
    name = _namespaces(spark) + "silver.companies"
    tables.overwrite_table(fx.companies(spark, sf_dir), name)
    return tables.read_table(spark, name)


@query
def overwrite_table(spark, sf_dir):
    """A table replaced by a selection of its own rows."""
    name = _namespaces(spark) + "staging.silver_companies"
    tables.overwrite_table(fx.companies(spark, sf_dir), name)
    tables.overwrite_table(spark.table(name).where("location <> 'Unknown'"), name)
    return spark.table(name)


@query
def append_table(spark, sf_dir):
    """Companies appended twice, as facts are on every run."""
    name = _namespaces(spark) + "gold.company_log"
    for _ in range(2):
        tables.append_table(fx.companies(spark, sf_dir), name)
    return spark.table(name).groupBy("location").agg(F.count(F.lit(1)).alias("rows"))


@query
def upsert(spark, sf_dir):
    """Remote jobs with one more applicant, and hybrid jobs reposted under a new URL."""
    jobs = fx.stored_tables(spark, sf_dir)["jobs"]
    changed = jobs.where("location_type = 'REMOTE'").withColumn(
        "number_applicants", F.col("number_applicants") + 1
    )
    reposted = jobs.where("location_type = 'HYBRID'").withColumn(
        "job_url", F.concat("job_url", F.lit("/repost"))
    )
    merged = merge.upsert(jobs, changed.unionByName(reposted), "job_url")
    return merged.select("job_url", "location_type", "number_applicants")


@query
def table_catalog(spark, sf_dir):
    prefix = _namespaces(spark)
    companies = fx.companies(spark, sf_dir)
    for table in ("companies", "scratch"):
        tables.get_or_create_table(companies, f"{prefix}gold.{table}")
    tables.recreate_table(companies.select("id"), f"{prefix}gold.ids")
    tables.append_table(companies.select("id"), f"{prefix}gold.ids")
    tables.drop_table(spark, f"{prefix}gold.scratch")
    counts = None
    for table in ("companies", "ids"):
        rows = spark.table(f"{prefix}gold.{table}").agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.select(F.lit(table).alias("table_name"), "rows")
        counts = rows if counts is None else counts.unionAll(rows)
    return tables.list_tables(spark, f"{prefix}gold").select("table_name").join(counts, "table_name", "left")


@query
def clear_staging(spark, sf_dir):
    """All staging tables filled, then cleared, and the staged raw files gone."""
    prefix, staged = _namespaces(spark), _staged_raw(spark, sf_dir, "clear")
    names = [prefix + t for t in pipeline.STAGING_TABLES]
    filled = fx.stored_tables(spark, sf_dir)
    for name in names:
        tables.overwrite_table(filled[name.split(".")[1].removeprefix("silver_").removeprefix("gold_")], name)
    tables.clear_tables(spark, names)
    raw_jobs.clear_staged(spark, staged)
    left = int(raw_jobs.clear_staged(spark, staged))
    results = spark.createDataFrame([("raw files", left, len(raw_jobs.RAW_COLUMNS))], "table_name string, rows long, columns int")
    for table, name in zip(pipeline.STAGING_TABLES, names, strict=True):
        cleared = spark.table(name)
        results = results.unionAll(
            cleared.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table), "rows", F.lit(len(cleared.columns)))
        )
    return results


@query
def upsert_table(spark, sf_dir):
    """Jobs stored by key buckets, then remote jobs with one more applicant and hybrid jobs under a new URL."""
    name = _namespaces(spark) + "silver.jobs"
    jobs = fx.stored_tables(spark, sf_dir)["jobs"].select("job_url", "location_type", "number_applicants")
    tables.upsert_table(jobs, name, "job_url", buckets=32)
    changed = jobs.where("location_type = 'REMOTE'").withColumn("number_applicants", F.col("number_applicants") + 1)
    reposted = jobs.where("location_type = 'HYBRID'").withColumn("job_url", F.concat("job_url", F.lit("/repost")))
    tables.upsert_table(changed.unionByName(reposted), name, "job_url")
    return spark.table(name).drop(tables.BUCKET)


@query
def daily_run(spark, sf_dir):
    """Two days of all postings to gold: the jobs known then, whether the second day changed each, and rows of gold tables.

    Which of several postings of one URL is kept is not asked: all of a URL's postings on the second day have the same
    number of applicants, but for those without any URL, whose job says nothing here.
    """
    lake = pipeline.Lake(spark, work_path(spark, "lake"), f"run_{uuid.uuid4().hex[:12]}_", fx.PROCESSED_AT, fx.CALENDAR_START, key_buckets=4)
    first = fx.raw_jobs(spark, sf_dir)
    second = first.where("doc_id % 3 = 0").withColumn("number_applicants", F.lit("777")).unionByName(
        first.where("doc_id % 7 = 0").withColumn("job_url", F.concat("job_url", F.lit("/new")))
    )
    for day, postings in (("2026-05-21", first), ("2026-05-22", second)):
        pipeline.run(lake, "bronze", day, postings=postings)
        pipeline.run(lake, "silver", day)
        pipeline.run(lake, "gold", day)
        pipeline.run(lake, "staging", day, "clean")
    changed = F.when(F.col("job_url") != "Unknown", (F.col("number_applicants") == 777).cast("long"))
    found = tables.read_table(spark, lake.table("silver.jobs")).select(
        F.lit("job").alias("kind"), F.col("job_url").alias("name"), changed.alias("value")
    )
    for table in ("dim_company", "dim_date", "dim_location", "fact_hiring"):
        rows = spark.table(lake.table(f"gold.{table}")).agg(F.count(F.lit(1)).alias("value"))
        found = found.unionAll(rows.select(F.lit("table"), F.lit(table), "value"))
    return found


@query
def promotion_gate(spark, sf_dir):
    """What is refused of a day whose facts have companies that no dimension knows and jobs without a key; the gold facts stay."""
    lake = pipeline.Lake(spark, work_path(spark, "gate"), f"gate_{uuid.uuid4().hex[:12]}_", fx.PROCESSED_AT, fx.CALENDAR_START)
    tables.ensure_namespaces(spark, work_path(spark, "gate-tables"), lake.prefix)
    star_tables = fx.star_tables(spark, sf_dir)
    for name in pipeline.DIMENSIONS:
        tables.overwrite_table(star_tables[name], lake.table(f"gold.{name}"))
    built = {t: star_tables[t] for t in pipeline.FACTS}
    pipeline.stage_facts(lake, built)
    pipeline.promote_fact(lake, "2026-05-21")
    facts = built["fact_hiring"]
    planted = facts.where("location_id = 'LOC_REMOTE'").withColumn("company_id", F.lit("nobody"))
    unkeyed = facts.where("location_id = 'LOC_HYBRID'").withColumn("id", F.lit(None).cast("string"))
    pipeline.stage_facts(lake, built | {"fact_hiring": facts.unionByName(planted).unionByName(unkeyed)})
    try:
        pipeline.promote_fact(lake, "2026-05-22")
        refused = []
    except pipeline.PromotionRefused as error:
        refused = sorted(error.findings.items())
    stored = spark.table(lake.table("gold.fact_hiring")).agg(F.count(F.lit(1)).alias("rows"))
    return spark.createDataFrame(refused, "finding string, rows long").unionAll(stored.select(F.lit("facts in gold"), "rows"))


# -- pages ------------------------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the top-level domain as their source."""
    source = F.regexp_extract("url", r"^https?://[^/?#]*\.([a-z]+)", 1)
    return fx.table(spark, sf_dir, "pages").withColumn("source_name", source)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A small table as a stored one, whose size Spark knows."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _page_sources(page_table: DataFrame) -> DataFrame:
    sources = page_table.select("source_name").distinct().select(
        "source_name", F.lit("nav > ul > li").alias("entry_point"), F.lit("article h1").alias("detail_entry_point")
    )
    return _stored(sources, "page-sources")


def _listing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_table = _pages(spark, sf_dir)
    return pages.explode_listing_items(page_table, _page_sources(page_table))


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_table = _pages(spark, sf_dir)
    sources = _page_sources(page_table)
    specs = {
        "title": "li a@text()", "job_url": "a@href", "company": "@text()", "level": "a[href^='/']",
        "salary": "b@text()", "role": "@href",
    }
    configs = sources.select(
        "source_name", *[F.lit(specs.get(f)).cast("string").alias(f) for f in pages.LISTING_FIELDS]
    )
    return pages.extract_fields(pages.explode_listing_items(page_table, sources), configs)


@query
def crawl_frontier(spark, sf_dir):
    suppliers = fx.table(spark, sf_dir, "supplier")
    host = F.concat(F.lit("https://s"), F.col("s_suppkey").cast("string"), F.lit(".example"))
    sources = suppliers.select(
        F.col("s_name").alias("source_name"),
        F.concat(host, F.lit("/jobs/{role_slug}?q={role_query}&page={page}")).alias("url_template"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey") - 20).alias("end_page"),
    )
    return crawl.crawl_frontier(sources)


@query
def explode_listing_items(spark, sf_dir):
    return _listing_items(spark, sf_dir).select("page_id", "item_no", "item_html")


@query
def extract_fields(spark, sf_dir):
    return _extracted(spark, sf_dir).select(
        "page_id", "item_no", "title", "job_url", "company", "level", "salary", "role"
    )


@query
def resolve_urls(spark, sf_dir):
    """Several forms of every listing link, against the URL of its page."""
    href = F.col("job_url")
    forms = {
        "rooted": href,
        "relative": F.substr(href, F.lit(2)),
        "scheme": F.concat(F.lit("//cdn.example"), href),
        "query": F.concat(F.lit("?q="), F.substr(href, F.lit(2))),
        "absolute": F.concat(F.lit("https://abs.example"), href),
        "empty": F.lit(""),
        "up": F.concat(F.lit("../x/./"), F.substr(href, F.lit(2))),
        "dots": F.concat(F.lit("/a/b/../."), href),
        "blank": F.concat(F.lit(" \t"), href),
        "empty segments": F.concat(F.lit("/a//b/"), href),
    }
    links = _extracted(spark, sf_dir).select(
        "page_id", "item_no", "url",
        F.explode(F.array(*[F.struct(F.lit(n).alias("form"), v.alias("link")) for n, v in forms.items()])).alias("l"),
    )
    return links.select(
        "page_id", "item_no", "l.form",
        F.coalesce(pages.resolve_urls(F.col("l.link"), F.col("url")), F.lit("(null)")).alias("resolved"),
        F.coalesce(pages.resolve_urls(F.col("l.link"), F.lit("")), F.lit("(null)")).alias("unresolved"),
    )


@query
def join_details(spark, sf_dir):
    """The heading of the page each item was listed on; items whose text has a comma have no link.

    Several pages may have one URL, so the number of the page is added to it as a fragment.
    """
    page_table = _pages(spark, sf_dir).withColumn("url", F.concat("url", F.lit("#"), F.col("page_id").cast("string")))
    sources = _page_sources(page_table)
    items = pages.explode_listing_items(page_table, sources).select(
        "page_id", "item_no", "source_name",
        F.when(~F.col("item_html").contains(","), F.col("url")).alias("job_url"),
    )
    joined = pages.join_details(items, page_table.select("source_name", "url", "html"), sources)
    return joined.select("page_id", "item_no", F.coalesce("description", F.lit("(null)")).alias("description"))


@query
def extract_postings(spark, sf_dir):
    """Postings of the pages of two sources; the third one's configuration is incomplete.

    The detail page of a link is the first page of its source whose own first link it is.
    """
    page_table = _pages(spark, sf_dir)
    first_link = F.regexp_extract("html", r'<li><a href="(/[^"&]+)">', 1)
    found = page_table.withColumn("link", first_link).where("link <> ''").groupBy("source_name", "link").agg(
        F.min("page_id").alias("page_id")
    )
    details = found.join(page_table.select("page_id", "html"), "page_id").select(
        "source_name", F.concat(F.lit("https://jobs."), "source_name", "link").alias("url"), "html"
    )
    prefix = F.when(F.col("source_name") != "org", F.concat(F.lit("https://jobs."), "source_name", F.lit("/list/x?y")))
    specs = {"title": "li > a@text()", "company": "@text()", "job_url": "a@href", "level": "a[href^='/']"}
    sources = _page_sources(page_table)
    configs = sources.select(
        "source_name", *[F.lit(specs.get(f)).cast("string").alias(f) for f in pages.LISTING_FIELDS],
        prefix.alias("prefix_job_url"),
    )
    postings = pages.extract_postings(page_table, _stored(details, "details"), sources, configs)
    shown = ["source_name", "title", "company", "job_url", "level", "salary", "description"]
    return postings.select("page_id", "item_no", *[F.coalesce(c, F.lit("(null)")).alias(c) for c in shown])


def _source_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration for every supplier, some incomplete."""
    suppliers = fx.table(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey")
    fields = {
        "source_name": F.col("s_name"),
        "title": F.when(nation < 3, "").otherwise(F.concat(F.lit("h"), nation.cast("string"), F.lit("@text()"))),
        "job_url": F.when(nation != 9, "a@href"),
        "prefix_job_url": F.when(nation == 7, "").otherwise("https://jobs.example/"),
        "company": F.when(nation > 12, ".company"),
    }
    nothing = F.lit(None).cast("string")
    return suppliers.select(*[fields.get(f, nothing).alias(f) for f in pages.CONFIG_FIELDS])


@query
def sources_missing_config(spark, sf_dir):
    suppliers = fx.table(spark, sf_dir, "supplier")
    present = suppliers.where("s_acctbal >= 0").select(F.col("s_name").alias("source_name"))
    configs = _source_configs(spark, sf_dir).join(present, "source_name", "left_semi")
    return crawl.sources_missing_config(suppliers.select(F.col("s_name").alias("source_name")), configs)


@query
def load_source_config(spark, sf_dir):
    path = work_path(spark, "source-config")
    crawl.write_source_configs(_source_configs(spark, sf_dir), path)
    loaded = crawl.load_source_configs(spark, path, one_per_line=True)
    return loaded.select(
        "source_name", *[F.coalesce(f, F.lit("(null)")).alias(f) for f in
                         ("title", "job_url", "prefix_job_url", "company", "salary")]
    )


# -- text -------------------------------------------------------------------------


@query
def keyword_match_all(spark, sf_dir):
    found = tech_keywords().match_all(F.col("text"), F.col("compact"))
    return _with_description(spark, sf_dir).select("doc_id", F.array_join(found, ",").alias("keywords"))


@query
def keyword_match_separators(spark, sf_dir):
    """Pairs of short words, whatever white space is between them."""
    found = KeywordSet(fx.SHORT_PAIRS, separators=True).match_all(F.lower("text"))
    docs = fx.table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.array_join(found, ",").alias("keywords"))


@query
def keyword_match_first(spark, sf_dir):
    found = tech_keywords().match_first(F.col("text"), compact=F.col("compact"))
    return _with_description(spark, sf_dir).select("doc_id", found.alias("keyword"))


@query
def canonical_role(spark, sf_dir):
    role = tx.canonical_role(tx.normalised(F.col("title")))
    return fx.raw_jobs(spark, sf_dir).select("doc_id", role.alias("role"))


@query
def employment_type(spark, sf_dir):
    value = tx.employment_type(F.col("working_type"), F.col("text"))
    return _with_description(spark, sf_dir).select("doc_id", value.alias("employment_type"))


@query
def location_type(spark, sf_dir):
    value = tx.location_type(F.col("location_working_type"), F.col("text"))
    return _with_description(spark, sf_dir).select("doc_id", value.alias("location_type"))


@query
def seniority_level(spark, sf_dir):
    value = tx.seniority_level(F.col("level"), F.col("text"))
    return _with_description(spark, sf_dir).select("doc_id", value.alias("level"))


@query
def experience_level(spark, sf_dir):
    value = tx.experience_level(F.col("text"))
    return _with_description(spark, sf_dir).select("doc_id", value.alias("level"))


@query
def salary_phrase(spark, sf_dir):
    value = tx.salary_phrase(F.col("salary"), F.col("text"))
    found = tx.salary_phrase(F.lit(None).cast("string"), F.col("text"))
    return _with_description(spark, sf_dir).select("doc_id", value.alias("salary"), found.alias("described"))


@query
def posted_date(spark, sf_dir):
    value = dates.posted_date(F.col("date_posted"), fx.processed_at())
    return fx.raw_jobs(spark, sf_dir).select("doc_id", value.alias("date_posted"))


@query
def fallback_unknown_like(spark, sf_dir):
    salary, level, other = F.col("salary"), F.col("level"), F.lit("fallback")
    label = tx.first_label(tx.normalised(level), vocab.SENIORITY_PHRASES, long_text=False)
    return fx.raw_jobs(spark, sf_dir).select(
        "doc_id",
        tx.known_text_or(salary, other).alias("text_or"),
        tx.known_value_or(salary, other).alias("value_or"),
        tx.known_label_or(level, label, other).alias("label_or"),
    )


@query
def slug_md5_key(spark, sf_dir):
    company = F.col("company")
    return fx.raw_jobs(spark, sf_dir).select(
        "doc_id", tx.slug(company).alias("slug"), tx.slug_md5_key(company).alias("company_id")
    )


@query
def applicant_count(spark, sf_dir):
    value = tx.lenient_int(F.col("number_applicants"))
    return fx.raw_jobs(spark, sf_dir).select("doc_id", value.alias("applicants"))


@query
def clean_jobs(spark, sf_dir):
    return flat_jobs(silver.clean_jobs(fx.raw_jobs(spark, sf_dir), fx.processed_at(), carry=["doc_id"]))


@query
def clean_companies(spark, sf_dir):
    return silver.clean_companies(fx.raw_jobs(spark, sf_dir))


# -- dates ------------------------------------------------------------------------


def _order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar bounds that cover the orders."""
    day = F.to_date("o_orderdate")
    return fx.table(spark, sf_dir, "orders").agg(F.min(day).alias("start_date"), F.max(day).alias("end")).select(
        "start_date", (F.datediff("end", "start_date") + 1).alias("days")
    )


def _text_date(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


@query
def dim_date(spark, sf_dir):
    return _text_date(star.dim_date(_order_calendar(spark, sf_dir)), "full_date")


@query
def date_key(spark, sf_dir):
    moment = fx.processed_on_many_days()
    return fx.raw_jobs(spark, sf_dir).select("doc_id", dates.date_key(moment).alias("date_id"))


# -- distinct -----------------------------------------------------------------------


@query
def dedup_first(spark, sf_dir):
    """Jobs by URL and companies by id."""
    raw = fx.raw_jobs(spark, sf_dir)
    jobs = dedup.dedup_first(raw.withColumn("key", F.coalesce("job_url", F.lit("Unknown"))), "key", ["doc_id"])
    companies = fx.companies(spark, sf_dir)
    return jobs.select(F.lit("job").alias("kind"), "key", F.col("doc_id").cast("string").alias("kept")).unionAll(
        companies.select(F.lit("company"), "id", F.concat_ws("|", "name", "location"))
    )


@query
def dedup_report(spark, sf_dir):
    raw = fx.raw_jobs(spark, sf_dir)
    jobs = dedup.dedup_report(raw, "job_url").withColumn("kind", F.lit("job"))
    companies = dedup.dedup_report(silver.clean_companies(raw), "id").withColumn("kind", F.lit("company"))
    return jobs.unionAll(companies)


@query
def distinct_plus_unknown(spark, sf_dir):
    members = fx.raw_jobs(spark, sf_dir).where("company_location is not null").select(
        F.md5("company_location").alias("id"), F.col("company_location").alias("name")
    )
    return dedup.distinct_plus_unknown(members, [F.md5(F.lit("Unknown")), F.lit("Unknown")])


# -- star ---------------------------------------------------------------------------


@query
def dim_company(spark, sf_dir):
    """Companies given a size text made from their id: a range, a plain number, or no number."""
    companies = fx.companies(spark, sf_dir)
    size = F.conv(F.substring("id", 1, 4), 16, 10).cast("int") % 5000
    text = (
        F.when(size < 2000, F.concat(F.format_number(size + 1, 0), F.lit("-"), F.format_number(size + 500, 0)))
        .when(size < 4000, size.cast("string"))
        .otherwise(F.lit("Unknown"))
    )
    return star.dim_company(companies.withColumn("company_size", text))


@query
def dim_location(spark, sf_dir):
    """Location members with the facts that use them."""
    fact = star.fact_hiring(fx.jobs(spark, sf_dir))
    used = fact.groupBy(F.col("location_id").alias("id")).agg(F.count(F.lit(1)).alias("jobs"))
    return star.dim_location(spark).join(used, "id", "left").withColumn("jobs", F.coalesce("jobs", F.lit(0)))


@query
def dim_source(spark, sf_dir):
    return star.dim_source(fx.jobs(spark, sf_dir))


@query
def dim_role(spark, sf_dir):
    return star.dim_role(fx.jobs(spark, sf_dir))


@query
def dim_level(spark, sf_dir):
    return star.dim_level(fx.jobs(spark, sf_dir))


@query
def dim_working_model(spark, sf_dir):
    return star.dim_working_model(fx.jobs(spark, sf_dir))


@query
def dim_techstack(spark, sf_dir):
    return star.dim_techstack(fx.jobs(spark, sf_dir))


@query
def fact_hiring(spark, sf_dir):
    return star.fact_hiring(fx.jobs(spark, sf_dir, fx.processed_on_many_days()))


@query
def bridge_tech_fact(spark, sf_dir):
    return star.bridge_tech_fact(fx.jobs(spark, sf_dir))


@query
def build_star(spark, sf_dir):
    """Rows of every star table, and a checksum of their contents."""
    counts = None
    for name, df in fx.star_tables(spark, sf_dir).items():
        rows = df.agg(F.count(F.lit(1)).alias("rows"), _checksum(*sorted(df.columns)))
        rows = rows.select(F.lit(name).alias("table_name"), "rows", "checksum")
        counts = rows if counts is None else counts.unionAll(rows)
    return counts


@query
def check_foreign_keys(spark, sf_dir):
    """Integrity of the star whose calendar is too short for the last processing days."""
    tables_ = fx.star_tables(spark, sf_dir)
    tables_["dim_date"] = star.dim_date(star.date_bounds(spark, fx.CALENDAR_START, 100))
    return star.check_foreign_keys(tables_)


# -- marts --------------------------------------------------------------------------


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: marts.mart_tables(fx.star_tables(spark, sf_dir))[name]


def _no_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("all")) for c in columns})


QUERIES["mart_jobs_by_month"] = _mart("jobs_by_month")


@query
def mart_hiring_trend(spark, sf_dir):
    trend = _mart("hiring_trend")(spark, sf_dir)
    return _no_null(trend, "year", "quarter", "month", "full_date")


QUERIES["mart_top_companies"] = _mart("top_companies")


@query
def mart_tech_demand(spark, sf_dir):
    return _text_date(_mart("tech_demand")(spark, sf_dir), "date")


QUERIES["mart_working_model_share"] = _mart("working_model_share")


@query
def mart_role_level(spark, sf_dir):
    return _no_null(_mart("role_level")(spark, sf_dir), "role_name", "level_name")


QUERIES["mart_source_share"] = _mart("source_share")


@query
def mart_job_analytics(spark, sf_dir):
    stored = fx.stored_tables(spark, sf_dir)
    result = marts.job_analytics(stored["jobs"], stored["companies"])
    return _text_date(result, "date").withColumn("top_technologies", F.array_join("top_technologies", ","))


@query
def mart_salary_insights(spark, sf_dir):
    return _text_date(marts.salary_insights(fx.jobs(spark, sf_dir)), "date")


# -- quality ------------------------------------------------------------------------


@query
def check_columns(spark, sf_dir):
    jobs = fx.table(spark, sf_dir, "documents").select("doc_id", "source")
    return quality.quality_report(
        jobs, quality.check_columns(jobs, ["doc_id", "source", "salary"]), quality.check_not_empty(jobs)
    )


@query
def check_not_empty(spark, sf_dir):
    """All postings, and a selection that no posting meets."""
    raw = fx.raw_jobs(spark, sf_dir)
    return quality.quality_report(raw, quality.check_not_empty(raw)).unionAll(
        quality.quality_report(raw.where("length(title) < 0"), quality.check_not_empty(raw))
    )


@query
def check_no_nulls(spark, sf_dir):
    raw = fx.raw_jobs(spark, sf_dir)
    return quality.quality_report(raw, quality.check_no_nulls(raw, raw_jobs.RAW_COLUMNS))


@query
def check_types(spark, sf_dir):
    raw = fx.raw_jobs(spark, sf_dir)
    return quality.quality_report(
        raw, quality.check_types(raw, {"doc_id": "bigint", "title": "string", "salary": "int"}),
        quality.check_not_empty(raw),
    )


@query
def check_unique(spark, sf_dir):
    raw = fx.raw_jobs(spark, sf_dir)
    return quality.quality_report(
        raw, *[quality.check_unique(raw, c) for c in ("doc_id", "job_url", "company", "company_location")]
    )
