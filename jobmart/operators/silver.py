"""Raw postings to the curated jobs and companies tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions import text as tx
from jobmart.functions.dates import posted_date
from jobmart.functions.matching import compact_text, tech_keywords
from jobmart.operators.dedup import dedup_first

JOB_COLUMNS = [
    "title", "company_id", "source_name", "location_type", "employment_type", "date_posted", "techstacks",
    "job_url", "salary", "level", "role", "number_applicants", "processed_at",
]
COMPANY_COLUMNS = ["id", "name", "industry", "company_size", "location", "source_name"]


def clean_jobs(
    raw: DataFrame,
    processed_at: Column | None = None,
    *,
    carry: Sequence[str] = (),
    fix_cpp: bool = False,
    fix_separators: bool = False,
    keep_null_urls: bool = False,
) -> DataFrame:
    """One curated row per raw posting; row-wise, so it never shuffles.

    ``carry`` names raw columns to keep (to order a later deduplication).  The
    lower-cased texts sit in a projection of their own: several fields read
    them and Spark computes them once.  ``keep_null_urls`` leaves a missing URL
    null instead of the text ``Unknown``.
    """
    processed = F.current_timestamp() if processed_at is None else processed_at
    prepared = raw.withColumns(
        {
            "_description": tx.normalised(F.col("description")),
            "_title": tx.normalised(F.col("title")),
            "_processed_at": processed,
        }
    ).withColumn("_compact", compact_text(F.col("_description")))
    description, moment = F.col("_description"), F.col("_processed_at")

    def or_unknown(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("Unknown"))

    values = {
        "title": or_unknown("title"),
        "company_id": tx.slug_md5_key(F.col("company")),
        "source_name": or_unknown("source_name"),
        "location_type": tx.location_type(F.col("location_working_type"), description),
        "employment_type": tx.employment_type(F.col("working_type"), description),
        "date_posted": posted_date(F.col("date_posted"), moment),
        "techstacks": tech_keywords(fix_cpp, fix_separators).match_all(description, F.col("_compact")),
        "job_url": F.col("job_url") if keep_null_urls else or_unknown("job_url"),
        "salary": tx.salary_phrase(F.col("salary"), description),
        "level": tx.seniority_level(F.col("level"), description),
        "role": tx.canonical_role(F.col("_title")),
        "number_applicants": tx.lenient_int(F.col("number_applicants")),
        "processed_at": moment,
    }
    return prepared.select(*[values[c].alias(c) for c in JOB_COLUMNS], *[F.col(c) for c in carry])


def _companies(raw: DataFrame) -> DataFrame:
    unknown = F.lit("Unknown")
    return raw.select(
        tx.slug_md5_key(F.col("company")).alias("id"),
        F.coalesce("company", unknown).alias("name"),
        unknown.alias("industry"),
        unknown.alias("company_size"),
        F.coalesce("company_location", unknown).alias("location"),
        F.lit("scraper").alias("source_name"),
    )


def clean_companies(raw: DataFrame) -> DataFrame:
    """Distinct companies named by the raw postings."""
    return _companies(raw).distinct()


def silver_jobs(raw: DataFrame, order: Sequence[str], processed_at: Column | None = None, **options) -> DataFrame:
    """Curated jobs, first row per URL in the order of the given raw columns.

    Enrichment runs before the shuffle, so the long descriptions never move.
    With ``keep_null_urls`` rows without URL are not collapsed into one.
    """
    jobs = clean_jobs(raw, processed_at, carry=order, **options)
    if not options.get("keep_null_urls"):
        return dedup_first(jobs, "job_url", order).select(*JOB_COLUMNS)
    # A null URL is its own group: the order columns identify the row.
    own_group = F.when(F.col("job_url").isNull(), F.struct(*order))
    grouped = jobs.withColumn("_null_url", own_group)
    return dedup_first(grouped, ["job_url", "_null_url"], order).select(*JOB_COLUMNS)


def silver_companies(raw: DataFrame) -> DataFrame:
    """Companies, first (name, location) per id.

    Keeping the first row makes the distinct step of ``clean_companies``
    superfluous: its duplicates tie, and one shuffle is enough.
    """
    return dedup_first(_companies(raw), "id", ["name", "location"]).select(*COMPANY_COLUMNS)
