"""Postings derived from the given tables, for the registered queries.

One posting per document: the document text is the body of the description,
customers and nations give company names and places, and fixed phrases are
mixed in by ``doc_id`` so that every recogniser meets all its cases.  The SQL
twin of this module is ``checks.oracle.RAW_JOBS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.functions.matching import constant
from jobmart.operators import silver, star
from jobmart.session import work_path

LOAD_DATE = "2026-05-21"
PROCESSED_AT = "2026-05-21 02:00:00"
CALENDAR_START = "2026-04-21"

TITLES = [
    "Senior Backend Developer", "Full-Stack Engineer", "data engineer (ETL)", "QA Engineer", "AI Engineer",
    "DevOps / SRE", "Solution Architect", "Kỹ sư Data Scientist", "Chief Happiness Person", "", None,
    "Software Engineer",
]
LOCATION_TEXTS = [
    None, "Remote", "hybrid", "On-site", " N/A ", "remote and office", "làm việc từ xa", "somewhere",
]
WORKING_TYPES = [None, "Full-time", "part time", "Intern", "toàn thời gian", "Contract", "unknown"]
POSTED = [
    "2026-05-01", "1-5-2026", "01/05/2026", "2026/5/1", "5 minutes ago", "3 hours ago", "đăng 2 ngày trước",
    "30+ days ago", "1 week ago", "yesterday", "hôm nay", "2 months ago", "31-02-2026", None,
]
APPLICANTS = ["12", " 7 ", "12.6", "1,234", "abc", "", None, "1e3", "-3.5", "2.4999999"]
SALARIES = [
    None, "  1000 USD ", "unknown", "Negotiable", "n/a", "15.000.000 - 20.000.000 VND", "1,234,567 usd", "$1,500.50",
    "15 - 20 million", "2,000 - 1,000 usd", "1.5 million vnd",
]
LEVELS = [None, "Senior", "Entry Level", "wizard", "Trưởng nhóm", "N/A"]
PHRASES = [
    "Python, Spark and Kafka", "spring boot", "springboot / node.js", "C++ and C#", "asp.net mvc",
    "scalable opportunity", "React Native", "3-5 years experience", "0-1 year of experience", "kinh nghiệm 2 năm",
    "up to $2,000 usd", "từ 10 đến 20 triệu", "work from home", "thực tập", "fresher", "nothing",
]
SHORT_PAIRS = ["of a", "la y", "de", "de la", "to be", "zu", "in", "in zu", "et le", "a on", "on a"]
COMPANY_TEXTS = [None, "  ACME, Inc. ", "acme inc", "Công ty Đá", "---"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str | None], index: Column) -> Column:
    return F.get(constant(values, "array<string>"), (index % len(values)).cast("int"))


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw posting table (12 text columns) with doc_id, which orders it."""
    customers = table(spark, sf_dir, "customer")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    i = F.col("doc_id")
    # Squares spread over the whole customer table and meet some customers often.
    customer = i * i % customers.agg(F.count(F.lit(1))).scalar()
    rest = (i % 17).cast("int")
    company = F.when(rest < len(COMPANY_TEXTS), _pick(COMPANY_TEXTS, rest)).otherwise(F.col("c_name"))
    url_id = F.when(i % 10 == 3, i - 1).otherwise(i)
    # One table after the other: Spark knows the size of each and need not move the texts for a small one.
    placed = documents.join(
        customers.select("c_custkey", "c_name", "c_nationkey"), customer == F.col("c_custkey"), "left"
    ).join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return placed.select(
        "doc_id",
        _pick(TITLES, i).alias("title"),
        company.alias("company"),
        F.when(i % 23 != 0, F.col("source")).alias("source_name"),
        F.when(i % 19 != 0, F.col("n_name")).alias("company_location"),
        _pick(LOCATION_TEXTS, i).alias("location_working_type"),
        _pick(WORKING_TYPES, i).alias("working_type"),
        _pick(POSTED, i).alias("date_posted"),
        F.concat(F.col("text"), F.lit(" "), _pick(PHRASES, i)).alias("description"),
        F.when(i % 50 != 7, F.concat(F.lit("https://jobs.example/"), url_id.cast("string"))).alias("job_url"),
        _pick(SALARIES, i).alias("salary"),
        _pick(LEVELS, i).alias("level"),
        _pick(APPLICANTS, i).alias("number_applicants"),
    )


def processed_at() -> Column:
    return F.lit(PROCESSED_AT).cast("timestamp")


def processed_on_many_days() -> Column:
    """Ninety processing days, for the marts."""
    return processed_at() + F.make_dt_interval((F.col("doc_id") % 90).cast("int"))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_jobs(raw_jobs(spark, sf_dir), processed_at())


def jobs(spark: SparkSession, sf_dir: str, moment: Column | None = None) -> DataFrame:
    moment = processed_at() if moment is None else moment
    return silver.silver_jobs(raw_jobs(spark, sf_dir), ["doc_id"], moment)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_companies(raw_jobs(spark, sf_dir))


_STORED: dict[tuple[str, str], dict[str, str]] = {}


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver of many days and its star, written to the shared folder once a session and read by all that need them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        paths = {}

        def store(name: str, df: DataFrame) -> DataFrame:
            paths[name] = work_path(spark, name)
            df.write.parquet(paths[name])
            return spark.read.parquet(paths[name])

        silver_jobs = store("jobs", jobs(spark, sf_dir, processed_on_many_days()))
        silver_companies = store("companies", companies(spark, sf_dir))
        bounds = star.date_bounds(spark, CALENDAR_START, 365)
        for name, df in star.build_star(silver_jobs, silver_companies, bounds).items():
            store(name, df)
        _STORED[key] = paths
    return {name: spark.read.parquet(path) for name, path in _STORED[key].items()}


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    found = stored_tables(spark, sf_dir)
    return {name: df for name, df in found.items() if name not in ("jobs", "companies")}
