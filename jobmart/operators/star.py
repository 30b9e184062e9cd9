"""Star schema: dimensions, the hiring fact and the technology bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.functions import vocab
from jobmart.functions.dates import date_key
from jobmart.operators.dedup import distinct_plus_unknown, plus_unknown

_UNKNOWN = "Unknown"
_NOT_AVAILABLE = "N/A"


# -- dimensions -------------------------------------------------------------


def dim_company(companies: DataFrame) -> DataFrame:
    """Companies with the lower bound of the size text as a number, plus the unknown member."""
    lower_bound = F.replace(F.split_part("company_size", F.lit("-"), F.lit(1)), F.lit(","), F.lit(""))
    members = companies.where(F.col("id") != _UNKNOWN).select(
        "id", "name", "location", "industry",
        F.coalesce(lower_bound.try_cast("int"), F.lit(0)).alias("company_size"),
    )
    return distinct_plus_unknown(members, [*[F.lit(_UNKNOWN)] * 4, F.lit(0)])


def dim_location(spark: SparkSession) -> DataFrame:
    """The four constant location members."""
    return spark.createDataFrame(vocab.LOCATION_ROWS, "id string, country string, district string, city string")


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar rows for every day from ``start_date`` on, ``days`` of them, per row of ``bounds``."""
    days = F.sequence("start_date", F.date_add("start_date", F.col("days") - 1))
    calendar = bounds.select(F.explode(days).alias("full_date"))
    return calendar.select(
        date_key(F.col("full_date")).alias("id"),
        "full_date",
        F.date_format("full_date", "EEEE").alias("day_of_week"),
        F.month("full_date").cast("long").alias("month"),
        F.quarter("full_date").cast("long").alias("quarter"),
        F.year("full_date").cast("long").alias("year"),
    )


def date_bounds(spark: SparkSession, start_date: str | None = None, days: int = 365) -> DataFrame:
    """Calendar bounds: 365 days from a start, which is 30 days ago by default."""
    start = F.date_sub(F.current_date(), 30) if start_date is None else F.lit(start_date).cast("date")
    return spark.range(1).select(start.alias("start_date"), F.lit(days).alias("days"))


def _named_dimension(jobs: DataFrame, column: str, name: str, unknown: str, keep: Column) -> DataFrame:
    members = jobs.where(keep).select(F.md5(column).alias("id"), F.col(column).alias(name))
    return distinct_plus_unknown(members, [F.md5(F.lit(unknown)), F.lit(unknown)])


def dim_source(jobs: DataFrame) -> DataFrame:
    return _named_dimension(jobs, "source_name", "source_name", _UNKNOWN, F.col("source_name") != _UNKNOWN)


def dim_role(jobs: DataFrame) -> DataFrame:
    return _named_dimension(jobs, "role", "role_name", _UNKNOWN, ~F.col("role").isin("", _UNKNOWN))


def dim_level(jobs: DataFrame) -> DataFrame:
    return _named_dimension(jobs, "level", "level_name", _UNKNOWN, F.col("level") != _UNKNOWN)


def dim_working_model(jobs: DataFrame) -> DataFrame:
    return _named_dimension(
        jobs, "location_type", "name", _NOT_AVAILABLE, F.col("location_type") != _NOT_AVAILABLE
    )


def dim_techstack(jobs: DataFrame) -> DataFrame:
    """Technologies named by the jobs, with a category."""
    category = F.coalesce(
        *[F.when(F.col("tech").isin(words), F.lit(name)) for name, words in vocab.TECH_CATEGORIES.items()],
        F.lit("Other"),
    )
    # Distinct words first: the key and the category are then computed per word, not per mention.
    words = jobs.select(F.explode("techstacks").alias("tech")).distinct()
    members = words.select(F.md5("tech").alias("id"), F.col("tech").alias("tech_name"), category.alias("category"))
    return plus_unknown(members, [F.md5(F.lit(_UNKNOWN)), F.lit(_UNKNOWN), F.lit("Other")])


# -- fact and bridge ----------------------------------------------------------


def _key_or(column: str, default: str) -> Column:
    return F.md5(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default)))


def fact_hiring(jobs: DataFrame, *, fix_onsite: bool = False) -> DataFrame:
    """One fact per curated job.

    Curated jobs say ``ON_SITE`` while the location code is chosen by
    ``ONSITE``, so on-site jobs get the not-available location unless
    ``fix_onsite`` is set.
    """
    model = F.col("location_type")
    location = (
        F.when(model == "REMOTE", "LOC_REMOTE")
        .when(model == ("ON_SITE" if fix_onsite else "ONSITE"), "LOC_ONSITE")
        .when(model == "HYBRID", "LOC_HYBRID")
        .otherwise("LOC_NA")
    )
    return jobs.select(
        F.md5("job_url").alias("id"),
        "company_id",
        F.md5("source_name").alias("source_id"),
        location.alias("location_id"),
        date_key(F.col("processed_at")).alias("date_id"),
        _key_or("role", _UNKNOWN).alias("role_id"),
        _key_or("level", _UNKNOWN).alias("level_id"),
        _key_or("location_type", _NOT_AVAILABLE).alias("working_model"),
        F.lit(0).alias("salary_min_vnd"),
        F.lit(0).alias("salary_max_vnd"),
        F.col("number_applicants").alias("number_of_applicants"),
        F.lit("ACTIVE").alias("job_status"),
    )


def bridge_tech_fact(jobs: DataFrame) -> DataFrame:
    """One row per technology mention of a job; repeated words stay repeated."""
    return jobs.select(F.md5("job_url").alias("fact_id"), F.explode("techstacks").alias("tech")).select(
        F.md5("tech").alias("techstack_id"), "fact_id"
    )


def build_dimensions(jobs: DataFrame, companies: DataFrame, bounds: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_company": dim_company(companies),
        "dim_location": dim_location(jobs.sparkSession),
        "dim_date": dim_date(bounds),
        "dim_source": dim_source(jobs),
        "dim_role": dim_role(jobs),
        "dim_level": dim_level(jobs),
        "dim_working_model": dim_working_model(jobs),
        "dim_techstack": dim_techstack(jobs),
    }


def build_facts(jobs: DataFrame, *, fix_onsite: bool = False) -> dict[str, DataFrame]:
    return {"fact_hiring": fact_hiring(jobs, fix_onsite=fix_onsite), "bridge_tech_fact": bridge_tech_fact(jobs)}


def build_star(
    jobs: DataFrame, companies: DataFrame, bounds: DataFrame, *, fix_onsite: bool = False
) -> dict[str, DataFrame]:
    """All star tables, lazily, from one curated snapshot.

    ``jobs`` should be a stored table (the pipeline reads it back from silver),
    so that no branch repeats the text work; each branch reads its own columns.
    """
    return build_dimensions(jobs, companies, bounds) | build_facts(jobs, fix_onsite=fix_onsite)


# -- referential integrity ----------------------------------------------------

# Foreign key of the fact -> (dimension table, key column).
FACT_FOREIGN_KEYS = {
    "company_id": "dim_company",
    "source_id": "dim_source",
    "location_id": "dim_location",
    "date_id": "dim_date",
    "role_id": "dim_role",
    "level_id": "dim_level",
    "working_model": "dim_working_model",
}
BRIDGE_FOREIGN_KEYS = {"fact_id": "fact_hiring", "techstack_id": "dim_techstack"}


def check_foreign_keys(star: dict[str, DataFrame]) -> DataFrame:
    """Orphan values and rows per foreign key of the fact and of the bridge, zero rows included.

    All keys of a table are counted in one pass, and only distinct values meet
    the tables they refer to.
    """
    def used_keys(table: str, keys: dict[str, str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).alias("id")) for fk in keys])
        return star[table].select(F.inline(pairs))

    used = used_keys("fact_hiring", FACT_FOREIGN_KEYS).unionAll(used_keys("bridge_tech_fact", BRIDGE_FOREIGN_KEYS))
    used = used.groupBy("foreign_key", "id").agg(F.count(F.lit(1)).alias("fact_rows"))
    known = None
    for fk, table in (FACT_FOREIGN_KEYS | BRIDGE_FOREIGN_KEYS).items():
        ids = star[table].select(F.lit(fk).alias("foreign_key"), "id", F.lit(True).alias("known"))
        known = ids if known is None else known.unionAll(ids)
    # Grouped like the used keys, so the join needs no further shuffle.
    known = known.groupBy("foreign_key", "id").agg(F.max("known").alias("known"))
    orphan = F.col("known").isNull()
    return (
        used.join(known, ["foreign_key", "id"], "left")
        .groupBy("foreign_key")
        .agg(
            F.count_if(orphan).alias("orphan_values"),
            F.coalesce(F.sum(F.when(orphan, F.col("fact_rows"))), F.lit(0)).alias("orphan_rows"),
        )
    )
