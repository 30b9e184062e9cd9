"""Analytics over the star schema.

Facts are counted per key before they meet a dimension, so joins see one row
per key and day, not one per posting.  No join carries a broadcast hint: Spark
broadcasts a dimension when its size is under the session's threshold and
shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 4


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _share(value: str, total: Column) -> Column:
    return F.round(F.col(value) * 100.0 / total, DIGITS)


def jobs_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Jobs per year and month, in order."""
    per_day = fact.groupBy("date_id").agg(_count("jobs"))
    return (
        per_day.join(dim_date.select(F.col("id").alias("date_id"), "year", "month"), "date_id")
        .groupBy("year", "month")
        .agg(F.sum("jobs").alias("total_jobs"))
        .orderBy("year", "month")
    )


def hiring_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Jobs per day, month, quarter, year and in total; ``grain`` is the grouping id of the row."""
    per_day = fact.groupBy("date_id").agg(_count("jobs"))
    days = dim_date.select(F.col("id").alias("date_id"), "year", "quarter", "month", "full_date")
    return (
        per_day.join(days, "date_id")
        .rollup("year", "quarter", "month", "full_date")
        .agg(F.sum("jobs").alias("total_jobs"), F.grouping_id().alias("grain"))
    )


def top_companies(fact: DataFrame, dim_company: DataFrame, top: int = 10) -> DataFrame:
    """Companies with the most jobs; ties go to the smaller id."""
    per_company = fact.groupBy("company_id").agg(_count("total_jobs"))
    names = dim_company.select(F.col("id").alias("company_id"), F.col("name").alias("company_name"))
    return (
        per_company.join(names, "company_id").orderBy(F.desc("total_jobs"), "company_id").limit(top)
    )


def tech_demand(fact: DataFrame, bridge: DataFrame, dim_techstack: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Jobs per technology and day, and the technology's share of all mentions of that day.

    The bridge repeats words and facts are appended on every run, so both sides
    are first reduced to one row per job: its set of technologies, at most the
    vocabulary, and its set of days, at most the calendar.  Both sets are built
    up inside the map tasks, and the join reuses their partitioning.
    """
    mentions = bridge.groupBy("fact_id").agg(F.collect_set("techstack_id").alias("techs"))
    days = fact.groupBy(F.col("id").alias("fact_id")).agg(F.collect_set("date_id").alias("days"))
    per_day = (
        mentions.join(days, "fact_id")
        .select(F.explode("days").alias("date_id"), "techs")
        .select("date_id", F.explode("techs").alias("techstack_id"))
        .groupBy("date_id", "techstack_id")
        .agg(_count("job_count"))
    )
    named = per_day.join(
        dim_techstack.select(F.col("id").alias("techstack_id"), F.col("tech_name").alias("technology")),
        "techstack_id",
    ).join(dim_date.select(F.col("id").alias("date_id"), F.col("full_date").alias("date")), "date_id")
    total = F.sum("job_count").over(Window.partitionBy("date"))
    return named.select("date", "technology", "job_count", _share("job_count", total).alias("percentage"))


def _dimension_share(fact: DataFrame, key: str, dimension: DataFrame, name: str) -> DataFrame:
    counts = fact.groupBy(key).agg(_count("total_jobs"))
    named = counts.join(dimension.select(F.col("id").alias(key), name), key)
    total = named.agg(F.sum("total_jobs")).scalar()
    return named.select(name, "total_jobs", _share("total_jobs", total).alias("percentage"))


def working_model_share(fact: DataFrame, dim_working_model: DataFrame) -> DataFrame:
    """Jobs and share per working model."""
    model = dim_working_model.withColumnRenamed("name", "working_model_name")
    return _dimension_share(fact, "working_model", model, "working_model_name")


def source_share(fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    """Jobs and share per source."""
    return _dimension_share(fact, "source_id", dim_source, "source_name")


def role_level(fact: DataFrame, dim_role: DataFrame, dim_level: DataFrame) -> DataFrame:
    """Jobs per role and level with all totals; ``grain`` is the grouping id of the row."""
    counts = fact.groupBy("role_id", "level_id").agg(_count("jobs"))
    return (
        counts.join(dim_role.select(F.col("id").alias("role_id"), "role_name"), "role_id")
        .join(dim_level.select(F.col("id").alias("level_id"), "level_name"), "level_id")
        .cube("role_name", "level_name")
        .agg(F.sum("jobs").alias("total_jobs"), F.grouping_id().alias("grain"))
    )


_JOB_KEYS = ["date", "company_id", "job_title", "location_type", "employment_type", "seniority_level"]


def job_analytics(jobs: DataFrame, companies: DataFrame, top: int = 5) -> DataFrame:
    """Postings, applicants and leading technologies per day, company, title and work arrangement.

    A technology counts once per job.  Technologies are counted per group before
    they are ranked, so a group brings at most one row per word of the
    vocabulary to the window, however many jobs it has.
    """
    keyed = jobs.select(
        F.to_date("processed_at").alias("date"),
        "company_id",
        F.col("title").alias("job_title"),
        "location_type",
        "employment_type",
        F.col("level").alias("seniority_level"),
        "number_applicants",
        F.array_distinct("techstacks").alias("techstacks"),
    )
    totals = keyed.groupBy(*_JOB_KEYS).agg(
        _count("total_jobs"),
        F.sum("number_applicants").alias("total_applicants"),
        F.round(F.avg("number_applicants"), DIGITS).alias("avg_applicants_per_job"),
    )
    per_word = keyed.select(*_JOB_KEYS, F.explode("techstacks").alias("tech")).groupBy(*_JOB_KEYS, "tech").agg(
        _count("mentions")
    )
    ranking = Window.partitionBy(*_JOB_KEYS).orderBy(F.desc("mentions"), "tech")
    leading = (
        per_word.withColumn("position", F.row_number().over(ranking))
        .groupBy(*_JOB_KEYS)
        .agg(
            F.array_sort(
                F.collect_list(F.when(F.col("position") <= top, F.struct("position", "tech")))
            ).getField("tech").alias("top_technologies"),
            F.count(F.lit(1)).cast("int").alias("tech_count"),
        )
    )
    names = companies.select(F.col("id").alias("company_id"), F.col("name").alias("company_name"))
    return (
        totals.join(leading, _JOB_KEYS, "left")
        .join(names, "company_id", "left")
        .select(
            "date",
            F.coalesce("company_name", F.lit("Unknown")).alias("company_name"),
            *_JOB_KEYS[2:],
            "total_jobs",
            "total_applicants",
            "avg_applicants_per_job",
            F.coalesce("top_technologies", F.array().cast("array<string>")).alias("top_technologies"),
            F.coalesce("tech_count", F.lit(0)).alias("tech_count"),
        )
    )


# -- salaries ---------------------------------------------------------------

# Digits in groups of three with an optional fraction, or plain digits with one, and the words for millions after it.
_NUMBER = "((?:[0-9]{1,3}(?:[.,][0-9]{3})+(?:[.,][0-9]{1,2})?(?![0-9])|[0-9]+(?:[.,][0-9]+)?))"
_MILLIONS = "trieu|triệu|million"
_MARKED_NUMBER = f"{_NUMBER}(?:\\s*({_MILLIONS}))?"
_CURRENCIES = {"usd": r"usd|\$", "eur": "€", "gbp": "£", "vnd": "vnd|vnđ|trieu|triệu|million"}


def _amount(text: Column) -> Column:
    """Number of an amount text; a point or comma before exactly three digits groups thousands."""
    grouped = F.regexp_replace(text, "[.,]([0-9]{3})(?![0-9])", "$1")
    return F.regexp_replace(grouped, ",", ".").try_cast("double")


def with_salary_range(jobs: DataFrame) -> DataFrame:
    """Adds salary_currency, salary_min and salary_max, read from the salary text.

    The first two numbers are the range, the lower one first; one number is both
    ends.  Millions are written out for each number they stand after, and for a
    number before them that has no unit of its own, as in ``15 - 20 million``:
    one below 1000.  Rows without a number get null.
    """
    text = F.lower(F.col("salary"))
    numbers = F.regexp_extract_all(text, F.lit(_MARKED_NUMBER), F.lit(1))
    marks = F.regexp_extract_all(text, F.lit(_MARKED_NUMBER), F.lit(2))
    currency = F.coalesce(
        *[F.when(text.rlike(pattern), F.lit(code)) for code, pattern in _CURRENCIES.items()], F.lit("unknown")
    )

    def number(i: int) -> Column:
        value, later = _amount(F.get("_numbers", F.lit(i))), F.get("_marks", F.lit(i + 1))
        millions = (F.get("_marks", F.lit(i)) != "") | (F.coalesce(later != "", F.lit(False)) & (value < 1000))
        bare = (F.size("_numbers") == 1) & text.rlike(_MILLIONS) & (value < 1000)
        return F.when(F.coalesce(millions, F.lit(False)) | bare, value * 1e6).otherwise(value)

    first = number(0)
    second = F.coalesce(number(1), first)
    return (
        jobs.withColumn("_numbers", numbers)
        .withColumn("_marks", marks)
        .withColumn("salary_currency", currency)
        .withColumn("salary_min", F.least(first, second))
        .withColumn("salary_max", F.greatest(first, second))
        .drop("_numbers", "_marks")
    )


_SALARY_KEYS = ["date", "job_title", "seniority_level", "location_type", "currency"]


def salary_insights(jobs: DataFrame) -> DataFrame:
    """Average range ends, exact median of the midpoints and job count of jobs with a salary number.

    Amounts of different currencies are never mixed, hence the extra key.
    Midpoints are first counted per value; the median then reads the two middle
    positions from running counts, a sorted pass that spills and that sees each
    distinct amount of a group once.
    """
    priced = with_salary_range(jobs).where(F.col("salary_min").isNotNull())
    per_value = (
        priced.select(
            F.to_date("processed_at").alias("date"),
            F.col("title").alias("job_title"),
            F.col("level").alias("seniority_level"),
            "location_type",
            F.col("salary_currency").alias("currency"),
            "salary_min",
            "salary_max",
            ((F.col("salary_min") + F.col("salary_max")) / 2).alias("middle"),
        )
        .groupBy(*_SALARY_KEYS, "middle")
        .agg(F.sum("salary_min").alias("sum_min"), F.sum("salary_max").alias("sum_max"), _count("n"))
    )
    ordered = Window.partitionBy(*_SALARY_KEYS).orderBy("middle")
    upto, after = F.col("upto"), F.col("upto") - F.col("n")
    lower, upper = F.floor((F.col("total") + 1) / 2), F.ceil((F.col("total") + 1) / 2)
    positions = per_value.select(
        "*",
        F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("upto"),
        F.sum("n").over(Window.partitionBy(*_SALARY_KEYS)).alias("total"),
    )

    def at(position: Column) -> Column:
        return F.max(F.when((after < position) & (position <= upto), F.col("middle")))

    return positions.groupBy(*_SALARY_KEYS).agg(
        F.round(F.sum("sum_min") / F.sum("n"), DIGITS).alias("avg_salary_min"),
        F.round(F.sum("sum_max") / F.sum("n"), DIGITS).alias("avg_salary_max"),
        F.round((at(lower) + at(upper)) / 2, DIGITS).alias("median_salary"),
        F.sum("n").alias("job_count"),
    )


def mart_tables(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts that need nothing but the star schema."""
    fact, date = star["fact_hiring"], star["dim_date"]
    return {
        "jobs_by_month": jobs_by_month(fact, date),
        "hiring_trend": hiring_trend(fact, date),
        "top_companies": top_companies(fact, star["dim_company"]),
        "tech_demand": tech_demand(fact, star["bridge_tech_fact"], star["dim_techstack"], date),
        "working_model_share": working_model_share(fact, star["dim_working_model"]),
        "role_level": role_level(fact, star["dim_role"], star["dim_level"]),
        "source_share": source_share(fact, star["dim_source"]),
    }
