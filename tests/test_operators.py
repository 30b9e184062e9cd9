"""Deduplication, upsert, quality, star and mart invariants."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from jobmart.operators import dedup, marts, merge, quality, silver, star

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- dedup ------------------------------------------------------------------------


def test_dedup_keeps_the_first_row_and_null_is_one_key(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, None), ("b", 2, "y"), (None, 5, "n"), (None, 4, "m")], "k string, o int, v string"
    )
    once = dedup.dedup_first(df, "k", ["o"])
    assert rows(once) == sorted([("a", 1, None), ("b", 2, "y"), (None, 4, "m")], key=repr)
    assert rows(dedup.dedup_first(once, "k", ["o"])) == rows(once)
    assert dedup.dedup_report(df, "k").first().asDict() == {"input_rows": 5, "kept_rows": 3, "removed_rows": 2}
    assert dedup.dedup_report(df.limit(0), "k").first().asDict() == {
        "input_rows": 0, "kept_rows": 0, "removed_rows": 0
    }


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of the rows share a key; every map task passes on one of them."""
    df = spark.range(0, 300_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string"))).alias("k"),
        F.col("id").alias("o"),
    )
    result = dedup.dedup_first(df, "k", ["o"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert "WindowGroupLimit" in plan
    expected = df.groupBy("k").agg(F.min("o"))
    assert rows(result) == rows(expected)


def test_null_urls_collapse_unless_kept(spark):
    raw = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "n int, title string")
    missing = [c for c in ("company source_name company_location location_working_type working_type date_posted "
                           "description job_url salary level number_applicants").split()]
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in missing})
    assert rows(silver.silver_jobs(raw, ["n"]).select("title", "job_url")) == [("t0", "Unknown")]
    kept = silver.silver_jobs(raw, ["n"], keep_null_urls=True).select("title", "job_url")
    assert rows(kept) == [(f"t{i}", None) for i in range(5)]


# -- upsert -----------------------------------------------------------------------


def test_upsert(spark):
    schema = "k string, v int"
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], schema)
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], schema)
    merged = merge.upsert(target, source, "k")
    assert rows(merged) == sorted([("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)], key=repr)
    keyed = source.where("k is not null")
    once = merge.upsert(target, keyed, "k")
    assert rows(merge.upsert(once, keyed, "k")) == rows(once)
    with pytest.raises(ValueError, match="not in the source"):
        merge.upsert(target, source, "missing")


# -- quality ----------------------------------------------------------------------


def test_quality_report_reads_the_table_once_for_counts_and_once_for_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (3, "a")], "id int, name string")
    report = quality.quality_report(
        df,
        quality.check_columns(df, ["id", "gone"]),
        quality.check_types(df, {"id": "int", "name": "int"}),
        quality.check_not_empty(df),
        quality.check_no_nulls(df, ["id", "name"]),
        quality.check_unique(df, "id"),
        quality.check_unique(df, "name"),
    )
    assert {(r.check_name, r.column_name): (r.passed, r.violations) for r in report.collect()} == {
        ("columns", "id"): (True, 0), ("columns", "gone"): (False, 1), ("types", "id"): (True, 0),
        ("types", "name"): (False, 1), ("not_empty", "*"): (True, 0), ("no_nulls", "id"): (True, 0),
        ("no_nulls", "name"): (False, 2), ("unique", "id"): (False, 1), ("unique", "name"): (False, 2),
    }
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2 and "Expand" not in plan
    with pytest.raises(quality.QualityError, match=r"no_nulls\(name\): 2"):
        quality.raise_on_fail(report)


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int")
    report = quality.quality_report(
        df, quality.check_not_empty(df), quality.check_no_nulls(df, ["id"]), quality.check_unique(df, "id")
    )
    assert [r.passed for r in report.collect()] == [False, True, True]
    with pytest.raises(quality.QualityError, match="not found"):
        quality.check_unique(df, "gone")


# -- star -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tables(spark):
    return {name: df.cache() for name, df in fx.star_tables(spark, SMALL).items()}


def test_unknown_members(tables):
    assert tables["dim_company"].where("id = 'Unknown'").count() == 1
    for name in ("dim_source", "dim_role", "dim_level"):
        column = tables[name].columns[1]
        assert rows(tables[name].where(f"id = md5('Unknown')").select(column)) == [("Unknown",)]
    assert rows(tables["dim_working_model"].where("id = md5('N/A')").select("name")) == [("N/A",)]
    for name in tables:
        if name.startswith("dim_"):
            assert tables[name].count() == tables[name].select("id").distinct().count(), name


def test_foreign_keys_hold(tables):
    report = star.check_foreign_keys(tables).collect()
    assert {r.foreign_key for r in report} == set(star.FACT_FOREIGN_KEYS | star.BRIDGE_FOREIGN_KEYS)
    assert all(r.orphan_rows == 0 for r in report)
    broken = dict(tables, dim_role=tables["dim_role"].where("role_name <> 'backend'"))
    orphans = {r.foreign_key: (r.orphan_values, r.orphan_rows) for r in star.check_foreign_keys(broken).collect()}
    backend = tables["fact_hiring"].where("role_id = md5('backend')").count()
    assert backend > 0 and orphans["role_id"] == (1, backend) and orphans["level_id"] == (0, 0)


def test_on_site_location_quirk(spark):
    jobs = fx.jobs(spark, SMALL)
    on_site = jobs.where("location_type = 'ON_SITE'").count()
    code = F.col("location_id") == "LOC_ONSITE"
    assert star.fact_hiring(jobs).where(code).count() == 0
    assert star.fact_hiring(jobs, fix_onsite=True).where(code).count() == on_site > 0


def test_company_sizes(spark):
    sizes = {"1,001-5,000": 1001, "500": 500, "10+": 0, "Unknown": 0}
    companies = spark.createDataFrame(
        [(s, s, "i", s, "l", "x") for s in sizes], "id string, name string, industry string, company_size string, "
        "location string, source_name string"
    )
    got = {r.name: r.company_size for r in star.dim_company(companies).collect() if r.id != "Unknown"}
    assert got == {k: v for k, v in sizes.items() if k != "Unknown"}


# -- marts ------------------------------------------------------------------------


def test_marts_do_not_multiply_appended_facts_in_tech_demand(tables):
    once = marts.tech_demand(
        tables["fact_hiring"], tables["bridge_tech_fact"], tables["dim_techstack"], tables["dim_date"]
    )
    fact, bridge = tables["fact_hiring"], tables["bridge_tech_fact"]
    twice = marts.tech_demand(
        fact.unionAll(fact), bridge.unionAll(bridge), tables["dim_techstack"], tables["dim_date"]
    )
    assert rows(once) == rows(twice)
    shares = once.groupBy("date").agg(F.sum("percentage").alias("p")).collect()
    assert all(abs(r.p - 100) < 0.1 for r in shares)


def test_trend_totals_agree(tables):
    trend = marts.hiring_trend(tables["fact_hiring"], tables["dim_date"])
    per_grain = {r[0]: r[1] for r in trend.groupBy("grain").agg(F.sum("total_jobs")).collect()}
    assert set(per_grain) == {0, 1, 3, 7, 15} and set(per_grain.values()) == {tables["fact_hiring"].count()}


def test_median_equals_statistics(spark):
    rng = random.Random(1)
    groups = {f"t{i}": [rng.randint(1, 30) * 100 for _ in range(rng.randint(1, 40))] for i in range(25)}
    data = [(t, f"{a} usd") for t, amounts in groups.items() for a in amounts] + [("none", "Negotiable")]
    jobs = spark.createDataFrame(data, "title string, salary string").select(
        "*", F.lit("L").alias("level"), F.lit("R").alias("location_type"),
        F.lit("2026-05-21 02:00:00").cast("timestamp").alias("processed_at"),
    )
    got = {r.job_title: (r.median_salary, r.avg_salary_min, r.job_count) for r in marts.salary_insights(jobs).collect()}
    assert got == {
        t: (float(statistics.median(a)), round(sum(a) / len(a), 4), len(a)) for t, a in groups.items()
    }


def test_salary_ranges(spark):
    cases = {
        "up to $2,000 usd": ("usd", 2000.0, 2000.0), "từ 10 đến 20 triệu": ("vnd", 1e7, 2e7),
        "€1.5 to 2.5": ("eur", 1.5, 2.5), "1,5 million": ("vnd", 1.5e6, 1.5e6), "100 - 200": ("unknown", 100.0, 200.0),
        "15.000.000 - 20.000.000 VND": ("vnd", 15e6, 20e6), "1,234,567 usd": ("usd", 1234567.0, 1234567.0),
        "$1,500.50": ("usd", 1500.5, 1500.5), "1000 usd - 1.5 million vnd": ("usd", 1000.0, 1.5e6),
        "15 - 20 million": ("vnd", 15e6, 20e6), "2,000 - 1,000 usd": ("usd", 1000.0, 2000.0),
        "Negotiable": ("unknown", None, None),
    }
    df = marts.with_salary_range(spark.createDataFrame([(s,) for s in cases], "salary string"))
    assert {r[0]: tuple(r[1:]) for r in df.collect()} == cases


def test_job_analytics_top_list(spark):
    moment = datetime.datetime(2026, 5, 21, 2)
    data = [
        ("t", "c", ["a", "b", "b"], 1, moment), ("t", "c", ["b", "z"], 2, moment), ("t", "c", [], 3, moment),
        ("u", "c", [], 0, moment),
    ]
    jobs = spark.createDataFrame(
        data, "title string, company_id string, techstacks array<string>, number_applicants int, processed_at timestamp"
    ).withColumns({"location_type": F.lit("R"), "employment_type": F.lit("F"), "level": F.lit("L")})
    companies = spark.createDataFrame([("c", "C")], "id string, name string")
    got = {r.job_title: r for r in marts.job_analytics(jobs, companies, top=2).collect()}
    assert got["t"].top_technologies == ["b", "a"] and got["t"].tech_count == 3
    assert (got["t"].total_jobs, got["t"].total_applicants, got["t"].avg_applicants_per_job) == (3, 6, 2.0)
    assert got["u"].top_technologies == [] and got["u"].tech_count == 0
