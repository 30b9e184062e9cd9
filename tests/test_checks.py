"""Every registered query against its SQL twin, and the shape of the important plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import compare, oracle, queries
from checks import fixture as fx
from jobmart.operators import marts

SMALL = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()


def test_every_query_has_a_twin():
    assert set(queries.QUERIES) == set(ORACLE) and len(ORACLE) == 65
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert compare.compare(spark, compare.duckdb_over(SMALL), entry.queries()[name], ORACLE[name], SMALL) == ""


def scans(spark, name, first_column):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    return plan.count(f"Relation [{first_column}#")


def test_documents_and_pages_are_read_once(spark):
    """The stored star is read by marts and key checks; a query from raw data reads its documents or pages once."""
    for name in ("build_star", "check_foreign_keys", "mart_tech_demand", "mart_job_analytics", "mart_role_level", "upsert"):
        assert scans(spark, name, "doc_id") == 0, name
    for name in ("clean_jobs", "fact_hiring", "bridge_tech_fact", "dim_location", "check_unique", "mart_salary_insights"):
        assert scans(spark, name, "doc_id") <= 1 + (name == "check_unique"), name
    for name in ("explode_listing_items", "extract_fields", "resolve_urls"):
        assert scans(spark, name, "page_id") == 1, name


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_never_shuffles(spark):
    plan = physical(fx.clean(spark, SMALL))
    above_fixture = plan.split("BroadcastHashJoin")[0]
    assert "Exchange" not in above_fixture


def test_unused_fields_are_not_computed(spark):
    plan = physical(fx.jobs(spark, SMALL).select("job_url", "source_name"))
    assert "regexp_extract_all" not in plan and "description" not in plan


def test_no_python_and_no_cross_join_in_the_text_path(spark):
    for name in ("clean_jobs", "fact_hiring", "mart_tech_demand", "mart_job_analytics", "crawl_frontier"):
        plan = physical(entry.queries()[name](spark, SMALL))
        assert not re.search("EvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoop", plan), name


def test_facts_are_counted_before_they_are_joined(spark, tmp_path):
    """The fact side of a mart reads two columns at most and reaches the join aggregated."""
    star = fx.star_tables(spark, SMALL)
    stored = {}
    for name in ("fact_hiring", "dim_company"):
        star[name].write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    plan = physical(marts.top_companies(stored["fact_hiring"], stored["dim_company"]))
    assert "ReadSchema: struct<company_id:string>" in plan
    assert plan.index("Join") < plan.index("HashAggregate")
    assert "TakeOrderedAndProject" in plan


def test_constant_tables_are_folded(spark):
    """Vocabularies are literals in the plan, not parsed per row."""
    plan = physical(fx.clean(spark, SMALL).select("techstacks", "role"))
    assert "from_json" not in plan


def test_details_of_pages_with_one_url(spark, tmp_path):
    """Each item has the heading of its own page, also when other pages have the same URL."""
    page_table = spark.read.parquet(f"{SMALL}/pages.parquet")
    again = page_table.withColumns({"page_id": F.col("page_id") + 100_000, "html": F.replace("html", F.lit("<h1>"), F.lit("<h1>again "))})
    page_table.unionByName(again).coalesce(1).write.parquet(str(tmp_path / "pages"))
    next((tmp_path / "pages").glob("*.parquet")).rename(tmp_path / "pages.parquet")
    folder = str(tmp_path)
    assert compare.compare(spark, compare.duckdb_over(folder), queries.join_details, ORACLE["join_details"], folder) == ""
