"""The daily run, step by step, on the derived postings."""

import uuid

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from jobmart.operators import star
from jobmart.plans import pipeline
from jobmart.plans.pipeline import Lake, run
from jobmart.sources import raw_jobs, tables

SMALL = "/root/testdata/sf0.001"
DAY = fx.LOAD_DATE


@pytest.fixture
def make_lake(spark, tmp_path):
    def make(**options):
        prefix = f"p{uuid.uuid4().hex[:8]}_"
        return Lake(spark, str(tmp_path / prefix), prefix, fx.PROCESSED_AT, fx.CALENDAR_START, **{"key_buckets": 4} | options)

    return make


def load(lake, postings, day=DAY):
    run(lake, "bronze", day, postings=postings)
    run(lake, "silver", day)
    run(lake, "gold", day)


def count(lake, table):
    return lake.spark.table(lake.table(table)).count()


def test_whole_run(spark, make_lake):
    lake = make_lake()
    raw = fx.raw_jobs(spark, SMALL)
    result = run(lake, "bronze", DAY, postings=raw)
    assert result["bronze_to_staging"]["jobs_staged"] == result["promote_bronze"]["promoted_rows"] == raw.count()

    result = run(lake, "silver", DAY)
    urls = raw.select(F.coalesce("job_url", F.lit("Unknown"))).distinct().count()
    assert result["silver_to_staging"]["jobs_staged"] == result["promote_silver"]["jobs_loaded"] == urls
    assert result["silver_to_staging"]["jobs_duplicate"] == raw.count() - urls

    # the text fields of the file path equal those of the direct path, whatever row of a URL is kept
    stored = tables.read_table(spark, lake.table("silver.jobs"))
    direct = fx.clean(spark, SMALL).select(stored.columns)
    assert stored.exceptAll(direct).count() == 0

    result = run(lake, "gold", DAY)
    assert count(lake, "gold.fact_hiring") == urls == result["promote_fact"]["fact_hiring"]
    assert count(lake, "gold.dim_date") == 365 and count(lake, "gold.dim_location") == 4
    gold = {t: spark.table(lake.table(f"gold.{t}")) for t in pipeline.DIMENSIONS + pipeline.FACTS}
    assert all(r.orphan_rows == 0 for r in star.check_foreign_keys(gold).collect())

    run(lake, "staging", DAY, "clean")
    assert all(count(lake, t) == 0 for t in pipeline.STAGING_TABLES)
    bronze = raw_jobs.read_raw_jobs(spark, lake.bronze_raw, DAY).count()
    with pytest.raises(ValueError, match="nothing staged"):
        run(lake, "bronze", DAY, "promote")
    assert raw_jobs.read_raw_jobs(spark, lake.bronze_raw, DAY).count() == bronze == raw.count()
    with pytest.raises(ValueError, match="no rows"):
        run(lake, "silver", DAY, "promote")


def test_running_again_updates_silver_and_dimensions_and_appends_facts(spark, make_lake):
    raw = fx.raw_jobs(spark, SMALL)
    for idempotent in (False, True):
        lake = make_lake(idempotent_facts=idempotent)
        load(lake, raw)
        before = {t: count(lake, t) for t in ("silver.jobs", "gold.dim_company", "gold.fact_hiring", "gold.bridge_tech_fact")}
        bridge = spark.table(lake.table("gold.bridge_tech_fact"))
        distinct = bridge.select("techstack_id", "fact_id").distinct().count()
        run(lake, "gold", DAY, "promote_fact")  # the same day once more
        assert {t: count(lake, t) for t in before} == before
        load(lake, raw, "2026-05-22")
        after = {t: count(lake, t) for t in before}
        assert after["silver.jobs"] == before["silver.jobs"]
        assert after["gold.dim_company"] == before["gold.dim_company"]
        if idempotent:
            assert after["gold.fact_hiring"] == before["gold.fact_hiring"]
            assert after["gold.bridge_tech_fact"] == before["gold.bridge_tech_fact"] == distinct
        else:
            assert after["gold.fact_hiring"] == 2 * before["gold.fact_hiring"]
            assert after["gold.bridge_tech_fact"] == 2 * before["gold.bridge_tech_fact"]


def test_second_day_updates_known_jobs(spark, make_lake):
    lake = make_lake()
    raw = fx.raw_jobs(spark, SMALL)
    load(lake, raw)
    first = count(lake, "silver.jobs")
    changed = raw.where("job_url like '%/1_'").withColumn("number_applicants", F.lit("777"))
    new = raw.where("doc_id = 0").withColumn("job_url", F.lit("https://jobs.example/new"))
    load(lake, changed.unionByName(new), "2026-05-22")
    jobs = spark.table(lake.table("silver.jobs"))
    assert jobs.count() == first + 1
    expected = changed.select("job_url").distinct().count()
    assert jobs.where("number_applicants = 777").count() == expected > 0


def test_kept_null_urls_are_not_stored_twice_by_a_retry(spark, make_lake):
    lake = make_lake(keep_null_urls=True)
    raw = fx.raw_jobs(spark, SMALL)
    run(lake, "bronze", DAY, postings=raw)
    run(lake, "silver", DAY)
    missing = raw.where("job_url is null").count()
    assert missing > 1
    run(lake, "silver", DAY, "promote")
    assert spark.table(lake.table("silver.jobs")).where("job_url is null").count() == missing


def test_rows_that_must_not_be_promoted_are_refused(spark, make_lake):
    """Counted while they are staged; after a proper day is staged, promotion goes on."""
    lake = make_lake()
    load(lake, fx.raw_jobs(spark, SMALL))
    before = count(lake, "gold.fact_hiring")
    built = {t: tables.read_table(spark, lake.table(f"staging.gold_{t}")) for t in pipeline.FACTS}
    built = {t: spark.createDataFrame(df.collect(), df.schema) for t, df in built.items()}
    facts = built["fact_hiring"]
    for bad, finding in (
        (facts.withColumn("level_id", F.lit("none of them")), "fact_hiring.level_id without dim_level"),
        (facts.withColumn("id", F.lit(None).cast("string")), "fact_hiring.id is null"),
    ):
        pipeline.stage_facts(lake, built | {"fact_hiring": bad})
        with pytest.raises(pipeline.PromotionRefused) as refused:
            run(lake, "gold", "2026-05-22", "promote_fact")
        assert refused.value.findings == {finding: before} and count(lake, "gold.fact_hiring") == before
    pipeline.stage_facts(lake, built)
    run(lake, "gold", "2026-05-22", "promote_fact")
    assert count(lake, "gold.fact_hiring") == 2 * before
    jobs = tables.read_table(spark, lake.table("silver.jobs")).withColumn("job_url", F.lit(None).cast("string")).limit(1)
    pipeline._stage(lake, jobs, pipeline.SILVER_STAGING["jobs"], ["job_url"])
    with pytest.raises(pipeline.PromotionRefused, match="job_url is null"):
        run(lake, "silver", DAY, "promote")
    # The write without counts drops what was counted of other contents.
    tables.overwrite_table(jobs, lake.table(pipeline.SILVER_STAGING["jobs"]))
    assert tables.observed(spark, lake.table(pipeline.SILVER_STAGING["jobs"])) == {}


def test_a_day_without_postings_is_refused_by_silver(spark, make_lake):
    lake = make_lake()
    result = run(lake, "bronze", DAY, postings=fx.raw_jobs(spark, SMALL).limit(0))
    assert result["promote_bronze"]["promoted_rows"] == 0
    with pytest.raises(ValueError, match="empty"):
        run(lake, "silver", DAY)


def test_errors(spark, make_lake):
    lake = make_lake()
    for layer, step, day in (("bronze", "load", DAY), ("copper", "all", DAY), ("silver", "all", "21-05-2026"),
                             ("staging", "all", DAY)):
        with pytest.raises(ValueError):
            run(lake, layer, day, step)
    with pytest.raises(ValueError, match="postings"):
        run(lake, "bronze", DAY, "process_to_staging")
    with pytest.raises(ValueError, match="nothing staged"):
        run(lake, "bronze", DAY, "promote")
    with pytest.raises(ValueError, match="does not exist"):
        run(lake, "gold", DAY)


def test_raw_values_in_one_form_and_other_separators(spark, make_lake):
    lake = make_lake(one_form=True, fix_separators=True)
    folder = raw_jobs.partition_path(lake.bronze_raw, DAY)
    lines = ['{"title":"a","title":"b","job_url":"u1","salary":1500.50}', '{"title":"c","job_url":"u2","salary":2e3}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    run(lake, "silver", DAY)
    stored = tables.read_table(spark, lake.table("silver.jobs")).select("job_url", "title", "salary").collect()
    assert sorted(map(tuple, stored)) == [("u1", "a", "1500.5"), ("u2", "c", "2000.0")]
