"""The daily run: every layer is built into staging and then promoted.

Steps share nothing but stored tables, so a step that failed can be run again
alone.  A promotion reads staging, never the build.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobmart.operators import silver, star
from jobmart.sources import raw_jobs, tables

# Table names of the layers.
SILVER_TABLES = {"jobs": "silver.jobs", "companies": "silver.companies"}
SILVER_STAGING = {"jobs": "staging.silver_jobs", "companies": "staging.silver_companies"}
SILVER_KEYS = {"jobs": "job_url", "companies": "id"}
DIMENSIONS = [
    "dim_company", "dim_location", "dim_date", "dim_source", "dim_role", "dim_level", "dim_working_model",
    "dim_techstack",
]
#: Dimensions that grow with the postings; the others have a row per value of a fixed list.
LARGE_DIMENSIONS = ["dim_company"]
FACTS = ["fact_hiring", "bridge_tech_fact"]
STAGING_TABLES = [*SILVER_STAGING.values(), *[f"staging.gold_{t}" for t in DIMENSIONS + FACTS]]


@dataclass(frozen=True)
class Lake:
    """Where things are and how the documented quirks are treated."""

    spark: SparkSession
    raw_root: str  # folder of the raw JSON lines
    prefix: str = ""  # put before every namespace, to keep runs apart
    processed_at: str | None = None  # fixed processing time; the current time if None
    calendar_start: str | None = None
    fix_cpp: bool = False
    fix_onsite: bool = False
    keep_null_urls: bool = False
    idempotent_facts: bool = False
    key_buckets: int = 16  # partitions of the tables that are upserted by key; one should hold a few GB
    fix_separators: bool = False
    one_form: bool = False

    def table(self, name: str) -> str:
        return self.prefix + name

    @property
    def staged_raw(self) -> str:
        return f"{self.raw_root.rstrip('/')}/staging/raw_jobs"

    @property
    def bronze_raw(self) -> str:
        return f"{self.raw_root.rstrip('/')}/bronze/raw_jobs"


class PromotionRefused(ValueError):
    """Staged rows that must not be promoted: ``findings`` has the number of rows for each."""

    def __init__(self, table: str, findings: dict[str, int]):
        super().__init__(f"{table} is not promoted: " + ", ".join(f"{k} ({n} rows)" for k, n in findings.items()))
        self.findings = findings


def _stage(lake: Lake, df: DataFrame, table: str, keys: list[str], allow_empty: bool = False, **counts: Column) -> int:
    """Replace a staging table; rows without one of ``keys`` and those of ``counts`` are counted while they are written."""
    short = table.split(".")[-1].removeprefix("gold_").removeprefix("silver_")
    wanted = {f"{short}.{k} is null": F.col(k).isNull() for k in keys} | {f"{short}.{k}": c for k, c in counts.items()}
    return tables.overwrite_table(df, lake.table(table), allow_empty, wanted)


def _gate(lake: Lake, *staged: str) -> None:
    """Refuse to promote if the write of one of the staging tables counted rows that it should not have."""
    for table in staged:
        found = {k: n for k, n in tables.observed(lake.spark, lake.table(table)).items() if n}
        if found:
            raise PromotionRefused(table, found)


# -- bronze -------------------------------------------------------------------


def bronze_to_staging(lake: Lake, load_date: str, postings: DataFrame | None) -> dict:
    """Stage the extracted postings (see ``sources.pages``) as JSON lines."""
    if postings is None:
        raise ValueError("staging bronze needs the extracted postings")
    raw_jobs.write_raw_jobs(postings, lake.staged_raw, load_date)
    staged = raw_jobs.read_raw_jobs(lake.spark, lake.staged_raw, load_date).count()
    return {"jobs_staged": staged, "load_date": load_date}


def promote_bronze(lake: Lake, load_date: str) -> dict:
    rows = raw_jobs.publish_partition(lake.spark, lake.staged_raw, lake.bronze_raw, load_date)
    return {"promoted_rows": rows, "load_date": load_date}


# -- silver -------------------------------------------------------------------


def build_silver(lake: Lake, raw: DataFrame) -> dict[str, DataFrame]:
    moment = None if lake.processed_at is None else F.lit(lake.processed_at).cast("timestamp")
    jobs = silver.silver_jobs(
        raw, raw_jobs.FILE_ORDER, moment, fix_cpp=lake.fix_cpp, fix_separators=lake.fix_separators,
        keep_null_urls=lake.keep_null_urls,
    )
    return {"jobs": jobs, "companies": silver.silver_companies(raw)}


def silver_to_staging(lake: Lake, load_date: str) -> dict:
    """Stage curated jobs and companies; the input is counted while the jobs are written."""
    raw = raw_jobs.read_raw_jobs(lake.spark, lake.bronze_raw, load_date, with_order=True, one_form=lake.one_form)
    seen = Observation()
    jobs = build_silver(lake, raw.observe(seen, F.count(F.lit(1)).alias("rows")))["jobs"]
    batch = {"jobs": jobs, "companies": build_silver(lake, raw)["companies"]}
    keys = {k: [] if k == "jobs" and lake.keep_null_urls else [SILVER_KEYS[k]] for k in batch}
    staged = {k: _stage(lake, df, SILVER_STAGING[k], keys[k]) for k, df in batch.items()}
    read = seen.get.get("rows") or 0
    return {
        "jobs_read": read,
        "jobs_staged": staged["jobs"],
        "jobs_duplicate": read - staged["jobs"],
        "companies_read": read,
        "companies_staged": staged["companies"],
        "companies_duplicate": read - staged["companies"],
        "load_date": load_date,
    }


def promote_silver(lake: Lake, load_date: str) -> dict:
    batch = {kind: tables.read_table(lake.spark, lake.table(table)) for kind, table in SILVER_STAGING.items()}
    _gate(lake, *SILVER_STAGING.values())
    result: dict = {"load_date": load_date}
    for kind, table in SILVER_TABLES.items():
        staged = batch[kind]
        if kind == "jobs" and lake.keep_null_urls:
            staged = _without_stored_null_keys(lake, staged)
        result[f"{kind}_loaded"] = tables.upsert_table(staged, lake.table(table), SILVER_KEYS[kind], lake.key_buckets)
    return result


def _without_stored_null_keys(lake: Lake, staged: DataFrame) -> DataFrame:
    """Staged jobs without the null-URL rows an earlier attempt of this promotion already stored."""
    name = lake.table(SILVER_TABLES["jobs"])
    if not tables.table_exists(lake.spark, name):
        return staged
    unkeyed = F.col("job_url").isNull()
    stored = tables.read_table(lake.spark, name, allow_empty=True).where(unkeyed)
    return staged.where(~unkeyed).unionByName(staged.where(unkeyed).exceptAll(stored))


# -- gold ---------------------------------------------------------------------


def _silver(lake: Lake, kind: str) -> DataFrame:
    return tables.read_table(lake.spark, lake.table(SILVER_TABLES[kind]), allow_empty=True)


def dimensions_to_staging(lake: Lake, load_date: str) -> dict:
    bounds = star.date_bounds(lake.spark, lake.calendar_start)
    built = star.build_dimensions(_silver(lake, "jobs"), _silver(lake, "companies"), bounds)
    return {t: _stage(lake, built[t], f"staging.gold_{t}", ["id"]) for t in DIMENSIONS}


def promote_dimensions(lake: Lake, load_date: str) -> dict:
    staged = {t: tables.read_table(lake.spark, lake.table(f"staging.gold_{t}")) for t in DIMENSIONS}
    _gate(lake, *[f"staging.gold_{t}" for t in DIMENSIONS])
    return {
        t: tables.upsert_table(
            staged[t], lake.table(f"gold.{t}"), "id", lake.key_buckets if t in LARGE_DIMENSIONS else None,
        )
        for t in DIMENSIONS
    }


def fact_to_staging(lake: Lake, load_date: str) -> dict:
    built = star.build_facts(_silver(lake, "jobs"), fix_onsite=lake.fix_onsite)
    return stage_facts(lake, built)


def stage_facts(lake: Lake, built: dict[str, DataFrame]) -> dict:
    """Stage facts and bridge rows. Keys that the gold dimensions do not know are counted while the rows are written.

    Each dimension is joined by its key alone, which it has once, so no row is lost or doubled.
    """
    keys = {
        "fact_hiring": (["id"], star.FACT_FOREIGN_KEYS),
        "bridge_tech_fact": (["fact_id"], {"techstack_id": "dim_techstack"}),
    }
    result = {}
    for t in FACTS:
        checked, orphans = built[t], {}
        for key, dimension in keys[t][1].items():
            mark = f"{tables.CHECKED}{key}"
            known = tables.read_table(lake.spark, lake.table(f"gold.{dimension}"), allow_empty=True)
            known = known.select(F.col("id").alias(key), F.lit(True).alias(mark))
            checked = checked.join(known, key, "left")
            orphans[f"{key} without {dimension}"] = F.col(mark).isNull()
        columns = [*built[t].columns, *[c for c in checked.columns if c.startswith(tables.CHECKED)]]
        result[t] = _stage(lake, checked.select(*columns), f"staging.gold_{t}", keys[t][0], True, **orphans)
    return result


def promote_fact(lake: Lake, load_date: str) -> dict:
    """Append facts and bridge rows, or replace those of the staged facts with ``idempotent_facts``.

    Refused with ``PromotionRefused`` if staging counted rows without key or with
    a key that no dimension has.  Facts are built from all of silver, so appending adds every known job again
    on every day.  Each day's rows are kept apart: promoting a day once more
    replaces what it appended before.
    """
    staged = {t: tables.read_table(lake.spark, lake.table(f"staging.gold_{t}"), allow_empty=True) for t in FACTS}
    _gate(lake, *[f"staging.gold_{t}" for t in FACTS])
    names = {t: lake.table(f"gold.{t}") for t in FACTS}
    if not lake.idempotent_facts:
        return {t: tables.append_table(staged[t], names[t], run=load_date) for t in FACTS}
    facts = staged["fact_hiring"]
    # Facts without technology lose their bridge rows.
    keys = facts.select(F.col("id").alias("fact_id"))
    bridge = staged["bridge_tech_fact"].distinct()
    return {
        "fact_hiring": tables.upsert_table(facts, names["fact_hiring"], "id", lake.key_buckets),
        "bridge_tech_fact": tables.replace_by_key(bridge, keys, names["bridge_tech_fact"], "fact_id", lake.key_buckets),
    }


# -- entry point --------------------------------------------------------------


def clean_staging(lake: Lake, load_date: str) -> dict:
    """Empty all staging tables, keeping their schemas, and remove all staged raw files."""
    cleared = tables.clear_tables(lake.spark, [lake.table(t) for t in STAGING_TABLES])
    raw_jobs.clear_staged(lake.spark, lake.staged_raw)
    return {"tables_cleared": cleared, "load_date": load_date}


Step = Callable[[Lake, str], dict]

STEPS: dict[str, dict[str, list[Step]]] = {
    "bronze": {"process_to_staging": [], "promote": [promote_bronze], "all": [promote_bronze]},
    "silver": {
        "process_to_staging": [silver_to_staging],
        "promote": [promote_silver],
        "all": [silver_to_staging, promote_silver],
    },
    "gold": {
        "dimensions": [dimensions_to_staging, promote_dimensions],
        "dimensions_to_staging": [dimensions_to_staging],
        "promote_dimensions": [promote_dimensions],
        "fact": [fact_to_staging, promote_fact],
        "fact_to_staging": [fact_to_staging],
        "promote_fact": [promote_fact],
        "load": [],  # gold tables are complete once promoted
        "all": [dimensions_to_staging, promote_dimensions, fact_to_staging, promote_fact],
    },
    "staging": {"clean": [clean_staging]},
}


def run(lake: Lake, layer: str, load_date: str, step: str = "all", postings: DataFrame | None = None) -> dict:
    """Run one step of a layer, or all of them, and return what each did.

    ``postings`` is needed to stage bronze: the postings extracted from the day's
    landed pages.
    """
    if layer not in STEPS:
        raise ValueError(f"invalid layer {layer!r}; one of {sorted(STEPS)}")
    if step not in STEPS[layer]:
        raise ValueError(f"invalid {layer} step {step!r}; one of {sorted(STEPS[layer])}")
    datetime.strptime(load_date, "%Y-%m-%d")
    tables.ensure_namespaces(lake.spark, f"{lake.raw_root.rstrip('/')}/warehouse", lake.prefix)
    results = {}
    if layer == "bronze" and step in ("process_to_staging", "all"):
        results["bronze_to_staging"] = bronze_to_staging(lake, load_date, postings)
    for operation in STEPS[layer][step]:
        results[operation.__name__] = operation(lake, load_date)
    return results
