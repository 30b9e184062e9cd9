"""What to crawl, and the selector configuration of the sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.functions.vocab import CRAWL_ROLE_SLUGS
from jobmart.sources.pages import CONFIG_FIELDS, REQUIRED_FIELDS

CONFIG_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in CONFIG_FIELDS])


def crawl_frontier(sources: DataFrame, role_slugs: Sequence[str] = CRAWL_ROLE_SLUGS) -> DataFrame:
    """Every listing URL: per source one row per role and page.

    ``sources`` has source_name, url_template and end_page; the template may name
    ``{role_slug}``, ``{role_query}`` and ``{page}``.  Roles are a short constant
    list, so both expansions are plain explodes of a row and nothing is shuffled.
    """
    pages = F.sequence(F.lit(1), F.greatest(F.lit(1), F.coalesce("end_page", F.lit(1)).cast("int")))
    roles = F.array(*map(F.lit, role_slugs))
    expanded = sources.withColumn("role_slug", F.explode(roles)).withColumn("page", F.explode(pages))
    role = F.replace(F.col("role_slug"), F.lit("-"), F.lit(" "))
    url = F.col("url_template")
    for name, value in {
        "role_slug": F.col("role_slug"),
        "role_query": F.url_encode(role),
        "page": F.col("page").cast("string"),
    }.items():
        url = F.replace(url, F.lit("{" + name + "}"), value)
    return expanded.select("source_name", role.alias("role"), "page", url.alias("url"))


def sources_missing_config(sources: DataFrame, configs: DataFrame) -> DataFrame:
    """Sources without a complete selector configuration.

    Complete means that the required fields are neither null nor empty; the
    others may be null.  An empty URL prefix is therefore incomplete.  A config
    table whose schema lacks a field has no complete row at all.
    """
    if set(CONFIG_FIELDS) - set(configs.columns):
        return sources
    complete = configs
    for field in REQUIRED_FIELDS:
        complete = complete.where(F.length(field) > 0)
    return sources.join(complete.select("source_name").distinct(), "source_name", "left_anti")


def load_source_configs(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Selector configurations from JSON documents: a list, or ``source_configs`` holding a list or an object.

    A file is one document, or every line is one (as ``write_source_configs``
    leaves them).  The shape is settled per document inside the plan.
    """
    document = spark.read.text(path, wholetext=not one_per_line)
    one = CONFIG_SCHEMA.simpleString()
    wrapped = F.get_json_object("value", "$.source_configs")
    body = F.when(F.col("value").rlike(r"^\s*\["), F.col("value")).otherwise(wrapped)
    as_list = F.from_json(body, f"array<{one}>")
    as_map = F.map_values(F.from_json(body, f"map<string,{one}>"))
    configs = F.when(F.ltrim(body).startswith("["), as_list).otherwise(as_map)
    return document.select(F.explode(configs).alias("c")).select("c.*")


def write_source_configs(configs: DataFrame, path: str) -> None:
    """Write configurations ordered by source name, one ``{"source_configs": [...]}`` document per line.

    The order is a range-partitioned sort, so nothing is gathered in one place.
    """
    fields = F.struct(*CONFIG_FIELDS)
    text = F.to_json(F.struct(F.array(fields).alias("source_configs")), {"ignoreNullFields": "false"})
    ordered = configs.select(*CONFIG_FIELDS).orderBy("source_name")
    ordered.select(text.alias("value")).write.mode("overwrite").text(path)


def normalise_config(configs: DataFrame) -> DataFrame:
    """The fields of a configuration in order, missing ones null and a missing URL prefix empty."""
    columns = [
        (F.col(f) if f in configs.columns else F.lit(None)).cast("string").alias(f) for f in CONFIG_FIELDS
    ]
    return configs.select(*columns).withColumn("prefix_job_url", F.coalesce("prefix_job_url", F.lit("")))
