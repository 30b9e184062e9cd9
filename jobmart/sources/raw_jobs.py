"""Raw postings as JSON lines, one folder per load date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.functions.matching import let

# The raw columns, all text.
RAW_COLUMNS = [
    "title", "company", "source_name", "company_location", "location_working_type", "working_type",
    "date_posted", "description", "job_url", "salary", "level", "number_applicants",
]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

# Columns that give the rows of a set of files their reading order.
FILE_ORDER = ["_file", "_block", "_row"]


def partition_path(base: str, load_date: str) -> str:
    return f"{base.rstrip('/')}/load_date={load_date}"


_EXPONENT = "^-?[0-9.]+E-?[0-9]+$"


def plain_number(text: Column) -> Column:
    """A floating-point number's text, in digits alone from 0.0001 up to 10**16 and else with an exponent like ``1e+20``.

    The text is what ``get_json_object`` makes of a JSON number; whole numbers keep their text.
    """
    size = F.abs(text.try_cast("double"))
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(text, r"(\.0)?E.*$", "")
    exponent = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    wide = F.concat(
        mantissa, F.when(exponent < 0, "e-").otherwise("e+"), F.when(F.abs(exponent) < 10, "0").otherwise(""),
        F.abs(exponent).cast("string"),
    )
    shown = F.when((size >= 1e-4) & (size < 1e16), plain).otherwise(wide)
    return F.when(text.rlike(_EXPONENT), shown).otherwise(text)


def json_fields(lines: DataFrame, columns: Sequence[str], line: str = "value") -> DataFrame:
    """``lines`` with the fields of the JSON object in ``line`` as texts instead of it; all null if it holds no object.

    Of a repeated key the first value counts. Numbers and nested values have one form, however they were written:
    ``1.50`` and ``15e-1`` are ``1.5``, and nested values have no spaces. A line is parsed once and its keys are listed
    once, one with repeated keys is parsed once more; only values that need it are looked up again.
    """
    # Two steps, so that what all fields need is worked out once. With an option, Spark keeps the schema whole: one
    # parse serves all fields, instead of one for each.
    keys = F.json_object_keys(line)
    listed = lines.withColumn("_keys", keys).withColumn("_object", F.when(F.col("_keys").isNotNull(), F.col(line)))
    fields = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    repeats = F.coalesce(F.size(F.array_distinct("_keys")) < F.size("_keys"), F.lit(False))
    parsed = listed.select(
        *lines.columns, "_object", "_keys", F.from_json("_object", fields, {"mode": "PERMISSIVE"}).alias("_once"),
        F.when(repeats, F.from_json("_object", "map<string,variant>")).alias("_firsts"), repeats.alias("_repeats"),
    )

    def field(name: str) -> Column:
        value, found = F.col("_once")[name], F.get_json_object("_object", f"$.{name}")
        repeated = F.col("_repeats") & (F.size("_keys") - F.size(F.array_remove("_keys", name)) > 1)
        # The first of several values may be null, which the lookup passes over.
        first = F.try_element_at("_firsts", F.lit(name))
        no_value = F.is_variant_null(first)
        # Inside an array, texts are given with their quotes.
        quoted = F.get_json_object(F.concat(F.lit("["), "_object", F.lit("]")), f"$[*].{name}").startswith('"')
        bare = ~F.coalesce(F.schema_of_variant(first) == "STRING", quoted)
        # Only a number with an exponent has another form, and each look-up is a parse: it is made once.
        shown = let(found, lambda text: F.when(text.rlike(_EXPONENT) & bare, plain_number(text)).otherwise(text))
        other = F.when(repeated & no_value, F.lit(None)).otherwise(shown)
        return F.when(repeated | value.rlike(_EXPONENT), other).otherwise(value).alias(name)

    return parsed.select(*[field(c) for c in columns], *[c for c in lines.columns if c != line])


def read_raw_jobs(spark: SparkSession, base: str, load_date: str, *, with_order: bool = False, one_form: bool = False) -> DataFrame:
    """Postings of one load date.

    The schema is forced, so empty files and missing fields do not change it.  A
    line that is no JSON object becomes a row of nulls and blank lines vanish.
    ``with_order`` adds the columns of ``FILE_ORDER``: file, position of the
    split in it, and the row within the task.  Numbers and nested values are
    texts as they were written, and the last value of a repeated key counts;
    with ``one_form`` they are those of ``json_fields``.  A load date whose publishing was
    interrupted after it was complete is put into its place first.
    """
    finish_publishing(spark, base, load_date)
    path = partition_path(base, load_date)
    order = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]
    order = order if with_order else []
    if not one_form:
        return spark.read.schema(RAW_SCHEMA).option("mode", "PERMISSIVE").json(path).select(*RAW_COLUMNS, *order)
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*$"))
    return json_fields(lines.select("value", *order), RAW_COLUMNS)


def write_raw_jobs(jobs: DataFrame, base: str, load_date: str) -> None:
    """Replace one load date; nulls are written, so every line has every field.

    No postings at all leave an empty file, as a day without results should.
    """
    writer = jobs.select(*RAW_COLUMNS).write.mode("overwrite").option("ignoreNullFields", "false")
    writer.json(partition_path(base, load_date))


def publish_partition(spark: SparkSession, staged: str, target: str, load_date: str) -> int:
    """Copy a staged load date to the target and return its rows; an unstaged date is an error.

    Lines are copied as text, so published files hold exactly what was staged.
    They are written beside the target first and moved into place when they are
    complete, so a job that fails leaves the published day as it was; a failure
    between moves is made good by the next reader or publisher.  Publishing
    replaces the load date, so it can simply be run again.  Staging is cleared
    last and leaves no folder, so a load date that was cleared is an error and
    never an empty day.
    """
    try:
        lines = spark.read.text(partition_path(staged, load_date))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"nothing staged for {load_date} under {staged}") from error
    seen = Observation()
    counted = lines.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").text(_incoming(target, load_date))
    if not finish_publishing(spark, target, load_date):
        raise OSError(f"the writer left no mark that {load_date} is complete under {target}")
    return seen.get.get("rows") or 0


def _incoming(target: str, load_date: str) -> str:
    # Readers of the target pass by folders whose names begin with an underscore.
    return f"{target.rstrip('/')}/_incoming/load_date={load_date}"


def finish_publishing(spark: SparkSession, target: str, load_date: str) -> bool:
    """Move a load date that was completely written into its place, if there is one; whether there was.

    The writer leaves ``_SUCCESS`` as its last file, which marks the folder as complete.  The old day goes only then,
    and the new one is moved as a whole.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    incoming, place = path(_incoming(target, load_date)), path(partition_path(target, load_date))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path(incoming, "_SUCCESS")):
        return False
    files.mkdirs(place.getParent())
    files.delete(place, True)
    if not files.rename(incoming, place):
        raise OSError(f"could not move {incoming} to {place}")
    return True


def clear_staged(spark: SparkSession, staged: str) -> bool:
    """Remove all staged load dates, so that none of them can be published any more; whether there were any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(folder, True)
