"""What several corpus operators share: sampling, written intermediate tables, and fold assignment."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.session import work_path

#: The separators of words, lines' margins and sizes, as the inside of a regular expression class.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
FOLDS = 5


#: Texts handed to Python at a time. Whole texts may be long, and Spark's own bound counts rows only.
BATCH_ROWS = 500


def in_small_batches(function: Callable) -> Callable:
    """Let a job's first argument, the session, hand few texts to Python at a time: memory stays bounded by them."""

    @wraps(function)
    def run(spark: SparkSession, *arguments):
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if int(spark.conf.get(setting)) not in range(1, BATCH_ROWS + 1):
            spark.conf.set(setting, BATCH_ROWS)
        return function(spark, *arguments)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """The fold of a document, 0 to 4; fold 0 is held out. A null id belongs to no fold, so it is never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, read back: a cut in the lineage that outlives a lost executor."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, groups: str, rows: int, by: Sequence[str], columns: Sequence[Column | str]) -> list:
    """About ``rows`` rows of each value of ``groups`` on the driver, at most one and a half times as many.

    Rows are counted first, then kept where a hash of ``by`` falls below the share wanted, so that nothing but the
    sample is moved, however large or uneven the groups are. Equal rows of ``by`` stand or fall together. ``columns``
    must be of bounded size. The order of the result is fixed.
    """
    counts = {r[0]: r[1] for r in df.groupBy(groups).count().collect() if r[0] is not None}
    if not counts:
        return []
    draw = F.pmod(F.xxhash64(F.lit("sample"), *by), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
    share = F.create_map(*[F.lit(x) for value, n in sorted(counts.items()) for x in (value, min(1.0, 1.2 * rows / n))])
    drawn = df.where(F.col(groups).isNotNull()).where(draw < share[F.col(groups)])
    found = drawn.select(F.col(groups).alias("_group"), draw.alias("_draw"), *columns).collect()
    kept, taken = [], dict.fromkeys(counts, 0)
    for row in sorted(found, key=lambda r: (r["_group"], r["_draw"], [str(x) for x in r[2:]])):
        if taken[row["_group"]] < rows * 1.5:
            taken[row["_group"]] += 1
            kept.append(row)
    return kept


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, features: Column, doc_id: str = "doc_id",
    usable: Column | None = None,
) -> tuple[list[tuple[int, tuple]], dict[int, int]]:
    """(label, features) of about ``rows`` labelled documents of each class 0 and 1, and the rows of each class.

    The sample is drawn from the narrow label table; the few ids drawn, at most one and a half times ``rows`` a class,
    are then met with the documents, so that no text moves but the features of the sample. Held-out documents are
    never drawn: those of fold 0, or the rows of ``labels`` that ``usable`` leaves out. A document labelled twice counts once, with its greatest label.
    """
    usable = fold(doc_id) != 0 if usable is None else usable
    known = labels.where(F.col(label).isin(0, 1)).where(usable).groupBy(doc_id).agg(F.max(label).cast("int").alias("_label"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    drawn = bounded_sample(known, "_label", rows, [doc_id], [F.col(doc_id).alias("_id")])
    ids = docs.sparkSession.createDataFrame([(r["_id"], r["_group"]) for r in drawn], "_id long, _label int")
    met = docs.join(F.broadcast(ids), docs[doc_id] == ids["_id"])
    found = met.select("_id", "_label", features.alias("_features")).collect()
    found.sort(key=lambda r: (r["_id"], r["_label"]))
    return [(r["_label"], r["_features"]) for r in found], counts
