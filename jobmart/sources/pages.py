"""Listing and detail pages to raw postings, parsed on the executors."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.sources import html
from jobmart.sources.raw_jobs import RAW_COLUMNS

# The parser travels with the task, so executors need no installation of this package.
cloudpickle.register_pickle_by_value(html)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fields of a selector configuration, and those read from a listing item.
CONFIG_FIELDS = [
    "source_name", "title", "company", "company_location", "location_working_type", "working_type",
    "date_posted", "number_applicants", "prefix_job_url", "job_url", "description", "salary", "role", "level",
]
REQUIRED_FIELDS = ["source_name", "title", "prefix_job_url", "job_url"]
LISTING_FIELDS = [f for f in CONFIG_FIELDS if f not in ("source_name", "prefix_job_url", "description")]

# Rows handed back to Spark at a time: items are small, pages may hold many.
_CHUNK = 1000


# The selectors that ``sources.html`` understands, as a pattern for Column tests.
_PART = r"""(?:[.#][\w-]+|\[\s*[\w:-]+\s*(?:[\^*$]?=\s*(?:"[^"]*"|'[^']*'|[^\]\s]+)\s*)?\])"""
_COMPOUND = rf"(?:(?:\*|[A-Za-z][\w-]*){_PART}*|{_PART}+)"
_CHAIN = rf"{_COMPOUND}(?:(?:\s*>\s*|\s+){_COMPOUND})*"
_SUPPORTED = rf"(?U)^\s*{_CHAIN}(?:\s*,\s*{_CHAIN})*\s*$"


def is_supported(selector: Column) -> Column:
    """Whether a selector can be used; an empty one, or none, needs no support."""
    return F.coalesce((F.trim(selector) == "") | selector.rlike(_SUPPORTED), F.lit(True))


def _css(spec: Column) -> Column:
    """The selector in a field specification."""
    return F.when(F.ltrim(spec).startswith("["), spec).otherwise(F.regexp_replace(spec, "@[^@]*$", ""))


def config_problems(sources: DataFrame, configs: DataFrame) -> DataFrame:
    """What keeps sources from being read: a row of source_name, field, value and problem for each fault.

    ``sources`` has source_name, entry_point and detail_entry_point, ``configs``
    has ``CONFIG_FIELDS``.  Problems are ``missing`` (a required value, or the
    whole configuration, whose field is then null) and ``unsupported``.
    """
    def rows(table: DataFrame, fields: list[str], required: list[str], css) -> DataFrame:
        tests = [
            F.struct(
                F.lit(f).alias("field"), F.col(f).cast("string").alias("value"),
                F.when(F.coalesce(F.length(f), F.lit(0)) == 0, F.lit("missing" if f in required else None))
                .when(~is_supported(css(F.col(f))), F.lit("unsupported")).alias("problem"),
            )
            for f in fields
        ]
        found = table.select("source_name", F.explode(F.array(*tests)).alias("t"))
        return found.select("source_name", "t.*").where(F.col("problem").isNotNull())

    entries = rows(sources, ["entry_point", "detail_entry_point"], ["entry_point"], lambda c: c)
    selectors = [f for f in CONFIG_FIELDS if f not in ("source_name", "prefix_job_url")]
    known = configs.join(sources.select("source_name"), "source_name", "left_semi")
    fields = rows(known, selectors, REQUIRED_FIELDS, _css).unionByName(
        rows(known, ["prefix_job_url"], REQUIRED_FIELDS, lambda c: F.lit(None).cast("string"))
    )
    absent = sources.join(configs.select("source_name"), "source_name", "left_anti").select(
        "source_name", F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"),
        F.lit("missing").alias("problem"),
    )
    return entries.unionByName(fields).unionByName(absent)


def explode_listing_items(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per element that matches the entry selector of the page's source.

    ``pages`` has page_id, source_name, url and html; ``sources`` has source_name
    and entry_point.  Pages without html or selector, and pages that cannot be
    parsed, give no rows, nor do sources whose selector is not supported:
    ``config_problems`` reports these, and all other sources are read.  Store the
    table of sources, so that Spark knows its size and broadcasts a small one.
    """
    usable = (F.length("entry_point") > 0) & is_supported(F.col("entry_point"))
    entries = sources.select("source_name", "entry_point").where(usable)
    joined = pages.where(F.length("html") > 0).join(entries, "source_name")

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        selectors: dict[str, html.Selector] = {}
        for batch in batches:
            types = [batch.schema.field(0).type, pa.string(), pa.string(), pa.int32(), pa.string()]
            rows = []
            for page_id, source, url, markup, entry in _rows(batch):
                if entry not in selectors:
                    selectors[entry] = html.Selector(entry)
                root = _parse_or_empty(markup)
                for position, node in enumerate(selectors[entry].select(root)):
                    rows.append((page_id, source, url, position, node.source()))
                    if len(rows) == _CHUNK:
                        yield _batch(rows, columns, types)
                        rows = []
                root.release()
            if rows:
                yield _batch(rows, columns, types)

    columns = ["page_id", "source_name", "url", "item_no", "item_html"]
    page_type = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "source_name", "url", "html", "entry_point").mapInArrow(
        items, f"page_id {page_type}, source_name string, url string, item_no int, item_html string"
    )


def extract_fields(items: DataFrame, configs: DataFrame) -> DataFrame:
    """The listing fields of every item by the selectors of its source; empty values are null.

    Adds ``LISTING_FIELDS`` to page_id, source_name, url and item_no.  A field
    whose selector is not supported is null; ``config_problems`` reports it.
    Selectors are compiled once per task.
    """
    usable = [F.when(is_supported(_css(F.col(f).cast("string"))), F.col(f).cast("string")).alias(f) for f in LISTING_FIELDS]
    selector_table = configs.select("source_name", F.to_json(F.struct(*usable)).alias("selectors"))
    joined = items.join(selector_table, "source_name")
    fields = list(LISTING_FIELDS)

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        compiled: dict[str, list[html.Field]] = {}
        for batch in batches:
            rows = []
            for markup, selectors in zip(batch["item_html"], batch["selectors"], strict=True):
                if selectors not in compiled:
                    specs = json.loads(selectors)
                    compiled[selectors] = [html.Field(specs.get(f)) for f in fields]
                root = _parse_or_empty(markup)
                rows.append([field.value(root) for field in compiled[selectors]])
                root.release()
            kept = batch.drop(columns=["item_html", "selectors"]).reset_index(drop=True)
            yield pd.concat([kept, pd.DataFrame(rows, columns=fields, dtype="object")], axis=1)

    page_type = items.schema["page_id"].dataType.simpleString()
    schema = f"page_id {page_type}, source_name string, url string, item_no int, "
    schema += ", ".join(f"{f} string" for f in fields)
    return joined.select("page_id", "source_name", "url", "item_no", "item_html", "selectors").mapInPandas(
        values, schema
    )


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, one at a time: only one page's markup is a Python text at once."""
    return (tuple(column[i].as_py() for column in batch.columns) for i in range(batch.num_rows))


def _batch(rows: list[tuple], columns: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    values = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(values, columns)


def _parse_or_empty(markup: str) -> html.Node:
    try:
        return html.parse(markup)
    except (AssertionError, ValueError):  # what the standard parser raises on hopeless markup
        return html.Node("[document]", {}, None)


# -- URLs ---------------------------------------------------------------------


def resolve_urls(url: Column, prefix: Column) -> Column:
    """A link made absolute against a prefix URL.

    Null and empty links are null, and without a prefix the link stays as it is.
    Blanks and control characters before a link do not count.  Dot segments of
    links without a host of their own are resolved; empty segments go from
    relative links and stay in those from the root.
    """
    given, url = url, F.regexp_replace(url, r"^[\x00-\x20]+", "")
    scheme = F.regexp_extract(prefix, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(prefix, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(prefix, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(prefix, r"^[^#]*?(\?[^#]*)", 1)
    folder = F.when(path.contains("/"), F.regexp_extract(path, "^(.*/)", 1)).otherwise(F.lit("/"))
    own_path, rest = F.regexp_extract(url, "^([^?#]*)", 1), F.regexp_extract(url, "^[^?#]*(.*)$", 1)
    return (
        F.when(F.coalesce(F.length(given), F.lit(0)) == 0, F.lit(None).cast("string"))
        .when(F.coalesce(F.length(prefix), F.lit(0)) == 0, given)
        .when(F.length(url) == 0, prefix)
        .when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), url)
        .when(url.startswith("//"), F.concat(scheme, url))
        .when(url.startswith("/"), F.concat(origin, _without_dots(own_path, r"(?:^|/)\.{1,2}(?:/|$)", lambda x: F.lit(True)), rest))
        .when(url.startswith("?"), F.concat(origin, path, url))
        .when(url.startswith("#"), F.concat(origin, path, query, url))
        .otherwise(F.concat(
            origin, _without_dots(F.concat(folder, own_path), r"(?:^|/)\.{1,2}(?:/|$)|//", lambda x: x != ""), rest
        ))
    )


def _without_dots(path: Column, odd: str, keeps: Callable[[Column], Column]) -> Column:
    """A path from the root without ``.`` and ``..``, and of its inner segments those it ``keeps``; a dot at its end
    leaves a folder.  Paths without a match of ``odd`` stay as they are."""
    split = F.split(path, "/")
    last = F.element_at(split, -1)
    inner = F.filter(F.slice(split, 2, F.greatest(F.size(split) - 2, F.lit(0))), keeps)
    walked = F.aggregate(
        F.concat(inner, F.array(last)), F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(x == ".", done).otherwise(F.concat(done, F.array(x))),
    )
    ended = F.when(last.isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    return F.when(~path.rlike(odd), path).otherwise(F.concat(F.lit("/"), F.array_join(ended, "/")))


# -- detail pages -------------------------------------------------------------


def detail_texts(details: DataFrame, sources: DataFrame) -> DataFrame:
    """Description per detail page: url, source_name, description.

    Text of the first element under the detail selector, the text of the whole
    page when there is none, or the markup itself when the source has no
    selector or one that is not supported.
    """
    usable = F.when(is_supported(F.col("detail_entry_point")), F.col("detail_entry_point"))
    selectors = sources.select("source_name", usable.alias("detail_entry_point"))
    joined = details.where(F.length("html") > 0).join(selectors, "source_name")

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled: dict[str, html.Selector] = {}

        def text(markup: str, selector: str | None) -> str:
            if not selector:
                return markup
            if selector not in compiled:
                compiled[selector] = html.Selector(selector)
            root = _parse_or_empty(markup)
            found = (compiled[selector].first(root) or root).text()
            root.release()
            return found

        for batch in batches:
            for start in range(0, len(batch), _CHUNK):
                part = batch[start : start + _CHUNK]
                found = [text(m, s) for m, s in zip(part["html"], part["detail_entry_point"], strict=True)]
                yield pd.DataFrame({"url": part["url"], "source_name": part["source_name"], "description": found})

    return joined.select("url", "source_name", "html", "detail_entry_point").mapInPandas(
        texts, "url string, source_name string, description string"
    )


#: Bits of the filter of asked pages; its size bounds what is sent to every task (1 MB).
ASKED_BITS = 1 << 23


def asked_filter(items: DataFrame, bits: int = ASKED_BITS) -> Callable[[Column, Column], Column]:
    """A test of (source_name, url) that all pages pass that an item asks for, and few others while these are few.

    It is a bitmap with a bit for the hash of each key: of a fixed size, so more
    keys let more pages pass and never make it greater.
    """
    def place(source: Column, url: Column) -> Column:
        return F.pmod(F.xxhash64(source, url), F.lit(bits))

    keys = items.where("job_url is not null").select(place(F.col("source_name"), F.col("job_url")).alias("place"))
    # Spark's bitmaps have 2 to the power of 15 bits.
    parts = keys.groupBy(F.shiftright("place", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")
    )
    bitmap = bytearray(bits // 8)
    for part, found in parts.collect():  # at most as many as the filter has bits
        bitmap[part << 12 : (part << 12) + len(found)] = found
    sent = items.sparkSession.sparkContext.broadcast(bytes(bitmap))

    @F.pandas_udf("boolean")
    def asked(places: pd.Series) -> pd.Series:
        held, at = np.frombuffer(sent.value, dtype=np.uint8), places.to_numpy()
        return pd.Series((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return lambda source, url: asked(F.coalesce(place(source, url), F.lit(0).cast("long")))


def join_details(items: DataFrame, details: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds to every item the description from the detail page at its job_url.

    Pages that no item asks for are left out where they are read, by a filter of
    bounded size; the others are parsed there, and only their text is shuffled to
    the items.  Items without URL get a key of their own: they match nothing, and
    they spread over all tasks.  ``details`` holds a page (source_name, url, html)
    at most once.
    """
    asked = asked_filter(items)
    texts = detail_texts(details.where(asked(F.col("source_name"), F.col("url"))), sources).select(
        F.col("source_name"), F.col("url").alias("_detail_url"), "description"
    )
    key = F.coalesce(
        F.col("job_url"), F.concat(F.lit("\u0001"), F.monotonically_increasing_id().cast("string"))
    )
    return (
        items.withColumn("_detail_url", key).join(texts, ["source_name", "_detail_url"], "left").drop("_detail_url")
    )


# -- pages to postings --------------------------------------------------------


def extract_postings(
    listings: DataFrame, details: DataFrame, sources: DataFrame, configs: DataFrame
) -> DataFrame:
    """Raw postings of landed pages: the columns of ``raw_jobs.RAW_COLUMNS`` with page_id and item_no.

    Only sources with a complete configuration are read.  Items and their fields
    are taken from the listing pages, job URLs are resolved against the source's
    prefix, and the description is the text of the detail page at that URL.
    ``config_problems`` tells what was left out and why.
    """
    complete = configs
    for field in REQUIRED_FIELDS:
        complete = complete.where(F.length(field) > 0)
    items = explode_listing_items(listings, sources.join(complete.select("source_name"), "source_name", "left_semi"))
    prefixes = complete.select("source_name", "prefix_job_url")
    found = extract_fields(items, complete).join(prefixes, "source_name")
    resolved = found.withColumn("job_url", resolve_urls(F.col("job_url"), F.col("prefix_job_url")))
    described = join_details(resolved, details.select("source_name", "url", "html"), sources)
    return described.select("page_id", "item_no", *RAW_COLUMNS)
