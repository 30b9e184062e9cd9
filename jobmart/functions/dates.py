"""Posting dates and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart.functions import vocab
from jobmart.functions.text import GAP, bounded, phrase_pattern

# What counts as an absolute date before the named formats are tried: a partial
# date such as "2026" or "2026-05" must not be completed to its first day.
_PLAIN_DATE = r"^[0-9]+-[0-9]{1,2}-[0-9]{1,2}$"
_DATE_AND_TIME = r"^[0-9]+-[0-9]{1,2}-[0-9]{1,2}[ T]"
_SPACED_DATE = r"^[0-9]+ [0-9]{1,2} [0-9]{1,2}$"
_DATE_FORMATS = ["d-M-yyyy", "d/M/yyyy", "yyyy-M-d", "yyyy/M/d"]

_OUTPUT_FORMAT = "dd-MM-yyyy"


def _ago(words: list[str]) -> str:
    return f"([0-9]+){GAP}(?:{phrase_pattern(words)}){GAP}(?:{phrase_pattern(vocab.AGO_WORDS)})"


def _relative(text: Column, processed_at: Column) -> Column:
    none = F.lit(0)

    def amount(words: list[str]) -> Column:
        return F.regexp_extract(text, _ago(words), 1).try_cast("int")

    def before(**parts: Column) -> Column:
        return processed_at - F.make_dt_interval(
            parts.get("days", none), parts.get("hours", none), parts.get("mins", none)
        )

    return (
        F.when(text.rlike(_ago(vocab.MINUTE_WORDS)), before(mins=amount(vocab.MINUTE_WORDS)))
        .when(text.rlike(_ago(vocab.HOUR_WORDS)), before(hours=amount(vocab.HOUR_WORDS)))
        .when(text.rlike(_ago(vocab.DAY_WORDS)), before(days=amount(vocab.DAY_WORDS)))
        .when(
            text.rlike(_ago(vocab.WEEK_WORDS)),
            before(days=F.try_multiply(amount(vocab.WEEK_WORDS), F.lit(7))),
        )
        .when(
            text.rlike(bounded(phrase_pattern(vocab.YESTERDAY_PHRASES))),
            processed_at - F.make_dt_interval(F.lit(1)),
        )
        # "today" and everything not understood mean the processing day.
        .otherwise(processed_at)
    )


def posted_date(raw: Column, processed_at: Column) -> Column:
    """Absolute or relative posting date as ``dd-MM-yyyy``; the processing day when not understood."""
    text = F.nullif(F.trim(raw), F.lit(""))
    year = F.split_part(text, F.lit("-"), F.lit(1))
    # A year of fewer than four digits is taken literally: 26-05-01 is in year 26.
    padded = F.concat(F.repeat(F.lit("0"), F.lit(4) - F.length(year)), text)
    absolute = [
        F.when(text.rlike(_PLAIN_DATE), padded.try_cast("date")),
        F.when(text.rlike(_DATE_AND_TIME) & padded.try_cast("timestamp").isNotNull(), padded.try_cast("date")),
        F.when(text.rlike(_SPACED_DATE), F.try_to_date(text, "yyyy M d")),
        *[F.try_to_date(text, f) for f in _DATE_FORMATS],
    ]
    relative = _relative(F.lower(F.trim(F.coalesce(raw, F.lit("")))), processed_at)
    return F.date_format(F.coalesce(*absolute, F.to_date(relative)), _OUTPUT_FORMAT)


def date_key(moment: Column) -> Column:
    """Day of a timestamp as ``yyyyMMdd`` text."""
    return F.date_format(F.to_date(moment), "yyyyMMdd")
