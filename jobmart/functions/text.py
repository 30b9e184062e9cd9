"""Recognisers for noisy English and Vietnamese posting text.

All functions take and return Columns.  Text is compared in lower case with
null read as empty, and is expected in Unicode NFC.

Conventions shared by the patterns:

* a word boundary is "not an ASCII letter, digit or underscore", written as
  look-arounds;
* white space is spelled out, because the Java class ``\\s`` also holds the
  vertical tab;
* repetitions are possessive wherever what follows cannot start with the
  repeated class, so a long run of separators costs one scan and not a
  quadratic search.

Long text is searched once per field: ``_candidates`` collects the phrases that
occur, with look-aheads so that none hides another and with the alternatives in
priority order, and the ordered label tests then run on those few characters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart.functions import vocab
from jobmart.functions.matching import BOUNDARY_AFTER, BOUNDARY_BEFORE, KeywordSet, let, starting_with

SEPARATOR = r"[ \t\n\f\r._/+:\-]"
GAP = SEPARATOR + "*+"
# A separator run that holds at least one hyphen.
_HYPHEN_GAP = r"[ \t\n\f\r._/+:]*+-" + GAP
_CANDIDATE_JOINER = "|"  # neither a word character nor a separator


def phrase_pattern(phrases: Sequence[str]) -> str:
    """Alternation of phrases in which a space is any run of separators."""
    return "|".join(p.replace(" ", GAP) for p in phrases)


def _search_pattern(phrases: Sequence[str]) -> str:
    """The same alternation made for searching: look-ahead for a first letter, grouped by it.

    Only phrases of one first letter can compete at a position, so grouping
    leaves their priority as it is.
    """
    groups: dict[str, list[str]] = {}
    for phrase in phrases:
        groups.setdefault(phrase[0], []).append(phrase[1:])
    grouped = "|".join(f"{first}(?:{phrase_pattern(rest)})" for first, rest in groups.items())
    return f"{starting_with(''.join(groups))}{BOUNDARY_BEFORE}(?=({grouped}){BOUNDARY_AFTER})"


def bounded(pattern: str) -> str:
    return f"{BOUNDARY_BEFORE}(?:{pattern}){BOUNDARY_AFTER}"


def normalised(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def is_unknown_like(text: Column) -> Column:
    return F.lower(F.trim(F.coalesce(text, F.lit("")))).isin(vocab.UNKNOWN_LIKE)


# -- fallback combinators ---------------------------------------------------


def known_text_or(raw: Column, fallback: Column) -> Column:
    """Trimmed raw text, or the fallback when the raw text is unknown-like."""
    return F.coalesce(F.when(~is_unknown_like(raw), F.trim(raw)), fallback)


def known_value_or(primary: Column, fallback: Column) -> Column:
    """Primary value as it is, or the fallback when the primary is unknown-like."""
    return F.coalesce(F.when(~is_unknown_like(primary), primary), fallback)


def known_label_or(raw: Column, raw_label: Column, fallback: Column) -> Column:
    """Label of a raw field, or the fallback when the raw field is unknown-like or has no label."""
    return F.coalesce(F.when(~is_unknown_like(raw), F.nullif(raw_label, F.lit(""))), fallback)


# -- first label in priority order -------------------------------------------

Phrases = Mapping[str, Sequence[str]]  # label -> phrases, in priority order


def _first_arm(text: Column, arms: Sequence[tuple[str, str]]) -> Column:
    return F.coalesce(*[F.when(text.rlike(bounded(pattern)), F.lit(label)) for label, pattern in arms])


def _candidates(text: Column, search_pattern: str) -> Column:
    """Everything the pattern's group finds in the text, joined; at one start the alternative that comes first."""
    return F.array_join(F.regexp_extract_all(text, F.lit(search_pattern), F.lit(1)), _CANDIDATE_JOINER)


def first_label(text: Column, phrases: Phrases, long_text: bool = True) -> Column:
    """First label, in priority order, with a phrase that occurs in the normalised text; else null."""
    arms = [(label, phrase_pattern(group)) for label, group in phrases.items()]
    if not long_text:
        return _first_arm(text, arms)
    search = _search_pattern([phrase for group in phrases.values() for phrase in group])
    return let(_candidates(text, search), lambda found: _first_arm(found, arms))


def _label_field(raw: Column, description: Column, phrases: Phrases, fallback: Column) -> Column:
    own = first_label(normalised(raw), phrases, long_text=False)
    return known_label_or(raw, own, F.coalesce(first_label(description, phrases), fallback))


def employment_type(raw: Column, description: Column, default: str = "FULL_TIME") -> Column:
    """Employment type of the raw field, else of the (normalised) description, else the default."""
    return _label_field(raw, description, vocab.EMPLOYMENT_PHRASES, F.lit(default))


def location_type(raw: Column, description: Column, default: str = "ON_SITE") -> Column:
    """Work location of the raw field, else of the (normalised) description, else the default."""
    return _label_field(raw, description, vocab.LOCATION_PHRASES, F.lit(default))


def seniority_level(raw: Column, description: Column, default: str = "Unknown") -> Column:
    """Level of the raw field, else keywords of the description, else its years of experience."""
    return _label_field(raw, description, vocab.SENIORITY_PHRASES, experience_level(description, default))


# -- years of experience ------------------------------------------------------


@cache
def _experience_arms() -> tuple[tuple[str, str], ...]:
    experience = phrase_pattern(vocab.EXPERIENCE_WORDS)
    context = f"(?:(?:{'|'.join(vocab.YEAR_WORDS)}){GAP}(?:of{GAP})?(?:{experience})|(?:{experience}))"

    def years(low: int, high: int) -> str:
        # The hyphen is itself a separator, so it needs an alternative of its own.
        between = f"(?:{_HYPHEN_GAP}|{GAP}(?:~|to|den|đến){GAP})"
        return f"{low}{between}{high}{GAP}{context}"

    def amount(number: str) -> str:
        # "+" is a separator as well, hence only "plus" has to be named.  Separators may
        # follow the number; only the underscore among them is a word character.
        return f"(?:{number}){GAP}(?:plus{GAP})?{context}|{context}{GAP}(?:{number})(?:_*+|{GAP}plus)"

    return (
        ("Entry", years(0, 1)),
        ("Junior", years(1, 2)),
        ("Mid-Level", years(2, 4)),
        ("Senior", amount("[4-9]|[1-9][0-9]")),
        ("Mid-Level", amount("[23]")),
        ("Junior", amount("1")),
        ("Entry", amount("0")),
    )


def experience_level(description: Column, default: str = "Unknown") -> Column:
    """Level that goes with the years of experience asked for in the (normalised) text.

    Every pattern needs a word of experience, and looking for the start of one
    is some fifty times cheaper than the pattern search it saves.
    """
    arms = _experience_arms()
    search = f"{BOUNDARY_BEFORE}(?=({'|'.join(pattern for _, pattern in arms)}){BOUNDARY_AFTER})"
    heads = sorted({word[:3] for word in vocab.EXPERIENCE_WORDS})
    mentioned = reduce(or_, [description.contains(head) for head in heads])
    found = F.when(mentioned, let(_candidates(description, search), lambda c: _first_arm(c, arms)))
    return F.coalesce(found, F.lit(default))


# -- salary -----------------------------------------------------------------


@cache
def salary_pattern() -> str:
    number = "[0-9]++(?:[.,][0-9]++)?+"
    money = f"(?:[{vocab.SALARY_CURRENCIES}]{GAP})?{number}"
    unit = f"(?:{'|'.join(vocab.SALARY_UNITS)})"
    range_words = f"(?:{'|'.join(vocab.SALARY_RANGE_WORDS)})"
    prefix = f"(?:{phrase_pattern(vocab.SALARY_PREFIXES)})"
    to_money = f"{GAP}{range_words}{GAP}{money}"
    unit_opt = f"(?:{GAP}{unit})?"
    # A number that could start one digit earlier would have matched there.
    first_number = f"(?<![0-9]){number}"
    phrases = "|".join([
        f"{prefix}{GAP}{money}(?:{to_money})?{unit_opt}",
        f"[{vocab.SALARY_CURRENCIES}]{GAP}{number}(?:{to_money})?{unit_opt}",
        f"{first_number}{GAP}{unit}(?:{to_money}{GAP}{unit}?)?",
        f"{first_number}{to_money}{unit_opt}",
        phrase_pattern(vocab.SALARY_WORDS),
    ])
    words = [*vocab.SALARY_PREFIXES, *vocab.SALARY_WORDS]
    first_letters = "".join(w[0] for w in words) + vocab.SALARY_CURRENCIES + "0123456789"
    return f"{starting_with(first_letters)}(?:{phrases})"


def salary_phrase(raw: Column, description: Column, default: str = "Unknown") -> Column:
    """Raw salary, else the first salary-like phrase of the (normalised) description, else the default."""
    # Every phrase but the plain words has a digit; looking for either is much cheaper than the search it saves.
    heads = sorted({word.split(" ")[0] for word in vocab.SALARY_WORDS})
    mentioned = reduce(or_, [description.contains(head) for head in heads], description.rlike("[0-9]"))
    found = F.when(mentioned, F.nullif(F.regexp_extract(description, salary_pattern(), 0), F.lit("")))
    return known_text_or(raw, F.coalesce(found, F.lit(default)))


# -- roles, keys, numbers ---------------------------------------------------


@cache
def _role_aliases() -> tuple[KeywordSet, tuple[str, ...]]:
    pairs = [(alias, role) for role, aliases in vocab.ROLE_ALIASES.items() for alias in aliases]
    return KeywordSet([alias for alias, _ in pairs]), tuple(role for _, role in pairs)


def canonical_role(title: Column, default: str = "Unknown") -> Column:
    """Canonical label of the first role alias found in a (normalised) title."""
    aliases, labels = _role_aliases()
    return aliases.match_first(title, default, labels)


def slug(name: Column) -> Column:
    """Lower case, runs of anything but ASCII letters and digits as one hyphen, ``unknown`` when empty."""
    hyphenated = F.regexp_replace(F.lower(F.trim(name)), r"[^\p{Alnum}]+", "-")
    return F.coalesce(F.nullif(F.btrim(hyphenated, F.lit("-")), F.lit("")), F.lit("unknown"))


def slug_md5_key(name: Column) -> Column:
    return F.md5(slug(name))


def lenient_int(text: Column, default: int = 0) -> Column:
    """Integer value of a number text, rounded half away from zero, else the default.

    A plain ``try_cast`` to int would turn fractions and exponents into null.
    """
    # Digits after the first of a fraction do not change how it is rounded, but could be rounded up to one that does.
    short = F.when(text.rlike("[eE]"), text).otherwise(F.regexp_replace(text, r"(\.[0-9])[0-9]+", "$1"))
    number = F.round(short.try_cast("decimal(38,18)")).try_cast("int")
    return F.coalesce(number, F.lit(default))
