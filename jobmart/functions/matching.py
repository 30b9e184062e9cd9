"""Keyword sets matched against free text.

A keyword is found in a text when

* it stands between two non-word characters (word = ASCII letter, digit, ``_``), or
* its compact form (everything but ASCII letters, digits, ``#`` and ``+``
  removed) is longer than four characters and occurs in the compact text.

A pattern search per keyword costs a slow scan of the text each.  Three
observations leave one slow scan for the whole vocabulary:

* a keyword with a long compact form needs only the compact test, because a
  bounded occurrence always survives compaction.  All of them are one pattern
  that is tried only at the letter of each that is the rarest in prose: most
  letters of a text are passed over by one look-up.  The few forms it finds are
  then tested as plain substrings;
* the few short keywords together are one prefix-tree pattern.  It is tried at
  every start through a look-ahead, so overlapping occurrences are seen, and it
  returns the longest keyword at a start; the shorter ones at the same start are
  prefixes of it and are known when the set is built;
* a keyword that is a pattern with backslashes is looked for only in text that
  holds a backslash.

Everything is a built-in Spark expression.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart.functions.vocab import TECH_KEYWORD_FIXES, TECH_KEYWORDS

BOUNDARY_BEFORE = "(?<![A-Za-z0-9_])"
BOUNDARY_AFTER = "(?![A-Za-z0-9_])"
_COMPACT_KEEP = "[A-Za-z0-9#+]++"
_COMPACT_MIN = 5
# Letters from the rarest to the most frequent one in prose; any other character counts as rarer still.
_BY_FREQUENCY = "qzxjkwvybgpfmhcdulnrsotaie"

# First characters that are looked up together.
_GROUP = 4


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def constant(value, type_name: str) -> Column:
    """A list or map literal as one expression, which Spark folds into a constant."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), type_name)


def compact_text(text: Column) -> Column:
    """Only the ASCII letters, digits, ``#`` and ``+`` of a text."""
    # Joining the kept runs is several times faster than regexp_replace of the others.
    return F.array_join(F.regexp_extract_all(text, F.lit(_COMPACT_KEEP), F.lit(0)), "")


def _compact(word: str) -> str:
    return "".join(re.findall("[A-Za-z0-9#+]+", word))


def starting_with(characters: str) -> str:
    """Look-ahead for one of the characters; a cheap test to put before expensive ones."""
    return "(?=[" + "".join(re.escape(c) for c in sorted(set(characters))) + "])"


def _prefix_tree_pattern(words: Sequence[str], separators: bool = False) -> str:
    """One pattern for all words; at a position it prefers the longest. With ``separators`` a space is any run of them."""
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def render(node: dict) -> str:
        branches = [
            (r"\s++" if separators and c == " " else re.escape(c)) + render(child) for c, child in sorted(node.items()) if c
        ]
        if not branches:
            return ""
        if len(branches) == 1 and "" not in node:
            return branches[0]
        return "(?:" + "|".join(branches) + ")" + ("?" if "" in node else "")

    return render(tree)


def _anchored_pattern(forms: Sequence[str]) -> tuple[str, dict[str, list[str]]]:
    """A pattern that finds every occurrence of the forms from its rarest character on, and the forms that a hit may be.

    The rest of a form is looked up by a prefix tree, longest first, and its beginning behind.  A hit therefore begins
    with the rests of all forms that occur around it.
    """
    rests: dict[str, list[str]] = {}
    for form in forms:
        at = min(range(len(form)), key=lambda i: (_BY_FREQUENCY.find(form[i].lower()), -i))
        rests.setdefault(form[at:], []).append(form)
    tree: dict = {}
    for rest, whole in rests.items():
        node = tree
        for char in rest:
            node = node.setdefault(char, {})
        node[""] = whole

    def render(node: dict) -> str:
        branches = [re.escape(c) + render(child) for c, child in sorted(node.items()) if c]
        if "" in node:
            branches.append(f"(?<={'|'.join(map(re.escape, node['']))})")
        return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"

    maybe = {hit: [form for rest, whole in rests.items() if hit.startswith(rest) for form in whole] for hit in rests}
    # A few first characters at a time: one look-up rules out all of a group.
    firsts = sorted(tree)
    groups = [firsts[i : i + _GROUP] for i in range(0, len(firsts), _GROUP)]
    grouped = "|".join(starting_with("".join(g)) + render({c: tree[c] for c in g}) for g in groups)
    return f"{starting_with(''.join(tree))}(?=({grouped}))", maybe


class KeywordSet:
    """An ordered keyword list compiled for Spark.

    A keyword that contains a backslash is a regular expression and is emitted
    as written; any other keyword is literal text.  With ``separators`` a space
    in it stands for any run of white space; else it is that one character, and
    only keywords with long compact forms are found across other separators.
    """

    def __init__(self, keywords: Sequence[str], separators: bool = False):
        self.keywords = list(keywords)
        self.separators = separators
        self._patterns: dict[str, list[int]] = {}  # pattern -> list positions
        self._long: dict[str, list[int]] = {}  # compact form -> list positions
        short: dict[str, list[int]] = {}
        for position, word in enumerate(self.keywords):
            compact = _compact(word)
            if "\\" in word:
                self._patterns.setdefault(word, []).append(position)
            if len(compact) >= _COMPACT_MIN:
                self._long.setdefault(compact, []).append(position)
            elif "\\" not in word:
                short.setdefault(word, []).append(position)
        # The longest short keyword at a start also stands for those it begins with.
        self._short = {
            hit: [p for word, ps in short.items() if re.match(re.escape(word) + BOUNDARY_AFTER, hit) for p in ps]
            for hit in short
        }

    def _hits(self, text: Column, compact: Column) -> Column:
        parts = []
        if self._long:
            pattern, forms = _anchored_pattern(list(self._long))
            maybe = constant(forms, "map<string,array<string>>")

            def occurring(whole: Column) -> Column:
                found = F.array_distinct(F.regexp_extract_all(whole, F.lit(pattern), F.lit(1)))
                listed = F.array_distinct(F.flatten(F.transform(found, lambda hit: F.element_at(maybe, hit))))
                return F.filter(listed, lambda form: whole.contains(form))

            parts.append(let(compact, occurring))
        if self._short:
            tree = _prefix_tree_pattern(sorted(self._short), self.separators)
            pattern = f"{starting_with([w[0] for w in self._short])}{BOUNDARY_BEFORE}(?=({tree}){BOUNDARY_AFTER})"
            found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
            if self.separators and any(" " in w for w in self._short):
                found = F.array_distinct(F.transform(found, lambda hit: F.regexp_replace(hit, r"\s+", " ")))
            parts.append(found)
        if self._patterns:
            found = [
                F.when(text.rlike(f"{BOUNDARY_BEFORE}(?:{p}){BOUNDARY_AFTER}"), F.lit(p)) for p in self._patterns
            ]
            parts.append(F.when(text.contains("\\"), F.array_compact(F.array(*found))).otherwise(F.array().cast("array<string>")))
        return F.concat(*parts)

    def positions(self, text: Column, compact: Column | None = None) -> Column:
        """List positions of the keywords found in ``text`` (lower-case, not null), ascending.

        ``compact`` is ``compact_text(text)``, for callers that have it as a column.
        """
        hits = self._hits(text, compact_text(text) if compact is None else compact)
        lookup = constant(self._long | self._short | self._patterns, "map<string,array<int>>")
        return F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda hit: F.element_at(lookup, hit)))))

    def match_all(self, text: Column, compact: Column | None = None) -> Column:
        """Keywords found in ``text``, in list order; a word listed twice is returned twice."""
        words = constant(self.keywords, "array<string>")
        return F.transform(self.positions(text, compact), lambda i: F.get(words, i))

    def match_first(
        self,
        text: Column,
        default: str | None = "Unknown",
        labels: Sequence[str] | None = None,
        compact: Column | None = None,
    ) -> Column:
        """First keyword of the list found in ``text``, or the label that belongs to it."""
        values = constant(list(labels if labels is not None else self.keywords), "array<string>")
        first = F.get(values, F.array_min(self.positions(text, compact)))
        return first if default is None else F.coalesce(first, F.lit(default))


@cache
def tech_keywords(fix_cpp: bool = False, fix_separators: bool = False) -> KeywordSet:
    """The technology vocabulary; ``fix_cpp`` makes C++ and ASP.NET ordinary literals, ``fix_separators`` a space in a
    keyword any run of white space."""
    fixes = TECH_KEYWORD_FIXES if fix_cpp else {}
    return KeywordSet([fixes.get(k, k) for k in TECH_KEYWORDS], fix_separators)
