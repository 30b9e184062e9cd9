"""Documents that hold benchmark items, verbatim or with other numbers, names and units.

Both sides become templates, in a strict reading and in a loose one, where a value of several words is one token.
Windows of eight template tokens are joined by hash; matches that lie in line, or nearly so because a value has more or
fewer words than the item's, form a passage, whose slots must agree: a value of the item is replaced by one value
throughout. A bitmap of fixed size lets only windows through that some item may have, so what is moved is in proportion to
the matches. Items that hardly have such windows (short ones, tables of numbers) are found as a whole, as they are written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import stored
from jobmart.llm.templates import Template, Windows, template, templates

WINDOW = 8
#: Plain words a window needs, so that placeholders alone never match.
MIN_PLAIN = 4
#: A passage counts from this share of an item's tokens, or from this many tokens, whichever is less.
MIN_SHARE = 0.5
MIN_TOKENS = 24
#: Share of an item's slot values that may be replaced in more than one way.
MAX_INCONSISTENT = 0.25
BITS = 24
#: Words by which one replaced value may move what follows it.
DRIFT = 8
#: Bytes of texts whose templates are worked out together; a longer text is worked out alone, as a whole.
BLOCK = 1 << 17

_HITS = (
    "array<struct<at: int, end: int, hash: long, size: int, exact: boolean, strict: boolean, cuts: boolean, "
    "slots: array<long>>>"
)


def blocks(texts: Iterable[bytes | None], size: int) -> Iterator[list[bytes]]:
    """The texts in order, nulls as empty ones, in lists of ``size`` bytes at most or of one text."""
    block, held = [], 0
    for text in texts:
        text = text or b""
        if block and held + len(text) > size:
            yield block
            block, held = [], 0
        block.append(text)
        held += len(text)
    if block:
        yield block


def _needed(tokens: int) -> int:
    return min(int(np.ceil(tokens * MIN_SHARE)), MIN_TOKENS)


def _windows(text: Column, sizes: list[tuple[bool, int]] | None = None, bitmap: Broadcast | None = None) -> Column:
    """The windows of a text that have one of ``sizes`` (exact or not, tokens) and are in the bitmap.

    Without sizes, those of an item in its own size; exact ones if the others cover less than a passage needs.
    """

    @F.pandas_udf(f"tokens int, hits {_HITS}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = None if bitmap is None else bitmap.value

        def listed(hashed: np.ndarray) -> np.ndarray:
            bits = hashed & np.uint64((1 << BITS) - 1)
            return (known[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1

        only = None if bitmap is None else listed

        def rows(w: Windows, size: int, exact: bool = False, strict: bool = False) -> list[tuple]:
            parts = (w.at.tolist(), w.end.tolist(), w.hashes.view(np.int64).tolist(), w.cuts.tolist(), w.slots)
            return [(a, e, h, size, exact, strict, c, v.view(np.int64).tolist()) for a, e, h, c, v in zip(*parts, strict=True)]

        def of_item(found: Template) -> list[tuple]:
            size, loose_size = (min(WINDOW, max(1, n)) for n in (len(found), found.loose_size()))
            strict = found.windows(size, MIN_PLAIN)
            hits = rows(strict, size, strict=True) + rows(found.loose_windows(loose_size, MIN_PLAIN), loose_size)
            covered = np.zeros(len(found) + 1, dtype=np.int64)
            np.add.at(covered, strict.at, 1)
            np.add.at(covered, strict.end, -1)
            if (np.cumsum(covered) > 0).sum() < _needed(len(found)):
                hits += rows(found.exact_windows(size), size, exact=True)
            return hits

        def of_texts(texts: list[bytes]) -> list[tuple]:
            found, hits = templates(texts), [[] for _ in texts]
            size_of = np.bincount(found.owner, minlength=len(texts))
            first = np.cumsum(size_of) - size_of
            for exact, size in sizes or ():
                kinds = [(found.exact_windows(size, only), True, False)] if exact else [
                    (found.windows(size, MIN_PLAIN, only), False, True),
                    (found.loose_windows(size, MIN_PLAIN, only), False, False),
                ]
                for w, as_written, strict in kinds:
                    for a, e, *rest in rows(w, size, as_written, strict):
                        text = found.owner[a]
                        hits[text].append((a - first[text], e - first[text], *rest))
            return list(zip(size_of.tolist(), hits, strict=True))

        for batch in batches:
            if sizes is None:
                items = [template(value) for value in batch]
                out = [(len(found), of_item(found)) for found in items]
            else:
                out = [row for block in blocks(batch, BLOCK) for row in of_texts(block)]
            yield pd.DataFrame(out, columns=["tokens", "hits"])

    return run(text.cast("binary"))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Which hashes may occur, by their last bits: 2 MB, however many there are."""
    bit = F.col("hash").bitwiseAND((1 << BITS) - 1)
    place = bit.bitwiseAND(63).cast("int")
    word = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    rows = hashes.groupBy(F.shiftright(bit, 6).alias("word")).agg(word.alias("bits")).collect()
    found = np.zeros(1 << (BITS - 6), dtype=np.int64)
    for row in rows:
        found[row["word"]] = row["bits"]
    return found.view(np.uint8)  # little-endian: bit k of a word is bit k % 8 of byte k // 8


def item_windows(items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """A row for each window of each distinct item; items of equal text are represented by the least id."""
    distinct = items.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(item_id).alias("item_id"))
    cut = distinct.select("item_id", _windows(F.col("text")).alias("w"))
    cut = cut.select("item_id", F.col("w.tokens").alias("item_tokens"), F.explode("w.hits").alias("hit"))
    return cut.select("item_id", "item_tokens", F.col("hit.at").alias("item_at"), F.col("hit.end").alias("item_end"),
                      "hit.hash", "hit.size", "hit.exact", F.col("hit.strict").alias("item_strict"), F.col("hit.cuts").alias("item_cuts"),
                      F.col("hit.slots").alias("item_slots"))


class _Piece:
    """Matches of one shift, as (first word, first word and end in the item, pairs of values), in order of place."""

    def __init__(self, hits: list[tuple]):
        self.at, self.item_at = hits[0][:2]
        self.shift, self.item_end = self.at - self.item_at, max(h[2] for h in hits)
        self.pairs = frozenset(p for h in hits for p in h[3])
        self.matched, last = 0, -1
        for _, start, end, _ in hits:
            self.matched += max(0, end - max(start, last))
            last = max(last, end)

    def consistent(self) -> bool:
        return _consistent(self.pairs)


def _consistent(pairs: frozenset) -> bool:
    distinct = len({p[0] for p in pairs})
    return len(pairs) - distinct <= distinct * MAX_INCONSISTENT


def _value_pairs(item_slots: Sequence[int], slots: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of values; those that only the loose reading has and that are the same on both sides tell nothing."""
    pairs = zip(map(int, item_slots), map(int, slots), strict=True)
    return [(a & ~1, b & ~1) for a, b in pairs if a | 1 != b | 1 or not (a & 1 or b & 1)]


def _best(hits: list[tuple], need: int, length: int) -> tuple[int, bool] | None:
    """Matched words and whether they are verbatim, of the longest passage of at least ``need`` words, if there is one.

    ``hits`` are (first word, first word and end in the item, pairs, strict, cuts). A passage is either all strict matches
    of one shift, or a chain of pieces whose shifts differ by ``DRIFT`` at most from one to the next, in the order of the
    item; parts of values do not take part in chains, where the loose reading has the whole ones.
    """
    passed = []
    by_shift: dict[tuple[bool, int], list[tuple]] = {}
    for at, item_at, end, pairs, strict, cuts in sorted(hits, key=lambda h: h[:3]):
        for only_strict in [True] * strict + [False] * (not cuts):
            by_shift.setdefault((only_strict, at - item_at), []).append((at, item_at, end, pairs))
    pieces = []
    for (only_strict, _), own in by_shift.items():
        if only_strict:
            whole = _Piece(own)
            if whole.matched >= need and whole.consistent():
                passed.append((whole.matched, all(a == b for a, b in whole.pairs)))
            continue
        end, start = own[0][2], 0
        for k, hit in enumerate(own):
            if hit[1] > end:
                pieces.append(_Piece(own[start:k]))
                start = k
            end = max(end, hit[2])
        pieces.append(_Piece(own[start:]))
    pieces = sorted((p for p in pieces if p.consistent()), key=lambda p: (p.at, p.item_at))
    chains = []
    for k, piece in enumerate(pieces):
        matched, joined = piece.matched, piece.pairs
        for i in range(k - 1, -1, -1):
            before = pieces[i]
            if piece.at - before.at > length + DRIFT:
                break
            if abs(piece.shift - before.shift) > DRIFT or before.item_at >= piece.item_at or before.at >= piece.at:
                continue
            more = chains[i][0] + max(0, min(piece.matched, piece.item_end - before.item_end))
            if more > matched and _consistent(both := chains[i][1] | piece.pairs):
                matched, joined = more, both
        chains.append((matched, joined))
        if matched >= need:
            passed.append((matched, all(a == b for a, b in joined)))
    return max(passed, default=None)


def _passage(hits: Column, item_tokens: Column) -> Column:
    """The longest passage of an item, null where none is long enough."""

    @F.pandas_udf("matched int, verbatim boolean")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for own, n in zip(*batch, strict=True):
                rows = [
                    (h["at"], h["item_at"], h["item_end"], _value_pairs(h["item_slots"], h["slots"]), h["strict"], h["cuts"])
                    for h in own if not h["exact"]
                ]
                whole: dict[int, list[tuple]] = {}
                for h in sorted((h for h in own if h["exact"]), key=lambda h: h["item_at"]):
                    whole.setdefault(h["at"] - h["item_at"], []).append((h["at"], h["item_at"], h["item_end"], []))
                if any(_Piece(hits).matched == n for hits in whole.values()):
                    out.append((n, True))
                    continue
                out.append(_best(rows, _needed(n), int(n)) or (None, None))
            yield pd.DataFrame(out, columns=["matched", "verbatim"]).astype({"matched": "Int32", "verbatim": "boolean"})

    return run(hits, item_tokens)


def passages(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
             item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """A row for each document and item found in it: the longest passage in line.

    Columns: ``doc_id``, ``text_hash`` (which tells rows of one id apart), ``item_id``, ``item_tokens``, ``matched``
    (tokens of the item that the passage covers), ``verbatim`` (all slots hold the item's values). Where the windows
    with ``MIN_PLAIN`` plain words are too few for a passage, the whole item is looked for, values as they are. Null and
    empty texts, texts without a letter or digit, and an empty table on either side, match nothing.
    """
    spark = docs.sparkSession
    wanted = stored(item_windows(items, item_text, item_id), "item-windows")
    sizes = sorted(tuple(r) for r in wanted.select("exact", "size").distinct().collect())  # at most 2 * WINDOW values
    bitmap = spark.sparkContext.broadcast(_bitmap(wanted))
    hits = docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        F.explode(_windows(F.col(text), sizes, bitmap)["hits"]).alias("hit"),
    )
    hits = hits.select("doc_id", "text_hash", "hit.at", "hit.hash", "hit.strict", "hit.cuts", "hit.slots")
    met = hits.join(wanted, "hash")
    strict, cuts = F.col("strict") & F.col("item_strict"), F.col("cuts") | F.col("item_cuts")
    hit = F.struct("at", "item_at", "item_end", "item_slots", "slots", "exact", strict.alias("strict"), cuts.alias("cuts"))
    met = met.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("item_tokens").alias("item_tokens"), F.collect_set(hit).alias("hits")
    )
    scored = met.select("doc_id", "text_hash", "item_id", "item_tokens", _passage("hits", "item_tokens").alias("best"))
    scored = scored.where(F.col("best.matched").isNotNull())
    return scored.select("doc_id", "text_hash", "item_id", "item_tokens", "best.matched", "best.verbatim")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    found = passages(docs, items, text, doc_id).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash"))
    found = found.distinct()
    same = docs[doc_id].eqNullSafe(found["_bad_id"]) & (F.xxhash64(docs[text]) == found["_bad_hash"])
    return docs.join(found, same, "left_anti")
