"""Language identification by compression.

Each language has a zstandard dictionary of raw text.  A text is encoded once with every dictionary; the language
whose encoding is smallest is predicted, and the prediction is rejected when the runner-up is nearly as small.

Whole texts are encoded, in blocks of ``BLOCK`` bytes that each start from the dictionary alone, so that a long
text does not become its own dictionary and drown the difference.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import bounded_sample, fold

UNDETERMINED = "und"
BLOCK = 8_192
PREDICTION = "lang string, score double, margin double"


@dataclass(frozen=True)
class LanguageModel:
    """``dictionaries`` holds raw text per language, in code point order of the languages."""

    dictionaries: tuple[tuple[str, bytes], ...]
    sharpness: float = 40.0

    def encoders(self) -> list[zstandard.ZstdCompressor]:
        # Words are short: matches of three bytes count, and the whole dictionary is in reach.
        how = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=3, search_log=2, hash_log=18, chain_log=18, window_log=19
        )
        made = []
        for _, text in self.dictionaries:
            raw = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=how)
            made.append(zstandard.ZstdCompressor(compression_params=how, dict_data=raw))
        return made


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = 120, piece: int = 1_500, size: int = 131_072
) -> LanguageModel:
    """Dictionaries of at most ``size`` bytes per language.

    The sample is bounded: about ``rows`` texts a language, of each a piece of at most ``piece`` characters from a
    place given by its hash.  Equal texts count once.  Rows without language or letters are not learned from; without
    any other row the model is empty.  The number of languages must be small enough for the driver: a language takes
    ``size`` bytes there.
    """
    room = F.greatest(F.length(text) - piece, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64(F.lit("piece"), text), F.lit(1_000_003)) % room + 1).cast("int")
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    sample = bounded_sample(usable, lang, rows, [text], [F.substring(F.col(text), start, F.lit(piece)).alias("_piece")])
    pieces: dict[str, dict[str, None]] = {}
    for row in sample:
        pieces.setdefault(row["_group"], {})[row["_piece"].lower()] = None
    return LanguageModel(
        tuple((name, "\n".join(found).encode()[-size:]) for name, found in sorted(pieces.items()) if found)
    )


def fit_on_folds(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> LanguageModel:
    """The model of all folds but the held-out one."""
    return fit(docs.where(fold(doc_id) != 0), text, lang)


def classify(data: bytes, encoders: list) -> list[int]:
    """The encoded size of a text with each dictionary."""
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]
    return [sum(len(e.compress(block)) for block in blocks) for e in encoders]


def predict(model: LanguageModel, text: Column) -> Column:
    """A struct of ``lang``, ``score`` and ``margin`` for each text.

    ``margin`` is the relative distance of the runner-up's size, ``score`` the best language's share when sizes are
    weighed exponentially.  A null text or one without a letter is ``und`` with score and margin 0, and so is every
    text when no language was learned.  Of equal sizes the first language in code point order wins, with margin 0;
    a single learned language has margin and score 1.
    """
    if not model.dictionaries:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("margin"))
    names = [name for name, _ in model.dictionaries]

    @F.pandas_udf(PREDICTION)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = model.encoders()
        for batch in batches:
            found = []
            for value in batch:
                if value is None:
                    found.append((UNDETERMINED, 0.0, 0.0))
                    continue
                sizes = classify(value.lower().encode("utf-8", "replace"), encoders)
                best, *rest = sorted((n, i) for i, n in enumerate(sizes))
                share = 1 / sum(math.exp(-model.sharpness * (n - best[0]) / best[0]) for n in sizes)
                found.append((names[best[1]], share, (rest[0][0] - best[0]) / best[0] if rest else 1.0))
            yield pd.DataFrame(found, columns=["lang", "score", "margin"])

    return run(F.when(text.rlike(r"\p{L}"), text))


def rejected(prediction: Column, min_margin: float) -> Column:
    """Whether nothing was determined, or the runner-up is too near."""
    return (prediction["lang"] == UNDETERMINED) | (prediction["margin"] < min_margin)


#: Relative margin of encoded sizes under which a prediction is rejected.
MIN_MARGIN = 0.005


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``prediction`` and ``rejected``, learned from all folds but the held-out one."""
    model = fit_on_folds(docs, text, lang, doc_id)
    found = docs.withColumn("prediction", predict(model, F.col(text)))
    return found.withColumn("rejected", rejected(F.col("prediction"), MIN_MARGIN))


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose prediction is not rejected, with its own columns only."""
    model = fit_on_folds(docs, text, lang, doc_id)
    found = docs.withColumn("_prediction", predict(model, F.col(text)))
    return found.where(~rejected(F.col("_prediction"), MIN_MARGIN)).select(*docs.columns)
