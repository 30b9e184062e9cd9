import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

#: Columns that operators use for themselves or add; an input may have them too.
CLASHING = [
    "score", "size", "target", "source_size", "taken", "kept", "n_lines", "n_dropped", "key", "id", "node", "band",
    "class_id", "repeats", "hash", "prediction", "rejected", "n_tokens", "digest", "kept_text", "predicted", "probability",
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)
LONG = " ".join(f"word{i % 977} thing{i % 31}" for i in range(30_000))
TEXTS = [
    None, "", "   \n \t\n", "a", "One short line.\nOne short line.", LONG, "1234 !!! ???", "ÄÖÜ straße œuvre ñandú",
    "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the wood",
    "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the wood", "\x00\x1f weird 😀 <|endoftext|>",
    "password=abcdef123456 and token: 'zzzzzzzz99'", "\n".join(["same line"] * 50),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, odd texts, rows that repeat, an id with two texts, and clashing names."""
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", None, "s0"][i % 3], len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[8], rows[8], (None, "lost words without any id at all, twice", None, None, None)]
    rows += [(None, "lost words without any id at all, twice", None, None, None), (None, None, None, None, None)]
    rows += [(3, "another text under the same id as before", "en", "s1", 3)]
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("1 = 0")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
