import json

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from jobmart.llm import tokens
from jobmart.llm.queries import QUERIES, TOKENIZER

ODD = [
    "", " ", "\n\n  \n", "don't DON'T we'll I'm", "a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|>", "<|endof text|>",
    "１２３ ٣٤ ²³ ½", "日本語のテキスト", "😀😀 emoji", "é ö", "x y z　w", "\x00\x1c\x1d\x85", "a" * 5_000, "1" * 3_000,
    "tab\t\ttab   spaces   ", "été ÀÉ ÿŸ ŒœßẞǅǆȲȳ", "Русский текст ҁ",
]


def _library(texts, path=TOKENIZER):
    return [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(small_docs):
    texts = ODD + [r["text"] for r in small_docs.collect()]
    assert tokens.counter(TOKENIZER)(texts) == _library(texts)


def test_the_faster_library_classifies_its_characters_alike():
    import regex

    alike = regex.compile(tokens.ALIKE)
    chars = [c for c in map(chr, range(0x3000)) if alike.fullmatch(c)]
    assert len(chars) > 650
    texts = [f"a{c}b {c}1{c} {c}{c} .{c}" for c in chars]
    assert tokens.counter(TOKENIZER)(texts) == _library(texts)


def test_every_vocabulary_entry_stands_for_itself():
    """Then both ways to merge agree: no entry can come up in another way than by its own merges."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    model = json.loads(open(TOKENIZER).read())["model"]
    texts = [tokenizer.decode([i]) for i in model["vocab"].values()]
    whole = [t for t in texts if "�" not in t and t]
    assert len(whole) > 48_000
    pieces = [t for t in whole if len(tokenizer.pre_tokenizer.pre_tokenize_str(t)) == 1]
    assert all(len(e) == 1 for e in tokenizer.encode_batch(pieces, add_special_tokens=False))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    path = public_tokenizers.path(name)
    found = tokens.counter(path)(ODD[:12])
    if name.endswith(".json"):
        assert found == _library(ODD[:12], path)
    else:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        assert found == [len(pieces.encode(t)) for t in ODD[:12]]


def test_only_distinct_misses_are_encoded_and_stored(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None), (4, ""), (5, "three")], "doc_id long, text string")
    cache = f"{tmp_path}/cache"
    first = tokens.count_tokens(docs, cache, TOKENIZER)
    assert {r["doc_id"]: r["n_tokens"] for r in first.collect()} == {1: 2, 2: 2, 3: 0, 4: 0, 5: 1}
    stored = lambda: spark.read.parquet(cache).count()
    assert stored() == 3
    # Stored counts are used as they are: a changed one shows, and nothing is added.
    more = docs.union(spark.createDataFrame([(6, "four five six")], docs.schema))
    assert tokens.count_tokens(more, cache, TOKENIZER).where("doc_id = 6").first()["n_tokens"] == 3
    assert stored() == 4
    other = public_tokenizers.path("word_bpe_49k.json")
    tokens.count_tokens(docs, cache, other)
    assert stored() == 7


def test_a_repeated_append_does_no_harm(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    cache = f"{tmp_path}/cache"
    tokens.count_tokens(docs, cache, TOKENIZER)
    spark.read.parquet(cache).write.mode("append").partitionBy("version").parquet(cache + "-copy")
    spark.read.parquet(cache + "-copy").write.mode("append").partitionBy("version").parquet(cache)
    assert tokens.count_tokens(docs, cache, TOKENIZER).count() == 1


def test_the_query(spark, small_docs):
    found = {r["doc_id"]: r for r in QUERIES["op2_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    wanted = dict(zip(texts, _library(list(texts.values())), strict=True))
    assert {i: r["n_tokens"] for i, r in found.items()} == wanted
    assert all(r["n_bytes"] == len(texts[i].encode()) and r["over_limit"] == (wanted[i] > 512) for i, r in found.items())
