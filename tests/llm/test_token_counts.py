"""Token counts against the library itself, and what the cache keeps."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.llm import token_counts
from lakeops.llm.queries import COUNTED, tokenizer
from lakeops.session import scratch_path

COLUMNS = ("doc_id", "n_bytes", "n_tokens", "over_limit")


@pytest.fixture(scope="module")
def plain_counts():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer(COUNTED))
    return lambda text: len(own.encode(text, add_special_tokens=False).ids)


def wanted(given, count):
    return Counter((i, len((t or "").encode()), count(t or ""), count(t or "") > 512) for i, t in given)


def rows(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


def batches(spark, cache):
    folder = f"{cache}/tokenizer={token_counts.tokenizer_version(tokenizer(COUNTED))}"
    return spark.read.parquet(folder)


def test_counts_of_the_library(spark, docs, given, plain_counts):
    cache = scratch_path(spark, "cache")
    found = token_counts.count_tokens(docs, tokenizer(COUNTED), cache)
    assert found.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert rows(found, *COLUMNS) == wanted(given, plain_counts)
    assert batches(spark, cache).count() == len({t or "" for _, t in given})


def test_only_misses_are_encoded(spark, docs, given, plain_counts, monkeypatch):
    cache, path = scratch_path(spark, "cache"), tokenizer(COUNTED)
    token_counts.count_tokens(docs.where("doc_id < 100"), path, cache)
    first = {r.batch for r in batches(spark, cache).select("batch").distinct().collect()}
    had = {t or "" for i, t in given if i is not None and i < 100}
    found = token_counts.count_tokens(docs, path, cache)
    assert rows(found, *COLUMNS) == wanted(given, plain_counts)
    new = batches(spark, cache).where(~F.col("batch").isin(*first))
    assert new.count() == len({t or "" for _, t in given} - had)
    before = batches(spark, cache).count()
    assert rows(token_counts.count_tokens(docs, path, cache), *COLUMNS) == wanted(given, plain_counts)
    assert batches(spark, cache).count() == before


def test_few_misses_leave_other_texts_unshuffled(spark, docs, given, plain_counts, monkeypatch):
    cache, path = scratch_path(spark, "cache"), tokenizer(COUNTED)
    token_counts.count_tokens(docs.where("doc_id IS NULL OR doc_id < 9010"), path, cache)
    asked = []
    texts_of = token_counts._texts_of
    monkeypatch.setattr(token_counts, "_texts_of", lambda rows, misses, few: asked.append(few) or texts_of(rows, misses, few))
    assert rows(token_counts.count_tokens(docs, path, cache), *COLUMNS) == wanted(given, plain_counts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = scratch_path(spark, "cache")
        assert rows(token_counts.count_tokens(docs, path, fresh), *COLUMNS) == wanted(given, plain_counts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert asked == [True, False]


def test_digests_stored_twice_are_read_once(spark, docs, given, plain_counts):
    one, two, path = scratch_path(spark, "cache"), scratch_path(spark, "cache"), tokenizer(COUNTED)
    token_counts.count_tokens(docs, path, one)
    token_counts.count_tokens(docs, path, two)
    batches(spark, two).drop("batch").write.parquet(f"{one}/tokenizer={token_counts.tokenizer_version(path)}/batch=other")
    assert rows(token_counts.count_tokens(docs, path, one), *COLUMNS) == wanted(given, plain_counts)


def test_another_tokenizer_has_counts_of_its_own(spark, docs, given, plain_counts):
    from sentencepiece import SentencePieceProcessor

    cache, path = scratch_path(spark, "cache"), tokenizer("piece_bpe_32k.model")
    pieces = SentencePieceProcessor(model_file=path)
    for file, count in ((COUNTED, plain_counts), ("piece_bpe_32k.model", lambda t: len(pieces.encode(t)))):
        assert rows(token_counts.count_tokens(docs, tokenizer(file), cache), *COLUMNS) == wanted(given, count)


def test_normalised_texts_share_a_count(spark):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    own, cache = Tokenizer.from_file(path), scratch_path(spark, "cache")
    given = [(1, "Some  Words here"), (2, "some words here"), (3, "SOME words\there "), (4, None)]
    simple = lambda c: F.trim(F.regexp_replace(F.lower(token_counts.plain(c)), r"\s+", " "))
    found = token_counts.count_tokens(spark.createDataFrame(given, "doc_id long, text string"), path, cache, normalise=simple)
    assert rows(found, *COLUMNS) == wanted(given, lambda t: len(own.encode(t, add_special_tokens=False).ids))
    assert token_counts.stored_counts(spark, cache, path).count() == 2


def test_long_texts_in_parts(spark, plain_counts):
    long = "It's a  text\n\nof <|endoftext|> 12 345 words, naïve ☃ ones 'll too   . " * 400
    given = [(1, long), (2, long.replace(" ", "")), (3, " " * 5000), (4, "é " * 3000)]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    assert len(token_counts.parts(long, 1000)) > 20 and "".join(token_counts.parts(long, 1000)) == long
    found = token_counts.count_tokens(docs, tokenizer(COUNTED), scratch_path(spark, "cache"), step=1000)
    assert rows(found, *COLUMNS) == wanted(given, plain_counts)


def test_hot_digest_and_empty_table(spark, docs, none, plain_counts):
    cache = scratch_path(spark, "cache")
    many = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.lit("the same text").alias("text"))
    found = token_counts.count_tokens(many.union(docs.select("doc_id", "text")), tokenizer(COUNTED), cache)
    same = found.where("n_bytes = 13")
    assert same.count() == 3000 and same.select("n_tokens").distinct().collect()[0][0] == plain_counts("the same text")
    fresh = scratch_path(spark, "cache")
    assert token_counts.count_tokens(none, tokenizer(COUNTED), fresh).count() == 0
    assert token_counts.stored_counts(spark, fresh, tokenizer(COUNTED)).count() == 0
