import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillstone.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
MERGES = bpe.Merges(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="the andin gre", min_size=1, max_size=70), st.text(min_size=1, max_size=90)), min_size=1, max_size=30))
def test_folds_are_those_of_the_library(words):
    words = [w.encode("utf-8", "surrogatepass") for w in words]
    ids, start = bpe.fold_words(words, MERGES)
    for i, word in enumerate(words):
        assert ids[start[i] : start[i + 1]].tolist() == LIBRARY._encode_single_piece(word)


def test_documents_round_trip(spark, odd_docs, no_docs):
    coded = bpe.encode(odd_docs, RANKS, public_tokenizers.PATTERN, ("doc_id", "text", "ids"))
    assert coded.columns == ["doc_id", "text", "ids", "ids"]
    rows = bpe.encode(odd_docs, RANKS, public_tokenizers.PATTERN, ("doc_id", "text"))
    rows = rows.withColumn("back", bpe.decode(F.col("ids"), RANKS)).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert list(r.ids) == LIBRARY.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()
    assert bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_words_are_forgotten_and_folded_again(spark, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "BATCH_BYTES", 20)
    texts = [(i, f"some words {i} again, some words") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect():
        assert list(r.ids) == LIBRARY.encode_ordinary(texts[r.doc_id][1])


@pytest.fixture(scope="module")
def some_words(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    return sorted({w for t in texts[:60] for w in regex.findall(public_tokenizers.PATTERN, t)})[:1500]


def test_higher_order_functions_fold_alike(spark, some_words):
    frame = spark.createDataFrame([(w,) for w in [*some_words, "", some_words[0]]], "word string")
    got = {r.word: list(r.ids) for r in bpe.encode_words(frame, RANKS).collect()}
    assert got == {w: LIBRARY._encode_single_piece(w.encode()) for w in some_words}


def test_higher_order_functions_are_native(spark):
    frame = spark.createDataFrame([("the",)], "word string")
    plan = bpe.encode_words(frame, RANKS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan
