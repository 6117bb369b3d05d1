import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from rillstone.llm import bpe, decontaminate, minhash, toxicity

from tests.llm.test_linededup import plain_clean
from tests.llm.test_minhash import groups

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input, then what each stage has made of what the last one left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_columns(stages):
    assert all(f.columns == corpus_pipeline.COLUMNS for f in stages[:-1])


def test_toxicity(spark, stages):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.model_of(docs, labels)).collect()
    assert texts(stages[1]) == {i: t for i, t in texts(docs).items() if {r.doc_id: r.score for r in scored}[i] < 0.5}


def test_line_dedup(stages):
    before = texts(stages[1])
    expected = plain_clean(before.items(), 0.8)
    assert texts(stages[2]) == {i: t if before[i] else before[i] for i, t in expected.items() if t or not before[i]}


def test_near_duplicates(stages, plain_words):
    before = texts(stages[2])
    roots = groups(list(before.items()), plain_words, percent=80)
    assert texts(stages[3]) == {i: t for i, t in before.items() if roots[i][1] == i}


def test_decontamination(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = texts(stages[3])
    leaks = {i for i, t in before.items() if t and any(x in t for _, x in items)}
    gone = set(before) - set(texts(stages[4]))
    found = decontaminate.matches(list(before.values()), decontaminate.build(items))
    assert leaks <= gone == {i for i, m in zip(before, found) if m}


def test_tokens(stages):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r.doc_id: r for r in stages[5].collect()}
    before = texts(stages[4])
    assert set(rows) == set(before)
    for i, text in before.items():
        ids = library.encode_ordinary(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_run_is_all_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF).exceptAll(stages[-1]).isEmpty()


def test_odd_and_empty_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs.select(corpus_pipeline.COLUMNS), no_docs.select(corpus_pipeline.COLUMNS)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()


def test_near_duplicates_leave_one_of_repeated_rows(spark, odd_docs):
    kept = corpus_pipeline.drop_near_duplicates(spark, odd_docs.select(corpus_pipeline.COLUMNS), SF).collect()
    ids = [r.doc_id for r in kept]
    assert ids.count(4) == 1 and ids.count(None) == 2 and 9 not in ids and 8 in ids
    assert minhash.near_duplicates(odd_docs).count() == odd_docs.count()
