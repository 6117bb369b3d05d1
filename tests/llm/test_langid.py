import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.llm import langid

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = langid.op4_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out and lang is not null").toPandas()
    assert got.count() == docs.count()
    assert (rows.lang == rows.lang_pred).mean() >= 0.995
    assert rows.score.between(0, 1).all()
    sure = rows[rows.accepted]
    assert (sure.lang == sure.lang_pred).mean() >= langid.PRECISION and len(sure) >= 0.95 * len(rows)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return langid.model_of(docs)


def test_features_of_a_word():
    words, form, ids, begins = langid.features(["abc, abc", "abc"])
    assert len(words) == 3 and len(set(form)) == 1
    # the word itself, three runs of three in " abc ", two of four, one of five
    assert np.diff(begins).tolist() == [1 + 3 + 2 + 1]


def test_scores_do_not_depend_on_company(model):
    texts = ["the thing that was", None, "", "und der die das ist", "the thing that was " * 50]
    whole, _ = langid._logits(texts, model)
    for i, text in enumerate(texts):
        alone, _ = langid._logits([text], model)
        assert np.allclose(alone[0], whole[i])


def test_odd_rows(spark, model, odd_docs, no_docs):
    rows = langid.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    for i in (0, 1, 2, 3, 15):
        assert by[i].lang_pred == "und" and by[i].score == 0 and not by[i].accepted
    assert by[11].lang_pred in model.languages and by[4].lang_pred in model.languages
    assert langid.identify(no_docs, model).count() == 0


def test_nothing_learned(spark, odd_docs, no_docs):
    model = langid.model_of(no_docs)
    assert {r.lang_pred for r in langid.identify(odd_docs, model).collect()} == {"und"}


def test_sample_takes_as_many_of_each_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    languages = [r.lang for r in langid.sample(docs, rows=20).collect()]
    assert sorted(languages.count(x) for x in set(languages)) == [20] * 4


def test_rare_languages_and_a_long_text_are_sampled(spark, monkeypatch):
    """Shares from 1/2 to 1/4096; the text that is first in the order is larger than the bound."""
    monkeypatch.setattr(langid, "MOST_BYTES", 1 << 20)
    n = 8192
    docs = spark.range(n).selectExpr("id as doc_id", "concat('l', least(12, int(log2(8192 / (id + 1))))) as lang", "concat('text ', id, repeat(' of some length', 150)) as text")
    first = docs.orderBy(F.xxhash64("doc_id")).first().doc_id
    docs = docs.withColumn("text", F.when(F.col("doc_id") == first, F.expr("repeat('a long text ', 200000)")).otherwise(F.col("text")))
    copied = docs.where("lang = 'l0'").limit(1).select("doc_id", "lang", F.explode(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.concat(F.lit("copy "), i.cast("string")))).alias("text"))
    held = dict(docs.groupBy("lang").count().collect())
    assert min(held.values()) <= 2 and max(held.values()) == n // 2
    rows = langid.sample(docs.union(copied)).collect()
    got = {x: [r.text for r in rows if r.lang == x] for x in held}
    fair = min(len(x) for lang, x in got.items() if len(x) < held[lang])
    assert all(len(x) == held[lang] or len(x) in (fair, fair + 1) for lang, x in got.items()) and fair >= 50
    assert sum(t.startswith("copy") for x in got.values() for t in x) <= 1
    assert 0.98 * (1 << 20) <= sum(len(t) for x in got.values() for t in x) <= 1 << 20
    assert max(len(t) for x in got.values() for t in x) == langid.PARTS * (langid.PART + 1) - 1


def test_a_language_with_one_document_is_learned():
    rng = np.random.default_rng(5)
    say = lambda words, n: " ".join(rng.choice(words.split(), n))
    one, other = "the thing that was here and there", "und der die das ist nicht ein"
    texts = [*(say(one, 80) for _ in range(40)), say(other, 80)]
    for seed in range(12):
        model = langid.train(texts, ["en"] * 40 + ["de"], seed=seed)
        logits, _ = langid._logits([say(one, 40), say(other, 40)], model)
        assert logits.argmax(axis=1).tolist() == [1, 0]


def plain_logits(text, model):
    """Feature by feature: every word itself, and its byte runs between two spaces."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    total, n = np.zeros(len(model.languages)), 0
    for word in re.findall(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower):
        edged = b" " + word + b" "
        found = [word] + [edged[i : i + run] for run in langid.RUNS for i in range(len(edged) - run + 1)]
        for gram in found:
            hashed = langid.span_hashes(np.frombuffer(gram, np.uint8), np.array([0]), np.array([len(gram)]))
            total += model.table[int(langid.mix(hashed)[0] >> np.uint64(13)) & (langid.BUCKETS - 1)]
            n += 1
    return total / max(n, 1) + model.bias


def test_against_plain_scores(spark, model, odd_texts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    texts = [t for t in [r.text for r in docs.collect()] + odd_texts if len(t or "") < 3000]
    rows = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        logits = plain_logits(text, model) * model.heat
        p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        if any(c.isalpha() for c in text or ""):
            assert r.lang_pred == model.languages[int(p.argmax())] and abs(r.score - p.max()) < 1e-9
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)
