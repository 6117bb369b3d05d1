import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.llm import toxicity

SF = "/root/testdata/sf0.1"


def by_enumeration(evidence, moves):
    """Marginals as sums over all sequences of states."""
    n = len(evidence)
    total, toxic = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        weight, last = 0.0, 0
        for e, s in zip(evidence, states):
            weight += moves[last, s] + e * s
            last = s
        weight = np.exp(weight)
        total += weight
        toxic += weight * np.array(states)
    return toxic / total


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    moves = rng.normal(0, 1, (2, 2))
    sizes = [0, 1, 5, 9, 0, 3]
    first = np.concatenate([[0], np.cumsum(sizes)])
    evidence = rng.normal(-1, 2, first[-1])
    got = toxicity.marginals(evidence, first, moves)
    for a, b in zip(first, first[1:]):
        if b > a:
            assert np.allclose(got[a:b], by_enumeration(evidence[a:b], moves))


def test_long_texts_count_as_a_whole():
    rng = np.random.default_rng(1)
    moves = rng.normal(0, 2, (2, 2))
    evidence = rng.normal(-1, 3, 1000)
    whole, _ = toxicity._pairs(evidence[None], np.array([1000]), moves)
    assert np.allclose(toxicity.marginals(evidence, np.array([0, 1000]), moves), whole[0])


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.model_of(docs, labels)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic", "quality")
    got = toxicity.op2_toxicity(spark, SF)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.toxic).mean() >= 0.98
    assert rows[rows.toxic == 0].predicted.mean() <= 0.005  # clean documents are left alone
    prose = rows[(rows.toxic == 1) & (rows.quality == 1)]
    assert prose.predicted.mean() >= 0.95


def test_spans_are_the_offending_bytes(spark, model):
    text = "Ünd the thonre was inwhin, You IDIOT! of thble and anre"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = toxicity.score(frame, model).first()
    assert [text.encode()[s.begin : s.end].decode() for s in row.spans] == ["IDIOT"]
    assert all(0.5 <= s.probability <= 1 for s in row.spans)


def test_odd_rows(spark, model, odd_docs, no_docs):
    got = toxicity.score(odd_docs, model, keep=("doc_id", "score", "spans")).drop("score", "spans")
    assert got.count() == odd_docs.count()
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score < 0.5 and not r.spans for r in rows)
    assert toxicity.score(no_docs, model).count() == 0


def test_without_both_labels(spark, odd_docs):
    assert toxicity.train([], np.zeros(0, bool)).score[0] < -3
    assert toxicity.train(["a b"], np.array([True])).score[0] < -3
    nothing = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.model_of(odd_docs, nothing)
    assert all(r.score < 0.5 for r in toxicity.score(odd_docs, model).collect())


def test_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.sample(docs, labels, rows=40).collect()
    by = {t: [r for r in rows if r.toxic == t] for t in (0, 1)}
    assert 20 <= len(by[1]) <= 40 and 20 <= len(by[0]) <= 40
    total = dict(labels.groupBy("toxic").count().collect())
    assert all(r.share * len(by[r.toxic]) == pytest.approx(total[r.toxic]) for r in rows)


def test_a_rare_class_and_a_long_text_are_sampled(spark, monkeypatch):
    """1 % toxic; the text that comes first in the sample's order has 10 MB; an id repeats."""
    monkeypatch.setattr(toxicity, "MOST_BYTES", 1 << 20)
    ids = spark.range(20_000).orderBy(F.xxhash64("id")).limit(2).collect()
    first, second = (r.id for r in ids)
    body = F.expr("concat('text ', id, repeat(' of some length', 150))")
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), body.alias("text"))
    long_ = spark.range(1).select(F.lit(first).alias("doc_id"), F.expr("repeat('a long text ', 900000)").alias("text"))
    copies = spark.range(500).select(F.lit(second).alias("doc_id"), F.expr("concat('copy ', id)").alias("text"))
    docs = docs.where(~F.col("doc_id").isin(first, second)).union(long_).union(copies)
    labels = spark.range(20_000).selectExpr("id as doc_id", "int(id % 100 = 7) as toxic")
    rows = toxicity.sample(docs, labels).collect()
    by = {t: [r.text for r in rows if r.toxic == t] for t in (0, 1)}
    assert len(by[1]) == 200 and len(by[0]) >= 350
    assert sum(t.startswith("copy") for t in by[0] + by[1]) == 1
    part = [t for t in by[0] + by[1] if "a long text" in t]
    assert [len(t) for t in part] == [toxicity.PARTS * (toxicity.PART + 1) - 1]
    assert all(sum(map(len, x)) <= 1 << 20 for x in by.values())


def test_nothing_learned_is_told(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    with pytest.warns(UserWarning, match="no toxic words learned"):
        toxicity.model_of(docs, labels)


def test_both_classes_train_the_field_at_its_bound(spark, monkeypatch):
    """The bound is below the toxic texts' tokens; accuracy is that on held-out documents."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.remainder("doc_id", 5) == 0
    rows = sorted(toxicity.sample(docs, labels.where(~held)).collect(), key=lambda r: (r.text, r.toxic))
    toxic = np.array([r.toxic == 1 for r in rows])
    tokens = sum(len(r.text.split()) for r in rows if r.toxic)
    most = tokens // 2
    monkeypatch.setattr(toxicity, "MOST_TOKENS", most)
    seen, pairs = [], toxicity._pairs
    monkeypatch.setattr(toxicity, "_pairs", lambda e, n, m: seen.append(int(n.sum())) or pairs(e, n, m))
    monkeypatch.setattr(toxicity, "_chosen", lambda n, t, f=toxicity._chosen: seen.append([int(n[f(n, t) & (t == c)].sum()) for c in (0, 1)]) or f(n, t))
    model = toxicity.train([r.text for r in rows], toxic, np.array([r.share for r in rows]))
    assert all(0.99 * most / 2 <= n <= most / 2 for n in seen[0]) and set(seen[1:]) == {sum(seen[0])}
    scored = toxicity.score(docs.where(held), model).join(labels, "doc_id").toPandas()
    predicted = scored.score >= 0.5
    print("held-out accuracy", (predicted == scored.toxic).mean(), "clean predicted toxic", predicted[scored.toxic == 0].mean(), "of", len(scored))
    assert (predicted == scored.toxic).mean() >= 0.98 and predicted[scored.toxic == 0].mean() <= 0.005


def test_rows_of_tokens_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_TOKENS", 640)
    length, toxic = np.full(40, 64), np.arange(40) < 20
    both = toxicity._chosen(length, toxic)
    assert both[:20].sum() == both[20:].sum() == 5
    few = toxicity._chosen(length, np.arange(40) < 2)
    assert few[:2].all() and few[2:].sum() == 8
    # not the first ones only
    assert both[10:20].any() and both[30:].any()
