"""Language identification by averaged hashed subword embeddings.

A word's features are itself and its byte runs of three to five, with its edges; each is
hashed to an embedding. A text is the average of all its features' embeddings, and a
linear softmax tells the language. Embeddings and softmax are trained by stochastic
gradient descent on snippets of a bounded sample of labelled documents. Because the
model is linear behind the average, scoring sums one small vector for each distinct word
of a batch. A temperature and a threshold, fitted on a part of the sample that training
did not see, make scores probabilities and reject what falls below the wanted precision.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.shared import Words, batches, cut, mix, remainder, span_hashes, stretches, table

#: Documents of each language, and bytes of text, that a model is trained on at most.
MOST_ROWS, MOST_BYTES = 1_000, 16 << 20
#: Stretches, and characters of each, that a longer text is sampled by; there are as many snippets.
PARTS, PART = 3, 1_024
#: Sampled ids that are broadcast at most; more of them are joined by shuffling.
MOST_SENT = 200_000
#: Hashed features, their dimension, lengths of byte runs.
BUCKETS, DIMENSION, RUNS = 1 << 16, 16, (3, 4, 5)
#: Words in a snippet, passes over the sample, texts in a step, speed of learning.
SNIPPET, PASSES, STEP, SPEED = 60, 6, 32, 0.5
#: Precision that accepted predictions have on the calibration part at least.
PRECISION = 0.99
BATCH_BYTES = 4 << 20
UNKNOWN = "und"
#: What parts words: ASCII other than letters.
APART = bytes(b for b in range(128) if not chr(b).isalpha())
LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    """Languages, what each feature adds to each, temperature and threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    heat: float = 1.0
    threshold: float = 0.0


def features(texts: list[str | None]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, each word's distinct form, and the features of the forms, one after another.

    The last array has where each form's features begin, and the end of all.
    """
    words = Words(["" if t is None else t for t in texts], APART)
    _, first, form = np.unique(words.hash, return_index=True, return_inverse=True)
    begin, end = words.begin[first], words.end[first]
    # one space at either side, whatever parts the words there
    size = end - begin + 2
    starts = np.concatenate([[0], np.cumsum(size)])
    of = np.repeat(np.arange(len(first)), size)
    inner = np.arange(starts[-1]) - starts[of]
    source = np.clip(begin[of] + inner - 1, 0, max(0, len(words.data) - 1))
    edge = (inner == 0) | (inner == size[of] - 1)
    flat = np.where(edge, 32, words.data[source] if len(words.data) else 32).astype(np.uint8)
    hashes, owner = [words.hash[first]], [np.arange(len(first))]
    for run in RUNS:
        at = np.flatnonzero(inner + run <= size[of])
        hashes.append(span_hashes(flat, at, at + run))
        owner.append(of[at])
    owner_all = np.concatenate(owner)
    order = np.argsort(owner_all, kind="stable")
    ids = (mix(np.concatenate(hashes)) >> np.uint64(13)).astype(np.int64)[order] & (BUCKETS - 1)
    begins = np.searchsorted(owner_all[order], np.arange(len(first) + 1))
    return words, form, ids, begins


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows; empty stretches have zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[begins[1:]] - total[begins[:-1]]


def _logits(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Uncalibrated logits, and the number of features, of each text."""
    words, form, ids, begins = features(texts)
    of_form = _sums(model.table[ids], begins)
    count = np.diff(begins)
    total = _sums(of_form[form], words.first)
    n = _sums(count[form].astype(np.float64), words.first)
    return total / np.maximum(n, 1)[:, None] + model.bias, n


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], languages: list[str], seed: int = 11) -> Model:
    """A model of labelled texts; without any it knows no language."""
    known = sorted(set(languages))
    model = Model(known, np.zeros((BUCKETS, len(known))), np.zeros(len(known)))
    if not known:
        return model
    rng = np.random.default_rng(seed)
    y = np.searchsorted(known, languages)
    snippets, labels, aside = [], [], []
    for text, label in zip(texts, y):
        words = text.split()
        for _ in range(PARTS):
            at = int(rng.integers(0, max(1, len(words) - SNIPPET + 1)))
            size = int(rng.integers(3, SNIPPET + 1))
            snippets.append(" ".join(words[at : at + size]))
            labels.append(label)
        aside += [rng.random() < 0.2] * PARTS
    label, aside = np.array(labels), np.array(aside)
    for k in range(len(known)):  # a language whose texts were all set aside would not be learned
        if aside[label == k].all():
            aside[label == k] = False

    words, form, ids, begins = features(snippets)
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSION)) / DIMENSION
    softmax, bias = np.zeros((DIMENSION, len(known))), np.zeros(len(known))
    weight = len(label) / len(known) / np.maximum(1, np.bincount(label, minlength=len(known)))
    chosen = np.flatnonzero(~aside)
    steps = PASSES * max(1, -(-len(chosen) // STEP))
    done = 0
    for _ in range(PASSES):
        for batch in np.array_split(rng.permutation(chosen), max(1, len(chosen) // STEP)):
            speed = SPEED * (1 - done / (steps + 1))
            done += 1
            rows = [ids[_within(begins, form[words.first[i] : words.first[i + 1]])] for i in batch]
            size = np.array([len(r) for r in rows])
            if not size.sum():
                continue
            flat = np.concatenate(rows)
            of = np.repeat(np.arange(len(batch)), size)
            ends = np.concatenate([[0], np.cumsum(size)])
            mean = _sums(embedding[flat], ends) / np.maximum(size, 1)[:, None]
            off = -_softmax(mean @ softmax + bias)
            off[np.arange(len(batch)), label[batch]] += 1
            off *= weight[label[batch]][:, None]
            back = off @ softmax.T / np.maximum(size, 1)[:, None]
            softmax += speed * mean.T @ off
            bias += 0.1 * speed * off.mean(axis=0)
            # an average hardly moves with one embedding; scale by the text's size
            touched, place = np.unique(flat, return_inverse=True)
            change = np.stack([np.bincount(place, weights=back[of, d], minlength=len(touched)) for d in range(DIMENSION)], axis=1)
            embedding[touched] += speed * 20 * change
    model.table, model.bias = embedding @ softmax, bias

    held = [s for s, a in zip(snippets, aside) if a]
    truth = label[aside]
    if held:
        logits, _ = _logits(held, model)
        heats = np.geomspace(0.1, 20, 60)
        loss = [-np.log(_softmax(logits * h)[np.arange(len(truth)), truth] + 1e-12).mean() for h in heats]
        model.heat = float(heats[int(np.argmin(loss))])
        p = _softmax(logits * model.heat)
        sure, right = p.max(axis=1), p.argmax(axis=1) == truth
        order = np.argsort(-sure)
        precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(precise >= PRECISION)
        model.threshold = float(sure[order][enough[-1]]) if len(enough) else 1.0
    return model


def _within(begins: np.ndarray, forms: np.ndarray) -> np.ndarray:
    """Positions of the features of the given forms."""
    size = begins[forms + 1] - begins[forms]
    ends = np.cumsum(size)
    return np.repeat(begins[forms] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def sample(docs: DataFrame, rows: int = MOST_ROWS) -> DataFrame:
    """``text`` and ``lang`` of labelled documents: a bounded, hashed sample.

    Of each language the ``rows`` documents with the smallest hashes of their ids. The
    languages take turns: the first document of each, then the second of each, so long as
    all texts have ``MOST_BYTES`` together; each language's first document is always taken.
    A text of over ``PARTS * PART`` characters counts by stretches, so that none fills the
    sample. Of rows that share an id and a language one is taken.
    """
    order = F.xxhash64("doc_id")
    named = docs.where("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang")
    # a hash below this leaves three times the ids wanted of each language, however many it has
    total = cut(named.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("total")))
    share = (order / F.lit(2.0**63) + 1) / 2
    # one row for each language: a join by shuffling would gather its ids in a task, and is for
    # tables in which lang is no language but as good as a key
    counts = F.broadcast(total) if total.count() <= MOST_SENT else total
    near = named.join(counts, "lang").where(share < 3.0 * rows / F.col("total")).drop("total").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))
    ids = cut(near.withColumn("place", place).where(F.col("place") <= rows))
    few = ids.count() <= MOST_SENT
    part = stretches(F.col("text"), F.col("doc_id"), PARTS, PART).alias("part")
    found = docs.select("doc_id", "lang", "text").where("text is not null")
    found = found.join(F.broadcast(ids) if few else ids, ["doc_id", "lang"])
    found = found.select("doc_id", "lang", "place", F.xxhash64("text").alias("of"), part)
    one = found.groupBy("lang", "place").agg(F.min(F.struct("of", "part"))["part"].alias("text"))
    so_far = F.sum(F.octet_length("text")).over(Window.orderBy("place", F.xxhash64("lang"), "lang"))
    return one.withColumn("so_far", so_far).where((F.col("so_far") <= MOST_BYTES) | (F.col("place") == 1)).select("text", "lang")


def model_of(docs: DataFrame) -> Model:
    """A model of the documents with a language.

    One task trains on the bounded sample; the driver sees the model only.
    """

    def fit(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["lang"], r["text"]) for batch in batches_ for r in batch.to_pylist())
        model = train([text for _, text in rows], [lang for lang, _ in rows])
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    row = sample(docs).coalesce(1).mapInArrow(fit, "model binary").first()
    return pickle.loads(row.model) if row else train([], [])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``accepted`` of each document.

    Texts that are null or have no letter are ``und`` with score 0. A prediction whose
    score is below the model's threshold stays, and ``accepted`` is false. Repeated rows
    give repeated results; other columns, ``lang`` among them, are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the corpus

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches(rows, "text", BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            letters = np.array([bool(t and LETTER.search(t)) for t in texts], dtype=bool)
            if model.languages:
                logits, _ = _logits(texts, model)
                p = _softmax(logits * model.heat)
                best, sure = p.argmax(axis=1), p.max(axis=1)
                named = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
            else:
                named, sure, letters = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            score = np.where(letters, sure, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(named, pa.string()), pa.array(score), pa.array(letters & (score >= model.threshold))],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, accepted boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned without the third that is held out."""
    docs = table(spark, sf_dir, "documents")
    model = model_of(docs.where(remainder("doc_id", 3) != 1))
    return identify(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "accepted"
    )
