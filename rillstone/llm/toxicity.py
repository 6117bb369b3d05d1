"""Toxic spans by a linear-chain conditional random field.

Two states, outside and toxic. A token's evidence is the sum of weights of its hashed
word, of the word's first bytes, and of the words before and behind it; transitions make
spans. Labels are known for documents only, so that tokens are labelled first: a token
of a toxic document is toxic if its word, or a beginning of it, stands in toxic documents
far more often than in others, where near copies count as one document. Forward-backward
sums give each token's marginal probability; a document's score is a logistic function
of its expected number of toxic tokens, of its length and of its largest marginal,
fitted on the labelled documents.

Training happens on a sample of labelled documents bounded by ``MOST_ROWS`` and
``MOST_BYTES`` of each class; scoring covers every document whole.
"""

from __future__ import annotations

import pickle
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.shared import Words, batches, mix, remainder, shingles, span_hashes, stretches, table

#: Labelled documents, and bytes of text, of each class that a model is trained on at most.
MOST_ROWS, MOST_BYTES = 2_000, 12 << 20
#: Stretches, and characters of each, that a longer text is trained on.
PARTS, PART = 8, 8_192
#: Tokens that the random field's gradient runs over at most, and its steps.
MOST_TOKENS, STEPS = 500_000, 40
#: Hashed weights of each kind.
BUCKETS = 1 << 18
#: First bytes of a word that are features of their own.
PREFIXES = (4, 5, 6, 7)
#: A token is labelled toxic if a feature's rate is raised so much, this surely (twice the
#: logarithm of a likelihood ratio), in so many toxic texts.
RAISED, SURE, SUPPORT = 6.0, 30.0, 3.0
#: Text that is scored at a time, and tokens in a stretch of the scan.
BATCH_BYTES, STRETCH = 4 << 20, 32
SPANS = "array<struct<begin:int,end:int,probability:double>>"
#: What parts words: ASCII that is neither a letter nor a digit.
APART = bytes(b for b in range(128) if not chr(b).isalnum())


@dataclass
class Model:
    """Weights of the random field and of the document's score."""

    now: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    # the word's features, then those of its neighbours
    before: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    behind: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = -4.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    score: np.ndarray = field(default_factory=lambda: np.array([-6.0, 0.0, 0.0, 0.0]))

    def evidence(self, all_ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of each token for the toxic state, without transitions."""
        ids = all_ids[0]
        out = np.full(len(ids), self.bias)
        for row in all_ids:
            out += self.now[row]
        if len(ids):
            inner = np.ones(len(ids), dtype=bool)
            inner[first[:-1][first[:-1] < len(ids)]] = False
            out[1:] += np.where(inner[1:], self.before[ids[:-1]], 0.0)
            out[:-1] += np.where(inner[1:], self.behind[ids[1:]], 0.0)
        return out


def token_ids(words: Words) -> np.ndarray:
    """A row of hashed features for the words, and one for each length of prefix."""
    rows = span_hashes(words.data, words.begin, words.end, PREFIXES)
    out = np.empty(rows.shape, dtype=np.int32)
    for i, row in enumerate(rows):
        salt = np.uint64(i * 0x9E3779B97F4A7C15 & 2**64 - 1)
        out[i] = (mix(row ^ salt) >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)
    return out


def marginals(evidence: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The probability of the toxic state at each token, given its whole text.

    Texts are cut into stretches. The transfer matrices of all stretches are multiplied
    side by side, then chained along each text, so that a long text takes few steps and
    still counts as a whole. The state before the first token is outside.
    """
    count = np.diff(first)
    stretches = -(-count // STRETCH)
    total = int(stretches.sum())
    out = np.zeros(len(evidence))
    if not total:
        return out
    text = np.repeat(np.arange(len(count)), stretches)
    base = np.cumsum(stretches) - stretches
    inner = np.arange(total) - base[text]
    start = first[:-1][text] + inner * STRETCH
    at = start[:, None] + np.arange(STRETCH)
    real = at < first[1:][text][:, None]
    toxic = 1.0 / (1.0 + np.exp(-np.clip(evidence[np.minimum(at, len(evidence) - 1)], -50, 50)))
    step = np.exp(moves)

    def forward(a: np.ndarray, b: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        x = (a * step[0, 0] + b * step[1, 0]) * (1 - toxic[:, i])
        y = (a * step[0, 1] + b * step[1, 1]) * toxic[:, i]
        scale = 1 / (x + y)
        return np.where(real[:, i], x * scale, a), np.where(real[:, i], y * scale, b)

    # what each stretch makes of either state; both rows share one scale
    rows = np.ones(total), np.zeros(total), np.zeros(total), np.ones(total)
    for i in range(STRETCH):
        a, b, c, d = rows
        off, on = 1 - toxic[:, i], toxic[:, i]
        new = (
            (a * step[0, 0] + b * step[1, 0]) * off, (a * step[0, 1] + b * step[1, 1]) * on,
            (c * step[0, 0] + d * step[1, 0]) * off, (c * step[0, 1] + d * step[1, 1]) * on,
        )
        scale = 1 / (new[0] + new[1] + new[2] + new[3])
        rows = tuple(np.where(real[:, i], x * scale, o) for x, o in zip(new, rows))
    a, b, c, d = rows

    # along the texts: longest first, so that those still running lead the arrays
    order = np.argsort(-stretches, kind="stable")
    running = np.searchsorted(-stretches[order], -np.arange(1, stretches.max() + 1), side="right")
    enter = np.zeros((total, 2))
    leave = np.zeros((total, 2))
    state = np.tile([1.0, 0.0], (len(order), 1))
    for k, n in enumerate(running):
        s = base[order[:n]] + k
        enter[s] = state[:n]
        x = state[:n, 0] * a[s] + state[:n, 1] * c[s]
        y = state[:n, 0] * b[s] + state[:n, 1] * d[s]
        state[:n, 0], state[:n, 1] = x / (x + y), y / (x + y)
    state = np.tile([0.5, 0.5], (len(order), 1))
    for k in range(len(running) - 1, -1, -1):
        n = running[k]
        s = base[order[:n]] + k
        leave[s] = state[:n]
        x = a[s] * state[:n, 0] + b[s] * state[:n, 1]
        y = c[s] * state[:n, 0] + d[s] * state[:n, 1]
        state[:n, 0], state[:n, 1] = x / (x + y), y / (x + y)

    fa, fb = np.zeros((total, STRETCH)), np.zeros((total, STRETCH))
    x, y = enter[:, 0], enter[:, 1]
    for i in range(STRETCH):
        x, y = forward(x, y, i)
        fa[:, i], fb[:, i] = x, y
    x, y = leave[:, 0].copy(), leave[:, 1].copy()
    both = np.zeros((total, STRETCH))
    for i in range(STRETCH - 1, -1, -1):
        p, q = fa[:, i] * x, fb[:, i] * y
        both[:, i] = q / (p + q)
        u = step[0, 0] * (1 - toxic[:, i]) * x + step[0, 1] * toxic[:, i] * y
        v = step[1, 0] * (1 - toxic[:, i]) * x + step[1, 1] * toxic[:, i] * y
        scale = 1 / (u + v)
        x, y = np.where(real[:, i], u * scale, x), np.where(real[:, i], v * scale, y)
    out[at[real]] = both[real]
    return out


def _pairs(evidence: np.ndarray, length: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of rows of tokens, and expected numbers of the four transitions."""
    n, wide = evidence.shape
    emit = np.stack([np.zeros_like(evidence), evidence], axis=2)
    emit -= np.logaddexp(0, evidence)[:, :, None]
    emit = np.exp(emit)
    real = np.arange(wide) < length[:, None]
    step = np.exp(moves)
    f = np.zeros((n, wide + 1, 2))
    f[:, 0] = [1.0, 0.0]
    for i in range(wide):
        x = (f[:, i] @ step) * emit[:, i]
        f[:, i + 1] = np.where(real[:, i, None], x / x.sum(axis=1, keepdims=True), f[:, i])
    b = np.ones((n, 2))
    marginal = np.zeros((n, wide))
    moved = np.zeros((2, 2))
    for i in range(wide - 1, -1, -1):
        weight = emit[:, i] * b
        pair = f[:, i, :, None] * step[None] * weight[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        marginal[:, i] = pair[:, :, 1].sum(axis=1)
        moved += pair[real[:, i]].sum(axis=0)
        x = weight @ step.T
        b = np.where(real[:, i, None], x / x.sum(axis=1, keepdims=True), b)
    return np.where(real, marginal, 0.0), moved


def _weights(words: Words) -> np.ndarray:
    """One over the number of sampled texts that share a text's smallest shingle hash."""
    hashes, of = shingles(words, 3)
    least = np.full(len(words.first) - 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, of, hashes)
    _, place, count = np.unique(least, return_inverse=True, return_counts=True)
    return 1.0 / count[place]


def _token_labels(all_ids: np.ndarray, words: Words, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Tokens of toxic texts with a feature that is typical of toxic texts.

    Repetitions within a text count by their logarithm.
    """
    text = words.text_of()
    size = np.maximum(np.diff(words.first), 1)
    share = np.array([(weight * size)[toxic].sum(), (weight * size)[~toxic].sum()])
    share = share / share.sum()
    out = np.zeros(len(text), dtype=bool)
    for ids in all_ids:
        seen, count = np.unique(text * BUCKETS + ids, return_counts=True)
        t, feature = seen // BUCKETS, seen % BUCKETS
        mass = weight[t] * np.log2(1 + count)
        bad = np.bincount(feature, weights=mass * toxic[t], minlength=BUCKETS)
        good = np.bincount(feature, weights=mass * ~toxic[t], minlength=BUCKETS)
        all_ = bad + good + 1e-9
        ratio = 2 * (bad * np.log((bad + 1e-9) / (all_ * share[0])) + good * np.log((good + 1e-9) / (all_ * share[1])))
        raised = (bad + 0.5) / share[0] / ((good + 0.5) / share[1])
        several = np.bincount(feature, weights=weight[t] * toxic[t], minlength=BUCKETS) >= SUPPORT
        out |= ((raised >= RAISED) & (ratio >= SURE) & several)[ids]
    return out & toxic[text]


def _chosen(length: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The rows of tokens that the gradient runs over, ``MOST_TOKENS`` tokens at most.

    Rows are picked by hash. Each class has half of the bound, and what the other leaves.
    """
    order = np.argsort(mix(np.arange(1, len(length) + 1)), kind="stable")
    out = np.zeros(len(length), dtype=bool)
    for of in (toxic, ~toxic):
        most = max(MOST_TOKENS // 2, MOST_TOKENS - int(length[~of].sum()))
        mine = order[of[order]]
        out[mine[np.cumsum(length[mine]) <= most]] = True
    return out


def train(texts: list[str], toxic: np.ndarray, share: np.ndarray | None = None, steps: int = STEPS) -> Model:
    """A model of labelled texts; ``share`` has how many rows each text stands for.

    Without texts of both labels nothing can be told apart, and all scores are near 0.
    """
    model = Model()
    toxic = np.asarray(toxic, dtype=bool)
    if not toxic.any() or toxic.all():
        return model
    words = Words(texts, APART)
    ids, weight = token_ids(words), _weights(words)
    label = _token_labels(ids, words, toxic, weight)

    # rows of up to 64 tokens
    text = words.text_of()
    starts = np.flatnonzero((np.arange(len(text)) - words.first[:-1][text]) % 64 == 0)
    length = np.minimum(64, words.first[1:][text[starts]] - starts)
    chosen = _chosen(length, toxic[text[starts]])
    starts, length = starts[chosen], length[chosen]
    if not len(starts) or not label.any():
        return model
    at = np.minimum(starts[:, None] + np.arange(64), len(text) - 1)
    real = np.arange(64) < length[:, None]
    y = label[at] & real
    inner = real.copy()
    inner[:, 0] = False
    past = np.concatenate([np.zeros((len(y), 1), bool), y[:, :-1]], axis=1)
    seen = np.array([[(real & ~past & ~y).sum(), (real & ~past & y).sum()], [(real & past & ~y).sum(), (real & past & y).sum()]])
    now = [row[at] for row in ids]
    near = now[0]
    speed = [np.full(BUCKETS, 1e-6) for _ in range(3)]
    speed_bias, speed_moves = 1e-6, np.full((2, 2), 1e-6)
    weights = [model.now.astype(np.float64), model.before.astype(np.float64), model.behind.astype(np.float64)]
    for _ in range(steps):
        evidence = model.bias + sum(weights[0][row] for row in now)
        evidence[:, 1:] += np.where(inner[:, 1:], weights[1][near[:, :-1]], 0.0)
        evidence[:, :-1] += np.where(inner[:, 1:], weights[2][near[:, 1:]], 0.0)
        marginal, moved = _pairs(evidence, length, model.moves)
        off = np.where(real, y - marginal, 0.0)
        ahead = np.where(inner[:, 1:], off[:, 1:], 0.0)
        back = np.where(inner[:, 1:], off[:, :-1], 0.0)
        for k, (of, value) in enumerate(((now, off), ([near[:, :-1]], ahead), ([near[:, 1:]], back))):
            slope = sum(np.bincount(x.ravel(), weights=value.ravel(), minlength=BUCKETS) for x in of)
            slope -= (0.05 if k == 0 else 0.5) * weights[k]
            speed[k] += slope**2
            weights[k] += (1.0 if k == 0 else 0.2) * slope / np.sqrt(speed[k])
        slope = off.sum()
        speed_bias += slope**2
        model.bias += 0.5 * slope / np.sqrt(speed_bias)
        slope = seen - moved
        slope[0, 0] = 0.0  # fixes the scale
        speed_moves += slope**2
        model.moves += 0.3 * slope / np.sqrt(speed_moves)
    model.now, model.before, model.behind = (w.astype(np.float32) for w in weights)

    known = _features(model, words)
    share = weight * (np.ones(len(texts)) if share is None else share)
    model.score = _logistic(known, toxic, share / share.sum() * len(texts))
    return model


def _features(model: Model, words: Words) -> np.ndarray:
    marginal = marginals(model.evidence(token_ids(words), words.first), words.first, model.moves)
    return _of_texts(marginal, words.first)


def _of_texts(marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: one, its toxic tokens, its largest marginal, and its length if it has any."""
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    sure = np.bincount(text, weights=np.where(marginal >= 0.3, marginal, 0.0), minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, text, marginal)
    long = np.log1p(np.diff(first) / 100)
    return np.stack([np.ones(n), np.log1p(sure), most, np.where(sure > 0, long, 0.0)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small ridge, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 0.1 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(curve, slope), -4, 4)
    return w


def sample(docs: DataFrame, labels: DataFrame, rows: int = MOST_ROWS) -> DataFrame:
    """``text``, ``toxic`` and ``share``, the rows that each stands for: a bounded, hashed sample.

    Of each class the ``rows`` documents with the smallest hashes of their ids, so long as
    the class's texts have ``MOST_BYTES`` together; no class takes from the other's. A text
    of over ``PARTS * PART`` characters counts by stretches, so that none fills the sample.
    A document with both labels is toxic; of rows that share an id one is taken.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where("toxic in (0, 1)")
    total = known.groupBy("toxic").agg(F.count("*").alias("total"))
    order = F.xxhash64("doc_id")
    clean, bad = (known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(rows) for c in (0, 1))
    text = F.coalesce("text", F.lit(""))
    part = stretches(text, F.col("doc_id"), PARTS, PART).alias("part")
    joined = docs.select("doc_id", F.xxhash64(text).alias("of"), text.alias("text")).join(
        F.broadcast(clean.union(bad)), "doc_id"
    )  # two times ``rows`` ids at most
    joined = joined.select("doc_id", "toxic", "of", part)
    one = joined.groupBy("doc_id", "toxic").agg(F.min(F.struct("of", "part"))["part"].alias("text"))
    so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("toxic").orderBy(order, "doc_id"))
    found = one.withColumn("so_far", so_far).where(F.col("so_far") <= MOST_BYTES)
    taken = F.count("*").over(Window.partitionBy("toxic"))
    return found.join(total, "toxic").select("text", "toxic", (F.col("total") / taken).alias("share"))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ``score`` and ``spans`` of each document.

    A span is a run of tokens that are toxic with probability one half or more: its first
    and last byte (exclusive) in the text's UTF-8 form, and its largest probability.
    Null and empty texts have no tokens, no spans and the score of a text without toxic
    words. Repeated rows give repeated results; other columns are left out.
    """
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for n, c in zip(names, keep)], F.col("text").alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the corpus

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        for batch in batches(rows, "t", BATCH_BYTES):
            texts = batch.column("t").to_pylist()
            words = Words(texts, APART)
            marginal = marginals(model.evidence(token_ids(words), words.first), words.first, model.moves)
            p = 1 / (1 + np.exp(-np.clip(_of_texts(marginal, words.first) @ model.score, -30, 30)))
            spans: list[list[dict]] = [[] for _ in texts]
            offset = np.cumsum([0, *(len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts)])
            hit = np.flatnonzero(marginal >= 0.5)
            of = np.searchsorted(words.first, hit, side="right") - 1
            last = (-2, -1)
            for i, t in zip(hit.tolist(), of.tolist()):
                end = int(words.end[i] - offset[t])
                if last == (i - 1, t):
                    spans[t][-1]["end"] = end
                    spans[t][-1]["probability"] = max(spans[t][-1]["probability"], float(marginal[i]))
                else:
                    spans[t].append({"begin": int(words.begin[i] - offset[t]), "end": end, "probability": float(marginal[i])})
                last = (i, t)
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p), pa.array(spans, kind)], names=[*names, "p", "s"])

    none = F.lit(None)
    schema = rows.select(*names, none.cast("double").alias("p"), none.cast(SPANS).alias("s")).schema
    scored = rows.mapInArrow(run, schema)
    return scored.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("p").alias("score"), F.col("s").alias("spans")
    )


def model_of(docs: DataFrame, labels: DataFrame, held_out: int | None = 0) -> Model:
    """A model of the labelled documents whose CRC-32 remainder by 5 is not ``held_out``.

    One task trains on the bounded sample; the driver sees the model only. Where documents
    of both labels are known and nothing was learned from them, a warning says so.
    """
    if held_out is not None:
        labels = labels.where(remainder("doc_id", 5) != held_out)

    def fit(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches_ for row in batch.to_pylist()]
        rows.sort(key=lambda r: (r["text"], r["toxic"]))
        toxic = np.array([r["toxic"] == 1 for r in rows], dtype=bool)
        model = train([r["text"] for r in rows], toxic, np.array([r["share"] for r in rows]))
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    row = sample(docs, labels).coalesce(1).mapInArrow(fit, "model binary").first()
    model = pickle.loads(row.model) if row else Model()
    if not model.now.any() and labels.where("doc_id is not null and toxic in (0, 1)").select("toxic").distinct().count() == 2:
        warnings.warn("no toxic words learned from labels of both classes: all scores are near 0", stacklevel=2)
    return model


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned without the fifth that is held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, model_of(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )
