import math

import numpy as np
import pytest

from rillstone.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, id string, key string, codes string"


def brute(rows, threshold=0.98):
    links = {i: 0 for i, _, _ in rows}
    root = {i: i for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def usable(e, label):
        return label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            (i, x, l), (j, y, m) = rows[a], rows[b]
            if usable(x, l) and usable(y, m) and l == m and len(x) == len(y):
                p, q = np.float32(x).astype(float), np.float32(y).astype(float)
                if p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    s, t = sorted((find(i), find(j)))
                    root[t] = s
    return {i: (links[i], find(i)) for i in links}


def vectors(seed, n=160, d=24):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rng.standard_normal(d)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (base + rng.normal(0, 0.12, d)).astype(np.float32).tolist(), label))
            if rng.random() < 0.2:
                rows.append((len(rows), rows[-1][1], label))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * d, [nan] * d, [inf] * d, [None, *[1.0] * (d - 1)], [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + i, x, 1) for i, x in enumerate(odd)]
    return [*rows, (2000, rows[0][1], None), (2001, rows[0][1], 7)]


def result(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame, **options).collect()}


@pytest.mark.parametrize("seed,block", [(0, 1024), (1, 5)])
def test_against_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = vectors(seed)
    assert result(spark, rows) == {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}


def test_buckets_find_what_whole_labels_find(spark):
    rows = vectors(5, 300)
    assert result(spark, rows, bucket=8) == {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}


def test_recall_of_the_tables_is_as_computed():
    rng = np.random.default_rng(6)
    d, bits = 32, 6
    tables = embeddings.tables_needed(bits, 0.98)
    a = rng.standard_normal((3000, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((3000, d))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * side
    meet = (embeddings.bucket_codes(a, bits, tables) == embeddings.bucket_codes(b, bits, tables)).any(axis=1)
    assert meet.mean() >= 0.998


def test_estimates_are_unbiased_and_within_their_bound():
    rng = np.random.default_rng(7)
    d, n = 64, 4000
    a = rng.standard_normal((n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((n, d))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * side
    x, y = a @ embeddings.rotation(d, 0).T, b @ embeddings.rotation(d, 0).T
    factor = np.abs(x).sum(axis=1) / math.sqrt(d)
    estimate = (np.sign(x) * y).sum(axis=1) / (factor * math.sqrt(d))
    assert abs(estimate.mean() - 0.98) < 0.002
    assert (estimate >= embeddings._bound(factor, d, 0.98)).all()


def test_empty_and_null_ids(spark):
    assert result(spark, []) == {}
    got = embeddings.near_duplicates(
        spark.createDataFrame([(None, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (3, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")
    ).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.kept) for r in got) == [(-1, 0, True), (3, 1, True), (3, 1, True)]


@pytest.mark.parametrize("scale", [1e-200, 1e-310, 1e200, 1.0])
def test_doubles_of_any_size(spark, scale):
    rows = [(1, [scale, scale], 1), (2, [scale, 1.0001 * scale], 1), (3, [-scale, scale], 1), (4, [scale, 0.5 * scale], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4)}


@pytest.fixture(scope="module")
def planted(spark):
    """A table, near copies of its vectors, and the links of every row with all others."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()]
    rng = np.random.default_rng(8)
    for i, vector, label in rows[::7]:
        noise = rng.normal(0, 1, len(vector))
        for k, share in enumerate((0.1, 0.17, 0.19, 0.21)):
            near = np.array(vector) + share * np.linalg.norm(vector) * noise / np.linalg.norm(noise)
            rows.append((100_000 + 10 * i + k, near.astype(np.float32).tolist(), label))
    unit = np.array([vector for _, vector, _ in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([label for *_, label in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    found = {rows[i][0]: int(n) - 1 for i, n in enumerate(near.sum(axis=1))}
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").cache(), found


@pytest.mark.parametrize("options", [{}, {"bucket": 16}, {"bucket": 16, "recall": 1.0}])
def test_recall_on_the_table(planted, options):
    """Whole labels, buckets of a few vectors, and the exact way, against all pairs."""
    vectors, whole = planted
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(vectors, **options).collect()}
    assert sum(whole.values()) > 1000 and all(got[i] <= n for i, n in whole.items())
    assert sum(got.values()) >= (0.999 if options.get("bucket") and "recall" not in options else 1.0) * sum(whole.values())
