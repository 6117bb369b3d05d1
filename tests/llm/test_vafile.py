import hashlib

import numpy as np
import pytest

from rillstone.llm import vafile

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, k, rounds, seed=3):
    """Every distance of every round, in Python's integers."""
    ids = [i for i, _ in rows]
    v = [[int(np.floor(1024 * x)) for x in e] for _, e in rows]
    first = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [c for _, c in sorted(zip(ids, v), key=first)[:k]]
    for turn in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids] for x in v]
        nearest = [f.index(min(f)) for f in far]
        if turn < rounds:
            for c in range(len(centroids)):
                mine = [x for x, n in zip(v, nearest) if n == c]
                if mine:
                    centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    total = {c: sum(f[n] for f, n in zip(far, nearest) if n == c) for c in range(len(centroids))}
    spelled = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (-1 if i is None else i, n, f[n], total[n], sum(total.values()), spelled[n]) for i, n, f in zip(ids, nearest, far)
    )


def got(frame):
    names = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((-1 if r.vec_id is None else r.vec_id, *(r[c] for c in names)) for r in frame.collect())


@pytest.mark.parametrize("bits,page,rounds", [(2, 16, 1), (4, 16, 10), (6, 4096, 10), (8, 50, 3)])
def test_equals_plain_rounds(spark, bits, page, rounds):
    rng = np.random.default_rng(bits)
    centres = rng.normal(0, 1, (5, 6))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.4, 6)).tolist()) for i in range(300)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[4][1]), (None, rows[4][1])]  # ties and repeated rows
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    out = vafile.cluster(frame, 4, rounds, 6, bits=bits, page=page)
    assert got(out) == plain(rows, 4, rounds)


def test_equal_distances_go_to_the_smaller_centroid(spark):
    rows = [(i, [float(i % 3 - 1), 0.0]) for i in range(60)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert got(vafile.cluster(frame, 5, 4, 2, page=8)) == plain(rows, 5, 4)


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.5, -0.5]), (2, [0.25, 3.0])]
    assert got(vafile.cluster(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), 8, 10, 2)) == plain(rows, 8, 10)


def test_unusable_vectors_and_clashing_names(spark):
    inf, nan = float("inf"), float("nan")
    bad = [(1, None, 1), (2, [], 1), (3, [1.0], 1), (4, [1.0, None], 1), (5, [inf, 1.0], 1), (6, [nan, 1.0], None), (7, [1.0] * 3, 1)]
    rows = [(10 + i, [i / 7, -i / 3]) for i in range(20)] + [(90, [1e308, -1e308])]
    frame = spark.createDataFrame(bad + [(*r, None) for r in rows], SCHEMA)
    for name in ("cluster", "distance", "cells", "v", "page", "nearest", "margin", "inertia", "any", "c", "d", "x", "n"):
        frame = frame.selectExpr("*", f"'c' as {name}")
    clipped = [(i, [max(-65536.0, min(65536.0, x)) for x in e]) for i, e in rows]
    assert got(vafile.cluster(frame, 3, 5, 2)) == plain(clipped, 3, 5)


def test_empty(spark):
    out = vafile.cluster(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("bits", range(1, 9))
def test_intervals_hold_the_distance(bits):
    rng = np.random.default_rng(bits)
    v = rng.integers(-2000, 2000, (500, 7))
    v[:2] = [[-(1 << 26)] * 7, [1 << 26] * 7]
    f = v.astype(float)
    cells = vafile.make_cells(v.min(0), v.max(0), f.mean(0), f.std(0), bits)
    numbers = vafile.cell_numbers(cells, v)
    assert (vafile.unpack(vafile.pack(numbers, bits), bits, 7) == numbers).all()
    centroids = v[:6]
    tables = vafile.lookup(cells, centroids)
    low, high = vafile.intervals(numbers, tables)
    far = vafile.distances(v, centroids)
    relative = far - vafile.distances(v, cells.middle[None])
    assert (low <= relative).all() and (relative <= high).all()
    sure = vafile.decided(numbers, tables)
    assert (sure[sure >= 0] == far.argmin(axis=1)[sure >= 0]).all()


def test_settled_pages_are_not_read(spark):
    """Far apart groups: after the first rounds the cells alone assign every vector."""
    rng = np.random.default_rng(1)
    rows = [(i, (10.0 * (i % 4) + rng.normal(0, 0.01, 8)).tolist(), 1) for i in range(800)]
    frame = vafile._usable(spark.createDataFrame(rows, SCHEMA), 8)
    count, by = vafile._statistics(frame, 8)
    cells = vafile.make_cells(by[:, 0].astype(int), by[:, 1].astype(int), by[:, 2], by[:, 3], 6)
    start = np.array([[10240 * g + 300] * 8 for g in range(4)])
    file = vafile.write_file(frame, count, cells, start, 6, 64)
    assert file.rows.select("page").distinct().count() > 5
    centroids, fetched = vafile.fit(file, start, 6)
    assert sum(fetched) == 0 and (np.abs(centroids - start) < 600).all()


def test_ranges_cover_the_pages():
    pages = [1, 2, 3, 9, 10, 20, 40, 41]
    assert vafile.ranges(pages) == [(1, 3), (9, 10), (20, 20), (40, 41)]
    assert vafile.ranges(pages, 2) == [(1, 20), (40, 41)]
    assert vafile.ranges([]) == [] and vafile.ranges([5], 1) == [(5, 5)]
