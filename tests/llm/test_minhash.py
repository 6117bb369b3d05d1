import numpy as np
import pytest

from rillstone.llm import minhash


def groups(docs, plain_words, size=5, percent=85):
    sets = {}
    for i, text in docs:
        w = plain_words(text)
        sets[i] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n=130):
    """Families of copies with growing edits, chains, passages in common, short and empty texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "w%d" % rng.integers(0, 4000)
    shared = [word() for _ in range(30)]
    docs = []
    while len(docs) < n:
        base = [word() for _ in range(int(rng.integers(1, 160)))]
        if rng.random() < 0.3:
            base += shared
        for _ in range(int(rng.integers(1, 9))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(0, len(copy)))] = word()
            docs.append((len(docs), " ".join(copy)))
            if rng.random() < 0.5:
                base = copy  # a chain: the next copy is of this one
    return [*docs, (1000, ""), (1001, None), (1002, "one two"), (1003, "ONE\ttwo"), (1004, "one")]


@pytest.mark.parametrize("seed,block,percent", [(0, 512, 85), (1, 3, 85), (2, 512, 80), (3, 2, 80)])
def test_against_brute_force(spark, plain_words, monkeypatch, seed, block, percent):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = near_copies(seed)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=percent).collect()
    expected = groups(docs, plain_words, percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_overlaps_are_exact():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(20)]
    got = minhash._overlaps(sets, 20)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


def test_a_sketch_rarely_shares_less():
    rng = np.random.default_rng(4)
    for percent in (80, 85):
        # exactly at the threshold: union 2000, intersection percent hundredths
        worst = minhash.K
        for _ in range(300):
            union = rng.permutation(2000)
            both = 20 * percent
            a = np.sort(union[: both + (2000 - both) // 2])[: minhash.K]
            b = np.sort(np.concatenate([union[:both], union[both + (2000 - both) // 2 :]]))[: minhash.K]
            worst = min(worst, len(np.intersect1d(a, b)))
        assert worst >= minhash.least_shared(percent)


def test_odd_rows(spark, odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[8].component_id == by[9].component_id == 8 and by[8].kept and not by[9].kept
    assert by[12].component_id == by[13].component_id == 12
    assert by[1].component_id == 1 and by[1].kept and by[1].n_shingles == 0
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert minhash.near_duplicates(no_docs).count() == 0
