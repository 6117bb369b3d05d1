import numpy as np
import pytest

from rillstone.llm import decontaminate

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def plain_distance(item, part):
    """Least edits between the item and any stretch of ``part``, by the textbook."""
    last = [0] * (len(part) + 1)
    for word in item:
        now = [last[0] + 1]
        for j, other in enumerate(part):
            now.append(min(last[j] + (word != other), last[j + 1] + 1, now[j] + 1))
        last = now
    return min(last)


def test_edit_distance():
    rng = np.random.default_rng(0)
    for _ in range(200):
        item = rng.integers(0, 5, rng.integers(1, 12)).astype(np.uint64)
        part = rng.integers(0, 5, rng.integers(0, 15)).astype(np.uint64)
        edits, start, end = decontaminate.edit_distance(item, part)
        assert edits == plain_distance(item.tolist(), part.tolist())
        assert 0 <= start <= end <= len(part)
        assert edits == plain_distance(item.tolist(), part[start:end].tolist())


def hidden(items, share, seed, hosts):
    """Each item in a host text, after edits of a share of its words."""
    rng = np.random.default_rng(seed)
    texts = []
    for _, text in items:
        words = [w for w in "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text).split()]
        for _ in range(int(share * len(words))):
            kind, at = int(rng.integers(0, 3)), int(rng.integers(0, len(words)))
            if kind == 0:
                words[at] = f"zq{rng.integers(1e6)}"
            elif kind == 1:
                words.insert(at, f"zq{rng.integers(1e6)}")
            else:
                del words[at]
        host = hosts[int(rng.integers(0, len(hosts)))].split()
        at = int(rng.integers(0, len(host) + 1))
        texts.append(" ".join([*host[:at], *words, *host[at:]]))
    return texts


@pytest.mark.parametrize("share,recall", [(0.0, 1.0), (0.05, 0.99), (0.1, 0.99), (0.2, 0.93)])
def test_recall_by_edits(items, share, recall):
    index = decontaminate.build(items)
    hosts = ["the of and a in to was here " * n for n in (1, 5, 40)]
    found = decontaminate.matches(hidden(items, share, 1, hosts), index)
    hit = [any(m["item_id"] == i for m in ms) for (i, _), ms in zip(items, found)]
    assert np.mean(hit) >= recall


def test_against_brute_force(spark, items):
    """Over whole documents: exactly the passages within the bound, for exact and edited ones."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    texts = [r.text or "" for r in docs.collect() if len(r.text or "") < 4000]
    texts += hidden(items[:25], 0.1, 2, texts)
    some = items[:60]
    index = decontaminate.build(some)
    found = decontaminate.matches(texts, index)
    words = decontaminate.Tokens(texts)
    missed = wrong = total = 0
    for t in range(len(texts)):
        own = words.hash[words.first[t] : words.first[t + 1]]
        expected = {i for i, w in zip(index.ids, index.items) if decontaminate.edit_distance(w, own)[0] <= decontaminate.allowed(len(w))}
        got = {m["item_id"] for m in found[t]}
        total += len(expected)
        missed += len(expected - got)
        wrong += len(got - expected)
    assert total >= 25 and wrong == 0 and missed <= 0.02 * total


def found_in(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(docs, bench).collect()
    return {r.doc_id: sorted((m.item_id, m.first_word, m.end_word, m.distance) for m in r.matches) for r in rows}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_short_items_match_word_by_word(spark, n):
    words = "Alpha beta, gamma-delta epsilon zeta".replace(",", "").replace("-", " ").split()[:n]
    item = " ".join(words)
    texts = [
        item, f"x {item.upper()}. y", "x " + " q ".join(words) + " z", " ".join(words[:-1]), f"{item} {item}",
        item[:-1], None, "", words[-1] + " " + " ".join(words[:-1]) if n > 1 else "none",
    ]
    got = found_in(spark, [(7, item), (7, item), (8, "other thing")], texts)
    assert got[0] == [(7, 0, n, 0)] and got[1] == [(7, 1, 1 + n, 0)] and got[4] == [(7, 0, n, 0), (7, n, 2 * n, 0)]
    assert got[2] == ([] if n > 1 else [(7, 1, 2, 0)])
    assert not any(got[i] for i in (3, 5, 6, 7, 8))


def test_a_short_item_does_not_reach_over_the_end_of_a_text(spark):
    assert found_in(spark, [(1, "one two")], ["x one", "two y", "one two"]) == {0: [], 1: [], 2: [(1, 0, 2, 0)]}


def test_scripts_without_spaces_go_by_characters(spark):
    item = "天地玄黃宇宙洪荒日月盈昃辰宿列張"
    edited = item[:5] + "新" + item[6:]
    texts = ["前文" + item + "後文", "abc" + edited + " def", item[::-1], "天地玄", "ภาษาไทยเขียนติดกัน", "寒來暑往"]
    got = found_in(spark, [(1, item), (2, "天地玄"), (3, "ไทย"), (4, "寒來")], texts)
    assert (1, 2, 18, 0) in got[0] and (2, 2, 5, 0) in got[0]
    assert [m[0] for m in got[1]] == [1, 2] and got[1][0][3] == 1
    assert got[2] == [] and got[3] == [(2, 0, 3, 0)] and [m[0] for m in got[4]] == [3] and [m[0] for m in got[5]] == [4]


def test_tokens_make_up_the_words(plain_words):
    text = "abc漢字def ghi, ñandú カナ-x 한국어 말 𠀀𠀁z ไทย"
    tokens = decontaminate.Tokens([text, "", "漢"])
    words = [tokens.word(i).decode() for i in range(len(tokens))]
    assert words == ["abc", "漢", "字", "def", "ghi", "ñandú", "カ", "ナ", "x", "한국어", "말", "𠀀", "𠀁", "z", "ไ", "ท", "ย", "漢"]
    assert tokens.first.tolist() == [0, 17, 17, 18]


def test_recall_out_of_reach_raises(monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_WALKS", 2)
    items = [np.arange(i, i + 40, dtype=np.uint64) * np.uint64(7919) for i in range(5)]
    with pytest.raises(RuntimeError, match="recall"):
        decontaminate.enough_walks(items, 1.1)


def test_a_run_that_many_items_hold(items, monkeypatch):
    many = [(i, f"one two three w{i} x{i} y{i} z{i} q{i}") for i in range(300)]
    texts = ["a one two three b " * 20, many[17][1], "one two three w5 x5 y5 z5"]
    index = decontaminate.build(many)
    whole = decontaminate.matches(texts, index)
    monkeypatch.setattr(decontaminate, "WINDOWS", 100)
    assert decontaminate.matches(texts, index) == whole
    assert [m["item_id"] for m in whole[1]] == [17] and [m["item_id"] for m in whole[2]] == [5] and whole[0] == []


def test_planted_leaks_in_the_tables(spark, items):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    exact = {d.doc_id for d in docs for _, t in items if d.text and t in d.text}
    got = {r.doc_id for r in decontaminate.op7_decontamination(spark, SF).where("contaminated").collect()}
    assert exact and exact <= got and len(got - exact) <= 0.05 * len(exact) + 1


def test_blocks_of_items(spark, items, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r.doc_id, tuple(sorted(m.item_id for m in r.matches))) for r in decontaminate.find(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 9000)
    parts = {(r.doc_id, tuple(sorted(m.item_id for m in r.matches))) for r in decontaminate.find(docs, bench).collect()}
    assert whole == parts


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, None), (2, ""), (3, "no such short item"), (6, "...!"), (None, "one two three four five six"),
         (4, "one two three four five six"), (4, "one two three four five six"), (5, "日 " * 9)],
        "item_id long, text string",
    )
    rows = decontaminate.find(odd_docs, bench, ("doc_id", "matches")).drop("matches")
    assert rows.count() == odd_docs.count()
    rows = decontaminate.find(odd_docs, bench).collect()
    assert {r.doc_id for r in rows if r.matches} == {12, 13}
    assert decontaminate.find(no_docs, bench).count() == 0
    assert not any(r.matches for r in decontaminate.find(odd_docs, bench.limit(0)).collect())
