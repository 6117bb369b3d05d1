import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillstone.llm import patricia


def spaced(text):
    return re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode())


def check(docs, out):
    """The smallest id of equal texts owns all of them, and exactly one row of each stays."""
    rows = [(r.doc_id, spaced(r.text)) for r in docs.collect()]
    size = Counter(text for _, text in rows)
    least = {}
    for i, text in rows:
        if i is not None:
            least[text] = min(i, least.get(text, i))
    want = Counter((i, least.get(t), size[t], hashlib.sha256(t).hexdigest()) for i, t in rows)
    got = out.collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert Counter(r.text_sha256 for r in kept) == Counter(hashlib.sha256(t).hexdigest() for t in size)
    assert all(r.doc_id == r.keep_id for r in kept)


@given(st.binary(max_size=30))
@settings(max_examples=300, deadline=None)
def test_runs_of_white_space(data):
    assert patricia.normal(data) == re.sub(rb"[\x20\x09-\x0D]+", b" ", data)


@given(st.lists(st.text("ab\x00é", max_size=8).map(str.encode), max_size=40), st.integers(0, 3))
@settings(max_examples=300, deadline=None)
def test_trie_is_a_map(keys, spills):
    trie, plain, gone = patricia.Trie(), {}, []
    for n, key in enumerate(keys):
        assert trie.owner(key, lambda: [n, key]) is plain.setdefault(key, trie.owner(key, lambda: None))
        assert plain[key][1] == key
        if spills and n % 7 == 6 and trie.held:
            out = list(trie.spill())
            gone += out
            assert all(plain.pop(k) is o for k, o in out)
    assert dict(trie.items()) == plain
    assert trie.size == sum(trie.held.values()) and len(gone) + len(plain) >= len(set(keys))


def test_edges_hold_whole_stretches():
    trie = patricia.Trie()
    for key in (b"x" * 10_000 + b"a", b"x" * 10_000 + b"b", b"x" * 5_000):
        trie.owner(key, lambda: key)
    assert trie.size == 10_002 + 4 * patricia.NODE and len(dict(trie.items())) == 3


@pytest.mark.parametrize("memory", [patricia.MEMORY, 2_000])
def test_odd_documents(odd_docs, memory):
    check(odd_docs, patricia.exact_duplicates(odd_docs, memory=memory))


def test_many_copies_over_many_tasks(spark):
    texts = "element_at(array('a b', 'a  b', ' a b', '', '\t', 'long ' || repeat('x', 5000)), int(id % 6) + 1)"
    docs = spark.range(3000).repartition(13).selectExpr("3000 - id as doc_id", f"if(id % 50 = 0, null, {texts}) as text")
    check(docs, patricia.exact_duplicates(docs, memory=9_000))


def test_texts_of_one_place_are_told_apart(spark):
    """Even where length and hash agree, bytes decide."""
    rows = [(i, None, 5, 77, text, i, i, 1) for i, text in enumerate([b"aaaaa", b"aaaab", b"aaaaa", b"baaaa"])]
    met = spark.createDataFrame(
        rows, "ref long, x string, length long, hash long, text binary, least long, least_row long, copies long"
    ).drop("x").coalesce(1)
    got = met.mapInArrow(patricia._settle(), "ref long, keep long, keep_row long, size long, sha string").collect()
    assert {(r.ref, r.keep, r.size) for r in got} == {(0, 0, 2), (2, 0, 2), (1, 1, 1), (3, 3, 1)}


def test_rows_of_one_id_and_text(spark):
    docs = spark.createDataFrame([(1, "t")] * 5 + [(None, "t"), (None, "u"), (None, "u")], "doc_id long, text string")
    check(docs, patricia.exact_duplicates(docs))


def test_carried_columns(spark):
    docs = spark.createDataFrame([(2, "t", "x", [1]), (1, "t ", None, None), (3, "t", "z", [])], "doc_id long, text string, keep string, ref array<int>")
    got = patricia.exact_duplicates(docs, carry=("keep", "ref")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.keep, r.ref, r.keep_id, r.kept) for r in got] == [(1, None, None, 1, True), (2, "x", [1], 2, True), (3, "z", [], 2, False)]


def test_identifiers_may_be_text(spark):
    docs = spark.createDataFrame([("b", "t"), ("a", "t"), (None, "t")], "doc_id string, text string")
    check(docs, patricia.exact_duplicates(docs))


def test_empty(no_docs):
    assert patricia.exact_duplicates(no_docs).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    check(spark.read.parquet(f"{sf}/documents.parquet"), patricia.op13_exact_dedup(spark, sf))
