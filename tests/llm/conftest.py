import re

import pytest

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: Names that the operators use within, so that a clash would show.
CLASHING = "score spans w hits found base k0 t l id of p s ids shard slot size n node u v value block bucket matches"


@pytest.fixture(scope="session")
def plain_words():
    """Words parted by ASCII white space, A to Z in lower case, as byte strings."""
    return lambda text: re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))


@pytest.fixture(scope="session")
def odd_texts():
    long_ = " ".join(f"word{i % 997} filler{i}" for i in range(30_000))
    return [
        None, "", " ", "\n\n", "x", "Ünïcödé ñ \x00 \x01", "All rights reserved.", "é" * 3000, long_, long_,
        "a " * 5000, "日本語。テキスト", "one two three four five six", "one two three four five six",
        "İK CC BY-SA 4.0 and the GNU GENERAL PUBLIC LICENSE, version 3", "🏳️‍🌈👨‍👩‍👧",
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """Odd texts, null and repeated ids, repeated rows, and columns with clashing names."""
    rows = [(i, x, "en" if i % 2 else None, "s", len(x or "")) for i, x in enumerate(odd_texts)]
    rows += [(None, "null id text here", None, None, None), (None, None, None, None, None), rows[4], rows[4]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING.split():
        docs = docs.selectExpr("*", f"'c' as {name}")
    return docs.cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
