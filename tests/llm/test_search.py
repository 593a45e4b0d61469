import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetide.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    held = [(k, Counter(terms(t))) for k, t in docs]
    held = [(k, c) for k, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for i, ts in wanted.items():
        scored = []
        for k, c in held:
            m = 100 - 90 + 90 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in ts if t in c)
            if score > 0:
                scored.append((-score, k is None, k))
        out += [(i, r, k, -s) for r, (s, _, k) in enumerate(sorted(scored)[:top], 1)]
    return out


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=order)


def order(row):
    return tuple((x is None, x) for x in row)


def texts(seed, n):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{int(rng.zipf(1.3)) % 300}"
    out = [" ".join(word() for _ in range(rng.integers(0, 60))) for _ in range(n)]
    return out + out[:n // 3] + [out[0]] * (n // 2)  # copies, so many ties


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many blocks of items, many cuts of documents
        monkeypatch.setattr(search, "BLOCK_POSTINGS", 20)
        monkeypatch.setattr(search, "CELLS", 30)
        monkeypatch.setattr(search, "GROUPS", 2)
    docs = list(enumerate(texts(0, 60)))
    items = [(f"i{k}", t) for k, t in enumerate(texts(1, 8)[:10])] + [("i0", "W7 w8-w9"), ("none", "..."), (None, "w1 w2")]
    found = search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                          spark.createDataFrame(items, "item_id string, text string"), top=7)
    assert rows(found) == sorted(brute(docs, items, 7), key=order)


def test_string_keys_and_few_documents(spark):
    docs = [("b", "Red fox"), ("a", "red FOX"), ("ä", "red fox"), ("c", "blue"), ("d", None), (None, "red fox")]
    items = [(1, "fox; Fox"), (2, "green")]
    found = search.search(spark.createDataFrame(docs, "doc_id string, text string"),
                          spark.createDataFrame(items, "item_id int, text string"))
    assert rows(found) == sorted(brute(docs, items), key=order)
    assert [r[2] for r in rows(found)] == ["a", "b", "ä", None]


def test_odd_rows(spark, odd, none):
    items = [(1, "quick brown fox word3 and7"), (2, "日本 ok"), (3, None), (None, "one a B")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({"score": F.lit(1), "rank": F.lit(2)})
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = search.search(odd.withColumns({"item": F.lit(1), "doc": F.lit(2), "item_id": F.lit(3)}), bench)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == sorted(brute(docs, items), key=order)
    assert rows(search.search(none, bench)) == [] and rows(search.search(odd, bench.limit(0))) == []


def test_lengths_beyond_64_bits_do_not_overflow():
    heaps = search.Heaps(search.Index([], np.zeros(0, np.int64), np.zeros(0, np.uint64)), np.zeros(0, np.int64), 10**12, 10**15, 10)
    assert heaps.length(np.array([10**9, 3])).tolist() == [10 + 90 * 10**21 // 10**15, 10 + 90 * 3 * 10**12 // 10**15]
