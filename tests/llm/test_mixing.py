import re
from collections import Counter, defaultdict

import pytest

from facetide.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Share by weight; what is above twice a source goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, open_ones, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_ones:
        level = (budget - sum(out.values())) / sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if weight[s] * level > 2 * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_ones}
        out |= {s: 2.0 * sizes[s] for s in full}
        open_ones -= full
    return out


def checked(docs, rows):
    sizes, taken = defaultdict(int), Counter()
    texts = Counter((r["doc_id"], words(r["text"]), r["source"]) for r in docs.collect())
    assert texts == Counter((r["doc_id"], r["size"], r["source"]) for r in rows)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    return sizes, taken, want


def test_sources_come_near_their_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs).collect()
    _, taken, want = checked(docs, rows)
    most = Counter()
    for r in rows:
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.5 * most[s], 1)
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mix(docs.repartition(5)).collect()))


def test_a_hot_source_and_ties(spark):
    rows = [(i, "w " * (1 + i % 40), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    _, taken, want = checked(docs, mixing.mix(docs).collect())
    for s, t in want.items():
        assert abs(taken[s] - t) <= 40


def test_rates_are_exponentially_tilted(spark):
    rows = [(i, "w " * (1 + i % 200), "abc"[i % 3]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    low = [r for r in mixing.mix(docs).collect() if r["source"] == "c"]
    # The source that weighs least gives up its long documents first.
    rate = lambda f: sum(r["copies"] for r in low if f(r["size"])) / sum(f(r["size"]) for r in low)
    assert rate(lambda s: s < 20) > rate(lambda s: 80 < s < 120) > rate(lambda s: s > 180)


def test_odd_rows(spark, odd, none):
    checked(odd, mixing.mix(odd).collect())
    assert mixing.mix(none).count() == 0
    empty = odd.where("doc_id in (3, 4)")
    assert {r["taken"] for r in mixing.mix(empty).collect()} == {0}


def test_only_functions(spark, odd):
    plan = mixing.mix(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
