from collections import Counter, defaultdict

from pyspark.sql import functions as F

from facetide.llm import sharding


def checked(docs, limit):
    rows = sharding.shard(docs, limit=limit).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    held = defaultdict(list)
    for r in rows:
        assert r["n_bytes"] == len((r["text"] or "").encode())
        held[r["shard"]].append(r)
    for name, group in held.items():
        assert name[0] in "bc" and set(name[1:]) <= set("01")
        total = sum(r["n_bytes"] for r in group)
        assert {(r["shard_bytes"], r["shard_docs"]) for r in group} == {(total, len(group))}
        assert total <= limit or len(group) == 1
    # No shard's bits begin another's, and a shard and its sibling together are too large.
    names = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for a, b in zip(names, names[1:]):
        if len(a) == len(b) > 1 and a[:-1] == b[:-1]:
            assert sum(r["n_bytes"] for n in (a, b) for r in held[n]) > limit
    return held


def test_only_oversized_buckets_split(spark):
    rows = [(i, "x" * (1 + 37 * i % 900)) for i in range(1500)]
    held = checked(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 9_000)
    assert len({len(n) for n in held}) > 1


def test_a_hot_key_is_split(spark):
    rows = [(7, "x" * 100)] * 400 + [(i, "y" * 50) for i in range(100)] + [(None, "z" * 80)] * 50
    held = checked(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3_000)
    assert any(n.startswith("c") for n in held)


def test_every_reading_of_a_hot_key_agrees(spark):
    """Copies of one key get their second hash once: counts, filters and rows read afterwards tell the same."""
    rows = [(7, "x" * 10)] * 4000 + [(i, "y" * 50) for i in range(100)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), limit=3_000)
    assert out.where("shard is null").count() == 0 and out.count() == 4100
    held = Counter(r["shard"] for r in out.collect())
    again = {r["shard"]: (r["count"], r["n"]) for r in out.groupBy("shard").agg(
        F.count(F.lit(1)).alias("count"), F.first("shard_docs").alias("n")).collect()}
    assert {s: (n, n) for s, n in held.items()} == again
    assert out.repartition(7).where("shard like 'c%'").agg(F.sum("n_bytes")).first()[0] == 40_050


def test_odd_rows(spark, odd, none):
    for limit in (100, 10_000, 1 << 25):
        checked(odd, limit)
    assert sharding.shard(none).count() == 0
    out = sharding.shard(odd, limit=1000)
    assert [c for c in out.columns if c.lower() == "shard"] == ["shard"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
