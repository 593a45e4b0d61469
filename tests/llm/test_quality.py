import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from facetide.llm import quality


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def hashed(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p.encode(), seed=seed).intdigest()
    return signed(seed)


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    repeated = {k for at in seen.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
            n < 10 or 100 * len(repeated) > 20 * n)


def grams(text):
    import regex

    t = regex.findall(quality.TOKEN, text or "")
    return [hashed(x) % quality.BUCKETS for x in t] + [hashed(a, b) % quality.BUCKETS for a, b in zip(t, t[1:])]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_and_scores_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    trusted = {r["doc_id"] for r in good.collect()}
    raw, kept = [0] * quality.BUCKETS, [0] * quality.BUCKETS
    for i, t in texts.items():
        for b in grams(t):
            raw[b] += 1
            kept[b] += i in trusted
    extra, scale = quality.SMOOTHING * sum(kept) / quality.BUCKETS, sum(raw) / sum(kept)
    ratio = [math.log((g + extra) * scale / (r + extra * scale)) for g, r in zip(kept, raw)]
    for r in quality.quality(docs, good).collect():
        held = grams(texts[r["doc_id"]])
        score = sum(ratio[b] for b in held) / len(held) if held else 0.0
        assert tuple(r[c] for c in COUNTS) == base(texts[r["doc_id"]])
        assert r["score"] == pytest.approx(score, abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.MIN_SCORE)


def test_odd_rows_and_clashing_columns(spark, odd, none):
    ratio = [0.0] * quality.BUCKETS
    out = quality.judge(odd, ratio)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "Shard", *quality.RESULTS]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert tuple(r[c] for c in COUNTS) == base(r["text"])
    # A filter on a result must not be slower for being pushed below the work.
    assert out.where("kept").count() == sum(r["kept"] for r in rows)
    assert quality.judge(none, ratio).count() == 0
    assert quality.fit(none, none) == ratio and quality.fit(odd, none) == ratio


def test_repeated_trusted_keys_count_once(spark, odd):
    keys = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    assert quality.fit(odd, keys) == quality.fit(odd, keys.distinct())


def test_all_trusted_documents_are_counted(spark, monkeypatch):
    docs = spark.range(70_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    # If all are trusted, every bucket is seen alike in both.
    assert max(map(abs, quality.fit(docs, docs))) < 1e-12
    few = docs.where("doc_id % 3 = 0")
    whole = quality.fit(docs, few)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 400_000)
    assert quality.fit(docs, few) == whole


def test_no_text_is_shuffled(spark, odd):
    plan = quality.judge(odd, [0.0] * quality.BUCKETS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert F is not None
