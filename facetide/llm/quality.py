"""Quality rules: counted rules, then a hashed n-gram log-likelihood ratio between trusted and raw text.

Two multinomials over ``BUCKETS`` hash buckets of token unigrams and bigrams are counted over all documents: one from the
documents that are trusted (all of them), one from the whole corpus. A document's score is the mean of log(trusted / raw) over its
n-grams, so that its length does not matter. Every document is judged by the same fixed threshold.

All of it is DataFrame functions. Counting sends the trusted keys to the texts, in blocks of bounded size with a pass over
the texts each, and shuffles bucket counts; judging is a map.

Defined cases: a null or empty text has no words, fails the base rules and scores 0. A null key is never trusted. Repeated
keys in the trusted table count once; repeated documents are judged one by one. Columns of the input with the name of a
result are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from facetide.functions._util import let
from facetide.llm.common import BETWEEN_WORDS, WORD, apart, constants, fenced, without

BUCKETS = 1 << 14
#: Letters and digits, or a run of other signs: junk shows in the signs.
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
#: Added to every count, as a share of the mean count of a bucket.
SMOOTHING = 0.5
#: A document whose mean log ratio is below this goes.
MIN_SCORE = -0.2
#: Trusted keys are sent to all tasks in blocks of about so many bytes, so that no text is shuffled. A key counts as its
#: length and KEY_BYTES.
BLOCK_BYTES, KEY_BYTES = 16 << 20, 32
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def buckets(tokens: Column) -> Column:
    """Bucket numbers of all unigrams and bigrams."""
    def numbered(held: Column) -> Column:
        one = F.transform(held, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int"))
        two = F.zip_with(F.slice(held, 1, F.size(held) - 1), F.slice(held, 2, F.size(held) - 1),
                         lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
        return F.concat(one, two)

    return F.when(F.size(tokens) > 0, let(tokens, numbered)).otherwise(F.array().cast("array<int>"))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def fit(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> list[float]:
    """log(trusted / raw) of each bucket, from the texts of all ``docs``; ``trusted`` has the keys of the good ones."""
    keys = trusted.select(F.col(key).alias("_good")).where("_good is not null").distinct().withColumn("_one", F.lit(1))
    size = keys.agg(F.sum(F.octet_length(F.col("_good").cast("string")) + KEY_BYTES).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    raw, good = [0] * BUCKETS, [0] * BUCKETS
    # The first pass counts all texts and those of the first block, the others their block's texts only.
    for block in range(blocks):
        sent = F.broadcast(keys.where(F.pmod(F.xxhash64("_good", F.lit(blocks)), F.lit(blocks)) == block))
        flagged = rows.join(sent, F.col("_key") == F.col("_good"), "inner" if block else "left").select(
            "_text", F.coalesce("_one", F.lit(0)).alias("_one"))
        counts = (
            flagged.select("_one", _tokens(F.col("_text")).alias("_tokens"))
            .select("_one", F.explode(buckets(F.col("_tokens"))).alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("_one").alias("good"))
            .collect()  # one row a bucket at most
        )
        for r in counts:
            good[r["bucket"]] += r["good"]
            if not block:
                raw[r["bucket"]] = r["raw"]
    all_raw, all_good = sum(raw), sum(good)
    if not all_good:
        return [0.0] * BUCKETS
    extra = SMOOTHING * all_good / BUCKETS
    # The same smoothing in proportion, so that a bucket seen alike in both has the ratio 1.
    scale = all_raw / all_good
    return [math.log((g + extra) * scale / (r + extra * scale)) for g, r in zip(good, raw)]


def _repeat_words(words: Column, hashed: Column):
    """The hashes of all windows of five; a function of them that counts the words in repeated ones; the word count."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW),
                          lambda i: F.xxhash64(*(F.get(hashed, i + k) for k in range(WINDOW))))

    def repeated(order: Column) -> Column:
        return F.filter(
            F.transform(order, lambda x, k: F.when(
                (x["h"] == F.get(order, k - 1)["h"]) | (x["h"] == F.get(order, k + 1)["h"]), x["i"])),
            lambda i: i.isNotNull())

    def covered(found: Column) -> Column:
        order = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.aggregate(
            F.array_sort(let(order, repeated)),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")),
            lambda a: a["n"])

    return windows, covered, n


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of the base rules and ``base_failed``."""
    held = without(docs, RESULTS)
    keep = [F.col(f"`{c}`") for c in held.columns]
    body = F.coalesce(F.col(text), F.lit(""))
    step = held.select(*keep, F.array_remove(F.split(body, BETWEEN_WORDS), "").alias("_words"))
    step = step.select(*keep, "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashed"))
    windows, covered, n = _repeat_words(F.col("_words"), F.col("_hashed"))
    none = F.array().cast("array<bigint>")
    step = step.select(*keep, "_words", F.when(n >= WINDOW, windows).otherwise(none).alias("_windows"))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD))
    step = step.select(*keep, "_words", "_windows", F.size(F.array_distinct("_windows")).alias("_distinct"),
                       lines.alias("_lines"))
    step = step.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # Sorting is left out where no window repeats.
        F.when(F.size("_windows") == F.col("_distinct"), F.lit(0)).otherwise(covered(F.col("_windows")))
        .cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return step.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"))


def judge(docs: DataFrame, log_ratio: list[float], text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """Add the base counts, the ``score`` and ``kept``: the base rules hold and the score is at least ``min_score``."""
    return apart(docs, RESULTS, (text,), lambda *held: _judged(*held, log_ratio, min_score))


def _judged(held: DataFrame, text: str, log_ratio: list[float], min_score: float) -> DataFrame:
    ruled = base_rules(held, text)
    keep = [F.col(f"`{c}`") for c in ruled.columns]
    step = ruled.select(*keep, _tokens(F.col(text)).alias("_tokens"))
    step = step.select(*keep, buckets(F.col("_tokens")).alias("_buckets"))
    total = F.aggregate("_buckets", F.lit(0.0), lambda a, b: a + F.get(constants(log_ratio, "double"), b))
    score = F.when(F.size("_buckets") > 0, total / F.size("_buckets")).otherwise(F.lit(0.0))
    step = step.select(*keep, score.alias("score"))
    return fenced(step.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= min_score)),
                  [c for c in held.columns], RESULTS)


def quality(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
            min_score: float = MIN_SCORE) -> DataFrame:
    return judge(docs, fit(docs, trusted, key, text), text, min_score)
