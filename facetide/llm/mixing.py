"""Mixing sources to target weights by entropy balancing.

Each source has a target of words. Of all document rates that meet it, with no rate above ``max_copies``, those nearest to
"every document once" (in relative entropy) are exponentially tilted: rate = min(max_copies, exp(lambda * size / mean
size)), with one dual variable per source. The dual is solved by Newton steps, kept inside a bracket, over the counts of
documents per source and size; every step is one aggregate with partial sums, for all sources at once.

Rates become whole copies: floor(rate + u), u a hash of the document in [0, 1). What rounding leaves is taken back by a
common shift of u per source, found by summing words per digit of the shift at which a document gains a copy, so that a
source ends within half a document of its target (rows alike in key and text move together); one more or one less copy
of the document that fits best brings it nearer.

Targets: sources in code-point order, null last, weigh ``weights`` in turn and share ``budget`` times all words; a target
stops at ``max_copies`` times its source's words, and the excess goes to the others by weight until none is above.

All of it is DataFrame functions. Texts are never shuffled; what is shuffled has a row per source, size or digit.

Defined cases: a null or empty text has size 0 and nothing is taken of it; a null source is a source; null and repeated
keys are allowed; an empty table gives an empty mix. Columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from facetide.llm.common import BETWEEN_WORDS, BROADCAST_BYTES, apart, stored

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_COPIES = 2
#: Newton ends when no source misses its target by more than this share; rounding does the rest.
TOLERANCE = 1e-4
MAX_STEPS = 60
#: Digits of the shift and bits of each.
DIGITS, DIGIT_BITS = 4, 7
SOURCE_ROW_BYTES = 512
PLACE = (1 << 33) - 1
RESULTS = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")).cast("long")


def _in_order(sources: DataFrame) -> tuple[DataFrame, int]:
    """Number the sources from 0 in code-point order, null last: sorted in ranges, then offset by one count a range."""
    order = F.col("_source").asc_nulls_last()
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        sources.repartitionByRange(tasks, order).sortWithinPartitions(order)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(PLACE)), "sources")
    counts = {r["_task"]: r["n"] for r in placed.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return placed.withColumn("_rank", F.col("_place")), 0
    before = list(accumulate((counts.get(t, 0) for t in range(max(counts) + 1)), initial=0))
    table = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    return placed.withColumn("_rank", F.get(table, F.col("_task")) + F.col("_place")).drop("_task", "_place"), before[-1]


def _targets(sources: DataFrame, weights: Sequence[float], budget: float, max_copies: int) -> DataFrame:
    """Add ``target``: weight times a common level, or the cap. The level rises until all is shared."""
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod("_rank", F.lit(len(weights))))
    sources = sources.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(max_copies))
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = 0.0
    while True:
        above = F.col("_weight") * F.lit(level) > F.col("_cap")
        r = sources.agg(F.sum(F.when(above, F.col("_cap"))).alias("capped"),
                        F.sum(F.when(~above, F.col("_weight"))).alias("open")).first()
        if not r["open"]:
            break
        raised = (budget * total - (r["capped"] or 0.0)) / r["open"]
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(F.col("_weight") * F.lit(level), F.col("_cap")))


def _rate(size: Column, mean: Column, dual: Column, max_copies: int) -> Column:
    return F.exp(F.least(dual * size / mean, F.log(F.lit(float(max_copies)))))


def _solve(hist: DataFrame, sources: DataFrame, near: Callable[[DataFrame], DataFrame], max_copies: int) -> DataFrame:
    """Add ``_dual`` to the sources."""
    state = stored(sources.select(
        "*", F.coalesce(F.log(F.try_divide("target", "source_size")), F.lit(0.0)).alias("_dual"),
        F.lit(float("-inf")).alias("_low"), F.lit(float("inf")).alias("_high"), F.lit(float("inf")).alias("_miss")), "dual")
    capped = F.col("target") >= F.col("_cap")
    names = [c for c in state.columns if c not in ("_dual", "_low", "_high", "_miss")]
    tilt = F.col("_dual") * F.col("size") / F.col("_mean")
    free = tilt < F.log(F.lit(float(max_copies)))
    words = F.col("n") * F.col("size")
    for _ in range(MAX_STEPS):
        sums = (
            hist.join(near(state.where(~capped).select("_s", "_dual", "_mean")), "_s")
            .groupBy("_s").agg(
                F.sum(words * _rate(F.col("size"), F.col("_mean"), F.col("_dual"), max_copies)).alias("_now"),
                F.sum(F.when(free, words * F.col("size") / F.col("_mean") * F.exp(tilt)).otherwise(0.0)).alias("_slope")))
        gap = F.col("_now") - F.col("target")
        low = F.when(gap <= 0, F.greatest("_low", "_dual")).otherwise(F.col("_low"))
        high = F.when(gap > 0, F.least("_high", "_dual")).otherwise(F.col("_high"))
        wide = F.when(low == float("-inf"), F.col("_dual") - 1 - F.abs("_dual")).when(
            high == float("inf"), F.col("_dual") + 1 + F.abs("_dual")).otherwise((low + high) / 2)
        step = F.col("_dual") - F.try_divide(gap, F.col("_slope"))
        miss = F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0))
        good = (F.col("_slope") > 0) & (step > low) & (step < high)
        state = stored(
            state.join(near(sums), "_s", "left").select(
                *names,
                F.when(F.col("_now").isNull() | (miss <= TOLERANCE), F.col("_dual")).when(good, step).otherwise(wide)
                .alias("_dual"),
                F.coalesce(low, "_low").alias("_low"), F.coalesce(high, "_high").alias("_high"),
                F.coalesce(miss, F.lit(0.0)).alias("_miss")), "dual")
        if not state.where(F.col("_miss") > TOLERANCE).limit(1).count():
            break
    return state.drop("_low", "_high", "_miss")


def _ticks(dual_rate: Column) -> tuple[Column, Column, Column]:
    """Copies at the lowest shift, and the shifts, as whole numbers, at which the first and second copy more come."""
    value = dual_rate + F.col("_u")
    whole = F.least(F.floor(value), F.lit(MAX_COPIES).cast("long"))
    part = value - whole
    scale = float(1 << (DIGITS * DIGIT_BITS - 1))
    first = F.floor((1 - part) * scale).cast("long")
    return F.greatest(whole - 1, F.lit(0)), F.when(whole >= 1, first), F.when(
        whole < MAX_COPIES, F.least(F.floor((2 - part) * scale), F.lit(2 * scale - 1)).cast("long"))


def _shifted(rows: DataFrame, sources: DataFrame, near: Callable[[DataFrame], DataFrame], max_copies: int) -> DataFrame:
    """Add ``_cut``: copies whose tick is at or below it are taken."""
    rate = _rate(F.col("size"), F.col("_mean"), F.col("_dual"), max_copies)
    held = rows.join(near(sources.select("_s", "_mean", "_dual")), "_s").where("size > 0")
    least, first, second = _ticks(rate)
    events = held.select("_s", "size", least.alias("_least"), F.array_compact(F.array(first, second)).alias("_ticks"))
    base = events.groupBy("_s").agg(F.sum(F.col("_least") * F.col("size")).alias("_acc"))
    events = events.select("_s", "size", F.explode("_ticks").alias("_tick"))
    state = stored(sources.join(near(base), "_s", "left").select(
        "_s", "target", F.coalesce("_acc", F.lit(0)).cast("long").alias("_acc"), F.lit(0).cast("long").alias("_cut"),
        F.lit(0).cast("long").alias("_last")), "shift")
    for k in range(DIGITS):
        bits = (DIGITS - 1 - k) * DIGIT_BITS
        digit = F.shiftright("_tick", bits)
        sums = (
            events.join(near(state.select("_s", "_cut")), "_s")
            .where(F.shiftright(digit, DIGIT_BITS) == F.col("_cut"))
            .groupBy("_s", digit.alias("_digit")).agg(F.sum("size").alias("_words")))
        # At most 128 rows a source.
        cum = F.sum("_words").over(Window.partitionBy("_s").orderBy("_digit"))
        reach = near(state.select("_s", "target", "_acc"))
        at = (
            sums.withColumn("_cum", cum).join(reach, "_s")
            .groupBy("_s").agg(
                F.min(F.when(F.col("_acc") + F.col("_cum") >= F.col("target"), F.struct("_digit", "_cum", "_words")))
                .alias("_hit"), F.max(F.struct("_digit", "_cum", "_words")).alias("_end")))
        hit = F.coalesce("_hit", "_end")
        state = stored(state.join(near(at), "_s", "left").select(
            "_s", "target", (F.col("_acc") + F.coalesce(hit["_cum"] - hit["_words"], F.lit(0))).alias("_acc"),
            F.coalesce(hit["_digit"], F.shiftleft("_cut", DIGIT_BITS)).alias("_cut"),
            F.coalesce(hit["_words"], F.lit(0)).alias("_last")), "shift")
    # The documents at the last digit go with the nearer side.
    with_last = F.abs(F.col("_acc") + F.col("_last") - F.col("target")) <= F.abs(F.col("_acc") - F.col("target"))
    return sources.join(near(state.select(
        "_s", F.when(with_last, F.col("_cut")).otherwise(F.col("_cut") - 1).alias("_cut"))), "_s")


def _copies(max_copies: int) -> Column:
    least, first, second = _ticks(_rate(F.col("size"), F.col("_mean"), F.col("_dual"), max_copies))
    more = sum((F.coalesce((t <= F.col("_cut")).cast("long"), F.lit(0)) for t in (first, second)), F.lit(0))
    return F.when(F.col("target") >= F.col("_cap"), F.lit(max_copies)).otherwise(least + more).cast("long")


def _nudged(rows: DataFrame, sources: DataFrame, near: Callable[[DataFrame], DataFrame], copies: Column) -> DataFrame:
    """Add the one document per source whose next copy more or less brings the source nearest to its target."""
    held = rows.join(near(sources), "_s").select("_s", "size", "_u", "target", copies.alias("_copies"))
    short = stored(held.groupBy("_s").agg(
        (F.first("target") - F.sum(F.col("_copies") * F.col("size"))).alias("_short")), "short")
    by = F.when(F.col("_short") > 0, F.lit(1)).otherwise(F.lit(-1))
    open_to = F.when(by > 0, F.col("_copies") < MAX_COPIES).otherwise(F.col("_copies") > 0)
    left = F.abs(F.col("_short") - by * F.col("size"))
    best = stored(
        held.join(near(short), "_s").where(open_to & (left < F.abs("_short")))
        .groupBy("_s").agg(F.min(F.struct(left.alias("left"), "size", "_u", by.alias("by"))).alias("b"))
        .select("_s", F.col("b.size").alias("_size"), F.col("b._u").alias("_at"), F.col("b.by").alias("_by")), "nudges")
    # Rows alike would all move.
    alone = (
        rows.join(near(best), "_s").where((F.col("size") == F.col("_size")) & (F.col("_u") == F.col("_at")))
        .groupBy("_s").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("_s"))
    return stored(sources.join(near(best.join(near(alone), "_s", "left_semi")), "_s", "left"), "nudged")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, max_copies: int = MAX_COPIES) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size)."""
    if max_copies != MAX_COPIES:
        raise ValueError("shifts are laid out for two copies")
    return apart(docs, RESULTS, (key, text, source), lambda *held: _mixed(*held, weights, budget, max_copies))


def _mixed(held: DataFrame, key: str, text: str, source: str, weights: Sequence[float], budget: float,
           max_copies: int) -> DataFrame:
    kept = [F.col(c) for c in held.columns]
    tag = F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))
    # 53 bits of the hash: equal parts of [0, 1).
    u = F.shiftrightunsigned(F.xxhash64(F.col(key), F.col(text)), 11) / F.lit(float(1 << 53))
    sized = held.select(*kept, tag.alias("_s"), word_count(F.col(text)).alias("size"), u.alias("_u"))
    rows = stored(sized.select("_s", F.col(source).cast("string").alias("_source"), "size", "_u"), "sizes")
    sums = rows.groupBy("_s", "_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    ranked, n_sources = _in_order(sums)
    near = F.broadcast if n_sources * SOURCE_ROW_BYTES <= BROADCAST_BYTES else (lambda df: df)
    sources = _targets(ranked, weights, budget, max_copies).withColumn(
        "_mean", F.greatest(F.col("source_size") / F.col("_docs"), F.lit(1e-9)))
    hist = stored(rows.where("size > 0").groupBy("_s", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    solved = stored(_solve(hist, sources, near, max_copies), "solved")
    solved = stored(_shifted(rows, solved, near, max_copies), "cuts")
    facts = ["_s", "source_size", "target", "_mean", "_dual", "_cap", "_cut"]
    copies = _copies(max_copies)
    solved = _nudged(rows, solved.select(*facts), near, copies)
    own = F.when((F.col("size") == F.col("_size")) & (F.col("_u") == F.col("_at")), F.col("_by")).otherwise(F.lit(0))
    return sized.join(near(solved), "_s").select(
        *kept, "size", "source_size", "target", (copies + own).cast("long").alias("copies"),
        ((copies + own) * F.col("size")).cast("long").alias("taken"))
