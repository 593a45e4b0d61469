"""Seeded order, exact splits, dense numbering, shards, epochs and batches, without a single-task sort.

The seeded order is that of ``md5(seed|key)``. Its first four hex digits are even over the key space, so equal ranges of
them make even tasks, in order. Rows go to the task of their range and are sorted there; a count per task turns the
row's place in its task into a global position. That is one shuffle, and nothing larger than a number per task comes to
the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from facetide.functions._util import as_column
from facetide.session import checkpointed

DIGITS = 4
MD5_DIGITS = 32
# monotonically_increasing_id holds the partition above this bit and the row's place in it below.
PLACE_BITS = 33
SPLIT_SEED = 2017
COPY = "_copy"


def order_hash(seed: int | Column, *key: Column | str) -> Column:
    first = seed if isinstance(seed, Column) else F.lit(str(seed))
    # Separators within a part are escaped and nulls marked, so that different keys differ. A copy's number is left out
    # where there is none.
    def part(k: Column | str) -> Column:
        held = F.regexp_replace(as_column(k).cast("string"), r"([|\\])", r"\\$1")
        return held if isinstance(k, str) and k == COPY else F.coalesce(held, F.lit("\\N"))

    return F.md5(F.concat_ws("|", first, *map(part, key)))


def with_row_tie(df: DataFrame, name: str) -> DataFrame:
    """Give each row its own number, fixed by a checkpoint, where no key tells copies apart."""
    return checkpointed(df.withColumn(name, F.monotonically_increasing_id()))


# --- the first rows in seeded order ------------------------------------------------------------------------------


def _cut(hashes: DataFrame, size: Callable[[int], int]) -> tuple[str | None, int]:
    """(cut, total): a row is among the first ``size(total)`` if its hash starts with the cut or something lower.

    Digits are added to the cut, four per pass over the hashes, until it falls between two rows. A pass brings at most
    65,536 counts to the driver.
    """
    prefix, need, total = "", None, 0
    while True:
        rows = hashes.filter(F.col("h").startswith(prefix)) if prefix else hashes
        digits = F.substring("h", len(prefix) + 1, DIGITS).alias("d")
        counts = sorted((r["d"], r["n"]) for r in rows.groupBy(digits).agg(F.count(F.lit(1)).alias("n")).collect())
        if need is None:
            total = sum(n for _, n in counts)
            need = size(total)
            if need == 0:
                return None, total
        for d, n in counts:
            if need <= n:
                break
            need -= n
        prefix += d
        if need == n:
            return prefix, total
        if len(prefix) >= MD5_DIGITS:
            raise ValueError("the key repeats across the cut; pass unique_key=False")


def _up_to(hashed: Column, cut: str | None) -> Column:
    return F.lit(False) if cut is None else F.substring(hashed, 1, len(cut)) <= F.lit(cut)


# --- positions in seeded order ---------------------------------------------------------------------------------


def _place() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(2**PLACE_BITS - 1)


def _table(numbers: Sequence[int]) -> Column:
    """A constant array, one number per task."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def _ranked(df: DataFrame, hashed: Column, key: Sequence[str], groups: int = 1, group: str | None = None,
            limit: int | None = None) -> DataFrame:
    """Add ``pos`` (from 0, within ``group``, a column of 0..groups-1) in hash order, and ``total``, its row count."""
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Every group is spread over as many tasks as any shuffle.
    tasks = max(1, min(setting, 16**DIGITS))
    digits = F.conv(F.substring("_hex", 1, DIGITS), 16, 10).cast("int")
    task = F.shiftright(digits * F.lit(tasks).cast("long"), 4 * DIGITS).cast("int")
    if group is not None:
        task = F.col(group) * tasks + task
    total = None
    if limit is not None:
        # Rows past the limit drop out before the shuffle.
        cut, total = _cut(df.select(hashed.alias("h")), lambda n: min(n, limit))
        df = df.filter(_up_to(hashed, cut))
    rows = df.withColumn("_hex", hashed).withColumn("_task", task)

    counts = [0] * (tasks * groups)
    for r in rows.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["_task"]] = r["n"]
    before = []
    for g in range(groups):
        before += accumulate(counts[g * tasks:(g + 1) * tasks - 1], initial=0)
    if total is None:
        total = sum(counts[:tasks])

    # Half the bytes of the digits, in the same order.
    placed = (
        rows.withColumn("_hash", F.unhex("_hex")).drop("_hex")
        .repartitionById(tasks * groups, "_task")
        .sortWithinPartitions("_hash", *key)
        .withColumn("_place", _place())
    )
    # Were two tasks ever read as one, the last row of the second would be out of its range.
    pos = F.when(
        F.col("_place") < F.get(_table(counts), "_task"), F.get(_table(before), "_task") + F.col("_place")
    ).otherwise(F.raise_error(F.lit("tasks were merged while numbering rows")))
    return placed.withColumn("pos", pos).withColumn("total", F.lit(total).cast("long")).drop("_hash", "_task", "_place")


def with_unique_key(df: DataFrame, key: str | Sequence[str], name: str = COPY) -> tuple[DataFrame, list[str]]:
    """The frame and the columns that tell its rows apart.

    If keys repeat, their copies are told apart by a further column, which is null for keys that occur once: those hash
    as if it were not there.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = [f"_key{i}" for i in range(len(keys))]
    repeated = (
        df.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names)))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    if repeated.isEmpty():
        return df, keys
    # Written out, so that the join can split a hot key at run time.
    repeated, rows = checkpointed(repeated), with_row_tie(df, "_row")
    same = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(repeated[n]) for k, n in zip(keys, names)))
    copy = F.when(F.col("_n").isNotNull(), F.col("_row")).alias(name)
    return rows.join(repeated, same, "left").select(*(rows[c] for c in df.columns), copy), [*keys, name]


def _keyed(df: DataFrame, key: str | Sequence[str], unique_key: bool) -> tuple[DataFrame, list[str], list[str]]:
    """The frame, the columns to hash, and those of them to drop in the end."""
    if unique_key:
        return df, [key] if isinstance(key, str) else list(key), []
    df, keys = with_unique_key(df, key)
    return df, keys, [k for k in keys if k == "_copy"]


def number_shuffled(df: DataFrame, key: str | Sequence[str], seed: int = SPLIT_SEED, limit: int | None = None,
                    unique_key: bool = True) -> DataFrame:
    """Dense positions ``pos`` 0..n-1 in seeded order and the ``total`` n; with ``limit`` only the first ones.

    Set ``unique_key=False`` if keys may repeat: copies then get hashes of their own and spread over the tasks.
    """
    df, keys, added = _keyed(df, key, unique_key)
    return _ranked(df, order_hash(seed, *keys), keys, limit=limit).drop(*added)


# --- exact split ------------------------------------------------------------------------------------------------


def split_sizes(n: int, test_size: float | int | None = None, train_size: float | int | None = None):
    """(train, test) row counts: a test share is rounded up, a train share down, the rest goes to the other."""
    if (test_size is None) == (train_size is None):
        raise ValueError("give one of test_size and train_size")
    if test_size is not None:
        n_test = math.ceil(n * test_size) if isinstance(test_size, float) else test_size
        n_train = n - n_test
    else:
        n_train = math.floor(n * train_size) if isinstance(train_size, float) else train_size
        n_test = n - n_train
    if n_train <= 0 or n_test < 0:
        raise ValueError(f"split of {n} rows leaves {n_train} for training and {n_test} for testing")
    return n_train, n_test


def split_exact(df: DataFrame, key: str | Sequence[str], test_size: float | int | None = None,
                train_size: float | int | None = None, seed: int = SPLIT_SEED,
                unique_key: bool = True) -> tuple[DataFrame, DataFrame]:
    """Exactly sized (train, test): the first rows in seeded order are the test set.

    Both results are plain filters of ``df`` against a literal cut, with no shuffle. Set ``unique_key=False`` if keys
    may repeat.
    """
    df, keys, added = _keyed(df, key, unique_key)
    hashed = order_hash(seed, *keys)
    cut, _ = _cut(df.select(hashed.alias("h")), lambda n: split_sizes(n, test_size, train_size)[1])
    in_test = _up_to(hashed, cut)
    return df.filter(~in_test).drop(*added), df.filter(in_test).drop(*added)


# --- numbering in a given order ---------------------------------------------------------------------------------


def number_rows(df: DataFrame, order_by: Sequence[Column | str], unique: bool = True,
                num_partitions: int | None = None) -> DataFrame:
    """Dense positions ``pos`` 0..n-1 in the given order and the ``total`` n.

    One range shuffle, sorted per task and checkpointed with each row's place in its task: range borders come from a
    sample, so the counts and the numbers must see one and the same outcome, even if executors are lost between.
    With ``unique=False`` equal rows get a tie-breaker first, which also lets copies spread over tasks.
    """
    order = [as_column(c) for c in order_by]
    if not unique:
        df = with_row_tie(df, "_tie")
        order.append(F.col("_tie"))
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    fixed = checkpointed(
        ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ).select("*", F.shiftright("_id", PLACE_BITS).alias("_part"))
    sizes = {r["_part"]: r["n"] for r in fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)]
    before = list(accumulate(counts, initial=0))
    return (
        fixed.withColumn("pos", F.get(_table(before), F.col("_part").cast("int"))
                         + F.col("_id").bitwiseAND(2**PLACE_BITS - 1))
        .withColumn("total", F.lit(before[-1]).cast("long"))
        .drop("_id", "_part", "_tie")
    )


# --- shards, epochs, batches ------------------------------------------------------------------------------------


def assign_shards(numbered: DataFrame, k: int) -> DataFrame:
    """Add ``shard``: ``k`` contiguous runs with boundaries at ``floor(p * total / k)``."""
    return numbered.withColumn(
        "shard", F.expr(f"((pos + 1) * {int(k)} - 1) div total").cast("int")
    )


def n_test_shards(k: int) -> int:
    """A quarter as many test shards as training shards, rounded up."""
    return math.ceil(k / 4)


def repeat_epochs(df: DataFrame, n: int) -> DataFrame:
    """Each row once per epoch 0..n-1, without a join."""
    if n < 1:
        raise ValueError("a batch job needs at least one epoch; endless repetition is for streams")
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def shuffle_epochs(df: DataFrame, key: str | Sequence[str], n: int, seed: int = SPLIT_SEED,
                   limit: int | None = None, unique_key: bool = True) -> DataFrame:
    """``n`` epochs, each in its own seeded order, numbered through: ``pos`` runs on from one epoch to the next.

    ``total`` is the length of the whole stream. A ``limit`` keeps the first rows of a single epoch only.
    """
    if limit is not None and n != 1:
        raise ValueError("a limit needs a single epoch")
    df, keys, added = _keyed(df, key, unique_key)
    hashed = F.md5(
        F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), *(F.col(k).cast("string") for k in keys))
    )
    ranked = _ranked(repeat_epochs(df, n), hashed, keys, n, "epoch", limit).drop(*added)
    return ranked.withColumn("pos", F.col("epoch") * F.col("total") + F.col("pos")).withColumn(
        "total", F.col("total") * n
    )


def assign_batches(numbered: DataFrame, size: int, drop_last: bool = False) -> DataFrame:
    """Add ``batch_id`` for each ``size`` consecutive positions; optionally drop a short last batch."""
    if drop_last:
        numbered = numbered.filter(F.expr(f"pos < (total div {int(size)}) * {int(size)}"))
    return numbered.withColumn("batch_id", F.expr(f"pos div {int(size)}"))


def cap_steps(batched: DataFrame, steps: int) -> DataFrame:
    """The first ``steps`` batches."""
    return batched.filter(F.col("batch_id") < steps)


def training_batches(df: DataFrame, key: str | Sequence[str], epochs: int, batch_size: int,
                     steps: int | None = None, seed: int = SPLIT_SEED, drop_last: bool = True) -> DataFrame:
    """Shuffled epochs in batches, capped at ``steps``; rows and epochs the cap cannot reach are not shuffled."""
    limit = None
    if steps is not None:
        wanted = steps * batch_size
        epochs = max(1, min(epochs, math.ceil(wanted / max(df.count(), 1))))
        limit = wanted if epochs == 1 else None
    batched = assign_batches(shuffle_epochs(df, key, epochs, seed, limit), batch_size, drop_last)
    return batched if steps is None else cap_steps(batched, steps)
