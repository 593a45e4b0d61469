"""Sharding by extendible hashing: a directory over the leading bits of a hash; only buckets above the byte limit split.

Bytes are summed per cell of many hash bits at once (partial sums, then a row a cell), and the directory is read off the
cells: a bucket is the shortest prefix whose bytes fit. Cells that still do not fit are opened on further bits, for their
rows only. Rows whose hashes are equal to the last bit (copies of one key) go on with a second hash, of their place in the
input, so that every shard fits unless a single document does not.

All of it is DataFrame functions. The directory is broadcast if its counted size is within the bound, else joined.

Defined cases: a null text has no bytes; null keys hash alike and so split on the second hash; a document above the limit
is a shard of its own; an empty table has no shards. Columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from facetide.llm.common import apart, bounded, stored

SHARD_BYTES = 32 << 20
#: Bits of a hash that are used, and bits that a further round adds.
HASH_BITS, ROUND_BITS = 60, 8
CELL_ROW_BYTES = 64
RESULTS = ("n_bytes", "shard", "shard_bytes", "shard_docs")


def _prefix(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits) if bits else F.lit(0).cast("long")


def _directory(rows: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame]], DataFrame | None]:
    """For each round its bits and a table cell -> shard; and the cells that no bits can split.

    ``rows``: _hash, n_bytes. A bucket of one row fits by definition.
    """
    total = rows.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    bits, base = min(20, max(4, math.ceil(math.log2(max(1, total / limit))) + 4)), 0
    found, open_rows = [], rows
    while True:
        cells = stored(
            open_rows.groupBy(_prefix(F.col("_hash"), bits).alias("_cell")).agg(
                F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")), "cells")
        depths = F.explode(F.sequence(F.lit(base), F.lit(bits))).alias("_depth")
        up = cells.select("_cell", "bytes", "docs", depths).withColumn(
            "_prefix", F.expr(f"shiftrightunsigned(_cell, {bits} - _depth)"))
        fits = (F.sum("bytes") <= limit) | (F.sum("docs") == 1)
        whole = up.groupBy("_depth", "_prefix").agg(
            fits.alias("_fits"), F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        # The shortest prefix that fits is the bucket.
        bucket = (
            up.select("_cell", "_depth", "_prefix").join(whole.where("_fits"), ["_depth", "_prefix"])
            .groupBy("_cell").agg(F.min(F.struct("_depth", "_prefix", "shard_bytes", "shard_docs")).alias("b")))
        name = F.expr("if(b._depth = 0, '', lpad(bin(b._prefix), b._depth, '0'))")
        table = stored(cells.select("_cell").join(bucket, "_cell", "left").select(
            "_cell", F.when(F.col("b").isNotNull(), name).alias("shard"), "b.shard_bytes", "b.shard_docs"), "directory")
        found.append((bits, table))
        rest = table.where("shard is null").select("_cell")
        if not rest.limit(1).count():
            return found, None
        if bits >= HASH_BITS:
            return found, rest
        open_rows = open_rows.withColumn("_cell", _prefix(F.col("_hash"), bits)).join(
            bounded(rest, CELL_ROW_BYTES), "_cell", "left_semi").drop("_cell")
        base, bits = bits, min(HASH_BITS, bits + ROUND_BITS)


def _placed(rows: DataFrame, directory: list[tuple[int, DataFrame]], mark: str) -> DataFrame:
    """Look each row's cell up, round by round."""
    names = [F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "shard_bytes", "shard_docs")]
    parts = ("shard", "shard_bytes", "shard_docs")
    for bits, table in directory:
        right = bounded(table.select(F.col("_cell").alias("_at"), *(F.col(p).alias(f"_{p}") for p in parts)), CELL_ROW_BYTES)
        rows = rows.withColumn("_at", _prefix(F.col("_hash"), bits)).join(right, "_at", "left").select(
            *names, *(F.coalesce(F.col(p), F.concat(F.lit(mark), F.col(f"_{p}")) if p == "shard" else F.col(f"_{p}")).alias(p)
                      for p in parts))
    return rows


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Add ``n_bytes``, ``shard`` (the bits of its prefix), and the bytes and documents of the shard."""
    return apart(docs, RESULTS, (key, text), lambda *held: _sharded(*held, limit))


def _sharded(held: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    kept = [F.col(c) for c in held.columns]
    sized = held.select(*kept, F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
                        F.xxhash64(F.col(key)).alias("_hash"))
    narrow = sized.select("_hash", "n_bytes")
    first, rest = _directory(narrow, limit)
    blank = [F.lit(None).cast(t).alias(n) for n, t in (("shard", "string"), ("shard_bytes", "long"), ("shard_docs", "long"))]
    out = _placed(sized.select("*", *blank), first, "b")
    if rest is not None:
        # Copies of one key: split by a hash of key and place. These rows are written with it, since a place read twice
        # need not be the same.
        numbered = stored(out.where("shard is null").withColumn(
            "_hash", F.xxhash64(F.col("_hash"), F.monotonically_increasing_id())), "copies")
        second, _ = _directory(numbered.select("_hash", "n_bytes"), limit)
        out = out.where("shard is not null").unionByName(_placed(numbered, second, "c"))
    found = F.coalesce("shard", F.raise_error(F.lit("a row's cell is not in the directory"))).alias("shard")
    return out.select(*kept, "n_bytes", found, "shard_bytes", "shard_docs")
