"""From metadata and an image folder to sharded training and test records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from facetide.functions import corpus_dir, image_path
from facetide.functions.text import CORPUS_FOLDERS
from facetide.operators.images import attach_bytes
from facetide.operators.prep import clean, to_example, with_age
from facetide.operators.sampling import (
    SPLIT_SEED, assign_shards, n_test_shards, number_shuffled, split_exact, with_unique_key,
)
from facetide.sources.tfrecord import write_shards

TEST_SIZE = 0.01
WORKERS = 3
KEY = ("source", "file_name")


def sharded(meta: DataFrame, key: str | Sequence[str] = KEY, test_size: float = TEST_SIZE, n_shards: int = WORKERS,
            seed: int = SPLIT_SEED, second_face: bool = False) -> dict[str, tuple[DataFrame, int]]:
    """Clean metadata rows with their shard, per split, and the number of shards.

    The split is exact over all rows; the gates then drop rows, and what is left fills even shards. Only metadata is
    shuffled. The same image may be listed any number of times.
    """
    rows, keys = with_unique_key(with_age(meta), key)
    train, test = split_exact(rows, keys, test_size=test_size, seed=seed)
    plans = {}
    for split, rows, k in (("train", train, n_shards), ("test", test, n_test_shards(n_shards))):
        numbered = number_shuffled(clean(rows, second_face), keys, seed)
        plans[split] = (assign_shards(numbered, k).withColumn("split", F.lit(split)).drop("pos", "total", "_copy"), k)
    return plans


def prepare(meta: DataFrame, base: str, out: str, test_size: float = TEST_SIZE, n_shards: int = WORKERS,
            detect: Callable | None = None, folders: Mapping[str, str] = CORPUS_FOLDERS,
            key: str | Sequence[str] = KEY, seed: int = SPLIT_SEED, second_face: bool = False) -> DataFrame:
    """Write ``<out>/{train,test}/<split>-NNN.tfrecords``; returns ``split, missing, valid`` counts.

    Rows go to the task of their shard while they are metadata; the task opens the images, runs ``detect`` and
    writes the records, so image bytes are never shuffled and each image is read once. The counts are observed
    while writing. Choose ``n_shards`` so that a shard's images are a few hundred megabytes.
    """
    counts = []
    for split, (rows, k) in sharded(meta, key, test_size, n_shards, seed, second_face).items():
        located = rows.withColumn("path", image_path(corpus_dir(base, "source", folders), "file_name"))
        read, written = Observation(), Observation()
        attached = attach_bytes(located.repartitionById(k, "shard"), detect=detect).observe(
            read, F.count_if(F.col("image_raw").isNull()).alias("missing")
        )
        records = to_example(attached.filter(F.col("image_raw").isNotNull()), "shard").observe(
            written, F.count(F.lit(1)).alias("valid")
        )
        write_shards(records, out, split, k, partitioned=True)
        counts.append((split, read.get["missing"], written.get["valid"]))
    return meta.sparkSession.createDataFrame(counts, "split string, missing long, valid long")
