"""Image bytes and user functions over rows: reading files where the rows are, mapping partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from facetide.session import ship
from facetide.sources.files import default_root, read_bytes

# One Arrow batch of images is passed on when it holds this many bytes.
BATCH_BYTES = 64 << 20
READERS_PER_TASK = 8
#: A reader takes so many small files at a time, as handing over single ones costs more than reading them; it stops early at
#: so many bytes.
RUN_FILES, RUN_BYTES = 32, 1 << 20


def missing_files(meta: DataFrame, listing: DataFrame, on: str = "path") -> DataFrame:
    """Metadata rows whose file is not in the listing."""
    return meta.join(listing.select(on), on, "left_anti")


def attach_files(meta: DataFrame, listing: DataFrame, on: str = "path") -> DataFrame:
    """Metadata rows with their file's listing columns; rows without a file drop out."""
    return meta.join(listing, on)


def attach_bytes(meta: DataFrame, path: str = "path", num_partitions: int | None = None,
                 detect: Callable | None = None) -> DataFrame:
    """Add ``image_raw`` by opening each row's file in the task that holds the row; null if there is none.

    No directory is listed and no image bytes are shuffled. Metadata is small next to the images, so pass
    ``num_partitions`` (or partition by shard first) to have enough tasks for the reading. With ``detect`` (see
    ``map_images``) the image is what it finds, and rows with no face or several drop out at once, before the
    bytes leave the Python worker.
    """
    ship(meta.sparkSession)
    if num_partitions:
        meta = meta.repartition(num_partitions)
    schema = StructType([*meta.schema.fields, StructField("image_raw", BinaryType(), True)])

    root = default_root(meta.sparkSession)

    def read(batches):
        from concurrent.futures import ThreadPoolExecutor

        from facetide.sources.files import qualified_in

        with ThreadPoolExecutor(READERS_PER_TASK) as pool:
            for batch in batches:
                paths = [qualified_in(p, root) for p in batch.column(batch.schema.get_field_index(path)).to_pylist()]
                rows, images, size = [], [], 0
                for row, data in _read_all(paths, pool):
                    if data is not None and detect is not None:
                        found = detect(data)
                        if len(found) != 1:
                            continue
                        data = found[0]
                    rows.append(row)
                    images.append(data)
                    size += len(data or b"")
                    if size >= BATCH_BYTES:
                        yield _with_images(batch, rows, images)
                        rows, images, size = [], [], 0
                if rows:
                    yield _with_images(batch, rows, images)

    return meta.mapInArrow(read, schema)


def _read_run(paths: list) -> list[bytes | None]:
    """The first files, up to the one with which they come to ``RUN_BYTES``."""
    out, size = [], 0
    for path in paths:
        out.append(read_bytes(path))
        size += len(out[-1] or b"")
        if size >= RUN_BYTES:
            break
    return out


def _read_all(paths: list, pool) -> Iterator[tuple[int, bytes | None]]:
    """(place, bytes) of all files. A run for each reader is in flight, of one file if they are large, never the whole list."""
    rest, run = list(range(len(paths)))[::-1], 1
    while rest:
        now = [rest.pop() for _ in range(min(len(rest), READERS_PER_TASK * run))]
        runs, left = [now[i:i + run] for i in range(0, len(now), run)], []
        for places, found in zip(runs, pool.map(_read_run, [[paths[i] for i in places] for places in runs])):
            yield from zip(places, found)
            left += places[len(found):]
        rest += left[::-1]
        run = max(1, run // 2) if left else min(2 * run, RUN_FILES)


def _with_images(batch, rows: list[int], images: list):
    import pyarrow as pa

    kept = batch.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*kept.columns, pa.array(images, pa.binary())], names=[*kept.schema.names, "image_raw"]
    )


def map_records(df: DataFrame, fn: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """User function over an iterator of a partition's rows, as pandas frames in and out."""
    return df.mapInPandas(fn, schema)


def map_images(df: DataFrame, detect: Callable, image: str = "image_raw") -> DataFrame:
    """Pluggable detector and aligner, keeping images with exactly one detection.

    ``detect(bytes)`` returns a list of aligned crops (bytes), one per face found. Rows with one crop get it as
    their image; those with none or several, and those without an image, drop out. Bytes stay in their task.
    """
    column = df.columns.index(image)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep, crops = [], []
            for row, data in enumerate(batch.column(column)):
                found = detect(data.as_py()) if data.is_valid else []
                if len(found) == 1:
                    keep.append(row)
                    crops.append(found[0])
            if keep:
                kept = batch.take(pa.array(keep, pa.int64()))
                yield kept.set_column(column, batch.schema.field(column), pa.array(crops, pa.binary()))

    return df.mapInArrow(run, df.schema)


def with_missing_flag(attached: DataFrame) -> DataFrame:
    return attached.withColumn("missing", F.col("image_raw").isNull())
