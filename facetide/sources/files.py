"""File access for tasks and for the record source, on any file system pyarrow knows; file listing."""

from __future__ import annotations

import errno
import os
import re
import threading
from collections.abc import Iterator
from stat import S_ISREG

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide.session import scratch_path, ship

#: A listing is passed on in runs of so many names.
RUN_NAMES = 8192

_open_systems: dict[str, object] = {}
_lock = threading.Lock()


def resolve(uri: str):
    """(file system, path within it) for a plain path or a URI."""
    from pyarrow import fs

    uri = re.sub("^s3[an]:", "s3:", uri)  # Hadoop's names of the same store
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", uri)
    if not scheme or scheme.group(1) == "file":
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    root = re.match(r"[^:]+://[^/]*", uri)
    with _lock:
        system = _open_systems.get(root.group(0)) if root else None
        if system is None:
            system, path = fs.FileSystem.from_uri(uri)
            if root:
                _open_systems[root.group(0)] = system
            return system, path
    # Within an object store the bucket is part of the path; elsewhere the host is not.
    host, _, rest = uri.split("://", 1)[1].partition("/")
    return system, f"/{rest}" if scheme.group(1) in ("hdfs", "viewfs") else f"{host}/{rest}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with scheme and host, as Spark itself reads it: without a scheme it is on the default file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


def default_root(spark: SparkSession) -> str:
    """What stands before an absolute path without a scheme, such as ``hdfs://host:8020`` or ``file:``."""
    return re.sub("/+$", "", qualified(spark, "/"))


def qualified_in(path: str | None, root: str) -> str | None:
    """For tasks: an absolute path below ``root``, as ``default_root`` gives it; a URI stays."""
    return root + path if path is not None and path.startswith("/") else path


def read_bytes(uri: str) -> bytes | None:
    """A whole file, or None if there is no such file. Other errors are raised."""
    if uri is None:
        return None
    system, path = resolve(uri)
    try:
        with system.open_input_stream(path) as stream:
            return stream.read()
    except FileNotFoundError:
        return None


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """Regular files directly inside a directory, not below it: ``path, length, modificationTime``.

    As in Spark's own listing, empty and hidden files (``_``, ``.``) are left out, links stand for what they lead to, and the
    files are those of the time of the call. Where the directory is on a local or mounted file system, one task reads the names
    and deals them out to all, which look the files up and store the rows below the shared folder: the driver holds no file, and
    a task a batch of them. Other file systems are listed by Spark, and the driver holds that listing.
    """
    root = qualified(spark, directory)
    if root.startswith("file:") and os.path.isdir(resolve(root)[1]):
        return _listed_by_tasks(spark, root)
    return _listed_by_spark(spark, directory, root)


def _listed_by_spark(spark: SparkSession, directory: str, root: str) -> DataFrame:
    parent, store = F.regexp_replace("path", "/[^/]*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "false")
        .load(directory)
        .select("path", "length", "modificationTime")
        .filter(F.regexp_replace(parent, store, "") == re.sub(store, "", root).rstrip("/"))
    )


def _listed_by_tasks(spark: SparkSession, root: str) -> DataFrame:
    ship(spark)
    folder = resolve(root)[1]

    def names(_):
        import pyarrow as pa

        for run in name_runs(folder):
            yield pa.RecordBatch.from_pydict({"name": pa.array(run, pa.string())})

    def look_up(batches):
        import pyarrow as pa

        kinds = [("name", pa.string()), ("length", pa.int64()), ("modified", pa.int64())]
        for batch in batches:
            rows = [row for name in batch.column(0).to_pylist() if (row := status(folder, name))]
            yield pa.RecordBatch.from_pylist([dict(zip(("name", "length", "modified"), r)) for r in rows], pa.schema(kinds))

    tasks, held = max(8, 2 * spark.sparkContext.defaultParallelism), scratch_path(spark, "listing")
    dealt = spark.range(0, 1, 1, 1).mapInArrow(names, "name string").repartition(tasks, "name")
    dealt.mapInArrow(look_up, "name string, length bigint, modified bigint").write.parquet(held)
    return spark.read.schema("name string, length bigint, modified bigint").parquet(held).select(
        F.concat(F.lit(root.rstrip("/") + "/"), "name").alias("path"),
        "length",
        F.timestamp_millis("modified").alias("modificationTime"),
    )


def name_runs(folder: str) -> Iterator[list[str]]:
    """For tasks: the names in a local folder that Spark's sources read, a run at a time, in the order of the folder."""
    run: list[str] = []
    with os.scandir(os.fsencode(folder)) as entries:
        for entry in entries:
            try:
                name = entry.name.decode()
            except UnicodeDecodeError:  # no path that Spark has can name it
                continue
            if name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"):
                continue
            run.append(name)
            if len(run) == RUN_NAMES:
                yield run
                run = []
    if run:
        yield run


def status(folder: str, name: str) -> tuple[str, int, int] | None:
    """For tasks: (name, bytes, milliseconds of its last change) of a regular file that is not empty, else None."""
    try:
        found = os.stat(os.path.join(folder, name))
    except OSError as error:  # it went meanwhile, or is a link that leads nowhere
        if error.errno in (errno.ENOENT, errno.ENOTDIR, errno.ELOOP, errno.EACCES):
            return None
        raise
    return (name, found.st_size, found.st_mtime_ns // 1_000_000) if S_ISREG(found.st_mode) and found.st_size else None
