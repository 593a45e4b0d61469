"""Session helpers: reliable checkpoints, shared scratch paths, shipping the package to executors."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    A temporary folder is made up only for a local master, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="facetide-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path, not yet existing, below the shared folder."""
    return f"{shared_dir(spark)}/facetide/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and go on from there, so lost executors cannot change it."""
    spark = df.sparkSession
    base = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (Python sources and sinks need it)."""
    app = spark.sparkContext.applicationId
    package = os.path.join(_PACKAGE_ROOT, "facetide")
    if app in _shipped or not os.path.isdir(package):  # within an archive it was sent along already
        return
    from facetide.sources.files import qualified, resolve

    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, _PACKAGE_ROOT))
    target = qualified(spark, f"{scratch_path(spark, 'package')}/facetide.zip")
    system, path = resolve(target)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as stream:
        stream.write(held.getvalue())
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
