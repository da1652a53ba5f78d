"""Makes this package importable where the session's Python tasks run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Texts reach a task in batches of about this size; a worker process holds one, and what it makes of it.
BATCH_BYTES = 8 * 1024 * 1024

_shipped: weakref.WeakSet = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Hands the package's modules to the session, so that executors import the driver's version.

    Spark itself sends the archive to every executor, also to those that join later. The session's
    batches are bounded in bytes, since some texts are very long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix=f"{package.name}-")  # on the driver only
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context)
