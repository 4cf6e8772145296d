"""The package on executors that do not have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once an application: workers can then import it from any folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="ternion-ship-")  # the driver's own; Spark copies the archive from here
    archive = f"{folder}/ternion.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path("ternion") / f.relative_to(root)))
    context.addPyFile(archive)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _SHIPPED.add(context.applicationId)
