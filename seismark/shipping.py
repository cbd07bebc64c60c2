"""Hand this package to the Python workers of a session that does not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import seismark

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the session's files once; Spark brings it to every executor."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(seismark.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="seismark-code-")) / "seismark_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path("seismark") / file.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
