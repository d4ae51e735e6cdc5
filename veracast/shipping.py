"""Sends this package to the executors, so that Python workers can import it anywhere."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per Spark application; nothing to do where the package itself came in an archive."""
    context = spark.sparkContext
    if context.applicationId in _sent or not _PACKAGE.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix=f"{_PACKAGE.name}-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for source in sorted(_PACKAGE.rglob("*.py")):
            packed.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
