"""Getting this package to the Python workers."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from wayside.storage import qualified, shared_root, write_bytes

_PACKAGE = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `wayside` importable in Python tasks, once per application.

    A job submitted with `--py-files` runs from an archive the workers have already;
    a session started from a source tree puts one into the shared folder.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or not _PACKAGE.is_dir():
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(_PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(_PACKAGE.parent))
    target = f"{qualified(spark, shared_root(spark))}/wayside.zip"
    write_bytes(spark, target, archive.getvalue())
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
