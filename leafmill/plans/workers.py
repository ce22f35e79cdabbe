"""What Python tasks need: this package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers, once per application (what ``--py-files`` does)."""
    context = spark.sparkContext
    if getattr(context, "_leafmill_package", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="leafmill-package-")) / "leafmill_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._leafmill_package = True
