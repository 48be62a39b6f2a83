"""Lets Python workers import this package wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the session's files, once an application; call before Python functions of this package run on executors."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="satellion-")) / "satellion.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
