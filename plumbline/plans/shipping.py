"""Making this package importable in the Python workers of every executor."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once for each application; Spark's own file server distributes them."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="plumbline-")) / "plumbline_src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
