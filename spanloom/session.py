"""Sessions that carry this package to their executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, so that tasks can import it
    where it is not installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).parent
        to = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
        with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, f"{root.name}/{p.relative_to(root)}")
        spark.sparkContext.addPyFile(str(to))
        _shipped.add(app)
    return spark
