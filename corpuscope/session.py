"""Session settings the jobs are designed for."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings only; sizes of executors and the number of shuffle partitions belong
# to the cluster. Adaptive execution coalesces small partitions and splits skewed ones,
# and turns a sort-merge join into a hash join when every build partition is small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once for an application, and return the session.

    Needed where it is not installed there: what runs Python on the executors imports it by name.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="corpuscope-")  # the driver's own; Spark serves the file from there as long as it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = Path(folder) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(application)
    return spark


def tuned(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session, :func:`ship` the package, and return the session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return ship(spark)
