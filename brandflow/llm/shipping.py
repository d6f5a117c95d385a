"""Makes this package importable in the executors' Python workers, as ``--py-files`` would."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_DONE: set[str] = set()


#: Rows of an Arrow batch. Texts are long; Spark's default of 10 000 would hold hundreds of MB of them in a worker.
BATCH_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Add a zip of the package to the application, once, and bound the Arrow batches unless the session says how."""
    sc = spark.sparkContext
    if sc.getConf().get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_ROWS)
    if sc.applicationId in _DONE:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="brandflow-zip-")  # the driver serves the file from here as long as it runs
    name = os.path.basename(package)
    shutil.copytree(package, os.path.join(folder, "src", name), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "brandflow_package"), "zip", os.path.join(folder, "src")))
    _DONE.add(sc.applicationId)
