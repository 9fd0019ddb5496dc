"""Gives this package to the Python workers of a session, as ``--py-files`` does."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Rows of an Arrow batch: whole texts come in each, and a batch is held by Spark and by the worker.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Adds the library as an archive once a session, so that workers can import it wherever they run.

    Also lowers the session's rows of an Arrow batch to ``BATCH_ROWS`` if they are more.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="lakestream-"), "lakestream.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
