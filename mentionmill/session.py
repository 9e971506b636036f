"""Session defaults and table access."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that only matter where the cluster has not chosen its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build(app: str = "mentionmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's defaults; ``conf`` overrides them."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (DEFAULTS | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once per application, so that Python steps find it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    tmp = tempfile.mkdtemp(prefix="mentionmill-code-")  # the driver serves the file from here until it ends
    atexit.register(shutil.rmtree, tmp, True)
    path = Path(tmp, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(path))


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a directory of Parquet tables."""
    ship(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")
