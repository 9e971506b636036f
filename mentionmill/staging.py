"""Lineage cuts that survive the loss of executors.

Intermediate results that are read more than once are written as Parquet to the folder in ``spark.checkpoint.dir``, which all
executors share. Only where that setting is absent (tests, a laptop) a local folder is made and set.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by all executors."""
    if at := spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY):
        return at.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_KEY} must name a folder that all executors share")
        _own[app] = tempfile.mkdtemp(prefix="mentionmill-")
        atexit.register(shutil.rmtree, _own[app], True)
    return "file://" + _own[app]


def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df``, computed once and written to the shared folder, in parts by the columns ``by``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    app = spark.sparkContext.applicationId
    if app not in _written:
        atexit.register(_at_end, spark)  # runs before the context's own end
    _written.setdefault(app, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results that still read them must be written or collected before."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _written.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def _at_end(spark: SparkSession) -> None:
    """What a session has staged goes with it; a context that has stopped before leaves its folder behind."""
    if spark.sparkContext._jsc is not None:
        release(spark)
