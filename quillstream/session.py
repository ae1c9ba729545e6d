"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quillstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for. Without a master, the one of
    spark-submit is used. Adaptive execution stays on: it sizes shuffle partitions and splits
    skewed join partitions at run time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that every executor can see.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is not set, the warehouse serves, which
    all executors share too. The tables of an application are deleted when it ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    folder = f"{root.rstrip('/')}/quillstream-{spark.sparkContext.applicationId}"
    if folder not in _SCRATCH:
        _SCRATCH.add(folder)
        atexit.register(_delete, spark._jvm, spark._jsc.hadoopConfiguration(), folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_SCRATCH: set[str] = set()


def _delete(jvm, conf, folder: str) -> None:  # noqa: ANN001
    path = jvm.org.apache.hadoop.fs.Path(folder)
    # The JVM may have gone before.
    with contextlib.suppress(Exception):
        path.getFileSystem(conf).delete(path, True)


ARROW_ROWS = 2000
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that functions that run in
    Python there find their modules whatever the working folder is.

    Where the session leaves the rows of an Arrow batch at Spark's default, they become fewer: ten
    thousand texts at a time, in the executor and again in its Python worker, are much memory.
    """
    context = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows, "10000") == "10000":
        spark.conf.set(rows, str(ARROW_ROWS))
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="quillstream-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan to all cores.

    Annotation is bound by CPU, and one short file is one task. A scan that already has a partition
    per core is returned as it is, so a large input is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
