"""Session set-up and the shared folder used for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SCRATCH: tempfile.TemporaryDirectory | None = None
_SHIPPED: set[str] = set()  # applications whose workers have the package


def build_session(master: str = "local[8]", app: str = "vitalis", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster the session normally exists already; this is for tests, the
    benchmark and notebooks.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def configured(spark: SparkSession, **values: str):
    """Session settings that hold inside the block (dots as double underscores) and are put back after it."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Where one machine does all the work a temporary folder serves, which goes with the process. On
    a cluster that names none this is an error: executors don't see each other's folders.
    """
    global _LOCAL_SCRATCH
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.TemporaryDirectory(prefix="vitalis-", ignore_cleanup_errors=True)
    return _LOCAL_SCRATCH.name


def ship(spark: SparkSession, root: Path) -> None:
    """Give the package below ``root`` to the Python workers, unless they find it by themselves."""
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or spark.sparkContext.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="vitalis-code-")) / "vitalis_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in [*(root / "vitalis").rglob("*.py"), *root.glob("corpus_pipeline.py")]:
            out.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and read it back.

    Used where a plan is read many times (iterative fits, folds): the copy survives lost
    executors and cuts the lineage. ``compression`` names the files' codec where it should not be the session's.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, bytes_per_task: int = 32 << 20) -> DataFrame:
    """Give a small input one slice per core before costly per-row work.

    A small table is often a single file, which one task would read and process alone. Large
    inputs already come in many splits and pass through without a shuffle.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(tasks) if size < tasks * bytes_per_task else df


def travelling(small: DataFrame, max_rows: int = 100_000, max_bytes: int = 32 << 20) -> DataFrame:
    """A frame that is broadcast if it is small, else as it came.

    The size is measured, not assumed. Beyond the bound the join is left to a shuffle, where
    adaptive execution splits skewed keys.
    """
    rows = small.limit(max_rows + 1).toArrow()
    if len(rows) > max_rows or rows.nbytes > max_bytes:
        return small
    return F.broadcast(small.sparkSession.createDataFrame(rows, small.schema))


def keep_apart(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition by the columns of the next grouping, at full width.

    The grouping needs this shuffle anyway. Naming the width keeps adaptive execution from merging
    partitions that are small now but feed costly per-row Python work.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(width, *columns)
