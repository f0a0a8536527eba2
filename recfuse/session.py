"""Session helpers: table access and lineage cuts that survive executor loss."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application; they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="recfuse-"), "recfuse.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(archive)  # the driver's file server hands it to the executors
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="recfuse-ckpt-")
    sc.setCheckpointDir(shared)


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` through reliable storage.

    Writes to the folder named by ``spark.checkpoint.dir``, which all executors share, so a lost
    executor costs a re-read and not the whole plan. A local session without that setting (tests)
    gets a temporary folder. Shuffle files of an eager cut go with its end and do not wait for the
    driver to collect its garbage, as nothing reads them again.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    if not eager:
        return df.checkpoint(False)
    with _shuffles_go(df.sparkSession):
        return df.select("*").checkpoint()  # a new plan, as one keeps the setting under which it was made


def stored(df: DataFrame) -> DataFrame:
    """``durable`` for wide tables of which each reader needs some columns: compressed columns in the same folder, until ``release``."""
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}.parquet"
    with _shuffles_go(spark):
        df.select("*").write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


@contextlib.contextmanager
def _shuffles_go(spark: SparkSession):
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, before)


def release(*frames: DataFrame) -> None:
    """Delete the files of results of ``durable`` and ``stored`` from which nothing is read any more; plans over them cannot run again."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        at = df.__dict__.get("_stored_at") or df._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
        path = sc._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least one partition per core, for work that costs far more than moving its rows.

    A table that is already split that far, as any large one is, stays as it is.
    """
    want = cores(df.sparkSession)
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def cores(spark: SparkSession) -> int:
    """Parallelism of the session, for sizing exchanges that AQE does not coalesce."""
    return max(1, spark.sparkContext.defaultParallelism)
