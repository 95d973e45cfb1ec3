"""Session-level helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed for (AQE re-plans joins and coalesces
# partitions at run time; skew join splits hot partitions).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ~256 MB per post-shuffle partition and per scan split
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "268435456",
    "spark.sql.files.maxPartitionBytes": "268435456",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def shared_dir(spark: SparkSession) -> str:
    """The storage that every executor and the driver see: the cluster's
    checkpoint folder (``spark.checkpoint.dir`` or the context's), else the
    session's warehouse. Never a machine-local folder: on a cluster a warehouse
    on the driver's own disk is refused."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    p, fs = _hadoop_path(spark, path)
    if fs.getUri().getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: "
                           f"{path} is on the driver's own disk")
    return path


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's own folder of the shared storage, for
    job output that must survive executor loss. The folder goes when the
    application ends."""
    home = f"{shared_dir(spark)}/contrail-{spark.sparkContext.applicationId}"
    p, fs = _hadoop_path(spark, home)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    path = f"{home}/{name}-{uuid.uuid4().hex[:12]}"
    for made in getattr(_OPEN, "scopes", [])[-1:]:
        made.append(path)
    return path


_OPEN = threading.local()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Scratch paths that are made inside go at the end: for a step whose result
    is written to a path made before, so that nothing reads its stages any more."""
    scopes = _OPEN.scopes = getattr(_OPEN, "scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def cut_lineage(df: DataFrame, name: str = "stage", path: str | None = None,
                compression: str = "zstd") -> DataFrame:
    """Cut the lineage by writing ``df`` as a Parquet table into the shared
    folder and reading it back (with the known schema, so no inference job).
    Compared with ``Dataset.checkpoint()`` the stage is columnar and
    compressed, and later steps read only the columns they use. A lost
    executor recomputes from this table, not from the sources."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
