"""Month-partitioned Parquet output: full rebuild, trailing-window refresh and
catalog registration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import col_of, month_key


def cutoff_month(as_of: dt.date, months: int = 12) -> int:
    """``yyyyMM`` of ``as_of`` minus ``months`` calendar months."""
    total = as_of.year * 12 + (as_of.month - 1) - months
    return (total // 12) * 100 + total % 12 + 1


def trailing_months(df: DataFrame, ts: Column | str, as_of: dt.date, months: int = 12) -> DataFrame:
    """Rows whose calendar month of ``ts`` is on or after the cutoff month
    (NULL times are dropped)."""
    return df.where(month_key(col_of(ts)).cast("int") >= F.lit(cutoff_month(as_of, months)))


def spread_by_month(df: DataFrame, month: str) -> DataFrame:
    """Rows of a month together, and as many tasks for it as its size asks:
    the rebalance hint lets adaptive execution split a large month and join
    small ones by the advisory partition size, so the number of files follows
    the data."""
    return df.hint("rebalance", month)


def write_full(df: DataFrame, path: str, month: str) -> None:
    """Overwrite the whole table at ``path``, one directory per month."""
    spread_by_month(df, month).write.mode("overwrite").partitionBy(month).parquet(path)


def write_unpartitioned(df: DataFrame, path: str) -> None:
    """Overwrite an unpartitioned Parquet table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folders_at(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories at ``path``; none where it does not exist."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    return [x.getPath().getName() for x in fs.listStatus(root) if x.isDirectory()]


def months_at(spark: SparkSession, path: str, month: str) -> set[int]:
    """The months that have a directory at ``path``: a listing, no rows are read."""
    values = [n.partition("=")[2] for n in folders_at(spark, path) if n.startswith(f"{month}=")]
    return {int(v) for v in values if v.isdigit()}


def refresh_trailing(spark: SparkSession, new: DataFrame, path: str, month: str,
                     cutoff: int) -> list[int]:
    """Replace every month ``>= cutoff`` of the table at ``path`` with the
    rows of ``new`` in those months.

    The new rows are written once, by month, into the shared scratch folder;
    the listing of that folder names their months. They then replace these
    months by dynamic partition overwrite (other months stay byte-for-byte as
    they were); months ``>= cutoff`` that exist in the table but have no new
    rows are deleted afterwards, so a failure part-way never loses a month that
    has replacement data. Returns the deleted months.
    """
    from ..session import drop_path, scratch_path
    stage = scratch_path(spark, "refresh")
    fresh = new.where(F.col(month) >= F.lit(cutoff))
    spread_by_month(fresh, month).write.partitionBy(month).parquet(stage)
    old = {m for m in months_at(spark, path, month) if m >= cutoff}
    kept = months_at(spark, stage, month)
    if kept:
        (spark.read.schema(fresh.schema).parquet(stage).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path))
    drop_path(spark, stage)
    emptied = sorted(old - kept)
    for m in emptied:
        drop_path(spark, f"{path.rstrip('/')}/{month}={m}")
    return emptied


def register_table(spark: SparkSession, name: str, path: str, df: DataFrame,
                   month: str | None) -> None:
    """(Re)create catalog table ``name`` over ``path`` with ``df``'s columns
    and register the month directories found on disk."""
    cols = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != month)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if month:
        mtype = dict(df.dtypes)[month]
        spark.sql(f"CREATE TABLE {name} ({cols}, `{month}` {mtype}) USING parquet "
                  f"PARTITIONED BY (`{month}`) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet LOCATION '{path}'")
