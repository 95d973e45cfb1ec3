"""Month-partitioned tables that are replaced at one stroke.

The rows of a refresh are written once, into a folder of their own. A table
definition is then made whose partitions lie where their rows are: the new
months in the new folder, the others where they were. Readers use a view; one
``CREATE OR REPLACE VIEW`` moves it from the old definition to the new one. A
failure before that statement leaves the old table whole, one after it the new
one. What a failure leaves behind is swept by the next refresh.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path
from . import sink

_PREFIX = "v_"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a month


def _definitions(spark: SparkSession, name: str) -> list[str]:
    """The table definitions made for ``name``, current or not."""
    database, _, own = name.rpartition(".")
    where = f" IN {database}" if database else ""
    found = spark.sql(f"SHOW TABLES{where} LIKE '{own}__{_PREFIX}*'").collect()
    return [f"{database}.{r['tableName']}" if database else r["tableName"] for r in found]


def current(spark: SparkSession, name: str) -> str | None:
    """The definition that the view ``name`` shows; None without a view."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    return rows[0]["data_type"].rsplit(" ", 1)[-1] if rows else None


def _months(names: list[str], month: str) -> dict[int | None, str]:
    """Month (None: rows without one) to the name of its folder."""
    values = {n: n.partition("=")[2] for n in names if n.startswith(f"{month}=")}
    return {None if v == _NO_MONTH else int(v): n for n, v in values.items() if v == _NO_MONTH or v.isdigit()}


def _spec(month: str, value: int | None) -> str:
    return f"PARTITION (`{month}` = {'NULL' if value is None else value})"


def locations(spark: SparkSession, table: str, month: str) -> dict[int | None, str]:
    """Month to folder of a definition's partitions that hold files: one listing,
    as any scan of the table makes it."""
    folders = {f.rpartition("/")[0] for f in spark.table(table).inputFiles()}
    named = {f.rpartition("/")[2]: f for f in folders}
    return {m: named[n] for m, n in _months(list(named), month).items()}


def write(df: DataFrame, path: str, month: str) -> str:
    """Step 1: the rows, by month, in a folder of their own."""
    folder = f"{path.rstrip('/')}/{_PREFIX}{uuid.uuid4().hex[:12]}"
    sink.spread_by_month(df, month).write.partitionBy(month).parquet(folder)
    return folder


def define(spark: SparkSession, name: str, df: DataFrame, path: str, month: str,
           places: dict[int | None, str]) -> str:
    """Step 2: a definition with these partitions, which no reader sees yet."""
    table = f"{name}__{_PREFIX}{uuid.uuid4().hex[:12]}"
    cols = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != month)
    spark.sql(f"CREATE TABLE {table} ({cols}, `{month}` {dict(df.dtypes)[month]}) USING parquet "
              f"PARTITIONED BY (`{month}`) LOCATION '{path.rstrip('/')}'")
    if places:
        parts = " ".join(f"{_spec(month, m)} LOCATION '{p}'" for m, p in places.items())
        spark.sql(f"ALTER TABLE {table} ADD {parts}")
    return table


def switch(spark: SparkSession, name: str, table: str) -> None:
    """Step 3, the one that counts: readers see the new definition."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")


def sweep(spark: SparkSession, name: str, path: str, places: dict[int | None, str]) -> None:
    """Step 4: definitions and folders that the view does not use go. Readers
    that began before the switch must have ended."""
    used = current(spark, name)
    for table in _definitions(spark, name):
        if table.rpartition(".")[2] != used.rpartition(".")[2].strip("`"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    kept = {p.rstrip("/").rpartition("/")[::2] for p in places.values()}
    held = {top.rpartition("/")[2]: {leaf for t, leaf in kept if t == top} for top, _ in kept}
    for folder in sink.folders_at(spark, path):
        if not folder.startswith(_PREFIX):
            continue
        place = f"{path.rstrip('/')}/{folder}"
        if folder not in held:
            drop_path(spark, place)
            continue
        for leaf in sink.folders_at(spark, place):
            if leaf not in held[folder]:
                drop_path(spark, f"{place}/{leaf}")


def publish(df: DataFrame, name: str, path: str, month: str) -> None:
    """The whole table ``name`` (a view) at ``path`` from the rows of ``df``.
    Rows without a month are part of it."""
    _replace(df, name, path, month, lambda m: False)


def refresh(df: DataFrame, name: str, path: str, month: str, cutoff: int) -> list[int]:
    """Every month ``>= cutoff`` of the table is replaced by the rows of ``df``
    in these months; the other months stay where they are. Returns the months
    that have no rows any more. Rows without a month stay."""
    return _replace(df.where(F.col(month) >= F.lit(cutoff)), name, path, month,
                    lambda m: m is None or m < cutoff)


def _replace(df: DataFrame, name: str, path: str, month: str, stays) -> list[int]:
    spark = df.sparkSession
    used = current(spark, name)
    old = locations(spark, used, month) if used else {}
    folder = write(df, path, month)
    new = {m: f"{folder}/{n}" for m, n in _months(sink.folders_at(spark, folder), month).items()}
    places = {m: p for m, p in old.items() if stays(m)} | new
    switch(spark, name, define(spark, name, df, path, month, places))
    sweep(spark, name, path, places)
    return sorted(m for m in old if not stays(m) and m not in new and m is not None)
