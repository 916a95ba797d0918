"""Result tables: partitioned parquet with append, overwrite and keyed merge."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files

# Rows that one file should hold at most.
FILE_ROWS = 1_000_000


def scan_day(spark: SparkSession, path: str, day: str, column: str = "order_date") -> DataFrame:
    """Rows of one day of a table partitioned by ``column``; other partitions are not read."""
    return spark.read.parquet(path).filter(F.col(column) == day)


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: list[str],
    mode: str = "overwrite",
    keys: list[str] | None = None,
    cluster_by: list[str] | None = None,
    find_by: str | None = None,
) -> None:
    """Write a result table.

    ``overwrite`` replaces only the partitions present in ``df``, so running a day again does not
    double it. ``append`` adds rows. ``merge`` replaces rows with equal ``keys`` inside the touched
    partitions and keeps the rest; the partition columns have to be part of the keys.

    The rows of a partition value go to as many files of FILE_ROWS as the largest needs, and partition values are written
    side by side by all tasks. Files are sorted by ``cluster_by``; with ``find_by`` they are sorted by that column
    first and hold a filter of its values, so that reading one value skips what does not hold it.
    """
    if mode == "merge":
        df = df.persist()
        try:
            merged = _merged(df, path, partition_by, keys or [])
            write_table(merged, path, partition_by=partition_by, cluster_by=cluster_by, find_by=find_by)
        finally:
            df.unpersist()
        return
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode: {mode}")
    order = ([find_by] if find_by else []) + (cluster_by or [])
    df = df.persist()
    try:
        out = _spread(df, partition_by, order).sortWithinPartitions(*partition_by, *order)
        # A table without files has nothing to replace: its partitions need not be moved into place one by one.
        fresh = not any("=" in name for name in files.names(df.sparkSession, path))
        writer = out.write.mode("append" if fresh else mode).option("partitionOverwriteMode", "dynamic")
        if find_by:
            writer = writer.option(f"parquet.bloom.filter.enabled#{find_by}", "true")
        writer.partitionBy(*partition_by).parquet(path)
    finally:
        df.unpersist()


def _spread(df: DataFrame, partition_by: list[str], order: list[str]) -> DataFrame:
    """Rows dealt out so that each task writes some partition values, and large values go to several tasks."""
    found = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("values"), F.max("n").alias("most")).first()
    slots = max(1, -(-(found.most or 0) // FILE_ROWS))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.pmod(F.xxhash64(*(order or df.columns)), F.lit(slots)) if slots > 1 else F.lit(0)
    return df.repartition(max(1, min(found["values"] * slots, max(tasks, slots))), *partition_by, slot)


def _merged(df: DataFrame, path: str, partition_by: list[str], keys: list[str]) -> DataFrame:
    if not set(partition_by) <= set(keys):
        raise ValueError("merge keys must contain the partition columns")
    spark = df.sparkSession
    ensure_folder(spark, path)
    old = _touched(spark.read.schema(df.schema).parquet(path), df, partition_by)
    kept = old.join(df.select(*keys), _null_safe(old, df, keys), "left_anti")
    return df.unionByName(kept.select(*df.columns))


def _touched(old: DataFrame, df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Old rows of the partitions that ``df`` has rows for, all of them named in a filter, so that the others are
    not even read. There are no more names than folders in the file listing that the driver holds anyway."""
    touched = df.select(*partition_by).distinct().collect()
    if len(partition_by) == 1:
        column, values = F.col(partition_by[0]), [row[0] for row in touched]
        named = column.isin([v for v in values if v is not None])
        return old.filter(named | column.isNull() if None in values else named)
    rows = [reduce(and_, [F.col(c).eqNullSafe(row[c]) for c in partition_by]) for row in touched]
    return old.filter(reduce(or_, rows, F.lit(False)))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make the folder of a table that may not have been written yet, so it reads as empty."""
    files.make(spark, path)


def clear_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Remove one partition of a table, as an overwrite without rows leaves the old ones."""
    files.remove(spark, f"{path}/{column}={value}")


# Layout of the analytics tables: partition column derived from a timestamp, clustering columns.


def write_daily(df: DataFrame, path: str, mode: str = "overwrite", keys: list[str] | None = None) -> None:
    write_table(df, path, partition_by=["order_date"], mode=mode, keys=keys)


def replace_day(report: DataFrame, path: str, day: str) -> None:
    """Put a report in the place of everything the table has for the day, also where it has no rows."""
    report = report.filter(F.col("order_date") == day).persist()
    try:
        ensure_folder(report.sparkSession, path)
        if report.isEmpty():
            clear_partition(report.sparkSession, path, "order_date", day)
        else:
            write_daily(report, path)
    finally:
        report.unpersist()


def write_revenue(flat: DataFrame, path: str, mode: str = "overwrite", batch_id: int | None = None) -> None:
    """Per-minute revenue rows, one partition per hour of the window end, clustered by region."""
    hour = F.date_format("window_end_timestamp", "yyyy-MM-dd-HH")
    _write_by_time(flat.withColumn("hour", hour), path, "hour", mode, batch_id, ["region"])


def write_sessions(sessions: DataFrame, path: str, mode: str = "overwrite", batch_id: int | None = None) -> None:
    day = F.date_format("session_end", "yyyy-MM-dd")
    _write_by_time(sessions.withColumn("day", day), path, "day", mode, batch_id, ["device_type", "geo_region"], "user_id")


def write_alerts(alerts: DataFrame, path: str, mode: str = "overwrite", batch_id: int | None = None) -> None:
    day = F.date_format("detected_at", "yyyy-MM-dd")
    _write_by_time(alerts.withColumn("day", day), path, "day", mode, batch_id, [], "user_id")


def _write_by_time(
    df: DataFrame, path: str, time: str, mode: str, batch_id: int | None, cluster_by: list[str],
    find_by: str | None = None,
) -> None:
    """With ``batch_id`` (a micro-batch) the rows go below the time partition into one of their own,
    so batches add to a day and a repeated batch replaces itself."""
    partition_by = [time]
    if batch_id is not None:
        df = df.withColumn("batch", F.lit(batch_id))
        partition_by.append("batch")
    write_table(df, path, partition_by=partition_by, mode=mode, cluster_by=cluster_by, find_by=find_by)
