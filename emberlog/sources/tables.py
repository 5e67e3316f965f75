"""Table sinks and scans: idempotent partition overwrite.

Default storage is parquet directories (``fmt="parquet"``); with
``fmt="iceberg"`` the same calls use ``writeTo(...).overwritePartitions()``
on a catalog table (needs the Iceberg runtime on the classpath -- not shipped
here, so that path is untested in this environment).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.silver import event_time
from ..schemas import table_schema

ALL_OFFSETS = "all"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Derived partition columns per stored table (added by ``with_partition``).
# Bronze also carries the event's day, so that a rerun of some event days
# prunes it whatever days its rows came in, and the offset range it was taken
# from, so that ranges of one ingest day do not replace one another.
PARTITIONS = {
    "fg_events_raw": {"ingest_date": lambda fb: F.to_date("ingested_at"),
                      "offset_range": lambda fb: F.lit(ALL_OFFSETS),
                      "event_date": lambda fb: F.to_date(event_time(fb))},
    "fg_events_clean": {"event_date": lambda fb: F.to_date("event_time")},
    "fg_kpi_hourly": {"window_date": lambda fb: F.to_date("window_start")},
    "fg_sdwan_performance": {"window_date": lambda fb: F.to_date("window_start")},
    "fg_protocol_stats": {"day_date": lambda fb: F.to_date("day")},
    "fg_device_inventory": {},
    "fg_top_threat_ips": {},
    "fg_policy_traffic": {},
}


# The index of events without a time (``plans.first_seen``), kept for parquet tables.
INDEX, INDEX_PARTITIONS = "fg_first_seen", ["bucket", "ingest_date", "offset_range"]


def with_partition(df: DataFrame, table: str, fallback=None, offsets: str = ALL_OFFSETS) -> tuple[DataFrame, list[str]]:
    """``df`` with the table's partition columns, and their names; ``offsets`` names bronze's offset range."""
    columns = {name: expr(fallback) for name, expr in PARTITIONS.get(table, {}).items()}
    if table == "fg_events_raw" and "first_seen" not in df.columns:
        df = df.withColumn("first_seen", F.lit(None).cast("timestamp"))
    if "offset_range" in columns:
        columns["offset_range"] = F.lit(offsets)
    return df.withColumns(columns), list(columns)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                         fmt: str = "parquet", table: str | None = None, options=None) -> None:
    """Replace exactly the partitions present in ``df`` (whole table if none).

    Dynamic partition overwrite makes a rerun of the same input a no-op in
    effect (idempotent), and a run over one day leaves other days untouched.
    The rows are rebalanced on the partition columns first: AQE then writes
    each partition value from few tasks, and splits a value that is large.
    ``options`` adds settings to the writer.
    """
    if fmt == "iceberg":
        df.writeTo(table or path).overwritePartitions()
        return
    w = df.hint("rebalance", *partition_cols) if partition_cols else df
    writer = (w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .option("compression", "zstd"))
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if options:
        writer = options(writer)
    writer.format(fmt).save(path)


def scan(spark: SparkSession, path: str, fmt: str = "parquet", table: str | None = None) -> DataFrame:
    """Read a stored table (partition columns come back as columns).

    With ``table`` the declared columns are read, also where nothing is stored yet.
    """
    if fmt == "iceberg":
        return spark.table(path)
    reader = spark.read.schema(table_schema(table)) if table else spark.read
    return reader.format(fmt).load(path)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def partition_values(spark: SparkSession, path: str) -> list[str]:
    """The values of the partitions directly under ``path`` (a listing of one folder; null is ``NULL_PARTITION``)."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return sorted(unescape(n.split("=", 1)[1]) for n in names if "=" in n)


def add_partition(spark: SparkSession, path: str) -> None:
    """An empty partition folder, which says that its rows were looked at and none came out."""
    system, folder = _folder(spark, path)
    system.mkdirs(folder)


def drop_partition(spark: SparkSession, path: str) -> None:
    """Remove the files of one partition folder of a parquet table."""
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def create_statement(name: str, table: str, fmt: str) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the declared columns and partitioning."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(table))
    parts = list(PARTITIONS[table])
    # Silver is also bucketed by device where the format knows the transform.
    if table == "fg_events_clean" and fmt == "iceberg":
        parts.append("bucket(16, device_id)")
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}" + (f" PARTITIONED BY ({', '.join(parts)})" if parts else "")


def ensure_tables(spark: SparkSession, root: str, namespaces=("bronze", "silver", "gold"),
                  fmt: str = "parquet") -> dict[str, str]:
    """Create the pipeline's tables where they are missing; returns their locations.

    For parquet, tables are directories under ``root``; for a catalog format
    they are created with their declared columns and partitioning.
    """
    if fmt != "parquet":
        for ns in namespaces:
            spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")
    layout = {"fg_events_raw": "bronze", INDEX: "bronze", "fg_events_clean": "silver"}
    out = {}
    for t in [*PARTITIONS, *([INDEX] if fmt == "parquet" else [])]:
        ns = layout.get(t, "gold")
        out[t] = f"{ns}.{t}" if fmt != "parquet" else f"{root.rstrip('/')}/{ns}/{t}"
        if fmt == "parquet":
            system, folder = _folder(spark, out[t])
            system.mkdirs(folder)
        else:
            spark.sql(create_statement(out[t], t, fmt))
    return out
