"""Sources and sinks (A1-A9): strict CSV scans, date normalisation, managed
tables, single-file CSV export of summaries, optional reads and display-name
views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beforeafter.sources.schemas import DATE_COLUMNS, DISPLAY_NAMES, SCHEMAS
from beforeafter.session import materialize, scratch_path


def read_csv_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A1: headered CSV with a declared schema; a malformed row fails the scan."""
    return (
        spark.read.option("header", "true")
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(path)
    )


def normalize_dates(df: DataFrame, dates: tuple[str, ...] = (), timestamps: tuple[str, ...] = ()) -> DataFrame:
    """A2: re-parse date and timestamp columns that may arrive as text."""
    out = df
    for c in dates:
        out = out.withColumn(c, F.to_date(F.col(c)))
    for c in timestamps:
        out = out.withColumn(c, F.to_timestamp(F.col(c)))
    return out


def normalize_table(df: DataFrame, table: str) -> DataFrame:
    """A2 with the per-table column lists."""
    d, t = DATE_COLUMNS[table]
    return normalize_dates(df, d, t)


def load_table(
    df: DataFrame,
    name: str,
    recreate: bool = False,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A4: overwrite a managed table (schema may change); optionally drop it first.

    Nothing is deleted that the catalog does not know: a folder that lies in the
    place of a new table makes the load fail.
    """
    spark = df.sparkSession
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    place = _managed_location(spark, name)
    if not spark.catalog.tableExists(name) and place and path_exists(spark, place):
        raise RuntimeError(f"{place} exists but the catalog has no table {name}; remove the folder or use another name")
    w = df.write.format(fmt).mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return spark.table(name)


def ingest(spark: SparkSession, paths: dict[str, str], suffix: str = "") -> dict[str, DataFrame]:
    """A1-A4 for the source tables: strict CSV read with the declared schema, date
    normalisation, load as managed table ``<name><suffix>``.  ``paths`` maps the
    names of ``SCHEMAS`` to CSV files; returns the loaded tables by name."""
    out = {}
    for name, path in paths.items():
        bronze = normalize_table(read_csv_strict(spark, path, SCHEMAS[name]), name)
        out[name] = load_table(bronze, f"{name}{suffix}")
    return out


def row_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """A5: one row per table with its row count (one job, counts run in parallel)."""
    parts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count"
        )
        for n in names
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _managed_location(spark: SparkSession, name: str) -> str | None:
    if "." in name:
        return None
    wh = spark.conf.get("spark.sql.warehouse.dir", None)
    if not wh:
        return None
    return f"{wh.rstrip('/')}/{name.lower()}"


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, tag)


def export_single_csv(df: DataFrame, export_dir: str, filename: str) -> str:
    """Write ``df`` as exactly one headered CSV file ``export_dir/filename``.

    For summary-size tables only: ``coalesce(1)`` funnels the rows through one
    task.  The frame is first stored by its own partitions and coalesced from
    there, so the upstream plan keeps its parallelism.  An existing file is put
    aside until the new one is in place.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex  # two exports to one folder do not meet
    target = f"{export_dir.rstrip('/')}/{filename}"
    rows = materialize(df, "export")
    draft = f"{export_dir.rstrip('/')}/.{filename}.{run}"
    rows.coalesce(1).write.option("header", "true").csv(draft)
    fs, folder = _fs(spark, draft)
    written = [f.getPath() for f in fs.globStatus(_fs(spark, f"{draft}/part-*.csv")[1])]
    if len(written) != 1:
        raise RuntimeError(f"the export of {filename} wrote {len(written)} files")
    _, place = _fs(spark, target)
    _, aside = _fs(spark, f"{draft}.before")
    had = fs.exists(place)
    if had and not fs.rename(place, aside):
        raise RuntimeError(f"{target} is in use")
    if not fs.rename(written[0], place):
        if had:
            fs.rename(aside, place)  # the old file stays as it was
        raise RuntimeError(f"{target} could not be written")
    if had:
        fs.delete(aside, False)
    fs.delete(folder, True)
    return target


def read_gold(spark: SparkSession, path: str, schema: StructType, required: bool = True) -> DataFrame:
    """Read an exported CSV; a missing optional file gives an empty frame."""
    if not path_exists(spark, path):
        if required:
            raise FileNotFoundError(f"missing required file: {path}")
        return spark.createDataFrame([], schema)
    return read_csv_strict(spark, path, schema)


def export_gold(
    tables: dict[str, DataFrame],
    export_dir: str,
    partitioned: tuple[str, ...] = ("fact_customer_month_incrementality", "dim_customer_month_rfm"),
) -> dict[str, str]:
    """The customer-grain tables (unbounded size) as parquet partitioned by
    month; the summaries as single CSV files."""
    out: dict[str, str] = {}
    for name, df in tables.items():
        if name in partitioned:
            path = f"{export_dir.rstrip('/')}/{name}"
            # REBALANCE groups rows by month before the write (few files per
            # month instead of one per task and month) and lets AQE split a
            # month that is much larger than the others across tasks.
            df.hint("rebalance", "month_id").write.mode("overwrite").partitionBy("month_id").parquet(path)
            out[name] = path
        else:
            out[name] = export_single_csv(df, export_dir, f"{name}.csv")
    return out


def replace_partitions(df: DataFrame, path: str, column: str, values: list[int]) -> None:
    """Replace the folders ``column=value`` of ``values`` in a partitioned Parquet table
    by the rows of ``df``, which has no other values.  Other folders are not touched;
    a value without rows loses its folder.  ``df`` is read twice, so store it first."""
    spark = df.sparkSession
    df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        column
    ).parquet(path)
    present = {r[0] for r in df.select(column).distinct().collect()}  # at most one row per value
    for value in set(values) - present:
        fs, folder = _fs(spark, f"{path.rstrip('/')}/{column}={value}")
        fs.delete(folder, True)


def register_views(tables: dict[str, DataFrame], display: bool = True) -> list[str]:
    """Temp views under the technical or the business display name."""
    names = []
    for name, df in tables.items():
        view = DISPLAY_NAMES.get(name, name) if display else name
        df.createOrReplaceTempView(f"`{view}`" if " " in view else view)
        names.append(view)
    return names
