"""Helpers shared by the operators: word rules, scratch tables, bounded joins."""

from __future__ import annotations

import io
import os
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.session import materialize, scratch_path

# A word is a run of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows of a frame that may be sent to every executor.
BROADCAST_ROWS = 200_000


def text_of(col: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text (JVM side); no words: an empty array."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+", -1), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ASCII strings take the fast path of lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def stage(df: DataFrame, tag: str, by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: computed once,
    read by several jobs, and still there after an executor is lost."""
    return materialize(df, tag, by)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` records for the jobs run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows; a larger
    one is joined by the plan that Spark chooses.  ``df`` must be cheap to read
    (a staged table or a small aggregate)."""
    few = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if few else df


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would.  Needed
    before a function of it runs in a task; done once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = scratch_path(spark, "package") + ".zip"
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(sc._jsc.hadoopConfiguration())
    out = store.create(place)
    out.write(bytearray(packed.getvalue()))
    out.close()
    store.deleteOnExit(place)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
