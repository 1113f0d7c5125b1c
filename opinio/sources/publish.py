"""Publishing many days at once: readers see all days of a run or none.

A run writes its days to a folder of its own (``run=<id>/dt=<day>``), which no
reader looks at.  What is published is a manifest: one row per day that names the
folder holding it.  A new manifest takes the last one's days, replaces those of the
run, and appears under the next number by one rename of a finished folder, which
fails if another run took that number first; it is then made anew from that run's.
Readers go by the highest number.  A run that was killed before the rename leaves a
folder that no manifest names; it is listed, and can be dropped.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.dates import iso
from opinio.schemas import PRODUCT_TABLE_SCHEMA
from opinio.sources.storage import children, file_system

MANIFESTS = "_manifests"
_DAY = "dt string, run string"


class PublishConflict(RuntimeError):
    """Other runs kept publishing first."""


def write_run(df: DataFrame, root: str) -> str:
    """The days of ``df`` in a run folder, not yet published; returns the run's id."""
    run = uuid.uuid4().hex
    df.repartition("dt").write.option("compression", "snappy").partitionBy("dt").parquet(f"{root}/run={run}")
    return run


def _last(spark: SparkSession, root: str) -> int:
    return max((int(n) for n, _ in children(spark, f"{root}/{MANIFESTS}") if re.fullmatch(r"[0-9]{12}", n)), default=0)


def manifest(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """(dt, run) of the days published by the last manifest, or by the one of that number."""
    number = _last(spark, root) if number is None else number
    if number == 0:
        return spark.createDataFrame([], _DAY)
    return spark.read.schema(_DAY).parquet(f"{root}/{MANIFESTS}/{number:012d}")


def publish_run(spark: SparkSession, root: str, run: str, emptied: Iterable[str | _dt.date] = (), attempts: int = 20) -> int:
    """Publishes a written run's days and takes ``emptied`` days out, in one step; returns the manifest's number."""
    days = [name[3:] for name, is_folder in children(spark, f"{root}/run={run}") if is_folder and name.startswith("dt=")]
    gone = [iso(d) for d in emptied]
    own = spark.createDataFrame([(d, run) for d in days], _DAY)
    for _ in range(attempts):
        number = _last(spark, root) + 1
        kept = manifest(spark, root, number - 1).where(~F.col("dt").isin([*days, *gone]))
        staged = f"{root}/{MANIFESTS}/_staged-{uuid.uuid4().hex}"
        kept.unionByName(own).coalesce(1).write.parquet(staged)
        if _renamed(spark, staged, f"{root}/{MANIFESTS}/{number:012d}"):
            return number
        store, place = file_system(spark, staged)
        store.delete(place, True)
    raise PublishConflict(root)


def _renamed(spark: SparkSession, old: str, new: str) -> bool:
    """Renames a folder unless the new name is taken (one step of the file system; its plain rename would move into the folder there)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    way = getattr(hadoop, "Options$Rename")
    ways = spark.sparkContext._gateway.new_array(way, 1)
    ways[0] = way.NONE
    source = hadoop.Path(old)
    context = hadoop.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, hadoop.Path(new), ways)
    except Py4JJavaError as exc:
        if "FileAlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    return True


def publish_days(df: DataFrame, root: str, emptied: Iterable[str | _dt.date] = ()) -> int:
    """Writes the days of ``df`` and publishes them together; ``emptied`` days have no rows from then on."""
    return publish_run(df.sparkSession, root, write_run(df, root), emptied)


def published_scan(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The published product (contract schema): one folder for each day of the manifest, fixed when this is called."""
    schema = PRODUCT_TABLE_SCHEMA
    found = manifest(spark, root, number).collect()  # a row per day
    if not found:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/run={r.run}/dt={r.dt}" for r in found]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)


def unpublished_runs(spark: SparkSession, root: str) -> list[str]:
    """Runs whose folder no manifest names: torn ones, and those that are being written."""
    numbers = [n for n, _ in children(spark, f"{root}/{MANIFESTS}") if re.fullmatch(r"[0-9]{12}", n)]
    named = set()
    if numbers:
        named = {r[0] for r in spark.read.schema(_DAY).parquet(*[f"{root}/{MANIFESTS}/{n}" for n in numbers]).select("run").distinct().collect()}
    return [n[4:] for n, is_folder in children(spark, root) if is_folder and n.startswith("run=") and n[4:] not in named]


def drop_run(spark: SparkSession, root: str, run: str) -> None:
    """Deletes a torn run's folder; refused while a manifest names it."""
    if run not in unpublished_runs(spark, root):
        raise ValueError(f"run {run} is published, or not there")
    store, folder = file_system(spark, f"{root}/run={run}")
    store.delete(folder, True)
