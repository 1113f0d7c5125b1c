"""Catalog registration (K1-K5): databases, the product table, partitions,
the schema contract and the saved views."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.functions.dates import iso
from opinio.operators import views
from opinio.schemas import PRODUCT_PROPERTIES, PRODUCT_TABLE_SCHEMA
from opinio.sources.storage import children, task_file_system


def register_databases(spark: SparkSession, locations: dict[str, str]) -> None:
    """K4: one database per layer, with its location."""
    for name, location in locations.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def register_product_table(spark: SparkSession, table: str, location: str) -> None:
    """K1: external Parquet table, contract columns, ``dt date`` partition."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PRODUCT_TABLE_SCHEMA.fields)
    props = ", ".join(f"'{k}'='{v}'" for k, v in PRODUCT_PROPERTIES.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING PARQUET "
        f"PARTITIONED BY (dt) LOCATION '{location}' TBLPROPERTIES ({props})"
    )


def sync_partitions(spark: SparkSession, table: str, days=None) -> DataFrame:
    """K2: make new ``dt=`` folders visible; returns ``SHOW PARTITIONS``.

    With ``days`` (the days a job just wrote) only those partitions are added,
    in one metadata statement - no listing of the table's other folders.
    Without, the whole location is scanned (``MSCK REPAIR TABLE``).
    """
    if days:
        specs = " ".join(f"PARTITION (dt='{iso(d)}')" for d in sorted({iso(d) for d in days}))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    else:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)
    return spark.sql(f"SHOW PARTITIONS {table}")


def partition_diff(spark: SparkSession, table: str) -> DataFrame:
    """K2/K3: registered partitions against the stored folders, both ways.

    One row per partition: ``OK``, ``NEW`` (a folder that is not registered) or
    ``VANISHED`` (registered, its folder is gone).  Vanished partitions are reported
    and stay registered; ``sync_partitions`` adds the new ones.  Costs one listing of
    the table's folder."""
    location, registered = _registered(spark, table)
    stored = [name for name, is_folder in children(spark, location) if is_folder and "=" in name]
    frame = lambda names, mark: spark.createDataFrame([(n, True) for n in names], f"partition string, {mark} boolean")
    both = frame(registered, "registered").join(frame(stored, "stored"), "partition", "full")
    status = F.when(F.col("registered") & F.col("stored"), "OK").when(F.col("stored"), "NEW").otherwise("VANISHED")
    return both.select("partition", F.coalesce("registered", F.lit(False)).alias("registered"), F.coalesce("stored", F.lit(False)).alias("stored"), status.alias("status"))


def _registered(spark: SparkSession, table: str) -> tuple[str, list[str]]:
    """The table's location and its registered partitions."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return described["Location"], [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _footer_types(meta: pq.FileMetaData) -> dict[str, str]:
    """Columns and Spark types of a Parquet file by its footer."""
    stored = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if stored:  # the writer's schema, which Spark reads too
        return {f.name: f.dataType.simpleString() for f in T.StructType.fromJson(json.loads(stored)).fields}
    from pyspark.sql.pandas.types import from_arrow_type

    physical = {meta.schema.column(i).path: meta.schema.column(i).physical_type for i in range(len(meta.schema))}
    found = {}
    for field in meta.schema.to_arrow_schema():
        try:
            found[field.name] = "timestamp" if physical.get(field.name) == "INT96" else from_arrow_type(field.type).simpleString()
        except Exception:  # a type that Spark does not have
            found[field.name] = str(field.type)
    return found


def _stored_types(wanted: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition folders -> their files' columns and types; a row without a name for a folder that is gone.

    Of each file only the footer is read (from its end, through the file system), whatever its size."""
    for batch in batches:
        rows = []
        for folder, part in zip(*(batch.column(c).to_pylist() for c in ("folder", "part")), strict=True):
            store, root = task_file_system(folder)
            if store.get_file_info(root).type != fs.FileType.Directory:
                rows.append((part, None, None))
                continue
            for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
                if info.type == fs.FileType.File and info.size and not re.search(r"/[._]", info.path[len(root) :]):
                    with store.open_input_file(info.path) as file:
                        found = _footer_types(pq.read_metadata(file))
                    rows += [(part, name, found.get(name)) for name in [*wanted, *(n for n in found if n not in wanted)]]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], ["part", "name", "type"])


def schema_contract(spark: SparkSession, table: str, contract: T.StructType = PRODUCT_TABLE_SCHEMA) -> DataFrame:
    """K3: drift report over the stored files; drift is reported, never applied.

    The footer of every file of every registered partition is read, in Spark
    tasks, and held against the contract: a row per column and type found, ``OK``,
    ``TYPE_CHANGED``, ``MISSING`` (in the contract, not the file) or
    ``UNEXPECTED`` (the reverse), with the number of partitions that have such a
    file; one whose files differ counts in several rows.  The partition key's type
    comes from the folder names; registered partitions whose folder is gone count in
    its row ``VANISHED``.
    """
    location, parts = _registered(spark, table)
    wanted = {f.name: f.dataType.simpleString() for f in contract.fields}
    rows = []
    if parts:
        key = parts[0].split("=")[0]
        stored = [name for name in wanted if name != key]
        folders = spark.createDataFrame([(f"{location}/{part}", part) for part in parts], "folder string, part string").repartition(min(len(parts), 1000))
        types = folders.mapInArrow(partial(_stored_types, stored), "part string, name string, type string")
        # a file's own column named like the key is the folder's
        counted = types.where(F.col("name").isNull() | (F.col("name") != key)).groupBy("name", "type").agg(F.countDistinct("part").alias("n")).collect()
        seen = {(r.name, r.type): r.n for r in counted if r.name is not None}
        for part_name in parts:
            kind = "date" if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", part_name.split("=", 1)[1]) else "string"
            seen[key, kind] = seen.get((key, kind), 0) + 1
        for (name, actual), partitions in seen.items():
            expected = wanted.get(name)
            status = "OK" if expected == actual else "MISSING" if actual is None else "UNEXPECTED" if expected is None else "TYPE_CHANGED"
            rows.append((name, expected, actual, status, partitions))
        rows += [(key, wanted.get(key), None, "VANISHED", r.n) for r in counted if r.name is None]
    return spark.createDataFrame(rows, "column_name string, expected_type string, actual_type string, status string, partitions bigint")


VIEW_BUILDERS = {
    "vw_sentiment_by_age": views.vw_sentiment_by_age,
    "vw_sentiment_by_dept": views.vw_sentiment_by_dept,
    "vw_daily_trend": views.vw_daily_trend,
}


def register_views(product: DataFrame) -> list[str]:
    """K5: the three saved queries as temporary views over ``product``."""
    for name, build in VIEW_BUILDERS.items():
        build(product).createOrReplaceTempView(name)
    return list(VIEW_BUILDERS)


def _view_sql(table: str, keys: str, mean: bool) -> str:
    """A saved query as SQL, with the exact mean of ``views.mean_of_means``."""
    cents = "try_cast(avg_rating AS decimal(16,2))"
    exact = f"cast(round(sum({cents}) / cast(nullif(count({cents}), 0) AS decimal(12,0)), 2) AS double)"
    media = f", CASE WHEN count({cents}) = count(avg_rating) THEN {exact} ELSE round(avg(avg_rating), 2) END AS media_nota" if mean else ""
    return f"SELECT {keys}, cast(sum(review_count) AS bigint) AS total_reviews{media} FROM {table} GROUP BY {keys} ORDER BY {keys}"


SAVED_QUERIES = {
    "vw_sentiment_by_age": ("age_band, sentiment", True),
    "vw_sentiment_by_dept": ("department_name, sentiment", True),
    "vw_daily_trend": ("dt, sentiment", False),
}


def save_views(spark: SparkSession, table: str, database: str | None = None) -> list[str]:
    """K5: the three saved queries as views of the catalog, next to ``table`` or in ``database``.

    They outlive the session wherever the catalog does (a metastore) and are replaced when saved
    again.  A view holds its query, not rows: it always shows the table as it is."""
    place = f"{database}." if database else f"{table.rpartition('.')[0]}." if "." in table else ""
    names = [f"{place}{name}" for name in SAVED_QUERIES]
    for name, (keys, mean) in zip(names, SAVED_QUERIES.values(), strict=True):
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {_view_sql(table, keys, mean)}")
    return names


def table_properties(spark: SparkSession, table: str) -> DataFrame:
    """The product table's properties as ``(key, value)`` rows."""
    return spark.sql(f"SHOW TBLPROPERTIES {table}").where(~F.col("key").startswith("transient"))
