"""Frames derived from the driver's test tables: the reviews, their trusted
layer and product, and documents as an ingest source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinio.operators.aggregate import product
from opinio.operators.clean import clean
from opinio.sources.reviews import reviews_from_events, reviews_from_lineitem


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_events(table(spark, sf_dir, "events"))


def event_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(event_reviews(spark, sf_dir))


def event_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product(event_trusted(spark, sf_dir))


def lineitem_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_lineitem(table(spark, sf_dir, "lineitem"))


def lineitem_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product(clean(lineitem_reviews(spark, sf_dir)))
