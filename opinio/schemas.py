"""Contracts of the three layers and the fixed label vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's strings byte for byte.
# Raw header, in file order.
RAW_HEADERS = (
    "Clothing ID",
    "Age",
    "Title",
    "Review Text",
    "Rating",
    "Recommended IND",
    "Division Name",
    "Department Name",
    "Class Name",
)
# Age bands (lower bounds 18, 30, 45, 60) and sentiment labels.
AGE_BANDS = ("Jovem", "Adulto", "Madura", "Sênior")
SENTIMENTS = ("Positivo", "Neutro", "Negativo")
# Default expectations of the quality report.
EXPECTED_PARTITIONS = 235
EXPECTED_MIN_DT = "2024-01-01"
# Default batching of the ingest.
DEFAULT_BATCH_SIZE = 100
DEFAULT_START_DATE = "2024-01-01"
# Run-log columns, in order.
RUNLOG_FIELDS = ("dt", "status", "duration_s", "error")
# Product table properties (``owner`` is reserved in Spark, hence the prefix).
PRODUCT_PROPERTIES = {
    "product.owner": "data-team",
    "sla": "30min",
    "domain": "marketing",
}
# ---------------------------------------------------------------------------

PRODUCT_COLUMNS = ("age_band", "department_name", "sentiment", "review_count", "avg_rating")

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("age_band", T.StringType(), True),
        T.StructField("department_name", T.StringType(), True),
        T.StructField("sentiment", T.StringType(), True),
        T.StructField("review_count", T.IntegerType(), True),
        T.StructField("avg_rating", T.DoubleType(), True),
    ]
)

PRODUCT_TABLE_SCHEMA = T.StructType(
    list(PRODUCT_SCHEMA.fields) + [T.StructField("dt", T.DateType(), True)]
)

RUNLOG_SCHEMA = T.StructType(
    [
        T.StructField("dt", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("duration_s", T.DoubleType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)
