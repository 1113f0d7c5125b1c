"""opinio: a Spark-native review-sentiment lakehouse.

Raw review files are cleaned into a trusted layer, classified and aggregated
into a partitioned data product, and served through saved summary queries,
partition gates and quality reports.  Every rule is a native Spark column
expression; every multi-day job is a single distributed Spark job.
"""

__version__ = "0.1.0"
