"""Raw -> trusted: header normalisation, blank-review filter, age band (D1 core)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.rules import age_band, snake_case


class HeaderCollision(ValueError):
    """Two raw headers normalise to the same column name."""


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case in one projection.

    Header names are metadata, so the rule runs on the driver over the column
    list.  Two headers that collapse to one name (or to an empty name) raise
    instead of producing an ambiguous frame.
    """
    names = [snake_case(c) for c in df.columns]
    seen: dict[str, str] = {}
    for original, new in zip(df.columns, names):
        if not new:
            raise HeaderCollision(f"header {original!r} has no usable characters")
        if new in seen:
            raise HeaderCollision(f"headers {seen[new]!r} and {original!r} both map to {new!r}")
        seen[new] = original
    if names == list(df.columns):
        return df
    return df.toDF(*names)


def drop_blank_reviews(df: DataFrame) -> DataFrame:
    """Keep rows whose review text is non-null and not only spaces.

    ``trim`` strips U+0020 only, exactly like the job being matched.
    """
    text = F.col("review_text")
    return df.where(text.isNotNull() & (F.length(F.trim(text)) > 0))


def with_age_band(df: DataFrame) -> DataFrame:
    """Derive ``age_band`` from ``age``."""
    return df.withColumn("age_band", age_band("age"))


def clean(raw: DataFrame) -> DataFrame:
    """P1 -> P2 -> P4.  Unknown columns (and ``dt``) pass through."""
    return with_age_band(drop_blank_reviews(normalize_headers(raw)))
