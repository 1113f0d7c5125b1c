"""Where the three layers live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    raw: str
    trusted: str
    product: str

    @classmethod
    def under(cls, root: str) -> "Lake":
        root = root.rstrip("/")
        return cls(
            raw=f"{root}/raw/reviews",
            trusted=f"{root}/trusted/reviews_clean",
            product=f"{root}/product/customer_sentiment_by_age",
        )
