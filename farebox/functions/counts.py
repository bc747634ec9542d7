"""Code-count pivot: one counter column per known code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.schemas import PAYMENT_CODES, RATE_CODES, VENDOR_CODES

# Counter family -> (code column, its code table).
FAMILIES = {
    "rate": ("rate_code", RATE_CODES),
    "payment": ("payment_type", PAYMENT_CODES),
    "vendor": ("vendor_id", VENDOR_CODES),
}


def counter_names(*families: str) -> list[str]:
    return [f"count_{family}_{name}" for family in families for name in FAMILIES[family][1]]


def counters(*families: str) -> list[Column]:
    return [
        F.count_if(F.col(FAMILIES[family][0]) == code).alias(f"count_{family}_{name}")
        for family in families
        for name, code in FAMILIES[family][1].items()
    ]
