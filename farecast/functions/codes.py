"""Code -> label mappings of the cleaned trip record.

Each mapping becomes one CASE expression evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: they must equal the labels of the original pipeline -------
# provider: code 1, everything else (also NULL and unknown codes) -> the second
PROVIDER_CODE_1 = "Creative Mobile Technologies"
PROVIDER_OTHER = "VeriFone Inc."
# rate code -> label; other codes and NULL -> NULL.
# Code 4 is "Nassau/Westchester" (the original's label was garbled).
RATE_LABELS = {
    1: "standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "negotiated rate",
    6: "group_ride",
}
# payment code -> label; code 5, other codes and NULL -> NULL
PAYMENT_LABELS = {
    1: "credit card",
    2: "cash",
    3: "no charge",
    4: "dispute",
    6: "voided trip",
}
# payment labels that have a flag of their own, flag column -> label
PAYMENT_FLAG_LABELS = {
    "payment_cash": "cash",
    "payment_no_charge": "no charge",
    "payment_credit_card": "credit card",
    "payment_dispute": "dispute",
}
# -----------------------------------------------------------------------------


def label_case(code: Column, labels: dict[int, str], default: str | None = None) -> Column:
    """CASE code WHEN k THEN label ... ELSE default END (NULL code -> default)."""
    expr = None
    for k, label in labels.items():
        expr = F.when(code == F.lit(k), F.lit(label)) if expr is None else expr.when(code == F.lit(k), F.lit(label))
    return expr.otherwise(F.lit(default).cast("string"))


def provider_label(code: Column) -> Column:
    return label_case(code, {1: PROVIDER_CODE_1}, PROVIDER_OTHER)


def rate_label(code: Column) -> Column:
    return label_case(code, RATE_LABELS)


def payment_label(code: Column) -> Column:
    return label_case(code, PAYMENT_LABELS)
