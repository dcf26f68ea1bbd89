"""Decoding of payment codes into names and descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment code -> (name, description); any other code, NULL
# included, decodes to the two fallbacks below.
PAYMENT_CODES = {
    1: ("Credit Card", "Payment by credit card"),
    2: ("Cash", "Cash payment"),
    3: ("No Charge", "Free ride"),
    4: ("Dispute", "Disputed charge"),
}
UNKNOWN_NAME = "Unknown"
UNKNOWN_DESCRIPTION = "Unknown payment type"

# Fixed value: the constant location name of the coordinate lane.
LOCATION_NAME = "NYC Area"


def _decode(code: Column, pick: int, fallback: str) -> Column:
    expr = None
    for k, labels in PAYMENT_CODES.items():
        expr = (F.when(code == k, labels[pick]) if expr is None else expr.when(code == k, labels[pick]))
    return expr.otherwise(fallback)


def decode_payment_name(code: str | Column) -> Column:
    return _decode(F.col(code) if isinstance(code, str) else code, 0, UNKNOWN_NAME)


def decode_payment_description(code: str | Column) -> Column:
    return _decode(F.col(code) if isinstance(code, str) else code, 1, UNKNOWN_DESCRIPTION)
