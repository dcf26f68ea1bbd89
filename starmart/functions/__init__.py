"""Column expressions used by the operators (all built-in Spark functions)."""

from starmart.functions.dates import datetime_parts, duration_seconds, weekday
from starmart.functions.payment import decode_payment_description, decode_payment_name

__all__ = [
    "datetime_parts",
    "duration_seconds",
    "weekday",
    "decode_payment_name",
    "decode_payment_description",
]
