"""Column expressions: keys, hashes and derived values."""

from pricevault.functions.keys import hash_diff, hash_diff_json, hash_key, short_digest, stable_text
from pricevault.functions.values import (
    canonical,
    movement,
    parse_date,
    parse_datetime,
    price_range,
    ratio,
)

__all__ = [
    "canonical",
    "hash_diff",
    "hash_diff_json",
    "hash_key",
    "movement",
    "parse_date",
    "parse_datetime",
    "price_range",
    "ratio",
    "short_digest",
    "stable_text",
]
