"""Text helpers: e-mail keys, price extraction, payout labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The plan-text price pattern and the bulk-payout description format.
PRICE_PATTERN = r"\$(\d+(?:\.\d+)?)"
EDGE_SPACE = r"^[\s\p{Z}\x{85}]+|[\s\p{Z}\x{85}]+$"
PAYOUT_PREFIX = "Earnings from App Store subscriptions for"
PAYOUT_LABEL_PATTERN = r"for (.+)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_email(c) -> Column:
    """Join key for e-mails: lower-cased, surrounding white space of any kind removed."""
    return F.lower(F.regexp_replace(_col(c), EDGE_SPACE, ""))


def imputed_price(c) -> Column:
    """Dollar amount written in a plan name (``"$60.50 a year"`` -> 60.5), else NULL."""
    return F.nullif(F.regexp_extract(_col(c), PRICE_PATTERN, 1), F.lit("")).try_cast("double")


def payout_label(c) -> Column:
    """Text after ``for `` at the end of a payout description; NULL when absent."""
    return F.nullif(F.regexp_extract(_col(c), PAYOUT_LABEL_PATTERN, 1), F.lit(""))


def source_uri(publication) -> Column:
    return F.concat(F.lit("https://"), _col(publication), F.lit(".substack.com"))
