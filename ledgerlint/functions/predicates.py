"""Null-safe row rules.

A rule that *removes* rows must be false, never unknown, where its input is
null: ``filter(~unknown)`` would silently drop the row. The ``is_`` and ``has_``
predicates therefore return true or false only, for flags and counts. The
``keeps_`` filters say the same in plain comparisons, which Parquet scans accept
as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlint.config import (
    EU_COUNTRIES,
    MAX_PRICE,
    PLACEHOLDER_QUANTITY,
    TECHNICAL_KEYWORDS,
)

_KEYWORD_PATTERN = "(?i)" + "|".join(TECHNICAL_KEYWORDS)


def holds(condition: Column) -> Column:
    """``condition``, with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def is_credit() -> Column:
    return holds(F.col("invoice").startswith("C"))


def is_placeholder_quantity() -> Column:
    return holds(F.abs("quantity") == PLACEHOLDER_QUANTITY)


def has_technical_keyword() -> Column:
    """Unanchored match in any case: ``LATEST`` counts as ``TEST``."""
    return holds(F.col("description").rlike(_KEYWORD_PATTERN))


def is_technical() -> Column:
    return is_placeholder_quantity() | has_technical_keyword()


def is_extreme_price() -> Column:
    return holds(F.col("price") > MAX_PRICE)


def is_acceptable_price() -> Column:
    """False for a null price too: this rule keeps rows instead of removing."""
    return holds(F.col("price") <= MAX_PRICE)


def is_negative() -> Column:
    return holds(F.col("quantity") < 0)


def is_zero_price_sale() -> Column:
    return holds(F.col("price") == 0) & ~is_credit()


def is_negative_sale() -> Column:
    return is_negative() & ~is_credit()


def is_nonpositive_quantity_sale() -> Column:
    return holds(F.col("quantity") <= 0) & ~is_credit()


def is_nonpositive_price_sale() -> Column:
    return holds(F.col("price") <= 0) & ~is_credit()


def _is_kept_as_credit() -> Column:
    return F.col("invoice").startswith("C")


def keeps_untechnical() -> Column:
    quantity, text = F.col("quantity"), F.col("description")
    placeholder = quantity.isin(PLACEHOLDER_QUANTITY, -PLACEHOLDER_QUANTITY)
    return (quantity.isNull() | ~placeholder) & (
        text.isNull() | ~text.rlike(_KEYWORD_PATTERN)
    )


def keeps_acceptable_price() -> Column:
    return F.col("price") <= MAX_PRICE


def keeps_priced() -> Column:
    price = F.col("price")
    return price.isNull() | (price != 0) | _is_kept_as_credit()


def keeps_unsigned() -> Column:
    """All but negative sales."""
    quantity = F.col("quantity")
    return quantity.isNull() | (quantity >= 0) | _is_kept_as_credit()


def keeps_negative_sales() -> Column:
    return (F.col("quantity") < 0) & ~is_credit()


def line_basket_value() -> Column:
    return F.when(
        F.col("quantity") > 0, F.col("quantity") * F.col("price")
    ).otherwise(F.lit(0.0))


def country_bucket() -> Column:
    country = F.col("country")
    return (
        F.when(country.isNull(), "Unknown")
        .when(country == "United Kingdom", "UK")
        .when(country.isin(*EU_COUNTRIES), "EU")
        .otherwise("NonEU")
    )


def surrogate_customer() -> Column:
    return F.concat(F.lit("anon_"), F.coalesce(F.lower("country"), F.lit("unknown")))


# The five anomaly flags, in report order.
def anomaly_flags() -> dict[str, Column]:
    return {
        "extreme_quantity": is_placeholder_quantity(),
        "extreme_price": is_extreme_price(),
        "negative_quantity_sale": is_negative_sale(),
        "zero_price_sale": is_zero_price_sale(),
        "technical_keyword": has_technical_keyword(),
    }
