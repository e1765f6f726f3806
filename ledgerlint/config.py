"""Parameters and fixed vocabulary shared by every operator."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class CleaningConfig:
    """Parameters of the cleaning run.

    ``isolation_trees`` trees of ``isolation_depth`` levels are trained on
    ``isolation_tree_rows`` sale lines each;
    ``date_min`` / ``date_max`` bound the final date assertion;
    ``dedupe_exclude`` names columns that exact-duplicate removal ignores.
    """

    drop_missing_id: bool = True
    price_cap_q: float = 0.99
    basket_cap_q: float = 0.995
    isolation_contam: float = 0.001
    isolation_trees: int = 100
    isolation_tree_rows: int = 256
    isolation_depth: int = 8
    seed: int = 42
    date_min: str = "2009-12-01 00:00:00"
    date_max: str = "2011-12-09 23:59:59"
    dedupe_exclude: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> "CleaningConfig":
        """Build from upper-case keys such as ``DROP_MISSING_ID``."""
        return cls(**{key.lower(): value for key, value in values.items()})


# Rule thresholds.
PLACEHOLDER_QUANTITY = 1000
MAX_PRICE = 10000
MIN_LOAD_ROWS = 1000
MIN_YEAR, MAX_YEAR = 2000, 2025
HIGH_NULL_PCT = 20
NORMALITY_SAMPLE = 5000
NORMALITY_ALPHA = 0.05
HISTOGRAM_BINS = 50
BASKET_PERCENTILES = (99.0, 99.5, 99.9)
RECOMMENDED_PERCENTILE = 99.5

# Words that mark a technical line.
TECHNICAL_KEYWORDS = ("TEST", "MANUAL", "ADJUST")

# Labels of the basket caps, by percentile.
CAP_LABELS = {
    99.0: "Conservative",
    99.5: "Balanced (Recommended)",
    99.9: "Liberal",
}

# Countries counted as EU; names are exact and case-sensitive.
EU_COUNTRIES = (
    "Austria", "Belgium", "Bulgaria", "Croatia", "Cyprus", "Czech Republic",
    "Denmark", "Estonia", "Finland", "France", "Germany", "Greece", "Hungary",
    "Ireland", "Italy", "Latvia", "Lithuania", "Luxembourg", "Malta",
    "Netherlands", "Poland", "Portugal", "Romania", "Slovakia", "Slovenia",
    "Spain", "Sweden", "EIRE", "European Community", "Channel Islands",
)

# Waterfall steps in the order they are applied.
WATERFALL_STEPS = (
    "initial",
    "collapse_duplicates",
    "drop_technical",
    "drop_extreme_prices",
    "drop_zero_price",
    "drop_negative_non_credit",
    "handle_missing_id",
    "isolation_forest",
)
