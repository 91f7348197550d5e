"""Business settings as plain data; every operator takes what it needs as a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field

# Decimals of currencies that don't have two.
MINOR_UNITS = {"JPY": 0, "KRW": 0, "KWD": 3, "BHD": 3}

# The currency that each market's site shows.
MARKET_CURRENCY = {
    "ARE": "AED", "AUS": "AUD", "CAN": "CAD", "CHN": "CNY", "FRA": "EUR", "GBR": "GBP", "HKG": "HKD", "JPN": "JPY",
    "KOR": "KRW", "MEX": "MXN", "MYS": "MYR", "SAU": "SAR", "SGP": "SGD", "THA": "THB", "TWN": "TWD", "USA": "USD",
}
WEEKLY_MARKETS = ("ARE", "CHN", "FRA", "GBR", "HKG", "JPN", "KOR", "USA")

# What happens to a line for which a rule fires.
HANDLING = {
    "fix": (
        "price_us_thousands_separator", "price_eu_decimal_format", "price_currency_symbol", "price_trailing_decimals", "price_non_ascii_digits",
        "price_dot_thousands_ambiguous", "price_numeric_type_drift", "missing_price_value", "currency_code_notation", "name_html_entity",
        "name_whitespace_noise", "name_case_drift", "category_mojibake", "sku_format_variant", "sku_recovered_from_object_id",
        "market_recovered_from_source", "timestamp_epoch_seconds", "is_valid_as_string", "exact_duplicate_line",
    ),
    "warn": ("url_missing", "preview_url_missing"),
    "quarantine": (
        "price_ambiguous_separator", "price_on_request", "price_from_or_range", "price_placeholder", "price_unparseable", "currency_market_mismatch",
        "name_missing", "conflicting_duplicate", "non_product_page", "http_error_or_invalid", "is_valid_contradiction", "price_scale_outlier",
    ),
}


@dataclass(frozen=True)
class CrawlConfig:
    """What staging needs to know of a brand and its crawlers."""

    brand: str = "Brand"
    tag_prefix: str = "br"
    #: A crawler that writes names in mixed case; all others write lower case.
    mixed_case_crawler: str = "BrandLocal"
    market_currency: dict[str, str] = field(default_factory=lambda: dict(MARKET_CURRENCY))
    minor_units: dict[str, int] = field(default_factory=lambda: dict(MINOR_UNITS))
    weekly_markets: tuple[str, ...] = WEEKLY_MARKETS
    partial_threshold: float = 0.70
    stale_days: int = 3
