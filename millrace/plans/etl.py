"""From the three base tables to the cleaned, feature-rich order item table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.cleaning import (
    apply_cleaning, dedup_stored, extract, fit_cleaning, parse_timestamps,
)
from millrace.operators.features import derive, risk_scores
from millrace.session import staged

NUMERIC_COLUMNS = [
    "late_delivery_risk", "days_for_shipping_real", "days_for_shipment_scheduled",
    "order_item_quantity", "order_item_discount_rate", "order_item_product_price",
    "order_item_profit_ratio", "sales", "benefit_per_order", "sales_per_customer", "latitude",
    "longitude", "product_price",
]
TEXT_COLUMNS = [
    "shipping_mode", "order_status", "delivery_status", "order_region", "order_country", "market",
    "payment_type", "customer_segment", "customer_country", "category_name", "department_name",
]
DATES = ["order_date", "shipping_date"]
# Order of the copies of one item; the first is kept.
FIRST_SEEN = [
    "order_date", "order_id", "order_item_quantity", "sales_per_customer", "benefit_per_order",
]


def extracted_items(mart: dict[str, DataFrame]) -> DataFrame:
    """Joined items with readable dates: text columns are parsed, what cannot be read is null."""
    items = extract(mart["orders"], mart["customers"], mart["products"])
    return parse_timestamps(items, [c for c in DATES if items.schema[c].dataType.typeName() == "string"])


def first_items(items: DataFrame) -> DataFrame:
    """One row per item of the stored, joined items."""
    # Copies that are equal in what orders them differ, if at all, in the other columns.
    others = [c for c in sorted(items.columns) if c not in FIRST_SEEN]
    return dedup_stored(items, ["order_item_id"], [*FIRST_SEEN, *others])


def cleaned(items: DataFrame) -> DataFrame:
    """Fill, cap and add features to stored items without copies.

    Fills and caps are a handful of numbers learnt from four narrow passes over that table, the late
    rates from a fifth; applying them is a projection of the same table.
    """
    rules = fit_cleaning(items, NUMERIC_COLUMNS, TEXT_COLUMNS)
    return risk_scores(derive(apply_cleaning(items, rules)))


def clean_orders(mart: dict[str, DataFrame]) -> DataFrame:
    """Extract, parse dates, drop duplicates, fill, cap and add features.

    The joined items are written once, and again only where some of them are copies.
    """
    return cleaned(first_items(staged(extracted_items(mart), "order_items")))
