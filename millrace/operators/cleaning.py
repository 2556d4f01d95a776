"""Extraction and cleaning of order items."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.lookup import mapped
from millrace.functions.numeric import clamp
from millrace.functions.stats import (
    at_ranks, modes, position, quantiles, sketched,
)
from millrace.session import staged

# Market base rates, shipping mode adjustments and the rate of unlisted markets.
MARKET_BASE = {
    "Federal": 0.72, "Balochistan": 0.64, "KPK": 0.59, "Sindh": 0.52, "Punjab": 0.48,
}
MODE_ADJUSTMENT = {
    "Standard Class": 0.15, "Second Class": 0.08, "First Class": -0.05, "Same Day": -0.15,
}
UNLISTED_RATE = 0.55

MONEY = ["sales", "benefit_per_order", "sales_per_customer"]
OF_CUSTOMER = ["customer_segment", "customer_country", "latitude", "longitude"]


def not_canceled(df: DataFrame) -> DataFrame:
    return df.where(F.col("order_status") != "CANCELED")


def late_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("late_delivery_risk") == 1)


def extract(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Order items that were not canceled, with their customer and product attributes.

    Products come first: orders that were joined by product last are not dealt again for them. Orders
    that carry their customers' attributes have met these before, and are not dealt by customer.
    """
    what = products.select("product_id", "category_name", "department_name", "product_price")
    items = not_canceled(orders).join(what, "product_id")
    if not set(OF_CUSTOMER) <= set(orders.columns):
        items = items.join(customers.select("customer_id", *OF_CUSTOMER), "customer_id")
    return (
        items.select(
            "order_id", "order_item_id", "order_date", "shipping_date", "shipping_mode",
            "order_status", "delivery_status", "late_delivery_risk", "days_for_shipping_real",
            "days_for_shipment_scheduled", "order_item_quantity", "order_item_discount_rate",
            "order_item_product_price", "order_item_profit_ratio", "sales", "benefit_per_order",
            "sales_per_customer", "order_region", "order_country", "market",
            F.col("type").alias("payment_type"), *OF_CUSTOMER, "category_name", "department_name",
            "product_price",
        )
    )


def dedup(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first in the given order.

    A rank limited to 1 is pruned before the shuffle, so many copies of one key stay cheap.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("copy", F.row_number().over(first)).where("copy = 1").drop("copy")


def dedup_stored(items: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """As ``dedup``, for a stored table whose rows are mostly the only ones of their key.

    Keys are counted by a digest, and only rows of a digest that occurs again are ordered; a table
    without such rows is given back as it is. Each wide row is dealt at most once, for its digest.
    """
    marked = items.withColumn("digest", F.xxhash64(*keys))
    again = staged(
        marked.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "repeated")
    if again.isEmpty():
        return items
    copies = dedup(marked.join(again, "digest", "left_semi"), keys, order)
    return staged(
        marked.join(again, "digest", "left_anti").unionByName(copies).drop("digest"), "first_copies")


def parse_timestamps(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to timestamp; unreadable text becomes null."""
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in cols})


def learn_fills(df: DataFrame, numeric: list[str], text: list[str]) -> dict[str, float | str]:
    """Median or most frequent value of those columns that have a missing value."""
    return fit_cleaning(df, numeric, text, []).fills


def _fill(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def fill_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill missing numbers with the exact median of their column."""
    return _fill(as_double(df, cols), learn_fills(df, cols, []))


def fill_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill missing text with the most frequent value of its column."""
    return _fill(df, learn_fills(df, [], cols))


def abs_fix(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.abs(column))


def negative_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column) < 0).alias("negative"))


def cap(df: DataFrame, caps: dict[str, float]) -> DataFrame:
    """Lower larger values to a fixed cap per column; missing values stay missing."""
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(F.col(c), F.lit(v))) for c, v in caps.items()
    })


def clip_upper(df: DataFrame, cols: list[str], p: float = 0.99) -> DataFrame:
    """Cap columns at their own exact p-quantile."""
    caps = quantiles(df, dict.fromkeys(cols, p))
    return cap(as_double(df, cols), {c: v for c, v in caps.items() if v is not None})


def delivery_status(status: Column, risk: Column, scheduled: Column, actual: Column) -> Column:
    return (
        F.when(status == "CANCELED", "Shipping canceled")
        # The status texts.
        .when(risk == 1, "Late delivery")
        .when(actual < scheduled, "Advance shipping")
        .otherwise("Shipping on time")
    )


def prior_late_probability(market: Column, mode: Column,
                           market_base: dict[str, float] = MARKET_BASE) -> Column:
    """Rule-based chance of lateness before any history is known."""
    base = mapped(market, market_base, UNLISTED_RATE)
    return clamp(base + mapped(mode, MODE_ADJUSTMENT, 0.0), 0.1, 0.95)


@dataclass(frozen=True)
class CleaningRules:
    """What cleaning learnt from one table: one number or text per column."""

    numeric: list[str]
    fills: dict[str, float | str]
    caps: dict[str, float]


def _filled(df: DataFrame, numeric: list[str], fills: dict[str, float | str]) -> DataFrame:
    return abs_fix(_fill(as_double(df, numeric), fills), "sales")


def _capped_at(held: dict[int, float], ranks: list[int], share: float, gaps: int,
               fill: float | None) -> float:
    """Quantile of a column whose ``gaps`` were filled with one value, from the values it had.

    The value at a rank is the one ``gaps`` ranks lower if that is beyond the fill, the one at the
    rank itself if that is before it, else the fill.
    """
    def value(rank: int) -> float:
        shifted = held.get(rank - gaps)
        if shifted is not None and (not gaps or shifted >= fill):
            return shifted
        plain = held.get(rank)
        return plain if plain is not None and plain < fill else fill

    low, high = (value(r) for r in ranks)
    return low + (high - low) * share


def fit_cleaning(df: DataFrame, numeric: list[str], text: list[str], money: list[str] = MONEY,
                 p: float = 0.99) -> CleaningRules:
    """Learn fills and caps; the caps hold for the filled, non-negative amounts.

    Four passes: sketches of all columns side by side, gap counts, most frequent values of the text
    columns with gaps, and exact ranks of all medians and caps at once. What filling does to
    the rank of a cap is known from the gap counts, so nothing is filled to learn it.
    """
    signed = {c: F.col(c).cast("double") for c in numeric}
    plain = {c: F.col(c).cast("double") for c in money}
    paid = {c: F.abs(v) if c == "sales" else v for c, v in plain.items()}
    sketches = sketched(
        df, {**{("fill", c): v for c, v in signed.items()}, **{("cap", c): v for c, v in paid.items()}})
    row = df.agg(
        F.count("*").alias("rows"), *[F.count(c).alias(f"has_{i}") for i, c in enumerate(text)]).first()
    rows = row["rows"]
    broken = [c for c in numeric if 0 < sketches["fill", c].n < rows]
    words = [c for i, c in enumerate(text) if row[f"has_{i}"] < rows]
    wanted, medians, caps = {}, {}, {}
    for c in broken:
        medians[c] = position(sketches["fill", c].n, 0.5)
        wanted["fill", c] = (signed[c], sketches["fill", c], medians[c][0])
    for c in paid:
        known = sketches["cap", c]
        if not known.n:
            continue
        # An empty share of a column that is no numeric one of the table stays unfilled.
        gaps = rows - known.n if c in broken else 0
        caps[c] = (*position(known.n + gaps, p), gaps)
        for name, shift in (("cap", gaps), ("plain", 0)):
            ranks = [r - shift for r in caps[c][0] if 0 <= r - shift < known.n]
            if ranks and (name == "cap" or gaps):
                wanted[name, c] = (paid[c], known, ranks)
    found = at_ranks(df, wanted)
    fills: dict[str, float | str] = {}
    for c, (ranks, share) in medians.items():
        low, high = (found["fill", c][r] for r in ranks)
        fills[c] = low + (high - low) * share
    fills |= {c: v for c, v in (modes(df, words) if words else {}).items() if v is not None}
    limits = {}
    for c, (ranks, share, gaps) in caps.items():
        fill = abs(fills[c]) if c == "sales" and gaps else fills.get(c)
        held = found.get(("plain", c), {}) | found.get(("cap", c), {})
        limits[c] = _capped_at(held, ranks, share, gaps, fill)
    return CleaningRules(numeric, fills, limits)


def apply_cleaning(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Fill, make sales positive and cap; a pure projection."""
    return cap(_filled(df, rules.numeric, rules.fills), rules.caps)
