"""Features of order items and the two narrow views made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.lookup import mapped, small_or_same
from millrace.functions.numeric import flag, mean, rounded

# The model's columns and those of the dashboard export, in their order.
TARGET = "late_delivery_risk"
CATEGORICAL = [
    "shipping_mode", "order_region", "market", "category_name", "department_name",
    "customer_segment", "payment_type",
]
NUMERIC = [
    "days_for_shipment_scheduled", "order_item_quantity", "order_item_discount_rate",
    "order_item_product_price", "sales", "revenue_per_unit", "is_weekend_order", "has_discount",
    "order_hour", "order_month", "market_risk_score", "region_risk_score", "mode_risk_score",
]
FEATURES = CATEGORICAL + NUMERIC
DASHBOARD_EXTRA = [
    "order_id", "order_date", "shipping_date", "order_country", "delivery_status",
    "benefit_per_order", "order_item_profit_ratio", "shipping_delay_days",
    "days_for_shipping_real", "order_year", "order_day_of_week", "is_profitable", "latitude",
    "longitude",
]
RISK_KEYS = {
    "market": "market_risk_score",
    "order_region": "region_risk_score",
    "shipping_mode": "mode_risk_score",
}

# Risk rates assumed for incoming orders, and the rate of anything unlisted.
MARKET_RISK = {"Africa": 0.72, "LATAM": 0.64, "Pacific Asia": 0.59, "Europe": 0.52, "USCA": 0.48}
MODE_RISK = {
    "Standard Class": 0.63, "Second Class": 0.56, "First Class": 0.48, "Same Day": 0.35,
}
REGION_RISK = {
    "West Africa": 0.74, "East Africa": 0.72, "North Africa": 0.70, "South Africa": 0.69,
    "South America": 0.65, "Caribbean": 0.63, "Central America": 0.62, "Southeast Asia": 0.60,
    "East Asia": 0.58, "South Asia": 0.57, "Oceania": 0.55, "Southern Europe": 0.54,
    "Central Europe": 0.52, "Western Europe": 0.51, "Northern Europe": 0.50, "Central US": 0.50,
    "Canada": 0.48, "East US": 0.47, "West US": 0.46,
}
UNLISTED_RISK = 0.55


def delay_days(df: DataFrame) -> DataFrame:
    days = F.col("days_for_shipping_real") - F.col("days_for_shipment_scheduled")
    return df.withColumn("shipping_delay_days", days)


def calendar(df: DataFrame, ts: str = "order_date") -> DataFrame:
    """Hour, weekday (0 = Monday), month and year."""
    return df.withColumns({
        "order_hour": F.hour(ts), "order_day_of_week": F.weekday(ts),
        "order_month": F.month(ts), "order_year": F.year(ts),
    })


def weekend(df: DataFrame, ts: str = "order_date") -> DataFrame:
    return df.withColumn("is_weekend_order", flag(F.weekday(ts) >= 5))


def unit_revenue(sales: Column, quantity: Column) -> Column:
    units = F.when(quantity.isNotNull(), F.greatest(quantity, F.lit(1)))
    return rounded(sales.cast("double") / units, 2)


def revenue_per_unit(df: DataFrame) -> DataFrame:
    value = unit_revenue(F.col("sales"), F.col("order_item_quantity"))
    return df.withColumn("revenue_per_unit", value)


def has_discount(df: DataFrame) -> DataFrame:
    return df.withColumn("has_discount", flag(F.col("order_item_discount_rate") > 0))


def is_profitable(df: DataFrame) -> DataFrame:
    return df.withColumn("is_profitable", flag(F.col("benefit_per_order") > 0))


def scheduled_bin(df: DataFrame) -> DataFrame:
    """Right-closed day ranges; anything outside them is null."""
    d = F.col("days_for_shipment_scheduled")
    label = (
        F.when((d > -1) & (d <= 1), "same_day").when((d > 1) & (d <= 3), "1-3_days")
        .when((d > 3) & (d <= 5), "3-5_days").when((d > 5) & (d <= 10), "5-10_days")
        .when((d > 10) & (d <= 100), "10+_days")
    )
    return df.withColumn("scheduled_days_bin", label)


def target_means(df: DataFrame, keys: dict[str, str], target: str = TARGET,
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Mean target per value of each key column (key to output name), joined back to the rows.

    All means come from one pass. A missing key gets no score. With ``fit_on`` the means come
    from other rows, and an unseen value gets their overall mean.
    """
    entries = [F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in keys]
    rates = (
        (df if fit_on is None else fit_on).select(target, F.inline(F.array(*entries)))
        .where("value is not null").groupBy("name", "value").agg(mean(F.col(target)).alias("rate"))
    )
    rates = small_or_same(rates)
    overall = None if fit_on is None else fit_on.agg(mean(F.col(target))).first()[0]
    for key, out in keys.items():
        lookup = rates.where(F.col("name") == key).select(F.col("value").alias(key), F.col("rate").alias(out))
        df = df.join(lookup, key, "left")
        if fit_on is not None:
            df = df.withColumn(out, F.coalesce(F.col(out), F.lit(overall)))
    return df


def target_mean(df: DataFrame, key: str, out: str, target: str = TARGET,
                fit_on: DataFrame | None = None) -> DataFrame:
    return target_means(df, {key: out}, target, fit_on)


def derive(df: DataFrame) -> DataFrame:
    """All features that depend on the row alone."""
    for step in (delay_days, calendar, weekend, revenue_per_unit, has_discount, is_profitable,
                 scheduled_bin):
        df = step(df)
    return df


def risk_scores(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Historical late rates by market, region and shipping mode."""
    return target_means(df, RISK_KEYS, fit_on=fit_on)


def lookup_risk(df: DataFrame) -> DataFrame:
    """Assumed late rates for orders without history."""
    return df.withColumns({
        "market_risk_score": mapped(F.col("market"), MARKET_RISK, UNLISTED_RISK),
        "region_risk_score": mapped(F.col("order_region"), REGION_RISK, UNLISTED_RISK),
        "mode_risk_score": mapped(F.col("shipping_mode"), MODE_RISK, UNLISTED_RISK),
    })


def incoming_orders(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 20 model features for new orders that have no outcome yet."""
    ready = lookup_risk(has_discount(revenue_per_unit(weekend(calendar(df)))))
    return ready.select(*(keep or []), *FEATURES)


def ml_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Features and target, complete rows only; ``keep`` adds identifying columns."""
    return df.select(*(keep or []), *FEATURES, TARGET).dropna(how="any", subset=[*FEATURES, TARGET])


def dashboard_view(df: DataFrame) -> DataFrame:
    """Features with identifiers, dates and places, for rows that have an order date."""
    wanted = [c for c in FEATURES + DASHBOARD_EXTRA if c in df.columns]
    return df.select(*wanted).dropna(subset=["order_date"])
