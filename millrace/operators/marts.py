"""The eight recurring business questions over orders, customers and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numeric import mean, money, percent, rounded
from millrace.functions.stats import rank_among, top_per_key
from millrace.session import staged


def _late_pct() -> Column:
    return percent(F.sum("late_delivery_risk"), F.count("*"))


def executive_summary(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Volume, revenue, profit, days and lateness per market and region.

    The dimensions only have to contain the key, so semi joins keep the fact narrow.
    """
    return (
        orders.join(customers.select("customer_id"), "customer_id", "left_semi")
        .join(products.select("product_id"), "product_id", "left_semi")
        .groupBy("market", "order_region")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.count("order_item_id").alias("total_items"),
            money(F.sum("sales")).alias("total_revenue"),
            rounded(mean(F.col("benefit_per_order")), 2).alias("avg_profit_per_order"),
            rounded(mean(F.col("days_for_shipping_real")), 1).alias("avg_actual_days"),
            rounded(mean(F.col("days_for_shipment_scheduled")), 1).alias("avg_scheduled_days"),
            _late_pct().alias("late_delivery_pct"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .orderBy(F.desc("total_revenue"), "market", "order_region")
    )


def shipping_mode_performance(orders: DataFrame) -> DataFrame:
    delay = F.col("days_for_shipping_real") - F.col("days_for_shipment_scheduled")
    return (
        orders.groupBy("shipping_mode")
        .agg(
            F.count("*").alias("total_shipments"),
            rounded(mean(F.col("days_for_shipping_real")), 2).alias("avg_actual_days"),
            rounded(mean(F.col("days_for_shipment_scheduled")), 2).alias("avg_scheduled_days"),
            rounded(mean(delay), 2).alias("avg_delay_days"),
            F.sum("late_delivery_risk").alias("late_count"),
            _late_pct().alias("late_pct"),
            money(F.sum("sales")).alias("total_revenue"),
        )
        .orderBy(F.desc("late_pct"), "shipping_mode")
    )


def segment_analysis(orders: DataFrame, customers: DataFrame, limit: int = 20) -> DataFrame:
    who = customers.select("customer_id", "customer_segment", "customer_country")
    return (
        orders.join(who, "customer_id")
        .groupBy("customer_segment", "customer_country")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            money(F.sum("sales")).alias("total_revenue"),
            rounded(mean(F.col("sales_per_customer")), 2).alias("avg_sales_per_customer"),
            _late_pct().alias("late_pct"),
            money(F.sum("benefit_per_order")).alias("total_profit"),
        )
        .orderBy(F.desc("total_revenue"), "customer_segment", "customer_country")
        .limit(limit)
    )


def top_categories(orders: DataFrame, products: DataFrame, limit: int = 15) -> DataFrame:
    """Best selling categories. Sums per product come first, so the join sees one row per product."""
    per_product = orders.groupBy("product_id").agg(
        F.count("order_item_id").alias("items"),
        F.count("*").alias("n"),
        F.sum("sales").alias("sales"),
        F.sum(F.col("order_item_profit_ratio").cast("decimal(18,8)")).alias("ratio"),
        F.count("order_item_profit_ratio").alias("ratios"),
        F.sum("late_delivery_risk").alias("late"),
    )
    what = products.select("product_id", "department_name", "category_name")
    return (
        per_product.join(what, "product_id")
        .groupBy("department_name", "category_name")
        .agg(
            F.sum("items").alias("items_sold"),
            money(F.sum("sales")).alias("total_revenue"),
            rounded(F.try_divide(F.sum("ratio").cast("double"), F.sum("ratios")), 3)
            .alias("avg_profit_ratio"),
            percent(F.sum("late"), F.sum("n")).alias("late_delivery_pct"),
        )
        .orderBy(F.desc("total_revenue"), "department_name", "category_name")
        .limit(limit)
    )


def running_revenue(orders: DataFrame) -> DataFrame:
    """Monthly revenue per region with its running total and its rank within the month."""
    monthly = orders.groupBy(
        F.date_format("order_date", "yyyy-MM").alias("order_month"), "order_region"
    ).agg(F.round(F.sum("sales"), 2).alias("revenue"))
    so_far = (
        Window.partitionBy("order_region").orderBy("order_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_month = Window.partitionBy("order_month").orderBy(F.desc("revenue"))
    return monthly.select(
        "order_month", "order_region",
        F.col("revenue").cast("double").alias("monthly_revenue"),
        money(F.sum("revenue").over(so_far)).alias("cumulative_revenue"),
        F.rank().over(in_month).cast("bigint").alias("revenue_rank_in_month"),
    ).orderBy("order_month", "revenue_rank_in_month", "order_region")


def route_ranking(orders: DataFrame, min_shipments: int = 50, limit: int = 20) -> DataFrame:
    """Worst routes by late share, with their ranks among all routes of enough shipments.

    The aggregated routes are staged once; the top rows and both ranks are read from there.
    """
    route = ["order_region", "order_country", "shipping_mode"]
    routes = (
        orders.groupBy(*route)
        .agg(
            F.count("*").alias("total_shipments"),
            F.sum("late_delivery_risk").alias("late_shipments"),
            _late_pct().alias("late_pct"),
            F.round(F.sum("sales"), 2).alias("total_revenue"),
        )
        .where(F.col("total_shipments") > min_shipments)
    )
    routes = staged(routes, "routes")
    worst = routes.orderBy(F.desc("late_pct"), *route).limit(limit)
    ranked = rank_among(worst, routes, "late_pct", "worst_route_rank")
    ranked = rank_among(ranked, routes, "total_revenue", "revenue_rank")
    return ranked.select(
        *route, "total_shipments", "late_shipments", "late_pct", "worst_route_rank", "revenue_rank"
    ).orderBy("worst_route_rank", *route)


def customer_value(orders: DataFrame, customers: DataFrame, limit: int = 25) -> DataFrame:
    """Top customers by spend and the percentile of their spend among all customers.

    Orders are summed per customer before the join, so a customer holding much of the fact joins
    as one row; the result, one row per customer, is staged for the top rows and their ranks.
    """
    spend = orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.round(F.sum("sales"), 2).alias("total_spend"),
    )
    who = customers.select(
        "customer_id", "customer_fname", "customer_lname", "customer_country", "customer_segment"
    )
    value = staged(spend.join(who, "customer_id"), "customer_value")
    top = value.orderBy(F.desc("total_spend"), "customer_id").limit(limit)
    ranked = rank_among(top, value, "total_spend", "rank_up", descending=False)
    everyone = value.count()
    by_spend = Window.orderBy(F.desc("total_spend"), "customer_id")
    return ranked.select(
        F.concat("customer_fname", F.lit(" "), "customer_lname").alias("customer_name"),
        "customer_country", "customer_segment", "total_orders",
        F.col("total_spend").cast("double").alias("total_spend"),
        F.row_number().over(by_spend).cast("bigint").alias("clv_rank"),
        percent(F.col("rank_up"), F.lit(everyone)).alias("spend_percentile"),
    ).orderBy("clv_rank")


def region_late_rates(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_region").agg(_late_pct().alias("region_late_rate"))


def risk_radar(orders: DataFrame, products: DataFrame, threshold: float = 55,
               limit: int = 100) -> DataFrame:
    """Late items of regions whose rounded late percentage exceeds the threshold.

    The result ranks by region rate first, so it lies within the top items of each region; those
    are picked before the rates are joined, and no task ever holds a region.
    """
    late = (
        orders.where(F.col("late_delivery_risk") == 1)
        .join(products.select("product_id", "category_name"), "product_id")
        .select(
            "order_id", "order_item_id", "order_date", "order_region", "shipping_mode",
            "category_name", "sales", "days_for_shipment_scheduled", "delivery_status",
            "late_delivery_risk",
        )
    )
    largest = [F.desc("sales"), F.asc("order_item_id")]
    leading = top_per_key(late, ["order_region"], largest, limit, "order_item_id", "place")
    risky = region_late_rates(orders).where(F.col("region_late_rate") > threshold)
    return (
        leading.join(risky, "order_region")
        .orderBy(F.desc("region_late_rate"), F.desc("sales"), "order_item_id")
        .limit(limit)
        .select(
            "order_id", "order_date", "order_region", "shipping_mode", "category_name", "sales",
            "days_for_shipment_scheduled", "delivery_status", "late_delivery_risk",
            "region_late_rate",
        )
    )
