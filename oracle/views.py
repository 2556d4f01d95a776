"""Common table expressions that define the input views, and rounding helpers."""

from __future__ import annotations

import re

from millrace.sources import fixtures


def half_up(value: str, places: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,8)), {places}) AS DOUBLE)"


def money(value: str, places: int = 2) -> str:
    return f"CAST(ROUND({value}, {places}) AS DOUBLE)"


def mean(value: str) -> str:
    return f"(CAST(SUM({value}) AS DOUBLE) / COUNT({value}))"


def pct(part: str, whole: str, places: int = 1) -> str:
    return half_up(f"1e2 * CAST({part} AS DOUBLE) / {whole}", places)


CHANNELS = ["temperature", "vibration", "pressure", "rpm", "current_amps"]
RISK_COLUMNS = {
    "market": "market_risk_score", "order_region": "region_risk_score",
    "shipping_mode": "mode_risk_score",
}

MODE_RISK = """CASE shipping_mode WHEN 'Standard Class' THEN 63e-2
  WHEN 'Second Class' THEN 56e-2 WHEN 'First Class' THEN 48e-2 WHEN 'Same Day' THEN 35e-2
  ELSE 55e-2 END AS mode_risk_score"""

_NAMES = {t: t for t in (*fixtures.WAREHOUSE, "sc_orders")}

BODY = {
    "sc_customers": fixtures.CUSTOMERS.format(**_NAMES),
    "sc_products": fixtures.PRODUCTS.format(**_NAMES),
    "sc_orders": fixtures.ORDERS.format(**_NAMES),
    "sc_orders_dirty": fixtures.ORDERS_DIRTY.format(**_NAMES),
    "sc_orders_gaps": fixtures.ORDERS_WITH_GAPS.format(**_NAMES),
    "sc_scored": fixtures.SCORED.format(**_NAMES),
    "sc_sensor": fixtures.SENSOR.replace("{k}", fixtures.SENSOR_KEY["duckdb"]).format(**_NAMES),
    # order items as extracted: joined, not canceled
    "sc_extracted": """
SELECT order_id, order_item_id, order_date, shipping_date, shipping_mode, order_status,
  delivery_status, late_delivery_risk, days_for_shipping_real, days_for_shipment_scheduled,
  order_item_quantity, order_item_discount_rate, order_item_product_price,
  order_item_profit_ratio, sales, benefit_per_order, sales_per_customer, order_region,
  order_country, market, type AS payment_type, customer_segment, customer_country, latitude,
  longitude, category_name, department_name, product_price
FROM sc_orders_gaps o JOIN sc_customers c ON o.customer_id = c.customer_id
JOIN sc_products p ON o.product_id = p.product_id
WHERE order_status <> 'CANCELED'""",
    # features of orders without an outcome
    "sc_incoming": f"""
SELECT order_item_id, shipping_mode, order_region, market, category_name, department_name,
  customer_segment, payment_type, days_for_shipment_scheduled, order_item_quantity,
  order_item_discount_rate, order_item_product_price, sales,
  {half_up("CAST(sales AS DOUBLE) / greatest(order_item_quantity, 1)", 2)} AS revenue_per_unit,
  CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend_order,
  CASE WHEN order_item_discount_rate > 0 THEN 1 ELSE 0 END AS has_discount,
  CAST(hour(order_date) AS INTEGER) AS order_hour, CAST(month(order_date) AS INTEGER) AS order_month,
  55e-2 AS market_risk_score, 55e-2 AS region_risk_score, {MODE_RISK}
FROM sc_extracted""",
    "sc_items": """
SELECT * FROM sc_extracted QUALIFY ROW_NUMBER() OVER (PARTITION BY order_item_id
  ORDER BY order_date, order_id, order_item_quantity, sales_per_customer, benefit_per_order) = 1""",
    # filled and made positive
    "sc_filled": """
SELECT * REPLACE (
  abs(coalesce(CAST(sales AS DOUBLE),
    (SELECT median(CAST(sales AS DOUBLE)) FROM sc_items))) AS sales,
  CAST(benefit_per_order AS DOUBLE) AS benefit_per_order,
  CAST(sales_per_customer AS DOUBLE) AS sales_per_customer,
  coalesce(payment_type, (SELECT payment_type FROM sc_items WHERE payment_type IS NOT NULL
    GROUP BY payment_type ORDER BY COUNT(*) DESC, payment_type LIMIT 1)) AS payment_type)
FROM sc_items""",
    "sc_capped": """
SELECT * REPLACE (
  least(sales, (SELECT quantile_cont(sales, 0.99) FROM sc_filled)) AS sales,
  least(benefit_per_order, (SELECT quantile_cont(benefit_per_order, 0.99) FROM sc_filled))
    AS benefit_per_order,
  least(sales_per_customer, (SELECT quantile_cont(sales_per_customer, 0.99) FROM sc_filled))
    AS sales_per_customer)
FROM sc_filled""",
    "sc_clean": f"""
SELECT order_id, order_item_id, order_date, shipping_date, shipping_mode, order_status,
  delivery_status, CAST(late_delivery_risk AS DOUBLE) AS late_delivery_risk,
  CAST(days_for_shipping_real AS DOUBLE) AS days_for_shipping_real,
  CAST(days_for_shipment_scheduled AS DOUBLE) AS days_for_shipment_scheduled,
  CAST(order_item_quantity AS DOUBLE) AS order_item_quantity,
  order_item_discount_rate, order_item_product_price, order_item_profit_ratio,
  {half_up("sales", 6)} AS sales, {half_up("benefit_per_order", 6)} AS benefit_per_order,
  {half_up("sales_per_customer", 6)} AS sales_per_customer, order_region, order_country, market,
  payment_type, customer_segment, customer_country, latitude, longitude, category_name,
  department_name, product_price,
  CAST(days_for_shipping_real - days_for_shipment_scheduled AS DOUBLE) AS shipping_delay_days,
  CAST(hour(order_date) AS INTEGER) AS order_hour,
  CAST(isodow(order_date) - 1 AS INTEGER) AS order_day_of_week,
  CAST(month(order_date) AS INTEGER) AS order_month,
  CAST(year(order_date) AS INTEGER) AS order_year,
  CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend_order,
  {half_up("sales / greatest(order_item_quantity, 1)", 2)} AS revenue_per_unit,
  CASE WHEN order_item_discount_rate > 0 THEN 1 ELSE 0 END AS has_discount,
  CASE WHEN benefit_per_order > 0 THEN 1 ELSE 0 END AS is_profitable,
  CASE WHEN days_for_shipment_scheduled <= -1 THEN NULL
    WHEN days_for_shipment_scheduled <= 1 THEN 'same_day'
    WHEN days_for_shipment_scheduled <= 3 THEN '1-3_days'
    WHEN days_for_shipment_scheduled <= 5 THEN '3-5_days'
    WHEN days_for_shipment_scheduled <= 10 THEN '5-10_days'
    WHEN days_for_shipment_scheduled <= 100 THEN '10+_days' END AS scheduled_days_bin,
  """ + ",\n  ".join(
        f"(SUM(late_delivery_risk) OVER (PARTITION BY {k})) / "
        f"CAST(COUNT(*) OVER (PARTITION BY {k}) AS DOUBLE) AS {out}"
        for k, out in RISK_COLUMNS.items()
    ) + "\nFROM sc_capped",
    # newest reading against the machine's own mean and spread
    "sc_health_raw": """
SELECT machine_id, least(greatest((""" + " + ".join(
        f"abs(({c} - m_{c}) / coalesce(nullif(s_{c}, 0), 1))" for c in CHANNELS
    ) + """) / 5 / 4, 0), 1) AS p, """ + ", ".join(CHANNELS) + """
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY machine_id ORDER BY reading_ts DESC, event_id DESC) AS rn
  FROM sc_sensor) JOIN (SELECT machine_id, """ + ", ".join(
        f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in CHANNELS
    ) + """ FROM sc_sensor GROUP BY machine_id) USING (machine_id) WHERE rn = 1""",
    "sc_health": f"""
SELECT printf('M-%03d', machine_id) AS machine_id, {half_up("p", 4)} AS failure_probability,
  {half_up("(1 - p) * 100", 1)} AS health_score,
  CAST(greatest(1, floor((1 - p) * 72)) AS INTEGER) AS rul_hours,
  CASE WHEN p < 0.25 THEN 'LOW' WHEN p < 0.5 THEN 'MEDIUM' WHEN p < 0.75 THEN 'HIGH'
    ELSE 'CRITICAL' END AS severity,
  {half_up("temperature", 1)} AS last_temperature, {half_up("vibration", 4)} AS last_vibration,
  {half_up("pressure", 1)} AS last_pressure, {half_up("rpm", 1)} AS last_rpm,
  {half_up("current_amps", 3)} AS last_current
FROM sc_health_raw""",
    "sc_labelled": """
SELECT *, CASE WHEN EXISTS (SELECT 1 FROM sc_sensor f WHERE f.is_failure = 1
    AND f.machine_id = r.machine_id AND f.reading_ts >= r.reading_ts
    AND f.reading_ts <= r.reading_ts + INTERVAL '24' HOUR) THEN 1 ELSE 0 END AS failure_in_24h
FROM sc_sensor r""",
}


def _mentioned(text: str) -> list[str]:
    return [n for n in BODY if re.search(rf"\b{n}\b", text)]


def with_views(statement: str) -> str:
    """Prefix a statement with all views it mentions, directly or through other views."""
    wanted: set[str] = set()
    open_names = _mentioned(statement)
    while open_names:
        name = open_names.pop()
        if name not in wanted:
            wanted.add(name)
            open_names += _mentioned(BODY[name])
    ordered = [n for n in BODY if n in wanted]
    if not ordered:
        return statement.strip()
    views = ",\n".join(f"{n} AS ({BODY[n]})" for n in ordered)
    own = statement.strip()
    if own.startswith("WITH "):  # a statement may have further expressions of its own
        return f"WITH {views},\n{own.removeprefix('WITH ')}"
    return f"WITH {views}\n{own}"
