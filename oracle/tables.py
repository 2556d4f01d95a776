from __future__ import annotations

from oracle.views import CHANNELS, MODE_RISK, RISK_COLUMNS, half_up, mean, money, pct, with_views

ORDER_COLUMNS = """order_id, order_item_id, customer_id, product_id, order_date, shipping_date,
  shipping_mode, order_status, delivery_status, late_delivery_risk, days_for_shipping_real,
  days_for_shipment_scheduled, order_item_quantity, order_item_discount_rate,
  order_item_product_price, order_item_profit_ratio, sales, benefit_per_order, sales_per_customer,
  order_region, order_country, market, type"""
FEATURES = """shipping_mode, order_region, market, category_name, department_name,
  customer_segment, payment_type, days_for_shipment_scheduled, order_item_quantity,
  order_item_discount_rate, order_item_product_price, sales, revenue_per_unit, is_weekend_order,
  has_discount, order_hour, order_month, market_risk_score, region_risk_score, mode_risk_score"""
DASHBOARD = FEATURES + """, order_id, order_date, shipping_date, order_country, delivery_status,
  benefit_per_order, order_item_profit_ratio, shipping_delay_days, days_for_shipping_real,
  order_year, order_day_of_week, is_profitable, latitude, longitude"""
COUNTS = """
SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM sc_customers
UNION ALL SELECT 'products', COUNT(*) FROM sc_products
UNION ALL SELECT 'orders', COUNT(*) FROM sc_orders"""
MODE_OF_TYPE = """(SELECT payment_type FROM sc_orders_dirty WHERE payment_type IS NOT NULL
  GROUP BY payment_type ORDER BY COUNT(*) DESC, payment_type LIMIT 1)"""


MART_COLUMNS = {
    "customers": ["customer_id", "customer_fname", "customer_lname", "customer_segment",
                  "customer_country", "latitude", "longitude"],
    "products": ["product_id", "product_name", "category_name", "department_name", "product_price"],
    "orders": [c.strip() for c in ORDER_COLUMNS.split(",")],
}
# Rates assumed for orders without history, in their order.
MARKET_RATES = {"Africa": 0.72, "LATAM": 0.64, "Pacific Asia": 0.59, "Europe": 0.52, "USCA": 0.48}
REGION_RATES = {
    "West Africa": 0.74, "East Africa": 0.72, "North Africa": 0.70, "South Africa": 0.69,
    "South America": 0.65, "Caribbean": 0.63, "Central America": 0.62, "Southeast Asia": 0.60,
    "East Asia": 0.58, "South Asia": 0.57, "Oceania": 0.55, "Southern Europe": 0.54,
    "Central Europe": 0.52, "Western Europe": 0.51, "Northern Europe": 0.50, "Central US": 0.50,
    "Canada": 0.48, "East US": 0.47, "West US": 0.46,
}


def _cells(columns: list[str]) -> str:
    return ", ".join(f"coalesce(CAST({c} AS VARCHAR), '?')" for c in sorted(columns))


def _listed(column: str, rates: dict[str, float]) -> str:
    """A name by its place: the number in the column's text, else the text's length."""
    names = ", ".join(f"'{n}'" for n in rates)
    place = f"coalesce(TRY_CAST(nullif(regexp_extract({column}, '[0-9]+'), '') AS INT), length({column}))"
    return f"([{names}])[CAST({place} % {len(rates) + 1} AS INT) + 1]"


def _rate(column: str, rates: dict[str, float]) -> str:
    cases = " ".join(f"WHEN '{n}' THEN {r}::DOUBLE" for n, r in rates.items())
    return f"CASE {column} {cases} ELSE 55e-2 END"


def sources() -> dict[str, str]:
    return {
        "src_orders_mart": f"SELECT {ORDER_COLUMNS} FROM sc_orders",
        "src_extract": "SELECT * FROM sc_extracted",
        "src_features_csv": f"SELECT {FEATURES}, late_delivery_risk FROM sc_clean",
        "src_sensor_csv": "SELECT machine_id, reading_ts, temperature, vibration, pressure, rpm, "
                          "current_amps, failure_in_24h FROM sc_labelled",
        "sink_tables": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(SUM(CAST('0x' || substr(md5("
            f"concat_ws('|', {_cells(columns)})), 1, 8) AS BIGINT)) AS BIGINT) AS content FROM sc_{name}"
            for name, columns in MART_COLUMNS.items()),
        "sink_flat": f"""
SELECT {ORDER_COLUMNS.replace("customer_id", "o.customer_id").replace("product_id", "o.product_id")},
  customer_fname, customer_lname, customer_segment, customer_country, latitude, longitude,
  product_name, category_name, department_name, product_price
FROM sc_orders o LEFT JOIN sc_customers c ON c.customer_id = o.customer_id
LEFT JOIN sc_products p ON p.product_id = o.product_id""",
        "sink_clean": "SELECT * FROM sc_clean",
        "sink_ml": f"SELECT {FEATURES}, late_delivery_risk FROM sc_clean",
        "sink_dash": f"SELECT {DASHBOARD} FROM sc_clean",
        "sink_health": "SELECT * FROM sc_health",
    }


def quality() -> dict[str, str]:
    return {
        "dq_row_counts": COUNTS,
        "dq_null_audit": """
SELECT COUNT(*) FILTER (customer_id IS NULL) AS null_customer_id,
  COUNT(*) FILTER (order_date IS NULL) AS null_order_date,
  COUNT(*) FILTER (delivery_status IS NULL) AS null_delivery_status,
  COUNT(*) FILTER (late_delivery_risk IS NULL) AS null_late_risk,
  COUNT(*) FILTER (sales IS NULL) AS null_sales FROM sc_orders_gaps""",
        "dq_orphan_customers": """
SELECT COUNT(*) AS orphan_orders FROM sc_orders o WHERE NOT EXISTS
  (SELECT 1 FROM sc_customers c WHERE c.customer_id = o.customer_id)""",
        "dq_orphan_products": """
SELECT COUNT(*) AS orphan_order_items FROM sc_orders o WHERE NOT EXISTS
  (SELECT 1 FROM sc_products p WHERE p.product_id = o.product_id)""",
        "dq_sample": """
SELECT order_id, customer_fname || ' ' || customer_lname AS customer_name, customer_country,
  product_name, category_name, shipping_mode, delivery_status, sales
FROM sc_orders o JOIN sc_customers c ON o.customer_id = c.customer_id
JOIN sc_products p ON o.product_id = p.product_id ORDER BY order_item_id LIMIT 10""",
        "dq_status_dist": f"""
SELECT delivery_status, COUNT(*) AS cnt,
  {pct("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS pct FROM sc_orders GROUP BY delivery_status""",
        "dq_class_dist": f"""
SELECT late_delivery_risk,
  {half_up("CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER ()", 3)} AS share
FROM sc_orders WHERE order_status <> 'CANCELED' GROUP BY late_delivery_risk""",
        "dq_missing_total": """
SELECT CAST(SUM((CASE WHEN sales IS NULL THEN 1 ELSE 0 END)
  + (CASE WHEN payment_type IS NULL THEN 1 ELSE 0 END)
  + (CASE WHEN TRY_CAST(order_date_text AS TIMESTAMP) IS NULL THEN 1 ELSE 0 END)) AS BIGINT)
  AS missing FROM sc_orders_dirty""",
        "dq_cleaning_report": """
SELECT (SELECT COUNT(*) FROM sc_extracted) + (SELECT COUNT(*) FROM sc_extracted WHERE order_id % 7 = 0)
    AS items, (SELECT COUNT(*) FROM sc_items) AS items_kept,
  (SELECT COUNT(*) FILTER (sales IS NULL) + COUNT(*) FILTER (payment_type IS NULL) FROM sc_items)
    AS missing_before, 0::BIGINT AS missing_after,
  (SELECT COUNT(*) FROM sc_extracted) + (SELECT COUNT(*) FROM sc_extracted WHERE order_id % 7 = 0)
    - (SELECT COUNT(*) FROM sc_items) AS duplicates_removed""",
        "dq_summary": f"""
SELECT COUNT(*) AS records, {half_up(mean("late_delivery_risk"), 6)} AS late_rate,
  {money("SUM(CAST(sales AS DECIMAL(22,6)))")} AS total_revenue,
  {half_up(mean("shipping_delay_days"), 2)} AS avg_delay_days,
  strftime(MIN(order_date), '%Y-%m-%d') AS first_date,
  strftime(MAX(order_date), '%Y-%m-%d') AS last_date, COUNT(DISTINCT market) AS markets,
  COUNT(DISTINCT order_region) AS regions, COUNT(DISTINCT category_name) AS categories
FROM sc_clean""",
    }


def cleaning() -> dict[str, str]:
    medians = ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM sc_orders_dirty)) AS {c}"
        for c in ("order_id", "customer_id", "product_id", "sales", "benefit_per_order",
                  "sales_per_customer", "late_delivery_risk")
    )
    caps = ", ".join(
        half_up(f"least(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.99) "
                f"FROM sc_orders))", 6) + f" AS {c}"
        for c in ("sales", "benefit_per_order", "sales_per_customer")
    )
    ranges = {
        "temperature": (30, 120), "vibration": (0.1, 5), "pressure": (50, 200),
        "rpm": (500, 2000), "current_amps": (2, 25),
    }
    clipped = ", ".join(
        f"least(greatest({c}, {lo}), {hi}) AS {c}" for c, (lo, hi) in ranges.items()
    )
    return {
        "clean_dedup": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""",
        "clean_parse_dates": """
SELECT order_item_id, TRY_CAST(order_date_text AS TIMESTAMP) AS order_date_text
FROM sc_orders_dirty""",
        "clean_fill_median": f"SELECT order_item_id, {medians} FROM sc_orders_dirty",
        "clean_fill_mode": f"""
SELECT order_item_id, coalesce(payment_type, {MODE_OF_TYPE}) AS payment_type, order_status, market
FROM sc_orders_dirty""",
        "clean_abs_sales": "SELECT order_item_id, abs(sales) AS sales FROM sc_orders_dirty",
        "clean_negative_count":
            "SELECT COUNT(*) FILTER (sales < 0) AS negative FROM sc_orders_dirty",
        "clean_clip_p99": f"SELECT order_item_id, {caps} FROM sc_orders",
        "filter_not_canceled":
            "SELECT order_item_id, order_status FROM sc_orders WHERE order_status <> 'CANCELED'",
        "filter_late":
            "SELECT order_item_id, late_delivery_risk FROM sc_orders WHERE late_delivery_risk = 1",
        "sensor_clip": f"SELECT machine_id, event_id, {clipped} FROM sc_sensor",
        "delivery_status": """
SELECT order_item_id, CASE WHEN order_status = 'CANCELED' THEN 'Shipping canceled'
  WHEN late_delivery_risk = 1 THEN 'Late delivery'
  WHEN days_for_shipping_real < days_for_shipment_scheduled THEN 'Advance shipping'
  ELSE 'Shipping on time' END AS delivery_status FROM sc_orders""",
        "prior_late_prob": f"""
SELECT order_item_id, {half_up('''least(greatest(CASE market WHEN 'AFRICA' THEN 72e-2
  WHEN 'AMERICA' THEN 64e-2 WHEN 'ASIA' THEN 59e-2 WHEN 'EUROPE' THEN 52e-2 ELSE 55e-2 END
  + CASE shipping_mode WHEN 'Standard Class' THEN 15e-2 WHEN 'Second Class' THEN 8e-2
    WHEN 'First Class' THEN -5e-2 WHEN 'Same Day' THEN -15e-2 ELSE 0 END, 0.1), 0.95)''', 6)}
  AS prior_probability FROM sc_orders""",
    }


def features() -> dict[str, str]:
    risk = {
        f"fe_{short}_risk": f"""
SELECT order_item_id, {key}, SUM(late_delivery_risk) OVER (PARTITION BY {key})
  / CAST(COUNT(*) OVER (PARTITION BY {key}) AS DOUBLE) AS {RISK_COLUMNS[key]}
FROM sc_orders WHERE order_status <> 'CANCELED'"""
        for short, key in (("market", "market"), ("region", "order_region"), ("mode", "shipping_mode"))
    }
    mode_risk = MODE_RISK
    return {
        "fe_delay_days": """
SELECT order_item_id, days_for_shipping_real - days_for_shipment_scheduled AS shipping_delay_days
FROM sc_orders""",
        "fe_calendar": """
SELECT order_item_id, CAST(hour(order_date) AS INTEGER) AS order_hour,
  CAST(isodow(order_date) - 1 AS INTEGER) AS order_day_of_week,
  CAST(month(order_date) AS INTEGER) AS order_month, CAST(year(order_date) AS INTEGER) AS order_year
FROM sc_orders""",
        "fe_weekend": """
SELECT order_item_id, CASE WHEN isodow(TRY_CAST(order_date_text AS TIMESTAMP)) >= 6 THEN 1
  ELSE 0 END AS is_weekend_order FROM sc_orders_dirty""",
        "fe_revenue_per_unit": f"""
SELECT order_item_id, {half_up("CAST(sales AS DOUBLE) / greatest(order_item_quantity, 1)", 2)}
  AS revenue_per_unit FROM sc_orders_gaps""",
        "fe_has_discount": """
SELECT order_item_id, CASE WHEN order_item_discount_rate > 0 THEN 1 ELSE 0 END AS has_discount
FROM sc_orders""",
        "fe_is_profitable": """
SELECT order_item_id, CASE WHEN benefit_per_order > 0 THEN 1 ELSE 0 END AS is_profitable
FROM sc_orders""",
        "fe_sched_bin": """
SELECT order_item_id, CASE WHEN days_for_shipment_scheduled BETWEEN 0 AND 1 THEN 'same_day'
  WHEN days_for_shipment_scheduled BETWEEN 2 AND 3 THEN '1-3_days'
  WHEN days_for_shipment_scheduled BETWEEN 4 AND 5 THEN '3-5_days'
  WHEN days_for_shipment_scheduled BETWEEN 6 AND 10 THEN '5-10_days'
  WHEN days_for_shipment_scheduled BETWEEN 11 AND 100 THEN '10+_days' END AS scheduled_days_bin
FROM sc_orders""",
        **risk,
        "fe_lookup_risk": f"""
SELECT order_item_id, 55e-2 AS market_risk_score, 55e-2 AS region_risk_score, {mode_risk}
FROM sc_orders""",
        "fe_lookup_risk_listed": f"""
SELECT order_item_id, m AS market, r AS order_region, {_rate("m", MARKET_RATES)} AS market_risk_score,
  {_rate("r", REGION_RATES)} AS region_risk_score, {MODE_RISK}
FROM (SELECT *, {_listed("market", MARKET_RATES)} AS m, {_listed("order_region", REGION_RATES)} AS r
  FROM sc_orders)""",
        "fe_incoming_order": "SELECT * FROM sc_incoming",
    }


def sensors() -> dict[str, str]:
    w = "(PARTITION BY machine_id ORDER BY reading_ts, event_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
    rn = "ROW_NUMBER() OVER (PARTITION BY machine_id ORDER BY reading_ts, event_id) AS rn"
    minmax = ", ".join(
        half_up(f"({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ())", 6) + f" AS {c}"
        for c in CHANNELS
    )
    latest = ", ".join(
        f"{half_up(expr, 4)} AS {c}_{kind}"
        for c in CHANNELS
        for kind, expr in (
            ("mean", f"AVG({c})"), ("sd", f"STDDEV_SAMP({c})"), ("min", f"MIN({c})"),
            ("max", f"MAX({c})"), ("last", f"arg_min({c}, age)"),
            ("change", f"arg_min({c}, age) - arg_max({c}, age)"),
        )
    )
    sums = ", ".join(f"{half_up(f'SUM({c}) OVER {w}', 4)} AS sum_{c}" for c in CHANNELS)
    feats = ", ".join(
        f"{half_up(expr, 4)} AS {c}_{kind}"
        for c in CHANNELS
        for kind, expr in (
            ("mean", f"AVG({c}) OVER {w}"), ("sd", f"STDDEV_SAMP({c}) OVER {w}"),
            ("min", f"MIN({c}) OVER {w}"), ("max", f"MAX({c}) OVER {w}"),
            ("last", f"LAST_VALUE({c}) OVER {w}"),
            ("change", f"LAST_VALUE({c}) OVER {w} - FIRST_VALUE({c}) OVER {w}"),
        )
    )
    return {
        "ts_failure_label":
            "SELECT machine_id, event_id, is_failure, failure_in_24h FROM sc_labelled",
        "ts_minmax": f"SELECT machine_id, event_id, {minmax} FROM sc_sensor",
        "ts_sequences": f"""
SELECT * EXCLUDE (rn) FROM (SELECT machine_id, event_id, failure_in_24h, 30 AS steps, {sums}, {rn}
  FROM sc_labelled) WHERE rn > 30""",
        "ts_window_features": f"""
SELECT * EXCLUDE (rn) FROM (SELECT machine_id, event_id, {feats}, {rn} FROM sc_sensor)
WHERE rn > 30""",
        "ts_latest_window": """
SELECT machine_id, event_id, reading_ts, age FROM (SELECT *, ROW_NUMBER() OVER
  (PARTITION BY machine_id ORDER BY reading_ts DESC, event_id DESC) AS age FROM sc_sensor)
WHERE age <= 30""",
        "ts_latest_features": f"""
SELECT machine_id, {latest} FROM (SELECT *, ROW_NUMBER() OVER
  (PARTITION BY machine_id ORDER BY reading_ts DESC, event_id DESC) AS age FROM sc_sensor)
WHERE age <= 30 GROUP BY machine_id HAVING COUNT(*) = 30""",
        "ts_health_zscore":
            f"SELECT machine_id, {half_up('p', 6)} AS probability FROM sc_health_raw",
        "ts_rul": """
SELECT machine_id, CAST(greatest(1, floor((1 - p) * 72)) AS INTEGER) AS rul_hours
FROM sc_health_raw""",
        "ts_severity": """
SELECT machine_id, ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'][CAST(least(3, floor(p * 4)) AS INT) + 1]
  AS severity FROM sc_health_raw""",
        "ts_health_table": "SELECT * FROM sc_health",
    }


def statements() -> dict[str, str]:
    parts = {**sources(), **quality(), **cleaning(), **features(), **sensors()}
    return {name: with_views(sql) for name, sql in parts.items()}
