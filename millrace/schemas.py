"""Schemas of the tables and files read and written."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "timestamp": T.TimestampNTZType(), "money": T.DecimalType(18, 4),
}


def _schema(text: str) -> T.StructType:
    """Schema from ``name kind`` pairs."""
    fields = [pair.split() for pair in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


CUSTOMERS = _schema("""
    customer_id bigint, customer_fname string, customer_lname string, customer_email string,
    customer_segment string, customer_city string, customer_state string,
    customer_country string, customer_zipcode string, latitude double, longitude double
""")

PRODUCTS = _schema("""
    product_id bigint, product_name string, category_id int, category_name string,
    department_id int, department_name string, product_price double, product_status int
""")

ORDERS = _schema("""
    order_id bigint, order_item_id bigint, customer_id bigint, product_id bigint,
    order_date timestamp, shipping_date timestamp, shipping_mode string, order_status string,
    delivery_status string, late_delivery_risk int, days_for_shipping_real int,
    days_for_shipment_scheduled int, order_item_quantity int, order_item_discount money,
    order_item_discount_rate double, order_item_product_price double,
    order_item_profit_ratio double, sales money, benefit_per_order money,
    sales_per_customer money, order_region string, order_country string, order_city string,
    order_state string, market string, type string
""")

SENSOR = _schema("""
    machine_id bigint, reading_ts timestamp, temperature double, vibration double,
    pressure double, rpm double, current_amps double, failure_in_24h int
""")

MACHINE_HEALTH = _schema("""
    machine_id string, failure_probability double, health_score double, rul_hours int,
    severity string, last_temperature double, last_vibration double, last_pressure double,
    last_rpm double, last_current double
""")

MODEL_METRICS = _schema("Metric string, Score double")

BRIEFING = _schema("""
    date string, overall_risk_score double, total_alerts bigint, maintenance_summary string,
    supply_chain_summary string, executive_headline string, generated_at string, model_used string
""")
