"""Briefing texts, report files and table round trips."""

import json
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import briefing
from millrace.schemas import MACHINE_HEALTH
from millrace.sources import tables

# The wording of a published briefing.
STABLE = (
    "**Fleet Status: ✅ STABLE**\n\nAs of 2026-06-19 14:44, the plant is monitoring **10 machines** "
    "with an average health score of **88.6/100**.\nThe most at-risk unit is **M-007** (failure "
    "probability: 18.4%, RUL: 58h). Recommend prioritizing preventive maintenance to avoid "
    "unplanned downtime."
)
NORMAL = ("🟢 OPERATIONS NORMAL — 0 minor alerts. System performing within expected parameters.")
HEALTH = [
    ("M-007", 0.1837, 81.6, 58), ("M-004", 0.1533, 84.7, 60), ("M-005", 0.1293, 87.1, 62),
    ("M-001", 0.1263, 87.4, 62), ("M-008", 0.1210, 87.9, 63), ("M-006", 0.0964, 90.4, 65),
    ("M-010", 0.0904, 91.0, 65), ("M-003", 0.0831, 91.7, 66), ("M-009", 0.0805, 92.0, 66),
    ("M-002", 0.0784, 92.2, 66),
]


def health_of(spark, rows, severity=None):
    full = [(m, p, h, r, severity or "LOW", *[0.0] * 5) for m, p, h, r in rows]
    return spark.createDataFrame(full, MACHINE_HEALTH)


def orders_of(spark, rows):
    return spark.createDataFrame(rows, "order_region string, predicted_late int")


def test_published_briefing(spark):
    made = briefing.daily_briefing(
        health_of(spark, HEALTH), orders_of(spark, []), "2026-06-19 14:44:12").first()
    assert made["date"] == "Friday, 19 June 2026"
    assert made["overall_risk_score"] == 5.7
    assert made["total_alerts"] == 0
    assert made["maintenance_summary"] == STABLE
    assert made["supply_chain_summary"] == briefing.NO_ORDERS
    assert made["executive_headline"] == NORMAL


def test_briefing_of_nothing(spark):
    made = briefing.daily_briefing(health_of(spark, []), orders_of(spark, []), "2024-01-01 00:00:00").first()
    assert made["maintenance_summary"] == briefing.NO_MACHINES
    assert (made["overall_risk_score"], made["total_alerts"]) == (0.0, 0)


def test_alert_texts(spark):
    rows = [("M-003", 0.82, 18.0, 8), ("M-001", 0.80, 20.0, 6)]
    health = health_of(spark, rows, "CRITICAL").union(health_of(spark, [("M-002", 0.6, 40.0, 28)], "HIGH"))
    late = [("North", 1)] * 1200 + [("South", 0)] * 600 + [("South", 1)] * 600 + [("East", 0)] * 30
    made = briefing.daily_briefing(health, orders_of(spark, late), "2024-01-01 00:00:00").first()
    assert "**2 machine(s) are in CRITICAL condition** (M-001, M-003) and require" in made["maintenance_summary"]
    assert "within the next 6 hours." in made["maintenance_summary"]
    assert "An additional **1 machine(s)**" in made["maintenance_summary"]
    assert "unit is **M-003** (failure probability: 82.0%, RUL: 8h)" in made["maintenance_summary"]
    assert "**Supply Chain Status: 🔴 HIGH RISK**" in made["supply_chain_summary"]
    assert "**2,430 shipments**" in made["supply_chain_summary"]
    assert "**74.1%**, affecting approximately **1,800 orders**" in made["supply_chain_summary"]
    assert "**North (100%), South (50%), East (0%)**" in made["supply_chain_summary"]
    assert made["total_alerts"] == 1803
    assert made["executive_headline"].startswith("🔴 HIGH OPERATIONAL RISK — 1803 active alerts")


@pytest.mark.parametrize("risk,start", [(60.0, "🔴"), (59.9, "🟡"), (35.0, "🟡"), (34.9, "🟢")])
def test_headline_limits(spark, risk, start):
    row = spark.range(1).select(briefing.headline(F.lit(risk), F.lit(3))).first()
    assert row[0].startswith(start)


def test_fleet_stats_by_group(spark):
    health = health_of(spark, HEALTH[:4]).withColumn("site", F.substring("machine_id", 5, 1))
    stats = briefing.fleet_stats(health, by="site").collect()
    assert {r["site"]: r["worst_machine"] for r in stats} == {
        "7": "M-007", "4": "M-004", "5": "M-005", "1": "M-001"}


def test_newest_reports_are_chosen_before_bad_ones_are_skipped(spark, tmp_path):
    for i in range(24):
        text = json.dumps({"date": f"day {i}", "overall_risk_score": 1.5 * i, "total_alerts": i}, indent=2)
        (tmp_path / f"briefing_202401{i:02d}_0000.json").write_text("{ broken" if i == 20 else text)
    (tmp_path / "briefing_20240123_0001.json").write_text("{}")
    rows = tables.list_reports(spark, str(tmp_path)).orderBy(F.desc("filename")).collect()
    assert len(rows) == 19
    assert rows[0]["filename"] == "briefing_20240123_0001.json"
    assert (rows[0]["date"], rows[0]["risk_score"], rows[0]["alerts"]) == ("Unknown", 0.0, 0)
    assert (rows[1]["date"], rows[1]["alerts"]) == ("day 23", 23)
    assert rows[-1]["filename"] == "briefing_20240105_0000.json"
    assert "briefing_20240120_0000.json" not in {r["filename"] for r in rows}


def test_no_reports(spark, tmp_path):
    assert tables.list_reports(spark, str(tmp_path)).count() == 0


def test_written_briefings_are_listed_by_name(spark, tmp_path):
    made = briefing.daily_briefing(health_of(spark, HEALTH), orders_of(spark, []), "2026-06-19 14:44:12")
    for name in ("briefing_20260619_1444.json", "briefing_20260620_2030.json"):
        tables.write_briefings(made.withColumn("report_name", F.lit(name)), str(tmp_path / "reports"))
    rows = tables.list_reports(spark, str(tmp_path / "reports"), 1).collect()
    assert [(r["filename"], r["date"], r["risk_score"]) for r in rows] == [
        ("briefing_20260620_2030.json", "Friday, 19 June 2026", 5.7)]


def test_a_report_written_again_counts_once(spark, tmp_path):
    made = briefing.daily_briefing(health_of(spark, HEALTH), orders_of(spark, []), "2026-06-19 14:44:12")
    for name, date in (("briefing_20260619_1444.json", "a"), ("briefing_20260620_2030.json", "old"),
                       ("briefing_20260620_2030.json", "new")):
        tables.write_briefings(
            made.withColumns({"report_name": F.lit(name), "date": F.lit(date)}), str(tmp_path / "r"))
        time.sleep(1.1)  # file times may be whole seconds
    for n, dates in ((1, ["new"]), (2, ["new", "a"]), (20, ["new", "a"])):
        rows = tables.list_reports(spark, str(tmp_path / "r"), n).orderBy(F.desc("filename")).collect()
        assert [r["date"] for r in rows] == dates


def test_flat_export_keeps_orders_without_a_match(spark):
    orders = spark.createDataFrame([(1, 10, 100), (2, 99, 999)], "order_item_id int, customer_id int, product_id int")
    customers = spark.createDataFrame(
        [(10, "A", "B", "Consumer", "X", 1.0, 2.0)],
        "customer_id int, customer_fname string, customer_lname string, customer_segment string, "
        "customer_country string, latitude double, longitude double")
    products = spark.createDataFrame(
        [(100, "p", "c", "d", 1.0)],
        "product_id int, product_name string, category_name string, department_name string, "
        "product_price double")
    rows = {r["order_item_id"]: r for r in tables.flat_export(orders, customers, products).collect()}
    assert rows[1]["customer_fname"] == "A" and rows[1]["product_name"] == "p"
    assert rows[2]["customer_fname"] is None and rows[2]["product_name"] is None


def test_csv_round_trip_with_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1, "a,b"), (2, None, None)], "i int, x double, t string")
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, 0.1, "a,b"), (2, None, None)]
