"""Cleaning, features and checks on hand-made rows, and the shape of their plans."""

import datetime as dt
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import registry
from millrace.operators import cleaning, features, quality
from millrace.plans.etl import clean_orders
from millrace.session import new_folder
from millrace.sources import tables
from millrace.sources.fixtures import mart, mart_to_extract, mart_with_gaps, orders, products
from tests.conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fill_abs_and_cap_follow_their_order(spark):
    df = spark.createDataFrame(
        [(-10.0, "a"), (None, "b"), (4.0, "b"), (6.0, None), (100.0, None)], "sales double, t string")
    rules = cleaning.fit_cleaning(df, ["sales"], ["t"], ["sales"], p=0.75)
    # median of -10, 4, 6, 100 is 5; after abs: 10, 5, 4, 6, 100 with upper quartile 10
    assert rules.fills == {"sales": 5.0, "t": "b"}
    assert rules.caps == {"sales": 10.0}
    cleaned = cleaning.apply_cleaning(df, rules).collect()
    assert [r["sales"] for r in cleaned] == [10.0, 5.0, 4.0, 6.0, 10.0]
    assert [r["t"] for r in cleaned] == ["a", "b", "b", "b", "b"]


@pytest.mark.parametrize("gaps", [0, 3, 40, 2_000])
def test_caps_are_those_of_the_filled_column(spark, gaps):
    rng = np.random.default_rng(gaps)
    values = [*rng.normal(5, 40, 700).round(1).tolist(), *[None] * gaps]
    df = spark.createDataFrame([(v,) for v in values], "sales double").repartition(3)
    for p in (0.05, 0.5, 0.75, 0.99, 1.0):
        rules = cleaning.fit_cleaning(df, ["sales"], [], ["sales"], p)
        known = [v for v in values if v is not None]
        median = float(np.median(known))
        assert rules.fills == ({"sales": pytest.approx(median)} if gaps else {})
        filled = np.abs([median if v is None else v for v in values])
        assert rules.caps == {"sales": pytest.approx(np.quantile(filled, p))}


def test_cleaning_takes_few_passes_over_the_items(spark):
    items = mart_with_gaps(spark, SF_DIR)["orders"].withColumnRenamed("type", "payment_type")
    path = new_folder(spark, "passes")
    items.write.parquet(path)
    df, tracker = spark.read.parquet(path), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("cleaning-passes", "")
    rules = cleaning.fit_cleaning(df, ["late_delivery_risk", "sales", "benefit_per_order"], ["payment_type", "market"])
    jobs = len(tracker.getJobIdsForGroup("cleaning-passes"))
    spark.sparkContext.setJobGroup("other", "")
    assert set(rules.fills) == {"sales", "payment_type"} and set(rules.caps) == set(cleaning.MONEY)
    assert jobs <= 14


def test_dates_of_text_columns_are_parsed_in_cleaning(spark):
    whole = mart(spark, SF_DIR)
    bad = F.when(F.col("order_id") % 113 == 0, "not a date").otherwise(F.col("order_date").cast("string"))
    cleaned = clean_orders({**whole, "orders": whole["orders"].withColumn("order_date", bad)})
    assert dict(cleaned.dtypes)["order_date"] == "timestamp_ntz"
    broken = cleaned.where("order_id % 113 = 0")
    assert broken.count() == broken.where("order_date is null and order_hour is null").count() > 0
    assert cleaned.where("order_id % 113 <> 0 and order_date is null").count() == 0


def test_clean_orders_has_all_columns_and_no_gaps(spark):
    cleaned = clean_orders(mart_with_gaps(spark, SF_DIR))
    assert len(cleaned.columns) == 41
    assert quality.missing_cells(cleaned).first()[0] == 0
    assert cleaned.count() == cleaned.select("order_item_id").distinct().count()


def test_dedup_keeps_the_first_row_and_prunes_before_the_shuffle(spark):
    rows = [(1, 5, "late"), (1, 2, "first"), (2, 9, "only")] + [(3, i, str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    kept = cleaning.dedup(df, ["k"], ["o"])
    assert {r["k"]: r["v"] for r in kept.collect()} == {1: "first", 2: "only", 3: "0"}
    assert "WindowGroupLimit" in plan(kept) and "Partial" in plan(kept)


def test_unreadable_dates_become_null(spark):
    df = spark.createDataFrame([("2024-02-29 10:00:00",), ("2023-02-29",), ("x",), (None,)], "d string")
    values = [r["d"] for r in cleaning.parse_timestamps(df, ["d"]).collect()]
    assert values == [dt.datetime(2024, 2, 29, 10), None, None, None]


def test_prior_probability_is_limited(spark):
    df = spark.createDataFrame(
        [("Federal", "Standard Class"), ("Punjab", "Same Day"), ("x", "y"), (None, None)],
        "m string, s string")
    found = [r[0] for r in df.select(cleaning.prior_late_probability(F.col("m"), F.col("s"))).collect()]
    assert found == pytest.approx([0.87, 0.33, 0.55, 0.55])


def test_scheduled_bins_are_closed_on_the_right(spark):
    days = [-1, 0, 1, 2, 3, 5, 6, 10, 11, 100, 101, None]
    df = spark.createDataFrame([(d,) for d in days], "days_for_shipment_scheduled int")
    labels = [r["scheduled_days_bin"] for r in features.scheduled_bin(df).collect()]
    assert labels == [None, "same_day", "same_day", "1-3_days", "1-3_days", "3-5_days",
                      "5-10_days", "5-10_days", "10+_days", "10+_days", None, None]


def test_target_mean_of_unseen_and_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "k string, t int")
    own = features.target_mean(df, "k", "r", "t").collect()
    assert {(r["k"], r["r"]) for r in own} == {("a", 0.5), ("b", 1.0), (None, None)}
    other = spark.createDataFrame([("a", 1), ("z", 0)], "k string, t int")
    fitted = features.target_mean(other, "k", "r", "t", fit_on=df).collect()
    assert {(r["k"], r["r"]) for r in fitted} == {("a", 0.5), ("z", 0.75)}


def test_missing_date_is_not_a_weekend(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(2024, 6, 1),)], "order_date timestamp_ntz")
    assert [r["is_weekend_order"] for r in features.weekend(df).collect()] == [0, 1]


def test_empty_tables_give_counts_of_zero(spark):
    whole = mart(spark, SF_DIR)
    empty = whole["orders"].limit(0)
    assert quality.orphans(empty, whole["customers"], "customer_id", "n").first()["n"] == 0
    assert quality.missing_cells(empty).first()["missing"] == 0
    assert quality.share_by(empty, "market").count() == 0


def test_orphans_count_missing_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    found = quality.orphans(fact, dim, "k", "n")
    assert found.first()["n"] == 2
    assert "LeftAnti" in plan(found)


def test_filters_and_columns_reach_the_scan(spark):
    narrow = cleaning.not_canceled(orders(spark, SF_DIR)).select("order_item_id")
    text = plan(narrow)
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    lineitem = next(line for line in scans if "l_orderkey" in line)
    assert "l_extendedprice" not in lineitem and "l_quantity" not in lineitem
    assert "o_orderstatus" in next(line for line in scans if "o_orderkey" in line)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_risk_scores_do_not_shuffle_the_rows(spark):
    df = products(spark, SF_DIR).select("category_name", F.lit(1).alias("late_delivery_risk"))
    text = plan(features.target_mean(df, "category_name", "r"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_stored_items_without_copies_are_not_written_again(spark):
    path = new_folder(spark, "single")
    spark.range(40).selectExpr("id k", "id % 3 o").write.parquet(path)
    df = spark.read.parquet(path)
    assert cleaning.dedup_stored(df, ["k"], ["o"]) is df


def test_stored_copies_are_dropped_as_by_a_window(spark):
    path = new_folder(spark, "copies")
    rows = [(k, o, str(o)) for k in (None, 1, 2, 3) for o in range(1 if k == 2 else 4)]
    spark.createDataFrame(rows, "k int, o int, t string").write.parquet(path)
    df = spark.read.parquet(path)
    want = sorted(map(str, cleaning.dedup(df, ["k"], ["o"]).collect()))
    assert sorted(map(str, cleaning.dedup_stored(df, ["k"], ["o"]).collect())) == want


def test_filled_orders_are_joined_once(spark):
    for name in ("ml_impute_cat", "ml_impute_num"):
        plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and "Join" not in plan


def test_items_are_dealt_by_order_and_product_alone(spark):
    adaptive, broadcast = (spark.conf.get(f"spark.sql.{c}") for c in (
        "adaptive.enabled", "autoBroadcastJoinThreshold"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = orders(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert len(dealt) == 1
    below = text[text.index(dealt[0]) + len(dealt[0]):].split("Exchange")[0]
    assert "l_linenumber" not in below and "l_orderkey" not in below


def test_caps_read_the_joined_amounts_once(spark):
    text = registry.queries()["clean_clip_p99"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text


def below(text, head):
    """The plan lines under each line that has ``head``."""
    lines = text.splitlines()
    depth = [re.match(r"[ :+\-|]*", x).end() for x in lines]
    for i, line in enumerate(lines):
        if head in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield lines[i + 1:end]


def test_items_are_not_dealt_by_customer(spark):
    plain = cleaning.extract(**mart_with_gaps(spark, SF_DIR))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(registry.queries()["src_extract"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    dealt = [*below(text, "Exchange hashpartitioning(customer_id#"), *below(text, "Exchange hashpartitioning(o_custkey#")]
    assert dealt and not any("l_orderkey" in line for lines in dealt for line in lines)
    made = cleaning.extract(**mart_to_extract(spark, SF_DIR))
    assert made.schema == plain.schema
    assert made.exceptAll(plain).isEmpty() and plain.exceptAll(made).isEmpty()


def test_features_are_stored_compressed(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(registry.tables, "read_csv", lambda s, path, schema: stored.append(path))
    registry.queries()["src_features_csv"](spark, SF_DIR)
    parts = [f for f in os.listdir(stored[0]) if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)


def test_flat_export_deals_orders_once_more(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = spark.range(40).select(
            F.col("id").alias("order_id"), (F.col("id") % 3).alias("customer_id"), (F.col("id") % 5).alias("product_id"),
            F.lit("x").alias("market")).repartition(8, "product_id")
        who = spark.range(2).select(
            F.col("id").alias("customer_id"), *[F.lit(c).alias(c) for c in (
                "customer_fname", "customer_lname", "customer_segment", "customer_country", "latitude", "longitude")])
        what = spark.range(4).select(
            F.col("id").alias("product_id"), *[F.lit(c).alias(c) for c in (
                "product_name", "category_name", "department_name", "product_price")])
        flat = tables.flat_export(dealt, who, what)
        # once as given, once by customer, and each of the small tables
        assert len(re.findall(r"Exchange hashpartitioning\(product_id", plan(flat))) == 2
        assert len(re.findall(r"Exchange hashpartitioning\(customer_id", plan(flat))) == 2
        rows = {r["order_id"]: r for r in flat.collect()}
        assert len(rows) == 40 and rows[2]["customer_fname"] is None and rows[4]["product_name"] is None
        assert flat.columns == ["product_id", "customer_id", "order_id", "market", *who.columns[1:], *what.columns[1:]]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
