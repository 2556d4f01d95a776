"""Every registered query: an operator bound to the views it reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numeric import percent, rounded
from millrace.operators import (
    briefing, cleaning, evaluation, features, marts, model, monitoring, quality, sensors,
)
from millrace.operators.oversample import oversample
from millrace.operators.preparation import fit_preparation
from millrace.plans.delay_model import (
    DelayModel, fit_on_training_rows, train_delay_model, training_rows,
)
from millrace.plans.etl import clean_orders, cleaned, extracted_items, first_items
from millrace.plans.maintenance import score_failures, train_failure_model
from millrace.session import new_folder, shared_folder, staged
from millrace.sources import tables
from millrace.sources.fixtures import (
    customers, mart, mart_to_extract, mart_with_gaps, orders, orders_dirty, products, scored, sensor,
)

Query = Callable[[SparkSession, str], DataFrame]

# The view's markets take the places of the five markets the base rates were set for.
MARKET_BASE = {"AFRICA": 0.72, "AMERICA": 0.64, "ASIA": 0.59, "EUROPE": 0.52}
MONEY = ["sales", "benefit_per_order", "sales_per_customer"]


def _digits(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    """Round floats that come from interpolation, sums or roots for comparison."""
    return df.withColumns({c: rounded(F.col(c), places) for c in cols})


def _clean(s: SparkSession, d: str) -> DataFrame:
    return _digits(clean_orders(mart_to_extract(s, d)), MONEY)


def _saved_mart(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """The mart after a round trip through parquet."""
    folder, whole = new_folder(s, "mart"), mart(s, d)
    for name, df in whole.items():
        tables.write_table(df, f"{folder}/{name}")
    return tables.load_mart(s, folder, {name: df.schema for name, df in whole.items()})


def _sink_tables(s: SparkSession, d: str) -> DataFrame:
    """Replace the mart's tables, count what is stored, and digest its contents."""
    whole = mart(s, d)
    s.sql(f"create database if not exists millrace_mart location '{shared_folder(s)}/millrace_mart'")
    folder = new_folder(s, "tables")
    tables.save_mart(whole, folder, "millrace_mart")
    return quality.table_digests({n: s.table(f"millrace_mart.{n}") for n in whole})


def _features_csv(s: SparkSession, d: str) -> DataFrame:
    path = new_folder(s, "features_csv")
    ready = features.ml_features(_clean(s, d))
    tables.write_csv(ready, path, compression="gzip")
    return tables.read_csv(s, path, ready.schema)


def _sensor_csv(s: SparkSession, d: str) -> DataFrame:
    path = new_folder(s, "sensor_csv")
    labelled = sensors.label_failures(sensor(s, d))
    tables.write_csv(labelled.select(*tables.SENSOR.names), path)
    return tables.read_sensor(s, path)


def _sources() -> dict[str, Query]:
    return {
        "src_orders_mart": lambda s, d: _saved_mart(s, d)["orders"],
        "src_extract": lambda s, d: cleaning.extract(**mart_to_extract(s, d)),
        "src_features_csv": _features_csv,
        "src_sensor_csv": _sensor_csv,
        "sink_tables": _sink_tables,
        "sink_flat": lambda s, d: tables.write_table(
            tables.flat_export(orders(s, d), customers(s, d), products(s, d)),
            new_folder(s, "flat")),
        "sink_clean": lambda s, d: tables.write_table(_clean(s, d), new_folder(s, "clean")),
        "sink_ml": lambda s, d: tables.write_table(
            features.ml_features(_clean(s, d)), new_folder(s, "ml")),
        "sink_dash": lambda s, d: tables.write_table(
            features.dashboard_view(_clean(s, d)), new_folder(s, "dash")),
        "sink_health": lambda s, d: tables.write_health(
            sensors.machine_health(sensor(s, d)), new_folder(s, "health")),
    }


def _repeated(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """The mart with gaps, in which some orders have arrived twice."""
    whole = mart_to_extract(s, d)
    orders_twice = whole["orders"].unionByName(whole["orders"].where("order_id % 7 = 0"))
    return {**whole, "orders": orders_twice}


def _cleaning_report(s: SparkSession, d: str) -> DataFrame:
    items = staged(extracted_items(_repeated(s, d)), "order_items")
    distinct = first_items(items)
    return quality.cleaning_report(items, distinct, cleaned(distinct))


def _listed(s: SparkSession, d: str) -> DataFrame:
    """Orders whose markets and regions take the names of the assumed rates, by their place."""
    def renamed(column: str, known: list[str]):
        digits = F.regexp_extract(F.col(column), "[0-9]+", 0)
        place = F.when(digits != "", digits.cast("int")).otherwise(F.length(column))
        return F.get(F.array(*[F.lit(x) for x in known]), place % F.lit(len(known) + 1))

    return orders(s, d).withColumns({
        "market": renamed("market", list(features.MARKET_RISK)),
        "order_region": renamed("order_region", list(features.REGION_RISK))})


def _quality() -> dict[str, Query]:
    return {
        "dq_row_counts": lambda s, d: quality.row_counts(mart(s, d)),
        "dq_null_audit": lambda s, d: quality.null_audit(mart_with_gaps(s, d)["orders"]),
        "dq_orphan_customers": lambda s, d: quality.orphans(
            orders(s, d), customers(s, d), "customer_id", "orphan_orders"),
        "dq_orphan_products": lambda s, d: quality.orphans(
            orders(s, d), products(s, d), "product_id", "orphan_order_items"),
        "dq_sample": lambda s, d: quality.sample(orders(s, d), customers(s, d), products(s, d)),
        "dq_status_dist": lambda s, d: quality.share_by(orders(s, d), "delivery_status"),
        "dq_class_dist": lambda s, d: quality.class_shares(
            cleaning.not_canceled(orders(s, d)), "late_delivery_risk"),
        "dq_missing_total": lambda s, d: quality.missing_cells(
            cleaning.parse_timestamps(orders_dirty(s, d), ["order_date_text"])),
        "dq_summary": lambda s, d: quality.etl_summary(_clean(s, d)),
        "dq_cleaning_report": _cleaning_report,
    }


def _marts() -> dict[str, Query]:
    return {
        "q1_executive": lambda s, d: marts.executive_summary(
            orders(s, d), customers(s, d), products(s, d)),
        "q2_shipping_mode": lambda s, d: marts.shipping_mode_performance(orders(s, d)),
        "q3_segment": lambda s, d: marts.segment_analysis(orders(s, d), customers(s, d)),
        "q4_category": lambda s, d: marts.top_categories(orders(s, d), products(s, d)),
        "q5_running_revenue": lambda s, d: marts.running_revenue(orders(s, d)),
        "q6_route_rank": lambda s, d: marts.route_ranking(orders(s, d)),
        "q7_customer_value": lambda s, d: marts.customer_value(orders(s, d), customers(s, d)),
        "q8_risk_radar": lambda s, d: marts.risk_radar(orders(s, d), products(s, d)),
    }


def _cleaning() -> dict[str, Query]:
    numeric = ["order_id", "customer_id", "product_id", *MONEY, "late_delivery_risk"]
    line = ["l_orderkey", "l_linenumber"]
    return {
        "clean_dedup": lambda s, d: cleaning.dedup(
            s.read.parquet(f"{d}/lineitem.parquet").select(
                *line, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"),
            line, ["l_partkey", "l_suppkey", "l_extendedprice"]),
        "clean_parse_dates": lambda s, d: cleaning.parse_timestamps(
            orders_dirty(s, d), ["order_date_text"]).select("order_item_id", "order_date_text"),
        "clean_fill_median": lambda s, d: cleaning.fill_median(
            orders_dirty(s, d), numeric).select("order_item_id", *numeric),
        "clean_fill_mode": lambda s, d: cleaning.fill_mode(
            orders_dirty(s, d), ["payment_type", "order_status", "market"]).select(
            "order_item_id", "payment_type", "order_status", "market"),
        "clean_abs_sales": lambda s, d: cleaning.abs_fix(
            orders_dirty(s, d), "sales").select("order_item_id", "sales"),
        "clean_negative_count": lambda s, d: cleaning.negative_count(orders_dirty(s, d), "sales"),
        # Learning and capping read the amounts where they are written once.
        "clean_clip_p99": lambda s, d: _digits(cleaning.clip_upper(
            staged(orders(s, d).select("order_item_id", *MONEY), "amounts"), MONEY), MONEY),
        "filter_not_canceled": lambda s, d: cleaning.not_canceled(orders(s, d)).select(
            "order_item_id", "order_status"),
        "filter_late": lambda s, d: cleaning.late_only(orders(s, d)).select(
            "order_item_id", "late_delivery_risk"),
        "sensor_clip": lambda s, d: sensors.clip_ranges(sensor(s, d)).select(
            "machine_id", "event_id", *sensors.CHANNELS),
        "delivery_status": lambda s, d: orders(s, d).select(
            "order_item_id",
            cleaning.delivery_status(
                F.col("order_status"), F.col("late_delivery_risk"),
                F.col("days_for_shipment_scheduled"), F.col("days_for_shipping_real"),
            ).alias("delivery_status")),
        "prior_late_prob": lambda s, d: orders(s, d).select(
            "order_item_id",
            rounded(cleaning.prior_late_probability(
                F.col("market"), F.col("shipping_mode"), MARKET_BASE), 6,
            ).alias("prior_probability")),
    }


def _features() -> dict[str, Query]:
    def one(step, *out: str, source=orders) -> Query:
        return lambda s, d: step(source(s, d)).select("order_item_id", *out)

    def parsed(s: SparkSession, d: str) -> DataFrame:
        return cleaning.parse_timestamps(orders_dirty(s, d), ["order_date_text"])

    def risk(key: str) -> Query:
        out = features.RISK_KEYS[key]
        return lambda s, d: features.target_mean(
            cleaning.not_canceled(orders(s, d)).select("order_item_id", key, "late_delivery_risk"),
            key, out).select("order_item_id", key, out)

    return {
        "fe_delay_days": one(features.delay_days, "shipping_delay_days"),
        "fe_calendar": one(
            features.calendar, "order_hour", "order_day_of_week", "order_month", "order_year"),
        "fe_weekend": one(
            lambda df: features.weekend(df, "order_date_text"), "is_weekend_order", source=parsed),
        "fe_revenue_per_unit": one(
            features.revenue_per_unit, "revenue_per_unit",
            source=lambda s, d: mart_with_gaps(s, d)["orders"]),
        "fe_has_discount": one(features.has_discount, "has_discount"),
        "fe_is_profitable": one(features.is_profitable, "is_profitable"),
        "fe_sched_bin": one(features.scheduled_bin, "scheduled_days_bin"),
        "fe_market_risk": risk("market"),
        "fe_region_risk": risk("order_region"),
        "fe_mode_risk": risk("shipping_mode"),
        "fe_lookup_risk": one(features.lookup_risk, *features.RISK_KEYS.values()),
        "fe_lookup_risk_listed": lambda s, d: features.lookup_risk(_listed(s, d)).select(
            "order_item_id", "market", "order_region", *features.RISK_KEYS.values()),
        "fe_incoming_order": lambda s, d: features.incoming_orders(
            cleaning.extract(**mart_to_extract(s, d)),
            ["order_item_id"]),
    }


def _sequence_sums(s: SparkSession, d: str) -> DataFrame:
    """Length and channel sums of every sequence."""
    made = sensors.sequences(sensors.label_failures(sensor(s, d)))

    def total(i: int):
        return F.aggregate("sequence", F.lit(0.0), lambda acc, step: acc + step[i])

    return made.select(
        "machine_id", "event_id", "failure_in_24h", F.size("sequence").alias("steps"),
        *[rounded(total(i), 4).alias(f"sum_{c}") for i, c in enumerate(sensors.CHANNELS)])


def _sensors() -> dict[str, Query]:
    def scores(s: SparkSession, d: str) -> DataFrame:
        return sensors.health_scores(sensor(s, d))

    return {
        "ts_failure_label": lambda s, d: sensors.label_failures(sensor(s, d)).select(
            "machine_id", "event_id", "is_failure", "failure_in_24h"),
        "ts_minmax": lambda s, d: _digits(
            sensors.minmax(sensor(s, d)), sensors.CHANNELS).select(
            "machine_id", "event_id", *sensors.CHANNELS),
        "ts_sequences": _sequence_sums,
        "ts_window_features": lambda s, d: _digits(
            sensors.window_features(sensor(s, d)), sensors.WINDOW_FEATURES, 4).select(
            "machine_id", "event_id", *sensors.WINDOW_FEATURES),
        "ts_latest_window": lambda s, d: sensors.latest_window(sensor(s, d)).select(
            "machine_id", "event_id", "reading_ts", "age"),
        "ts_latest_features": lambda s, d: _digits(
            sensors.latest_features(sensor(s, d)), sensors.WINDOW_FEATURES, 4),
        "ts_health_zscore": lambda s, d: _digits(
            scores(s, d), ["probability"]).select("machine_id", "probability"),
        "ts_rul": lambda s, d: scores(s, d).select(
            "machine_id", sensors.rul_hours(F.col("probability")).alias("rul_hours")),
        "ts_severity": lambda s, d: scores(s, d).select(
            "machine_id", sensors.severity(F.col("probability")).alias("severity")),
        "ts_health_table": lambda s, d: sensors.machine_health(sensor(s, d)),
    }


def _evaluation() -> dict[str, Query]:
    def rounded_floats(df: DataFrame) -> DataFrame:
        doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
        return _digits(df, [c for c in doubles if c != "threshold"], 8)

    def metrics(s: SparkSession, d: str) -> DataFrame:
        rows = scored(s, d)
        ratios = evaluation.metric_rows(evaluation.binary_metrics(rows))
        return ratios.unionAll(evaluation.metric_rows(evaluation.auc(rows)))

    return {
        "sink_metrics": lambda s, d: tables.write_table(
            rounded_floats(metrics(s, d)), new_folder(s, "metrics")),
        "ev_confusion": lambda s, d: evaluation.confusion(scored(s, d)),
        "ev_scores": lambda s, d: rounded_floats(evaluation.binary_metrics(scored(s, d))),
        "ev_auc": lambda s, d: rounded_floats(evaluation.auc(scored(s, d))),
        "ev_report": lambda s, d: rounded_floats(evaluation.classification_report(scored(s, d))),
        "ev_roc": lambda s, d: rounded_floats(evaluation.roc_points(scored(s, d))),
    }


def _split(s: SparkSession, d: str) -> DataFrame:
    rows = cleaning.not_canceled(orders(s, d)).select("order_item_id", "late_delivery_risk")
    return model.stratified_split(rows)


def _rows(s: SparkSession, d: str) -> DataFrame:
    return training_rows(_clean(s, d))


def _prepared(s: SparkSession, d: str) -> DataFrame:
    """Feature vectors of the training rows."""
    rows = _rows(s, d)
    train = rows.where("split = 'train'")
    return fit_on_training_rows(rows).transform(train).select(
        "order_item_id", "late_delivery_risk", "features")


def _filled(s: SparkSession, d: str, numeric: list[str], text: list[str]) -> DataFrame:
    """Features of incoming orders, whose gaps are filled with what was learnt from them.

    The joined orders are written once, with the asked columns; learning and filling read them there.
    """
    orders_in = staged(features.incoming_orders(cleaning.extract(
        **mart_to_extract(s, d)), ["order_item_id"]
    ).select("order_item_id", *numeric, *text), "incoming")
    return fit_preparation(orders_in, numeric, text).fill(orders_in)


# Folders of the models that this process has trained, by application and state of the input.
_models: dict[tuple[str, str], str] = {}


def _state_of(s: SparkSession, d: str) -> str:
    """Names, sizes and times of the input's files."""
    found = []
    for name in ("orders", "lineitem", "customer", "part", "nation", "region"):
        files = s.read.parquet(f"{d}/{name}.parquet").select(
            "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        found += sorted(map(str, files.distinct().collect()))
    return "\n".join(found)


def _trained(s: SparkSession, d: str) -> DelayModel:
    """The model of these orders: trained and saved by the first query that asks, then loaded."""
    asked = (s.sparkContext.applicationId, _state_of(s, d))
    if asked not in _models:
        folder = new_folder(s, "delay_model")
        train_delay_model(clean_orders(mart(s, d))).save(folder)
        _models[asked] = folder
    return DelayModel.load(s, _models[asked])


def _predictions(s: SparkSession, d: str) -> DataFrame:
    view = features.dashboard_view(clean_orders(mart(s, d)))
    return model.score_orders(_trained(s, d).classifier, view)


def _incoming_scores(s: SparkSession, d: str) -> DataFrame:
    """Orders before cleaning, scored one by one by the saved model."""
    arrived = cleaning.extract(**mart_to_extract(s, d))
    return model.score_incoming(_trained(s, d).classifier, arrived, ["order_item_id"])


def _oversampled(s: SparkSession, d: str) -> DataFrame:
    """Rows, new rows and sums of the new vectors per class after balancing."""
    rows = oversample(_prepared(s, d), "late_delivery_risk")
    x = vector_to_array("features")
    made = F.col("parent").isNotNull()
    return rows.groupBy("late_delivery_risk").agg(
        F.count("*").alias("n"), F.count("parent").alias("added"),
        *[rounded(F.coalesce(F.sum(F.when(made, x[i])), F.lit(0.0)), 3).alias(f"sum_{c}")
          for i, c in enumerate([*features.NUMERIC, *features.CATEGORICAL])])


def _failure_report(s: SparkSession, d: str) -> DataFrame:
    fitted = train_failure_model(sensor(s, d))
    report = fitted.report()
    return report.join(fitted.auc(), F.col("class") == "accuracy", "left")


def _failure_scores(s: SparkSession, d: str) -> DataFrame:
    readings = sensor(s, d)
    return score_failures(train_failure_model(readings), readings)


def _model() -> dict[str, Query]:
    numeric, text = features.NUMERIC, features.CATEGORICAL

    def scaled(s: SparkSession, d: str) -> DataFrame:
        rows = _rows(s, d)
        return _digits(fit_on_training_rows(rows).scale(rows), numeric).select(
            "order_item_id", *numeric)

    def encoded(s: SparkSession, d: str) -> DataFrame:
        rows, codes = _rows(s, d), [f"{c}_code" for c in text]
        fitted = fit_on_training_rows(rows)
        return fitted.encode(fitted.fill(rows)).select("order_item_id", *codes)

    def vectors(s: SparkSession, d: str) -> DataFrame:
        x = vector_to_array("features")
        return _prepared(s, d).select("order_item_id", *[
            rounded(x[i], 6).alias(f"x_{c}") for i, c in enumerate([*numeric, *text])])

    def labelled(s: SparkSession, d: str) -> DataFrame:
        label = model.risk_label(F.col("score")).alias("risk_label")
        return scored(s, d).select(label).groupBy("risk_label").agg(F.count("*").alias("n"))

    def advised(s: SparkSession, d: str) -> DataFrame:
        level = model.risk_level(F.col("score"))
        return scored(s, d).select(
            "order_item_id", level.alias("risk_level"), model.advice(level).alias("message"))

    return {
        "ml_split": _split,
        "ev_base_rates": lambda s, d: evaluation.late_rate_by_split(
            _split(s, d), label="late_delivery_risk"),
        "ml_impute_num": lambda s, d: _digits(_filled(s, d, numeric, []), numeric),
        "ml_impute_cat": lambda s, d: _filled(s, d, [], text),
        "ml_scale": scaled,
        "ml_encode": encoded,
        "ml_assemble": vectors,
        "ml_class_weight": lambda s, d: model.class_weight(_split(s, d).where("split = 'train'")),
        "ml_oversample": _oversampled,
        "ml_train": lambda s, d: _trained(s, d).metrics(),
        "ml_score": _predictions,
        "ml_score_incoming": _incoming_scores,
        "ml_risk_label": labelled,
        "ml_advice": advised,
        "ml_factor_flags": lambda s, d: _digits(model.risk_factors(_clean(s, d)), ["score"]),
        "ev_importance": lambda s, d: model.feature_importance(_trained(s, d).classifier),
        "sink_predictions": lambda s, d: tables.write_table(
            _predictions(s, d), new_folder(s, "predictions")),
        "ts_failure_train": _failure_report,
        "ts_failure_score": _failure_scores,
    }


AS_OF = "2024-07-01 06:30:00"


def _monthly_reports(s: SparkSession, d: str) -> DataFrame:
    """Write one report per order month and list the newest twenty."""
    month = F.date_trunc("month", F.col("order_date"))
    late = F.sum("late_delivery_risk")
    reports = orders(s, d).groupBy(month.alias("month")).agg(
        percent(late, F.count("*")).alias("overall_risk_score"), late.alias("total_alerts"))
    folder = new_folder(s, "reports")
    tables.write_briefings(reports.select(
        F.concat(F.lit("briefing_"), F.date_format("month", "yyyyMMdd"), F.lit("_0000.json"))
        .alias("report_name"),
        F.date_format("month", "EEEE, dd MMMM yyyy").alias("date"), "overall_risk_score",
        "total_alerts",
    ), folder)
    return tables.list_reports(s, folder).drop("path")


def _stored_briefing(s: SparkSession, d: str) -> DataFrame:
    folder = new_folder(s, "briefings")
    made = briefing.daily_briefing(sensors.machine_health(sensor(s, d)), scored(s, d), AS_OF)
    tables.write_briefings(
        made.withColumn("report_name", F.lit("briefing_20240701_0630.json")), folder)
    return s.read.schema(made.schema).json(folder).select(*made.columns)


def _briefing() -> dict[str, Query]:
    def health(s: SparkSession, d: str) -> DataFrame:
        return sensors.health_table(sensors.health_scores(sensor(s, d)))

    def supply_status(s: SparkSession, d: str) -> DataFrame:
        stats = briefing.delay_stats(scored(s, d), by="order_region")
        return stats.select(
            "order_region", briefing.supply_status(F.col("delay_rate")).alias("supply_status"))

    def daily(s: SparkSession, d: str) -> DataFrame:
        return briefing.daily_briefing(health(s, d), scored(s, d), AS_OF)

    return {
        "br_fleet_stats": lambda s, d: briefing.fleet_stats(health(s, d)),
        "br_delay_stats": lambda s, d: briefing.delay_stats(scored(s, d), by="order_region"),
        "br_top_regions": lambda s, d: briefing.top_regions(scored(s, d)),
        "br_fleet_status": lambda s, d: briefing.fleet_stats(health(s, d)).select(
            briefing.fleet_status(F.col("critical")).alias("fleet_status")),
        "br_supply_status": supply_status,
        "br_overall_risk": lambda s, d: briefing.overall_risk(health(s, d), scored(s, d)),
        "br_alerts": lambda s, d: briefing.alert_count(health(s, d), scored(s, d)),
        "br_headline": lambda s, d: daily(s, d).select("executive_headline"),
        "br_maintenance_text": lambda s, d: briefing.maintenance_text(
            briefing.fleet_stats(health(s, d)), AS_OF).select("maintenance_summary"),
        "br_supply_text": lambda s, d: briefing.supply_text(
            briefing.supply_stats(scored(s, d))).select("supply_chain_summary"),
        "br_daily": daily,
        "sink_briefing": _stored_briefing,
        "src_reports": _monthly_reports,
    }


def _monitoring() -> dict[str, Query]:
    def drift(s: SparkSession, d: str) -> DataFrame:
        """All features of the orders since 1998 against those of the earlier ones."""
        since = F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00"))
        rows = staged(_clean(s, d).select("order_date", *features.FEATURES), "drift_rows")
        found = monitoring.drift(
            rows.where(F.col("order_date") < since), rows.where(F.col("order_date") >= since),
            features.NUMERIC, features.CATEGORICAL)
        return _digits(found, ["psi"])

    return {
        "adv_logistics_spend": lambda s, d: monitoring.logistics_spend(orders(s, d)),
        "adv_risk_radar": lambda s, d: monitoring.predicted_risk(_predictions(s, d), orders(s, d)),
        "adv_drift": drift,
    }


def queries() -> dict[str, Query]:
    return {
        **_sources(), **_quality(), **_marts(), **_cleaning(), **_features(), **_sensors(),
        **_evaluation(), **_model(), **_briefing(), **_monitoring(),
    }
