"""Briefing tables and texts from machine health and scored orders.

Every statistic takes ``by``: None gives one row for everything, a column one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numeric import mean, rounded

# These texts and the sentences of the functions below must match word for word.
NO_MACHINES = "No machine health data available."
NO_ORDERS = "No supply chain data available."
ENGINE = "Template Engine"


def _keys(by: str | None) -> list[str]:
    return [by] if by else []


def _fleet(health: DataFrame, by: str | None = None) -> DataFrame:
    critical = F.col("severity") == "CRITICAL"
    worst = F.min(F.struct(
        (-F.col("failure_probability")).alias("order"), "machine_id", "failure_probability",
        "rul_hours",
    ))
    stats = health.groupBy(*_keys(by)).agg(
        F.count("*").alias("machines"),
        rounded(mean(F.col("health_score").cast("decimal(18,6)")), 1).alias("mean_health"),
        F.count_if(critical).alias("critical"),
        F.array_join(F.sort_array(F.collect_list(F.when(critical, F.col("machine_id")))), ", ")
        .alias("critical_ids"),
        F.count_if(F.col("severity") == "HIGH").alias("high"),
        F.min(F.when(critical, F.col("rul_hours"))).alias("soonest_hours"),
        worst.alias("worst"),
        mean(F.col("failure_probability").cast("decimal(18,6)")).alias("machine_risk"),
    )
    return stats.select(
        *_keys(by), "machines", "mean_health", "critical", "critical_ids", "high", "soonest_hours",
        F.col("worst.machine_id").alias("worst_machine"),
        F.col("worst.failure_probability").alias("worst_probability"),
        F.col("worst.rul_hours").alias("worst_hours"), "machine_risk",
    )


def fleet_stats(health: DataFrame, by: str | None = None) -> DataFrame:
    """Fleet size, mean health, critical and high machines, and the machine most at risk."""
    return _fleet(health, by).drop("machine_risk")


def delay_stats(predictions: DataFrame, by: str | None = None) -> DataFrame:
    """Shipments, predicted late ones and their share, 0 when there are none."""
    late = F.coalesce(F.sum("predicted_late"), F.lit(0)).cast("bigint")
    stats = predictions.groupBy(*_keys(by)).agg(F.count("*").alias("shipments"), late.alias("late"))
    rate = F.coalesce(F.try_divide(F.col("late").cast("double"), F.col("shipments")), F.lit(0.0))
    return stats.withColumn("delay_rate", rate)


def top_regions(predictions: DataFrame, n: int = 3) -> DataFrame:
    rates = predictions.where("order_region is not null").groupBy("order_region").agg(
        mean(F.col("predicted_late")).alias("late_share")
    )
    return rates.orderBy(F.desc("late_share"), "order_region").limit(n)


def region_line(predictions: DataFrame, n: int = 3) -> DataFrame:
    """The leading regions as one row of text."""
    place = Window.orderBy(F.desc("late_share"), "order_region")
    percent = F.format_string("%.0f", rounded(F.col("late_share") * 100, 0))
    named = F.concat("order_region", F.lit(" ("), percent, F.lit("%)"))
    lines = top_regions(predictions, n).select(
        F.struct(F.row_number().over(place).alias("place"), named.alias("text")).alias("line")
    )
    ordered = F.transform(F.sort_array(F.collect_list("line")), lambda line: line["text"])
    return lines.agg(F.array_join(ordered, ", ").alias("regions"))


def fleet_status(critical: Column) -> Column:
    return F.when(critical > 0, "⚠️ ALERT").otherwise("✅ STABLE")


def supply_status(delay_rate: Column) -> Column:
    return (
        F.when(delay_rate > 0.4, "🔴 HIGH RISK").when(delay_rate > 0.2, "🟡 MODERATE")
        .otherwise("🟢 LOW RISK")
    )


def _risk(machines: Column, orders: Column) -> Column:
    """Equal parts of both risks on 0..100; an absent side counts as 0 and stays in the mean."""
    parts = [F.coalesce(side, F.lit(0.0)) * 0.5 for side in (machines, orders)]
    return rounded((parts[0] + parts[1]) * 100, 1)


def overall_risk(health: DataFrame, predictions: DataFrame) -> DataFrame:
    """Mean failure probability and predicted late share in equal parts."""
    machines = _fleet(health).select("machine_risk")
    orders = delay_stats(predictions).select("delay_rate")
    risk = _risk(F.col("machine_risk"), F.col("delay_rate"))
    return _beside(machines, orders).select(risk.alias("overall_risk_score"))


def alert_count(health: DataFrame, predictions: DataFrame) -> DataFrame:
    """Machines in critical or high condition and orders predicted late."""
    machines = health.agg(F.count_if(F.col("severity").isin("CRITICAL", "HIGH")).alias("machines"))
    orders = predictions.agg(F.coalesce(F.sum("predicted_late"), F.lit(0)).alias("orders"))
    return _beside(machines, orders).select(
        (F.col("machines") + F.col("orders")).cast("bigint").alias("total_alerts")
    )


def headline(risk: Column, alerts: Column) -> Column:
    n = alerts.cast("string")
    return (
        F.when(risk >= 60, F.concat(
            F.lit("🔴 HIGH OPERATIONAL RISK — "), n,
            F.lit(" active alerts require immediate attention.")))
        .when(risk >= 35, F.concat(
            F.lit("🟡 ELEVATED RISK — "), n,
            F.lit(" alerts detected. Monitor closely and prepare contingencies.")))
        .otherwise(F.concat(
            F.lit("🟢 OPERATIONS NORMAL — "), n,
            F.lit(" minor alerts. System performing within expected parameters.")))
    )


def _beside(*one_row: DataFrame) -> DataFrame:
    """One-row frames side by side, joined on a constant."""
    keyed = [df.withColumn("one", F.lit(1)) for df in one_row]
    out = keyed[0]
    for df in keyed[1:]:
        out = out.join(F.broadcast(df), "one")
    return out.drop("one")


def _share(value: Column) -> Column:
    return F.format_string("%.1f%%", rounded(value * 100, 1))


def maintenance_text(stats: DataFrame, as_of: str) -> DataFrame:
    """Add the maintenance paragraph to fleet statistics, for a given moment."""
    count = F.col("critical").cast("string")
    moment = F.date_format(F.lit(as_of).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm")
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("**Fleet Status: "), fleet_status(F.col("critical")), F.lit("**")),
        F.lit(""),
        F.concat(
            F.lit("As of "), moment, F.lit(", the plant is monitoring **"),
            F.col("machines").cast("string"),
            F.lit(" machines** with an average health score of **"),
            F.format_string("%.1f", F.col("mean_health")), F.lit("/100**."),
        ),
        F.when(F.col("critical") > 0, F.concat(
            F.lit("**"), count, F.lit(" machine(s) are in CRITICAL condition** ("),
            F.col("critical_ids"),
            F.lit(") and require **immediate maintenance intervention** within the next "),
            F.col("soonest_hours").cast("string"), F.lit(" hours."),
        )),
        F.when(F.col("high") > 0, F.concat(
            F.lit("An additional **"), F.col("high").cast("string"),
            F.lit(" machine(s)** are classified as HIGH risk and should be scheduled for "
                  "inspection within 24–48 hours."),
        )),
        F.concat(
            F.lit("The most at-risk unit is **"), F.col("worst_machine"),
            F.lit("** (failure probability: "), _share(F.col("worst_probability")),
            F.lit(", RUL: "), F.col("worst_hours").cast("string"),
            F.lit("h). Recommend prioritizing preventive maintenance to avoid unplanned downtime."),
        ),
    )
    text = F.when(F.col("machines") > 0, lines).otherwise(NO_MACHINES)
    return stats.withColumn("maintenance_summary", text)


def supply_text(stats: DataFrame) -> DataFrame:
    """Add the supply paragraph to delay statistics that carry a ``regions`` line."""
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("**Supply Chain Status: "), supply_status(F.col("delay_rate")), F.lit("**")),
        F.lit(""),
        F.concat(
            F.lit("Analysis of **"), F.format_number("shipments", 0),
            F.lit(" shipments** reveals a predicted delay rate of **"),
            _share(F.col("delay_rate")), F.lit("**, affecting approximately **"),
            F.format_number("late", 0), F.lit(" orders**."),
        ),
        F.when(F.col("regions") != "", F.concat(
            F.lit("The highest-risk regions are **"), F.col("regions"),
            F.lit("**, which should be prioritized for carrier renegotiation and buffer stock "
                  "allocation."),
        )),
        F.lit("Recommend activating contingency routing protocols for flagged shipments and "
              "initiating supplier performance reviews for the affected regions."),
    )
    text = F.when(F.col("shipments") > 0, lines).otherwise(NO_ORDERS)
    return stats.withColumn("supply_chain_summary", text)


def supply_stats(predictions: DataFrame) -> DataFrame:
    return _beside(delay_stats(predictions), region_line(predictions))


def daily_briefing(health: DataFrame, predictions: DataFrame, as_of: str) -> DataFrame:
    """The briefing record of one moment."""
    moment = F.lit(as_of).cast("timestamp_ntz")
    parts = _beside(
        maintenance_text(_fleet(health), as_of), supply_text(supply_stats(predictions))
    )
    alerts = F.col("critical") + F.col("high") + F.col("late")
    figures = parts.withColumns({
        "overall_risk_score": _risk(F.col("machine_risk"), F.col("delay_rate")),
        "total_alerts": alerts.cast("bigint"),
    })
    return figures.select(
        F.date_format(moment, "EEEE, dd MMMM yyyy").alias("date"),
        "overall_risk_score", "total_alerts", "maintenance_summary", "supply_chain_summary",
        headline(F.col("overall_risk_score"), F.col("total_alerts")).alias("executive_headline"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
        F.lit(ENGINE).alias("model_used"),
    )
