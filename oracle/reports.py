"""Answers for classifier measures and briefing tables."""

from __future__ import annotations

from oracle.views import half_up, mean, with_views

# The sentences in the statements below must match word for word.
AS_OF = "2024-07-01 06:30:00"

CELLS = """(SELECT
  CAST(COUNT(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
  CAST(COUNT(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
  CAST(COUNT(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
  CAST(COUNT(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM sc_scored)"""
RATIOS = f"""(SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / nullif(tp + fp, 0) AS precision,
  tp / nullif(tp + fn, 0) AS recall FROM {CELLS})"""
AUC = """(SELECT (SUM(CASE WHEN label = 1 THEN rk END) - p * (p + 1) / 2) / (p * n) AS auc_roc
  FROM (SELECT label, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2e0 AS rk
    FROM sc_scored), (SELECT CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) AS p,
    CAST(COUNT(*) FILTER (label = 0) AS DOUBLE) AS n FROM sc_scored) GROUP BY p, n)"""


def metrics() -> dict[str, str]:
    f1 = "2 * precision * recall / nullif(precision + recall, 0)"
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS Metric, {half_up(expr, 8)} AS Score FROM {source}"
        for name, expr, source in (
            ("Accuracy", "accuracy", RATIOS), ("Precision", "precision", RATIOS),
            ("Recall", "recall", RATIOS), ("F1-Score", f1, RATIOS), ("AUC-ROC", "auc_roc", AUC),
        )
    )
    c0, c1 = ("tn / (tn + fn)", "tn / (tn + fp)", "tn + fp"), ("tp / (tp + fp)", "tp / (tp + fn)", "tp + fn")
    per_class = " UNION ALL ".join(
        f"SELECT '{i}' AS class, {p} AS p, {r} AS r, 2 * ({p}) * ({r}) / (({p}) + ({r})) AS f, {s} AS n "
        f"FROM {CELLS}" for i, (p, r, s) in enumerate((c0, c1))
    )
    out = {
        "sink_metrics": rows,
        "ev_confusion": "SELECT label, prediction, COUNT(*) AS n FROM sc_scored GROUP BY 1, 2",
        "ev_scores": f"""
SELECT {half_up("accuracy", 8)} AS accuracy, {half_up("precision", 8)} AS precision,
  {half_up("recall", 8)} AS recall, {half_up(f1, 8)} AS f1 FROM {RATIOS}""",
        "ev_auc": f"SELECT {half_up('auc_roc', 8)} AS auc_roc FROM {AUC}",
        "ev_report": f"""
SELECT class, {half_up("p", 8)} AS precision, {half_up("r", 8)} AS recall, {half_up("f", 8)} AS f1,
  CAST(n AS BIGINT) AS support FROM (
  SELECT * FROM ({per_class})
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, tp + tn + fp + fn FROM {RATIOS}
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(n) FROM ({per_class})
  UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n),
    sum(n) FROM ({per_class}))""",
        "ev_roc": f"""
SELECT {half_up("fpr", 8)} AS fpr, {half_up("tpr", 8)} AS tpr, threshold FROM (
  SELECT 0e0 AS fpr, 0e0 AS tpr, CAST('inf' AS DOUBLE) AS threshold
  UNION ALL SELECT SUM(neg) OVER (ORDER BY score DESC) / SUM(neg) OVER (),
    SUM(pos) OVER (ORDER BY score DESC) / SUM(pos) OVER (), score
  FROM (SELECT score, CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) AS pos,
    CAST(COUNT(*) FILTER (label = 0) AS DOUBLE) AS neg FROM sc_scored GROUP BY score))""",
    }
    return out




def _split(source: str) -> str:
    return f"""(SELECT order_item_id, late_delivery_risk AS label,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY late_delivery_risk ORDER BY md5(concat(order_item_id, '42')))
    <= ceil(0.2 * COUNT(*) OVER (PARTITION BY late_delivery_risk)) THEN 'test' ELSE 'train' END AS split
  FROM {source} WHERE order_status <> 'CANCELED')"""


SPLIT = _split("sc_orders")


# The model's columns in the order of its vector.
NUMERIC = [
    "days_for_shipment_scheduled", "order_item_quantity", "order_item_discount_rate",
    "order_item_product_price", "sales", "revenue_per_unit", "is_weekend_order", "has_discount",
    "order_hour", "order_month", "market_risk_score", "region_risk_score", "mode_risk_score",
]
CATEGORICAL = [
    "shipping_mode", "order_region", "market", "category_name", "department_name",
    "customer_segment", "payment_type",
]


def _scaled(c: str) -> str:
    train = "FILTER (split = 'train') OVER ()"
    return f"({c} - avg({c}) {train}) / coalesce(nullif(stddev_pop({c}) {train}, 0), 1)"


def _code(c: str) -> str:
    """How many training values are smaller, unless the value itself is not one of them."""
    known = f"(SELECT DISTINCT {c} AS v FROM model_rows WHERE split = 'train')"
    return (f"(SELECT CASE WHEN count(*) FILTER (v = {c}) = 0 THEN -1 ELSE count(*) FILTER (v < {c}) END "
            f"FROM {known})::DOUBLE")


# The smaller class is raised with points between a row and one of its five nearest others.
OVERSAMPLED = """
placed AS MATERIALIZED (SELECT *, md5(order_item_id || '42') AS digest,
  count(*) OVER (PARTITION BY label) AS size FROM model_vectors WHERE split = 'train'),
ends AS (SELECT min(size) AS small, max(size) AS large FROM placed),
few AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY digest, order_item_id) AS nth, {grid} FROM placed, ends
  WHERE label = (SELECT arg_min(label, (size, label)) FROM placed)),
chosen AS (SELECT *, (large - small) // small
  + CASE WHEN nth <= (large - small) % small THEN 1 ELSE 0 END AS copies FROM few),
near AS MATERIALIZED (SELECT a.order_item_id,
    min_by(b.nth, ({distance})::HUGEINT * 10000000000 + b.nth, 5) AS partners
  FROM (SELECT * FROM chosen WHERE copies > 0) a JOIN few b ON a.order_item_id <> b.order_item_id
  GROUP BY a.order_item_id),
steps AS (SELECT c.*, copy,
    CAST('0x' || substr(md5(concat_ws('#', order_item_id, copy, 42)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u,
    CAST('0x' || substr(md5(concat_ws('#', order_item_id, copy, 43)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS t
  FROM chosen c, unnest(range(1, copies + 1)) AS r(copy)),
made AS (SELECT s.label, {moved} FROM steps s JOIN near USING (order_item_id)
  JOIN few p ON p.nth = partners[CAST(floor(u * len(partners)) AS INT) + 1]),
totals AS (SELECT label, {totals} FROM made GROUP BY label)
SELECT label AS late_delivery_risk, large AS n, large - size AS added, {sums}
FROM (SELECT DISTINCT label, size, large FROM placed, ends) LEFT JOIN totals USING (label)"""


def model() -> dict[str, str]:
    names = [*NUMERIC, *CATEGORICAL]
    rows = f"model_rows AS MATERIALIZED (SELECT c.*, split FROM sc_clean c JOIN {_split('sc_items')} USING (order_item_id))"
    vectors = ", ".join(
        [f"{_scaled(c)} AS x_{c}" for c in NUMERIC] + [f"{_code(c)} AS x_{c}" for c in CATEGORICAL])
    vectors = f"""{rows},
model_vectors AS MATERIALIZED (SELECT order_item_id, late_delivery_risk::INT AS label, split, {vectors}
  FROM model_rows)"""
    distance = " + ".join(
        f"(a.g_{c} - b.g_{c}) * (a.g_{c} - b.g_{c})" for c in names)
    oversampled = OVERSAMPLED.format(
        distance=distance,
        grid=", ".join(f"CAST(floor(x_{c} * 1024 + 0.5) AS BIGINT) AS g_{c}" for c in names),
        moved=", ".join(f"s.x_{c} + t * (p.x_{c} - s.x_{c}) AS x_{c}" for c in names),
        totals=", ".join(f"sum(x_{c}) AS x_{c}" for c in names),
        sums=", ".join(half_up(f"coalesce(x_{c}, 0)", 3) + f" AS sum_{c}" for c in names))
    levels = [
        ("Market Risk Score", "market_risk_score"), ("Region Risk Score", "region_risk_score"),
        ("Mode Risk Score", "mode_risk_score"),
        ("Scheduled Days", "least(days_for_shipment_scheduled / 1e1, 1)"),
        ("Discount Rate", "order_item_discount_rate"),
    ]
    flags = " UNION ALL ".join(
        f"SELECT order_item_id, '{name}' AS factor, {half_up(expr, 6)} AS score, "
        f"CASE WHEN {expr} > 65e-2 THEN 'red' WHEN {expr} > 45e-2 THEN 'amber' ELSE 'green' END AS level "
        f"FROM sc_clean" for name, expr in levels
    )
    label = """CASE WHEN {p} > 7e-1 THEN '🔴 High Risk' WHEN {p} > 45e-2 THEN '🟡 Medium Risk'
  ELSE '🟢 Low Risk' END"""
    return {
        "ml_split": f"SELECT order_item_id, label AS late_delivery_risk, split FROM {SPLIT}",
        "ev_base_rates": f"""
SELECT split, COUNT(*) AS n, {mean("label")} AS late_rate FROM {SPLIT} GROUP BY split""",
        "ml_impute_num": "SELECT order_item_id, " + ", ".join(
            half_up(f"coalesce({c}::DOUBLE, (SELECT median({c}::DOUBLE) FROM sc_incoming))", 6)
            + f" AS {c}" for c in NUMERIC) + " FROM sc_incoming",
        "ml_impute_cat": "SELECT order_item_id, " + ", ".join(
            f"coalesce({c}, (SELECT {c} FROM sc_incoming WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY COUNT(*) DESC, {c} LIMIT 1)) AS {c}" for c in CATEGORICAL)
            + " FROM sc_incoming",
        "ml_scale": f"WITH {rows} SELECT order_item_id, " + ", ".join(
            f"{half_up(_scaled(c), 6)} AS {c}" for c in NUMERIC) + " FROM model_rows",
        "ml_encode": f"WITH {rows} SELECT order_item_id, " + ", ".join(
            f"{_code(c)} AS {c}_code" for c in CATEGORICAL) + " FROM model_rows",
        "ml_assemble": f"WITH {vectors} SELECT order_item_id, " + ", ".join(
            f"{half_up(f'x_{c}', 6)} AS x_{c}" for c in names)
            + " FROM model_vectors WHERE split = 'train'",
        "ml_class_weight": f"""
SELECT {half_up("CAST(COUNT(*) FILTER (label = 0) AS DOUBLE) / COUNT(*) FILTER (label = 1)", 2)}
  AS weight FROM {SPLIT} WHERE split = 'train'""",
        "ml_oversample": f"WITH {vectors}, {oversampled}",
        "ml_risk_label": f"""
SELECT risk_label, COUNT(*) AS n FROM (SELECT {label.format(p=half_up("score", 3))} AS risk_label
  FROM sc_scored) GROUP BY risk_label""",
        "ml_advice": """
SELECT order_item_id, CASE WHEN score > 7e-1 THEN 'HIGH RISK' WHEN score > 45e-2 THEN 'MEDIUM RISK'
  ELSE 'LOW RISK' END AS risk_level,
  CASE WHEN score > 7e-1 THEN 'This order has a HIGH probability of being delayed. Consider upgrading to First Class or Same Day shipping, or sourcing from a closer warehouse.'
  WHEN score > 45e-2 THEN 'This order has MODERATE delay risk. Monitor closely and have a contingency plan ready.'
  ELSE 'This order is likely to be delivered ON TIME. Continue with the current shipping plan.' END
  AS message FROM sc_scored""",
        "ml_factor_flags": flags,
    }


FLEET = f"""(SELECT COUNT(*) AS machines, {half_up(mean("CAST(health_score AS DECIMAL(18,6))"), 1)} AS mean_health,
  COUNT(*) FILTER (severity = 'CRITICAL') AS critical,
  coalesce(string_agg(machine_id, ', ' ORDER BY machine_id) FILTER (severity = 'CRITICAL'), '') AS critical_ids,
  COUNT(*) FILTER (severity = 'HIGH') AS high,
  MIN(rul_hours) FILTER (severity = 'CRITICAL') AS soonest_hours,
  first(machine_id ORDER BY failure_probability DESC, machine_id) AS worst_machine,
  first(failure_probability ORDER BY failure_probability DESC, machine_id) AS worst_probability,
  first(rul_hours ORDER BY failure_probability DESC, machine_id) AS worst_hours FROM sc_health)"""
DELAY = """(SELECT COUNT(*) AS shipments, CAST(SUM(predicted_late) AS BIGINT) AS late,
  CAST(SUM(predicted_late) AS DOUBLE) / COUNT(*) AS delay_rate FROM sc_scored)"""
REGIONS = f"""(SELECT order_region, {mean("predicted_late")} AS late_share FROM sc_scored
  GROUP BY order_region ORDER BY late_share DESC, order_region LIMIT 3)"""
RISK = f"""(SELECT {half_up(f"((SELECT {mean('CAST(failure_probability AS DECIMAL(18,6))')} FROM sc_health) * 0.5 + (SELECT {mean('predicted_late')} FROM sc_scored) * 0.5) * 100", 1)}
  AS overall_risk_score)"""
ALERTS = """(SELECT CAST((SELECT COUNT(*) FROM sc_health WHERE severity IN ('CRITICAL', 'HIGH'))
  + (SELECT SUM(predicted_late) FROM sc_scored) AS BIGINT) AS total_alerts)"""
HEADLINE = """CASE WHEN overall_risk_score >= 60
    THEN '🔴 HIGH OPERATIONAL RISK — ' || total_alerts || ' active alerts require immediate attention.'
  WHEN overall_risk_score >= 35
    THEN '🟡 ELEVATED RISK — ' || total_alerts || ' alerts detected. Monitor closely and prepare contingencies.'
  ELSE '🟢 OPERATIONS NORMAL — ' || total_alerts || ' minor alerts. System performing within expected parameters.' END"""
STATUS = "CASE WHEN critical > 0 THEN '⚠️ ALERT' ELSE '✅ STABLE' END"
SUPPLY = """CASE WHEN delay_rate > 0.4 THEN '🔴 HIGH RISK' WHEN delay_rate > 0.2 THEN '🟡 MODERATE'
  ELSE '🟢 LOW RISK' END"""


def _one_decimal(value: str) -> str:
    return f"printf('%.1f', {half_up(value, 1)})"


MAINTENANCE = f"""(SELECT '**Fleet Status: ' || {STATUS} || '**' || chr(10) || chr(10)
  || 'As of 2024-07-01 06:30, the plant is monitoring **' || machines
  || ' machines** with an average health score of **' || {_one_decimal("mean_health")} || '/100**.'
  || CASE WHEN critical > 0 THEN chr(10) || '**' || critical || ' machine(s) are in CRITICAL condition** ('
    || critical_ids || ') and require **immediate maintenance intervention** within the next '
    || soonest_hours || ' hours.' ELSE '' END
  || CASE WHEN high > 0 THEN chr(10) || 'An additional **' || high
    || ' machine(s)** are classified as HIGH risk and should be scheduled for inspection within 24–48 hours.'
    ELSE '' END
  || chr(10) || 'The most at-risk unit is **' || worst_machine || '** (failure probability: '
  || {_one_decimal("worst_probability * 100")} || '%, RUL: ' || worst_hours
  || 'h). Recommend prioritizing preventive maintenance to avoid unplanned downtime.'
  AS maintenance_summary FROM {FLEET})"""
SUPPLY_TEXT = f"""(SELECT '**Supply Chain Status: ' || {SUPPLY} || '**' || chr(10) || chr(10)
  || 'Analysis of **' || format('{{:,}}', shipments) || ' shipments** reveals a predicted delay rate of **'
  || {_one_decimal("delay_rate * 100")} || '%**, affecting approximately **' || format('{{:,}}', late)
  || ' orders**.' || chr(10) || 'The highest-risk regions are **'
  || (SELECT string_agg(order_region || ' (' || printf('%.0f', {half_up("late_share * 100", 0)}) || '%)', ', '
      ORDER BY late_share DESC, order_region) FROM {REGIONS})
  || '**, which should be prioritized for carrier renegotiation and buffer stock allocation.' || chr(10)
  || 'Recommend activating contingency routing protocols for flagged shipments and initiating supplier performance reviews for the affected regions.'
  AS supply_chain_summary FROM {DELAY})"""
DAILY = f"""SELECT 'Monday, 01 July 2024' AS date, overall_risk_score, total_alerts, maintenance_summary,
  supply_chain_summary, {HEADLINE} AS executive_headline, '2024-07-01T06:30:00' AS generated_at,
  'Template Engine' AS model_used FROM {RISK}, {ALERTS}, {MAINTENANCE}, {SUPPLY_TEXT}"""


def briefing() -> dict[str, str]:
    return {
        "br_fleet_stats": f"SELECT * FROM {FLEET}",
        "br_delay_stats": """
SELECT order_region, COUNT(*) AS shipments, CAST(SUM(predicted_late) AS BIGINT) AS late,
  CAST(SUM(predicted_late) AS DOUBLE) / COUNT(*) AS delay_rate FROM sc_scored GROUP BY order_region""",
        "br_top_regions": f"SELECT * FROM {REGIONS}",
        "br_fleet_status": f"SELECT {STATUS} AS fleet_status FROM {FLEET}",
        "br_supply_status": f"""
SELECT order_region, {SUPPLY} AS supply_status FROM (SELECT order_region,
  CAST(SUM(predicted_late) AS DOUBLE) / COUNT(*) AS delay_rate FROM sc_scored GROUP BY order_region)""",
        "br_overall_risk": f"SELECT * FROM {RISK}",
        "br_alerts": f"SELECT * FROM {ALERTS}",
        "br_headline": f"SELECT {HEADLINE} AS executive_headline FROM {RISK}, {ALERTS}",
        "br_maintenance_text": f"SELECT * FROM {MAINTENANCE}",
        "br_supply_text": f"SELECT * FROM {SUPPLY_TEXT}",
        "br_daily": DAILY,
        "sink_briefing": DAILY,
        "src_reports": """
SELECT 'briefing_' || strftime(month, '%Y%m%d') || '_0000.json' AS filename,
  strftime(month, '%A, %d %B %Y') AS date, late_share AS risk_score, late AS alerts
FROM (SELECT date_trunc('month', order_date) AS month, CAST(SUM(late_delivery_risk) AS BIGINT) AS late,
  """ + half_up("1e2 * CAST(SUM(late_delivery_risk) AS DOUBLE) / COUNT(*)", 1) + """ AS late_share
  FROM sc_orders GROUP BY 1) ORDER BY filename DESC LIMIT 20""",
    }


def statements() -> dict[str, str]:
    parts = {**metrics(), **model(), **briefing()}
    return {name: with_views(sql) for name, sql in parts.items()}
