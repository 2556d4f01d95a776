from __future__ import annotations

from oracle.reports import CATEGORICAL, NUMERIC
from oracle.views import half_up, money, pct, with_views


def statements() -> dict[str, str]:
    binned = []
    for c in NUMERIC:
        cuts = (f"(SELECT quantile_cont(CAST({c} AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) "
                f"FROM sc_clean WHERE order_date < TIMESTAMP '1998-01-01')")
        binned.append(
            f"SELECT '{c}' AS feature, CAST(len(list_filter(cuts, lambda x: x < {c})) AS VARCHAR) AS bin, "
            f"order_date >= TIMESTAMP '1998-01-01' AS fresh FROM sc_clean, (SELECT {cuts} AS cuts)")
    for c in CATEGORICAL:
        binned.append(f"SELECT '{c}', {c}, order_date >= TIMESTAMP '1998-01-01' FROM sc_clean")
    counts = (
        "SELECT feature, bin, CAST(COUNT(*) FILTER (NOT fresh) AS DOUBLE) AS o, "
        f"CAST(COUNT(*) FILTER (fresh) AS DOUBLE) AS n FROM ({' UNION ALL '.join(binned)}) GROUP BY 1, 2"
    )
    shares = (
        "SELECT feature, greatest(o / SUM(o) OVER (PARTITION BY feature), 1e-6) AS o, "
        f"greatest(n / SUM(n) OVER (PARTITION BY feature), 1e-6) AS n FROM ({counts})"
    )
    sql = {
        "adv_logistics_spend": f"""
SELECT order_region, shipping_mode, COUNT(*) AS shipments, {money("SUM(sales)")} AS total_sales,
  {money('''SUM(CAST(CAST(order_item_product_price AS DECIMAL(18,4)) * order_item_quantity
    * CAST(order_item_discount_rate AS DECIMAL(9,6)) AS DECIMAL(24,6)))''')} AS total_discount,
  {pct("SUM(late_delivery_risk)", "COUNT(*)")} AS late_pct
FROM sc_orders GROUP BY order_region, shipping_mode""",
        "adv_drift": f"""
SELECT feature, {half_up("SUM((n - o) * ln(n / o))", 6)} AS psi FROM ({shares}) GROUP BY feature""",
    }
    return {name: with_views(text) for name, text in sql.items()}
