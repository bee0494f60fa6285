"""DuckDB SQL for the registered queries, from the same sample tables.

Every statement starts from the same chain of named subqueries; DuckDB only runs
those a statement uses.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"
TIER = "member_tier_when_transact"

TABLES = f"""
order_header AS (
  SELECT o_orderkey AS id, o_custkey AS member_id, o_orderdate AS order_ts,
         CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS grand_total,
         'Outlet ' || CAST(o_orderkey % 12 AS VARCHAR) AS outlet_name,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'VVIP'
              WHEN o_orderpriority = '2-HIGH' THEN 'GOLD'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'SILVER'
              WHEN o_orderpriority = '5-LOW' AND o_orderkey % 2 = 1 THEN 'BRONZE'
              WHEN o_orderpriority = '5-LOW' THEN 'BLACK' END AS {TIER},
         CAST(o_orderkey AS VARCHAR) AS order_number
  FROM orders),
order_item AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_number, p_type AS product_group,
         p_brand AS brand_name, CAST(l_partkey AS VARCHAR) AS sku,
         l_quantity AS quantity, l_extendedprice / l_quantity AS price,
         l_extendedprice / l_quantity * (1 - l_discount) AS paid_price
  FROM lineitem JOIN part ON l_partkey = p_partkey),
recent AS (SELECT * FROM order_header WHERE order_date >= {AS_OF} - 365)
"""

LABELS = f"""
spend AS (
  SELECT member_id,
         SUM(CASE WHEN order_date >= {AS_OF} - 60 THEN grand_total ELSE 0 END)
           AS spend_last_60_days,
         SUM(CASE WHEN order_date >= {AS_OF} - 120 AND order_date < {AS_OF} - 60
                  THEN grand_total ELSE 0 END) AS spend_previous_60_days,
         AVG(CASE WHEN order_date < {AS_OF} - 120 THEN grand_total END) * 2
           AS historical_60day_baseline
  FROM recent GROUP BY member_id HAVING COUNT(*) >= 3),
labelled AS (
  SELECT *,
         CASE WHEN spend_previous_60_days > 0
               AND spend_last_60_days <= spend_previous_60_days * 0.5
              THEN 1 ELSE 0 END AS churned_vs_previous,
         CASE WHEN historical_60day_baseline > 0
               AND spend_last_60_days <= historical_60day_baseline * 0.5
              THEN 1 ELSE 0 END AS churned_vs_baseline
  FROM spend),
member_labels AS (
  SELECT *, CASE WHEN churned_vs_previous = 1 OR churned_vs_baseline = 1
                 THEN 1 ELSE 0 END AS is_churned
  FROM labelled)
"""

COHORT = f"""
periodic AS (
  SELECT member_id, {TIER} AS tier, MAX(order_date) AS last_order_date,
         MIN(order_date) AS first_order_date,
         {"".join(f'''
         SUM(CASE WHEN order_date > {AS_OF} - {n} THEN grand_total ELSE 0 END)
           AS spend_last_{n}_days,''' for n in (30, 60, 90, 120))}
         SUM(CASE WHEN order_date <= {AS_OF} - 120 THEN grand_total ELSE 0 END)
           AS historical_spend,
         COUNT(DISTINCT CASE WHEN order_date <= {AS_OF} - 120 THEN order_date END)
           AS historical_transaction_days,
         COUNT(DISTINCT id) AS total_orders, SUM(grand_total) AS total_gmv,
         COUNT(DISTINCT order_date) AS total_visits
  FROM order_header
  WHERE {TIER} IS NOT NULL AND member_id IS NOT NULL
  GROUP BY member_id, {TIER}),
averaged AS (
  SELECT *, CASE WHEN historical_transaction_days IN (0, 1) THEN NULL
                 ELSE historical_spend / historical_transaction_days END
              AS historical_daily_avg_spend
  FROM periodic),
flags AS (
  SELECT *, date_diff('day', last_order_date, {AS_OF}) > 120 AS churn_120_day_visit,
         {"".join(f'''
         spend_last_{n}_days < historical_daily_avg_spend * {n} * 0.5
           AS churn_{n}_day_spend,''' for n in (30, 60, 90, 120))}
         CAST(date_diff('day', first_order_date, last_order_date) + 1 AS INTEGER)
           AS active_days
  FROM averaged),
cohort AS (
  SELECT tier, {{measures}} FROM flags GROUP BY tier
  UNION ALL
  SELECT 'Global' AS tier, {{measures}} FROM flags)
""".replace(
    "{measures}",
    ", ".join(
        [
            f"ROUND(AVG(CASE WHEN churn_{n} THEN 1.0::DOUBLE ELSE 0.0 END), 4)"
            f" AS churn_rate_{n}"
            for n in (
                "120_day_visit",
                "30_day_spend",
                "60_day_spend",
                "90_day_spend",
                "120_day_spend",
            )
        ]
        + [
            "ROUND(AVG(total_gmv / (active_days / 30.44::DOUBLE)), 4) AS avg_monthly_spend",
            "ROUND(AVG(total_visits / (active_days / 30.44::DOUBLE)), 4)"
            " AS avg_monthly_visits",
            "ROUND(AVG(total_orders::DOUBLE / total_visits), 4) AS avg_orders_per_visit",
            "ROUND(AVG(total_gmv / total_visits), 4) AS avg_spend_per_visit",
        ]
    ),
)

FEATURES = f"""
outlet_rank AS (
  SELECT member_id, {TIER}, outlet_name,
         ROW_NUMBER() OVER (PARTITION BY member_id, {TIER}
                            ORDER BY COUNT(*) DESC, outlet_name) AS place
  FROM recent WHERE outlet_name IS NOT NULL GROUP BY member_id, {TIER}, outlet_name),
base AS (
  SELECT r.member_id,
         CAST(date_diff('day', MAX(order_date), {AS_OF}) AS INTEGER)
           AS days_since_last_order,
         CAST(date_diff('day', MIN(order_date), {AS_OF}) AS INTEGER)
           AS customer_age_days,
         COUNT(DISTINCT id) AS total_orders,
         COUNT(DISTINCT date_trunc('month', order_date)) AS active_months,
         ROUND(COUNT(DISTINCT id)::DOUBLE
               / COUNT(DISTINCT date_trunc('month', order_date)), 2)
           AS avg_orders_per_month,
         SUM(grand_total) AS total_gmv, AVG(grand_total) AS avg_order_value,
         STDDEV_SAMP(grand_total) AS order_value_std,
         SUM(CASE WHEN order_date >= {AS_OF} - 90 THEN grand_total ELSE 0 END)
           AS gmv_last_90_days,
         SUM(CASE WHEN order_date >= {AS_OF} - 180 AND order_date < {AS_OF} - 90
                  THEN grand_total ELSE 0 END) AS gmv_previous_90_days,
         COUNT(DISTINCT r.outlet_name) AS outlet_diversity,
         ANY_VALUE(o.outlet_name) AS primary_outlet, r.{TIER}
  FROM recent r LEFT JOIN outlet_rank o
    ON r.member_id = o.member_id AND r.{TIER} IS NOT DISTINCT FROM o.{TIER} AND place = 1
  GROUP BY r.member_id, r.{TIER}),
lines AS (
  SELECT member_id, i.* FROM recent JOIN order_item i USING (order_number)),
product AS (
  SELECT member_id, COUNT(DISTINCT product_group) AS product_group_diversity,
         COUNT(DISTINCT brand_name) AS brand_diversity,
         COUNT(DISTINCT sku) AS sku_diversity, AVG(quantity) AS avg_quantity_per_item,
         SUM(quantity * paid_price) / NULLIF(SUM(quantity * price), 0)
           AS avg_discount_rate,
         STRING_AGG(product_group, '|' ORDER BY product_group) AS top_product_groups
  FROM lines GROUP BY member_id),
gaps AS (
  SELECT member_id, id, order_date, grand_total,
         CAST(order_date - LAG(order_date) OVER (PARTITION BY member_id
                                            ORDER BY order_ts, id) AS INTEGER)
           AS days_between_orders,
         CAST(dayofweek(order_date) AS INTEGER) AS dow
  FROM recent),
dow_rank AS (
  SELECT member_id, dow, ROW_NUMBER() OVER (PARTITION BY member_id
                                            ORDER BY COUNT(*) DESC, dow) AS place
  FROM gaps GROUP BY member_id, dow),
behaviour AS (
  SELECT g.member_id, ANY_VALUE(d.dow) AS favorite_day_of_week,
         AVG(g.dow) AS avg_day_of_week,
         AVG(grand_total) FILTER (WHERE g.dow IN (6, 0)) AS weekend_avg_spend,
         AVG(grand_total) FILTER (WHERE g.dow BETWEEN 1 AND 5) AS weekday_avg_spend,
         AVG(days_between_orders) AS avg_days_between_orders,
         STDDEV_SAMP(days_between_orders) AS days_between_orders_std
  FROM gaps g JOIN dow_rank d ON g.member_id = d.member_id AND place = 1
  GROUP BY g.member_id),
features AS (
  SELECT b.*, product_group_diversity, brand_diversity, sku_diversity,
         avg_quantity_per_item, avg_discount_rate, top_product_groups,
         avg_days_between_orders, days_between_orders_std,
         weekend_avg_spend, weekday_avg_spend,
         CASE WHEN gmv_previous_90_days > 0
              THEN (gmv_last_90_days - gmv_previous_90_days) / gmv_previous_90_days
              ELSE 0 END AS spend_growth_rate,
         CASE WHEN customer_age_days = 0 THEN NULL
              ELSE avg_order_value / NULLIF(total_gmv / customer_age_days * 365, 0) END
           AS aov_vs_annual_spend_ratio,
         CASE WHEN days_since_last_order <= 7 THEN 'very_recent'
              WHEN days_since_last_order <= 30 THEN 'recent'
              WHEN days_since_last_order <= 60 THEN 'moderate' ELSE 'old' END
           AS recency_bucket
  FROM base b LEFT JOIN product p ON b.member_id = p.member_id
       LEFT JOIN behaviour h ON b.member_id = h.member_id),
data AS (
  SELECT is_churned, f.* FROM member_labels l
  JOIN features f ON l.member_id IS NOT DISTINCT FROM f.member_id)
"""

SEGMENTS = f"""
edges AS (
  SELECT quantile_cont(days_since_last_order::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS e,
         COUNT(*) AS n FROM data),
ranked AS (
  SELECT data.*, n,
         6 - CASE WHEN days_since_last_order <= e[1] THEN 1
                  WHEN days_since_last_order <= e[2] THEN 2
                  WHEN days_since_last_order <= e[3] THEN 3
                  WHEN days_since_last_order <= e[4] THEN 4 ELSE 5 END AS R_score,
         ROW_NUMBER() OVER (ORDER BY total_orders, member_id NULLS LAST,
                            {TIER} NULLS LAST) AS f_rank,
         ROW_NUMBER() OVER (ORDER BY total_gmv, member_id NULLS LAST,
                            {TIER} NULLS LAST) AS m_rank
  FROM data, edges),
scored AS (
  SELECT *,
         CAST(GREATEST(1, CEIL(5 * (f_rank - 1) / (n - 1)::DOUBLE)) AS INTEGER) AS F_score,
         CAST(GREATEST(1, CEIL(5 * (m_rank - 1) / (n - 1)::DOUBLE)) AS INTEGER) AS M_score
  FROM ranked),
rfm AS (SELECT *, R_score + F_score + M_score AS RFM_score FROM scored),
segments AS (
  SELECT *, CASE WHEN RFM_score >= 13 THEN 'Champions'
                 WHEN RFM_score >= 11 THEN 'Loyal Customers'
                 WHEN RFM_score >= 9 THEN 'Potential Loyalists'
                 WHEN RFM_score >= 7 THEN 'At Risk'
                 WHEN RFM_score >= 5 THEN 'Cannot Lose Them' ELSE 'Lost' END AS segment
  FROM rfm)
"""

PREDICTED = f"""
closed AS (
  SELECT member_id, {TIER}, is_churned AS actual_churn,
         GREATEST(0.0::DOUBLE, LEAST(1.0::DOUBLE, days_since_last_order / 365.0::DOUBLE))
           AS churn_probability
  FROM data),
predicted AS (
  SELECT *, CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END AS predicted_churn,
         CASE WHEN churn_probability <= 0.3 THEN 'Low Risk'
              WHEN churn_probability <= 0.7 THEN 'Medium Risk'
              WHEN churn_probability <= 1.0 THEN 'High Risk' END AS risk_segment
  FROM closed),
per_score AS (
  SELECT churn_probability AS threshold, SUM(actual_churn) AS pos,
         SUM(1 - actual_churn) AS neg
  FROM predicted GROUP BY churn_probability),
steps AS (
  SELECT threshold, pos::DOUBLE AS pos, neg::DOUBLE AS neg,
         (SUM(pos) OVER (ORDER BY threshold DESC))::DOUBLE AS tp,
         (SUM(neg) OVER (ORDER BY threshold DESC))::DOUBLE AS fp,
         (SUM(pos) OVER ())::DOUBLE AS p, (SUM(neg) OVER ())::DOUBLE AS n
  FROM per_score)
"""

PREFIX = "WITH " + ",".join([TABLES, LABELS, COHORT, FEATURES, SEGMENTS, PREDICTED])

TEXT_COLUMNS = ["primary_outlet", TIER, "top_product_groups", "recency_bucket"]
# Column -> digits to round to; None leaves the column as it is.
BASE_COLUMNS: dict[str, int | None] = {
    "member_id": None,
    "days_since_last_order": None,
    "customer_age_days": None,
    "total_orders": None,
    "active_months": None,
    "avg_orders_per_month": 4,
    "total_gmv": 4,
    "avg_order_value": 6,
    "order_value_std": 4,
    "gmv_last_90_days": 4,
    "gmv_previous_90_days": 4,
    "outlet_diversity": None,
    "primary_outlet": None,
    TIER: None,
}
MORE_COLUMNS: dict[str, int | None] = {
    "product_group_diversity": None,
    "brand_diversity": None,
    "sku_diversity": None,
    "avg_quantity_per_item": 6,
    "avg_discount_rate": 4,
    "top_product_groups": None,
    "avg_days_between_orders": 6,
    "days_between_orders_std": 4,
    "weekend_avg_spend": 6,
    "weekday_avg_spend": 6,
    "spend_growth_rate": 4,
    "aov_vs_annual_spend_ratio": 4,
    "recency_bucket": None,
}
FEATURE_COLUMNS = BASE_COLUMNS | MORE_COLUMNS
NUMERIC = [c for c in FEATURE_COLUMNS if c not in ("member_id", *TEXT_COLUMNS)]


def columns(spec: dict[str, int | None]) -> str:
    return ", ".join(c if d is None else f"ROUND({c}, {d}) AS {c}" for c, d in spec.items())


def histogram(value: str, label: str | None, source: str, digits: int, density: int) -> str:
    """Bins per class with the class's own range; limits decide on which side a value is."""
    by = label or "0"
    return f""",
    points AS (SELECT {by} AS k, {value} AS v FROM {source}),
    spread AS (SELECT k, MIN(v)::DOUBLE AS a, MAX(v)::DOUBLE AS z, COUNT(*) AS total
               FROM points GROUP BY k),
    ranges AS (SELECT k, CASE WHEN a = z THEN a - 0.5 ELSE a END AS lo,
                      CASE WHEN a = z THEN z + 0.5 ELSE z END AS hi, total FROM spread),
    guess AS (SELECT k, v, lo, (hi - lo) / 30.0::DOUBLE AS w,
                     LEAST(CAST(FLOOR((v - lo) / (hi - lo) * 30.0::DOUBLE) AS INTEGER), 29)
                       AS g
              FROM points JOIN ranges USING (k)),
    binned AS (SELECT k, CASE WHEN v < lo + g * w THEN g - 1
                              WHEN v >= lo + (g + 1) * w AND g < 29 THEN g + 1
                              ELSE g END AS bin FROM guess),
    counted AS (SELECT k, bin, COUNT(*) AS n FROM binned GROUP BY k, bin),
    slots AS (SELECT ranges.*, CAST(r.range AS INTEGER) AS bin,
                     (hi - lo) / 30.0::DOUBLE AS w FROM ranges, range(30) r)
    SELECT {f'k AS {label}, ' if label else ''} bin, ROUND(lo + bin * w, {digits}) AS bin_low,
           ROUND(lo + (bin + 1) * w, {digits}) AS bin_high, COALESCE(n, 0) AS n,
           ROUND(COALESCE(n, 0) / (total * w), {density}) AS density
    FROM slots LEFT JOIN counted USING (k, bin)"""


def grid(x: str, y: str) -> str:
    def cell(c: str) -> str:
        return f"""CASE WHEN {c} < {c}_lo + {c}_g * {c}_w THEN {c}_g - 1
                        WHEN {c} >= {c}_lo + ({c}_g + 1) * {c}_w AND {c}_g < 29
                        THEN {c}_g + 1 ELSE {c}_g END"""

    return f""",
    points AS (SELECT is_churned, {x}::DOUBLE AS x, {y}::DOUBLE AS y FROM data),
    ends AS (SELECT MIN(x) AS x_lo, MAX(x) AS x_hi, MIN(y) AS y_lo, MAX(y) AS y_hi
             FROM points),
    guess AS (SELECT *, (x_hi - x_lo) / 30.0::DOUBLE AS x_w, (y_hi - y_lo) / 30.0::DOUBLE AS y_w,
                LEAST(CAST(FLOOR((x - x_lo) / (x_hi - x_lo) * 30.0::DOUBLE) AS INTEGER), 29) AS x_g,
                LEAST(CAST(FLOOR((y - y_lo) / (y_hi - y_lo) * 30.0::DOUBLE) AS INTEGER), 29) AS y_g
              FROM points, ends)
    SELECT is_churned, {cell('x')} AS x_bin, {cell('y')} AS y_bin, COUNT(*) AS n
    FROM guess GROUP BY ALL"""


def correlation_rows(pairs: list[tuple[str, str]]) -> str:
    cells = ", ".join(
        f"{{'feature_a': '{a}', 'feature_b': '{b}', 'correlation': CORR({a}, {b})}}"
        for a, b in pairs
    )
    return f"""
    SELECT c.feature_a, c.feature_b,
           CASE WHEN isnan(c.correlation) THEN NULL ELSE ROUND(c.correlation, 6) END
             AS correlation
    FROM (SELECT UNNEST([{cells}]) AS c FROM data)"""


def every_text(select: str, source: str = "data", names: list[str] | None = None) -> str:
    """``select`` once per text column, united; {c} stands for the column."""
    return " UNION ALL ".join(
        select.replace("{c}", c).replace("{source}", source) for c in names or TEXT_COLUMNS
    )


TIER_FEATURES = {
    "tier_features_vvip": (
        "'VVIP'",
        {
            "vvip_engagement_score": "outlet_diversity * 2.0::DOUBLE"
            " + product_group_diversity * 3 + brand_diversity * 1.5::DOUBLE",
            "vvip_service_expectation": "avg_order_value / (avg_days_between_orders + 1e-6)",
            "vvip_premium_behavior": "1 / (avg_discount_rate + 0.01::DOUBLE)",
        },
    ),
    "tier_features_gold": (
        "'GOLD'",
        {
            "gold_loyalty_score": "active_months * avg_orders_per_month",
            "gold_spending_stability": "avg_order_value / (order_value_std + 1e-6)",
        },
    ),
    "tier_features_silver": (
        "'SILVER'",
        {
            "silver_growth_potential": "spend_growth_rate * brand_diversity",
            "silver_engagement_trend": "gmv_last_90_days / (gmv_previous_90_days + 1e-6)",
        },
    ),
    "tier_features_value": (
        "'BLACK', 'BRONZE'",
        {
            "price_sensitivity": "avg_discount_rate",
            "value_seeking_score": "avg_order_value * avg_discount_rate",
        },
    ),
}
INTERACTIONS = {
    "rf_interaction": "total_orders / (days_since_last_order + 1.0::DOUBLE)",
    "fm_interaction": "total_orders * total_gmv",
    "rfm_composite": "1 / (days_since_last_order + 1.0::DOUBLE) * total_orders * total_gmv",
    "purchase_regularity": "avg_days_between_orders / (days_between_orders_std + 1e-6)",
    "channel_loyalty": "total_orders / (outlet_diversity + 1.0::DOUBLE)",
}


# Digits of derived features that differ from 4.
DIGITS = {
    "vvip_service_expectation": 3,
    "gold_spending_stability": 3,
    "silver_engagement_trend": 3,
    "fm_interaction": 2,
    "rfm_composite": 0,
    "rf_interaction": 8,
}


def listed(made: dict[str, str]) -> str:
    return ", ".join(f"ROUND({e}, {DIGITS.get(n, 4)}) AS {n}" for n, e in made.items())


def prepared(source: str = "data", label: str = "m.is_churned,", fit: str = "TRUE") -> str:
    """Interactions, then median, fill and mode, then codes, for all rows of ``source``;
    medians, modes and codes come from the rows where ``fit`` holds."""
    numbers = [*NUMERIC, *INTERACTIONS]
    medians = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in numbers)
    modes = ", ".join(
        f"(SELECT {c} FROM fitted WHERE {c} IS NOT NULL GROUP BY {c}"
        f" ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS {c}"
        for c in TEXT_COLUMNS
    )
    order = f"ORDER BY m.member_id NULLS LAST, m.{TIER} NULLS LAST"

    def number(c: str) -> str:
        digits = DIGITS.get(c, FEATURE_COLUMNS.get(c) or 4)
        value = f"m.{c}"
        if c.startswith("days_"):
            value = f"LAST_VALUE(m.{c} IGNORE NULLS) OVER ({order})"
        return f"ROUND(COALESCE({value}, d.{c}, 0)::DOUBLE, {digits}) AS {c}"

    codes = ",\n".join(
        f"""code_{i} AS (SELECT v, (ROW_NUMBER() OVER (ORDER BY v) - 1)::DOUBLE AS code
            FROM (SELECT DISTINCT {c} AS v FROM fitted WHERE {c} IS NOT NULL))"""
        for i, c in enumerate(TEXT_COLUMNS)
    )
    joins = " ".join(
        f"LEFT JOIN code_{i} ON code_{i}.v = COALESCE(m.{c}, o.{c})"
        for i, c in enumerate(TEXT_COLUMNS)
    )
    encoded = ", ".join(
        f"COALESCE(code_{i}.code, 0) AS {c}_encoded" for i, c in enumerate(TEXT_COLUMNS)
    )
    return f""",
    made AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in INTERACTIONS.items())} FROM {source}),
    fitted AS (SELECT * FROM made WHERE {fit}),
    medians AS (SELECT {medians} FROM fitted),
    modes AS (SELECT {modes}),
    {codes}
    SELECT m.member_id, COALESCE(m.{TIER}, 'none') AS row_tier, {label}
           {', '.join(number(c) for c in numbers)}, {encoded}
    FROM made m CROSS JOIN medians d CROSS JOIN modes o {joins}"""


def _statements() -> dict[str, str]:
    key = f"member_id, {TIER}"
    with_label = {"is_churned": None} | FEATURE_COLUMNS
    label_columns = """member_id, ROUND(spend_last_60_days, 2) AS spend_last_60_days,
        ROUND(spend_previous_60_days, 2) AS spend_previous_60_days,
        ROUND(historical_60day_baseline, 6) AS historical_60day_baseline"""
    spend_columns = ", ".join(
        f"ROUND(spend_last_{n}_days, 2) AS spend_last_{n}_days" for n in (30, 60, 90, 120)
    )
    periodic = f"""member_id, tier, last_order_date, first_order_date, {spend_columns},
        ROUND(historical_spend, 2) AS historical_spend, historical_transaction_days,
        total_orders, ROUND(total_gmv, 2) AS total_gmv, total_visits"""
    numeric_with_label = ["is_churned", "member_id", *NUMERIC]
    sql = {
        "scan_order_header": "SELECT * FROM order_header",
        "scan_order_item": """SELECT order_number, product_group, brand_name, sku, quantity,
            price, paid_price FROM order_item""",
        "sql_passthrough": f"""SELECT outlet_name, COUNT(*) AS orders,
            ROUND(SUM(grand_total), 2) AS gmv FROM order_header
            WHERE order_date >= DATE '2000-01-01' AND {TIER} = 'GOLD' GROUP BY outlet_name""",
        "table_row_count": """SELECT 'order_header' AS table_name, COUNT(*) AS row_count
            FROM order_header UNION ALL SELECT 'order_item', COUNT(*) FROM order_item""",
        "date_range": """SELECT MIN(order_date) AS min_date, MAX(order_date) AS max_date,
            COUNT(DISTINCT order_date) AS unique_dates FROM order_header
            WHERE order_date IS NOT NULL""",
        "csv_roundtrip": f"""SELECT {key}, actual_churn, predicted_churn,
            ROUND(churn_probability, 6) AS churn_probability, risk_segment FROM predicted""",
        "append_order_items": """SELECT brand_name, COUNT(*) AS n_lines,
            SUM(quantity) AS sum_quantity FROM order_item GROUP BY brand_name""",
        "reload_churn_stats": """SELECT COUNT(*) AS total_customers,
            SUM(actual_churn)::BIGINT AS churned_customers,
            ROUND(AVG(actual_churn), 6) AS churn_rate FROM predicted""",
        "history_window": "SELECT id, member_id, order_date, grand_total FROM recent",
        "churn_labels": f"""SELECT {label_columns}, churned_vs_previous,
            churned_vs_baseline, is_churned FROM member_labels""",
        "spend_windows": f"SELECT {label_columns} FROM spend",
        "churn_stats": """SELECT COUNT(*) AS total_customers,
            SUM(is_churned)::BIGINT AS churned_customers,
            ROUND(AVG(is_churned), 6) AS churn_rate FROM member_labels""",
        "customer_periodic_spend": f"SELECT {periodic} FROM periodic",
        "cohort_flags": f"""SELECT {periodic},
            ROUND(historical_daily_avg_spend, 6) AS historical_daily_avg_spend,
            churn_120_day_visit, churn_30_day_spend, churn_60_day_spend,
            churn_90_day_spend, churn_120_day_spend, active_days FROM flags""",
        "cohort_analysis": "SELECT * FROM cohort",
        "cohort_union": "SELECT * FROM cohort",
        "base_features": f"SELECT {columns(BASE_COLUMNS)} FROM base",
        "product_features": """SELECT member_id, product_group_diversity, brand_diversity,
            sku_diversity, ROUND(avg_quantity_per_item, 6) AS avg_quantity_per_item,
            ROUND(avg_discount_rate, 6) AS avg_discount_rate, top_product_groups
            FROM product""",
        "behavioral_features": """SELECT member_id, favorite_day_of_week,
            ROUND(avg_day_of_week, 6) AS avg_day_of_week,
            ROUND(weekend_avg_spend, 6) AS weekend_avg_spend,
            ROUND(weekday_avg_spend, 6) AS weekday_avg_spend,
            ROUND(avg_days_between_orders, 6) AS avg_days_between_orders,
            ROUND(days_between_orders_std, 4) AS days_between_orders_std FROM behaviour""",
        "feature_set": f"SELECT {columns(FEATURE_COLUMNS)} FROM features",
        "final_dataset": f"SELECT {columns(with_label)} FROM data",
        "order_value_stats": f"""SELECT {key}, ROUND(avg_order_value, 6) AS avg_order_value,
            ROUND(order_value_std, 4) AS order_value_std FROM base""",
        "primary_outlet": f"SELECT {key}, primary_outlet, outlet_diversity FROM base",
        "favorite_day_of_week": """SELECT member_id, favorite_day_of_week,
            ROUND(avg_day_of_week, 6) AS avg_day_of_week FROM behaviour""",
        "weekend_weekday_spend": """SELECT member_id,
            ROUND(weekend_avg_spend, 6) AS weekend_avg_spend,
            ROUND(weekday_avg_spend, 6) AS weekday_avg_spend FROM behaviour""",
        "days_between_orders": """SELECT member_id, id, order_date, grand_total,
            days_between_orders FROM gaps""",
        "interpurchase_stats": """SELECT member_id,
            ROUND(avg_days_between_orders, 6) AS avg_days_between_orders,
            ROUND(days_between_orders_std, 4) AS days_between_orders_std FROM behaviour""",
        "product_group_list": "SELECT member_id, top_product_groups FROM product",
        "top3_product_groups": """SELECT member_id,
            STRING_AGG(product_group, '|' ORDER BY place) AS top_groups
            FROM (SELECT member_id, product_group,
                         ROW_NUMBER() OVER (PARTITION BY member_id
                                            ORDER BY COUNT(*) DESC, product_group) AS place
                  FROM lines WHERE product_group IS NOT NULL
                  GROUP BY member_id, product_group)
            WHERE place <= 3 GROUP BY member_id""",
        "recency_bucket": """SELECT recency_bucket, COUNT(*) AS n FROM features
            GROUP BY recency_bucket""",
        "summary_stats": """SELECT COUNT(DISTINCT member_id) AS unique_customers,
            COUNT(*) AS total_orders, ROUND(AVG(grand_total), 4) AS avg_order_value,
            MIN(order_date) AS first_order, MAX(order_date) AS last_order FROM recent""",
        "data_quality": """SELECT COUNT(*) AS total_orders,
            COUNT(DISTINCT member_id) AS unique_customers,
            COUNT(*) FILTER (WHERE grand_total IS NULL) AS null_amounts,
            COUNT(*) FILTER (WHERE member_id IS NULL) AS null_member_ids,
            MIN(order_date) AS earliest_date, MAX(order_date) AS latest_date
            FROM order_header""",
        "distinct_counts": """SELECT COUNT(DISTINCT id) AS orders,
            COUNT(DISTINCT member_id) AS members, COUNT(DISTINCT outlet_name) AS outlets,
            COUNT(DISTINCT date_trunc('month', order_date)) AS months,
            COUNT(DISTINCT order_date) AS days FROM order_header""",
        "missing_values": "SELECT "
        + " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in with_label)
        + " AS missing_values FROM data",
        "tier_list": f"SELECT DISTINCT {TIER} FROM data",
        "date_scalars": f"""SELECT id,
            CAST(date_diff('day', order_date, {AS_OF}) AS INTEGER) AS days_ago,
            order_date - 60 AS day_60_before,
            CAST(date_trunc('month', order_date) AS DATE) AS month_start,
            CAST(dayofweek(order_date) AS INTEGER) AS dow FROM order_header""",
        "math_scalars": """SELECT id, ROUND(LN(1 + grand_total), 4) AS log_total,
            ROUND(ABS(grand_total - 200000), 4) AS distance,
            ROUND(grand_total / NULLIF(id % 5, 0), 4) AS part,
            ROUND(grand_total * 2 + 1, 4) AS line FROM order_header""",
        "seasonality_features": """SELECT id, CAST(month(order_date) AS INTEGER) AS month,
            CASE WHEN month(order_date) IN (11, 12) THEN 1 ELSE 0 END AS is_holiday_season
            FROM order_header""",
        "recency_score": f"SELECT {key}, R_score FROM rfm",
        "frequency_score": f"SELECT {key}, F_score FROM rfm",
        "monetary_score": f"SELECT {key}, M_score FROM rfm",
        "rfm_scores": f"SELECT {key}, R_score, F_score, M_score, RFM_score FROM rfm",
        "rfm_segments": f"SELECT {key}, RFM_score, segment FROM segments",
        "segment_analysis": """SELECT segment, COUNT(is_churned) AS Customer_Count,
            ROUND(AVG(is_churned), 2) AS Churn_Rate, ROUND(AVG(total_gmv), 2) AS Avg_GMV,
            ROUND(AVG(total_orders), 2) AS Avg_Orders,
            ROUND(AVG(days_since_last_order), 2) AS Avg_Days_Since_Last
            FROM segments GROUP BY segment""",
        "segment_counts": "SELECT segment, COUNT(*) AS n FROM segments GROUP BY segment",
        "segment_churn": """SELECT segment, ROUND(AVG(is_churned), 6) AS churn_rate
            FROM segments GROUP BY segment""",
        "churn_counts": "SELECT is_churned, COUNT(*) AS n FROM data GROUP BY is_churned",
        "churn_by_recency": """SELECT recency_bucket, COUNT(is_churned) AS count,
            ROUND(AVG(is_churned), 6) AS churn_rate FROM data GROUP BY recency_bucket""",
        "churn_by_tier": f"""SELECT {TIER}, COUNT(is_churned) AS count,
            ROUND(AVG(is_churned), 6) AS churn_rate FROM data
            WHERE {TIER} IS NOT NULL GROUP BY {TIER}""",
        "recency_histogram": histogram(
            "days_since_last_order::DOUBLE", "is_churned", "data", 6, 9
        ),
        "aov_log_histogram": histogram(
            "LN(1 + avg_order_value)", "is_churned", "data", 6, 6
        ),
        "gmv_histogram": histogram("total_gmv", None, "data", 6, 12),
        "probability_histogram": histogram(
            "churn_probability", "actual_churn", "predicted", 6, 6
        ),
        "frequency_monetary_grid": grid("total_orders", "total_gmv"),
        "frequency_recency_grid": grid("total_orders", "days_since_last_order"),
        "feature_correlations": correlation_rows(
            [(a, b) for a in numeric_with_label for b in numeric_with_label]
        ),
        "top_churn_correlations": "SELECT feature_b AS feature,"
        " ABS(correlation) AS abs_correlation FROM ("
        + correlation_rows([("is_churned", b) for b in numeric_with_label])
        + ") WHERE correlation IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 15",
        "insights": """
            SELECT 'basic_stats' AS section, NULL::VARCHAR AS entity, m.metric,
                   ROUND(m.value, 3) AS value
            FROM (SELECT UNNEST([
                {'metric': 'total_customers', 'value': COUNT(*)::DOUBLE},
                {'metric': 'churn_rate', 'value': AVG(is_churned)},
                {'metric': 'avg_gmv', 'value': AVG(total_gmv)},
                {'metric': 'avg_orders', 'value': AVG(total_orders)}]) AS m FROM data)
            UNION ALL
            SELECT 'risk_factors', NULL, m.metric, ROUND(m.value, 3)
            FROM (SELECT UNNEST([
                {'metric': 'customers_inactive_60_days', 'value': COUNT(*)::DOUBLE},
                {'metric': 'churn_rate_inactive_customers', 'value': AVG(is_churned)}]) AS m
                FROM data WHERE days_since_last_order > 60)
            UNION ALL
            SELECT 'segment_analysis', segment, m.metric, ROUND(m.value, 3)
            FROM (SELECT segment, UNNEST([
                {'metric': 'count', 'value': COUNT(*)::DOUBLE},
                {'metric': 'churn_rate', 'value': AVG(is_churned)},
                {'metric': 'avg_gmv', 'value': AVG(total_gmv)}]) AS m
                FROM segments GROUP BY segment)
            UNION ALL
            SELECT 'model_performance', NULL, 'auc_score',
                   ROUND(SUM(pos * (n - fp + neg / 2)) / MAX(p * n), 3) FROM steps
            UNION ALL
            SELECT 'model_performance', NULL, m.metric, ROUND(m.value, 3)
            FROM (SELECT UNNEST([
                {'metric': 'precision', 'value': SUM(actual_churn * predicted_churn)
                                                 / SUM(predicted_churn)},
                {'metric': 'recall', 'value': SUM(actual_churn * predicted_churn)
                                              / SUM(actual_churn)}]) AS m FROM predicted)""",
        "dashboard_join": f"""SELECT member_id, {TIER}, actual_churn AS is_churned,
            ROUND(churn_probability, 6) AS churn_probability, risk_segment FROM predicted""",
        "risk_counts": """SELECT risk_segment, COUNT(*) AS n FROM predicted
            GROUP BY risk_segment""",
        "risk_segment": f"""SELECT {key}, ROUND(churn_probability, 6) AS churn_probability,
            predicted_churn, risk_segment FROM predicted""",
        "risk_segment_performance": """SELECT risk_segment, COUNT(actual_churn) AS "Count",
            ROUND(AVG(actual_churn), 3) AS Actual_Churn_Rate,
            ROUND(AVG(churn_probability), 3) AS Avg_Probability
            FROM predicted GROUP BY risk_segment""",
        "prediction_join_fanout": """SELECT s.member_id, d.is_churned AS actual_churn,
            ROUND(churn_probability, 6) AS churn_probability
            FROM data d JOIN predicted s ON d.member_id IS NOT DISTINCT FROM s.member_id""",
        "roc_auc": "SELECT ROUND(SUM(pos * (n - fp + neg / 2)) / MAX(p * n), 9) AS auc"
        " FROM steps",
        "roc_curve": """SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr,
            0.0::DOUBLE AS tpr UNION ALL
            SELECT ROUND(threshold, 9), ROUND(fp / n, 9), ROUND(tp / p, 9) FROM steps""",
        "pr_curve": """SELECT NULL::DOUBLE AS threshold, 1.0::DOUBLE AS precision,
            0.0::DOUBLE AS recall UNION ALL
            SELECT ROUND(threshold, 9), ROUND(tp / (tp + fp), 9), ROUND(tp / p, 9)
            FROM steps""",
        "average_precision": "SELECT ROUND(SUM(pos / p * (tp / (tp + fp))), 9)"
        " AS average_precision FROM steps",
        "confusion_matrix": """SELECT a.v AS actual, b.v AS predicted, COUNT(q.actual_churn) AS n
            FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) b(v)
            LEFT JOIN predicted q ON q.actual_churn = a.v AND q.predicted_churn = b.v
            GROUP BY a.v, b.v""",
        "precision_recall": """SELECT
            ROUND(SUM(actual_churn * predicted_churn) / SUM(predicted_churn), 9) AS precision,
            ROUND(SUM(actual_churn * predicted_churn) / SUM(actual_churn), 9) AS recall
            FROM predicted""",
        "interaction_features": f"SELECT {key}, {listed(INTERACTIONS)} FROM data",
        "impute_numeric": " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, ROUND(quantile_cont({c}, 0.5)::DOUBLE, 2) AS median,
            ROUND(SUM(COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM data)))::DOUBLE, 2)
              AS filled_sum FROM data"""
            for c in NUMERIC
        ),
        "ffill_days": f"""SELECT {key}, ROUND(LAST_VALUE(days_between_orders_std IGNORE NULLS)
            OVER (ORDER BY member_id NULLS LAST, {TIER} NULLS LAST), 4)
            AS days_between_orders_std FROM features""",
        "impute_categorical": every_text(
            """(SELECT '{c}' AS feature, {c} AS fill_value FROM data WHERE {c} IS NOT NULL
            GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"""
        ),
        "label_encode": every_text(
            """SELECT '{c}' AS feature, {c} AS value,
            DENSE_RANK() OVER (ORDER BY {c}) - 1 AS code
            FROM (SELECT DISTINCT {c} FROM data WHERE {c} IS NOT NULL)"""
        ),
        "prepared_features": prepared(),
        "prepared_gaps": prepared("features", ""),
        "prepared_unseen": prepared(fit=f"{TIER} = 'GOLD'"),
        "align_features": f"""SELECT {key}, ROUND(total_gmv, 4) AS total_gmv,
            0.0::DOUBLE AS avg_quantity_per_item, total_orders::DOUBLE AS total_orders,
            brand_diversity::DOUBLE AS brand_diversity FROM data""",
        "unseen_categories": f""", known AS (
            SELECT * REPLACE (COALESCE({TIER}, 'unknown') AS {TIER}) FROM data),
            held AS ({every_text(
                f"SELECT DISTINCT {TIER} AS route, '{{c}}' AS feature, {{c}} AS value "
                "FROM known WHERE {c} IS NOT NULL")}),
            routes(route) AS (VALUES ('VVIP'), ('GOLD'), ('SILVER'), ('BLACK'), ('BRONZE'),
                              ('unknown'))
            SELECT r.route, feature, value FROM routes r JOIN held h ON h.route <> r.route
            EXCEPT SELECT route, feature, value FROM held""",
        "tier_eligibility": f"""SELECT tier, sample_size, churn_count, min_samples,
            sample_size >= min_samples AND churn_count BETWEEN 1 AND sample_size - 1
              AS eligible
            FROM (SELECT COALESCE({TIER}, 'unknown') AS tier, COUNT(*) AS sample_size,
                         SUM(is_churned)::BIGINT AS churn_count,
                         (CASE COALESCE({TIER}, 'unknown') WHEN 'VVIP' THEN 50
                            WHEN 'GOLD' THEN 75 WHEN 'BLACK' THEN 150 WHEN 'BRONZE' THEN 150
                            ELSE 100 END)::BIGINT AS min_samples
                  FROM data GROUP BY {TIER})""",
        "class_weights": f"""SELECT tier, ROUND(r, 6) AS churn_ratio, w AS business_weight,
            ROUND(r * w, 6) AS positive_weight
            FROM (SELECT COALESCE({TIER}, 'unknown') AS tier,
                         (COUNT(*) - SUM(is_churned))::DOUBLE / SUM(is_churned) AS r,
                         (CASE COALESCE({TIER}, 'unknown') WHEN 'VVIP' THEN 15
                            WHEN 'GOLD' THEN 8 WHEN 'SILVER' THEN 4 WHEN 'BLACK' THEN 2
                            WHEN 'BRONZE' THEN 1.5 ELSE 1 END)::DOUBLE AS w
                  FROM data GROUP BY {TIER}
                  UNION ALL
                  SELECT 'global', (COUNT(*) - SUM(is_churned))::DOUBLE / SUM(is_churned),
                         1.0 FROM data)""",
    }
    # What is certain about trained models: which exist, their rows, churners and features.
    common = len(NUMERIC) + len(INTERACTIONS) + len(TEXT_COLUMNS)
    extra = " ".join(
        f"WHEN tier IN ({tiers}) THEN {len(made)}" for tiers, made in TIER_FEATURES.values()
    )
    figures = """COUNT(*) AS sample_size, ROUND(AVG(is_churned), 9) AS churn_rate,
        SUM(is_churned)::BIGINT AS churn_count"""
    sql["train_tier_models"] = f"""SELECT tier AS model, sample_size, churn_rate, churn_count,
        CAST({common} + CASE {extra} ELSE 0 END AS INTEGER) AS feature_count
        FROM (SELECT COALESCE({TIER}, 'unknown') AS tier, {figures} FROM data GROUP BY {TIER})
        WHERE sample_size >= CASE tier WHEN 'VVIP' THEN 50 WHEN 'GOLD' THEN 75
                WHEN 'BLACK' THEN 150 WHEN 'BRONZE' THEN 150 ELSE 100 END
          AND churn_count BETWEEN 1 AND sample_size - 1"""
    sql["train_global_model"] = f"""SELECT 'global' AS model, {figures},
        {common} AS feature_count FROM data"""
    tier_models = sql["train_tier_models"]
    all_models = f"{tier_models} UNION ALL {sql['train_global_model']}"
    used = f"""CASE WHEN COALESCE({TIER}, 'unknown') IN (SELECT model FROM ({tier_models}))
        THEN 'tier_specific' ELSE 'global_fallback' END"""
    rows = f"SELECT member_id, COALESCE({TIER}, 'unknown') AS {TIER},"
    sql["training_metrics"] = f"""SELECT *, TRUE AS auc_reproduced, TRUE AS auc_plausible
        FROM ({all_models})"""
    sql["score_members"] = f"""{rows} {used} AS model_used,
        COALESCE({TIER}, 'unknown') AS prediction_tier, TRUE AS is_probability FROM data"""
    sql["predictions"] = f"""{rows} is_churned AS actual_churn, TRUE AS class_follows,
        TRUE AS band_follows FROM data"""
    sql["score_ranking"] = f"""SELECT COALESCE({TIER}, 'unknown') AS prediction_tier,
        COUNT(*) AS rows, TRUE AS ordered FROM data GROUP BY 1"""
    sql["model_roundtrip"] = f"{rows} TRUE AS same FROM data"
    sql["feature_importance"] = f"""SELECT model, feature_count::BIGINT AS features,
        feature_count::BIGINT AS names, LEAST(feature_count, 20)::BIGINT AS first_features,
        TRUE AS first_are_best, 1.0::DOUBLE AS total, TRUE AS none_negative,
        TRUE AS first_positive FROM ({all_models})"""
    sql["model_summary"] = f"""SELECT 'model_counts' AS entity,
        'tier_specific_models' AS metric, COUNT(*)::DOUBLE AS value FROM ({tier_models})
        UNION ALL SELECT 'model_counts', 'global_fallback', 1
        UNION ALL SELECT model, 'auc', 1 FROM ({all_models})
        UNION ALL SELECT model, metric, value FROM (
          UNPIVOT (SELECT model, sample_size::DOUBLE AS sample_size, churn_rate::DOUBLE
                   AS churn_rate, churn_count::DOUBLE AS churn_count,
                   feature_count::DOUBLE AS feature_count FROM ({all_models}))
          ON COLUMNS(* EXCLUDE model) INTO NAME metric VALUE value)"""
    sql["model_comparison"] = """SELECT algorithm, COUNT(*) > 1 AS better_than_chance,
        COUNT(*) > 1 AS steady FROM data, (VALUES ('gradient_boosting'),
        ('logistic_regression'), ('random_forest')) a(algorithm) GROUP BY algorithm"""
    sql["churn_report"] = f"""SELECT 'pipeline_summary' AS section, NULL AS entity,
        'rows' AS metric, COUNT(*)::DOUBLE AS value FROM data
        UNION ALL SELECT 'pipeline_summary', NULL, 'columns', {len(FEATURE_COLUMNS) + 1}
        UNION ALL SELECT 'cohort_analysis', upper(tier), metric, value FROM (
          UNPIVOT cohort ON COLUMNS(* EXCLUDE tier) INTO NAME metric VALUE value)
        UNION ALL SELECT 'data_summary', NULL, metric, value FROM (
          UNPIVOT (SELECT COUNT(*)::DOUBLE AS total_customers,
                   SUM(is_churned)::DOUBLE AS churned_customers,
                   ROUND(AVG(is_churned), 4) AS churn_rate FROM member_labels)
          ON COLUMNS(*) INTO NAME metric VALUE value)
        UNION ALL SELECT 'model_performance', upper(model), metric, value FROM (
          UNPIVOT (SELECT model, sample_size::DOUBLE AS sample_size,
                   ROUND(churn_rate, 4) AS churn_rate FROM ({all_models}))
          ON COLUMNS(* EXCLUDE model) INTO NAME metric VALUE value)"""
    sql["whole_run"] = f"""SELECT *, TRUE AS resumed FROM (
        SELECT 'cohort' AS output, COUNT(*) AS rows, NULL::BIGINT AS churned FROM cohort
        UNION ALL SELECT 'labels', COUNT(*), SUM(is_churned)::BIGINT FROM member_labels
        UNION ALL SELECT 'dataset', COUNT(*), SUM(is_churned)::BIGINT FROM data
        UNION ALL SELECT 'predictions', COUNT(*), SUM(is_churned)::BIGINT FROM data
        UNION ALL SELECT 'report', COUNT(*), NULL FROM ({sql['churn_report']}))"""
    described = " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, CAST(row_number() OVER () AS INTEGER)
            AS ordinal_position, column_name,
            CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
              WHEN 'DATE' THEN 'date' WHEN 'VARCHAR' THEN 'string'
              WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(column_type) END AS data_type,
            TRUE AS is_nullable
            FROM (DESCRIBE SELECT * FROM {table})"""
        for table in ("order_header", "order_item")
    )
    sql["table_info"] = described
    recent = f"order_date >= {AS_OF}"
    sql["churn_labels_custom"] = f""", custom AS (
        SELECT member_id,
          SUM(CASE WHEN {recent} - 90 THEN grand_total ELSE 0 END) AS now,
          SUM(CASE WHEN {recent} - 180 AND order_date < {AS_OF} - 90
                   THEN grand_total ELSE 0 END) AS before,
          AVG(CASE WHEN order_date < {AS_OF} - 180 THEN grand_total END) * 2 AS base
        FROM recent GROUP BY member_id HAVING COUNT(*) >= 3),
        judged AS (SELECT *, (before > 0 AND now <= before * 0.3)::INTEGER AS by_before,
          COALESCE(base > 0 AND now <= base * 0.3, FALSE)::INTEGER AS by_base FROM custom)
        SELECT member_id, ROUND(now, 2) AS spend_last_60_days,
          ROUND(before, 2) AS spend_previous_60_days,
          ROUND(base, 6) AS historical_60day_baseline, by_before AS churned_vs_previous,
          by_base AS churned_vs_baseline, GREATEST(by_before, by_base) AS is_churned
        FROM judged"""
    sql["days_between_orders_repeats"] = """SELECT member_id, id, order_date, grand_total,
        CAST(order_date - LAG(order_date) OVER (PARTITION BY member_id
             ORDER BY order_ts, id) AS INTEGER) AS days_between_orders
        FROM recent JOIN order_item USING (order_number)"""
    sql["risk_segment_all_bands"] = """SELECT risk_segment, COUNT(actual_churn) AS "Count",
        ROUND(AVG(actual_churn), 3) AS Actual_Churn_Rate,
        ROUND(AVG(churn_probability), 3) AS Avg_Probability
        FROM (VALUES ('Low Risk'), ('Medium Risk'), ('High Risk')) b(risk_segment)
        LEFT JOIN (SELECT * FROM predicted WHERE risk_segment <> 'High Risk') p
          USING (risk_segment) GROUP BY risk_segment"""
    for name, (tiers, made) in TIER_FEATURES.items():
        sql[name] = (
            f"SELECT member_id, {TIER}, {listed(made)} FROM data WHERE {TIER} IN ({tiers})"
        )
    return sql


def oracle_sql() -> dict[str, str]:
    return {name: f"{PREFIX} {text}" for name, text in _statements().items()}
