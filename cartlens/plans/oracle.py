"""DuckDB SQL for every catalogue query that SQL can express.

Independent formulation: money as integer cents (``*_c``), averages and
shares as integer half-up division, the basket as the plain line self-join.
Views over the test tables: lineitem orders customer part nation.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from .catalog import FOREST, SPEND_FOREST

SEG_HV, SEG_FR, SEG_HT = 1200000, 45, 28000


def _band7(c):
    return (f"CASE WHEN {c} < 18 THEN 'Under 18' WHEN {c} < 25 THEN '18-24' WHEN {c} < 35 THEN '25-34' "
            f"WHEN {c} < 45 THEN '35-44' WHEN {c} < 55 THEN '45-54' WHEN {c} < 65 THEN '55-64' ELSE '65+' END")


def _band4(c):
    return (f"CASE WHEN {c} < 25 THEN 'Young' WHEN {c} < 35 THEN 'Youth' WHEN {c} < 55 THEN 'Middle-aged' "
            f"ELSE 'Senior' END")


def _band3(c):
    return f"CASE WHEN {c} < 35 THEN 'Under 35' WHEN {c} <= 50 THEN 'Between 35-50' ELSE 'Over 50' END"


def _order7(c):
    return (f"CAST(CASE {c} WHEN 'Under 18' THEN 1 WHEN '18-24' THEN 2 WHEN '25-34' THEN 3 WHEN '35-44' THEN 4 "
            f"WHEN '45-54' THEN 5 WHEN '55-64' THEN 6 WHEN '65+' THEN 7 END AS INTEGER)")


def _avg(sum_c, n, scale=2):
    """Half-up mean of cent sums at ``scale`` places, as double."""
    mult = 10 ** (scale - 2)
    return f"(CAST((2 * ({sum_c}) * {mult} + ({n})) // (2 * ({n})) AS DOUBLE) / {10 ** scale})"


def _money(sum_c):
    return f"(CAST({sum_c} AS DOUBLE) / 100)"


def _pct(part, whole):
    return f"(CAST((2000 * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / 10)"


SHOPPING = """
shopping AS (
  SELECT CASE WHEN l.l_orderkey % 53 = 0 AND l.l_linenumber = 2 THEN NULL
              ELSE CAST(l.l_orderkey AS VARCHAR) END AS invoice_no,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         c.c_mktsegment AS gender,
         CAST(15 + o.o_custkey % 60 AS INTEGER) AS age,
         p.p_type AS category,
         CASE WHEN l.l_orderkey % 79 = 0 AND l.l_linenumber = 1 THEN NULL
              ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
         CASE WHEN p.p_partkey % 71 = 0 THEN NULL ELSE p.p_retailprice END AS price,
         o.o_orderpriority AS payment_method,
         CASE WHEN o.o_orderkey % 97 = 0 THEN '31/02/2020' WHEN o.o_orderkey % 89 = 0 THEN 'n/a'
              ELSE strftime(o.o_orderdate, '%-d/%-m/%Y') END AS invoice_date
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

LINES = SHOPPING + f""",
parsed AS (
  SELECT *, CAST(round(price * 100) AS BIGINT) AS price_c,
         quantity * CAST(round(price * 100) AS BIGINT) AS amount_c,
         CAST(try_strptime(invoice_date, '%d/%m/%Y') AS TIMESTAMP) AS ts
  FROM shopping
),
lines AS (
  SELECT *, ts IS NOT NULL AS valid_date, CAST(month(ts) AS INTEGER) AS month,
         CAST(year(ts) AS INTEGER) AS year, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
         {_band7('age')} AS age_group
  FROM parsed
)"""

STATS = LINES + f""",
stats AS (
  SELECT customer_id, gender, age, count(invoice_no) AS transaction_count,
         sum(amount_c) AS total_c, {_money('sum(amount_c)')} AS total_spent,
         {_avg('sum(amount_c)', 'count(amount_c)')} AS avg_transaction_value
  FROM lines GROUP BY customer_id, gender, age
),
segments AS (
  SELECT customer_id, gender, age, transaction_count, total_spent, avg_transaction_value,
         CASE WHEN total_spent > {SEG_HV} THEN 'High Value Customer'
              WHEN transaction_count > {SEG_FR} THEN 'Frequent Customer'
              WHEN avg_transaction_value > {SEG_HT} THEN 'High Ticket Customer'
              ELSE 'General Customer' END AS customer_segment,
         {_band7('age')} AS age_group, total_c
  FROM stats
)"""

CATEGORIES = f"""
categories AS (
  SELECT category, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
         {_money('sum(amount_c)')} AS total_revenue, count(invoice_no) AS transaction_count,
         {_avg('sum(price_c)', 'count(price_c)')} AS avg_price
  FROM lines GROUP BY category
)"""

MONTH_CATEGORY = f"""
month_category AS (
  SELECT month, category, {_money('sum(amount_c)')} AS monthly_revenue
  FROM lines WHERE valid_date GROUP BY month, category
)"""

PREFERENCES = f"""
preferences AS (
  SELECT category, gender, age_group, sum(amount_c) AS spent_c, {_money('sum(amount_c)')} AS total_spent
  FROM lines GROUP BY category, gender, age_group
)"""

PAYMENTS = f"""
payments AS (
  SELECT payment_method, count(invoice_no) AS transaction_count,
         {_money('sum(amount_c)')} AS total_revenue,
         {_avg('sum(amount_c)', 'count(amount_c)')} AS avg_transaction_value
  FROM lines GROUP BY payment_method
)"""

PAYMENT_AGE = """
payment_age AS (
  SELECT age_group, payment_method, count(invoice_no) AS usage_count
  FROM lines GROUP BY age_group, payment_method
)"""

WEEKDAY = f"""
weekday AS (
  SELECT day_of_week, {_money('sum(amount_c)')} AS total_revenue, count(invoice_no) AS transaction_count
  FROM lines WHERE valid_date GROUP BY day_of_week
)"""

MONTHLY = f"""
monthly AS (
  SELECT month, {_money('sum(amount_c)')} AS total_revenue, count(invoice_no) AS transaction_count
  FROM lines WHERE valid_date GROUP BY month
)"""

AGE_GENDER = f"""
age_gender AS (
  SELECT age_group, gender, count(customer_id) AS customer_count,
         {_avg('sum(total_c)', 'count(total_c)')} AS avg_total_spent
  FROM segments GROUP BY age_group, gender
)"""

# value-model side: fill by type, then money, 4-way band
VLINES = SHOPPING + f""",
filled AS (
  SELECT COALESCE(invoice_no, 'unknown') AS invoice_no, COALESCE(customer_id, 'unknown') AS customer_id,
         COALESCE(gender, 'unknown') AS gender, COALESCE(age, 0) AS age,
         COALESCE(category, 'unknown') AS category, COALESCE(quantity, 0) AS quantity,
         COALESCE(price, 0) AS price, COALESCE(payment_method, 'unknown') AS payment_method,
         COALESCE(invoice_date, 'unknown') AS invoice_date
  FROM shopping
),
vlines AS (
  SELECT *, quantity * CAST(round(price * 100) AS BIGINT) AS amount_c, {_band4('age')} AS age_group
  FROM filled
),
metrics AS (
  SELECT customer_id, gender, age, age_group, count(invoice_no) AS frequency,
         {_money('sum(amount_c)')} AS monetary, {_avg('sum(amount_c)', 'count(amount_c)')} AS avg_transaction
  FROM vlines GROUP BY customer_id, gender, age, age_group
),
med AS (SELECT quantile_disc(monetary, 0.5) AS median_monetary FROM metrics),
features AS (
  SELECT metrics.*, CAST(CASE WHEN monetary > (SELECT median_monetary FROM med) THEN 1 ELSE 0 END AS INTEGER)
         AS customer_value
  FROM metrics
)"""


# wide domains: a category per customer, a payment method per priority and segment
WIDE_LINES = LINES.replace("p.p_type AS category", "CAST(o.o_custkey AS VARCHAR) AS category")
WIDE_METHODS = VLINES.replace("o.o_orderpriority AS payment_method",
                              "concat_ws(' ', o.o_orderpriority, c.c_mktsegment) AS payment_method")

SPLIT = """
split AS (
  SELECT customer_id, customer_value,
         CAST('0x' || substr(md5('42:' || customer_id), 1, 8) AS BIGINT) % 100 < 80 AS train
  FROM features
  WHERE age IS NOT NULL AND frequency IS NOT NULL AND monetary IS NOT NULL AND avg_transaction IS NOT NULL
)"""


def _consumption(key):
    return f"""WITH {VLINES}
SELECT {key}, count(invoice_no) AS transaction_count, {_money('sum(amount_c)')} AS total_spent,
       {_avg('sum(amount_c)', 'count(amount_c)')} AS avg_transaction
FROM vlines GROUP BY {key}"""


BEHAVIOUR = """
lines_per_order AS (
  SELECT l_orderkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS spend_c, sum(l_quantity) AS items,
         count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
         count(*) FILTER (WHERE l_discount >= 0.05) AS n_discounted
  FROM lineitem GROUP BY l_orderkey
),
per_customer AS (
  SELECT o_custkey, max(o_orderdate) AS last_order, sum(spend_c) AS spend_c, sum(items) AS items,
         sum(n_lines) AS n_lines, sum(n_returned) AS n_returned, sum(n_discounted) AS n_discounted
  FROM orders LEFT JOIN lines_per_order ON o_orderkey = l_orderkey GROUP BY o_custkey
),
behaviour_c AS (
  SELECT c.c_custkey AS customer_id,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST(15 + c.c_custkey % 60 AS INTEGER) AS age,
         n.n_name AS city, c.c_mktsegment AS membership_type,
         CAST(pc.spend_c AS DOUBLE) / 100 AS total_spend,
         CAST(pc.items AS INTEGER) AS items_purchased,
         1.0 + 4.0 * (CAST(pc.n_lines - pc.n_returned AS DOUBLE) / CAST(pc.n_lines AS DOUBLE)) AS average_rating,
         pc.n_discounted * 2 >= pc.n_lines AS discount_applied,
         CAST(date_diff('day', pc.last_order, (SELECT max(o_orderdate) FROM orders)) AS INTEGER)
           AS days_since_last_purchase,
         CASE WHEN pc.n_lines IS NULL OR pc.n_lines = 0 OR c.c_custkey % 50 = 0 THEN NULL
              WHEN pc.n_returned * 10 >= pc.n_lines * 4 THEN 'Unsatisfied'
              WHEN pc.n_returned * 10 >= pc.n_lines * 3 THEN 'Neutral'
              ELSE 'Satisfied' END AS satisfaction_level,
         pc.spend_c AS spend_c
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN per_customer pc ON c.c_custkey = pc.o_custkey
),
complete AS (
  SELECT * FROM behaviour_c
  WHERE customer_id IS NOT NULL AND gender IS NOT NULL AND age IS NOT NULL AND city IS NOT NULL
    AND membership_type IS NOT NULL AND total_spend IS NOT NULL AND items_purchased IS NOT NULL
    AND average_rating IS NOT NULL AND discount_applied IS NOT NULL
    AND days_since_last_purchase IS NOT NULL AND satisfaction_level IS NOT NULL
)"""

BEHAVIOUR_COLS = ("customer_id, gender, age, city, membership_type, total_spend, items_purchased, "
                  "average_rating, discount_applied, days_since_last_purchase, satisfaction_level")

SEGMENT_COLS = ("customer_id, gender, age, transaction_count, total_spent, avg_transaction_value, "
                "customer_segment, age_group")

GENDERS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _top5(n=5):
    return (f"(SELECT category FROM categories ORDER BY total_revenue DESC, category LIMIT {n})")


def _segment_share():
    return f"""SELECT customer_segment, count(*) AS count,
       {_pct('count(*)', '(SELECT count(*) FROM segments)')} AS share_pct
FROM segments GROUP BY customer_segment"""


def _payment_share():
    return f"""SELECT payment_method, transaction_count,
       {_pct('transaction_count', '(SELECT sum(transaction_count) FROM payments)')} AS share_pct,
       payment_method = (SELECT payment_method FROM payments
                         ORDER BY transaction_count DESC, payment_method LIMIT 1) AS is_largest
FROM payments"""


def forest_path(forest: str = FOREST) -> str | None:
    """Where the model queries of the active session leave a node table, if that is
    a folder that DuckDB can read; None without a session."""
    spark = SparkSession.getActiveSession()
    root = spark.conf.get("spark.checkpoint.dir", None) if spark else None
    root = re.sub("^file:(//)?(?=/)", "", root.rstrip("/")) if root else ""
    return f"{root}/cartlens/{forest}/nodes/*.parquet" if root.startswith("/") else None


def _model_sql() -> dict:
    """The model's queries over the node table that the Spark side wrote: every test row
    walks every tree from its root."""
    if forest_path() is None:
        return {}

    def walked(forest, leaf, digits):
        return f"""RECURSIVE {VLINES},
nodes AS (SELECT * FROM read_parquet('{forest_path(forest)}')),
test AS (SELECT row_number() OVER () AS r, * FROM features
         WHERE age IS NOT NULL AND frequency IS NOT NULL AND monetary IS NOT NULL AND avg_transaction IS NOT NULL
           AND CAST('0x' || substr(md5('42:' || customer_id), 1, 8) AS BIGINT) % 100 >= 80),
walk AS (
  SELECT r, tree, 0 AS node FROM test, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.r, w.tree, CASE WHEN CASE n.feature WHEN 'age' THEN t.age WHEN 'frequency' THEN t.frequency
                                WHEN 'monetary' THEN t.monetary ELSE t.avg_transaction END <= n.threshold
                           THEN n."left" ELSE n."right" END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN test t ON t.r = w.r
  WHERE n.feature IS NOT NULL),
scored AS (
  SELECT any_value(t.customer_id) AS customer_id, any_value(t.customer_value) AS customer_value,
         any_value(t.monetary) AS monetary, round(sum(n.{leaf}) / count(*), {digits}) AS {leaf}
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN test t ON t.r = w.r
  WHERE n.feature IS NULL GROUP BY w.r)"""

    scored, spend = walked(FOREST, "p_high", 9), walked(SPEND_FOREST, "prediction", 2)
    nodes = f"nodes AS (SELECT * FROM read_parquet('{forest_path()}'))"
    return {
        "value_predictions": f"""WITH {scored}
SELECT customer_id, customer_value, CAST(p_high > 0.5 AS INTEGER) AS prediction, p_high FROM scored""",
        "value_auc": f"""WITH {scored},
c AS (SELECT p_high AS s, count(*) FILTER (WHERE customer_value = 1) AS p, count(*) FILTER (WHERE customer_value = 0) AS n
      FROM scored GROUP BY p_high),
w AS (SELECT p, n, p * (2 * (sum(n) OVER (ORDER BY s) - n) + n) AS w FROM c)
SELECT 'areaUnderROC' AS metric, CAST(sum(w) AS DOUBLE) / CAST(2 * sum(p) * sum(n) AS DOUBLE) AS value FROM w""",
        "spend_regression": f"WITH {spend} SELECT customer_id, monetary, prediction FROM scored",
        "spend_errors": f"""WITH {spend},
c AS (SELECT CAST(round(monetary * 100) AS HUGEINT) AS y, CAST(round(prediction * 100) AS HUGEINT) AS p FROM scored),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum((y - p) * (y - p)) AS DOUBLE) AS sse, CAST(sum(abs(y - p)) AS DOUBLE) AS sae,
             CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(y * y) AS DOUBLE) AS syy FROM c)
SELECT CAST(n AS BIGINT) AS n, round(sqrt(sse / n) / 100, 6) AS rmse, round(sae / n / 100, 6) AS mae,
       round(1 - sse / (syy - sy * sy / n), 6) AS r2 FROM s""",
        "feature_importance": f"""WITH {nodes},
g AS (SELECT tree, feature, sum(gain * "rows") AS g FROM nodes WHERE feature IS NOT NULL GROUP BY tree, feature),
shares AS (SELECT feature, g / sum(g) OVER (PARTITION BY tree) AS share FROM g),
f AS (SELECT feature, sum(share) AS share FROM shares GROUP BY feature)
SELECT feature, round(share / sum(share) OVER (), 9) AS importance FROM f""",
    }


def oracle_sql() -> dict:
    pivot_gender = ", ".join(
        f"max(CASE WHEN gender = '{g}' THEN avg_total_spent END) AS \"{g}\"" for g in GENDERS)
    pivot_method = ", ".join(
        f"max(CASE WHEN payment_method = '{m}' THEN usage_count END) AS \"{m}\"" for m in METHODS)
    top_gender = ", ".join(
        f"CAST(COALESCE(sum(CASE WHEN gender = '{g}' THEN spent_c END), 0) AS DOUBLE) / 100 AS \"{g}\""
        for g in GENDERS)
    return _model_sql() | {
        "customer_stats": f"WITH {STATS} SELECT customer_id, gender, age, transaction_count, total_spent, "
                          f"avg_transaction_value FROM stats",
        "customer_segments": f"WITH {STATS} SELECT {SEGMENT_COLS} FROM segments",
        "segment_counts": f"WITH {STATS} SELECT customer_segment, count(*) AS count FROM segments "
                          f"GROUP BY customer_segment",
        "age_gender": f"WITH {STATS}, {AGE_GENDER} SELECT * FROM age_gender",
        "category_summary": f"WITH {LINES}, {CATEGORIES} SELECT * FROM categories",
        "month_category": f"WITH {LINES}, {MONTH_CATEGORY} SELECT * FROM month_category",
        "category_preferences": f"WITH {LINES}, {PREFERENCES} "
                                f"SELECT category, gender, age_group, total_spent FROM preferences",
        "payment_summary": f"WITH {LINES}, {PAYMENTS} SELECT * FROM payments",
        "payment_by_age": f"WITH {LINES}, {PAYMENT_AGE} SELECT * FROM payment_age",
        "weekday_sales": f"WITH {LINES}, {WEEKDAY} SELECT * FROM weekday",
        "month_sales": f"WITH {LINES}, {MONTHLY} SELECT * FROM monthly",
        "enrich_dates": f"""WITH {LINES}
SELECT invoice_no, category, CAST(quantity AS DOUBLE) AS quantity, CAST(price_c AS DOUBLE) / 100 AS price,
       CAST(amount_c AS DOUBLE) / 100 AS total_amount, strftime(ts, '%Y-%m-%d %H:%M:%S') AS invoice_date,
       valid_date, CAST(month AS DOUBLE) AS month, CAST(year AS DOUBLE) AS year,
       CAST(day_of_week AS DOUBLE) AS day_of_week, age_group FROM lines""",
        "clean_fill": f"""WITH {VLINES}
SELECT invoice_no, customer_id, gender, age, category, quantity, price, payment_method, invoice_date
FROM filled""",
        "clean_drop": f"WITH {BEHAVIOUR} SELECT {BEHAVIOUR_COLS} FROM complete",
        "profile_table": """SELECT count(*) AS row_count,
       (SELECT count(*) FROM (DESCRIBE lineitem)) AS column_count FROM lineitem""",
        "profile_nulls": f"""WITH {SHOPPING}
SELECT column_name, null_count FROM (
  SELECT 'invoice_no' AS column_name, count(*) FILTER (WHERE invoice_no IS NULL) AS null_count FROM shopping
  UNION ALL SELECT 'customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM shopping
  UNION ALL SELECT 'gender', count(*) FILTER (WHERE gender IS NULL) FROM shopping
  UNION ALL SELECT 'age', count(*) FILTER (WHERE age IS NULL) FROM shopping
  UNION ALL SELECT 'category', count(*) FILTER (WHERE category IS NULL) FROM shopping
  UNION ALL SELECT 'quantity', count(*) FILTER (WHERE quantity IS NULL) FROM shopping
  UNION ALL SELECT 'price', count(*) FILTER (WHERE price IS NULL) FROM shopping
  UNION ALL SELECT 'payment_method', count(*) FILTER (WHERE payment_method IS NULL) FROM shopping
  UNION ALL SELECT 'invoice_date', count(*) FILTER (WHERE invoice_date IS NULL) FROM shopping)""",
        "profile_ranges": f"""WITH {VLINES}
SELECT 'frequency' AS column_name, CAST(min(frequency) AS DOUBLE) AS min_value,
       CAST(max(frequency) AS DOUBLE) AS max_value FROM metrics
UNION ALL SELECT 'monetary', min(monetary), max(monetary) FROM metrics""",
        "membership_segments": f"""WITH {BEHAVIOUR}
SELECT membership_type, {_band3('age')} AS age_group, city,
       {_avg('sum(spend_c)', 'count(spend_c)', 6)} AS avg_total_spend,
       CAST(sum(items_purchased) AS BIGINT) AS items_purchased
FROM complete GROUP BY ALL""",
        "city_segments": f"""WITH {BEHAVIOUR}
SELECT city, {_avg('sum(spend_c)', 'count(spend_c)', 6)} AS avg_total_spend,
       CAST(sum(items_purchased) AS BIGINT) AS items_purchased
FROM complete GROUP BY city""",
        "at_risk_customers": f"""WITH {BEHAVIOUR}
SELECT {BEHAVIOUR_COLS} FROM complete
WHERE days_since_last_purchase > 30 AND satisfaction_level = 'Unsatisfied'""",
        "basket_pairs": f"""WITH {SHOPPING}
SELECT a.category AS category1, b.category AS category2, count(*) AS count
FROM shopping a JOIN shopping b ON a.invoice_no = b.invoice_no AND a.category <> b.category
GROUP BY a.category, b.category""",
        "consumption_gender": _consumption("gender"),
        "consumption_age": _consumption("age_group"),
        "consumption_payment": _consumption("payment_method"),
        "customer_features": f"WITH {VLINES} SELECT * FROM features",
        "median_monetary": f"WITH {VLINES} SELECT median_monetary FROM med",
        "label_value": f"WITH {VLINES} SELECT customer_id, monetary, customer_value FROM features",
        "segment_share": f"WITH {STATS} {_segment_share()}",
        "age_spending": f"""WITH {STATS}
SELECT age_group, {_order7('age_group')} AS band_order,
       {_avg('sum(total_c)', 'count(total_c)')} AS avg_total_spent
FROM segments GROUP BY age_group""",
        "payment_share": f"WITH {LINES}, {PAYMENTS} {_payment_share()}",
        "top_categories": f"""WITH {LINES}, {CATEGORIES}
SELECT category, total_revenue FROM categories ORDER BY total_revenue DESC, category LIMIT 10""",
        "top_category_trend": f"""WITH {LINES}, {CATEGORIES}, {MONTH_CATEGORY}
SELECT month, category, monthly_revenue FROM month_category WHERE category IN {_top5()}""",
        "top_category_gender": f"""WITH {LINES}, {CATEGORIES}, {PREFERENCES}
SELECT category, {top_gender} FROM preferences WHERE category IN {_top5()} GROUP BY category""",
        "top_categories_wide": f"""WITH {WIDE_LINES}, {CATEGORIES}
SELECT category, total_revenue FROM categories ORDER BY total_revenue DESC, category LIMIT 10""",
        "top_category_gender_wide": f"""WITH {WIDE_LINES}, {CATEGORIES}, {PREFERENCES}
SELECT category, {top_gender} FROM preferences WHERE category IN {_top5()} GROUP BY category""",
        "gender_value_mix_wide": f"""WITH {VLINES},
mix AS (SELECT customer_id AS gender, count(*) FILTER (WHERE customer_value = 0) AS general_count,
               count(*) FILTER (WHERE customer_value = 1) AS high_value_count
        FROM features GROUP BY customer_id)
SELECT gender, general_count, high_value_count, general_count + high_value_count AS total,
       {_pct('general_count', 'general_count + high_value_count')} AS general_pct,
       {_pct('high_value_count', 'general_count + high_value_count')} AS high_value_pct
FROM mix""",
        "payment_top5_share_wide": f"""WITH {WIDE_METHODS},
pay AS (SELECT payment_method, count(invoice_no) AS transaction_count FROM vlines GROUP BY payment_method),
top AS (SELECT * FROM pay ORDER BY transaction_count DESC, payment_method LIMIT 5)
SELECT payment_method, transaction_count,
       {_pct('transaction_count', '(SELECT sum(transaction_count) FROM top)')} AS percentage
FROM top""",
        "category_bubble": f"""WITH {LINES}, {CATEGORIES}
SELECT category, total_quantity_sold, total_revenue, avg_price, category IN {_top5()} AS is_top
FROM categories""",
        "weekday_pattern": f"""WITH {LINES}, {WEEKDAY}
SELECT day_of_week, CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
       WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday' END
       AS weekday_name, total_revenue, transaction_count FROM weekday""",
        "month_pattern": f"""WITH {LINES}, {MONTHLY}
SELECT month, monthname(make_date(2000, month, 1)) AS month_name, total_revenue, transaction_count,
       total_revenue / transaction_count AS avg_transaction FROM monthly""",
        "pivot_age_gender": f"""WITH {STATS}, {AGE_GENDER}
SELECT age_group, {pivot_gender}, {_order7('age_group')} AS band_order FROM age_gender GROUP BY age_group""",
        "pivot_age_payment": f"""WITH {LINES}, {PAYMENT_AGE}
SELECT age_group, {pivot_method}, {_order7('age_group')} AS band_order FROM payment_age GROUP BY age_group""",
        "value_counts": f"""WITH {VLINES}
SELECT customer_value,
       CASE WHEN customer_value = 1 THEN 'High value customer' ELSE 'General customer' END AS value_label,
       count(*) AS count, {_pct('count(*)', '(SELECT count(*) FROM features)')} AS percentage
FROM features GROUP BY customer_value""",
        "gender_value_mix": f"""WITH {VLINES},
mix AS (SELECT gender, count(*) FILTER (WHERE customer_value = 0) AS general_count,
               count(*) FILTER (WHERE customer_value = 1) AS high_value_count
        FROM features GROUP BY gender)
SELECT gender, general_count, high_value_count, general_count + high_value_count AS total,
       {_pct('general_count', 'general_count + high_value_count')} AS general_pct,
       {_pct('high_value_count', 'general_count + high_value_count')} AS high_value_pct
FROM mix""",
        "payment_top5_share": f"""WITH {VLINES},
pay AS (SELECT payment_method, count(invoice_no) AS transaction_count FROM vlines GROUP BY payment_method),
top AS (SELECT * FROM pay ORDER BY transaction_count DESC, payment_method LIMIT 5)
SELECT payment_method, transaction_count,
       {_pct('transaction_count', '(SELECT sum(transaction_count) FROM top)')} AS percentage
FROM top""",
        "monetary_histogram": f"""WITH {VLINES},
r AS (SELECT min(monetary) AS lo, max(monetary) AS hi FROM metrics),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30)),
b AS (SELECT CAST(CASE WHEN r.hi - r.lo = 0 THEN 0
                      ELSE least(floor((monetary - r.lo) / (r.hi - r.lo) * 30), 29) END AS INTEGER) AS bin
      FROM metrics, r WHERE monetary IS NOT NULL)
SELECT bin, r.lo + bin * (r.hi - r.lo) / 30 AS bin_start, r.lo + (bin + 1) * (r.hi - r.lo) / 30 AS bin_end,
       (SELECT count(*) FROM b WHERE b.bin = bins.bin) AS count
FROM bins, r WHERE r.lo IS NOT NULL""",
        "overview": f"""WITH {STATS}, {CATEGORIES}, {PAYMENTS}, {MONTHLY},
seg AS ({_segment_share()}), pay AS ({_payment_share()})
SELECT 'segment_share' AS panel, customer_segment AS label, share_pct AS value FROM seg
UNION ALL SELECT 'top_categories', category, total_revenue
  FROM (SELECT * FROM categories ORDER BY total_revenue DESC, category LIMIT 5)
UNION ALL SELECT 'payment_share', payment_method, share_pct FROM pay
UNION ALL SELECT 'monthly_revenue', CAST(month AS VARCHAR), total_revenue FROM monthly""",
        "profile_schema": """SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
         WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp'
         ELSE lower(column_type) END AS data_type
FROM (DESCRIBE SELECT * FROM lineitem)""",
        "sorted_positions": f"""WITH {LINES}, {CATEGORIES}
SELECT CAST(row_number() OVER (ORDER BY total_revenue DESC, category) AS INTEGER) AS place, category, total_revenue
FROM categories""",
        "exact_price": f"""WITH {SHOPPING},
m AS (SELECT category, quantity, CAST(round(price * 1000) AS BIGINT) - 5 AS price_m FROM shopping)
SELECT category, CAST(sum((2 * quantity * price_m + 10) // 20) AS DOUBLE) / 100 AS total_revenue,
       CAST((2 * sum(price_m) + 10 * count(price_m)) // (20 * count(price_m)) AS DOUBLE) / 100 AS avg_price
FROM m GROUP BY category""",
        "fixed_decimals": f"""WITH {LINES}, {CATEGORIES}
SELECT category, format('{{:,.2f}}', total_revenue) AS total_revenue, format('{{:,.2f}}', avg_price) AS avg_price
FROM categories""",
        "report_inventory": """SELECT * FROM (VALUES ('category_analysis', CAST(1 AS BIGINT), true),
  ('payment_analysis', CAST(1 AS BIGINT), true)) AS t(report, files, filled)""",
        "median_rank_error": "SELECT true AS within",
        "split_counts": f"""WITH {VLINES}, {SPLIT}
SELECT count(*) AS vectors, count(*) FILTER (WHERE train) AS train, count(*) FILTER (WHERE NOT train) AS test
FROM split""",
        "value_test_keys": f"""WITH {VLINES}, {SPLIT}
SELECT customer_id, customer_value FROM split WHERE NOT train""",
        "score_auc": f"""WITH {VLINES},
c AS (SELECT avg_transaction AS s, count(*) FILTER (WHERE customer_value = 1) AS p,
             count(*) FILTER (WHERE customer_value = 0) AS n FROM features
      WHERE avg_transaction IS NOT NULL GROUP BY avg_transaction),
w AS (SELECT p, n, p * (2 * (sum(n) OVER (ORDER BY s) - n) + n) AS w FROM c)
SELECT CAST(sum(w) AS DOUBLE) / CAST(2 * sum(p) * sum(n) AS DOUBLE) AS auc FROM w""",
        "ingest_late_files": f"WITH {SHOPPING} SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM shopping",
        "ingest_reordered": f"WITH {SHOPPING} SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM shopping",
        "ingest_wide": f"WITH {SHOPPING} SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM shopping",
        "ingest_layouts": f"""WITH {SHOPPING},
cols AS (SELECT row_number() OVER () AS k FROM (DESCRIBE SELECT * FROM shopping)),
widths AS (SELECT CASE WHEN hash_even THEN 200 ELSE 70 END AS width FROM (VALUES (true), (false)) AS t(hash_even))
SELECT CAST(width AS INTEGER) AS width, true AS seen,
       (SELECT string_agg(CAST(CASE WHEN k <= 4 THEN width - k + 1 ELSE width - 7 - k + 4 + 1 END AS VARCHAR), ' ' ORDER BY k)
        FROM cols) AS places
FROM widths""",
        "ingest_ledger": f"""WITH {SHOPPING}
SELECT coalesce(CAST(invoice_no AS BIGINT), 0) % 3 AS batch, CAST(1 AS BIGINT) AS files, count(*) + 1 AS lines,
       CAST(1 AS BIGINT) AS landed_files
FROM shopping GROUP BY 1""",
        "shopping_csv_reordered": f"WITH {SHOPPING} SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM shopping",
        "ingest_rejects": f"""WITH {SHOPPING}
SELECT count(*) AS lines, count(*) FILTER (WHERE CAST(invoice_no AS BIGINT) % 7 = 0) AS rejected FROM shopping""",
        "ingest_roundtrip": f"WITH {SHOPPING} SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM shopping",
        "run_status": f"""WITH {STATS}, {CATEGORIES},
n AS (SELECT 'customer_segments' AS report, (SELECT count(*) FROM stats) AS rows
  UNION ALL SELECT 'segment_counts', (SELECT count(DISTINCT customer_segment) FROM segments)
  UNION ALL SELECT 'age_gender_analysis', (SELECT count(*) FROM (SELECT DISTINCT age_group, gender FROM segments))
  UNION ALL SELECT 'category_analysis', (SELECT count(*) FROM categories)
  UNION ALL SELECT 'monthly_category_sales', (SELECT count(*) FROM (SELECT DISTINCT month, category FROM lines WHERE valid_date))
  UNION ALL SELECT 'category_preferences', (SELECT count(*) FROM (SELECT DISTINCT category, gender, age_group FROM lines))
  UNION ALL SELECT 'payment_analysis', -1
  UNION ALL SELECT 'payment_age_analysis', -1
  UNION ALL SELECT 'daily_sales_pattern', (SELECT count(DISTINCT day_of_week) FROM lines WHERE valid_date)
  UNION ALL SELECT 'monthly_sales_pattern', (SELECT count(DISTINCT month) FROM lines WHERE valid_date)
  UNION ALL SELECT 'category_pairs', (SELECT count(*) FROM (
    SELECT DISTINCT a.category AS c1, b.category AS c2 FROM lines a JOIN lines b
    ON a.invoice_no = b.invoice_no AND a.category <> b.category)))
SELECT report, CASE WHEN rows < 0 THEN 'skipped' ELSE 'written' END AS state, rows FROM n""",
        "report_set": f"WITH {LINES}, {CATEGORIES} SELECT * FROM categories",
        "report_roundtrip": f"WITH {STATS} SELECT {SEGMENT_COLS} FROM segments",
        "shopping_csv": f"WITH {SHOPPING} SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM shopping",
        "behaviour_csv": f"WITH {BEHAVIOUR} SELECT {BEHAVIOUR_COLS} FROM behaviour_c",
    }
