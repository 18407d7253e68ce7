"""DuckDB twins of the registered queries, over the same Parquet tables."""

from __future__ import annotations

import re

# Fixed values, written out here so that an error in the library's own can show.
COMPARED8 = (
    "recency_days",
    "order_count",
    "total_spend",
    "avg_order_value",
    "avg_delivery_delay",
    "pct_late_orders",
    "avg_review_score",
    "pct_bad_reviews",
)
CORE9 = (*COMPARED8, "category_diversity")
FULL13 = (
    "recency_days",
    "order_count",
    "total_spend",
    "avg_order_value",
    "total_freight",
    "avg_delivery_delay",
    "max_delivery_delay",
    "avg_delivery_days",
    "pct_late_orders",
    "avg_review_score",
    "min_review_score",
    "pct_bad_reviews",
    "category_diversity",
)
LINEAR_BIAS = -0.6
LINEAR_WEIGHTS = {
    "recency_days": 0.004,
    "order_count": -0.25,
    "total_spend": -0.0000005,
    "avg_order_value": 0.000005,
    "avg_delivery_delay": 0.06,
    "pct_late_orders": 0.5,
    "avg_review_score": -0.1,
    "pct_bad_reviews": 0.4,
    "category_diversity": 0.05,
}
RIVAL_SCORES = {
    "all features": LINEAR_WEIGHTS,
    "recency": {"recency_days": 0.004, "order_count": -0.25},
    "service": {"avg_delivery_delay": 0.2, "avg_review_score": -0.3, "pct_bad_reviews": 0.8},
}
# Lowest and highest accepted value of each input field, and its default.
INPUT_RULES = {
    "recency_days": (0, 365, 90),
    "order_count": (1, None, 2),
    "total_spend": (0.0, None, 150.0),
    "avg_order_value": (0.0, None, 75.0),
    "total_freight": (0.0, None, 20.0),
    "avg_delivery_delay": (-10, 30, 0),
    "max_delivery_delay": (-10, 60, 0),
    "avg_delivery_days": (1, 60, 12),
    "pct_late_orders": (0.0, 1.0, 0.2),
    "avg_review_score": (1.0, 5.0, 4.0),
    "min_review_score": (1, 5, 3),
    "pct_bad_reviews": (0.0, 1.0, 0.0),
    "category_diversity": (1, 10, 2),
}
CAMPAIGN_DAYS = {60: 0, 75: 15, 89: 15}

DAY = "86400000000.0"


def floor_days(later: str, earlier: str) -> str:
    return f"floor(date_diff('microsecond', {earlier}, {later}) / {DAY})::INT"


def score(weights: dict[str, float], bias: float = LINEAR_BIAS) -> str:
    terms = " + ".join(f"({w!r})::DOUBLE * coalesce({c}::DOUBLE, 0.0::DOUBLE)" for c, w in weights.items())
    return f"round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(({bias!r})::DOUBLE + {terms}))), 6)"


BASE = f"""
orders_v AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    o_orderdate AS placed,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate
      + to_days((5 + (o_orderkey * 13) % 23)::INT) + to_hours((o_orderkey % 24)::INT) END AS arrived,
    o_orderdate + to_days((10 + (o_orderkey * 7) % 11)::INT) AS promised
  FROM orders),
customers_v AS (
  SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id, n_name AS customer_state
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
items_v AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
    l_extendedprice::DECIMAL(18,4) AS price, (l_extendedprice * l_tax)::DECIMAL(18,4) AS freight FROM lineitem),
reviews_v AS (
  SELECT order_id, score, arrived + INTERVAL 1 DAY AS written FROM (
    SELECT o_orderkey AS order_id, (1 + (o_orderkey * 31) % 5)::INT AS score FROM orders WHERE o_orderkey % 11 <> 0
    UNION ALL
    SELECT o_orderkey, (1 + (o_orderkey * 17 + 3) % 5)::INT FROM orders WHERE o_orderkey % 13 = 0)
  JOIN orders_v USING (order_id)),
products_v AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS category FROM part),
cut AS (
  SELECT max(placed) AS max_date, max(placed) - INTERVAL 6 MONTH AS cutoff_date
  FROM orders_v WHERE order_status = 'delivered'),
delivered AS (
  SELECT o.*, c.customer_unique_id, c.customer_state, {floor_days('arrived', 'promised')} AS delay,
    {floor_days('arrived', 'placed')} AS transit
  FROM orders_v o JOIN customers_v c USING (customer_id) WHERE order_status = 'delivered'),
pre AS (SELECT * FROM delivered WHERE placed <= (SELECT cutoff_date FROM cut)),
post AS (SELECT * FROM delivered WHERE placed > (SELECT cutoff_date FROM cut)),
labels_v AS (
  SELECT customer_unique_id,
    CASE WHEN customer_unique_id IN (SELECT customer_unique_id FROM post) THEN 0 ELSE 1 END AS churned
  FROM (SELECT DISTINCT customer_unique_id FROM pre)),
rfm AS (
  SELECT customer_unique_id, max(placed) AS last_purchase, count(DISTINCT order_id) AS order_count,
    coalesce(sum(price), 0)::DOUBLE AS total_spend, sum(price)::DOUBLE / count(price)::DOUBLE AS avg_order_value,
    coalesce(sum(freight), 0)::DOUBLE AS total_freight,
    {floor_days('(SELECT cutoff_date FROM cut)', 'max(placed)')} AS recency_days
  FROM pre JOIN items_v USING (order_id) GROUP BY ALL),
delivery AS (
  SELECT customer_unique_id, avg(delay) AS avg_delivery_delay, max(delay) AS max_delivery_delay,
    avg(transit) AS avg_delivery_days,
    avg(CASE WHEN delay > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_late_orders
  FROM pre GROUP BY ALL),
delivery_asof AS (
  SELECT customer_unique_id, avg(d) AS avg_delivery_delay, max(d) AS max_delivery_delay, avg(t) AS avg_delivery_days,
    avg(CASE WHEN d > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_late_orders
  FROM (SELECT customer_unique_id, CASE WHEN arrived <= cutoff_date THEN delay END AS d,
          CASE WHEN arrived <= cutoff_date THEN transit END AS t FROM pre, cut) GROUP BY ALL),
review_agg AS (
  SELECT customer_unique_id, avg(score) AS avg_review_score, min(score) AS min_review_score,
    avg(CASE WHEN score <= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_bad_reviews
  FROM pre JOIN reviews_v USING (order_id) GROUP BY ALL),
review_asof AS (
  SELECT customer_unique_id, avg(score) AS avg_review_score, min(score) AS min_review_score,
    avg(CASE WHEN score <= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_bad_reviews
  FROM pre JOIN reviews_v USING (order_id) WHERE written <= (SELECT cutoff_date FROM cut) GROUP BY ALL),
diversity AS (
  SELECT customer_unique_id, count(DISTINCT category) AS category_diversity
  FROM pre JOIN items_v USING (order_id) JOIN products_v USING (product_id) GROUP BY ALL)
"""


def wide(delivery: str = "delivery", reviews: str = "review_agg", repaired: bool = False) -> str:
    score_fill = "coalesce(avg_review_score, 3.0::DOUBLE)" if repaired else "avg_review_score"
    return f"""
  SELECT customer_unique_id, recency_days, order_count, total_spend, avg_order_value, total_freight,
    coalesce(avg_delivery_delay, 0.0::DOUBLE) AS avg_delivery_delay,
    coalesce(max_delivery_delay::DOUBLE, 0.0::DOUBLE) AS max_delivery_delay,
    coalesce(avg_delivery_days, 3.0::DOUBLE) AS avg_delivery_days, pct_late_orders,
    {score_fill} AS avg_review_score, coalesce(min_review_score::DOUBLE, 3.0::DOUBLE) AS min_review_score,
    coalesce(pct_bad_reviews, 0.0::DOUBLE) AS pct_bad_reviews,
    coalesce(category_diversity, 1) AS category_diversity, last_purchase, churned
  FROM rfm LEFT JOIN {delivery} USING (customer_unique_id) LEFT JOIN {reviews} USING (customer_unique_id)
    JOIN labels_v USING (customer_unique_id) LEFT JOIN diversity USING (customer_unique_id)"""


TIER = """CASE WHEN churn_probability > 0 AND churn_probability <= 0.3 THEN 'Low risk'
  WHEN churn_probability > 0.3 AND churn_probability <= 0.6 THEN 'Medium risk'
  WHEN churn_probability > 0.6 AND churn_probability <= 1.0 THEN 'High risk' END"""
RULE_TIER = """CASE WHEN churn_probability >= 0.6 THEN 'High risk' WHEN churn_probability >= 0.3 THEN 'Medium risk'
  ELSE 'Low risk' END"""

MATRIX_COLUMNS = ", ".join(f"coalesce({c}::DOUBLE, 0.0::DOUBLE) AS {c}" for c in CORE9)
UNIT = "(('0x' || substr(md5('{seed}|' || {key}::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"
DIGEST = "md5('{seed}|' || customer_unique_id::VARCHAR)"

FEATURES = BASE + f""",
features AS ({wide()}),
scored AS (SELECT *, {score(LINEAR_WEIGHTS)} AS churn_probability FROM features),
tiered AS (SELECT *, {TIER} AS risk_tier FROM scored),
tiers AS (SELECT unnest(['Low risk', 'Medium risk', 'High risk']) AS risk_tier),
matrix AS (SELECT customer_unique_id, churned AS label, {MATRIX_COLUMNS} FROM features),
class_sizes AS (SELECT label, count(*) AS n FROM matrix GROUP BY label),
class_quota AS (
  SELECT label, n, ceil((sum(n) OVER ())::DOUBLE * 0.2::DOUBLE) AS wanted,
    ceil((sum(n) OVER ())::DOUBLE * 0.2::DOUBLE) * n / (sum(n) OVER ())::DOUBLE AS quota FROM class_sizes),
class_test AS (
  SELECT label, n, (floor(quota) + CASE WHEN row_number() OVER (ORDER BY quota - floor(quota) DESC, label)
    <= wanted - sum(floor(quota)) OVER () THEN 1 ELSE 0 END)::BIGINT AS n_test FROM class_quota),
split AS (
  SELECT m.*, CASE WHEN row_number() OVER (PARTITION BY label
    ORDER BY {DIGEST.format(seed=42)}, customer_unique_id) <= n_test THEN 'test' ELSE 'train' END AS split
  FROM matrix m JOIN class_test USING (label)),
held_out AS (SELECT * FROM split WHERE split = 'test')
"""

HELD_OUT = FEATURES + ",\nevaluated AS (" + "\n  UNION ALL ".join(
    f"SELECT '{name}' AS model, customer_unique_id, label, {score(weights)} AS probability FROM held_out"
    for name, weights in RIVAL_SCORES.items()
) + "),\none AS (SELECT * FROM evaluated WHERE model = 'all features')"


def auc_table(source: str) -> str:
    """Rank-sum form, independent of the running-total form used in Spark."""
    return f"""
  SELECT model, positives, negatives, round((rank_sum - positives * (positives + 1) / 2.0::DOUBLE)
    / (positives::DOUBLE * negatives), 6) AS roc_auc
  FROM (SELECT model, sum(label)::BIGINT AS positives, (count(*) - sum(label))::BIGINT AS negatives,
          sum(CASE WHEN label = 1 THEN mid_rank ELSE 0 END)::DOUBLE AS rank_sum
        FROM (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY probability)
                + (count(*) OVER (PARTITION BY model, probability) - 1) / 2.0::DOUBLE AS mid_rank FROM {source})
        GROUP BY model)"""


def curve(source: str) -> str:
    return f"""
  SELECT model, probability AS threshold, tp, fp, all_pos, all_neg FROM (
    SELECT model, probability, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
      sum(pos) OVER (PARTITION BY model) AS all_pos, sum(neg) OVER (PARTITION BY model) AS all_neg
    FROM (SELECT model, probability, sum(label) AS pos, sum(1 - label) AS neg FROM {source} GROUP BY ALL)
    WINDOW w AS (PARTITION BY model ORDER BY probability DESC))"""


def report(source: str, threshold: float) -> str:
    def ratio(top: str, bottom: str) -> str:
        return f"coalesce(({top})::DOUBLE / nullif({bottom}, 0)::DOUBLE, 0.0::DOUBLE)"

    return f"""
  cells AS (
    SELECT model, sum(CASE WHEN label = 1 AND p = 1 THEN 1 ELSE 0 END)::BIGINT AS tp,
      sum(CASE WHEN label = 0 AND p = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
      sum(CASE WHEN label = 1 AND p = 0 THEN 1 ELSE 0 END)::BIGINT AS fn,
      sum(CASE WHEN label = 0 AND p = 0 THEN 1 ELSE 0 END)::BIGINT AS tn
    FROM (SELECT *, CASE WHEN probability >= {threshold} THEN 1 ELSE 0 END AS p FROM {source}) GROUP BY model),
  per_class AS (
    SELECT model, '0' AS class_name, {ratio('tn', 'tn + fn')} AS pr, {ratio('tn', 'tn + fp')} AS re,
      tn + fp AS support FROM cells
    UNION ALL
    SELECT model, '1', {ratio('tp', 'tp + fp')}, {ratio('tp', 'tp + fn')}, tp + fn FROM cells),
  with_f1 AS (SELECT *, {ratio('2 * pr * re', 'pr + re')} AS f1 FROM per_class),
  lines AS (
    SELECT model, class_name, pr, re, f1, support FROM with_f1
    UNION ALL
    SELECT model, 'accuracy', a, a, a, t FROM (
      SELECT model, {ratio('tp + tn', 'tp + tn + fp + fn')} AS a, tp + tn + fp + fn AS t FROM cells)
    UNION ALL
    SELECT model, 'macro avg', avg(pr), avg(re), avg(f1), sum(support)::BIGINT FROM with_f1 GROUP BY model
    UNION ALL
    SELECT model, 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support)::BIGINT FROM with_f1 GROUP BY model),
  report AS (
    SELECT model, class_name, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1_score,
      support FROM lines)"""


def segment_rates(column: str, edges: list[float], labels: list[str], lowest: str = ">") -> str:
    cases = " ".join(
        f"WHEN {column} {lowest if i == 0 else '>'} {low} AND {column} <= {high} THEN {i}"
        for i, (low, high) in enumerate(zip(edges[:-1], edges[1:]))
    )
    names = ", ".join(f"'{label}'" for label in labels)
    return f"""
  SELECT i AS ordinal, label, coalesce(customers, 0) AS customers, churn_rate
  FROM (SELECT unnest(range({len(labels)}))::INT AS i, unnest([{names}]) AS label)
  LEFT JOIN (SELECT CASE {cases} END AS i, count(*) AS customers, round(avg(churned), 6) AS churn_rate
             FROM features GROUP BY ALL) USING (i)"""


DELAY_RATES = segment_rates(
    "avg_delivery_delay", [-99, 0, 3, 7, 99], ["On time", "1-3 days late", "4-7 days late", "7+ days late"]
)
REVIEW_RATES = segment_rates(
    "avg_review_score", [0, 2, 3, 4, 5.01], ["1-2 stars", "3 stars", "4 stars", "5 stars"]
)
RECENCY_RATES = segment_rates(
    "recency_days",
    [0, 60, 90, 120, "'inf'::DOUBLE"],
    ["0-60 days", "60-90 days", "90-120 days", "120+ days"],
    lowest=">=",
)

DIGITS = {"total_spend": 2, "total_freight": 4}
WHOLE = ("recency_days", "order_count", "category_diversity")


def rounded(columns: tuple[str, ...] = FULL13) -> str:
    return ", ".join(c if c in WHOLE else f"round({c}, {DIGITS.get(c, 6)}) AS {c}" for c in columns)


FEATURE_LIST = f"customer_unique_id, {rounded()}, last_purchase, churned"


def histogram(source: str, groups: str, value: str) -> str:
    keys = f"{groups}, " if groups else ""
    using = f"USING ({groups}, bin)" if groups else "USING (bin)"
    bounds = f"JOIN bounds USING ({groups})" if groups else ", bounds"
    grouped = f"GROUP BY {groups}" if groups else ""
    return f"""
  extremes AS (
    SELECT {keys}min({value})::DOUBLE AS a, max({value})::DOUBLE AS b, count(*) AS total FROM {source}
    WHERE {value} IS NOT NULL {grouped}),
  bounds AS (
    SELECT {keys}CASE WHEN a = b THEN a - 0.5::DOUBLE ELSE a END AS lo,
      CASE WHEN a = b THEN b + 0.5::DOUBLE ELSE b END AS hi, total FROM extremes),
  placed AS (
    SELECT {keys}least(floor(({value} - lo) / ((hi - lo) / 40)), 39)::INT AS bin, count(*) AS n
    FROM {source} {bounds} WHERE {value} IS NOT NULL GROUP BY ALL),
  frame AS (SELECT {keys}lo, hi, total, unnest(range(40))::INT AS bin FROM bounds)
  SELECT {keys}bin, round(lo + bin * ((hi - lo) / 40), 6) AS bin_start, coalesce(n, 0) AS rows,
    round(coalesce(n, 0) / (total * ((hi - lo) / 40)), 12) AS density
  FROM frame LEFT JOIN placed {using}"""


def long(source: str, columns: tuple[str, ...], keep: str) -> str:
    return "\n  UNION ALL ".join(f"SELECT {keep}, '{c}' AS feature, {c}::DOUBLE AS value FROM {source}" for c in columns)


def profile(name: str, source: str, columns: list[str]) -> str:
    """Columns are ``name TYPE``, or ``name:source TYPE`` where the source calls them otherwise."""
    parts = []
    for column in columns:
        names, kind = column.split(" ")
        shown, actual = names.split(":") if ":" in names else (names, names)
        parts.append(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, {len(columns)} AS column_count, "
            f"'{shown}' AS column_name, '{kind}' AS data_type, count(*) - count({actual}) AS null_count FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


def correlations() -> str:
    columns = (*COMPARED8, "churned")
    cells = []
    for a in columns:
        for b in columns:
            if a == b:
                cells.append(
                    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
                    f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END AS correlation FROM features"
                )
            else:
                cells.append(f"SELECT '{a}', '{b}', round(corr({a}, {b}), 6) FROM features")
    return "\nUNION ALL ".join(cells)


def shap_rows() -> str:
    parts = [
        f"SELECT customer_unique_id, '{c}' AS feature, {c} AS value, "
        f"({w!r})::DOUBLE * ({c} - (SELECT avg({c}) FROM matrix)) AS shap FROM matrix"
        for c, w in LINEAR_WEIGHTS.items()
    ]
    return "shap AS (" + "\n  UNION ALL ".join(parts) + ")"


def range_checks() -> str:
    parts = []
    for feature, (low, high, _) in INPUT_RULES.items():
        inside = f"{feature} >= {low}" + ("" if high is None else f" AND {feature} <= {high}")
        top = "NULL::DOUBLE" if high is None else f"{float(high)}::DOUBLE"
        parts.append(
            f"SELECT customer_unique_id, '{feature}' AS feature, round({feature}::DOUBLE, 6) AS value, "
            f"{float(low)}::DOUBLE AS min_allowed, {top} AS max_allowed "
            f"FROM features WHERE NOT coalesce({inside}, false)"
        )
    return "\nUNION ALL ".join(parts)


def two_rates(exposed: str, baseline: str) -> str:
    return f"""
  SELECT n1 AS exposed_customers, n0 AS baseline_customers, round(r1, 6) AS exposed_rate,
    round(r0, 6) AS baseline_rate, round(r1 / nullif(r0, 0), 6) AS churn_ratio
  FROM (SELECT count(*) FILTER ({exposed}) AS n1, count(*) FILTER ({baseline}) AS n0,
          avg(churned) FILTER ({exposed}) AS r1, avg(churned) FILTER ({baseline}) AS r0 FROM features)"""


def by_tier(measures: str, outer: str) -> str:
    return f"""SELECT risk_tier, {outer} FROM tiers LEFT JOIN (
    SELECT risk_tier, {measures} FROM tiered WHERE risk_tier IS NOT NULL GROUP BY risk_tier) USING (risk_tier)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


HIGH = "risk_tier = 'High risk'"
ORDER_COLUMNS = [
    "order_id BIGINT",
    "customer_id BIGINT",
    "order_status VARCHAR",
    "order_purchase_timestamp:placed TIMESTAMP",
    "order_delivered_customer_date:arrived TIMESTAMP",
    "order_estimated_delivery_date:promised TIMESTAMP",
]
ITEM_COLUMNS = [
    "order_id BIGINT",
    "product_id BIGINT",
    "seller_id BIGINT",
    "price DOUBLE",
    "freight_value:freight DOUBLE",
]
REVIEW_COLUMNS = ["order_id BIGINT", "review_score:score INTEGER", "review_creation_date:written TIMESTAMP"]
FEATURE_TYPES = {"recency_days": "INTEGER", "order_count": "BIGINT", "category_diversity": "BIGINT", "churned": "INTEGER"}
DELIVERY_LIST = """customer_unique_id, round(avg_delivery_delay, 6) AS avg_delivery_delay, max_delivery_delay,
  round(avg_delivery_days, 6) AS avg_delivery_days, round(pct_late_orders, 6) AS pct_late_orders"""
CAMPAIGN = ", ".join(f"({i}, {d}, {off})" for i, (d, off) in enumerate(CAMPAIGN_DAYS.items(), start=1))

ORACLE: dict[str, str] = {
    "table_profile": with_(
        BASE,
        "\nUNION ALL ".join(
            [
                profile("orders", "orders_v", ORDER_COLUMNS),
                profile("order_items", "items_v", ITEM_COLUMNS),
                profile("order_reviews", "reviews_v", REVIEW_COLUMNS),
            ]
        ),
    ),
    "csv_round_trip": with_(
        BASE,
        """SELECT 'orders' AS table_name, order_status AS part, count(*) AS rows, count(arrived) AS filled,
          max(placed) AS last_moment FROM orders_v GROUP BY order_status
        UNION ALL SELECT 'order_items', 'all', count(*), count(price), NULL::TIMESTAMP FROM items_v
        UNION ALL SELECT 'order_reviews', score::VARCHAR, count(*), count(written), max(written) FROM reviews_v GROUP BY score""",
    ),
    "delivered_ratio": with_(
        BASE,
        """SELECT count(*) FILTER (order_status = 'delivered') AS delivered_orders, count(*) AS total_orders,
        round(count(*) FILTER (order_status = 'delivered') / count(*), 6) AS delivered_share FROM orders_v""",
    ),
    "cutoff_date": with_(
        BASE,
        """SELECT max_date, cutoff_date, max_date::DATE::VARCHAR AS data_until, cutoff_date::DATE::VARCHAR AS cutoff_day
        FROM cut""",
    ),
    "pre_cutoff_orders": with_(
        BASE, "SELECT order_id, customer_unique_id, placed AS order_purchase_timestamp FROM pre"
    ),
    "post_cutoff_orders": with_(
        BASE, "SELECT order_id, customer_unique_id, placed AS order_purchase_timestamp FROM post"
    ),
    "churn_labels": with_(BASE, "SELECT customer_unique_id, churned FROM labels_v"),
    "churn_labels_per_customer": with_(
        BASE,
        """SELECT customer_unique_id, CASE WHEN EXISTS (SELECT 1 FROM delivered d
          WHERE d.customer_unique_id = l.customer_unique_id AND d.placed > l.last
            AND d.placed <= l.last + INTERVAL 6 MONTH) THEN 0 ELSE 1 END AS churned
        FROM (SELECT customer_unique_id, max(placed) AS last FROM pre GROUP BY ALL) l""",
    ),
    "active_and_churned": with_(
        BASE,
        """SELECT customer_unique_id, 'active' AS group_name FROM (
          SELECT customer_unique_id FROM pre INTERSECT SELECT customer_unique_id FROM post)
        UNION ALL SELECT customer_unique_id, 'churned' FROM (
          SELECT customer_unique_id FROM pre EXCEPT SELECT customer_unique_id FROM post)""",
    ),
    "churn_rate": with_(
        BASE,
        """SELECT count(*) AS customers, sum(churned)::BIGINT AS churned_customers, round(avg(churned), 6) AS churn_rate,
        printf('%.1f%%', round(avg(churned), 6) * 100) AS churn_rate_text FROM labels_v""",
    ),
    "order_delays": with_(
        BASE, "SELECT order_id, delay AS delivery_delay_days, transit AS actual_delivery_days FROM delivered"
    ),
    "rfm_features": with_(
        BASE,
        f"""SELECT customer_unique_id, last_purchase,
        {rounded(('order_count', 'total_spend', 'avg_order_value', 'total_freight', 'recency_days'))} FROM rfm""",
    ),
    "delivery_features": with_(BASE, f"SELECT {DELIVERY_LIST} FROM delivery"),
    "delivery_features_asof": with_(BASE, f"SELECT {DELIVERY_LIST} FROM delivery_asof"),
    "review_features": with_(
        BASE,
        """SELECT customer_unique_id, round(avg_review_score, 6) AS avg_review_score, min_review_score,
        round(pct_bad_reviews, 6) AS pct_bad_reviews FROM review_agg""",
    ),
    "category_diversity": with_(BASE, "SELECT customer_unique_id, category_diversity FROM diversity"),
    "feature_table": with_(FEATURES, f"SELECT {FEATURE_LIST} FROM features"),
    "feature_table_repaired": with_(BASE, f"SELECT {FEATURE_LIST} FROM ({wide(repaired=True)})"),
    "feature_table_asof": with_(BASE, f"SELECT {FEATURE_LIST} FROM ({wide('delivery_asof', 'review_asof')})"),
    "feature_profile": with_(FEATURES, profile("features", "features", [f"{c} {FEATURE_TYPES.get(c, 'DOUBLE')}" for c in (*FULL13, "churned")])),
    "class_balance": with_(
        FEATURES,
        """SELECT churned, CASE churned WHEN 1 THEN 'Churned' ELSE 'Retained' END AS class_label, count(*) AS rows,
        round(count(*) / sum(count(*)) OVER (), 6) AS share FROM features GROUP BY churned""",
    ),
    "feature_means_by_class": with_(
        FEATURES + f", long AS ({long('features', COMPARED8, 'churned')})",
        """SELECT feature, round(avg(value) FILTER (churned = 0), 2) AS retained_mean,
        round(avg(value) FILTER (churned = 1), 2) AS churned_mean FROM long GROUP BY feature""",
    ),
    "correlation_matrix": with_(FEATURES, correlations()),
    "feature_histogram": with_(
        FEATURES + f", long AS ({long('features', COMPARED8, 'churned')}),", histogram("long", "feature, churned", "value")
    ).replace("),,", "),"),
    "stratified_split": with_(FEATURES, "SELECT customer_unique_id, label, split FROM split"),
    "cross_validation_folds": with_(
        FEATURES,
        f"""SELECT customer_unique_id, label, ((row_number() OVER (PARTITION BY label
          ORDER BY {DIGEST.format(seed=43)}, customer_unique_id) - 1) % 5)::INT AS fold FROM matrix""",
    ),
    "scaled_features": with_(
        FEATURES
        + ", stats AS (SELECT "
        + ", ".join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS {c}_s" for c in CORE9)
        + " FROM split WHERE split = 'train')",
        "SELECT customer_unique_id, "
        + ", ".join(f"round(({c} - {c}_m) / {c}_s, 6) AS {c}" for c in CORE9)
        + " FROM held_out, stats",
    ),
    "linear_score": with_(FEATURES, "SELECT customer_unique_id, churned, churn_probability FROM scored"),
    "classification_report": with_(HELD_OUT + "," + report("one", 0.5), "SELECT * FROM report"),
    "threshold_report": with_(HELD_OUT + "," + report("one", 0.3), "SELECT * FROM report"),
    "threshold_predictions": with_(
        HELD_OUT,
        "SELECT customer_unique_id, label, CASE WHEN probability >= 0.3 THEN 1 ELSE 0 END AS prediction FROM one",
    ),
    "roc_auc": with_(HELD_OUT, auc_table("one")),
    "roc_curve": with_(
        HELD_OUT + f", curve AS ({curve('one')})",
        """SELECT model, threshold, round(fp / all_neg::DOUBLE, 6) AS fpr, round(tp / all_pos::DOUBLE, 6) AS tpr FROM curve
        UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM curve
        UNION ALL SELECT 'random guess', NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
        UNION ALL SELECT 'random guess', NULL::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE""",
    ),
    "roc_curve_corners": with_(
        HELD_OUT
        + f""", curve AS ({curve('one')}),
        turns AS (SELECT *, tp - lag(tp) OVER w AS t0, lead(tp) OVER w - tp AS t1, fp - lag(fp) OVER w AS f0,
          lead(fp) OVER w - fp AS f1 FROM curve WINDOW w AS (PARTITION BY model ORDER BY threshold DESC))""",
        """SELECT model, threshold, round(fp / all_neg::DOUBLE, 6) AS fpr, round(tp / all_pos::DOUBLE, 6) AS tpr
        FROM turns WHERE t0 IS NULL OR t1 IS NULL OR t0 <> t1 OR f0 <> f1
        UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM curve""",
    ),
    "pr_curve": with_(
        HELD_OUT + f", curve AS ({curve('one')})",
        """SELECT model, threshold, round(tp / (tp + fp)::DOUBLE, 6) AS "precision", round(tp / all_pos::DOUBLE, 6) AS recall
        FROM curve UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM curve""",
    ),
    "model_comparison": with_(
        HELD_OUT + f", areas AS ({auc_table('evaluated')})," + report("evaluated", 0.5),
        """SELECT model, roc_auc, "precision", recall, f1_score,
          row_number() OVER (ORDER BY roc_auc DESC, model)::INT AS position
        FROM areas JOIN report USING (model) WHERE class_name = '1'""",
    ),
    "linear_shap": with_(
        FEATURES + ", " + shap_rows(),
        "SELECT customer_unique_id, feature, round(value, 6) AS value, "
        "round(shap, 6) AS shap FROM shap",
    ),
    "shap_importance": with_(
        FEATURES + ", " + shap_rows(),
        "SELECT feature, round(avg(abs(shap)), 6) AS mean_abs_shap FROM shap GROUP BY feature",
    ),
    "shap_summary": with_(
        FEATURES
        + ", "
        + shap_rows()
        + """, ends AS (SELECT feature, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b,
          quantile_cont(value, 0.01) AS a1, quantile_cont(value, 0.99) AS b1, min(value) AS a2, max(value) AS b2
          FROM shap GROUP BY feature),
        picked AS (SELECT feature, CASE WHEN a < b THEN a WHEN a1 < b1 THEN a1 ELSE a2 END AS lo,
          CASE WHEN a < b THEN b WHEN a1 < b1 THEN b1 ELSE b2 END AS hi FROM ends)""",
        """SELECT customer_unique_id, feature, round(value, 6) AS value, round(shap, 6) AS shap,
          round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce((value - lo) / nullif(hi - lo, 0), 0.5::DOUBLE))), 6)
            AS colour
        FROM shap JOIN picked USING (feature)""",
    ),
    "delay_segment_churn": with_(
        FEATURES, f"SELECT ordinal, label AS segment, customers, churn_rate FROM ({DELAY_RATES})"
    ),
    "review_segment_churn": with_(
        FEATURES, f"SELECT ordinal, label AS segment, customers, churn_rate FROM ({REVIEW_RATES})"
    ),
    "segment_dashboard": with_(
        FEATURES,
        f"""SELECT 'delivery delay' AS segment_kind, ordinal, label AS segment, customers, churn_rate FROM ({DELAY_RATES})
        UNION ALL SELECT 'review score', ordinal, label, customers, churn_rate FROM ({REVIEW_RATES})""",
    ),
    "recency_band_churn": with_(
        FEATURES, f"SELECT ordinal, label AS recency_band, customers, churn_rate FROM ({RECENCY_RATES})"
    ),
    "risk_tiers": with_(
        FEATURES, f"SELECT customer_unique_id, churn_probability, risk_tier, {RULE_TIER} AS rule_tier FROM tiered"
    ),
    "rule_tier_actions": with_(
        FEATURES,
        f"""SELECT customer_unique_id, risk_tier, CASE risk_tier
          WHEN 'High risk' THEN 'immediate retention action recommended'
          WHEN 'Medium risk' THEN 'include in next reactivation campaign'
          ELSE 'no immediate action needed' END AS recommended_action
        FROM (SELECT customer_unique_id, {RULE_TIER} AS risk_tier FROM scored)""",
    ),
    "tier_counts": with_(FEATURES, by_tier("count(*) AS n", "coalesce(n, 0) AS customers")),
    "tier_spend": with_(FEATURES, by_tier("round(avg(total_spend), 4) AS avg_spend", "avg_spend")),
    "tier_kpis": with_(
        FEATURES,
        """SELECT count(*) FILTER (risk_tier = 'High risk') AS high_risk_customers,
        count(*) FILTER (risk_tier = 'Medium risk') AS medium_risk_customers,
        count(*) FILTER (risk_tier = 'Low risk') AS low_risk_customers FROM tiered""",
    ),
    "top10_high_risk": with_(
        FEATURES,
        f"""SELECT customer_unique_id, round(total_spend, 2) AS total_spend, recency_days, churn_probability
        FROM tiered WHERE {HIGH} ORDER BY total_spend DESC, customer_unique_id LIMIT 10""",
    ),
    "top10_display": with_(
        FEATURES,
        f"""SELECT customer_unique_id,
          CASE WHEN churn_probability >= 0.5 THEN 'Churned' ELSE 'Retained' END AS predicted_class,
          printf('BRL %.0f', round(total_spend, 2)) AS spend_text
        FROM tiered WHERE {HIGH} ORDER BY total_spend DESC, customer_unique_id LIMIT 10""",
    ),
    "top10_text": with_(
        FEATURES,
        f"""SELECT customer_unique_id, printf('BRL %.0f', total_spend) AS total_spend, recency_days,
          printf('%.1f%%', churn_probability * 100) AS churn_probability
        FROM (SELECT * FROM tiered WHERE {HIGH} ORDER BY total_spend DESC, customer_unique_id LIMIT 10)""",
    ),
    "probability_histogram": with_(FEATURES + ",", histogram("scored", "", "churn_probability")),
    "monthly_churn_trend": with_(
        FEATURES,
        """SELECT date_trunc('month', last_purchase)::DATE::VARCHAR AS month, count(*) AS customers,
        round(avg(churn_probability), 6) AS predicted_churn_rate FROM scored GROUP BY ALL""",
    ),
    "range_violations": with_(FEATURES, range_checks()),
    "revenue_at_risk": with_(
        FEATURES,
        by_tier(
            "count(*) AS customers, round(sum(total_spend), 2) AS total_spend, "
            "round(sum(round(churn_probability * total_spend * 10000)::BIGINT) / 10000.0::DOUBLE, 2) AS revenue_at_risk",
            "customers, total_spend, revenue_at_risk",
        ),
    ),
    "trigger_delivery_recovery": with_(
        BASE,
        """SELECT order_id, customer_unique_id, delay AS delivery_delay_days, arrived + INTERVAL 24 HOUR AS outreach_due,
        10 AS discount_pct, arrived + INTERVAL 30 DAY AS offer_expires FROM delivered WHERE delay > 3""",
    ),
    "trigger_bad_review": with_(
        BASE,
        """SELECT order_id, customer_unique_id, score AS review_score, written + INTERVAL 48 HOUR AS contact_due
        FROM reviews_v JOIN orders_v USING (order_id) JOIN customers_v USING (customer_id) WHERE score <= 2""",
    ),
    "target_delivery_recovery": with_(
        FEATURES,
        f"""SELECT customer_unique_id, round(max_delivery_delay, 6) AS max_delivery_delay,
        round(total_spend, 2) AS total_spend, churn_probability FROM tiered WHERE {HIGH} AND max_delivery_delay > 7""",
    ),
    "target_delivery_recovery_mean": with_(
        FEATURES,
        f"""SELECT customer_unique_id, round(avg_delivery_delay, 6) AS avg_delivery_delay,
        round(total_spend, 2) AS total_spend, churn_probability FROM tiered WHERE {HIGH} AND avg_delivery_delay > 3""",
    ),
    "target_bad_review": with_(
        FEATURES,
        """SELECT customer_unique_id, min_review_score, churn_probability FROM scored
        WHERE min_review_score <= 2 AND churn_probability >= 0.6""",
    ),
    "target_reactivation": with_(
        FEATURES,
        """SELECT customer_unique_id, recency_days, round(total_spend, 2) AS total_spend, last_purchase FROM features
        WHERE recency_days BETWEEN 60 AND 90 AND total_spend > 100""",
    ),
    "campaign_schedule": with_(
        FEATURES,
        f"""SELECT customer_unique_id, message, recency_day, discount_pct,
          CASE WHEN discount_pct > 0 THEN 'discount' ELSE 'product suggestions' END AS offer,
          (last_purchase::DATE + recency_day)::DATE::VARCHAR AS send_date,
          CASE WHEN discount_pct > 0 THEN (last_purchase::DATE + 75 + 7)::DATE::VARCHAR END AS offer_ends
        FROM features, (VALUES {CAMPAIGN}) AS c(message, recency_day, discount_pct)
        WHERE recency_days BETWEEN 60 AND 90 AND total_spend > 100""",
    ),
    "target_vip": with_(
        FEATURES,
        """SELECT customer_unique_id, round(total_spend, 2) AS total_spend, churn_probability,
          20 AS min_discount_pct, 25 AS max_discount_pct FROM scored
        WHERE churn_probability >= 0.6 AND total_spend >= (SELECT quantile_cont(total_spend, 0.8) FROM scored)""",
    ),
    "worst_sellers": with_(
        BASE
        + """, pairs AS (SELECT DISTINCT seller_id, order_id FROM items_v),
        delays AS (SELECT seller_id, count(*) AS orders, avg(delay) AS avg_delay
          FROM pairs JOIN delivered USING (order_id) GROUP BY ALL),
        scores AS (SELECT seller_id, avg(score) AS avg_review
          FROM pairs JOIN delivered USING (order_id) JOIN reviews_v USING (order_id) GROUP BY ALL),
        latest AS (SELECT seller_id, (ntile(10) OVER (ORDER BY avg_delay DESC, seller_id))::INT AS delay_tile
          FROM delays WHERE avg_delay IS NOT NULL),
        lowest AS (SELECT seller_id, (ntile(10) OVER (ORDER BY avg_review, seller_id))::INT AS review_tile
          FROM scores WHERE avg_review IS NOT NULL)""",
        """SELECT seller_id, orders, round(avg_delay, 6) AS avg_delay, round(avg_review, 6) AS avg_review,
          delay_tile, review_tile
        FROM delays LEFT JOIN scores USING (seller_id) LEFT JOIN latest USING (seller_id)
          LEFT JOIN lowest USING (seller_id)
        WHERE delay_tile = 1 OR review_tile = 1""",
    ),
    "product_suggestions": with_(
        BASE
        + """, bought AS (SELECT customer_unique_id, category, product_id, count(*) AS units, sum(price) AS spend
          FROM pre JOIN items_v USING (order_id) JOIN products_v USING (product_id) WHERE category IS NOT NULL GROUP BY ALL),
        sales AS (SELECT category, product_id, sum(units)::BIGINT AS sold FROM bought GROUP BY ALL),
        spent AS (SELECT customer_unique_id, category, sum(spend) AS spend FROM bought GROUP BY ALL),
        favourite AS (SELECT customer_unique_id, category FROM (
          SELECT customer_unique_id, category, row_number() OVER (PARTITION BY customer_unique_id
            ORDER BY spend DESC, category) AS rn FROM spent) WHERE rn = 1),
        open AS (SELECT f.customer_unique_id, s.category, s.product_id, s.sold, row_number() OVER (
            PARTITION BY f.customer_unique_id ORDER BY s.sold DESC, s.product_id) AS suggestion
          FROM favourite f JOIN sales s USING (category)
          WHERE NOT EXISTS (SELECT 1 FROM bought b WHERE b.customer_unique_id = f.customer_unique_id
            AND b.category = s.category AND b.product_id = s.product_id))""",
        "SELECT customer_unique_id, category, suggestion::INT AS suggestion, product_id, sold FROM open WHERE suggestion <= 3",
    ),
    "insight_recency_ratio": with_(
        FEATURES,
        f"""SELECT *, 'over 120 vs under 30' AS comparison FROM ({two_rates('recency_days > 120', 'recency_days < 30')})
        UNION ALL SELECT *, 'over 90 vs rest' FROM ({two_rates('recency_days > 90', 'recency_days <= 90')})""",
    ),
    "insight_delay_ratio": with_(FEATURES, two_rates("max_delivery_delay > 7", "max_delivery_delay <= 0")),
    "insight_review_slope": with_(
        FEATURES,
        """SELECT regr_count(churned, avg_review_score)::BIGINT AS customers,
        round(regr_slope(churned, avg_review_score), 6) AS churn_per_review_point FROM features""",
    ),
    "insight_review_jump": with_(
        FEATURES,
        """SELECT review_band, customers, round(rate, 6) AS churn_rate,
          round(rate - lag(rate) OVER (ORDER BY review_band), 6) AS jump
        FROM (SELECT floor(avg_review_score)::INT AS review_band, count(*) AS customers, avg(churned) AS rate
              FROM features WHERE avg_review_score IS NOT NULL GROUP BY ALL)""",
    ),
    "insight_spend": with_(
        FEATURES,
        """SELECT count(*) FILTER (total_spend > 300) AS high_spenders,
        round(avg(churned) FILTER (total_spend > 300), 6) AS high_spend_rate,
        round(avg(churned) FILTER (total_spend <= 300), 6) AS low_spend_rate,
        round(corr(churned, total_spend), 6) AS spend_churn_correlation FROM features""",
    ),
    "insight_category": with_(
        FEATURES,
        """SELECT CASE WHEN category_diversity > 1 THEN 'several categories' WHEN category_diversity = 1
          THEN 'one category' ELSE 'no known category' END AS categories,
        count(*) AS customers, round(avg(churned), 6) AS churn_rate FROM features GROUP BY ALL""",
    ),
    "spend_concentration": with_(
        FEATURES,
        """SELECT count(*) FILTER (t = 1) AS top_customers, round(sum(total_spend) FILTER (t = 1), 2) AS top_spend,
        round(sum(total_spend), 2) AS all_spend,
        round(sum(total_spend) FILTER (t = 1) / sum(total_spend), 6) AS top_share
        FROM (SELECT total_spend, ntile(5) OVER (ORDER BY total_spend DESC, customer_unique_id) AS t FROM features)""",
    ),
    "one_time_buyers": with_(
        BASE,
        """SELECT count(*) AS customers, count(*) FILTER (n = 1) AS one_time_customers,
        round(avg(CASE WHEN n = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS one_time_share
        FROM (SELECT customer_unique_id, count(*) AS n FROM delivered GROUP BY ALL)""",
    ),
    "km_survival": with_(
        FEATURES
        + f""", lives AS (SELECT segment, {floor_days('b', 'a')} AS duration, churned FROM (
            SELECT customer_unique_id, min(placed) AS a, max(placed) AS b FROM pre GROUP BY ALL)
          JOIN (SELECT customer_unique_id, churned, CASE WHEN avg_delivery_delay <= 0
              THEN 'On time' WHEN avg_delivery_delay > 0 AND avg_delivery_delay <= 3 THEN '1-3 days late'
              WHEN avg_delivery_delay > 3 AND avg_delivery_delay <= 7 THEN '4-7 days late'
              ELSE '7+ days late' END AS segment FROM features)
            USING (customer_unique_id)),
        days AS (SELECT segment, duration, sum(churned)::BIGINT AS events, count(*) AS leaving FROM lives GROUP BY ALL),
        risk AS (SELECT *, sum(leaving) OVER (PARTITION BY segment ORDER BY duration
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS at_risk FROM days)""",
        """SELECT segment, duration, at_risk, events, round(product((1 - events / at_risk::DOUBLE)) OVER (
            PARTITION BY segment ORDER BY duration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS survival
        FROM risk""",
    ),
    "state_churn": with_(
        FEATURES,
        """SELECT customer_state, count(*) AS customers, round(avg(churned), 6) AS churn_rate,
          round(avg(avg_delivery_delay), 6) AS avg_delay
        FROM (SELECT DISTINCT customer_unique_id, customer_state FROM pre) JOIN features USING (customer_unique_id)
        GROUP BY ALL""",
    ),
    "seller_churn": with_(
        BASE,
        """SELECT seller_id, count(*) AS buyers, sum(churned)::BIGINT AS churned_buyers, round(avg(churned), 6) AS churn_rate
        FROM (SELECT DISTINCT seller_id, customer_unique_id FROM items_v JOIN pre USING (order_id))
          JOIN labels_v USING (customer_unique_id) GROUP BY ALL""",
    ),
    "smote_balance": with_(
        FEATURES
        + ", parts AS (SELECT label, count(*) AS n FROM split WHERE split = 'train' GROUP BY label)",
        """SELECT 'before' AS stage, label, n AS rows FROM parts
        UNION ALL SELECT 'after', label, (SELECT max(n) FROM parts) FROM parts""",
    ),
}

ARMS = f"""arms AS (SELECT customer_unique_id, 1 - churned AS retained,
  CASE WHEN {UNIT.format(seed=42, key='customer_unique_id')} < 0.5
    THEN 'treatment' ELSE 'control' END AS arm FROM tiered WHERE {HIGH})"""
ORACLE["scored_round_trip"] = ORACLE["tier_kpis"]
ORACLE["experiment_arms"] = with_(FEATURES + ", " + ARMS, "SELECT customer_unique_id, arm FROM arms")
ORACLE["ab_lift"] = with_(
    FEATURES
    + ", "
    + ARMS
    + """, sides AS (SELECT count(*) FILTER (arm = 'treatment') AS nt, count(*) FILTER (arm = 'control') AS nc,
      sum(retained) FILTER (arm = 'treatment') AS xt, sum(retained) FILTER (arm = 'control') AS xc FROM arms),
    rates AS (SELECT nt, nc, xt / nt::DOUBLE AS pt, xc / nc::DOUBLE AS pc, (xt + xc) / (nt + nc)::DOUBLE AS p FROM sides)""",
    """SELECT nt AS treated, nc AS controls, round(pt, 6) AS treated_rate, round(pc, 6) AS control_rate,
      round(pt - pc, 6) AS lift, round((pt - pc) / nullif(sqrt(p * (1 - p) * (1.0::DOUBLE / nt + 1.0::DOUBLE / nc)), 0), 6)
        AS z_statistic FROM rates WHERE nt > 0 AND nc > 0""",
)

DISTANCE = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in CORE9)
ORACLE["smote_balanced"] = with_(
    FEATURES
    + f""",
train AS (SELECT * FROM split WHERE split = 'train'),
parts AS (SELECT label, count(*) AS n FROM train GROUP BY label),
small AS (SELECT label, n, (SELECT max(n) FROM parts) - n AS missing FROM parts ORDER BY n, label LIMIT 1),
minority AS (
  SELECT *, row_number() OVER (ORDER BY {DIGEST.format(seed=42)}, customer_unique_id) AS seat
  FROM train WHERE label = (SELECT label FROM small)),
near AS (
  SELECT seat, other, place, count(*) OVER (PARTITION BY seat) AS pool FROM (
    SELECT a.seat, b.seat AS other, row_number() OVER (PARTITION BY a.seat ORDER BY {DISTANCE}, b.seat) AS place
    FROM minority a JOIN minority b ON a.seat <> b.seat) WHERE place <= 5),
draws AS (
  SELECT id, floor({UNIT.format(seed=43, key='id')} * (SELECT n FROM small))::BIGINT + 1 AS seat,
    {UNIT.format(seed=44, key='id')} AS pick, {UNIT.format(seed=45, key='id')} AS along
  FROM (SELECT unnest(range((SELECT missing FROM small))) AS id)),
made AS (
  SELECT 'synthetic-' || id AS customer_unique_id, a.label, {', '.join(f'a.{c} + along * (b.{c} - a.{c}) AS {c}' for c in CORE9)}
  FROM draws d JOIN near n ON n.seat = d.seat AND n.place = floor(d.pick * n.pool)::BIGINT + 1
    JOIN minority a ON a.seat = d.seat JOIN minority b ON b.seat = n.other)""",
    f"""SELECT customer_unique_id::VARCHAR AS customer_unique_id, label, {', '.join(f'round({c}, 6) AS {c}' for c in CORE9)}
    FROM (SELECT customer_unique_id::VARCHAR AS customer_unique_id, label, {', '.join(CORE9)} FROM train
      UNION ALL SELECT customer_unique_id, label, {', '.join(CORE9)} FROM made)""",
)

# Facts about fitted models, stated from the tables alone.
HAZARD_COLUMNS = ("avg_order_value", "avg_review_score", "pct_late_orders", "category_diversity")
LIVES = (
    FEATURES
    + f""", lives AS (SELECT {floor_days('b', 'a')} AS duration, churned, {', '.join(HAZARD_COLUMNS)} FROM (
        SELECT customer_unique_id, min(placed) AS a, max(placed) AS b FROM pre GROUP BY ALL)
      JOIN features USING (customer_unique_id) WHERE {' AND '.join(f'{c} IS NOT NULL' for c in HAZARD_COLUMNS)})"""
)
# Efron's ties at no effect, term by term.
ORACLE["cox_null_scores"] = with_(
    LIVES
    + f""", long AS (SELECT duration, churned, unnest([{', '.join(f"{{'feature': '{c}', 'value': {c}::DOUBLE}}" for c in HAZARD_COLUMNS)}]) AS e FROM lives),
    scaled AS (SELECT e.feature AS feature, duration, churned, (e.value - avg(e.value) OVER (PARTITION BY e.feature))
        / stddev_pop(e.value) OVER (PARTITION BY e.feature) AS x FROM long),
    days AS (SELECT feature, duration, sum(churned)::BIGINT AS d, count(*) AS n, sum(x) AS x1, sum(x * x) AS x2,
        coalesce(sum(x) FILTER (churned = 1), 0) AS t1, coalesce(sum(x * x) FILTER (churned = 1), 0) AS t2
      FROM scaled GROUP BY ALL),
    risk AS (SELECT *, sum(n) OVER w AS s, sum(x1) OVER w AS s1, sum(x2) OVER w AS s2 FROM days
      WINDOW w AS (PARTITION BY feature ORDER BY duration DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    terms AS (SELECT feature, d, t1, t2, s::DOUBLE AS s, s1, s2, unnest(range(0, d)) AS k FROM risk WHERE d > 0),
    parts AS (SELECT feature, t1 / d AS seen, (s1 - k / d::DOUBLE * t1) / (s - k) AS m1,
        (s2 - k / d::DOUBLE * t2) / (s - k) AS m2 FROM terms)""",
    """SELECT feature, round(sum(seen - m1), 6) AS slope, round(sum(m2 - m1 * m1), 6) AS variance,
      round(sum(seen - m1) / sqrt(sum(m2 - m1 * m1)), 6) AS z_statistic FROM parts GROUP BY ALL""",
)
ORACLE["cox_hazards"] = with_(
    LIVES + f""", columns_v AS (SELECT unnest([{', '.join(f"'{c}'" for c in HAZARD_COLUMNS)}]) AS feature)""",
    """SELECT lives, deaths, true AS gained, true AS converged, feature, 0.0::DOUBLE AS slope
      FROM (SELECT count(*) AS lives, sum(churned)::BIGINT AS deaths FROM lives), columns_v""",
)
ORACLE["lr_scores"] = with_(
    FEATURES
    + f""", parts AS (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM split WHERE split = 'train' GROUP BY label)),
    columns_v AS (SELECT unnest([{', '.join(f"'{c}'" for c in CORE9)}]) AS feature)""",
    "SELECT n AS rows_0, n AS rows_1, feature, 0.0::DOUBLE AS slope FROM parts, columns_v",
)
ORACLE["rf_scores"] = ORACLE["gbt_scores"] = with_(
    FEATURES,
    """SELECT customer_unique_id, label, true AS is_probability, true AS agrees, 0.0::DOUBLE AS difference
    FROM held_out""",
)
ORACLE["booster_facts"] = with_(
    FEATURES,
    """SELECT 100::BIGINT AS trees, 5::INT AS levels, 0.0::DOUBLE AS leaf_difference, 0.0::DOUBLE AS gain_difference,
      true AS loss_falls FROM (SELECT count(*) AS n FROM split) WHERE n > 0""",
)
ORACLE["forest_facts"] = with_(
    FEATURES,
    """SELECT 200::BIGINT AS trees, 10::INT AS levels, 0.0::DOUBLE AS gain_difference, true AS orders_rows
      FROM (SELECT count(*) AS n FROM split) WHERE n > 0""",
)
# The best of all cuts between bins of equal frequency.
ORACLE["booster_first_split"] = with_(
    FEATURES
    + f""", train AS (SELECT * FROM split WHERE split = 'train'),
    long AS (SELECT label, unnest([{', '.join(f"{{'place': {i}, 'feature': '{c}', 'value': {c}::DOUBLE}}" for i, c in enumerate(CORE9))}]) AS e FROM train),
    cells AS (SELECT e.place AS place, e.feature AS feature, e.value AS value,
      sum(0.5::DOUBLE - label) AS g, sum(0.25::DOUBLE) AS h, count(*) AS n
      FROM long GROUP BY ALL),
    running AS (SELECT *, sum(n) OVER w AS upto, sum(n) OVER (PARTITION BY place) AS total, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
      sum(g) OVER (PARTITION BY place) AS ga, sum(h) OVER (PARTITION BY place) AS ha
      FROM cells WINDOW w AS (PARTITION BY place ORDER BY value)),
    ends AS (SELECT *, row_number() OVER (PARTITION BY place, ((upto - n) * 256) // total ORDER BY value DESC) AS last FROM running),
    cuts AS (SELECT *, 0.5 * (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) AS gain
      FROM ends WHERE last = 1 AND upto < total AND hl >= 1 AND ha - hl >= 1),
    best AS (SELECT * FROM cuts WHERE gain > 0.000001 ORDER BY gain DESC, place, value LIMIT 1)""",
    """SELECT feature, round(value, 6) AS threshold, round(gain, 6)::DOUBLE AS gain, round(-0.3 * gl / (hl + 1), 6)::DOUBLE AS left_value,
      round(-0.3 * (ga - gl) / (ha - hl + 1), 6)::DOUBLE AS right_value FROM best""",
)
ORACLE["tree_shap"] = with_(
    FEATURES, f"SELECT customer_unique_id, {len(CORE9)}::BIGINT AS features, 0.0::DOUBLE AS difference FROM held_out"
)
ORACLE["batch_scores"] = with_(
    FEATURES, "SELECT customer_unique_id, true AS tier_agrees, 0.0::DOUBLE AS difference FROM features"
)
ORACLE["fitted_model_comparison"] = with_(
    FEATURES,
    """SELECT unnest(['Logistic Regression', 'Random Forest', 'Boosted Trees']) AS model, 0.0::DOUBLE AS difference
    FROM (SELECT count(*) AS n FROM held_out) WHERE n > 0""",
)
ORACLE["random_search_results"] = with_(
    FEATURES,
    """SELECT 30::BIGINT AS draws, 30::BIGINT AS distinct_draws, 30::BIGINT AS inside_grid, true AS areas_valid,
      true AS places_complete, true AS best_is_first FROM (SELECT count(*) AS n FROM split) WHERE n > 0""",
)

GIVEN = [c for c in FULL13 if c not in ("total_freight", "max_delivery_delay")]
SERVED = ", ".join(
    f"coalesce({c}::DOUBLE, {float(INPUT_RULES[c][2])!r}::DOUBLE) AS {c}" if c in GIVEN
    else f"{float(INPUT_RULES[c][2])!r}::DOUBLE AS {c}"
    for c in FULL13
)
OUTSIDE = " + ".join(
    f"CASE WHEN {c} >= {low}" + ("" if high is None else f" AND {c} <= {high}") + " THEN 0 ELSE 1 END"
    for c, (low, high, _) in INPUT_RULES.items()
)
ORACLE["served_records"] = with_(
    FEATURES
    + f""", filled AS (SELECT customer_unique_id, {SERVED} FROM features),
    served AS (SELECT *, {score(LINEAR_WEIGHTS)} AS churn_probability FROM filled),
    ruled AS (SELECT *, {RULE_TIER} AS risk_tier FROM served)""",
    f"""SELECT customer_unique_id, ({OUTSIDE})::INT AS fields_out_of_range, churn_probability, risk_tier,
      CASE risk_tier WHEN 'High risk' THEN 'immediate retention action recommended'
        WHEN 'Medium risk' THEN 'include in next reactivation campaign'
        ELSE 'no immediate action needed' END AS recommended_action FROM ruled""",
)
ORACLE["served_by_model"] = with_(
    FEATURES + f", filled AS (SELECT customer_unique_id, {SERVED} FROM features)",
    f"""SELECT customer_unique_id, ({OUTSIDE})::INT AS fields_out_of_range, true AS tier_agrees, true AS has_action,
      0.0::DOUBLE AS difference FROM filled""",
)


def arrived(orders: str) -> str:
    """Features and score of everyone, as of the last delivered purchase among these orders."""
    base = re.sub(r"FROM orders\b", f"FROM ({orders})", BASE.replace("INTERVAL 6 MONTH", "INTERVAL 0 MONTH"))
    return with_(
        base + f", features AS ({wide()})",
        f"SELECT customer_unique_id, order_count, {score(LINEAR_WEIGHTS)} AS churn_probability FROM features",
    )


ORACLE["live_scores"] = f"""
WITH touched AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 4 = 0),
first AS ({arrived("SELECT * FROM orders WHERE o_orderkey % 4 <> 0")}),
whole AS ({arrived("SELECT * FROM orders")})
SELECT * FROM whole WHERE customer_unique_id IN (SELECT o_custkey FROM touched)
UNION ALL SELECT * FROM first WHERE customer_unique_id NOT IN (SELECT o_custkey FROM touched)
"""
