"""Queries for market-basket rules."""

from pyspark.sql import functions as F

from tallyhouse.operators import basket as mb
from tallyhouse.plans.check_views import div
from tallyhouse.plans.registry import query


@query("mba_1_clean_basket", "SELECT * FROM k_basket")
def clean_basket(t):
    return mb.clean_basket(t.lines)


@query("mba_2_product_counts", "SELECT product_id, n AS product_order_count FROM k_counts")
def product_counts(t):
    return mb.product_counts(mb.clean_basket(t.lines))


@query("mba_3_pair_counts", "SELECT * FROM k_pairs")
def pair_counts(t):
    return mb.pair_counts(mb.clean_basket(t.lines))


def _metrics(t):
    basket = mb.clean_basket(t.lines)
    return mb.pair_metrics(mb.pair_counts(basket), basket)


@query(
    "mba_4_all_pair_metrics",
    f"""SELECT product_a, product_b, pair_order_count, count_a, count_b, support, confidence_atob, confidence_btoa,
               {div('CAST(confidence_atob AS DECIMAL(6,4)) * total_orders', 'count_b', 4)} AS lift_atob, {div('CAST(confidence_btoa AS DECIMAL(6,4)) * total_orders', 'count_a', 4)} AS lift_btoa
        FROM k_ratios""",
)
def all_pair_metrics(t):
    """Metrics of all pairs, without a floor on confidence and lift."""
    basket = mb.clean_basket(t.lines)
    return mb.pair_metrics(mb.pair_counts(basket), basket, min_confidence=0.0, min_lift=-1.0).drop("total_orders")


@query("mba_4_pair_metrics", "SELECT product_a, product_b, pair_order_count, count_a, count_b, support, confidence_atob, confidence_btoa, lift_atob, lift_btoa FROM k_metrics")
def pair_metrics(t):
    return _metrics(t).drop("total_orders")


@query("mba_5_directional_rules", "SELECT * FROM k_rules")
def directional_rules(t):
    return mb.directional_rules(_metrics(t))


@query(
    "mba_5_directional_rules_low_floor",
    f"""SELECT product_a AS antecedent_id, product_b AS consequent_id, support, confidence_atob AS confidence, pair_order_count FROM k_ratios WHERE confidence_atob >= CAST(0.05 AS DOUBLE)
          AND {div('CAST(confidence_atob AS DECIMAL(6,4)) * total_orders', 'count_b', 4)} > 1
        UNION ALL SELECT product_b, product_a, support, confidence_btoa, pair_order_count FROM k_ratios WHERE confidence_btoa >= CAST(0.05 AS DOUBLE)
          AND {div('CAST(confidence_btoa AS DECIMAL(6,4)) * total_orders', 'count_a', 4)} > 1""",
)
def directional_rules_low_floor(t):
    """Random baskets hold few confident rules; a lower floor shows the directions at work."""
    basket = mb.clean_basket(t.lines)
    metrics = mb.pair_metrics(mb.pair_counts(basket), basket, min_confidence=0.05)
    return mb.directional_rules(metrics, min_confidence=0.05).drop("lift")


@query("mba_6_association_rules", "SELECT * FROM k_enriched")
def association_rules(t):
    return mb.association_rules(t.lines, t.products)


def _loose(t):
    """Enriched rules with a low confidence floor, so that the labels meet many rules."""
    basket = mb.clean_basket(t.lines)
    metrics = mb.pair_metrics(mb.pair_counts(basket), basket, min_confidence=0.05)
    return mb.enrich_rules(mb.directional_rules(metrics, min_confidence=0.05), t.products)


_LOOSE = f"""SELECT r.*, a.label AS antecedent_label, c.label AS consequent_label, CASE WHEN lift >= 3 THEN 'Strong' WHEN lift >= 1.5 THEN 'Moderate' ELSE 'Weak' END AS rule_strength
    FROM (SELECT product_a AS antecedent_id, product_b AS consequent_id, support, confidence_atob AS confidence,
                 {div('CAST(confidence_atob AS DECIMAL(6,4)) * total_orders', 'count_b', 4)} AS lift, pair_order_count FROM k_ratios
          UNION ALL SELECT product_b, product_a, support, confidence_btoa, {div('CAST(confidence_btoa AS DECIMAL(6,4)) * total_orders', 'count_a', 4)}, pair_order_count FROM k_ratios) r
    LEFT JOIN k_labels a ON r.antecedent_id = a.product_id LEFT JOIN k_labels c ON r.consequent_id = c.product_id
    WHERE r.confidence >= CAST(0.05 AS DOUBLE) AND r.lift > 1"""
_PCT = div("CAST(confidence AS DECIMAL(6,4))", "1", 1, 100)


@query("mba_7_frequent_itemsets", "SELECT * FROM k_itemsets")
def frequent_itemsets(t):
    return mb.frequent_itemsets(mb.pair_counts(mb.clean_basket(t.lines)), t.products)


@query(
    "mba_8_vendor_rules",
    f"""WITH b AS (SELECT DISTINCT vendor_id, CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id FROM s_lines),
        totals AS (SELECT vendor_id, count(DISTINCT order_id) AS total_orders FROM b GROUP BY 1 HAVING count(DISTINCT order_id) >= 50),
        n AS (SELECT vendor_id, product_id, count(*) AS n FROM b GROUP BY 1, 2),
        pairs AS (SELECT x.vendor_id, x.product_id AS product_a, y.product_id AS product_b, count(*) AS pair_order_count FROM b x
                  JOIN b y ON x.vendor_id = y.vendor_id AND x.order_id = y.order_id AND x.product_id < y.product_id GROUP BY 1, 2, 3 HAVING count(*) >= 2),
        scored AS (SELECT p.*, a.n AS count_a, c.n AS count_b, {div('pair_order_count', 'a.n', 4)} AS confidence, {div('pair_order_count * total_orders', 'a.n * c.n', 4)} AS lift
                   FROM pairs p JOIN totals t ON p.vendor_id = t.vendor_id JOIN n a ON a.vendor_id = p.vendor_id AND a.product_id = p.product_a
                   JOIN n c ON c.vendor_id = p.vendor_id AND c.product_id = p.product_b)
        SELECT s.vendor_id, v.vendor_name, product_a, product_b, pair_order_count, count_a, count_b, confidence, lift
        FROM scored s LEFT JOIN s_vendors v ON s.vendor_id = v.vendor_id WHERE confidence >= CAST(0.2 AS DOUBLE) AND lift > 1""",
)
def vendor_rules(t):
    return mb.vendor_rules(t.lines, t.vendors)


@query(
    "mba_9_top_lift",
    f"SELECT antecedent_label AS when_buying, consequent_label AS also_buying, {_PCT} AS confidence_pct, lift AS lift_value, rule_strength, pair_order_count AS orders_together FROM ({_LOOSE}) r ORDER BY lift DESC, antecedent_id, consequent_id LIMIT 10",
)
def top_lift(t):
    return mb.top_lift(_loose(t))


@query(
    "mba_9_reliable_cross_sell",
    f"SELECT antecedent_label AS product_a, consequent_label AS offer_with, {_PCT} AS confidence_pct, lift, rule_strength FROM ({_LOOSE}) r WHERE rule_strength <> 'Weak' ORDER BY confidence DESC, lift DESC, antecedent_id, consequent_id LIMIT 10",
)
def reliable_cross_sell(t):
    return mb.reliable_cross_sell(_loose(t))


@query("mba_9_top_pairs", "SELECT itemset_label AS pair_of_products, freq AS orders_together FROM k_itemsets ORDER BY freq DESC, product_a, product_b LIMIT 10")
def top_pairs(t):
    return mb.top_pairs(mb.frequent_itemsets(mb.pair_counts(mb.clean_basket(t.lines)), t.products))


@query("mba_9_strong_rules", f"SELECT antecedent_label AS when_buying, consequent_label AS pair_with, support, {_PCT} AS confidence_pct, lift FROM ({_LOOSE}) r WHERE rule_strength = 'Strong'")
def strong_rules(t):
    return mb.strong_rules(_loose(t))


@query("mba_9_rules_per_strength", f"SELECT rule_strength, count(*) AS rules FROM ({_LOOSE}) r GROUP BY 1")
def rules_per_strength(t):
    return _loose(t).groupBy("rule_strength").agg(F.count(F.lit(1)).alias("rules"))


_BRANDS = "b AS (SELECT DISTINCT l.order_id, p.brand AS i FROM s_lines l JOIN s_products p ON l.product_id = p.product_id)"
_SETS = {
    2: "SELECT a.i || ' + ' || b.i AS items, 2 AS size, count(*) AS freq FROM b a JOIN b ON a.order_id = b.order_id AND a.i < b.i GROUP BY 1 HAVING count(*) >= 5",
    3: "SELECT a.i || ' + ' || b.i || ' + ' || c.i, 3, count(*) FROM b a JOIN b ON a.order_id = b.order_id AND a.i < b.i JOIN b c ON a.order_id = c.order_id AND b.i < c.i GROUP BY 1 HAVING count(*) >= 5",
    4: "SELECT a.i || ' + ' || b.i || ' + ' || c.i || ' + ' || d.i, 4, count(*) FROM b a JOIN b ON a.order_id = b.order_id AND a.i < b.i JOIN b c ON a.order_id = c.order_id AND b.i < c.i "
       "JOIN b d ON a.order_id = d.order_id AND c.i < d.i GROUP BY 1 HAVING count(*) >= 5",
}


@query("mba_10_itemsets", f"WITH {_BRANDS} {' UNION ALL '.join(_SETS.values())}")
def itemsets(t):
    """Brands that are ordered together, in sets of two to four."""
    brands = t.lines.join(t.products.select("product_id", "brand"), "product_id").select("order_id", F.col("brand").alias("product_id"))
    found = mb.itemsets(mb.clean_basket(brands), 5, 4)
    return found.select(F.array_join("items", " + ").alias("items"), "size", "freq")
