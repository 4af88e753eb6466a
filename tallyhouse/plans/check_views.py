"""Views in plain SQL that the checks build on: the layers computed a second time.

Inputs (``s_``, ``b_``) share their text with the test entities. Everything after that is
written independently of the Spark operators: unions instead of one-pass arrays, windows
instead of ``min_by``, row-by-row pairing instead of sorting.
"""

from __future__ import annotations

from tallyhouse.config import RULES, Rule, rules_for
from tallyhouse.sources.testbed import check_bases

RUN_ID = "check-run"
RUN_AT = "TIMESTAMP '2024-02-01 00:00:00'"


def div(num: str, den: str, digits: int, scale: int = 1) -> str:
    """Exact ``round(scale * num / den, digits)``, half away from zero, for decimals of up to 8 digits.

    Works on whole numbers, so the check does not depend on how an engine rounds doubles.
    """
    n, d = f"CAST(({num}) * 100000000 AS HUGEINT)", f"CAST(({den}) * 100000000 AS HUGEINT)"
    k = 10**digits * scale
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(sign({num}) * sign({den}) * ((2 * abs({n}) * {k} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {float(10**digits)} END)"
    )


def micro(num: str, den: str) -> str:
    """Exact quotient with eight digits as DECIMAL, half away from zero (unit prices)."""
    n, d = f"CAST(({num}) * 10000 AS HUGEINT)", f"CAST(({den}) * 10000 AS HUGEINT)"
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(sign({num}) * ((2 * abs({n}) * 100000000 + abs({d})) // (2 * abs({d}))) AS DECIMAL(28,0)) * CAST(0.00000001 AS DECIMAL(9,8)) END)"
    )


def rule_sql(rule: Rule) -> str:
    """Rule text with the one operator the check engine spells differently."""
    text = rule.rule_expression
    if "RLIKE" in text:
        text = text.replace("state RLIKE '^[A-Z]{2}$'", "regexp_matches(state, '^[A-Z]{2}$')").replace(
            "state RLIKE '^[A-Z][a-z]+$'", "regexp_matches(state, '^[A-Z][a-z]+$')")
    return text


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _quarantine(entity: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{RUN_ID}' AS _run_id, {quote(r.rule_name)} AS _expectation_name, '{r.severity}' AS _severity, '{r.issue_type}' AS _issue_type, "
        f"{quote(r.failure_reason)} AS _failure_reason, {RUN_AT} AS _quarantine_timestamp FROM h_{entity} WHERE NOT ({rule_sql(r)})"
        for r in rules_for(entity)
    )


def _clean(entity: str) -> str:
    keep = [f"({rule_sql(r)})" for r in rules_for(entity) if r.consequence == "drop"]
    return f"SELECT * FROM h_{entity} WHERE " + " AND ".join(keep)


def _stamp(c: str) -> str:
    return f"coalesce(try_strptime({c}, '%m/%d/%Y %H:%M'), try_strptime({c}, '%Y-%m-%d %H:%M'))"


def _money(c: str, kind: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '^\\$', '') AS {kind})"


def _refund(c: str) -> str:
    return f"TRY_CAST(regexp_replace(nullif({c}, '?'), '[^0-9.]', '', 'g') AS DECIMAL(10,2))"


def _day(c: str) -> str:
    return f"CAST(coalesce(try_strptime(nullif({c}, 'NULL'), '%Y-%m-%d'), try_strptime(nullif({c}, 'NULL'), '%m-%d-%Y')) AS DATE)"


def _segment(c: str) -> str:
    return f"CASE WHEN {c} IN ('CONS', 'Cosumer') THEN 'Consumer' WHEN {c} = 'CORP' THEN 'Corporate' WHEN {c} = 'HO' THEN 'Home Office' ELSE {c} END"


def _status(c: str) -> str:
    return f"CASE {c} WHEN 'PENDG' THEN 'Pending' WHEN 'APPRVD' THEN 'Approved' WHEN 'RJCTD' THEN 'Rejected' ELSE {c} END"


LINEAGE = "source_file AS _source_file, load_timestamp AS _load_timestamp, 'static_config' AS _mapping_source"

_DISCOUNT_RAW = "TRY_CAST(regexp_replace(discount, '[^0-9.]', '', 'g') AS DECIMAL(10,3))"

CHECK_VIEWS: dict[str, str] = {
    **check_bases(),
    # --- harmonised ---------------------------------------------------------------------------
    "h_customers": f"""
        SELECT coalesce(customer_id, customerid, cust_id, customer_identifier) AS customer_id,
               coalesce(customer_email, email_address) AS customer_email, coalesce(customer_name, full_name) AS customer_name,
               coalesce({_segment('segment')}, {_segment('customer_segment')}) AS segment, country, city, state, postal_code,
               CASE upper(trim(region)) WHEN 'S' THEN 'South' WHEN 'C' THEN 'Central' WHEN 'W' THEN 'West' WHEN 'E' THEN 'East'
                    WHEN 'N' THEN 'North' ELSE region END AS region, {LINEAGE}
        FROM b_customers""",
    "h_orders": f"""
        SELECT order_id, customer_id, CAST(NULL AS VARCHAR) AS vendor_id, ship_mode, order_status,
               {_stamp('order_purchase_date')} AS order_purchase_timestamp, {_stamp('order_approved_at')} AS order_approved_timestamp,
               {_stamp('order_delivered_carrier_date')} AS order_delivered_carrier_timestamp,
               {_stamp('order_delivered_customer_date')} AS order_delivered_customer_timestamp,
               {_stamp('order_estimated_delivery_date')} AS order_estimated_delivery_timestamp, {LINEAGE}
        FROM b_orders""",
    "h_transactions": f"""
        SELECT order_id, product_id, {_money('sales', 'DECIMAL(10,3)')} AS sales, TRY_CAST(quantity AS INTEGER) AS quantity,
               CAST(CASE WHEN {_DISCOUNT_RAW} >= 1 THEN CAST({_DISCOUNT_RAW} AS DECIMAL(12,5)) * CAST(0.01 AS DECIMAL(3,2)) ELSE {_DISCOUNT_RAW} END AS DECIMAL(12,5)) AS discount,
               {_money('profit', 'DECIMAL(10,3)')} AS profit, nullif(payment_type, '?') AS payment_type,
               TRY_CAST(payment_installments AS INTEGER) AS payment_installments, {LINEAGE}
        FROM b_transactions""",
    "h_returns": f"""
        SELECT coalesce(order_id, orderid) AS order_id, coalesce({_refund('refund_amount')}, {_refund('amount')}) AS refund_amount,
               coalesce({_day('return_date')}, {_day('date_of_return')}) AS return_date,
               coalesce(nullif(return_reason, '?'), nullif(reason, '?')) AS return_reason,
               coalesce({_status('return_status')}, {_status('status')}) AS return_status, {LINEAGE}
        FROM b_returns""",
    "h_products": f"""
        SELECT product_id, product_name, brand, categories, colors, manufacturer, CAST(NULL AS VARCHAR) AS dimension, sizes, upc,
               CAST(NULL AS VARCHAR) AS weight, product_photos_qty, TRY_CAST(dateadded AS TIMESTAMP) AS date_added,
               TRY_CAST(dateupdated AS TIMESTAMP) AS date_updated, {LINEAGE}
        FROM b_products""",
    "h_vendors": f"SELECT vendor_id, vendor_name, {LINEAGE} FROM b_vendors",
    **{f"q_{e}": _quarantine(e) for e in ("customers", "orders", "transactions", "returns", "products", "vendors")},
    **{f"c_{e}": _clean(e) for e in ("customers", "orders", "transactions", "returns", "products", "vendors")},
    "q_all": " UNION ALL ".join(
        f"SELECT '{e}' AS entity, _expectation_name, _severity, _issue_type, _failure_reason, _source_file, _quarantine_timestamp FROM q_{e}"
        for e in ("customers", "orders", "transactions", "returns", "products", "vendors")),
    # --- golden records --------------------------------------------------------------------------
    "m_ranked": """
        SELECT *, coalesce(TRY_CAST(regexp_extract(_source_file, 'customers_([0-9])', 1) AS INTEGER), 99) AS source_rank FROM c_customers""",
    "m_priority": """
        SELECT * FROM m_ranked QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_rank) = 1""",
    "m_recent": """
        SELECT * FROM m_ranked QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _load_timestamp DESC, source_rank) = 1""",
    "m_complete": """
        SELECT * FROM m_ranked
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY CASE WHEN customer_email IS NULL THEN 1 ELSE 0 END, source_rank) = 1""",
    "m_customers": """
        SELECT p.customer_id, e.customer_email, p.customer_name, p.segment, p.country, r.city, r.state, r.postal_code, p.region, r._load_timestamp
        FROM m_priority p JOIN m_recent r ON p.customer_id = r.customer_id JOIN m_complete e ON p.customer_id = e.customer_id""",
    # --- gold ----------------------------------------------------------------------------------------
    "g_sales": """
        SELECT md5(CAST(t.order_id AS VARCHAR) || '||' || CAST(t.product_id AS VARCHAR)) AS sales_key,
               CASE WHEN c.customer_id IS NOT NULL THEN md5(CAST(c.customer_id AS VARCHAR)) END AS customer_key, o.customer_id, c.region, c.segment,
               CASE WHEN p.product_id IS NOT NULL THEN md5(CAST(p.product_id AS VARCHAR)) END AS product_key, t.product_id,
               CASE WHEN v.vendor_id IS NOT NULL THEN md5(CAST(v.vendor_id AS VARCHAR)) END AS vendor_key, t.vendor_id,
               CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_key, t.order_id, t.sales, t.quantity, t.discount, t.profit,
               t.payment_type, t.payment_installments, CAST(o.order_purchase_timestamp AS DATE) AS day, t._source_file
        FROM s_lines t JOIN s_orders o ON t.order_id = o.order_id LEFT JOIN s_customers c ON o.customer_id = c.customer_id
        LEFT JOIN s_products p ON t.product_id = p.product_id LEFT JOIN s_vendors v ON t.vendor_id = v.vendor_id""",
    "g_numbered_returns": "SELECT *, row_number() OVER () AS rid FROM s_returns",
    "g_matched": """
        SELECT r.*, l.product_id, l.sales AS original_sales, l.vendor_id,
               count(l.order_id) OVER (PARTITION BY r.rid) AS candidates,
               count(CASE WHEN abs(l.sales - r.refund_amount) < 0.01 THEN 1 END) OVER (PARTITION BY r.rid) AS same_price
        FROM g_numbered_returns r LEFT JOIN s_lines l ON r.order_id = l.order_id
        QUALIFY row_number() OVER (PARTITION BY r.rid ORDER BY abs(l.sales - r.refund_amount), l.product_id, l.sales, l.vendor_id) = 1""",
    "g_returns": f"""
        SELECT md5(CAST(m.order_id AS VARCHAR) || '||' || CAST(m.return_date AS VARCHAR)) AS return_key,
               CASE WHEN c.customer_id IS NOT NULL THEN md5(CAST(c.customer_id AS VARCHAR)) END AS customer_key, o.customer_id, c.region, c.segment,
               CASE WHEN p.product_id IS NOT NULL THEN md5(CAST(p.product_id AS VARCHAR)) END AS product_key, m.product_id,
               CASE WHEN v.vendor_id IS NOT NULL THEN md5(CAST(v.vendor_id AS VARCHAR)) END AS vendor_key, m.vendor_id,
               CAST(strftime(m.return_date, '%Y%m%d') AS INTEGER) AS return_date_key, m.order_id, m.refund_amount, m.return_reason, m.return_status,
               m.return_date, m.original_sales,
               CAST(CASE WHEN m.original_sales > 0 THEN {div('m.refund_amount', 'm.original_sales', 2)} END AS DECIMAL(14,2)) AS return_to_sales_ratio,
               CASE WHEN m.candidates = 0 THEN 'ORPHAN' WHEN m.same_price = 1 THEN 'EXACT' WHEN m.same_price > 1 THEN 'AMBIGUOUS' ELSE 'ESTIMATED' END AS match_confidence
        FROM g_matched m LEFT JOIN s_orders o ON m.order_id = o.order_id LEFT JOIN s_customers c ON o.customer_id = c.customer_id
        LEFT JOIN s_products p ON m.product_id = p.product_id LEFT JOIN s_vendors v ON m.vendor_id = v.vendor_id""",
    "g_dates": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (
            SELECT min(d) AS lo, max(d) AS hi FROM (
                SELECT CAST(order_purchase_timestamp AS DATE) AS d FROM s_orders UNION ALL SELECT return_date FROM s_returns) days) span) all_days""",
    "g_revenue": f"""
        SELECT CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month, monthname(day) AS month_name, region,
               sum(sales) AS total_sales, round(sum(profit), 2) AS total_profit, count(*) AS line_item_count, count(DISTINCT order_id) AS order_count,
               {div('sum(sales)', 'count(sales)', 2)} AS avg_line_item_value, {div('sum(sales)', 'count(DISTINCT order_id)', 2)} AS avg_order_value
        FROM g_sales GROUP BY ALL""",
    "g_rates": f"""
        SELECT s.vendor_id, v.vendor_name, s.total_orders_sold, s.total_sales, coalesce(r.total_returns, 0) AS total_returns,
               coalesce(r.total_refund_amount, 0) AS total_refund_amount, r.avg_refund_amount,
               {div('coalesce(r.total_returns, 0)', 's.total_orders_sold', 2, 100)} AS return_rate_pct
        FROM (SELECT vendor_id, count(DISTINCT order_id) AS total_orders_sold, sum(sales) AS total_sales FROM g_sales GROUP BY 1) s
        LEFT JOIN (SELECT vendor_id, count(*) AS total_returns, sum(refund_amount) AS total_refund_amount,
                          {div('sum(refund_amount)', 'count(refund_amount)', 2)} AS avg_refund_amount FROM g_returns GROUP BY 1) r ON s.vendor_id = r.vendor_id
        LEFT JOIN s_vendors v ON s.vendor_id = v.vendor_id""",
    "g_slow": f"""
        SELECT x.product_id, p.product_name, p.brand, x.region, x.total_quantity_sold, x.total_sales, x.order_count, x.first_sale_date, x.last_sale_date,
               CAST(date_diff('day', x.last_sale_date, (SELECT max(day) FROM g_sales)) AS INTEGER) AS days_since_last_sale,
               CAST(date_diff('day', x.first_sale_date, x.last_sale_date) AS INTEGER) AS selling_period_days,
               CASE WHEN x.last_sale_date > x.first_sale_date
                    THEN {div('x.total_quantity_sold', "date_diff('day', x.first_sale_date, x.last_sale_date)", 2)}
                    ELSE CAST(x.total_quantity_sold AS DOUBLE) END AS avg_daily_quantity
        FROM (SELECT product_id, region, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, sum(sales) AS total_sales, count(DISTINCT order_id) AS order_count,
                     min(day) AS first_sale_date, max(day) AS last_sale_date FROM g_sales GROUP BY 1, 2) x
        LEFT JOIN s_products p ON x.product_id = p.product_id""",
    "g_history": f"""
        SELECT *, CASE WHEN total_returns >= 5 AND avg_return_to_sales_ratio > 0.8 THEN 'HIGH'
                       WHEN total_returns >= 3 OR max_single_refund > 400 THEN 'MEDIUM' ELSE 'LOW' END AS fraud_risk_score
        FROM (SELECT r.customer_id, c.customer_name, c.customer_email, r.segment, r.region, count(*) AS total_returns, sum(r.refund_amount) AS total_refund_amount,
                     {div('sum(r.refund_amount)', 'count(r.refund_amount)', 2)} AS avg_refund_amount, max(r.refund_amount) AS max_single_refund,
                     min(r.return_date) AS first_return_date, max(r.return_date) AS last_return_date,
                     CAST(date_diff('day', min(r.return_date), max(r.return_date)) AS INTEGER) AS days_between_first_last_return,
                     count(DISTINCT r.return_reason) AS distinct_reasons,
                     {div('sum(r.return_to_sales_ratio)', 'count(r.return_to_sales_ratio)', 2)} AS avg_return_to_sales_ratio
              FROM g_returns r LEFT JOIN s_customers c ON r.customer_id = c.customer_id GROUP BY 1, 2, 3, 4, 5) t""",
    # --- fraud ------------------------------------------------------------------------------------
    "f_profile": """
        SELECT b.customer_id, c.customer_name, c.segment, c.region, b.total_returns, coalesce(o.total_orders, 0) AS total_orders,
               CASE WHEN o.total_orders > 0 THEN CAST(b.total_returns AS DOUBLE) / o.total_orders ELSE 0.0 END AS order_return_rate,
               coalesce(b.total_refund_value, 0) AS total_refund_value, coalesce(i.total_refund_inflation, 0) AS total_refund_inflation,
               coalesce(i.max_single_inflation, 0) AS max_single_inflation, coalesce(i.inflated_refund_count, 0) AS inflated_refund_count,
               coalesce(d.n, 0) AS duplicate_order_count, coalesce(t.before_n, 0) AS return_before_delivery_count,
               coalesce(t.same_n, 0) AS same_day_ship_return_count, coalesce(x.n, 0) AS no_matching_order_count, b.distinct_reasons, b.return_reasons
        FROM (SELECT customer_id, count(*) AS total_returns, sum(refund_amount) AS total_refund_value, count(DISTINCT return_reason) AS distinct_reasons,
                     array_to_string(list_sort(list(DISTINCT return_reason)), '|') AS return_reasons FROM g_returns GROUP BY 1) b
        LEFT JOIN (SELECT customer_id, sum(refund_amount - original_sales) AS total_refund_inflation, max(refund_amount - original_sales) AS max_single_inflation,
                          count(CASE WHEN refund_amount > original_sales THEN 1 END) AS inflated_refund_count
                   FROM g_returns WHERE refund_amount IS NOT NULL AND original_sales IS NOT NULL GROUP BY 1) i ON b.customer_id = i.customer_id
        LEFT JOIN (SELECT customer_id, count(*) AS n FROM g_returns WHERE return_reason = 'Duplicate Order' GROUP BY 1) d ON b.customer_id = d.customer_id
        LEFT JOIN (SELECT r.customer_id, count(CASE WHEN r.return_date < CAST(o.order_delivered_customer_timestamp AS DATE) THEN 1 END) AS before_n,
                          count(CASE WHEN o.ship_mode = 'Same Day' THEN 1 END) AS same_n
                   FROM g_returns r LEFT JOIN s_orders o ON r.order_id = o.order_id GROUP BY 1) t ON b.customer_id = t.customer_id
        LEFT JOIN (SELECT customer_id, count(*) AS n FROM g_returns r WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = r.order_id) GROUP BY 1) x
               ON b.customer_id = x.customer_id
        LEFT JOIN (SELECT customer_id, count(*) AS total_orders FROM s_orders GROUP BY 1) o ON b.customer_id = o.customer_id
        LEFT JOIN s_customers c ON b.customer_id = c.customer_id""",
    "f_points": """
        SELECT *, CASE WHEN total_returns >= 5 THEN 20.0 ELSE 0.0 END AS score_high_return_volume,
               CASE WHEN total_refund_value >= 1000 THEN 10.0 ELSE 0.0 END AS score_high_refund_value,
               CASE WHEN order_return_rate >= CAST(0.3 AS DOUBLE) THEN 10.0 ELSE 0.0 END AS score_high_order_return_rate,
               CASE WHEN total_refund_inflation >= 500 THEN 20.0 ELSE 0.0 END AS score_refund_inflation,
               CASE WHEN return_before_delivery_count >= 1 THEN 10.0 ELSE 0.0 END AS score_return_before_delivery,
               CASE WHEN duplicate_order_count >= 1 THEN 10.0 ELSE 0.0 END AS score_duplicate_order_reason,
               CASE WHEN same_day_ship_return_count >= 1 THEN 5.0 ELSE 0.0 END AS score_same_day_ship_return,
               CASE WHEN no_matching_order_count >= 1 THEN 15.0 ELSE 0.0 END AS score_no_matching_order
        FROM f_profile""",
    "f_scored": """
        SELECT *, score_high_return_volume + score_high_refund_value + score_high_order_return_rate + score_refund_inflation + score_return_before_delivery
                  + score_duplicate_order_reason + score_same_day_ship_return + score_no_matching_order AS anomaly_score,
               concat_ws('|', CASE WHEN score_high_return_volume > 0 THEN 'high_return_volume' END, CASE WHEN score_high_refund_value > 0 THEN 'high_refund_value' END,
                  CASE WHEN score_high_order_return_rate > 0 THEN 'high_order_return_rate' END, CASE WHEN score_refund_inflation > 0 THEN 'refund_inflation' END,
                  CASE WHEN score_return_before_delivery > 0 THEN 'return_before_delivery' END, CASE WHEN score_duplicate_order_reason > 0 THEN 'duplicate_order_reason' END,
                  CASE WHEN score_same_day_ship_return > 0 THEN 'same_day_ship_return' END, CASE WHEN score_no_matching_order > 0 THEN 'no_matching_order' END) AS rules_violated
        FROM f_points""",
    "f_flagged": "SELECT * FROM f_scored WHERE anomaly_score >= 40",
    "f_leads": f"""
        SELECT t.*, CASE WHEN lead_score >= 65 THEN 'HOT' WHEN lead_score >= 35 THEN 'WARM' ELSE 'COLD' END AS lead_label
        FROM (SELECT *, CAST(round(greatest(CAST(purchase_value_score AS DECIMAL(8,2)) + CAST(frequency_score AS DECIMAL(8,2)) + CAST(recency_score AS DECIMAL(8,2)) - CAST(return_penalty AS DECIMAL(8,2)), 0), 1) AS DECIMAL(8,1)) AS lead_score
              FROM (SELECT b.customer_id, b.total_spent, b.total_orders,
                           {div('least(coalesce(r.n, 0), b.total_orders)', 'b.total_orders', 1, 100)} AS return_rate_pct,
                           {div('b.total_spent', '(SELECT max(s) FROM (SELECT sum(sales) AS s FROM g_sales GROUP BY customer_id))', 2, 40)} AS purchase_value_score,
                           {div('b.total_orders', '(SELECT max(n) FROM (SELECT count(DISTINCT order_id) AS n FROM g_sales GROUP BY customer_id))', 2, 30)} AS frequency_score,
                           {div("greatest(365 - date_diff('day', b.last_day, (SELECT max(day) FROM g_sales)), 0)", 'CAST(365 AS BIGINT)', 2, 30)} AS recency_score,
                           {div('least(coalesce(r.n, 0), b.total_orders)', 'b.total_orders', 2, 20)} AS return_penalty
                    FROM (SELECT customer_id, sum(sales) AS total_spent, count(DISTINCT order_id) AS total_orders, max(day) AS last_day FROM g_sales GROUP BY 1) b
                    LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS n FROM g_returns GROUP BY 1) r ON b.customer_id = r.customer_id) parts) t""",
    # --- baskets ----------------------------------------------------------------------------------
    "k_basket": "SELECT DISTINCT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id FROM s_lines",
    "k_counts": "SELECT product_id, count(*) AS n FROM k_basket GROUP BY 1",
    "k_pairs": """
        SELECT a.product_id AS product_a, b.product_id AS product_b, count(*) AS pair_order_count
        FROM k_basket a JOIN k_basket b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2 HAVING count(*) >= 2""",
    "k_ratios": f"""
        SELECT p.*, t.total_orders, a.n AS count_a, b.n AS count_b, {div('p.pair_order_count', 't.total_orders', 6)} AS support,
               {div('p.pair_order_count', 'a.n', 4)} AS confidence_atob, {div('p.pair_order_count', 'b.n', 4)} AS confidence_btoa
        FROM k_pairs p JOIN k_counts a ON p.product_a = a.product_id JOIN k_counts b ON p.product_b = b.product_id
        CROSS JOIN (SELECT count(DISTINCT order_id) AS total_orders FROM k_basket) t""",
    "k_metrics": f"""
        SELECT * FROM (SELECT *, {div('CAST(confidence_atob AS DECIMAL(6,4)) * total_orders', 'count_b', 4)} AS lift_atob,
                              {div('CAST(confidence_btoa AS DECIMAL(6,4)) * total_orders', 'count_a', 4)} AS lift_btoa FROM k_ratios) m
        WHERE (confidence_atob >= CAST(0.2 AS DOUBLE) OR confidence_btoa >= CAST(0.2 AS DOUBLE)) AND (lift_atob > 1 OR lift_btoa > 1)""",
    "k_rules": """
        SELECT product_a AS antecedent_id, product_b AS consequent_id, support, confidence_atob AS confidence, lift_atob AS lift, pair_order_count
        FROM k_metrics WHERE confidence_atob >= CAST(0.2 AS DOUBLE) AND lift_atob > 1
        UNION ALL SELECT product_b, product_a, support, confidence_btoa, lift_btoa, pair_order_count FROM k_metrics WHERE confidence_btoa >= CAST(0.2 AS DOUBLE) AND lift_btoa > 1""",
    "k_labels": "SELECT CAST(product_id AS VARCHAR) AS product_id, product_name || ' | ' || categories || ' | ' || brand AS label FROM s_products",
    "k_enriched": """
        SELECT r.*, coalesce(a.label, r.antecedent_id) AS antecedent_label, coalesce(c.label, r.consequent_id) AS consequent_label,
               CASE WHEN lift >= 3 THEN 'Strong' WHEN lift >= 1.5 THEN 'Moderate' ELSE 'Weak' END AS rule_strength,
               'IF [' || coalesce(a.label, r.antecedent_id) || '] THEN [' || coalesce(c.label, r.consequent_id) || ']' AS rule_label
        FROM k_rules r LEFT JOIN k_labels a ON r.antecedent_id = a.product_id LEFT JOIN k_labels c ON r.consequent_id = c.product_id""",
    "k_itemsets": """
        SELECT p.product_a, p.product_b, coalesce(a.label, p.product_a) || '  +  ' || coalesce(b.label, p.product_b) AS itemset_label,
               p.pair_order_count AS freq, 2 AS itemset_size
        FROM k_pairs p LEFT JOIN k_labels a ON p.product_a = a.product_id LEFT JOIN k_labels b ON p.product_b = b.product_id""",
    # --- pricing ------------------------------------------------------------------------------------
    "p_lines": f"""
        SELECT g.*, CAST(CASE WHEN discount >= 1 THEN discount / 100 ELSE discount END AS DECIMAL(10,4)) AS nd,
               {micro('sales', '(quantity * (1 - CAST(discount AS DECIMAL(10,4))))')} AS lp, {micro('sales', 'quantity')} AS unit_sales, {micro('profit', 'quantity')} AS unit_profit,
               p.product_name, p.brand, split_part(p.categories, ',', 1) AS top_category, v.vendor_name
        FROM g_sales g LEFT JOIN s_products p ON g.product_id = p.product_id LEFT JOIN s_vendors v ON g.vendor_id = v.vendor_id
        WHERE g.sales IS NOT NULL AND g.quantity > 0""",
    "p_history": """
        SELECT product_id, vendor_id, base_unit_price, valid_from,
               lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current, CAST(row_number() OVER w AS INTEGER) AS version_rank,
               sum(base_unit_price) OVER run AS total, count(base_unit_price) OVER run AS n,
               min(base_unit_price) OVER run AS min_price_to_date, max(base_unit_price) OVER run AS max_price_to_date
        FROM (SELECT t.product_id, t.vendor_id, CAST(""" + div("sales", "(quantity * (1 - CAST(discount AS DECIMAL(10,4))))", 2) + """ AS DECIMAL(12,2)) AS base_unit_price,
                     min(o.order_purchase_timestamp) AS valid_from
              FROM s_lines t JOIN s_orders o ON t.order_id = o.order_id WHERE sales IS NOT NULL GROUP BY 1, 2, 3) versions
        WINDOW w AS (PARTITION BY product_id, vendor_id ORDER BY valid_from, base_unit_price),
               run AS (PARTITION BY product_id, vendor_id ORDER BY valid_from, base_unit_price ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
}

PRICE_MEASURES = {
    "txns": "count(*)",
    "total_units": "CAST(sum(quantity) AS BIGINT)",
    "avg_unit_price": div("sum(unit_sales)", "count(unit_sales)", 2),
    "avg_discount_pct": div("sum(nd)", "count(nd)", 1, 100),
    "max_discount_pct": div("max(nd)", "1", 1, 100),
    "total_revenue": "sum(sales)",
    "total_profit": "round(sum(profit), 2)",
    "margin_pct": div("sum(profit)", "sum(sales)", 1, 100),
    "avg_unit_profit": div("sum(unit_profit)", "count(unit_profit)", 2),
    "min_list_price": "round(min(lp), 2)",
    "max_list_price": "round(max(lp), 2)",
}


def measures(*names: str) -> str:
    return ", ".join(f"{PRICE_MEASURES[n]} AS {n}" for n in names)


RULE_COUNT = len(RULES)
