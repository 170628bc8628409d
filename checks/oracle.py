"""DuckDB SQL with the same results as the registered queries.

Written on its own terms: sessions come from ordering every event by user, baskets from
a plain self-join, quantiles and modes from DuckDB.  Whole-number quotients are rounded
half up in integers, because floating-point averages of cents hit exact ties.
"""

from __future__ import annotations

MID_SPEND, HIGH_SPEND = 500_000, 1_000_000
AS_OF = "2002-01-01"
RANGE = ("20240105", "20240120")
STATUS_LIMIT = 100


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Non-negative quotient rounded half up, null when the denominator is 0."""
    scale = 10**digits
    top = f"2 * {scale} * CAST(({numerator}) AS HUGEINT) + ({denominator})"
    whole = f"(({top}) // nullif(2 * CAST(({denominator}) AS HUGEINT), 0))"
    return f"(CAST({whole} AS DOUBLE) / {scale})" if digits else f"CAST({whole} AS DOUBLE)"


def money_mean(total_cents: str, count: str, digits: int = 2) -> str:
    return half_up(total_cents, f"100 * ({count})", digits)


def usd(total_cents: str) -> str:
    return f"(CAST({total_cents} AS DOUBLE) / 100)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


CTES: dict[str, str] = {
    "line": f"""
        SELECT l_orderkey AS transaction_id, l_partkey AS product_id,
               CAST(l_quantity AS BIGINT) AS quantity,
               {cents("l_extendedprice")} AS sub_cents,
               CAST(round(l_discount * 100) AS BIGINT) AS off_pct
        FROM lineitem""",
    "txn": f"""
        SELECT o_orderkey AS transaction_id,
               CASE WHEN o_orderkey % 4 <> 0
                    THEN o_custkey || '#' || (1 + (o_orderkey // 4) % 24) END AS session_id,
               o_custkey AS user_id, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS day,
               strftime(o_orderdate, '%Y-%m') AS year_month,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing'
                                  WHEN 'P' THEN 'shipped' END AS status,
               {cents("o_totalprice")} AS total_cents, sub_cents,
               coalesce(off_cents, 0) AS off_cents, n_lines
        FROM orders LEFT JOIN (
            SELECT transaction_id, {big("sum(sub_cents)")} AS sub_cents,
                   {big("(2 * sum(sub_cents * off_pct) + 100) // 200")} AS off_cents,
                   count(*) AS n_lines
            FROM line GROUP BY transaction_id) totals
          ON o_orderkey = totals.transaction_id""",
    "done": "SELECT * FROM txn WHERE status = 'completed'",
    "sold": """
        SELECT l.*, d.user_id, d.day, d.off_cents, d.n_lines,
               (2 * l.sub_cents + l.quantity) // (2 * l.quantity) AS price_cents
        FROM line l JOIN done d USING (transaction_id)""",
    "product": """
        SELECT p_partkey AS product_id, p_name AS name,
               'Category ' || p_brand AS category,
               p_type AS subcategory
        FROM part""",
    "buyer": """
        SELECT c_custkey AS user_id, min(o_orderdate) AS registration_date,
               max(o_orderdate) AS last_active,
               max(CASE WHEN c_custkey % 20 <> 0 THEN n_name ELSE 'Unknown' END) AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey""",
    "event": """
        SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
               sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
        FROM (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR
                             THEN 0 ELSE 1 END AS begins
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "session": """
        SELECT user_id || '#' || session_no AS session_id, user_id, session_no,
               start_time, end_time,
               CAST(floor(epoch(end_time)) - floor(epoch(start_time)) AS BIGINT) AS duration,
               CASE WHEN purchases > 0 THEN 'converted' WHEN clicks > 0 THEN 'abandoned'
                    ELSE 'browsed' END AS status,
               CASE WHEN k % 50 <> 0 THEN ['mobile', 'desktop', 'tablet'][k % 3 + 1] END AS device,
               CASE WHEN k % 50 <> 0
                    THEN ['iOS', 'Android', 'Windows', 'macOS'][k % 4 + 1] END AS os,
               CASE WHEN k % 50 <> 0
                    THEN ['Chrome', 'Safari', 'Firefox', 'Edge'][k % 4 + 1] END AS browser,
               ['direct', 'email', 'social', 'search_engine', 'affiliate'][k % 5 + 1] AS referrer
        FROM (SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS start_time,
                     max(ts) AS end_time, arg_min(k, event_id) AS k,
                     count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
                     count(*) FILTER (WHERE event_type = 'click') AS clicks
              FROM event GROUP BY ALL)""",
    "session_row": """
        SELECT user_id || '#' || lpad(CAST(9223372036854775807 - epoch_us(start_time) // 1000 AS VARCHAR),
                                      19, '0') AS row_key, *
        FROM session""",
    "cart": f"""
        SELECT user_id, CAST(session_no AS BIGINT) AS session_no, CAST(k AS VARCHAR) AS product_id,
               count(*) AS quantity, max({cents("value")}) AS price_cents
        FROM event WHERE event_type = 'click' GROUP BY ALL""",
    "page": """
        SELECT user_id, session_no, event_id, ts, k AS product_id,
               CASE event_type WHEN 'view' THEN 'product_detail' WHEN 'click' THEN 'category_listing'
                    WHEN 'signup' THEN 'home' WHEN 'purchase' THEN 'confirmation'
                    WHEN 'error' THEN 'search' END AS page_type,
               CAST(floor(value) AS BIGINT) AS view_duration
        FROM event""",
    "view_day": f"""
        SELECT product_id || '#' || strftime(ts, '%Y%m%d') AS row_key, product_id,
               strftime(ts, '%Y%m%d') AS day, count(*) AS views,
               count(DISTINCT user_id) AS unique_users,
               {half_up("sum(view_duration)", "count(*)", 1)} AS avg_dur_sec
        FROM page WHERE page_type = 'product_detail' GROUP BY product_id, day""",
    "cart_day": f"""
        SELECT product_id, strftime(start_time, '%Y%m%d') AS day,
               {big("sum(quantity)")} AS add_count,
               {usd("sum(quantity * price_cents)")} AS total_value_added
        FROM cart JOIN session USING (user_id, session_no) GROUP BY ALL""",
    "sale_day": f"""
        SELECT product_id, strftime(day, '%Y%m%d') AS day, {big("sum(quantity)")} AS units_sold,
               {usd("sum(sub_cents)")} AS revenue, count(DISTINCT transaction_id) AS order_count
        FROM sold GROUP BY product_id, sold.day""",
    "daily": f"""
        SELECT day, count(*) AS orders, {big("sum(total_cents)")} AS revenue_cents,
               {big("sum(off_cents)")} AS off_cents
        FROM done GROUP BY day""",
    "clv": f"""
        SELECT *, 100.0 * total_discount / (clv + total_discount + 0.01) AS discount_rate
        FROM (SELECT user_id, count(*) AS order_count, {usd("sum(total_cents)")} AS clv,
                     CAST(sum(total_cents) AS DOUBLE) / (100 * count(*)) AS avg_order_val,
                     {usd("sum(off_cents)")} AS total_discount, min(ts) AS first_purchase,
                     max(ts) AS last_purchase
              FROM done GROUP BY user_id)""",
    "tiered": """
        SELECT clv.*, CASE WHEN clv <= q[1] THEN 'Low' WHEN clv <= q[2] THEN 'Mid'
                           ELSE 'High' END AS clv_tier
        FROM clv, (SELECT quantile_cont(clv, [0.33, 0.66]) AS q FROM clv)""",
    "device_mode": """
        SELECT user_id, device AS preferred_device FROM (
            SELECT user_id, coalesce(device, 'unknown') AS device,
                   row_number() OVER (PARTITION BY user_id
                                      ORDER BY count(*) DESC, coalesce(device, 'unknown')) AS place
            FROM session GROUP BY user_id, coalesce(device, 'unknown')) WHERE place = 1""",
    "referrer_mode": """
        SELECT user_id, referrer AS primary_referrer FROM (
            SELECT user_id, referrer,
                   row_number() OVER (PARTITION BY user_id
                                      ORDER BY count(*) DESC, referrer) AS place
            FROM session GROUP BY user_id, referrer) WHERE place = 1""",
    "engagement": f"""
        SELECT user_id, count(*) AS total_sessions,
               {half_up("sum(duration)", "count(*)", 1)} AS avg_session_dur,
               {big("sum(duration)")} AS total_session_dur,
               count(*) FILTER (WHERE status = 'converted') AS converted,
               count(*) FILTER (WHERE status = 'abandoned') AS abandoned,
               round(100.0 * count(*) FILTER (WHERE status = 'converted')
                     / (count(*) + 0.001), 2) AS user_conversion_rate,
               any_value(preferred_device) AS preferred_device,
               any_value(primary_referrer) AS primary_referrer
        FROM session JOIN device_mode USING (user_id) JOIN referrer_mode USING (user_id)
        GROUP BY user_id""",
    "profile": """
        SELECT t.user_id, t.order_count, t.clv AS total_spend, t.avg_order_val, t.total_discount,
               t.first_purchase, t.last_purchase, t.clv,
               CAST(datediff('day', t.first_purchase, t.last_purchase) AS BIGINT) AS lifespan_days,
               round(t.discount_rate, 2) AS discount_rate_pct, t.clv_tier,
               coalesce(e.total_sessions, 0) AS total_sessions,
               coalesce(e.avg_session_dur, 0.0) AS avg_session_dur,
               e.total_session_dur, e.converted, e.abandoned,
               coalesce(e.user_conversion_rate, 0.0) AS user_conversion_rate,
               coalesce(e.preferred_device, 'unknown') AS preferred_device,
               coalesce(e.primary_referrer, 'unknown') AS primary_referrer,
               b.registration_date, b.country
        FROM tiered t LEFT JOIN engagement e USING (user_id) LEFT JOIN buyer b USING (user_id)""",
    "linked": """
        SELECT d.transaction_id, d.total_cents, s.device, s.os
        FROM done d JOIN session s USING (session_id)""",
    "allocated": f"""
        SELECT category AS category_name, gross AS gross_revenue, off AS total_discount,
               units_sold, gross - off AS net_revenue, 100.0 * off / (gross + 0.01) AS discount_rate
        FROM (SELECT category, {usd("sum(sub_cents)")} AS gross,
                     sum(CAST(off_cents AS DOUBLE) / n_lines) / 100 AS off,
                     {big("sum(quantity)")} AS units_sold
              FROM sold JOIN product USING (product_id) WHERE category IS NOT NULL
              GROUP BY category)""",
    "funnel": """
        SELECT referrer, count(*) AS total,
               count(*) FILTER (WHERE status = 'converted') AS converted,
               count(*) FILTER (WHERE status = 'abandoned') AS abandoned,
               count(*) FILTER (WHERE status = 'browsed') AS browsed,
               sum(duration) AS duration
        FROM session GROUP BY referrer""",
}

SEGMENT_MEANS = f"""
    count(*) AS user_count, {money_mean(f"sum({cents('clv')})", "count(*)")} AS avg_clv,
    {half_up("sum(order_count)", "count(*)", 2)} AS avg_order_count,
    {half_up("sum(total_sessions)", "count(*)", 2)} AS avg_sessions,
    {money_mean(f"sum({cents('avg_session_dur')})", "count(*)")} AS avg_session_dur_sec,
    {money_mean(f"sum({cents('user_conversion_rate')})", "count(*)")} AS avg_conversion_rate,
    {money_mean(f"sum({cents('discount_rate_pct')})", "count(*)")} AS avg_discount_rate_pct"""


def matrix_cell(os_name: str) -> str:
    held = f"coalesce(sum(total_cents) FILTER (WHERE coalesce(os, 'unknown') = '{os_name}'), 0)"
    return f'{half_up(held, "100000", 1)} AS "{os_name}"'


SELECTS: dict[str, str] = {
    "clean_transactions": f"""
        SELECT transaction_id, session_id, user_id, {stamp("ts")} AS timestamp,
               {usd("sub_cents")} AS subtotal, {usd("off_cents")} AS discount,
               {usd("total_cents")} AS total, status, total_cents <= 0 AS is_suspicious,
               strftime(day, '%Y-%m-%d') AS date, year_month FROM txn""",
    "clean_users": f"""
        SELECT user_id, country, {stamp("registration_date")} AS registration_date,
               {stamp("last_active")} AS last_active,
               strftime(registration_date, '%Y-%m') AS reg_year_month,
               CAST(datediff('day', registration_date, DATE '{AS_OF}') AS INTEGER) AS tenure_days
        FROM buyer""",
    "clean_products": """
        SELECT p_partkey AS product_id, p_name AS name, p_brand AS category_id,
               p_retailprice AS base_price,
               CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_size END AS current_stock,
               p_size % 20 <> 0 AS is_active, CAST(p_partkey % 3 AS INTEGER) AS price_history_len,
               p_partkey % 3 = 2 AS is_price_volatile FROM part""",
    "enrich_products": """
        SELECT product_id, name, coalesce(category, 'Unknown') AS category_name,
               coalesce(subcategory, 'Unknown') AS subcategory_name FROM product""",
    "transaction_quality_profile": f"""
        SELECT count(*) AS total_transactions,
               count(*) FILTER (WHERE session_id IS NULL) AS standalone,
               count(*) FILTER (WHERE total_cents <= 0) AS suspicious,
               {half_up("100 * count(*) FILTER (WHERE session_id IS NULL)", "count(*)", 1)}
                   AS standalone_pct FROM txn""",
    "daily_revenue": f"""
        SELECT strftime(day, '%Y-%m-%d') AS date, orders AS daily_orders,
               {usd("revenue_cents")} AS daily_revenue,
               {money_mean("sum(revenue_cents) OVER w", "count(*) OVER w")} AS rolling_7d_avg,
               {usd("off_cents")} AS daily_discount
        FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "daily_revenue_series": f"""
        SELECT strftime(day, '%Y-%m-%d') AS date, {usd("revenue_cents")} AS revenue, orders,
               {usd("off_cents")} AS discount,
               CAST(sum(revenue_cents) OVER w AS DOUBLE) / (100 * count(*) OVER w) AS rolling7
        FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "funnel_by_referrer": f"""
        SELECT referrer, total AS total_sessions, converted, abandoned, browsed,
               {half_up("100 * converted", "total", 2)} AS conversion_rate_pct,
               {half_up("duration", "total", 0)} AS avg_session_dur_sec FROM funnel""",
    "revenue_by_device_os": f"""
        SELECT device AS device_type, os, count(DISTINCT transaction_id) AS transactions,
               {usd("sum(total_cents)")} AS revenue,
               {money_mean("sum(total_cents)", "count(*)")} AS avg_order_value
        FROM linked GROUP BY device, os""",
    "ltv_segments": f"""
        SELECT CASE WHEN spend > {HIGH_SPEND}00 THEN 'High Value'
                    WHEN spend > {MID_SPEND}00 THEN 'Mid Value' ELSE 'Low Value' END AS ltv_segment,
               count(*) AS user_count, {money_mean("sum(spend)", "count(*)")} AS avg_ltv,
               {half_up("sum(orders)", "count(*)", 1)} AS avg_orders,
               {money_mean("sum(order_value)", "count(*)")} AS avg_order_value,
               {half_up("sum(lifespan)", "count(*)", 0)} AS avg_lifespan_days
        FROM (SELECT user_id, count(*) AS orders, sum(total_cents) AS spend,
                     (2 * sum(total_cents) + count(*)) // (2 * count(*)) AS order_value,
                     datediff('day', min(day), max(day)) AS lifespan
              FROM done GROUP BY user_id)
        GROUP BY 1""",
    "copurchase_pairs": f"""
        SELECT product_a, na.name AS name_a, product_b, nb.name AS name_b, co_purchase_count,
               {half_up("co_purchase_count", "ca.n + cb.n - co_purchase_count", 4)}
                   AS jaccard_similarity
        FROM (SELECT a.product_id AS product_a, b.product_id AS product_b,
                     count(*) AS co_purchase_count
              FROM sold a JOIN sold b
                ON a.transaction_id = b.transaction_id AND a.product_id < b.product_id
              GROUP BY ALL HAVING count(*) >= 2)
        JOIN (SELECT product_id, count(*) AS n FROM sold GROUP BY ALL) ca
          ON product_a = ca.product_id
        JOIN (SELECT product_id, count(*) AS n FROM sold GROUP BY ALL) cb
          ON product_b = cb.product_id
        JOIN product na ON product_a = na.product_id
        JOIN product nb ON product_b = nb.product_id
        ORDER BY co_purchase_count DESC, product_a, product_b LIMIT 10""",
    "cohort_revenue": f"""
        SELECT cohort_month, txn_month, count(*) AS active_users,
               {usd("sum(spend)")} AS cohort_revenue,
               {money_mean("sum(spend)", "count(*)")} AS arpu
        FROM (SELECT strftime(registration_date, '%Y-%m') AS cohort_month,
                     year_month AS txn_month, user_id, sum(total_cents) AS spend
              FROM done JOIN buyer USING (user_id) GROUP BY ALL)
        GROUP BY cohort_month, txn_month""",
    "user_monthly_spend": f"""
        SELECT user_id, year_month AS txn_month, {usd("sum(total_cents)")} AS monthly_spend
        FROM done GROUP BY user_id, year_month""",
    "product_purchase_counts": """
        SELECT product_id, count(*) AS purchase_count FROM sold GROUP BY product_id""",
    "product_popularity": f"""
        SELECT product_id, coalesce(name, 'Unknown') AS product_name,
               coalesce(category, 'Unknown') AS category_name, units AS total_units,
               {usd("sub_cents")} AS total_revenue, n AS order_count,
               {money_mean("price_cents", "n")} AS avg_unit_price
        FROM (SELECT product_id, {big("sum(quantity)")} AS units, sum(sub_cents) AS sub_cents,
                     sum(price_cents) AS price_cents, count(*) AS n FROM sold GROUP BY product_id)
        LEFT JOIN product USING (product_id)
        ORDER BY sub_cents DESC, product_id LIMIT 15""",
    "revenue_by_category": f"""
        SELECT category, gross AS gross_revenue, total_orders, total_units_sold,
               off AS total_discount, unique_products,
               round(off / (gross + 0.01) * 100, 2) AS discount_pct
        FROM (SELECT CASE WHEN product.product_id IS NOT NULL
                          THEN coalesce(category, 'Unknown') END AS category,
                     {usd("sum(sub_cents)")} AS gross, count(*) AS total_orders,
                     {big("sum(quantity)")} AS total_units_sold,
                     {usd("sum(off_cents)")} AS off,
                     count(DISTINCT sold.product_id) AS unique_products
              FROM sold LEFT JOIN product ON sold.product_id = product.product_id GROUP BY 1)""",
    "category_revenue_allocated": """
        SELECT category_name, gross_revenue, round(total_discount, 2) AS total_discount, units_sold,
               round(net_revenue, 2) AS net_revenue, round(discount_rate, 2) AS discount_rate
        FROM allocated ORDER BY net_revenue DESC, category_name LIMIT 12""",
    "clv_features": f"""
        SELECT user_id, order_count, clv AS total_spend, avg_order_val, total_discount,
               {stamp("first_purchase")} AS first_purchase,
               {stamp("last_purchase")} AS last_purchase, clv,
               CAST(datediff('day', first_purchase, last_purchase) AS BIGINT) AS lifespan_days,
               round(discount_rate, 2) AS discount_rate_pct FROM clv""",
    "clv_tier": "SELECT user_id, clv, clv_tier FROM tiered",
    "engagement_features": "SELECT * FROM engagement",
    "unified_profile": f"""
        SELECT * REPLACE ({stamp("first_purchase")} AS first_purchase,
                          {stamp("last_purchase")} AS last_purchase,
                          {stamp("registration_date")} AS registration_date) FROM profile""",
    "clv_segment_summary": f"SELECT clv_tier, {SEGMENT_MEANS} FROM profile GROUP BY clv_tier",
    "clv_segment_behaviour": f"""
        SELECT clv_tier, avg_clv, avg_order_count AS avg_orders, avg_sessions,
               avg_conversion_rate AS avg_conv_rate, user_count
        FROM (SELECT clv_tier, {SEGMENT_MEANS} FROM profile GROUP BY clv_tier)""",
    "top_clv_users": """
        SELECT user_id, clv, order_count, total_sessions, avg_session_dur, user_conversion_rate,
               preferred_device FROM profile ORDER BY clv DESC, user_id LIMIT 10""",
    "referrer_revenue": f"""
        SELECT primary_referrer, count(*) AS user_count, {usd(f"sum({cents('clv')})")} AS total_rev,
               {money_mean(f"sum({cents('clv')})", "count(*)")} AS avg_clv,
               {money_mean(f"sum({cents('user_conversion_rate')})", "count(*)")} AS avg_conv_rate
        FROM profile GROUP BY primary_referrer""",
    "clv_segments_fixed": f"""
        SELECT CASE WHEN clv > {HIGH_SPEND} THEN 'High' WHEN clv > {MID_SPEND} THEN 'Mid'
                    ELSE 'Low' END AS clv_tier,
               count(*) AS users, {money_mean(f"sum({cents('clv')})", "count(*)")} AS avg_clv,
               {half_up("sum(order_count)", "count(*)", 1)} AS avg_orders,
               {half_up("sum(n)", "count(n)", 1)} AS avg_sessions
        FROM clv LEFT JOIN (SELECT user_id, count(*) AS n FROM session GROUP BY user_id)
        USING (user_id) GROUP BY 1""",
    "funnel_composition": """
        SELECT referrer, converted, abandoned, browsed, total,
               CAST(100 * converted AS DOUBLE) / total AS conversion_rate,
               CAST(100 * converted AS DOUBLE) / total >
                   (SELECT quantile_cont(CAST(100 * converted AS DOUBLE) / total, 0.5) FROM funnel)
                   AS above_median FROM funnel""",
    "referrer_conversion": """
        SELECT referrer, CAST(converted AS DOUBLE) / total * 100 AS conversion_pct FROM funnel""",
    "device_os_matrix": f"""
        SELECT coalesce(device, 'unknown') AS device_type,
               {", ".join(map(matrix_cell, ["iOS", "Android", "Windows", "macOS", "other", "unknown"]))}
        FROM linked GROUP BY 1""",
    "kpi_summary": f"""
        SELECT {usd("sum(total_cents)")} AS total_revenue,
               {money_mean("sum(total_cents)", "count(*)")} AS avg_order_value,
               (SELECT referrer FROM funnel
                ORDER BY CAST(converted AS DOUBLE) / total DESC, referrer LIMIT 1) AS best_referrer,
               (SELECT round(max(CAST(converted AS DOUBLE) / total * 100), 2) FROM funnel)
                   AS best_conversion_pct,
               (SELECT category_name FROM allocated
                ORDER BY net_revenue DESC, category_name LIMIT 1) AS top_category
        FROM done""",
    "user_session_rows": f"""
        SELECT row_key, user_id, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS start_time,
               strftime(end_time, '%Y-%m-%dT%H:%M:%S') AS end_time,
               CAST(duration AS INTEGER) AS duration_seconds, coalesce(device, '') AS device_type,
               coalesce(os, '') AS device_os, coalesce(browser, '') AS browser, referrer,
               status AS conversion_status, '' AS city, '' AS state, '' AS country,
               '' AS ip_address, coalesce(product_ids, '[]') AS product_ids,
               coalesce(total_value, 0.0) AS total_value
        FROM session_row LEFT JOIN (
            SELECT user_id, session_no,
                   '["' || string_agg(product_id, '","' ORDER BY product_id) || '"]' AS product_ids,
                   {usd("sum(quantity * price_cents)")} AS total_value
            FROM cart GROUP BY user_id, session_no) USING (user_id, session_no)""",
    "recent_sessions": """
        SELECT row_key, user_id, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS start_time,
               status AS conversion_status
        FROM session_row QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY row_key) <= 5""",
    "filter_by_value_limit": f"""
        SELECT row_key, user_id, status AS conversion_status FROM session_row
        WHERE status = 'converted' ORDER BY row_key LIMIT {STATUS_LIMIT}""",
    "key_range_scan": """
        SELECT row_key, user_id, CAST(duration AS INTEGER) AS duration_seconds FROM session_row
        WHERE row_key >= '1' AND row_key < '3'""",
    "point_lookup": """
        SELECT strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS start_time,
               strftime(end_time, '%Y-%m-%dT%H:%M:%S') AS end_time,
               CAST(duration AS INTEGER) AS duration_seconds, coalesce(device, '') AS device_type,
               coalesce(os, '') AS device_os, coalesce(browser, '') AS browser, referrer,
               status AS conversion_status
        FROM session_row WHERE row_key = (SELECT min(row_key) FROM session_row)""",
    "row_counts": """
        SELECT 'user_sessions' AS table_name, count(*) AS row_count FROM session_row
        UNION ALL SELECT 'product_performance', count(*) FROM view_day""",
    "product_performance_daily": "SELECT * FROM view_day",
    "product_performance_range": f"""
        SELECT *, {big("sum(views) OVER (PARTITION BY product_id)")} AS total_views
        FROM view_day WHERE day >= '{RANGE[0]}' AND day < '{RANGE[1]}'""",
    "product_reach_range": f"""
        SELECT product_id, count(DISTINCT user_id) AS unique_users FROM page
        WHERE page_type = 'product_detail' AND strftime(ts, '%Y%m%d') >= '{RANGE[0]}'
              AND strftime(ts, '%Y%m%d') < '{RANGE[1]}' GROUP BY product_id""",
    "order_value_bands": f"""
        SELECT CAST(year(day) AS INTEGER) AS year, {usd("quantile_disc(total_cents, 0.25)")} AS low,
               {usd("quantile_disc(total_cents, 0.5)")} AS median,
               {usd("quantile_disc(total_cents, 0.75)")} AS high, count(*) AS orders
        FROM txn WHERE status = 'completed' GROUP BY 1""",
    "product_sales_daily": "SELECT * FROM sale_day",
    "cart_adds_daily": "SELECT * FROM cart_day",
    "product_performance_table": """
        SELECT product_id || '#' || day AS row_key, views, unique_users, avg_dur_sec, add_count,
               total_value_added, units_sold, revenue, order_count
        FROM (SELECT * EXCLUDE (row_key) REPLACE (CAST(product_id AS VARCHAR) AS product_id)
              FROM view_day)
        FULL JOIN cart_day USING (product_id, day)
        FULL JOIN (SELECT * REPLACE (CAST(product_id AS VARCHAR) AS product_id) FROM sale_day)
            USING (product_id, day)""",
    "page_events": f"""
        SELECT user_id || '#' || user_id || '#' || CAST(session_no AS BIGINT) || '#' ||
               lpad(CAST(row_number() OVER (PARTITION BY user_id, session_no
                                            ORDER BY ts, event_id) - 1 AS VARCHAR), 19, '0')
                   AS row_key,
               page_type, product_id, CAST(view_duration AS INTEGER) AS view_duration,
               {stamp("ts")} AS timestamp FROM page""",
    "upsert_latest": """
        SELECT user_id, max(event_id) AS event_id,
               arg_max(value, event_id) FILTER (WHERE event_type = 'view') AS last_view,
               arg_max(value, event_id) FILTER (WHERE event_type = 'click') AS last_click,
               arg_max(value, event_id) FILTER (WHERE event_type = 'purchase') AS last_purchase
        FROM events GROUP BY user_id""",
}


# Queries with the result of another, reached from sketches, stored layouts or batch by batch.
SAME = {
    "product_reach_sketched": "product_reach_range",
    "daily_revenue_in_sql": "daily_revenue",
    "ltv_segments_in_sql": "ltv_segments",
    "funnel_by_referrer_in_sql": "funnel_by_referrer",
    "stored_revenue_by_category": "revenue_by_category",
    "stored_category_revenue": "category_revenue_allocated",
    "stored_sales_daily": "product_sales_daily",
    "clean_transactions_from_json": "clean_transactions",
    "merged_session_rows": "user_session_rows",
    "ledger_monthly_spend": "user_monthly_spend",
    "ledger_ltv_segments": "ltv_segments",
    "ledger_clv_features": "clv_features",
}


def oracle_sql() -> dict[str, str]:
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())
    selects = SELECTS | {name: SELECTS[as_in] for name, as_in in SAME.items()}
    return {name: f"WITH {ctes}\n{body}" for name, body in selects.items()}
