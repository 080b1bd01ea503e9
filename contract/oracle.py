"""DuckDB statements with the expected result of every registered query.

They follow the definitions literally: plain joins with all their row pairs,
``DISTINCT`` and ``row_number``. The Spark builders avoid exactly those, so an
equal result proves the rewrite. One definition is narrowed on both sides:
where several known addresses share a street, an order takes the one with the
smallest id, because ``order_id`` is the declared key of the orders. That these
statements agree does not prove the narrowing; ``order_address_matches`` counts
all matches by the plain joins.
"""

from __future__ import annotations

import re

NOW = "timestamp '2001-08-01 00:00:00'"
AUDIT = f"'historic' AS data_source, 'batch-1' AS batch_id, {NOW} AS loaded_at"


def key(*columns: str) -> str:
    token = "'_dbt_utils_surrogate_key_null_'"
    return "md5(" + " || '-' || ".join(f"coalesce(cast({c} AS varchar), {token})" for c in columns) + ")"


def part(address: str, back: int) -> str:
    split = f"string_split({address}, ',')"
    return f"coalesce(trim({split}[len({split}) - {back}]), '')"


def money(expression: str, name: str) -> str:
    return f"cast({expression} AS decimal(38,2)) AS {name}"


def big(expression: str, name: str) -> str:
    return f"cast({expression} AS bigint) AS {name}"


def units(expression: str, name: str) -> str:
    return f"cast({expression} AS decimal(38,0)) AS {name}"


def avg(expression: str, name: str) -> str:
    return f"cast(sum({expression}) AS double) / nullif(count({expression}), 0) AS {name}"


def month(stamp: str) -> str:
    return f"cast(date_trunc('month', {stamp}) AS date)"


def _address(bare: str) -> str:
    street = "cast(o_orderkey % 500 AS varchar) || ' Main St'"
    return (
        f"CASE WHEN {bare} THEN {street} ELSE {street} || ', ' || cast(10000 + o_custkey % 50 AS varchar)"
        " || ', City ' || cast(o_custkey % 40 AS varchar) || ', ' || n_name || ', ' || r_name END"
    )


# --- the shop's tables, as staged ---------------------------------------------------------

CTE: dict[str, str] = {
    "s_categories": f"""
        SELECT DISTINCT p_type AS category_id, 'Category ' || p_type AS category_name,
               timestamp '1995-01-01' AS created_at, {AUDIT}
        FROM part""",
    "s_subcategories": f"""
        SELECT DISTINCT p_type || '-' || cast(p_size AS varchar) AS subcategory_id,
               p_type AS category_id, 'Size ' || cast(p_size AS varchar) AS subcategory_name,
               timestamp '1995-01-01' AS created_at, {AUDIT}
        FROM part""",
    "s_products": f"""
        SELECT cast(p_partkey AS varchar) AS product_id, p_type AS category_id,
               p_type || '-' || cast(p_size AS varchar) AS subcategory_id,
               p_name AS product_name, cast(NULL AS varchar) AS description,
               cast(p_retailprice AS decimal(12,2)) AS base_price,
               cast(cast(p_retailprice AS decimal(12,2)) * cast(80 + p_partkey % 21 AS decimal(5,0))
                    / 100 AS decimal(12,2)) AS sale_price,
               cast(p_partkey * 37 % 1001 AS integer) AS stock_quantity,
               cast(NULL AS decimal(8,2)) AS weight_kg, p_partkey % 10 <> 0 AS is_active,
               cast(NULL AS timestamp) AS created_at,
               CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 51 = 0 THEN '  '
                    WHEN p_partkey % 7 = 0 THEN ' ' || p_brand || ' ' ELSE p_brand END AS brand,
               cast(NULL AS varchar) AS sku, cast(NULL AS decimal(3,1)) AS rating,
               cast(NULL AS integer) AS review_count, {AUDIT}
        FROM part""",
    "raw_customers": f"""
        SELECT cast(c_custkey AS varchar) AS customer_id,
               lower(c_name || '@example.com') AS email,
               cast(NULL AS varchar) AS first_name, cast(NULL AS varchar) AS last_name,
               cast(18 + c_custkey % 73 AS integer) AS age,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
               cast(c_acctbal + 15000 AS decimal(12,2)) AS annual_income,
               CASE c_custkey % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married'
                    WHEN 2 THEN 'Divorced' ELSE 'Widowed' END AS marital_status,
               c_mktsegment AS education, cast(NULL AS varchar) AS location_type,
               CASE WHEN c_custkey % 97 = 0 THEN '' WHEN c_custkey % 89 = 0 THEN NULL
                    ELSE ' City ' || cast(c_custkey % 40 AS varchar) END AS city,
               n_name AS state, r_name AS country,
               cast(date '1994-01-01' + cast(c_custkey % 365 AS integer) AS timestamp) AS signup_date,
               CASE WHEN c_custkey % 11 = 0 THEN 'null' WHEN c_custkey % 13 = 0 THEN ''
                    ELSE cast(date '1995-01-01' + cast(c_custkey % 300 AS integer) AS varchar)
               END AS last_login,
               cast(NULL AS varchar) AS preferred_channel, cast(NULL AS boolean) AS is_active,
               {AUDIT}
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "s_customers": """
        SELECT * REPLACE (try_cast(nullif(nullif(last_login, ''), 'null') AS timestamp) AS last_login)
        FROM raw_customers""",
    "s_orders": f"""
        SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_custkey AS varchar) AS customer_id,
               o_orderdate AS order_date, o_orderstatus AS status,
               cast(o_totalprice AS decimal(12,2)) AS total_amount,
               cast(5 + (o_orderkey % 1500) / 100.0 AS decimal(12,2)) AS shipping_cost,
               o_orderpriority AS payment_method,
               {_address("o_orderkey % 10 = 0")} AS shipping_address,
               {_address("o_orderkey % 7 = 0")} AS billing_address,
               o_orderdate AS created_at, cast(NULL AS timestamp) AS updated_at, {AUDIT}
        FROM orders JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "s_order_items": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         cast(round(l_extendedprice * 100) AS bigint)) AS order_item_id,
               cast(l_orderkey AS varchar) AS order_id, cast(l_partkey AS varchar) AS product_id,
               cast(l_quantity AS integer) AS quantity,
               cast(cast(floor(round(l_extendedprice * 100) / l_quantity) AS decimal(14,0)) / 100
                    AS decimal(12,2)) AS unit_price,
               cast(l_extendedprice AS decimal(12,2)) AS total_price, l_shipdate AS created_at,
               {AUDIT}
        FROM lineitem""",
    "s_interactions": f"""
        SELECT cast(event_id AS varchar) AS event_id, cast(user_id AS varchar) AS customer_id,
               props->>'$.k' AS product_id,
               CASE event_type WHEN 'click' THEN 'cart_add' WHEN 'signup' THEN 'wishlist_add'
                    WHEN 'error' THEN 'cart_remove' ELSE event_type END AS event_type,
               ts AS event_date,
               CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END
                    AS device_type,
               concat_ws('_', 'session', user_id, cast(ts AS date)) AS session_id,
               ts AS created_at, {AUDIT}
        FROM events""",
    "s_reviews": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_id,
               cast(l_partkey AS varchar) AS product_id, cast(l_orderkey AS varchar) AS order_id,
               cast(o_custkey AS varchar) AS customer_id,
               cast(1 + (l_orderkey * 7 + l_partkey + l_linenumber) % 5 AS integer) AS review_score,
               'Review for product ' || cast(l_partkey AS varchar) AS review_text,
               'historic' AS data_source, 'batch-1' AS batch_id, l_shipdate AS loaded_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE (l_orderkey + l_partkey) % 3 = 0""",
}


def _lookup(source: str, column: str, id_name: str, value_name: str) -> str:
    return f"""
        SELECT DISTINCT {key(column)} AS {id_name}, {column} AS {value_name}, {NOW} AS created_at
        FROM {source} WHERE {column} IS NOT NULL"""


# --- normalized tables --------------------------------------------------------------------

CTE |= {
    "education_types": _lookup("s_customers", "education", "education_id", "education_type"),
    "marital_statuses": _lookup("s_customers", "marital_status", "marital_status_id", "status_type"),
    "order_statuses": _lookup("s_orders", "status", "status_id", "status_name"),
    "payment_methods": _lookup("s_orders", "payment_method", "payment_method_id", "method_name"),
    "brands": f"""
        SELECT DISTINCT {key("trim(brand)")} AS brand_id, trim(brand) AS brand_name,
               {NOW} AS created_at
        FROM s_products WHERE trim(brand) <> ''""",
    "order_addresses": """
        SELECT shipping_address AS address FROM s_orders WHERE shipping_address IS NOT NULL
        UNION
        SELECT billing_address FROM s_orders WHERE billing_address IS NOT NULL""",
    "places": f"""
        SELECT {part("address", 2)} AS city, {part("address", 1)} AS state,
               {part("address", 0)} AS country
        FROM order_addresses
        UNION
        SELECT trim(city), trim(state), trim(country) FROM s_customers""",
    "locations": f"""
        SELECT {key("city", "state", "country")} AS location_id, city, state, country,
               {NOW} AS created_at
        FROM places WHERE city <> '' AND state <> '' AND country <> ''""",
    "addresses": f"""
        SELECT DISTINCT {key("address")} AS address_id, street_address, postal_code,
               coalesce(l.location_id, {key("a.city", "a.state", "a.country")}) AS location_id,
               {NOW} AS created_at
        FROM (SELECT address, trim(string_split(address, ',')[1]) AS street_address,
                     {part("address", 3)} AS postal_code, {part("address", 2)} AS city,
                     {part("address", 1)} AS state, {part("address", 0)} AS country
              FROM order_addresses) a
             LEFT JOIN locations l USING (city, state, country)
        WHERE a.city <> '' AND a.state <> '' AND a.country <> ''""",
    "categories_enriched": f"""
        SELECT DISTINCT category_id, category_name,
               (SELECT count(DISTINCT s.subcategory_id) FROM s_subcategories s
                WHERE s.category_id = c.category_id) AS subcategory_count,
               (SELECT count(DISTINCT p.product_id) FROM s_products p
                WHERE p.category_id = c.category_id) AS product_count,
               created_at
        FROM s_categories c""",
    "subcategories_enriched": """
        SELECT s.subcategory_id, s.subcategory_name, s.category_id,
               count(DISTINCT p.product_id) AS product_count, s.created_at
        FROM s_subcategories s LEFT JOIN s_products p ON p.subcategory_id = s.subcategory_id
        GROUP BY ALL""",
    "products_enriched": f"""
        SELECT p.product_id, p.product_name, p.description, p.base_price, p.sale_price,
               p.stock_quantity, p.weight_kg, p.is_active, b.brand_id, p.category_id,
               p.subcategory_id, coalesce(i.n, 0) AS total_orders,
               {big("coalesce(i.units, 0)", "total_quantity_sold")},
               {money("coalesce(i.revenue, 0)", "total_revenue")},
               coalesce(r.n, 0) AS review_count, r.avg_review_score, p.created_at
        FROM s_products p LEFT JOIN brands b ON trim(p.brand) = b.brand_name
             LEFT JOIN (SELECT product_id, count(DISTINCT order_id) AS n, sum(quantity) AS units,
                               sum(total_price) AS revenue
                        FROM s_order_items GROUP BY 1) i ON i.product_id = p.product_id
             LEFT JOIN (SELECT product_id, count(*) AS n, {avg("review_score", "avg_review_score")}
                        FROM s_reviews GROUP BY 1) r ON r.product_id = p.product_id
        WHERE p.product_id IS NOT NULL""",
    "customers_enriched": f"""
        SELECT customer_id, email, first_name, last_name, age, gender, annual_income,
               CASE WHEN education IS NOT NULL THEN {key("education")} END AS education_id,
               CASE WHEN marital_status IS NOT NULL THEN {key("marital_status")} END AS marital_status_id,
               {key("trim(city)", "trim(state)", "trim(country)")} AS location_id,
               signup_date, preferred_channel, is_active, last_login,
               (SELECT count(DISTINCT order_id) FROM s_orders o WHERE o.customer_id = c.customer_id) AS total_orders,
               cast(coalesce((SELECT sum(total_amount) FROM s_orders o WHERE o.customer_id = c.customer_id), 0)
                    AS decimal(38,2)) AS total_spent,
               (SELECT min(order_date) FROM s_orders o WHERE o.customer_id = c.customer_id) AS first_order_date,
               (SELECT max(order_date) FROM s_orders o WHERE o.customer_id = c.customer_id) AS last_order_date,
               loaded_at AS created_at
        FROM s_customers c
        WHERE least(length(trim(city)), length(trim(state)), length(trim(country))) > 0
              AND city IS NOT NULL AND state IS NOT NULL AND country IS NOT NULL""",
    "reviews_enriched": """
        SELECT r.product_id, r.order_id, r.customer_id, r.review_score, r.review_text,
               p.product_name, c.category_name, s.subcategory_name, b.brand_name,
               r.loaded_at AS created_at
        FROM s_reviews r LEFT JOIN products_enriched p ON p.product_id = r.product_id
             LEFT JOIN categories_enriched c ON c.category_id = p.category_id
             LEFT JOIN subcategories_enriched s ON s.subcategory_id = p.subcategory_id
             LEFT JOIN brands b ON b.brand_id = p.brand_id""",
    # several addresses may share a street; an order takes the one with the smallest id
    "street_addresses": """
        SELECT * FROM addresses
        QUALIFY row_number() OVER (PARTITION BY street_address ORDER BY address_id) = 1""",
    "int_orders": f"""
        SELECT order_id, customer_id, order_date,
               CASE WHEN status IS NOT NULL THEN {key("status")} END AS status_id,
               CASE WHEN payment_method IS NOT NULL THEN {key("payment_method")} END AS payment_method_id,
               (SELECT address_id FROM street_addresses WHERE street_address = shipping_address) AS shipping_address_id,
               (SELECT address_id FROM street_addresses WHERE street_address = billing_address) AS billing_address_id,
               total_amount, shipping_cost,
               (SELECT count(DISTINCT product_id) FROM s_order_items i WHERE i.order_id = o.order_id) AS unique_products,
               cast((SELECT sum(quantity) FROM s_order_items i WHERE i.order_id = o.order_id)
                    * greatest(1, (SELECT count(*) FROM s_reviews r WHERE r.order_id = o.order_id))
                    AS decimal(38,0)) AS total_items,
               EXISTS (SELECT 1 FROM s_reviews r WHERE r.order_id = o.order_id AND review_score IS NOT NULL) AS has_review,
               (SELECT cast(sum(review_score) AS double) / count(review_score)
                FROM s_reviews r WHERE r.order_id = o.order_id AND review_score IS NOT NULL) AS avg_review_score,
               created_at
        FROM s_orders o""",
    "newest_scores": """
        SELECT order_id, product_id, review_score FROM s_reviews
        QUALIFY row_number() OVER (PARTITION BY order_id, product_id
                                   ORDER BY loaded_at DESC, review_id DESC) = 1""",
    "int_order_items": """
        SELECT DISTINCT i.order_item_id, i.order_id, i.product_id, o.customer_id, i.quantity,
               i.unit_price, i.total_price, p.category_id, p.subcategory_id, p.brand_id,
               r.review_score, i.created_at
        FROM s_order_items i JOIN products_enriched p ON p.product_id = i.product_id
             LEFT JOIN s_orders o ON o.order_id = i.order_id
             LEFT JOIN newest_scores r ON r.order_id = i.order_id AND r.product_id = i.product_id""",
    "customer_interactions": f"""
        SELECT event_id, customer_id, product_id,
               (SELECT category_id FROM s_products p WHERE p.product_id = i.product_id) AS category_id,
               (SELECT subcategory_id FROM s_products p WHERE p.product_id = i.product_id) AS subcategory_id,
               event_type, event_date, device_type, session_id, created_at
        FROM s_interactions i""",
}

# --- marts --------------------------------------------------------------------------------


MARTS = {
    "dim_dates": f"""
        SELECT DISTINCT d AS date_day, cast(year(d) AS integer) AS year,
               cast(month(d) AS integer) AS month, cast(isodow(d) AS integer) AS day_of_week,
               {month("d")} AS first_day_of_month, last_day(d) AS last_day_of_month
        FROM (SELECT order_date AS d FROM int_orders
              UNION ALL SELECT event_date FROM customer_interactions)""",
    "dim_locations": f"""
        SELECT location_id, city, state, country, coalesce(there.people, 0) AS total_customers,
               {big("coalesce(there.orders, 0)", "total_orders")}, {money("there.spent", "total_revenue")}
        FROM locations LEFT JOIN (
            SELECT location_id, count(DISTINCT customer_id) AS people, sum(orders) AS orders,
                   sum(spent) AS spent
            FROM customers_enriched LEFT JOIN (
                SELECT customer_id, count(DISTINCT order_id) AS orders, sum(total_amount) AS spent
                FROM int_orders GROUP BY customer_id) USING (customer_id)
            GROUP BY location_id) there USING (location_id)""",
    "dim_categories": f"""
        SELECT category_id, category_name, subcategory_count, product_count,
               {money("sold.revenue", "category_revenue")}
        FROM categories_enriched LEFT JOIN (
            SELECT g.category_id,
                   sum(i.total_price * cast(greatest(g.subcategories, 1) AS decimal(9,0))) AS revenue
            FROM (SELECT p.product_id, p.category_id,
                         (SELECT count(*) FROM subcategories_enriched s
                          WHERE s.category_id = p.category_id) AS subcategories
                  FROM products_enriched p) g JOIN int_order_items i USING (product_id)
            GROUP BY g.category_id) sold USING (category_id)""",
    "dim_products": f"""
        SELECT p.product_id, p.product_name, p.description, p.base_price, p.sale_price,
               p.stock_quantity, c.category_name, s.subcategory_name, b.brand_name,
               coalesce(i.n, 0) AS total_orders,
               {big("coalesce(i.units, 0)", "total_quantity_sold")},
               {money("coalesce(i.revenue, 0)", "total_revenue")},
               coalesce(cast(i.revenue AS double) / nullif(i.units, 0), 0) AS avg_selling_price,
               coalesce(p.review_count, 0) AS review_count, p.avg_review_score, p.is_active,
               p.created_at, {NOW} AS updated_at
        FROM products_enriched p LEFT JOIN categories_enriched c ON c.category_id = p.category_id
             LEFT JOIN subcategories_enriched s ON s.subcategory_id = p.subcategory_id
             LEFT JOIN brands b ON b.brand_id = p.brand_id
             LEFT JOIN (SELECT product_id, count(DISTINCT order_id) AS n, sum(quantity) AS units,
                               sum(total_price) AS revenue
                        FROM int_order_items GROUP BY 1) i ON i.product_id = p.product_id""",
    "dim_customers": f"""
        SELECT customer_id, email, first_name, last_name, age, gender, annual_income,
               (SELECT trim(city) FROM s_customers s WHERE s.customer_id = c.customer_id) AS city,
               (SELECT trim(state) FROM s_customers s WHERE s.customer_id = c.customer_id) AS state,
               (SELECT trim(country) FROM s_customers s WHERE s.customer_id = c.customer_id) AS country,
               (SELECT education FROM s_customers s WHERE s.customer_id = c.customer_id) AS education_type,
               (SELECT marital_status FROM s_customers s WHERE s.customer_id = c.customer_id) AS marital_status,
               total_orders, total_spent,
               coalesce(cast(total_spent AS double) / nullif(total_orders, 0), 0) AS avg_order_value,
               first_order_date, last_order_date,
               CASE WHEN last_order_date >= timestamp '2001-05-01' THEN 'Active'
                    WHEN last_order_date >= timestamp '2001-02-01' THEN 'At Risk' ELSE 'Churned' END AS customer_status,
               cast(date '2001-08-01' - cast(coalesce(first_order_date, signup_date) AS date) AS integer)
                   AS customer_lifetime_days,
               signup_date, last_login, is_active, created_at, {NOW} AS updated_at
        FROM customers_enriched c""",
    "fct_customer_orders": f"""
        SELECT o.customer_id, o.order_id, o.order_date, o.total_amount,
               coalesce(bought.products, 0) AS unique_products,
               {units("bought.units * greatest(coalesce(said.n, 0), 1)", "total_items")},
               said.avg_review_score
        FROM int_orders o
             LEFT JOIN (SELECT order_id, count(DISTINCT product_id) AS products, sum(quantity) AS units
                        FROM int_order_items GROUP BY order_id) bought USING (order_id)
             LEFT JOIN (SELECT order_id, count(*) AS n, {avg("review_score", "avg_review_score")}
                        FROM reviews_enriched GROUP BY order_id) said USING (order_id)""",
    "fct_customer_activity": f"""
        SELECT customer_id, email, activity_month, total_views, unique_products_viewed, cart_adds,
               unique_products_added, purchases, unique_products_purchased, total_sessions, devices_used,
               {NOW} AS updated_at
        FROM (SELECT customer_id, {month("event_date")} AS activity_month,
                     count(*) FILTER (event_type = 'view') AS total_views,
                     count(DISTINCT product_id) FILTER (event_type = 'view') AS unique_products_viewed,
                     count(*) FILTER (event_type = 'cart_add') AS cart_adds,
                     count(DISTINCT product_id) FILTER (event_type = 'cart_add') AS unique_products_added,
                     count(*) FILTER (event_type = 'purchase') AS purchases,
                     count(DISTINCT product_id) FILTER (event_type = 'purchase') AS unique_products_purchased,
                     count(DISTINCT session_id) AS total_sessions, count(DISTINCT device_type) AS devices_used
              FROM customer_interactions WHERE event_date IS NOT NULL GROUP BY ALL)
             JOIN customers_enriched USING (customer_id)""",
    "fct_customer_reviews": f"""
        SELECT customer_id, product_id, order_id, review_score, review_text, category_id, subcategory_id
        FROM s_reviews JOIN (SELECT product_id, category_id, subcategory_id FROM s_products)
             USING (product_id)""",
    "fct_order_details": f"""
        SELECT h.order_id, h.order_date, buyer.customer_id, buyer.email, buyer.city AS customer_city,
               buyer.state AS customer_state, line.product_id, goods.product_name, goods.category_name,
               goods.brand_name, h.status_name, h.method_name AS payment_method,
               h.street_address AS shipping_address, h.city AS shipping_city, h.state AS shipping_state,
               line.quantity, line.unit_price, line.total_price AS item_total, h.shipping_cost,
               h.total_amount AS order_total, said.review_score, h.created_at, {NOW} AS updated_at
        FROM (SELECT product_id, product_name, category_name, brand_name
              FROM products_enriched JOIN brands USING (brand_id)
                   JOIN (SELECT category_id, category_name FROM categories_enriched) USING (category_id)) goods
             JOIN int_order_items line USING (product_id)
             LEFT JOIN (SELECT order_id, product_id, review_score FROM reviews_enriched) said
                  ON (said.order_id, said.product_id) = (line.order_id, line.product_id)
             JOIN (SELECT o.*, status_name, method_name, sent.* EXCLUDE (address_id)
                   FROM int_orders o LEFT JOIN order_statuses USING (status_id)
                        LEFT JOIN payment_methods USING (payment_method_id)
                        LEFT JOIN (SELECT address_id, street_address, city, state
                                   FROM addresses LEFT JOIN locations USING (location_id)) sent
                             ON sent.address_id = o.shipping_address_id) h ON h.order_id = line.order_id
             JOIN (SELECT customer_id, email, city, state
                   FROM customers_enriched JOIN locations USING (location_id)) buyer
                  ON buyer.customer_id = h.customer_id""",
    "fct_product_interactions": f"""
        SELECT product_id, cast(event_date AS date) AS event_day,
               count(DISTINCT event_id) FILTER (event_type = 'view') AS views,
               count(DISTINCT event_id) FILTER (event_type = 'cart_add') AS cart_adds,
               count(DISTINCT event_id) FILTER (event_type = 'wishlist_add') AS wishlist_adds,
               count(DISTINCT customer_id) AS unique_customers
        FROM customer_interactions GROUP BY ALL""",
    "fct_product_performance": f"""
        SELECT product_id, sold.month, coalesce(sold.orders, 0) AS total_orders,
               {units("sold.units", "units_sold")}, {money("sold.revenue", "revenue")}, said.avg_rating,
               coalesce(said.scores, 0) AS review_count
        FROM products_enriched
             LEFT JOIN (SELECT product_id, {avg("review_score", "avg_rating")},
                               count(DISTINCT review_score) AS scores
                        FROM reviews_enriched GROUP BY product_id) said USING (product_id)
             LEFT JOIN (SELECT i.product_id, {month("o.order_date")} AS month,
                               count(DISTINCT o.order_id) AS orders, sum(i.quantity * times) AS units,
                               sum(i.total_price * cast(times AS decimal(9,0))) AS revenue
                        FROM (SELECT *, greatest(1, (SELECT count(*) FROM reviews_enriched r
                                                     WHERE r.product_id = l.product_id)) AS times
                              FROM int_order_items l) i LEFT JOIN int_orders o USING (order_id)
                        GROUP BY 1, 2) sold USING (product_id)""",
    "fct_sales_by_date": f"""
        SELECT cast(order_date AS date) AS sale_date, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers,
               {money("sum(total_amount)", "total_revenue")},
               {money("sum(shipping_cost)", "total_shipping")},
               {money("sum(total_amount) - sum(shipping_cost)", "net_revenue")},
               {avg("total_amount", "avg_order_value")},
               cast(sum(total_amount) AS double) / nullif(count(DISTINCT customer_id), 0)
                   AS revenue_per_customer,
               {NOW} AS updated_at
        FROM int_orders GROUP BY 1""",
    "fct_sales_by_product": f"""
        SELECT p.product_id, p.category_id, {month("o.order_date")} AS sales_month,
               count(DISTINCT o.order_id) AS total_orders, {big("sum(i.quantity)", "units_sold")},
               {money("sum(i.total_price)", "revenue")}, {avg("i.unit_price", "avg_selling_price")}
        FROM products_enriched p JOIN int_order_items i ON i.product_id = p.product_id
             JOIN int_orders o ON o.order_id = i.order_id
        GROUP BY 1, 2, 3""",
    "fct_sales_by_region": f"""
        SELECT state, country, sales_month, {big("sum(orders)", "total_orders")},
               count(*) AS unique_customers, {money("sum(spent)", "total_revenue")},
               cast(sum(spent) AS double) / nullif(sum(priced), 0) AS avg_order_value
        FROM (SELECT customer_id, {month("order_date")} AS sales_month, count(DISTINCT order_id) AS orders,
                     sum(total_amount) AS spent, count(total_amount) AS priced
              FROM int_orders GROUP BY 1, 2)
             JOIN customers_enriched USING (customer_id) JOIN locations USING (location_id)
        GROUP BY 1, 2, 3""",
}
CTE |= MARTS


def with_tables(body: str, given: frozenset[str] = frozenset()) -> str:
    """``body`` behind those of the shared tables that it needs, directly or not.

    ``given`` names tables that the database already has.
    """
    needed: list[str] = []

    def visit(text: str) -> None:
        words = {w.split(".")[0] for w in re.findall(r"[\w.]+", text)}
        for name in CTE:
            if name in words and name not in given and name not in needed:
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTE[n]})" for n in needed) + "\n" + body


def table(name: str) -> str:
    return with_tables(f"SELECT * FROM {name}")


STATEMENTS: dict[str, str] = {
    f"stg_{t}": table(f"s_{t}")
    for t in (
        "categories", "subcategories", "customers", "products", "orders", "order_items",
        "interactions", "reviews",
    )
}
STATEMENTS |= {
    f"int_{name}": table(name if name not in ("orders", "order_items") else f"int_{name}")
    for name in (
        "education_types", "marital_statuses", "order_statuses", "payment_methods", "brands",
        "locations", "addresses", "categories_enriched", "subcategories_enriched",
        "products_enriched", "customers_enriched", "reviews_enriched", "orders", "order_items",
        "customer_interactions",
    )
}
STATEMENTS |= {name: table(name) for name in MARTS}
