"""The registered queries as DuckDB SQL over the raw test tables.

Nothing here uses the library: histories, decoding and state are stated on their own.
Rounded averages are computed in whole numbers, half up; see ``cents``.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
OPENED = "TIMESTAMP '1995-01-01 00:00:00'"


def cents(total: str, count: str) -> str:
    """Mean of money rounded half up to cents; doubles would round some ties wrongly."""
    return (
        f"CASE WHEN {count} > 0 THEN cast((2 * cast({total} * 100 AS hugeint) + {count}) // (2 * {count}) "
        f"AS double) / 100 END"
    )


def pct(part: str, whole: str) -> str:
    """Percentage rounded half up to two decimals."""
    return f"cast((2 * 10000 * cast({part} AS hugeint) + {whole}) // (2 * {whole}) AS double) / 100"


# Common table expressions, each able to use those above it.
CTES = {
    "d_categories": f"""
        SELECT DISTINCT cast(substr(p_brand, 7) AS bigint) AS category_id, p_brand AS name,
               cast(NULL AS varchar) AS description, {OPENED} AS created_at
        FROM part""",
    "d_products": f"""
        SELECT p_partkey AS product_id, cast(substr(p_brand, 7) AS bigint) AS category_id, p_name AS name,
               'SKU-' || p_partkey AS sku, cast(p_retailprice AS decimal(10,2)) AS price,
               cast(p_size AS bigint) AS stock, p_partkey % 10 <> 0 AS is_active,
               {OPENED} AS created_at, {OPENED} AS updated_at
        FROM part""",
    "d_customers": f"""
        SELECT c_custkey AS customer_id, c_custkey || '@example.com' AS email,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               cast(NULL AS varchar) AS phone, n_name AS city, cast(NULL AS varchar) AS country,
               {OPENED} AS created_at, {OPENED} AS updated_at
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "d_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'pending' WHEN '2-HIGH' THEN 'confirmed'
                    WHEN '3-MEDIUM' THEN 'shipped' WHEN '4-NOT SPECIFIED' THEN 'delivered'
                    WHEN '5-LOW' THEN 'cancelled' END AS status,
               cast(o_totalprice AS decimal(10,2)) AS total_amount,
               o_orderdate AS created_at, o_orderdate AS updated_at
        FROM orders""",
    "d_city_orders": """
        SELECT o.order_id, o.customer_id, o.status, o.total_amount, c.city, o.created_at, o.updated_at
        FROM d_orders o JOIN d_customers c USING (customer_id)""",
    "d_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, cast(l_quantity AS bigint) AS quantity,
               cast(l_extendedprice AS decimal(10,2)) AS unit_price,
               cast(l_quantity AS bigint) * cast(l_extendedprice AS decimal(10,2)) AS line_value
        FROM lineitem""",
    "d_payments": """
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id, cast(o_totalprice AS decimal(10,2)) AS amount,
               CASE o_custkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'paypal'
                    ELSE 'transfer' END AS method,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'failed'
                    END AS status,
               'TX-' || o_orderkey AS transaction_ref, o_orderdate AS processed_at
        FROM orders""",
    "orders_log": """
        SELECT *, 1 AS _version, 0 AS _is_deleted FROM d_city_orders
        UNION ALL
        SELECT * REPLACE ('delivered' AS status), 2, 0 FROM d_city_orders WHERE order_id % 3 = 0
        UNION ALL
        SELECT *, 3, 1 FROM d_city_orders WHERE order_id % 7 = 0""",
    "latest_orders": """
        SELECT * FROM orders_log
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _version DESC) = 1""",
    "l_orders": """
        SELECT * EXCLUDE (_version, _is_deleted) FROM latest_orders WHERE _is_deleted = 0""",
    "products_log": """
        SELECT *, 1 AS _version FROM d_products
        UNION ALL
        SELECT * REPLACE (cast(price + 1 AS decimal(10,2)) AS price), 2 FROM d_products
        WHERE product_id % 5 = 0""",
    "l_products": """
        SELECT * EXCLUDE (_version) FROM products_log
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY _version DESC) = 1""",
    "sold": """
        SELECT o.*, i.product_id, i.quantity, i.unit_price, i.line_value
        FROM l_orders o JOIN d_items i USING (order_id)""",
    # One row per change in the feed, with what becomes of it.
    "feed": """
        SELECT event_id, event_id + 2 AS _version, user_id, event_type, props, ts,
               cast(value AS decimal(10,2)) AS amount,
               CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS op,
               CASE WHEN event_id % 79 = 0 THEN 'truncate' WHEN event_type = 'error' THEN 'delete'
                    WHEN event_type = 'signup' THEN 'insert' ELSE 'update' END AS kind,
               CASE WHEN event_id % 89 = 0 THEN 'audit_log' ELSE 'orders' END AS table_name,
               CASE WHEN event_id % 97 = 0 THEN 'malformed message' WHEN event_id % 89 = 0 THEN 'unknown table'
                    WHEN event_id % 79 = 0 THEN 'unknown kind' ELSE 'applied' END AS route
        FROM events""",
    "order_changes": """
        SELECT * FROM (SELECT *, op <> 'delete' AND event_id % 83 = 0 AS bad,
                              op = 'update' AND event_id % 50 = 0 AS moved
                       FROM feed WHERE route = 'applied') c""",
    "order_rows": """
        SELECT CASE WHEN moved THEN user_id + 1000000 ELSE user_id END AS order_id, event_id AS customer_id,
               event_type AS status, amount AS total_amount, props AS city, ts AS created_at, ts AS updated_at,
               _version, 0 AS _seq, CASE WHEN op = 'delete' THEN 1 ELSE 0 END AS _is_deleted
        FROM order_changes WHERE NOT bad
        UNION ALL
        SELECT user_id, NULL, NULL, NULL, CASE WHEN event_type = 'click' THEN props END, NULL, NULL,
               _version, 0, 1
        FROM order_changes WHERE NOT bad AND moved""",
    "payment_changes": """
        SELECT event_id AS payment_id, amount, _version, 1 AS _seq, event_id
        FROM feed WHERE event_type = 'purchase' AND route <> 'malformed message'""",
    "feed_middle": "SELECT max(event_id) // 2 + 2 AS middle FROM events",
    "fed_orders": """
        SELECT * FROM (SELECT * FROM order_rows
                       QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _version DESC) = 1) r""",
    # Changes of stock in their order, and the stock they leave, one step at a time.
    "stock_changes": """
        SELECT l_partkey AS product_id, l_shipdate AS shipped_at, l_orderkey AS order_id, cast(l_linenumber AS bigint) AS line,
               cast(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END AS bigint) AS delta,
               CASE WHEN l_linenumber > 1 THEN cast(l_extendedprice AS decimal(10,2)) END AS new_price,
               row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS step
        FROM lineitem""",
    "stock_after": """
        WITH RECURSIVE walk AS (
            SELECT product_id, stock, cast(0 AS bigint) AS step FROM l_products
            UNION ALL
            SELECT w.product_id, greatest(w.stock + c.delta, 0), c.step
            FROM walk w JOIN stock_changes c ON c.product_id = w.product_id AND c.step = w.step + 1)
        SELECT * FROM walk WHERE step > 0""",
    "spoiled": """
        SELECT order_id, customer_id, total_amount,
               CASE order_id % 100 WHEN 1 THEN 'lost' WHEN 2 THEN NULL WHEN 3 THEN repeat('x', 31) ELSE status END
                   AS status,
               CASE WHEN order_id % 100 <> 4 THEN created_at END AS created_at,
               CASE WHEN order_id % 100 = 5 THEN repeat('y', 101) ELSE city END AS city, updated_at
        FROM d_city_orders""",
    "keyed_items": """
        SELECT row_number() OVER (ORDER BY order_id, product_id, quantity, unit_price) AS item_id, order_id, product_id,
               CASE product_id % 90 WHEN 1 THEN 0 ELSE quantity END AS quantity,
               CASE product_id % 80 WHEN 1 THEN cast(-1 AS decimal(10,2)) ELSE unit_price END AS unit_price
        FROM d_items""",
    "f_customers": """
        SELECT customer_id, CASE customer_id % 10 WHEN 1 THEN 'x' || customer_id % 50 ELSE email END AS email,
               CASE customer_id % 40 WHEN 1 THEN NULL ELSE first_name END AS first_name
        FROM d_customers""",
    "f_products": """
        SELECT product_id, cast(price - 950 AS decimal(10,2)) AS price, stock - 10 AS stock,
               CASE product_id % 20 WHEN 1 THEN 'SKU-0' ELSE sku END AS sku,
               CASE product_id % 30 WHEN 1 THEN 999 ELSE category_id END AS category_id
        FROM d_products""",
    "f_payments": """
        SELECT payment_id, CASE payment_id % 100 WHEN 1 THEN 'cash' ELSE method END AS method,
               CASE payment_id % 70 WHEN 1 THEN 'open' ELSE status END AS status,
               CASE payment_id % 50 WHEN 1 THEN 'TX-0' ELSE transaction_ref END AS transaction_ref,
               CASE payment_id % 60 WHEN 1 THEN -1 ELSE order_id END AS order_id
        FROM d_payments""",
    "f_categories": "SELECT category_id, CASE WHEN category_id < 20 THEN 'twice' ELSE name END AS name FROM d_categories",
    "f_orders": """
        SELECT * REPLACE (CASE order_id % 45 WHEN 1 THEN -1 ELSE customer_id END AS customer_id) FROM spoiled""",
    "doomed": f"""
        SELECT * FROM l_orders WHERE status = 'cancelled' AND updated_at < {AS_OF} - INTERVAL 3 MINUTE""",
    "priced": """
        SELECT i.order_id AS cart_id, i.product_id, cast(sum(i.quantity) AS bigint) AS quantity, p.price AS unit_price
        FROM d_items i JOIN l_products p USING (product_id) WHERE p.is_active AND p.stock > 0
        GROUP BY i.order_id, i.product_id, p.price""",
    "built": """
        SELECT cart_id, cast(sum(quantity * unit_price) AS decimal(10,2)) AS total_amount,
               (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY cart_id) AS order_id
        FROM priced GROUP BY cart_id""",
}


def _needed(text: str) -> list[str]:
    """The expressions a text reads, directly or through others."""
    needed: set[str] = set()
    waiting = [text]
    while waiting:
        body = waiting.pop()
        words = set(body.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in CTES.keys() & words - needed:
            needed.add(name)
            waiting.append(CTES[name])
    return [name for name in CTES if name in needed]


def sql(select: str) -> str:
    names = _needed(select)
    if not names:
        return select.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + select.strip()


def _flag(n: int) -> str:
    return f"cast({n} AS bigint)"


HISTORY = "order_id, customer_id, status, cast(total_amount AS double) AS total_amount"
KNUTH = "((payment_id % 1000003) * 2654435761) % 4294967296"

SELECTS = {
    "q1_daily_category_revenue": f"""
        SELECT c.name AS category, date_trunc('day', s.created_at) AS day,
               count(DISTINCT s.order_id) AS total_orders, cast(sum(s.line_value) AS double) AS revenue,
               cast(sum(s.line_value) AS double) / count(s.line_value) AS avg_item_revenue
        FROM sold s JOIN l_products p USING (product_id) JOIN d_categories c USING (category_id)
        WHERE s.status IN ('shipped', 'delivered') AND s.created_at >= {AS_OF} - INTERVAL 30 DAY
        GROUP BY 1, 2""",
    "q2_customer_ltv": f"""
        SELECT c.customer_id, c.first_name || ' ' || c.last_name AS full_name, c.city,
               count(DISTINCT s.order_id) AS orders_placed, cast(sum(s.line_value) AS double) AS lifetime_value,
               {cents("sum(s.line_value)", "count(s.line_value)")} AS avg_item_value,
               max(s.created_at) AS last_order_at
        FROM d_customers c JOIN sold s USING (customer_id)
        WHERE s.status <> 'cancelled'
        GROUP BY c.customer_id, c.first_name, c.last_name, c.city
        HAVING count(DISTINCT s.order_id) >= 2
        ORDER BY sum(s.line_value) DESC, c.customer_id LIMIT 50""",
    "q3_city_fulfillment": f"""
        SELECT city, count(*) AS total_orders, count(*) FILTER (WHERE status = 'delivered') AS delivered,
               count(*) FILTER (WHERE status = 'cancelled') AS cancelled,
               {pct("count(*) FILTER (WHERE status = 'delivered')", "count(*)")} AS fulfillment_pct,
               {cents("sum(total_amount)", "count(total_amount)")} AS avg_ticket
        FROM l_orders GROUP BY city""",
    "q4_product_performance": f"""
        SELECT p.product_id, p.name AS product_name, c.name AS category, cast(p.price AS double) AS current_price,
               p.stock AS current_stock, count(DISTINCT s.order_id) AS times_ordered,
               cast(sum(s.quantity) AS bigint) AS units_sold, cast(sum(s.line_value) AS double) AS total_revenue,
               {cents("sum(s.unit_price)", "count(s.unit_price)")} AS avg_sell_price
        FROM l_products p JOIN d_categories c USING (category_id) JOIN sold s USING (product_id)
        WHERE s.status <> 'cancelled'
        GROUP BY p.product_id, p.name, c.name, p.price, p.stock
        ORDER BY sum(s.line_value) DESC, p.product_id LIMIT 25""",
    "q5_payment_share": f"""
        SELECT method, status, n AS tx_count, cast(total AS double) AS total_amount,
               {cents("total", "n")} AS avg_amount, {pct("n", "sum(n) OVER (PARTITION BY method)")} AS status_share_pct
        FROM (SELECT method, status, count(*) AS n, sum(amount) AS total FROM d_payments GROUP BY method, status) g""",
    "snapshot_load": f"""
        SELECT * REPLACE (cast(price AS double) AS price), {_flag(1)} AS _version, {_flag(0)} AS _seq,
               {_flag(0)} AS _is_deleted
        FROM d_products""",
    "changelog_history": f"""
        SELECT {HISTORY}, created_at, cast(_version AS bigint) AS _version, cast(_is_deleted AS bigint) AS _is_deleted
        FROM orders_log""",
    "changelog_history_store": f"""
        SELECT {HISTORY}, created_at, cast(_version AS bigint) AS _version, cast(_is_deleted AS bigint) AS _is_deleted,
               cast(_version - 1 AS bigint) AS _batch_id
        FROM orders_log""",
    "snapshot_load_all": """
        SELECT table_name, rows, key_sum, cast(1 AS bigint) AS version FROM (
            SELECT 'categories' AS table_name, count(*) AS rows, cast(sum(category_id) AS bigint) AS key_sum FROM d_categories
            UNION ALL SELECT 'customers', count(*), cast(sum(customer_id) AS bigint) FROM d_customers
            UNION ALL SELECT 'products', count(*), cast(sum(product_id) AS bigint) FROM d_products
            UNION ALL SELECT 'orders', count(*), cast(sum(order_id) AS bigint) FROM d_orders
            UNION ALL SELECT 'order_items', count(*), cast(sum(item_id) AS bigint) FROM keyed_items
            UNION ALL SELECT 'payments', count(*), cast(sum(payment_id) AS bigint) FROM d_payments) t""",
    "latest_state": f"""
        SELECT {HISTORY}, created_at, cast(_version AS bigint) AS _version, cast(_is_deleted AS bigint) AS _is_deleted
        FROM latest_orders""",
    "live_rows": """
        SELECT user_id, event_type, cast(cast(value AS decimal(10,2)) AS double) AS amount, ts
        FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) e
        WHERE event_type <> 'error'""",
    "live_orders": f"SELECT {HISTORY}, created_at, updated_at FROM l_orders",
    "live_from_store": f"SELECT {HISTORY}, city, created_at, updated_at FROM l_orders",
    "late_batch_after_compaction": f"SELECT {HISTORY}, city, created_at, updated_at FROM l_orders",
    "live_products": "SELECT * REPLACE (cast(price AS double) AS price) FROM l_products",
    "live_categories": "SELECT * FROM d_categories",
    "live_customers": "SELECT * FROM d_customers",
    "live_payments": "SELECT * REPLACE (cast(amount AS double) AS amount) FROM d_payments",
    "live_order_items": """
        SELECT order_id, product_id, quantity, cast(unit_price AS double) AS unit_price
        FROM d_items WHERE order_id NOT IN (SELECT order_id FROM latest_orders WHERE _is_deleted = 1)""",
    "point_lookup": "SELECT product_id, cast(price AS double) AS price FROM l_products WHERE product_id = 10",
    "compact_changelog": f"""
        SELECT {HISTORY}, city, created_at, updated_at, cast(_version AS bigint) AS _version,
               cast(_is_deleted AS bigint) AS _is_deleted
        FROM latest_orders""",
    "change_counts": """
        SELECT route, CASE WHEN route = 'applied' THEN table_name END AS table_name,
               CASE WHEN route = 'applied' THEN kind END AS kind, count(*) AS changes
        FROM (SELECT route, table_name, kind FROM feed
              UNION ALL SELECT 'applied', 'payments', 'insert' FROM payment_changes) c
        GROUP BY 1, 2, 3""",
    "change_counts_store": """
        SELECT batch, route, CASE WHEN route = 'applied' THEN table_name END AS table_name,
               CASE WHEN route = 'applied' THEN kind END AS kind, count(*) AS changes
        FROM (SELECT cast(event_id > (SELECT max(event_id) // 2 FROM events) AS bigint) AS batch, route, table_name, kind
              FROM feed
              UNION ALL
              SELECT cast(event_id > (SELECT max(event_id) // 2 FROM events) AS bigint), 'applied', 'payments', 'insert'
              FROM payment_changes) c
        GROUP BY 1, 2, 3, 4""",
    "feed_broken_lines": """
        SELECT reason, cast(sum(n) AS bigint) AS changes FROM (
            SELECT CASE WHEN event_id % 101 = 0 OR event_id % 97 = 0 THEN 'malformed message'
                        WHEN event_id % 103 = 0 THEN 'no position'
                        WHEN route = 'applied' AND op <> 'delete' AND event_id % 83 = 0
                             THEN 'bad value in total_amount' END AS reason,
                   CASE WHEN event_id % 101 <> 0 AND event_id % 97 <> 0 AND event_id % 103 = 0
                             AND event_type = 'purchase' THEN 2 ELSE 1 END AS n
            FROM feed) f
        WHERE reason IS NOT NULL GROUP BY reason""",
    "cdc_decode": f"""
        SELECT _version, {_flag(0)} AS _seq, table_name, kind,
               cast(CASE op WHEN 'delete' THEN -1 ELSE CASE event_type WHEN 'click' THEN 6 ELSE 7 END END AS bigint)
                   AS new_values,
               cast(CASE op WHEN 'delete' THEN 7 WHEN 'insert' THEN -1
                    ELSE CASE event_type WHEN 'click' THEN 2 ELSE 1 END END AS bigint) AS old_values,
               event_type AS status
        FROM feed WHERE route <> 'malformed message'
        UNION ALL
        SELECT _version, {_flag(1)}, 'payments', 'insert', {_flag(7)}, {_flag(-1)}, 'completed' FROM payment_changes""",
    "cdc_route": f"""
        SELECT _version, {_flag(0)} AS _seq, route,
               CASE WHEN route <> 'malformed message' THEN table_name END AS table_name
        FROM feed
        UNION ALL
        SELECT _version, {_flag(1)}, 'applied', 'payments' FROM payment_changes""",
    "cdc_upsert_rows": f"""
        SELECT {HISTORY}, city, created_at, updated_at, _version, cast(_seq AS bigint) AS _seq,
               cast(_is_deleted AS bigint) AS _is_deleted
        FROM order_rows WHERE _is_deleted = 0""",
    "cdc_tombstones": f"""
        SELECT {HISTORY}, city, created_at, updated_at, _version, cast(_seq AS bigint) AS _seq,
               cast(_is_deleted AS bigint) AS _is_deleted
        FROM order_rows WHERE _is_deleted = 1""",
    "cdc_key_change": """
        SELECT _version, user_id AS order_id, user_id + 1000000 AS new_order_id
        FROM order_changes WHERE moved AND NOT bad""",
    "cdc_quarantine": f"""
        SELECT _version, {_flag(0)} AS _seq, cast(NULL AS varchar) AS table_name, 'malformed message' AS reason
        FROM feed WHERE route = 'malformed message'
        UNION ALL
        SELECT _version, {_flag(0)}, 'orders', 'bad value in total_amount' FROM order_changes WHERE bad""",
    "quarantine_kept": f"""
        SELECT _version, {_flag(0)} AS _seq, cast(NULL AS varchar) AS table_name, 'malformed message' AS reason
        FROM feed WHERE route = 'malformed message'
        UNION ALL
        SELECT _version, {_flag(0)}, 'orders', 'bad value in total_amount' FROM order_changes WHERE bad""",
    "coerce_defaults": """
        SELECT order_id, CASE order_id % 10 WHEN 0 THEN 0.0 ELSE cast(total_amount AS double) END AS total_amount,
               CASE order_id % 10 WHEN 1 THEN '' ELSE city END AS city
        FROM d_city_orders""",
    "coerce_timestamps": f"""
        SELECT event_id, CASE WHEN event_id % 10 < 2 THEN {AS_OF} ELSE ts END AS ts FROM events""",
    "coerce_booleans": f"""
        SELECT event_id, CASE WHEN event_id % 10 <> 0 AND event_id % 2 = 0 THEN {_flag(1)} ELSE {_flag(0)} END AS flag
        FROM events""",
    "cdc_stream_changelog": """
        SELECT 'orders' AS table_name, order_id AS key, cast(total_amount AS double) AS amount, _version,
               cast(_seq AS bigint) AS _seq, cast(_is_deleted AS bigint) AS _is_deleted
        FROM order_rows
        UNION ALL
        SELECT 'payments', payment_id, cast(amount AS double), _version, cast(1 AS bigint), cast(0 AS bigint)
        FROM payment_changes""",
    "cdc_resume": f"""
        SELECT {HISTORY}, city, created_at, updated_at
        FROM (SELECT * FROM (SELECT *, 1 AS _version, 0 AS _is_deleted FROM d_city_orders
                             UNION ALL BY NAME SELECT * EXCLUDE (_seq) FROM order_rows) u
              QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _version DESC) = 1) n
        WHERE _is_deleted = 0""",
    "late_change_ignored": f"""
        SELECT {HISTORY}, city, created_at, updated_at FROM fed_orders WHERE _is_deleted = 0""",
    "latest_state_stream": f"""
        SELECT {HISTORY}, _version, cast(_is_deleted AS bigint) AS _is_deleted FROM fed_orders""",
    "state_new_checkpoint": f"""
        SELECT {HISTORY}, _version, cast(_is_deleted AS bigint) AS _is_deleted FROM fed_orders""",
    "latest_state_processor": f"""
        SELECT {HISTORY}, _version, cast(_is_deleted AS bigint) AS _is_deleted FROM fed_orders WHERE _is_deleted = 0""",
    "processor_from_base": f"""
        SELECT {HISTORY}, _version, cast(_is_deleted AS bigint) AS _is_deleted, sign
        FROM (SELECT *, {_flag(1)} AS sign FROM fed_orders WHERE _version > (SELECT middle FROM feed_middle)
              UNION ALL
              SELECT b.*, {_flag(-1)} AS sign
              FROM (SELECT * FROM order_rows WHERE _version <= (SELECT middle FROM feed_middle)
                    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _version DESC) = 1) b
              WHERE order_id IN (SELECT order_id FROM fed_orders WHERE _version > (SELECT middle FROM feed_middle))) s
        WHERE _is_deleted = 0""",
    "flush_policy": f"""
        SELECT table_name, bucket, version, seq, payload,
               (row_number() OVER (PARTITION BY table_name, bucket ORDER BY version, seq, payload) - 1) // 50 AS flush
        FROM (SELECT 'orders' AS table_name, order_id % 4 AS bucket, _version AS version, cast(_seq AS bigint) AS seq,
                     order_id || ':' || _is_deleted AS payload FROM order_rows
              UNION ALL
              SELECT 'payments', payment_id % 4, _version, cast(_seq AS bigint), payment_id || ':0' FROM payment_changes) w""",
    "line_revenue": "SELECT order_id, product_id, cast(line_value AS double) AS revenue FROM d_items",
    "filter_in": "SELECT order_id, status FROM l_orders WHERE status IN ('shipped', 'delivered')",
    "filter_ne": "SELECT order_id, status FROM l_orders WHERE status <> 'cancelled'",
    "filter_not_in": "SELECT order_id, status FROM l_orders WHERE status NOT IN ('delivered', 'cancelled')",
    "filter_recent": f"""
        SELECT order_id, created_at FROM l_orders WHERE created_at >= {AS_OF} - INTERVAL 30 DAY""",
    "filter_conjunction": f"""
        SELECT order_id, created_at FROM l_orders
        WHERE status = 'cancelled' AND created_at < {AS_OF} - INTERVAL 3 MINUTE""",
    "join_two": "SELECT order_id, status, product_id, quantity FROM sold",
    "join_four": """
        SELECT s.order_id, s.status, p.name AS product_name, c.name AS category, s.quantity
        FROM sold s JOIN l_products p USING (product_id) JOIN d_categories c USING (category_id)""",
    "group_by_columns": """
        SELECT status, product_id, cast(sum(quantity) AS bigint) AS units FROM sold GROUP BY status, product_id""",
    "group_by_day": """
        SELECT date_trunc('day', created_at) AS day, count(*) AS orders, cast(sum(total_amount) AS double) AS total
        FROM l_orders GROUP BY 1""",
    "having_min_orders": """
        SELECT customer_id, count(DISTINCT order_id) AS orders FROM l_orders
        GROUP BY customer_id HAVING count(DISTINCT order_id) >= 2""",
    "share_of_partition": f"""
        SELECT customer_id, status, n AS orders, {pct("n", "sum(n) OVER (PARTITION BY customer_id)")} AS share_pct
        FROM (SELECT customer_id, status, count(*) AS n FROM l_orders GROUP BY customer_id, status) g""",
    "top_k": """
        SELECT order_id, cast(total_amount AS double) AS total_amount FROM l_orders
        ORDER BY l_orders.total_amount DESC, order_id LIMIT 100""",
    "sample_n_summary": f"SELECT {_flag(15)} AS rows, {_flag(15)} AS orders, TRUE AS all_open",
    "agg_approx_within_error": "SELECT status, count(DISTINCT order_id) AS orders, TRUE AS within FROM sold GROUP BY status",
    "agg_count": "SELECT status, count(*) AS lines FROM sold GROUP BY status",
    "agg_count_distinct": "SELECT status, count(DISTINCT order_id) AS orders FROM sold GROUP BY status",
    "agg_count_if": """
        SELECT status, count(*) FILTER (WHERE quantity > 25) AS large_lines FROM sold GROUP BY status""",
    "agg_sum": "SELECT status, cast(sum(line_value) AS double) AS revenue FROM sold GROUP BY status",
    "agg_sum_if": """
        SELECT status, cast(sum(line_value) FILTER (WHERE quantity > 25) AS double) AS large_revenue
        FROM sold GROUP BY status""",
    "agg_avg": f"""
        SELECT status, {cents("sum(unit_price)", "count(unit_price)")} AS avg_unit_price FROM sold GROUP BY status""",
    "agg_max": "SELECT status, max(created_at) AS last_order_at FROM sold GROUP BY status",
    "fn_date_trunc": "SELECT event_id, date_trunc('day', ts) AS day FROM events",
    "fn_round": """
        SELECT cast(unit_price AS double) AS unit_price,
               cast((cast(unit_price * 100 AS bigint) + 2) // 4 AS double) / 100 AS quarter
        FROM d_items""",
    "fn_concat": "SELECT customer_id, first_name || ' ' || last_name AS full_name FROM d_customers",
    "fn_nullif": """
        SELECT product_id, cast(stock AS double) / nullif(stock - 1, 0) AS ratio FROM d_products""",
    "fn_case": f"""
        SELECT payment_id, CASE WHEN {KNUTH} < 0.12 * 4294967296 THEN 'failed' ELSE 'completed' END AS outcome
        FROM d_payments""",
    "fn_greatest": "SELECT product_id, greatest(stock - 25, 0) AS stock FROM d_products",
    "fn_percentage": f"""
        SELECT method, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) AS payments,
               {pct("count(*) FILTER (WHERE status = 'completed')", "count(*)")} AS completed_pct
        FROM d_payments GROUP BY method""",
    "fn_substring": "SELECT product_id, substr(name, 1, 20) AS short_name, sku FROM d_products",
    "insert_if_absent": f"""
        SELECT customer_id, email, first_name, last_name, phone, city, 'Mexico' AS country, {AS_OF} AS created_at,
               {AS_OF} AS updated_at, {_flag(10)} AS _version, {_flag(0)} AS _seq, {_flag(0)} AS _is_deleted
        FROM d_customers WHERE customer_id % 3 <> 0""",
    "advance_status": f"""
        SELECT * REPLACE (CASE status WHEN 'pending' THEN 'confirmed' WHEN 'confirmed' THEN 'shipped'
                               ELSE 'delivered' END AS status,
                          {AS_OF} AS updated_at, cast(total_amount AS double) AS total_amount),
               {_flag(10)} AS _version, {_flag(0)} AS _seq, {_flag(0)} AS _is_deleted
        FROM l_orders o WHERE status NOT IN ('delivered', 'cancelled')""",
    "apply_stock_delta": f"""
        SELECT product_id, cast(cast(p_retailprice AS decimal(10,2)) * 2 AS double) AS price,
               greatest(stock + product_id % 76 - 15, 0) AS stock, {AS_OF} AS updated_at,
               {_flag(10)} AS _version, {_flag(0)} AS _is_deleted
        FROM l_products JOIN part ON p_partkey = product_id""",
    "apply_stock_delta_ordered": f"""
        SELECT c.product_id, cast(coalesce(arg_max(c.new_price, c.step), any_value(p.price)) AS double) AS price,
               arg_max(w.stock, w.step) AS stock, {AS_OF} AS updated_at,
               {_flag(10)} AS _version, {_flag(0)} AS _is_deleted
        FROM stock_changes c JOIN stock_after w USING (product_id, step) JOIN l_products p USING (product_id)
        GROUP BY c.product_id""",
    "stock_steps": f"""
        SELECT product_id, shipped_at, order_id, line, delta, {_flag(1)} AS times, w.stock
        FROM stock_changes JOIN stock_after w USING (product_id, step)""",
    "settle_old_payments": f"""
        SELECT payment_id, CASE WHEN {KNUTH} < 0.12 * 4294967296 THEN 'failed' ELSE 'completed' END AS status,
               cast(amount AS double) AS amount, {AS_OF} AS processed_at, {_flag(10)} AS _version,
               {_flag(0)} AS _is_deleted
        FROM d_payments WHERE status = 'pending' AND processed_at < {AS_OF} - INTERVAL 45 SECOND""",
    "expire_cancelled": f"""
        SELECT * REPLACE (cast(total_amount AS double) AS total_amount), {_flag(10)} AS _version,
               {_flag(0)} AS _seq, {_flag(1)} AS _is_deleted
        FROM doomed d""",
    "delete_restricted": """
        SELECT 'orders' AS table_name, order_id, cast(total_amount AS double) AS amount FROM doomed
        WHERE order_id <> 2 AND (order_id % 2 = 1 OR order_id % 10 = 0)
        UNION ALL
        SELECT 'order_items', order_id, cast(unit_price AS double) FROM d_items
        WHERE order_id IN (SELECT order_id FROM doomed WHERE order_id <> 2 AND (order_id % 2 = 1 OR order_id % 10 = 0))""",
    "cascade_delete": """
        SELECT 'orders' AS table_name, order_id, cast(total_amount AS double) AS amount FROM doomed
        UNION ALL
        SELECT 'order_items', order_id, cast(unit_price AS double) FROM d_items
        WHERE order_id IN (SELECT order_id FROM doomed)
        UNION ALL
        SELECT 'payments', order_id, cast(amount AS double) FROM d_payments
        WHERE order_id IN (SELECT order_id FROM doomed)""",
    "build_orders": f"""
        SELECT b.order_id, o.o_custkey AS customer_id, 'pending' AS status,
               cast(b.total_amount AS double) AS total_amount, o.o_orderpriority AS city,
               {AS_OF} AS created_at, {AS_OF} AS updated_at, {_flag(10)} AS _version, {_flag(0)} AS _is_deleted
        FROM built b JOIN orders o ON o.o_orderkey = b.cart_id""",
    "build_orders_items": f"""
        SELECT row_number() OVER (ORDER BY b.order_id, p.product_id) AS item_id, b.order_id,
               p.product_id, p.quantity, cast(p.unit_price AS double) AS unit_price,
               {_flag(10)} AS _version, {_flag(0)} AS _is_deleted
        FROM built b JOIN priced p USING (cart_id)""",
    "build_orders_payments": f"""
        SELECT b.order_id AS payment_id, b.order_id, cast(b.total_amount AS double) AS amount, y.method, y.status,
               y.transaction_ref, {AS_OF} AS processed_at, {_flag(10)} AS _version, {_flag(0)} AS _is_deleted
        FROM built b JOIN d_payments y ON y.order_id = b.cart_id""",
    "apply_defaults": f"""
        SELECT order_id, customer_id, CASE order_id % 4 WHEN 0 THEN 'pending' ELSE status END AS status,
               cast(total_amount AS double) AS total_amount, city, created_at, {AS_OF} AS updated_at
        FROM d_city_orders""",
    "assign_keys": """
        SELECT order_id, created_at, 1000 + row_number() OVER (ORDER BY created_at, order_id) AS number
        FROM d_orders""",
    "check_unique": f"""
        SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_unique_columns": """
        SELECT 'email' AS column_name, 'x' || customer_id % 50 AS value, count(*) AS copies
        FROM d_customers WHERE customer_id % 10 = 0 GROUP BY customer_id % 50 HAVING count(*) > 1""",
    "check_domain": """
        SELECT order_id, 'status' AS column_name, 'domain' AS rule, status AS value FROM spoiled
        WHERE status NOT IN ('pending', 'confirmed', 'shipped', 'delivered', 'cancelled')""",
    "check_range": """
        SELECT order_id AS key, 'status' AS column_name, 'length' AS rule, status AS value FROM spoiled
        WHERE length(status) > 30
        UNION ALL
        SELECT order_id, 'city', 'length', city FROM spoiled WHERE length(city) > 100
        UNION ALL
        SELECT product_id, 'price', 'range', cast(cast(price - 950 AS decimal(10,2)) AS varchar) FROM d_products
        WHERE price - 950 < 0
        UNION ALL
        SELECT product_id, 'stock', 'range', cast(stock - 10 AS varchar) FROM d_products WHERE stock - 10 < 0""",
    "check_not_null": """
        SELECT * FROM (SELECT 'status' AS column_name, count(*) FILTER (WHERE status IS NULL) AS nulls FROM spoiled
                       UNION ALL
                       SELECT 'created_at', count(*) FILTER (WHERE created_at IS NULL) FROM spoiled) n
        WHERE nulls > 0""",
    "check_foreign_keys": """
        SELECT order_id, product_id, quantity, cast(unit_price AS double) AS unit_price FROM d_items i
        WHERE NOT EXISTS (SELECT 1 FROM l_orders o WHERE o.order_id = i.order_id)""",
    "check_one_to_one": """
        SELECT c.customer_id, count(o.order_id) AS children
        FROM d_customers c LEFT JOIN d_orders o USING (customer_id)
        GROUP BY c.customer_id HAVING count(o.order_id) <> 1""",
    "check_all_rules": """
        SELECT 'orders' AS table_name, order_id AS key, 'status' AS column_name, 'domain' AS rule, status AS value
        FROM f_orders WHERE status NOT IN ('pending', 'confirmed', 'shipped', 'delivered', 'cancelled')
        UNION ALL SELECT 'orders', order_id, 'status', 'length', status FROM f_orders WHERE length(status) > 30
        UNION ALL SELECT 'orders', order_id, 'city', 'length', city FROM f_orders WHERE length(city) > 100
        UNION ALL SELECT 'products', product_id, 'price', 'range', cast(price AS varchar) FROM f_products WHERE price < 0
        UNION ALL SELECT 'products', product_id, 'stock', 'range', cast(stock AS varchar) FROM f_products WHERE stock < 0
        UNION ALL SELECT 'payments', payment_id, 'method', 'domain', method FROM f_payments WHERE method = 'cash'
        UNION ALL SELECT 'payments', payment_id, 'status', 'domain', status FROM f_payments WHERE status = 'open'
        UNION ALL SELECT 'order_items', item_id, 'quantity', 'range', cast(quantity AS varchar) FROM keyed_items
        WHERE quantity <= 0
        UNION ALL SELECT 'order_items', item_id, 'unit_price', 'range', cast(unit_price AS varchar) FROM keyed_items
        WHERE unit_price < 0
        UNION ALL SELECT 'customers', NULL, 'email', 'unique', email FROM f_customers GROUP BY email HAVING count(*) > 1
        UNION ALL SELECT 'products', NULL, 'sku', 'unique', sku FROM f_products GROUP BY sku HAVING count(*) > 1
        UNION ALL SELECT 'payments', NULL, 'transaction_ref', 'unique', transaction_ref FROM f_payments
        GROUP BY transaction_ref HAVING count(*) > 1
        UNION ALL SELECT 'categories', NULL, 'name', 'unique', name FROM f_categories GROUP BY name HAVING count(*) > 1""",
    "check_all_nulls": """
        SELECT * FROM (
            SELECT 'orders' AS table_name, 'status' AS column_name, count(*) FILTER (WHERE status IS NULL) AS nulls FROM f_orders
            UNION ALL SELECT 'orders', 'created_at', count(*) FILTER (WHERE created_at IS NULL) FROM f_orders
            UNION ALL SELECT 'customers', 'first_name', count(*) FILTER (WHERE first_name IS NULL) FROM f_customers) n
        WHERE nulls > 0""",
    "check_all_references": """
        SELECT 'orders' AS table_name, 'customer_id' AS column_name, count(*) AS rows, count(DISTINCT customer_id) AS parents
        FROM f_orders WHERE customer_id NOT IN (SELECT customer_id FROM d_customers)
        UNION ALL SELECT 'products', 'category_id', count(*), count(DISTINCT category_id) FROM f_products
        WHERE category_id NOT IN (SELECT category_id FROM d_categories)
        UNION ALL SELECT 'order_items', 'order_id', count(*), count(DISTINCT order_id) FROM keyed_items
        WHERE order_id NOT IN (SELECT order_id FROM d_orders)
        UNION ALL SELECT 'order_items', 'product_id', count(*), count(DISTINCT product_id) FROM keyed_items
        WHERE product_id NOT IN (SELECT product_id FROM d_products)
        UNION ALL SELECT 'payments', 'order_id', count(*), count(DISTINCT order_id) FROM f_payments
        WHERE order_id NOT IN (SELECT order_id FROM d_orders)""",
    "check_one_payment_per_order": """
        SELECT o.order_id, count(p.paid) AS children
        FROM d_orders o LEFT JOIN (SELECT CASE order_id % 3 WHEN 0 THEN order_id + 1 ELSE order_id END AS paid
                                   FROM d_payments) p ON p.paid = o.order_id
        GROUP BY o.order_id HAVING count(p.paid) <> 1""",
    "check_order_totals": """
        SELECT o.order_id, cast(o.total_amount AS double) AS total_amount,
               cast(coalesce(t.total, 0) AS double) AS items_total
        FROM l_orders o LEFT JOIN (SELECT order_id, sum(line_value) AS total FROM d_items GROUP BY order_id) t
             USING (order_id)
        WHERE o.total_amount IS DISTINCT FROM coalesce(t.total, 0)""",
    "reconcile_counts": """
        SELECT table_name, source_rows, target_rows, source_rows - target_rows AS behind
        FROM (SELECT 'orders' AS table_name, (SELECT count(*) FROM d_orders) AS source_rows,
                     (SELECT count(*) FROM l_orders) AS target_rows
              UNION ALL
              SELECT 'products', (SELECT count(*) FROM d_products), (SELECT count(*) FROM l_products)) t""",
    "reconcile_counts_all": """
        SELECT table_name, source_rows, target_rows, source_rows - target_rows AS behind
        FROM (SELECT 'orders' AS table_name, (SELECT count(*) FROM d_orders) AS source_rows,
                     (SELECT count(*) FROM l_orders) AS target_rows
              UNION ALL SELECT 'products', (SELECT count(*) FROM d_products), (SELECT count(*) FROM l_products)
              UNION ALL SELECT 'categories', count(*), count(*) FROM d_categories
              UNION ALL SELECT 'customers', count(*), count(*) FROM d_customers
              UNION ALL SELECT 'payments', count(*), count(*) FROM d_payments
              UNION ALL SELECT 'order_items', count(*), count(*) FROM keyed_items) t""",
    "reconcile_diff": """
        SELECT coalesce(s.order_id, t.order_id) AS order_id,
               CASE WHEN t.order_id IS NULL THEN 'missing' WHEN s.order_id IS NULL THEN 'extra'
                    ELSE 'different' END AS state
        FROM d_orders s FULL JOIN l_orders t ON s.order_id = t.order_id
        WHERE t.order_id IS NULL OR s.order_id IS NULL OR s.customer_id IS DISTINCT FROM t.customer_id
           OR s.status IS DISTINCT FROM t.status OR s.total_amount IS DISTINCT FROM t.total_amount
           OR s.created_at IS DISTINCT FROM t.created_at""",
}

# The same question put to other forms of the tables has the same answer.
SELECTS |= {
    "q1_from_store": SELECTS["q1_daily_category_revenue"],
    "q2_from_store": SELECTS["q2_customer_ltv"],
    "reconcile_tree": SELECTS["reconcile_diff"],
    "q1_incremental": SELECTS["q1_daily_category_revenue"],
    "q2_incremental": SELECTS["q2_customer_ltv"],
    "q3_incremental": SELECTS["q3_city_fulfillment"],
    "q4_incremental": SELECTS["q4_product_performance"],
    "q5_incremental": SELECTS["q5_payment_share"],
    "q3_sql": SELECTS["q3_city_fulfillment"],
    "q4_from_store": SELECTS["q4_product_performance"],
    "q5_sql": SELECTS["q5_payment_share"],
}

ORACLE = {name: sql(select) for name, select in SELECTS.items()}
