"""Plain SQL for every registered query, as an independent check of its result."""

from __future__ import annotations

import datetime as dt

from tidemart.functions.temporal import month_starts

# The months of the order log.
FIRST_MONTH, LAST_MONTH = dt.date(1995, 1, 1), dt.date(2001, 8, 1)

# Shared relations; each statement starts with the ones it needs.
_RELATIONS = {
    "posts": """
        SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate::TIMESTAMP AS ts,
               o_totalprice::DECIMAL(14,2) AS views, o_orderstatus AS kind
        FROM orders""",
    "people": """
        SELECT c.c_custkey AS id, n.n_name AS display_name, s.signup
        FROM (SELECT o_custkey, MIN(o_orderdate)::TIMESTAMP AS signup FROM orders GROUP BY o_custkey) s
        JOIN customer c ON c.c_custkey = s.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "retention": """
        SELECT f.cohort AS cohort_dt, m.month AS session_date, COUNT(*)::BIGINT AS users_cnt,
               z.n::BIGINT AS cohort_users_cnt,
               ((2 * COUNT(*) * 10000 + z.n) // (2 * z.n)) / 100.0::DOUBLE AS retention_rate
        FROM (SELECT DISTINCT user_id, date_trunc('month', ts)::DATE AS month FROM posts) m
        JOIN (SELECT user_id, MIN(date_trunc('month', ts))::DATE AS cohort FROM posts GROUP BY user_id) f
          ON f.user_id = m.user_id
        JOIN (SELECT cohort, COUNT(*) AS n
              FROM (SELECT user_id, MIN(date_trunc('month', ts))::DATE AS cohort FROM posts GROUP BY user_id)
              GROUP BY cohort) z ON z.cohort = f.cohort
        GROUP BY f.cohort, m.month, z.n""",
    "months": """
        SELECT month(ts)::INT AS creation_month, COUNT(*)::BIGINT AS posts_count
        FROM posts
        WHERE ts >= TIMESTAMP '1998-09-01' AND ts <= TIMESTAMP '1998-12-31'
        GROUP BY month(ts)""",
    "status_orders": """
        SELECT o.o_custkey AS user_id, o.o_orderkey AS order_id, o.o_orderdate::TIMESTAMP AS order_ts,
               o.o_totalprice::DECIMAL(14,2) AS cost, l.status
        FROM orders o
        LEFT JOIN (
            SELECT l_orderkey, CASE l_linestatus WHEN 'F' THEN 4 WHEN 'O' THEN 1 ELSE 2 END AS status,
                   row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
                       l_partkey DESC, l_suppkey DESC,
                       CASE l_linestatus WHEN 'F' THEN 4 WHEN 'O' THEN 1 ELSE 2 END DESC) AS rn
            FROM lineitem) l ON l.l_orderkey = o.o_orderkey AND l.rn = 1
        WHERE o.o_orderdate >= TIMESTAMP '2000-01-01'""",
    "measures": """
        SELECT c.c_custkey AS user_id, MAX(o.o_orderdate) AS latest, COUNT(o.o_orderkey) AS n,
               SUM(o.o_totalprice::DECIMAL(14,2)) AS spent
        FROM customer c
        LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
             AND o.o_orderdate >= TIMESTAMP '2000-01-01'
        GROUP BY c.c_custkey""",
    "log_measures": """
        SELECT c.c_custkey AS user_id, MAX(o.order_ts) AS latest, COUNT(o.order_id) AS n,
               SUM(o.cost) AS spent
        FROM customer c
        LEFT JOIN status_orders o ON o.user_id = c.c_custkey AND o.status = 4
        GROUP BY c.c_custkey""",
    "segments": """
        SELECT user_id,
               ntile(5) OVER (ORDER BY latest DESC NULLS FIRST, user_id)::INT AS recency,
               ntile(5) OVER (ORDER BY n, user_id)::INT AS frequency,
               ntile(5) OVER (ORDER BY spent ASC NULLS FIRST, user_id)::INT AS monetary_value
        FROM measures""",
    "deliveries": """
        SELECT o_orderkey AS shippingid, o_custkey % 25 AS vendorid,
               o_totalprice::DECIMAL(14,2) AS payment_amount, o_orderstatus AS st,
               o_orderdate::TIMESTAMP AS booked,
               o_orderdate::TIMESTAMP + INTERVAL 7 DAY AS plan,
               n_name AS country, ((n_regionkey + 1) * 0.01)::DECIMAL(14,3) AS base_rate,
               CASE left(o_orderpriority, 1) WHEN '1' THEN '1p' WHEN '2' THEN '1p' WHEN '3' THEN '1p'
                    ELSE '3p' END AS transfer_type,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'car' WHEN '2' THEN 'train'
                    WHEN '3' THEN 'ship' WHEN '4' THEN 'airplane' ELSE 'multiple' END AS transfer_model,
               ((left(o_orderpriority, 1)::INT * 10 + 15 + o_orderkey % 3) / 1000.0)::DECIMAL(14,3) AS rate,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::TIMESTAMP
                    + to_days((o_orderkey % 9)::INT) + to_hours(2 + o_orderkey % 22) END AS received,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 13 = 0
                    THEN o_orderdate::TIMESTAMP + INTERVAL 12 DAY END AS returned
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "delivery_log": """
        SELECT shippingid, 'booked' AS state, 'in_progress' AS status, booked AS moment, rate, transfer_type,
               transfer_model FROM deliveries
        UNION ALL
        SELECT shippingid, 'transition', 'in_progress', booked + INTERVAL 1 HOUR, rate, transfer_type,
               transfer_model FROM deliveries
        UNION ALL
        SELECT shippingid, 'recieved', 'finished', received, rate, transfer_type, transfer_model
        FROM deliveries WHERE received IS NOT NULL
        UNION ALL
        SELECT shippingid, 'returned', 'finished', returned, rate, transfer_type, transfer_model
        FROM deliveries WHERE returned IS NOT NULL""",
    "countries": """
        SELECT row_number() OVER (ORDER BY country, base_rate)::BIGINT AS shipping_country_id,
               country AS shipping_country, base_rate AS shipping_country_base_rate
        FROM (SELECT DISTINCT country, base_rate FROM deliveries)""",
    "transfers": """
        SELECT row_number() OVER (ORDER BY transfer_type, transfer_model)::BIGINT AS transfer_type_id,
               transfer_type, transfer_model,
               (SUM(rate)::DOUBLE / COUNT(*))::DECIMAL(14,3) AS shipping_transfer_rate
        FROM delivery_log GROUP BY transfer_type, transfer_model""",
    "agreements": """
        SELECT DISTINCT vendorid::BIGINT AS agreementid, 'vsp-' || vendorid AS agreement_number,
               ((vendorid % 9) * 0.01)::DECIMAL(14,2) AS agreement_rate,
               (0.02 + (vendorid % 5) * 0.001)::DECIMAL(14,3) AS agreement_commission
        FROM deliveries""",
    "info": """
        SELECT d.shippingid, d.vendorid::BIGINT AS vendorid, d.payment_amount,
               d.plan AS shipping_plan_datetime, t.transfer_type_id, c.shipping_country_id,
               d.vendorid::BIGINT AS agreementid
        FROM deliveries d
        JOIN transfers t ON t.transfer_type = d.transfer_type AND t.transfer_model = d.transfer_model
        JOIN countries c ON c.shipping_country = d.country""",
    "last_state": """
        SELECT l.shippingid, l.status, l.state, d.booked AS shipping_start_fact_datetime,
               d.received AS shipping_end_fact_datetime
        FROM delivery_log l
        JOIN (SELECT shippingid, MAX(moment) AS moment FROM delivery_log GROUP BY shippingid) m
          ON m.shippingid = l.shippingid AND m.moment = l.moment
        JOIN deliveries d ON d.shippingid = l.shippingid""",
    "sales": """
        SELECT (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate))::INT AS date_id,
               o_orderdate::DATE AS day, l_partkey AS item_id, o_custkey AS customer_id,
               c_nationkey AS city_id, l_quantity::BIGINT AS quantity,
               (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
                * l_extendedprice::DECIMAL(14,2))::DECIMAL(14,2) AS amount
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""",
    "exported": """
        SELECT o_orderkey * 10 + l_linenumber AS id, o_orderdate::TIMESTAMP AS date_time,
               c_nationkey AS city_id, n_name AS city_name, o_custkey AS customer_id,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               l_partkey AS item_id, p_name AS item_name, l_quantity::BIGINT AS quantity,
               l_extendedprice::DECIMAL(14,2) AS price, l_returnflag AS flag
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey""",
    "loaded": """
        SELECT * REPLACE ((CASE WHEN day >= DATE '2001-07-01' THEN amount ELSE abs(amount) END)::DECIMAL(14,2)
                          AS amount)
        FROM sales""",
    "cleaned": """
        SELECT id, date_time, city_id, city_name, customer_id, first_name, last_name, item_id, item_name,
               quantity,
               (CASE WHEN flag = 'R' AND date_time >= TIMESTAMP '1998-01-01' THEN -price ELSE price END)
                   ::DECIMAL(14,2) AS payment_amount,
               price, flag
        FROM exported""",
}

_NEEDS = {
    "retention": ["posts"],
    "months": ["posts"],
    "log_measures": ["status_orders"],
    "segments": ["measures"],
    "delivery_log": ["deliveries"],
    "countries": ["deliveries"],
    "transfers": ["delivery_log"],
    "agreements": ["deliveries"],
    "info": ["transfers", "countries"],
    "last_state": ["delivery_log"],
    "cleaned": ["exported"],
    "loaded": ["sales"],
}

_LOG_COLUMNS = (
    "date_time, city_id, city_name, customer_id, first_name, last_name, item_id, item_name, "
    "quantity, payment_amount"
)


def _with(body: str, *names: str) -> str:
    """Prefix ``body`` with the named relations and whatever they rest on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({_RELATIONS[n]})" for n in ordered) + body


def _retention_weekly(period: str, extra: str = "", source: str = "sales") -> str:
    lead = f"{extra}, " if extra else ""
    return f"""
        SELECT {lead}COUNT(*) FILTER (WHERE amount_sign > 0 AND n = 1)::BIGINT AS new_customers_count,
               COUNT(*) FILTER (WHERE amount_sign > 0 AND n > 1)::BIGINT AS returning_customers_count,
               COUNT(*) FILTER (WHERE amount_sign < 0)::BIGINT AS refunded_customer_count,
               period_id,
               COALESCE(SUM(total) FILTER (WHERE amount_sign > 0 AND n = 1), 0)::DECIMAL(18,2)
                   AS new_customers_revenue,
               COALESCE(SUM(total) FILTER (WHERE amount_sign > 0 AND n > 1), 0)::DECIMAL(18,2)
                   AS returning_customers_revenue,
               ROUND(COALESCE(SUM(total) FILTER (WHERE amount_sign < 0), 0))::BIGINT AS customers_refunded
        FROM (SELECT {lead}{period} AS period_id, customer_id,
                     CASE WHEN amount < 0 THEN -1 ELSE 1 END AS amount_sign,
                     COUNT(*) AS n, SUM(amount) AS total
              FROM {source} GROUP BY ALL)
        GROUP BY {lead}period_id"""


def _matrix() -> str:
    cells = ", ".join(
        f"MAX(CASE WHEN session_date = DATE '{m}' THEN retention_rate END) AS \"{m}\""
        for m in month_starts(FIRST_MONTH, LAST_MONTH)
    )
    return f" SELECT strftime(cohort_dt, '%Y-%m-%d') AS cohort_dt, {cells} FROM retention GROUP BY cohort_dt"


_AS_CODED = "(year(day)::VARCHAR || week(day)::VARCHAR)::INT"
_ISO = "(isoyear(day) * 100 + week(day))::INT"


def statements() -> dict[str, str]:
    found = _statements()
    for name in ("running_views", "second_last_month"):
        found[f"{name}_skewed"] = found[name]
    return found


def _statements() -> dict[str, str]:
    return {
        "sample_rows": _with(
            " SELECT id, display_name, signup AS creation_date FROM people ORDER BY id LIMIT 10", "people"
        ),
        "sample_rows_last": _with(
            " SELECT id, display_name, signup AS creation_date FROM people ORDER BY id DESC LIMIT 10",
            "people",
        ),
        "monthly_views_total": _with(
            """
            SELECT date_trunc('month', ts)::DATE AS month_date, SUM(views)::DECIMAL(18,2) AS total_views
            FROM posts WHERE year(ts) = 1998
            GROUP BY month_date ORDER BY total_views DESC NULLS LAST, month_date""",
            "posts",
        ),
        "active_new_users": _with(
            """
            SELECT display_name, COUNT(DISTINCT people.id)::BIGINT AS count
            FROM people JOIN posts ON posts.user_id = people.id
            WHERE kind = 'F' AND ts >= signup
              AND ts <= ((signup::DATE + INTERVAL 3 MONTH)::DATE)::TIMESTAMP
            GROUP BY display_name HAVING COUNT(posts.id) > 2 ORDER BY display_name""",
            "posts",
            "people",
        ),
        "active_new_users_per_user": _with(
            """
            SELECT display_name, COUNT(*)::BIGINT AS count
            FROM (SELECT display_name, people.id
                  FROM people JOIN posts ON posts.user_id = people.id
                  WHERE kind = 'F' AND ts >= signup
                    AND ts <= ((signup::DATE + INTERVAL 12 MONTH)::DATE)::TIMESTAMP
                  GROUP BY display_name, people.id HAVING COUNT(*) > 2)
            GROUP BY display_name""",
            "posts",
            "people",
        ),
        "cohort_posts_by_month": _with(
            """
            SELECT date_trunc('month', ts)::DATE AS month, COUNT(*)::BIGINT AS count
            FROM posts JOIN people ON people.id = posts.user_id
            WHERE year(ts) = 1996 AND month(signup) IN (1, 2, 3)
              AND EXISTS (SELECT 1 FROM posts p WHERE p.user_id = posts.user_id
                          AND p.ts::DATE BETWEEN DATE '1996-10-01' AND DATE '1996-12-31')
            GROUP BY 1""",
            "posts",
            "people",
        ),
        "running_views": _with(
            """
            SELECT user_id, ts AS creation_date, views AS views_count,
                   (SUM(views) OVER (PARTITION BY user_id ORDER BY ts))::DECIMAL(18,2) AS cumulative_count
            FROM posts""",
            "posts",
        ),
        "avg_daily_posts": """
            SELECT user_id, COUNT(*)::DOUBLE / COUNT(DISTINCT ts::DATE) AS avg_daily
            FROM events WHERE ts::DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
            GROUP BY user_id HAVING COUNT(*) > 15""",
        "avg_active_days": """
            SELECT ROUND(AVG(days))::BIGINT AS result
            FROM (SELECT user_id, COUNT(DISTINCT ts::DATE) AS days FROM events
                  WHERE ts::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-07' GROUP BY user_id)""",
        "second_last_month": _with(
            """
            SELECT user_id, ts AS creation_date,
                   strftime(LAG(ts, 2) OVER (PARTITION BY user_id ORDER BY ts, id), '%B')
                       AS second_last_month
            FROM posts""",
            "posts",
        ),
        "cohort_retention": _with(" SELECT * FROM retention", "retention"),
        "cohort_retention_incremental": _with(" SELECT * FROM retention", "retention"),
        "weekly_active_users": """
            WITH seen AS (SELECT DISTINCT ts::DATE AS day, event_type AS post_type_id, user_id FROM events),
                 days AS (SELECT DISTINCT day, post_type_id FROM seen WHERE user_id IS NOT NULL)
            SELECT d.day, d.post_type_id, COUNT(DISTINCT s.user_id)::BIGINT AS active_users
            FROM days d JOIN seen s ON s.post_type_id = d.post_type_id AND s.day BETWEEN d.day - 6 AND d.day
            GROUP BY d.day, d.post_type_id""",
        "retention_matrix": _with(_matrix(), "retention"),
        "month_over_month": _with(
            """
            SELECT creation_month, posts_count,
                   ROUND((posts_count::DOUBLE / LAG(posts_count) OVER (ORDER BY creation_month) - 1) * 100, 2)
                       AS percentage
            FROM months""",
            "months",
        ),
        "posts_share": _with(
            """
            SELECT creation_month, posts_count,
                   ROUND(posts_count * 100.0::DOUBLE / (SELECT SUM(posts_count) FROM months), 1) AS share_pct
            FROM months""",
            "months",
        ),
        "top_author_weekly": """
            SELECT week(ts)::INT AS week_creation, MAX(ts)::TIMESTAMP AS creation_date
            FROM events
            WHERE user_id = (SELECT user_id FROM events GROUP BY user_id
                             ORDER BY COUNT(*) DESC, user_id LIMIT 1)
              AND ts::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
            GROUP BY 1""",
        "user_activity": _with(
            """
            SELECT user_id, ts AS creation_date, views AS views_count,
                   (SUM(views) OVER (ORDER BY ts))::DECIMAL(18,2) AS cumulative_count
            FROM posts WHERE user_id = 14""",
            "posts",
        ),
        "orders_since": """
            SELECT o_custkey AS user_id, o_orderkey AS order_id, o_orderdate::TIMESTAMP AS order_ts,
                   o_totalprice::DECIMAL(14,2) AS cost,
                   (CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END)::INT AS status
            FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
        "orders_current_status": _with(" SELECT * FROM status_orders", "status_orders"),
        "rfm_segments": _with(" SELECT * FROM segments", "segments"),
        "rfm_segments_documented": _with(
            """
            SELECT s.user_id,
                   ntile(5) OVER (ORDER BY m.latest ASC NULLS FIRST, s.user_id)::INT AS recency,
                   s.frequency, s.monetary_value
            FROM segments s JOIN measures m ON m.user_id = s.user_id""",
            "segments",
        ),
        "rfm_segments_status_log": _with(
            " " + _RELATIONS["segments"].replace("measures", "log_measures"), "log_measures"
        ),
        "rfm_segment_balance": _with(
            """
            , sizes AS (
                SELECT 'recency' AS score, recency AS value, COUNT(*)::BIGINT AS users
                FROM segments GROUP BY recency
                UNION ALL
                SELECT 'frequency', frequency, COUNT(*)::BIGINT FROM segments GROUP BY frequency
                UNION ALL
                SELECT 'monetary_value', monetary_value, COUNT(*)::BIGINT
                FROM segments GROUP BY monetary_value)
            SELECT score, value, users,
                   MAX(users) OVER (PARTITION BY score) - MIN(users) OVER (PARTITION BY score) <= 1 AS balanced
            FROM sizes""",
            "segments",
        ),
        "dim_country_rates": _with(" SELECT * FROM countries", "countries"),
        "dim_agreement": _with(" SELECT * FROM agreements", "agreements"),
        "dim_transfer": _with(" SELECT * FROM transfers", "transfers"),
        "shipping_info": _with(" SELECT * FROM info", "info"),
        "shipping_status": _with(" SELECT * FROM last_state", "last_state"),
        "shipping_status_ties": _with(
            """
            , busy AS (
                SELECT CASE WHEN shippingid % 3 = 0 THEN 0 ELSE shippingid END AS shippingid, status, state,
                       date_trunc('day', moment) AS moment FROM delivery_log
            ), last_days AS (
                SELECT shippingid, MAX(moment) AS moment, MAX(moment) FILTER (state = 'booked') AS booked,
                       MAX(moment) FILTER (state = 'received' OR state = 'recieved') AS received
                FROM busy GROUP BY shippingid)
            SELECT b.shippingid, b.status, b.state, l.booked::TIMESTAMP AS shipping_start_fact_datetime,
                   l.received::TIMESTAMP AS shipping_end_fact_datetime
            FROM busy b JOIN last_days l ON l.shippingid = b.shippingid AND l.moment = b.moment""",
            "delivery_log",
        ),
        "shipping_datamart": _with(
            """
            SELECT i.shippingid, i.vendorid, t.transfer_type,
                   date_part('day', s.shipping_end_fact_datetime - s.shipping_start_fact_datetime)::INT
                       AS full_day_at_shipping,
                   COALESCE(s.shipping_end_fact_datetime > i.shipping_plan_datetime, FALSE)::INT AS is_delay,
                   (s.status = 'finished')::INT AS is_shipping_finish,
                   COALESCE(date_part('day', CASE
                       WHEN s.shipping_end_fact_datetime > i.shipping_plan_datetime
                       THEN s.shipping_end_fact_datetime - i.shipping_plan_datetime END), 0)::INT
                       AS delay_day_at_shipping,
                   i.payment_amount,
                   (i.payment_amount * (c.shipping_country_base_rate + a.agreement_rate
                       + t.shipping_transfer_rate))::DECIMAL(18,5) AS vat,
                   (i.payment_amount * a.agreement_commission)::DECIMAL(18,5) AS profit
            FROM info i JOIN last_state s ON s.shippingid = i.shippingid
            JOIN transfers t ON t.transfer_type_id = i.transfer_type_id
            JOIN countries c ON c.shipping_country_id = i.shipping_country_id
            JOIN agreements a ON a.agreementid = i.agreementid""",
            "info",
            "last_state",
            "agreements",
        ),
        "vendor_quality": _with(
            """
            , counts AS (
                SELECT vendorid::BIGINT AS vendorid, COUNT(*) AS deliveries,
                       COUNT(*) FILTER (WHERE received > plan) AS late,
                       COUNT(*) FILTER (WHERE received IS NULL) AS undelivered,
                       COUNT(returned) AS returned
                FROM deliveries GROUP BY vendorid)
            SELECT vendorid, deliveries::BIGINT AS deliveries,
                   ((2 * late * 10000 + deliveries) // (2 * deliveries)) / 100.0::DOUBLE AS late_pct,
                   ((2 * undelivered * 10000 + deliveries) // (2 * deliveries)) / 100.0::DOUBLE
                       AS undelivered_pct,
                   ((2 * returned * 10000 + deliveries) // (2 * deliveries)) / 100.0::DOUBLE AS returned_pct
            FROM counts""",
            "deliveries",
        ),
        "clean_order_log": _with(f" SELECT {_LOG_COLUMNS} FROM cleaned", "cleaned"),
        "clean_order_log_deduped": _with(
            f"""
            SELECT {_LOG_COLUMNS} FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY id, date_time < TIMESTAMP '1998-01-01'
                    ORDER BY item_id::VARCHAR, item_name, quantity::VARCHAR, price::VARCHAR,
                             CASE WHEN date_time < TIMESTAMP '1998-01-01' OR flag = 'N' THEN ''
                                  WHEN flag = 'R' THEN 'refunded' ELSE 'shipped' END) AS rn
                FROM cleaned) WHERE rn = 1""",
            "cleaned",
        ),
        "daily_increment": _with(
            f"""
            , landed AS (
                SELECT * EXCLUDE (payment_amount), date_time >= TIMESTAMP '2001-07-01' AS increment,
                       (CASE WHEN increment AND flag = 'R' THEN -price ELSE price END)::DECIMAL(14,2)
                           AS payment_amount
                FROM cleaned)
            SELECT {_LOG_COLUMNS},
                   CASE WHEN increment THEN strftime(date_time, '%Y-%m-%d') ELSE '2001-06-30' END AS dt
            FROM landed""",
            "cleaned",
        ),
        "daily_increment_dated": _with(
            f"""
            , landed AS (
                SELECT * EXCLUDE (payment_amount), date_time >= TIMESTAMP '2001-07-01' AS increment,
                       (CASE WHEN increment AND flag = 'R' THEN -price ELSE price END)::DECIMAL(14,2)
                           AS payment_amount
                FROM cleaned)
            SELECT {_LOG_COLUMNS},
                   CASE WHEN increment THEN strftime(date_time, '%Y-%m-%d') ELSE '2001-06-30' END AS dt
            FROM landed""",
            "cleaned",
        ),
        "retail_load_fact": _with(
            """
            SELECT date_id, item_id, customer_id, city_id, quantity, amount AS payment_amount,
                   strftime(day, '%Y-%m-%d') AS dt
            FROM loaded""",
            "loaded",
        ),
        "retail_load_dims": _with(
            """
            SELECT DISTINCT 'city' AS dim, city_id AS id, city_name AS name FROM exported
            UNION ALL SELECT DISTINCT 'item', item_id, item_name FROM exported
            UNION ALL SELECT 'customer', customer_id, first_name || '#' || last_name || '#' || MAX(city_id)
            FROM exported GROUP BY customer_id, first_name, last_name""",
            "exported",
        ),
        "retail_load_weekly": _with(_retention_weekly(_AS_CODED, source="loaded"), "loaded"),
        "stage_customer_research": """
            SELECT o_orderdate::TIMESTAMP AS date_id, left(o_orderpriority, 1)::INT AS category_id,
                   c_nationkey::INT AS geo_id, COUNT(*)::INT AS sales_qty,
                   SUM(o_totalprice::DECIMAL(18,2))::DECIMAL(18,2) AS sales_amt
            FROM orders JOIN customer ON c_custkey = o_custkey
            GROUP BY o_orderdate, left(o_orderpriority, 1), c_nationkey""",
        "stage_user_activity": """
            SELECT ts::TIMESTAMP AS date_time,
                   (CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                         WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END)::BIGINT AS action_id,
                   user_id AS customer_id, regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT AS quantity
            FROM events""",
        "dim_city": _with(
            """
            SELECT DISTINCT city_id, city_name FROM exported
            WHERE city_id NOT IN (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey
                                  WHERE r_name = 'AFRICA')""",
            "exported",
        ),
        "dim_item": _with(
            """
            SELECT DISTINCT item_id, item_name FROM exported
            WHERE item_id NOT IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')""",
            "exported",
        ),
        "dim_customer": _with(
            """
            SELECT customer_id, first_name, last_name, MAX(city_id) AS city_id FROM exported
            WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')
            GROUP BY customer_id, first_name, last_name""",
            "exported",
        ),
        "fact_sales_daily": _with(
            """
            SELECT date_id, item_id, customer_id, city_id, quantity, amount AS payment_amount
            FROM sales WHERE day = DATE '1995-06-19'""",
            "sales",
        ),
        "fact_sales_backfill": _with(
            """
            SELECT date_id, item_id, customer_id, city_id, quantity, amount AS payment_amount
            FROM sales""",
            "sales",
        ),
        "customer_retention_weekly": _with(_retention_weekly(_AS_CODED), "sales"),
        "customer_retention_iso_weekly": _with(_retention_weekly(_ISO), "sales"),
        "retention_by_item": _with(
            ", branded AS (SELECT sales.*, p_brand AS item_group FROM sales JOIN part ON p_partkey = item_id)"
            + _retention_weekly(_AS_CODED, "item_group", "branded"),
            "sales",
        ),
        "dq_duplicates": """
            SELECT (SELECT COUNT(*) FROM lineitem)::BIGINT AS total_rows, COUNT(*)::BIGINT AS distinct_rows,
                   ((SELECT COUNT(*) FROM lineitem) - COUNT(*))::BIGINT AS duplicate_rows
            FROM (SELECT DISTINCT * FROM lineitem)""",
        "dq_nulls": _with(
            " "
            + " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL)::BIGINT AS null_count "
                "FROM status_orders"
                for c in ("user_id", "order_id", "order_ts", "cost", "status")
            ),
            "status_orders",
        ),
        "dq_pk_violations": """
            SELECT l_orderkey, l_linenumber, COUNT(*)::BIGINT AS row_count FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
        "dq_orphans": """
            SELECT o_orderkey, o_custkey FROM orders
            WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
        "dq_rules": """
            SELECT 'price_positive' AS rule, COUNT(*) FILTER (WHERE l_extendedprice <= 0)::BIGINT AS violations
            FROM lineitem
            UNION ALL
            SELECT 'discount_at_most_price',
                   COUNT(*) FILTER (WHERE l_discount * l_extendedprice > l_extendedprice)::BIGINT FROM lineitem
            UNION ALL
            SELECT 'discount_set', COUNT(*) FILTER (WHERE l_discount <= 0)::BIGINT FROM lineitem
            UNION ALL
            SELECT 'flag_one_letter', COUNT(*) FILTER (WHERE length(l_returnflag) > 1)::BIGINT FROM lineitem""",
        "row_count": "SELECT COUNT(*)::BIGINT AS row_count FROM customer",
    }
