"""DuckDB SQL for every registered query, over the generic test tables.

Written without the shortcuts of the Spark code: joins repeat rows where the
grain says so, ranks and running totals are plain windows.  Money is DECIMAL
until the last step.
"""

from __future__ import annotations

import re

MONTHS_FROM = "DATE '1996-01-01'"
MIN_COHORT = 5
TOP_CUSTOMERS = 100
SAMPLE = 500
SEARCH = "1.*5"

# Named building blocks; `statement` adds the ones a query mentions.
PARTS: dict[str, str] = {
    # ---- raw tables
    "src_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS src,
               o_orderpriority AS priority,
               CASE o_orderstatus
                   WHEN 'F' THEN 'delivered'
                   WHEN 'O' THEN 'shipped'
                   ELSE list_value('canceled', 'unavailable', 'processing')[1 + o_orderkey % 3]
               END AS order_status,
               o_orderdate + to_minutes((o_orderkey * 37) % 1440) AS bought,
               CAST(o_orderdate AS DATE) + CAST(10 + o_orderkey % 21 AS INTEGER) AS promised
        FROM orders""",
    "src_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS ship_limit,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))
                    AS DECIMAL(18,2)) AS freight
        FROM lineitem""",
    "src_people": """
        SELECT c_custkey AS customer_id,
               c_custkey - CASE c_custkey % 20 WHEN 1 THEN 1 ELSE 0 END AS person,
               upper(n_name) AS state,
               CAST(CASE WHEN c_custkey % 40 < 2 THEN 0
                         ELSE c_nationkey * 100 + c_custkey % 7 END AS INTEGER) AS zip
        FROM customer
        LEFT JOIN nation ON n_nationkey = CASE WHEN c_custkey % 40 < 2 THEN 0
                                               ELSE c_nationkey END""",
    # ---- star
    "ord": """
        SELECT s.order_id, p.person, s.order_status, s.bought,
               CAST(s.bought AS DATE) AS day,
               CAST(date_trunc('month', s.bought) AS DATE) AS month,
               CASE WHEN s.order_id % 101 <> 0
                    THEN s.bought + to_minutes((s.order_id * 53) % 2880) END AS approved,
               CASE WHEN s.src <> 'P'
                    THEN s.bought + to_minutes(2880 + (s.order_id * 71) % 10080) END AS shipped,
               CASE WHEN (s.src = 'F' AND s.order_id % 97 <> 0)
                      OR (s.src <> 'F' AND s.order_id % 89 = 0)
                    THEN s.bought + to_minutes(2880 + (s.order_id * 131) % 43200)
               END AS delivered,
               s.promised,
               s.src IN ('F', 'O') AS sale,
               s.order_status IN ('canceled', 'unavailable') AS lost
        FROM src_orders s LEFT JOIN src_people p USING (customer_id)""",
    "od": """
        SELECT *, date_diff('day', bought, delivered) AS took,
               date_diff('day', delivered, CAST(promised AS TIMESTAMP)) AS early,
               date_diff('day', approved, shipped) AS to_ship
        FROM ord""",
    "pay": """
        SELECT l_orderkey AS order_id, l_linenumber AS seq,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                                 WHEN 'R' THEN 'voucher' END AS kind,
               CAST(CASE l_returnflag WHEN 'A' THEN 1 + l_partkey % 10 ELSE 1 END AS INTEGER)
                   AS parts,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
                    AS DECIMAL(18,2)) AS paid
        FROM lineitem""",
    "rev": """
        SELECT order_id AS review_id, order_id, CAST(1 + (order_id * 7) % 5 AS INTEGER) AS score,
               priority AS title, bought + INTERVAL 30 DAY AS made
        FROM src_orders WHERE order_id % 10 <> 0
        UNION ALL
        SELECT 1000000000 + order_id, order_id, CAST(1 + order_id % 5 AS INTEGER),
               NULL, bought + INTERVAL 30 DAY
        FROM src_orders WHERE order_id % 20 = 5""",
    "dc": """
        SELECT person, state, zip, min(customer_id) AS first_id,
               count(DISTINCT customer_id) AS ids
        FROM src_people GROUP BY person, state, zip""",
    "home": """
        SELECT person, arg_min(state, first_id) AS state FROM dc GROUP BY person""",
    "dp": """
        SELECT p_partkey AS product_id, p_partkey % 50 = 0 AS unnamed,
               CASE WHEN p_partkey % 50 = 0 THEN 'uncategorised'
                    WHEN p_type IN ('ECONOMY', 'SMALL', 'STANDARD', 'LARGE') THEN lower(p_type)
                    ELSE p_type END AS category
        FROM part""",
    "per_order_items": """
        SELECT order_id, count(*) AS n, count(DISTINCT seller_id) AS sellers,
               sum(price) AS price, sum(freight) AS freight
        FROM src_items GROUP BY order_id""",
    "per_order_pay": "SELECT order_id, sum(paid) AS paid FROM pay GROUP BY order_id",
    "per_order_rev": "SELECT order_id, avg(score) AS score FROM rev GROUP BY order_id",
    "wide": """
        SELECT od.*, dc.state, i.n, i.sellers, i.price, i.freight, p.paid, r.score
        FROM od LEFT JOIN dc USING (person)
        LEFT JOIN per_order_items i USING (order_id)
        LEFT JOIN per_order_pay p USING (order_id)
        LEFT JOIN per_order_rev r USING (order_id)""",
    "wide_once": """
        SELECT od.*, home.state, i.n, i.sellers, i.price, i.freight, p.paid, r.score
        FROM od LEFT JOIN home USING (person)
        LEFT JOIN per_order_items i USING (order_id)
        LEFT JOIN per_order_pay p USING (order_id)
        LEFT JOIN per_order_rev r USING (order_id)""",
    # ---- customers
    "prof": """
        SELECT person, min(day) AS first_day, max(day) AS last_day,
               count(DISTINCT order_id) AS n, sum(price) AS spent,
               CAST(sum(n) AS BIGINT) AS items
        FROM wide WHERE sale GROUP BY person""",
    "scored": """
        SELECT *, max(last_day) OVER () AS as_of,
               CAST(ntile(5) OVER (ORDER BY last_day ASC NULLS LAST, person) AS INTEGER) AS r,
               CAST(CASE WHEN n >= 5 THEN 4 WHEN n >= 3 THEN 3 ELSE n END AS INTEGER) AS f_tier,
               CAST(ntile(5) OVER (ORDER BY n ASC NULLS LAST, person) AS INTEGER) AS f_tile,
               CAST(ntile(5) OVER (ORDER BY spent ASC NULLS LAST, person) AS INTEGER) AS m
        FROM prof""",
    "labelled": """
        SELECT *,
               CASE WHEN r = 5 AND f_tier > 2 THEN 'Champions'
                    WHEN (r = 5 AND f_tier = 2) OR (r = 4 AND f_tier > 1) THEN 'Loyal Customers'
                    WHEN r = 5 THEN 'New / Promising'
                    WHEN r = 3 AND f_tier > 1 THEN 'Potential Loyalists'
                    WHEN r IN (3, 4) THEN 'Need Attention'
                    WHEN r = 2 AND f_tier > 1 AND CAST(spent AS DOUBLE) >
                         (SELECT CAST(sum(spent) AS DOUBLE) / count(spent) FROM scored)
                    THEN 'At Risk'
                    ELSE 'Hibernating / Lost' END AS segment
        FROM scored""",
    # ---- marts
    "m_kpi": """
        SELECT month AS order_month, count(DISTINCT order_id) AS orders,
               count(DISTINCT person) AS customers,
               CAST(sum(price) AS DOUBLE) AS revenue,
               round(CAST(sum(price) AS DOUBLE) / nullif(count(DISTINCT order_id), 0), 2) AS aov,
               round(CAST(sum(price) AS DOUBLE) / nullif(count(DISTINCT person), 0), 2)
                   AS revenue_per_customer,
               CAST(sum(n) AS BIGINT) AS items_sold,
               round(avg(took), 1) AS avg_delivery_days,
               round(avg(score), 2) AS avg_review_score
        FROM wide WHERE sale GROUP BY month""",
    "m_seg": """
        SELECT segment, count(*) AS customers,
               round(100::DOUBLE * count(*) / (SELECT count(*) FROM labelled), 2)
                   AS pct_customers,
               CAST(sum(spent) AS DOUBLE) AS revenue,
               round(100::DOUBLE * CAST(sum(spent) AS DOUBLE)
                     / (SELECT CAST(sum(spent) AS DOUBLE) FROM labelled), 2) AS pct_revenue,
               round(CAST(sum(spent) AS DOUBLE) / count(spent), 2) AS avg_monetary,
               round(avg(n), 2) AS avg_frequency,
               round(avg(date_diff('day', last_day, as_of)), 0) AS avg_recency_days
        FROM labelled GROUP BY segment""",
    "m_cohort": """
        SELECT b.start AS cohort_month, c.size AS cohort_size,
               CAST(date_diff('month', b.start, a.month) AS INTEGER) AS month_offset,
               count(DISTINCT a.person) AS active_customers,
               round(100::DOUBLE * count(DISTINCT a.person) / c.size, 2) AS retention_pct
        FROM wide a
        JOIN (SELECT person, min(month) AS start FROM wide WHERE sale GROUP BY person) b
          ON a.person = b.person
        JOIN (SELECT start, count(person) AS size
              FROM (SELECT person, min(month) AS start FROM wide WHERE sale GROUP BY person)
              GROUP BY start) c ON c.start = b.start
        WHERE a.sale AND date_diff('month', b.start, a.month) <= 24
        GROUP BY b.start, c.size, date_diff('month', b.start, a.month)""",
    "m_pareto": """
        SELECT row_number() OVER w AS rk, person AS customer_unique_id,
               CAST(spent AS DOUBLE) AS monetary,
               CAST(sum(spent) OVER w AS DOUBLE) AS cumulative_revenue,
               round(100::DOUBLE * (row_number() OVER w) / (count(*) OVER ()), 4)
                   AS pct_customers,
               round(100::DOUBLE * CAST(sum(spent) OVER w AS DOUBLE)
                     / CAST(sum(spent) OVER () AS DOUBLE), 4) AS pct_revenue
        FROM prof
        WINDOW w AS (ORDER BY spent DESC NULLS LAST, person
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "m_category": """
        SELECT *, round(100::DOUBLE * revenue / (SELECT CAST(sum(price) AS DOUBLE)
                                                 FROM cat_rows WHERE kept), 2) AS pct_revenue
        FROM (SELECT category, count(DISTINCT order_id) AS orders, count(*) AS items_sold,
                     CAST(sum(price) AS DOUBLE) AS revenue,
                     CAST(sum(freight) AS DOUBLE) AS freight,
                     round(CAST(sum(price) AS DOUBLE) / count(*), 2) AS avg_unit_price,
                     count(DISTINCT review_id) AS reviews,
                     round(avg(score), 2) AS avg_review_score
              FROM cat_rows WHERE kept GROUP BY category)""",
    "cat_rows": """
        SELECT dp.category, i.order_id, i.price, i.freight, r.review_id, r.score,
               sum(i.price) OVER (PARTITION BY dp.category) > 0 AS kept
        FROM src_items i JOIN od ON od.order_id = i.order_id AND od.sale
        LEFT JOIN dp ON dp.product_id = i.product_id
        LEFT JOIN rev r ON r.order_id = i.order_id""",
    "m_category_once": """
        SELECT dp.category, count(DISTINCT i.order_id) AS orders, count(*) AS items_sold,
               CAST(sum(i.price) AS DOUBLE) AS revenue,
               CAST(sum(i.freight) AS DOUBLE) AS freight,
               round(CAST(sum(i.price) AS DOUBLE) / count(*), 2) AS avg_unit_price,
               round(100::DOUBLE * CAST(sum(i.price) AS DOUBLE)
                     / (SELECT CAST(sum(price) AS DOUBLE) FROM src_items
                        JOIN od USING (order_id) WHERE sale), 2) AS pct_revenue,
               (SELECT count(DISTINCT r.review_id) FROM cat_rows r
                WHERE r.category = dp.category) AS reviews,
               round(avg(q.score), 2) AS avg_review_score
        FROM od JOIN src_items i USING (order_id) JOIN dp USING (product_id)
        LEFT JOIN per_order_rev q USING (order_id)
        WHERE od.sale GROUP BY dp.category""",
    "state_rows": """
        SELECT coalesce(dc.state, 'UNKNOWN') AS state, od.order_id, od.person, od.took,
               i.price, r.score
        FROM src_items i JOIN od ON od.order_id = i.order_id AND od.sale
        LEFT JOIN dc ON dc.person = od.person
        LEFT JOIN rev r ON r.order_id = od.order_id""",
    "state_rows_once": """
        SELECT coalesce(home.state, 'UNKNOWN') AS state, od.order_id, od.person, od.took,
               i.price, r.score
        FROM src_items i JOIN od ON od.order_id = i.order_id AND od.sale
        LEFT JOIN home ON home.person = od.person
        LEFT JOIN per_order_rev r ON r.order_id = od.order_id""",
    "m_sla": """
        SELECT month AS order_month, count(*) AS delivered_orders,
               round(avg(took), 2) AS avg_delivery_days,
               round(median(took), 2) AS median_delivery_days,
               count(*) FILTER (early >= 0) AS on_time_orders,
               round(100::DOUBLE * (count(*) FILTER (early >= 0)) / count(*), 2) AS on_time_pct,
               round(avg(to_ship), 2) AS avg_days_to_ship,
               round(avg(early), 2) AS avg_days_vs_estimate
        FROM od WHERE order_status = 'delivered' AND took >= 0 AND took <= 200
        GROUP BY month""",
    "m_pay": """
        SELECT kind AS payment_type, count(DISTINCT order_id) AS orders,
               CAST(sum(paid) AS DOUBLE) AS value,
               round(100::DOUBLE * CAST(sum(paid) AS DOUBLE)
                     / (SELECT CAST(sum(paid) AS DOUBLE) FROM pay JOIN od USING (order_id)
                        WHERE sale), 2) AS pct_value,
               round(avg(parts), 2) AS avg_installments,
               round(CAST(count(*) FILTER (parts > 1) AS DOUBLE) / count(*), 4)
                   AS pct_multi_installment
        FROM pay JOIN od USING (order_id) WHERE sale GROUP BY kind""",
    "m_repeat": """
        SELECT list_value('1 order', '2 orders', '3 orders', '4+ orders')[least(n, 4)]
                   AS order_bucket,
               count(*) AS customers,
               round(100::DOUBLE * count(*) / (SELECT count(*) FROM prof), 2) AS pct_customers,
               CAST(sum(spent) AS DOUBLE) AS revenue,
               round(100::DOUBLE * CAST(sum(spent) AS DOUBLE)
                     / (SELECT CAST(sum(spent) AS DOUBLE) FROM prof), 2) AS pct_revenue,
               round(CAST(sum(spent) AS DOUBLE) / count(spent), 2) AS avg_monetary
        FROM prof GROUP BY least(n, 4)""",
    "m_delay": """
        SELECT CASE WHEN early < -3 THEN '4+ days late'
                    WHEN early < 0 THEN '1-3 days late'
                    WHEN early < 3 THEN '0-2 days early'
                    WHEN early < 7 THEN '3-6 days early'
                    WHEN early >= 7 THEN '7+ days early'
                    ELSE 'no data' END AS delivery_bucket,
               count(*) AS orders, round(avg(score), 3) AS avg_review_score,
               round(100::DOUBLE * (count(*) FILTER (score <= 2)) / count(*), 2)
                   AS pct_bad_reviews
        FROM wide WHERE order_status = 'delivered' AND score IS NOT NULL GROUP BY 1""",
    # ---- findings
    "win": f"""
        SELECT *, order_month >= {MONTHS_FROM} AND NOT partial AS in_window
        FROM (SELECT *, order_month IN (min(order_month) OVER (), max(order_month) OVER ())
                        AS partial FROM m_kpi)""",
    "mom": """
        SELECT *, CASE WHEN in_window
                       THEN (revenue / nullif(lag(revenue) OVER (PARTITION BY in_window
                                                                 ORDER BY order_month), 0)
                             - 1) * 100 END AS rev_mom_pct
        FROM win""",
    "growth": "SELECT * FROM mom WHERE in_window",
}


def _state_mart(rows: str) -> str:
    return f"""
        SELECT state AS customer_state, count(DISTINCT order_id) AS orders,
               count(DISTINCT person) AS customers, CAST(sum(price) AS DOUBLE) AS revenue,
               round(CAST(sum(price) AS DOUBLE) / count(DISTINCT order_id), 2) AS aov,
               round(100::DOUBLE * CAST(sum(price) AS DOUBLE)
                     / (SELECT CAST(sum(price) AS DOUBLE) FROM {rows}), 2) AS pct_revenue,
               round(avg(took), 1) AS avg_delivery_days, round(avg(score), 2) AS avg_review_score
        FROM {rows} GROUP BY state"""


def _sla_state(homes: str, opinions: str) -> str:
    return f"""
        SELECT coalesce(h.state, 'UNKNOWN') AS customer_state, count(*) AS delivered_orders,
               round(avg(took), 2) AS avg_delivery_days,
               round(100::DOUBLE * (count(*) FILTER (early >= 0)) / count(*), 2) AS on_time_pct,
               round(avg(q.score), 2) AS avg_review_score
        FROM od LEFT JOIN {homes} h USING (person) LEFT JOIN {opinions} q USING (order_id)
        WHERE order_status = 'delivered' AND took BETWEEN 0 AND 200 GROUP BY 1"""


PARTS["m_state"] = _state_mart("state_rows")
PARTS["m_state_once"] = _state_mart("state_rows_once")
PARTS["m_sla_state"] = _sla_state("dc", "rev")
PARTS["m_sla_state_once"] = _sla_state("home", "per_order_rev")

_WIDE_COLUMNS = """
    order_id, person AS customer_unique_id, state AS customer_state, order_status,
    CAST(sale AS INTEGER) AS is_revenue_order, CAST(lost AS INTEGER) AS is_cancelled_order,
    day AS order_date, month AS order_month, CAST(took AS INTEGER) AS days_to_deliver,
    CAST(early AS INTEGER) AS days_vs_estimate, n AS item_count, sellers AS seller_count,
    CAST(price AS DOUBLE) AS order_revenue, CAST(freight AS DOUBLE) AS order_freight,
    coalesce(CAST(paid AS DOUBLE), 0) AS payment_value, score AS avg_review_score"""


def _rfm(f: str, segment: str = "", source: str = "scored") -> str:
    return f"""
        SELECT person AS customer_unique_id, first_day AS first_order_date,
               last_day AS last_order_date, as_of AS as_of_date,
               CAST(date_diff('day', last_day, as_of) AS INTEGER) AS recency_days,
               n AS frequency, CAST(spent AS DOUBLE) AS monetary, items AS items_bought,
               r AS r_score, {f} AS f_score, m AS m_score,
               round(CAST(spent AS DOUBLE) / nullif(n, 0), 2) AS avg_order_value,
               CAST(n > 1 AS INTEGER) AS is_repeat_customer,
               concat(r, {f}, m) AS rfm_cell {segment}
        FROM {source}"""


def _marks(percents: str, count: str) -> str:
    return f"""
        SELECT CAST(t.pct AS INTEGER) AS pct, round(p.pct_revenue, 2) AS pct_revenue
        FROM (SELECT unnest([{percents}]) AS pct) t
        JOIN m_pareto p
          ON p.rk = greatest(1, (SELECT CAST({count} AS BIGINT) FROM prof))"""


def _matrix(last: int) -> str:
    cells = ", ".join(
        f"max(retention_pct) FILTER (month_offset = {o}) AS m{o}" for o in range(last + 1)
    )
    return f"SELECT cohort_month, max(cohort_size) AS cohort_size, {cells} FROM m_cohort"


# Area under Student's density (v degrees) from 0 to t, by Simpson's rule in 2000 steps.
_AREA = """(sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
              * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi())
              * pow(1 + (t * i / 2000) * (t * i / 2000) / v, -(v + 1) / 2)) * max(t) / 6000)"""

MATURE = "HAVING date_diff('day', cohort_month, (SELECT max(cohort_month) FROM m_cohort)) / 30.44 >= 1"

QUERIES: dict[str, str] = {
    # ---- star schema
    "dim_customer": """SELECT person AS customer_unique_id, first_id AS first_customer_id,
        state AS customer_state, zip AS customer_zip_prefix, ids AS customer_id_count FROM dc""",
    "dim_product": """SELECT dp.product_id, dp.category,
        CASE WHEN NOT unnamed THEN p_type END AS category_pt,
        CAST(length(p_name) AS INTEGER) AS product_name_length,
        p_size AS product_description_length, p_size % 6 AS product_photos_qty,
        p_retailprice AS product_weight_g, CAST(p_size AS DOUBLE) AS product_length_cm,
        CAST(1 + p_size % 10 AS DOUBLE) AS product_height_cm,
        CAST(1 + p_partkey % 30 AS DOUBLE) AS product_width_cm,
        CAST(p_size * (1 + p_size % 10) * (1 + p_partkey % 30) AS DOUBLE) AS product_volume_cm3
        FROM dp JOIN part ON p_partkey = dp.product_id""",
    "dim_seller": """SELECT s_suppkey AS seller_id, upper(n_name) AS seller_state,
        s_nationkey AS seller_zip_prefix
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "dim_date": """SELECT CAST(d AS DATE) AS date_day,
        CAST(date_trunc('month', d) AS DATE) AS date_month,
        CAST(date_trunc('quarter', d) AS DATE) AS date_quarter,
        CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        strftime(d, '%b-%y') AS month_label,
        concat(year(d), '-Q', quarter(d)) AS quarter_label,
        CAST(dayofweek(d) AS INTEGER) AS dow, CAST(dayofyear(d) AS INTEGER) AS doy
        FROM (SELECT unnest(range(min(day), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
              FROM ord)""",
    "fact_orders": """SELECT order_id, person AS customer_unique_id, order_status,
        bought AS order_purchase_ts, day AS order_date, month AS order_month,
        approved AS order_approved_ts, shipped AS shipped_ts, delivered AS delivered_ts,
        promised AS estimated_delivery_date, CAST(sale AS INTEGER) AS is_revenue_order,
        CAST(lost AS INTEGER) AS is_cancelled_order,
        date_diff('minute', bought, approved) / 60::DOUBLE AS hours_to_approve,
        CAST(to_ship AS INTEGER) AS days_to_ship, CAST(took AS INTEGER) AS days_to_deliver,
        CAST(early AS INTEGER) AS days_vs_estimate FROM od""",
    "fact_order_items": """SELECT order_id, order_item_id, product_id, seller_id,
        CAST(price AS DOUBLE) AS price, CAST(freight AS DOUBLE) AS freight_value,
        CAST(price AS DOUBLE) + CAST(freight AS DOUBLE) AS revenue,
        ship_limit AS shipping_limit_ts FROM src_items""",
    "fact_payments": """SELECT order_id, seq AS payment_sequential, kind AS payment_type,
        parts AS payment_installments, CAST(paid AS DOUBLE) AS payment_value FROM pay""",
    "fact_reviews": """SELECT review_id, order_id, score AS review_score,
        title AS review_comment_title, CAST(NULL AS VARCHAR) AS review_comment_message,
        made AS review_creation_ts,
        made + to_minutes((order_id * 17) % 7200) AS review_answer_ts,
        date_diff('hour', made, made + to_minutes((order_id * 17) % 7200)) / 24::DOUBLE
            AS days_to_answer_review FROM rev""",
    "fact_order_summary": f"SELECT {_WIDE_COLUMNS} FROM wide",
    "fact_order_summary_order_grain": f"SELECT {_WIDE_COLUMNS} FROM wide_once",
    "mart_rfm_base": _rfm("f_tier"),
    "mart_customer_segment": _rfm("f_tier", ", segment", "labelled"),
    # ---- marts
    "mart_monthly_kpi": "SELECT * FROM m_kpi",
    "mart_rfm": _rfm("f_tile"),
    "mart_rfm_segments": "SELECT * FROM m_seg",
    "mart_cohort": "SELECT * FROM m_cohort",
    "mart_pareto": "SELECT * FROM m_pareto",
    "mart_category": "SELECT * FROM m_category",
    "mart_category_order_grain": "SELECT * FROM m_category_once",
    "mart_state": "SELECT * FROM m_state",
    "mart_state_order_grain": "SELECT * FROM m_state_once",
    "mart_delivery_sla": "SELECT * FROM m_sla",
    "mart_payment": "SELECT * FROM m_pay",
    "mart_repeat": "SELECT * FROM m_repeat",
    "mart_review_delay": "SELECT * FROM m_delay",
    "mart_sla_by_state": "SELECT * FROM m_sla_state",
    "mart_sla_by_state_order_grain": "SELECT * FROM m_sla_state_once",
    # ---- quality and headline
    "dq_checks": """
        SELECT c.name AS "check", CAST(c.n AS DOUBLE) AS value FROM (
            SELECT 'orders_total' AS name, (SELECT CAST(count(*) AS DOUBLE) FROM ord) AS n
            UNION ALL SELECT 'orders_null_customer_key',
                (SELECT count(*) FROM ord WHERE person IS NULL)
            UNION ALL SELECT 'orders_duplicate_order_id',
                (SELECT count(*) - count(DISTINCT order_id) FROM ord)
            UNION ALL SELECT 'items_orphan_order_id',
                (SELECT count(*) FROM src_items WHERE order_id NOT IN (SELECT order_id FROM ord))
            UNION ALL SELECT 'payments_orphan_order_id',
                (SELECT count(*) FROM pay WHERE order_id NOT IN (SELECT order_id FROM ord))
            UNION ALL SELECT 'items_missing_product_id',
                (SELECT count(*) FROM src_items WHERE product_id IS NULL)
            UNION ALL SELECT 'items_negative_price',
                (SELECT count(*) FROM src_items WHERE price IS NULL OR price < 0)
            UNION ALL SELECT 'items_null_freight',
                (SELECT count(*) FROM src_items WHERE freight IS NULL)
            UNION ALL SELECT 'products_null_category',
                (SELECT count(*) FROM dp WHERE category = 'uncategorised')
            UNION ALL SELECT 'customers_unique_ids', (SELECT count(*) FROM dc)
            UNION ALL SELECT 'customers_with_multiple_order_ids',
                (SELECT count(*) FROM dc WHERE ids > 1)
            UNION ALL SELECT 'orders_missing_delivered_ts',
                (SELECT count(*) FROM ord WHERE order_status = 'delivered' AND delivered IS NULL)
            UNION ALL SELECT 'delivered_after_estimate',
                (SELECT count(*) FROM od WHERE early < 0)
            UNION ALL SELECT 'revenue_item_based',
                (SELECT CAST(sum(price) AS DOUBLE) FROM wide WHERE sale)
            UNION ALL SELECT 'revenue_payments_based',
                (SELECT CAST(sum(paid) AS DOUBLE) FROM pay JOIN ord USING (order_id) WHERE sale)
            UNION ALL SELECT 'revenue_reconciliation_gap_pct',
                (SELECT round(100::DOUBLE * (b.v - a.v) / a.v, 2)
                 FROM (SELECT CAST(sum(price) AS DOUBLE) AS v FROM wide WHERE sale) a,
                      (SELECT CAST(sum(paid) AS DOUBLE) AS v
                       FROM pay JOIN ord USING (order_id) WHERE sale) b)) c""",
    "headline_metrics": f"""
        SELECT CAST(sum(price) FILTER (sale) AS DOUBLE) AS revenue_brl,
               count(*) FILTER (sale) AS orders,
               count(DISTINCT person) FILTER (sale) AS unique_customers,
               round(CAST(sum(price) FILTER (sale) AS DOUBLE) / (count(*) FILTER (sale)), 2)
                   AS aov_brl,
               (SELECT round(100::DOUBLE * (count(*) FILTER (n > 1)) / count(*), 2) FROM prof)
                   AS repeat_customer_pct,
               round(100::DOUBLE * (SELECT CAST(sum(spent) AS DOUBLE) FROM
                    (SELECT spent FROM prof ORDER BY spent DESC NULLS LAST LIMIT {TOP_CUSTOMERS}))
                    / CAST(sum(price) FILTER (sale) AS DOUBLE), 2)
                   AS top8pct_customers_share_of_revenue,
               CAST(min(day) FILTER (sale) AS VARCHAR) AS period_start,
               CAST(max(day) FILTER (sale) AS VARCHAR) AS period_end,
               round(100::DOUBLE * (count(*) FILTER (lost)) / count(*), 2)
                   AS cancellation_rate_pct,
               (SELECT round(avg(took), 2) FROM od
                WHERE order_status = 'delivered' AND took BETWEEN 0 AND 200)
                   AS avg_delivery_days,
               (SELECT round(avg(score), 2) FROM rev) AS avg_review_score
        FROM wide""",
    # ---- findings
    "analysis_window": "SELECT * FROM win",
    "month_on_month": "SELECT * FROM mom",
    "trend_summary": """
        SELECT CAST(min(order_month) AS VARCHAR) AS window_start,
               CAST(max(order_month) AS VARCHAR) AS window_end, count(*) AS months_in_window,
               (SELECT CAST(order_month AS VARCHAR) FROM growth ORDER BY revenue DESC, order_month
                LIMIT 1) AS peak_month,
               round(max(revenue), 2) AS peak_revenue_brl,
               round(arg_min(revenue, order_month), 2) AS first_month_revenue_brl,
               round(arg_max(revenue, order_month), 2) AS last_month_revenue_brl,
               round((arg_max(revenue, order_month) / arg_min(revenue, order_month) - 1) * 100, 1)
                   AS window_growth_pct,
               round((pow(arg_max(revenue, order_month) / arg_min(revenue, order_month),
                          12::DOUBLE / greatest(count(*) - 1, 1)) - 1) * 100, 1)
                   AS annualised_growth_pct,
               round(max(rev_mom_pct), 1) AS best_mom_pct,
               (SELECT CAST(order_month AS VARCHAR) FROM growth
                ORDER BY rev_mom_pct DESC NULLS LAST, order_month LIMIT 1) AS best_mom_month,
               round(min(rev_mom_pct), 1) AS worst_mom_pct,
               (SELECT CAST(order_month AS VARCHAR) FROM growth
                ORDER BY rev_mom_pct NULLS LAST, order_month LIMIT 1) AS worst_mom_month
        FROM growth""",
    "cohort_matrix": f"{_matrix(12)} GROUP BY cohort_month {MATURE}",
    "cohort_matrix_all": f"{_matrix(24)} GROUP BY cohort_month",
    "cohort_summary": f"""
        SELECT round(median(retention_pct) FILTER (month_offset = 1 AND cohort_size > {MIN_COHORT}), 2)
                   AS median_m1_retention_pct,
               round(max(retention_pct) FILTER (month_offset = 1 AND cohort_size > {MIN_COHORT}), 2)
                   AS best_m1_retention_pct,
               round(min(retention_pct) FILTER (month_offset = 1 AND cohort_size > {MIN_COHORT}), 2)
                   AS worst_m1_retention_pct,
               max(month_offset) AS max_observed_offset
        FROM m_cohort""",
    "segment_summary": """
        SELECT t.segment AS top_segment, t.customers AS top_segment_customers,
               t.pct_customers AS top_segment_pct_customers,
               t.pct_revenue AS top_segment_pct_revenue,
               (SELECT CAST(coalesce(sum(customers), 0) AS BIGINT) FROM m_seg
                WHERE segment = 'At Risk') AS at_risk_customers,
               (SELECT coalesce(sum(revenue), 0) FROM m_seg WHERE segment = 'At Risk')
                   AS at_risk_revenue_brl,
               (SELECT coalesce(sum(revenue), 0) FROM m_seg WHERE segment = 'Cant Lose Them')
                   AS cant_lose_revenue_brl
        FROM m_seg t ORDER BY t.revenue DESC LIMIT 1""",
    "pareto_marks": _marks("1, 5, 10, 20, 30, 50", "round_even(count(*) * t.pct / 100::DOUBLE, 0)"),
    "pareto_marks_truncated": _marks("1, 5, 10, 20, 50", "trunc(count(*) * t.pct / 100::DOUBLE)"),
    "repeat_summary": """
        SELECT pct_customers AS one_time_customer_pct,
               round(100 - pct_customers, 2) AS repeat_customer_pct
        FROM m_repeat WHERE order_bucket = '1 order'""",
    "category_summary": """
        SELECT arg_max(category, revenue) AS top_category,
               arg_max(pct_revenue, revenue) AS top_category_pct_revenue,
               round((SELECT sum(pct_revenue) FROM
                      (SELECT pct_revenue FROM m_category ORDER BY revenue DESC LIMIT 3)), 2)
                   AS top3_pct_revenue,
               count(*) AS categories_total
        FROM m_category""",
    "state_summary": """
        SELECT arg_max(customer_state, revenue) AS top_state,
               round((SELECT sum(pct_revenue) FROM
                      (SELECT pct_revenue FROM m_state ORDER BY revenue DESC LIMIT 3)), 2)
                   AS top3_states_pct_revenue,
               (SELECT customer_state FROM m_state
                ORDER BY avg_delivery_days DESC NULLS LAST, customer_state LIMIT 1)
                   AS slowest_state,
               max(avg_delivery_days) AS slowest_state_days
        FROM m_state""",
    "delivery_review_correlation": """
        SELECT round(corr(avg_delivery_days, avg_review_score), 6) AS r,
               count(*) FILTER (avg_delivery_days IS NOT NULL AND avg_review_score IS NOT NULL)
                   AS n
        FROM m_state""",
    "delivery_review_test": f"""
        SELECT round(max(r), 3) AS delivery_vs_review_r,
               round(1 - 2 * {_AREA}, 4) AS delivery_vs_review_p
        FROM (SELECT r, n - 2 AS v, abs(r) * sqrt((n - 2) / (1 - r * r)) AS t
              FROM (SELECT corr(avg_delivery_days, avg_review_score) AS r,
                           CAST(count(*) AS DOUBLE) AS n FROM m_state))
        CROSS JOIN range(0, 2001) AS steps(i)""",
    "payment_summary": """
        SELECT pct_value AS card_pct_value, avg_installments AS card_avg_installments
        FROM m_pay WHERE payment_type = 'credit_card'""",
    "late_review_welch": """
        SELECT n1 AS late_orders, round(100::DOUBLE * n1 / (n1 + n2), 2) AS late_pct_of_delivered,
               round(m1, 3) AS late_avg_review, round(m2, 3) AS ontime_avg_review,
               round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 2) AS welch_t
        FROM (SELECT count(*) FILTER (early < 0) AS n1, count(*) FILTER (early >= 0) AS n2,
                     avg(score) FILTER (early < 0) AS m1, avg(score) FILTER (early >= 0) AS m2,
                     var_samp(score) FILTER (early < 0) AS v1,
                     var_samp(score) FILTER (early >= 0) AS v2
              FROM wide WHERE score IS NOT NULL)""",
    "late_review_test": f"""
        SELECT max(n1) AS late_orders,
               round(100::DOUBLE * max(n1) / max(n1 + n2), 2) AS late_pct_of_delivered,
               round(max(m1), 3) AS late_avg_review, round(max(m2), 3) AS ontime_avg_review,
               round(max(signed), 2) AS welch_t,
               CAST(format('{{:.3e}}', 1 - 2 * {_AREA}) AS DOUBLE) AS welch_p
        FROM (SELECT *, abs(signed) AS t,
                     (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)) AS v
              FROM (SELECT *, v1 / n1 AS a, v2 / n2 AS b,
                           (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS signed
                    FROM (SELECT count(*) FILTER (early < 0) AS n1,
                                 count(*) FILTER (early >= 0) AS n2,
                                 avg(score) FILTER (early < 0) AS m1,
                                 avg(score) FILTER (early >= 0) AS m2,
                                 var_samp(score) FILTER (early < 0) AS v1,
                                 var_samp(score) FILTER (early >= 0) AS v2
                          FROM wide WHERE score IS NOT NULL)))
        CROSS JOIN range(0, 2001) AS steps(i)""",
    "sla_summary": f"""
        SELECT round(avg(on_time_pct), 2) AS avg_on_time_pct,
               (SELECT pct_bad_reviews FROM m_delay WHERE delivery_bucket = '0-2 days early')
                   AS bad_review_rate_ontime_pct,
               (SELECT pct_bad_reviews FROM m_delay WHERE delivery_bucket = '4+ days late')
                   AS bad_review_rate_late_pct,
               round(avg(avg_delivery_days), 2) AS avg_delivery_days
        FROM m_sla WHERE order_month >= {MONTHS_FROM}""",
    # ---- chart and dashboard data
    "data_monthly_trend": """SELECT order_month, revenue / 1000 AS revenue_thousands, orders, aov,
        rev_mom_pct, partial, in_window FROM mom""",
    "data_cohort_heatmap": f"""SELECT *, strftime(cohort_month, '%b-%y') AS cohort_label
        FROM ({_matrix(12)} GROUP BY cohort_month {MATURE})""",
    "data_segments_ordered": "SELECT * FROM m_seg",
    "data_frequency_scatter": "SELECT n AS frequency, CAST(spent AS DOUBLE) AS monetary FROM prof",
    "data_pareto_curve": "SELECT pct_customers, pct_revenue FROM m_pareto",
    "data_repeat_bars": "SELECT order_bucket, pct_customers, pct_revenue FROM m_repeat",
    "data_top_categories": """SELECT category, revenue, pct_revenue, avg_review_score
        FROM m_category ORDER BY revenue DESC, category LIMIT 5""",
    "data_top_states": """SELECT customer_state, revenue, avg_delivery_days
        FROM m_state ORDER BY revenue DESC, customer_state LIMIT 10""",
    "data_payment_pie": """SELECT payment_type, value, pct_value,
        pct_multi_installment * 100 AS pct_multi_installment FROM m_pay""",
    "data_on_time_line": f"""SELECT order_month, on_time_pct FROM m_sla
        WHERE order_month >= {MONTHS_FROM}""",
    "data_delay_bars": """SELECT delivery_bucket, avg_review_score, pct_bad_reviews FROM m_delay
        WHERE delivery_bucket <> 'no data'""",
    "data_kpi_cards": """
        SELECT round(sum(revenue), 2) AS revenue, CAST(sum(orders) AS BIGINT) AS orders,
               (SELECT count(*) FROM prof) AS customers,
               round(sum(revenue) / sum(orders), 2) AS aov,
               (SELECT round(100::DOUBLE * avg(CAST(n > 1 AS INTEGER)), 2) FROM prof)
                   AS repeat_pct,
               (SELECT round(avg(on_time_pct), 2) FROM m_sla) AS on_time_pct
        FROM m_kpi""",
    "data_kpi_table": "SELECT * FROM m_kpi ORDER BY order_month DESC",
    "data_segment_bars": "SELECT * FROM m_seg ORDER BY revenue",
    "data_customer_search": f"""SELECT * FROM ({_rfm("f_tile")})
        WHERE regexp_matches(CAST(customer_unique_id AS VARCHAR), '(?i){SEARCH}')
        ORDER BY customer_unique_id LIMIT 20""",
    "data_pareto_sample": f"""SELECT rk, pct_customers, pct_revenue FROM m_pareto
        ORDER BY md5(concat('7:', customer_unique_id)) LIMIT {SAMPLE}""",
    "data_window_summary": """
        SELECT round(sum(revenue), 2) AS window_revenue,
               round((arg_max(revenue, order_month) / arg_min(revenue, order_month) - 1) * 100, 0)
                   AS growth_pct,
               strftime(arg_max(order_month, revenue), '%b-%Y') AS peak_month,
               max(revenue) AS peak_revenue
        FROM growth""",
    "data_state_table": "SELECT * FROM m_state ORDER BY revenue DESC",
    # ---- stored tables and files
    "mart_monthly_kpi_stored": "SELECT * FROM m_kpi",
    "mart_category_raw_stored": "SELECT * FROM m_category",
    "mart_monthly_kpi_by_order": "SELECT * FROM m_kpi",
    "data_segment_table": "SELECT * FROM m_seg ORDER BY revenue DESC",
}
# Tables that are built from all eight raw files as CSV.
FROM_CSV = [
    "dim_customer", "dim_product", "dim_seller", "fact_orders", "fact_order_items",
    "fact_payments", "fact_reviews", "fact_order_summary",
]
MARTS = [
    "mart_monthly_kpi", "mart_rfm", "mart_rfm_segments", "mart_cohort", "mart_pareto",
    "mart_category", "mart_state", "mart_delivery_sla", "mart_payment", "mart_repeat",
    "mart_review_delay", "mart_sla_by_state", "mart_customer_segment", "dim_date",
    "fact_order_summary",
]
QUERIES |= {f"{table}_from_csv": QUERIES[table] for table in FROM_CSV}
QUERIES |= {f"{mart}_csv_round_trip": QUERIES[mart] for mart in MARTS}
QUERIES["dq_checks_json_round_trip"] = QUERIES["dq_checks"]
HEADLINE_NUMBERS = [
    "revenue_brl", "orders", "unique_customers", "aov_brl", "repeat_customer_pct",
    "top8pct_customers_share_of_revenue", "cancellation_rate_pct", "avg_delivery_days",
    "avg_review_score",
]
QUERIES["headline_json_round_trip"] = (
    f"SELECT unnest({HEADLINE_NUMBERS}) AS \"check\", "
    f"unnest([{', '.join(f'CAST({n} AS DOUBLE)' for n in HEADLINE_NUMBERS)}]) AS value "
    f"FROM ({QUERIES['headline_metrics']})"
)
QUERIES["headline_period_json_round_trip"] = (
    f"SELECT period_start, period_end FROM ({QUERIES['headline_metrics']})"
)
_SEGMENT_COLUMNS = [
    "segment", "customers", "pct_customers", "revenue", "pct_revenue", "avg_monetary",
    "avg_frequency", "avg_recency_days",
]
QUERIES["segment_table"] = "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in _SEGMENT_COLUMNS
) + " FROM m_seg"

# The numbers of the findings document: section -> (query, its numeric columns).
_NUMBERS = [
    ("trend", "trend_summary", [
        "months_in_window", "peak_revenue_brl", "first_month_revenue_brl",
        "last_month_revenue_brl", "window_growth_pct", "annualised_growth_pct",
        "best_mom_pct", "worst_mom_pct"]),
    ("cohort", "cohort_summary", [
        "median_m1_retention_pct", "best_m1_retention_pct", "worst_m1_retention_pct",
        "max_observed_offset"]),
    ("rfm", "segment_summary", [
        "top_segment_customers", "top_segment_pct_customers", "top_segment_pct_revenue",
        "at_risk_customers", "at_risk_revenue_brl", "cant_lose_revenue_brl"]),
    ("pareto", "repeat_summary", ["one_time_customer_pct", "repeat_customer_pct"]),
    ("category", "category_summary", [
        "top_category_pct_revenue", "top3_pct_revenue", "categories_total"]),
    ("state", "state_summary", ["top3_states_pct_revenue", "slowest_state_days"]),
    ("state", "delivery_review_test", ["delivery_vs_review_r", "delivery_vs_review_p"]),
    ("payment", "payment_summary", ["card_pct_value", "card_avg_installments"]),
    ("sla", "sla_summary", [
        "avg_on_time_pct", "bad_review_rate_ontime_pct", "bad_review_rate_late_pct",
        "avg_delivery_days"]),
    ("sla", "late_review_test", [
        "late_orders", "late_pct_of_delivered", "late_avg_review", "ontime_avg_review",
        "welch_t", "welch_p"]),
]
QUERIES["findings_numbers"] = " UNION ALL ".join(
    f"SELECT '{section}' AS section, unnest({names}) AS metric, "
    f"unnest([{', '.join(f'CAST({n} AS DOUBLE)' for n in names)}]) AS value "
    f"FROM ({QUERIES[query]})"
    for section, query, names in _NUMBERS
) + f"""
    UNION ALL SELECT 'pareto', concat('concentration_', pct), pct_revenue
    FROM ({QUERIES["pareto_marks"]})"""

# Text fields of the findings document.
_TEXTS = [
    ("trend", "trend_summary", [
        "window_start", "window_end", "peak_month", "best_mom_month", "worst_mom_month"]),
    ("rfm", "segment_summary", ["top_segment"]),
    ("category", "category_summary", ["top_category"]),
    ("state", "state_summary", ["top_state", "slowest_state"]),
]
QUERIES["findings_document"] = " UNION ALL ".join(
    f"SELECT '{section}' AS section, unnest({names}) AS field, "
    f"unnest([{', '.join(f'CAST({n} AS VARCHAR)' for n in names)}]) AS text "
    f"FROM ({QUERIES[query]})"
    for section, query, names in _NUMBERS + _TEXTS
) + f"""
    UNION ALL SELECT 'pareto', concat('concentration_', pct), CAST(pct_revenue AS VARCHAR)
    FROM ({QUERIES["pareto_marks"]})
    UNION ALL SELECT 'rfm', concat('segments_table: ', segment, ': ', c.name), c.text
    FROM (SELECT segment, unnest([{", ".join(
        f"{{'name': '{c}', 'text': CAST({c} AS VARCHAR)}}" for c in _SEGMENT_COLUMNS
    )}]) AS c FROM m_seg)"""

QUERIES["findings_json_round_trip"] = QUERIES["findings_document"]

# What is stored of the spoilt CSV files, see the query.
_UNREADABLE = """CASE WHEN order_id % 7 = 0 THEN 'order_purchase_timestamp'
                      WHEN order_id % 11 = 0 THEN 'order_estimated_delivery_date'
                      ELSE 'usable' END"""
QUERIES["raw_csv_rejects"] = f"""
    SELECT 'orders' AS "table", {_UNREADABLE} AS reason, count(*) AS rows
    FROM src_orders GROUP BY ALL
    UNION ALL SELECT 'category_translation', 'usable', 5
""" + "".join(
    f"UNION ALL SELECT '{table}', 'usable', count(*) FROM {part}\n"
    for table, part in [
        ("items", "src_items"), ("payments", "pay"), ("reviews", "rev"),
        ("customers", "src_people"), ("products", "part"), ("sellers", "supplier"),
    ]
)


def _needs(text: str) -> set[str]:
    return {name for name in PARTS if re.search(rf"\b{name}\b", text)}


def statement(body: str) -> str:
    """`body` with the building blocks it needs, in dependency order."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in sorted(_needs(PARTS[name]) - {name}):
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in sorted(_needs(body)):
        add(name)
    if not wanted:
        return body
    blocks = ",\n".join(f"{name} AS ({PARTS[name]})" for name in wanted)
    return f"WITH {blocks}\n{body}"


def all_statements() -> dict[str, str]:
    return {name: statement(body) for name, body in QUERIES.items()}
