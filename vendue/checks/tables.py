"""The views of ``vendue.views`` as SQL, and a helper that prefixes a query with those it uses."""

from __future__ import annotations

import re

ORDERS_AS_OF = "DATE '2001-08-02'"
EVENTS_AS_OF = "DATE '2024-01-31'"

VIEWS: dict[str, str] = {
    "v_item": f"""
        SELECT p_partkey AS item_id, p_brand AS brand_id, p_type AS category_id,
               CASE WHEN p_size <= 40 THEN 20 ELSE 10 END AS sell_status,
               CASE p_partkey % 4 WHEN 1 THEN 20 WHEN 2 THEN 30 ELSE 10 END AS sell_type,
               CASE p_partkey % 8 WHEN 2 THEN 70 WHEN 6 THEN 80 ELSE 10 END AS sell_type_detail,
               {ORDERS_AS_OF} - CAST(p_partkey % 120 AS INTEGER) AS shown_from,
               {ORDERS_AS_OF} - CAST(p_partkey % 120 AS INTEGER) AS registered,
               CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS new_flag,
               CAST(p_partkey % 7 AS VARCHAR) AS origin_id,
               CASE WHEN p_partkey % 10 = 0 THEN 'N' ELSE 'Y' END AS searchable
        FROM part""",
    "v_category": """
        SELECT DISTINCT p_type AS category_id,
               upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS category_name,
               'ALL' AS large_id,
               CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'SMALL') THEN 'VALUE' ELSE 'MAIN' END AS medium_id,
               substr(p_type, 1, 1) AS small_id,
               CASE WHEN p_type = 'LARGE' THEN 'N' ELSE 'Y' END AS in_use
        FROM part""",
    "v_brand": """
        SELECT DISTINCT p_brand AS brand_id, upper(p_brand) AS brand_name,
               CASE WHEN p_brand = 'Brand#7' THEN 'N' ELSE 'Y' END AS in_use
        FROM part""",
    "v_site": """
        SELECT s_suppkey, CAST(n_regionkey AS VARCHAR) AS site_no
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "v_price": """
        SELECT l_partkey AS item_id, site_no, l_suppkey AS store_no,
               CAST(max(floor(l_extendedprice / l_quantity)) AS BIGINT) AS sell_price,
               CAST(min(floor(l_extendedprice / l_quantity)) AS BIGINT) AS low_price
        FROM lineitem JOIN v_site ON l_suppkey = s_suppkey
        GROUP BY l_partkey, site_no, l_suppkey""",
    "v_member": """
        SELECT c_custkey AS member_id,
               CASE c_custkey % 3 WHEN 0 THEN '10' WHEN 1 THEN '20' ELSE '' END AS gender,
               CASE c_nationkey % 5 WHEN 0 THEN '20' WHEN 1 THEN '30' WHEN 2 THEN '40' WHEN 3 THEN '50' ELSE '' END AS age_band
        FROM customer
        UNION ALL
        SELECT c_custkey, '',
               CASE c_nationkey % 5 WHEN 0 THEN '20' WHEN 1 THEN '30' WHEN 2 THEN '40' WHEN 3 THEN '50' ELSE '' END
        FROM customer WHERE c_custkey % 7 = 0""",
    "v_event_item": "SELECT p_partkey AS item_id FROM part WHERE p_partkey % 17 = 0",
    "v_order_line": """
        SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS item_id, site_no,
               o_custkey AS member_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(l_quantity AS BIGINT) AS qty,
               CAST(floor(l_extendedprice) AS BIGINT) AS amount,
               CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS own_discount,
               CAST(0 AS BIGINT) AS partner_discount,
               CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS unit_price,
               CASE WHEN l_returnflag = 'R' THEN '2' ELSE '1' END AS target_code,
               CASE WHEN l_linenumber % 2 = 1 THEN '011' ELSE '021' END AS line_kind,
               o_orderpriority AS priority
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN v_site ON l_suppkey = s_suppkey""",
    "v_offline_sale": """
        SELECT CAST(l_shipdate AS DATE) AS sale_date, 'S' || CAST(l_partkey AS VARCHAR) AS offline_item_id
        FROM lineitem WHERE l_returnflag = 'R'""",
    "v_offline_map": """
        SELECT 'S' || CAST(p_partkey AS VARCHAR) AS offline_item_id,
               CASE WHEN p_partkey % 3 = 0 THEN '20' ELSE '10' END AS business_code, p_partkey AS item_id
        FROM part""",
    "v_event": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
        FROM events""",
    "v_click": """
        SELECT event_id, ts, CAST(ts AS DATE) AS visit_date, k AS item_id, CAST(k % 5 AS VARCHAR) AS site_no,
               'ip' || CAST(user_id % 40 AS VARCHAR) AS ip, CAST(user_id AS VARCHAR) AS visitor_id,
               CASE WHEN user_id % 5 <> 0 THEN user_id END AS member_id,
               CASE user_id % 3 WHEN 0 THEN '10' WHEN 1 THEN '20' ELSE '' END AS gender,
               CASE user_id % 4 WHEN 0 THEN '20' WHEN 1 THEN '30' WHEN 2 THEN '40' ELSE '50' END AS age_band
        FROM v_event WHERE event_type IN ('view', 'click')""",
    "v_cart": """
        SELECT event_id, ts, CAST(ts AS DATE) AS visit_date, k AS item_id, CAST(k % 5 AS VARCHAR) AS site_no,
               CAST(user_id AS VARCHAR) AS visitor_id, user_id AS member_id
        FROM v_event WHERE event_type = 'purchase'""",
    "v_page_row": """
        SELECT CAST(ts AS DATE) AS day,
               CASE user_id % 3 WHEN 0 THEN 'PC' WHEN 1 THEN 'MW' ELSE 'MA' END AS device,
               (event_type = 'view' OR k % 2 = 0) AS item_page,
               user_id % 2 = 0 AS from_search,
               k AS item_id,
               user_id % 3 = 2 AND k % 4 = 0 AS native_item
        FROM v_event WHERE event_type IN ('view', 'click')""",
    "v_reaction_row": """
        SELECT CAST(ts AS DATE) AS day, k AS item_id, k % 2 = 0 AS from_search
        FROM v_event WHERE event_type = 'signup'""",
    "v_attribution_row": """
        SELECT CAST(ts AS DATE) AS day, k AS item_id, k % 3 = 0 OR (user_id % 3 = 2 AND k % 5 = 0) AS from_search
        FROM v_event WHERE event_type = 'purchase'""",
    "v_review": """
        SELECT k AS item_id, count(*) AS review_count FROM v_event WHERE event_type = 'signup' GROUP BY k""",
    "v_ad_row": """
        SELECT event_id, ts, CAST(k % 5 AS VARCHAR) AS site_no,
               CASE WHEN user_id % 2 = 0 THEN 'pc' ELSE 'app' END AS media_code,
               CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'click' ELSE 'etc' END AS type,
               CASE WHEN event_type = 'purchase' THEN 'buy' WHEN event_type = 'signup' THEN 'tap_cart'
                    WHEN event_type = 'view' THEN 'view' WHEN k % 4 = 0 THEN 'quick' ELSE 'share' END AS position,
               CASE WHEN k % 3 = 0 THEN 'obanjang' ELSE 'main' END AS global_id,
               CAST(k % 2 AS VARCHAR) AS area_id,
               CASE k % 3 WHEN 0 THEN '10' WHEN 1 THEN '20' ELSE '' END AS unit_code,
               CAST(k % 10 AS VARCHAR) AS account_id, CAST(k % 20 AS VARCHAR) AS bid_id,
               CAST(k AS VARCHAR) AS target_id, '10' AS extension_code
        FROM v_event""",
    "v_interaction": """
        SELECT user_id, k AS item_id, ts FROM v_event WHERE event_type = 'view'""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with a WITH clause of the views it names, and of those they name."""
    pool = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str, inside: str = "") -> None:
        for name in pool:
            if re.search(rf"\b{name}\b", text) and name not in needed and name != inside:
                visit(pool[name], name)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({pool[n]})" for n in needed) + "\n" + body
