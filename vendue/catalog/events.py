"""Event-chain queries over the test tables, with the same queries in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendue.checks.tables import with_views
from vendue.functions.pages import click_area, page_code
from vendue.operators.attribution import attribute_last_touch, orders_with_attribution
from vendue.operators.ranking import carry_once, drop_reloads, latest_per_key
from vendue.plans import events as ev
from vendue.views import Shop

# inputs built from the tables --------------------------------------------------


def cart_payloads(shop: Shop):
    """Purchases as cart events: one or two lines in a JSON array, some with inflow lists."""
    k, n = F.col("k"), F.col("event_id")
    flow = F.struct(k.cast("string").alias("ordItemInfloTgtId"),
                    F.when(k % 4 == 0, "03").otherwise("01").alias("ordItemInfloDivCd"))
    line = F.struct(
        n.cast("string").alias("cartId"), F.concat(F.lit("m"), n).alias("masterCartId"), F.lit("0").alias("uitemId"),
        (k % 5).cast("string").alias("cartItemSiteNo"), k.cast("string").alias("itemId"),
        (k % 3 + 1).cast("double").alias("ordQty"),
        F.when(k % 2 == 0, F.array(flow)).alias("ordItemInfloExtApiDtoList"),
    )
    lines = F.when(n % 2 == 0, F.array(line, line)).otherwise(F.array(line))
    text = F.when(k % 10 == 9, "not json").otherwise(F.to_json(lines))
    return shop.events().where(F.col("event_type") == "purchase").select(
        "event_id", "ts", F.col("user_id").cast("string").alias("visitor_id"),
        F.when(k % 3 == 0, "").otherwise("/ref").alias("referrer"), text.alias("payload"),
    )


def order_payloads(shop: Shop):
    """Orders as order events with their lines in a JSON object."""
    line = F.struct(
        F.col("line_no").cast("double").alias("ordItemSeq"),
        F.col("unit_price").cast("double").alias("unitPrice"),
        F.col("qty").cast("double").alias("ordQty"),
        F.col("site_no").alias("cartItemSiteNo"),
        F.col("order_no").cast("string").alias("masterCartId"),
        F.col("order_no").cast("string").alias("cartId"),
        F.lit("0").alias("uitemId"),
        F.col("item_id").cast("string").alias("itemId"),
        F.col("site_no").alias("infloSiteNo"),
        F.when(F.col("item_id") % 3 == 0, "30").otherwise("10").alias("ordItemRepTypeCd"),
        F.when(F.col("item_id") % 6 == 0, "12").otherwise("10").alias("ordItemTypeCd"),
        (F.col("item_id") % 10).cast("string").alias("itemChrctDtlCd"),
    )
    orders = shop.order_lines().groupBy("order_no", "member_id").agg(F.collect_list(line).alias("lines"))
    member = F.col("member_id").cast("string")
    base = F.struct(
        F.lit("w").alias("ckWhere"), member.alias("mbrId"), member.alias("pcid"), member.alias("dmId"),
        member.alias("sessionId"), F.lit("ip").alias("ip"), F.lit("b").alias("browser"), F.lit("10").alias("tgtMediaCd"),
        F.lit(1704067200000.0).alias("timestamp"),
    )
    body = F.struct(F.col("order_no").cast("string").alias("ordNo"), F.lit("d").alias("ordCmplDts"),
                    base.alias("baseProperties"), F.col("lines").alias("subOrderItemList"))
    return orders.select(F.to_json(body).alias("payload"))


def ad_payloads(shop: Shop):
    """Events as ad events with an upper-case JSON payload of two units."""
    k = F.col("k")

    def unit(code):
        return F.struct(
            k.cast("string").alias("ADTGTID"), F.lit("1").alias("adIdx"), F.lit("ACC").alias("advertAcctId"),
            F.lit("BID").alias("advertBidId"), F.lit("item").alias("unitType"), code.alias("advertExtensTeryDivCd"),
        )

    body = F.struct(
        F.col("event_type").alias("type"), F.lit("VIEW").alias("position"), (k % 5).cast("string").alias("siteNo"),
        F.lit("MAIN").alias("globalId"), F.lit("A").alias("areaId"), F.lit("PC").alias("mediaCd"),
        F.array(unit(F.lit("")), unit(F.lit("20"))).alias("unitInfoList"),
    )
    return shop.events().select(
        "event_id", "ts", F.when(k % 7 == 0, "").otherwise(F.to_json(body)).alias("payload")
    )


def contribution_orders(shop: Shop):
    padded = F.lpad(F.col("item_id").cast("string"), 10, "0")
    target = (
        F.when(F.col("item_id") % 3 == 0, "")
        .when(F.col("item_id") % 2 == 0, F.concat(F.lit("20"), padded))
        .otherwise(padded)
    )
    priority = F.substring("priority", 1, 1)
    return shop.order_lines().select(
        "order_no", "line_no", "qty", "unit_price", target.alias("inflow_target"),
        F.col("order_no").alias("cart_id"), F.to_timestamp("order_date").alias("order_ts"),
        F.to_timestamp("order_date").alias("cart_ts"),
        F.when(priority == "1", "10").otherwise("20").alias("os_code"),
        F.when(priority == "2", "SSGAPP/1").otherwise("web").alias("user_agent"),
    )


def ad_chain(shop: Shop):
    """Visits to carts to orders to ad revenue, with the device of the page an order came from."""
    kind = F.col("visit_id") % 3
    visits = shop.page_visits().withColumns({
        "os_code": F.when(kind == 0, "10").otherwise("20"), "user_agent": F.when(kind == 1, "SSGAPP/1").otherwise("web")})
    carts = attribute_last_touch(shop.cart_lines(), visits, carry=["os_code", "user_agent"])
    pages = carts.select("site_no", "item_id", "cart_id", F.col("ts").alias("cart_ts"), "visit_id", "os_code", "user_agent")
    bought, k = shop.events().where(F.col("event_type") == "purchase"), F.col("k")
    orders = bought.select(
        F.col("event_id").alias("order_no"), k.alias("item_id"), (F.col("event_id") % 3).cast("string").alias("cart_id"),
        F.col("ts").alias("order_ts"), F.lit(2).alias("qty"), (k + 1).alias("unit_price"),
        F.when(k % 3 != 0, F.concat(F.when(k % 2 == 0, "20").otherwise(""), F.lpad(k.cast("string"), 10, "0"))).alias("inflow_target"),
    )
    attributed = orders_with_attribution(orders, pages, ["item_id", "cart_id"], not_after="order_ts")
    return ev.ad_contribution(attributed).withColumn("sales_amount", F.col("sales_amount").cast("bigint"))


def attribution_of_carts(shop: Shop):
    """Purchases as attribution rows, keyed by item and a third of the event ids."""
    return shop.events().where(F.col("event_type") == "purchase").select(
        (F.col("k") % 5).cast("string").alias("site_no"), F.col("k").alias("item_id"),
        (F.col("event_id") % 3).alias("cart_id"),
        F.date_trunc("day", "ts").alias("cart_ts"), F.col("event_id").alias("page_id"),
    )


def attributed_orders(shop: Shop):
    orders = shop.order_lines().select("order_no", "line_no", "item_id", (F.col("order_no") % 3).alias("cart_id"))
    return orders_with_attribution(orders, attribution_of_carts(shop), ["item_id", "cart_id"])


def carried_pages(shop: Shop, **kw):
    """Attribution of carts where every seventh user has no name and every fifth visit is logged twice."""
    named = F.col("visitor_id").cast("bigint") % 7 != 0
    nameless = {c: F.when(named, F.col(c)) for c in ("visitor_id", "session_id")}
    visits = shop.page_visits().withColumn("device", F.concat(F.lit("d"), F.col("visit_id") % 3))
    visits = visits.unionByName(visits.where(F.col("visit_id") % 5 == 0))
    found = attribute_last_touch(shop.cart_lines().withColumns(nameless), visits.withColumns(nameless), carry=["device"], **kw)
    return found.select(*TOUCH, "device")


def orders_as_of(shop: Shop):
    """Order lines, each fourth without a cart and each fifth twice, with the attribution before a day of their own."""
    lines = shop.order_lines().withColumn("copy", F.explode(F.when(F.col("order_no") % 5 == 0, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(1)))))
    orders = lines.select(
        "order_no", "line_no", "item_id", F.when(F.col("order_no") % 4 != 0, F.col("order_no") % 3).alias("cart_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(int(order_no % 40))").alias("order_ts"),
    )
    return orders_with_attribution(orders, attribution_of_carts(shop), ["item_id", "cart_id"], not_after="order_ts")


def page_set(shop: Shop, kind: str):
    rows = shop.events().where(F.col("event_type") == kind)
    k = F.col("k")
    return rows.select(
        (k % 12 + 1).alias("kind"), F.concat(F.lit("mall"), k % 3).alias("mall"),
        F.concat(F.lit(kind), F.col("event_id") % 10).alias("shop"), F.lit(kind).alias("shop_detail"),
        F.concat(F.lit("u"), k, F.lit("  ")).alias("url"), (F.col("user_id") % 10).cast("string").alias("param"),
        F.when(k % 2 == 0, "mobile app").otherwise("pc").alias("device"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def merged_pages(shop: Shop):
    left = page_set(shop, "view").withColumn(
        "url", page_code(F.col("kind"), F.col("url"), F.col("device"))
    )
    right = page_set(shop, "click").withColumn("url", F.trim("url"))
    return ev.merge_page_sets(left, right)


def totals(shop: Shop):
    """Orders per customer and purchases per user on one row, either may be missing."""
    orders = shop.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderpriority").alias("label"))
    users = shop.events().groupBy(F.col("user_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("event_type").alias("label"))
    return ev.merge_full(users, orders, ["id"], ["n", "label"])


TOUCH = ["visitor_id", "site_no", "item_id", "cart_id", "ts", "qty", "visit_id", "visit_ts", "url", "area"]

QUERIES = {
    "attribute_last_touch": lambda s: attribute_last_touch(s.cart_lines(), s.page_visits()).select(*TOUCH),
    "attribute_last_touch_split": lambda s: attribute_last_touch(
        s.cart_lines(), s.page_visits(), hot_rows=60, chunk_rows=25
    ).select(*TOUCH),
    "attribute_carried": carried_pages,
    "attribute_carried_split": lambda s: carried_pages(s, hot_rows=60, chunk_rows=25),
    "attribute_one_day": lambda s: attribute_last_touch(s.cart_lines(), s.page_visits(), "1 day").select(*TOUCH),
    "explode_cart": lambda s: ev.explode_cart(cart_payloads(s)),
    "explode_orders": lambda s: ev.explode_orders(order_payloads(s))[0].select(
        "order_no", "line_no", "item_id", "cart_site_no", "unit_price", "qty", "member_id", "order_ts", "trait_code"
    ),
    "explode_visit_orders": lambda s: ev.explode_orders(order_payloads(s))[1].select("order_no", "line_no", "item_id"),
    "explode_ads": lambda s: ev.explode_ads(ad_payloads(s)),
    "json_field": lambda s: s.table("events").select(
        "event_id", ev.json_field("props", "$.k").cast("bigint").alias("k")
    ),
    "ad_counters": lambda s: ev.ad_counters(s.ad_rows()),
    "ad_contribution": lambda s: ev.ad_contribution(contribution_orders(s)),
    "ad_contribution_chain": ad_chain,
    "orders_with_attribution": attributed_orders,
    "orders_with_attribution_as_of": orders_as_of,
    "merge_full": totals,
    "merge_page_sets": merged_pages,
    "click_area": lambda s: s.table("pages").select(
        "page_id",
        click_area(F.col("url"), {"ref": "", "utm_source": "src_", "page": "p_"}, "[?&]").alias("area"),
    ),
    "latest_per_key": lambda s: latest_per_key(attribution_of_carts(s), ["item_id", "cart_id"], "cart_ts"),
    "latest_one_per_key": lambda s: latest_per_key(
        attribution_of_carts(s), ["item_id", "cart_id"], "cart_ts", ties="page_id"
    ),
    "drop_reloads": lambda s: drop_reloads(
        s.events().withColumn("g", F.col("k") % 10), ["user_id"], [("ts", "asc"), ("event_id", "asc")], ["event_type", "g"]
    ).select("event_id", "user_id", "event_type"),
    "carry_once": lambda s: carry_once(
        s.page_visits().withColumn("area", click_area(F.col("url"))),
        ["visitor_id"], [("ts", "asc"), ("visit_id", "asc")], "area", "carried",
    ).select("visit_id", "area", "carried"),
}

_STEPS = {
    "t_cart": """
        SELECT CAST(user_id AS VARCHAR) AS visitor_id, CAST(k % 5 AS VARCHAR) AS site_no, k AS item_id,
               CAST(event_id % 3 AS VARCHAR) AS cart_id, max(ts) AS ts, count(*) AS qty
        FROM v_event WHERE event_type = 'purchase' GROUP BY 1, 2, 3, 4""",
    "t_visit": """
        SELECT event_id AS visit_id, CAST(user_id AS VARCHAR) AS visitor_id, ts AS visit_ts,
               CASE event_type WHEN 'error' THEN '/order/popup.ssg?k=' WHEN 'view' THEN '/item/itemView.ssg?itemId='
                    WHEN 'signup' THEN '/disp/category.ssg?x=1&tarea=' ELSE '/main.ssg?k=' END || k AS url,
               CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS own,
               event_type = 'error' AS noise, event_type = 'view' AS detail
        FROM v_event WHERE event_type <> 'purchase'""",
}


def _touch(hours: int, carried: bool = False) -> str:
    return with_views(*_touch_parts(hours, carried))


def _ad_chain() -> str:
    body, steps = _touch_parts(6, False, "'d' || visit_id % 3 AS device")
    steps["t_touch"] = body
    return with_views("""
        SELECT target_id, order_no, date_trunc('minute', order_ts) AS minute, extension_code,
               CASE device WHEN 'd0' THEN '10' WHEN 'd1' THEN '30' ELSE '20' END AS device_code, cart_id, cart_ts, sales_amount
        FROM (SELECT lpad(CAST(k AS VARCHAR), 10, '0') AS target_id, event_id AS order_no, e.ts AS order_ts, t.device, t.ts AS cart_ts,
                     CASE WHEN k % 2 = 0 THEN '20' ELSE '10' END AS extension_code, CAST(event_id % 3 AS VARCHAR) AS cart_id,
                     2 * (k + 1) AS sales_amount,
                     row_number() OVER (PARTITION BY event_id ORDER BY t.ts DESC NULLS LAST, t.visit_id DESC) AS back
              FROM v_event e LEFT JOIN t_touch t ON t.item_id = k AND t.cart_id = CAST(event_id % 3 AS VARCHAR) AND t.ts <= e.ts
              WHERE event_type = 'purchase' AND k % 3 <> 0)
        WHERE back = 1""", steps)


def _touch_parts(hours: int, carried: bool, extra: str = "") -> tuple[str, dict[str, str]]:
    steps = _touch_steps(hours)
    visitor, device = "visitor_id", f", {extra}" if extra else ""
    if extra:
        # the device is a column of the page, so it tells reloads apart
        steps["t_reload"] = steps["t_reload"].replace("AND lead(area)", "AND lead(visit_id) OVER w % 3 = visit_id % 3 AND lead(area)")
    if carried:
        visitor, device = "nullif(visitor_id, '~') AS visitor_id", ", device"
        nameless = "CASE WHEN user_id % 7 = 0 THEN '~' ELSE CAST(user_id AS VARCHAR) END"
        steps = {name: text.replace("CAST(user_id AS VARCHAR)", nameless) for name, text in steps.items()}
        steps["t_visit"] = steps["t_visit"].replace("SELECT event_id", "SELECT 'd' || event_id % 3 AS device, event_id") + (
            " QUALIFY row_number() OVER (PARTITION BY visitor_id, visit_ts ORDER BY visit_id DESC) = 1")
        steps["t_reload"] = steps["t_reload"].replace("AND lead(area)", "AND lead(device) OVER w = device AND lead(area)")
    return (
        f"""
        SELECT {visitor}, site_no, item_id, cart_id, ts, qty, visit_id, visit_ts, url, area{device} FROM t_pick
        UNION ALL
        SELECT {visitor}, site_no, item_id, cart_id, ts, qty, visit_id, visit_ts, url, NULL{device} FROM t_reload a
        WHERE back = 1 AND NOT EXISTS (
            SELECT 1 FROM t_pick p WHERE p.visitor_id = a.visitor_id AND p.site_no = a.site_no
            AND p.item_id = a.item_id AND p.cart_id = a.cart_id AND p.ts = a.ts)""",
        steps,
    )


def _touch_steps(hours: int) -> dict[str, str]:
    return {
        **_STEPS,
        "t_pair": f"""
            SELECT c.*, v.* EXCLUDE (visitor_id) FROM t_cart c JOIN t_visit v ON c.visitor_id = v.visitor_id
            AND v.visit_ts <= c.ts AND v.visit_ts >= c.ts - INTERVAL {hours} HOUR""",
        "t_area": """
            SELECT *, coalesce(own, lead(own) OVER w) AS area FROM t_pair
            WINDOW w AS (PARTITION BY visitor_id, site_no, item_id, cart_id, ts ORDER BY visit_ts, visit_id)""",
        "t_reload": """
            SELECT *, lead(url) OVER w IS NOT DISTINCT FROM url AND lead(area) OVER w IS NOT DISTINCT FROM area
                      AND lead(visit_id) OVER w IS NOT NULL AS reload,
                   row_number() OVER (PARTITION BY visitor_id, site_no, item_id, cart_id, ts
                                      ORDER BY visit_ts DESC, visit_id DESC) AS back
            FROM t_area
            WINDOW w AS (PARTITION BY visitor_id, site_no, item_id, cart_id, ts ORDER BY visit_ts, visit_id)""",
        "t_left": """
            SELECT *, count(*) OVER (PARTITION BY visitor_id, site_no, item_id, cart_id, ts) AS n
            FROM t_reload WHERE NOT reload""",
        "t_clean": """
            SELECT *, row_number() OVER w AS r, first_value(detail) OVER w AS lead_detail,
                   count(*) OVER (PARTITION BY visitor_id, site_no, item_id, cart_id, ts) AS m
            FROM t_left WHERE NOT noise OR n = 1
            WINDOW w AS (PARTITION BY visitor_id, site_no, item_id, cart_id, ts ORDER BY visit_ts DESC, visit_id DESC)""",
        "t_pick": """
            SELECT * FROM t_clean
            WHERE r = CASE WHEN n > 1 AND lead_detail AND m > 1 THEN 2 ELSE 1 END""",
    }


_CART_LINES = """
    SELECT e.event_id, e.ts, CAST(user_id AS VARCHAR) AS visitor_id,
           CASE WHEN k % 3 = 0 THEN '.' ELSE '/ref' END AS referrer, CAST(e.event_id AS VARCHAR) AS cart_id,
           'm' || CAST(e.event_id AS VARCHAR) AS master_cart_id, '0' AS option_id, CAST(k % 5 AS VARCHAR) AS cart_site_no,
           CAST(k AS VARCHAR) AS item_id, k % 3 + 1 AS qty,
           CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) ELSE '' END AS inflow_target
    FROM v_event e JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR e.event_id % 2 = 0
    WHERE event_type = 'purchase' AND k % 10 <> 9 AND NOT (k % 2 = 0 AND k % 4 = 0)"""

_ATTR = {
    "t_attr": """
        SELECT CAST(k % 5 AS VARCHAR) AS site_no, k AS item_id, event_id % 3 AS cart_id,
               date_trunc('day', ts) AS cart_ts, event_id AS page_id
        FROM v_event WHERE event_type = 'purchase'""",
}


def _pages(kind: str, url: str) -> str:
    return f"""
        SELECT k % 12 + 1 AS kind, 'mall' || CAST(k % 3 AS VARCHAR) AS mall,
               '{kind}' || CAST(event_id % 10 AS VARCHAR) AS shop, '{kind}' AS shop_detail, {url} AS url,
               CAST(user_id % 10 AS VARCHAR) AS param, CASE WHEN k % 2 = 0 THEN 'mobile app' ELSE 'pc' END AS device,
               strftime(ts, '%Y-%m-%d') AS day
        FROM v_event WHERE event_type = '{kind}'"""


_PREFIXED = """CASE WHEN k % 2 = 0 THEN CASE k % 12 + 1 WHEN 1 THEN 'SSG_' WHEN 2 THEN 'EM_' WHEN 3 THEN 'TR_'
    WHEN 4 THEN 'BM_' WHEN 5 THEN 'SM_' WHEN 6 THEN 'SD_' WHEN 7 THEN 'TV_' WHEN 8 THEN 'HD_' WHEN 10 THEN 'BT_'
    WHEN 11 THEN 'SIV_' WHEN 12 THEN 'STF_' ELSE '' END ELSE '' END || 'u' || CAST(k AS VARCHAR)"""

SQL = {
    "attribute_last_touch": _touch(6),
    "attribute_last_touch_split": _touch(6),
    "attribute_carried": _touch(6, True),
    "attribute_carried_split": _touch(6, True),
    "attribute_one_day": _touch(24),
    "ad_contribution_chain": _ad_chain(),
    "orders_with_attribution_as_of": with_views("""
        SELECT order_no, line_no, item_id, cart_id, order_ts, cart_ts, page_id FROM (
            SELECT o.*, a.cart_ts, a.page_id,
                   row_number() OVER (PARTITION BY o.r ORDER BY a.cart_ts DESC NULLS LAST, a.page_id DESC) AS back
            FROM (SELECT row_number() OVER () AS r, order_no, line_no, item_id, CASE WHEN order_no % 4 <> 0 THEN order_no % 3 END AS cart_id,
                         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(order_no % 40 AS INTEGER)) AS order_ts
                  FROM v_order_line JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR order_no % 5 = 0) o
            LEFT JOIN t_attr a ON a.item_id = o.item_id AND a.cart_id = o.cart_id AND a.cart_ts <= o.order_ts)
        WHERE back = 1""", _ATTR),
    "explode_cart": with_views(_CART_LINES),
    "explode_orders": with_views("""
        SELECT CAST(order_no AS VARCHAR) AS order_no, line_no, CAST(item_id AS VARCHAR) AS item_id,
               site_no AS cart_site_no, unit_price, qty, CAST(member_id AS VARCHAR) AS member_id,
               TIMESTAMP '2024-01-01 00:00:00' AS order_ts, CAST(item_id % 10 AS VARCHAR) AS trait_code
        FROM v_order_line"""),
    "explode_visit_orders": with_views("""
        SELECT CAST(order_no AS VARCHAR) AS order_no, line_no, CAST(item_id AS VARCHAR) AS item_id
        FROM v_order_line WHERE (item_id % 3 <> 0 OR item_id % 6 = 0) AND item_id % 10 NOT IN (6, 8, 9)"""),
    "explode_ads": with_views("""
        SELECT event_id, ts, event_type AS type, 'main' AS global_id, 'a' AS area_id, CAST(k % 5 AS VARCHAR) AS site_no,
               'pc' AS media_code, 'view' AS position, 'item' AS unit_type, 'acc' AS account_id, 'bid' AS bid_id,
               CAST(k AS VARCHAR) AS target_id, '1' AS ad_index, x AS extension_code
        FROM v_event, (SELECT unnest(['10', '20']) AS x) WHERE k % 7 <> 0"""),
    "json_field": with_views("SELECT event_id, k FROM v_event"),
    "ad_counters": with_views("""
        SELECT site_no, media_code, date_trunc('minute', ts) AS minute, global_id, area_id, unit_code, account_id,
               bid_id, target_id, extension_code,
               count(*) FILTER (type = 'pv') AS pv_count, count(*) FILTER (type = 'click') AS click_count,
               count(*) FILTER (position = 'view') AS view_count,
               count(*) FILTER (position IN ('cart', 'tap_cart')) AS cart_count,
               count(*) FILTER (position = 'buy') AS buy_count,
               count(*) FILTER (position IN ('clip', 'tap_clip')) AS clip_count,
               count(*) FILTER (position = 'quick') AS quick_count,
               count(*) FILTER (position IN ('share', 'tap_share')) AS share_count,
               count(*) FILTER (position = 'pop') AS pop_count
        FROM v_ad_row GROUP BY ALL"""),
    "ad_contribution": with_views("""
        SELECT lpad(CAST(item_id AS VARCHAR), 10, '0') AS target_id, order_no, CAST(order_date AS TIMESTAMP) AS minute,
               CASE WHEN item_id % 2 = 0 THEN '20' ELSE '10' END AS extension_code,
               CASE substr(priority, 1, 1) WHEN '1' THEN '10' WHEN '2' THEN '30' ELSE '20' END AS device_code,
               order_no AS cart_id, CAST(order_date AS TIMESTAMP) AS cart_ts, qty * unit_price AS sales_amount
        FROM v_order_line WHERE item_id % 3 <> 0"""),
    "orders_with_attribution": with_views("""
        SELECT o.order_no, o.line_no, o.item_id, o.order_no % 3 AS cart_id, a.cart_ts, a.page_id
        FROM v_order_line o LEFT JOIN (
            SELECT * FROM t_attr t WHERE cart_ts = (
                SELECT max(cart_ts) FROM t_attr m
                WHERE m.site_no = t.site_no AND m.item_id = t.item_id AND m.cart_id = t.cart_id)) a
        ON o.item_id = a.item_id AND o.order_no % 3 = a.cart_id""", _ATTR),
    "merge_full": """
        SELECT coalesce(a.id, b.id) AS id, coalesce(a.n, b.n) AS n, coalesce(a.label, b.label) AS label
        FROM (SELECT user_id AS id, count(*) AS n, max(event_type) AS label FROM events GROUP BY 1) a
        FULL JOIN (SELECT o_custkey AS id, count(*) AS n, max(o_orderpriority) AS label FROM orders GROUP BY 1) b
        ON a.id = b.id""",
    "merge_page_sets": with_views("""
        SELECT kind, mall, url, param, device, max(shop) AS shop, max(shop_detail) AS shop_detail, max(day) AS day
        FROM (SELECT coalesce(a.kind, b.kind) AS kind, coalesce(a.mall, b.mall) AS mall, coalesce(a.url, b.url) AS url,
                     coalesce(a.param, b.param) AS param, coalesce(a.device, b.device) AS device,
                     coalesce(a.shop, b.shop) AS shop, coalesce(a.shop_detail, b.shop_detail) AS shop_detail,
                     coalesce(a.day, b.day) AS day
              FROM t_left a FULL JOIN t_right b ON a.url = b.url AND a.param = b.param AND a.device = b.device)
        GROUP BY kind, mall, url, param, device""",
        {"t_left": _pages("view", _PREFIXED), "t_right": _pages("click", "'u' || CAST(k AS VARCHAR)")}),
    "click_area": """
        SELECT page_id, coalesce(
            nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), ''),
            'src_' || nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), ''),
            'p_' || nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '')) AS area
        FROM pages""",
    "latest_per_key": with_views(
        "SELECT * FROM t_attr QUALIFY rank() OVER (PARTITION BY item_id, cart_id ORDER BY cart_ts DESC) = 1", _ATTR),
    "latest_one_per_key": with_views(
        "SELECT * FROM t_attr QUALIFY row_number() OVER (PARTITION BY item_id, cart_id"
        " ORDER BY cart_ts DESC, page_id DESC) = 1", _ATTR),
    "drop_reloads": with_views("""
        SELECT event_id, user_id, event_type FROM v_event
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
        QUALIFY NOT coalesce(lead(event_type) OVER w = event_type AND lead(k % 10) OVER w = k % 10, false)"""),
    "carry_once": with_views("""
        SELECT visit_id, own AS area, coalesce(own, lead(own) OVER (PARTITION BY visitor_id ORDER BY visit_ts, visit_id)) AS carried
        FROM t_visit""", _STEPS),
}
