"""Search-best and search-model queries over the test tables, with the same queries in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from vendue.checks.tables import with_views
from vendue.plans import search_best as sb
from vendue.plans import search_model as sm
from vendue.session import pin
from vendue.views import EVENTS_AS_OF, ORDERS_AS_OF, Shop

SINCE = date(1995, 1, 1)


def previous_logins(shop: Shop):
    """A state of earlier days: purchases until three days before, one year old for some users."""
    old = F.when(F.col("user_id") % 6 == 0, F.add_months(F.to_date("ts"), -12)).otherwise(F.to_date("ts"))
    return shop.events().where((F.col("event_type") == "purchase") & (F.col("user_id") % 2 == 0)).select(
        F.col("user_id").alias("member_id"), F.col("user_id").cast("string").alias("visitor_id"), old.alias("updated")
    )


def logins(shop: Shop):
    return sb.login_history(previous_logins(shop), shop.clicks(), EVENTS_AS_OF)


def sellables(shop: Shop):
    return sb.sb_items(shop.items(), shop.prices(), ORDERS_AS_OF)


def known(shop: Shop, fanout: bool = True, items=None):
    columns = ["item_id", "visitor_id", "site_no"]
    both = shop.clicks().select(*columns).unionByName(shop.carts().select(*columns))
    return sb.known_clicks(both, items or sellables(shop), logins(shop), fanout)


def buys(shop: Shop, items=None, clicked=None):
    items = items or pin(sellables(shop))
    return sb.sb_buy_log(shop.order_lines(), items, clicked or known(shop, items=items), ORDERS_AS_OF, days=None)


def best(shop: Shop):
    # both are read several times
    items = pin(sellables(shop))
    clicked = pin(known(shop, items=items))
    return sb.search_best(buys(shop, items, clicked), sb.sb_click_log(clicked), items, shop.prices())


def signals(shop: Shop):
    return sm.search_signals(shop.page_rows(), shop.reaction_rows(), shop.attribution_rows(), EVENTS_AS_OF)


def features(shop: Shop):
    return sm.sm_features(
        signals(shop), sm.order_features(shop.order_lines(), SINCE), shop.reviews(),
        sm.offline_freq(shop.offline_sales(), shop.offline_map()), shop.prices(), shop.items(), ORDERS_AS_OF,
    )


def scores(shop: Shop):
    names = ["first_score", "second_score", "third_score", "fourth_score"]
    return sm.sm_scores(features(shop)).select(
        "item_id", "brand_id", "category_id", "new_flag", *[F.round(n, 4).alias(n) for n in names]
    )


def counted(shop: Shop, kind: str):
    return shop.events().where(F.col("event_type") == kind).groupBy(F.col("k").alias("item_id")).agg(
        F.count(F.lit(1)).alias("n"))


_FEATURES = [
    "item_id", "search_growth", "click_growth", "search_count", "click_count", "cart_count", "order_count", "amount",
    "unit_price", "discount_rate", "review_count", "offline_count", "freshness",
]
_ROUNDED = {"search_growth", "click_growth", "unit_price", "discount_rate", "freshness"}

QUERIES = {
    "login_history": logins,
    "full_items": lambda s: sb.full_items(s.items(), s.prices(), ORDERS_AS_OF),
    "search_best_items": sellables,
    "known_clicks": known,
    "known_clicks_once": lambda s: known(s, fanout=False),
    "search_best_click_log": lambda s: sb.sb_click_log(known(s)),
    "search_best_buy_log": buys,
    "search_best": best,
    "search_signals": signals,
    "growth_rate": lambda s: sm.growth_rate(counted(s, "view"), counted(s, "click"), 1e7).select(
        "item_id", F.round("growth", 4).alias("growth")
    ),
    "order_features": lambda s: sm.order_features(s.order_lines(), date(1998, 1, 1)).select(
        "item_id", "order_count", "amount", F.round("unit_price", 4).alias("unit_price"),
        F.round("discount_rate", 4).alias("discount_rate"),
    ),
    "offline_freq": lambda s: sm.offline_freq(s.offline_sales(), s.offline_map()),
    "search_model_features": lambda s: features(s).select(
        *[F.round(c, 4).alias(c) if c in _ROUNDED else F.col(c) for c in _FEATURES]
    ),
    "search_model": scores,
    "score_by_site": lambda s: sm.score_by_site(scores(s), s.prices()).select("item_id", "site_no", "third_score"),
    "items_in_classes": lambda s: sm.items_in_classes(s.items(), s.categories(), [], ["VALUE"]),
}

_STEPS = {
    "s_login": """
        SELECT visitor_id, max(member_id) AS member_id, max(updated) AS updated
        FROM (SELECT user_id AS member_id, CAST(user_id AS VARCHAR) AS visitor_id,
                     CASE WHEN user_id % 6 = 0 THEN CAST(CAST(ts AS DATE) - INTERVAL 12 MONTH AS DATE)
                          ELSE CAST(ts AS DATE) END AS updated
              FROM v_event WHERE event_type = 'purchase' AND user_id % 2 = 0
              UNION ALL
              SELECT DISTINCT member_id, visitor_id, DATE '2024-01-30' FROM v_click
              WHERE visit_date >= DATE '2024-01-28' AND visit_date < DATE '2024-01-30' AND member_id IS NOT NULL)
        GROUP BY visitor_id HAVING max(updated) >= DATE '2023-07-30'""",
    "s_full": """
        SELECT item_id, site_no, store_no, sell_price, low_price, shown_from,
               round(1.0::DOUBLE / nullif(DATE '2001-08-02' - shown_from, 0), 4) AS open_weight
        FROM v_item JOIN v_price USING (item_id)
        WHERE sell_status = 20 AND (sell_type IN (10, 20) OR (sell_type = 30 AND sell_type_detail = 70))""",
    "s_site": """
        SELECT item_id, site_no, min(low_price) AS price, max(open_weight) AS open_weight,
               min(shown_from) AS shown_from, count(*) AS stores
        FROM s_full GROUP BY item_id, site_no""",
    "s_click": """
        SELECT t.item_id, t.visitor_id, t.site_no
        FROM (SELECT item_id, visitor_id, site_no FROM v_click
              UNION ALL SELECT item_id, visitor_id, site_no FROM v_cart) t
        JOIN s_full f ON t.item_id = f.item_id JOIN s_login l ON t.visitor_id = l.visitor_id""",
    "s_buy_rows": """
        SELECT o.item_id, o.member_id FROM v_order_line o
        JOIN s_full f ON o.item_id = f.item_id AND o.site_no = f.site_no""",
    "s_buy": """
        SELECT item_id, max(a) AS buyers, max(b) AS purchases, max(c) AS amount, max(site_no) AS site_no
        FROM (SELECT r.item_id, CAST(count(DISTINCT member_id) AS DOUBLE) AS a, CAST(count(*) AS DOUBLE) AS b,
                     CAST(sum(price) AS DOUBLE) AS c, max(site_no) AS site_no
              FROM s_buy_rows r JOIN s_site s ON r.item_id = s.item_id GROUP BY r.item_id
              UNION ALL
              SELECT c.item_id, 0.0001, 0.0001, 0.0001, max(s.site_no)
              FROM s_click c JOIN s_site s ON c.item_id = s.item_id GROUP BY c.item_id)
        GROUP BY item_id""",
    "s_click_log": """
        SELECT item_id, count(DISTINCT visitor_id) AS visitors, count(*) AS click_count, max(site_no) AS site_no
        FROM s_click GROUP BY item_id""",
    "s_log": """
        SELECT b.item_id, s.site_no, buyers, purchases, amount,
               CASE WHEN visitors < buyers THEN visitors + buyers ELSE visitors END::DOUBLE AS click_visitors,
               CASE WHEN click_count < purchases THEN click_count + purchases ELSE click_count END::DOUBLE AS clicks,
               CASE WHEN open_weight IS NULL OR open_weight < 1.0::DOUBLE / 7 THEN 0.1429 ELSE open_weight END::DOUBLE AS w
        FROM s_buy b JOIN s_click_log c ON b.item_id = c.item_id JOIN s_site s ON b.item_id = s.item_id""",
    "s_ranked": """
        SELECT *, row_number() OVER (ORDER BY purchases * w DESC, item_id, site_no) AS r1,
               row_number() OVER (ORDER BY amount * w DESC, item_id, site_no) AS r2,
               row_number() OVER (ORDER BY clicks * w DESC, item_id, site_no) AS r3
        FROM s_log""",
    "s_best": """
        SELECT a.item_id, p.site_no, purchases, amount,
               round((1000000.0::DOUBLE / r1) * 0.3::DOUBLE + (1000000.0::DOUBLE / r2) * 0.5::DOUBLE
                     + (1000000.0::DOUBLE / r3) * 0.7::DOUBLE, 4) AS score,
               conversion, click_visitors, click_count
        FROM (SELECT item_id, max(purchases) AS purchases, max(amount) AS amount, min(r1) AS r1, min(r2) AS r2,
                     min(r3) AS r3, min(round(purchases / clicks * buyers / click_visitors * 100, 2)) AS conversion,
                     min(click_visitors) AS click_visitors, min(clicks) AS click_count
              FROM s_ranked GROUP BY item_id) a
        JOIN (SELECT item_id, max(site_no) AS site_no FROM v_price GROUP BY item_id) p ON a.item_id = p.item_id""",
    # search model: one query per channel and day, joined one after another
    "m_search": """
        SELECT item_id, day, 'detail' AS part FROM v_page_row WHERE device <> 'MA' AND item_page AND from_search
        UNION ALL SELECT item_id, day, 'detail' FROM v_reaction_row WHERE from_search
        UNION ALL SELECT item_id, day, 'cart' FROM v_attribution_row WHERE from_search""",
    "m_item": """
        SELECT item_id, day, 'detail' AS part FROM v_page_row WHERE device = 'MA' AND native_item
        UNION ALL SELECT item_id, day, 'detail' FROM v_page_row WHERE item_page
        UNION ALL SELECT item_id, day, 'cart' FROM v_attribution_row""",
    "m_search_d1": "SELECT item_id, count(*) AS n FROM m_search WHERE day = DATE '2024-01-30' GROUP BY item_id",
    "m_search_d8": "SELECT item_id, count(*) AS n FROM m_search WHERE day = DATE '2024-01-23' GROUP BY item_id",
    "m_search_3d": """
        SELECT item_id, count(*) AS n FROM m_search
        WHERE day BETWEEN DATE '2024-01-28' AND DATE '2024-01-30' AND part = 'detail' GROUP BY item_id""",
    "m_item_d1": """
        SELECT a.item_id, greatest(a.n - coalesce(b.n, 0), 0) AS n
        FROM (SELECT item_id, count(*) AS n FROM m_item WHERE day = DATE '2024-01-30' GROUP BY item_id) a
        LEFT JOIN m_search_d1 b ON a.item_id = b.item_id""",
    "m_item_d8": """
        SELECT a.item_id, greatest(a.n - coalesce(b.n, 0), 0) AS n
        FROM (SELECT item_id, count(*) AS n FROM m_item WHERE day = DATE '2024-01-23' GROUP BY item_id) a
        LEFT JOIN m_search_d8 b ON a.item_id = b.item_id""",
    "m_item_3d": """
        SELECT a.item_id, greatest(a.n - coalesce(b.n, 0), 0) AS n
        FROM (SELECT item_id, count(*) AS n FROM m_item
              WHERE day BETWEEN DATE '2024-01-28' AND DATE '2024-01-30' AND part = 'detail' GROUP BY item_id) a
        LEFT JOIN m_search_3d b ON a.item_id = b.item_id""",
    "m_cart_3d": """
        SELECT item_id, count(*) AS n FROM v_attribution_row
        WHERE day BETWEEN DATE '2024-01-28' AND DATE '2024-01-30' GROUP BY item_id""",
    "m_spine": """
        SELECT item_id FROM m_search_d1 UNION SELECT item_id FROM m_search_d8 UNION SELECT item_id FROM m_search_3d
        UNION SELECT item_id FROM m_item_d1 UNION SELECT item_id FROM m_item_d8 UNION SELECT item_id FROM m_item_3d
        UNION SELECT item_id FROM m_cart_3d""",
    "m_signal": """
        SELECT s.item_id, coalesce(a.n, 0) AS search_d1, coalesce(b.n, 0) AS search_d8, coalesce(c.n, 0) AS search_count,
               coalesce(d.n, 0) AS click_d1, coalesce(e.n, 0) AS click_d8, coalesce(f.n, 0) AS click_count,
               coalesce(g.n, 0) AS cart_count
        FROM m_spine s LEFT JOIN m_search_d1 a USING (item_id) LEFT JOIN m_search_d8 b USING (item_id)
        LEFT JOIN m_search_3d c USING (item_id) LEFT JOIN m_item_d1 d USING (item_id)
        LEFT JOIN m_item_d8 e USING (item_id) LEFT JOIN m_item_3d f USING (item_id) LEFT JOIN m_cart_3d g USING (item_id)""",
    "m_order": """
        SELECT item_id, count(DISTINCT order_no) AS order_count,
               CAST(sum(amount - own_discount - partner_discount) AS BIGINT) AS amount,
               CAST(sum(amount - own_discount - partner_discount) AS DOUBLE) / sum(qty) AS unit_price,
               greatest(CAST(sum(own_discount + partner_discount) AS DOUBLE) / sum(amount), 0) AS discount_rate
        FROM v_order_line WHERE order_date >= DATE '{since}' AND target_code = '1'
        GROUP BY item_id HAVING sum(amount - own_discount - partner_discount) > 0 AND sum(qty) > 0""",
    "m_offline": """
        SELECT m.item_id, count(*) AS offline_count FROM v_offline_sale s
        LEFT JOIN v_offline_map m ON m.business_code = '10' AND s.offline_item_id = m.offline_item_id
        WHERE m.item_id IS NOT NULL GROUP BY m.item_id""",
    "m_total": "SELECT sum(search_d1) AS s1, sum(search_d8) AS s8, sum(click_d1) AS c1, sum(click_d8) AS c8 FROM m_signal",
    "m_merged": """
        SELECT i.item_id,
               coalesce((coalesce(search_d1, 0) / s1 - coalesce(search_d8, 0) / s8) / 7 * 10000000, 0) AS search_growth,
               coalesce((coalesce(click_d1, 0) / c1 - coalesce(click_d8, 0) / c8) / 7 * 100000000, 0) AS click_growth,
               coalesce(search_count, 0) AS search_count, coalesce(click_count, 0) AS click_count,
               coalesce(cart_count, 0) AS cart_count, coalesce(order_count, 0) AS order_count,
               coalesce(o.amount, 0) AS amount,
               coalesce(unit_price, (SELECT max(sell_price) FROM v_price p WHERE p.item_id = i.item_id)) AS unit_price,
               coalesce(discount_rate, 0) AS discount_rate, coalesce(review_count, 0) AS review_count,
               coalesce(offline_count, 0) AS offline_count,
               CASE WHEN age BETWEEN 0 AND 7 THEN 1.0 WHEN age BETWEEN 0 AND 77 THEN 1.0 / ceil(age / 7)
                    ELSE 1.0 / 12 END::DOUBLE AS freshness,
               brand_id, category_id, new_flag
        FROM (SELECT *, DATE '2001-08-02' - shown_from AS age FROM v_item WHERE sell_type_detail <> 80) i
        LEFT JOIN m_signal s ON i.item_id = s.item_id LEFT JOIN m_order o ON i.item_id = o.item_id
        LEFT JOIN v_review r ON i.item_id = r.item_id LEFT JOIN m_offline f ON i.item_id = f.item_id, m_total
        WHERE i.item_id IN (SELECT item_id FROM v_price)
          AND (s.item_id IS NOT NULL OR o.item_id IS NOT NULL OR r.item_id IS NOT NULL OR f.item_id IS NOT NULL)""",
}
_LOG = ", ".join(
    f"CASE WHEN {c} > 0 THEN log10({c}) ELSE 0 END AS {c}" for c in sm.LOGGED
)
_STEPS["m_log"] = f"SELECT item_id, brand_id, category_id, new_flag, freshness, discount_rate, {_LOG} FROM m_merged"
_STEPS["m_bounds"] = "SELECT " + ", ".join(
    f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in sm.LOGGED + sm.PLAIN
) + " FROM m_log"
_STEPS["m_norm"] = "SELECT item_id, brand_id, category_id, new_flag, " + ", ".join(
    ("100 - " if c == "unit_price" else "") + f"100 * (({c} - lo_{c}) / nullif(hi_{c} - lo_{c}, 0)) AS {c}"
    for c in sm.LOGGED + sm.PLAIN
) + " FROM m_log, m_bounds"
_NEW = "(search_growth * 0.4::DOUBLE + click_growth * 0.4::DOUBLE + freshness * 0.2::DOUBLE)"
_POP = ("(cart_count * 0.25::DOUBLE + order_count * 0.2::DOUBLE + review_count * 0.2::DOUBLE"
        " + search_count * 0.15::DOUBLE + click_count * 0.1::DOUBLE + amount * 0.1::DOUBLE)")
_PRICE = "(unit_price * 0.6::DOUBLE + discount_rate * 0.4::DOUBLE)"
_STEPS["m_score"] = "SELECT item_id, brand_id, category_id, new_flag, " + ", ".join(
    f"round({a}::DOUBLE * {_NEW} + {b}::DOUBLE * {_POP} + {c}::DOUBLE * {_PRICE}, 4) AS {name}"
    for name, (a, b, c) in sm.SCORE_SETS.items()
) + """, round(cart_count * 0.15::DOUBLE + order_count * 0.35::DOUBLE + review_count * 0.25::DOUBLE
       + search_count * 0.05::DOUBLE + offline_count * 0.1::DOUBLE + amount * 0.1::DOUBLE, 4) AS fourth_score FROM m_norm"""


def model_steps(since: str = "1995-01-01") -> dict[str, str]:
    return {**_STEPS, "m_order": _STEPS["m_order"].format(since=since)}


def _sql(body: str, since: str = "1995-01-01") -> str:
    return with_views(body, model_steps(since))


SQL = {
    "login_history": _sql("SELECT * FROM s_login"),
    "full_items": _sql("SELECT * FROM s_full"),
    "search_best_items": _sql("SELECT * FROM s_site"),
    "known_clicks": _sql("SELECT item_id, visitor_id, site_no, count(*) AS clicks FROM s_click GROUP BY ALL"),
    "known_clicks_once": _sql("""
        SELECT item_id, visitor_id, site_no, count(*) AS clicks
        FROM (SELECT item_id, visitor_id, site_no FROM v_click UNION ALL SELECT item_id, visitor_id, site_no FROM v_cart)
        WHERE item_id IN (SELECT item_id FROM s_full) AND visitor_id IN (SELECT visitor_id FROM s_login) GROUP BY ALL"""),
    "search_best_click_log": _sql("SELECT * FROM s_click_log"),
    "search_best_buy_log": _sql("SELECT * FROM s_buy"),
    "search_best": _sql("SELECT * FROM s_best"),
    "search_signals": _sql("SELECT * FROM m_signal"),
    "growth_rate": with_views("""
        SELECT coalesce(a.item_id, b.item_id) AS item_id,
               round(((coalesce(a.n, 0) / (SELECT count(*) FROM v_event WHERE event_type = 'view')
                 - coalesce(b.n, 0) / (SELECT count(*) FROM v_event WHERE event_type = 'click')) / 7) * 10000000, 4) AS growth
        FROM (SELECT k AS item_id, count(*) AS n FROM v_event WHERE event_type = 'view' GROUP BY k) a
        FULL JOIN (SELECT k AS item_id, count(*) AS n FROM v_event WHERE event_type = 'click' GROUP BY k) b
        ON a.item_id = b.item_id"""),
    "order_features": _sql("""
        SELECT item_id, order_count, amount, round(unit_price, 4) AS unit_price, round(discount_rate, 4) AS discount_rate
        FROM m_order""", "1998-01-01"),
    "offline_freq": _sql("SELECT * FROM m_offline"),
    "search_model_features": _sql("SELECT " + ", ".join(
        f"round({c}, 4) AS {c}" if c in _ROUNDED else c for c in _FEATURES) + " FROM m_merged"),
    "search_model": _sql("SELECT * FROM m_score"),
    "score_by_site": _sql("""
        SELECT m.item_id, p.site_no, m.third_score FROM m_score m
        JOIN (SELECT DISTINCT item_id, site_no FROM v_price) p ON m.item_id = p.item_id"""),
    "items_in_classes": with_views("""
        SELECT item_id FROM v_item JOIN v_category USING (category_id) WHERE medium_id = 'VALUE'"""),
}
