"""Best-rank and segment queries over the test tables, with the same queries in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from vendue.checks.tables import with_views
from vendue.plans import best_rank as br
from vendue.plans import segments as sg
from vendue.session import pin
from vendue.views import ORDERS_AS_OF, Shop

# Sites of the test tables are 0..4: 4 counts as 3, 9 is the all-site, 1 and 2 have copies.
ALIAS = {"4": "3"}
COPIES = [("1", "7"), ("2", "8")]
ALL = "9"
BOOST = ("2", ("VALUE",), 123456, 4)
FADE = {17: (date(2001, 7, 23), 5), 34: (date(2001, 6, 3), 5)}
DEMO = ["gender", "age_band"]


def items(shop: Shop):
    return br.br_items(shop.items(), shop.prices(), ORDERS_AS_OF)


def counts(shop: Shop):
    return br.br_counts(shop.order_lines(), br.br_clicks(shop.clicks(), shop.prices(), site_alias=ALIAS))


def frame(shop: Shop):
    clicks = br.br_clicks(shop.clicks(), site_alias=ALIAS)
    return br.br_frame(items(shop), br.br_counts(shop.order_lines(), clicks), shop.event_items())


def final(shop: Shop, normal: bool, ranked: DataFrame | None = None):
    ranked = frame(shop) if ranked is None else ranked
    scored = br.br_norm_score(ranked) if normal else br.br_rank_score(ranked)
    pushed = br.event_penalty(scored, all_site=ALL)
    shown = br.copy_sites(pushed, COPIES if normal else [])
    return br.final_rank(shown, ORDERS_AS_OF, FADE)


def products(shop: Shop, normal: bool, k: int = br.PRODUCT_ROWS, ranked: DataFrame | None = None):
    return br.product_list(final(shop, normal, ranked), shop.categories(), ORDERS_AS_OF, k, ALL, BOOST)


def both_products(shop: Shop):
    """The lists of both runs, over one frame whose features are ranked once."""
    ranked = pin(br.br_feature_ranks(frame(shop))[0])
    return br.final_products(products(shop, False, ranked=ranked), products(shop, True, ranked=ranked), ALL)


def demo_counts(shop: Shop, gated: bool = True):
    # members by order, not by line: no line moves for them
    orders = shop.order_lines(sg.orders_demo(shop.order_heads(), shop.members()))
    clicks = br.br_clicks(shop.clicks(), shop.prices() if gated else None, DEMO, ALIAS, match_site=True)
    return br.br_counts(orders, clicks, DEMO)


def cube(shop: Shop):
    return sg.segment_cube(sg.segment_frame(items(shop), demo_counts(shop, gated=False), shop.event_items()))


def segment_ranks(shop: Shop, bounds: str = "overall"):
    return sg.segment_rank(sg.show_on_sites(sg.segment_score(cube(shop), bounds), COPIES))


RANK_COLUMNS = [
    "item_id", "display_site", "sell_site", "order_count", "order_rank", "brand_id", "new_item", "origin_id",
    "click_count", "click_rank", "amount", "amount_rank", "total_score", "total_rank", "event", "final_rank",
]

QUERIES = {
    "best_rank_items": lambda s: items(s),
    "best_rank_clicks": lambda s: br.br_clicks(s.clicks(), s.prices(), site_alias=ALIAS),
    "best_rank_counts": lambda s: counts(s),
    "best_rank_frame": lambda s: frame(s),
    "best_rank_reciprocal": lambda s: final(s, False).select(*RANK_COLUMNS),
    "best_rank_norm": lambda s: final(s, True).select(*RANK_COLUMNS),
    "product_list": lambda s: products(s, True),
    "product_list_top": lambda s: products(s, True, 500),
    "final_products": both_products,
    "unique_members": lambda s: sg.unique_members(s.members()),
    "orders_demo": lambda s: sg.orders_demo(s.order_lines(), s.members()).select(
        "order_no", "line_no", "member_id", "gender", "age_band"
    ),
    "segment_counts": lambda s: demo_counts(s),
    "segment_cube": lambda s: cube(s).select(
        "grouping", "item_id", "gender", "age_band", "site_no", "brand_id", "event", *br.FEATURES
    ),
    "segment_score": lambda s: sg.segment_score(cube(s)).select(
        "grouping", "item_id", "gender", "age_band", "total_score"
    ),
    "segment_score_own_bounds": lambda s: sg.segment_score(cube(s), "own").select(
        "grouping", "item_id", "gender", "age_band", "total_score"
    ),
    "segment_rank": lambda s: segment_ranks(s).select(
        "grouping", "gender", "age_band", "display_site", "sell_site", "item_id", "total_score", "score"
    ),
    "segment_wide": lambda s: sg.pivot_segment_scores(segment_ranks(s)),
}

# SQL ---------------------------------------------------------------------

_NET = "amount - own_discount - partner_discount"

_STEPS = {
    "q_items": """
        SELECT item_id, site_no, brand_id, max(low_price) AS sell_price, origin_id, category_id,
               CASE WHEN new_flag = 'Y' AND registered >= DATE '2001-08-02' - 7 THEN 'Y' ELSE 'N' END AS new_item
        FROM v_item JOIN v_price USING (item_id)
        WHERE sell_status = 20
        GROUP BY item_id, site_no, brand_id, registered, new_flag, origin_id, category_id""",
    "q_clicks": """
        SELECT DISTINCT item_id, ip, CASE WHEN site_no = '4' THEN '3' ELSE site_no END AS site_no
        FROM v_click
        WHERE visitor_id IS NOT NULL AND item_id IN (SELECT item_id FROM v_price)""",
    "q_counts": f"""
        SELECT item_id, site_no, CAST(sum(o) AS BIGINT) AS order_count, CAST(sum(c) AS BIGINT) AS click_count,
               CAST(sum(a) AS BIGINT) AS amount
        FROM (SELECT item_id, site_no, count(DISTINCT order_no) AS o, sum({_NET}) AS a, NULL AS c
              FROM v_order_line GROUP BY item_id, site_no
              UNION ALL
              SELECT item_id, site_no, 0, 0, count(*) FROM q_clicks GROUP BY item_id, site_no)
        GROUP BY item_id, site_no""",
    "q_frame": """
        SELECT b.*, CASE WHEN e.item_id IS NULL THEN 'N' ELSE 'Y' END AS event
        FROM (SELECT i.item_id, max(i.site_no) AS site_no, max(i.sell_price) AS sell_price,
                     max(i.brand_id) AS brand_id, max(i.new_item) AS new_item, max(i.origin_id) AS origin_id,
                     max(i.category_id) AS category_id, CAST(sum(order_count) AS BIGINT) AS order_count,
                     CAST(sum(click_count) AS BIGINT) AS click_count,
                     CAST(CASE WHEN sum(c.amount) < 0 THEN 0 ELSE sum(c.amount) END AS BIGINT) AS amount
              FROM q_items i LEFT JOIN q_counts c ON i.item_id = c.item_id AND i.site_no = c.site_no
              GROUP BY i.item_id) b
        LEFT JOIN v_event_item e ON b.item_id = e.item_id""",
    "q_feature_rank": """
        SELECT *, rank() OVER (ORDER BY order_count DESC NULLS LAST) AS order_rank,
               row_number() OVER (ORDER BY amount DESC NULLS LAST, item_id) AS amount_rank,
               row_number() OVER (ORDER BY click_count DESC NULLS LAST, item_id) AS click_rank
        FROM q_frame""",
    "q_plain_raw": """
        SELECT *, (1000000.0::DOUBLE / order_rank) * 0.5::DOUBLE + (1000000.0::DOUBLE / amount_rank) * 0.2::DOUBLE
                  + (1000000.0::DOUBLE / click_rank) * 0.3::DOUBLE AS raw
        FROM q_feature_rank""",
    "q_log": """
        SELECT item_id, CASE WHEN order_count > 0 THEN log10(order_count) ELSE 0 END AS lo,
               CASE WHEN click_count > 0 THEN log10(click_count) ELSE 0 END AS lc,
               CASE WHEN amount > 0 THEN log10(amount) ELSE 0 END AS la
        FROM q_frame""",
    "q_bounds": "SELECT min(lo) o0, max(lo) o1, min(lc) c0, max(lc) c1, min(la) a0, max(la) a1 FROM q_log",
    "q_norm_raw": """
        SELECT f.*, 100 * ((lo - o0) / nullif(o1 - o0, 0)) * 0.5::DOUBLE
                  + 100 * ((la - a0) / nullif(a1 - a0, 0)) * 0.2::DOUBLE
                  + 100 * ((lc - c0) / nullif(c1 - c0, 0)) * 0.3::DOUBLE AS raw
        FROM q_feature_rank f JOIN q_log USING (item_id), q_bounds""",
}


def _final_steps(kind: str, copies: bool) -> dict[str, str]:
    extra = "" if not copies else f"""
        UNION ALL SELECT * REPLACE ('7' AS display_site) FROM q_{kind}_pushed WHERE sell_site = '1'
        UNION ALL SELECT * REPLACE ('8' AS display_site) FROM q_{kind}_pushed WHERE sell_site = '2'"""
    return {
        f"q_{kind}_total": f"""
            SELECT * EXCLUDE (raw), round(raw, 4) AS total_score,
                   row_number() OVER (ORDER BY raw DESC NULLS LAST, item_id) AS total_rank
            FROM q_{kind}_raw""",
        f"q_{kind}_pushed": f"""
            SELECT * EXCLUDE (site_no), site_no AS sell_site, '9' AS display_site,
                   row_number() OVER (ORDER BY total_rank + CASE WHEN event = 'Y' THEN 100 ELSE 0 END,
                                      total_score DESC, item_id) AS pushed_rank
            FROM q_{kind}_total""",
        f"q_{kind}_shown": f"""
            SELECT * FROM q_{kind}_pushed
            UNION ALL SELECT * REPLACE (sell_site AS display_site) FROM q_{kind}_pushed{extra}""",
        f"q_{kind}_site": f"""
            SELECT *, row_number() OVER (PARTITION BY display_site
                                         ORDER BY pushed_rank, total_score DESC, item_id, sell_site) AS site_rank
            FROM q_{kind}_shown""",
        f"q_{kind}_final": f"""
            SELECT *, row_number() OVER (PARTITION BY display_site
                ORDER BY site_rank + CASE item_id WHEN 17 THEN 50 WHEN 34 THEN 300 ELSE 0 END,
                         total_score DESC, item_id, sell_site) AS final_rank
            FROM q_{kind}_site""",
        f"q_{kind}_product": f"""
            SELECT strftime(DATE '2001-08-03', '%y%m%d') AS score_date, display_site, sell_site, item_id, brand_id,
                   origin_id, new_item,
                   CAST(CASE WHEN display_site = '2' AND medium_id = 'VALUE' THEN 123456 ELSE 0 END AS INTEGER) AS mark,
                   CASE WHEN display_site = '2' AND medium_id = 'VALUE' THEN round(10000.0::DOUBLE / final_rank, 4) * 4
                        ELSE round(10000.0::DOUBLE / final_rank, 4) END AS score
            FROM q_{kind}_final JOIN v_category USING (category_id)
            WHERE display_site = '9' OR in_use = 'Y'""",
    }


_STEPS.update(_final_steps("plain", False))
_STEPS.update(_final_steps("norm", True))

_STEPS.update(
    {
        "q_member": """
            SELECT member_id, max(gender) AS gender, max(age_band) AS age_band FROM v_member
            WHERE NOT (gender = '' AND age_band = '') GROUP BY member_id""",
        "q_order_demo": """
            SELECT o.*, m.gender, m.age_band FROM v_order_line o LEFT JOIN q_member m ON o.member_id = m.member_id""",
        "q_click_demo": """
            SELECT DISTINCT item_id, ip, CASE WHEN site_no = '4' THEN '3' ELSE site_no END AS site_no, gender, age_band
            FROM v_click""",
        "q_demo_counts": f"""
            SELECT item_id, site_no, gender, age_band, CAST(sum(o) AS BIGINT) AS order_count,
                   CAST(sum(c) AS BIGINT) AS click_count, CAST(sum(a) AS BIGINT) AS amount
            FROM (SELECT item_id, site_no, gender, age_band, count(DISTINCT order_no) AS o, sum({_NET}) AS a, NULL AS c
                  FROM q_order_demo GROUP BY ALL
                  UNION ALL
                  SELECT item_id, site_no, gender, age_band, 0, 0, count(*)
                  FROM q_click_demo WHERE (item_id, site_no) IN (SELECT item_id, site_no FROM v_price) GROUP BY ALL)
            GROUP BY ALL""",
        "q_segment": """
            SELECT b.*, CASE WHEN e.item_id IS NULL THEN 'N' ELSE 'Y' END AS event
            FROM (SELECT item_id, gender, age_band, max(site_no) AS site_no, max(brand_id) AS brand_id,
                         coalesce(sum(order_count), 0) AS order_count, coalesce(sum(click_count), 0) AS click_count,
                         coalesce(CASE WHEN sum(amount) < 0 THEN 0 ELSE sum(amount) END, 0) AS amount
                  FROM (SELECT item_id, '' AS gender, '' AS age_band, site_no, brand_id, NULL AS order_count,
                               NULL AS click_count, NULL AS amount FROM q_items
                        UNION ALL
                        SELECT item_id, gender, age_band, site_no, '', order_count, click_count, amount
                        FROM q_demo_counts WHERE (item_id, site_no) IN (SELECT item_id, site_no FROM q_items))
                  GROUP BY item_id, gender, age_band
                  HAVING count(order_count) > 0 OR count(click_count) > 0) b
            LEFT JOIN v_event_item e ON b.item_id = e.item_id""",
        "q_cube": """
            SELECT 'age_gender' AS "grouping", item_id, gender, age_band, site_no, brand_id, event,
                   CAST(order_count AS BIGINT) AS order_count, CAST(click_count AS BIGINT) AS click_count,
                   CAST(amount AS BIGINT) AS amount
            FROM q_segment WHERE gender <> '' AND age_band <> ''
            UNION ALL
            SELECT 'gender', item_id, gender, '', max(site_no), max(brand_id), max(event), CAST(sum(order_count) AS BIGINT),
                   CAST(sum(click_count) AS BIGINT), CAST(sum(amount) AS BIGINT)
            FROM q_segment WHERE gender <> '' GROUP BY item_id, gender
            UNION ALL
            SELECT 'age', item_id, '', age_band, max(site_no), max(brand_id), max(event), CAST(sum(order_count) AS BIGINT),
                   CAST(sum(click_count) AS BIGINT), CAST(sum(amount) AS BIGINT)
            FROM q_segment WHERE age_band <> '' GROUP BY item_id, age_band
            UNION ALL
            SELECT 'all', item_id, '', '', max(site_no), max(brand_id), max(event), CAST(sum(order_count) AS BIGINT),
                   CAST(sum(click_count) AS BIGINT), CAST(sum(amount) AS BIGINT)
            FROM q_segment GROUP BY item_id""",
        "q_cube_log": """
            SELECT *, CASE WHEN order_count > 0 THEN log10(order_count) ELSE 0 END AS lo,
                   CASE WHEN click_count > 0 THEN log10(click_count) ELSE 0 END AS lc,
                   CASE WHEN amount > 0 THEN log10(amount) ELSE 0 END AS la FROM q_cube""",
        "q_cube_bounds": """
            SELECT "grouping" AS g, min(lo) o0, max(lo) o1, min(lc) c0, max(lc) c1, min(la) a0, max(la) a1
            FROM q_cube_log GROUP BY "grouping" """,
        "q_seg_score": """
            SELECT q_cube_log.*, round(100 * ((lo - o0) / nullif(o1 - o0, 0)) * 0.5::DOUBLE
                   + 100 * ((la - a0) / nullif(a1 - a0, 0)) * 0.2::DOUBLE
                   + 100 * ((lc - c0) / nullif(c1 - c0, 0)) * 0.3::DOUBLE, 4) AS total_score
            FROM q_cube_log, q_cube_bounds WHERE g = 'all'""",
        "q_seg_shown": """
            SELECT *, site_no AS display_site, site_no AS sell_site FROM q_seg_score
            UNION ALL SELECT *, '7', site_no FROM q_seg_score WHERE site_no = '1'
            UNION ALL SELECT *, '8', site_no FROM q_seg_score WHERE site_no = '2'""",
        "q_seg_rank": """
            SELECT *, row_number() OVER (PARTITION BY display_site, "grouping", gender, age_band
                                         ORDER BY r + CASE WHEN event = 'Y' THEN 110 ELSE 0 END, item_id, sell_site) AS fr
            FROM (SELECT *, row_number() OVER (PARTITION BY display_site, "grouping", gender, age_band
                                               ORDER BY total_score DESC, item_id, sell_site) AS r FROM q_seg_shown)
            WHERE r <= 200""",
    }
)


def _sql(body: str) -> str:
    return with_views(body, _STEPS)


_RANKS = ", ".join(RANK_COLUMNS)
_WIDE = ", ".join(
    f"coalesce(max(CASE WHEN age_band = '{code}' AND gender = '{g}' THEN round(10000.0::DOUBLE / fr, 4) END), 0) AS {age}_{who}"
    for code, age in [*sg.AGE_BANDS.items(), ("", "all_ages")]
    for g, who in [*sg.GENDERS.items(), ("", "all")]
)

SQL = {
    "best_rank_items": _sql("SELECT * FROM q_items"),
    "best_rank_clicks": _sql("SELECT * FROM q_clicks"),
    "best_rank_counts": _sql("SELECT * FROM q_counts"),
    "best_rank_frame": _sql("SELECT * FROM q_frame"),
    "best_rank_reciprocal": _sql(f"SELECT {_RANKS} FROM q_plain_final"),
    "best_rank_norm": _sql(f"SELECT {_RANKS} FROM q_norm_final"),
    "product_list": _sql("SELECT * FROM q_norm_product ORDER BY score DESC, item_id, display_site, sell_site LIMIT 300000"),
    "product_list_top": _sql("SELECT * FROM q_norm_product ORDER BY score DESC, item_id, display_site, sell_site LIMIT 500"),
    "final_products": _sql(
        "SELECT * FROM (SELECT * FROM q_plain_product ORDER BY score DESC, item_id, display_site, sell_site LIMIT 300000)"
        " WHERE display_site = '9' UNION ALL"
        " SELECT * FROM (SELECT * FROM q_norm_product ORDER BY score DESC, item_id, display_site, sell_site LIMIT 300000)"
        " WHERE display_site <> '9'"
    ),
    "unique_members": _sql("SELECT * FROM q_member"),
    "orders_demo": _sql("SELECT order_no, line_no, member_id, gender, age_band FROM q_order_demo"),
    "segment_counts": _sql("SELECT * FROM q_demo_counts"),
    "segment_cube": _sql("SELECT * FROM q_cube"),
    "segment_score": _sql('SELECT "grouping", item_id, gender, age_band, total_score FROM q_seg_score'),
    "segment_score_own_bounds": _sql(
        'SELECT "grouping", item_id, gender, age_band, round(100 * ((lo - o0) / nullif(o1 - o0, 0)) * 0.5::DOUBLE'
        " + 100 * ((la - a0) / nullif(a1 - a0, 0)) * 0.2::DOUBLE"
        " + 100 * ((lc - c0) / nullif(c1 - c0, 0)) * 0.3::DOUBLE, 4) AS total_score"
        ' FROM q_cube_log JOIN q_cube_bounds ON g = "grouping"'
    ),
    "segment_rank": _sql(
        'SELECT "grouping", gender, age_band, display_site, sell_site, item_id, total_score,'
        " round(10000.0::DOUBLE / fr, 4) AS score FROM q_seg_rank"
    ),
    "segment_wide": _sql(f"SELECT item_id, display_site, sell_site, {_WIDE} FROM q_seg_rank GROUP BY item_id, display_site, sell_site"),
}
