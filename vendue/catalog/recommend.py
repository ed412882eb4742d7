"""Recommendation queries over the test tables, with the same queries in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendue.checks.tables import with_views
from vendue.operators.similarity import item_similarity
from vendue.plans import recommend as rc
from vendue.session import pin
from vendue.views import ORDERS_AS_OF, Shop


def scores(shop: Shop):
    """Order lines per item as the score."""
    return shop.table("lineitem").groupBy(F.col("l_partkey").alias("item_id")).agg(
        F.count(F.lit(1)).cast("double").alias("third_score"))


def rounded(sim, digits: int = 6):
    return sim.withColumn("value", F.round("value", digits))


def llr(shop: Shop, n: int = 20, **kw):
    return item_similarity(shop.interactions(), n, **kw)


def sim_of(shop: Shop, kind: str, n: int = 20):
    pairs = shop.events().where(F.col("event_type") == kind).select("user_id", F.col("k").alias("item_id"))
    return item_similarity(pairs, n)


def categorised(shop: Shop, kind: str = "view"):
    return rc.categorise(sim_of(shop, kind), shop.items(), shop.categories(), shop.prices())


def basket_items(shop: Shop):
    return rc.basket_rows(shop.order_lines(), shop.items())


def brand_rows(shop: Shop):
    part = shop.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return shop.table("lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey").select(
        F.col("l_orderkey").alias("order_no"), F.col("p_brand").alias("item_id")).distinct()


def brand_rules(shop: Shop, by_first: bool = False):
    return rc.association_rules(brand_rows(shop), 0.0015, 0.01, by_first)


def rule_view(rules):
    return rules.select(
        "antecedent", F.concat_ws(",", "consequent").alias("consequent"),
        "support", "confidence", "lift", "conviction")


def item_rules(shop: Shop):
    return rc.pair_rules(basket_items(shop), 0.0001, 0.05)


def rule_figures(rules):
    return rules.select("antecedent", "consequent", "support", "confidence", "lift", "conviction")


def clips(shop: Shop):
    items, score = shop.items(), scores(shop)
    return (
        rc.brand_new(items, score, ORDERS_AS_OF)
        .unionByName(rc.brand_top(items, score))
        .unionByName(rc.related_brands(items, llr(shop)))
    )


def ranked_lists(shop: Shop, key: str):
    from vendue.operators.ranking import top_n_per_group

    sold = shop.prices().select("item_id", "site_no").distinct()
    rows = shop.items().select("item_id", key).join(scores(shop), "item_id").join(sold, "item_id")
    best = top_n_per_group(rows, [key, "site_no"], [("third_score", "desc"), ("item_id", "asc")], 30, "rank")
    return best.select(key, "site_no", F.col("item_id").alias("candidate"), "rank")


def cascade(shop: Shop, limit: int = 30, sites: list[str] | None = None):
    sold = shop.prices().select(F.col("item_id").alias("similar_id"), "site_no").distinct()
    similar = llr(shop).join(sold, "similar_id").select("item_id", "site_no", F.col("similar_id").alias("candidate"), "rank")
    items = shop.items()
    return rc.recommend_cascade(
        [
            ("itembase", similar),
            ("category", rc.list_for_items(items, ranked_lists(shop, "category_id"), "category_id", limit, sites, over_sites=True)),
            ("brand", rc.list_for_items(items, ranked_lists(shop, "brand_id"), "brand_id", limit, sites, over_sites=True)),
        ],
        limit,
        sites,
    )


def some_sites(shop: Shop) -> list[str]:
    """The first two sites; a shop has a handful."""
    return [r[0] for r in shop.prices().select("site_no").distinct().orderBy("site_no").limit(2).collect()]


def order_state(shop: Shop):
    return shop.order_lines().groupBy("member_id", "site_no").agg(
        F.countDistinct("order_no").alias("order_count"))


def new_orders(shop: Shop):
    return shop.order_lines().where(F.col("member_id") % 3 == 0).select(
        (F.col("member_id") * 2).alias("member_id"), "site_no").distinct()


def prediction(shop: Shop):
    return rc.predict_item_based(llr(shop, None), shop.ratings()).withColumn("prediction", F.round("prediction", 4))


def item_based_error(shop: Shop):
    def fit(known, held):
        asked = known.join(held.select("user_id").distinct(), "user_id", "left_semi")
        sim = item_similarity(known.select("user_id", "item_id"), None, items=asked.select("item_id"))
        return rc.predict_item_based(sim, asked, held)

    return rc.evaluate_mae(pin(shop.ratings()), fit)


def factorised_error(shop: Shop):
    def fit(known, held):
        model = rc.als_model(known)
        keys = held.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"))
        return model.transform(keys).select(
            F.col("user_id").cast("bigint"), F.col("item_id").cast("bigint"), "prediction")

    return rc.evaluate_mae(shop.ratings(), fit)


QUERIES = {
    "basket_rows": basket_items,
    "baskets": lambda s: rc.baskets(s.order_lines(), s.items()),
    "item_frequency": lambda s: rc.item_frequency(basket_items(s)),
    "map_ids": lambda s: rc.map_ids(
        s.offline_sales(), s.offline_map(), "offline_item_id").groupBy("item_id").agg(F.count(F.lit(1)).alias("n")),
    "pair_rules": lambda s: rule_figures(item_rules(s)),
    "rules_for": lambda s: rule_figures(rc.rules_for(s.event_items(), item_rules(s))),
    "fp_growth_rules": lambda s: rule_view(brand_rules(s)),
    "fp_growth_rules_by_first": lambda s: rule_view(brand_rules(s, True)),
    "rule_lines": lambda s: rc.rule_lines(brand_rules(s)),
    "index_users": lambda s: rc.index_users(s.clicks().select("visitor_id").distinct(), "visitor_id"),
    "interactions": lambda s: rc.interactions(
        s.clicks().withColumn("hour", F.date_trunc("hour", "ts")), "visitor_id", "item_id", "hour"),
    "item_similarity": lambda s: rounded(llr(s)),
    "item_similarity_large_users": lambda s: rounded(llr(s, slice_items=13)),
    "item_similarity_tanimoto": lambda s: rounded(llr(s, measure="tanimoto")),
    "item_similarity_pearson": lambda s: rounded(item_similarity(s.ratings(), 20, "pearson")),
    "item_similarity_euclidean": lambda s: rounded(item_similarity(s.ratings(), 20, "euclidean")),
    "predict_item_based": prediction,
    "categorise": lambda s: rounded(categorised(s)),
    "blend_scores": lambda s: rounded(rc.blend_scores(categorised(s, "view"), categorised(s, "click"))),
    "similar_top": lambda s: rc.similar_top(categorised(s), 3),
    "category_best": lambda s: rc.category_best(s.categories(), s.items(), scores(s)),
    "brand_best": lambda s: rc.brand_best(s.brands(), s.items(), scores(s)),
    "brand_top": lambda s: rc.brand_top(s.items(), scores(s)),
    "brand_new": lambda s: rc.brand_new(s.items(), scores(s), ORDERS_AS_OF),
    "related_brands": lambda s: rc.related_brands(s.items(), llr(s)),
    "clip_lists": lambda s: rc.clip_lists(clips(s)).select(
        "brand_id", "entry_count",
        F.concat_ws(";", F.transform("entries", lambda e: F.concat_ws(":", e["kind"], e["rank"], e["id"]))).alias("entries")),
    "recommend_cascade": cascade,
    "recommend_cascade_sites": lambda s: cascade(s, 10, some_sites(s)),
    "member_orders": lambda s: rc.member_orders(order_state(s)),
    "add_orders": lambda s: rc.add_orders(order_state(s), new_orders(s)),
    "item_master": lambda s: rc.item_master(s.items()),
    "als_recommend": lambda s: rc.als_recommend(s.ratings()),
    "evaluate_mae": item_based_error,
    "evaluate_mae_factorised": factorised_error,
}


def _llr(k11: str, a: str, b: str, n: str) -> str:
    def x(v: str) -> str:
        return f"(CASE WHEN {v} > 0 THEN CAST({v} AS DOUBLE) * ln({v}) ELSE 0 END)"

    k12, k21, k22 = f"({a} - {k11})", f"({b} - {k11})", f"({n} - {a} - {b} + {k11})"
    rows = f"({x(n)} - {x(a)} - {x(f'({n} - {a})')})"
    cols = f"({x(n)} - {x(b)} - {x(f'({n} - {b})')})"
    cells = f"({x(n)} - {x(k11)} - {x(k12)} - {x(k21)} - {x(k22)})"
    return f"1 - 1 / (1 + greatest(2 * ({rows} + {cols} - {cells}), 0))"


def _sim(kind: str) -> dict[str, str]:
    p = f"r_{kind}"
    return {
        f"{p}_held": f"SELECT DISTINCT user_id, k AS item_id FROM v_event WHERE event_type = '{kind}'",
        f"{p}_n": f"SELECT item_id, count(*) AS n FROM {p}_held GROUP BY item_id",
        f"{p}_pair": f"""
            SELECT a.item_id, b.item_id AS similar_id, count(*) AS k11, any_value(c.n) AS na, any_value(d.n) AS nb,
                   (SELECT count(DISTINCT user_id) FROM {p}_held) AS users
            FROM {p}_held a JOIN {p}_held b ON a.user_id = b.user_id AND a.item_id <> b.item_id
            JOIN {p}_n c ON a.item_id = c.item_id JOIN {p}_n d ON b.item_id = d.item_id
            GROUP BY a.item_id, b.item_id""",
        f"{p}_sim": f"SELECT item_id, similar_id, {_llr('k11', 'na', 'nb', 'users')} AS value FROM {p}_pair",
        f"{p}_top": f"""
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY value DESC, similar_id) AS rank FROM {p}_sim
            QUALIFY rank <= 20""",
        f"{p}_cat": f"""
            SELECT s.item_id, s.similar_id, p.site_no, s.value,
                   ca.large_id || '^' || ca.medium_id || '^' || ca.small_id || '^' || ca.category_name AS category_path,
                   cb.large_id || '^' || cb.medium_id || '^' || cb.small_id || '^' || cb.category_name AS similar_category_path
            FROM {p}_top s
            JOIN v_item a ON s.item_id = a.item_id AND a.searchable = 'Y' JOIN v_category ca ON a.category_id = ca.category_id
            JOIN v_item b ON s.similar_id = b.item_id AND b.searchable = 'Y' JOIN v_category cb ON b.category_id = cb.category_id
            JOIN (SELECT DISTINCT item_id, site_no FROM v_price) p ON s.similar_id = p.item_id
            WHERE ca.small_id = cb.small_id""",
    }


def _ranked(key: str) -> str:
    return f"""
        SELECT {key}, site_no, item_id AS candidate,
               row_number() OVER (PARTITION BY {key}, site_no ORDER BY third_score DESC, item_id) AS rank
        FROM v_item JOIN r_score USING (item_id) JOIN r_sold USING (item_id) QUALIFY rank <= 30"""


_STEPS = {
    **_sim("view"),
    **_sim("click"),
    "r_sold": "SELECT DISTINCT item_id, site_no FROM v_price",
    "r_score": "SELECT l_partkey AS item_id, CAST(count(*) AS DOUBLE) AS third_score FROM lineitem GROUP BY l_partkey",
    "r_basket": """
        SELECT DISTINCT order_no, item_id FROM v_order_line JOIN v_item USING (item_id)
        WHERE sell_type IN (10, 20) AND sell_status = 20""",
    "r_freq": "SELECT item_id, count(*) AS n FROM r_basket GROUP BY item_id",
    "r_total": "SELECT count(DISTINCT order_no) AS t FROM r_basket",
    "r_rule": """
        SELECT antecedent, consequent, n / t AS support, n / a AS confidence,
               n * t / (CAST(a AS DOUBLE) * b) AS lift,
               (1 - b / t) / nullif(1 - n / a, 0) AS conviction
        FROM (SELECT x.item_id AS antecedent, y.item_id AS consequent, CAST(count(*) AS DOUBLE) AS n,
                     any_value(p.n) AS a, any_value(q.n) AS b
              FROM r_basket x JOIN r_basket y ON x.order_no = y.order_no AND x.item_id <> y.item_id
              JOIN r_freq p ON x.item_id = p.item_id JOIN r_freq q ON y.item_id = q.item_id
              GROUP BY x.item_id, y.item_id), r_total
        WHERE n > 0.0001 * t AND n / a > 0.05""",
    "b_row": "SELECT DISTINCT l_orderkey AS o, p_brand AS b FROM lineitem JOIN part ON l_partkey = p_partkey",
    "b_total": "SELECT CAST(count(DISTINCT o) AS DOUBLE) AS t FROM b_row",
    # every subset of every order, by adding larger brands one at a time
    "b_subset": """
        SELECT o, [b] AS s, b AS last FROM b_row
        UNION ALL SELECT e.o, list_append(e.s, r.b), r.b FROM b_subset e JOIN b_row r ON e.o = r.o AND r.b > e.last""",
    "b_set": "SELECT s, count(*) AS n FROM b_subset GROUP BY s",
    "b_open": """
        SELECT s, n, unnest(s) AS a FROM b_set, b_total WHERE n > 0.0015 * t AND len(s) > 1""",
    "b_rule": """
        SELECT r.a AS antecedent, list_filter(r.s, lambda v: v <> r.a) AS c, r.n, p.n AS na
        FROM b_open r JOIN b_set p ON p.s = [r.a]""",
    "b_figures": """
        SELECT antecedent, c, array_to_string(c, ',') AS consequent, r.n / t AS support, CAST(r.n AS DOUBLE) / na AS confidence,
               (r.n * t) / (CAST(na AS DOUBLE) * q.n) AS lift,
               (1 - q.n / t) / nullif(1 - CAST(r.n AS DOUBLE) / na, 0) AS conviction
        FROM b_rule r JOIN b_set q ON q.s = r.c, b_total WHERE CAST(r.n AS DOUBLE) / na > 0.01""",
    "b_first": """
        SELECT antecedent, array_to_string(c, ',') AS consequent, r.n / t AS support, CAST(r.n AS DOUBLE) / na AS confidence,
               (r.n * t) / (CAST(na AS DOUBLE) * q.n) AS lift,
               (1 - q.n / t) / nullif(1 - CAST(r.n AS DOUBLE) / na, 0) AS conviction
        FROM b_rule r JOIN b_set q ON q.s = [r.c[1]], b_total WHERE CAST(r.n AS DOUBLE) / na > 0.01""",
    "r_rating": "SELECT user_id, k AS item_id, avg(value) AS rating FROM v_event GROUP BY user_id, k",
    "r_best": """
        SELECT brand_id, 'best' AS kind, CAST(item_id AS VARCHAR) AS id,
               row_number() OVER (PARTITION BY brand_id ORDER BY third_score DESC, item_id) AS rank
        FROM v_item JOIN r_score USING (item_id) WHERE sell_status = 20 QUALIFY rank <= 30""",
    "r_new": """
        SELECT brand_id, 'new' AS kind, CAST(item_id AS VARCHAR) AS id,
               row_number() OVER (PARTITION BY brand_id ORDER BY third_score DESC, shown_from DESC, item_id) AS rank
        FROM v_item JOIN r_score USING (item_id)
        WHERE sell_status = 20 AND DATE '2001-08-02' - shown_from BETWEEN 0 AND 31 QUALIFY rank <= 30""",
    "r_brand": """
        SELECT brand_id, 'brand' AS kind, other AS id,
               row_number() OVER (PARTITION BY brand_id ORDER BY n DESC, other) AS rank
        FROM (SELECT i.brand_id, c.other, max(c.n) AS n
              FROM (SELECT s.item_id, b.brand_id AS other, count(*) AS n
                    FROM r_view_top s JOIN v_item b ON s.similar_id = b.item_id GROUP BY s.item_id, b.brand_id) c
              JOIN v_item i ON c.item_id = i.item_id WHERE i.brand_id <> c.other GROUP BY i.brand_id, c.other)
        QUALIFY rank <= 20""",
    "r_clip": "SELECT * FROM r_new UNION ALL SELECT * FROM r_best UNION ALL SELECT * FROM r_brand",
    "r_in_category": _ranked("category_id"),
    "r_in_brand": _ranked("brand_id"),
    "r_source": """
        SELECT t.item_id, site_no, similar_id AS candidate, 0 AS src, rank, 'itembase' AS source
        FROM r_view_top t JOIN r_sold d ON t.similar_id = d.item_id
        UNION ALL SELECT i.item_id, site_no, candidate, 1, rank, 'category' FROM v_item i JOIN r_in_category c ON i.category_id = c.category_id
        UNION ALL SELECT i.item_id, site_no, candidate, 2, rank, 'brand' FROM v_item i JOIN r_in_brand b ON i.brand_id = b.brand_id""",
    "r_state": "SELECT member_id, site_no, count(DISTINCT order_no) AS order_count FROM v_order_line GROUP BY member_id, site_no",
}


def _sql(body: str) -> str:
    return with_views(body, _STEPS)


def _cascade(limit: int, where: str = "") -> str:
    return f"""
        SELECT item_id, site_no, candidate, source,
               row_number() OVER (PARTITION BY item_id ORDER BY src, rank, candidate, site_no) AS position
        FROM (SELECT * FROM r_source {where} QUALIFY row_number() OVER (PARTITION BY item_id, site_no, candidate ORDER BY src) = 1)
        QUALIFY position <= {limit}"""


_FIGURES = "support, confidence, lift, conviction"
_TOP = "SELECT item_id, similar_id, round(value, 6) AS value, rank FROM r_view_top"

SQL = {
    "basket_rows": _sql("SELECT * FROM r_basket"),
    "baskets": _sql("""
        SELECT order_no, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items,
               CAST(sum(n) AS BIGINT) AS line_count
        FROM (SELECT order_no, item_id, count(*) AS n FROM v_order_line JOIN v_item USING (item_id)
              WHERE sell_type IN (10, 20) AND sell_status = 20 GROUP BY order_no, item_id)
        GROUP BY order_no"""),
    "item_frequency": _sql("SELECT item_id, n AS frequency FROM r_freq"),
    "map_ids": _sql("SELECT item_id, count(*) AS n FROM v_offline_sale JOIN v_offline_map USING (offline_item_id) GROUP BY item_id"),
    "pair_rules": _sql("SELECT * FROM r_rule"),
    "rules_for": _sql("SELECT * FROM r_rule WHERE antecedent IN (SELECT item_id FROM v_event_item)"),
    "fp_growth_rules": _sql(f"SELECT antecedent, consequent, {_FIGURES} FROM b_figures"),
    "fp_growth_rules_by_first": _sql(f"SELECT antecedent, consequent, {_FIGURES} FROM b_first"),
    "rule_lines": _sql("""
        SELECT antecedent || '|' || x || '|' || printf('%.7f', support) || '|' || printf('%.7f', confidence)
               || '|' || printf('%.7f', lift) AS value
        FROM (SELECT *, unnest(c) AS x FROM b_figures)"""),
    "index_users": _sql("""
        SELECT visitor_id, dense_rank() OVER (ORDER BY visitor_id) - 1 AS user_index
        FROM (SELECT DISTINCT visitor_id FROM v_click)"""),
    "interactions": _sql("""
        SELECT dense_rank() OVER (ORDER BY visitor_id) - 1 AS user_index, item_id, n AS cnt, hour
        FROM (SELECT visitor_id, item_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM v_click GROUP BY ALL)"""),
    "item_similarity": _sql(_TOP),
    "item_similarity_large_users": _sql(_TOP),
    "item_similarity_tanimoto": _sql("""
        SELECT item_id, similar_id, round(v, 6) AS value, row_number() OVER (PARTITION BY item_id ORDER BY v DESC, similar_id) AS rank
        FROM (SELECT item_id, similar_id, CAST(k11 AS DOUBLE) / (na + nb - k11) AS v FROM r_view_pair) QUALIFY rank <= 20"""),
    "item_similarity_pearson": _sql("""
        SELECT item_id, similar_id, round(v, 6) AS value, row_number() OVER (PARTITION BY item_id ORDER BY v DESC, similar_id) AS rank
        FROM (SELECT a.item_id, b.item_id AS similar_id, round(corr(a.rating, b.rating), 9) AS v
              FROM r_rating a JOIN r_rating b ON a.user_id = b.user_id AND a.item_id <> b.item_id
              GROUP BY a.item_id, b.item_id HAVING count(*) > 1)
        WHERE v IS NOT NULL AND NOT isnan(v) QUALIFY rank <= 20"""),
    "item_similarity_euclidean": _sql("""
        SELECT item_id, similar_id, round(v, 6) AS value, row_number() OVER (PARTITION BY item_id ORDER BY v DESC, similar_id) AS rank
        FROM (SELECT a.item_id, b.item_id AS similar_id,
                     round(1 / (1 + sqrt(sum((a.rating - b.rating) * (a.rating - b.rating))) / sqrt(count(*))), 9) AS v
              FROM r_rating a JOIN r_rating b ON a.user_id = b.user_id AND a.item_id <> b.item_id
              GROUP BY a.item_id, b.item_id)
        QUALIFY rank <= 20"""),
    "predict_item_based": _sql("""
        SELECT user_id, s.similar_id AS item_id, round(sum(value * rating) / nullif(sum(value), 0), 4) AS prediction
        FROM r_rating r JOIN r_view_sim s ON r.item_id = s.item_id
        WHERE (user_id, s.similar_id) NOT IN (SELECT (user_id, item_id) FROM r_rating)
        GROUP BY user_id, s.similar_id"""),
    "categorise": _sql("SELECT * REPLACE (round(value, 6) AS value) FROM r_view_cat"),
    "blend_scores": _sql("""
        SELECT coalesce(a.item_id, b.item_id) AS item_id, coalesce(a.similar_id, b.similar_id) AS similar_id,
               coalesce(a.site_no, b.site_no) AS site_no,
               round(CASE WHEN a.value IS NOT NULL AND b.value IS NOT NULL THEN (a.value + b.value) / 2
                          ELSE coalesce(a.value, b.value) END, 6) AS value,
               coalesce(a.category_path, b.category_path) AS category_path,
               coalesce(a.similar_category_path, b.similar_category_path) AS similar_category_path
        FROM r_view_cat a FULL JOIN r_click_cat b
        ON a.item_id = b.item_id AND a.similar_id = b.similar_id AND a.site_no = b.site_no"""),
    "similar_top": _sql("""
        SELECT item_id, site_no, similar_id, row_number() OVER (PARTITION BY item_id, site_no ORDER BY value DESC, similar_id) AS rank
        FROM r_view_cat QUALIFY rank <= 3"""),
    "category_best": _sql("""
        SELECT category_id, item_id, third_score, category_name FROM v_item JOIN r_score USING (item_id)
        JOIN v_category USING (category_id) WHERE in_use = 'Y'"""),
    "brand_best": _sql("""
        SELECT brand_id, item_id, third_score, brand_name FROM v_item JOIN r_score USING (item_id)
        JOIN v_brand USING (brand_id) WHERE in_use = 'Y'"""),
    "brand_top": _sql("SELECT * FROM r_best"),
    "brand_new": _sql("SELECT * FROM r_new"),
    "related_brands": _sql("SELECT * FROM r_brand"),
    "clip_lists": _sql("""
        SELECT brand_id, count(*) AS entry_count,
               string_agg(kind || ':' || CAST(rank AS VARCHAR) || ':' || id, ';' ORDER BY kind, rank, id) AS entries
        FROM r_clip WHERE rank <= 10 GROUP BY brand_id"""),
    "recommend_cascade": _sql(_cascade(30)),
    "recommend_cascade_sites": _sql(_cascade(10, "WHERE site_no IN (SELECT site_no FROM r_sold GROUP BY ALL ORDER BY site_no LIMIT 2)")),
    "member_orders": _sql("""
        SELECT member_id, site_no, order_count FROM r_state
        UNION ALL SELECT member_id, 'TOTAL', CAST(sum(order_count) AS BIGINT) FROM r_state GROUP BY member_id"""),
    "add_orders": _sql("""
        SELECT member_id, site_no, CAST(sum(order_count) AS BIGINT) AS order_count
        FROM (SELECT * FROM r_state UNION ALL
              SELECT DISTINCT member_id * 2, site_no, 1 FROM v_order_line WHERE member_id % 3 = 0)
        GROUP BY member_id, site_no"""),
    "item_master": _sql("SELECT item_id, brand_id, category_id FROM v_item"),
}
