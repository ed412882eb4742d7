"""Readers, single operators and streams over the test tables, with the same results in SQL."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.checks.tables import with_views
from vendue.functions import dates, pages, scoring, text
from vendue.operators import ranking, relational
from vendue.session import ensure_checkpoint_dir
from vendue.sinks.tables import Store
from vendue.sources import shop as src
from vendue.sources.delimited import parse_lines
from vendue.sources.window import RunWindow
from vendue.streaming.ads import ad_counters_stream, sliding_stream
from vendue.streaming.micro import read_stream
from vendue.views import EVENTS_AS_OF, ORDERS_AS_OF, Shop


def lines(df: DataFrame, sep: str, width: int, fields: dict[int, Column], quote: bool = False) -> DataFrame:
    """Text lines with the given fields by position; the other positions are empty."""
    parts = [F.coalesce(fields[i].cast("string"), F.lit("")) if i in fields else F.lit("") for i in range(width)]
    line = F.concat_ws(sep, *parts)
    return df.select((F.concat(F.lit('"'), line, F.lit('"')) if quote else line).alias("value"))


def item_lines(s: Shop) -> DataFrame:
    c = F.col
    rows = lines(
        s.items(), '"|"', 35,
        {0: c("item_id"), 8: c("brand_id"), 9: c("sell_status"), 14: c("origin_id"), 15: c("category_id"),
         16: c("sell_type"), 17: c("sell_type_detail"), 21: F.concat(c("shown_from"), F.lit(" 00:00:00")),
         31: c("registered"), 33: c("new_flag"), 34: c("searchable")},
        quote=True,
    )
    # a header, and lines that are too short
    noise = s.items().where(c("item_id") % 50 == 0).select(
        F.when(c("item_id") % 100 == 0, F.lit('"ITEM_ID' + '"|"x' * 34 + '"')).otherwise(F.lit('"1"|"2"')).alias("value"))
    return rows.unionByName(noise)


def event_lines(s: Shop) -> DataFrame:
    """Events as 65-field log lines."""
    k, user, kind = F.col("k"), F.col("user_id"), F.col("event_type")
    url = (
        F.when(kind == "view", "/item/itemView.ssg?x=1").when(kind == "click", "/item/appItemLayer.ssg")
        .when(kind == "error", "").otherwise("/main.ssg")
    )
    return lines(
        s.events(), "\t", 65,
        {0: F.unix_millis(F.col("ts").cast("timestamp")), 2: F.concat(F.lit(" ip"), user % 40), 4: url, 6: (k % 5).cast("string"),
         7: F.when(k % 10 == 0, F.concat(F.lit("x"), k)).otherwise(F.lpad(k.cast("string"), 13, "0")),
         17: F.when(kind == "error", "ItemDetailX").when(kind == "signup", "Login").otherwise(""),
         18: F.lit("/search.ssg"), 22: F.when(user % 3 == 0, "App").otherwise("chrome"), 28: user, 29: user,
         34: F.when(user % 5 != 0, user), 52: user % 3, 53: user, 55: user % 2},
    )


def event_log(s: Shop) -> DataFrame:
    return parse_lines(event_lines(s), src.EVENT_LOG)


def order_item_lines(s: Shop) -> DataFrame:
    c = F.col
    return lines(
        s.order_lines(), "|", 93,
        {0: c("order_no"), 1: c("order_no"), 3: c("line_kind"), 5: c("order_date"), 9: c("target_code"),
         19: F.lpad(c("item_id").cast("string"), 13, "0"), 24: c("site_no"), 25: c("member_id"), 32: c("qty"),
         41: F.when(c("item_id") % 2 == 0, "Z~1").otherwise(" 5 "), 42: c("amount"), 47: c("own_discount"),
         48: F.when(c("line_no") == 7, "bad").otherwise(c("partner_discount").cast("string")),
         92: c("order_date")},
    )


def member_lines(s: Shop) -> DataFrame:
    key = F.col("c_custkey")
    return lines(
        s.table("customer"), "\t", 37,
        {0: key, 1: F.lit("10"), 3: F.lit("20"), 12: F.when(key % 3 == 0, "*10").when(key % 3 == 1, "20").otherwise("*"),
         14: F.when(key % 11 == 0, "19").otherwise(F.concat((F.lit(1890) + key % 115).cast("string"), F.lit("0101")))},
    )


def attribution_lines(s: Shop) -> DataFrame:
    k, user = F.col("k"), F.col("user_id")
    return lines(
        s.events().where(F.col("event_type") == "purchase"), "\t", 71,
        {1: F.lpad(k.cast("string"), 13, "0"), 7: F.unix_millis(F.col("ts").cast("timestamp")), 11: F.lit("/main.ssg"),
         27: F.when(user % 3 == 0, "10").otherwise("20"), 29: F.when(user % 2 == 0, "UPLUS").otherwise("safari")},
    )


def scratch(s: Shop) -> str:
    return f"{ensure_checkpoint_dir(s.spark)}/{uuid.uuid4().hex}"


def upserted(s: Shop) -> DataFrame:
    """Scores of even items loaded, then all items of the first brands upserted."""
    store = Store(s.spark, scratch(s))
    part = s.table("part").select(F.col("p_partkey").alias("item_id"), "p_brand", F.col("p_size").alias("score"))
    store.replace("best", part.where(F.col("item_id") % 2 == 0).withColumn(
        "load_ts", F.lit(datetime(2024, 1, 1)).cast("timestamp")))
    more = part.where(F.col("p_brand") < "Brand#2").withColumn("score", F.col("score") + 100)
    store.upsert("best", more, ["item_id"], datetime(2024, 1, 2))
    store.copy("best", "best_copy")
    return store.read("best_copy").drop("load_ts")


def published(s: Shop) -> DataFrame:
    store = Store(s.spark, scratch(s))
    store.publish_items(s.items().where(F.col("item_id") < 0))
    store.publish_items(s.items())
    return store.read("item", ["item_id", "brand_id", "category_id"])


def streamed_counters(s: Shop) -> DataFrame:
    """Ad counters of the events file as a stream, the newest minute and late rows included."""
    schema = s.table("events").schema
    root = scratch(s)
    stream = read_stream(s.spark, s.root, schema, pathGlobFilter="events.parquet")
    rows = Shop.ad_rows(_Over(s, stream))
    return ad_counters_stream(rows, f"{root}/out", f"{root}/state")


def streamed_windows(s: Shop) -> DataFrame:
    schema = s.table("events").schema
    root = scratch(s)
    stream = read_stream(s.spark, s.root, schema, pathGlobFilter="events.parquet")
    visits = stream.select("ts", F.col("user_id").alias("visitor_id"))
    return sliding_stream(visits, f"{root}/out", f"{root}/state").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("from_ts", "to_ts")})


class _Over(Shop):
    """The views over a stream of the events table."""

    def __init__(self, base: Shop, stream: DataFrame):
        super().__init__(base.spark, base.root)
        self.stream = stream

    def table(self, name: str) -> DataFrame:
        return self.stream if name == "events" else super().table(name)


def order_ranks(s: Shop) -> DataFrame:
    """Rank of the order count per item among its sites, and of the price over all rows."""
    counts = s.order_lines().where(F.col("line_kind") == "011").groupBy("item_id", "site_no").agg(
        F.count(F.lit(1)).alias("order_count"), F.max("unit_price").alias("price"))
    ranked = ranking.rank_in(counts, ["item_id"], [("order_count", "desc"), ("site_no", "asc")], "rank", "count_rank")
    return ranking.global_rank(
        ranked, [("price", "desc"), ("item_id", "asc"), ("site_no", "asc")], "rank", "price_rank", limit=500)


PART = [("p_size", "desc"), ("p_partkey", "asc")]
DISTRIBUTED = {"limit": 100}
_VIEW = ["visit_date", "ip", "site_no", "item_id", "visitor_id", "member_id"]

QUERIES = {
    "read_item": lambda s: parse_lines(item_lines(s), src.ITEM).drop("mobile_name", "vendor_id"),
    "read_item_views": lambda s: src.item_views(event_log(s)).select(*_VIEW),
    "read_item_views_loose": lambda s: src.item_views(event_log(s), strict_item=False).select(*_VIEW),
    "read_clicks_demo": lambda s: src.click_demo(event_log(s)).select("visitor_id", "item_id", "gender", "age_band"),
    "read_clicks_sparse": lambda s: src.click_rows(event_log(s)).select("day", "device", "url", "referrer", "item_id", "screen_code"),
    "read_page_visits": lambda s: src.page_visits(event_log(s)).select("visitor_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "url", "screen_code"),
    "read_ord_item": lambda s: parse_lines(order_item_lines(s), src.ORDER_ITEM).select(
        "order_no", "item_id", "order_date", "qty", "amount", "own_discount", "partner_discount", "original_amount"),
    "read_member_demo": lambda s: src.member_demo(parse_lines(member_lines(s), src.MEMBER_DEMO), EVENTS_AS_OF).select(
        "member_id", "gender", "age_band"),
    "read_attribution": lambda s: parse_lines(attribution_lines(s), src.ATTRIBUTION).select(
        F.to_date("ts").alias("day"), "item_id", "url",
        src.device_class(F.col("os_code") == src.PC_OS, F.col("browser")).alias("device")),
    "read_similarity": lambda s: parse_lines(
        lines(s.events(), ",", 3, {0: F.col("k"), 1: F.col("user_id"), 2: F.col("value")}), src.SIMILARITY
    ).select(text.pad_key("item_id").alias("item_id"), text.pad_key("similar_id").alias("similar_id"), "value"),
    "read_offline_map": lambda s: parse_lines(
        lines(s.offline_map(), "\\|", 3, {0: F.col("offline_item_id"), 1: F.col("business_code"), 2: F.col("item_id")}),
        src.OFFLINE_MAP),
    "read_latest_days": lambda s: src.latest_days(
        s.offline_sales().withColumnRenamed("sale_date", "dt"), RunWindow(datetime(2001, 11, 3)), want=3, max_back=10
    ).groupBy("dt").agg(F.count(F.lit(1)).alias("n")),
    "run_window_hours": lambda s: s.events().withColumns(
        {"dt": F.to_date("ts"), "hh": F.hour("ts")}
    ).where(RunWindow(datetime(2024, 1, 16, 3)).last_hours(30)).select("event_id", "dt", "hh"),
    "run_window_days": lambda s: s.events().withColumn("dt", F.to_date("ts")).where(
        RunWindow(datetime(2024, 1, 31)).listed_days([1, 2, 3, 8])).select("event_id", "dt"),
    "serving_upsert": upserted,
    "serving_swap": published,
    "ad_counters_stream": streamed_counters,
    "sliding_visits_stream": streamed_windows,
    "global_row_number": lambda s: ranking.global_rank(s.table("part"), PART).select("p_partkey", "rn"),
    "global_row_number_split": lambda s: ranking.global_rank(s.table("part"), PART, **DISTRIBUTED).select("p_partkey", "rn"),
    "global_rank": lambda s: ranking.global_rank(s.table("part"), PART, "rank").select("p_partkey", "rn"),
    "global_rank_split": lambda s: ranking.global_rank(s.table("part"), PART, "rank", **DISTRIBUTED).select("p_partkey", "rn"),
    "rank_in_split": lambda s: ranking.rank_in(s.table("part"), ["p_brand"], PART, "rank", limit=10).select("p_partkey", "rn"),
    "row_number_in_split": lambda s: ranking.rank_in(s.table("part"), ["p_type"], PART, limit=10).select("p_partkey", "rn"),
    "order_ranks": order_ranks,
    "top_k": lambda s: ranking.top_k(s.order_lines().select("order_no", "line_no", "amount"),
                                     [("amount", "desc"), ("order_no", "asc"), ("line_no", "asc")], 100),
    "top_k_large": lambda s: ranking.top_k(s.order_lines().select("order_no", "line_no", "amount"),
                                           [("amount", "desc"), ("order_no", "asc"), ("line_no", "asc")], 5000, limit=50),
    "top_n_per_group": lambda s: ranking.top_n_per_group(
        s.table("part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], PART, 3),
    "pick_max": lambda s: relational.pick_max(s.prices(), ["item_id"], ["site_no", "sell_price"]),
    "count_distinct": lambda s: relational.count_distinct(s.order_lines(), ["item_id", "site_no"], "order_no"),
    "sum_by": lambda s: relational.sum_by(s.order_lines(), ["site_no"], "amount", "amount"),
    "total": lambda s: relational.total(s.order_lines(), "amount"),
    "orders_since": lambda s: relational.orders_since(s.order_lines(), ORDERS_AS_OF.replace(year=2001, month=6)).select(
        "order_no", "line_no", "order_date"),
    "freshness": lambda s: s.items().select(
        "item_id", F.round(scoring.freshness(dates.age_days("shown_from", ORDERS_AS_OF)), 6).alias("freshness")),
    "open_weight": lambda s: s.items().select(
        "item_id", scoring.floor_weight(scoring.open_weight(dates.age_days("shown_from", ORDERS_AS_OF))).alias("weight")),
    "min_max_scale": lambda s: scoring.min_max_scale(
        scoring.log_scale(s.table("part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"]),
        ["p_size_log", "p_retailprice_log"], invert=["p_retailprice_log"],
    ).select("p_partkey", F.round("p_size_log_norm", 4).alias("size"), F.round("p_retailprice_log_norm", 4).alias("price")),
    "repair_count": lambda s: s.table("lineitem").select(
        "l_orderkey", "l_linenumber", scoring.repair_count(F.col("l_linenumber"), F.col("l_quantity")).alias("n")),
    "site_codes": lambda s: s.prices().select(
        "item_id", "store_no", text.alias_value("site_no", {"4": "3"}).alias("aliased"),
        text.map_code("site_no", {"0": "10", "1": "20"}, "").alias("coded")),
    "page_code": lambda s: s.events().select(
        "event_id",
        pages.page_code(F.col("k") % 13, F.concat(F.lit("EM_p"), F.col("k"), F.lit(" ")),
                        F.when(F.col("user_id") % 2 == 0, "mobile app").otherwise("pc")).alias("code")),
    "key_checks": lambda s: s.events().select(
        "event_id", text.valid_key(F.lpad("event_id", 13, "0")).alias("long_key"),
        text.valid_key(F.col("event_id").cast("string"), 4).alias("short_key"),
        text.present(F.when(F.col("k") % 2 == 0, "").otherwise("x")).alias("filled"),
        text.starts_with_any(F.col("k").cast("string"), ["6", "8", "9"]).alias("marked")),
    "date_parts": lambda s: s.events().select(
        "event_id", dates.epoch_date(F.unix_millis(F.col("ts").cast("timestamp"))).alias("day"), dates.minute_bucket("ts").alias("minute"),
        dates.fmt_date("ts").alias("text"), dates.age_days("ts", EVENTS_AS_OF).cast("bigint").alias("age")),
}

_STEPS = {
    "x_event": """
        SELECT *, CASE event_type WHEN 'view' THEN '/item/itemView.ssg?x=1' WHEN 'click' THEN '/item/appItemLayer.ssg'
                       WHEN 'error' THEN '' ELSE '/main.ssg' END AS url,
               CASE event_type WHEN 'error' THEN 'ItemDetailX' WHEN 'signup' THEN 'Login' ELSE '' END AS screen,
               CASE WHEN k % 10 = 0 THEN 'x' || k ELSE lpad(CAST(k AS VARCHAR), 13, '0') END AS item
        FROM v_event""",
    "x_view": """
        SELECT CAST(ts AS DATE) AS visit_date, 'ip' || CAST(user_id % 40 AS VARCHAR) AS ip, CAST(k % 5 AS VARCHAR) AS site_no,
               item AS item_id, CAST(user_id AS VARCHAR) AS visitor_id,
               CASE WHEN user_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS member_id
        FROM x_event WHERE event_type IN ('view', 'error')""",
    "x_order_rank": """
        SELECT item_id, site_no, count(*) AS order_count, max(unit_price) AS price
        FROM v_order_line WHERE line_kind = '011' GROUP BY item_id, site_no""",
}


def _sql(body: str) -> str:
    return with_views(body, _STEPS)


def _counters(extra: str) -> str:
    return f"""
        SELECT date_trunc('minute', ts) AS minute, site_no, media_code, global_id, area_id, unit_code, account_id,
               bid_id, target_id, extension_code,
               count(*) FILTER (type = 'pv') AS pv_count, count(*) FILTER (type = 'click') AS click_count,
               count(*) FILTER (position = 'view') AS view_count,
               count(*) FILTER (position IN ('cart', 'tap_cart')) AS cart_count,
               count(*) FILTER (position = 'buy') AS buy_count,
               count(*) FILTER (position IN ('clip', 'tap_clip')) AS clip_count,
               count(*) FILTER (position = 'quick') AS quick_count,
               count(*) FILTER (position IN ('share', 'tap_share')) AS share_count,
               count(*) FILTER (position = 'pop') AS pop_count
        FROM v_ad_row {extra} GROUP BY ALL"""


_AGE = "DATE '2001-08-02' - shown_from"

SQL = {
    "read_item": _sql("SELECT * REPLACE (CAST(item_id AS VARCHAR) AS item_id) FROM v_item"),
    "read_item_views": _sql("SELECT * FROM x_view WHERE item_id NOT LIKE 'x%'"),
    "read_item_views_loose": _sql("SELECT * FROM x_view"),
    "read_clicks_demo": _sql("""
        SELECT CAST(user_id AS VARCHAR) AS visitor_id, item AS item_id,
               CASE user_id % 3 WHEN 1 THEN '10' WHEN 2 THEN '20' ELSE '' END AS gender,
               CASE WHEN user_id BETWEEN 1 AND 29 THEN '20' WHEN user_id BETWEEN 30 AND 39 THEN '30'
                    WHEN user_id BETWEEN 40 AND 49 THEN '40' WHEN user_id BETWEEN 50 AND 100 THEN '50' ELSE '' END AS age_band
        FROM x_event"""),
    "read_clicks_sparse": _sql("""
        SELECT CAST(ts AS DATE) AS day, CASE WHEN user_id % 2 = 0 THEN 'PC' WHEN user_id % 3 = 0 THEN 'MA' ELSE 'MW' END AS device,
               url, '/search.ssg' AS referrer, item AS item_id, screen AS screen_code
        FROM x_event WHERE length(item) = 13"""),
    "read_page_visits": _sql("""
        SELECT CAST(user_id AS VARCHAR) AS visitor_id, date_trunc('millisecond', ts) AS ts,
               CASE WHEN url = '' THEN screen ELSE url END AS url, screen AS screen_code
        FROM x_event WHERE event_type <> 'click'"""),
    "read_ord_item": with_views("""
        SELECT CAST(order_no AS VARCHAR) AS order_no, lpad(CAST(item_id AS VARCHAR), 13, '0') AS item_id, order_date, qty,
               amount, own_discount, CASE WHEN line_no <> 7 THEN partner_discount END AS partner_discount,
               CASE WHEN item_id % 2 = 0 THEN 'Z~1' ELSE '5' END AS original_amount
        FROM v_order_line"""),
    "read_member_demo": """
        SELECT CAST(c_custkey AS VARCHAR) AS member_id,
               CASE c_custkey % 3 WHEN 0 THEN '10' WHEN 1 THEN '20' ELSE '' END AS gender,
               CASE WHEN c_custkey % 11 = 0 THEN '' WHEN a BETWEEN 0 AND 29 THEN '20' WHEN a BETWEEN 30 AND 39 THEN '30'
                    WHEN a BETWEEN 40 AND 49 THEN '40' WHEN a BETWEEN 50 AND 100 THEN '50' ELSE '' END AS age_band
        FROM (SELECT *, 2024 - (1890 + c_custkey % 115) AS a FROM customer)""",
    "read_attribution": with_views("""
        SELECT CAST(ts AS DATE) AS day, lpad(CAST(k AS VARCHAR), 13, '0') AS item_id, '/main.ssg' AS url,
               CASE WHEN user_id % 3 = 0 THEN 'PC' WHEN user_id % 2 = 0 THEN 'MA' ELSE 'MW' END AS device
        FROM v_event WHERE event_type = 'purchase'"""),
    "read_similarity": with_views("""
        SELECT lpad(CAST(k AS VARCHAR), 13, '0') AS item_id, lpad(CAST(user_id AS VARCHAR), 13, '0') AS similar_id, value
        FROM v_event"""),
    "read_offline_map": with_views(
        "SELECT offline_item_id, business_code, CAST(item_id AS VARCHAR) AS item_id FROM v_offline_map"),
    "read_latest_days": with_views("""
        SELECT sale_date AS dt, count(*) AS n FROM v_offline_sale
        WHERE sale_date BETWEEN DATE '2001-10-23' AND DATE '2001-11-01' GROUP BY sale_date ORDER BY sale_date DESC LIMIT 3"""),
    "run_window_hours": """
        SELECT event_id, CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hh FROM events
        WHERE ts >= TIMESTAMP '2024-01-14 22:00:00' AND ts < TIMESTAMP '2024-01-16 04:00:00'""",
    "run_window_days": """
        SELECT event_id, CAST(ts AS DATE) AS dt FROM events
        WHERE CAST(ts AS DATE) IN (DATE '2024-01-30', DATE '2024-01-29', DATE '2024-01-28', DATE '2024-01-23')""",
    "serving_upsert": """
        SELECT p_partkey AS item_id, p_brand, CAST(CASE WHEN p_brand < 'Brand#2' THEN p_size + 100 ELSE p_size END AS INTEGER) AS score
        FROM part WHERE p_partkey % 2 = 0 OR p_brand < 'Brand#2'""",
    "serving_swap": "SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_brand AS brand_id, p_type AS category_id FROM part",
    "ad_counters_stream": with_views(_counters("")),
    "sliding_visits_stream": """
        SELECT from_ts, from_ts + INTERVAL 6 HOUR AS to_ts, user_id AS visitor_id, count(*) AS visits
        FROM (SELECT user_id, date_trunc('hour', ts) - to_hours(h) AS from_ts
              FROM events, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS h))
        GROUP BY from_ts, user_id""",
    "global_row_number": "SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rn FROM part",
    "global_row_number_split": "SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rn FROM part",
    "global_rank": "SELECT p_partkey, rank() OVER (ORDER BY p_size DESC) AS rn FROM part",
    "global_rank_split": "SELECT p_partkey, rank() OVER (ORDER BY p_size DESC) AS rn FROM part",
    "rank_in_split": "SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rn FROM part",
    "row_number_in_split": "SELECT p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) AS rn FROM part",
    "order_ranks": _sql("""
        SELECT *, rank() OVER (PARTITION BY item_id ORDER BY order_count DESC) AS count_rank,
               rank() OVER (ORDER BY price DESC, item_id) AS price_rank FROM x_order_rank"""),
    "top_k": with_views("SELECT order_no, line_no, amount FROM v_order_line ORDER BY amount DESC, order_no, line_no LIMIT 100"),
    "top_k_large": with_views("SELECT order_no, line_no, amount FROM v_order_line ORDER BY amount DESC, order_no, line_no LIMIT 5000"),
    "top_n_per_group": """
        SELECT p_brand, p_partkey, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn
        FROM part QUALIFY rn <= 3""",
    "pick_max": with_views("SELECT item_id, max(site_no) AS site_no, max(sell_price) AS sell_price FROM v_price GROUP BY item_id"),
    "count_distinct": with_views("SELECT item_id, site_no, count(DISTINCT order_no) AS cnt FROM v_order_line GROUP BY ALL"),
    "sum_by": with_views("SELECT site_no, CAST(sum(amount) AS BIGINT) AS amount FROM v_order_line GROUP BY site_no"),
    "total": with_views("SELECT CAST(sum(amount) AS BIGINT) AS total FROM v_order_line"),
    "orders_since": with_views("SELECT order_no, line_no, order_date FROM v_order_line WHERE order_date >= DATE '2001-06-02'"),
    "freshness": with_views(f"""
        SELECT item_id, round(CASE WHEN {_AGE} <= 7 THEN 1.0 WHEN {_AGE} <= 77 THEN 1.0 / ceil(({_AGE}) / 7)
               ELSE 1.0 / 12 END::DOUBLE, 6) AS freshness FROM v_item"""),
    "open_weight": with_views(f"""
        SELECT item_id, CASE WHEN {_AGE} BETWEEN 1 AND 7 THEN round(1.0::DOUBLE / ({_AGE}), 4) ELSE 0.1429 END::DOUBLE AS weight
        FROM v_item"""),
    "min_max_scale": """
        SELECT p_partkey, round(100 * ((log10(p_size) - a) / (b - a)), 4) AS size,
               round(100 - 100 * ((log10(p_retailprice) - c) / (d - c)), 4) AS price
        FROM part, (SELECT min(log10(p_size)) a, max(log10(p_size)) b, min(log10(p_retailprice)) c,
                           max(log10(p_retailprice)) d FROM part)""",
    "repair_count": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber < l_quantity THEN l_linenumber + l_quantity ELSE l_linenumber END::DOUBLE AS n
        FROM lineitem""",
    "site_codes": with_views("""
        SELECT item_id, store_no, CASE WHEN site_no = '4' THEN '3' ELSE site_no END AS aliased,
               CASE site_no WHEN '0' THEN '10' WHEN '1' THEN '20' ELSE '' END AS coded FROM v_price"""),
    "page_code": with_views("""
        SELECT event_id, CASE WHEN user_id % 2 = 0 THEN CASE k % 13 WHEN 1 THEN 'SSG_' WHEN 3 THEN 'TR_' WHEN 4 THEN 'BM_'
            WHEN 5 THEN 'SM_' WHEN 6 THEN 'SD_' WHEN 7 THEN 'TV_' WHEN 8 THEN 'HD_' WHEN 10 THEN 'BT_' WHEN 11 THEN 'SIV_'
            WHEN 12 THEN 'STF_' ELSE '' END ELSE '' END || 'EM_p' || CAST(k AS VARCHAR) AS code
        FROM v_event"""),
    "key_checks": with_views("""
        SELECT event_id, true AS long_key, length(CAST(event_id AS VARCHAR)) = 4 AS short_key, k % 2 <> 0 AS filled,
               substr(CAST(k AS VARCHAR), 1, 1) IN ('6', '8', '9') AS marked FROM v_event"""),
    "date_parts": """
        SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('minute', ts) AS minute, strftime(ts, '%Y%m%d') AS text,
               CAST(DATE '2024-01-31' - CAST(ts AS DATE) AS BIGINT) AS age FROM events""",
}
