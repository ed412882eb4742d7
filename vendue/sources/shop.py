"""Readers of the shop's files.

Daily and hourly logs lie in partition folders ``dt=yyyy-MM-dd`` and ``hh=HH``; a
look-back is a filter on those. The event log is parsed once into ``EVENT_LOG``
columns, which the click readers narrow.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendue.functions.pages import UNATTRIBUTED_URLS, is_item_view, page_code, page_url
from vendue.functions.text import default_if_blank, map_code, pad_key, page_in, valid_key
from vendue.sources.delimited import Layout, parse_lines, read_delimited
from vendue.sources.window import RunWindow

# Separators and field positions of the shop's files ----------------

ITEM = Layout(
    '"|"',
    {
        "item_id": 0, "mobile_name": 2, "vendor_id": 4, "brand_id": 8, "sell_status": (9, "int"), "origin_id": 14,
        "category_id": 15, "sell_type": (16, "int"), "sell_type_detail": (17, "int"), "shown_from": (21, "date"),
        "registered": (31, "date"), "new_flag": 33, "searchable": 34,
    },
    header="ITEM_ID",
)
CATEGORY = Layout(
    '"|"',
    {
        "category_id": 0, "category_name": 1, "parent_id": 2, "large_id": 4, "large_name": 5, "medium_id": 6,
        "medium_name": 7, "small_id": 8, "small_name": 9, "detail_id": 10, "detail_name": 11, "in_use": 14,
    },
    header="STD_CTG_ID",
)
CATEGORY_IDS = ["category_id", "parent_id", "large_id", "medium_id", "small_id", "detail_id", "in_use"]
PRICE = Layout(
    "|",
    {"item_id": 0, "site_no": 1, "store_no": 2, "sell_price": (3, "bigint"), "low_price": (4, "bigint")},
    min_fields=10,
    header="ITEM_ID",
)
MEMBER = Layout(",", {"member_id": 0, "login_id": 4, "gender": 12, "birth": 14}, header="MBR_ID")
MEMBER_DEMO = Layout(
    "\t",
    {"member_id": 0, "status": 1, "kind": 3, "gender": 12, "birth": 14},
    min_fields=37,
    header="MBR_ID",
)
ORDER_EVENT = Layout("\t", {"order_no": 0, "item_id": 5, "ts": (10, "epoch_ms"), "member_id": (17, "bigint")})
ORDER_ITEM = Layout(
    "|",
    {
        "order_no": 0, "shipping_order_no": 1, "line_kind": 3, "order_date": (5, "date"), "target_code": 9,
        "device_code": 10, "line_status": 17, "item_id": 19, "site_no": 24, "member_id": 25,
        "sell_price": (27, "bigint"), "supply_price": (28, "bigint"), "original_qty": (31, "bigint"),
        "qty": (32, "bigint"), "original_amount": 41, "amount": (42, "bigint"), "own_discount": (47, "bigint"),
        "partner_discount": (48, "bigint"), "category_id": 58, "brand_id": 60, "inflow_site_no": 64, "vendor_id": 68,
        "registered": (92, "date"),
    },
    header="ORORD_NO",
)
EVENT_LOG = Layout(
    "\t",
    {
        "ts": (0, "epoch_ms"), "ip": 2, "url": 4, "site_no": 6, "item_id": 7, "search": 12, "area": 13,
        "screen_code": 17, "referrer": 18, "user_agent": 19, "os": 20, "browser": 22, "visitor_id": 28,
        "session_id": 29, "click_origin": 30, "device_id": 33, "member_id": 34, "payload": (44, "raw"),
        "gender_code": 52, "age": (53, "int"), "mobile_domain": 55,
    },
    min_fields=65,
)
CART_LOG = Layout(
    "\t",
    {
        "visitor_id": 28, "session_id": 29, "ts": (0, "epoch_ms"), "payload": (44, "raw"), "referrer": 18,
        "member_id": 34, "os": 20, "browser": 22, "user_agent": 19, "ip": 2, "device_id": 33, "click_origin": 30,
        "site_no": 6, "mobile_domain": 55,
    },
)
ORDER_LOG = Layout(
    "\t",
    {
        "payload": (44, "raw"), "os": 20, "os_version": 21, "browser": 22, "browser_version": 23, "device_model": 24,
        "screen_width": 25, "screen_height": 26, "inflow_1": 58, "inflow_2": 59, "session_id": 29, "site_no": 6,
        "mobile_domain": 55,
    },
    min_fields=61,
)
ATTRIBUTION = Layout(
    "\t",
    {
        "site_no": 0, "item_id": 1, "option_id": 2, "qty": (3, "bigint"), "master_cart_id": 4, "cart_id": 5,
        "cart_ts": (6, "epoch_ms"), "ts": (7, "epoch_ms"), "url": 11, "page_site_no": 13, "search": 19, "area": 20,
        "screen_code": 24, "referrer": 25, "os_code": 27, "browser": 29,
    },
    min_fields=71,
)
CART_ROW = Layout(
    "\t",
    {"visitor_id": 0, "ts": (2, "epoch_ms"), "site_no": 6, "item_id": 7, "member_id": 10},
    required=("item_id",),
)
REVIEW = Layout("\t", {"item_id": 0, "review_count": (1, "bigint")})
EVENT_ITEM = Layout("|", {"item_id": 0}, header="ITEM_ID")
LOGIN_HISTORY = Layout(",", {"member_id": 0, "visitor_id": 1, "updated": (2, "date")})
SIMILARITY = Layout(",", {"item_id": 0, "similar_id": 1, "value": (2, "double")})
CATEGORISED = Layout(
    ",",
    {"item_id": 0, "similar_id": 1, "site_no": 2, "value": (3, "double"), "category_path": 4, "similar_category_path": 5},
)
SEARCH_SCORE = Layout(
    ",", {"item_id": 1, "first_score": (2, "double"), "second_score": (3, "double"), "third_score": (4, "double")}
)
BRAND = Layout("|", {"brand_id": 0, "brand_name": 1, "in_use": 3, "division": 4}, header="BRAND_ID")
BEST_RANK = Layout(
    ",",
    {
        "item_id": 0, "display_site": 1, "sell_site": 2, "order_count": (3, "bigint"), "order_rank": (4, "bigint"),
        "brand_id": 5, "click_count": (8, "bigint"), "click_rank": (9, "bigint"), "amount": (10, "bigint"),
        "amount_rank": (11, "bigint"), "total_score": (12, "double"), "total_rank": (13, "bigint"),
        "final_rank": (15, "bigint"),
    },
)
ITEMBASE = Layout(",", {"item_id": 0, "site_no": 1, "similar_id": 2, "value": (3, "double")}, header="item_id")
OFFLINE_MAP = Layout("\\|", {"offline_item_id": 0, "business_code": 1, "item_id": 2})
OFFLINE_SALE = Layout("\\|", {"sale_date": 0, "offline_item_id": 7})
PRODUCT = Layout(
    ",",
    {
        "score_date": 0, "display_site": 1, "sell_site": 2, "item_id": 3, "brand_id": 4, "mark": (5, "int"),
        "score": (8, "double"), "origin_id": 11, "new_item": 12,
    },
)
PAGE_SET = Layout(
    "\t",
    {"kind": (0, "int"), "mall": 1, "shop": 2, "shop_detail": 3, "url": (4, "raw"), "param": 5, "device": 6, "day": 7},
)
GENDER_CODES = {"1": "10", "2": "20"}
PC_DOMAIN, PC_OS = "0", "10"
APP_BROWSERS = ["app", "uplus"]

# Masters ----------------------------------------------------------------------


def read_item(spark: SparkSession, path: str) -> DataFrame:
    """Item master; the file of another day is another path."""
    return read_delimited(spark, path, ITEM)


def read_category(spark: SparkSession, path: str, with_names: bool = False) -> DataFrame:
    """Category tree, with or without names."""
    tree = read_delimited(spark, path, CATEGORY)
    return tree.drop("parent_id") if with_names else tree.select(*CATEGORY_IDS)


def read_price(spark: SparkSession, path: str) -> DataFrame:
    """Prices per item, site and store."""
    return read_delimited(spark, path, PRICE)


def read_member(spark: SparkSession, path: str, cols: Sequence[str] = ("member_id", "login_id", "gender", "birth")) -> DataFrame:
    return read_delimited(spark, path, MEMBER).select(*cols)


def age_band(age: Column, youngest: int = 0) -> Column:
    """20, 30, 40 or 50; blank for ages outside ``youngest``..100 and missing ones."""
    return (
        F.when(age.between(youngest, 29), "20")
        .when(age.between(30, 39), "30")
        .when(age.between(40, 49), "40")
        .when(age.between(50, 100), "50")
        .otherwise("")
    )


def member_demo(rows: DataFrame, as_of: date) -> DataFrame:
    """Gender code and age band of member rows."""
    birth_year = F.when(F.length("birth") >= 4, F.substring("birth", 1, 4).try_cast("int"))
    return rows.select(
        "member_id",
        "status",
        "kind",
        F.coalesce(F.trim(F.replace("gender", F.lit("*"), F.lit(""))), F.lit("")).alias("gender"),
        age_band(F.lit(as_of.year) - birth_year).alias("age_band"),
    )


def read_member_demo(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    return member_demo(read_delimited(spark, path, MEMBER_DEMO), as_of)


def read_brand(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, BRAND)


def read_event_items(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, EVENT_ITEM)


# Orders -------------------------------------------------------------------------


def read_order_event(spark: SparkSession, root: str, day: date) -> DataFrame:
    return read_delimited(spark, root, ORDER_EVENT, F.col("dt") == F.lit(day))


def read_ord_item(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Order items. With ``cols`` only those, and only lines whose item id has 13 characters."""
    rows = read_delimited(spark, path, ORDER_ITEM)
    return rows if cols is None else rows.where(F.length("item_id") == 13).select(*cols)


# Event log ----------------------------------------------------------------------


def item_views(log: DataFrame, strict_item: bool = True) -> DataFrame:
    """Item views of the event log; ``strict_item`` asks for a 13-digit item id."""
    blank = F.lit("")
    seen = log.where(is_item_view(F.coalesce("url", blank), F.coalesce("screen_code", blank)))
    if strict_item:
        seen = seen.where(valid_key("item_id"))
    return seen.select(
        F.to_date("ts").alias("visit_date"), "ip", "site_no", "item_id", "visitor_id", "member_id", "session_id", "ts"
    )


def read_clicks(spark: SparkSession, root: str, run: RunWindow, n: int = 1, strict_item: bool = True) -> DataFrame:
    """Item views of the last ``n`` days."""
    return item_views(read_delimited(spark, root, EVENT_LOG, run.last_days(n)), strict_item)


def click_demo(log: DataFrame) -> DataFrame:
    """Clicks with gender code and age band."""
    return log.select(
        F.to_date("ts").alias("visit_date"), "ip", "site_no", "item_id", "visitor_id", "member_id", "session_id", "ts",
        map_code("gender_code", GENDER_CODES, "").alias("gender"),
        age_band(F.col("age"), youngest=1).alias("age_band"),
    )


def read_clicks_demo(spark: SparkSession, root: str, run: RunWindow, n: int) -> DataFrame:
    return click_demo(read_delimited(spark, root, EVENT_LOG, run.last_days(n)))


def device_class(is_pc: Column, browser: Column) -> Column:
    """PC, MA (app) or MW (mobile web)."""
    app = F.coalesce(F.lower(browser).isin(APP_BROWSERS), F.lit(False))
    return F.when(is_pc, "PC").when(app, "MA").otherwise("MW")


def _model_rows(log: DataFrame, device: Column) -> DataFrame:
    blank = F.lit("")
    return log.where(F.length("item_id") == 13).select(
        F.to_date("ts").alias("day"), device.alias("device"), "item_id", "search",
        *[F.coalesce(c, blank).alias(c) for c in ("url", "referrer", "area", "screen_code")],
    )


def click_rows(log: DataFrame) -> DataFrame:
    """Search-model rows of the event log."""
    is_pc = F.coalesce(F.col("mobile_domain") == PC_DOMAIN, F.lit(False))
    return _model_rows(log, device_class(is_pc, F.col("browser")))


def read_clicks_sparse(spark: SparkSession, root: str, run: RunWindow, offsets: Sequence[int] = (1, 2, 3, 8)) -> DataFrame:
    return click_rows(read_delimited(spark, root, EVENT_LOG, run.listed_days(offsets)))


def read_reactions(spark: SparkSession, root: str, run: RunWindow, offsets: Sequence[int] = (1, 2, 3, 8)) -> DataFrame:
    """App reactions; the device is always the app."""
    return _model_rows(read_delimited(spark, root, EVENT_LOG, run.listed_days(offsets)), F.lit("MA"))


def read_attribution(spark: SparkSession, root: str, run: RunWindow, offsets: Sequence[int] = (1, 2, 3, 8)) -> DataFrame:
    rows = read_delimited(spark, root, ATTRIBUTION, run.listed_days(offsets))
    is_pc = F.coalesce(F.col("os_code") == PC_OS, F.lit(False))
    return _model_rows(rows, device_class(is_pc, F.col("browser")))


def read_attribution_days(spark: SparkSession, root: str, run: RunWindow, hours: int = 384) -> DataFrame:
    """Attribution rows of all days that the last hours touch."""
    return read_delimited(
        spark, root, ATTRIBUTION, F.col("dt").between(F.lit(run.before((hours + 23) // 24)), F.lit(run.day))
    )


def read_cart(spark: SparkSession, root: str, run: RunWindow, n: int) -> DataFrame:
    rows = read_delimited(spark, root, CART_ROW, run.last_days(n))
    return rows.select(F.to_date("ts").alias("visit_date"), F.lit("").alias("ip"), "site_no", "item_id", "visitor_id", "member_id")


def page_visits(log: DataFrame) -> DataFrame:
    """Page visits for attribution: the URL, or the screen code where there is none."""
    blank = F.lit("")
    url, screen = F.coalesce("url", blank), F.coalesce("screen_code", blank)
    return log.where(~page_in(url, UNATTRIBUTED_URLS)).select(
        "visitor_id", "session_id", "ts", F.xxhash64("ts", "url", "screen_code", "ip").alias("visit_id"),
        page_url(url, screen).alias("url"), screen.alias("screen_code"), "site_no", "item_id", "referrer",
    )


def read_clicks_hours(spark: SparkSession, root: str, run: RunWindow, hours: int = 6) -> DataFrame:
    return page_visits(read_delimited(spark, root, EVENT_LOG, run.last_hours(hours)))


def read_cart_events(spark: SparkSession, root: str, run: RunWindow) -> DataFrame:
    rows = read_delimited(spark, root, CART_LOG, run.last_hours(1))
    return rows.withColumn("referrer", default_if_blank("referrer", "."))


def read_order_events_raw(spark: SparkSession, root: str, run: RunWindow) -> DataFrame:
    return read_delimited(spark, root, ORDER_LOG, run.last_hours(1))


def read_ad_events(spark: SparkSession, root: str, run: RunWindow) -> DataFrame:
    """Ad events of the run hour that have a payload."""
    rows = read_delimited(spark, root, EVENT_LOG, run.last_hours(1))
    return rows.where(F.col("payload") != "").select(
        "ts", "visitor_id", "member_id", "session_id", "referrer", "user_agent", "payload"
    )


# Results of earlier runs ------------------------------------------------------------


def read_reply(spark: SparkSession, root: str, as_of: RunWindow, back: int = 7) -> DataFrame:
    rows = read_delimited(spark, root, REVIEW, F.col("dt") == F.lit(as_of.before(back)))
    return rows.where(F.length("item_id") == 13).select("item_id", "review_count")


def read_login_history(spark: SparkSession, root: str, run: RunWindow, back: int = 2) -> DataFrame:
    return read_delimited(spark, root, LOGIN_HISTORY, F.col("dt") == F.lit(run.before(back))).drop("dt")


def read_similarity(spark: SparkSession, root: str, day: date) -> DataFrame:
    """Similar items of one day, ids filled to 13 characters."""
    rows = read_delimited(spark, root, SIMILARITY, F.col("dt") == F.lit(day))
    return rows.select(pad_key("item_id").alias("item_id"), pad_key("similar_id").alias("similar_id"), "value")


def read_categorised(spark: SparkSession, root: str, method: str, day: date) -> DataFrame:
    rows = read_delimited(spark, root, CATEGORISED, F.col("dt") == F.lit(day))
    return rows.drop("dt").withColumn("method", F.lit(method))


def read_search_score(spark: SparkSession, root: str, day: date) -> DataFrame:
    return read_delimited(spark, root, SEARCH_SCORE, F.col("dt") == F.lit(day)).drop("dt")


def read_best_rank(spark: SparkSession, root: str, day: date) -> DataFrame:
    return read_delimited(spark, root, BEST_RANK, F.col("dt") == F.lit(day)).drop("dt")


def read_itembase(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, ITEMBASE)


def read_offline_map(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, OFFLINE_MAP)


def latest_days(rows: DataFrame, run: RunWindow, want: int = 3, max_back: int = 10, first: int = 2) -> DataFrame:
    """Rows of the newest ``want`` days there are, looking back from ``first`` days before the run day."""
    recent = rows.where(
        F.col("dt").between(F.lit(run.before(first + max_back - 1)), F.lit(run.before(first)))
    )
    days = recent.select("dt").distinct().orderBy(F.col("dt").desc()).limit(want)
    return recent.join(F.broadcast(days), "dt", "left_semi")


def read_latest_days(spark: SparkSession, root: str, run: RunWindow, want: int = 3, max_back: int = 10) -> DataFrame:
    """Store sales of the newest days that have a folder; only those folders are read or listed."""

    def there(path: str) -> bool:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

    days = (f"{root}/dt={run.before(back).isoformat()}" for back in range(2, max_back + 2))
    newest = list(islice(filter(there, days), want))
    if not newest:
        return parse_lines(spark.createDataFrame([], "value string, dt date"), OFFLINE_SALE)
    return parse_lines(spark.read.option("basePath", root).text(newest), OFFLINE_SALE)


def read_prod(
    spark: SparkSession, path: str, sites: Sequence[str] = (), not_sites: Sequence[str] = ()
) -> DataFrame:
    """Product list of some sites, or of all but some."""
    rows = read_delimited(spark, path, PRODUCT)
    if sites:
        rows = rows.where(F.col("display_site").isin(list(sites)))
    if not_sites:
        rows = rows.where(~F.col("display_site").isin(list(not_sites)))
    return rows


def read_page_sets(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Page list with site prefixes, and the list of special shops."""
    pages = read_delimited(spark, f"{root}/pages", PAGE_SET)
    coded = pages.withColumn("url", page_code(F.col("kind"), F.col("url"), F.coalesce("device", F.lit(""))))
    return coded, read_delimited(spark, f"{root}/special", PAGE_SET)
