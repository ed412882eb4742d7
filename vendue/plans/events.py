"""Hourly event chain: cart, order and ad payloads to flat rows, ad counters, ad revenue, page sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.functions.text import default_if_blank, map_code, replace_text, starts_with_any

# Payload shapes -------------------------------------------------------------

CART_JSON = (
    "array<struct<cartId: string, masterCartId: string, uitemId: string, cartItemSiteNo: string, itemId: string, "
    "ordQty: double, ordItemInfloExtApiDtoList: array<struct<ordItemInfloTgtId: string, ordItemInfloDivCd: string>>>>"
)
ORDER_JSON = (
    "struct<ordNo: string, ordCmplDts: string, baseProperties: struct<ckWhere: string, mbrId: string, pcid: string, "
    "dmId: string, sessionId: string, ip: string, browser: string, tgtMediaCd: string, timestamp: double>, "
    "subOrderItemList: array<struct<ordItemSeq: double, unitPrice: double, ordQty: double, cartItemSiteNo: string, "
    "masterCartId: string, cartId: string, uitemId: string, itemId: string, infloSiteNo: string, "
    "ordItemRepTypeCd: string, ordItemTypeCd: string, itemChrctDtlCd: string>>>"
)
AD_JSON = (
    "struct<position: string, userip: string, globalid: string, mediacd: string, areaid: string, type: string, "
    "siteno: string, unitinfolist: array<struct<adtgtid: string, adidx: string, advertbilngtypecd: string, "
    "advertacctid: string, advertbidid: string, advertkindcd: string, unittype: string, "
    "advertextensterydivcd: string>>>"
)

# Fixed values of the shop's event chain
DROPPED_INFLOW_KIND = "03"
REPEAT_ORDER_KIND, REPEAT_ITEM_KIND = "30", "12"
NOT_VISITED_PREFIXES = ["6", "8", "9"]
DEFAULT_EXTENSION = "10"
APP_BROWSER, PC_MEDIA = "SSGAPP", "10"
UNIT_CODES = {"item": "10", "banr": "20", "main_banr": "20"}
AREA_NAMES = {"해피바이러스": "happy", "오반장": "obanjang"}
COUNTER_KEYS = [
    "site_no", "media_code", "minute", "global_id", "area_id", "unit_code", "account_id", "bid_id", "target_id",
    "extension_code",
]


def explode_json(
    df: DataFrame, col: str, schema: str, out: str = "element", outer: bool = False
) -> DataFrame:
    """One row per element of a JSON array; text that does not parse gives no rows.

    ``outer`` keeps rows without elements.
    """
    parsed = df.withColumn("_parsed", F.from_json(F.col(col), schema))
    func = F.explode_outer if outer else F.explode
    return parsed.withColumn(out, func("_parsed")).drop("_parsed")


def json_field(col: str, path: str) -> Column:
    """One value of a JSON text by path."""
    return F.get_json_object(F.col(col), path)


def explode_cart(events: DataFrame) -> DataFrame:
    """One row per cart line and inflow entry.

    A line without inflow list gets one blank entry; an empty list gives no row;
    entries of the dropped kind are left out.
    """
    blank = F.array(F.struct(F.lit("").alias("ordItemInfloTgtId"), F.lit("0").alias("ordItemInfloDivCd")))
    lines = explode_json(events, "payload", CART_JSON, "line")
    flows = lines.withColumn(
        "flow", F.explode(F.coalesce(F.col("line.ordItemInfloExtApiDtoList"), blank))
    )
    kind = F.coalesce(F.col("flow.ordItemInfloDivCd"), F.lit(""))
    kept = [c for c in events.columns if c != "payload"]
    return flows.where(kind != DROPPED_INFLOW_KIND).select(
        *[default_if_blank(c, ".").alias(c) if c == "referrer" else F.col(c) for c in kept],
        F.col("line.cartId").alias("cart_id"),
        F.col("line.masterCartId").alias("master_cart_id"),
        F.col("line.uitemId").alias("option_id"),
        F.col("line.cartItemSiteNo").alias("cart_site_no"),
        F.col("line.itemId").alias("item_id"),
        F.col("line.ordQty").cast("bigint").alias("qty"),
        F.coalesce(F.col("flow.ordItemInfloTgtId"), F.lit("")).alias("inflow_target"),
    )


def visit_orders(rows: DataFrame) -> DataFrame:
    """Order rows that count as visit orders."""
    repeat = (F.col("order_kind") == REPEAT_ORDER_KIND) & (F.col("item_kind") != REPEAT_ITEM_KIND)
    return rows.where(~repeat & ~starts_with_any("trait_code", NOT_VISITED_PREFIXES))


def explode_orders(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per ordered item, as (all rows, rows of visit orders)."""
    kept = [c for c in events.columns if c != "payload"]
    base, line = "order.baseProperties", "line"
    rows = (
        events.withColumn("order", F.from_json("payload", ORDER_JSON))
        .withColumn("line", F.explode("order.subOrderItemList"))
        .select(
            *kept,
            F.col("order.ordNo").alias("order_no"),
            F.col(f"{line}.ordItemSeq").cast("bigint").alias("line_no"),
            F.col(f"{line}.cartItemSiteNo").alias("cart_site_no"),
            F.col(f"{line}.masterCartId").alias("master_cart_id"),
            F.col(f"{line}.cartId").alias("cart_id"),
            F.col(f"{line}.itemId").alias("item_id"),
            F.col(f"{line}.uitemId").alias("option_id"),
            F.col(f"{line}.unitPrice").cast("bigint").alias("unit_price"),
            F.col(f"{line}.ordQty").cast("bigint").alias("qty"),
            F.col(f"{base}.ckWhere").alias("click_origin"),
            F.timestamp_millis(F.col(f"{base}.timestamp").cast("bigint")).alias("order_ts"),
            F.col(f"{base}.tgtMediaCd").alias("media_code"),
            F.col(f"{base}.browser").alias("browser"),
            F.col(f"{base}.ip").alias("ip"),
            F.col(f"{base}.sessionId").alias("session_id"),
            F.col(f"{base}.dmId").alias("device_id"),
            F.col(f"{base}.pcid").alias("visitor_id"),
            F.col(f"{base}.mbrId").alias("member_id"),
            F.col("order.ordCmplDts").alias("completed_at"),
            F.col(f"{line}.infloSiteNo").alias("inflow_site_no"),
            F.col(f"{line}.ordItemRepTypeCd").alias("order_kind"),
            F.col(f"{line}.ordItemTypeCd").alias("item_kind"),
            F.col(f"{line}.itemChrctDtlCd").alias("trait_code"),
        )
    )
    return rows, visit_orders(rows)


def explode_ads(events: DataFrame) -> DataFrame:
    """One row per advertised unit; keys and values of the payload are lower-cased first."""
    ad = F.from_json(F.lower("payload"), AD_JSON)
    kept = [c for c in events.columns if c != "payload"]
    rows = (
        events.where(F.col("payload") != "")
        .withColumn("ad", ad)
        .withColumn("unit", F.explode("ad.unitinfolist"))
    )
    return rows.select(
        *kept,
        F.col("ad.type").alias("type"),
        F.col("ad.globalid").alias("global_id"),
        F.col("ad.areaid").alias("area_id"),
        F.col("ad.siteno").alias("site_no"),
        F.col("ad.mediacd").alias("media_code"),
        F.col("ad.position").alias("position"),
        F.col("unit.unittype").alias("unit_type"),
        F.col("unit.advertacctid").alias("account_id"),
        F.col("unit.advertbidid").alias("bid_id"),
        F.col("unit.adtgtid").alias("target_id"),
        F.col("unit.adidx").alias("ad_index"),
        default_if_blank("unit.advertextensterydivcd", DEFAULT_EXTENSION).alias("extension_code"),
    )


def ad_dimensions(ad_rows: DataFrame) -> DataFrame:
    """Area names replaced, unit types as codes."""
    return ad_rows.withColumn("global_id", replace_text("global_id", AREA_NAMES)).withColumn(
        "unit_code", map_code("unit_type", UNIT_CODES, "")
    )


def ad_counts() -> list[Column]:
    """The nine counters of ad rows."""
    kind, at = F.col("type"), F.col("position")
    return [
        F.count_if(kind == "pv").alias("pv_count"),
        F.count_if(kind == "click").alias("click_count"),
        F.count_if(at == "view").alias("view_count"),
        F.count_if(at.isin("cart", "tap_cart")).alias("cart_count"),
        F.count_if(at == "buy").alias("buy_count"),
        F.count_if(at.isin("clip", "tap_clip")).alias("clip_count"),
        F.count_if(at == "quick").alias("quick_count"),
        F.count_if(at.isin("share", "tap_share")).alias("share_count"),
        F.count_if(at == "pop").alias("pop_count"),
    ]


def ad_counters(ad_rows: DataFrame) -> DataFrame:
    """Ad counters per minute and ten keys."""
    rows = ad_dimensions(ad_rows).withColumn("minute", F.date_trunc("minute", "ts"))
    return rows.groupBy(*COUNTER_KEYS).agg(*ad_counts())


def ad_contribution(orders: DataFrame, os_code: str = "os_code", user_agent: str = "user_agent") -> DataFrame:
    """Revenue of order lines that carry an ad target of 10 or 12 characters.

    A 12-character target starts with its extension code. The device is that of the page
    which the order is attributed to, by its OS code and user agent: 10 for PCs, 30 for
    the shop's app, 20 else and without a page.
    """
    target = F.col("inflow_target")
    long_form = F.length(target) == 12
    device = (
        F.when(F.col(os_code) == PC_MEDIA, "10")
        .when(F.col(user_agent).contains(APP_BROWSER), "30")
        .otherwise("20")
    )
    return orders.where(F.length(target).isin(10, 12)).select(
        F.when(long_form, F.substring(target, 3, 10)).otherwise(target).alias("target_id"),
        "order_no",
        F.date_trunc("minute", "order_ts").alias("minute"),
        F.when(long_form, F.substring(target, 1, 2)).otherwise(DEFAULT_EXTENSION).alias("extension_code"),
        device.alias("device_code"),
        "cart_id",
        "cart_ts",
        (F.col("qty") * F.col("unit_price")).alias("sales_amount"),
    )


def merge_full(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Full outer join; for every column the first frame's value wins where it is present."""
    right = b.select(*keys, *values)
    for c in values:
        right = right.withColumnRenamed(c, f"_b_{c}")
    joined = a.select(*keys, *values).join(right, list(keys), "full")
    return joined.select(*keys, *[F.coalesce(F.col(c), F.col(f"_b_{c}")).alias(c) for c in values])


def merge_page_sets(page_sets: DataFrame, special: DataFrame) -> DataFrame:
    """Two page lists merged on url, parameter and device; one sorted row per page.

    Of every value the greatest counts, so each list is reduced before the join, which pairs all rows of a
    page. Rows of the first list with a value and rows without one stay apart, as the other list fills those only.
    """
    page, values = ["kind", "mall", "url", "param", "device"], ["shop", "shop_detail", "day"]
    greatest = [F.max(c).alias(c) for c in values]
    first = page_sets.groupBy(*page, *[F.isnull(c).alias(f"_no_{c}") for c in values]).agg(*greatest)
    merged = merge_full(first, special.groupBy(*page).agg(*greatest), ["url", "param", "device"], ["kind", "mall", *values])
    return (
        merged.groupBy(*page)
        .agg(*greatest)
        .orderBy("kind", "mall", "shop", "shop_detail", F.col("device").desc(), "url", "param")
    )
