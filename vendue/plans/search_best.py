"""Search-best list: login history, sellable items, purchase and click logs, score.

The shop's lists hold one row per item and store, and its joins multiply log rows
by those. Here log rows are counted first and the counts multiplied, which gives
the same numbers without the rows. ``fanout=False`` counts each log row once.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.functions.scoring import floor_weight, open_weight, ratio, reciprocal_rank_score, repair_count
from vendue.functions.text import present
from vendue.operators.ranking import position
from vendue.session import pin

# Fixed values of the shop's search-best list
SCORE_WEIGHTS = {"order_rank": 0.3, "amount_rank": 0.5, "click_rank": 0.7}
UNBOUGHT = 0.0001
ORDER_DAYS = 8
LOGIN_MONTHS = 6


def today_logins(clicks: DataFrame, as_of: date) -> DataFrame:
    """Visitor and member pairs seen from three days to two days before the run date."""
    seen = F.col("visit_date").between(F.lit(as_of - timedelta(days=3)), F.lit(as_of - timedelta(days=2)))
    return (
        clicks.where(seen & F.col("member_id").isNotNull() & present("visitor_id"))
        .select("member_id", "visitor_id")
        .distinct()
        .withColumn("updated", F.lit(as_of - timedelta(days=1)))
    )


def login_history(prev: DataFrame, clicks: DataFrame, as_of: date, months: int = LOGIN_MONTHS) -> DataFrame:
    """State of known visitors: previous state and new logins, one row each, last months only."""
    merged = prev.select("member_id", "visitor_id", "updated").unionByName(today_logins(clicks, as_of))
    oldest = F.add_months(F.lit(as_of - timedelta(days=1)), -months)
    return (
        merged.groupBy("visitor_id")
        .agg(F.max("member_id").alias("member_id"), F.max("updated").alias("updated"))
        .where(F.col("updated") >= oldest)
    )


def sellable() -> Column:
    """On sale, and of a normal kind or a deal of kind 70."""
    kind, detail = F.col("sell_type"), F.col("sell_type_detail")
    return (F.col("sell_status") == 20) & (kind.isin(10, 20) | ((kind == 30) & (detail == 70)))


def full_items(items: DataFrame, prices: DataFrame, as_of: date) -> DataFrame:
    """Sellable items per site and store with the weight of their age on display."""
    age = F.date_diff(F.lit(as_of), F.to_date("shown_from"))
    return items.where(sellable()).join(prices, "item_id").select(
        "item_id", "site_no", "store_no", "sell_price", "low_price",
        open_weight(age).alias("open_weight"), "shown_from",
    )


def sb_items(items: DataFrame, prices: DataFrame, as_of: date) -> DataFrame:
    """Sellable items per site: lowest price, weight, display date, number of store rows."""
    per_site = prices.groupBy("item_id", "site_no").agg(
        F.min("low_price").alias("price"), F.count(F.lit(1)).alias("stores")
    )
    age = F.date_diff(F.lit(as_of), F.to_date("shown_from"))
    return (
        items.where(sellable())
        .join(per_site, "item_id")
        .groupBy("item_id", "site_no")
        .agg(
            F.min("price").alias("price"),
            F.max(open_weight(age)).alias("open_weight"),
            F.min("shown_from").alias("shown_from"),
            F.sum("stores").alias("stores"),
        )
    )


def known_clicks(clicks: DataFrame, items: DataFrame, logins: DataFrame, fanout: bool = True) -> DataFrame:
    """Clicks of known visitors on sellable items, counted per item, visitor and site.

    ``clicks`` counts each click once per store row of its item, or once.
    """
    counted = clicks.groupBy("item_id", "visitor_id", "site_no").agg(F.count(F.lit(1)).alias("clicks"))
    gated = counted.join(logins.select("visitor_id").distinct(), "visitor_id", "left_semi")
    rows = items.groupBy("item_id").agg(F.sum("stores").alias("_rows"))
    times = F.col("clicks") * (F.col("_rows") if fanout else F.lit(1))
    return gated.join(rows, "item_id").withColumn("clicks", times).drop("_rows")


def sb_click_log(known: DataFrame) -> DataFrame:
    """Distinct visitors and clicks per item."""
    return known.groupBy("item_id").agg(
        F.countDistinct("visitor_id").alias("visitors"),
        F.sum("clicks").alias("click_count"),
        F.max("site_no").alias("site_no"),
    )


def sb_buy_log(
    orders: DataFrame,
    items: DataFrame,
    clicked: DataFrame,
    as_of: date,
    days: int | None = ORDER_DAYS,
    fanout: bool = True,
) -> DataFrame:
    """Buyers, purchases and amount per item; items that were only clicked get a small constant."""
    if days is not None:
        orders = orders.where(F.date_diff(F.lit(as_of), F.col("order_date")) <= days)
    counted = orders.groupBy("item_id", "site_no", "member_id").agg(F.count(F.lit(1)).alias("n"))
    sold = counted.join(items.select("item_id", "site_no", "stores"), ["item_id", "site_no"])
    times = F.col("n") * (F.col("stores") if fanout else F.lit(1))
    bought = sold.groupBy("item_id").agg(
        F.countDistinct("member_id").alias("buyers"), F.sum(times).alias("lines")
    )
    per_item = items.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("sites"), F.sum("price").alias("prices"), F.min("price").alias("one_price"),
        F.max("site_no").alias("site_no"),
    )
    hit = clicked.select("item_id").distinct().withColumn("was_clicked", F.lit(True))
    joined = per_item.join(bought, "item_id", "left").join(hit, "item_id", "left")
    small = F.when(F.col("was_clicked"), F.lit(UNBOUGHT))
    lines = F.col("lines") * (F.col("sites") if fanout else F.lit(1))
    amount = F.col("lines") * (F.col("prices") if fanout else F.col("one_price"))

    def at_least(value: Column) -> Column:
        return F.greatest(value.cast("double"), small)

    return joined.where(F.col("lines").isNotNull() | F.col("was_clicked")).select(
        "item_id",
        at_least(F.col("buyers")).alias("buyers"),
        at_least(lines).alias("purchases"),
        at_least(amount).alias("amount"),
        "site_no",
    )


def search_best(buys: DataFrame, clicks: DataFrame, items: DataFrame, prices: DataFrame, **kw) -> DataFrame:
    """Score of three ranks weighted by age on display, and the conversion rate; one row per item."""
    weight = floor_weight(F.col("open_weight"))
    log = pin(
        buys.select("item_id", "buyers", "purchases", "amount")
        .join(clicks.select("item_id", "visitors", "click_count"), "item_id")
        .join(items.select("item_id", F.col("site_no").alias("row_site"), "open_weight"), "item_id")
        .select(
            "item_id",
            "row_site",
            "buyers",
            "purchases",
            "amount",
            repair_count(F.col("visitors").cast("double"), F.col("buyers")).alias("click_visitors"),
            repair_count(F.col("click_count").cast("double"), F.col("purchases")).alias("clicks"),
            weight.alias("weight"),
        )
        .withColumns(
            {
                "w_orders": F.col("purchases") * F.col("weight"),
                "w_amount": F.col("amount") * F.col("weight"),
                "w_clicks": F.col("clicks") * F.col("weight"),
            }
        )
    )
    rows = log.count()
    ranked = log
    for value, out in (("w_orders", "order_rank"), ("w_amount", "amount_rank"), ("w_clicks", "click_rank")):
        order = [(value, "desc"), ("item_id", "asc"), ("row_site", "asc")]
        ranked = position(ranked, order, (), out, rows=rows, **kw)
    conversion = F.round(
        ratio(ratio(F.col("purchases"), F.col("clicks")) * F.col("buyers"), F.col("click_visitors")) * 100, 2
    )
    per_item = ranked.groupBy("item_id").agg(
        F.min(conversion).alias("conversion"),
        F.min("clicks").alias("click_count"),
        F.min("click_visitors").alias("click_visitors"),
        F.min("order_rank").alias("order_rank"),
        F.min("amount_rank").alias("amount_rank"),
        F.min("click_rank").alias("click_rank"),
        F.max("amount").alias("amount"),
        F.max("purchases").alias("purchases"),
    )
    site = prices.groupBy("item_id").agg(F.max("site_no").alias("site_no"))
    return (
        per_item.withColumn("score", F.round(reciprocal_rank_score(SCORE_WEIGHTS), 4))
        .join(site, "item_id")
        .select(
            "item_id", "site_no", "purchases", "amount", "score", "conversion", "click_visitors", "click_count"
        )
    )
