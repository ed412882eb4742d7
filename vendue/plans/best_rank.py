"""Daily best-seller ranks: reciprocal-rank form and normalised form.

Order and click logs are reduced to one row per item and site before they meet
the item master, so joins run on counts, not on log rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.functions.scoring import (
    feature_bounds,
    log_scale,
    min_max_scale,
    rank_score,
    reciprocal_rank_score,
    weighted_sum,
)
from vendue.functions.text import alias_value
from vendue.operators.ranking import position, rerank, top_k
from vendue.session import pin

# Fixed values of the shop's ranking.
RANK_WEIGHTS = {"order_rank": 0.5, "amount_rank": 0.2, "click_rank": 0.3}
NORM_WEIGHTS = {"order_count_log_norm": 0.5, "amount_log_norm": 0.2, "click_count_log_norm": 0.3}
FEATURES = ["order_count", "click_count", "amount"]
SITE_ALIAS = {"6101": "6100"}
ALL_SITE = "6005"
SITE_COPIES = [("6200", "6001"), ("6300", "6004")]
EVENT_PENALTY = 100
NEW_ITEM_DAYS = 7
PRODUCT_ROWS = 300_000
FADED_ITEMS = {1000010008801: (date(2017, 9, 11), 5)}
BOOSTED_CLASSES = ("6002", ("2000000057", "2000000058"), 123456, 4)


def net_amount() -> Column:
    """Amount paid: order amount less both discounts."""
    return F.col("amount") - F.col("own_discount") - F.col("partner_discount")


def br_items(items: DataFrame, prices: DataFrame, as_of: date) -> DataFrame:
    """Sellable items per site with the largest low price and the new-item flag."""
    by_site = prices.groupBy("item_id", "site_no").agg(F.max("low_price").alias("sell_price"))
    fresh = (F.col("new_flag") == "Y") & (F.col("registered") >= F.lit(as_of - timedelta(days=NEW_ITEM_DAYS)))
    return (
        items.where(F.col("sell_status") == 20)
        .select("item_id", "brand_id", "registered", "new_flag", "origin_id", "category_id")
        .join(by_site, "item_id")
        .select(
            "item_id",
            "site_no",
            "brand_id",
            "sell_price",
            "origin_id",
            "category_id",
            F.when(fresh, "Y").otherwise("N").alias("new_item"),
        )
    )


def br_clicks(
    clicks: DataFrame,
    prices: DataFrame | None = None,
    by: Sequence[str] = (),
    site_alias: Mapping[str, str] = SITE_ALIAS,
    match_site: bool = False,
) -> DataFrame:
    """One row per item, address and site (and segment), for items that have a price.

    Prices may be left out where the rows are counted for the item frame, which
    holds priced items only.
    """
    rows = (
        clicks.where(F.col("visitor_id").isNotNull())
        .select("item_id", "ip", alias_value("site_no", site_alias).alias("site_no"), *by)
        .distinct()
    )
    if prices is None:
        return rows
    keys = ["item_id", "site_no"] if match_site else ["item_id"]
    return rows.join(prices.select(*keys).distinct(), keys, "left_semi")


def br_counts(orders: DataFrame, click_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Orders, amount paid and clicks per item and site (and segment) on one row.

    Without clicks the click count is missing; without orders the order figures are 0.
    """
    keys = ["item_id", "site_no", *by]
    ordered = orders.groupBy(*keys).agg(
        F.countDistinct("order_no").alias("order_count"),
        F.sum(net_amount()).alias("amount"),
    ).withColumn("click_count", F.lit(None).cast("bigint"))
    clicked = click_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count")).withColumns(
        {"order_count": F.lit(0).cast("bigint"), "amount": F.lit(0).cast("bigint")}
    )
    return ordered.unionByName(clicked).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in FEATURES]
    )


def floor_zero(col: Column) -> Column:
    return F.when(col < 0, F.lit(0)).otherwise(col)


def with_event_flag(df: DataFrame, events: DataFrame) -> DataFrame:
    """Column ``event`` = Y for items of the event list."""
    listed = events.select("item_id").distinct().withColumn("_hit", F.lit(True))
    return df.join(listed, "item_id", "left").withColumn(
        "event", F.when(F.col("_hit"), "Y").otherwise("N")
    ).drop("_hit")


def br_frame(items: DataFrame, counts: DataFrame, events: DataFrame) -> DataFrame:
    """One row per item: all sellable items, with counts where there are any."""
    per_item = (
        items.join(counts, ["item_id", "site_no"], "left")
        .groupBy("item_id")
        .agg(
            F.max("site_no").alias("site_no"),
            F.max("sell_price").alias("sell_price"),
            F.max("brand_id").alias("brand_id"),
            F.max("new_item").alias("new_item"),
            F.max("origin_id").alias("origin_id"),
            F.max("category_id").alias("category_id"),
            F.sum("order_count").alias("order_count"),
            F.sum("click_count").alias("click_count"),
            floor_zero(F.sum("amount")).alias("amount"),
        )
    )
    return with_event_flag(per_item, events)


def _feature_ranks(frame: DataFrame, rows: int, **kw) -> DataFrame:
    ranked = position(frame, [("order_count", "desc"), ("item_id", "asc")], (), "order_rank", "rank", rows=rows, **kw)
    ranked = position(ranked, [("amount", "desc"), ("item_id", "asc")], (), "amount_rank", rows=rows, **kw)
    return position(ranked, [("click_count", "desc"), ("item_id", "asc")], (), "click_rank", rows=rows, **kw)


def _total_rank(scored: DataFrame, rows: int, **kw) -> DataFrame:
    order = [("raw_score", "desc"), ("item_id", "asc")]
    return (
        position(scored, order, (), "total_rank", rows=rows, **kw)
        .withColumn("total_score", F.round("raw_score", 4))
        .drop("raw_score")
    )


def br_feature_ranks(frame: DataFrame, **kw) -> tuple[DataFrame, int]:
    """The frame with ranks of orders, amount and clicks, for both scores to start from, and its rows."""
    if "order_rank" in frame.columns:
        return frame, frame.count()
    frame = pin(frame)
    rows = frame.count()
    return _feature_ranks(frame, rows, **kw), rows


def br_rank_score(frame: DataFrame, **kw) -> DataFrame:
    """Reciprocal ranks of orders, amount and clicks, weighted; then the total rank."""
    ranked, rows = br_feature_ranks(frame, **kw)
    scored = ranked.withColumn("raw_score", reciprocal_rank_score(RANK_WEIGHTS))
    return _total_rank(scored, rows, **kw)


def br_norm_score(frame: DataFrame, **kw) -> DataFrame:
    """Logs of orders, amount and clicks scaled to 0..100, weighted; then the total rank."""
    ranked, rows = br_feature_ranks(frame, **kw)
    ranked = log_scale(ranked, FEATURES)
    logs = [f"{c}_log" for c in FEATURES]
    scaled = min_max_scale(ranked, logs, feature_bounds(ranked, logs))
    scored = scaled.withColumn("raw_score", weighted_sum(NORM_WEIGHTS))
    return _total_rank(scored, rows, **kw).drop(*logs, *[f"{c}_norm" for c in logs])


def event_penalty(ranked: DataFrame, add: int = EVENT_PENALTY, all_site: str = ALL_SITE, **kw) -> DataFrame:
    """Event items lose ranks, all are numbered again; rows are labelled with the all-site code."""
    shifted = ranked.withColumnRenamed("site_no", "sell_site").withColumn(
        "_pushed", F.col("total_rank") + F.when(F.col("event") == "Y", F.lit(add)).otherwise(F.lit(0))
    )
    order = [("_pushed", "asc"), ("total_score", "desc"), ("item_id", "asc")]
    return (
        position(shifted, order, (), "final_rank", **kw)
        .drop("_pushed")
        .withColumn("display_site", F.lit(all_site))
    )


def copy_sites(
    df: DataFrame, copies: Sequence[tuple[str, str]] = SITE_COPIES, own: bool = True, keep: bool = True
) -> DataFrame:
    """Rows shown on further sites: on the selling site itself, and on copies of it.

    One pass: each row carries the list of sites it is shown on.
    """
    extra = [F.when(F.col("sell_site") == source, F.lit(target)) for source, target in copies]
    own_site = [F.col("sell_site")] if own else []
    kept = [F.col("display_site")] if keep else []
    shown = F.filter(F.array(*kept, *own_site, *extra), lambda s: s.isNotNull())
    return df.withColumn("display_site", F.explode(shown))


def final_rank(
    df: DataFrame,
    as_of: date,
    fade: Mapping[int, tuple[date, int]] = FADED_ITEMS,
    **kw,
) -> DataFrame:
    """Rank inside each display site; faded items lose ranks per day since a date, then again."""
    ties = [("total_score", "desc"), ("item_id", "asc"), ("sell_site", "asc")]
    ranked = position(df, [("final_rank", "asc"), *ties], ["display_site"], "_site_rank", **kw)
    ranked = ranked.drop("final_rank").withColumnRenamed("_site_rank", "final_rank")
    if not fade:
        return ranked

    def slower(frame: DataFrame) -> Column:
        rank = F.col("final_rank")
        for item, (start, per_day) in fade.items():
            lost = (as_of - start).days * per_day
            listed = F.col("item_id").cast("string") == F.lit(str(item))
            rank = F.when(listed, F.col("final_rank") + lost).otherwise(rank)
        return rank

    return rerank(ranked, ["display_site"], slower, "final_rank", ties, **kw)


def product_list(
    ranked: DataFrame,
    categories: DataFrame,
    as_of: date,
    k: int = PRODUCT_ROWS,
    all_site: str = ALL_SITE,
    boost: tuple[str, Sequence[str], int, int] = BOOSTED_CLASSES,
) -> DataFrame:
    """Scores of 10000/rank for the product table, best ``k`` rows.

    Sites other than the all-site keep items of used categories only; two classes
    of one site get a mark and a multiplied score.
    """
    site, classes, mark, times = boost
    used = categories.where(F.col("in_use") == "Y").select("category_id", "medium_id")
    boosted = (F.col("display_site") == site) & F.col("medium_id").isin(list(classes))
    score = rank_score(F.col("final_rank"))
    on_all = F.col("display_site") == all_site
    rows = (
        ranked.join(used, "category_id", "left")
        .where(on_all | F.col("medium_id").isNotNull())
        .withColumn("mark", F.when(~on_all & boosted, F.lit(mark)).otherwise(F.lit(0)))
        .withColumn("score", F.when(~on_all & boosted, score * F.lit(times)).otherwise(score))
        .select(
            F.date_format(F.lit(as_of + timedelta(days=1)), "yyMMdd").alias("score_date"),
            "display_site",
            "sell_site",
            "item_id",
            "brand_id",
            "origin_id",
            "new_item",
            "mark",
            "score",
        )
    )
    order = [("score", "desc"), ("item_id", "asc"), ("display_site", "asc"), ("sell_site", "asc")]
    return top_k(rows, order, k)


def final_products(plain: DataFrame, normal: DataFrame, all_site: str = ALL_SITE) -> DataFrame:
    """Product list of the reciprocal run for the all-site, of the normalised run for the others."""
    return plain.where(F.col("display_site") == all_site).unionByName(
        normal.where(F.col("display_site") != all_site)
    )
