"""Search model: counts of search and item clicks, growth, twelve features, four scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.functions.pages import PREDICATES
from vendue.functions.scoring import feature_bounds, freshness, growth, log_scale, min_max_scale, ratio, weighted_sum
from vendue.plans.best_rank import net_amount
from vendue.session import pin

# Fixed values of the shop's search model
SEARCH_GROWTH_SCALE = 10_000_000.0
CLICK_GROWTH_SCALE = 100_000_000.0
OFFLINE_BUSINESS = "10"
DEAL_DETAIL = 80
LOGGED = [
    "click_growth", "search_growth", "search_count", "click_count", "order_count", "cart_count", "review_count",
    "amount", "unit_price", "offline_count",
]
PLAIN = ["freshness", "discount_rate"]
NEWNESS = {"search_growth": 0.4, "click_growth": 0.4, "freshness": 0.2}
POPULARITY = {
    "cart_count": 0.25, "order_count": 0.2, "review_count": 0.2, "search_count": 0.15, "click_count": 0.1, "amount": 0.1,
}
PRICE = {"unit_price": 0.6, "discount_rate": 0.4}
# score name -> weights of newness, popularity and price
SCORE_SETS = {"first_score": (0.2, 0.5, 0.3), "second_score": (0.5, 0.2, 0.3), "third_score": (0.3, 0.5, 0.2)}
FOURTH = {
    "cart_count": 0.15, "order_count": 0.35, "review_count": 0.25, "search_count": 0.05, "offline_count": 0.1,
    "amount": 0.1,
}
LARGE_CLASSES = ["1000000007"]
MEDIUM_CLASSES = [
    "1000020864", "2000000017", "2000000019", "2000000020", "2000000021", "2000000022", "2000000023", "2000000024",
    "2000000025", "2000000026", "2000000027", "2000000028",
]


def _marks(rows: DataFrame, **weights: Column) -> DataFrame:
    zero = F.lit(0)
    names = ("search_detail", "search_cart", "item_detail", "cart")
    return rows.select("item_id", "day", *[weights.get(n, zero).cast("bigint").alias(n) for n in names])


def search_marks(views: DataFrame, reactions: DataFrame, attribution: DataFrame) -> DataFrame:
    """Log rows marked as search click, search cart, item click and cart, with item and day.

    A native item page whose URL is an item page as well counts twice.
    """
    p = {name: build for name, build in PREDICATES.items()}
    device = F.col("device")
    from_search = device.isin("PC", "MW") & p["item_url"]() & p["search_referrer"]()
    native = (device == "MA") & p["item_screen"]()
    searched_cart = p["search_url"]() | ((device == "MA") & p["search_screen"]())
    return (
        _marks(views, search_detail=from_search, item_detail=native.cast("int") + p["item_url"]().cast("int"))
        .unionByName(_marks(reactions, search_detail=p["search_area"]()))
        .unionByName(_marks(attribution, search_cart=searched_cart, cart=F.lit(1)))
    )


def search_signals(views: DataFrame, reactions: DataFrame, attribution: DataFrame, as_of: date) -> DataFrame:
    """Counts per item for the day before, the day eight days before and the last three days.

    One pass over the three logs and one aggregation for all channels and days.
    """
    d1, d3, d8 = (F.lit(as_of - timedelta(days=n)) for n in (1, 3, 8))
    day = F.col("day")
    yesterday, last_week, three = day == d1, day == d8, day.between(d3, d1)
    search, item = F.col("search_detail") + F.col("search_cart"), F.col("item_detail") + F.col("cart")
    marks = search_marks(
        *[df.where(day.between(d3, d1) | (day == d8)) for df in (views, reactions, attribution)]
    )

    def total(value: Column, when: Column) -> Column:
        return F.sum(F.when(when, value).otherwise(0))

    counts = marks.groupBy("item_id").agg(
        total(search, yesterday).alias("search_d1"),
        total(search, last_week).alias("search_d8"),
        total(F.col("search_detail"), three).alias("search_count"),
        total(item, yesterday).alias("all_d1"),
        total(item, last_week).alias("all_d8"),
        total(F.col("item_detail"), three).alias("all_3d"),
        total(F.col("cart"), three).alias("cart_count"),
    )
    seen = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in counts.columns if c != "item_id"])
    return counts.where(seen).select(
        "item_id",
        "search_d1",
        "search_d8",
        "search_count",
        subtract_counts("all_d1", "search_d1").alias("click_d1"),
        subtract_counts("all_d8", "search_d8").alias("click_d8"),
        subtract_counts("all_3d", "search_count").alias("click_count"),
        "cart_count",
    )


def subtract_counts(a: str, b: str) -> Column:
    """a - b, not below 0; a missing b counts as 0."""
    return F.greatest(F.col(a) - F.coalesce(F.col(b), F.lit(0)), F.lit(0))


def with_growth(signals: DataFrame) -> DataFrame:
    """Growth of search and click shares from day -8 to day -1, in place of the day counts."""
    signals = pin(signals)
    days = ["search_d1", "search_d8", "click_d1", "click_d8"]
    total = signals.agg(*[F.sum(c).cast("double").alias(c) for c in days]).first()

    def grown(kind: str, scale: float) -> Column:
        now, then = f"{kind}_d1", f"{kind}_d8"
        value = growth(F.col(now), F.col(then), total[now] or 0.0, total[then] or 0.0, scale)
        return F.coalesce(value, F.lit(0.0))

    return signals.withColumns(
        {
            "search_growth": grown("search", SEARCH_GROWTH_SCALE),
            "click_growth": grown("click", CLICK_GROWTH_SCALE),
        }
    ).drop(*days)


def growth_rate(now: DataFrame, then: DataFrame, scale: float, days: int = 7) -> DataFrame:
    """Growth of each item's share between two count tables; an item may be in one of them only."""
    stacked = now.select("item_id", F.col("n").alias("now"), F.lit(0).cast("bigint").alias("then")).unionByName(
        then.select("item_id", F.lit(0).cast("bigint").alias("now"), F.col("n").alias("then"))
    )
    per_item = pin(stacked.groupBy("item_id").agg(F.sum("now").alias("now"), F.sum("then").alias("then")))
    total = per_item.agg(F.sum("now").alias("now"), F.sum("then").alias("then")).first()
    rate = growth(F.col("now"), F.col("then"), float(total["now"] or 0), float(total["then"] or 0), scale, days)
    return per_item.select("item_id", rate.alias("growth"))


def order_features(orders: DataFrame, since: date) -> DataFrame:
    """Orders, net amount, unit price and discount rate per item; items sold at a positive net amount."""
    discount = F.col("own_discount") + F.col("partner_discount")
    per_item = orders.where((F.col("order_date") >= F.lit(since)) & (F.col("target_code") == "1")).groupBy("item_id").agg(
        F.countDistinct("order_no").alias("order_count"),
        F.sum(net_amount()).alias("amount"),
        F.sum(discount).alias("_discount"),
        F.sum("amount").alias("_gross"),
        F.sum("qty").alias("_qty"),
    )
    return per_item.where((F.col("amount") > 0) & (F.col("_qty") > 0)).select(
        "item_id",
        "order_count",
        "amount",
        ratio(F.col("amount"), F.col("_qty")).alias("unit_price"),
        F.greatest(ratio(F.col("_discount"), F.col("_gross")), F.lit(0.0)).alias("discount_rate"),
    )


def offline_freq(sales: DataFrame, mapping: DataFrame, business: str = OFFLINE_BUSINESS) -> DataFrame:
    """Sales in stores per online item."""
    known = mapping.where((F.col("business_code") == business) & F.col("item_id").isNotNull()).select(
        "offline_item_id", "item_id"
    )
    counted = sales.groupBy("offline_item_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(known, "offline_item_id").groupBy("item_id").agg(F.sum("n").alias("offline_count"))


def merge_features(features: Sequence[DataFrame], prices: DataFrame) -> DataFrame:
    """Feature tables on one row per item; the largest sell price fills a missing unit price.

    The tables are stacked and grouped once instead of joined one after another.
    """
    stacked = features[0]
    for table in features[1:]:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    names = [c for c in stacked.columns if c != "item_id"]
    merged = stacked.groupBy("item_id").agg(*[F.max(c).alias(c) for c in names])
    filled = merged.na.fill(0, [c for c in names if c != "unit_price"])
    price = prices.groupBy("item_id").agg(F.max(F.col("sell_price").cast("bigint")).alias("_price"))
    return filled.join(price, "item_id").withColumn(
        "unit_price", F.coalesce("unit_price", F.col("_price").cast("double"))
    ).drop("_price")


def sm_features(
    signals: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    offline: DataFrame,
    prices: DataFrame,
    items: DataFrame,
    as_of: date,
) -> DataFrame:
    """Twelve features per item of the master; deals are left out."""
    merged = merge_features([with_growth(signals), orders, reviews, offline], prices)
    age = F.date_diff(F.lit(as_of), F.to_date("shown_from"))
    master = items.where(F.col("sell_type_detail") != DEAL_DETAIL).select(
        "item_id", "brand_id", "category_id", "shown_from", "new_flag", freshness(age).alias("freshness")
    )
    return merged.join(master, "item_id")


def sm_scores(
    features: DataFrame,
    weights: Mapping[str, tuple[float, float, float]] = SCORE_SETS,
    debug: bool = False,
) -> DataFrame:
    """Three scores from newness, popularity and price, and a fourth; ``debug`` keeps all columns."""
    logged = pin(log_scale(features, LOGGED))
    scaled_cols = [f"{c}_log" for c in LOGGED] + PLAIN
    scaled = min_max_scale(logged, scaled_cols, feature_bounds(logged, scaled_cols), invert=["unit_price_log"])

    def norm(name: str) -> str:
        return f"{name}_norm" if name in PLAIN else f"{name}_log_norm"

    def index(part: Mapping[str, float]) -> Column:
        return weighted_sum({norm(name): w for name, w in part.items()})

    indexes = [index(part) for part in (NEWNESS, POPULARITY, PRICE)]
    out = scaled.withColumns(
        {
            name: reduce(add, [F.lit(w) * value for w, value in zip(ws, indexes)])
            for name, ws in weights.items()
        }
        | {"fourth_score": index(FOURTH)}
    )
    if debug:
        return out
    return out.drop(*[f"{c}_log" for c in LOGGED], *[norm(c) for c in LOGGED + PLAIN])


def score_by_site(scores: DataFrame, prices: DataFrame) -> DataFrame:
    """Scores on every site that has a price for the item."""
    return scores.join(prices.select("item_id", "site_no").distinct(), "item_id")


def items_in_classes(
    items: DataFrame,
    categories: DataFrame,
    large: Sequence[str] = LARGE_CLASSES,
    medium: Sequence[str] = MEDIUM_CLASSES,
) -> DataFrame:
    """Items under one of the large or medium classes."""
    listed = categories.where(F.col("large_id").isin(list(large)) | F.col("medium_id").isin(list(medium)))
    return items.join(listed.select("category_id"), "category_id", "left_semi").select("item_id")
