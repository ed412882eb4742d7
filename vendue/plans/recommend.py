"""Recommendation data: baskets and rules, interactions, categorised similarity, lists, cascade."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.functions.scoring import ratio
from vendue.functions.text import present
from vendue.operators.ranking import number_rows, position, small_or_plain, top_n_per_group
from vendue.operators.similarity import item_pairs
from vendue.session import pin

# Fixed values of the shop's lists
UNBRANDED = "9999999999"
BEST_ROWS, NEW_ROWS, BRAND_ROWS, SIMILAR_ROWS, PAGE_ROWS = 30, 30, 20, 20, 10
NEW_DAYS = 31
CASCADE_ROWS = 30

# Baskets and rules ---------------------------------------------------------


def basket_rows(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct items of each order, for items on normal sale."""
    on_sale = items.where(F.col("sell_type").isin(10, 20) & (F.col("sell_status") == 20)).select("item_id")
    return orders.select("order_no", "item_id").join(on_sale, "item_id", "left_semi").distinct()


def baskets(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One text line of items per order, with the number of order lines.

    A line holds its whole order by definition; ``basket_rows`` has the same items
    as rows, and the rules start from those.
    """
    on_sale = items.where(F.col("sell_type").isin(10, 20) & (F.col("sell_status") == 20)).select("item_id")
    lines = (
        orders.select("order_no", "item_id")
        .join(on_sale, "item_id", "left_semi")
        .groupBy("order_no", "item_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return lines.groupBy("order_no").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("item_id"))).alias("items"),
        F.sum("n").alias("line_count"),
    )


def item_frequency(rows: DataFrame) -> DataFrame:
    """Baskets per item."""
    return rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("frequency"))


def map_ids(df: DataFrame, mapping: DataFrame, code: str = "code", target: str = "item_id") -> DataFrame:
    """Replace a code by the id it stands for; rows without one are left out."""
    return df.join(mapping.select(code, target), code).drop(code)


def _rule_measures(both: Column, first: Column, second: Column, total: int) -> dict[str, Column]:
    n = F.lit(float(total))
    confidence = ratio(both, first)
    return {
        "support": both / n,
        "confidence": confidence,
        "lift": (both * n) / (first.cast("double") * second),
        "conviction": F.try_divide(F.lit(1.0) - second / n, F.lit(1.0) - confidence),
    }


def pair_rules(rows: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules of one item to one item, from (order_no, item_id) rows.

    Items below the support cannot be in a rule and go first, so what is left of a
    basket is bounded by the support, however long it was; long ones are sliced.
    """
    rows = pin(rows.select("order_no", "item_id"))
    total = rows.select(F.countDistinct("order_no")).first()[0]
    frequency = small_or_plain(item_frequency(rows).where(F.col("frequency") > min_support * total))
    kept = rows.join(frequency.select("item_id"), "item_id", "left_semi")
    both = (
        item_pairs(kept.withColumnRenamed("order_no", "user_id"))
        .select(F.col("item_id").alias("antecedent"), F.col("similar_id").alias("consequent"))
        .groupBy("antecedent", "consequent")
        .agg(F.count(F.lit(1)).alias("both"))
        .where(F.col("both") > min_support * total)
    )
    first = frequency.select(F.col("item_id").alias("antecedent"), F.col("frequency").alias("_first"))
    second = frequency.select(F.col("item_id").alias("consequent"), F.col("frequency").alias("_second"))
    measures = _rule_measures(F.col("both"), F.col("_first"), F.col("_second"), total)
    return (
        both.join(first, "antecedent")
        .join(second, "consequent")
        .withColumns(measures)
        .where(F.col("confidence") > min_confidence)
        .select("antecedent", "consequent", *measures)
    )


def association_rules(
    rows: DataFrame, min_support: float, min_confidence: float, by_first: bool = False
) -> DataFrame:
    """Rules of one item to a set of items, from frequent patterns (FP-growth).

    Lift and conviction use the frequency of the whole consequent, or with
    ``by_first`` that of its first item only.
    """
    from pyspark.ml.fpm import FPGrowth

    rows = pin(rows.select("order_no", "item_id"))
    total = rows.select(F.countDistinct("order_no")).first()[0]
    frequency = item_frequency(rows).where(F.col("frequency") > min_support * total)
    kept = rows.join(small_or_plain(frequency.select("item_id")), "item_id", "left_semi")
    # at most as many items per basket as pass the support
    arrays = pin(kept.groupBy("order_no").agg(F.collect_set("item_id").alias("items")))
    # the model counts support over the rows it sees; baskets without frequent items count as well
    seen = arrays.count()
    share = min(1.0, min_support * total / seen) if seen else 1.0
    found = FPGrowth(itemsCol="items", minSupport=share).fit(arrays).freqItemsets
    sets = pin(found.select(F.array_sort("items").alias("items"), F.col("freq")))
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("antecedent"), F.col("freq").alias("_first"))
    rules = (
        sets.where((F.size("items") > 1) & (F.col("freq") > min_support * total))
        .withColumn("antecedent", F.explode("items"))
        .withColumn("consequent", F.array_except("items", F.array("antecedent")))
        .join(single, "antecedent")
    )
    key = F.array(F.col("consequent")[0]) if by_first else F.col("consequent")
    second = sets.select(F.col("items").alias("_key"), F.col("freq").alias("_second"))
    measures = _rule_measures(F.col("freq"), F.col("_first"), F.col("_second"), total)
    return (
        rules.withColumn("_key", key)
        .join(second, "_key")
        .withColumns(measures)
        .where(F.col("confidence") > min_confidence)
        .select("antecedent", "consequent", *measures)
    )


def rule_lines(rules: DataFrame) -> DataFrame:
    """Text lines of rules: one per item of the consequent, figures with 7 decimals."""
    figures = [F.format_string("%.7f", F.col(c)) for c in ("support", "confidence", "lift")]
    return rules.withColumn("item", F.explode("consequent")).select(
        F.concat_ws("|", F.col("antecedent").cast("string"), F.col("item").cast("string"), *figures).alias("value")
    )


def rules_for(items: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules whose antecedent is one of the items."""
    return rules.join(items.select(F.col("item_id").alias("antecedent")).distinct(), "antecedent", "left_semi")


# Interactions ---------------------------------------------------------------


def index_users(df: DataFrame, col: str, out: str = "user_index") -> DataFrame:
    """Dense numbers from 0 for the values of a text column, in text order."""
    keys = position(df.select(col).distinct(), [(col, "asc")], out=out).withColumn(out, F.col(out) - 1)
    return df.join(small_or_plain(keys), col)


def interactions(df: DataFrame, user: str, item: str, ts: str) -> DataFrame:
    """Count per user, item and time, with the user as a dense number."""
    counted = df.groupBy(user, item, ts).agg(F.count(F.lit(1)).alias("cnt"))
    return index_users(counted, user).select("user_index", item, "cnt", ts)


# Similarity to lists ----------------------------------------------------------


def similar_with_category(sim: DataFrame, items: DataFrame, categories: DataFrame, side: str) -> DataFrame:
    """Category of one side of similar pairs; items that cannot be searched are left out."""
    prefix = "" if side == "item_id" else "similar_"
    known = (
        items.where(F.col("searchable") == "Y")
        .join(categories, "category_id")
        .select(
            F.col("item_id").alias(side),
            F.col("small_id").alias(f"{prefix}small_id"),
            F.concat_ws("^", "large_id", "medium_id", "small_id", "category_name").alias(f"{prefix}category_path"),
        )
    )
    return sim.join(known, side)


def same_category(sim: DataFrame, items: DataFrame, categories: DataFrame, same_class: bool = True) -> DataFrame:
    """Similar pairs of searchable items with both categories; of one small class unless told otherwise."""
    both = similar_with_category(similar_with_category(sim, items, categories, "item_id"), items, categories, "similar_id")
    return both.where(F.col("small_id") == F.col("similar_small_id")) if same_class else both


def with_sites(sim: DataFrame, prices: DataFrame) -> DataFrame:
    """One row per pair and site that sells the candidate."""
    return sim.join(prices.select(F.col("item_id").alias("similar_id"), "site_no").distinct(), "similar_id")


def categorise(
    sim: DataFrame, items: DataFrame, categories: DataFrame, prices: DataFrame, same_class: bool = True
) -> DataFrame:
    """Similar pairs of searchable items of one small class, on every site that sells the candidate."""
    return with_sites(same_category(sim, items, categories, same_class), prices).select(
        "item_id", "similar_id", "site_no", "value", "category_path", "similar_category_path"
    )


def blend_scores(prev: DataFrame, today: DataFrame, keys: Sequence[str] = ("item_id", "similar_id", "site_no")) -> DataFrame:
    """Mean of yesterday's and today's score, or the one there is; other columns from yesterday first."""
    keys = list(keys)
    rest = [c for c in today.columns if c not in (*keys, "value")]
    stacked = prev.withColumn("_old", F.lit(1)).unionByName(today.withColumn("_old", F.lit(0)))
    return (
        stacked.groupBy(*keys)
        .agg(
            F.avg("value").alias("value"),
            *[F.coalesce(F.max(F.when(F.col("_old") == 1, F.col(c))), F.max(F.when(F.col("_old") == 0, F.col(c)))).alias(c)
              for c in rest],
        )
        .select(*today.columns)
    )


def similar_top(sim_by_site: DataFrame, n: int = SIMILAR_ROWS) -> DataFrame:
    """Best candidates per item and site."""
    return top_n_per_group(
        sim_by_site, ["item_id", "site_no"], [("value", "desc"), ("similar_id", "asc")], n, "rank"
    ).select("item_id", "site_no", "similar_id", "rank")


def category_best(categories: DataFrame, items: DataFrame, scores: DataFrame) -> DataFrame:
    """Scored items of used categories, sorted by category and rising score."""
    used = categories.where(F.col("in_use") == "Y").select("category_id", "category_name")
    return (
        items.select("item_id", "category_id")
        .join(scores.select("item_id", "third_score"), "item_id")
        .join(used, "category_id")
        .orderBy("category_id", "third_score", "item_id")
    )


def brand_best(brands: DataFrame, items: DataFrame, scores: DataFrame) -> DataFrame:
    """Scored items of used brands, sorted by brand and rising score."""
    used = brands.where(F.col("in_use") == "Y").select("brand_id", "brand_name")
    return (
        items.select("item_id", "brand_id")
        .join(scores.select("item_id", "third_score"), "item_id")
        .join(used, "brand_id")
        .orderBy("brand_id", "third_score", "item_id")
    )


def brand_top(items: DataFrame, scores: DataFrame, n: int = BEST_ROWS) -> DataFrame:
    """Best items of each brand."""
    rows = items.where(
        (F.col("sell_status") == 20) & present("brand_id") & (F.col("brand_id") != UNBRANDED)
    ).join(scores.select("item_id", "third_score"), "item_id")
    best = top_n_per_group(rows, ["brand_id"], [("third_score", "desc"), ("item_id", "asc")], n, "rank")
    return best.select("brand_id", F.lit("best").alias("kind"), F.col("item_id").cast("string").alias("id"), "rank")


def brand_new(items: DataFrame, scores: DataFrame, as_of: date, n: int = NEW_ROWS, days: int = NEW_DAYS) -> DataFrame:
    """Best new items of each brand."""
    age = F.date_diff(F.lit(as_of), F.to_date("shown_from"))
    rows = (
        items.where((F.col("sell_status") == 20) & present("brand_id") & age.between(0, days))
        .join(scores.select("item_id", "third_score"), "item_id")
        .select("brand_id", "item_id", "shown_from", F.coalesce("third_score", F.lit(0.0)).alias("score"))
        .distinct()
    )
    order = [("score", "desc"), ("shown_from", "desc"), ("item_id", "asc")]
    best = top_n_per_group(rows, ["brand_id"], order, n, "rank")
    return best.select("brand_id", F.lit("new").alias("kind"), F.col("item_id").cast("string").alias("id"), "rank")


def related_brands(items: DataFrame, sim: DataFrame, n: int = BRAND_ROWS) -> DataFrame:
    """Brands of similar items; a brand pair counts as often as its best item does."""
    branded = items.where(present("brand_id")).select("item_id", "brand_id")
    other = branded.select(F.col("item_id").alias("similar_id"), F.col("brand_id").alias("other_brand"))
    counted = (
        sim.select("item_id", "similar_id")
        .distinct()
        .join(other, "similar_id")
        .groupBy("item_id", "other_brand")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    pairs = (
        counted.join(branded, "item_id")
        .where((F.col("brand_id") != F.col("other_brand")) & (F.col("brand_id") != UNBRANDED))
        .groupBy("brand_id", "other_brand")
        .agg(F.max("n").alias("n"))
    )
    best = top_n_per_group(pairs, ["brand_id"], [("n", "desc"), ("other_brand", "asc")], n, "rank")
    return best.select("brand_id", F.lit("brand").alias("kind"), F.col("other_brand").alias("id"), "rank")


def clip_lists(clip: DataFrame, per_kind: int = PAGE_ROWS) -> DataFrame:
    """Entries of each kind on one row per brand, at most ``per_kind`` of each."""
    cut = top_n_per_group(clip, ["brand_id", "kind"], [("rank", "asc"), ("id", "asc")], per_kind, "_at")
    entry = F.struct("kind", "rank", "id")
    return cut.groupBy("brand_id").agg(
        F.count(F.lit(1)).alias("entry_count"), F.array_sort(F.collect_list(entry)).alias("entries")
    )


# Cascade ----------------------------------------------------------------------


def list_for_items(
    items: DataFrame, ranked: DataFrame, key: str, limit: int, sites: Sequence[str] | None = None, over_sites: bool = False
) -> DataFrame:
    """Candidates of each item's category or brand on every site, by rank.

    ``ranked`` has the key, site_no, candidate and rank; the candidate is sold on that site. With ``over_sites`` the list
    of a key is cut to ``limit`` over the wanted sites together, before its items get it: what a cascade takes of it.
    """
    rows = ranked.select(key, "site_no", "candidate", "rank")
    if sites is not None:
        rows = rows.where(F.col("site_no").isin(list(sites)))
    short = top_n_per_group(rows, [key, "site_no"], [("rank", "asc"), ("candidate", "asc")], limit, "_at")
    if over_sites:
        first = [("_at", "asc"), ("candidate", "asc"), ("site_no", "asc")]
        short = top_n_per_group(short.select(key, "site_no", "candidate", "_at"), [key], first, limit, "_first")
    return items.select("item_id", key).join(small_or_plain(short), key).select(
        "item_id", "site_no", "candidate", F.col("_at").alias("rank")
    )


def recommend_cascade(
    sources: Sequence[tuple[str, DataFrame]], limit: int = CASCADE_ROWS, sites: Sequence[str] | None = None
) -> DataFrame:
    """Candidates per item on the sites asked for (all by default): first source, then the next, until the limit.

    Each source has item_id, site_no, candidate and rank. A candidate counts once for a
    site, for the first source that names it there; the limit is per item over the sites.
    """
    stacked = None
    for at, (name, frame) in enumerate(sources):
        if sites is not None:
            frame = frame.where(F.col("site_no").isin(list(sites)))
        # what earlier sources name as well is in the result anyhow, so ``limit`` of each source are enough
        rows = frame.select("item_id", "site_no", "candidate", "rank")
        first = [("rank", "asc"), ("candidate", "asc"), ("site_no", "asc")]
        cut = top_n_per_group(rows, ["item_id"], first, limit, "_at").select(
            "item_id", "site_no", "candidate",
            F.struct(F.lit(at).alias("at"), F.col("rank").cast("bigint").alias("rank"), F.lit(name).alias("source")).alias("place"),
        )
        stacked = cut if stacked is None else stacked.unionByName(cut)
    once = stacked.groupBy("item_id", "site_no", "candidate").agg(F.min("place").alias("place"))
    flat = once.select("item_id", "site_no", "candidate", "place.at", F.col("place.rank").alias("_rank"), "place.source")
    order = [("at", "asc"), ("_rank", "asc"), ("candidate", "asc"), ("site_no", "asc")]
    best = top_n_per_group(flat, ["item_id"], order, limit, "position")
    return best.select("item_id", "site_no", "candidate", "source", "position")


# Orders per member ---------------------------------------------------------------


def member_orders(state: DataFrame) -> DataFrame:
    """Orders per member and site, and per member in all (site TOTAL)."""
    return (
        state.groupingSets(
            [[F.col("member_id"), F.col("site_no")], [F.col("member_id")]], F.col("member_id"), F.col("site_no")
        )
        .agg(F.sum("order_count").alias("order_count"), F.grouping("site_no").alias("_all"))
        .withColumn("site_no", F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col("site_no")))
        .drop("_all")
    )


def add_orders(state: DataFrame, new: DataFrame) -> DataFrame:
    """State with one order more per member and site listed in ``new``."""
    more = new.select("member_id", "site_no").withColumn("order_count", F.lit(1).cast("bigint"))
    return (
        state.select("member_id", "site_no", "order_count")
        .unionByName(more)
        .groupBy("member_id", "site_no")
        .agg(F.sum("order_count").alias("order_count"))
    )


def item_master(items: DataFrame) -> DataFrame:
    """Item, brand and category of items with an id."""
    return items.where(F.col("item_id").isNotNull() & (F.col("item_id").cast("string") != "")).select(
        "item_id", "brand_id", "category_id"
    )


# Prediction -----------------------------------------------------------------------


def predict_item_based(sim: DataFrame, ratings: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Similarity-weighted mean of a user's ratings, for items the user has not rated.

    ``wanted`` names the users and items (``user_id, item_id``) to predict for, all by default.
    """
    rated = ratings.select("user_id", "item_id", "rating")
    near = sim.select("item_id", "similar_id", "value")
    if wanted is None:
        rows = rated.join(near, "item_id")
    else:
        keys = wanted.select("user_id", F.col("item_id").alias("similar_id")).distinct()
        rows = keys.join(near, "similar_id").join(rated, ["user_id", "item_id"])
    reached = (
        rows.groupBy("user_id", F.col("similar_id").alias("_item"))
        .agg(
            F.try_divide(F.sum(F.col("value") * F.col("rating")), F.sum("value")).alias("prediction")
        )
        .withColumnRenamed("_item", "item_id")
    )
    return reached.join(rated.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def als_model(ratings: DataFrame, rank: int = 3, reg: float = 0.65, iters: int = 10, seed: int = 1):
    """Matrix factorisation by alternating least squares."""
    from pyspark.ml.recommendation import ALS

    return ALS(
        rank=rank, regParam=reg, maxIter=iters, seed=seed, userCol="user_id", itemCol="item_id",
        ratingCol="rating", coldStartStrategy="drop",
    ).fit(ratings.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating"))


def als_recommend(
    ratings: DataFrame, rank: int = 3, reg: float = 0.65, iters: int = 10, n: int = 10, users: DataFrame | None = None
) -> DataFrame:
    """Best ``n`` items per user by factorised ratings, for all users or for those of ``users``.

    The factorisation takes numbers of 32 bits; users and items of any id are numbered
    densely before and named again after. For a few users name them: all users
    means a score for every user and item.
    """
    numbered, user_ids, item_ids = dense_ids(ratings)
    model = als_model(numbered, rank, reg, iters)
    if users is None:
        found = model.recommendForAllUsers(n)
    else:
        asked = user_ids.join(users.select(F.col("user_id").alias("_user")).distinct(), "_user").select("user_id")
        found = model.recommendForUserSubset(asked, n)
    best = found.select("user_id", F.posexplode("recommendations").alias("_at", "r")).select(
        "user_id", F.col("r.item_id").alias("item_id"),
        (F.col("_at") + 1).cast("bigint").alias("rank"), F.col("r.rating").cast("double").alias("rating"),
    )
    named = best.join(user_ids, "user_id").join(item_ids, "item_id")
    return named.select(F.col("_user").alias("user_id"), F.col("_item").alias("item_id"), "rank", "rating")


def dense_ids(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings with dense numbers for ids, and the numbers of users (``_user``) and items (``_item``)."""
    users = number_rows(ratings.select(F.col("user_id").alias("_user")).distinct(), [("_user", "asc")], "user_id")
    items = number_rows(ratings.select(F.col("item_id").alias("_item")).distinct(), [("_item", "asc")], "item_id")
    users, items = (f.withColumn(c, F.col(c).cast("int")) for f, c in ((users, "user_id"), (items, "item_id")))
    known = ratings.select(F.col("user_id").alias("_user"), F.col("item_id").alias("_item"), "rating")
    return known.join(users, "_user").join(items, "_item").select("user_id", "item_id", "rating"), users, items


def split_ratings(ratings: DataFrame, train: float = 0.95, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of user and item: the same rows on every run."""
    mark = F.pmod(F.xxhash64("user_id", "item_id", F.lit(seed)), F.lit(10_000))
    cut = int(round(train * 10_000))
    return ratings.where(mark < cut), ratings.where(mark >= cut)


def evaluate_mae(
    ratings: DataFrame, fit: Callable[[DataFrame, DataFrame], DataFrame], train: float = 0.95, seed: int = 1
) -> DataFrame:
    """Mean absolute error over held-out ratings.

    ``fit(train_rows, test_keys)`` gives user_id, item_id and prediction; ratings
    without one are not counted, as in the toolset's evaluator.
    """
    known, held = split_ratings(ratings, train, seed)
    predicted = fit(known, held.select("user_id", "item_id"))
    return held.join(predicted, ["user_id", "item_id"]).agg(
        F.avg(F.abs(F.col("rating") - F.col("prediction"))).alias("mae"), F.count(F.lit(1)).alias("tested")
    )
