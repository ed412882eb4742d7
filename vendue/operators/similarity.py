"""Item-item similarity over user-item pairs, exact for users of any size.

The items of a user are cut into slices, and every pair of slices is a task's share
of its own, so one user's pairs spread evenly however many items it has. Users per pair
are added up before they are shuffled. The number of pairs still grows with the square
of a user's items, as the measures are defined over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.operators.ranking import small_or_plain, top_n_per_group
from vendue.session import pin

# Items of a slice of one user; a task pairs two slices.
SLICE = 1_000

ORDER = [("value", "desc"), ("similar_id", "asc")]

# Decimals of rating similarities, so that values that are equal but for rounding are ties.
DIGITS = 9


def _x_log_x(x: Column) -> Column:
    return F.when(x > 0, x * F.ln(x)).otherwise(F.lit(0.0))


def _entropy(*counts: Column) -> Column:
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    out = _x_log_x(total)
    for c in counts:
        out = out - _x_log_x(c)
    return out


def llr_similarity(both: Column, first: Column, second: Column, users: Column) -> Column:
    """1 - 1/(1 + log-likelihood ratio) of a two-by-two table of user counts."""
    k11 = both.cast("double")
    k12, k21 = first - k11, second - k11
    k22 = users - first - second + k11
    ratio = F.lit(2.0) * (
        _entropy(k11 + k12, k21 + k22) + _entropy(k11 + k21, k12 + k22) - _entropy(k11, k12, k21, k22)
    )
    return F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.greatest(ratio, F.lit(0.0)))


def tanimoto_similarity(both: Column, first: Column, second: Column, users: Column) -> Column:
    """Users of both items over users of either."""
    return both.cast("double") / (first + second - both)


COUNT_MEASURES = {"llr": llr_similarity, "tanimoto": tanimoto_similarity}


def item_similarity(
    pairs: DataFrame, n: int | None, measure: str = "llr", slice_items: int = SLICE, items: DataFrame | None = None
) -> DataFrame:
    """The ``n`` most similar items of each item with their rank, from (user_id, item_id) rows.

    Without ``n`` every pair with a user in common is returned, without a rank; ``items``
    (item_id) then names the items whose partners are asked for.
    """
    if measure in RATING_MEASURES:
        return rating_similarity(pairs, n, measure, slice_items, items)
    held = pin(pairs.select("user_id", "item_id").distinct())
    users = held.select(F.countDistinct("user_id")).first()[0]
    item_users = small_or_plain(held.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_users")))
    counted = item_pairs(held, slice_items, items).groupBy("item_id", "similar_id").agg(F.count(F.lit(1)).alias("both"))
    return _best(_score(counted, item_users, COUNT_MEASURES[measure], users), n)


def item_pairs(held: DataFrame, slice_items: int = SLICE, items: DataFrame | None = None, **values: str) -> DataFrame:
    """Ordered pairs of a user's items, with a value column of each side under new names.

    ``items`` limits the first item of the pairs. Users with more than ``slice_items`` items are cut into slices of
    about that many on both sides, and every pair of slices is joined on its own; the others are joined as they are.
    """
    named = [F.col(source).alias(name) for name, source in values.items()]
    first = held if items is None else held.join(items.select("item_id").distinct(), "item_id", "left_semi")

    def joined(ours: DataFrame, theirs: DataFrame, on: list[str], our_slices: list, their_slices: list) -> DataFrame:
        left = ours.select("user_id", "item_id", *named[:1], *our_slices)
        right = theirs.select("user_id", F.col("item_id").alias("similar_id"), *named[1:], *their_slices)
        return left.join(right, on).where(F.col("item_id") != F.col("similar_id"))

    sizes = held.groupBy("user_id").agg((F.floor(F.count(F.lit(1)) / slice_items) + 1).alias("_slices"))
    large = sizes.where(F.col("_slices") > 1)
    if large.isEmpty():
        return joined(first, held, ["user_id"], [], [])
    large = small_or_plain(large)
    small = [f.join(large, "user_id", "left_anti") for f in (first, held)]
    cut = [f.join(large, "user_id") for f in (first, held)]
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1))
    own = F.pmod(F.xxhash64("item_id"), "_slices")
    sliced = joined(*cut, ["user_id", "_a", "_b"], [own.alias("_a"), every.alias("_b")], [own.alias("_b"), every.alias("_a")])
    return joined(*small, ["user_id"], [], []).unionByName(sliced.drop("_a", "_b"))


def _score(counted: DataFrame, item_users: DataFrame, score, users: int) -> DataFrame:
    second = item_users.select(F.col("item_id").alias("similar_id"), F.col("n_users").alias("n_similar"))
    value = score(F.col("both"), F.col("n_users"), F.col("n_similar"), F.lit(float(users)))
    return counted.join(item_users, "item_id").join(second, "similar_id").select(
        "item_id", "similar_id", value.alias("value")
    )


def _best(scored: DataFrame, n: int | None) -> DataFrame:
    return scored if n is None else top_n_per_group(scored, ["item_id"], ORDER, n, "rank")


# Ratings -------------------------------------------------------------------

RATING_MEASURES = ("pearson", "euclidean")


def rating_similarity(
    ratings: DataFrame, n: int | None, measure: str, slice_items: int = SLICE, items: DataFrame | None = None
) -> DataFrame:
    """Similarity of the ratings users gave to both items.

    Needs the sums of every pair, so work grows with the square of a user's items.
    """
    held = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"))
    x, y = F.col("x"), F.col("y")
    sums = (
        item_pairs(held, slice_items, items, x="rating", y="rating")
        .groupBy("item_id", "similar_id")
        .agg(
            F.count(F.lit(1)).alias("both"),
            F.sum((x - y) * (x - y)).alias("gap2"),
            F.covar_pop("x", "y").alias("shared"),
            (F.stddev_pop("x") * F.stddev_pop("y")).alias("spread"),
        )
    )
    if measure == "euclidean":
        value = F.lit(1.0) / (F.lit(1.0) + F.sqrt("gap2") / F.sqrt("both"))
    else:
        # missing where one side's ratings are all alike
        value = F.when(F.col("both") > 1, F.try_divide("shared", "spread"))
    scored = sums.select("item_id", "similar_id", F.round(value, DIGITS).alias("value")).where(F.col("value").isNotNull())
    return _best(scored, n)
