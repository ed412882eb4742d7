"""The most similar users by the items they have in common, exact and without all pairs.

Two sets that are similar to a degree have sizes close to each other, and share an item among the rarest of both: with
sets in the order of rarity, the first ``size - ceil(degree * size) + 1`` items of each. So pairs are formed from rare items
only. The degree starts high; who has enough neighbours of that degree is done, since all others are further
away. The others go on with a lower degree, down to any item in common.

Users with equal sets are one set in all of this. Where even the rarest items are held by many, pairs by items would be
more than the pairs of sets; then the sets that are left are compared with all sets, block by block: items that few hold
by their pairs, the others by a matrix product.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendue.operators.ranking import number_rows, top_n_per_group
from vendue.session import pin

DEGREES = (0.7, 0.4, 0.2, 0.0)
#: Pairs by items for each pair of sets from which on all sets are compared.
PAIRED = 0.1
#: Sets that meet in one task.
SLICE_SETS, BLOCK_SETS = 8192, 16384


def candidates(items: DataFrame, pending: DataFrame, degree: float) -> DataFrame:
    """``user_id, other_id``: pairs of a pending user and another one that may be similar to the degree.

    ``items`` has a row for each user and item with the set's ``size`` and the item's ``place`` by rarity.
    """
    least = F.ceil(F.col("size") * degree - 1e-9)
    rare = items.where(F.col("place") <= F.col("size") - least + 1)
    ours = rare.join(pending, "user_id", "left_semi").select("user_id", "item_id", "size")
    theirs = rare.select(F.col("user_id").alias("other_id"), "item_id", F.col("size").alias("other_size"))
    close = (F.col("other_size") >= F.col("size") * degree - 1e-9) & (F.col("size") >= F.col("other_size") * degree - 1e-9)
    return ours.join(theirs, "item_id").where((F.col("user_id") != F.col("other_id")) & close).select("user_id", "other_id").distinct()


def _entries(sets: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets, and the row and item of each entry."""
    sizes = sets.str.len().to_numpy().astype("int64")
    return sizes, np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets.to_numpy())


def _common(rows: int, row: np.ndarray, item: np.ndarray, others: int, other_row: np.ndarray, start: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Items in common of each row and each other set; the others' entries are sorted by item, those of one begin at ``start``."""
    held = np.diff(start)
    few = ~dense[item]
    times = held[item[few]]
    both = np.zeros((rows, others), "float32")
    if times.sum():
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start[item[few]], times)
        np.add.at(both.ravel(), np.repeat(row[few], times) * others + other_row[at], 1)
    many = np.flatnonzero(dense)
    for begin in range(0, len(many), 1024):
        part = many[begin : begin + 1024]
        column = np.full(len(dense), -1)
        column[part] = np.arange(len(part))
        left, right = np.zeros((rows, len(part)), "float32"), np.zeros((others, len(part)), "float32")
        own = column[item] >= 0
        left[row[own], column[item[own]]] = 1
        for j, i in enumerate(part):
            right[other_row[start[i] : start[i + 1]], j] = 1
        both += left @ right.T
    return both


def _best_of_blocks(pending: DataFrame, sets: DataFrame, n: int) -> DataFrame:
    """``user_id, other_id, value``: the ``n`` most similar sets of each pending one in each block of all sets."""
    kind = sets.schema["user_id"].dataType.simpleString()
    slices, blocks = -(-pending.count() // SLICE_SETS), -(-sets.count() // BLOCK_SETS)

    def compare(key: tuple, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(ours) and len(theirs):
            theirs = theirs.sort_values("other_id")
            ids, other_ids = ours["user_id"].to_numpy(), theirs["other_id"].to_numpy()
            own_place = {v: i for i, v in enumerate(other_ids)}
            sizes, row, item = _entries(ours["items"])
            other_sizes, other_row, other_item = _entries(theirs["others"])
            names = np.unique(other_item)
            by_item = np.argsort(other_item, kind="stable")
            other_row = other_row[by_item]
            start = np.searchsorted(other_item[by_item], np.append(names, names[-1] + 1))
            at = np.minimum(np.searchsorted(names, item), len(names) - 1)
            shared = names[at] == item
            row, item = row[shared], at[shared]
            dense = np.bincount(item, minlength=len(names)) * np.diff(start) * 64 >= len(ours) * len(theirs)
            step = max(1, (1 << 23) // len(theirs))
            for begin in range(0, len(ours), step):
                size = sizes[begin : begin + step]
                mine = slice(*np.searchsorted(row, [begin, begin + len(size)]))
                both = _common(len(size), row[mine] - begin, item[mine], len(theirs), other_row, start, dense).astype("float64")
                value = both / (size[:, None] + other_sizes[None, :] - both)
                same = [(i, own_place[v]) for i, v in enumerate(ids[begin : begin + step]) if v in own_place]
                for i, j in same:
                    value[i, j] = 0
                every = np.arange(len(size))
                for _ in range(min(n, len(theirs))):
                    best = value.argmax(axis=1)  # the first one, so the smaller id of equals
                    most = value[every, best]
                    near = most > 0
                    found.append(pd.DataFrame({"user_id": ids[begin : begin + step][near], "other_id": other_ids[best[near]], "value": most[near]}))
                    value[every, best] = 0
        return pd.concat(found) if found else pd.DataFrame({"user_id": [], "other_id": [], "value": []})

    def dealt(count: int):
        return F.pmod(F.xxhash64("user_id"), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    ours = sets.join(pending, "user_id", "left_semi").select("user_id", "items", dealt(slices).alias("slice"), every(blocks).alias("block"))
    theirs = sets.select(F.col("user_id").alias("other_id"), F.col("items").alias("others"), dealt(blocks).alias("own"), every(slices).alias("copy"))
    return ours.groupBy("slice", "block").cogroup(theirs.groupBy("copy", "own")).applyInPandas(compare, f"user_id {kind}, other_id {kind}, value double")


def _nearest_sets(held: DataFrame, pending: DataFrame, n: int, degrees: Sequence[float], paired: float) -> DataFrame:
    """``user_id, other_id, value``: the ``n`` most similar of all different sets for each pending one."""
    users = held.groupBy("item_id").agg(F.count(F.lit(1)).alias("users"))
    known = number_rows(users, [("users", "asc"), ("item_id", "asc")], "code").select("item_id", F.col("code").cast("int").alias("code"))
    by_rarity = Window.partitionBy("user_id").orderBy("item_id")
    items = held.join(known, "item_id").select("user_id", F.col("code").alias("item_id")).withColumns(
        {"place": F.row_number().over(by_rarity), "size": F.count(F.lit(1)).over(Window.partitionBy("user_id"))}
    )
    items = pin(items.select("user_id", "item_id", "place", "size"))
    sets = pin(items.groupBy("user_id").agg(F.collect_list("item_id").alias("items")))
    other = sets.select(F.col("user_id").alias("other_id"), F.col("items").alias("others"))
    order, all_sets, found = [("value", "desc"), ("other_id", "asc")], sets.count(), []
    pending = pin(pending)
    for degree in degrees:
        left = pending.count()
        if not left:
            break
        if _rows_by_items(items, pending, degree) > paired * left * all_sets:
            found.append(pin(top_n_per_group(_best_of_blocks(pending, sets, n), ["user_id"], order, n, "rank")))
            break
        pair = candidates(items, pending, degree).join(sets, "user_id").join(other, "other_id")
        both = F.size(F.array_intersect("items", "others"))
        value = both / (F.size("items") + F.size("others") - both)
        near = pair.select("user_id", "other_id", value.alias("value")).where(F.col("value") >= degree - 1e-9)
        best = pin(top_n_per_group(near, ["user_id"], order, n, "rank"))
        if degree > 0:
            done = best.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n).select("user_id")
            best = best.join(done, "user_id", "left_semi")
            pending = pin(pending.join(done, "user_id", "left_anti"))
        found.append(best)
    empty = held.select("user_id", F.col("user_id").alias("other_id"), F.lit(0.0).alias("value")).where("false")
    return reduce(DataFrame.unionByName, [f.drop("rank") for f in found], empty)


def _rows_by_items(items: DataFrame, pending: DataFrame, degree: float) -> int:
    """Rows that ``candidates`` would join."""
    rare = items.where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * degree - 1e-9) + 1)
    asked = pending.select("user_id", F.lit(1).alias("_asked"))
    held = rare.join(asked, "user_id", "left").groupBy("item_id").agg(F.count(F.lit(1)).alias("all"), F.count("_asked").alias("asked"))
    return int(held.agg(F.sum(F.col("all").cast("decimal(19,0)") * F.col("asked"))).first()[0] or 0)


def nearest_users(pairs: DataFrame, n: int = 2, degrees: Sequence[float] = DEGREES, paired: float = PAIRED) -> DataFrame:
    """``user_id, other_id, value, rank``: the ``n`` users most similar to each, by items of both over items of either.

    ``pairs`` has user_id and item_id; repeated rows count once, rows with a null are left out. Of equal values the smaller id
    comes first. Users without a common item with anyone have no row. All sets are compared from ``paired`` rows by items on
    for each pair of sets.
    """
    if not degrees or degrees[-1] != 0 or list(degrees) != sorted(degrees, reverse=True):
        raise ValueError("degrees fall, down to 0")
    held = pin(pairs.select("user_id", "item_id").dropna().distinct())
    sets = pin(held.groupBy("user_id").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    # the smallest user of a set stands for all who have it
    classes = pin(sets.groupBy("items").agg(F.min("user_id").alias("first"), F.count(F.lit(1)).alias("users")))
    member = pin(sets.join(classes.select("items", "first"), "items").select("user_id", "first"))
    firsts = held.join(classes.select(F.col("first").alias("user_id")), "user_id", "left_semi")
    pending = classes.where(F.col("users") <= n).select(F.col("first").alias("user_id"))
    near = _nearest_sets(firsts, pending, n, degrees, paired).select(F.col("user_id").alias("first"), F.col("other_id").alias("_set"), "value")
    # n users besides oneself are enough of any set
    some = pin(top_n_per_group(member, ["first"], [("user_id", "asc")], n + 1, "_at")).select(F.col("first").alias("_set"), F.col("user_id").alias("other_id"))
    own = member.select("user_id", F.col("first").alias("_set"), F.lit(1.0).alias("value"))
    met = member.join(near, "first").select("user_id", "_set", "value").unionByName(own).join(some, "_set").where(F.col("user_id") != F.col("other_id"))
    best = top_n_per_group(met, ["user_id"], [("value", "desc"), ("other_id", "asc")], n, "rank")
    return best.select("user_id", "other_id", "value", "rank")
