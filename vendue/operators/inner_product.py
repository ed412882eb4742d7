"""The best items of each user by the inner product of their factors, without scoring every pair.

Items are sorted by the length of their vectors and cut into stretches. Everyone meets the first stretch, which has the
longest vectors; by Cauchy and Schwarz no item of a later one scores more than the user's length times the longest of it,
so stretches that can't reach a user's list any more are skipped. Within a stretch, items close to each other make blocks;
no item of a block scores more than its middle and the user's length times its radius. A user takes blocks by falling bound, until
the bound is below the list.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.operators.ranking import number_rows, top_n_per_group
from vendue.session import pin

BLOCK_ITEMS = 4096
#: Users that meet a block in one task.
SLICE_USERS = 20_000
#: Items, in whole blocks, that users meet in one task.
STRETCH_ITEMS = 65_536
#: Scores held at once by a task.
SCORES = 1 << 21
RESULT = "user_id long, item_id long, score double, block long, users long"


def _norm():
    return F.sqrt(F.aggregate("factors", F.lit(0.0), lambda s, x: s + x * x))


def item_blocks(items: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``block, item_id, factors, norm``: blocks of equal size by falling length of the vectors."""
    rows = items.select(F.col("item_id").cast("long"), F.col("factors").cast("array<double>").alias("factors")).dropna()
    numbered = number_rows(rows.withColumn("norm", _norm()), [("norm", "desc"), ("item_id", "asc")], "_rn")
    return numbered.withColumn("block", F.expr(f"(_rn - 1) div {block_items}")).drop("_rn")


def _split(vectors: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows ``at`` cut into blocks of ``size`` close ones, the last one smaller: halves along the widest dimension."""
    count = -(-len(at) // size)
    if count < 2:
        return [at]
    own = vectors[at]
    cut = count // 2 * size
    order = np.argpartition(own[:, own.var(axis=0).argmax()], cut)
    return _split(vectors, at[np.sort(order[:cut])], size) + _split(vectors, at[np.sort(order[cut:])], size)


def _first(user: np.ndarray, item: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Rows of the ``n`` best of each user, users in order."""
    order = np.lexsort((item, -score, user))
    own = user[order]
    return order[np.arange(len(own)) - np.searchsorted(own, own) < n]


def _best_of_stretch(ids: np.ndarray, vectors: np.ndarray, blocks: list[np.ndarray], middle: np.ndarray, radius: np.ndarray, longest: np.ndarray,
                     wanted: np.ndarray, limit: np.ndarray, n: int, scored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the user, item and score of the ``n`` best that reach the limits; ``scored`` counts users by block."""
    norm = np.sqrt((wanted * wanted).sum(axis=1))[:, None]
    most = norm * longest
    bound = np.minimum(wanted @ middle.T + norm * radius, most) + 1e-9 * most
    turn = np.argsort(-bound, axis=1)
    limit = limit.copy()
    item, score = np.zeros((len(wanted), n), ids.dtype), np.full((len(wanted), n), -np.inf)
    active = np.arange(len(wanted))
    for t in range(len(blocks)):
        block = turn[active, t]
        reach = bound[active, block] >= limit[active]
        active, block = active[reach], block[reach]
        if not len(active):
            break
        order = np.argsort(block, kind="stable")
        edges = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
        parts = []
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            number, rows = block[order[begin]], active[order[begin:end]]
            scored[number] += len(rows)
            own = blocks[number]
            scores = wanted[rows] @ vectors[own].T
            least = limit[rows]
            if len(own) > n:
                least = np.maximum(least, np.partition(scores, len(own) - n, axis=1)[:, len(own) - n])
            at, column = np.nonzero(scores >= least[:, None])
            parts.append((rows[at], ids[own[column]], scores[at, column]))
        fresh = [np.concatenate(p) for p in zip(*parts, strict=True)]
        if not len(fresh[0]):
            continue
        # users with new items only
        near = np.unique(fresh[0])
        old, place = np.nonzero(score[near] > -np.inf)
        users, items, values = (np.concatenate(p) for p in zip((near[old], item[near[old], place], score[near[old], place]), fresh, strict=True))
        best = _first(users, items, values, n)
        users, items, values = users[best], items[best], values[best]
        place = np.arange(len(users)) - np.searchsorted(users, users)
        item[users, place], score[users, place] = items, values
        limit[near] = np.maximum(limit[near], score[near, n - 1])
    user, place = np.nonzero(score > -np.inf)
    return user, item[user, place], score[user, place]


def _best_of_blocks(wanted: DataFrame, items: DataFrame, n: int, block_items: int) -> DataFrame:
    """The ``n`` best items of each user in each wanted stretch (``user_id, factors, limit, stretch``), users dealt to slices.

    Further rows, without a user, tell how many users were scored against a block.
    """
    per_stretch = max(1, STRETCH_ITEMS // block_items)

    def score(key: tuple, users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({c: pd.Series(dtype=t) for c, t in zip(("user_id", "item_id", "score", "block", "users"), ("Int64", "Int64", "float64", "Int64", "Int64"), strict=True)})]
        if len(users) and len(items):
            ids, vectors = items["item_id"].to_numpy(), np.stack(items["factors"].to_numpy())
            order = np.argsort(ids)
            ids, vectors = ids[order], vectors[order]
            blocks = _split(vectors, np.arange(len(ids)), block_items)
            middle = np.stack([vectors[b].mean(axis=0) for b in blocks])
            radius = np.array([np.sqrt(((vectors[b] - m) ** 2).sum(axis=1).max()) for b, m in zip(blocks, middle, strict=True)])
            longest = np.array([np.sqrt((vectors[b] ** 2).sum(axis=1).max()) for b in blocks])
            scored = np.zeros(len(blocks), "int64")
            step = max(1, SCORES // max(block_items, len(blocks)))
            for at in range(0, len(users), step):
                part = users.iloc[at : at + step]
                limit = part["limit"].fillna(-np.inf).to_numpy("float64")
                user, item, best = _best_of_stretch(ids, vectors, blocks, middle, radius, longest, np.stack(part["factors"].to_numpy()), limit, n, scored)
                found.append(pd.DataFrame({"user_id": part["user_id"].to_numpy()[user], "item_id": item, "score": best}))
            found.append(pd.DataFrame({"block": items["stretch"].iloc[0] * per_stretch + np.arange(len(blocks)), "users": scored}))
        return pd.concat([f.astype({c: "Int64" for c in f.columns if c != "score"}) for f in found])

    # few users that reach a stretch are one slice and take one copy of it
    slices = wanted.groupBy("stretch").agg(F.ceil(F.count(F.lit(1)) / SLICE_USERS).alias("slices"))
    wanted = wanted.join(F.broadcast(slices), "stretch").withColumn("slice", F.pmod(F.xxhash64("user_id"), "slices").cast("int")).drop("slices")
    # a slice without users asks for no copy of the stretch
    asked = wanted.groupBy("stretch", "slice").agg(F.count(F.lit(1)).alias("users"))
    asked = asked.select(F.col("stretch").alias("own"), F.col("slice").alias("copy"))
    copies = asked.join(items.select(F.col("stretch").alias("own"), F.col("stretch"), "item_id", "factors"), "own")
    return wanted.groupBy("stretch", "slice").cogroup(copies.groupBy("own", "copy")).applyInPandas(score, RESULT)


def top_by_inner_product(users: DataFrame, items: DataFrame, n: int = 10, block_items: int = BLOCK_ITEMS) -> tuple[DataFrame, DataFrame]:
    """``user_id, item_id, score, rank`` of the ``n`` best items of each user, and ``block, users`` that were scored.

    ``users`` has user_id and ``factors``, ``items`` has item_id and factors of the same length; ids are unique, rows with a null are
    left out. Of equal scores the smaller item comes first. The result is that of scoring all pairs.
    """
    users = pin(users.select(F.col("user_id").cast("long"), F.col("factors").cast("array<double>").alias("factors")).dropna().withColumn("norm", _norm()))
    per_stretch = max(1, STRETCH_ITEMS // block_items)
    stretches = pin(item_blocks(items, block_items).withColumn("stretch", F.expr(f"block div {per_stretch}")))
    filled = -(-n // (block_items * per_stretch))
    front = users.withColumn("limit", F.lit(None).cast("double")).withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(filled - 1).cast("long"))))
    order = [("score", "desc"), ("item_id", "asc")]
    met = pin(_best_of_blocks(front.drop("norm"), stretches, n, block_items))
    first = top_n_per_group(met.where("user_id is not null").select("user_id", "item_id", "score"), ["user_id"], order, n, "rank").drop("rank")
    longest = stretches.where(F.col("stretch") >= filled).groupBy("stretch").agg(F.max("norm").alias("longest"))
    longest = [(r["stretch"], r["longest"]) for r in longest.orderBy("stretch").collect()]
    parts, asked = first, met
    if longest:
        first = parts = pin(first)
        # the n-th score so far is the least that a list ends with; a user with fewer items wants every stretch
        limit = first.groupBy("user_id").agg(F.when(F.count(F.lit(1)) >= n, F.min("score")).alias("limit"))
        later = F.array(*[F.struct(F.lit(b).cast("long").alias("stretch"), F.lit(float(x)).alias("longest")) for b, x in longest])
        reach = users.join(limit, "user_id", "left")
        able = F.filter(later, lambda b: F.col("limit").isNull() | (F.col("norm") * b["longest"] * (1 + 1e-9) >= F.col("limit")))
        wanted = pin(reach.select("user_id", "factors", "limit", F.explode(able).alias("b")).select("user_id", "factors", "limit", "b.stretch"))
        more = pin(_best_of_blocks(wanted, stretches, n, block_items))
        parts = first.unionByName(more.where("user_id is not null").select("user_id", "item_id", "score"))
        asked = met.unionByName(more)
    best = top_n_per_group(parts, ["user_id"], order, n, "rank")
    return best, asked.where("user_id is null").groupBy("block").agg(F.sum("users").alias("users"))
