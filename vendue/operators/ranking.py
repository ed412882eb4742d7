"""Positions and ranks, over whole tables and inside groups of any size.

A window without PARTITION BY, or with one that has few values, sends whole
groups to single tasks. Up to ``GROUP_ROWS`` rows that is the cheapest plan; for
larger groups the rows are range-partitioned on the full sort key, sorted inside
the partitions and numbered there, and each partition's start is added.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendue.session import BROADCAST_ROWS, GROUP_ROWS, pin

Order = Sequence[tuple[str, str]]


def sort_columns(order: Order) -> list[Column]:
    """``[("score", "desc"), ("item_id", "asc")]`` as columns; nulls come last."""
    return [
        F.col(name).desc_nulls_last() if way == "desc" else F.col(name).asc_nulls_last()
        for name, way in order
    ]


def small_or_plain(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when a count proves it small, else without one.

    The frame is checkpointed, so the count does not compute it a second time.
    Without the hint the join is a shuffled one and AQE splits skewed partitions.
    """
    df = pin(df)
    return F.broadcast(df) if df.count() <= limit else df


def number_rows(df: DataFrame, order: Order, out: str = "rn") -> DataFrame:
    """Dense 1-based numbers over the whole frame in the given order.

    The order has to be total (end with a unique key). One range shuffle; the
    checkpoint fixes which row sits where before the partition sizes are taken.
    """
    keys = sort_columns(order)
    placed = pin(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id keeps the partition in the bits above 33
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition, so this window is bounded by the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    offset = F.col("_place") - F.shiftleft(part, 33)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + offset + 1)
        .drop("_part", "_start", "_place")
    )


def position(
    df: DataFrame,
    order: Order,
    within: Sequence[str] = (),
    out: str = "rn",
    kind: str = "row_number",
    limit: int = GROUP_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """``row_number`` or ``rank`` over the frame, or inside each group of ``within``.

    ``order`` has to end with a unique key for ``row_number``. For ``rank`` the
    last key breaks ties of the numbering only; equal values of the keys before
    it share a rank. ``rows`` may give the size of the largest group when the
    caller knows it; else it is counted, so ``df`` should be cheap to read twice.
    """
    within = list(within)
    if rows is None:
        rows = largest_group(df, within)
    ranked_by = list(order) if kind == "row_number" else list(order)[:-1]
    if rows <= limit:
        spec = Window.partitionBy(*within) if within else Window.partitionBy()
        func = F.row_number() if kind == "row_number" else F.rank()
        return df.withColumn(out, func.over(spec.orderBy(*sort_columns(ranked_by))).cast("bigint"))

    numbered = number_rows(df, [(c, "asc") for c in within] + list(order), "_rn")
    first = ["_rn"]
    if within:
        starts = numbered.groupBy(*within).agg(F.min("_rn").alias("_first"))
        numbered = _join_null_safe(numbered, starts, within)
        first = ["_rn", "_first"]
    if kind == "row_number":
        base = F.col("_first") if within else F.lit(1)
        return numbered.withColumn(out, F.col("_rn") - base + 1).drop(*first)
    values = [name for name, _ in ranked_by]
    ties = numbered.groupBy(*within, *values).agg(F.min("_rn").alias("_tie"))
    joined = _join_null_safe(numbered, ties, within + values)
    base = F.col("_first") if within else F.lit(1)
    return joined.withColumn(out, F.col("_tie") - base + 1).drop(*first, "_tie")


def largest_group(df: DataFrame, within: Sequence[str] = ()) -> int:
    """Rows of the largest group (of the frame when ``within`` is empty)."""
    if not within:
        return df.count()
    row = df.groupBy(*within).count().agg(F.max("count").alias("n")).first()
    return row["n"] or 0


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_k_{key}")
    renamed = small_or_plain(renamed)
    cond = None
    for key in keys:
        part = left[key].eqNullSafe(F.col(f"_k_{key}"))
        cond = part if cond is None else cond & part
    return left.join(renamed, cond).drop(*[f"_k_{key}" for key in keys])


def global_rank(df: DataFrame, order: Order, kind: str = "row_number", out: str = "rn", **kw) -> DataFrame:
    """Position over the whole frame."""
    return position(df, order, (), out, kind, **kw)


def rank_in(
    df: DataFrame, part: Sequence[str], order: Order, kind: str = "row_number", out: str = "rn", **kw
) -> DataFrame:
    """Position inside each group."""
    return position(df, order, part, out, kind, **kw)


def rerank(
    df: DataFrame,
    part: Sequence[str],
    adjust: Callable[[DataFrame], Column],
    rank: str,
    ties: Order,
    **kw,
) -> DataFrame:
    """Shift some ranks by ``adjust`` and number again in the shifted order."""
    shifted = df.withColumn("_shifted", adjust(df)).drop(rank)
    return position(shifted, [("_shifted", "asc"), *ties], part, rank, **kw).drop("_shifted")


def top_n_per_group(df: DataFrame, part: Sequence[str], order: Order, n: int, out: str = "rn") -> DataFrame:
    """First ``n`` rows of each group.

    Spark cuts each group to ``n`` rows per task before the shuffle
    (WindowGroupLimit), so a hot group never arrives whole at one task.
    """
    spec = Window.partitionBy(*part).orderBy(*sort_columns(order))
    return df.withColumn(out, F.row_number().over(spec).cast("bigint")).where(F.col(out) <= n)


def top_k(df: DataFrame, order: Order, k: int, limit: int = 10_000) -> DataFrame:
    """First ``k`` rows of the frame.

    A small k is a sorted limit. A large one is a filter on distributed numbers,
    since a sorted limit merges k rows of every partition in one task.
    """
    if k <= limit:
        return df.orderBy(*sort_columns(order)).limit(k)
    return position(df, order, out="_rn").where(F.col("_rn") <= k).drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, ties: str = "all") -> DataFrame:
    """Rows with the newest ``ts`` of their key.

    ``ties="all"`` keeps every row that carries it; any other value names the
    column whose largest value decides. Both aggregate on the map side first, so
    a key with many rows costs no more than others.
    """
    keys = list(keys)
    if ties == "all":
        newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
        return df.join(newest, [*keys, ts], "left_semi")
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(F.col(ts), F.col(ties))).alias("_row")
    )
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def drop_reloads(df: DataFrame, part: Sequence[str], order: Order, cols: Sequence[str]) -> DataFrame:
    """Drop a row that equals its later neighbour in ``cols``.

    ``order`` is ascending in time. For groups of bounded size.
    """
    spec = Window.partitionBy(*part).orderBy(*sort_columns(order))
    same = F.struct(*cols).eqNullSafe(F.lead(F.struct(*cols)).over(spec))
    last = F.lead(F.lit(1)).over(spec).isNull()
    return df.withColumn("_reload", same & ~last).where(~F.col("_reload")).drop("_reload")


def carry_once(df: DataFrame, part: Sequence[str], order: Order, col: str, out: str) -> DataFrame:
    """Give a value also to the next older row, once; an own value wins."""
    spec = Window.partitionBy(*part).orderBy(*sort_columns(order))
    return df.withColumn(out, F.coalesce(F.col(col), F.lead(col).over(spec)))
