"""Best sellers by gender and age band: one frame over all segmentations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.functions.scoring import feature_bounds, log_scale, min_max_scale, rank_score, weighted_sum
from vendue.operators.ranking import top_n_per_group
from vendue.plans.best_rank import FEATURES, NORM_WEIGHTS, copy_sites, floor_zero, with_event_flag
from vendue.session import pin

# Fixed values of the shop's segment ranking.
SEGMENT_ROWS = 200
SEGMENT_PENALTY = 110
SEGMENT_COPIES = [("6009", "6004"), ("6300", "6004")]
GENDERS = {"10": "male", "20": "female"}
AGE_BANDS = {"20": "twenties", "30": "thirties", "40": "forties", "50": "fifties"}

# Score columns of the wide table, in output order.
SCORE_COLUMNS = [
    f"{age}_{who}" for age in [*AGE_BANDS.values(), "all_ages"] for who in [*GENDERS.values(), "all"]
]


def unique_members(members: DataFrame) -> DataFrame:
    """One row per member with the largest codes; rows without both are left out."""
    blank = (F.col("gender") == "") & (F.col("age_band") == "")
    return members.where(~blank).groupBy("member_id").agg(
        F.max("gender").alias("gender"), F.max("age_band").alias("age_band")
    )


def orders_demo(orders: DataFrame, members: DataFrame) -> DataFrame:
    """Order lines with the gender and age band of the member, where known."""
    return orders.join(unique_members(members), "member_id", "left")


def segment_frame(items: DataFrame, counts: DataFrame, events: DataFrame) -> DataFrame:
    """One row per item, gender and age band that has orders or clicks.

    ``counts`` are those of ``br_counts`` by gender and age band. Item master
    values reach only the blank segment, as in the shop's own frame.
    """
    masters = ["site_no", "sell_price", "brand_id", "category_id"]
    # one row per item with its sites: all that follows is by item, so counts are shuffled once
    known = items.groupBy("item_id").agg(
        F.collect_list(F.struct("site_no", "sell_price", "category_id")).alias("_sites"),
        *[F.max(c).alias(f"_item_{c}") for c in masters],
    )
    own = F.filter("_sites", lambda site: site["site_no"] == F.col("site_no"))
    counted = counts.join(known, "item_id").select(
        "item_id", "site_no", F.lit("").alias("brand_id"), "gender", "age_band", *FEATURES,
        *[f"_item_{c}" for c in masters], F.explode(own).alias("_own"),
    )
    counted = counted.withColumns({c: F.col("_own")[c] for c in ("sell_price", "category_id")})
    blank = (F.col("gender") == "") & (F.col("age_band") == "")
    raw = (
        counted.groupBy("item_id", "gender", "age_band")
        .agg(
            *[F.max(F.when(blank, F.greatest(c, f"_item_{c}")).otherwise(F.col(c))).alias(c) for c in masters],
            F.sum("order_count").alias("order_count"),
            F.sum("click_count").alias("click_count"),
            floor_zero(F.sum("amount")).alias("amount"),
        )
        .where(F.col("order_count").isNotNull() | F.col("click_count").isNotNull())
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in FEATURES})
    )
    return with_event_flag(raw, events)


def segment_cube(frame: DataFrame) -> DataFrame:
    """Four groupings in one pass: gender and age, gender, age, all.

    ``grouping`` is age_gender, gender, age or all; segments with a blank code are
    dropped from the groupings that use that code.
    """
    gender, age, none = F.col("gender"), F.col("age_band"), F.lit("")
    segments = [("age_gender", gender, age), ("gender", gender, none), ("age", none, age), ("all", none, none)]
    has_gender, has_age = gender != "", age != ""
    wanted = [has_gender & has_age, has_gender, has_age, F.lit(True)]
    # a row for each grouping; the item stays a column of its own, so rows stay where they are
    each = [
        F.when(there, F.struct(F.lit(label).alias("grouping"), who.alias("gender"), band.alias("age_band")))
        for there, (label, who, band) in zip(wanted, segments, strict=True)
    ]
    rows = frame.withColumn("_segment", F.explode(F.array(*each))).where(F.col("_segment").isNotNull())
    values = ["site_no", "sell_price", "brand_id", "category_id", "event"]
    return (
        rows.select("item_id", "_segment.*", *values, *FEATURES)
        .groupBy("item_id", "gender", "age_band", "grouping")
        .agg(*[F.max(c).alias(c) for c in values], *[F.sum(c).alias(c) for c in FEATURES])
        .select("item_id", "gender", "age_band", *values, *FEATURES, "grouping")
    )


def segment_score(cube: DataFrame, bounds: str = "overall") -> DataFrame:
    """Weighted, scaled logs. Bounds come from the grouping ``all`` or from each grouping."""
    logged = log_scale(pin(cube), FEATURES)
    logs = [f"{c}_log" for c in FEATURES]
    if bounds == "overall":
        parts = [min_max_scale(logged, logs, feature_bounds(logged.where(F.col("grouping") == "all"), logs))]
    else:
        parts = [
            min_max_scale(part, logs, feature_bounds(part, logs))
            for part in (logged.where(F.col("grouping") == g) for g in ("all", "age", "gender", "age_gender"))
        ]
    scaled = parts[0]
    for part in parts[1:]:
        scaled = scaled.unionByName(part)
    return scaled.withColumn("total_score", F.round(weighted_sum(NORM_WEIGHTS), 4)).drop(
        *logs, *[f"{c}_norm" for c in logs]
    )


def show_on_sites(scored: DataFrame, copies: Sequence[tuple[str, str]] = SEGMENT_COPIES) -> DataFrame:
    """Each row on its own site and on the copies of that site."""
    return copy_sites(scored.withColumnRenamed("site_no", "sell_site"), copies, own=True, keep=False)


def segment_rank(
    shown: DataFrame,
    part: Sequence[str] = ("display_site", "grouping", "gender", "age_band"),
    top: int = SEGMENT_ROWS,
    penalty: int = SEGMENT_PENALTY,
) -> DataFrame:
    """Best rows per site and segment; event items lose ranks after the cut; score 10000/rank."""
    ties = [("item_id", "asc"), ("sell_site", "asc")]
    cut = top_n_per_group(shown, part, [("total_score", "desc"), *ties], top, "_rank")
    pushed = cut.withColumn(
        "_rank", F.col("_rank") + F.when(F.col("event") == "Y", F.lit(penalty)).otherwise(F.lit(0))
    )
    again = top_n_per_group(pushed, part, [("_rank", "asc"), *ties], top, "_final")
    return again.withColumn("score", rank_score(F.col("_final"))).drop("_rank", "_final")


def pivot_segment_scores(ranks: DataFrame) -> DataFrame:
    """One row per item and site with a score per segment, 0 where there is none."""
    age = F.coalesce(*[F.when(F.col("age_band") == code, name) for code, name in AGE_BANDS.items()], F.lit("all_ages"))
    who = F.coalesce(*[F.when(F.col("gender") == code, name) for code, name in GENDERS.items()], F.lit("all"))
    return (
        ranks.withColumn("_segment", F.concat_ws("_", age, who))
        .groupBy("item_id", "display_site", "sell_site")
        .pivot("_segment", SCORE_COLUMNS)
        .agg(F.max("score"))
        .na.fill(0.0, SCORE_COLUMNS)
    )
