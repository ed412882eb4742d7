"""Last-touch attribution of carts to the page before, and of orders to carts.

Every cart line takes one page out of the visits of the same visitor and session
in the hours before it. No visit-cart pairs are built: the page follows from a
few running values over the visits, which each cart line reads off at its time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vendue.functions.pages import click_area, is_detail, is_noise
from vendue.operators.ranking import number_rows, small_or_plain
from vendue.session import GROUP_ROWS, pin

KEYS = ["visitor_id", "session_id"]
CART_KEYS = ["site_no", "item_id", "option_id", "master_cart_id", "cart_id", "referrer", "inflow_target"]

# Chunks of a hot visitor's rows; at most this many, each of at least that size.
MAX_CHUNKS = 100_000
CHUNK_ROWS = 50_000

# Rows that a task sorts when it reads values off chunks; a row holds several pages.
TASK_ROWS = 50_000


def cart_groups(carts: DataFrame) -> DataFrame:
    """One row per cart line: newest time, summed quantity."""
    keys = [c for c in CART_KEYS if c in carts.columns]
    return carts.groupBy(*KEYS, *keys).agg(F.max("ts").alias("ts"), F.sum("qty").alias("qty"))


def attribute_last_touch(
    carts: DataFrame,
    visits: DataFrame,
    lookback: str = "6 hours",
    noise: Callable[[Column, Column], Column] = is_noise,
    detail: Callable[[Column, Column], Column] = is_detail,
    area: Callable[[Column], Column] = click_area,
    content: Sequence[str] = ("url", "screen_code"),
    carry: Sequence[str] = (),
    hot_rows: int = GROUP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Cart lines with the page that led to them; lines without a visit are left out.

    Rules: of several visits at one instant the one with the largest id counts, once
    however often its line is repeated. Then, newest visit first: a visit that equals
    the next newer one in ``content``, ``carry`` and area is a reload and goes. If more than one visit is left,
    noise pages go, and so does the newest remaining page when it is an
    item-detail page. The newest page left is taken; with none left, the detail
    page, and with only noise the newest visit. A page without area of its own
    takes that of the next newer visit.

    ``carry`` names further columns of the page that the result hands on. Visits and
    carts without a visitor or session belong to one nameless visitor.

    Only visits of visitors with a cart are sorted. Visitors with more than
    ``hot_rows`` rows are cut into chunks that run in separate tasks; the values
    at a chunk's start come from the chunks before.
    """
    content = list(dict.fromkeys([*content, *carry]))
    pages = visits.select(
        *KEYS,
        "ts",
        "visit_id",
        "url",
        area(F.col("url")).alias("area"),
        noise(F.col("url"), F.col("screen_code")).alias("noise"),
        detail(F.col("url"), F.col("screen_code")).alias("detail"),
        F.struct(*content).alias("content"),
    )
    groups = cart_groups(carts)
    pages = _with_keys(pages, small_or_plain(groups.select(*KEYS).distinct()), "left_semi")
    hot = _hot_keys(groups, pages, hot_rows)
    if hot is None:
        return _attribute(groups, pages, lookback, _VisitorWindows(), carry)
    cold = [_with_keys(df, hot, "left_anti") for df in (groups, pages)]
    warm = [_with_keys(df, hot, "left_semi") for df in (groups, pages)]
    return _attribute(*cold, lookback, _VisitorWindows(), carry).unionByName(
        _attribute(*warm, lookback, _ChunkWindows(chunk_rows), carry)
    )


def _with_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on visitor and session, where missing ones are equal to missing ones."""
    right = keys.select(*[F.col(k).alias(f"_{k}") for k in KEYS])
    return df.join(right, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]), how)


def _hot_keys(groups: DataFrame, pages: DataFrame, limit: int) -> DataFrame | None:
    rows = groups.select(*KEYS).unionByName(pages.select(*KEYS))
    hot = small_or_plain(rows.groupBy(*KEYS).count().where(F.col("count") > limit).select(*KEYS))
    return None if hot.isEmpty() else hot


SORT = ["ts", "is_cart", "visit_id", "tie"]


class _VisitorWindows:
    """Windows per visitor and session: groups fit one task."""

    def timeline(self, visits: DataFrame, carts: DataFrame) -> DataFrame:
        """Visits and carts in one frame; of several visits at one instant the last one counts."""
        later = F.lead(F.struct("ts", "is_cart")).over(Window.partitionBy(*KEYS).orderBy(*SORT))
        return (
            visits.unionByName(carts)
            .withColumn("_repeated", (F.col("is_cart") == 0) & later.eqNullSafe(F.struct("ts", "is_cart")))
            .where(~F.col("_repeated"))
            .drop("_repeated")
        )

    def running_last(self, rows: DataFrame, values: Mapping[str, Column], strict: bool) -> DataFrame:
        """Last value that is there before each row, the row itself included unless ``strict``."""
        window = (
            Window.partitionBy(*KEYS).orderBy(*SORT).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        )
        return rows.withColumns({name: F.last(v, ignorenulls=True).over(window) for name, v in values.items()})


class _ChunkWindows:
    """Windows per chunk of consecutive rows, for visitors too large for one task."""

    def __init__(self, chunk_rows: int):
        self.chunk_rows = chunk_rows
        self.tasks = 1

    def timeline(self, visits: DataFrame, carts: DataFrame) -> DataFrame:
        rest = [c for c in visits.columns if c not in (*KEYS, "ts")]
        # dealt first: aggregating structs sorts all rows of a task, and a task that scans has as many as its files
        dealt = visits.repartition(*KEYS, "ts", "visit_id")
        last = dealt.groupBy(*KEYS, "ts").agg(F.max_by(F.struct(*rest), F.struct("visit_id", "tie")).alias("_last"))
        kept = last.select(*KEYS, "ts", "_last.*").select(*visits.columns)
        numbered = number_rows(kept.unionByName(carts), [(c, "asc") for c in [*KEYS, *SORT]], "_rn")
        rows = numbered.count()
        size = max(self.chunk_rows, rows // MAX_CHUNKS + 1)
        self.tasks = max(1, -(-rows // TASK_ROWS))
        return pin(numbered.withColumn("_chunk", F.floor((F.col("_rn") - 1) / size)))

    def running_last(self, rows: DataFrame, values: Mapping[str, Column], strict: bool) -> DataFrame:
        # one row per chunk, at most MAX_CHUNKS
        earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        ends = rows.groupBy("_chunk").agg(
            F.min_by(F.struct(*KEYS), "_rn").alias("_first"),
            *[
                F.max_by(F.struct(*KEYS, v.alias("v")), F.when(v.isNotNull(), F.col("_rn"))).alias(f"_end_{n}")
                for n, v in values.items()
            ],
        )
        carried = ends.select(
            "_chunk",
            "_first",
            *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"_carried_{n}") for n in values],
        )

        def own(name: str) -> Column:
            # a value of the visitor before is none of this visitor's
            value = F.col(f"_carried_{name}")
            same = reduce(lambda a, b: a & b, [value[k].eqNullSafe(F.col("_first")[k]) for k in KEYS])
            return F.when(same, value["v"])

        # what a chunk takes over is a row before its first one
        starts = carried.select(
            "_chunk", "_first.*", F.lit(0).cast("bigint").alias("_rn"), *[own(n).alias(f"_own_{n}") for n in values]
        )
        every = rows.withColumns({f"_own_{n}": v for n, v in values.items()}).unionByName(starts, allowMissingColumns=True)
        local = (
            Window.partitionBy("_chunk", *KEYS)
            .orderBy("_rn")
            .rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        )
        found = every.repartition(self.tasks, "_chunk").withColumns(
            {n: F.last(f"_own_{n}", ignorenulls=True).over(local) for n in values}
        )
        return pin(found.where(F.col("_rn") > 0).drop(*[f"_own_{n}" for n in values]))


def _page(prefix: str, area: Column) -> Column:
    at = F.col(prefix)
    return F.struct(
        at["visit_id"].alias("visit_id"),
        at["ts"].alias("ts"),
        at["url"].alias("url"),
        area.alias("area"),
        at["noise"].alias("noise"),
        at["detail"].alias("detail"),
        at["content"].alias("content"),
    )


def _attribute(groups: DataFrame, pages: DataFrame, lookback: str, windows, carry: Sequence[str]) -> DataFrame:
    page = F.struct("visit_id", "ts", "url", "area", "noise", "detail", "content")
    others = [c for c in groups.columns if c not in (*KEYS, "ts")]
    visit_rows = pages.select(
        *KEYS, "ts", F.lit(0).alias("is_cart"), "visit_id", F.hex(F.xxhash64(page)).alias("tie"), page.alias("self"),
        F.lit(None).cast(_cart_type(groups)).alias("cart"),
    )
    cart_rows = groups.select(
        *KEYS,
        "ts",
        F.lit(1).alias("is_cart"),
        F.lit(None).cast(pages.schema["visit_id"].dataType).alias("visit_id"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in others]).alias("tie"),
        F.lit(None).cast(visit_rows.schema["self"].dataType).alias("self"),
        F.struct(*others).alias("cart"),
    )
    rows = windows.timeline(visit_rows, cart_rows)
    rows = windows.running_last(rows, {"before": F.col("self")}, strict=True)
    rows = windows.running_last(
        rows, {"before2": F.when(F.col("self").isNotNull(), F.col("before"))}, strict=True
    )

    own, area1, area2 = F.col("self.area"), F.col("before.area"), F.col("before2.area")
    is_visit, has1, has2 = (F.col(c).isNotNull() for c in ("self", "before", "before2"))
    # seen from this visit as the newest one
    before_is_reload = F.col("before.content").eqNullSafe(F.col("self.content")) & F.coalesce(
        area1, own
    ).eqNullSafe(own)
    # two visits back: its neighbours are settled whatever comes later
    settled_area = F.coalesce(area2, area1)
    settled_is_reload = F.col("before2.content").eqNullSafe(F.col("before.content")) & settled_area.eqNullSafe(
        F.coalesce(area1, own)
    )
    rows = rows.withColumns(
        {
            "newest": F.when(
                is_visit,
                F.struct(
                    _page("self", own).alias("page"),
                    F.when(has1 & ~before_is_reload, _page("before", F.coalesce(area1, own))).alias("before"),
                ),
            ),
            "settled": F.when(is_visit & has2 & ~settled_is_reload, _page("before2", settled_area)),
        }
    ).select(*KEYS, *SORT, *[c for c in ("_rn", "_chunk") if c in rows.columns], "cart", "newest", "settled")
    useful = F.when(~F.col("settled.noise"), F.col("settled"))
    rows = windows.running_last(rows, {"useful_before": useful}, strict=True)
    pair = F.when(useful.isNotNull(), F.struct(useful.alias("page"), F.col("useful_before").alias("before")))
    rows = windows.running_last(
        rows, {"useful": pair, "left_ts": F.col("settled.ts"), "last_visit": F.col("newest")}, strict=False
    )

    oldest = F.col("ts") - F.expr(f"INTERVAL {lookback}")

    def within(page: Column) -> Column:
        return F.when(page["ts"] >= oldest, page)

    def clean(page: Column) -> Column:
        return F.when(~page["noise"], page)

    newest = F.col("last_visit.page")
    before = within(F.col("last_visit.before"))
    several = before.isNotNull() | F.coalesce(F.col("left_ts") >= oldest, F.lit(False))
    candidates = F.filter(
        F.array(clean(newest), clean(before), within(F.col("useful.page")), within(F.col("useful.before"))),
        lambda p: p.isNotNull(),
    )
    carts = rows.where((F.col("is_cart") == 1) & (newest["ts"] >= oldest)).withColumns(
        {"_several": several, "_candidates": candidates}
    )
    first, second = F.get("_candidates", F.lit(0)), F.get("_candidates", F.lit(1))
    bare = F.struct(
        *[(F.lit(None).cast("string") if n == "area" else newest[n]).alias(n)
          for n in ("visit_id", "ts", "url", "area", "noise", "detail", "content")]
    )
    chosen = (
        F.when(~F.col("_several"), newest)
        .when(first.isNull(), bare)
        .when(first["detail"], F.coalesce(second, first))
        .otherwise(first)
    )
    return carts.withColumn("_page", chosen).select(
        *KEYS,
        "ts",
        *[F.col("cart")[c].alias(c) for c in others],
        F.col("_page.visit_id").alias("visit_id"),
        F.col("_page.ts").alias("visit_ts"),
        F.col("_page.url").alias("url"),
        F.col("_page.area").alias("area"),
        *[F.col("_page.content")[c].alias(c) for c in carry],
    )


def _cart_type(groups: DataFrame) -> str:
    fields = [f for f in groups.schema.fields if f.name not in (*KEYS, "ts")]
    return StructType(fields).simpleString()


ORDER_KEYS = ["item_id", "option_id", "master_cart_id", "cart_id"]


def orders_with_attribution(
    orders: DataFrame,
    attributed: DataFrame,
    keys: Sequence[str] = ORDER_KEYS,
    site: str = "site_no",
    ts: str = "cart_ts",
    not_after: str | None = None,
) -> DataFrame:
    """Order lines with the newest attribution row of their cart; ties keep several rows.

    With ``not_after`` (a time column of the orders) attribution later than the
    order is left out and of ties the row that sorts last is taken; by default later
    attribution is taken as well. Every order line comes back, equal lines each for itself
    and lines with a missing key without attribution.
    """
    keys = list(keys)
    if not_after is None:
        newest = attributed.groupBy(site, *keys).agg(F.max(ts).alias(ts))
        latest = attributed.join(newest, [site, *keys, ts], "left_semi").drop(site)
        return orders.join(latest, keys, "left")
    # As-of: orders and attribution rows of a cart on one timeline; an order reads off the last row
    # before it. No pairs are built, and orders are rows of their own throughout.
    rest = [c for c in attributed.columns if c not in (site, *keys)]
    lines = orders.select(
        *keys, F.col(not_after).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(attributed.select(F.struct(*rest).alias("r")).schema["r"].dataType).alias("_row"),
        F.struct(*orders.columns).alias("_line"),
    )
    rows = attributed.dropna(subset=[*keys, ts]).select(
        *keys, F.col(ts).alias("_at"), F.lit(0).alias("_kind"), F.struct(*rest).alias("_row"),
        F.lit(None).cast(lines.schema["_line"].dataType).alias("_line"),
    )
    # rows without a key are apart: they would meet in one group
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, "_at"]])
    before = Window.partitionBy(*keys).orderBy("_at", "_kind", "_row").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionByName(lines.where(whole)).withColumn("_row", F.last("_row", ignorenulls=True).over(before))
    found = found.where("_kind = 1").unionByName(lines.where(~whole))
    return found.select("_line.*", *[F.col("_row")[c].alias(c) for c in rest])
