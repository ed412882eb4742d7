"""The supplied test tables in the shape of the shop's inputs.

Money is in whole units (floor), so sums are exact. Order data and event data
have their own run dates; day offsets are counted from each one's own date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendue.session import input_bytes, scale_partitions

ORDERS_AS_OF = date(2001, 8, 2)
EVENTS_AS_OF = date(2024, 1, 31)


class Shop:
    """Lazy frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._bytes = 0

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.root}/{name}.parquet"
            self._tables[name] = self.spark.read.parquet(path)
            self._bytes += input_bytes(self.spark, path)
            scale_partitions(self.spark, self._bytes)
        return self._tables[name]

    # masters -----------------------------------------------------------

    def items(self) -> DataFrame:
        key = F.col("p_partkey")
        shown = F.date_sub(F.lit(ORDERS_AS_OF), (key % 120).cast("int"))
        return self.table("part").select(
            key.alias("item_id"),
            F.col("p_brand").alias("brand_id"),
            F.col("p_type").alias("category_id"),
            F.when(F.col("p_size") <= 40, 20).otherwise(10).alias("sell_status"),
            F.when(key % 4 == 1, 20).when(key % 4 == 2, 30).otherwise(10).alias("sell_type"),
            F.when(key % 8 == 2, 70).when(key % 8 == 6, 80).otherwise(10).alias("sell_type_detail"),
            shown.alias("shown_from"),
            shown.alias("registered"),
            F.when(F.col("p_size") % 2 == 0, "Y").otherwise("N").alias("new_flag"),
            (key % 7).cast("string").alias("origin_id"),
            F.when(key % 10 == 0, "N").otherwise("Y").alias("searchable"),
        )

    def categories(self) -> DataFrame:
        name = F.col("p_type")
        return self.table("part").select(name.alias("category_id")).distinct().select(
            "category_id",
            F.initcap("category_id").alias("category_name"),
            F.lit("ALL").alias("large_id"),
            F.when(F.col("category_id").isin("ECONOMY", "PROMO", "SMALL"), "VALUE").otherwise("MAIN").alias("medium_id"),
            F.substring("category_id", 1, 1).alias("small_id"),
            F.when(F.col("category_id") == "LARGE", "N").otherwise("Y").alias("in_use"),
        )

    def brands(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("brand_id")).distinct().select(
            "brand_id",
            F.upper("brand_id").alias("brand_name"),
            F.when(F.col("brand_id") == "Brand#7", "N").otherwise("Y").alias("in_use"),
        )

    def _site_of_supplier(self) -> DataFrame:
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").cast("string").alias("site_no")
        )

    def prices(self) -> DataFrame:
        unit = F.floor(F.col("l_extendedprice") / F.col("l_quantity"))
        lines = self.table("lineitem").select(
            F.col("l_partkey").alias("item_id"), "l_suppkey", unit.alias("unit")
        )
        return (
            lines.groupBy("item_id", "l_suppkey")
            .agg(F.max("unit").alias("sell_price"), F.min("unit").alias("low_price"))
            .join(self._site_of_supplier(), "l_suppkey")
            .select("item_id", "site_no", F.col("l_suppkey").alias("store_no"), "sell_price", "low_price")
        )

    def members(self) -> DataFrame:
        key = F.col("c_custkey")
        gender = F.when(key % 3 == 0, "10").when(key % 3 == 1, "20").otherwise("")
        band = F.col("c_nationkey") % 5
        age = F.when(band == 0, "20").when(band == 1, "30").when(band == 2, "40").when(band == 3, "50").otherwise("")
        base = self.table("customer").select(
            key.alias("member_id"), gender.alias("gender"), age.alias("age_band")
        )
        # some members come twice, the second time without gender
        twice = base.where(F.col("member_id") % 7 == 0).withColumn("gender", F.lit(""))
        return base.unionByName(twice)

    def event_items(self) -> DataFrame:
        return self.table("part").where(F.col("p_partkey") % 17 == 0).select(F.col("p_partkey").alias("item_id"))

    # orders ------------------------------------------------------------

    def order_heads(self) -> DataFrame:
        """What order lines take from their order."""
        return self.table("orders").select(
            "o_orderkey", F.col("o_custkey").alias("member_id"), "o_orderdate", "o_orderpriority"
        )

    def order_lines(self, heads: DataFrame | None = None) -> DataFrame:
        """Order lines; further columns of ``heads``, which are ``order_heads`` by default, come last."""
        orders = self.order_heads() if heads is None else heads
        more = [c for c in orders.columns if c not in ("o_orderkey", "member_id", "o_orderdate", "o_orderpriority")]
        gross = F.floor(F.col("l_extendedprice"))
        lines = self.table("lineitem").select(
            "l_orderkey",
            F.col("l_partkey").alias("item_id"),
            "l_suppkey",
            F.col("l_linenumber").cast("bigint").alias("line_no"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            gross.alias("amount"),
            F.floor(F.col("l_extendedprice") * F.col("l_discount")).alias("own_discount"),
            F.lit(0).cast("bigint").alias("partner_discount"),
            F.floor(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.when(F.col("l_returnflag") == "R", "2").otherwise("1").alias("target_code"),
            F.when(F.col("l_linenumber") % 2 == 1, "011").otherwise("021").alias("line_kind"),
        )
        return (
            lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .join(self._site_of_supplier(), "l_suppkey")
            .select(
                F.col("l_orderkey").alias("order_no"),
                "line_no",
                "item_id",
                "site_no",
                "member_id",
                F.to_date("o_orderdate").alias("order_date"),
                "qty",
                "amount",
                "own_discount",
                "partner_discount",
                "unit_price",
                "target_code",
                "line_kind",
                F.col("o_orderpriority").alias("priority"),
                *more,
            )
        )

    def offline_sales(self) -> DataFrame:
        return self.table("lineitem").where(F.col("l_returnflag") == "R").select(
            F.to_date("l_shipdate").alias("sale_date"),
            F.concat(F.lit("S"), F.col("l_partkey")).alias("offline_item_id"),
        )

    def offline_map(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            F.concat(F.lit("S"), key).alias("offline_item_id"),
            F.when(key % 3 == 0, "20").otherwise("10").alias("business_code"),
            key.alias("item_id"),
        )

    # events ------------------------------------------------------------

    def events(self) -> DataFrame:
        number = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
        return self.table("events").select(
            "event_id", "ts", "user_id", "event_type", "value", number.alias("k")
        )

    def clicks(self) -> DataFrame:
        user = F.col("user_id")
        return self.events().where(F.col("event_type").isin("view", "click")).select(
            "event_id",
            "ts",
            F.to_date("ts").alias("visit_date"),
            F.col("k").alias("item_id"),
            (F.col("k") % 5).cast("string").alias("site_no"),
            F.concat(F.lit("ip"), (user % 40)).alias("ip"),
            user.cast("string").alias("visitor_id"),
            F.when(user % 5 != 0, user).alias("member_id"),
            F.when(user % 3 == 0, "10").when(user % 3 == 1, "20").otherwise("").alias("gender"),
            F.when(user % 4 == 0, "20").when(user % 4 == 1, "30").when(user % 4 == 2, "40").otherwise("50").alias("age_band"),
        )

    def carts(self) -> DataFrame:
        return self.events().where(F.col("event_type") == "purchase").select(
            "event_id",
            "ts",
            F.to_date("ts").alias("visit_date"),
            F.col("k").alias("item_id"),
            (F.col("k") % 5).cast("string").alias("site_no"),
            F.col("user_id").cast("string").alias("visitor_id"),
            F.col("user_id").alias("member_id"),
        )

    def cart_lines(self) -> DataFrame:
        """Cart lines for attribution; one session per visitor."""
        return self.events().where(F.col("event_type") == "purchase").select(
            F.col("user_id").cast("string").alias("visitor_id"),
            F.col("user_id").cast("string").alias("session_id"),
            (F.col("k") % 5).cast("string").alias("site_no"),
            F.col("k").alias("item_id"),
            (F.col("event_id") % 3).cast("string").alias("cart_id"),
            "ts",
            F.lit(1).cast("bigint").alias("qty"),
        )

    def page_visits(self) -> DataFrame:
        """Page visits for attribution: error pages are noise, views are item pages."""
        kind = F.col("event_type")
        page = (
            F.when(kind == "error", "/order/popup.ssg?k=")
            .when(kind == "view", "/item/itemView.ssg?itemId=")
            .when(kind == "signup", "/disp/category.ssg?x=1&tarea=")
            .otherwise("/main.ssg?k=")
        )
        return self.events().where(kind != "purchase").select(
            F.col("event_id").alias("visit_id"),
            F.col("user_id").cast("string").alias("visitor_id"),
            F.col("user_id").cast("string").alias("session_id"),
            "ts",
            F.concat(page, F.col("k")).alias("url"),
            F.lit("").alias("screen_code"),
        )

    def page_rows(self) -> DataFrame:
        """Page views of the search model, with device, referrer and screen code."""
        user, k = F.col("user_id"), F.col("k")
        device = F.when(user % 3 == 0, "PC").when(user % 3 == 1, "MW").otherwise("MA")
        item_page = (F.col("event_type") == "view") | (k % 2 == 0)
        return self.events().where(F.col("event_type").isin("view", "click")).select(
            F.to_date("ts").alias("day"),
            device.alias("device"),
            F.when(item_page, "/item/itemView.ssg").otherwise("/search.ssg").alias("url"),
            F.when(user % 2 == 0, "/search.ssg?q=a").otherwise(".").alias("referrer"),
            k.alias("item_id"),
            F.lit("").alias("area"),
            F.when((device == "MA") & (k % 4 == 0), "ItemDetailViewController").otherwise("").alias("screen_code"),
        )

    def reaction_rows(self) -> DataFrame:
        k = F.col("k")
        return self.events().where(F.col("event_type") == "signup").select(
            F.to_date("ts").alias("day"),
            F.lit("MA").alias("device"),
            F.lit("").alias("url"),
            F.lit(".").alias("referrer"),
            k.alias("item_id"),
            F.when(k % 2 == 0, "검색결과|전체상품탭|상품_클릭").otherwise("기타").alias("area"),
            F.lit("").alias("screen_code"),
        )

    def attribution_rows(self) -> DataFrame:
        user, k = F.col("user_id"), F.col("k")
        device = F.when(user % 3 == 0, "PC").when(user % 3 == 1, "MW").otherwise("MA")
        return self.events().where(F.col("event_type") == "purchase").select(
            F.to_date("ts").alias("day"),
            device.alias("device"),
            F.when(k % 3 == 0, "/search.ssg").otherwise("/main.ssg").alias("url"),
            k.alias("item_id"),
            F.when((device == "MA") & (k % 5 == 0), "NativeSearchResult").otherwise("").alias("screen_code"),
        )

    def reviews(self) -> DataFrame:
        return (
            self.events()
            .where(F.col("event_type") == "signup")
            .groupBy(F.col("k").alias("item_id"))
            .agg(F.count(F.lit(1)).alias("review_count"))
        )

    def ad_rows(self) -> DataFrame:
        """Advertised units seen, one row per event."""
        k, kind = F.col("k"), F.col("event_type")
        return self.events().select(
            "event_id",
            "ts",
            (k % 5).cast("string").alias("site_no"),
            F.when(F.col("user_id") % 2 == 0, "pc").otherwise("app").alias("media_code"),
            F.when(kind == "view", "pv").when(kind == "click", "click").otherwise("etc").alias("type"),
            F.when(kind == "purchase", "buy").when(kind == "signup", "tap_cart").when(kind == "view", "view")
            .when(k % 4 == 0, "quick").otherwise("share").alias("position"),
            F.when(k % 3 == 0, "오반장").otherwise("main").alias("global_id"),
            (k % 2).cast("string").alias("area_id"),
            F.when(k % 3 == 0, "item").when(k % 3 == 1, "banr").otherwise("x").alias("unit_type"),
            (k % 10).cast("string").alias("account_id"),
            (k % 20).cast("string").alias("bid_id"),
            k.cast("string").alias("target_id"),
            F.lit("10").alias("extension_code"),
        )

    def ratings(self) -> DataFrame:
        return (
            self.events()
            .groupBy("user_id", F.col("k").alias("item_id"))
            .agg(F.avg("value").alias("rating"))
        )

    def interactions(self) -> DataFrame:
        """User and item of views, for similarity."""
        return self.events().where(F.col("event_type") == "view").select(
            F.col("user_id"), F.col("k").alias("item_id"), "ts"
        )
