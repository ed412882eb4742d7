"""Streams with state, sketches, bucketed tables, interval joins and VARIANT logs over the test tables, with the same results in SQL."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.catalog.basics import _counters, _Over
from vendue.catalog.events import TOUCH, _touch
from vendue.catalog.search import previous_logins
from vendue.checks.tables import with_views
from vendue.functions import in_sql, variants
from vendue.operators import range_join, sketches
from vendue.operators.inner_product import top_by_inner_product
from vendue.operators.nearest import nearest_users
from vendue.session import ensure_checkpoint_dir
from vendue.sinks.buckets import BucketStore
from vendue.streaming import event_time, logins
from vendue.streaming.attribution import StreamedTouch
from vendue.streaming.micro import read_stream
from vendue.views import EVENTS_AS_OF, Shop

GAP = "6 hours"


def scratch(s: Shop) -> str:
    return f"{ensure_checkpoint_dir(s.spark)}/{uuid.uuid4().hex}"


def _arrivals(s: Shop, folder: str):
    """Events in the order of days, and one of ten only after the others: first and second delivery."""
    late = F.col("event_id") % 10 == 0
    rows = s.table("events")
    yield rows.where(~late).repartitionByRange(8, "ts").write.parquet(f"{folder}/in/0")
    yield rows.where(late).repartitionByRange(4, "ts").write.parquet(f"{folder}/in/1")


def counters(s: Shop) -> DataFrame:
    """Ad counters per minute in event time: two deliveries, the second one late, then the end."""
    folder = scratch(s)
    windows = event_time.ad_windows(f"{folder}/out", timedelta(hours=12))
    for number, _ in enumerate(_arrivals(s, folder)):
        stream = read_stream(s.spark, f"{folder}/in/*", s.table("events").schema, maxFilesPerTrigger="4")
        windows.run(Shop.ad_rows(_Over(s, stream)), finish=number == 1)
    return windows.complete(s.spark).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


def visits(s: Shop) -> DataFrame:
    """Visits per visitor in sliding windows in event time."""
    folder = scratch(s)
    windows = event_time.visit_windows(f"{folder}/out", delay=timedelta(hours=12))
    for number, _ in enumerate(_arrivals(s, folder)):
        stream = read_stream(s.spark, f"{folder}/in/*", s.table("events").schema, maxFilesPerTrigger="4")
        windows.run(stream.select("ts", F.col("user_id").alias("visitor_id")), finish=number == 1)
    return windows.complete(s.spark).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("from_ts", "to_ts")})


def _with_plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("from_ts", "to_ts")})


def session_rows(s: Shop) -> DataFrame:
    return s.table("events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("visitor_id"))


def streamed_sessions(s: Shop) -> DataFrame:
    """Sessions closed by a watermark: two deliveries, then an event long after them."""
    folder = scratch(s)
    rows = session_rows(s)
    middle = F.lit(datetime(2024, 1, 15)).cast("timestamp")
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts")).select("ts", F.lit(None).cast("long").alias("visitor_id"))
    for number, part in enumerate((rows.where(F.col("ts") < middle), rows.where(F.col("ts") >= middle), end)):
        part.repartitionByRange(4, "ts").write.parquet(f"{folder}/in/{number}")
        event_time.run_sessions(read_stream(s.spark, f"{folder}/in/*", rows.schema, maxFilesPerTrigger="3"), f"{folder}/out", GAP, "1 day")
    found = s.spark.read.parquet(f"{folder}/out/sessions")
    return _with_plain_times(found.where("visitor_id is not null"))


def streamed_logins(s: Shop) -> DataFrame:
    """Known visitors kept by a stream over three deliveries, the last ones from before the year."""
    folder = scratch(s)
    clicks = s.clicks().where(F.col("visit_date") <= F.lit(EVENTS_AS_OF - timedelta(days=2)))
    rows = previous_logins(s).unionByName(logins.logins_of_clicks(clicks))
    day = F.col("updated")
    first, second = date(2023, 12, 31), date(2024, 1, 15)
    for number, part in enumerate((rows.where(day < first), rows.where((day >= first) & (day < second)), rows.where(day >= second))):
        part.write.parquet(f"{folder}/in/{number}")
        logins.run_logins(read_stream(s.spark, f"{folder}/in/*", rows.schema), f"{folder}/out")
    return logins.known_logins(s.spark, f"{folder}/out", EVENTS_AS_OF)


def streamed_touches(s: Shop) -> DataFrame:
    """Carts attributed from two deliveries of carts and visits as streams."""
    folder = scratch(s)
    frames = [df.withColumn("ts", F.col("ts").cast("timestamp")) for df in (s.cart_lines(), s.page_visits())]
    touch = StreamedTouch(f"{folder}/out", frames[0].schema, frames[1].schema, delay="1 day")
    middle = F.lit(datetime(2024, 1, 15)).cast("timestamp")
    for number, own in enumerate((F.col("ts") < middle, F.col("ts") >= middle)):
        streams = []
        for name, frame in zip(("carts", "visits"), frames, strict=True):
            frame.where(own).repartitionByRange(4, "ts").write.parquet(f"{folder}/{name}/{number}")
            streams.append(read_stream(s.spark, f"{folder}/{name}/*", frame.schema))
        touch.run(*streams)
    first, last = frames[0].agg(F.min("ts"), F.max("ts")).first()
    found = touch.closed(s.spark, first - timedelta(seconds=1), last).select(*TOUCH)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "visit_ts") if c in found.columns})


def sketched_visitors(s: Shop) -> DataFrame:
    """Distinct visitors by type in weeks that start every day: exact, and whether the stored sketches agree."""
    folder = scratch(s)
    rows = s.events().withColumn("ts", F.col("ts").cast("timestamp"))
    sketches.hourly_sketches(rows, "user_id", ["event_type"]).write.parquet(folder)
    found = sketches.distinct_sliding(s.spark.read.parquet(folder), 168, ["event_type"], 24)
    exact = rows.groupBy(F.window("ts", "168 hours", "24 hours").alias("w"), "event_type").agg(F.count_distinct("user_id").alias("exact"))
    exact = exact.select(F.col("w.start").alias("from_ts"), F.col("w.end").alias("to_ts"), "event_type", "exact")
    both = exact.join(found, ["from_ts", "to_ts", "event_type"], "full")
    close = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(2), 0.08 * F.col("exact"))
    return _with_plain_times(both.select("from_ts", "to_ts", "event_type", "exact", close.alias("within_error")))


def _scores(s: Shop) -> tuple[BucketStore, list[int]]:
    store = BucketStore(s.spark, scratch(s), 16)
    part = s.table("part").select(F.col("p_partkey").alias("item_id"), "p_brand", F.col("p_size").alias("score"))
    store.upsert("best", part.where(F.col("item_id") % 2 == 0), ["item_id"], datetime(2024, 1, 1))
    more = part.where(F.col("p_brand") < "Brand#2").withColumn("score", F.col("score") + 100)
    return store, store.upsert("best", more, ["item_id"], datetime(2024, 1, 2))


def looked_up(s: Shop) -> DataFrame:
    """Scores of the items that order lines of one day ask for."""
    wanted = s.table("lineitem").where(F.col("l_shipdate") == F.lit(date(1996, 3, 13))).select(F.col("l_partkey").alias("item_id"))
    return _scores(s)[0].lookup("best", wanted, ["item_id"])


def near_pairs(s: Shop, **kw) -> DataFrame:
    """Views of an item and the carts of it, by anyone, from ten minutes before to two hours after."""
    seen = s.clicks().where(F.col("event_id") % 2 == 0).select("item_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    carts = s.carts().select("item_id", F.col("event_id").alias("cart_id"), F.col("ts").alias("cart_ts"))
    return range_join.interval_join(seen, carts, ["item_id"], "view_ts", "cart_ts", timedelta(minutes=-10), timedelta(hours=2), **kw)


def json_logs(s: Shop) -> DataFrame:
    """Events with their JSON, some of it cut off, blank, no object, without the field or with another type; more fields on odd days."""
    kind, text = F.col("event_id") % 12, F.col("props")
    more = F.concat(F.regexp_replace(text, "}$", ""), F.lit(', "device": {"os": "x"}}'))
    text = F.when(F.dayofmonth("ts") % 2 == 1, more).otherwise(text)
    broken = (
        F.when(kind == 0, F.substring(text, 1, 5)).when(kind == 1, "  ").when(kind == 2, "[1, 2]").when(kind == 3, '{"x": 1}')
        .when(kind == 4, '{"k": "none"}').when(kind == 5, '{"k": null}').when(kind != 6, text)
    )
    return s.table("events").select("event_id", F.to_date("ts").alias("day"), broken.alias("log"))


def accepted_logs(s: Shop) -> DataFrame:
    found = variants.split_records(json_logs(s), "log", {"k": "bigint"}, {"device.os": "string"})[0]
    return found.select("event_id", "day", "k", "os")


def pages_in_sql(s: Shop) -> DataFrame:
    """The three families of page predicates from SQL alone."""
    return in_sql.query(
        s.spark,
        """
        SELECT visit_id, is_noise(url, screen_code) AS noise, is_detail(url, screen_code) AS detail,
               is_item_view(url, screen_code) AS item_view, search_url(url) AS search
        FROM IDENTIFIER(:visits) WHERE ts >= :since AND NOT coalesce(search_screen(screen_code), false)""",
        {"page_visits_in_sql": s.page_visits()}, visits="page_visits_in_sql", since=datetime(2024, 1, 11),
    )


def best_by_factors(s: Shop) -> DataFrame:
    """Ten best items of each customer for whole-numbered factors made from ids."""
    def factors(key: str, times: int):
        return F.array(*[((F.col(key) * (times + 7 * j) + j * j) % (11 + 2 * j) - F.lit(3)).cast("double") for j in range(6)])

    users = s.table("customer").select(F.col("c_custkey").alias("user_id"), factors("c_custkey", 31).alias("factors"))
    own = factors("p_partkey", 17)
    items = s.table("part").select(F.col("p_partkey").alias("item_id"), F.transform(own, lambda x: x * (1 + F.col("p_partkey") % 5)).alias("factors"))
    return top_by_inner_product(users, items, 10, 256)[0]


QUERIES = {
    "ad_counters_event_time": counters,
    "sliding_visits_event_time": visits,
    "visitor_sessions": lambda s: _with_plain_times(event_time.sessions(session_rows(s), GAP)),
    "visitor_sessions_stream": streamed_sessions,
    "login_history_stream": streamed_logins,
    "attribute_last_touch_stream": streamed_touches,
    "distinct_visitors_sketched": sketched_visitors,
    "bucket_upsert": lambda s: _scores(s)[0].read("best"),
    "bucket_lookup": looked_up,
    "interval_join": near_pairs,
    "interval_join_split": lambda s: near_pairs(s, heavy=1),
    "json_accepted": accepted_logs,
    "json_rejected": lambda s: variants.split_records(json_logs(s), "log", {"k": "bigint"})[1].select("event_id", "log", "reason"),
    "json_schema_by_day": lambda s: variants.schema_by(json_logs(s).where(F.col("event_id") % 12 > 6), "log", "day"),
    "pages_in_sql": pages_in_sql,
    "top_by_inner_product": best_by_factors,
    "nearest_users": lambda s: nearest_users(s.ratings()).withColumn("value", F.round("value", 6)),
}

_SESSIONS = """
    SELECT user_id AS visitor_id, min(ts) AS from_ts, max(ts) AS to_ts, count(*) AS events
    FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island
          FROM (SELECT user_id, ts, CASE WHEN lag(ts) OVER w >= ts - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
                FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)))
    GROUP BY user_id, island"""

_BEST = """
    SELECT p_partkey AS item_id, p_brand, CAST(CASE WHEN p_brand < 'Brand#2' THEN p_size + 100 ELSE p_size END AS INTEGER) AS score
    FROM part WHERE (p_partkey % 2 = 0 OR p_brand < 'Brand#2')"""

_PAIRS = with_views("""
    SELECT v.item_id, v.event_id AS view_id, v.ts AS view_ts, c.event_id AS cart_id, c.ts AS cart_ts
    FROM v_click v JOIN v_cart c ON c.item_id = v.item_id
     AND c.ts BETWEEN v.ts - INTERVAL 10 MINUTE AND v.ts + INTERVAL 2 HOUR
    WHERE v.event_id % 2 = 0""")

_LOGS = """
    SELECT event_id, CAST(ts AS DATE) AS day, event_id % 12 AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k, day(ts) % 2 = 1 AS more,
           CASE event_id % 12 WHEN 0 THEN substr(props, 1, 5) WHEN 1 THEN '  ' WHEN 2 THEN '[1, 2]' WHEN 3 THEN '{"x": 1}'
                WHEN 4 THEN '{"k": "none"}' WHEN 5 THEN '{"k": null}' END AS log
    FROM events"""


def _matches(name: str) -> str:
    column, pattern = in_sql.PATTERNS[name]
    return f"regexp_matches({column}, '{pattern}')"


def _factor(key: str, times: int, j: int) -> str:
    return f"(({key} * {times + 7 * j} + {j * j}) % {11 + 2 * j} - 3)"


_DOT = " + ".join(f"{_factor('c_custkey', 31, j)} * {_factor('p_partkey', 17, j)}" for j in range(6))

SQL = {
    "top_by_inner_product": f"""
        SELECT c_custkey AS user_id, p_partkey AS item_id, CAST(({_DOT}) * (1 + p_partkey % 5) AS DOUBLE) AS score,
               row_number() OVER (PARTITION BY c_custkey ORDER BY ({_DOT}) * (1 + p_partkey % 5) DESC, p_partkey) AS rank
        FROM customer, part QUALIFY rank <= 10""",
    "nearest_users": with_views("""
        SELECT user_id, other_id, round(value, 6) AS value, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, other_id) AS rank FROM (
                SELECT a.user_id, b.user_id AS other_id, count(*) / (any_value(s.n) + any_value(t.n) - count(*)) AS value
                FROM t_held a JOIN t_held b ON a.item_id = b.item_id AND a.user_id <> b.user_id
                JOIN t_size s ON s.user_id = a.user_id JOIN t_size t ON t.user_id = b.user_id
                GROUP BY a.user_id, b.user_id)) WHERE rank <= 2""",
        {"t_held": "SELECT DISTINCT user_id, k AS item_id FROM v_event", "t_size": "SELECT user_id, count(*) AS n FROM t_held GROUP BY user_id"}),
    "json_accepted": f"SELECT event_id, day, k, CASE WHEN more THEN 'x' END AS os FROM ({_LOGS}) WHERE kind > 6",
    "json_rejected": f"""
        SELECT event_id, log, CASE kind WHEN 0 THEN 'malformed' WHEN 1 THEN 'blank' WHEN 2 THEN 'no object' WHEN 3 THEN 'no k'
               WHEN 4 THEN 'type of k' WHEN 5 THEN 'no k' ELSE 'missing' END AS reason
        FROM ({_LOGS}) WHERE kind <= 6""",
    "json_schema_by_day": f"""
        SELECT day, CASE WHEN any_value(more) THEN 'OBJECT<device: OBJECT<os: STRING>, k: BIGINT>' ELSE 'OBJECT<k: BIGINT>' END AS schema,
               count(*) AS records
        FROM ({_LOGS}) WHERE kind > 6 GROUP BY day""",
    "pages_in_sql": with_views(f"""
        SELECT visit_id, {_matches("noise_url")} OR {_matches("noise_screen")} AS noise, {_matches("detail_url")} OR {_matches("detail_screen")} AS detail,
               {_matches("item_view_url")} OR {_matches("item_view_screen")} AS item_view, {_matches("search_url")} AS search
        FROM (SELECT event_id AS visit_id, ts, '' AS screen_code, CASE event_type WHEN 'error' THEN '/order/popup.ssg?k='
                     WHEN 'view' THEN '/item/itemView.ssg?itemId=' WHEN 'signup' THEN '/disp/category.ssg?x=1&tarea=' ELSE '/main.ssg?k=' END || k AS url
              FROM v_event WHERE event_type <> 'purchase')
        WHERE ts >= TIMESTAMP '2024-01-11 00:00:00'"""),
    "ad_counters_event_time": with_views(_counters("")),
    "sliding_visits_event_time": """
        SELECT from_ts, from_ts + INTERVAL 6 HOUR AS to_ts, user_id AS visitor_id, count(*) AS visits
        FROM (SELECT user_id, date_trunc('hour', ts) - to_hours(h) AS from_ts
              FROM events, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS h))
        GROUP BY from_ts, user_id""",
    "visitor_sessions": _SESSIONS,
    "visitor_sessions_stream": _SESSIONS,
    "login_history_stream": with_views("""
        SELECT visitor_id, max(member_id) AS member_id, least(max(updated), DATE '2024-01-30') AS updated FROM (
            SELECT *, max(island) OVER (PARTITION BY visitor_id) AS newest FROM (
                SELECT *, sum(fresh) OVER (PARTITION BY visitor_id ORDER BY updated, member_id ROWS UNBOUNDED PRECEDING) AS island FROM (
                    SELECT *, CASE WHEN lag(updated) OVER w < CAST(updated - INTERVAL 6 MONTH AS DATE) THEN 1 ELSE 0 END AS fresh FROM (
                        SELECT user_id AS member_id, CAST(user_id AS VARCHAR) AS visitor_id,
                               CASE WHEN user_id % 6 = 0 THEN CAST(CAST(ts AS DATE) - INTERVAL 12 MONTH AS DATE)
                                    ELSE CAST(ts AS DATE) END AS updated
                        FROM v_event WHERE event_type = 'purchase' AND user_id % 2 = 0
                        UNION ALL
                        SELECT member_id, visitor_id, visit_date + 2 FROM v_click
                        WHERE member_id IS NOT NULL AND visit_date <= DATE '2024-01-29')
                    WINDOW w AS (PARTITION BY visitor_id ORDER BY updated, member_id))))
        WHERE island = newest GROUP BY visitor_id HAVING max(updated) >= DATE '2023-07-30'"""),
    "attribute_last_touch_stream": _touch(6),
    "distinct_visitors_sketched": """
        SELECT from_ts, from_ts + INTERVAL 168 HOUR AS to_ts, event_type, count(DISTINCT user_id) AS exact, true AS within_error
        FROM (SELECT user_id, event_type, date_trunc('day', ts) - to_days(CAST(d AS INTEGER)) AS from_ts
              FROM events, (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS d))
        GROUP BY from_ts, event_type""",
    "bucket_upsert": _BEST,
    "bucket_lookup": _BEST + " AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_shipdate = DATE '1996-03-13')",
    "interval_join": _PAIRS,
    "interval_join_split": _PAIRS,
}
