"""Attribution rules on hand-made visits, and the split path against a plain loop."""

import random
from datetime import datetime, timedelta

import pytest

from vendue.functions.pages import click_area
from vendue.operators.attribution import attribute_last_touch, orders_with_attribution

T0 = datetime(2024, 1, 1, 12)
ITEM, NOISE, MAIN = "/item/itemView.ssg?i=1", "/order/popup.ssg", "/main.ssg"
VISIT = "visitor_id string, session_id string, ts timestamp, visit_id bigint, url string, screen_code string"
CART = "visitor_id string, session_id string, ts timestamp, site_no string, item_id string, cart_id string, qty bigint"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def visits(spark, *pages, visitor="v"):
    data = [(visitor, "s", at(m), i, url, screen) for i, (m, url, screen) in enumerate(pages, 1)]
    return spark.createDataFrame(data, VISIT)


CASES = {
    "newest page": ([(1, MAIN, ""), (2, "/a.ssg", "")], [(2, None)]),
    "leading item page is skipped": ([(1, MAIN, ""), (2, ITEM, "")], [(1, None)]),
    "only the leading item page is skipped": ([(1, MAIN, ""), (2, ITEM, ""), (3, ITEM + "2", "")], [(2, None)]),
    "single item page stays": ([(2, ITEM, "")], [(1, None)]),
    "single noise page stays": ([(2, NOISE, "")], [(1, None)]),
    "noise goes": ([(1, MAIN, ""), (2, NOISE, "")], [(1, None)]),
    "login screen is noise": ([(1, MAIN, ""), (2, "/x", "LoginView")], [(1, None)]),
    "item page comes back when nothing else is left": ([(1, NOISE, ""), (2, ITEM, "")], [(2, None)]),
    "only noise: newest visit": ([(1, NOISE, ""), (2, NOISE + "?2", "")], [(2, None)]),
    "reloads count as one": ([(1, ITEM, ""), (2, ITEM, "")], [(2, None)]),
    "area of the page itself": ([(1, "/c.ssg?a=1&tarea=t1", "")], [(1, "t1")]),
    "area of the next newer page": ([(1, MAIN, ""), (2, ITEM + "&tarea=t1", "")], [(1, "t1")]),
    "area is handed on once": ([(1, MAIN, ""), (2, NOISE, ""), (3, NOISE + "?x=1&click=t2", "")], [(1, None)]),
    "named area": ([(1, "/c.ssg?a=1&ForYouB=7", "")], [(1, "ForYouB_7")]),
    "area decides on reload": ([(1, MAIN, ""), (2, MAIN, ""), (3, NOISE + "?x=1&tarea=t", "")], [(2, "t")]),
    "after the cart": ([(61, MAIN, "")], []),
    "too old": ([(-301, MAIN, "")], []),
    "just in time": ([(-300, MAIN, "")], [(1, None)]),
}


@pytest.fixture(scope="module", params=[1_000_000, 0], ids=["whole", "split"])
def found(request, spark):
    """Page and area per case; each case is a visitor of its own."""
    carts = spark.createDataFrame([(name, "s", at(60), "1", "i", "c", 1) for name in CASES], CART)
    seen = spark.createDataFrame(
        [(name, "s", at(m), i, url, screen) for name, (pages, _) in CASES.items() for i, (m, url, screen) in enumerate(pages, 1)],
        VISIT,
    )
    out = attribute_last_touch(carts, seen, hot_rows=request.param, chunk_rows=2)
    return {r["visitor_id"]: [(r["visit_id"], r["area"])] for r in out.collect()}


@pytest.mark.parametrize("name", CASES)
def test_rules(found, name):
    assert found.get(name, []) == CASES[name][1]


def test_no_carts_of_other_sessions(spark):
    cart = spark.createDataFrame([("w", "s", at(60), "1", "i", "c", 1)], CART)
    assert attribute_last_touch(cart, visits(spark, (1, MAIN, ""))).count() == 0


def test_cart_lines_are_grouped(spark):
    cart = spark.createDataFrame(
        [("v", "s", at(60), "1", "i", "c", 1), ("v", "s", at(70), "1", "i", "c", 2)], CART
    )
    found = attribute_last_touch(cart, visits(spark, (1, MAIN, ""))).collect()
    assert [(r["qty"], r["ts"]) for r in found] == [(3, at(70))]


def brute_force(carts, pages, hours=6):
    """The rules as a loop over each cart's visits."""
    out = []
    for visitor, _, ts, *rest in carts:
        seen = sorted((p for p in pages if p[0] == visitor and ts - timedelta(hours=hours) <= p[2] <= ts), key=lambda p: p[2])
        if not seen:
            continue
        left, newer, newer_own = [], None, None
        for page in reversed(seen):
            url = page[4]
            own = url.split("&tarea=")[1] if "&tarea=" in url else None
            area = own or newer_own
            if (url, area) != newer:
                left.append((page[3], area, "popup" in url, "itemView" in url))
            newer, newer_own = (url, area), own
        kept = left if len(left) == 1 else [p for p in left if not p[2]]
        if not kept:
            out.append((visitor, ts, seen[-1][3], None))
            continue
        first = kept[0]
        if len(left) > 1 and first[3] and len(kept) > 1:
            first = kept[1]
        out.append((visitor, ts, first[0], first[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_rows", [3, 40])
def test_split_path_equals_loop(spark, chunk_rows):
    rng = random.Random(7)
    urls = [ITEM, NOISE, MAIN, "/c.ssg?x=1&tarea=a", "/c.ssg?x=1&tarea=b", ITEM]
    pages = [
        (rng.choice(["v", "v", "v", "w"]), "s", T0 + timedelta(seconds=rng.randrange(100_000)), i, rng.choice(urls), "")
        for i in range(300)
    ]
    pages = list({(p[0], p[2]): p for p in pages}.values())
    carts = [
        (rng.choice("vw"), "s", T0 + timedelta(seconds=rng.randrange(100_000)), "1", "i", str(i), 1) for i in range(80)
    ]
    found = attribute_last_touch(
        spark.createDataFrame(carts, CART), spark.createDataFrame(pages, VISIT), hot_rows=100, chunk_rows=chunk_rows
    ).collect()
    got = sorted(((r["visitor_id"], r["ts"], r["visit_id"], r["area"]) for r in found), key=str)
    assert got == brute_force(carts, pages)


def test_tasks_of_chunks_grow_with_the_rows(spark, monkeypatch):
    """However many partitions the session has, a task holds a bounded number of rows of large visitors."""
    from pyspark.sql import functions as F

    from vendue.operators import attribution

    monkeypatch.setattr(attribution, "TASK_ROWS", 50)
    seen = [("v", "s", at(m), 0, m, str(m), f"p{m}" if m % 3 else None) for m in range(1, 401)]
    schema = "visitor_id string, session_id string, ts timestamp, is_cart int, visit_id bigint, tie string, page string"
    frame = spark.createDataFrame(seen, schema)
    windows = attribution._ChunkWindows(7)
    rows = windows.timeline(frame, frame.limit(0))
    found = windows.running_last(rows, {"before": F.col("page")}, strict=True)
    assert found.rdd.getNumPartitions() >= 8
    expected = [(m, None if m == 1 else f"p{m - 1 if (m - 1) % 3 else m - 2}") for m in range(1, 401)]
    assert sorted((r["visit_id"], r["before"]) for r in found.collect()) == expected


def test_click_area_order(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("/a?x=1&click=c&tarea=t",), ("/a?x=1&tarea=&click=c",), ("/a?tarea=t",)], "url string")
    assert [r[0] for r in df.select(click_area(F.col("url"))).collect()] == ["t", "c", None]


def test_orders_with_attribution(spark, rows):
    orders = spark.createDataFrame([("o1", "i", "0", "m", "c", 5), ("o2", "j", "0", "m", "c", 5)],
                                   "order_no string, item_id string, option_id string, master_cart_id string, cart_id string, at int")
    attr = spark.createDataFrame(
        [("1", "i", "0", "m", "c", 3, "a"), ("1", "i", "0", "m", "c", 9, "b"), ("1", "i", "0", "m", "c", 9, "b2"),
         ("2", "i", "0", "m", "c", 1, "other site")],
        "site_no string, item_id string, option_id string, master_cart_id string, cart_id string, cart_ts int, page string")
    late = orders_with_attribution(orders, attr)
    assert rows(late, "order_no", "page") == [("o1", "b"), ("o1", "b2"), ("o1", "other site"), ("o2", None)]
    early = orders_with_attribution(orders, attr, not_after="at")
    assert rows(early, "order_no", "page") == [("o1", "a"), ("o2", None)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 0])
def test_repeated_instants_and_nameless_visitors(spark, hot_rows):
    """A line written twice counts once; visits of nobody are those of one nameless visitor."""
    rows = [
        (name, "s", at(m), i, url, "")
        for name in ("v", None)
        for m, i, url in [(1, 1, MAIN), (2, 2, ITEM), (2, 2, ITEM), (3, 3, NOISE)]
    ]
    seen = spark.createDataFrame(rows, VISIT).selectExpr("*", "concat('os', visit_id) as os")
    carts = spark.createDataFrame([(n, "s", at(30), "1", "i", "c", 1) for n in ("v", None)], CART)
    found = attribute_last_touch(carts, seen, carry=["os"], hot_rows=hot_rows, chunk_rows=2).collect()
    assert [(r["visit_id"], r["url"], r["os"]) for r in found] == [(1, MAIN, "os1")] * 2


@pytest.mark.parametrize("hot_rows", [1_000_000, 0])
def test_carried_columns_tell_reloads_apart(spark, hot_rows):
    seen = visits(spark, (1, ITEM, ""), (2, ITEM, "")).selectExpr("*", "cast(visit_id as string) as word")
    carts = spark.createDataFrame([("v", "s", at(30), "1", "i", "c", 1)], CART)
    plain = attribute_last_touch(carts, seen, hot_rows=hot_rows).first()
    carried = attribute_last_touch(carts, seen, carry=["word"], hot_rows=hot_rows).first()
    assert (plain["visit_id"], carried["visit_id"], carried["word"]) == (2, 1, "1")


def test_not_after_keeps_every_order_line(spark):
    orders = spark.createDataFrame(
        [(1, "i", "a", at(10)), (1, "i", "a", at(10)), (2, "i", None, at(10)), (3, "i", "b", at(10)), (4, "i", "a", None), (5, "i", "a", at(1))],
        "order_no int, item_id string, cart_id string, order_ts timestamp",
    )
    pages = spark.createDataFrame(
        [("1", "i", "a", at(5), 7), ("1", "i", "a", at(8), 8), ("1", "i", "a", at(20), 9), ("1", "i", None, at(5), 1)],
        "site_no string, item_id string, cart_id string, cart_ts timestamp, page_id int",
    )
    found = orders_with_attribution(orders, pages, ["item_id", "cart_id"], not_after="order_ts").collect()
    assert sorted((r["order_no"], r["page_id"] or 0) for r in found) == [(1, 8), (1, 8), (2, 0), (3, 0), (4, 0), (5, 0)]
