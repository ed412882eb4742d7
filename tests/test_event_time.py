"""Streams in event time: windows, sessions, known visitors, restarts and late rows."""

import random
from collections import Counter, defaultdict
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import functions as F

from vendue.plans.search_best import login_history
from vendue.streaming import event_time, logins
from vendue.streaming.micro import read_stream

START = datetime(2024, 1, 1)


def test_windows_close_once_and_late_rows_are_added(spark, tmp_path):
    """Files in mixed order and a restart: closed and late counts together are all rows; each window closes once."""
    rng = random.Random(3)
    rows = [(START + timedelta(minutes=rng.randrange(60 * 48)), f"v{rng.randrange(4)}") for _ in range(1500)]
    files = [rows[i::30] for i in range(15)] + [sorted(rows)[len(rows) // 2 :][i::15] for i in range(15)]
    taken = []
    schema = "ts timestamp, visitor_id string"
    windows = event_time.visit_windows(f"{tmp_path}/out", "2 hours", "1 hour", timedelta(hours=3))
    sizes = []
    for run in range(3):
        for k, part in enumerate(files[run::3]):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{run}-{k}")
            taken += part
        stream = read_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, maxFilesPerTrigger="4")
        last = windows.run(stream, finish=run == 2)[-1]
        sizes += [s["numRowsTotal"] for p in last.recentProgress for s in p["stateOperators"]]
        closed = windows.closed(spark)
        assert closed.count() == closed.select("from_ts", "visitor_id").distinct().count()
    expected = Counter()
    for ts, visitor in taken:
        hour = ts.replace(minute=0)
        for back in (0, 1):
            expected[hour - timedelta(hours=back), visitor] += 1
    got = {(r["from_ts"], r["visitor_id"]): r["visits"] for r in windows.complete(spark).collect()}
    assert got == dict(expected)
    assert windows.late(spark).count() > 0
    assert max(sizes) <= 4 * 50 + 1


def test_windows_without_rows(spark, tmp_path):
    schema = "ts timestamp, visitor_id string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/in/0")
    stream = read_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
    event_time.visit_windows(f"{tmp_path}/out").run(stream, finish=True)


def sessions_by_hand(rows, gap):
    by = defaultdict(list)
    for ts, visitor in rows:
        by[visitor].append(ts)
    out = []
    for visitor, times in by.items():
        own = []
        for ts in sorted(times):
            if own and ts - own[-1] > gap:
                out.append((visitor, own[0], own[-1], len(own)))
                own = []
            own.append(ts)
        out.append((visitor, own[0], own[-1], len(own)))
    return sorted(out, key=str)


def test_sessions(spark):
    rng = random.Random(5)
    rows = [(START + timedelta(minutes=rng.randrange(3000)), f"v{rng.randrange(5)}") for _ in range(300)]
    rows += [rows[0], (START, "edge"), (START + timedelta(minutes=30), "edge"), (START + timedelta(minutes=59), "edge"), (START, None)]
    frame = spark.createDataFrame(rows, "ts timestamp, visitor_id string")
    found = event_time.sessions(frame).collect()
    assert sorted(map(tuple, found), key=str) == sorted(sessions_by_hand(rows, timedelta(minutes=30)), key=str)


def test_late_event_joins_two_sessions(spark, tmp_path):
    schema = "ts timestamp, visitor_id string"
    at = lambda m: START + timedelta(minutes=m)
    runs = [[(at(0), "a"), (at(50), "a")], [(at(25), "a"), (at(70), "b")], [(at(600), "z")], [(at(20), "a"), (at(1200), "z")]]
    seen = []
    for run, rows in enumerate(runs):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{run}")
        event_time.run_sessions(read_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema), f"{tmp_path}/out")
        seen.append(sorted((r["visitor_id"], r["from_ts"], r["to_ts"], r["events"]) for r in spark.read.schema("visitor_id string, from_ts timestamp, to_ts timestamp, events long").parquet(f"{tmp_path}/out/sessions").collect()))
    assert seen[1] == []
    assert seen[2] == [("a", at(0), at(50), 3), ("b", at(70), at(70), 1)]  # one session, though it was two before
    assert seen[3] == [*seen[2], ("z", at(600), at(600), 1)]  # the event after the watermark is gone


def test_months_before():
    assert logins.months_before(date(2024, 8, 31), 6) == date(2024, 2, 29)
    assert logins.months_before(date(2024, 1, 31), 6) == date(2023, 7, 31)
    assert logins.months_before(date(2024, 3, 15), 12) == date(2023, 3, 15)
    for updated in (date(2023, 8, 31), date(2024, 2, 29), date(2023, 12, 30)):
        day = datetime.fromtimestamp(logins.KnownVisitor(6)._too_old(updated) / 1000, UTC).date()
        assert logins.months_before(day, 6) > updated >= logins.months_before(day - timedelta(days=1), 6)


def test_known_visitors_equal_the_daily_job(spark, tmp_path):
    """A year replayed in several runs, each started from the checkpoint; late and expired visitors included."""
    rng = random.Random(8)
    first = date(2023, 1, 1)
    rows = [(rng.randrange(90), f"v{rng.randrange(25)}", first + timedelta(days=rng.randrange(500))) for _ in range(160)]
    rows += [(99, "gap", first), (5, "gap", first + timedelta(days=300)), (7, "old", first + timedelta(days=10)), (None, "no member", first), (3, "", first)]
    schema = "member_id long, visitor_id string, visit_date date"
    ends = [first + timedelta(days=d) for d in (120, 260, 400, 520)]
    done = date(2000, 1, 1)
    for run, end in enumerate(ends):
        part = [r for r in rows if done <= r[2] < end]
        late = [r for r in part if r[2] >= end - timedelta(days=3)][::2]  # these come with the next run
        spark.createDataFrame([r for r in part if r not in late], schema).write.parquet(f"{tmp_path}/in/{run}a")
        stream = read_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
        logins.run_logins(logins.logins_of_clicks(stream), f"{tmp_path}/out")
        if late:
            spark.createDataFrame(late, schema).write.parquet(f"{tmp_path}/in/{run}b")
        done = end
    stream = read_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
    logins.run_logins(logins.logins_of_clicks(stream), f"{tmp_path}/out")
    as_of = ends[-1] + timedelta(days=3)
    found = {tuple(r) for r in logins.known_logins(spark, f"{tmp_path}/out", as_of).select("visitor_id", "member_id", "updated").collect()}
    known = {}
    for day in sorted({r[2] for r in rows}):  # the daily job by hand: state and logins of the day, without what is too old
        for member, visitor, seen in rows:
            if seen == day and member is not None and visitor:
                at = day + timedelta(days=2)
                held = known.get(visitor)
                fresh = held is None or held[1] < logins.months_before(at, 6)
                known[visitor] = (member, at) if fresh else (max(member, held[0]), at)
    limit = logins.months_before(as_of - timedelta(days=1), 6)
    assert found == {(v, m, d) for v, (m, d) in known.items() if d >= limit}
    assert {v for v, _, _ in found} >= {"gap"} - {"gap"} and "old" not in {v for v, _, _ in found}


def test_known_visitors_of_one_day_equal_login_history(spark, tmp_path):
    as_of = date(2024, 1, 31)
    prev = [(4, "a", date(2024, 1, 1)), (9, "b", date(2023, 5, 1)), (2, "c", date(2023, 7, 30)), (1, "d", date(2023, 7, 29))]
    clicks = [(7, "a", date(2024, 1, 28)), (1, "b", date(2024, 1, 29)), (5, "e", date(2024, 1, 29)), (None, "f", date(2024, 1, 29))]
    before = spark.createDataFrame(prev, "member_id long, visitor_id string, updated date")
    today = spark.createDataFrame(clicks, "member_id long, visitor_id string, visit_date date")
    expected = sorted(map(tuple, login_history(before, today, as_of).select("visitor_id", "member_id", "updated").collect()))
    rows = before.unionByName(logins.logins_of_clicks(today))
    for day, part in enumerate((rows.where("updated < '2024-01-15'"), rows.where("updated >= '2024-01-15'"))):
        part.write.parquet(f"{tmp_path}/in/{day}")
        logins.run_logins(read_stream(spark, f"{tmp_path}/in/*", rows.schema), f"{tmp_path}/out")
    found = logins.known_logins(spark, f"{tmp_path}/out", as_of)
    got = sorted(map(tuple, found.select("visitor_id", "member_id", "updated").collect()))
    # the daily job also joins what had run out between its days
    assert [r for r in got if r[0] != "b"] == [r for r in expected if r[0] != "b"]
    assert [r for r in got if r[0] == "b"] == [("b", 1, date(2024, 1, 30))]


def test_streamed_attribution_equals_the_batch(spark, tmp_path):
    """Three deliveries in mixed order, each started from the checkpoint: hours that are over equal the batch; the state is bounded."""
    from vendue.operators.attribution import attribute_last_touch
    from vendue.streaming.attribution import StreamedTouch

    rng = random.Random(6)
    cart_schema = "visitor_id string, session_id string, site_no string, item_id long, cart_id string, ts timestamp, qty long"
    visit_schema = "visit_id long, visitor_id string, session_id string, ts timestamp, url string, screen_code string"
    people = ["a", "b", "c", None]
    urls = ["/main.ssg?k=1", "/item/itemView.ssg?itemId=2", "/order/popup.ssg?k=3", "/disp/category.ssg?x=1&tarea=4"]
    at = lambda: START + timedelta(minutes=rng.randrange(60 * 72))
    carts = [(v := rng.choice(people), v, "1", rng.randrange(9), str(i), at(), 1) for i in range(60)]
    carts += carts[:3]
    visits = [(i, v := rng.choice(people), v, at(), rng.choice(urls), "") for i in range(500)]
    frames = spark.createDataFrame(carts, cart_schema), spark.createDataFrame(visits, visit_schema)
    touch = StreamedTouch(f"{tmp_path}/out", frames[0].schema, frames[1].schema, delay="2 hours")
    cuts = [START + timedelta(hours=h) for h in (0, 24, 48, 72)]
    sizes = []
    for run in range(3):
        streams = []
        for name, frame in zip(("carts", "visits"), frames, strict=True):
            part = frame.where((F.col("ts") >= F.lit(cuts[run])) & (F.col("ts") < F.lit(cuts[run + 1])))
            part.repartition(2).write.parquet(f"{tmp_path}/{name}/{run}")
            streams.append(read_stream(spark, f"{tmp_path}/{name}/*", frame.schema))
        last = touch.run(*streams)
        sizes.append(last.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(sizes) < 250
    columns = ["visitor_id", "item_id", "cart_id", "ts", "qty", "visit_id", "url", "area"]
    for after, until in ((cuts[0] - timedelta(seconds=1), cuts[3]), (cuts[1], cuts[2])):
        own = frames[0].where((F.col("ts") > F.lit(after)) & (F.col("ts") <= F.lit(until)))
        expected = attribute_last_touch(own, frames[1]).select(*columns).collect()
        found = touch.closed(spark, after, until).select(*columns).collect()
        assert Counter(map(tuple, found)) == Counter(map(tuple, expected)) and found


def test_files_of_found_visits_are_few(spark, tmp_path):
    """Visits of many hours are written as about as many files as there are hours and tasks, not as their product."""
    from glob import glob

    from vendue.streaming.attribution import StreamedTouch

    hours, each = 24, 20
    at = lambda h, m: START + timedelta(hours=h, minutes=m)
    carts = [(f"v{m}", "s", "1", 1, f"{h}-{m}", at(h, m + 1), 1) for h in range(hours) for m in range(each)]
    visits = [(h * each + m, f"v{m}", "s", at(h, m), "/main.ssg?k=1", "") for h in range(hours) for m in range(each)]
    cart_schema = "visitor_id string, session_id string, site_no string, item_id long, cart_id string, ts timestamp, qty long"
    visit_schema = "visit_id long, visitor_id string, session_id string, ts timestamp, url string, screen_code string"
    frames = spark.createDataFrame(carts, cart_schema), spark.createDataFrame(visits, visit_schema)
    touch = StreamedTouch(f"{tmp_path}/out", frames[0].schema, frames[1].schema, "30 minutes")
    streams = []
    for name, frame in zip(("carts", "visits"), frames, strict=True):
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        streams.append(read_stream(spark, f"{tmp_path}/{name}", frame.schema))
    touch.run(*streams)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(glob(f"{tmp_path}/out/visits/*/*/*.parquet")) <= hours + tasks
    found = touch.closed(spark, START - timedelta(hours=1), START + timedelta(hours=hours))
    assert sorted(r["visit_id"] for r in found.collect()) == list(range(hours * each))
