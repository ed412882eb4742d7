"""Nearest users, VARIANT logs, predicates in SQL."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from vendue.functions import in_sql, variants
from vendue.operators.nearest import candidates, nearest_users


def test_nearest_users(spark):
    rng = random.Random(2)
    sets = {u: {rng.randrange(60) if rng.random() < 0.7 else 0 for _ in range(rng.randrange(1, 9))} for u in range(60)}
    sets |= {100 + u: sets[u] for u in range(10)} | {200: {999}}
    rows = [(u, i) for u, own in sets.items() for i in own] + [(1, min(sets[1])), (None, 5), (7, None)]
    pairs = spark.createDataFrame(rows, "user_id long, item_id long")
    expected = []
    for u, own in sets.items():
        near = sorted((-len(own & o) / len(own | o), v) for v, o in sets.items() if v != u and own & o)
        expected += [(u, v, -s, r) for r, (s, v) in enumerate(near[:2], 1)]
    found = [tuple(r) for r in nearest_users(pairs).collect()]
    assert sorted(found) == sorted(expected)
    with pytest.raises(ValueError, match="degrees"):
        nearest_users(pairs, degrees=(0.5,))


@pytest.mark.parametrize("paired", [0.0, 1e9])
def test_nearest_users_by_blocks_and_by_items(spark, monkeypatch, paired):
    """Popular and rare items, equal sets, ids and items as strings; blocks of few sets."""
    from vendue.operators import nearest

    monkeypatch.setattr(nearest, "SLICE_SETS", 20)
    monkeypatch.setattr(nearest, "BLOCK_SETS", 30)
    rng = random.Random(5)
    sets = {f"u{u}": {f"i{rng.choice((rng.randrange(6), rng.randrange(400)))}" for _ in range(rng.randrange(1, 12))} for u in range(90)}
    sets |= {f"v{u}": sets["u1"] for u in range(4)} | {"w": sets["u2"], "x": {"alone"}}
    rows = [(u, i) for u, own in sets.items() for i in own]
    expected = []
    for u, own in sets.items():
        near = sorted((-len(own & o) / len(own | o), v) for v, o in sets.items() if v != u and own & o)
        expected += [(u, v, -s, r) for r, (s, v) in enumerate(near[:2], 1)]
    found = nearest_users(spark.createDataFrame(rows, "user_id string, item_id string"), paired=paired)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_popular_items_make_no_pairs(spark, monkeypatch):
    """With few items that all hold about half of, pairs by items are more than the sets have."""
    from vendue.operators import nearest

    def none(*args):
        raise AssertionError("pairs by items")

    monkeypatch.setattr(nearest, "candidates", none)
    rng = random.Random(6)
    rows = [(u, i) for u in range(80) for i in rng.sample(range(20), 10)]
    assert nearest_users(spark.createDataFrame(rows, "user_id long, item_id long")).count() == 160


def test_few_pairs_are_verified(spark):
    """An item that everybody has makes no pairs at a high degree."""
    rows = [(u, 0, 5, 5) for u in range(300)] + [(u, 1000 * (u // 2) + k, k, 5) for u in range(300) for k in range(1, 5)]
    items = spark.createDataFrame(rows, "user_id long, item_id long, place long, size long")
    assert candidates(items, items.select("user_id").distinct(), 0.7).count() == 300  # of 300 * 299


def test_records_are_accepted_or_rejected(spark):
    texts = ['{"a": 1, "b": {"c": "x"}}', '{"a": 2}', '{"a": "no"}', '{"a": null}', "{}", "[1]", "3", "nonsense", "", None, '{"a": 1, "b": {"c": "x"}}', '{"a":' + "[" * 3000]
    rows = spark.createDataFrame([(i, t, date(2024, 1, 1 + i % 2)) for i, t in enumerate(texts)], "a long, text string, day date")
    good, bad = variants.split_records(rows, "text", {"a": "bigint"}, {"b.c": "string"})
    assert sorted((r["a"], r["c"] or "") for r in good.collect()) == [(1, "x"), (1, "x"), (2, "")]
    assert {r["a"]: r["reason"] for r in bad.collect()} == {
        2: "type of a", 3: "no a", 4: "no a", 5: "no object", 6: "no object", 7: "malformed", 8: "blank", 9: "missing", 11: "malformed"}
    assert good.count() + bad.count() == rows.count()
    drift = {r["day"].day: (r["schema"], r["records"]) for r in variants.schema_by(rows.where("a < 2"), "text", "day").collect()}
    assert drift == {1: ("OBJECT<a: BIGINT, b: OBJECT<c: STRING>>", 1), 2: ("OBJECT<a: BIGINT>", 1)}


def test_predicates_in_sql_equal_columns(spark):
    from vendue.functions import pages

    urls = ["/item/itemView.ssg?itemId=1", "/order/popup.ssg?k=1", "/search.ssg?q=1", "/main.ssg", "", None]
    rows = spark.createDataFrame([(i, u, s) for i, u in enumerate(urls) for s in ("", "ItemDetail", None)], "id long, url string, screen_code string")
    found = in_sql.query(spark, "SELECT id, is_noise(url, screen_code) AS n, is_detail(url, screen_code) AS d FROM IDENTIFIER(:t) WHERE id >= :least", {"seen_pages": rows}, t="seen_pages", least=1)
    expected = rows.where("id >= 1").select("id", pages.is_noise(F.col("url"), F.col("screen_code")).alias("n"), pages.is_detail(F.col("url"), F.col("screen_code")).alias("d"))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize(("block", "n"), [(4096, 3), (16, 3), (5, 10), (1, 2)])
def test_top_by_inner_product(spark, block, n):
    from vendue.operators.inner_product import top_by_inner_product

    rng = random.Random(block)
    users = [(u, [float(rng.randrange(-4, 9)) for _ in range(6)]) for u in range(50)] + [(900, [0.0] * 6), (901, None)]
    items = [(i, [float(rng.randrange(-2, 6)) * (1 + 9 * (i % 10 == 0)) for _ in range(6)]) for i in range(120)] + [(500, None)]
    schema = "{} long, factors array<double>"
    best, asked = top_by_inner_product(spark.createDataFrame(users, schema.format("user_id")), spark.createDataFrame(items, schema.format("item_id")), n, block)
    expected = []
    for u, a in users:
        if a is not None:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in items if b is not None)
            expected += [(u, i, -s + 0.0, r) for r, (s, i) in enumerate(scores[:n], 1)]
    assert sorted((r["user_id"], r["item_id"], r["score"] + 0.0, r["rank"]) for r in best.collect()) == sorted(expected)
    scored = sum(r["users"] for r in asked.collect()) * block
    assert block > 20 or scored < 0.9 * 51 * 120  # blocks were skipped


@pytest.mark.parametrize("stretch", [8, 64])
def test_top_by_inner_product_over_stretches(spark, monkeypatch, stretch):
    """Blocks of vectors in the same direction are skipped though they are long; equal scores across stretches."""
    from vendue.operators import inner_product

    monkeypatch.setattr(inner_product, "STRETCH_ITEMS", stretch)
    monkeypatch.setattr(inner_product, "SLICE_USERS", 20)
    rng = random.Random(stretch)
    ways = [(9, 0, 0), (0, 9, 0), (0, 0, 9), (-9, 0, 0)]
    items = [(i, [float(x + rng.randrange(-1, 2)) for x in ways[i % 4]]) for i in range(160)] + [(200, [0.0] * 3)]
    users = [(u, [float(x + rng.randrange(2)) for x in ways[u % 3]]) for u in range(45)] + [(50, [0.0] * 3), (51, [-1.0, 0.0, 0.0])]
    schema = "{} long, factors array<double>"
    best, asked = inner_product.top_by_inner_product(spark.createDataFrame(users, schema.format("user_id")), spark.createDataFrame(items, schema.format("item_id")), 3, 8)
    expected = []
    for u, a in users:
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in items)
        expected += [(u, i, -s + 0.0, r) for r, (s, i) in enumerate(scores[:3], 1)]
    assert sorted((r["user_id"], r["item_id"], r["score"] + 0.0, r["rank"]) for r in best.collect()) == sorted(expected)
    assert stretch < 64 or sum(r["users"] for r in asked.collect()) * 8 < 0.5 * len(users) * len(items)


def test_top_by_inner_product_of_nothing(spark):
    from vendue.operators.inner_product import top_by_inner_product

    users = spark.createDataFrame([(1, [1.0])], "user_id long, factors array<double>")
    items = spark.createDataFrame([(1, [1.0])], "item_id long, factors array<double>")
    assert top_by_inner_product(users.where("false"), items)[0].count() == 0
    assert top_by_inner_product(users, items.where("false"))[0].count() == 0
    assert [tuple(r) for r in top_by_inner_product(users, items)[0].collect()] == [(1, 1, 1.0, 1)]


def test_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    """A large table is shuffled into more partitions than the session names, a small one is not."""
    from vendue import session, views
    from vendue.operators.relational import count_distinct

    folder = str(tmp_path)
    spark.range(40_000).selectExpr("id % 400 AS l_partkey", "uuid() AS l_orderkey").repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    kept = [(k, spark.conf.get(k, None)) for k in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")]
    try:
        monkeypatch.setattr(session, "PARTITION_BYTES", 50_000)
        lines = views.Shop(spark, folder).table("lineitem")
        assert count_distinct(lines, ["l_partkey"], "l_orderkey").groupBy("cnt").count().collect() == [(100, 400)]
        assert int(spark.conf.get(kept[0][0])) > 20
        monkeypatch.undo()
        views.Shop(spark, folder).table("lineitem")
        assert spark.conf.get(kept[0][0]) == "4"
    finally:
        for key, value in kept:
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_prediction_for_wanted_keys_only(spark):
    from vendue.plans.recommend import predict_item_based

    sim = spark.createDataFrame([(i, j, 1.0 / (i + j)) for i in range(1, 6) for j in range(1, 6) if i != j], "item_id long, similar_id long, value double")
    rated = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0), (2, 3, 5.0)], "user_id long, item_id long, rating double")
    wanted = spark.createDataFrame([(1, 3), (1, 3), (1, 2), (2, 5), (9, 1)], "user_id long, item_id long")
    every = {(r["user_id"], r["item_id"]): round(r["prediction"], 9) for r in predict_item_based(sim, rated).collect()}
    found = [(r["user_id"], r["item_id"], round(r["prediction"], 9)) for r in predict_item_based(sim, rated, wanted).collect()]
    assert sorted(found) == [(1, 3, every[1, 3]), (2, 5, every[2, 5])]


def test_both_scores_start_from_one_ranked_frame(spark):
    from vendue.plans import best_rank as br

    rows = [(i, "1", i % 4, i % 3, 10 * (i % 5)) for i in range(1, 20)]
    frame = spark.createDataFrame(rows, "item_id long, site_no string, order_count long, click_count long, amount long")
    ranked = br.br_feature_ranks(frame)[0]
    for score in (br.br_rank_score, br.br_norm_score):
        expected = score(frame)
        assert sorted(score(ranked).select(expected.columns).collect()) == sorted(expected.collect())


def test_segments_are_shuffled_by_item_once(spark):
    """From counts to the cube rows move to their item and stay there; sums and item values as by hand."""
    from vendue.plans import segments as sg

    master = "item_id long, site_no string, brand_id string, sell_price long, category_id string"
    items = spark.createDataFrame([(1, "a", "x", 5, "c1"), (1, "b", "y", 9, "c2"), (2, "a", "z", 3, "c1"), (2, "a", "z", 3, "c1")], master)
    counts = spark.createDataFrame(
        [(1, "a", "10", "20", 2, 1, 30), (1, "b", "", "20", 1, None, 5), (1, "a", "", "", 4, 2, -90), (2, "a", None, None, 1, 1, 7), (2, "b", "10", "20", 9, 9, 9)],
        "item_id long, site_no string, gender string, age_band string, order_count long, click_count long, amount long",
    )
    cube = sg.segment_cube(sg.segment_frame(items, counts, spark.createDataFrame([(2,)], "item_id long")))
    got = {tuple(r) for r in cube.select("grouping", "item_id", "gender", "age_band", "site_no", "sell_price", "brand_id", "event", "order_count", "click_count", "amount").collect()}
    assert got == {
        ("age_gender", 1, "10", "20", "a", 5, "", "N", 2, 1, 30),
        ("gender", 1, "10", "", "a", 5, "", "N", 2, 1, 30),
        ("age", 1, "", "20", "b", 9, "", "N", 3, 1, 35),
        ("all", 1, "", "", "b", 9, "y", "N", 7, 3, 35),
        ("all", 2, "", "", "a", 3, "", "Y", 2, 2, 14),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sg.segment_cube(sg.segment_frame(items, counts, items.select("item_id")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 3  # counts, items and event items
