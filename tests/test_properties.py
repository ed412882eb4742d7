"""Properties of scores and lists, and split paths against plain ones."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vendue.functions import scoring
from vendue.operators.ranking import position, top_k
from vendue.operators.similarity import item_similarity
from vendue.plans import recommend as rc
from vendue.plans.best_rank import copy_sites, final_rank
from vendue.plans.search_best import login_history
from vendue.plans.segments import SCORE_COLUMNS
from vendue.sources.window import RunWindow


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    # a third of the rows share one value, one group holds most rows
    data = [(i, "a" if i % 4 else f"g{i % 3}", 0 if i % 3 == 0 else rng.randrange(50)) for i in range(900)]
    return spark.createDataFrame(data, "id int, grp string, score int")


ORDER = [("score", "desc"), ("id", "asc")]


@pytest.mark.parametrize("kind", ["row_number", "rank"])
@pytest.mark.parametrize("within", [[], ["grp"]])
def test_split_numbers_equal_window(scored, kind, within, rows):
    plain = position(scored, ORDER, within, "n", kind)
    split = position(scored, ORDER, within, "n", kind, limit=50)
    assert rows(plain, "id", "n") == rows(split, "id", "n")


def test_split_numbers_with_missing_values(spark, rows):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 7) for i in range(60)], "id int, score int")
    for kind in ("row_number", "rank"):
        assert rows(position(df, ORDER, (), "n", kind), "id", "n") == rows(
            position(df, ORDER, (), "n", kind, limit=5), "id", "n")


def test_numbers_are_a_permutation(scored):
    numbers = [r["n"] for r in position(scored, ORDER, (), "n", limit=50).collect()]
    assert sorted(numbers) == list(range(1, 901))


def test_top_k_paths(scored, rows):
    assert rows(top_k(scored, ORDER, 100), "id") == rows(top_k(scored, ORDER, 100, limit=10), "id")


def test_scaled_values(scored):
    out = scoring.min_max_scale(scoring.log_scale(scored, ["score"]), ["score_log"]).agg(
        F.min("score_log_norm"), F.max("score_log_norm")).first()
    assert tuple(out) == (0.0, 100.0)


def test_equal_bounds_give_missing(spark):
    df = spark.createDataFrame([(1,), (1,)], "x int")
    assert [r[0] for r in scoring.min_max_scale(df, ["x"]).select("x_norm").collect()] == [None, None]


def test_freshness(spark):
    ages = [-1, 0, 7, 8, 14, 77, 78, 84, 85]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(scoring.freshness(F.col("age"))).collect()]
    assert got == pytest.approx([1 / 12, 1, 1, 1 / 2, 1 / 2, 1 / 11, 1 / 12, 1 / 12, 1 / 12])


def hold(rng, users, items, big):
    pairs = {(u, rng.randrange(items)) for u in range(users) for _ in range(rng.randrange(1, 6))}
    pairs |= {(1000 + b, i) for b in range(big) for i in range(items) if rng.random() < 0.8}
    return sorted(pairs)


@pytest.mark.parametrize("measure", ["llr", "tanimoto", "pearson", "euclidean"])
@pytest.mark.parametrize("big", [1, 3])
def test_users_far_above_a_slice(spark, measure, big):
    rng = random.Random(big)
    data = [(u, i, float(rng.randrange(1, 6))) for u, i in hold(rng, 30, 40, big)]
    data += data[:5] if measure in ("llr", "tanimoto") else []
    pairs = spark.createDataFrame(data, "user_id bigint, item_id bigint, rating double")

    def view(slice_items):
        found = item_similarity(pairs, 8, measure, slice_items).collect()
        return sorted((r["item_id"], r["rank"], r["similar_id"], round(r["value"], 9)) for r in found)

    assert view(1_000) == view(3)


def test_partners_of_some_items(spark):
    pairs = spark.createDataFrame(hold(random.Random(5), 30, 20, 1), "user_id bigint, item_id bigint")
    some = spark.createDataFrame([(3,), (3,), (7,)], "item_id bigint")
    view = lambda df: sorted((r["item_id"], r["similar_id"], round(r["value"], 9)) for r in df.collect())
    every = view(item_similarity(pairs, None))
    assert view(item_similarity(pairs, None, items=some)) == [r for r in every if r[0] in (3, 7)]


def test_llr_value(spark):
    # users 1..4; items a, b held together by two users
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 3)], "user_id bigint, item_id bigint")
    got = {(r["item_id"], r["similar_id"]): r["value"] for r in item_similarity(pairs, 5).collect()}
    # k11=2 k12=1 k21=0 k22=1
    from math import log

    def h(*xs):
        n = sum(xs)
        return n * log(n) - sum(x * log(x) for x in xs if x)

    llr = 2 * (h(3, 1) + h(2, 2) - h(2, 1, 0, 1))
    assert got[(1, 2)] == pytest.approx(1 - 1 / (1 + llr))
    assert (1, 3) not in got


def test_blend_between(spark):
    schema = "item_id int, similar_id int, site_no string, value double, category_path string"
    prev = spark.createDataFrame([(1, 2, "1", 0.2, "old"), (1, 3, "1", 0.5, "old")], schema)
    today = spark.createDataFrame([(1, 2, "1", 0.6, "new"), (1, 4, "1", 0.9, "new")], schema)
    got = {r["similar_id"]: (round(r["value"], 6), r["category_path"]) for r in rc.blend_scores(prev, today).collect()}
    assert got == {2: (0.4, "old"), 3: (0.5, "old"), 4: (0.9, "new")}


def test_cascade(spark, rows):
    schema = "item_id int, site_no string, candidate int, rank int"
    a = spark.createDataFrame([(1, "s", 10, 1), (1, "s", 11, 2), (1, "t", 11, 3)], schema)
    b = spark.createDataFrame([(1, "s", 11, 1), (1, "s", 12, 2), (1, "s", 13, 3), (2, "s", 11, 1), (2, "u", 12, 1)], schema)
    columns = ("item_id", "position", "site_no", "candidate", "source")
    out = rc.recommend_cascade([("itembase", a), ("category", b)], 4)
    assert rows(out, *columns) == [
        (1, 1, "s", 10, "itembase"), (1, 2, "s", 11, "itembase"), (1, 3, "t", 11, "itembase"), (1, 4, "s", 12, "category"),
        (2, 1, "s", 11, "category"), (2, 2, "u", 12, "category")]
    out = rc.recommend_cascade([("itembase", a), ("category", b)], 3, ["s"])
    assert rows(out, *columns) == [
        (1, 1, "s", 10, "itembase"), (1, 2, "s", 11, "itembase"), (1, 3, "s", 12, "category"), (2, 1, "s", 11, "category")]


def test_cascade_without_repeats(spark):
    rng = random.Random(5)
    frames, schema = [], "item_id int, site_no string, candidate int, rank int"
    for name in ("a", "b", "c"):
        data = [(i, rng.choice("st"), rng.randrange(40), r) for i in range(20) for r in range(1, 15)]
        frames.append((name, spark.createDataFrame(data, schema).dropDuplicates(["item_id", "site_no", "candidate"])))
    out = rc.recommend_cascade(frames, 12)
    found = F.countDistinct("candidate", "site_no").alias("d")
    per_item = out.groupBy("item_id").agg(F.count("*").alias("n"), found).collect()
    assert all(r["n"] == r["d"] == 12 for r in per_item)


def test_copy_sites(spark, rows):
    df = spark.createDataFrame([(1, "6200", "6005"), (2, "6300", "6005"), (3, "6009", "6005")], "item_id int, sell_site string, display_site string")
    assert rows(copy_sites(df), "item_id", "display_site") == [
        (1, "6001"), (1, "6005"), (1, "6200"), (2, "6004"), (2, "6005"), (2, "6300"), (3, "6005"), (3, "6009")]


def test_faded_item_with_text_ids(spark, rows):
    df = spark.createDataFrame([("1000010008801", 1), ("2", 2), ("x3", 3)], "item_id string, final_rank int").withColumns(
        {"display_site": F.lit("6005"), "sell_site": F.lit("6001"), "total_score": F.lit(1.0)})
    out = final_rank(df, date(2017, 9, 12))
    assert rows(out, "item_id", "final_rank") == [("1000010008801", 3), ("2", 1), ("x3", 2)]


def test_rule_measures(spark):
    data = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "c")]
    rules = rc.pair_rules(spark.createDataFrame(data, "order_no int, item_id string"), 0.1, 0.1)
    got = {(r["antecedent"], r["consequent"]): r for r in rules.collect()}
    ab, ba = got[("a", "b")], got[("b", "a")]
    assert ab["support"] == 0.5 and ab["confidence"] == pytest.approx(2 / 3)
    assert ab["lift"] == pytest.approx(4 / 3) and ab["conviction"] == pytest.approx(1.5)
    assert ba["confidence"] == 1.0 and ba["conviction"] is None


def test_segment_columns():
    assert len(SCORE_COLUMNS) == 15 and SCORE_COLUMNS[0] == "twenties_male" and SCORE_COLUMNS[-1] == "all_ages_all"


def test_login_history_drops_old(spark, rows):
    prev = spark.createDataFrame([(1, "v1", date(2023, 7, 29)), (2, "v2", date(2023, 7, 30)), (5, "v3", date(2023, 1, 1))],
                                 "member_id int, visitor_id string, updated date")
    clicks = spark.createDataFrame([(9, "v3", date(2024, 1, 29)), (8, "v4", date(2024, 1, 30)), (None, "v5", date(2024, 1, 29))],
                                   "member_id int, visitor_id string, visit_date date")
    out = login_history(prev, clicks, date(2024, 1, 31))
    assert rows(out, "visitor_id", "member_id") == [("v2", 2), ("v3", 9)]


def test_run_window():
    assert RunWindow.parse("17-09-12-05").as_of == datetime(2017, 9, 12, 5)
    assert RunWindow.parse("17-09-12").day == date(2017, 9, 12)
    assert RunWindow.parse(now=datetime(2024, 1, 1, 0, 30)).as_of == datetime(2023, 12, 31, 23)


def test_als_names_ids_beyond_32_bits(spark):
    from vendue.plans.recommend import als_recommend

    base = 1_000_010_008_801
    rows = [(base + u, base * 7 + i, float(1 + (u * i) % 5)) for u in range(6) for i in range(5) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    found = als_recommend(ratings, iters=2, n=3).collect()
    assert {r["user_id"] for r in found} == {r[0] for r in rows}
    assert {r["item_id"] for r in found} <= {r[1] for r in rows}
    for user in {r[0] for r in rows}:
        assert sorted(r["rank"] for r in found if r["user_id"] == user) == [1, 2, 3]
    few = spark.createDataFrame([(base + 2,), (base + 2,), (5,)], "user_id bigint")
    assert {r["user_id"] for r in als_recommend(ratings, iters=2, n=3, users=few).collect()} == {base + 2}
