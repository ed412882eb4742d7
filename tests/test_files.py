"""Readers and writers on files."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vendue.sinks import files
from vendue.sinks.tables import Store
from vendue.sources import shop as src
from vendue.sources.delimited import Layout, parse_lines, read_delimited
from vendue.sources.window import RunWindow
from vendue.streaming.micro import read_log_stream, run_available

RUN = RunWindow(datetime(2024, 1, 10, 5))


def event(ms, **at):
    """A log line of 65 fields."""
    fields = [""] * 65
    fields[0] = str(ms)
    for position, value in at.items():
        fields[int(position[1:])] = value
    return "\t".join(fields)


def put(root, text, day=None, hour=None):
    folder = root
    if day:
        folder = folder / f"dt={day}"
    if hour is not None:
        folder = folder / f"hh={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-0.txt").write_text(text, encoding="utf-8")


def ms(day, hour=0):
    return int((datetime(2024, 1, day, hour) - datetime(1970, 1, 1)).total_seconds() * 1000)


def test_layout_needs_its_highest_field(spark):
    lines = spark.createDataFrame([("a|b|c",), ("a|b",), ("H|b|c",), (' "x" |y|"" ',)], "value string")
    got = parse_lines(lines, Layout("|", {"first": 0, "third": 2}, header="H")).collect()
    assert [(r["first"], r["third"]) for r in got] == [("a", "c"), ("x", None)]


def test_header_word_in_data_is_kept(spark):
    lines = spark.createDataFrame([("ITEM_ID|x",), ("1|about ITEM_ID",)], "value string")
    assert parse_lines(lines, Layout("|", {"a": 0, "b": 1}, header="ITEM_ID")).count() == 1


def test_wrong_numbers_become_missing(spark):
    lines = spark.createDataFrame([("x\t2024-01-05 10:00:00\ty",)], "value string")
    row = parse_lines(lines, Layout("\t", {"n": (0, "bigint"), "d": (1, "date"), "t": (2, "epoch_ms")})).first()
    assert (row["n"], row["d"], row["t"]) == (None, date(2024, 1, 5), None)


def test_clicks_of_the_last_days(spark, tmp_path, rows):
    view = dict(f4="/item/itemView.ssg?a", f7="1" * 13, f28="v")
    for day in (6, 7, 8, 9, 10):
        put(tmp_path, event(ms(day, 3), **view) + "\n" + event(ms(day), f7="2" * 13, f4="/main.ssg"), f"2024-01-{day:02d}", 3)
    clicks = src.read_clicks(spark, str(tmp_path), RUN, 3)
    assert rows(clicks, "visit_date", "item_id") == [(date(2024, 1, d), "1" * 13) for d in (7, 8, 9)]
    plan = clicks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_clicks_of_the_last_hours(spark, tmp_path, rows):
    for day, hour in ((9, 22), (9, 23), (10, 0), (10, 4), (10, 5), (10, 6)):
        put(tmp_path, event(ms(day, hour), f4="/a.ssg", f28="v"), f"2024-01-{day:02d}", hour)
    seen = src.read_clicks_hours(spark, str(tmp_path), RUN, 6)
    assert [r[0].hour for r in rows(seen, "ts")] == [0, 4, 5]


def test_demo_and_device(spark, rows):
    lines = spark.createDataFrame(
        [(event(ms(1), f7="1" * 13, f52="1", f53="29", f55="0", f28="a"),), (event(ms(1), f7="1" * 13, f52="2", f53="101", f22="APP", f28="b"),),
         (event(ms(1), f7="1" * 13, f53="x", f22="safari", f28="c"),)], "value string")
    log = parse_lines(lines, src.EVENT_LOG)
    assert rows(src.click_demo(log), "visitor_id", "gender", "age_band") == [("a", "10", "20"), ("b", "20", ""), ("c", "", "")]
    assert [r[0] for r in rows(src.click_rows(log), "device")] == ["MA", "MW", "PC"]


def test_latest_days_there_are(spark, tmp_path, rows):
    for day in (1, 3, 4, 6, 9):
        put(tmp_path, "\\|".join([f"d{day}", *"abcdef", f"s{day}"]), f"2024-01-{day:02d}")
    sales = src.read_latest_days(spark, str(tmp_path), RUN, want=3)
    assert rows(sales, "offline_item_id") == [("s3",), ("s4",), ("s6",)]


def test_masters(spark, tmp_path, rows):
    item = ['"0000000000001', *[f"f{i}" for i in range(1, 35)]]
    item[9], item[16], item[17], item[21], item[31], item[34] = "20", "10", "70", "2024-01-01 00:00:00", "2024-01-02", 'Y"'
    put(tmp_path / "item", '"|"'.join(item))
    got = src.read_item(spark, str(tmp_path / "item")).first()
    assert (got["item_id"], got["sell_status"], got["shown_from"], got["searchable"]) == ("0000000000001", 20, date(2024, 1, 1), "Y")
    put(tmp_path / "ctg", '"|"'.join(['"1', "nm", "0", "", "L", "ln", "M", "mn", "S", "sn", "D", "dn", "", "", 'Y"']))
    assert src.read_category(spark, str(tmp_path / "ctg")).columns == src.CATEGORY_IDS
    assert src.read_category(spark, str(tmp_path / "ctg"), with_names=True).first()["detail_name"] == "dn"
    put(tmp_path / "price", "\n".join(["ITEM_ID|s" + "|x" * 8, "1|6001|2|100|90" + "|" * 5, "1|6001|short"]))
    assert rows(src.read_price(spark, str(tmp_path / "price")), "item_id", "sell_price", "low_price") == [("1", 100, 90)]
    put(tmp_path / "map", "S1\\|10\\|77")
    assert rows(src.read_offline_map(spark, str(tmp_path / "map")), "offline_item_id", "item_id") == [("S1", "77")]
    put(tmp_path / "sim", "12,34,0.5\n" + "1" * 14 + ",2,0.25", "2024-01-10")
    assert rows(src.read_similarity(spark, str(tmp_path / "sim"), date(2024, 1, 10)), "item_id", "value") == [
        ("0" * 11 + "12", 0.5), ("1" * 14, 0.25)]


def test_product_list_by_site(spark, tmp_path):
    put(tmp_path, "\n".join(",".join(["d", site, "s", "i"] + [""] * 13) for site in ("6005", "6001")))
    assert [r["display_site"] for r in src.read_prod(spark, str(tmp_path), sites=["6005"]).collect()] == ["6005"]
    assert [r["display_site"] for r in src.read_prod(spark, str(tmp_path), not_sites=["6005"]).collect()] == ["6001"]


def test_tab_rows_keep_empty_tails(spark, tmp_path):
    df = spark.createDataFrame([("a", None, ""), ("b", "c", "d")], "x string, y string, z string")
    files.write_tsv(df, str(tmp_path / "t"), single_file=True)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a\t\t\tEND", "b\tc\td\tEND"]
    back = read_delimited(spark, str(tmp_path / "t"), Layout("\t", {"x": 0, "y": 1, "z": 2}))
    assert sorted(back.collect()) == [("a", None, None), ("b", "c", "d")]


def test_csv_files(spark, tmp_path):
    df = spark.range(100).repartition(5)
    files.write_csv(df, str(tmp_path / "one"), single_file=True)
    files.write_csv(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1 and len(list((tmp_path / "many").glob("part-*"))) == 5


def test_partitions_are_replaced_one_by_one(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    files.write(spark.createDataFrame([(1, "a"), (2, "b")], "n int, dt string"), path, ["dt"])
    files.write(spark.createDataFrame([(3, "b")], "n int, dt string"), path, ["dt"])
    assert rows(spark.read.parquet(path), "n", "dt") == [(1, "a"), (3, "b")]


def test_rules_as_text(spark, tmp_path):
    rules = spark.createDataFrame([("a", ["b", "c"], 0.5, 0.25, 1.5)], "antecedent string, consequent array<string>, support double, confidence double, lift double")
    files.write_rules(rules, str(tmp_path / "r"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "r")).collect()) == [
        "a|b|0.5000000|0.2500000|1.5000000", "a|c|0.5000000|0.2500000|1.5000000"]


def test_store(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    assert store.current_slot("best") is None and not store.exists("best")
    with pytest.raises(ValueError):
        store.read("best")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert store.swap("best", first) == "10" and store.swap("best", first.limit(1)) == "20"
    assert store.current_slot("best") == "20" and store.read("best").count() == 1
    store.upsert("keyed", first, ["id"], datetime(2024, 1, 1))
    store.upsert("keyed", spark.createDataFrame([(2, "new"), (3, None)], "id int, name string"), ["id"], datetime(2024, 1, 2))
    assert rows(store.read("keyed", ["id", "name"]), "id", "name") == [("1", "a"), ("2", "new"), ("3", "")]
    for name in ("again", "again", "once more"):  # the same time: the load that comes last wins
        store.upsert("keyed", spark.createDataFrame([(2, name)], "id int, name string"), ["id"], datetime(2024, 1, 2))
        assert rows(store.read("keyed", ["id", "name"]), "id", "name")[1] == ("2", name)
    store.copy("keyed", "copied")
    assert store.read("copied").count() == 3


def test_log_folder_as_stream(spark, tmp_path, rows):
    logs, out, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    logs.mkdir()
    (logs / "h1.txt").write_text(event(ms(1), f28="a") + "\n")

    def run():
        run_available(read_log_stream(spark, str(logs), src.EVENT_LOG), out, state,
                      lambda df: df.select("visitor_id", F.to_date("ts").alias("dt")), ["dt"])

    run()
    (logs / "h2.txt").write_text(event(ms(2), f28="b") + "\n")
    run()
    run()
    assert rows(spark.read.parquet(out), "visitor_id", "dt") == [("a", date(2024, 1, 1)), ("b", date(2024, 1, 2))]


def test_no_day_there(spark, tmp_path):
    put(tmp_path, "\\|".join(["d", *"abcdef", "s"]), "2023-01-01")
    assert src.read_latest_days(spark, str(tmp_path), RUN).count() == 0
