"""Payload flattening on hand-made events."""

import json
import random

from vendue.plans import events as ev

EVENT = "id int, referrer string, payload string"


def line(**kw):
    return {"cartId": "c", "masterCartId": "m", "uitemId": "0", "cartItemSiteNo": "1", "itemId": "i", "ordQty": 2.0, **kw}


def flows(*pairs):
    return [{"ordItemInfloTgtId": t, "ordItemInfloDivCd": k} for t, k in pairs]


def test_explode_cart(spark, rows):
    data = [
        (1, "", json.dumps([line()])),
        (2, "/r", json.dumps([line(ordItemInfloExtApiDtoList=flows(("t1", "01"), ("t2", "03"), ("t3", "02")))])),
        (3, "/r", json.dumps([line(ordItemInfloExtApiDtoList=[])])),
        (4, "/r", json.dumps([line(ordItemInfloExtApiDtoList=None), line(itemId="j", ordQty=1.9)])),
        (5, "/r", "{broken"),
    ]
    out = ev.explode_cart(spark.createDataFrame(data, EVENT))
    assert rows(out, "id", "referrer", "item_id", "qty", "inflow_target") == [
        (1, ".", "i", 2, ""),
        (2, "/r", "i", 2, "t1"),
        (2, "/r", "i", 2, "t3"),
        (4, "/r", "i", 2, ""),
        (4, "/r", "j", 1, ""),
    ]


def order(*lines):
    base = {k: "x" for k in ("ckWhere", "mbrId", "pcid", "dmId", "sessionId", "ip", "browser", "tgtMediaCd")}
    items = [
        {"ordItemSeq": float(i), "unitPrice": 1000.0, "ordQty": 1.0, "cartItemSiteNo": "1", "masterCartId": "m",
         "cartId": "c", "uitemId": "0", "itemId": f"i{i}", "infloSiteNo": "1", "ordItemRepTypeCd": rep,
         "ordItemTypeCd": kind, "itemChrctDtlCd": trait}
        for i, (rep, kind, trait) in enumerate(lines)
    ]
    return json.dumps({"ordNo": "o", "ordCmplDts": "d", "baseProperties": {**base, "timestamp": 1700000000000.0}, "subOrderItemList": items})


def test_explode_orders(spark, rows):
    data = [(1, "", order(("10", "10", "10"), ("30", "10", "10"), ("30", "12", "10"), ("10", "10", "60"), ("10", "10", "90")))]
    all_rows, visits = ev.explode_orders(spark.createDataFrame(data, EVENT))
    assert [r[0] for r in rows(all_rows, "item_id")] == ["i0", "i1", "i2", "i3", "i4"]
    assert [r[0] for r in rows(visits, "item_id")] == ["i0", "i2"]


def test_explode_ads(spark, rows):
    payload = json.dumps({"Position": "VIEW", "Type": "PV", "UnitInfoList": [
        {"adTgtId": "A1", "advertExtensTeryDivCd": ""}, {"adTgtId": "A2", "advertExtensTeryDivCd": "20"}, {"adTgtId": "A3"}]})
    out = ev.explode_ads(spark.createDataFrame([(1, "", payload), (2, "", "")], EVENT))
    assert rows(out, "id", "type", "position", "target_id", "extension_code") == [
        (1, "pv", "view", "a1", "10"), (1, "pv", "view", "a2", "20"), (1, "pv", "view", "a3", "10")]


def test_ad_contribution(spark, rows):
    data = [("1234567890", "10", "x"), ("301234567890", "20", "SSGAPP/2"), ("12345", "10", "x"), ("", "10", "x"), ("1234567890", "20", "x")]
    df = spark.createDataFrame([(*d, "o", "c", 2, 500) for d in data],
                               "inflow_target string, os_code string, user_agent string, order_no string, cart_id string, qty int, unit_price int")
    from pyspark.sql import functions as F

    df = df.withColumns({"order_ts": F.lit("2024-01-01 10:00:30").cast("timestamp"), "cart_ts": F.lit(None).cast("timestamp")})
    assert rows(ev.ad_contribution(df), "target_id", "extension_code", "device_code", "sales_amount") == [
        ("1234567890", "10", "10", 1000), ("1234567890", "10", "20", 1000), ("1234567890", "30", "30", 1000)]


def test_merge_page_sets_joins_reduced_lists(spark, monkeypatch):
    """Rows with nulls in every column against all pairs; a page of many rows meets the join in a few."""
    rng = random.Random(6)
    names = ["kind", "mall", "url", "param", "device", "shop", "shop_detail", "day"]
    some = lambda *of: rng.choice((None, *of))

    def pages(n):
        return [(some(1, 2), some("m", "n"), some("u", "v"), some("", "p"), some("pc", "app"), some("a", "b", "c"), some("d", "e"), some("x", "y")) for _ in range(n)]

    left, right = pages(300) + [(1, "m", "hot", "p", "pc", "a", None, "x")] * 200, pages(250) + [(1, "n", "hot", "p", "pc", "b", "e", "y")] * 300
    pairs, used = [], set()
    for a in left:
        own = [(k, b) for k, b in enumerate(right) if a[2:5] == b[2:5] and None not in a[2:5]]
        used |= {k for k, _ in own}
        pairs += [tuple(y if x is None else x for x, y in zip(a, b, strict=True)) for _, b in own] or [a]
    pairs += [b for k, b in enumerate(right) if k not in used]
    expected = {}
    for p in pairs:
        old = expected.get(p[:5], (None,) * 3)
        expected[p[:5]] = tuple(max((v for v in both if v is not None), default=None) for both in zip(old, p[5:], strict=True))
    joined = []
    merge = ev.merge_full
    monkeypatch.setattr(ev, "merge_full", lambda a, b, *more: joined.append((a, b, out := merge(a, b, *more))) or out)
    schema = ", ".join(f"{c} {'int' if c == 'kind' else 'string'}" for c in names)
    found = ev.merge_page_sets(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).select(names).collect()
    assert {tuple(r)[:5]: tuple(r)[5:] for r in found} == expected and len(found) == len(expected)
    assert [f.where("url = 'hot'").count() for f in joined[0]] == [1, 1, 1]
