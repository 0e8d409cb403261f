import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from pricelake.operators import marts

D = "decimal(18,4)"


def _books(spark, a_rows, b_rows):
    a = spark.createDataFrame(a_rows, f"id_name string, date_extracted timestamp, suggested_price {D}")
    b = spark.createDataFrame(b_rows, f"id_name string, date_extracted timestamp, price {D}")
    p = spark.createDataFrame([("k1", "one"), ("k2", "two"), ("k3", "three")], "id_name string, name string")
    return marts.joined_books(a, b, p)


T1 = dt.datetime(2025, 11, 5, 10)
T2 = dt.datetime(2025, 11, 5, 12)
T3 = dt.datetime(2025, 11, 6, 1)


def test_arbitrage_cases(spark):
    j = _books(spark,
               [("k1", T1, Decimal(5)), ("k1", T2, Decimal(10)),  # latest of the day wins
                ("k2", T2, Decimal(3)), ("k3", T2, Decimal(0))],
               [("k1", T1, Decimal(12)), ("k2", T2, Decimal(3)), ("k3", T1, Decimal(4)),
                ("k3", T3, Decimal(1))])  # other day: not joined
    out = {r.item_name: r for r in marts.arbitrage(j, "A", "B").collect()}
    assert set(out) == {"one", "three"}  # equal prices dropped
    one = out["one"]
    assert (one.buy_platform, one.sell_platform, one.profit_abs) == ("A", "B", Decimal("2.0000"))
    assert abs(one.profit_pct - 20.0) < 1e-12 and one.date_extracted == T2
    three = out["three"]
    assert three.buy_platform == "A" and three.profit_pct == 0.0  # lower price 0 -> 0 %


def test_order_books_keep_equal_prices(spark):
    j = _books(spark, [("k2", T2, Decimal(3))], [("k2", T1, Decimal(3))])
    r = marts.order_books(j).first()
    assert r.price_diff == Decimal("0.0000") and r.item_name == "two"


def _history(spark, rows):
    return spark.createDataFrame(rows, (
        f"id_name string, date_extracted timestamp, last_24_hours_avg {D}, last_24_hours_volume int, "
        f"last_7_days_min {D}, last_7_days_max {D}, last_7_days_avg {D}, last_7_days_volume int"))


def test_volatility_guards(spark):
    h = _history(spark, [
        ("k1", T1, Decimal(1), 1, Decimal(2), Decimal(6), Decimal(4), 3),
        ("k2", T1, Decimal(1), 1, Decimal(2), Decimal(6), None, 3),
        ("k3", T1, Decimal(1), 1, None, Decimal(6), Decimal(4), 3),
    ])
    p = spark.createDataFrame([("k1", "one"), ("k2", "two"), ("k3", "three")], "id_name string, name string")
    out = {r.item_name: r for r in marts.volatility(h, p).collect()}
    assert out["one"].volatility_index == 1.0 and out["one"].spread_7d == Decimal("4.0000")
    assert out["two"].volatility_index == 0.0  # NULL average -> 0
    assert out["three"].volatility_index is None and out["three"].spread_7d is None


def test_group_rules_first_match_wins(spark):
    names = ["AK-47 | Redline", "★ Karambit | Fade", "AWP Knife Mix", "Sport Gloves", "Glock | X"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.g for r in df.select(marts.classify(F.col("name"), marts.DEFAULT_GROUP_RULES).alias("g")).collect()]
    assert got == ["AK-47", "Knife", "AWP", "Gloves", None]


def test_group_analytics_exact_average(spark):
    h = _history(spark, [
        ("k1", T1, Decimal("0.1"), 1, None, None, None, None),
        ("k1", T2, Decimal("0.2"), 2, None, None, None, None),  # latest of k1 that day
        ("k2", T1, Decimal("0.1"), 5, None, None, None, None),
    ])
    p = spark.createDataFrame([("k1", "AK-47 | A"), ("k2", "AK-47 | B")], "id_name string, name string")
    r = marts.group_analytics(h, p).first()
    assert r.group_name == "AK-47" and r.total_volume == 7
    assert r.avg_price == 0.30000000000000004 / 2 or abs(r.avg_price - 0.15) < 1e-15


def test_sales_history_latest_per_name_day(spark):
    h = _history(spark, [
        ("k1", T1, Decimal(1), 1, None, None, None, None),
        ("k1", T2, Decimal(2), 2, None, None, None, None),
        ("k1", T3, Decimal(3), 3, None, None, None, None),
    ])
    p = spark.createDataFrame([("k1", "one")], "id_name string, name string")
    got = sorted((r.date_extracted, r.volume_24h) for r in marts.sales_history(h, p).collect())
    assert got == [(dt.date(2025, 11, 5), 2), (dt.date(2025, 11, 6), 3)]


def test_books_scale_side_b(spark):
    from pyspark.sql import functions as F

    a = spark.createDataFrame([("k1", T2, Decimal(10))], f"id_name string, date_extracted timestamp, suggested_price {D}")
    b = spark.createDataFrame([("k1", T1, Decimal(5))], f"id_name string, date_extracted timestamp, price {D}")
    p = spark.createDataFrame([("k1", "one")], "id_name string, name string")
    r = marts.arbitrage(marts.joined_books(a, b, p, scale_b=2.0)).collect()
    assert r == []  # 10 vs 5 x 2: no gap
    r = marts.order_books(marts.joined_books(a, b, p)).first()
    assert r.price_diff == Decimal("5.0000")


def test_group_analytics_is_the_same_with_and_without_broadcast(spark):
    """A catalog with two rows of one id: dedup first, then join, at every size."""
    import datetime as dt

    from pricelake.operators.marts import group_analytics

    product = spark.createDataFrame([("i", "Lamp one"), ("i", "Lamp two")], "id_name string, name string")
    t = dt.datetime(2025, 1, 1, 5)
    history = spark.createDataFrame([("i", t, 2.0, 5)], "id_name string, date_extracted timestamp, last_24_hours_avg double, last_24_hours_volume int")
    got = []
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("-1", "10485760"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got.append([tuple(r) for r in group_analytics(history, product, [("lamps", ["Lamp%"])]).collect()])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got[0] == got[1] and got[0][0][3] == 10
