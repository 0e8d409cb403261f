from pyspark.sql import functions as F

from pricelake.operators import merge

from conftest import rows

K = ["k"]


def _t(spark, data):
    return spark.createDataFrame(data, "k string, a int, b int")


def test_upsert_inserts_and_updates(spark):
    t = _t(spark, [("x", 1, 1), ("y", 2, 2)])
    s = _t(spark, [("y", 20, None), ("z", 30, 3)])
    assert rows(merge.upsert(t, s, K)) == [("x", 1, 1), ("y", 20, None), ("z", 30, 3)]


def test_upsert_preserving_columns(spark):
    t = _t(spark, [("x", 1, 1), ("y", 2, 2)])
    s = _t(spark, [("y", 20, 99), ("z", 30, 3)])
    assert rows(merge.upsert(t, s, K, update_cols=["a"])) == [("x", 1, 1), ("y", 20, 2), ("z", 30, 3)]


def test_null_keys_never_conflict(spark):
    t = _t(spark, [(None, 1, 1)])
    s = _t(spark, [(None, 2, 2), (None, 3, 3)])
    assert len(rows(merge.upsert(t, s, K, order=[F.col("a")]))) == 3
    assert len(rows(merge.insert_ignore(t, s, K, order=[F.col("a")]))) == 3


def test_insert_ignore_first_writer_wins(spark):
    t = _t(spark, [("x", 1, 1)])
    s = _t(spark, [("x", 9, 9), ("z", 5, 5), ("z", 4, 4)])
    out = rows(merge.insert_ignore(t, s, K, order=[F.col("a").desc()]))
    assert out == [("x", 1, 1), ("z", 5, 5)]


def test_update_from_null_overwrites(spark):
    t = _t(spark, [("x", 1, 1), ("y", 2, 2)])
    s = _t(spark, [("y", None, 7), ("q", 5, 5)])
    assert rows(merge.update_from(t, s, K, ["a"])) == [("x", 1, 1), ("y", None, 2)]


def test_update_then_insert_new_equals_upsert(spark):
    t = _t(spark, [("x", 1, 1), ("y", 2, 2)])
    s = _t(spark, [("y", 20, 21), ("z", 30, 31)])
    two_step = merge.insert_new(merge.update_from(t, s, K, ["a", "b"]), s, K)
    assert rows(two_step) == rows(merge.upsert(t, s, K))


def test_merges_are_idempotent(spark):
    t = _t(spark, [("x", 1, 1), ("y", 2, 2)])
    s = _t(spark, [("y", 20, 21), ("z", 30, 31)])
    for op in (lambda a: merge.upsert(a, s, K), lambda a: merge.insert_ignore(a, s, K),
               lambda a: merge.insert_new(a, s, K), lambda a: merge.update_from(a, s, K, ["a"])):
        once = op(t)
        assert rows(op(once)) == rows(once)


def test_insert_ignore_keeps_target_rows(spark):
    t = _t(spark, [("x", 1, 1)])
    s = _t(spark, [("x", 2, 2)])
    assert rows(merge.insert_ignore(t, s, K)) == [("x", 1, 1)]


def test_replace_and_append(spark):
    t = _t(spark, [("x", 1, 1)])
    s = _t(spark, [("x", 2, 2)])
    assert rows(merge.replace(t, s)) == [("x", 2, 2)]
    assert len(rows(merge.append(t, s))) == 2
