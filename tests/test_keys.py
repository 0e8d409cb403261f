import uuid

from pyspark.sql import functions as F

from pricelake.functions.keys import KEY_NAMESPACE, canon_name, usable_name, uuid5

NS = uuid.UUID(KEY_NAMESPACE)


def test_uuid5_matches_python(spark):
    names = ["AK-47 | Redline (Field-Tested)", "★ Karambit | Fade (Factory New)", "", "hot gear", "日本語"]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    got = {r["name"]: r["k"] for r in df.select("name", uuid5("name").alias("k")).collect()}
    for n in names:
        assert got[n] == str(uuid.uuid5(NS, n))
    assert got[None] is None


def test_canon_name_and_usable(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), (None, None), ("", "x")], "m string, n string")
    out = df.select(canon_name("m", "n").alias("c")).select("c", usable_name("c").alias("ok")).collect()
    assert [(r.c, r.ok) for r in out] == [("a", True), ("b", True), (None, False), ("", False)]
