from pricelake.operators import joins


def test_size_estimate_and_checked_broadcast(spark):
    small = spark.range(100)
    assert joins.estimated_bytes(small) is not None
    assert joins.fits_broadcast(small)
    assert not joins.fits_broadcast(small, limit=1)
    est = joins.estimated_bytes(small)
    assert joins.fits_broadcast(small, limit=est * joins.EXPANSION_FACTOR)
    assert not joins.fits_broadcast(small, limit=est * joins.EXPANSION_FACTOR - 1)
    plan = spark.range(10).join(joins.maybe_broadcast(small), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_disabled_threshold_disables_checked_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not joins.fits_broadcast(spark.range(10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
