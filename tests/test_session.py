from pricelake.session import sizing_conf


def test_sizing_for_100tb():
    conf = sizing_conf(100 << 40, executor_memory_bytes=32 << 30, cores_per_executor=8, executors=1000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    target = int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    assert target == 256 << 20 and parts >= 100 * 1024 * 4  # 100 TB in 256 MB pieces
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 128 << 20


def test_sizing_small_input_keeps_waves():
    conf = sizing_conf(1 << 30, executor_memory_bytes=4 << 30, cores_per_executor=4, executors=10)
    assert int(conf["spark.sql.shuffle.partitions"]) == 120
