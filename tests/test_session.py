from salesfacts.session import cluster_conf

TB = 1 << 40


def test_shuffle_width_from_estimated_shuffle_bytes():
    assert cluster_conf(100 * TB, 8000)["spark.sql.shuffle.partitions"] == "51200"


def test_shuffle_width_floor_and_cap():
    assert cluster_conf(1 << 30, 8000)["spark.sql.shuffle.partitions"] == "16000"     # 2 waves
    assert cluster_conf(10_000 * TB, 8000)["spark.sql.shuffle.partitions"] == "100000"  # capped


def test_adaptive_and_jit_settings_present():
    c = cluster_conf(TB, 100)
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "-XX:-DontCompileHugeMethods" in c["spark.executor.extraJavaOptions"]
