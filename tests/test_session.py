"""Session helpers: sizing and the shared folder."""

from gateflow.session import MB, scratch_path, shared_dir, sizing_conf


def test_sizing_scales():
    small = sizing_conf(10 * MB, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"           # two waves at least
    tb100 = sizing_conf(100 * 1024**4, cores=8000)
    assert tb100["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * MB))
    mid = sizing_conf(1024**4, cores=800)
    assert mid["spark.sql.shuffle.partitions"] == str(1024**4 // (256 * MB))


def test_shared_dir_comes_from_session(spark):
    base = shared_dir(spark)
    assert base and scratch_path(spark, "x").startswith(base + "/x/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_size_for_input_sets_runtime_conf(spark, tmp_path):
    from gateflow.session import size_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset("spark.sql.shuffle.partitions")
    (tmp_path / "f.csv").write_text("x\n" * 1000)
    try:
        conf = size_for_input(spark, str(tmp_path))
        cores = spark.sparkContext.defaultParallelism
        assert conf["spark.sql.shuffle.partitions"] == str(2 * cores)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(2 * cores)
        # A setting of the user or the cluster stays.
        spark.conf.set("spark.sql.shuffle.partitions", "777")
        assert "spark.sql.shuffle.partitions" not in size_for_input(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "777"
    finally:
        for key in conf:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)
