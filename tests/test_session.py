"""Session helpers: partition sizing and the shared checkpoint folder."""

from strata.session import ensure_checkpoint_dir, scale_conf


def test_scale_conf_100tb():
    c = scale_conf(input_bytes=100e12, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == int(100e12 // (256 << 20)) + 1
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    small = scale_conf(input_bytes=1e9, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24000  # three waves of cores


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    assert got and (configured is None or got == configured)
    assert ensure_checkpoint_dir(spark) == got          # idempotent
    assert not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()
