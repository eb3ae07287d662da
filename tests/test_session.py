import os

from bazaar.session import checkpoint_dir, scratch_path


def test_checkpoint_dir_in_local_session(spark):
    # spark.checkpoint.dir is unset in the test session: a local session gets
    # one scratch folder, reused by later calls and registered for checkpoints
    d = checkpoint_dir(spark)
    assert os.path.isdir(d)
    assert checkpoint_dir(spark) == d
    assert scratch_path(spark, "x") == os.path.join(d, "x")
    assert spark.sparkContext.getCheckpointDir() is not None
    df = spark.range(10).checkpoint()          # reliable checkpoint works there
    assert df.count() == 10


def test_defaults_fill_gaps_only(spark):
    from bazaar.session import PLAN_DEFAULTS, build_session
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    try:
        same = build_session()
        assert same.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert same.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert same.conf.get("spark.sql.files.maxPartitionBytes") == PLAN_DEFAULTS["spark.sql.files.maxPartitionBytes"]
        assert build_session(extra={"spark.sql.session.timeZone": "UTC"}).conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
