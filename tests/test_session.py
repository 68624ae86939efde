"""Plan defaults apply only where the session has no value; the checkpoint
folder comes from the session when it is set."""

from ledgerline.session import PLAN_DEFAULTS, apply_defaults, checkpoint_root


def test_defaults_never_override_the_cluster(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "7MB")
    try:
        apply_defaults(spark)
        assert spark.conf.get(key) == "7MB"
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    apply_defaults(spark)
    assert spark.conf.get(key) == (before or PLAN_DEFAULTS[key])


def test_checkpoint_root_is_read_from_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
