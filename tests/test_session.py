import re

import pytest

from strata import session


def test_cluster_defaults_only_fill_unset(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.unset(key)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    changed = session.apply_cluster_defaults(spark)
    assert changed.get(key) == "256m" and "spark.sql.files.maxPartitionBytes" not in changed
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    for k in changed:
        spark.conf.unset(k)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_now_iso_format():
    assert re.fullmatch(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z", session.now_iso())


def test_scratch_is_under_checkpoint_dir(spark):
    root = session.scratch_root(spark)
    assert session.scratch_path(spark, "x").startswith(f"{root}/strata/x-")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import types

    from strata.session import scratch_root
    context = types.SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        context.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(session)
